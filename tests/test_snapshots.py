"""Versions of a table: one rename commits, a crash before it changes nothing, readers see whole versions."""

import os

import pytest

from ridestar.sources.snapshots import FOLDER, Conflict, Snapshots


def test_versions_follow_each_other(spark, tmp_dir):
    s = Snapshots(spark, f"{tmp_dir}/t")
    assert s.current() == (0, {}) and s.numbers() == []
    s.commit(1, {"live": ["a"]})
    s.commit(2, {"live": ["a", "b"]})
    assert s.current() == (2, {"live": ["a", "b"]}) and s.read(1) == {"live": ["a"]}


def test_a_number_is_committed_once(spark, tmp_dir):
    s = Snapshots(spark, f"{tmp_dir}/t")
    s.commit(1, {"by": "first"})
    with pytest.raises(Conflict):
        s.commit(1, {"by": "second"})
    assert s.current() == (1, {"by": "first"})
    assert not [n for n in os.listdir(f"{tmp_dir}/t/{FOLDER}") if n.startswith(".") and not n.endswith(".crc")]


def test_a_version_half_written_is_not_read(spark, tmp_dir):
    s = Snapshots(spark, f"{tmp_dir}/t")
    s.commit(1, {"live": ["a"]})
    with open(f"{tmp_dir}/t/{FOLDER}/.0123", "w") as f:
        f.write('{"live": ["b"')
    assert s.current() == (1, {"live": ["a"]})


def test_vacuum_deletes_only_folders_of_old_versions(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    s = Snapshots(spark, base)
    for name in ("a", "b", "c", "filling"):
        os.makedirs(f"{base}/{name}")
    s.commit(1, {"live": ["a", "b"]})
    s.commit(2, {"live": ["b", "c"]})
    assert s.vacuum(lambda state: state["live"]) == ["a"]
    assert sorted(n for n in os.listdir(base) if n != FOLDER) == ["b", "c", "filling"]
    assert s.numbers() == [2] and s.vacuum(lambda state: state["live"]) == []
