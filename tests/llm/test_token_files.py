import glob
import random
import shutil
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from fixtures import SF, awkward, empty
from tokenizers import Tokenizer

from ridestar.llm.token_files import (Damaged, Together, frame, parse, read_manifest, read_shuffled, read_token_records,
                                      write_token_records)

PATH = P.path("byte_bpe_50k.json")


def wanted(df):
    t = Tokenizer.from_file(PATH)
    rows = sorted([(r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect()])
    out, start = [], 0
    for known, doc_id, text in rows:
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        out.append((doc_id if known else None, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    return out


@pytest.mark.parametrize("source", ["awkward", "sf"])
def test_round_trip_in_order(spark, tmp_dir, source):
    df = awkward(spark) if source == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    write_token_records(df.repartition(5), tmp_dir, PATH, 2)
    got = read_token_records(spark, tmp_dir).collect()
    got.sort(key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start
        assert r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert sorted([(r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got], key=str) == sorted(wanted(df), key=str)
    assert read_manifest(spark, tmp_dir).agg({"tokens": "sum"}).first()[0] == start


def test_shuffled_read_gives_every_record_in_another_order(spark, tmp_dir):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    write_token_records(df, tmp_dir, PATH, 2)
    plain = {r.doc_id: bytes(r.ids) for r in read_token_records(spark, tmp_dir).collect()}
    one, two = ([(r.doc_id, bytes(r.ids)) for r in read_shuffled(spark, tmp_dir, 7, e).collect()] for e in (0, 1))
    assert dict(one) == plain and dict(two) == plain and len(one) == len(plain)
    assert [d for d, _ in one] != [d for d, _ in two]


def test_empty_table(spark, tmp_dir):
    write_token_records(empty(spark), tmp_dir, PATH, 2)
    assert read_token_records(spark, tmp_dir).count() == 0
    assert read_shuffled(spark, tmp_dir, 1).count() == 0


def test_record_frame():
    for doc_id, ids in ((5, [1, 2, 50256]), (None, []), (-1, [70000, 1])):
        data = frame(doc_id, np.array(ids, dtype="<u4"))
        got_id, got, end = parse(memoryview(data), 0)
        assert (got_id, got.tolist(), end) == (doc_id, ids, len(data))
    data = bytearray(frame(5, np.array([1, 2, 3], dtype="<u4")))
    for at in (0, 9, 14, 22, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises((Damaged, struct.error)):
            parse(memoryview(bytes(bad)), 0)
    with pytest.raises(Damaged):
        parse(memoryview(bytes(data[:-2])), 0)


def test_damage_is_found_on_reading(spark, tmp_dir):
    write_token_records(awkward(spark), tmp_dir, PATH, 2)
    path = max(glob.glob(f"{tmp_dir}/*.records"), key=lambda p: len(open(p, "rb").read()))
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 0x40
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="checksum|cut off"):
        read_token_records(spark, tmp_dir).collect()


def test_units_encoded_together_are_those_of_the_library():
    rng = random.Random(3)
    letters = ["a", "é", "日", "\t", "\u00a0", ".", "'s", "9", "<|endoftext|>", "\U0001f600", "x" * 300, "\r", "\u2028", "THE", "\x1c"]
    units = [rng.choice([" ", "\n", "", "\t"]) + "".join(rng.choice(letters) for _ in range(rng.randint(0, 5))) for _ in range(6000)]
    t = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch(units, add_special_tokens=False)]
    assert list(Together(t).encode(units)) == want


def test_what_a_lost_attempt_left_is_not_read(spark, tmp_dir):
    df = awkward(spark)
    write_token_records(df, tmp_dir, PATH, 2)
    for path in glob.glob(f"{tmp_dir}/*.records"):
        shutil.copy(path, path.replace("shard-", "shard-000000-99-dead"))
    got = read_token_records(spark, tmp_dir)
    assert got.count() == df.count() and read_shuffled(spark, tmp_dir, 1).count() == df.count()
    assert not glob.glob(f"{tmp_dir}/shard-??????.records")
