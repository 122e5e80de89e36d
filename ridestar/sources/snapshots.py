"""Snapshots of a table kept as several folders: which of them are live, switched by one rename.

A table's folder holds data folders, each written once and never changed, and ``_snapshots`` with one small JSON file
per version. A version is written aside and renamed to its number, so readers see one version or the next and a
crash before the rename leaves only files that no version names. Two writers cannot both commit a number: the
second one's rename is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_snapshots"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class Snapshots:
    """The versions of the table at ``base`` (any Hadoop path)."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.base, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Committed versions, oldest first."""
        fs, folder = self._fs(), self._path(FOLDER)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self._fs().open(self._path(FOLDER, f"{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """(number, state) of the last version; (0, {}) for a table without one."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, number: int, state: dict) -> None:
        """Makes ``state`` version ``number``; ``Conflict`` if that version is there already."""
        fs = self._fs()
        aside, target = self._path(FOLDER, f".{uuid.uuid4().hex}"), self._path(FOLDER, f"{number:012d}.json")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if fs.exists(target):
            fs.delete(aside, False)
            raise Conflict(f"version {number} of {self.base} is there already")
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(target), plain)
        except Exception as e:
            if fs.exists(target):
                raise Conflict(f"version {number} of {self.base} was committed by another writer") from e
            raise

    def new_folder(self, name: str) -> str:
        """The name, relative to ``base``, of a data folder that no version holds yet."""
        return f"{name}-{uuid.uuid4().hex[:12]}"

    def at(self, folder: str) -> str:
        return f"{self.base}/{folder}"

    def vacuum(self, live: callable, keep: int = 1) -> list[str]:
        """Deletes all but the last ``keep`` versions and the data folders that only those named; gives the folders.

        ``live``: the data folders of a state. Folders not named by any version (a writer may be filling them) stay.
        """
        numbers = self.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        held = {f for n in kept for f in live(self.read(n))}
        gone = sorted({f for n in old for f in live(self.read(n))} - held)
        fs = self._fs()
        for folder in gone:
            fs.delete(self._path(folder), True)
        for n in old:   # after the data, so that a crash leaves the versions that name what is left
            fs.delete(self._path(FOLDER, f"{n:012d}.json"), False)
        return gone
