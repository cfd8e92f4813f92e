"""Replacing a table's files without ever losing the former ones.

Spark's own overwrite deletes what it replaces *before* the job runs (static)
or in the middle of its commit (dynamic), so a job that fails, or a driver
that is lost, takes the table with it.  Here a write has three steps:

1. *stage*: the job writes the new files into ``<table>/_staged/<id>``.  If
   it fails, the table has not been touched.
2. *commit*: one small record ``<table>/_commit.json`` that lists what goes out
   and what comes in appears by one rename.  From here the new version counts.
3. *settle*: entries that go out move to ``<table>/_former/<id>``, staged ones
   into the table; then the record goes.  Every move can be repeated, so a
   reader or writer that finds a record (``settle``) finishes an interrupted
   one.  The former version stays until the next commit, which also removes
   what failed writes left staged.

Names that begin with ``_`` are invisible to Spark's readers, so a table is
an ordinary directory for every reader.  Only names are moved, on the driver,
as many as there are replaced partitions (or top-level entries).  One writer
per table at a time; a second one finds the record and settles it first.
Delta tables have a log of their own and don't come here.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

STAGED, RECORD, FORMER = "_staged", "_commit.json", "_former"
_MOVERS = 16


class TableFiles:
    """The files of one table directory, through Spark's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        # every step of a name in the JVM is a round trip: the class once
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._utils = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self.root = self._path(root)
        self._base = self.root.toString().rstrip("/")
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, relative: str):
        return self._path(f"{self._base}/{relative}")

    def exists(self, relative: str) -> bool:
        return self.fs.exists(self.at(relative))

    def names(self, relative: str = "") -> list[tuple[str, bool]]:
        """(name, is a directory) of the entries of a directory, none if absent."""
        path = self.at(relative) if relative else self.root
        if not self.fs.exists(path):
            return []
        return sorted((s.getPath().getName(), s.isDirectory()) for s in self.fs.listStatus(path))

    def visible(self) -> list[str]:
        """Entries that readers see, and the marker of a finished job."""
        return [n for n, _ in self.names() if n == "_SUCCESS" or not n.startswith(("_", "."))]

    def leaves(self, relative: str, depth: int) -> list[str]:
        """Directories ``depth`` levels below, relative to ``relative``."""
        found = [""]
        for _ in range(depth):
            found = [
                f"{above}/{name}".lstrip("/")
                for above in found
                for name, is_dir in self.names(f"{relative}/{above}".rstrip("/"))
                if is_dir and not name.startswith(("_", "."))
            ]
        return found

    def move(self, source: str, target: str) -> None:
        """Rename; nothing to do where the source is gone (moved before)."""
        src, dst = self.at(source), self.at(target)
        if not self.fs.exists(src):
            return
        self.fs.mkdirs(dst.getParent())
        if not self.fs.rename(src, dst) and self.fs.exists(src):
            raise OSError(f"could not move {src} to {dst}")

    def delete(self, relative: str) -> None:
        self.fs.delete(self.at(relative), True)

    def read_text(self, relative: str) -> str:
        stream = self.fs.open(self.at(relative))
        try:
            return self._utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text_once(self, relative: str, text: str) -> None:
        """Create a file that appears whole or not at all."""
        draft = self.at(f"{relative}.{uuid.uuid4().hex[:8]}")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.exists(relative) or not self.fs.rename(draft, self.at(relative)):
            self.fs.delete(draft, False)
            raise OSError(f"{self.at(relative)} exists: another writer is committing to this table")


def new_id() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def staging_path(path: str, commit_id: str) -> str:
    return f"{path.rstrip('/')}/{STAGED}/{commit_id}"


def commit(spark: SparkSession, path: str, commit_id: str, partition_depth: int | None = None) -> None:
    """Make the staged files the table's.

    ``partition_depth`` given: replace only the partitions (directories that
    deep) that are staged; else everything that readers see.
    """
    settle(spark, path)
    files = TableFiles(spark, path)
    staged = f"{STAGED}/{commit_id}"
    if partition_depth:
        comes = files.leaves(staged, partition_depth)
        goes = comes
    else:
        comes = [n for n, _ in files.names(staged)]
        goes = files.visible()
    if not comes and not goes:
        files.delete(staged)
        return
    files.write_text_once(RECORD, json.dumps({"id": commit_id, "out": goes, "in": comes}))
    settle(spark, path)


def settle(spark: SparkSession, path: str) -> None:
    """Finish a committed replacement that was interrupted, if there is one."""
    files = TableFiles(spark, path)
    if not files.exists(RECORD):
        return
    record = json.loads(files.read_text(RECORD))
    staged, former = f"{STAGED}/{record['id']}", f"{FORMER}/{record['id']}"
    comes = set(record["in"])

    def replace(name: str) -> None:
        # an entry that comes in is still staged, or is in place already; in
        # the second case what lies in its place must not go out again
        if name not in comes or files.exists(f"{staged}/{name}"):
            if not files.exists(f"{former}/{name}"):
                files.move(name, f"{former}/{name}")
            if name in comes:
                files.move(f"{staged}/{name}", name)

    _each(replace, dict.fromkeys([*record["out"], *record["in"]]))
    files.delete(RECORD)
    for name, _ in files.names(FORMER):
        if name != record["id"]:
            files.delete(f"{FORMER}/{name}")
    for name, _ in files.names(STAGED):
        if name <= record["id"]:  # ids sort by time: of failed writes before this one
            files.delete(f"{STAGED}/{name}")


def _each(do, names: Iterable[str]) -> None:
    with ThreadPoolExecutor(_MOVERS) as pool:
        for _ in pool.map(do, names):
            pass
