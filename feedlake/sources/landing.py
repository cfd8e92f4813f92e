"""Landing-zone scan: one row per landed JSON document.

The whole landing directory is read in ONE distributed pass (no driver-side
file loop).  Each file becomes a row ``(file_name, file_path, file_size,
file_mtime, doc)``; the feed, asset id and snapshot time are derived from the
name as columns, so every feed of every file goes through one plan.

A multi-line document cannot be split, so a file is the unit of parallelism:
scale comes from the number of files.  Spark packs many small files into one
read task (``spark.sql.files.openCostInBytes``), so a landing zone of
millions of few-kB files does not become millions of tasks.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.columns import (
    FEED_RULES,
    UNRECOGNISED,
    chart_asset_id,
    route_by_name,
    shape_from_probes,
    shape_probes,
    snapshot_time,
)

LANDING_COLUMNS = ("file_name", "file_path", "file_size", "file_mtime", "doc")


def scan_landing(
    spark: SparkSession,
    path: str,
    glob: str = "*.json",
    recursive: bool = False,
) -> DataFrame:
    """All regular files matching ``glob`` under ``path`` as whole-text rows.

    Non-recursive by default, like a directory listing of the landing zone.
    Partition columns found in the directory names (``key=value``) are kept.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    # text() has its own wholetext argument, which overrides .option()
    return _described(reader.text(path, wholetext=True), None, {"doc": "value"})


def landed_name(pattern: str | None = None) -> Column:
    """The name of a row's file; ``pattern`` (its first group) takes it from
    the path instead.  Spark gives both as addresses, with ``%20`` for a blank."""
    name = F.regexp_extract("_metadata.file_path", pattern, 1) if pattern else F.col("_metadata.file_name")
    return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _described(raw: DataFrame, name_pattern: str | None, content: dict[str, str]) -> DataFrame:
    """Name, path, size and time of each row's file, the given content, and
    the partition columns."""
    own = {"value", "path", "modificationTime", "length", "content"}
    return raw.select(
        landed_name(name_pattern).alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        *[F.col(c).alias(name) for name, c in content.items()],
        *[c for c in raw.columns if c not in own],
    )


def describe_files(
    docs: DataFrame,
    name_col: str = "file_name",
    rules=FEED_RULES,
) -> DataFrame:
    """Add ``kind`` (first matching name rule), ``asset_id`` and ``snapshot_ts``."""
    return docs.withColumns(
        {
            "kind": route_by_name(name_col, rules),
            "asset_id": chart_asset_id(name_col),
            "snapshot_ts": snapshot_time(name_col),
        }
    )


def describe_shapes(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Add ``shape`` - the feed judged from the document itself.

    The probes (keys, array length, ...) are computed in their own
    projection, so each parses the document once even though the
    classification refers to some of them several times.
    """
    probes = shape_probes(doc_col)
    probed = docs.withColumns(probes)
    return probed.withColumn("shape", shape_from_probes({k: F.col(k) for k in probes})).drop(*probes)


def split_by_kind(docs: DataFrame) -> dict[str, DataFrame]:
    """Lazy per-feed views of one described landing frame."""
    kinds = [kind for _, kind in FEED_RULES] + [UNRECOGNISED]
    return {kind: docs.filter(F.col("kind") == kind) for kind in kinds}


def scan_names(
    spark: SparkSession, path: str, glob: str = "*.json", recursive: bool = False, name_pattern: str | None = None
) -> DataFrame:
    """Names, sizes and times of the landed files, ``(file_name, file_path,
    file_size, file_mtime)`` and partition columns; no file is opened.

    The binary file source answers this from the files' status as long as its
    ``content`` column isn't asked for.  ``name_pattern`` takes the name from
    the path (its first group) where files lie in a folder of their name.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return _described(reader.load(path), name_pattern, {})


def newest_names(described: DataFrame, by: tuple[str, ...] = ("kind",)) -> DataFrame:
    """Per feed (or per ``by``) the name row of its newest file: snapshot time
    from the name, then modification time, then name."""
    from feedlake.operators.merge import latest_per_key

    order = [c for c in ("snapshot_ts", "file_mtime", "file_name", "file_path") if c in described.columns]
    return latest_per_key(described, list(by), order)


#: So many winners are read by their paths; more, by a join on the path.
MOST_PATHS = 1000


def read_newest(
    spark: SparkSession,
    path: str,
    glob: str = "*.json",
    by: tuple[str, ...] = ("kind",),
    recursive: bool = False,
    name_pattern: str | None = None,
) -> DataFrame:
    """The newest landed file per feed (or per ``by``) with its document.

    The winners come from the names alone; then only their files are opened.
    A feed has one winner, so there are a few paths; more than ``MOST_PATHS``
    (``by`` an asset, say) never come to the driver but meet the scan in a join.
    """
    names = scan_names(spark, path, glob, recursive, name_pattern)
    newest = newest_names(describe_files(names), by)
    paths = [r.file_path for r in newest.select("file_path").limit(MOST_PATHS + 1).collect()]
    reader = spark.read.option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", "true") if recursive else reader.option("basePath", path)
    few = 0 < len(paths) <= MOST_PATHS
    docs = reader.text([_as_path(p) for p in paths] if few else path, wholetext=True)
    docs = describe_files(_described(docs, name_pattern, {"doc": "value"}))
    if few:
        return docs
    return docs.join(newest.select(F.col("file_path").alias("_newest")), F.col("file_path") == F.col("_newest"), "left_semi")


def _as_path(uri: str) -> str:
    """A listed file's address as a path to load: no part of it is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def latest_files(described: DataFrame, by: tuple[str, ...] = ("kind",)) -> DataFrame:
    """Newest landed file per feed (or per ``by``) of a frame of documents.

    The winners are found by an aggregate over names and times alone; the
    documents are only touched by the semi-join that keeps the winners'.
    ``read_newest`` does the same for a directory without opening the others."""
    narrow = [c for c in (*by, "snapshot_ts", "file_mtime", "file_name", "file_path") if c in described.columns]
    newest = newest_names(described.select(*dict.fromkeys(narrow)), by)
    file = "file_path" if "file_path" in described.columns else "file_name"
    return described.join(newest.select(F.col(file).alias("_newest")), F.col(file) == F.col("_newest"), "left_semi")
