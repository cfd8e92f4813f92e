"""Table writers: full or touched-partition refresh, exports, verification.

Partitioned writes ask AQE to *rebalance* on the partition columns (the
``rebalance`` hint): rows of one partition value go to the same tasks, so
each directory gets few files, while a partition value that holds a third
of all rows is split over several tasks instead of one.  Rows are sorted by
``sort_by`` inside each file so Parquet row-group min/max statistics skip
data on time filters.

An overwrite stages its files beside the table's and swaps them in when all
are written (``sinks.commit``), so a write that fails, at whatever point,
leaves the former rows in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from feedlake.sinks import commit
from feedlake.sources.tables import CSV_NULL_LIKE, CSV_OPTIONS


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    refresh: str = "full",
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
    count_rows: bool = True,
) -> int | None:
    """Write ``df`` and return the number of rows written.

    ``refresh="full"`` replaces the whole table; ``refresh="touched"``
    replaces only the partitions present in ``df`` and keeps all others.  Both
    keep the former files until every new one is written, so ``df`` may read
    the table it replaces.  The row count is collected
    by an ``Observation`` during the write itself - no second job.  Pass
    ``count_rows=False`` inside ``foreachBatch``, where observations of the
    micro-batch frame are not available; ``None`` is returned then.
    """
    if refresh not in ("full", "touched"):
        raise ValueError("refresh must be 'full' or 'touched'")
    obs = Observation("written") if count_rows else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    elif sort_by:
        out = out.sortWithinPartitions(*sort_by)
    writer = out.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    touched = bool(partition_by) and refresh == "touched"
    if mode == "overwrite" and fmt != "delta":
        commit_id = commit.new_id()
        writer.save(commit.staging_path(path, commit_id))
        commit.commit(df.sparkSession, path, commit_id, len(partition_by) if touched else None)
    else:  # appends add files only; Delta replaces through its own log
        if touched and mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.mode(mode).save(path)
    return _observed_rows(obs)


def _observed_rows(obs: Observation | None) -> int | None:
    """Row count from the observation; 0 for an input without rows."""
    if obs is None:
        return None
    try:
        return int(obs.get["rows"])
    except Py4JJavaError as error:
        # the one known case: nothing to write, no task ran, no metrics row
        if error.java_exception.getClass().getSimpleName() != "AssertionError":
            raise
        return 0


def verify_written(spark, path: str, expected_rows: int, fmt: str = "parquet") -> dict:
    """Read the table back and compare its row count with what was written."""
    found = spark.read.format(fmt).load(path).count()
    return {"rows_written": expected_rows, "rows_read": found, "ok": found == expected_rows}


#: Bytes that a file of a CSV export has at most, and of a usual one to a row's mean.
CSV_FILE_BYTES, CSV_ROOM = 128 << 20, 8


def _csv_width(df: DataFrame) -> Column:
    """Bytes of a row's line at most: every text in quotes, its own doubled."""
    parts = []
    for f in df.schema.fields:
        text = F.col(f"`{f.name}`").cast("string")
        quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
        parts.append(F.coalesce((F.octet_length(text) + quotes).cast("long"), F.lit(2)) + F.lit(3))
    return reduce(lambda x, y: x + y, parts, F.lit(0).cast("long"))


def export_csv(df: DataFrame, path: str, header: bool = True, max_file_bytes: int = CSV_FILE_BYTES) -> None:
    """CSV that ``read_csv`` reads back unchanged: quotes are doubled, blanks
    and line breaks kept, the empty text (quoted) differs from null (``\\N``);
    a text that looks like the null mark gets one more backslash.

    A file with line breaks inside values is read by one task, so files are
    bounded: no file exceeds ``max_file_bytes`` (but for a single longer row).
    Rows are measured in a first pass; a file has as many as fit if each is
    ``CSV_ROOM`` times the mean.  Longer ones, an eighth of all rows at most,
    go to files of their own, as many as fit of the longest.  The former
    export stays until the new one is written.
    """
    marked = df.select(
        *[
            F.when(F.col(f"`{f.name}`").rlike(CSV_NULL_LIKE), F.concat(F.lit("\\"), F.col(f"`{f.name}`"))).otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
    spark, width, commit_id = df.sparkSession, _csv_width(marked), commit.new_id()
    room = max_file_bytes - sum(len(c.encode()) + 3 for c in df.columns)
    mean, longest = marked.agg(F.avg(width), F.max(width)).first()
    usual = max(1, int(room // (CSV_ROOM * (mean or 1))))
    sets = [(marked, usual)]
    if longest and usual * longest > room:
        fits = width <= F.lit(room // usual)
        sets = [(marked.where(fits), usual), (marked.where(~fits), max(1, room // longest))]
    for rows, records in sets:
        writer = rows.write.mode("append").options(**CSV_OPTIONS, header=str(header).lower())
        writer.option("maxRecordsPerFile", records).csv(commit.staging_path(path, commit_id))
    commit.commit(spark, path, commit_id)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, one object per row (what Spark and most readers split).
    The former export stays until the new one is written."""
    commit_id = commit.new_id()
    df.write.json(commit.staging_path(path, commit_id))
    commit.commit(df.sparkSession, path, commit_id)


def export_json_documents(
    df: DataFrame,
    path: str,
    group_col: str,
    id_col: str,
    max_items: int = 1000,
    buckets: int = 64,
) -> None:
    """Indented JSON documents, root arrays of rows of one ``group_col`` value.

    A document holds the rows of a group whose ``id_col`` (a unique number)
    falls in one range of ``max_items``, so neither a document nor a
    ``collect_list`` grows with a hot group, the split needs no join and no
    second scan, a null group is a group, and a retried task writes the same
    documents.  Each document is one multi-line file, readable with
    ``multiLine``; files lie in ``buckets`` directories whatever the keys.
    """
    part = F.floor(F.col(id_col) / F.lit(max_items))
    docs = df.groupBy(F.col(group_col).alias("_group"), part.alias("_part")).agg(
        F.to_json(F.collect_list(F.struct(*df.columns)), {"pretty": "true"}).alias("value")
    )
    bucket = F.pmod(F.xxhash64("_group", "_part"), F.lit(buckets)).alias("bucket")
    # one document per file: a multi-line JSON file holds exactly one value
    commit_id = commit.new_id()
    writer = docs.select("value", bucket).write.option("maxRecordsPerFile", 1)
    writer.partitionBy("bucket").text(commit.staging_path(path, commit_id))
    commit.commit(df.sparkSession, path, commit_id)


def table_exists(spark, path: str) -> bool:
    commit.settle(spark, path)
    return any(n != "_SUCCESS" for n in commit.TableFiles(spark, path).visible())


def partition_filter(new: DataFrame, column: str, most: int = 1000) -> Column | None:
    """A literal filter on a partition column that keeps the values ``new``
    has: a list while they are few, else their range.  So only those
    directories are listed and read, and one stray old value doesn't widen
    the list to everything in between.  ``None`` if ``new`` has no rows."""
    values = [r[0] for r in new.select(column).distinct().limit(most + 1).collect()]
    if not values:
        return None
    known = [v for v in values if v is not None]
    if len(values) <= most:
        kept = F.col(column).isin(known) if known else F.lit(False)
        return kept | F.col(column).isNull() if None in values else kept
    lo, hi, nulls = new.agg(F.min(column), F.max(column), F.max(F.col(column).isNull())).first()
    kept = F.col(column).between(F.lit(lo), F.lit(hi))
    return kept | F.col(column).isNull() if nulls else kept


def touched_partitions(
    spark,
    path: str,
    new: DataFrame,
    schema,
    partition_by: Sequence[str] = ("coin_id", "date"),
    date_col: str = "date",
    fmt: str = "parquet",
) -> DataFrame:
    """Existing rows of the partitions ``new`` touches: a literal filter on
    ``date_col`` prunes the directories, then a null-safe semi-join on all
    partition columns keeps exactly the touched ones."""
    old = spark.read.format(fmt).schema(schema).load(path)
    wanted = partition_filter(new, date_col)
    if wanted is None:
        return old.filter(F.lit(False))
    keys = new.select(*[F.col(c).alias(f"_new_{c}") for c in partition_by]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in partition_by])
    return old.filter(wanted).join(keys, same, "left_semi")


def merge_into_table(
    spark,
    rows: DataFrame,
    path: str,
    schema,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    date_col: str = "date",
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
    count_rows: bool = True,
) -> int | None:
    """Merge rows into a table, the greatest ``order`` per ``keys`` wins.

    A partitioned table reads back and rewrites only the partitions the new
    rows touch; all others stay as they are.  The former rows are read from
    the table itself, whose files stay until the merged ones are complete, so
    nothing is copied in between and a merge that fails changes nothing.
    Merging the same rows again changes nothing.
    """
    from feedlake.operators.merge import latest_per_key

    new = rows.select(*[f.name for f in schema.fields])
    if table_exists(spark, path):
        if partition_by:
            old = touched_partitions(spark, path, new, schema, partition_by, date_col, fmt)
        else:
            old = spark.read.format(fmt).schema(schema).load(path)
        new = old.unionByName(new)
    merged = latest_per_key(new, keys, order)
    refresh = "touched" if partition_by else "full"
    return write_table(merged, path, partition_by=partition_by, sort_by=sort_by, refresh=refresh, fmt=fmt, count_rows=count_rows)


def append_new_rows(
    spark,
    rows: DataFrame,
    path: str,
    schema,
    keys: Sequence[str],
    partition_by: Sequence[str],
    date_col: str,
    fmt: str = "parquet",
) -> bool:
    """Add the rows whose ``keys`` the touched partitions don't hold yet;
    whether there were any.

    For a history whose rows never change: nothing is rewritten, only key
    columns of the touched partitions are read back, and a run without news
    writes no file.  Run again after a failure, it adds what is missing.
    """
    new = rows.select(*[f.name for f in schema.fields])
    if table_exists(spark, path):
        known = touched_partitions(spark, path, new, schema, partition_by, date_col, fmt)
        known = known.select(*[F.col(c).alias(f"_known_{c}") for c in (*keys, *partition_by)])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in (*keys, *partition_by)])
        new = new.join(known, same, "left_anti")
    if new.isEmpty():
        if not commit.TableFiles(spark, path).visible():
            # a table without rows still has a schema: one empty file in the null partition
            null_partition = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in partition_by)
            new.drop(*partition_by).limit(0).write.format(fmt).save(f"{path}/{null_partition}")
        return False
    write_table(new, path, partition_by=partition_by, fmt=fmt, mode="append", count_rows=False)
    return True


def merge_into_chart_table(
    spark,
    points: DataFrame,
    path: str,
    value_name: str = "price",
    keys: Sequence[str] = ("coin_id", "timestamp"),
    partition_by: Sequence[str] = ("coin_id", "date"),
    date_col: str = "date",
    fmt: str = "parquet",
    count_rows: bool = True,
) -> int | None:
    """Merge chart points into a partitioned table, the latest snapshot wins."""
    from feedlake.schemas import chart_table

    return merge_into_table(
        spark, points, path, chart_table(value_name), keys, ("snapshot_ts", value_name), partition_by, date_col,
        sort_by=("timestamp",), fmt=fmt, count_rows=count_rows,
    )
