"""Incremental ingest with Structured Streaming.

The landing directory only grows.  Instead of re-reading it every run, a
file-source stream with ``trigger(availableNow=True)`` processes the files
that arrived since the last run and stops; the checkpoint remembers which
files were read, so running the job twice ingests each file once.  The
checkpoint and sink live under the shared folder, so a lost executor (or a
lost driver) resumes from the last committed micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators import feeds, merge
from feedlake.schemas import chart_table
from feedlake.sources.landing import describe_files, landed_name
from feedlake.sources.tables import read_table


def file_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir)


def landing_stream(
    spark: SparkSession,
    landing_dir: str,
    glob: str = "*.json",
    max_files_per_trigger: int | None = None,
    recursive: bool = False,
    name_pattern: str | None = None,
) -> DataFrame:
    """Newly landed documents as a stream of ``(file_name, file_path, doc, kind, ...)``.

    ``name_pattern`` takes the name from the path (its first group) where
    files lie in a folder of their name.
    """
    reader = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    raw = reader.load(landing_dir)
    docs = raw.select(
        landed_name(name_pattern).alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("value").alias("doc"),
    )
    return describe_files(docs)


def run_available_now(stream: DataFrame, sink_dir: str, checkpoint_dir: str, fmt: str = "parquet",
                      partition_by: Sequence[str] = ()) -> None:
    """Process everything available now into an append-only table, then stop."""
    writer = (
        stream.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(sink_dir)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_batches(stream: DataFrame, checkpoint_dir: str, handle: Callable[[DataFrame, str], None]) -> None:
    """Available-now run with a per-micro-batch handler (``foreachBatch``).

    The handler gets the micro-batch and its key, ``<stream id>-<batch id>``:
    the same when a failed batch is run again, and different for every other
    batch of every checkpoint.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        handle(batch, f"{stream_id}-{batch_id}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint_dir)
        .foreachBatch(run)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def write_batch(
    rows: DataFrame, path: str, batch_key: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> None:
    """Write a micro-batch's rows into partitions of its own (``batch``), so
    that a batch that runs again replaces what it wrote before."""
    from feedlake.sinks.tables import write_table

    write_table(
        rows.withColumn("batch", F.lit(batch_key)), path, partition_by=(*partition_by, "batch"), sort_by=sort_by,
        refresh="touched", count_rows=False,
    )


def dedup_batch(batch: DataFrame, batch_key: str, sink_dir: str, keys: Sequence[str], event_time: str) -> None:
    """Add the rows of a micro-batch whose ``keys`` the sink hasn't yet.

    Exact for any number and order of files: there is no watermark that a
    late row could miss, and no state that grows.  Of repeats inside a batch
    the row with the smallest event time stays (of equal ones the smallest
    row).  A repeat carries its event time, so only the days the batch touches are
    read from the sink (partition ``day``), and of those only the keys.
    """
    from feedlake.sinks.tables import partition_filter, table_exists

    spark, others = batch.sparkSession, [c for c in batch.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min(F.struct(F.col(event_time).alias("_at"), *others)).alias("_first"))
    rows = first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others]).select(*batch.columns)
    rows = rows.withColumn("day", F.to_date(event_time))
    if table_exists(spark, sink_dir):
        wanted = partition_filter(rows, "day")
        schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.StringType())])
        seen = spark.read.schema(schema).parquet(sink_dir).filter(F.col("batch") != batch_key)
        if wanted is not None:
            known = seen.filter(wanted).select(*[F.col(c).alias(f"_seen_{c}") for c in (*keys, "day")])
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_seen_{c}")) for c in (*keys, "day")])
            rows = rows.join(known, same, "left_anti")
    write_batch(rows, sink_dir, batch_key, partition_by=("day",))


def run_dedup(stream: DataFrame, sink_dir: str, checkpoint_dir: str, keys: Sequence[str], event_time: str) -> None:
    """Available-now run of ``dedup_batch`` over a stream."""
    run_batches(stream, checkpoint_dir, lambda batch, key: dedup_batch(batch, key, sink_dir, keys, event_time))


def ingest_landing_batch(
    batch: DataFrame,
    table_root: str,
    batch_key: str,
    charts_mode: str = "append",
) -> None:
    """Write one micro-batch of landed documents to the feed tables.

    Used by ``foreachBatch``: each batch is an ordinary DataFrame, so the
    same transforms as the batch job apply.  The batch is parsed once and
    persisted while its five writers run.  Every table is partitioned by the
    batch's key and a batch replaces only its own partitions, so a batch
    that failed between two writers can run again.  With
    ``charts_mode="append"`` chart points keep their snapshot time and
    ``latest_chart`` resolves overlaps on read; with ``"merge"`` they are
    merged into the touched partitions on write (``merge_into_chart_table``).
    """
    from pyspark import StorageLevel

    from feedlake.sinks.tables import merge_into_chart_table

    parsed = batch if feeds.REASONS_COL in batch.columns else feeds.parse_documents(batch, keep_doc=False)
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        charts = parsed.filter(F.col("kind") == "chart")
        for field, value, table in (("prices", "price", "chart_prices"), ("total_volumes", "volume", "chart_volumes")):
            pts = feeds.chart_points(charts, field, value)
            path = f"{table_root}/{table}"
            if charts_mode == "merge":
                merge_into_chart_table(batch.sparkSession, pts, path, value, count_rows=False)
            else:
                write_batch(pts, path, batch_key, partition_by=("coin_id", "date"), sort_by=("timestamp",))
        write_batch(feeds.spot_long(parsed.filter(F.col("kind") == "spot")), f"{table_root}/spot", batch_key)
        write_batch(feeds.catalog_rows(parsed.filter(F.col("kind") == "catalog")), f"{table_root}/catalog", batch_key)
        write_batch(feeds.quarantine(parsed), f"{table_root}/quarantine", batch_key)
    finally:
        parsed.unpersist()


def latest_chart(spark: SparkSession, table_root: str, value_name: str = "price") -> DataFrame:
    """Merged view over the appended chart table: one point per (asset, time)."""
    table = "chart_prices" if value_name == "price" else "chart_volumes"
    schema = T.StructType([*chart_table(value_name).fields, T.StructField("batch", T.StringType())])
    points = read_table(spark, f"{table_root}/{table}", schema=schema).drop("batch")
    return merge.merge_chart_snapshots(points, value_name)


def run_ingest_stream(
    spark: SparkSession,
    landing_dir: str,
    table_root: str,
    checkpoint_dir: str | None = None,
    charts_mode: str = "append",
) -> None:
    """Ingest the files landed since the last run (available-now), then stop.

    The checkpoint defaults to ``<table_root>/_checkpoints/landing`` so it
    lives beside the tables in the shared folder.
    """
    from feedlake.session import use_utc

    use_utc(spark)
    checkpoint_dir = checkpoint_dir or f"{table_root}/_checkpoints/landing"
    run_batches(
        landing_stream(spark, landing_dir),
        checkpoint_dir,
        lambda batch, key: ingest_landing_batch(batch, table_root, key, charts_mode),
    )
