"""Batch ingest of a whole landing zone into the feed tables.

One scan of the landing directory feeds every output table.  Every document is
parsed once (``feeds.parse_documents``) and the parsed frame - typed
columns and the rejected texts, not the raw ones - is persisted (memory
and disk) because seven writers and the report read it; if an executor is
lost, its blocks are recomputed from the scan.  Chart snapshots are merged set-based (latest snapshot wins per
(asset, time)), so the result doesn't depend on file listing order.

Landed files come and go (older ones are archived), so the default run
*merges* what is landed now into the tables; nothing that an earlier run
ingested is lost when its file has left the landing zone, and running again
over the same files changes nothing.  ``refresh="full"`` rebuilds the tables
from the landing zone alone.

Outputs under ``table_root``:
  catalog        latest snapshot of the asset list, with ingestion time
  spot           every quote, long form, with its snapshot time, by snapshot date
  spot_latest    latest quote per (asset, currency)
  spot_wide      latest quotes, one row per asset, one column per currency
  chart_prices   merged points, partitioned by (coin_id, date)
  chart_volumes  merged points, partitioned by (coin_id, date)
  quarantine     unusable documents and rows, with a reason, by snapshot date
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.columns import snapshot_time
from feedlake.operators import feeds, merge, report
from feedlake.schemas import QUARANTINE_TABLE, SPOT_LATEST_TABLE, SPOT_TABLE, chart_table
from feedlake.session import use_utc
from feedlake.sinks.tables import append_new_rows, merge_into_table, table_exists, write_table
from feedlake.sources.landing import describe_files, scan_landing


def run_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_root: str,
    refresh: str = "merge",
    glob: str = "*.json",
) -> DataFrame:
    """Ingest every landed file; returns the run report (already computed).

    ``refresh="merge"`` keeps what earlier runs ingested, ``"full"``
    replaces every table.
    """
    if refresh not in ("merge", "full"):
        raise ValueError("refresh must be 'merge' or 'full'")
    return ingest_documents(spark, describe_files(scan_landing(spark, landing_dir, glob)), table_root, refresh)


def ingest_documents(spark: SparkSession, described: DataFrame, table_root: str, refresh: str = "merge") -> DataFrame:
    """``run_ingest`` for described documents from any source."""
    use_utc(spark)
    # Parse every document once; keep the typed columns (not the raw text).
    routed = feeds.parse_documents(described, keep_doc=False).persist(StorageLevel.MEMORY_AND_DISK)

    def store(name: str, rows: DataFrame, schema, keys, order, **layout) -> None:
        path = f"{table_root}/{name}"
        if refresh == "merge":
            merge_into_table(spark, rows, path, schema, keys, order, **layout)
        else:
            chosen = merge.latest_per_key(rows.select(*[f.name for f in schema.fields]), keys, order)
            write_table(chosen, path, partition_by=layout.get("partition_by", ()), sort_by=layout.get("sort_by", ()))

    try:
        by_kind = {k: routed.filter(F.col("kind") == k) for k in ("chart", "spot", "catalog")}
        _store_catalog(spark, feeds.catalog_rows(by_kind["catalog"]), f"{table_root}/catalog", refresh)

        spot = feeds.spot_long(by_kind["spot"]).withColumn("snapshot_date", F.to_date("snapshot_ts"))
        store(
            "spot", spot, SPOT_TABLE, ["coin_id", "currency", "file_name"], ["snapshot_ts", "price"],
            partition_by=("snapshot_date",), date_col="snapshot_date",
        )
        store("spot_latest", spot, SPOT_LATEST_TABLE, ["coin_id", "currency"], ["snapshot_ts", "file_name"])
        # Wide form: one double column per currency.  The pivot discovers the
        # currency names (a distinct over a few dozen values, capped by
        # spark.sql.pivotMaxValues), then aggregates in one pass.
        latest = spark.read.schema(SPOT_LATEST_TABLE).parquet(f"{table_root}/spot_latest")
        write_table(feeds.spot_wide(latest, order=("snapshot_ts", "file_name")), f"{table_root}/spot_wide")

        for field, value, table in (("prices", "price", "chart_prices"), ("total_volumes", "volume", "chart_volumes")):
            store(
                table, feeds.chart_points(by_kind["chart"], field, value), chart_table(value),
                ["coin_id", "timestamp"], ["snapshot_ts", value], partition_by=("coin_id", "date"), sort_by=("timestamp",),
            )

        store_quarantine(spark, feeds.quarantine(routed), f"{table_root}/quarantine", refresh)
        rep = report.run_report(routed)
        rows = rep.collect()  # one row per feed kind: bounded by the routing rules
        return spark.createDataFrame(rows, rep.schema)
    finally:
        routed.unpersist()


def store_quarantine(spark: SparkSession, problems: DataFrame, path: str, refresh: str) -> None:
    """Problems by the day in the file's name.  A file's problems don't change,
    so a merging run only adds those it hasn't seen; a file that comes back
    with other ones adds those."""
    rows = problems.withColumn("snapshot_date", F.to_date(snapshot_time("file_name")))
    day = ("snapshot_date",)
    if refresh == "merge":
        append_new_rows(spark, rows, path, QUARANTINE_TABLE, ["file_path", "file_name", "problem_no", "reason"], day, day[0])
    else:
        write_table(rows.select(*[f.name for f in QUARANTINE_TABLE.fields]), path, partition_by=day)


def _store_catalog(spark: SparkSession, catalog: DataFrame, path: str, refresh: str) -> None:
    """The one latest catalog file (snapshot time, then name), of those landed
    now and, when merging, of the table's."""
    stamped = catalog.select(
        "id", "symbol", "name", "snapshot_ts", "file_name", F.current_timestamp().alias("ingestion_timestamp")
    )
    if refresh == "merge" and table_exists(spark, path):
        newer = catalog.agg(F.max(F.struct("snapshot_ts", "file_name")).alias("k")).first().k
        old = spark.read.schema(stamped.schema).parquet(path)
        known = old.agg(F.max(F.struct("snapshot_ts", "file_name")).alias("k")).first().k
        if newer is None or (known is not None and _file_key(known) > _file_key(newer)):
            return
    latest_file = catalog.agg(F.max_by("file_name", F.struct("snapshot_ts", "file_name")).alias("file_name"))
    write_table(stamped.join(F.broadcast(latest_file), "file_name").select(*stamped.columns), path)  # one-row side


def _file_key(row) -> tuple:
    return (row.snapshot_ts is not None, row.snapshot_ts, row.file_name or "")


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m feedlake.plans.ingest_run LANDING TABLES [--refresh full|merge] [--stream]``"""
    import argparse

    from feedlake.session import get_session

    ap = argparse.ArgumentParser(description="Ingest a landing directory into the feed tables.")
    ap.add_argument("landing_dir")
    ap.add_argument("table_root")
    ap.add_argument("--refresh", choices=("full", "merge"), default="merge")
    ap.add_argument("--stream", action="store_true", help="only files landed since the last run (append)")
    args = ap.parse_args(argv)
    spark = get_session("feedlake-ingest")
    if args.stream:
        from feedlake.streaming.ingest import run_ingest_stream

        run_ingest_stream(spark, args.landing_dir, args.table_root)
    else:
        run_ingest(spark, args.landing_dir, args.table_root, refresh=args.refresh).show(truncate=False)


if __name__ == "__main__":
    main()
