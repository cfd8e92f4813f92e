"""Inspect a table: schema with fill counts, row count, nulls, keys, time values.

    spark-submit -m feedlake.plans.inspect_table PATH [--format parquet] [--partitions coin_id,date]

Every measure is a distributed aggregate; only the small results are shown.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from feedlake.operators import quality


def inspect(spark: SparkSession, path: str, fmt: str = "parquet", partitions: list[str] | None = None) -> dict[str, DataFrame]:
    df = spark.read.format(fmt).load(path)
    out = {
        "schema": quality.schema_profile(df),
        "nulls": quality.null_counts(df),
        "preview": df.limit(5),
    }
    keys = [c for c in ("id", "coin_id") if c in df.columns]
    if keys:
        out["distinct_keys"] = quality.distinct_keys(df, keys)
    if quality.time_columns(df):
        out["time_values"] = quality.distinct_time_values(df, 10)
    if partitions:
        out["partitions"] = quality.partition_listing(df, partitions)
    return out


def main(argv: list[str] | None = None) -> None:
    from feedlake.session import get_session

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("path")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--partitions", default="")
    args = ap.parse_args(argv)
    spark = get_session("feedlake-inspect")
    parts = [p for p in args.partitions.split(",") if p]
    for name, frame in inspect(spark, args.path, args.format, parts).items():
        print(f"== {name}")
        frame.show(20, truncate=False)


if __name__ == "__main__":
    main()
