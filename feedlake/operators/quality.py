"""Data-quality and inspection queries over any DataFrame.

Whole-table measures are computed in ONE aggregation pass (one expression
per column) and then unpivoted, instead of one job per column.  Schema
questions (which columns exist, which look like time columns) are answered
from ``df.schema`` - metadata, not data - and then combined with a data pass
so the answer also says how full those columns are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.columns import json_keys, line_count, names_matching

TIME_NEEDLES = ("time", "date")


def _unpivot_one_row(row: DataFrame, names: Sequence[str], var: str, val: str) -> DataFrame:
    return row.unpivot([], list(names), var, val)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, nulls)`` for every column, one pass over the data."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    return _unpivot_one_row(row, columns, "column_name", "nulls")


def nullness_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace ``columns`` by booleans that are null exactly where they were.

    Null counts are unchanged, but a join or shuffle that follows no longer
    carries the values (e.g. whole document texts).
    """
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.lit(True)) for c in columns})


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    columns = list(columns)
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in columns])
    return _unpivot_one_row(row, columns, "column_name", "non_null")


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``(column_name, present, non_null)`` for each required column.

    ``non_null`` is null for a missing column; a present column that is
    entirely null shows 0, which a presence check alone would not reveal.
    """
    spark = df.sparkSession
    present = [c for c in required if c in df.columns]
    wanted = spark.createDataFrame(
        [(c, c in df.columns, i) for i, c in enumerate(required)],
        "column_name string, present boolean, position int",
    )
    if not present:
        return wanted.select("column_name", "present", F.lit(None).cast("long").alias("non_null"))
    counts = non_null_counts(df, present)
    return (
        wanted.join(F.broadcast(counts), "column_name", "left")
        .orderBy("position")
        .select("column_name", "present", "non_null")
    )


def similar_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """For each wanted name, existing columns that contain it (case-insensitive).

    Returns ``(wanted, candidate, non_null)``.  Candidate search is over the
    schema; the fill rate of every candidate comes from one data pass.
    """
    spark = df.sparkSession
    pairs = [(w, c) for w in wanted for c in df.columns if w.lower() in c.lower()]
    candidates = sorted({c for _, c in pairs})
    pair_df = spark.createDataFrame(pairs, "wanted string, candidate string")
    if not candidates:
        return pair_df.withColumn("non_null", F.lit(None).cast("long"))
    counts = non_null_counts(df, candidates).withColumnRenamed("column_name", "candidate")
    return pair_df.join(F.broadcast(counts), "candidate").select("wanted", "candidate", "non_null")


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str:
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def distinct_keys(df: DataFrame, candidates: Sequence[str] = ("id", "coin_id")) -> DataFrame:
    """Distinct values of the first candidate key column that exists."""
    key = first_existing(df, candidates)
    return df.select(key).distinct()


def time_columns(df: DataFrame, needles: Sequence[str] = TIME_NEEDLES) -> list[str]:
    return names_matching(df.columns, needles)


def distinct_time_values(df: DataFrame, n: int = 10, needles: Sequence[str] = TIME_NEEDLES) -> DataFrame:
    """The ``n`` smallest distinct values of each time-like column.

    ``(column_name, value)`` with the value as text so columns of different
    types fit one result.  Each part is a distinct + top-k, which Spark
    plans as partial/final aggregation and ``TakeOrderedAndProject``.
    """
    parts = []
    for c in time_columns(df, needles):
        top = df.select(c).distinct().orderBy(c).limit(n)
        parts.append(top.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, value string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def series_stats(
    points: DataFrame,
    keys: Sequence[str] = ("coin_id",),
    ts: str = "timestamp",
    value: str = "price",
    mean_digits: int | None = None,
) -> DataFrame:
    """First/last time, count, mean, min and max per series."""
    mean = F.avg(value)
    if mean_digits is not None:
        mean = F.round(mean, mean_digits)
    return points.groupBy(*keys).agg(
        F.count(value).alias("n_points"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        mean.alias(f"mean_{value}"),
        F.min(value).alias(f"min_{value}"),
        F.max(value).alias(f"max_{value}"),
    )


def json_shape_profile(df: DataFrame, doc_col: str, id_cols: Sequence[str]) -> DataFrame:
    """Per document: number of top-level keys/elements and the key list."""
    keys = json_keys(doc_col)
    return df.select(
        *id_cols,
        F.coalesce(F.size(keys), F.json_array_length(doc_col)).cast("long").alias("n_items"),
        F.array_join(keys, ",").alias("keys"),
    )


def json_type_profile(df: DataFrame, doc_col: str, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., key, json_type, n)``: JSON type of every top-level key's
    values, counted over all documents (map-side combined, one small shuffle).

    Types are the JSON names: object, array, string, number, boolean, null.
    Documents that are no JSON object have no keys.
    """
    parsed = df.select(*group, F.try_parse_json(doc_col).alias("_doc"))
    fields = df.sparkSession.sql("SELECT d.*, f.key, f.value FROM {parsed} d, LATERAL variant_explode(_doc) f", parsed=parsed)
    kind = F.schema_of_variant("value")
    json_type = (
        F.when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", "null")
        .otherwise("number")
    )
    keyed = fields.filter(F.col("key").isNotNull())  # array elements have a position only
    return keyed.groupBy(*group, "key", json_type.alias("json_type")).agg(F.count(F.lit(1)).alias("n"))


def text_shape_profile(df: DataFrame, text_col: str, id_cols: Sequence[str], head_chars: int = 200) -> DataFrame:
    """Bytes, lines, single-line flag and leading characters of each text."""
    lines = line_count(text_col)
    return df.select(
        *id_cols,
        F.octet_length(text_col).cast("long").alias("n_bytes"),
        lines.alias("n_lines"),
        (lines == 1).alias("single_line"),
        F.substring(text_col, 1, head_chars).alias("head"),
    )


def preview_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """Deterministic first ``n`` rows (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """``(position, column_name, data_type, non_null)`` for every column."""
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, data_type string",
    )
    counts = non_null_counts(df, df.columns)
    return meta.join(F.broadcast(counts), "column_name").select("position", "column_name", "data_type", "non_null")


def partition_listing(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Distinct partition values, sorted.  Only partition columns are read."""
    return df.select(*partition_cols).distinct().orderBy(*partition_cols)
