"""Explicit schemas for the landed feeds and the output tables.

Nothing in the package infers a schema: inference is content dependent (an
all-integral chart infers ``bigint``, an empty array infers no columns) and
costs an extra pass over the input.
"""

from __future__ import annotations

from pyspark.sql import types as T

# -- landed documents --------------------------------------------------------

# coins_list: a root array of {id, symbol, name}
CATALOG_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)
CATALOG_DOC = T.ArrayType(CATALOG_ITEM)

# simple_price: {asset: {currency: value}}.  Values are read as text and
# checked afterwards, so one bad quote loses one row, not the document.
SPOT_ENTRY = T.MapType(T.StringType(), T.StringType())
SPOT_DOC = T.MapType(T.StringType(), SPOT_ENTRY)

# market_chart_<id>: {"prices": [[epoch_ms, v], ...], "total_volumes": [...]}.
# Cells are text for the same reason.
PAIR = T.ArrayType(T.StringType())
PAIR_LIST = T.ArrayType(PAIR)
CHART_FIELDS = ("prices", "total_volumes")
CHART_DOC = T.StructType([T.StructField(f, PAIR_LIST) for f in CHART_FIELDS])

# Raw parts, for documents of which a part doesn't fit
TEXT_MAP = T.MapType(T.StringType(), T.StringType())
TEXT_LIST = T.ArrayType(T.StringType())

# -- output tables -------------------------------------------------------------

CATALOG_TABLE = T.StructType(
    CATALOG_ITEM.fields + [T.StructField("snapshot_ts", T.TimestampType())]
)

SPOT_LONG_TABLE = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quote_ts", T.TimestampType()),
        T.StructField("snapshot_ts", T.TimestampType()),
    ]
)


# the ingest job's spot tables: each quote with the file it came from
SPOT_LATEST_TABLE = T.StructType([*SPOT_LONG_TABLE.fields, T.StructField("file_name", T.StringType())])
SPOT_TABLE = T.StructType([*SPOT_LATEST_TABLE.fields, T.StructField("snapshot_date", T.DateType())])


def chart_table(value_name: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("coin_id", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
            T.StructField(value_name, T.DoubleType()),
            T.StructField("date", T.DateType()),
            T.StructField("snapshot_ts", T.TimestampType()),
        ]
    )


QUARANTINE_TABLE = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("problem_no", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("rejected_doc", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

METRIC_SAMPLE = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)
