"""Landed documents derived from the driver tables.

The catalogue queries run the real feed transforms, so they need landed
documents.  These are built from the given tables by Spark itself: rows are
packed into JSON documents of the same shapes the fetcher lands.

Every document is a group of at most ``chunk`` source rows (the group key
includes ``id div chunk``), so no document - and no ``collect_list`` group -
grows with the data or with a hot key.  Every source row lands in exactly
one document; nothing is sampled or dropped.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.columns import ts_to_epoch_ms
from feedlake.session import scratch_path

CHART_CHUNK = 256
SPOT_CHUNK = 256
CATALOG_CHUNK = 1000
ORDERS_CHUNK = 1000
DAMAGE_EVERY = {"chart": 7, "spot": 5, "catalog": 11}


def _chunk(col: str, size: int):
    return F.floor(F.col(col) / F.lit(size)).cast("long")


def _name(kind: str, *parts, stamp=None):
    pieces = [F.lit(kind)]
    for p in parts:
        pieces += [F.lit("_"), p]
    stamp = stamp if stamp is not None else F.lit("20250101_000000")
    return F.concat(*pieces, F.lit("_"), stamp, F.lit(".json"))


def _path(*parts):
    """Unique landing path of an emulated document (names may repeat)."""
    pieces = [F.lit("landing")]
    for p in parts:
        pieces += [F.lit("/"), p.cast("string") if not isinstance(p, str) else F.lit(p)]
    return F.concat(*pieces).alias("file_path")


def _stamp(ts_col):
    return F.date_format(ts_col, "yyyyMMdd_HHmmss")


def _pair(ms, value):
    return F.array(ms.cast("double"), value.cast("double"))


def chart_docs_from_events(
    events: DataFrame, value_col: str = "value", chunk: int = CHART_CHUNK, snapshot_col: str | None = None
) -> DataFrame:
    """``market_chart_<event_type>_<stamp>.json`` documents.

    ``prices`` pairs are ``[epoch_ms(ts), value]``; ``total_volumes`` pairs
    carry ``user_id`` as the volume.  One document per (event_type, date,
    event_id div chunk), stamped with its last time - or per snapshot time
    too, and stamped with it, where ``snapshot_col`` is given.
    """
    ms = ts_to_epoch_ms("ts")
    snapshot = [F.col(snapshot_col).alias("_snapshot")] if snapshot_col else []
    grouped = events.groupBy(
        "event_type", F.to_date("ts").alias("_day"), _chunk("event_id", chunk).alias("_chunk"), *snapshot
    ).agg(
        F.collect_list(_pair(ms, F.col(value_col))).alias("prices"),
        F.collect_list(_pair(ms, F.col("user_id"))).alias("total_volumes"),
        F.max("ts").alias("_last"),
    )
    stamp, where = (F.col("_snapshot"), [F.col("_snapshot")]) if snapshot_col else (F.col("_last"), [])
    return grouped.select(
        _name("market_chart", F.col("event_type"), stamp=_stamp(stamp)).alias("file_name"),
        _path("chart", F.col("event_type"), F.col("_day"), F.col("_chunk"), *where),
        F.to_json(F.struct("prices", "total_volumes")).alias("doc"),
    )


def volume_docs_from_lineitem(lineitem: DataFrame, chunk: int = CHART_CHUNK) -> DataFrame:
    """Chart documents that carry only ``total_volumes`` (no ``prices`` key).

    One document per (l_returnflag, l_orderkey div chunk): a few hundred
    pairs, at most ``chunk`` orders x 7 lines, spanning many days as a
    chart window does.
    """
    ms = ts_to_epoch_ms("l_shipdate")
    grouped = lineitem.groupBy("l_returnflag", _chunk("l_orderkey", chunk).alias("_chunk")).agg(
        F.collect_list(_pair(ms, F.col("l_quantity"))).alias("total_volumes"),
        F.max("l_shipdate").alias("_last"),
    )
    return grouped.select(
        _name("market_chart", F.col("l_returnflag"), stamp=_stamp("_last")).alias("file_name"),
        _path("volume", F.col("l_returnflag"), F.col("_chunk")),
        F.to_json(F.struct("total_volumes")).alias("doc"),
    )


def spot_docs_from_events(events: DataFrame, chunk: int = SPOT_CHUNK) -> DataFrame:
    """``simple_price_<stamp>.json``: ``{"<event_id>": <props object>, ...}``.

    The quote objects are the raw ``props`` text, so integral numbers stay
    integral in the document, as the fetcher lands them.
    """
    entry = F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('":'), F.col("props"))
    grouped = events.groupBy(_chunk("event_id", chunk).alias("_chunk")).agg(
        F.concat_ws(",", F.collect_list(entry)).alias("_body"),
        F.max("ts").alias("_last"),
    )
    return grouped.select(
        _name("simple_price", stamp=_stamp("_last")).alias("file_name"),
        _path("spot", F.col("_chunk")),
        F.concat(F.lit("{"), F.col("_body"), F.lit("}")).alias("doc"),
    )


def spot_doc_per_event(events: DataFrame, broken_types: tuple[str, ...] = ()) -> DataFrame:
    """One spot document per event; events of ``broken_types`` land truncated
    (last character cut), as an interrupted download would."""
    props = F.when(
        F.col("event_type").isin(*broken_types) if broken_types else F.lit(False),
        F.expr("substring(props, 1, length(props) - 1)"),
    ).otherwise(F.col("props"))
    return events.select(
        _name("simple_price", stamp=_stamp("ts")).alias("file_name"),
        _path("spot_event", F.col("event_id")),
        F.concat(F.lit('{"'), F.col("event_id").cast("string"), F.lit('":'), props, F.lit("}")).alias("doc"),
    )


def catalog_docs_from_customer(customer: DataFrame, chunk: int = CATALOG_CHUNK) -> DataFrame:
    """``coins_list_<stamp>.json``: root array of ``{id, symbol, name}``."""
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("symbol"),
        F.col("c_name").alias("name"),
    )
    grouped = customer.groupBy(_chunk("c_custkey", chunk).alias("_chunk")).agg(F.collect_list(item).alias("_items"))
    return grouped.select(
        _name("coins_list").alias("file_name"),
        _path("catalog", F.col("_chunk")),
        F.to_json("_items").alias("doc"),
    )


def page_files(pages: DataFrame) -> DataFrame:
    """Raw pages as landed files the router does not know."""
    return pages.select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        _path("page", F.col("page_id")),
        F.col("html").alias("doc"),
    )


def landing_zone(events: DataFrame, customer: DataFrame, pages: DataFrame) -> DataFrame:
    """All emulated landed files of one run: charts, spot, catalog, unknown."""
    return (
        chart_docs_from_events(events)
        .unionByName(spot_docs_from_events(events))
        .unionByName(catalog_docs_from_customer(customer))
        .unionByName(page_files(pages))
    )


#: Folders over which landed files are spread.
LANDED_BUCKETS = 64


def _file_system(path: str) -> tuple[arrow_fs.FileSystem, str] | None:
    """Arrow's file system of an address and the path in it; none if Arrow
    doesn't know such addresses."""
    try:
        return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def _land(files: DataFrame, path: str) -> int:
    """Write each row ``(folder, name, value)`` as a file of its own; how many.

    Rows are dealt out by their place, whatever partitions they come in, and
    every task writes its files one after the other, as a fetcher does.  Spark's
    writers need a record writer, four changes of mode, a check sum file and a
    move in the job's commit per file.  A file appears whole, by a rename,
    under a place of its own: a task that runs again replaces its files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, base), made, n = _file_system(path), set(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                folder, name, value = (column[i] for column in batch.columns)
                place = f"{base}/{folder}"
                if place not in made:
                    fs.create_dir(place, recursive=True)
                    made.add(place)
                draft = f"{place}/.{uuid.uuid4().hex}"  # invisible to readers
                with fs.open_output_stream(draft) as out:
                    if value.is_valid:
                        out.write(value.as_buffer())
                    out.write(b"\n")  # as Spark's text writer ends a record
                fs.move(draft, f"{place}/{name}")
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    dealt = files.select("folder", "name", "value").repartition("folder", "name")
    return dealt.mapInArrow(run, "n long").groupBy().sum("n").first()[0] or 0


def landed_files(spark: SparkSession, name: str, docs: DataFrame, buckets: int = LANDED_BUCKETS) -> str:
    """Directory of newly landed files, one document (column ``value``) per
    file, spread over ``buckets`` sub-directories by a hash of the text."""
    path = scratch_path(spark, f"landed-{name}")
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets))
    if _file_system(path) is None:
        docs.select("value", bucket.alias("bucket")).write.option("maxRecordsPerFile", 1).partitionBy("bucket").text(path)
        return path
    folder = F.concat(F.lit("bucket="), bucket.cast("string"))
    number = F.concat(F.monotonically_increasing_id().cast("string"), F.lit(".txt"))
    if _land(docs.select(folder.alias("folder"), number.alias("name"), "value"), path) == 0:
        docs.select("value").limit(0).write.text(path)  # an empty directory
    return path


#: Name of a landed file by its path (see ``named_files``).
NAME_IN_PATH = r"(?:/file_name=(?=[^/]+/[^/]+$)|/(?=[^/]+~[0-9a-f]{32}\.txt$))(.+?)(?:/[^/]+|~[0-9a-f]{32}\.txt)$"


def named_files(docs: DataFrame, path: str) -> None:
    """Add landed documents to a directory, each a file of its own under its
    name and the hash of its path, since names may repeat.

    In a store that Arrow doesn't know, Spark's writer lands them, which names
    files itself: there each lies in a folder of its name."""
    if _file_system(path) is None:
        files = docs.select("file_name", F.col("doc").alias("value"))
        files.write.option("maxRecordsPerFile", 1).partitionBy("file_name").mode("append").text(path)
        return
    folder = F.concat(F.lit("bucket="), F.pmod(F.xxhash64("file_path"), F.lit(LANDED_BUCKETS)).cast("string"))
    name = F.concat("file_name", F.lit("~"), F.md5(F.col("file_path").cast("binary")), F.lit(".txt"))
    _land(docs.select(folder.alias("folder"), name.alias("name"), F.col("doc").alias("value")), path)


# -- damage -------------------------------------------------------------------------------


def damaged_zone(events: DataFrame, customer: DataFrame, every: dict[str, int] | None = None) -> DataFrame:
    """Chart, spot and catalog documents in which a known share of the parts
    is damaged: every ``every[kind]``-th chart value is a word, spot entry a
    number, catalog element a number."""
    every = every or DAMAGE_EVERY
    hit = {k: F.col("c_custkey" if k == "catalog" else "event_id") % n == 0 for k, n in every.items()}
    ms = F.coalesce(ts_to_epoch_ms("ts").cast("string"), F.lit("null"))
    value = F.when(hit["chart"], F.lit('"x"')).otherwise(F.coalesce(F.col("value").cast("string"), F.lit("null")))
    pair = F.concat(F.lit("["), ms, F.lit(","), value, F.lit("]"))
    charts = events.groupBy("event_type", F.to_date("ts").alias("_day"), _chunk("event_id", CHART_CHUNK).alias("_chunk")).agg(
        F.concat_ws(",", F.collect_list(pair)).alias("_body"), F.max("ts").alias("_last")
    )
    charts = charts.select(
        _name("market_chart", F.col("event_type"), stamp=_stamp("_last")).alias("file_name"),
        _path("chart", F.col("event_type"), F.col("_day"), F.col("_chunk")),
        F.concat(F.lit('{"prices":['), F.col("_body"), F.lit("]}")).alias("doc"),
    )
    spots = spot_docs_from_events(events.withColumn("props", F.when(hit["spot"], F.lit("5")).otherwise(F.col("props"))))
    item = F.to_json(
        F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("symbol"), F.col("c_name").alias("name"))
    )
    items = F.collect_list(F.when(hit["catalog"], F.lit("5")).otherwise(item))
    catalogs = customer.groupBy(_chunk("c_custkey", CATALOG_CHUNK).alias("_chunk")).agg(F.concat_ws(",", items).alias("_body"))
    catalogs = catalogs.select(
        _name("coins_list").alias("file_name"), _path("catalog", F.col("_chunk")),
        F.concat(F.lit("["), F.col("_body"), F.lit("]")).alias("doc"),
    )
    return charts.unionByName(spots).unionByName(catalogs)
