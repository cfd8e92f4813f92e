"""Query catalogue: every operator applied to the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Queries that exercise sinks write to a fresh location under the
shared folder (``spark.checkpoint.dir``) and read the result back.

Timestamps are returned as ``timestamp_ntz`` (wall-clock UTC), the type of
the driver tables' time columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import columns as C
from feedlake.operators import feeds, merge, metrics, quality, report
from feedlake.plans import emulate, ingest_run
from feedlake.schemas import CATALOG_TABLE, QUARANTINE_TABLE, SPOT_LATEST_TABLE, chart_table
from feedlake.session import scratch_path, shared_root, use_utc
from feedlake.sinks import tables as sinks
from feedlake.sources import landing, tables as sources
from feedlake.streaming import ingest as streaming

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Query parameters (chosen for the driver tables; not reference values).
EVENT_TYPE_LABELS = {
    "click": ("Click", "CLK"),
    "error": ("Error", "ERR"),
    "purchase": ("Purchase", "PUR"),
    "signup": ("Sign-up", "SGN"),
    "view": ("View", "VEW"),
}
URL_RULES = (("?", "query"), ("#", "fragment"), ("blog.", "blog"), (".html", "static"))
PRUNE_FROM_DATE = "2024-01-15"
PRUNE_MIN_PRICE = 100.0
THRESHOLD = 50.0
MAX_GAP = 240
CUSTOMER_REQUIRED = ("c_custkey", "c_name", "c_phone", "c_mktsegment")
CUSTOMER_WANTED = ("key", "name", "seg")
ORDER_STATES = ("F", "O", "P")
MERGE_SNAPSHOTS = ((1, 1, 15), (2, 10, 25), (3, 20, 31))  # (snapshot, first day, last day)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir.rstrip("/"))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chart_docs(spark, sf_dir):
    return landing.describe_files(emulate.chart_docs_from_events(table(spark, sf_dir, "events")))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: C.to_ntz(c) for c in cols})


# -- feeds ------------------------------------------------------------------------


@query
def chart_prices(spark, sf_dir):
    """Chart documents -> (coin_id, timestamp, price, date)."""
    pts = feeds.chart_points(_chart_docs(spark, sf_dir), "prices", "price")
    return _ntz(pts.select("coin_id", "timestamp", "price", "date"), "timestamp")


@query
def chart_volumes(spark, sf_dir):
    """Volume-only chart documents (no ``prices`` key) -> volume points."""
    docs = landing.describe_files(emulate.volume_docs_from_lineitem(table(spark, sf_dir, "lineitem")))
    pts = feeds.chart_points(docs, "total_volumes", "volume")
    return _ntz(pts.select("coin_id", "timestamp", "volume", "date"), "timestamp")


@query
def series_stats(spark, sf_dir):
    """Per asset and day: points, first/last time, mean, low, high."""
    pts = feeds.chart_points(_chart_docs(spark, sf_dir), "prices", "price")
    stats = quality.series_stats(pts, ("coin_id", "date"), "timestamp", "price", mean_digits=6)
    return _ntz(stats, "first_ts", "last_ts")


@query
def catalog_project(spark, sf_dir):
    """Root-array catalog documents -> (id, symbol, name)."""
    docs = emulate.catalog_docs_from_customer(table(spark, sf_dir, "customer"))
    return feeds.catalog_rows(docs).select("id", "symbol", "name")


@query
def json_document_scan(spark, sf_dir):
    """Orders written as indented multi-line JSON documents, typed read back."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "json-docs")
    sinks.export_json_documents(
        orders.withColumn("chunk", F.floor(F.col("o_orderkey") / emulate.ORDERS_CHUNK).cast("long")),
        path,
        group_col="chunk",
        id_col="o_orderkey",
        max_items=emulate.ORDERS_CHUNK,
    )
    schema = T.StructType([f for f in orders.schema.fields])
    back = sources.read_json_documents(spark, path, schema, multi_line=True)
    return back.select(*orders.columns)


@query
def landing_scan(spark, sf_dir):
    """Every page landed as its own JSON file; one-pass whole-text scan."""
    pages = table(spark, sf_dir, "pages")
    path = emulate.landed_files(spark, "pages", pages.select(F.to_json(F.struct("page_id", "url", "html")).alias("value")))
    scanned = landing.scan_landing(spark, path, glob="*.txt")
    parsed = F.from_json("doc", "page_id long, url string, html string")
    return scanned.select(
        parsed["page_id"].alias("page_id"),
        parsed["url"].alias("url"),
        F.length(parsed["html"]).cast("long").alias("n_chars"),
    )


@query
def spot_long(spark, sf_dir):
    """Keyed spot documents -> (coin_id, currency, price)."""
    docs = emulate.spot_docs_from_events(table(spark, sf_dir, "events"))
    return feeds.spot_long(docs).select("coin_id", "currency", "price")


@query
def spot_wide(spark, sf_dir):
    """Latest value per user and event type, one column per type."""
    e = table(spark, sf_dir, "events")
    long = e.select(F.col("user_id").alias("coin_id"), F.col("event_type").alias("currency"), F.col("value").alias("price"), "ts", "event_id")
    return feeds.spot_wide(long, order=("ts", "event_id"))


@query
def spot_usd(spark, sf_dir):
    """Assets carrying a quote in one currency (the driver data quotes ``k``)."""
    docs = emulate.spot_docs_from_events(table(spark, sf_dir, "events"))
    return feeds.spot_quote(docs, "k").select("coin_id", "k")


@query
def cast_measures(spark, sf_dir):
    """All lineitem columns but the keys -> double (try_cast)."""
    return feeds.cast_measures(table(spark, sf_dir, "lineitem"), keep=("l_orderkey", "l_linenumber"))


# -- routing and names ------------------------------------------------------------------


@query
def feed_routing(spark, sf_dir):
    """First-match substring dispatch over page URLs."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", C.route_by_name("url", URL_RULES).alias("kind"))


@query
def shape_routing(spark, sf_dir):
    """Documents of every feed (and foreign ones) classified by shape."""
    e = table(spark, sf_dir, "events")
    docs = (
        emulate.landing_zone(e, table(spark, sf_dir, "customer"), table(spark, sf_dir, "pages"))
        .select("doc")
        .unionByName(e.select(F.col("props").alias("doc")))
    )
    return landing.describe_shapes(docs).groupBy("shape").agg(F.count(F.lit(1)).alias("n_docs"))


@query
def name_field(spark, sf_dir):
    """Host, 4th '/' field and file stem of each page URL."""
    pages = table(spark, sf_dir, "pages")
    path_only = F.regexp_extract("url", r"^[^?#]*", 0)
    return pages.select(
        "page_id",
        F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"),
        C.name_field("url", "/", 4).alias("section"),
        C.file_stem(path_only).alias("leaf"),
    )


# -- snapshots and merge ------------------------------------------------------------------------


@query
def latest_snapshot(spark, sf_dir):
    """Newest event per user (time, then id breaks ties)."""
    e = table(spark, sf_dir, "events")
    return merge.latest_per_key(e, ["user_id"], ["ts", "event_id"])


@query
def chart_merge(spark, sf_dir):
    """Three overlapping chart snapshots; the latest snapshot wins per point."""
    e = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    taken = F.array(
        *[
            F.when(
                day.between(first, last),
                F.struct(F.lit(f"2025-01-0{snap}").cast("timestamp").alias("at"), (F.col("value") + F.lit(float(snap))).alias("value")),
            )
            for snap, first, last in MERGE_SNAPSHOTS
        ]
    )
    seen = e.select("event_id", "event_type", "user_id", "ts", F.explode(F.array_compact(taken)).alias("_s"))
    docs = emulate.chart_docs_from_events(
        seen.select("event_id", "event_type", "user_id", "ts", "_s.value", "_s.at"), snapshot_col="at"
    )
    pts = feeds.chart_points(landing.describe_files(docs), "prices", "price")
    merged = merge.merge_chart_snapshots(pts, "price")
    return _ntz(merged.select("coin_id", "timestamp", "price"), "timestamp")


# -- tables -----------------------------------------------------------------------------------------


def _write_chart_table(spark, sf_dir, refresh="full"):
    pts = feeds.chart_points(_chart_docs(spark, sf_dir), "prices", "price")
    path = scratch_path(spark, "chart-prices")
    n = sinks.write_table(
        pts.select("coin_id", "timestamp", "price", "date"),
        path,
        partition_by=("coin_id", "date"),
        sort_by=("timestamp",),
        refresh=refresh,
    )
    return path, n


CHART_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("coin_id", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)


@query
def table_roundtrip(spark, sf_dir):
    """Supplier written, overwritten with new content, read back."""
    s = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier")
    sinks.write_table(s.withColumn("s_acctbal", F.lit(0.0)), path)
    sinks.write_table(s, path)
    return sources.read_table(spark, path).select(*s.columns)


@query
def partitioned_overwrite(spark, sf_dir):
    """Chart points written partitioned by (coin_id, date); counts read back."""
    path, _ = _write_chart_table(spark, sf_dir)
    back = sources.read_table(spark, path, schema=CHART_TABLE_SCHEMA)
    return back.groupBy("coin_id", "date").agg(
        F.count(F.lit(1)).alias("n_points"), F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )


@query
def partition_refresh(spark, sf_dir):
    """Touched-partition refresh: the first day is rewritten with price 0."""
    path, _ = _write_chart_table(spark, sf_dir)
    written = sources.read_table(spark, path, schema=CHART_TABLE_SCHEMA)
    first_day = written.agg(F.min("date")).first()[0]  # from the partition values
    # the partitions about to be replaced are read into a checkpoint first
    shared_root(spark)
    fresh = written.filter(F.col("date") == F.lit(first_day)).withColumn("price", F.lit(0.0)).checkpoint(eager=True)
    sinks.write_table(
        fresh.select("coin_id", "timestamp", "price", "date"),
        path,
        partition_by=("coin_id", "date"),
        sort_by=("timestamp",),
        refresh="touched",
    )
    back = sources.read_table(spark, path, schema=CHART_TABLE_SCHEMA)
    return back.groupBy("coin_id", "date").agg(
        F.count(F.lit(1)).alias("n_points"), F.max("price").alias("max_price")
    )


def _attempt(write: Callable[[], object]) -> None:
    """Run a write that must fail on the rows marked lost."""
    try:
        write()
    except PySparkException as error:
        if "row lost" not in str(error):
            raise
    else:
        raise AssertionError("the write did not fail")


@query
def failed_overwrite_kept(spark, sf_dir):
    """Orders in four tables; a full overwrite, a full and a touched refresh
    of partitions and a merge that each fail half way; every row is still there."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lost = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("row lost")).cast("double"))
    bad = o.withColumn("o_totalprice", lost.otherwise(F.lit(0.0)))
    schema = T.StructType([o.schema["o_orderkey"], o.schema["o_totalprice"], o.schema["o_orderstatus"]])
    by = ("o_orderstatus",)

    def merge_in(rows: DataFrame, path: str) -> None:
        sinks.merge_into_table(
            spark, rows, path, schema, ["o_orderkey"], ["o_totalprice"], partition_by=by, date_col="o_orderstatus"
        )

    writes = {
        "full": lambda rows, path: sinks.write_table(rows, path),
        "partitioned": lambda rows, path: sinks.write_table(rows, path, partition_by=by),
        "touched": lambda rows, path: sinks.write_table(rows, path, partition_by=by, refresh="touched"),
        "merge": merge_in,
    }
    parts = []
    for form, write in writes.items():
        path = scratch_path(spark, f"kept-{form}")
        write(o, path)
        _attempt(lambda: write(bad, path))
        parts.append(sources.read_table(spark, path, schema=schema).withColumn("form", F.lit(form)))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.select("form", "o_orderkey", "o_orderstatus", "o_totalprice")


@query
def discovered_tables(spark, sf_dir):
    """Tables found under a root, with their rows."""
    root = scratch_path(spark, "tables")
    for name in ("nation", "supplier", "orders"):
        sinks.write_table(table(spark, sf_dir, name), f"{root}/{name}")
    return sources.table_inventory(sources.discover_tables(spark, root))


@query
def nested_tables(spark, sf_dir):
    """Tables at several depths under a root that also holds folders of raw
    files and an empty one, with their rows."""
    root = scratch_path(spark, "nested")
    chart = feeds.chart_points(_chart_docs(spark, sf_dir), "prices", "price")
    sinks.write_table(
        chart.select("coin_id", "timestamp", "price", "date"), f"{root}/market/charts/all/prices", partition_by=("date",)
    )
    sinks.write_table(table(spark, sf_dir, "supplier"), f"{root}/market/parties")
    sinks.write_table(table(spark, sf_dir, "nation"), f"{root}/nation")
    # as a fetcher lands them: raw files, no job's marker
    raw = table(spark, sf_dir, "region").select(F.to_json(F.struct("*")).alias("value"))
    raw.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(f"{root}/market/raw")
    return sources.table_inventory(sources.discover_tables(spark, root))


@query
def partition_pruned_read(spark, sf_dir):
    """Date filter answered by partition pruning, price filter pushed down."""
    path, _ = _write_chart_table(spark, sf_dir)
    back = sources.read_table(spark, path, schema=CHART_TABLE_SCHEMA)
    hit = back.filter((F.col("date") >= F.lit(PRUNE_FROM_DATE).cast("date")) & (F.col("price") > PRUNE_MIN_PRICE))
    return _ntz(hit.select("coin_id", "timestamp", "price", "date"), "timestamp")


@query
def partition_listing(spark, sf_dir):
    """Distinct partitions of the chart table, sorted."""
    path, _ = _write_chart_table(spark, sf_dir)
    back = sources.read_table(spark, path, schema=CHART_TABLE_SCHEMA)
    return quality.partition_listing(back, ["coin_id", "date"])


@query
def write_verify(spark, sf_dir):
    """Rows written (observed during the write) against rows read back."""
    results = []
    path, n = _write_chart_table(spark, sf_dir)
    results.append(("chart_prices", n, path))
    spot = feeds.spot_long(emulate.spot_docs_from_events(table(spark, sf_dir, "events")))
    spath = scratch_path(spark, "spot")
    results.append(("spot", sinks.write_table(spot, spath), spath))
    cat = feeds.catalog_rows(emulate.catalog_docs_from_customer(table(spark, sf_dir, "customer")))
    cpath = scratch_path(spark, "catalog")
    results.append(("catalog", sinks.write_table(cat.withColumn("ingestion_timestamp", F.current_timestamp()), cpath), cpath))
    parts = [
        sources.read_table(spark, p).agg(F.count(F.lit(1)).alias("rows_read")).select(
            F.lit(name).alias("table_name"), F.lit(written).cast("long").alias("rows_written"), "rows_read"
        )
        for name, written, p in results
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def csv_export(spark, sf_dir):
    """Documents (line breaks, quotes, blanks) exported as CSV with a header
    and read back typed."""
    d = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "csv")
    sinks.export_csv(d, path)
    return sources.read_csv(spark, path, d.schema)


@query
def json_export(spark, sf_dir):
    """Part exported as JSON lines and read back typed."""
    p = table(spark, sf_dir, "part")
    path = scratch_path(spark, "json")
    sinks.export_json(p, path)
    return sources.read_json_documents(spark, path, p.schema, multi_line=False)


@query
def preview_rows(spark, sf_dir):
    """First five orders by key."""
    return quality.preview_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


@query
def schema_profile(spark, sf_dir):
    """(position, column, type, non-null count) of orders."""
    return quality.schema_profile(table(spark, sf_dir, "orders"))


@query
def table_inventory(spark, sf_dir):
    """Row count of every driver table."""
    return sources.table_inventory({t: table(spark, sf_dir, t) for t in TABLES})


# -- quality ------------------------------------------------------------------------------------------


@query
def distinct_keys(spark, sf_dir):
    """Distinct values of the first key column found (id, coin_id, user_id)."""
    return quality.distinct_keys(table(spark, sf_dir, "events"), ("id", "coin_id", "user_id"))


@query
def distinct_time_values(spark, sf_dir):
    """First ten distinct values of each time-like column of orders."""
    return quality.distinct_time_values(table(spark, sf_dir, "orders"), 10)


@query
def null_counts(spark, sf_dir):
    """Nulls per column of documents left-joined with their labels."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    # only nullness is measured: the join never has to move the texts
    docs = quality.nullness_only(docs, [c for c in docs.columns if c != "doc_id"])
    return quality.null_counts(docs.join(labels, "doc_id", "left"))


@query
def required_columns(spark, sf_dir):
    """Required customer columns: present, and how many non-null values."""
    return quality.required_columns(table(spark, sf_dir, "customer"), CUSTOMER_REQUIRED)


@query
def similar_columns(spark, sf_dir):
    """Customer columns containing each wanted name, with fill counts."""
    return quality.similar_columns(table(spark, sf_dir, "customer"), CUSTOMER_WANTED)


@query
def date_time_split(spark, sf_dir):
    """Date and time-of-day text of each event."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.to_date("ts").alias("date"), C.time_of_day("ts").alias("time_of_day"))


@query
def epoch_seconds(spark, sf_dir):
    """Epoch seconds of each event and the timestamp they give back."""
    e = table(spark, sf_dir, "events")
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.select("event_id", secs.alias("epoch_s"), C.to_ntz(C.epoch_s_to_ts(secs)).alias("ts_s"))


@query
def ingest_stamp(spark, sf_dir):
    """Catalog rows stamped at ingestion: one stamp value per query."""
    cat = feeds.catalog_rows(emulate.catalog_docs_from_customer(table(spark, sf_dir, "customer")))
    stamped = cat.withColumn("ingestion_timestamp", F.current_timestamp())
    return stamped.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ingestion_timestamp").alias("n_stamps")
    )


@query
def json_shape_profile(spark, sf_dir):
    """Number and list of top-level keys of each event's props document."""
    return quality.json_shape_profile(table(spark, sf_dir, "events"), "props", ["event_id"])


@query
def json_type_profile(spark, sf_dir):
    """JSON type of each props key, counted per event type."""
    return quality.json_type_profile(table(spark, sf_dir, "events"), "props", ["event_type"])


@query
def text_shape_profile(spark, sf_dir):
    """Bytes, lines, single-line flag and first 200 characters of documents."""
    return quality.text_shape_profile(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query
def price_label(spark, sf_dir):
    """Order totals as money text."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.money("o_totalprice").alias("label"))


@query
def asset_labels(spark, sf_dir):
    """Fixed display label and code per event type, with event counts."""
    e = table(spark, sf_dir, "events")
    counts = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.select(
        "event_type",
        C.asset_label("event_type", EVENT_TYPE_LABELS).alias("label"),
        C.asset_code("event_type", EVENT_TYPE_LABELS).alias("code"),
        "n_events",
    )


# -- run states and metrics ---------------------------------------------------------------------------


def _order_log(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.nullif("o_orderstatus", F.lit("P")).alias("state"))


@query
def state_counts(spark, sf_dir):
    """Runs per state; the null state is a group counted 0."""
    return metrics.state_counts(_order_log(spark, sf_dir))


@query
def state_counts_filled(spark, sf_dir):
    """State counts with 0 for known states never seen."""
    return metrics.state_counts_filled(_order_log(spark, sf_dir), ORDER_STATES)


@query
def metric_lines(spark, sf_dir):
    """Exposition lines of the state counts."""
    return metrics.metric_lines(metrics.state_counts(_order_log(spark, sf_dir)))


@query
def metric_exposition(spark, sf_dir):
    """Help, type and sample lines of the run metric, and of the task metric
    whose log is empty (known states at 0)."""
    runs = metrics.state_counts(_order_log(spark, sf_dir))
    no_tasks = _order_log(spark, sf_dir).filter(F.col("run_id").isNull())
    tasks = metrics.state_counts_filled(no_tasks, metrics.TASK_STATES, only_if_empty=True)
    return metrics.exposition(
        [(metrics.RUN_METRIC, "Number of runs by state", runs), (metrics.TASK_METRIC, "Number of tasks by state", tasks)]
    )


def _samples(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "ts", "value")


@query
def counter_rate(spark, sf_dir):
    """Per-second increase of each event type's counter per 5 minutes.  The
    event id rises within a type, and restarts from 0 every 1000 ids."""
    e = _samples(spark, sf_dir).withColumn("counter", (F.col("event_id") % 1000).cast("double"))
    r = metrics.counter_rate(e, ["event_type"], "ts", "counter", tie="event_id")
    return r.withColumn("rate", F.round("rate", 6))


@query
def sliding_rate(spark, sf_dir):
    """Rate of each event type's counter over the five minutes that end at
    every minute."""
    e = _samples(spark, sf_dir).withColumn("counter", (F.col("event_id") % 1000).cast("double"))
    r = metrics.sliding_rate(e, ["event_type"], "ts", "counter", "5 minutes", "1 minute", tie="event_id")
    return r.withColumn("rate", F.round("rate", 6))


@query
def instant_values(spark, sf_dir):
    """Value of each event type at every 30-second step, up to 5 minutes old."""
    return metrics.instant_values(_samples(spark, sf_dir), ["event_type"], "ts", "value", "30 seconds", "5 minutes", tie="event_id")


@query
def alert_changes(spark, sf_dir):
    """Pending, firing and inactive per event type: value above the threshold
    for two minutes, evaluated every 30 seconds, samples up to 2 minutes old."""
    return metrics.alert_changes(
        _samples(spark, sf_dir), ["event_type"], THRESHOLD, "2 minutes", "ts", "value", "30 seconds", "2 minutes", tie="event_id"
    )


@query
def label_select(spark, sf_dir):
    """Samples selected by label ``type = click``."""
    e = _samples(spark, sf_dir).withColumn(
        "labels", F.create_map(F.lit("type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    )
    return metrics.label_select(e, {"type": "click"}).select("event_id", "ts", "value")


@query
def sustained_threshold(spark, sf_dir):
    """Runs of values above the threshold lasting at least five minutes."""
    return metrics.sustained_threshold(
        _samples(spark, sf_dir), ["event_type"], THRESHOLD, 300, "ts", "value", tie="event_id"
    )


@query
def sustained_threshold_gap(spark, sf_dir):
    """The same with a gap limit, over a series without a label that holds a
    third of all samples and more."""
    e = _samples(spark, sf_dir).withColumn("label", F.when(~F.col("event_type").isin("click", "view"), F.col("event_type")))
    return metrics.sustained_threshold(
        e, ["label"], THRESHOLD, 300, "ts", "value", tie="event_id", max_gap_seconds=MAX_GAP
    )


@query
def sample_grid(spark, sf_dir):
    """Last sample of each event type per 30-second slot."""
    return metrics.sample_grid(_samples(spark, sf_dir), ["event_type"], "ts", "value", "30 seconds", tie="event_id")


# -- quarantine and report --------------------------------------------------------------------------------


@query
def quarantine(spark, sf_dir):
    """Per-event spot documents, error events landed truncated: ok vs reason."""
    docs = emulate.spot_doc_per_event(table(spark, sf_dir, "events"), broken_types=("error",))
    routed = feeds.parse_documents(landing.describe_files(docs))
    first_reason = F.try_element_at(feeds.problem_reasons(routed), F.lit(1))
    return routed.groupBy(F.coalesce(first_reason, F.lit("ok")).alias("status")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )


@query
def run_report(spark, sf_dir):
    """Files, rows and quarantined files per routed feed of one landing run."""
    zone = emulate.landing_zone(
        table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "pages")
    )
    return report.run_report(landing.describe_files(zone))


@query
def feed_damage(spark, sf_dir):
    """Documents with a known share of damaged parts: kept rows and problems
    per feed (the names of assets cut from the reasons)."""
    zone = emulate.damaged_zone(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))
    routed = feeds.parse_documents(landing.describe_files(zone))
    rows = report.run_report(routed).select("kind", F.lit("rows").alias("what"), F.col("n_rows").alias("n"))
    what = F.regexp_replace("reason", r"(quotes? \w+).*", "$1")
    problems = feeds.quarantine(routed).groupBy("kind", what.alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(problems)


@query
def latest_landed_file(spark, sf_dir):
    """Newest landed file per feed."""
    zone = emulate.landing_zone(
        table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "pages")
    )
    return landing.latest_files(landing.describe_files(zone)).select("kind", "file_name")


@query
def newest_landed_file(spark, sf_dir):
    """Newest file per feed of a directory of landed files, found by name
    without opening the others, and its rows."""
    landed = scratch_path(spark, "landed-names")
    emulate.named_files(emulate.spot_docs_from_events(table(spark, sf_dir, "events")), landed)
    # catalogs a second apart, by their number
    catalogs = emulate.catalog_docs_from_customer(table(spark, sf_dir, "customer"))
    taken = F.timestamp_seconds(F.lit(1735689600) + F.regexp_extract("file_path", "[0-9]+$", 0).cast("long"))
    name = F.concat(F.lit("coins_list_"), F.date_format(taken, C.SNAPSHOT_FORMAT), F.lit(".json"))
    emulate.named_files(catalogs.withColumn("file_name", name), landed)
    newest = landing.read_newest(spark, landed, glob="*.txt", recursive=True, name_pattern=emulate.NAME_IN_PATH)
    parsed = feeds.parse_documents(newest)
    return parsed.select("kind", "file_name", feeds.typed_row_count(parsed).alias("n_rows"))


def _contents(spark, root, names):
    """Rows of the ingest tables as (table_name, coin_id, item, value)."""
    micros = F.unix_micros("timestamp").cast("string")
    layout = {
        "chart_prices": (chart_table("price"), "coin_id", micros, F.col("price")),
        "chart_volumes": (chart_table("volume"), "coin_id", micros, F.col("volume")),
        "spot": (SPOT_LATEST_TABLE, "coin_id", F.col("currency"), F.col("price")),
        "spot_latest": (SPOT_LATEST_TABLE, "coin_id", F.col("currency"), F.col("price")),
        "catalog": (CATALOG_TABLE, "id", F.col("symbol"), F.lit(None).cast("double")),
        "quarantine": (QUARANTINE_TABLE, "file_name", F.col("reason"), F.col("problem_no").cast("double")),
    }
    parts = []
    for name in names:
        schema, coin, item, value = layout[name]
        rows = sources.read_table(spark, f"{root}/{name}", schema=schema)
        parts.append(rows.select(F.lit(name).alias("table_name"), F.col(coin).alias("coin_id"), item.alias("item"), value.alias("value")))
    return reduce(DataFrame.unionByName, parts)


@query
def ingest_two_runs(spark, sf_dir):
    """Landed documents ingested in two runs; the second no longer sees the
    first run's files.  The tables' rows equal those of one run."""
    zone = landing.describe_files(
        emulate.landing_zone(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "pages"))
    )
    root = scratch_path(spark, "two-runs")
    later = F.pmod(F.xxhash64("file_path"), F.lit(2)) == 1
    for part in (zone.filter(~later), zone.filter(later)):
        ingest_run.ingest_documents(spark, part, root)
    return _contents(spark, root, ("chart_prices", "chart_volumes", "spot", "spot_latest", "quarantine"))


@query
def quarantine_history(spark, sf_dir):
    """Damaged documents ingested twice over, in two parts: the quarantine
    holds each problem once, and its files are those of the first time."""
    zone = landing.describe_files(emulate.damaged_zone(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")))
    routed = feeds.parse_documents(zone).persist()
    path = f"{scratch_path(spark, 'history')}/quarantine"
    later = F.pmod(F.xxhash64("file_path"), F.lit(2)) == 1
    try:
        for part in (routed.filter(~later), routed, routed):
            ingest_run.store_quarantine(spark, feeds.quarantine(part), path, "merge")
    finally:
        routed.unpersist()
    kept = sources.read_table(spark, path, schema=QUARANTINE_TABLE)
    what = F.regexp_replace("reason", r"(quotes? \w+).*", "$1")
    return kept.groupBy("kind", what.alias("what")).agg(F.count(F.lit(1)).alias("n"))


# -- streaming -----------------------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf_dir):
    """Available-now file stream of events into a table; counts per type."""
    schema = table(spark, sf_dir, "events").schema
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    stream = streaming.file_stream(spark, sf_dir, schema, glob="events.parquet")
    streaming.run_available_now(stream, sink, ckpt)
    return spark.read.schema(schema).parquet(sink).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))


@query
def landed_file_stream(spark, sf_dir):
    """Landed spot files streamed as whole texts, several files a trigger, in
    two runs between which the second half of the files lands."""
    docs = emulate.spot_docs_from_events(table(spark, sf_dir, "events"))
    landed, sink, ckpt = (scratch_path(spark, f"landed-stream-{n}") for n in ("files", "sink", "ckpt"))

    def write(batch, key):
        streaming.write_batch(feeds.spot_long(batch.filter(F.col("kind") == "spot")), sink, key)

    later = F.pmod(F.xxhash64("file_path"), F.lit(2)) == 1
    for part in (docs.filter(~later), docs.filter(later)):
        emulate.named_files(part, landed)
        stream = streaming.landing_stream(
            spark, landed, "*.txt", max_files_per_trigger=128, recursive=True, name_pattern=emulate.NAME_IN_PATH
        )
        streaming.run_batches(stream, ckpt, write)
    return sources.read_table(spark, sink, schema=SPOT_LATEST_TABLE).select("coin_id", "currency", "price")


@query
def landing_batches(spark, sf_dir):
    """Landed documents through the streaming ingest; every micro-batch runs
    twice, as after a failure.  The tables' rows are those of one run."""
    zone = emulate.landing_zone(
        table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "pages")
    )
    landed, root = scratch_path(spark, "landed-documents"), scratch_path(spark, "stream-tables")
    zone.write.parquet(landed)
    stream = landing.describe_files(streaming.file_stream(spark, landed, zone.schema, max_files_per_trigger=4))

    def twice(batch, key):
        for _ in range(2):
            streaming.ingest_landing_batch(batch, root, key)

    streaming.run_batches(stream, scratch_path(spark, "stream-ckpt"), twice)
    return _contents(spark, root, ("chart_prices", "chart_volumes", "spot", "catalog", "quarantine"))


@query
def stream_dedup(spark, sf_dir):
    """Events land, then land again, in several files; over two runs of the
    stream each event is kept once."""
    e = table(spark, sf_dir, "events")
    landed, sink, ckpt = (scratch_path(spark, f"dedup-{n}") for n in ("files", "sink", "ckpt"))
    for salt in (0, 1):
        e.repartition(4, F.xxhash64("event_id", F.lit(salt))).write.mode("append").parquet(landed)
        stream = streaming.file_stream(spark, landed, e.schema, max_files_per_trigger=3)
        streaming.run_dedup(stream, sink, ckpt, ["event_id"], "ts")
    return sources.read_table(spark, sink, schema=e.schema).select(*e.columns)
