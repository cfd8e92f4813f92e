"""Landing scan, routing, snapshot merge and the batch ingest job."""

import datetime as dt
import json
import os

import pytest

from conftest import write_landing
from feedlake.functions.columns import route_by_name, shape_kind
from feedlake.operators import feeds, merge
from feedlake.plans.ingest_run import run_ingest
from feedlake.sources.landing import describe_files, scan_landing


def chart(points, volumes=None):
    doc = {"prices": points}
    if volumes is not None:
        doc["total_volumes"] = volumes
    return json.dumps(doc)


def test_feed_routing_first_match(spark):  # P9
    names = ["simple_price_1.json", "coins_list_simple_price.json", "market_chart_x_1.json", "other.json"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    kinds = [r.k for r in df.select(route_by_name("n").alias("k")).collect()]
    assert kinds == ["spot", "spot", "chart", "unrecognised"]


def test_shape_routing(spark):  # P10
    docs = [
        '{"bitcoin":{"usd":1},"ethereum":{"usd":2}}',
        '{"prices":[],"total_volumes":[]}',
        '[{"id":"a","symbol":"a","name":"A"}]',
        '{"k": 1}',
        "<html>",
    ]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert [r.s for r in df.select(shape_kind("d").alias("s")).collect()] == [
        "spot", "chart", "catalog", "unrecognised", "invalid",
    ]


def test_landing_scan_one_row_per_file(spark, tmp_path):  # S1, S7
    d = write_landing(
        tmp_path / "raw",
        {
            "simple_price_20250722_192230.json": '{"bitcoin":{"usd":119800}}',
            "coins_list_20250722_192230.json": '[\n {"id":"a","symbol":"a","name":"A"}\n]\n',
            "notes.txt": "ignored",
        },
    )
    os.makedirs(tmp_path / "raw" / "sub")
    write_landing(tmp_path / "raw" / "sub", {"simple_price_20250101_000000.json": "{}"})
    rows = describe_files(scan_landing(spark, d)).orderBy("file_name").collect()
    assert [(r.file_name, r.kind) for r in rows] == [
        ("coins_list_20250722_192230.json", "catalog"),
        ("simple_price_20250722_192230.json", "spot"),
    ]
    assert rows[0].doc.count("\n") == 3 and rows[0].file_size == len(rows[0].doc)


def test_latest_snapshot_independent_of_order(spark):  # Q1, S6, O4
    a = ("market_chart_btc_20250722_000000.json", chart([[1000, 1], [2000, 2]]))
    b = ("market_chart_btc_20250723_000000.json", chart([[2000, 20], [3000, 30]]))
    results = []
    for pair in ([a, b], [b, a]):
        d = describe_files(spark.createDataFrame(pair, "file_name string, doc string"))
        m = merge.merge_chart_snapshots(feeds.chart_points(d))
        results.append(sorted((r.timestamp, r.price) for r in m.collect()))
    assert results[0] == results[1]
    assert [p for _, p in results[0]] == [1.0, 20.0, 30.0]


def test_identical_snapshots_collapse(spark):  # Q15
    doc = '{"bitcoin":{"usd":119529}}'
    d = describe_files(
        spark.createDataFrame(
            [("simple_price_20250723_020443.json", doc), ("simple_price_20250723_020444.json", doc)],
            "file_name string, doc string",
        )
    )
    spot = feeds.spot_long(d)
    assert spot.count() == 2
    latest = merge.latest_per_key(spot, ["coin_id", "currency"], ["snapshot_ts"]).collect()
    assert len(latest) == 1 and latest[0].snapshot_ts == dt.datetime(2025, 7, 23, 2, 4, 44)


def test_run_ingest_end_to_end_and_file_order(spark, tmp_path):  # R3, R4, Q1
    files = {
        "simple_price_20250722_192230.json": '{"bitcoin":{"usd":119800},"ethereum":{"usd":3715.55}}',
        "simple_price_20250722_192231.json": '{"bitcoin":{"usd":"bad"}}',
        "coins_list_20250722_192230.json": '[{"id":"bitcoin","symbol":"btc","name":"Bitcoin"}]',
        "market_chart_bitcoin_20250722_100000.json": chart([[1753142400000, 1], [1753146000000, 2]], [[1753142400000, 9]]),
        "market_chart_bitcoin_20250723_100000.json": chart([[1753146000000, 3], [1753232400000, 4]]),
        "market_chart_ethereum_20250723_100000.json": '{"prices":[[1753142400000,',
        "readme.json": "{}",
    }
    d = write_landing(tmp_path / "raw", files)
    report = {r.kind: r for r in run_ingest(spark, d, str(tmp_path / "tables")).collect()}
    assert (report["chart"].n_files, report["chart"].n_bad, report["chart"].status) == (3, 1, "partial")
    assert (report["spot"].n_rows, report["spot"].n_bad) == (2, 1)
    assert report["unrecognised"].n_files == 1
    prices = spark.read.parquet(str(tmp_path / "tables" / "chart_prices"))
    assert sorted((r.price, str(r.date)) for r in prices.collect()) == [
        (1.0, "2025-07-22"), (3.0, "2025-07-22"), (4.0, "2025-07-23"),
    ]
    assert spark.read.parquet(str(tmp_path / "tables" / "quarantine")).count() == 2
    assert spark.read.parquet(str(tmp_path / "tables" / "chart_volumes")).count() == 1


def test_empty_landing_gives_typed_empty_tables(spark, tmp_path):  # S10, P16
    d = str(tmp_path / "empty")
    os.makedirs(d)
    write_landing(tmp_path / "empty", {"readme.txt": "not landed"})
    report = run_ingest(spark, d, str(tmp_path / "tables")).collect()
    assert report == []
    from feedlake.schemas import chart_table

    prices = spark.read.schema(chart_table("price")).parquet(str(tmp_path / "tables" / "chart_prices"))
    assert prices.count() == 0 and dict(prices.dtypes)["price"] == "double"
    from feedlake.schemas import SPOT_TABLE

    assert spark.read.schema(SPOT_TABLE).parquet(str(tmp_path / "tables" / "spot")).count() == 0
    assert spark.read.parquet(str(tmp_path / "tables" / "spot_latest")).columns[:4] == ["coin_id", "currency", "price", "quote_ts"]


def test_latest_files_per_feed(spark, tmp_path):  # S6
    d = write_landing(
        tmp_path / "raw",
        {
            "coins_list_20250722_000000.json": "[]",
            "coins_list_20250723_000000.json": "[]",
            "simple_price_20250701_000000.json": "{}",
        },
    )
    from feedlake.sources.landing import latest_files

    got = {r.kind: r.file_name for r in latest_files(describe_files(scan_landing(spark, d))).collect()}
    assert got == {"catalog": "coins_list_20250723_000000.json", "spot": "simple_price_20250701_000000.json"}


def test_stream_ingest_job_twice_equals_once(spark, tmp_path):  # R1
    from feedlake.streaming.ingest import run_ingest_stream

    d = write_landing(tmp_path / "raw", {"market_chart_btc_20250722_000000.json": chart([[1000, 1], [2000, 2]])})
    root = str(tmp_path / "tables")
    run_ingest_stream(spark, d, root)
    run_ingest_stream(spark, d, root)
    assert spark.read.parquet(f"{root}/chart_prices").count() == 2


def test_inspect_table(spark, tmp_path):  # Entry C
    from feedlake.plans.inspect_table import inspect

    path = str(tmp_path / "t")
    spark.createDataFrame([("a", dt.date(2025, 1, 1), None)], "coin_id string, date date, v double").write.parquet(path)
    out = inspect(spark, path, partitions=["date"])
    assert {r.column_name: r.nulls for r in out["nulls"].collect()}["v"] == 1
    assert [r.value for r in out["time_values"].collect()] == ["2025-01-01"]


def test_discover_tables_and_inventory(spark, tmp_path):  # S11, A1
    from feedlake.sources.tables import discover_tables, table_inventory

    d = write_landing(
        tmp_path / "raw",
        {
            "simple_price_20250722_192230.json": '{"bitcoin":{"usd":119800},"ethereum":{"usd":3715.55}}',
            "market_chart_bitcoin_20250722_100000.json": chart([[1753142400000, 1]], [[1753142400000, 9]]),
        },
    )
    root = str(tmp_path / "tables")
    run_ingest(spark, d, root)
    tables = discover_tables(spark, root)
    assert set(tables) >= {"chart_prices", "chart_volumes", "spot", "spot_latest", "quarantine"}
    counts = {r.table_name: r.n_rows for r in table_inventory(tables).collect()}
    assert counts["spot"] == 2 and counts["chart_prices"] == 1 and counts["quarantine"] == 0


def test_run_ingest_wide_spot_and_catalog_stamp(spark, tmp_path):  # P8, F8
    d = write_landing(
        tmp_path / "raw",
        {
            "simple_price_20250722_192230.json": '{"bitcoin":{"usd":1,"eur":2},"ethereum":{"usd":3}}',
            "simple_price_20250722_192231.json": '{"bitcoin":{"usd":10}}',
            "coins_list_20250722_192230.json": '[{"id":"bitcoin","symbol":"btc","name":"Bitcoin"}]',
        },
    )
    root = str(tmp_path / "tables")
    run_ingest(spark, d, root)
    wide = {r.coin_id: (r.usd, r.eur) for r in spark.read.parquet(f"{root}/spot_wide").collect()}
    assert wide == {"bitcoin": (10.0, 2.0), "ethereum": (3.0, None)}
    cat = spark.read.parquet(f"{root}/catalog").collect()
    assert len(cat) == 1 and cat[0].ingestion_timestamp is not None


def test_batch_equals_stream(spark, tmp_path):  # SURVEY §5 (d)
    from feedlake.streaming.ingest import latest_chart, run_ingest_stream

    files = {
        "market_chart_btc_20250722_000000.json": chart([[1000, 1], [2000, 2]], [[1000, 5]]),
        "market_chart_btc_20250723_000000.json": chart([[2000, 20], [3000, 30]], [[1000, 6]]),
        "market_chart_eth_20250723_000000.json": chart([[1000, 7]]),
        "simple_price_20250722_000000.json": '{"btc":{"usd":3,"eur":"x"}}',
    }
    d = write_landing(tmp_path / "raw", files)
    batch_root, stream_root = str(tmp_path / "b"), str(tmp_path / "s")
    run_ingest(spark, d, batch_root)
    run_ingest_stream(spark, d, stream_root)
    for value, table in (("price", "chart_prices"), ("volume", "chart_volumes")):
        b = sorted((r.coin_id, r.timestamp, r[value]) for r in spark.read.parquet(f"{batch_root}/{table}").collect())
        s = sorted((r.coin_id, r.timestamp, r[value]) for r in latest_chart(spark, stream_root, value).collect())
        assert b == s and b
    for table in ("spot", "quarantine"):
        cols = ["coin_id", "currency", "price"] if table == "spot" else ["file_name", "reason"]
        b = sorted(tuple(r) for r in spark.read.parquet(f"{batch_root}/{table}").select(*cols).collect())
        s = sorted(tuple(r) for r in spark.read.parquet(f"{stream_root}/{table}").select(*cols).collect())
        assert b == s and b


def test_spot_files_of_a_landing_zone(spark, tmp_path):  # Q1, Q2, Q15 on 33 spot documents, two assets each
    files = {
        f"simple_price_20250722_{10 + i // 60:02d}{i % 60:02d}00.json": json.dumps(
            {"bitcoin": {"usd": 119000 + i}, "ethereum": {"usd": 3700.25 + i}}
        )
        for i in range(33)
    }
    root = str(tmp_path / "tables")
    report = {r.kind: r for r in run_ingest(spark, write_landing(tmp_path / "raw", files), root).collect()}
    assert (report["spot"].n_files, report["spot"].n_rows, report["spot"].n_bad) == (33, 66, 0)
    latest = {r.coin_id: r.price for r in spark.read.parquet(f"{root}/spot_latest").collect()}
    assert latest == {"bitcoin": 119032.0, "ethereum": 3732.25}
    assert {r.coin_id: r.usd for r in spark.read.parquet(f"{root}/spot_wide").collect()} == latest
    assert dict(spark.read.parquet(f"{root}/spot").dtypes)["price"] == "double"


def test_ingest_keeps_what_archived_files_brought(spark, tmp_path):
    """Two runs over the same day; the first run's files are gone in the second."""
    root = str(tmp_path / "tables")
    first = {
        "market_chart_btc_20250722_000000.json": chart([[1000, 1], [2000, 2]], [[1000, 5]]),
        "simple_price_20250722_000000.json": '{"btc":{"usd":3,"eur":"x"}}',
        "coins_list_20250723_000000.json": '[{"id":"a","symbol":"a","name":"newer"}]',
    }
    second = {
        "market_chart_btc_20250723_000000.json": chart([[2000, 20], [3000, 30]]),
        "simple_price_20250723_000000.json": '{"btc":{"usd":4}}',
        "coins_list_20250722_000000.json": '[{"id":"a","symbol":"a","name":"older"}]',
    }
    run_ingest(spark, write_landing(tmp_path / "day1", first), root)
    run_ingest(spark, write_landing(tmp_path / "day2", second), root)
    assert sorted(r.price for r in spark.read.parquet(f"{root}/chart_prices").collect()) == [1.0, 20.0, 30.0]
    assert spark.read.parquet(f"{root}/chart_volumes").count() == 1
    assert sorted(r.price for r in spark.read.parquet(f"{root}/spot").collect()) == [3.0, 4.0]
    assert [r.price for r in spark.read.parquet(f"{root}/spot_latest").collect()] == [4.0]
    assert [r.name for r in spark.read.parquet(f"{root}/catalog").collect()] == ["newer"]
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    run_ingest(spark, str(tmp_path / "day2"), root, refresh="full")
    assert sorted(r.price for r in spark.read.parquet(f"{root}/chart_prices").collect()) == [20.0, 30.0]


def test_landed_files_always_hold_the_current_content(spark, tmp_path):
    from feedlake.plans.emulate import landed_files

    for text in ("aaa", "bbb"):  # same size, other content
        docs = spark.createDataFrame([(text,), (text + "2",), (text,)], "value string")
        path = landed_files(spark, "case", docs, buckets=2)
        assert sorted(r.doc.strip() for r in scan_landing(spark, path, glob="*.txt").collect()) == [text, text, text + "2"]


def test_unlisted_type_is_a_column_of_the_pivot(spark):
    from feedlake.operators.feeds import spot_wide

    long = spark.createDataFrame([("u", "click", 1.0, 1), ("u", "brand_new", 2.0, 1)], "coin_id string, currency string, price double, snapshot_ts int")
    assert spot_wide(long).first().asDict() == {"coin_id": "u", "click": 1.0, "brand_new": 2.0}


def test_latest_files_carry_no_text_through_the_aggregate(spark, tmp_path):  # S6
    from feedlake.sources.landing import latest_files

    d = write_landing(tmp_path / "raw", {"coins_list_20250722_000000.json": "[]"})
    plan = latest_files(describe_files(scan_landing(spark, d)))._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Aggregate [" in line:
            assert "doc#" not in line


def test_latest_catalog_is_one_file(spark, tmp_path):  # S6 for the catalog table
    d = write_landing(
        tmp_path / "raw",
        {
            "coins_list_20250722_000000.json": '[{"id":"a","symbol":"a","name":"A"}]',
            "coins_list_20250723_000000.json": '[{"id":"a","symbol":"a","name":"A1"},{"id":"b","symbol":"b","name":"B"}]',
            "coins_list_x_20250723_000000.json": '[{"id":"a","symbol":"a","name":"A2"}]',
        },
    )
    root = str(tmp_path / "tables")
    run_ingest(spark, d, root)
    rows = sorted((r.id, r.name) for r in spark.read.parquet(f"{root}/catalog").collect())
    assert rows == [("a", "A2")]  # same second: the later name wins, one file only
