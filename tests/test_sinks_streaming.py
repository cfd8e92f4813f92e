"""Writers (full and touched refresh, pruning), exports and streaming ingest."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import write_landing
from feedlake.sinks import tables as sinks
from feedlake.sources import tables as sources
from feedlake.streaming import ingest as streaming


def points(spark, rows):
    return spark.createDataFrame(rows, "coin_id string, timestamp timestamp, price double, date date")


def test_full_versus_touched_refresh(spark, tmp_path):  # K1, K2, Q9
    d1, d2 = dt.date(2025, 7, 21), dt.date(2025, 7, 22)
    t = dt.datetime(2025, 7, 21, 1)
    base = points(spark, [("btc", t, 1.0, d1), ("btc", t, 2.0, d2)])
    new = points(spark, [("btc", t, 9.0, d2)])
    full, touched = str(tmp_path / "full"), str(tmp_path / "touched")
    for path, refresh in ((full, "full"), (touched, "touched")):
        assert sinks.write_table(base, path, partition_by=("coin_id", "date")) == 2
        sinks.write_table(new, path, partition_by=("coin_id", "date"), refresh=refresh)
    assert sorted(r.price for r in spark.read.parquet(full).collect()) == [9.0]
    assert sorted(r.price for r in spark.read.parquet(touched).collect()) == [1.0, 9.0]


def test_partition_pruning_and_pushdown_in_plan(spark, tmp_path):  # §4
    t = dt.datetime(2025, 7, 21, 1)
    df = points(spark, [("btc", t, float(i), dt.date(2025, 7, 1 + i % 5)) for i in range(50)])
    path = str(tmp_path / "t")
    sinks.write_table(df, path, partition_by=("coin_id", "date"), sort_by=("timestamp",))
    read = sources.read_table(spark, path).filter((F.col("date") >= "2025-07-04") & (F.col("price") > 10))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(price), GreaterThan(price,10.0)]" in plan
    assert read.count() == 16


def test_csv_and_json_exports_round_trip(spark, tmp_path):  # K3, K4
    texts = ["a,b", None, "", " lead ", "a\nb", "x\r\ny", '"q"', "\\N", "\\\\N", "#c", "\\", '"', "null", "é\t"]
    df = spark.createDataFrame([(i, t, i / 4) for i, t in enumerate(texts)] + [(None, "k", None)], "id int, name string, v double")
    sinks.export_csv(df, str(tmp_path / "c"))
    sinks.export_json(df, str(tmp_path / "j"))
    want = sorted(map(str, df.collect()))
    assert sorted(map(str, sources.read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == want
    back = sources.read_json_documents(spark, str(tmp_path / "j"), df.schema, multi_line=False)
    assert sorted(map(str, back.collect())) == want


@pytest.mark.parametrize("limit", [20_000, 200_000])
def test_csv_files_are_bounded_and_read_in_parallel(spark, tmp_path, limit):  # K3
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.repeat(F.lit('a"b'), 30_000)).otherwise(F.col("text")))
    path = str(tmp_path / "c")
    sinks.export_csv(docs, path, max_file_bytes=limit)
    sinks.export_csv(docs, path, max_file_bytes=limit)  # again: replaced, not added to
    files = {f: os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".csv")}
    for name in (f for f, size in files.items() if size > limit):  # only a row that is longer by itself
        assert sources.read_csv(spark, f"{path}/{name}", docs.schema).count() == 1
    assert limit < 150_000 or max(files.values()) <= limit
    back = sources.read_csv(spark, path, docs.schema)
    assert back.rdd.getNumPartitions() > 1 or limit > sum(files.values())
    assert len(files) >= sum(files.values()) / limit
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))


def test_csv_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "i int, t string")
    sinks.export_csv(df, str(tmp_path / "c"))
    assert sources.read_csv(spark, str(tmp_path / "c"), df.schema).count() == 0


def test_pretty_json_documents_read_back(spark, tmp_path):  # S2, F23
    rows = [(i, None if i < 2 else i // 3, f"n{i}") for i in range(10)] + [(10, 3, "n9"), (11, 3, "n9")]
    df = spark.createDataFrame(rows, "id long, grp long, name string")
    path = str(tmp_path / "docs")
    sinks.export_json_documents(df, path, group_col="grp", id_col="id")
    text = spark.read.text(path, wholetext=True).first().value
    assert "\n" in text and json.loads(text)
    back = sources.read_json_documents(spark, path, df.schema)
    assert sorted(map(str, back.select("id", "grp", "name").collect())) == sorted(map(str, df.collect()))


def test_stream_ingest_twice_equals_once(spark, tmp_path):  # R1
    src = tmp_path / "src"
    spark.range(100).withColumn("ts", F.current_timestamp()).write.parquet(str(src / "a"))
    schema = spark.read.parquet(str(src / "a")).schema
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    for _ in range(2):
        streaming.run_available_now(streaming.file_stream(spark, str(src / "a"), schema), sink, ckpt)
    assert spark.read.parquet(sink).count() == 100


def test_landing_stream_batches_equal_batch_job(spark, tmp_path):  # R1, R2
    landing = write_landing(
        tmp_path / "raw",
        {
            "market_chart_btc_20250722_000000.json": json.dumps({"prices": [[1000, 1], [2000, 2]]}),
            "simple_price_20250722_000000.json": '{"btc":{"usd":3}}',
        },
    )
    root = str(tmp_path / "tables")
    ingest = lambda batch, key: streaming.ingest_landing_batch(batch, root, key)
    streaming.run_batches(streaming.landing_stream(spark, landing), str(tmp_path / "ckpt"), ingest)
    write_landing(
        tmp_path / "raw",
        {"market_chart_btc_20250723_000000.json": json.dumps({"prices": [[2000, 20], [3000, 30]]})},
    )
    streaming.run_batches(streaming.landing_stream(spark, landing), str(tmp_path / "ckpt"), ingest)
    merged = sorted(r.price for r in streaming.latest_chart(spark, root).collect())
    assert merged == [1.0, 20.0, 30.0]
    assert spark.read.parquet(f"{root}/spot").count() == 1


@pytest.mark.parametrize("runs", [1, 4])
def test_stream_dedup_is_exact_in_any_file_order(spark, tmp_path, runs):  # R2 stream
    """20 files, newest events first, one file per trigger, over several runs:
    every distinct id once, however late it comes."""
    src, sink = tmp_path / "ev", str(tmp_path / "sink")
    schema = "id long, ts timestamp, v long"
    rng = random.Random(runs)
    ids = list(range(400))
    for run in range(runs):
        for f in range(20 // runs):
            part = ids[len(ids) - 20 * (run * 20 // runs + f + 1) : len(ids) - 20 * (run * 20 // runs + f)]
            part = part + rng.sample(ids, 10)  # repeats of early and late events
            rows = [(i, dt.datetime(2025, 1, 1) + dt.timedelta(hours=3 * i), i) for i in part] + [(None, None, 0)]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        stream = streaming.file_stream(spark, str(src), spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
        streaming.run_dedup(stream, sink, str(tmp_path / "ck"), ["id"], "ts")
    got = [r.id for r in spark.read.parquet(sink).collect()]
    assert sorted(got, key=str) == sorted([*ids, None], key=str)


def test_failed_batch_runs_again_without_traces(spark, tmp_path, monkeypatch):  # R1 after a failure between writers
    landing = write_landing(
        tmp_path / "raw",
        {
            "market_chart_btc_20250722_000000.json": json.dumps({"prices": [[1000, 1], [2000, "x"]], "total_volumes": [[1000, 5]]}),
            "simple_price_20250722_000000.json": '{"btc":{"usd":3}}',
            "coins_list_20250722_000000.json": '[{"id":"a","symbol":"a","name":"A"}]',
        },
    )
    root, real = str(tmp_path / "tables"), streaming.write_batch

    def failing(rows, path, *args, **kwargs):
        if path.endswith("/catalog"):
            raise RuntimeError("lost")
        real(rows, path, *args, **kwargs)

    monkeypatch.setattr(streaming, "write_batch", failing)
    with pytest.raises(Exception, match="lost"):
        streaming.run_ingest_stream(spark, landing, root)
    monkeypatch.setattr(streaming, "write_batch", real)
    streaming.run_ingest_stream(spark, landing, root)
    counts = {t: spark.read.parquet(f"{root}/{t}").count() for t in ("chart_prices", "chart_volumes", "spot", "catalog", "quarantine")}
    assert counts == {"chart_prices": 1, "chart_volumes": 1, "spot": 1, "catalog": 1, "quarantine": 1}


def test_json_documents_split_hot_groups(spark, tmp_path):  # no unbounded document
    rows = [(i, 0 if i < 90 else None, "same") for i in range(100)]  # repeated rows but for the id
    df = spark.createDataFrame(rows, "id long, grp long, name string")
    path = str(tmp_path / "docs")
    sinks.export_json_documents(df, path, group_col="grp", id_col="id", max_items=20, buckets=4)
    docs = spark.read.text(path, wholetext=True).collect()
    sizes = sorted(len(json.loads(d.value)) for d in docs)
    assert sum(sizes) == 100 and max(sizes) <= 20 and len(docs) == 6
    assert len([d for d in os.listdir(path) if d.startswith("bucket=")]) <= 4
    back = sources.read_json_documents(spark, path, df.schema)
    assert sorted((r.id, r.grp) for r in back.collect()) == [(i, g) for i, g, _ in rows]


def test_merge_into_chart_table_touched_partitions_only(spark, tmp_path):  # §7.3, Q1, Q9
    from feedlake.schemas import chart_table

    t = lambda d, h: dt.datetime(2025, 7, d, h)
    snap1, snap2 = dt.datetime(2025, 7, 22), dt.datetime(2025, 7, 23)
    schema = chart_table("price")
    first = spark.createDataFrame(
        [("btc", t(21, 1), 1.0, dt.date(2025, 7, 21), snap1), ("btc", t(22, 1), 2.0, dt.date(2025, 7, 22), snap1)], schema
    )
    second = spark.createDataFrame(
        [("btc", t(22, 1), 20.0, dt.date(2025, 7, 22), snap2), ("btc", t(22, 2), 30.0, dt.date(2025, 7, 22), snap2)], schema
    )
    path = str(tmp_path / "prices")
    sinks.merge_into_chart_table(spark, first, path)
    plan = sinks.touched_partitions(spark, path, second, schema)._jdf.queryExecution().executedPlan().toString()
    assert "2025-07-22" in plan.split("PartitionFilters: [")[1].split("]")[0]
    sinks.merge_into_chart_table(spark, second, path)
    got = sorted((r.timestamp, r.price) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [(t(21, 1), 1.0), (t(22, 1), 20.0), (t(22, 2), 30.0)]


def test_stream_merge_mode_keeps_one_point_per_time(spark, tmp_path):  # R2 merge on write
    from feedlake.schemas import chart_table

    landing = write_landing(tmp_path / "raw", {"market_chart_btc_20250722_000000.json": json.dumps({"prices": [[1000, 1], [2000, 2]]})})
    root = str(tmp_path / "tables")
    streaming.run_ingest_stream(spark, landing, root, charts_mode="merge")
    write_landing(tmp_path / "raw", {"market_chart_btc_20250723_000000.json": json.dumps({"prices": [[2000, 20], [3000, 30]]})})
    streaming.run_ingest_stream(spark, landing, root, charts_mode="merge")
    prices = spark.read.schema(chart_table("price")).parquet(f"{root}/chart_prices")
    assert sorted(r.price for r in prices.collect()) == [1.0, 20.0, 30.0]


def test_stray_old_point_reads_only_its_own_partition(spark, tmp_path):  # touched partitions by value, not by range
    from feedlake.schemas import chart_table

    schema, path = chart_table("price"), str(tmp_path / "prices")
    day = lambda d: (dt.datetime(2025, 7, d, 1), dt.date(2025, 7, d))
    rows = [("btc", day(d)[0], float(d), day(d)[1], dt.datetime(2025, 7, 30)) for d in range(1, 21)]
    sinks.merge_into_chart_table(spark, spark.createDataFrame(rows, schema), path)
    new = spark.createDataFrame([rows[0], rows[19]], schema)
    old = sinks.touched_partitions(spark, path, new, schema)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan and " IN (" in plan.split("PartitionFilters")[1][:200]
    assert sorted(r.price for r in old.collect()) == [1.0, 20.0]
    assert sinks.touched_partitions(spark, path, new.limit(0), schema).count() == 0


def test_merge_and_ingest_are_idempotent(spark, tmp_path):  # retries after a lost job give the same tables
    from feedlake.plans.ingest_run import run_ingest
    from feedlake.schemas import chart_table

    schema = chart_table("price")
    pts = spark.createDataFrame(
        [("btc", dt.datetime(2025, 7, 22, h), float(h), dt.date(2025, 7, 22), dt.datetime(2025, 7, 23)) for h in range(5)],
        schema,
    )
    path = str(tmp_path / "prices")
    sinks.merge_into_chart_table(spark, pts, path)
    once = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    sinks.merge_into_chart_table(spark, pts, path)
    assert sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect()) == once

    landing = write_landing(
        tmp_path / "raw",
        {
            "market_chart_btc_20250722_000000.json": json.dumps({"prices": [[1000, 1], [2000, 2]]}),
            "simple_price_20250722_000000.json": '{"btc":{"usd":3}}',
        },
    )
    root = str(tmp_path / "tables")
    tables = ("chart_prices", "spot", "spot_latest", "quarantine")
    run_ingest(spark, landing, root)
    first = {t: sorted(map(str, spark.read.parquet(f"{root}/{t}").drop("ingestion_timestamp").collect())) for t in tables}
    run_ingest(spark, landing, root)
    again = {t: sorted(map(str, spark.read.parquet(f"{root}/{t}").drop("ingestion_timestamp").collect())) for t in tables}
    assert again == first
