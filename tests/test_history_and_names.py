"""Nested tables, newest files by name, and a quarantine that only grows."""

import json
import os

from pyspark.sql import functions as F

from conftest import write_landing
from feedlake.plans.ingest_run import run_ingest
from feedlake.schemas import QUARANTINE_TABLE
from feedlake.sinks import tables as sinks
from feedlake.sources import landing
from feedlake.sources import tables as sources


def test_tables_are_found_at_any_depth(spark, tmp_path):  # S11
    root = str(tmp_path / "root")
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    sinks.write_table(df, f"{root}/market/charts/bitcoin/prices", partition_by=("k",))
    sinks.write_table(df, f"{root}/market/charts/eth_x/prices")
    df.write.parquet(f"{root}/plain")
    df.write.parquet(f"{root}/no_marker")
    os.remove(f"{root}/no_marker/_SUCCESS")
    os.makedirs(f"{root}/nothing/here")
    os.makedirs(f"{root}/_hidden/x")
    write_landing(f"{root}/raw", {"a.json": "{}"})
    sinks.write_table(df.limit(0), f"{root}/empty", partition_by=("k",))
    found = sources.discover_tables(spark, root)
    assert {n: d.count() for n, d in found.items()} == {
        "empty": 0, "market/charts/bitcoin/prices": 10, "market/charts/eth_x/prices": 10, "no_marker": 10, "plain": 10,
    }
    assert "k" in found["market/charts/bitcoin/prices"].columns
    assert sources.discover_tables(spark, f"{root}/nothing") == {}


def test_a_delta_folder_is_a_table_and_not_searched(spark, tmp_path):
    os.makedirs(tmp_path / "r" / "deep" / "t" / "_delta_log")
    os.makedirs(tmp_path / "r" / "deep" / "t" / "part=1")
    assert sources.table_paths(spark, str(tmp_path / "r")) == {"deep/t": "delta"}


def test_newest_file_reads_no_other_file(spark, tmp_path):  # S6
    names = [f"{kind}_2025072{d}_0{h}0000.json" for kind in ("simple_price", "market_chart_a b_c") for d in (1, 2) for h in (1, 5)]
    names += ["coins_list_20250101_000000.json", "coins_list_x.json", "other.json", "simple_price_[1].json"]
    path = write_landing(tmp_path / "raw", {n: json.dumps({"n": n}) for n in names})
    plan = landing.scan_names(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    got = {r.kind: r.file_name for r in landing.read_newest(spark, path).collect()}
    assert got == {
        "spot": "simple_price_20250722_050000.json", "chart": "market_chart_a b_c_20250722_050000.json",
        "catalog": "coins_list_20250101_000000.json", "unrecognised": "other.json",
    }
    assert all(json.loads(r.doc)["n"] == r.file_name for r in landing.read_newest(spark, path).collect())
    files = landing.read_newest(spark, path).inputFiles()
    assert len(files) == 4  # only the winners are in the scan
    by_asset = landing.read_newest(spark, path, by=("kind", "asset_id"))
    assert sorted(r.file_name for r in by_asset.collect()) == sorted(got.values())
    assert landing.read_newest(spark, path, glob="*.csv").count() == 0


def test_newest_files_beyond_the_path_limit(spark, tmp_path, monkeypatch):
    path = write_landing(tmp_path / "raw", {f"market_chart_c{i}_2025072{d}_000000.json": "{}" for i in range(5) for d in (1, 2)})
    monkeypatch.setattr(landing, "MOST_PATHS", 3)
    got = landing.read_newest(spark, path, by=("asset_id",))
    assert sorted(r.file_name for r in got.collect()) == [f"market_chart_c{i}_20250722_000000.json" for i in range(5)]


def table_files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names
    }


def test_quarantine_grows_only_by_what_is_new(spark, tmp_path):  # R3
    bad = {f"simple_price_2025072{d}_000000.json": '{"btc":{"usd":"x"},"eth":5}' for d in (1, 2)}
    raw, root = tmp_path / "raw", str(tmp_path / "tables")
    path = f"{root}/quarantine"
    run_ingest(spark, write_landing(raw, bad), root)
    first = table_files(path)
    run_ingest(spark, str(raw), root)
    assert table_files(path) == first  # not a byte for the same files
    write_landing(raw, {"simple_price_20250722_060000.json": "broken"})
    os.remove(raw / "simple_price_20250721_000000.json")  # archived
    run_ingest(spark, str(raw), root)
    after = table_files(path)
    assert {f: t for f, t in after.items() if f in first and not f.endswith(("_SUCCESS", "_SUCCESS.crc"))}.items() <= first.items()
    rows = sources.read_table(spark, path, schema=QUARANTINE_TABLE).collect()
    assert len(rows) == 5 and sum(r.rejected_doc is not None for r in rows) == 3
    assert sorted({str(r.snapshot_date) for r in rows}) == ["2025-07-21", "2025-07-22"]
