"""Overwrites and merges that fail, or stop, at every step keep a whole table."""

import os

import pytest
from pyspark.sql import functions as F

from feedlake.schemas import chart_table
from feedlake.sinks import commit
from feedlake.sinks import tables as sinks
from feedlake.sources import tables as sources

BY = ("k", "day")


def rows(spark, n, factor=1.0):
    return spark.range(n).select(
        (F.col("id") % 3).alias("k"), F.date_add(F.lit("2025-07-01").cast("date"), (F.col("id") % 4).cast("int")).alias("day"),
        "id", (F.col("id") * factor).alias("v"),
    )


def content(df):
    return sorted((r.k, str(r.day), r.id, r.v) for r in df.collect())


def failing(df):
    return df.withColumn("v", F.when(F.col("id") % 10 == 9, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("v")))


FORMS = {
    "full": lambda df, path: sinks.write_table(df, path),
    "partitioned": lambda df, path: sinks.write_table(df, path, partition_by=BY),
    "touched": lambda df, path: sinks.write_table(df, path, partition_by=BY, refresh="touched"),
    "merge": lambda df, path: sinks.merge_into_table(
        df.sparkSession, df, path, rows(df.sparkSession, 0).schema, ["k", "day", "id"], ["v"], partition_by=BY, date_col="day"
    ),
}


@pytest.mark.parametrize("form", FORMS)
def test_failed_write_keeps_every_former_row(spark, tmp_path, form):  # K1, K2, R2
    path, before = str(tmp_path / "t"), rows(spark, 100)
    FORMS[form](before, path)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            FORMS[form](failing(rows(spark, 100, -1.0).repartition(4)), path)
        # for any reader, not only ours
        assert content(spark.read.parquet(path)) == content(before)
        assert content(sources.read_table(spark, path)) == content(before)
    FORMS[form](rows(spark, 100, 2.0), path)
    assert content(spark.read.parquet(path)) == content(rows(spark, 100, 2.0))
    assert os.listdir(f"{path}/_staged") == []  # what failed writes left is gone


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("moves", [0, 1, 2, 5])
def test_interrupted_swap_is_finished_by_the_next_reader(spark, tmp_path, monkeypatch, form, moves):
    path = str(tmp_path / "t")
    FORMS[form](rows(spark, 60), path)
    real, done = commit.TableFiles.move, []

    def dies(self, source, target):
        done.append(source)
        if len(done) > moves:
            raise RuntimeError("driver lost")
        real(self, source, target)

    monkeypatch.setattr(commit.TableFiles, "move", dies)
    monkeypatch.setattr(commit, "_MOVERS", 1)
    with pytest.raises(RuntimeError):
        FORMS[form](rows(spark, 40, 3.0), path)
    with pytest.raises(RuntimeError):  # the one who finishes it dies, too
        sources.read_table(spark, path)
    monkeypatch.setattr(commit.TableFiles, "move", real)
    want = content(rows(spark, 40, 3.0))
    if form == "merge":  # the former rows of other keys stay
        want = sorted(want + [r for r in content(rows(spark, 60)) if r[2] >= 40])
    assert content(sources.read_table(spark, path)) == want
    assert not os.path.exists(f"{path}/_commit.json")
    assert content(spark.read.parquet(path)) == want


def test_stop_before_the_record_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    FORMS["full"](rows(spark, 20), path)

    def dies(self, relative, text):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(commit.TableFiles, "write_text_once", dies)
    with pytest.raises(RuntimeError):
        FORMS["full"](rows(spark, 5), path)
    monkeypatch.undo()
    assert content(sources.read_table(spark, path)) == content(rows(spark, 20))


def test_former_version_stays_until_the_next_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (10, 20, 30):
        FORMS["full"](rows(spark, n), path)
    kept = os.listdir(f"{path}/_former")
    assert len(kept) == 1
    assert content(spark.read.parquet(f"{path}/_former/{kept[0]}")) == content(rows(spark, 20))


def test_overwrite_may_read_the_table_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    FORMS["partitioned"](rows(spark, 50), path)
    FORMS["touched"](spark.read.parquet(path).where("k = 1").withColumn("v", F.lit(0.0)), path)
    FORMS["partitioned"](spark.read.parquet(path).withColumn("v", F.col("v") + 1), path)
    want = sorted((k, d, i, 1.0 if k == 1 else v + 1) for k, d, i, v in content(rows(spark, 50)))
    assert content(spark.read.parquet(path)) == want


def test_empty_inputs(spark, tmp_path):
    path = str(tmp_path / "t")
    FORMS["touched"](rows(spark, 0), path)  # nothing to write, nothing there
    assert not sinks.table_exists(spark, path)
    FORMS["touched"](rows(spark, 30), path)
    FORMS["touched"](rows(spark, 0), path)
    FORMS["merge"](rows(spark, 0), path)
    assert content(spark.read.parquet(path)) == content(rows(spark, 30))
    FORMS["partitioned"](rows(spark, 0), path)
    assert spark.read.schema(rows(spark, 0).schema).parquet(path).count() == 0


def test_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = ["a b", "x/y", "50%", "c:d", None, "ä", "=", "p.q"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(odd)], "name string, i int")
    for extra in (0, 10):
        sinks.write_table(df.withColumn("i", F.col("i") + extra), path, partition_by=("name",), refresh="touched")
    got = {r.name: r.i for r in spark.read.schema("i int, name string").parquet(path).collect()}
    assert got == {v: i + 10 for i, v in enumerate(odd)}


def test_merge_reads_no_copy(spark, tmp_path, monkeypatch):  # the merged rows are written once
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("merge copies its rows"))
    path = str(tmp_path / "prices")
    pts = rows(spark, 20).selectExpr(
        "cast(k as string) coin_id", "timestamp_seconds(id * 3600) timestamp", "v price", "day date", "timestamp_seconds(0) snapshot_ts"
    )
    for _ in range(2):
        sinks.merge_into_chart_table(spark, pts, path)
    assert spark.read.schema(chart_table("price")).parquet(path).count() == 20


def test_a_swap_takes_few_round_trips_a_partition(spark, tmp_path, monkeypatch):
    df = spark.range(60).select((F.col("id") % 30).alias("k"), F.lit("2025-07-01").cast("date").alias("day"), "id", F.lit(1.0).alias("v"))
    path, client, calls = str(tmp_path / "t"), spark.sparkContext._gateway._gateway_client, []
    FORMS["touched"](df, path)
    df.write.partitionBy(*BY).save(commit.staging_path(path, "1"))
    real = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(a[0][:1]) or real(*a, **k))
    commit.commit(spark, path, "1", 2)
    monkeypatch.undo()
    calls = [c for c in calls if c != "m"]  # without those that free objects
    print(len(calls) / 30)
    assert len(calls) < 50 * 30 and spark.read.parquet(path).count() == 60
