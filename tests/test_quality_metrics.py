"""Quality and metric operators, checked against brute force on small frames."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedlake.operators import metrics, quality


def test_null_counts_count_nulls(spark):  # Q4, A3
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {r.column_name: r.nulls for r in quality.null_counts(df).collect()} == {"a": 1, "b": 2}


def test_required_and_similar_columns(spark):  # P12, P13
    df = spark.createDataFrame([(1, None, "x")], "Coin_Id int, symbol string, name string")
    req = {r.column_name: (r.present, r.non_null) for r in quality.required_columns(df, ["symbol", "id"]).collect()}
    assert req == {"symbol": (True, 0), "id": (False, None)}
    sim = sorted(tuple(r) for r in quality.similar_columns(df, ["ID", "nam"]).collect())
    assert sim == [("ID", "Coin_Id", 1), ("nam", "name", 1)]


def test_distinct_keys_fallback_and_time_values(spark):  # P14, P15, O2
    df = spark.createDataFrame(
        [("a", dt.date(2025, 1, i % 12 + 1)) for i in range(30)], "coin_id string, date date"
    )
    assert quality.distinct_keys(df).count() == 1
    vals = [r.value for r in quality.distinct_time_values(df, 10).collect()]
    assert vals == [f"2025-01-{d:02d}" for d in range(1, 11)]


def test_text_shape_profile_lines(spark):  # A9, F18
    texts = ["", "one", "one\n", "a\nb", "a\nb\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = [(r.n_lines, r.single_line, r.n_bytes) for r in quality.text_shape_profile(df, "t", ["id"]).orderBy("id").collect()]
    assert got == [(0, False, 0), (1, True, 3), (1, True, 4), (2, False, 3), (3, False, 5)]


def test_state_counts_null_state_and_defaults(spark):  # Q18, A5, A6, F22
    log = spark.createDataFrame([("1", "success"), ("2", None), ("3", "success")], "run_id string, state string")
    counts = {r.state: r.n for r in metrics.state_counts(log).collect()}
    assert counts == {"success": 2, None: 0}
    filled = {r.state: r.n for r in metrics.state_counts_filled(log).collect()}
    assert filled == {"success": 2, None: 0, "running": 0, "failed": 0}
    only_empty = {r.state: r.n for r in metrics.state_counts_filled(log, only_if_empty=True).collect()}
    assert only_empty == counts
    empty = log.filter(F.lit(False))
    assert {r.state for r in metrics.state_counts_filled(empty, only_if_empty=True).collect()} == {"running", "success", "failed"}
    lines = {r.line for r in metrics.metric_lines(metrics.state_counts(log)).collect()}
    assert lines == {'airflow_dag_run_count{state="success"} 2', 'airflow_dag_run_count{state="None"} 0'}


def test_counter_rate_reset_inside_window(spark):  # M1
    t0 = dt.datetime(2025, 1, 1, 0, 0, 0)
    vals = [10.0, 40.0, 5.0, 25.0]  # reset after 40: increments 30, 5, 20
    rows = [("s", t0 + dt.timedelta(seconds=30 * i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "name string, ts timestamp_ntz, value double")
    r = metrics.counter_rate(df, ["name"]).first()
    assert r.n_samples == 4 and abs(r.rate - 55.0 / 300) < 1e-12


def test_label_select(spark):  # M2
    df = spark.createDataFrame(
        [({"job": "a", "svc": "x"}, 1.0), ({"job": "b"}, 2.0)], "labels map<string,string>, value double"
    )
    assert [r.value for r in metrics.label_select(df, {"job": "a"}).collect()] == [1.0]


def brute_force_runs(pdf, threshold, min_seconds, max_gap=None):
    out = []
    for name, g in pdf.sort_values(["ts", "id"]).groupby("name", dropna=False):
        run = []
        for _, row in g.iterrows():
            if run and (not row.value > threshold or (max_gap and (row.ts - run[-1]).total_seconds() > max_gap)):
                out.append((name if isinstance(name, str) else "null", run[0], run[-1], len(run)))
                run = []
            if row.value > threshold:
                run.append(row.ts)
        if run:
            out.append((name if isinstance(name, str) else "null", run[0], run[-1], len(run)))
    return sorted(r for r in out if (r[2] - r[1]).total_seconds() >= min_seconds)


@pytest.mark.parametrize("threshold,slice_seconds,max_gap", [(3.0, 60, None), (1.0, 3600, None), (0.5, 900, 200), (1.0, 30, 90)])
def test_sustained_threshold_matches_brute_force(spark, threshold, slice_seconds, max_gap):  # M3
    """Null series, ties, null values, runs over slice and day edges."""
    rng = random.Random(slice_seconds)
    t0 = dt.datetime(2025, 1, 1, 22, 0, 0)
    rows = []
    for i in range(900):
        name = rng.choice(["hot", "hot", "hot", "cold", None])
        value = None if rng.random() < 0.02 else float(rng.randint(0, 10))
        rows.append((i, name, t0 + dt.timedelta(seconds=rng.randint(0, 30 * 3600) // 7 * 7), value))
    pdf = pd.DataFrame(rows, columns=["id", "name", "ts", "value"])
    df = spark.createDataFrame(rows, "id long, name string, ts timestamp_ntz, value double")
    got = metrics.sustained_threshold(
        df, ["name"], threshold, 120, "ts", "value", tie="id", slice_seconds=slice_seconds, max_gap_seconds=max_gap
    )
    got = sorted((r.name or "null", r.start_ts, r.end_ts, r.n_samples) for r in got.collect())
    expected = [(n, a.to_pydatetime(), b.to_pydatetime(), k) for n, a, b, k in brute_force_runs(pdf, threshold, 120, max_gap)]
    assert got == expected and len(got) > 5


def test_two_distant_samples_are_no_sustained_run_with_a_gap_limit(spark):  # M3
    t0 = dt.datetime(2025, 1, 1)
    rows = [("s", t0, 9.0), ("s", t0 + dt.timedelta(days=2), 9.0)]
    df = spark.createDataFrame(rows, "name string, ts timestamp_ntz, value double")
    assert metrics.sustained_threshold(df, ["name"], 5.0).count() == 1
    assert metrics.sustained_threshold(df, ["name"], 5.0, max_gap_seconds=3600).count() == 0


def test_counter_rate_parameters(spark):  # M1
    t0 = dt.datetime(2025, 1, 1)
    rows = [("s", t0, 0.0), ("s", t0 + dt.timedelta(seconds=50), 60.0), ("s", t0 + dt.timedelta(seconds=61), 61.0)]
    df = spark.createDataFrame(rows, "name string, ts timestamp_ntz, value double")
    got = {r.window_start: (r.rate, r.n_samples) for r in metrics.counter_rate(df, ["name"], window="1 minute").collect()}
    assert got == {t0: (1.0, 2), t0 + dt.timedelta(minutes=1): (None, 1)}
    for bad in ({"slice_seconds": 7}, {"window": "soon"}, {"window": "0 seconds"}):
        with pytest.raises(ValueError):
            metrics.counter_rate(df, ["name"], **bad)


def test_label_selector_reaches_the_scan(spark, tmp_path):  # M2
    spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", 3.0)], "kind string, value double").write.parquet(str(tmp_path / "s"))
    labelled = spark.read.parquet(str(tmp_path / "s")).withColumn("labels", F.create_map(F.lit("type"), F.col("kind")))
    out = metrics.label_select(labelled, {"type": "a"}).select("value")
    assert "EqualTo(kind,a)" in out._jdf.queryExecution().executedPlan().toString()
    assert [r.value for r in out.collect()] == [1.0]
    assert metrics.label_select(labelled, {"none": "a"}).count() == 0


def test_exposition_has_headers_and_task_states(spark):  # F22
    runs = spark.createDataFrame([("success", 2), (None, 0)], "state string, n long")
    tasks = metrics.state_counts_filled(spark.createDataFrame([], "state string"), metrics.TASK_STATES, only_if_empty=True)
    rows = metrics.exposition([(metrics.RUN_METRIC, "Runs by state", runs), (metrics.TASK_METRIC, "Tasks by state", tasks)])
    lines = [r.line for r in rows.orderBy("metric", "line_no").collect()]
    assert lines[:4] == [
        "# HELP airflow_dag_run_count Runs by state", "# TYPE airflow_dag_run_count gauge",
        'airflow_dag_run_count{state="success"} 2', 'airflow_dag_run_count{state="None"} 0',
    ]
    assert len(lines) == 4 + 2 + len(metrics.TASK_STATES) and lines[6].endswith(" 0")


def test_sample_grid_last_sample(spark):  # M4
    t0 = dt.datetime(2025, 1, 1)
    rows = [("s", 1, t0 + dt.timedelta(seconds=1), 1.0), ("s", 2, t0 + dt.timedelta(seconds=29), 2.0),
            ("s", 3, t0 + dt.timedelta(seconds=31), 3.0)]
    df = spark.createDataFrame(rows, "name string, id long, ts timestamp_ntz, value double")
    got = sorted((r.slot_start, r.value, r.n_samples) for r in metrics.sample_grid(df, ["name"], tie="id").collect())
    assert got == [(t0, 2.0, 2), (t0 + dt.timedelta(seconds=30), 3.0, 1)]


def test_counter_rate_matches_brute_force_with_hot_burst(spark):  # M1, skew
    rng = random.Random(3)
    t0 = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(800):
        hot = i < 500
        secs = rng.randint(0, 299) if hot else rng.randint(0, 3000)  # a burst inside one window
        rows.append((i, "hot" if hot else "cold", t0 + dt.timedelta(seconds=secs, microseconds=rng.randint(0, 999999)), float(rng.randint(0, 50))))
    pdf = pd.DataFrame(rows, columns=["id", "name", "ts", "value"])
    df = spark.createDataFrame(pdf, "id long, name string, ts timestamp_ntz, value double")
    got = {(r.name, r.window_start): (r.rate if r.rate is None else round(r.rate, 9), r.n_samples) for r in metrics.counter_rate(df, ["name"], tie="id").collect()}
    expected = {}
    pdf["w"] = pdf.ts.dt.floor("5min")
    for (name, w), g in pdf.sort_values(["ts", "id"]).groupby(["name", "w"]):
        vals = list(g.value)
        inc = sum((b - a) if b >= a else b for a, b in zip(vals, vals[1:]))
        expected[(name, w.to_pydatetime())] = (round(inc / 300, 9) if len(vals) > 1 else None, len(vals))
    assert got == expected


def test_required_columns_keep_order_and_empty_inventory(spark):
    from feedlake.sources.tables import table_inventory

    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert [r.column_name for r in quality.required_columns(df, ["z", "a", "b", "y"]).collect()] == ["z", "a", "b", "y"]
    assert table_inventory({}).count() == 0


def test_json_type_profile_against_brute_force(spark):  # F17
    import collections
    import json

    docs = [
        ("a", '{"k": 1}'), ("a", '{"k": 2, "s": "x", "o": {"x": 1}}'), ("b", '{"n": [1], "k": null, "t": true}'), ("b", "not json"),
        ("c", '{"k": 1.5, "big": 12345678901234567890123}'), ("c", "[1, 2]"), ("c", "5"), ("c", None), (None, '{"k": "1"}'), (None, "{}"),
    ]
    names = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null", int: "number", float: "number"}
    expected = collections.Counter()
    for g, d in docs:
        try:
            value = json.loads(d) if d else None
        except ValueError:
            continue
        if isinstance(value, dict):
            expected.update((g, k, names[type(v)]) for k, v in value.items())
    df = spark.createDataFrame(docs, "g string, doc string")
    assert {(r.g, r.key, r.json_type): r.n for r in quality.json_type_profile(df, "doc", ["g"]).collect()} == expected


def test_nullness_only_keeps_null_counts(spark):
    df = spark.createDataFrame([(1, "long text", None), (2, None, 3.0), (3, None, None)], "id int, t string, v double")
    slim = quality.nullness_only(df, ["t", "v"])
    assert dict(slim.dtypes)["t"] == "boolean"
    full = {r.column_name: r.nulls for r in quality.null_counts(df).collect()}
    assert {r.column_name: r.nulls for r in quality.null_counts(slim).collect()} == full == {"id": 0, "t": 2, "v": 2}
