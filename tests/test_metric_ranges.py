"""Sliding rates, instant values and alert states against plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedlake.operators import metrics

T0 = dt.datetime(2025, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, id long, value double")


def samples(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        series = rng.choice(["a", "a", "a", None, "b"])  # one hot, one without a label
        at = T0 + dt.timedelta(seconds=rng.choice([rng.randrange(4000), 30 * rng.randrange(130)]))
        rows.append((series, at, i, float(rng.choice([i % 90, rng.randrange(100)]))))
    return rows


def ranges(rows, window, step):
    """{(series, step end): samples in (end - window, end], in order}"""
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        at = (r[1] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        e = -(-at // (step * 1_000_000))
        for k in range(window // step):
            out[r[0], e + k].append(r)
    return {(s, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=e * step)): v for (s, e), v in out.items()}


@pytest.mark.parametrize("window, step", [(300, 60), (120, 120), (90, 30)])
def test_sliding_rate(spark, window, step):  # M1
    rows = samples(window)
    got = metrics.sliding_rate(frame(spark, rows), ["series"], window=f"{window} seconds", step=f"{step} seconds", tie="id")
    got = {(r.series, r.step_ts): (r.rate, r.n_samples) for r in got.collect()}
    want = {}
    for key, seen in ranges(rows, window, step).items():
        if len(seen) > 1:
            values = [r[3] for r in seen]
            rise = sum(b - a if b >= a else b for a, b in zip(values, values[1:]))
            want[key] = (pytest.approx(rise / window), len(seen))
    assert got == want


def test_sliding_rate_orders_bounded_partitions_only(spark):
    plan = metrics.sliding_rate(frame(spark, samples(1)), ["series"], tie="id")._jdf.queryExecution().executedPlan().toString()
    specs = [line.split("windowspecdefinition(")[1] for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert specs and all("_end#" in s or "_block#" in s for s in specs)
    assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan


def test_instant_values(spark):  # M4
    rows = samples(5, 120)
    got = metrics.instant_values(frame(spark, rows), ["series"], step="30 seconds", lookback="2 minutes", tie="id")
    got = {(r.series, r.step_ts): (r.value, r.sample_ts) for r in got.collect()}
    want = {key: (seen[-1][3], seen[-1][1]) for key, seen in ranges(rows, 120, 30).items()}
    assert got == want


@pytest.mark.parametrize("hold", [0, 60, 100])
def test_alert_changes(spark, hold):  # M3
    rows = samples(7, 250)
    got = metrics.alert_changes(
        frame(spark, rows), ["series"], 40.0, f"{hold} seconds" if hold else "1 second", step="30 seconds", lookback="1 minute", tie="id"
    )
    got = sorted((str(r.series), r.step_ts, r.state) for r in got.collect())
    hold = hold or 1
    values = {key: seen[-1][3] for key, seen in ranges(rows, 60, 30).items()}
    want, step = [], dt.timedelta(seconds=30)
    for series in {k[0] for k in values}:
        times = [k[1] for k in values if k[0] == series]
        at, since, firing = min(times), None, False
        while at <= max(times) + step:
            if values.get((series, at), -1.0) > 40.0:
                if since is None:
                    since = at
                    want.append((str(series), at, "pending"))
                if not firing and at - since >= dt.timedelta(seconds=hold):
                    firing = True
                    want.append((str(series), at, "firing"))
            elif since is not None:
                want.append((str(series), at, "inactive"))
                since, firing = None, False
            at += step
    assert got == sorted(want)


def test_empty_and_null_values(spark):
    none = frame(spark, [])
    assert metrics.sliding_rate(none, ["series"]).count() == 0
    assert metrics.instant_values(none, ["series"]).count() == 0
    assert metrics.alert_changes(none, ["series"], 1.0).count() == 0
    some = frame(spark, [("a", T0, 1, None), ("a", T0 + dt.timedelta(seconds=5), 2, None)])
    assert metrics.alert_changes(some, ["series"], 1.0).count() == 0
    with pytest.raises(ValueError):
        metrics.sliding_rate(none, ["series"], window="5 minutes", step="7 seconds")
    assert metrics.sliding_rate(some.withColumn("value", F.lit(3.0)), ["series"]).select("rate").distinct().first().rate == 0.0
