"""Run-state counts and time-series metric queries.

Metric samples are any frame with series columns, a time column and a value.
Per-series ordering is never done over a whole series in one task: ordered
work is partitioned by (series, time bucket), and what crosses a bucket edge
(the previous sample, a running count) is carried by a small per-bucket
aggregate - one row per series and bucket - so a series holding a third of
all samples is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.columns import metric_line

# ---------------------------------------------------------------------------
# State names and metric names of the run-state exposition.
# ---------------------------------------------------------------------------
RUN_STATES = ("running", "success", "failed")
TASK_STATES = (
    "success",
    "running",
    "failed",
    "up_for_retry",
    "upstream_failed",
    "skipped",
    "up_for_reschedule",
    "queued",
    "scheduled",
)
RUN_METRIC = "airflow_dag_run_count"
TASK_METRIC = "airflow_task_instance_count"
# ---------------------------------------------------------------------------


def state_counts(log: DataFrame, state_col: str = "state") -> DataFrame:
    """``(state, n)`` with ``n = count(state)``: a null state is a group with 0."""
    return log.groupBy(F.col(state_col).alias("state")).agg(F.count(state_col).alias("n"))


def state_counts_filled(
    log: DataFrame,
    known_states: Sequence[str] = RUN_STATES,
    state_col: str = "state",
    only_if_empty: bool = False,
) -> DataFrame:
    """State counts with a 0 row for known states.

    Default: every known state is present (0 when unseen).  With
    ``only_if_empty`` the zeros appear only when the log has no rows at all,
    as the reference exporter behaves.  Both paths work on rows bounded by
    the number of distinct states; the default reads the log once.
    """
    counts = state_counts(log, state_col)
    spark = log.sparkSession
    zeros = spark.createDataFrame([(s, 0) for s in known_states], "state string, n long")
    if only_if_empty:
        seen = counts.select(F.lit(1).alias("_k")).distinct()
        missing = zeros.withColumn("_k", F.lit(1)).join(seen, "_k", "left_anti").drop("_k")
        return counts.unionByName(missing)
    # one scan of the log: observed counts and zeros, the larger per state
    return counts.unionByName(zeros).groupBy("state").agg(F.max("n").alias("n"))


def exposition(families: Sequence[tuple[str, str, DataFrame]], label: str = "state") -> DataFrame:
    """The whole text of an exposition, ``(metric, line_no, line)``.

    Each family is (metric name, help text, ``(state, n)`` counts) and gives
    its help line (0), its type line (1), then its samples by state (nulls
    last).  Rows are bounded by the number of states."""
    parts = []
    for metric, text, counts in families:
        rank = F.row_number().over(Window.orderBy(F.col("state").asc_nulls_last()))  # a few states
        samples = counts.select(
            F.lit(metric).alias("metric"),
            (rank + 1).cast("long").alias("line_no"),
            metric_line(metric, label, F.col("state"), F.col("n")).alias("line"),
        )
        heads = [(metric, 0, f"# HELP {metric} {text}"), (metric, 1, f"# TYPE {metric} gauge")]
        parts.append(counts.sparkSession.createDataFrame(heads, "metric string, line_no long, line string").unionByName(samples))
    return reduce(DataFrame.unionByName, parts)


def metric_lines(counts: DataFrame, metric: str = RUN_METRIC, label: str = "state") -> DataFrame:
    """Exposition lines ``metric{state="x"} n`` from ``(state, n)`` rows."""
    return counts.select(
        F.col("state"),
        F.col("n"),
        metric_line(metric, label, F.col("state"), F.col("n")).alias("line"),
    )


def label_select(samples: DataFrame, selector: Mapping[str, str], labels_col: str = "labels") -> DataFrame:
    """Samples whose label map matches every ``key = value`` of the selector."""
    cond: Column | None = None
    for k, v in selector.items():
        # plain map access folds into the column a built map takes the label
        # from, so the filter reaches the scan; an absent label is null
        c = F.col(labels_col)[k] == F.lit(v)
        cond = c if cond is None else (cond & c)
    return samples if cond is None else samples.filter(cond)


def sample_grid(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    step: str = "30 seconds",
    tie: str | None = None,
) -> DataFrame:
    """Last sample of each series in every ``step`` slot (scrape alignment)."""
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    slot = F.window(ts, step).start.alias("slot_start")
    return samples.groupBy(*series, slot).agg(
        F.max_by(value, order).alias(value),
        F.count(F.lit(1)).alias("n_samples"),
    )


def _increase(prev: Column, cur: Column) -> Column:
    """Counter increase between consecutive samples; a drop is a reset."""
    return F.when(prev.isNull(), None).when(cur >= prev, cur - prev).otherwise(cur)


def _seconds(interval: str) -> int:
    """Whole seconds of an interval text such as ``5 minutes``."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    parts = interval.split()
    if len(parts) != 2 or not parts[0].isdigit() or parts[1].rstrip("s") not in units or int(parts[0]) < 1:
        raise ValueError(f"an interval like '5 minutes' is needed, not {interval!r}")
    return int(parts[0]) * units[parts[1].rstrip("s")]


def _slice(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000))


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    window: str = "5 minutes",
    tie: str | None = None,
    slice_seconds: int = 10,
) -> DataFrame:
    """Per-second increase of a counter in each tumbling window.

    Increments are taken between consecutive samples of a series inside the
    window; a drop means the counter was reset, so the increment is the new
    value.  No extrapolation to the window edges; a window with a single
    sample has no rate (null).  ``(series..., window_start, rate, n_samples)``.

    Ordered work never spans more than ``slice_seconds`` of one series: a window
    function finds increments inside each (series, slice); per slice, the
    first and last sample and the summed increments are aggregated; the
    increments across consecutive non-empty slices of a window come from a
    lag over those aggregates (at most window/slice rows per group).
    ``slice_seconds`` must divide the window length.
    """
    seconds = _seconds(window)
    if slice_seconds < 1 or seconds % slice_seconds:
        raise ValueError("slice_seconds must divide the window")
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])
    key = F.struct(*order)
    df = samples.withColumns({"window_start": F.window(ts, window).start, "_slice": _slice(ts, slice_seconds)})
    w_in = Window.partitionBy(*series, "window_start", "_slice").orderBy(*order)
    df = df.withColumn("_inc", _increase(F.lag(value).over(w_in), F.col(value)))
    slices = df.groupBy(*series, "window_start", "_slice").agg(
        F.min_by(value, key).alias("_first"),
        F.max_by(value, key).alias("_last"),
        F.sum("_inc").alias("_inc_in"),
        F.count(F.lit(1)).alias("_n"),
    )
    w_s = Window.partitionBy(*series, "window_start").orderBy("_slice")
    slices = slices.withColumn("_inc_edge", _increase(F.lag("_last").over(w_s), F.col("_first")))
    increase = F.coalesce(F.sum("_inc_in"), F.lit(0.0)) + F.coalesce(F.sum("_inc_edge"), F.lit(0.0))
    return slices.groupBy(*series, "window_start").agg(
        F.when(F.sum("_n") > 1, increase / F.lit(float(seconds))).alias("rate"),
        F.sum("_n").alias("n_samples"),
    )


def _grid_end(ts: str, micros: int) -> Column:
    """Number of the grid step at or after the time: step ``e`` sees the
    samples of ((e - 1) * step, e * step]."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rest = F.pmod(at, F.lit(micros))
    return ((at - rest) / F.lit(micros)).cast("long") + (rest > 0).cast("long")


def _steps_in(window: str, step: str) -> tuple[int, int]:
    """(steps in the window, microseconds of a step)."""
    whole, part = _seconds(window), _seconds(step)
    if whole % part:
        raise ValueError("the step must divide the window")
    return whole // part, part * 1_000_000


def _step_time(samples: DataFrame, ts: str, micros: int) -> Column:
    return F.timestamp_micros(F.col("_end") * F.lit(micros)).cast(samples.schema[ts].dataType).alias("step_ts")


def sliding_rate(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    window: str = "5 minutes",
    step: str = "1 minute",
    tie: str | None = None,
) -> DataFrame:
    """Per-second increase of a counter over the range that ends at every
    grid step, ``rate(x[5m])``: ``(series..., step_ts, rate, n_samples)``.

    A range is open on the left, closed on the right: (end - window, end].
    Increments are taken between consecutive samples inside it (a drop is a
    reset), without extrapolation to its edges, and divided by its length.  A
    range of fewer than two samples gives no row; a null value adds nothing.

    A slice of one step becomes a state (first, last, increase, count); states
    merge associatively.  Slices are cut into blocks of as many steps as the
    range has, so a range is the end of one block and the beginning of the
    next: running merges from both ends inside (series, block) partitions,
    put together per (series, step).  The cost doesn't depend on how often
    ranges overlap, and no task orders more than a slice's samples or a
    block's slices of one series.
    """
    steps, micros = _steps_in(window, step)
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])
    inside = Window.partitionBy(*series, "_end").orderBy(*order)
    df = samples.select(*series, *dict.fromkeys([ts, value] + ([tie] if tie else []))).withColumn("_end", _grid_end(ts, micros))
    df = df.withColumn("_inc", _increase(F.lag(value).over(inside), F.col(value)))
    slices = df.groupBy(*series, "_end").agg(
        F.min_by(value, F.struct(*order)).alias("_first"),
        F.max_by(value, F.struct(*order)).alias("_last"),
        F.coalesce(F.sum("_inc"), F.lit(0.0)).alias("_inc"),
        F.count(F.lit(1)).alias("_n"),
    )
    zero = F.lit(0.0)
    slices = slices.withColumn("_block", F.floor(F.col("_end") / F.lit(steps)) * F.lit(steps))  # its first step
    up = Window.partitionBy(*series, "_block").orderBy("_end")
    from_before = F.coalesce(_increase(F.lag("_last").over(up), F.col("_first")), zero)
    to_next = F.coalesce(_increase(F.col("_last"), F.lead("_first").over(up)), zero)
    slices = slices.withColumns(
        {
            "_up": F.col("_inc") + from_before,
            "_down": F.col("_inc") + to_next,
            "_until": F.coalesce(F.lead("_end").over(up) - 1, F.col("_block") + F.lit(steps - 1)),
            "_since": F.coalesce(F.lag("_end").over(up) + 1, F.col("_block") + 1),
        }
    )
    ahead = up.rowsBetween(Window.unboundedPreceding, 0)
    back = up.rowsBetween(0, Window.unboundedFollowing)

    def state(first: Column, last: Column, inc: Column, n: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), inc.alias("inc"), n.alias("n"))

    slices = slices.withColumns(
        {
            "_begun": state(F.first("_first").over(ahead), F.col("_last"), F.sum("_up").over(ahead), F.sum("_n").over(ahead)),
            "_ended": state(F.col("_first"), F.last("_last").over(back), F.sum("_down").over(back), F.sum("_n").over(back)),
        }
    )
    none = F.lit(None)

    def seen(ends: Column, newer: Column, older: Column) -> Column:
        return F.transform(ends, lambda e: F.struct(e.alias("end"), newer.alias("newer"), older.alias("older")))

    begun, ended = F.col("_begun"), F.col("_ended")
    shape = slices.schema["_begun"].dataType
    since, shift = F.greatest("_since", F.col("_block") + 1), F.lit(steps - 1)
    both = F.concat(
        seen(F.sequence("_end", "_until"), begun, none.cast(shape)),
        F.when(F.col("_end") >= since, seen(F.sequence(since + shift, F.col("_end") + shift), none.cast(shape), ended)).otherwise(F.array()),
    )
    parts = slices.select(*series, F.explode(both).alias("_s"))
    ranges = parts.groupBy(*series, F.col("_s.end").alias("_end")).agg(
        F.max("_s.newer").alias("_newer"), F.max("_s.older").alias("_older")  # at most one of each
    )
    newer, older = F.col("_newer"), F.col("_older")
    meet = F.coalesce(_increase(older["last"], newer["first"]), zero)
    increase = F.coalesce(older["inc"], zero) + F.coalesce(newer["inc"], zero) + meet
    n = F.coalesce(older["n"], F.lit(0)) + F.coalesce(newer["n"], F.lit(0))
    return ranges.where(n > 1).select(
        *series, _step_time(samples, ts, micros), (increase / F.lit(float(_seconds(window)))).alias("rate"), n.alias("n_samples")
    )


def instant_values(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    step: str = "30 seconds",
    lookback: str = "5 minutes",
    tie: str | None = None,
) -> DataFrame:
    """Value of each series at every grid step: its last sample of the
    look-back (step - lookback, step], ``(series..., step_ts, value,
    sample_ts)``.  After that long a silence a series is stale: no row.

    The last sample of each slice is carried forward to the next slice that
    has one, or to the end of its look-back, inside (series, block) partitions
    of as many steps as the look-back has; what the block before carries
    over is outbid per (series, step) by a newer one.
    """
    steps, micros = _steps_in(lookback, step)
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.struct(F.col(ts))
    slices = samples.groupBy(*series, _grid_end(ts, micros).alias("_end")).agg(
        F.max_by(F.struct(F.col(value).alias("value"), F.col(ts).alias("ts")), order).alias("_last")
    )
    block = F.floor(F.col("_end") / F.lit(steps))
    following = F.lead("_end").over(Window.partitionBy(*series, block).orderBy("_end"))
    stale = F.col("_end") + F.lit(steps - 1)
    carried = slices.withColumn("_until", F.least(F.coalesce(following - 1, stale), stale)).select(
        *series, F.col("_end").alias("_from"), "_last", F.explode(F.sequence("_end", "_until")).alias("_end")
    )
    newest = carried.groupBy(*series, "_end").agg(F.max_by("_last", "_from").alias("_last"))
    return newest.select(*series, _step_time(samples, ts, micros), F.col("_last.value").alias(value), F.col("_last.ts").alias("sample_ts"))


def alert_changes(
    samples: DataFrame,
    series: Sequence[str],
    threshold: float,
    hold: str = "5 minutes",
    ts: str = "ts",
    value: str = "value",
    step: str = "1 minute",
    lookback: str = "5 minutes",
    tie: str | None = None,
) -> DataFrame:
    """State changes of an alert "above ``threshold`` for ``hold``",
    ``(series..., step_ts, state)``, evaluated at every grid step.

    Above the threshold (instant value, ``instant_values``) an alert is
    ``pending``, and ``firing`` from the step at which it has been pending for
    ``hold``; at the first step that is not above, or where the series is
    stale, it is ``inactive``.  A null value is not above.

    Between two changes nothing happens but "still above", so the machine's
    steps compose: runs of consecutive steps above are joined slice by slice
    (``sustained_threshold``), and each run gives its two or three changes.
    """
    period, held = _seconds(step), _seconds(hold)
    values = instant_values(samples, series, ts, value, step, lookback, tie)
    runs = sustained_threshold(
        values, series, threshold, 0, "step_ts", value, slice_seconds=3600, max_gap_seconds=period
    )
    wait = -(-held // period) * period  # the first step at which ``hold`` is over
    at = lambda c, seconds: F.col(c) + F.expr(f"interval {seconds} seconds")
    change = lambda when, state: F.struct(when.alias("step_ts"), F.lit(state).alias("state"))
    firing = F.when(at("start_ts", wait) <= F.col("end_ts"), change(at("start_ts", wait), "firing"))
    pending = [change(F.col("start_ts"), "pending")] if wait else []
    changes = F.array_compact(F.array(*pending, firing, change(at("end_ts", period), "inactive")))
    return runs.select(*series, F.explode(changes).alias("_c")).select(*series, "_c.step_ts", "_c.state")


def sustained_threshold(
    samples: DataFrame,
    series: Sequence[str],
    threshold: float,
    min_duration_seconds: int = 300,
    ts: str = "ts",
    value: str = "value",
    tie: str | None = None,
    slice_seconds: int = 60,
    max_gap_seconds: int | None = None,
) -> DataFrame:
    """Runs of consecutive samples above ``threshold`` lasting at least
    ``min_duration_seconds`` (last minus first sample time).

    ``max_gap_seconds`` ends a run where the next sample is further away than
    that; ``None`` lets a run span any silence.  A null value is not above
    the threshold; a series with null labels is a series.

    Gaps and islands without ordering a series in one task.  Samples are
    ordered inside (series, slice) partitions of ``slice_seconds`` only and
    become stretches.  A stretch that holds neither the first nor the last
    sample of its slice is complete; the others, two a slice at most, are
    joined inside (series, day) partitions, and the first and last of each
    day across days.  Complete stretches pass by in partitions of their own.
    The samples are scanned once, and nothing is joined back.

    Returns ``(series..., start_ts, end_ts, n_samples)``.
    """
    if slice_seconds < 1 or 86400 % slice_seconds:
        raise ValueError("slice_seconds must divide a day")
    order_cols = [ts] + ([tie] if tie else [])
    gap = F.lit(None).cast("long") if max_gap_seconds is None else F.lit(max_gap_seconds * 1_000_000)
    df = samples.select(
        *series,
        *dict.fromkeys(order_cols),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_from"),
        _slice(ts, slice_seconds).alias("_slice"),
        F.coalesce(F.col(value) > F.lit(threshold), F.lit(False)).alias("_above"),
    )
    df = df.withColumns(
        {"_to": F.col("_from"), "start_ts": F.col(ts), "end_ts": F.col(ts), "n_samples": F.lit(1).cast("long"),
         "_first": F.lit(True), "_last": F.lit(True), "_done": F.lit(None).cast(_DONE)}
    )
    stretches = _joined(df, series, ["_slice"], order_cols, gap, 0)
    stretches = stretches.withColumn("_day", F.floor(F.col("_slice") * F.lit(slice_seconds) / F.lit(86400)))
    days = _joined(stretches.withColumnRenamed("_run", "_part"), series, ["_day"], ["_slice", "_part"], gap, 1)
    runs = _joined(days.withColumnRenamed("_run", "_day_run"), series, [], ["_day", "_day_run"], gap, 2)
    span = F.col("_to") - F.col("_from")
    runs = runs.filter(F.col("_above") & (span >= F.lit(min_duration_seconds * 1_000_000)))
    return runs.select(*series, "start_ts", "end_ts", "n_samples")


#: Name of a complete stretch of samples: level, container, number.
_DONE = "struct<level:int,c:bigint,n:bigint>"


def _joined(parts: DataFrame, series: Sequence[str], inside: Sequence[str], order: Sequence[str], gap: Column, level: int) -> DataFrame:
    """Parts joined with the one before where both are above, they meet (the
    last of its container and the first of the next) and no gap lies between.

    ``_done`` names a complete part (level, container, number) and is null for
    an open one, so that a complete part has a partition of its own.  Of the
    result, ``_first`` and ``_last`` say whether a run is the first or last of
    its container, which keeps it open; the other runs are complete, and
    those not above the threshold go."""
    keys = [*series, *inside, "_done"]
    w = Window.partitionBy(*keys).orderBy(*order)
    far = F.coalesce(F.col("_from") - F.lag("_to").over(w) > gap, F.lit(False))
    meets = F.col("_above") & F.lag("_above").over(w) & F.lag("_last").over(w) & F.col("_first") & ~far
    new = F.when(F.coalesce(meets, F.lit(False)), 0).otherwise(1)
    numbered = parts.withColumn("_run", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(*keys, "_run", "_above").agg(
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("n_samples").alias("n_samples"),
    )
    whole = Window.partitionBy(*keys)
    first, last = F.col("_run") == F.min("_run").over(whole), F.col("_run") == F.max("_run").over(whole)
    runs = runs.withColumns({"_first": first, "_last": last})
    if inside:
        name = F.struct(F.lit(level).alias("level"), F.col(inside[0]).cast("long").alias("c"), F.col("_run").cast("long").alias("n"))
        inner = ~(F.col("_first") | F.col("_last"))
        runs = runs.withColumn("_done", F.coalesce(F.col("_done"), F.when(inner, name).cast(_DONE)))
    return runs.filter(F.col("_above") | F.col("_done").isNull())
