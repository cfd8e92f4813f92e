"""Hard negatives against brute force, and the bounds that filter them."""

from collections import Counter, defaultdict
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from feedlake.llm import hard_negatives as hn

SCHEMA = StructType(
    [
        StructField("vec_id", LongType()),
        StructField("embedding", ArrayType(FloatType())),
        StructField("label", IntegerType()),
        StructField("rank", StringType()),  # a name that the result uses, too
        StructField("id", StringType()),
    ]
)


def brute(rows, every=10):
    usable = []
    for key, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not isfinite(x) for x in vector):
            continue
        usable.append((key, [floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    place = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for key, vector, label in usable:
        if key is None or key % every:
            continue
        others = [(k, sum(a * b for a, b in zip(vector, v)), lab) for k, v, lab in usable if k != key]
        positives = sorted((r for r in others if r[2] == label), key=place)[:5]
        for p in positives:
            fits = [r for r in others if r[2] != label and 80 * p[1] <= 100 * r[1] <= 100 * p[1]]
            for rank, n in enumerate(sorted(fits, key=place)[:5], 1):
                out.append((key, p[0], rank, n[0], p[1], n[1]))
    return Counter(out)


def mined(spark, rows, every=10, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = hn.mine(df, F.col("vec_id") % every == 0, F.col("label"), **kw)
    return Counter(map(tuple, got.collect()))


def vectors(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    found = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))
    return (found / np.linalg.norm(found, axis=1, keepdims=True)).astype(np.float32)


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_brute_force_in_several_groups(spark, spread):
    rng = np.random.default_rng(3)
    data = vectors(600, 8, 1, spread)
    rows = [(i, [float(x) for x in v], int(rng.integers(0, 4))) for i, v in enumerate(data)]
    expected = brute(rows)
    assert sum(expected.values()) > 500
    assert mined(spark, rows) == expected
    assert mined(spark, rows, group_bytes=8 * 8 * 7) == expected


def test_nulls_ties_repeats_and_odd_vectors(spark):
    e = [[1.0, 0.5], [1.0, 0.5], [0.9, 0.5], [0.0, 0.0], [], [1.0], [-1.0, -0.5], [0.7, 0.9, 3.0]]
    rows = [(i, e[i % len(e)], i % 3) for i in range(60)]
    rows += [(10, e[0], 1), (10, e[0], 1), (10, e[2], 2), (11, e[0], 0), (11, e[0], 0)]  # repeated ids and rows
    rows += [(None, e[0], 0), (None, e[0], 2), (70, None, 1), (71, e[0], None), (80, [1.0, None], 1)]
    rows += [(90, [float("nan"), 1.0], 1), (91, [float("inf"), 1.0], 0), (-100, e[2], 1)]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_double_precision(spark):
    big = [[1e6, 1.0], [1e6, 0.75], [0.9e6, 5.0], [0.85e6, -3.0], [1e6, 1.25]]
    rows = [(i, big[i % 5], i % 2) for i in range(40)]
    expected = brute(rows)
    assert max(k[4] for k in expected) > 1 << 53
    assert mined(spark, rows) == expected


def test_scores_beyond_a_long_are_clamped(spark):
    got = mined(spark, [(i, [3e7, float(i % 2)], i % 2) for i in range(40)])
    assert got and {k[4:] for k in got} == {(hn.LONG_MAX, hn.LONG_MAX)}


def test_empty_table_and_no_anchor(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, [1.0], 0), (2, [1.0], 1)])


def blocks_of(data, labels):
    raw = np.floor(256 * data.astype(float))
    refs = hn.choose_references(raw[:200])
    return list(hn._blocks_of([(i, int(x), v) for i, (v, x) in enumerate(zip(raw, labels))], refs))


@pytest.mark.parametrize("spread", [0.01, 0.3, 3.0])
def test_bounds_hold_every_score(spread):
    data = vectors(400, 16, 5, spread)
    blocks = blocks_of(data, np.zeros(400))
    anchors = hn.join_blocks(blocks).rows(slice(0, 60))
    for rows in blocks:
        low, high = hn.score_bounds(anchors, rows)
        exact = anchors.vectors @ rows.vectors.T
        assert (low <= exact).all() and (exact <= high).all()
        block_low, block_high = hn.block_bounds(anchors, rows)
        assert (block_low <= exact.min(axis=1)).all() and (exact.max(axis=1) <= block_high).all()


def test_only_overlapping_windows_are_scored(monkeypatch):
    data = vectors(4000, 16, 7, 0.05)
    labels = np.arange(4000) % 2
    blocks = blocks_of(data, labels)
    group = hn.join_blocks(blocks).rows(slice(0, 4000, 100))
    scored = defaultdict(int)
    plain = hn.scores_of

    def counted(anchors, rows, a, b):
        scored["n"] += len(a)
        return plain(anchors, rows, a, b)

    monkeypatch.setattr(hn, "scores_of", counted)
    hn.find_positives(group, iter(blocks), 5)
    assert scored["n"] < 0.5 * len(group) * 4000 / 2  # less than half of the pairs of equal labels
