import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from feedlake.llm import hmm_lm, quality_qda


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# --- quality classifier ----------------------------------------------------------


def labelled():
    rnd = random.Random(3)
    rows, labels = [], []
    for d in range(400):
        words = [rnd.choice("the of and river mountain quiet early letter house".split()) for _ in range(rnd.randint(30, 200))]
        good = d % 4 != 0
        text = " ".join(words) if good else " ".join(w.upper() + rnd.choice(["!!", "$$", "***"]) for w in words)
        rows.append((d, text))
        labels.append((d, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_inputs(spark, docs_of):
    rows, labels = labelled()
    table = spark.createDataFrame([*labels, (None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of([*rows, (9000, None), (9001, ""), (9001, ""), (None, "x")]).withColumnRenamed("lang", "score")
    got = quality_qda.quality_scores(docs, table).collect()
    assert len(got) == 404
    truth = dict((d, q) for d, q, _ in labels)
    for r in got:
        assert r.held_out == (r.doc_id is not None and fold(r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    # held-out labels, lang and source change nothing
    flipped = spark.createDataFrame([(d, 1 - q if fold(d, 3) == 1 else q, 0) for d, q, _ in labels], "doc_id long, quality int, toxic int")
    again = quality_qda.quality_scores(docs_of([(d, t, f"s{d % 7}") for d, t in rows]), flipped).collect()
    mine = {r.doc_id: r.score for r in got if r.doc_id is not None and r.doc_id < 400}
    assert all(math.isclose(mine[r.doc_id], r.score, rel_tol=1e-9, abs_tol=1e-12) for r in again)


def test_scores_without_labels(spark, docs_of):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality_qda.quality_scores(docs_of([(1, "a b"), (2, None)]), empty).collect()] == [0.5, 0.5]
    assert quality_qda.quality_scores(docs_of([]), empty).collect() == []


def test_discriminant_equals_direct_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(500, 3)) @ np.diag([1, 2, 3]), rng.normal(size=(300, 3)) + 2]
    n = np.array([len(v) for v in x], dtype=float)
    model = quality_qda.fit_moments(n, np.array([v.sum(axis=0) for v in x]), np.array([v.T @ v for v in x]))
    cov, logs = [], []
    for v in x:
        z = (v - model.centre) / model.scale
        cov.append(np.cov(z.T, bias=True))
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    points = rng.normal(size=(20, 3)) * 2
    z = (points - model.centre) / model.scale
    for c in (0, 1):
        s = (1 - quality_qda.TO_POOLED) * cov[c] + quality_qda.TO_POOLED * pooled
        s = (1 - quality_qda.TO_DIAGONAL) * s + quality_qda.TO_DIAGONAL * np.diag(np.diag(s)) + 1e-6 * np.eye(3)
        mean = ((x[c] - model.centre) / model.scale).mean(axis=0)
        d = z - mean
        logs.append(np.log(n[c] / n.sum()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert np.allclose(model.score(points), 1 / (1 + np.exp(logs[0] - logs[1])))


# --- language model --------------------------------------------------------------


def lm_rows():
    rnd = random.Random(12)
    worlds = [["le", "la", "maison", "eau"], ["the", "house", "water", "of"], ["das", "haus", "und", "wasser"]]
    rows = [(d, " ".join(rnd.choice(worlds[d % 3]) + rnd.choice(["", "", "s"]) for _ in range(rnd.randint(0, 60)))) for d in range(300)]
    return [*rows, (500, None), (501, ""), (502, "zzz The\x0bLA " + "w" * 100), (503, "w" * 100), (0, rows[0][1]), (None, "la la")]


def brute_base(rows):
    def tokens(t):
        return [*(t or "").encode().lower().split(), None]

    counts = Counter(w for d, t in rows if d is None or fold(d, 5) != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        ws = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((d, d is not None and fold(d, 5) == 1, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("top_words", [50_000, 5])
def test_base_score_equals_brute_force_and_model_beats_it(docs_of, top_words):
    rows = lm_rows()
    docs = docs_of(rows).withColumnRenamed("lang", "classes")
    got = hmm_lm.text_scores(docs, top_words=top_words, states=4).collect()
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)
    assert mine == brute_base(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_equals_sum_over_paths():
    rng = np.random.default_rng(5)
    k, c = 3, 6
    model = hmm_lm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T)
    seqs = [rng.integers(0, c, n) for n in (1, 2, 5, 7, 5)]
    for seq, log in zip(seqs, model.log_likelihoods(seqs), strict=True):
        total = 0.0
        for path in np.ndindex(*[k] * len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        assert math.isclose(log, math.log10(total), rel_tol=1e-9)


def test_long_texts_in_pieces_equal_one_recursion(monkeypatch):
    rng = np.random.default_rng(6)
    k, c = 4, 9
    model = hmm_lm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T)
    seqs = [rng.integers(0, c, n) for n in (1000, 33, 32, 2111)]
    whole = model.log_likelihoods(seqs)
    monkeypatch.setattr(hmm_lm, "EXACT", 32)
    assert np.allclose(model.log_likelihoods(seqs), whole, rtol=1e-10)


def test_baum_welch_counts_and_rising_likelihood():
    rng = np.random.default_rng(2)
    c = hmm_lm.CLASSES
    seqs = [rng.integers(0, 50, n) if i % 2 else rng.integers(50, 99, n) for i, n in enumerate([40, 3, 700, 90, 1, 300])]
    share = np.bincount(np.concatenate(seqs), minlength=c) + 0.5
    share = share / share.sum()
    model, k = hmm_lm.first_guess(seqs, 3, share, rounds=0), 3
    logs = []
    for _ in range(8):
        counts = model.expected(seqs)
        tokens = sum(map(len, seqs))
        assert math.isclose(counts[k + k * k :].sum(), tokens, rel_tol=1e-4)
        assert math.isclose(counts[:k].sum(), len(seqs), rel_tol=1e-4)
        logs.append(model.log_likelihoods(seqs).sum())
        model = hmm_lm.maximise(counts, k, share)
        assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)
    assert logs[-1] > logs[0]


def test_expected_counts_of_whole_long_texts(monkeypatch):
    rng = np.random.default_rng(8)
    k, c = 3, 9
    model = hmm_lm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T)
    seqs = [rng.integers(0, c, n) for n in (700, 1, 256, 257, 1200, 2)]
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((c, k))
    for seq in seqs:
        alpha, beta = [model.start * model.emit[seq[0]]], [np.ones(k)]
        alpha[0] = alpha[0] / alpha[0].sum()
        for x in seq[1:]:
            now = alpha[-1] @ model.move * model.emit[x]
            alpha.append(now / now.sum())
        for x in seq[:0:-1]:
            now = model.move @ (model.emit[x] * beta[-1])
            beta.append(now / now.sum())
        beta.reverse()
        for t, x in enumerate(seq):
            gamma = alpha[t] * beta[t] / (alpha[t] * beta[t]).sum()
            emits[x] += gamma
            starts += gamma if t == 0 else 0
            if t:
                both = alpha[t - 1][:, None] * model.move * (model.emit[x] * beta[t])
                moves += both / both.sum()
    want = np.concatenate([starts, moves.ravel(), emits.ravel()])
    assert np.allclose(model.expected(seqs), want, rtol=1e-4)
    monkeypatch.setattr(hmm_lm, "BLOCK", 100)
    assert np.allclose(model.expected(seqs), want, rtol=1e-4)


def test_pairs_of_whole_texts():
    rng = np.random.default_rng(4)
    seqs = [rng.integers(0, hmm_lm.CLASSES, n) for n in (1, 2, 3000, 1, 40)]
    want, group = np.zeros((hmm_lm.CLASSES, hmm_lm.GROUPS)), hmm_lm.group_of()
    for seq in seqs:
        for a, b in zip(seq[:-1], seq[1:], strict=True):
            want[a, group[b]] += 1
    assert (hmm_lm.pair_counts(seqs) == want).all()
    assert hmm_lm.pair_counts([]).sum() == 0


def test_scores_do_not_depend_on_the_files(docs_of):
    rnd = random.Random(9)
    worlds = [["le", "la", "maison", "eau"], ["the", "house", "water", "of"], ["das", "haus", "und", "wasser"]]
    rows = [(d, " ".join(rnd.choice(worlds[d % 3]) for _ in range(20))) for d in range(1500)]
    docs = docs_of(rows)
    one, other = (
        {r.doc_id: r.score for r in hmm_lm.text_scores(d, states=4, rounds=1).collect()}
        for d in (docs.coalesce(1), docs.repartition(3, "doc_id"))
    )
    assert all(math.isclose(one[d], other[d], rel_tol=1e-6) for d, _ in rows)


def test_language_model_without_training_text(docs_of):
    assert hmm_lm.text_scores(docs_of([])).collect() == []
    only = next(d for d in range(100) if fold(d, 5) == 1)
    (row,) = hmm_lm.text_scores(docs_of([(only, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert math.isclose(row.base_score, 0.0, abs_tol=1e-9) and math.isfinite(row.score)


def test_hmm_scales_rarely_and_remembers_endings():  # op2: the same scores and classes in fewer steps
    import numpy as np

    from feedlake.llm import hmm_lm

    rng = np.random.default_rng(3)
    emit, move = rng.gamma(0.3, size=(50, 4)) + 1e-17, rng.random((4, 4))
    model = hmm_lm.Hmm(np.full(4, 0.25), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    seqs = [rng.integers(0, 50, n) for n in (1, 7, 8, 9, 16, 17, 300, hmm_lm.EXACT + 70)]
    want = []
    for seq in seqs:  # a step at a time, scaled at each
        state, log = model.start, 0.0
        for t, c in enumerate(seq):
            state = (state if t == 0 else state @ model.move) * model.emit[c]
            log += np.log10(state.sum())
            state = state / state.sum()
        want.append(log)
    assert np.allclose(model.log_likelihoods(seqs), want, rtol=1e-12)
    rare = np.full((50, 4), 3e-18)  # as rare as classes get: nothing underflows
    assert np.allclose(hmm_lm.Hmm(model.start, model.move, rare).log_likelihoods([np.zeros(9, int)]), [9 * np.log10(3e-18)])
    before = hmm_lm._class_of.cache_info().misses
    keys = [b"w%dxyz" % n for n in range(1000, 3000)]
    assert len({hmm_lm.ending_class(k) for k in keys}) == 1
    assert hmm_lm._class_of.cache_info().misses - before <= 1
