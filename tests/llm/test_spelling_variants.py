"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from feedlake.llm import spelling_variants as sv


def brute_counts(rows, every=97, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode()) & 0xFFFFFFFF
                if h % every == 0:
                    i = h % len(run)
                    run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if counts[b] >= ratio * counts[w]}
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, f, root, n, len(near[w]), counts[f] if f else None))
    return out


def found(spark, docs_of, rows, **kw):
    got = sv.variants(docs_of(rows), **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, n_words, alphabet, lengths, docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(n_words)]
    words = []
    for w in base:
        words += [w] * rng.randint(1, 12)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            c = rng.choice(alphabet)
            words += [rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])] * rng.randint(2, 6)
    rng.shuffle(words)
    cut = [words[i::docs] for i in range(docs)]
    return [(i, rng.choice(["", "  "]) + " ,\n".join(w.title() if rng.random() < 0.2 else w for w in ws)) for i, ws in enumerate(cut)]


@pytest.mark.parametrize("max_words, long_word", [(8000, 64), (12, 64), (12, 8), (1, 6)])
def test_equals_brute_force(spark, docs_of, max_words, long_word):
    rows = texts(5, 120, "abé", (5, 6, 7, 8, 9), docs=40)
    counts = brute_counts(rows)
    expected = brute(counts)
    assert sum(r[1] is not None for r in expected) > 30 and any(r[1] and r[2] != r[1] for r in expected)
    assert found(spark, docs_of, rows, max_words=max_words, long_word=long_word) == expected


def test_odd_rows_and_very_long_runs(spark, docs_of):
    long = "ab" * 400
    rows = [
        (None, "colour color colour colour color color"), (1, None), (2, ""), (3, "123 ... œ中"), (None, None),
        (4, "naïve naive NAIVE Naive naïve naïve Àbcde Àbcde Àbcde àbcde"),
        (5, "x×yab x×yab x×yab aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa"),
        (6, f"{long} {long}c {long[1:]} " * 3), (6, f"{long} {long}c {long[1:]} " * 3),
        (7, ("q" * 64 + " " + "q" * 65 + " " + "q" * 66 + " ") * 4),
        (8, " ".join(["colou中r", "favourite"] * 3)),
    ]
    counts = brute_counts(rows)
    assert any(len(w) > 700 for w in counts)
    assert found(spark, docs_of, rows) == brute(counts)


def test_texts_longer_than_a_piece(spark, docs_of, monkeypatch):
    rows = texts(9, 30, "abc", (5, 6), docs=1)
    total = {}
    monkeypatch.setattr(sv, "PIECE", 40)
    sv.count_runs(total, 0, rows[0][1])
    assert {w.decode("latin-1"): n for w, n in total.items() if len(w) >= 5 and n >= 3} == brute_counts(rows)


def test_empty_table(spark, docs_of):
    assert found(spark, docs_of, []) == set()


def test_machine_is_minimal_and_lists_each_pair_once():
    rng = random.Random(1)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(150)}
    machine = sv.PartMachine(list(words))
    pairs = [frozenset(p) for p in machine.pairs()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    rests = set()  # one state for each set of rests that some prefix leaves
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    for p in prefixes:
        rests.add(frozenset(w[len(p) :] for w in words if w.startswith(p)))
    assert len(machine.arcs) == len(rests)
