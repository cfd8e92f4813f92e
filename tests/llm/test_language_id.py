"""Language identification: sums over all cuts by brute force, held-out accuracy."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from feedlake.llm import language_id as li
from feedlake.llm.common import table


def cuts(word):
    for n in range(len(word)):
        for places in itertools.combinations(range(1, len(word)), n):
            edges = (0, *places, len(word))
            yield [word[a:b] for a, b in itertools.pairwise(edges)]


@pytest.fixture(scope="module")
def small():
    pieces = ["▁", "a", "b", "▁a", "ab", "ba", "aba", "▁ab", "bb"]
    voc = li.Vocabulary(pieces, ["x"] * 256)
    rng = np.random.default_rng(2)
    return voc, np.log(rng.dirichlet(np.ones(voc.size), size=3))


WORDS = ["a", "abab", "bbabab", "abc", "é", "aab", "b" * 9]


def brute_total(voc, log_p, word):
    total = 0.0
    for cut in cuts(voc.spell("▁" + word)):
        numbers = [voc.numbers.get(c, -1) for c in cut]
        if min(numbers) >= 0:
            total += math.exp(sum(log_p[n] for n in numbers))
    return math.log(total)


def test_forward_sums_all_cuts(small):
    voc, log_p = small
    lattice = li.Lattice(WORDS, voc)
    got = lattice.totals(log_p.T[lattice.piece])
    for at, word in enumerate(WORDS):
        for lang in range(3):
            assert got[at, lang] == pytest.approx(brute_total(voc, log_p[lang], word))


def test_expected_counts(small):
    voc, log_p = small
    lattice = li.Lattice(WORDS, voc)
    total, uses = lattice.expected(log_p[0][lattice.piece])
    got = np.zeros((len(WORDS), voc.size))
    np.add.at(got, (lattice.word, lattice.piece), uses)
    for at, word in enumerate(WORDS):
        want = np.zeros(voc.size)
        for cut in cuts(voc.spell("▁" + word)):
            numbers = [voc.numbers.get(c, -1) for c in cut]
            if min(numbers) >= 0:
                np.add.at(want, numbers, math.exp(sum(log_p[0][n] for n in numbers) - total[at]))
        assert got[at] == pytest.approx(want)


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy_and_rising_likelihood(spark, sf_dir):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = li.train(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 != 1"))
    assert model.languages == ["de", "en", "es", "fr"]
    assert all(b > a for a, b in itertools.pairwise(model.history))
    assert np.exp(model.log_p).sum(axis=1) == pytest.approx(np.ones(4))
    got = li.language_report(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows)
    out = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) > 0.97 * len(out)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, lang_pred string")


def test_odd_rows(spark):
    rng = random.Random(1)
    say = {"xx": ["alpha", "beta", "gamma"], "yy": ["uno", "due", "tre"]}
    rows = [(i, " ".join(rng.choices(say[lang], k=8)), lang, "s", "p") for i in range(40) for lang in say]
    odd = [None, "", "  ", "12 34 !", "uno due", "ALPHA", "漢字", "beta " * 3000, "u" * 5000, "tre\x00tre"]
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate(odd)]
    rows += [(None, "alpha beta", "xx", None, None)] * 2 + [(2000, None, "zz", None, None)]
    got = {(r.doc_id, r.lang_pred) for r in li.language_report(labelled(spark, rows)).collect()}
    for i, t in enumerate(odd[:4]):
        assert (1000 + i, "und") in got, t
    assert {(1004, "yy"), (1007, "xx"), (None, "xx"), (2000, "und")} <= got
    assert all(lang in ("xx", "yy", "und") for _, lang in got)  # a language without a word is not learned
    report = li.language_report(labelled(spark, rows))
    assert report.count() == len(rows) and report.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert {r.held_out for r in report.where("doc_id is null").collect()} == {False}


def test_nothing_learned_and_empty_table(spark):
    rows = li.language_report(labelled(spark, [(1, "abc", None, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert li.language_report(labelled(spark, [])).collect() == []
    with pytest.raises(ValueError):
        li.train(labelled(spark, [(1, "a", "x", None, None), (2, "a", "y", None, None)]), max_languages=1)


def test_slices_and_forgotten_words_change_nothing(monkeypatch):
    model = li.Model(["x", "y"], np.log([0.5, 0.5]), np.log(np.random.default_rng(0).dirichlet(np.ones(li.vocabulary().size), 2)), [])
    text = " ".join(random.Random(3).choices(["one", "two", "three", "q" * 700, "çé"], k=300))
    want = li.Scorer(model).score([text, "one two"])
    monkeypatch.setattr(li, "PIECE", 50)
    monkeypatch.setattr(li, "FLUSH_WORDS", 7)
    monkeypatch.setattr(li, "CACHE_WORDS", 9)
    monkeypatch.setattr(li, "CELLS", 500)
    # runs over PIECE may be cut elsewhere, so only texts of shorter ones here
    assert li.Scorer(model).score(["one two"])[0] == pytest.approx(want[1])
    short = text.replace("q" * 700, "qq")
    monkeypatch.undo()
    whole = li.Scorer(model).score([short])
    monkeypatch.setattr(li, "PIECE", 50)
    monkeypatch.setattr(li, "FLUSH_WORDS", 7)
    monkeypatch.setattr(li, "CACHE_WORDS", 9)
    assert li.Scorer(model).score([short]) == pytest.approx(whole)
