import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedlake.llm import decontam, quality_rules, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules -------------------------------------------------------------


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
    )


def rule_texts():
    rnd = random.Random(1)
    made = [" ".join(rnd.choice("a b c dé x# <y>".split()) for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    return [*made, None, "", " \n\t ", "a b \x1c c", "l\nl\n\nl\n \n", "one two three four five " * 30, "x" * 50_000]


def test_measures_equal_brute_force():
    texts = rule_texts()
    got = list(zip(*quality_rules.measures()([t or "" for t in texts]), strict=True))
    assert [tuple(map(int, g)) for g in got] == [brute_rules(t) for t in texts]


def test_rule_report_and_stage_agree(docs_of):
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(rule_texts())] + [(0, "x", None), (None, "y " * 20, "s1")]
    docs = docs_of(rows)
    report = quality_rules.rule_report(docs)
    assert report.count() == len(rows)
    got = {r.doc_id: r for r in report.where("doc_id IS NOT NULL AND doc_id > 0").collect()}
    for i, t, _ in rows[1:-2]:
        n, chars, symbols, lines, repeats = brute_rules(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (r.base_failed and r.kept)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == report.where("kept").count()


def test_host_verdict_is_strict_only_for_failing_hosts(docs_of):
    good = " ".join(f"word{i}" for i in range(30))
    marked = good + " " + "### " * 9
    rows = [(i, "bad", "junk.example") for i in range(40)] + [(100, good, "junk.example"), (101, marked, "junk.example")]
    rows += [(200 + i, good, "fine.example") for i in range(40)] + [(300, good + " #" * 4, "fine.example"), (301, good + " #" * 5, "fine.example")]
    kept = {r.doc_id for r in quality_rules.rule_report(docs_of(rows)).where("kept").collect()}
    assert 100 in kept and 101 not in kept  # a clean document of a bad host stays
    assert {300, 301} <= kept


def host_corpus(shares, size=60):
    """Hosts whose documents fail at the given shares; each other document is
    good, every fifth of those with many symbols."""
    good = " ".join(f"word{i}" for i in range(30))
    rows = []
    for h, share in enumerate(shares):
        for i in range(size):
            text = "too short" if i < share * size else good + (" ####" if i % 5 else "")
            rows.append((h * size + i, text, f"h{h}.example"))
    return rows


def test_the_prior_decides_which_hosts_are_bad(docs_of):
    shares = [0.05, 0.08, 0.1, 0.06, 0.04, 0.09, 0.07, 0.05, 0.6, 0.5]
    rows = host_corpus(shares)
    report = quality_rules.rule_report(docs_of(rows)).where("kept != (NOT base_failed)").collect()
    assert {r.doc_id // 60 for r in report} == {8, 9}  # the method changes documents of the bad hosts only
    assert len(report) == sum(t.endswith("####") for _, t, h in rows if h in ("h8.example", "h9.example"))
    assert all(100 * r.n_symbols > 10 * r.n_words for r in report)
    # hosts that differ by chance only: none is bad, whatever their rate
    for share in (0.1, 0.4):
        alike = host_corpus([share + d for d in (0, 0.03, -0.03, 0.02, -0.02, 0.01)])
        assert quality_rules.rule_report(docs_of(alike)).where("kept != (NOT base_failed)").count() == 0


def test_rules_on_empty_and_clashing_tables(docs_of):
    docs = docs_of([(1, "a " * 30), (2, None)]).withColumnRenamed("lang", "kept").withColumnRenamed("n_chars", "_rule_0")
    assert quality_rules.rule_report(docs).count() == 2
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.rule_report(docs.limit(0)).collect() == []
    assert quality_rules.keep_good(docs.limit(0)).collect() == []


# --- SimHash -------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """component id per row index, over fingerprints within 3 bits."""
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return prints, [best.get(find(i)) for i in range(len(rows))]


def copies(n=120):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    rows, d = [], 0
    for _ in range(n // 6):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(60, 250))]
        for _ in range(6):
            near = list(words)
            if rnd.random() < 0.7:
                near[rnd.randrange(len(near))] = rnd.choice(vocab)
            rows.append((d, " ".join(near)))
            d += 1
    rnd.shuffle(rows)
    return [*rows, (900, None), (899, ""), (901, "Two words"), (902, "two WORDS"), (None, "two words"), (3, rows[0][1])]


def test_components_equal_brute_force(docs_of):
    rows = copies()
    prints, ids = brute_components(rows)
    want = Counter((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, ids, strict=True))
    got = simhash.near_duplicates(docs_of(rows))
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_keys_meet_through_balls(spark, hot):
    """The exact way for hot keys gives the same components as the join."""
    rnd = random.Random(hot)
    values = set()
    for _ in range(12):
        value = rnd.getrandbits(64)
        for _ in range(8):
            values.add(value)
            for _ in range(rnd.randint(1, 4)):
                value ^= 1 << rnd.randrange(64)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")

    def classes(df):
        groups = {}
        for r in simhash.components(df).collect():
            groups.setdefault(r.root, set()).add(r.node)
        return sorted(map(sorted, groups.values()))

    plain = classes(simhash.near_links(prints))
    assert classes(simhash.near_links(prints, hot_bucket=hot)) == plain
    for count in simhash.PARTITION_COUNTS:
        assert classes(simhash.near_links(prints, counts=(count,))) == plain
    root = {v: v for v in signed}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = {}
    for v in signed:
        groups.setdefault(find(v), set()).add(v)
    assert sorted(sorted(g) for g in groups.values() if len(g) > 1) == plain


def test_thresholds_cover_the_pigeonhole():
    cost, units = simhash.allot([[0, 5, 9, 30, 90], [0, 1, 2, 3, 4], [0, 50, 60, 70, 80]], 4)
    assert (cost, units) == (4.0, [0, 4, 0])
    assert simhash.allot([[0, 1, 9, 99, 999]] * 4, 4)[1] == [1, 1, 1, 1]
    groups = simhash.group_bits(100, np.full((64, 64), 25.0) + np.eye(64) * 25, 5)
    assert sorted(b for g in groups for b in g) == list(range(64))


def test_keep_one_of_each_component(docs_of):
    rows = copies()
    _, ids = brute_components(rows)
    docs = docs_of(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(set(ids))
    twins = docs_of([(5, "same text here"), (5, "same text here"), (5, "other words now and then"), (None, "same text here")])
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(twins).collect()) == [
        (5, "other words now and then"), (5, "same text here"),
    ]
    assert simhash.keep_one(docs.limit(0)).collect() == []
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


# --- decontamination -----------------------------------------------------------


def brute_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items, window=13):
    words, hit, found = brute_words(text), set(), set()
    for item, body in items:
        ws = brute_words(body)
        for s in range(max(1, len(ws) - window + 1) if ws else 0):
            part = ws[s : s + window]
            for i in range(len(words) - len(part) + 1):
                if words[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def overlap_case():
    rnd = random.Random(6)
    vocab = [f"t{i}" for i in range(30)] + ["é", "x1"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 3, 12, 13, 14, 30])))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "..."), (None, "t1 t2"), (3, "T5, t6; t7 t8 t9 t10 t11 t12 t13 t14 t15 t16 t17 t18")]
    rows = []
    for d in range(80):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        if d % 2:
            words += brute_words(items[rnd.randrange(25)][1])[: rnd.randint(1, 30)] * rnd.randint(1, 2)
        rows.append((d, " ".join(w.upper() if rnd.random() < 0.1 else w for w in words)))
    return [*rows, (100, None), (101, ""), (102, "..."), (7, rows[7][1])], items


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 40])
def test_hits_equal_brute_force(spark, docs_of, block_words):
    rows, items = overlap_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.report(docs_of(rows), benchmark, block_words=block_words).collect()
    want = Counter()
    for d, t in rows:
        n, hit, found = brute_hits(t, [i for i in items if i[0] is not None])
        sha = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert sha == decontam.digest(found)
        want[(d, n, hit, len(found), sha, hit > 0 and 20 * hit >= n)] += 1
    assert Counter(map(tuple, got)) == want


def test_clean_documents_keeps_columns(spark, docs_of):
    rows, items = overlap_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "_decontam_hit")
    clean = decontam.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    marked = decontam.report(docs.withColumn("n_hit", F.lit("x")), benchmark)
    assert clean.count() == marked.where("NOT contaminated").count()
    assert decontam.clean_documents(docs, benchmark.limit(0)).count() == docs.count()
    assert decontam.clean_documents(docs.limit(0), benchmark).collect() == []
