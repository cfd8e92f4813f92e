"""Spelling variants by finite-state composition (operator 12).

Words one inserted, deleted or replaced code point apart are *near*.  With the
vocabulary as an acceptor V and a transducer E that copies any number of code
points, makes one edit and copies the rest, the accepted pairs of V o E o V
are exactly the near words.  E copies until its edit, so both copies of V are
in the same state up to there: a state of the composition is (p, before, p) or
(p, after, q).  A pair may be accepted along several paths ("aab", "ab"); the
edit is taken at the first code point that differs, which each pair has once.

The machine is cut into partitions by the state that a prefix leads to from
the initial state.  Prefixes are as short as leaves at most ``max_words``
words behind each, so no partition grows with the vocabulary.  Inside one, the
minimised acceptor of its words is composed with E and itself, and the pairs
are enumerated (``PartMachine``).  An edit inside the prefix leads out of the
partition, to a state where both words must go on alike; those arcs are
followed by a shuffle on what the edit leaves of both words, in groups bounded
by the alphabet, without listing a group's pairs.  Words over ``long_word``
code points meet by hashes of what every possible edit leaves of them (a few
dozen bytes a code point), and found pairs are compared in full.

Runs are counted per task (the hash of document id and run decides the same
for each repetition in a document), then over all documents.

Defined results: null and empty texts have no words; with a null document id
no code point is deleted; repeated rows count each; very long texts are read
in pieces cut between runs; ties of a form go to the first word in code-point
order.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import staged, text_slices

MIN_LENGTH, MIN_COUNT = 5, 3
#: A run is altered when this divides its hash; a form has this many times the word's count.
ALTER_EVERY, FORM_RATIO = 97, 2
MAX_WORDS, LONG_WORD = 8000, 64
#: Distinct words, and bytes of text, that a task holds at once.
FLUSH_WORDS, PIECE = 200_000, 1 << 20
#: Strings kept while a partition's intersections are remembered.
KEPT_STRINGS = 1_000_000

#: Latin-1 bytes of a text to its lower-cased runs with blanks between.
_RUNS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)
_FOUND = "word string, n_near long, minus_n long, near string"


# -- counting ------------------------------------------------------------------------


def _pieces(data: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(data):
        cut = data.find(b" ", start + PIECE)
        stop = len(data) if cut < 0 else cut
        yield data[start:stop]
        start = stop


def count_runs(total: dict[bytes, int], doc_id: int | None, text: str, every: int = ALTER_EVERY) -> None:
    """Add the text's runs, altered where the hash says so, in Latin-1 bytes."""
    start = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
    for piece in _pieces(text.encode("latin-1", "replace").translate(_RUNS)):
        for run, n in Counter(piece.split()).items():
            if start is not None:
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if h % every == 0:
                    place = h % len(run)
                    run = run[:place] + run[place + 1 :]
            total[run] = total.get(run, 0) + n


def word_counts(
    docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = ALTER_EVERY
) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            kept = [(w.decode("latin-1"), n) for w, n in total.items() if len(w) >= min_length]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            ids, at = batch.column("doc_id").to_pylist(), 0
            for texts in text_slices(batch.column("text")):
                for text in texts:
                    count_runs(total, ids[at], text, every)
                    at += 1
                if len(total) > FLUSH_WORDS:
                    yield flush()
        if total:
            yield flush()

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = narrow.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -- one partition's machine ---------------------------------------------------------------


class PartMachine:
    """Minimised acceptor of some words, composed with one edit and itself."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple[int, int], list[str]] = {}
        self._strings = 0
        self._edits: dict[int, list[tuple[str, str]]] = {}
        words = sorted(words)
        self.shared = self._shared_prefix(words)
        self.start = self._state(words, 0, len(words), len(self.shared))

    @staticmethod
    def _shared_prefix(words: list[str]) -> str:
        first, last = words[0], words[-1]
        n = next((i for i, (a, b) in enumerate(zip(first, last, strict=False)) if a != b), min(len(first), len(last)))
        return first[:n]

    def _state(self, words: list[str], low: int, high: int, depth: int) -> int:
        """The state after ``depth`` code points; equal right languages share one."""
        final = len(words[low]) == depth
        arcs, i = {}, low + final
        while i < high:
            symbol, stop = words[i][depth], i + 1
            while stop < high and words[stop][depth] == symbol:
                stop += 1
            arcs[symbol] = self._state(words, i, stop, depth + 1)
            i = stop
        known = (final, tuple(arcs.items()))
        if known not in self._known:
            self._known[known] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[known]

    def common(self, p: int, q: int) -> list[str]:
        """What is accepted from both states: (p, after, q) of the composition."""
        key = (p, q) if p <= q else (q, p)
        found = self._common.get(key)
        if found is None:
            found = [""] if self.final[p] and self.final[q] else []
            one, other = sorted((self.arcs[p], self.arcs[q]), key=len)
            for symbol, to in one.items():
                if symbol in other:
                    found += [symbol + rest for rest in self.common(to, other[symbol])]
            self._strings += len(found) + 1
            if self._strings > KEPT_STRINGS:
                self._common.clear()
                self._strings = 0
            self._common[key] = found
        return found

    def edits(self, p: int) -> list[tuple[str, str]]:
        """Pairs of rests from (p, before, p) that differ in their first code
        point; in a pair of unequal lengths the longer comes first."""
        found = self._edits.get(p)
        if found is None:
            found, arcs = [], list(self.arcs[p].items())
            for i, (a, to_a) in enumerate(arcs):
                for b, to_b in arcs[i + 1 :]:
                    found += [(a + rest, b + rest) for rest in self.common(to_a, to_b)]
                found += [(a + rest, rest) for rest in self.common(to_a, p) if not rest.startswith(a)]
            self._edits[p] = found
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All near pairs of the words, each once."""
        open_ = [(self.start, self.shared)]
        while open_:
            p, prefix = open_.pop()
            for a, b in self.edits(p):
                yield prefix + a, prefix + b
            open_ += [(to, prefix + symbol) for symbol, to in self.arcs[p].items()]


def _inside(part: pd.DataFrame) -> pd.DataFrame:
    """Near words inside one partition: count and best one per word."""
    counts = dict(zip(part["word"], part["n"], strict=True))
    near: Counter[str] = Counter()
    best: dict[str, tuple[int, str]] = {}
    if len(counts) > 1:
        for pair in PartMachine(list(counts)).pairs():
            for word, other in (pair, pair[::-1]):
                near[word] += 1
                place = (-counts[other], other)
                if word not in best or place < best[word]:
                    best[word] = place
    return pd.DataFrame([(w, k, *best[w]) for w, k in near.items()], columns=["word", "n_near", "minus_n", "near"])


# -- the partitions ----------------------------------------------------------------------


def _prefix(length: int) -> Column:
    return F.substring(F.concat("word", F.lit("$")), 1, length)


def partitions(words: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """``words`` with ``k``, the length of the shortest prefix (the word's end
    counts as a sign) that at most ``max_words`` words have."""
    crowded: list[DataFrame] = []
    while True:
        length = len(crowded) + 1
        rest = words
        if crowded:
            rest = words.join(crowded[-1], _prefix(length - 1) == F.col("prefix"), "left_semi")
        sizes = rest.groupBy(_prefix(length).alias("prefix")).agg(F.count(F.lit(1)).alias("size"))
        more = staged(sizes.where(F.col("size") > max_words).select("prefix"), "crowded-prefixes")
        if more.isEmpty():
            break
        crowded.append(more)
    out = words.withColumn("k", F.lit(1))
    for length, prefixes in enumerate(crowded, 1):
        marked = prefixes.select(F.col("prefix").alias("_prefix"))
        out = out.join(marked, _prefix(length) == F.col("_prefix"), "left")
        out = out.withColumn("k", F.col("k") + F.col("_prefix").isNotNull().cast("int")).drop("_prefix")
    return out


def _across(words: DataFrame) -> DataFrame:
    """Near words whose edit lies inside the first ``k`` code points: both
    keep the same text around it.  A group holds at most one word for each
    code point at that place and one without it."""
    k, size = F.col("k"), F.length("word")

    def member(i: Column, taken: int) -> Column:
        left, gone = F.substr("word", F.lit(1), i), F.substr("word", i + 1, F.lit(taken))
        return F.struct(F.concat(left, F.lit("_"), F.substr("word", i + 1 + taken)).alias("key"), gone.alias("gone"))

    without = F.transform(F.sequence(F.lit(0), F.least(k, size) - 1), lambda i: member(i, 1))
    whole = F.transform(F.sequence(F.lit(0), F.least(k - 1, size)), lambda i: member(i, 0))
    arcs = words.select("word", "n", F.explode(F.concat(without, whole)).alias("_arc"))
    groups = (
        arcs.groupBy(F.col("_arc.key").alias("key"))
        .agg(F.collect_list(F.struct(F.col("_arc.gone").alias("gone"), "n", "word")).alias("members"))
        .where(F.size("members") > 1)
    )
    # the code point after the place: an edit there is not the first difference
    after = F.substring(F.substring_index("key", "_", -1), 1, 1)

    def meets(one: Column, other: Column) -> Column:
        late = ((one["gone"] == "") & (other["gone"] == F.col("after"))) | ((other["gone"] == "") & (one["gone"] == F.col("after")))
        return (one["gone"] != other["gone"]) & ~late

    each = groups.withColumn("after", after).select("members", "after", F.explode("members").alias("m"))
    partners = F.filter("members", lambda o: meets(F.col("m"), o))
    return (
        each.select(F.col("m.word").alias("word"), partners.alias("near"))
        .where(F.size("near") > 0)
        .select(
            "word",
            F.size("near").cast("long").alias("n_near"),
            F.array_min(F.transform("near", lambda o: F.struct((-o["n"]).alias("minus_n"), o["word"].alias("near")))).alias("best"),
        )
    )


# -- long words --------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: it has an inverse modulo 2 ** 64
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _long_arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per long word and place: the hash of the rest without the code point
    there, and the hash of the whole word for one that has one more there."""
    names = ["size", "place", "hash", "wid", "symbol", "whole"]
    with np.errstate(over="ignore"):
        for batch in batches:
            for wid, word in zip(batch.column("wid").to_pylist(), batch.column("word").to_pylist(), strict=True):
                codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
                n = len(codes)
                power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))[:n]
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * power)])
                without = sums[:-1] + (sums[-1] - sums[1:]) * _BACK
                here = codes.astype(np.int64)
                for size, hashes, symbols, whole in (
                    (n - 1, without, here, False),
                    (n, np.full(n + 1, sums[-1]), np.append(here, -1), True),
                ):
                    m = len(hashes)
                    for i in range(0, m, 1 << 16):
                        part = slice(i, min(m, i + (1 << 16)))
                        count = part.stop - i
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(count, size)), pa.array(np.arange(i, part.stop)), pa.array(hashes[part].view(np.int64)),
                                pa.array(np.full(count, wid)), pa.array(symbols[part]), pa.array(np.full(count, whole)),
                            ],
                            names=names,
                        )


def _long_near(words: DataFrame, long_word: int) -> DataFrame | None:
    """Near words of which at least one is longer than ``long_word``."""
    long = words.where(F.length("word") >= long_word).withColumn("wid", F.monotonically_increasing_id())
    long = staged(long, "long-words")
    if long.isEmpty():
        return None
    arcs = long.select("wid", "word").mapInArrow(
        _long_arcs, "size long, place long, hash long, wid long, symbol long, whole boolean"
    )
    member = F.struct("wid", "symbol", "whole")
    groups = arcs.groupBy("size", "place", "hash").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    # at most one word for each code point at the place and one without it
    one = groups.select("members", F.explode("members").alias("a"))
    fits = F.filter("members", lambda o: ~o["whole"] & (o["symbol"] != F.col("a.symbol")) & (F.col("a.whole") | (o["wid"] > F.col("a.wid"))))
    pairs = one.select(F.col("a.wid").alias("wid"), F.explode(F.transform(fits, lambda o: o["wid"])).alias("other_wid"))
    other = long.select(F.col("wid").alias("other_wid"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = pairs.join(long, "wid").join(other, "other_wid")
    near = near.where((F.levenshtein("word", "other", 1) == 1) & (F.greatest(F.length("word"), F.length("other")) > long_word))
    both = F.explode(
        F.array(
            F.struct(F.col("word"), F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("near")).alias("best")),
            F.struct(F.col("other").alias("word"), F.struct((-F.col("n")).alias("minus_n"), F.col("word").alias("near")).alias("best")),
        )
    ).alias("_b")
    return near.select(both).select("_b.word", F.lit(1).cast("long").alias("n_near"), "_b.best")


# -- variants ----------------------------------------------------------------------------


def near_words(words: DataFrame, max_words: int = MAX_WORDS, long_word: int = LONG_WORD) -> DataFrame:
    """``(word, n_near, best)`` for the words with a near word; ``best`` is
    the one of largest ``n``, the first of those in code-point order."""
    short = staged(partitions(words.where(F.length("word") <= long_word), max_words), "partitioned-words")
    inside = short.groupBy(F.substring(F.concat("word", F.lit("$")), F.lit(1), F.col("k")).alias("part")).applyInPandas(_inside, _FOUND)
    inside = inside.select("word", "n_near", F.struct("minus_n", "near").alias("best"))
    found = [inside, _across(short), _long_near(words, long_word)]
    parts = reduce(DataFrame.unionByName, [f for f in found if f is not None])
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: forms followed to the last, the
    length of the followed way doubling each round.  Counts at least double
    along it, so a chain is no longer than a count has binary digits."""
    ways = staged(forms.select("word", F.col("form").alias("root")), "form-ways")
    while True:
        ahead = ways.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = ways.join(ahead, F.col("root") == F.col("_at"), "left")
        ways = staged(
            joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "form-ways"
        )
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    alter_every: int = ALTER_EVERY,
    form_ratio: int = FORM_RATIO,
    max_words: int = MAX_WORDS,
    long_word: int = LONG_WORD,
) -> DataFrame:
    """Per word: ``word, form, root, n, n_near, form_n``."""
    words = staged(word_counts(docs, id_col, text_col, min_length, min_count, alter_every), "vocabulary")
    found = words.join(near_words(words, max_words, long_word), "word", "left")
    is_form = -F.col("best.minus_n") >= F.col("n") * form_ratio
    table = staged(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus_n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(table.where(F.col("form").isNotNull()))
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
