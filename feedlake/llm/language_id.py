"""Language identification by segmentation-marginalised unigrams (operator 13).

The pieces of a fixed public vocabulary have one probability each in every
language.  The probability of a text in a language is the sum over *all* ways
to cut it into pieces, computed by a forward recursion; the language with the
greatest posterior wins.

Training: the words of all labelled texts are counted per language in Spark.
Expectation-maximisation over that table (forward-backward over every word's
cuts, expected piece counts summed in Spark) runs until the log-likelihood of
the training words grows by less than ``tolerance`` of itself.  At last each
language's counts are mixed with those of all languages, so that a piece not
seen in one has a small probability there.

Cuts never span a white space or, in a run of more than ``RUN`` code points,
its every ``RUN``-th one; so a word's probability doesn't depend on its
neighbours, is computed once per task, and a text's is the product.  A code
point without a piece is spelt by the vocabulary's byte pieces (a vocabulary
without those gives it one common piece).

The model in each task is languages x pieces float64 (128 kB a language for
16,000 pieces); ``max_languages`` bounds it, more labels are refused.

Defined results: a null text and a text without a letter are ``und`` with
score 0; so is every text where nothing was learned; a null id is never held
out; a null language teaches nothing; ties go to the language that sorts
first; repeated rows each count; very long texts are read in pieces cut at
white space or every ``PIECE`` code points.  Empty input gives empty output.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate, free_name, held_out, staged, text_slices

MODEL = "piece_bpe_32k.model"
HELD_OUT_MOD = 3
MAX_LANGUAGES = 1000
TOLERANCE, MAX_ROUNDS = 5e-3, 20
#: The first guess of a piece's share is one by its rank and this.
RANK_SHIFT = 10
#: Weight of the all-language shares, in pieces; of each piece in those.
SHARED_WEIGHT, PIECE_WEIGHT = 100.0, 0.5
#: Code points of a run, of a slice of a text; words a task remembers, of what length.
RUN, PIECE = 256, 1 << 20
FLUSH_WORDS, CACHE_WORDS = 200_000, 500_000
#: Cells (words x places x languages) of one recursion.
CELLS = 2 << 20
#: Places of a word up to which probabilities are multiplied; the log of the least one.
PLAIN, _LEAST = 24, float(np.log(1e-12))
#: More than the longest piece has code points.
_LENGTHS = 1 << 10
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_BLANK = regex.compile(r"\s")
#: Stands for a byte of a code point without a piece (a private code point,
#: which never is a piece itself).
_BYTE = 0xF0000
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- vocabulary ------------------------------------------------------------------


class Vocabulary:
    """Piece numbers by text, and the pieces' trie in arrays."""

    def __init__(self, pieces: list[str], byte_pieces: list[str] | None = None):
        """``byte_pieces``: the 256 pieces of single bytes, in order."""
        spelt = [chr(_BYTE + b) for b in range(256)] if byte_pieces else [chr(_BYTE)]
        texts = list(dict.fromkeys(p for p in pieces if p)) + spelt
        if max(map(len, texts)) >= _LENGTHS:
            raise ValueError(f"a piece of {_LENGTHS} code points or more")
        self.numbers = {p: i for i, p in enumerate(texts)}
        self.size = len(texts)
        self.known = frozenset(p for p in pieces if len(p) == 1)
        self.has_bytes = bool(byte_pieces)
        symbols = sorted(self.known.union(spelt, *texts))
        #: number of each code point; 0 for those in no piece
        self.symbol = np.zeros(0x110000, np.int32)
        self.symbol[[ord(c) for c in symbols]] = np.arange(1, len(symbols) + 1)
        #: whether a code point is a piece by itself (or a byte's sign)
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(c) for c in self.known.union(spelt)]] = True
        nodes, piece = {"": 0}, [-1]
        arcs = []
        for text in texts:
            for end in range(1, len(text) + 1):
                if text[:end] not in nodes:
                    nodes[text[:end]] = len(piece)
                    arcs.append((nodes[text[: end - 1]], self.symbol[ord(text[end - 1])], len(piece)))
                    piece.append(-1)
            piece[nodes[text]] = self.numbers[text]
        self.piece = np.array(piece, np.int64)
        self.width = len(symbols) + 1
        table = np.array(arcs, np.int64).reshape(-1, 3)
        self._fill(table[:, 0] * self.width + table[:, 1], table[:, 2])
        self._first = np.zeros(self.width, np.int64)  # 0: no piece begins so
        begin = table[:, 0] == 0
        self._first[table[begin, 1]] = table[begin, 2]

    def _fill(self, keys: np.ndarray, nodes: np.ndarray) -> None:
        """A table of the arcs, found by hash; a taken place moves on to the next."""
        bits = max(4, int(np.ceil(np.log2(6 * len(keys) + 1))))
        self._shift = np.uint64(64 - bits)
        self._arcs, self._next = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        while len(keys):
            place = self._place(keys)
            while (taken := self._arcs[place] >= 0).any():
                place = np.where(taken, (place + 1) & (len(self._arcs) - 1), place)
            first = np.unique(place, return_index=True)[1]
            self._arcs[place[first]], self._next[place[first]] = keys[first], nodes[first]
            keys, nodes = np.delete(keys, first), np.delete(nodes, first)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self._shift).astype(np.int64)

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        """The node that each (node, symbol) leads to; 0 for none."""
        place = self._place(keys)
        there = self._arcs[place]
        out = np.where(there == keys, self._next[place], 0)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) & (len(self._arcs) - 1)
            there = self._arcs[place[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self._next[place[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def spell(self, word: str) -> str:
        """The word, each code point without a piece as its bytes' signs."""
        if self.known.issuperset(word):
            return word
        if not self.has_bytes:
            return "".join(c if c in self.known else chr(_BYTE) for c in word)
        return "".join(c if c in self.known else "".join(chr(_BYTE + b) for b in c.encode()) for c in word)

    def matches(self, codes: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Every piece at every place, length by length: (places, length,
        pieces).  ``stop``: per place, where its word ends."""
        symbols = self.symbol[codes].astype(np.int64)
        at, node, length = np.arange(len(codes)), self._first[symbols], 1
        while len(at):
            numbers = self.piece[node]
            found = numbers >= 0
            yield at[found], length, numbers[found]
            inside = (at + length < stop[at]) & (node > 0)
            at, node = at[inside], node[inside]
            node = self._follow(node * self.width + symbols[at + length])
            goes = node > 0
            at, node = at[goes], node[goes]
            length += 1


@functools.lru_cache(maxsize=2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """The pieces of a sentencepiece file; a bare name is a file of ``public_tokenizers``."""
    import os

    import sentencepiece

    if os.sep not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    special = [i for i in numbers if model.is_control(i) or model.is_unknown(i)]
    in_bytes = [i for i in numbers if model.is_byte(i)]
    skipped = set(special) | set(in_bytes)
    plain = [model.id_to_piece(i) for i in numbers if i not in skipped]
    return Vocabulary(plain, [model.id_to_piece(i) for i in in_bytes] if len(in_bytes) == 256 else None)


def words_of(text: str) -> Iterator[list[str]]:
    """The text's words, a space sign before each, slice by slice."""
    start = 0
    while start < len(text):
        stop = len(text)
        if stop - start > PIECE:
            blank = _BLANK.search(text, start + PIECE, start + 2 * PIECE)
            stop = blank.start() if blank else min(stop, start + 2 * PIECE)
        words = text[start:stop].split()
        if len(text) - start > RUN and any(len(w) > RUN for w in words):
            words = [w[i : i + RUN] for w in words for i in range(0, len(w), RUN)]
        yield words
        start = stop


# -- the sum over all cuts ------------------------------------------------------------


class Lattice:
    """Every piece at every place of some words.

    Edges of one end and one length lie together and have a word once each, so
    a step of a recursion is one gather and one scatter.  Words of up to
    ``PLAIN`` places multiply plain probabilities (at least 1e-12 each, so no
    product underflows), longer ones add logarithms.
    """

    def __init__(self, words: list[str], voc: Vocabulary):
        spelt = ["▁" + w for w in words]
        codes = np.frombuffer("".join(spelt).encode("utf-32-le"), np.uint32)
        if not voc.single[codes].all():
            spelt = [voc.spell(w) for w in spelt]
            codes = np.frombuffer("".join(spelt).encode("utf-32-le"), np.uint32)
        self.ends = np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.places = int(self.ends.max(initial=0)) + 1
        stop = np.cumsum(self.ends)
        word_of = np.repeat(np.arange(len(words)), self.ends)
        offset = np.arange(len(codes)) - (stop - self.ends)[word_of]
        found = list(voc.matches(codes, stop[word_of]))
        at = np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)])
        length = np.concatenate([np.full(len(f[0]), f[1]) for f in found] or [np.empty(0, np.int64)])
        piece = np.concatenate([f[2] for f in found] or [np.empty(0, np.int64)])
        key = (offset[at] + length) * _LENGTHS + length
        key = key.astype(np.uint16) if self.places * _LENGTHS < 1 << 16 else key  # few bits sort by counting
        order = np.argsort(key, kind="stable")
        key, self.word, self.piece = key[order], word_of[at[order]], piece[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(key.astype(np.int64))) + 1, [len(key)]]) if len(key) else [0]
        #: (first edge, last edge + 1, start, end) of each end and length
        self.steps = [
            (int(a), int(b), int(key[a]) // _LENGTHS - int(key[a]) % _LENGTHS, int(key[a]) // _LENGTHS)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        self.plain = self.places <= PLAIN

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all cuts up to each place, [place, word, ...]; of ``p``,
        per edge with any further axes, or of logarithms (``plain``)."""
        sums = np.full((self.places, len(self.ends), *p.shape[1:]), 0.0 if self.plain else -np.inf)
        sums[0] = 1.0 if self.plain else 0.0
        for a, b, start, end in self.steps:
            self._step(sums[end], self.word[a:b], sums[start], p[a:b])
        return sums

    def backward(self, p: np.ndarray) -> np.ndarray:
        sums = np.full((self.places, len(self.ends), *p.shape[1:]), 0.0 if self.plain else -np.inf)
        sums[self.ends, np.arange(len(self.ends))] = 1.0 if self.plain else 0.0
        for a, b, start, end in sorted(self.steps, key=lambda s: -s[2]):
            self._step(sums[start], self.word[a:b], sums[end], p[a:b])
        return sums

    def _step(self, to: np.ndarray, words: np.ndarray, source: np.ndarray, p: np.ndarray) -> None:
        if self.plain:
            to[words] += source[words] * p
        else:
            to[words] = np.logaddexp(to[words], source[words] + p)

    def _scale(self, log_p: np.ndarray) -> np.ndarray:
        return np.exp(np.maximum(log_p, _LEAST)) if self.plain else log_p

    def totals(self, log_p: np.ndarray) -> np.ndarray:
        """Per word the log of the sum over all its cuts; ``log_p`` as above."""
        last = self.forward(self._scale(log_p))[self.ends, np.arange(len(self.ends))]
        return np.log(last) if self.plain else last

    def expected(self, log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word its log sum, and per edge its expected number of uses."""
        p = self._scale(log_p)
        ahead, behind = self.forward(p), self.backward(p)
        last = ahead[self.ends, np.arange(len(self.ends))]
        uses = np.empty(len(p))
        for a, b, start, end in self.steps:
            words = self.word[a:b]
            if self.plain:
                uses[a:b] = ahead[start, words] * p[a:b] * behind[end, words] / last[words]
            else:
                uses[a:b] = np.exp(ahead[start, words] + p[a:b] + behind[end, words] - last[words])
        return np.log(last) if self.plain else last, uses


def _in_parts(words: list[str], axes: int) -> Iterator[list[int]]:
    """Numbers of words of like lengths, bounded by the cells they need (a
    code point may be spelt in four); the plain ones apart from the longer."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        plain = sizes[order[start]] <= PLAIN
        stop, cells = start + 1, axes if plain else 4 * axes
        limit = np.searchsorted(sizes[order], PLAIN, "right") if plain else len(order)
        # sizes ascend, so the last word's size bounds all of them
        while stop < limit and (min(limit, 2 * stop - start) - start) * int(sizes[order[min(limit, 2 * stop - start) - 1]]) * cells <= CELLS:
            stop = min(limit, 2 * stop - start)
        yield order[start:stop].tolist()
        start = stop


# -- training ---------------------------------------------------------------------------


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    #: languages x pieces
    log_p: np.ndarray
    #: log-likelihood of the training words before each round
    history: list[float]
    path: str = MODEL


def word_table(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, word, n)`` over all given texts; ``word`` is null and ``n``
    the number of texts in one row per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[str, Counter[str | None]] = defaultdict(Counter)

        def flush() -> pa.RecordBatch:
            langs = [lang for lang, words in total.items() for _ in words]
            words = [w for counts in total.values() for w in counts]
            counts = [n for words in total.values() for n in words.values()]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["lang", "word", "n"]
            )

        for batch in batches:
            langs, at = batch.column("lang").to_pylist(), 0
            for texts in text_slices(batch.column("text")):
                for text in texts:
                    counts = total[langs[at]]
                    at += 1
                    counts[None] += 1
                    for words in words_of(text):
                        counts.update(words)
                        if len(counts) > FLUSH_WORDS:
                            yield flush()
                            counts = total[langs[at - 1]]
                if sum(map(len, total.values())) > FLUSH_WORDS:
                    yield flush()
        if total:
            yield flush()

    narrow = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _round(words: DataFrame, languages: list[str], log_p: np.ndarray, path: str) -> tuple[np.ndarray, float]:
    """Expected piece counts per language, and the log-likelihood."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(log_p.astype(np.float32))  # languages x pieces: bounded
    known = pa.array(languages, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, table = vocabulary(path), sent.value
        counts, likelihood = np.zeros(table.shape), 0.0
        for batch in batches:
            texts = batch.column("word").to_pylist()
            lang = pc.index_in(batch.column("lang"), known).to_numpy().astype(np.int64)
            times = batch.column("n").to_numpy().astype(np.float64)
            for part in _in_parts(texts, 1):
                lattice = Lattice([texts[i] for i in part], voc)
                here, weight = lang[part], times[part]
                total, uses = lattice.expected(table[here[lattice.word], lattice.piece].astype(np.float64))
                cell = here[lattice.word] * table.shape[1] + lattice.piece
                counts += np.bincount(cell, uses * weight[lattice.word], counts.size).reshape(counts.shape)
                likelihood += float(total @ weight)
        rows, pieces = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(np.append(rows, -1)), "piece": pa.array(np.append(pieces, -1)),
             "n": pa.array(np.append(counts[rows, pieces], likelihood))}
        )

    sums = words.mapInArrow(run, "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # a row for each language and piece at most
    sent.unpersist()
    likelihood = float(found.n[found.lang < 0].sum())
    found = found[found.lang >= 0]
    counts = np.zeros(log_p.shape)
    counts[found.lang.to_numpy(), found.piece.to_numpy()] = found.n.to_numpy()
    return counts, likelihood


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", path: str = MODEL,
    tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS, max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Fit every language's piece probabilities to all given texts."""
    table = staged(word_table(docs.where(F.col(lang_col).isNotNull()), text_col, lang_col), "language-words")
    words = table.where(F.col("word").isNotNull())
    texts = {r.lang: r.n for r in table.where(F.col("word").isNull()).limit(max_languages + 1).collect()}
    if len(texts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())  # those of `texts` with words
    size = vocabulary(path).size
    # the vocabulary lists its pieces from the more to the less frequent
    guess = 1 / (np.arange(size) + RANK_SHIFT)
    log_p = np.tile(np.log(guess / guess.sum()), (len(languages), 1))
    if not languages:
        return Model([], np.zeros(0), log_p, [], path)
    history: list[float] = []
    while True:
        counts, likelihood = _round(words, languages, log_p, path)
        history.append(likelihood)
        settled = len(history) > 1 and history[-1] - history[-2] < tolerance * abs(history[-2])
        if settled or len(history) > max_rounds:
            break
        log_p = np.log(np.maximum(counts / counts.sum(axis=1, keepdims=True), 1e-12))
    shared = counts.sum(axis=0) + PIECE_WEIGHT
    shared /= shared.sum()
    mixed = (counts + SHARED_WEIGHT * shared) / (counts.sum(axis=1, keepdims=True) + SHARED_WEIGHT)
    prior = np.array([texts[lang] for lang in languages], dtype=np.float64)
    return Model(languages, np.log(prior / prior.sum()), np.log(mixed), history, path)


# -- scoring ----------------------------------------------------------------------------


class Scorer:
    """Posteriors of texts in every language; words are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.voc = vocabulary(model.path)
        self.by_piece = np.ascontiguousarray(model.log_p.T)
        self.at: dict[str, int] = {}
        self.rows = np.empty((0, len(model.languages)))

    def _learn(self, words: list[str]) -> None:
        """Remember the log probabilities of new words."""
        need = len(self.at) + len(words)
        if need > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty((need, self.rows.shape[1]))])
        base = len(self.at)
        for part in _in_parts(words, len(self.model.languages)):
            lattice = Lattice([words[i] for i in part], self.voc)
            self.rows[base + np.array(part)] = lattice.totals(self.by_piece[lattice.piece])
        self.at.update(zip(words, range(base, need), strict=True))

    def _add(self, total: np.ndarray, held: list[str], owner: list[int], size: list[int]) -> None:
        """Add the words' log probabilities to their texts' totals."""
        places = list(map(self.at.get, held))  # the only look-up of a remembered word
        new = list(dict.fromkeys([w for w, place in zip(held, places, strict=True) if place is None]))
        if new:
            # also bounds the remembered numbers, of many languages
            if len(self.at) + len(new) > min(CACHE_WORDS, 4 * CELLS // max(1, self.rows.shape[1])):
                self.at = {}
                new = list(dict.fromkeys(held))
                places = [None] * len(held)
            self._learn(new)
            places = [self.at[w] if place is None else place for w, place in zip(held, places, strict=True)]
        rows = self.rows[places]
        first = np.cumsum([0, *size[:-1]])
        np.add.at(total, owner, np.add.reduceat(rows, first, axis=0))

    def score(self, texts: list[str]) -> np.ndarray:
        """Per text and language, the log of prior times probability."""
        total = np.tile(self.model.log_prior, (len(texts), 1))
        held: list[str] = []
        owner: list[int] = []
        size: list[int] = []
        for at, text in enumerate(texts):
            for words in words_of(text):
                if words:
                    held += words
                    owner.append(at)
                    size.append(len(words))
                if len(held) > FLUSH_WORDS:
                    self._add(total, held, owner, size)
                    held, owner, size = [], [], []
        if held:
            self._add(total, held, owner, size)
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        some = [i for i, t in enumerate(texts) if _LETTER.search(t)] if self.model.languages else []
        if some:
            log = self.score([texts[i] for i in some])
            best = log.argmax(axis=1)
            share = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
            for i, lang, score in zip(some, best, share, strict=True):
                langs[i], scores[i] = self.model.languages[lang], float(score)
        return langs, scores


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the language's posterior."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # max_languages x pieces at most

    def make() -> Callable[[list[str]], list]:
        scorer = Scorer(sent.value)
        return lambda texts: list(scorer.predict(texts))

    return annotate(docs, text_col, "lang_pred string, score double", make)


def language_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str = MODEL,
    held_out_mod: int = HELD_OUT_MOD,
) -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred`` and ``score``; learned
    from the documents that are not held out."""
    is_out: Column = held_out(F.col(id_col), held_out_mod)
    model = train(docs.where(~is_out), text_col, lang_col, path)
    text = free_name(docs, "_whole_text")
    narrow = docs.select(F.col(id_col).alias("doc_id"), is_out.alias("held_out"), F.col(text_col).alias(text))
    return predict(narrow, model, text).drop(text)
