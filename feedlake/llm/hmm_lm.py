"""Hidden Markov language model (operator 2).

Tokens are the lower-cased (A-Z) words of a text and one end.  A first pass
counts the training tokens exactly.  The ``own_words`` most frequent ones are
a class each; every other word belongs to the class of its ending.  A state
emits a class, a class emits a word with the smoothed share
``(c + 0.5) / (T + 0.5 * (V + 1))`` of the class's T tokens and V words, so a
word's probability in a state is the product and the model is normalised over
known words and one unknown word per class.

Baum-Welch trains transitions and class emissions: tasks sum expected counts
over their whole documents, Spark adds them up by cell, and the driver renormalises
a table whose size is set by parameters.  The first guess comes from the pairs
of neighbours of all training documents, counted in Spark by left class and
right group; every round covers all training documents.  The score is the exact likelihood by scaled forward recursion;
a very long text is cut in pieces whose transfer matrices are multiplied.

Word counts are too many to broadcast.  The (up to) ``top_words`` most
frequent are, at most 33 bytes each; a document's other words are joined with the counts,
grouped per document beforehand, so a common word never meets the join.

Defined results: null, empty and blank texts are one end token; a null id is
training text; repeated rows each count and each give a row; without training
text every token is unknown; empty input gives empty output.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate, held_out, staged, text_slices

FOLDS = 5
STATES, ROUNDS = 8, 3
TOP_WORDS, OWN_WORDS, ENDINGS = 50_000, 2_000, 1_024
#: Levels of the count histogram per natural logarithm.
COUNT_LEVELS = 50
#: First guess: groups of the right class of a pair, the first ones for the end
#: and the most frequent words; rounds on the table of pairs.
GROUPS, OWN_GROUPS, PAIR_ROUNDS = 64, 48, 60
#: Keys a task counts before it hands them on; tokens handled side by side.
COUNT_KEYS, SIDE_TOKENS = 400_000, 500_000
#: Training keeps the states of so many steps at a time; scoring cuts longer texts than EXACT tokens.
BLOCK, EXACT = 16_384, 8_192
#: Steps between two scalings: a step divides by 1e18 at most (a class seen once in 30 GB).
RESCALE = 8
#: Weight of the corpus share of a class in a state's emissions.
SMOOTH = 50.0
#: Words up to this many bytes are keys themselves, longer ones by a digest;
#: a blank, which no word holds, sets digests and the end apart.
KEY_BYTES = 32
END = b" end"
#: Classes: the end, words with a class of their own, endings, long words.
FIRST_ENDING = 1 + OWN_WORDS
CLASSES = FIRST_ENDING + ENDINGS + 1


def key_of(word: bytes) -> bytes:
    return word if len(word) <= KEY_BYTES else b" " + xxhash.xxh3_128_digest(word)


#: A word's length as its class has it.
LENGTHS = [bytes([min(n // 4, 4)]) for n in range(KEY_BYTES + 1)]


@functools.lru_cache(maxsize=200_000)
def _class_of(end: bytes) -> int:
    return FIRST_ENDING + xxhash.xxh32_intdigest(end) % ENDINGS


def ending_class(key: bytes) -> int:
    """Class of a word without one of its own: by its last letters and length.
    Endings recur where such words do not, so endings are remembered."""
    if key[:1] == b" ":
        return CLASSES - 1
    return _class_of(key.rstrip(b".,;:!?#*$%&'\")")[-3:] + LENGTHS[min(len(key), KEY_BYTES)])


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(key, n) over a table with one column of training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            keys = pa.array(counts.keys(), pa.binary())
            return pa.RecordBatch.from_arrays([keys, pa.array(counts.values(), pa.int64())], names=["key", "n"])

        for batch in batches:
            for texts in text_slices(batch.column(0)):
                part = Counter([w for t in texts for w in words_of(t)])
                for word in [w for w in part if len(w) > KEY_BYTES]:
                    part[key_of(word)] += part.pop(word)
                counts.update(part)
                counts[END] += len(texts)
                if len(counts) >= COUNT_KEYS:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return texts.mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Frequent words (rank by key), their counts and classes; corpus totals."""

    rank: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    words: int
    class_tokens: np.ndarray  # T and V per class
    class_words: np.ndarray

    def word_shares(self) -> np.ndarray:
        """log10 of a class's denominator; 0 for a class with a single word."""
        size = np.log10(self.class_tokens + 0.5 * (self.class_words + 1))
        size[:FIRST_ENDING] = 0
        return size


def vocabulary(counts: DataFrame, top_words: int = TOP_WORDS, own_words: int = OWN_WORDS) -> Vocabulary:
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = F.col("key") == F.lit(END)
    plain = counts.where(ends | (F.substring("key", 1, 1) != F.lit(b" ")))  # no digests
    # the frequent words by a threshold, from a histogram of log counts: a
    # sort would send so many rows from every task
    level = F.floor(F.log("n") * COUNT_LEVELS)
    room, least = top_words, None
    for row in sorted(plain.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        if row.words > room:  # a few thousand levels at most
            break
        room, least = room - row.words, row.level
    frequent = plain.where(ends | (level >= F.lit(least))) if least is not None else plain.where(ends)
    top = sorted(((bytes(r.key), r.n) for r in frequent.collect()), key=lambda r: (r[0] != END, -r[1], r[0]))
    own = [k for k, _ in top if k != END][: min(own_words, OWN_WORDS)]
    classes = {END: 0, **{k: 1 + i for i, k in enumerate(own)}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            where = np.array([classes[k] if k in classes else ending_class(k) for k in keys], dtype=np.int64)
            tokens += np.bincount(where, weights=batch.column(1).to_numpy(), minlength=CLASSES)
            words += np.bincount(where, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(tokens), pa.array(words)], names=["c", "t", "v"])

    sums = counts.mapInArrow(run, "c long, t double, v double").groupBy("c").agg(F.sum("t").alias("t"), F.sum("v").alias("v"))
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in sums.collect():  # one row per class
        tokens[row.c], words[row.c] = row.t, row.v
    return Vocabulary(
        {k: i for i, (k, _) in enumerate(top)},
        np.array([n for _, n in top], dtype=np.int64),
        np.array([classes[k] if k in classes else ending_class(k) for k, _ in top], dtype=np.int64),
        totals.n or 0, totals.v, tokens, words,
    )


ENCODED = (
    "n_tokens long, n_known long, log_own double, log_top double, classes binary, rare array<struct<key:binary,tf:int>>"
)


def encoder(shared) -> Callable[[], Callable[[list[str]], list]]:
    """Maps texts to the columns of ``ENCODED``: what the frequent words
    contribute, the class of every token, and the other words with counts."""

    def make() -> Callable[[list[str]], list]:
        vocab: Vocabulary = shared.value
        get, end = vocab.rank.get, vocab.rank.get(END, -1)
        logs = np.append(np.log10(vocab.counts + 0.5), 0.0)
        kinds = np.append(vocab.classes, 0).astype(np.int16)

        def compute(texts: list[str]) -> list:
            lists = [words_of(t) for t in texts]
            sizes = np.array([len(ws) + 1 for ws in lists])
            stops = np.cumsum(sizes)
            flat: list[int] = []
            for ws in lists:
                flat += [get(w, -1) for w in ws]
                flat.append(end)
            ranks = np.fromiter(flat, np.int64, len(flat))
            kind = kinds[ranks]
            keys: list[bytes] = []
            tfs: list[int] = []
            edges = [0]
            for ws, stop, size in zip(lists, stops.tolist(), sizes.tolist(), strict=True):
                mine = ranks[stop - size : stop - 1]
                missing = np.flatnonzero(mine < 0)
                if len(missing):
                    rare = [key_of(ws[i]) for i in missing.tolist()]
                    kind[stop - size + missing] = [ending_class(k) for k in rare]
                    found = Counter(rare)
                    keys.extend(found.keys())
                    tfs.extend(found.values())
                edges.append(len(keys))
            if end < 0:
                kind[stops - 1] = 0
            firsts = stops - sizes
            value = logs[ranks]
            own = (kind < FIRST_ENDING) & (ranks >= 0)
            known = (ranks >= 0).astype(np.int64)
            if end < 0:  # no training text: an end is unknown too
                value[stops - 1] = np.log10(0.5)
            log_own = np.add.reduceat(np.where(own | (kind == 0), value, 0.0), firsts)
            log_top = np.add.reduceat(np.where(own | (kind == 0), 0.0, value), firsts)
            data = kind.astype("<i2")
            seqs = [data[b - n : b].tobytes() for b, n in zip(stops.tolist(), sizes.tolist(), strict=True)]
            pairs = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(tfs, pa.int32())], names=["key", "tf"])
            return [
                sizes, np.add.reduceat(known, firsts), log_own, log_top, pa.array(seqs, pa.binary()),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pairs),
            ]

        return compute

    return make


def side_by_side(seqs: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sequences in lists of up to ``SIDE_TOKENS`` tokens (a longer one alone)."""
    lo = 0
    while lo < len(seqs):
        hi, tokens = lo, 0
        while hi < len(seqs) and (hi == lo or tokens + len(seqs[hi]) <= SIDE_TOKENS):
            tokens += len(seqs[hi])
            hi += 1
        yield seqs[lo:hi]
        lo = hi


# --- the model -----------------------------------------------------------------


@dataclass
class Hmm:
    start: np.ndarray  # (K)
    move: np.ndarray  # (K, K)
    emit: np.ndarray  # (classes, K)

    def log_likelihoods(self, seqs: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each sequence of classes, by scaled forward
        recursion over all sequences side by side."""
        out = np.zeros(len(seqs))
        short = [i for i, s in enumerate(seqs) if len(s) <= EXACT]
        short.sort(key=lambda i: -len(seqs[i]))
        lo = 0
        while lo < len(short):
            hi, tokens = lo, 0
            while hi < len(short) and (hi == lo or tokens + len(seqs[short[hi]]) <= 2 * SIDE_TOKENS):
                tokens += len(seqs[short[hi]])
                hi += 1
            part = short[lo:hi]
            out[part] = self._forward([seqs[i] for i in part], np.tile(self.start, (len(part), 1)), True)[0]
            lo = hi
        for i, seq in enumerate(seqs):
            if len(seq) > EXACT:
                out[i] = self._forward_long(seq)
        return out / np.log(10)

    def _forward(self, seqs: list[np.ndarray], alpha: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scaled recursion over sequences sorted by falling length; natural
        logs of the scales and the last state distributions.  Every ``RESCALE``
        steps the states' sum becomes 1 again, and where a sequence ends."""
        sizes = np.array([len(s) for s in seqs])
        begin, flat = np.cumsum(sizes) - sizes, np.concatenate(seqs)
        logs, alpha = np.zeros(len(seqs)), alpha.astype(np.float64)
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]))).tolist()  # rows longer than t
        for t, n in enumerate(active):
            e = self.emit.take(flat[begin[:n] + t], axis=0)
            e *= alpha[:n] if first and t == 0 else alpha[:n] @ self.move
            if t % RESCALE == RESCALE - 1:
                scale = e.sum(axis=1)
                e /= scale[:, None]
                logs[:n] += np.log(scale)
            alpha[:n] = e
        scale = alpha.sum(axis=1)
        return logs + np.log(scale), alpha / scale[:, None]

    def _forward_long(self, seq: np.ndarray) -> float:
        """Pieces in parallel, each from every state; then piece after piece."""
        k = len(self.start)
        total, state = self._forward([seq[:EXACT]], self.start[None, :], True)
        log, state = float(total[0]), state[0]
        rest = [seq[a : a + EXACT] for a in range(EXACT, len(seq), EXACT)]
        for lo in range(0, len(rest), 64):
            group = rest[lo : lo + 64]
            logs, ends = self._forward([g for g in group for _ in range(k)], np.tile(np.eye(k), (len(group), 1)), False)
            for j in range(len(group)):
                own = logs[j * k : (j + 1) * k]
                top = own.max()
                mixed = (state * np.exp(own - top)) @ ends[j * k : (j + 1) * k]
                log += top + float(np.log(mixed.sum()))
                state = mixed / mixed.sum()
        return log

    def expected(self, seqs: list[np.ndarray]) -> np.ndarray:
        """Baum-Welch counts over whole sequences, flat: starts (K), moves
        (K, K), emissions (classes, K).  Of a sequence beyond ``BLOCK`` tokens
        the states at the blocks' ends are kept, and block after block, last
        first, is run again."""
        k = len(self.start)
        starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros(self.emit.shape)
        emit, move, start = (v.astype(np.float32) for v in (self.emit, self.move, self.start))
        for part in side_by_side(sorted(seqs, key=lambda s: -len(s))):
            sizes = np.array([len(s) for s in part])
            steps = int(sizes[0])
            active = np.searchsorted(-sizes, -np.arange(steps)).tolist()  # rows longer than t
            begin, flat = np.cumsum(sizes) - sizes, np.concatenate(part)

            def forward(last: np.ndarray | None, lo: int, hi: int, keep: bool):
                """Symbols, their emissions, scales and states at steps lo to hi."""
                out: list[tuple[np.ndarray, ...]] = []
                for t in range(lo, hi):
                    n = active[t]  # noqa: B023
                    symbols = flat[begin[:n] + t]  # noqa: B023
                    e = emit[symbols]
                    now = start * e if last is None else (last[:n] @ move) * e
                    scale = now.sum(axis=1, keepdims=True)
                    last = now / scale
                    if keep:
                        out.append((symbols, e, scale, last))
                return out, last

            blocks = range(0, steps, BLOCK)
            ends: list[np.ndarray | None] = [None]
            for lo in blocks[:-1]:
                ends.append(forward(ends[-1], lo, lo + BLOCK, False)[1])
            ahead = np.empty((0, k), dtype=np.float32)
            for lo, last in zip(reversed(blocks), reversed(ends), strict=True):
                kept, _ = forward(last, lo, min(lo + BLOCK, steps), True)
                weights: list[np.ndarray] = []
                for _symbols, e, scale, alpha in reversed(kept):
                    m = len(ahead)
                    beta = np.ones(alpha.shape, dtype=np.float32)
                    if m:
                        moves += alpha[:m].T @ ahead
                        beta[:m] = ahead @ move.T
                    weights.append(alpha * beta)
                    ahead = e * beta / scale
                symbols, weight = np.concatenate([x[0] for x in reversed(kept)]), np.concatenate(weights)
                for j in range(k):
                    emits[:, j] += np.bincount(symbols, weights=weight[:, j], minlength=len(emits))
            starts += weights[-1].sum(axis=0)
        return np.concatenate([starts, (moves * self.move).ravel(), emits.ravel()])


def maximise(counts: np.ndarray, k: int, share: np.ndarray) -> Hmm:
    """The model for summed expected counts; ``share`` is the classes' corpus
    share, which smooths the emissions."""
    starts, moves, emits = counts[:k], counts[k : k + k * k].reshape(k, k), counts[k + k * k :].reshape(-1, k)
    emit = emits + SMOOTH * share[:, None]
    return Hmm(
        (starts + 0.1) / (starts + 0.1).sum(),
        (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True),
        emit / emit.sum(axis=0),
    )


def group_of() -> np.ndarray:
    """Group of every class, for the right side of a pair."""
    classes = np.arange(CLASSES)
    return np.where(classes < OWN_GROUPS, classes, OWN_GROUPS + classes % (GROUPS - OWN_GROUPS))


def pair_counts(seqs: list[np.ndarray]) -> np.ndarray:
    """(CLASSES, GROUPS): how often a class precedes a group, in all texts."""
    out, group = np.zeros(CLASSES * GROUPS, dtype=np.int64), group_of()
    for part in side_by_side(seqs):
        flat, stops = np.concatenate(part), np.cumsum([len(s) for s in part])
        cells = flat[:-1] * GROUPS + group[flat[1:]]
        inner = np.ones(len(cells), dtype=bool)
        inner[stops[:-1] - 1] = False  # no pair across texts
        out += np.bincount(cells[inner], minlength=len(out))
    return out.reshape(CLASSES, GROUPS)


def first_guess(pairs: np.ndarray, k: int, share: np.ndarray, rounds: int = PAIR_ROUNDS) -> Hmm:
    """States that start as blurred copies of the corpus and settle on the
    pairs of neighbours of all training texts."""
    noise = np.random.default_rng(7).gamma(1.0, size=(len(share), k))
    emit = share[:, None] * (0.5 + noise)
    emit /= emit.sum(axis=0)
    joint = (np.full((k, k), 0.1 / k) + 0.9 * np.eye(k)) / k  # of a pair's two states
    group = group_of()
    for _ in range(rounds):
        right = np.zeros((GROUPS, k))
        np.add.at(right, group, emit)
        ahead = joint @ right.T  # (k, GROUPS)
        ratio = pairs / np.maximum(emit @ ahead, 1e-300)
        left = emit * (ratio @ ahead.T)  # expected counts
        joint *= emit.T @ ratio @ right
        joint = (joint + 0.1) / (joint + 0.1).sum()
        left += SMOOTH * share[:, None]
        emit = left / left.sum(axis=0)
    return Hmm(joint.sum(axis=1), joint / joint.sum(axis=1, keepdims=True), emit)


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, "<i2").astype(np.int64) for v in column.to_pylist()]


def train(encoded: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Hmm:
    """Baum-Welch over all rows of ``encoded`` (column ``classes``)."""
    share = (vocab.class_tokens + 0.5) / (vocab.class_tokens + 0.5).sum()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * GROUPS, dtype=np.int64)
        for batch in batches:
            total += pair_counts(_sequences(batch.column(0))).ravel()
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "v"])

    found = encoded.select("classes").mapInArrow(count, "cell long, v long").groupBy("cell").agg(F.sum("v").alias("v"))
    pairs = np.zeros(CLASSES * GROUPS)
    table = found.toArrow()  # its size is set by the parameters
    pairs[table["cell"].to_numpy()] = table["v"].to_numpy()
    model = first_guess(pairs.reshape(CLASSES, GROUPS), states, share)
    size = states + states * states + CLASSES * states
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                seqs = _sequences(batch.column(0))
                if seqs:
                    total += model.expected(seqs)
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "v"])

        sums = encoded.select("classes").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
        counts = np.zeros(size)
        for row in sums.collect():  # a table whose size the parameters set
            counts[row.cell] = row.v
        model = maximise(counts, states, share)
    return model


def text_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
    states: int = STATES, rounds: int = ROUNDS, top_words: int = TOP_WORDS, own_words: int = OWN_WORDS,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10)."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col), folds).alias("held_out"), F.col(text_col).alias("text")
    )
    counts = staged(count_tokens(rows.where(~F.col("held_out")).select("text")), "token-counts")
    vocab = vocabulary(counts, top_words, own_words)
    encoded = annotate(rows, "text", ENCODED, encoder(context.broadcast(vocab))).drop("text")
    encoded = staged(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded-texts")  # numbers fixed once written
    model = train(encoded.where(~F.col("held_out")), vocab, states, rounds)

    rare = encoded.select("row", F.explode("rare").alias("x")).select("row", "x.key", "x.tf")
    found = rare.join(counts.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    per_row = found.groupBy(F.col("row").alias("r")).agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("log_rare"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("known_rare"),
    )
    shared = context.broadcast((model, vocab.word_shares()))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sizes = shared.value
        for batch in batches:
            seqs = _sequences(batch.column(-1 + batch.num_columns))
            logs = model.log_likelihoods(seqs) - np.array([sizes[s].sum() for s in seqs])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(logs, pa.float64())], names=[*batch.schema.names[:-1], "forward"])

    narrow = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "log_own", "log_top", "classes")
    schema = narrow.drop("classes").withColumn("forward", F.lit(0.0)).schema
    scored = narrow.mapInArrow(forward, schema).join(per_row, F.col("row") == F.col("r"), "left")
    log_rare, known_rare = F.coalesce("log_rare", F.lit(0.0)), F.coalesce("known_rare", F.lit(0))
    size = float(np.log10(vocab.tokens + 0.5 * (vocab.words + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known_rare).cast("long").alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_own") + F.col("log_top") + log_rare - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("forward") + F.col("log_top") + log_rare).alias("score"),
    )
