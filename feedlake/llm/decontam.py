"""Benchmark decontamination by a prefix-filtered set join (operator 3).

An item's windows are its runs of ``window`` consecutive words (one shorter
window for a shorter item).  A window is a set of word shingles; a document
that contains the window contains all of them, so for exact containment the
necessary prefix is a single shingle.  Shingles are ordered by how often they
occur in all documents and the rarest one of each window is its prefix.

Only prefixes are looked up in the documents.  A hit must leave room for the
whole window on both sides (positional and length bounds), and is verified
word by word.  The documents are never shuffled: the index of a benchmark
block, whose words are bounded by ``block_words``, is broadcast; a larger
benchmark is split into blocks that are queried one after the other, and only
documents with hits are then merged.

Defined results: null, empty and wordless texts have no words and no hits;
items without words, or without an id, have no windows; an id that repeats in
the benchmark counts once; repeated documents each give a row; empty tables
give empty results or no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate, free_name, staged, text_slices
from feedlake.session import scratch_path

WINDOW = 13
SHINGLE = 3
#: Words of benchmark text in one broadcast index (some 100 bytes each).
BLOCK_WORDS = 500_000
#: A document is contaminated from this share of hit words on (in percent).
HIT_PERCENT = 5

#: Byte table: A-Z to lower case, the other ASCII bytes outside words to blanks.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in UTF-8."""
    return text.encode().translate(_WORD_BYTES).split()


@dataclass
class Windows:
    """Windows that are found through one shingle of ``shingle`` words each.

    ``keys`` are the sorted prefix keys; the windows ``order[first[i]:first[i+1]]``
    belong to ``keys[i]``, with the prefix ``offset`` words inside the window.
    """

    shingle: int
    grams: np.ndarray  # all shingle keys, sorted
    words: np.ndarray  # word ids of each window, zero-padded
    sizes: np.ndarray  # words of each window
    item_of: np.ndarray
    keys: np.ndarray | None = None
    first: np.ndarray | None = None
    order: np.ndarray | None = None
    offset: np.ndarray | None = None


@dataclass
class Index:
    """A benchmark block.  Word ids start at 1; 0 is any other word.  Windows
    shorter than the shingle have a table of their own, by their length."""

    vocab: dict[bytes, int]
    items: list[str]
    tables: list[Windows]


def shingle_keys(ids: np.ndarray, base: int, size: int) -> np.ndarray:
    """One integer for the shingle that starts at each word; -1 where it has a
    word that the benchmark hasn't, or runs over the end."""
    keys = np.full(len(ids), -1, dtype=np.int64)
    n = len(ids) - size + 1
    if n > 0:
        key, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for j in range(size):
            part = ids[j : j + n]
            key = key * base + part
            known &= part > 0
        keys[:n] = np.where(known, key, -1)
    return keys


def build_index(items: list[tuple[str, str]], window: int, shingle: int) -> Index:
    """The windows of the items, before their prefixes are chosen."""
    vocab: dict[bytes, int] = {}
    rows, sizes, owner = [], [], []
    names = sorted({i for i, _ in items})
    number = {name: k for k, name in enumerate(names)}
    for name, text in items:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
        for s in range(max(1, len(ids) - window + 1) if ids else 0):
            part = ids[s : s + window]
            rows.append(part + [0] * (window - len(part)))
            sizes.append(len(part))
            owner.append(number[name])
    words = np.array(rows, dtype=np.int64).reshape(-1, window)
    size, item_of = np.array(sizes, dtype=np.int64), np.array(owner, dtype=np.int64)
    tables = []
    for used in range(1, shingle + 1):
        mine = np.minimum(size, shingle) == used
        if mine.any():
            grams = np.unique(_window_grams(words[mine], size[mine], len(vocab) + 1, used))
            tables.append(Windows(used, grams[grams >= 0], words[mine], size[mine], item_of[mine]))
    return Index(vocab, names, tables)


def _window_grams(words: np.ndarray, sizes: np.ndarray, base: int, shingle: int) -> np.ndarray:
    """Shingle keys per window and offset, -1 beyond the window."""
    n = words.shape[1] - shingle + 1
    out = np.full((len(words), max(n, 0)), -1, dtype=np.int64)
    for o in range(n):
        key = np.zeros(len(words), dtype=np.int64)
        for j in range(shingle):
            key = key * base + words[:, o + j]
        out[:, o] = np.where(o + shingle <= sizes, key, -1)
    return out


def choose_prefixes(index: Index, counts: list[np.ndarray]) -> Index:
    """Order each window's shingles by corpus count; keep the rarest."""
    for table, count in zip(index.tables, counts, strict=True):
        grams = _window_grams(table.words, table.sizes, len(index.vocab) + 1, table.shingle)
        place = np.minimum(np.searchsorted(table.grams, grams), len(table.grams) - 1)
        best = np.where(grams >= 0, count[place], np.iinfo(np.int64).max).argmin(axis=1)
        prefix = grams[np.arange(len(grams)), best]
        table.order, table.offset = np.argsort(prefix, kind="stable"), best
        table.keys, first = np.unique(prefix[table.order], return_index=True)
        table.first = np.append(first, len(prefix))
    return index


def _flat(texts: list[str], vocab: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of all texts, each text followed by a 0; per text its first
    place and its number of words."""
    ids: list[int] = []
    get, sizes = vocab.get, []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        ids.extend([get(w, 0) for w in words])
        ids.append(0)
    size = np.array(sizes, dtype=np.int64)
    return np.array(ids, dtype=np.int64), np.concatenate([[0], np.cumsum(size + 1)])[:-1], size


def _matches(ids: np.ndarray, base: int, table: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(start, window) of every occurrence of a window in the word ids."""
    keys = shingle_keys(ids, base, table.shingle)
    at = np.flatnonzero(keys >= 0)
    slot = np.minimum(np.searchsorted(table.keys, keys[at]), len(table.keys) - 1)
    hit = table.keys[slot] == keys[at]
    at, slot = at[hit], slot[hit]
    none = np.zeros(0, dtype=np.int64)
    starts, windows = [none], [none]
    step = max(1, 4_000_000 // int(np.diff(table.first).max()))
    for lo in range(0, len(at), step):  # bounded memory for a very common prefix
        s, a = slot[lo : lo + step], at[lo : lo + step]
        many = table.first[s + 1] - table.first[s]
        inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window = table.order[np.repeat(table.first[s], many) + inner]
        start = np.repeat(a, many) - table.offset[window]
        size = table.sizes[window]
        inside = (start >= 0) & (start + size <= len(ids))
        start, window, size = start[inside], window[inside], size[inside]
        same = np.ones(len(start), dtype=bool)
        for j in range(table.words.shape[1]):
            live = np.flatnonzero(same & (j < size))
            same[live] = ids[start[live] + j] == table.words[window[live], j]
        starts.append(start[same])
        windows.append(window[same])
    return np.concatenate(starts), np.concatenate(windows)


def _hits(texts: list[str], index: Index) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
    """Per text: its number of words, the hit word places, the item ids."""
    ids, first, sizes = _flat(texts, index.vocab)
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    places: list[list[int]] = [[] for _ in texts]
    names: list[set[int]] = [set() for _ in texts]
    for table in index.tables:
        start, window = _matches(ids, len(index.vocab) + 1, table)
        edge += np.bincount(start, minlength=len(edge))
        edge -= np.bincount(start + table.sizes[window], minlength=len(edge))
        owner = np.searchsorted(first, start, "right") - 1
        for text, item in zip(owner.tolist(), table.item_of[window].tolist(), strict=True):
            names[text].add(item)
    covered = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    owner = np.searchsorted(first, covered, "right") - 1
    for text, place in zip(owner.tolist(), (covered - first[owner]).tolist(), strict=True):
        places[text].append(place)
    return sizes, places, [sorted(index.items[i] for i in n) for n in names]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """Benchmark items in blocks of bounded size; a block holds an item whole."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where(
        "i IS NOT NULL AND t IS NOT NULL"
    )
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-chars // (4 * block_words)))
    if blocks == 1:
        yield [(r.i, r.t) for r in items.collect()]
    else:
        parts = staged(items.withColumn("b", F.pmod(F.xxhash64("i"), F.lit(blocks))), "benchmark-blocks")
        for b in range(blocks):
            yield [(r.i, r.t) for r in parts.where(F.col("b") == b).collect()]


def _indexes(docs: DataFrame, text_col: str, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, shingle: int, block_words: int) -> Iterator:
    """Broadcast indexes with prefixes chosen by counts over all documents."""
    context = docs.sparkSession.sparkContext
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        index = build_index(block, window, shingle)
        shared = context.broadcast(index)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            totals = [np.zeros(len(t.grams), dtype=np.int64) for t in index.tables]
            for batch in batches:
                for texts in text_slices(batch.column(0)):
                    ids = _flat(texts, index.vocab)[0]
                    for table, total in zip(index.tables, totals, strict=True):
                        keys = shingle_keys(ids, len(index.vocab) + 1, table.shingle)
                        keys = keys[keys >= 0]
                        slot = np.minimum(np.searchsorted(table.grams, keys), len(total) - 1)
                        total += np.bincount(slot[table.grams[slot] == keys], minlength=len(total))
            for k, total in enumerate(totals):
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(seen), k)), pa.array(seen), pa.array(total[seen])], names=["k", "gram", "n"]
                )

        sums = docs.select(text_col).mapInArrow(count, "k long, gram long, n long").groupBy("k", "gram").agg(F.sum("n").alias("n"))
        counts = [np.zeros(len(t.grams), dtype=np.int64) for t in index.tables]
        for row in sums.collect():  # one row per shingle of the block at most
            counts[row.k][row.gram] = row.n
        shared.destroy()
        yield context.broadcast(choose_prefixes(index, counts))


def mark_documents(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS, names: tuple[str, ...] = ("n_words", "n_hit", "items"),
) -> DataFrame:
    """``docs`` with the number of words, of hit words, and the sorted ids of
    the benchmark items found.  Input columns of those names are replaced."""
    indexes = _indexes(docs, text_col, benchmark, item_col, item_text_col, window, shingle, block_words)
    only, further = next(indexes), next(indexes, None)
    fields = "`{}` long, `{}` long, `{}` array<string>".format(*names)

    def make_for(shared, with_places: bool) -> Callable:
        def make() -> Callable[[list[str]], list]:
            index = shared.value

            def compute(texts: list[str]) -> list:
                sizes, places, found = _hits(texts, index)
                items = pa.array(found, pa.list_(pa.string()))
                if with_places:
                    return [sizes, pa.array(places, pa.list_(pa.int64())), items]
                return [sizes, [len(p) for p in places], items]

            return compute

        return make

    if further is None:
        return annotate(docs, text_col, fields, make_for(only, False))
    # more blocks: each queries all documents; only hits are kept, written
    # block by block so that an index goes when its block is done, and merged
    n_words, n_hit, items = names
    key = F.struct(F.xxhash64(text_col).alias("a"), F.length(text_col).alias("b"), F.crc32(F.col(text_col).cast("binary")).alias("c"))
    texts = docs.select(text_col, key.alias("k"))
    path = scratch_path(docs.sparkSession, "decontamination-blocks")
    for shared in chain((only, further), indexes):
        hits = annotate(texts, text_col, "w long, p array<long>, i array<string>", make_for(shared, True))
        hits = hits.where(F.size("p") > 0).select("k", "p", "i").dropDuplicates(["k"])
        hits.write.mode("append").parquet(path)
        shared.destroy()
    found = docs.sparkSession.read.schema(hits.schema).parquet(path)
    merged = staged(
        found.groupBy("k").agg(F.size(F.array_distinct(F.flatten(F.collect_list("p")))).cast("long").alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("i")))).alias("i")),
        "decontamination-hits",
    )  # a row per text with hits, an entry per block
    kept = [c for c in docs.columns if c not in names or c == text_col]
    sized = annotate(docs.select(*kept), text_col, f"`{n_words}` long", lambda: lambda ts: [[len(words_of(t)) for t in ts]])
    doc_key = free_name(sized, "_key")
    joined = sized.withColumn(doc_key, key).join(merged, F.col(doc_key) == F.col("k"), "left")
    return joined.withColumn(n_hit, F.coalesce("h", F.lit(0).cast("long"))).withColumn(
        items, F.coalesce("i", F.array().cast("array<string>"))
    ).select(*[c for c in kept if c not in names], *names)


def contaminated(n_words, n_hit):
    """The contract's contamination rule."""
    return (n_hit > 0) & (n_hit * (100 // HIT_PERCENT) >= n_words)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that aren't contaminated, with their columns unchanged."""
    names = tuple(free_name(docs, f"_decontam_{n}") for n in ("words", "hit", "items"))
    marked = mark_documents(docs, benchmark, text_col, names=names, **options)
    return marked.where(~contaminated(F.col(names[0]), F.col(names[1]))).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document the contract's digest columns."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = mark_documents(narrow, benchmark, "text", **options)
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    """SHA-256 of sorted, comma-joined item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
