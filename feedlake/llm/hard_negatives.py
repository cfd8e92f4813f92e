"""Hard-negative mining by angular triangle filtering (operator 11).

A row's score for an anchor is the inner product of their integer vectors
(``floor(scale * x)``).  An anchor's positives are its best rows of the same
label; its hard negatives for a positive are the best rows of other labels
whose score lies in a window below the positive's.

Every row is stored once in a block table with its norm and its angles to a
few reference directions.  For two vectors at angles s and t to a reference,
their own angle lies between |s - t| and min(s + t, 2 pi - s - t); the cosines
of the tightest such interval over all references, times both norms and
rounded outwards, bound the score.  A block keeps the range of its rows'
angles and norms, so whole blocks are passed over first, then rows; only pairs
whose bounds overlap the wanted window get the integer score.  The window
narrows while a task finds better rows.  References steer the filter only:
results are exact whatever they are, and they may come from a bounded sample.

Anchors are taken in groups of bounded bytes.  A group is broadcast, all
blocks are scanned by map tasks without a shuffle of vectors, each task hands
on its best few rows per anchor, and the group's rows are written before its
broadcast is released.

Defined results: rows with a null label, a null vector, or a null or
non-finite component (also one that overflows when scaled) take no part; a row
with a null id is never an anchor and comes after equal scores with an id;
rows of the anchor's own id are not its positives or negatives; repeated rows
each count, an anchor row that repeats gives its rows each time; vectors of
different lengths are compared as if the shorter one ended in zeros, so an
empty vector scores 0; a positive with a negative score has an empty window;
scores beyond 2**53 are computed in whole numbers and clamped to a long.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.common import staged
from feedlake.session import scratch_path

POSITIVES, NEGATIVES = 5, 5
#: Window of a negative's score, in percent of its positive's.
LOW_PERCENT, HIGH_PERCENT = 80, 100
SCALE = 256.0
#: Reference directions, and the vectors they are chosen from.
REFERENCES, SAMPLE = 16, 2048
#: Rows of a block, bytes of vectors sorted together, bytes of a broadcast group.
BLOCK_ROWS, SORT_BYTES, GROUP_BYTES = 1024, 8 << 20, 8 << 20
#: Error allowed in a stored angle (float32, and arccos near its ends).
SLACK = 2e-6
#: Inner products up to here are exact in double precision.
EXACT = float(1 << 53)
LONG_MAX = (1 << 63) - 1

_BLOCK = "n int, dim int, kind string, ids binary, has_id binary, labels binary, norms binary, angles binary, vectors binary"


@dataclass
class Block:
    """Rows with their norms and angles, in order of the angle to one reference."""

    ids: np.ndarray
    has_id: np.ndarray
    labels: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    vectors: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def rows(self, keep: slice | np.ndarray) -> Block:
        return Block(*(getattr(self, f)[keep] for f in self.__dataclass_fields__))

    def pack(self) -> dict:
        small = len(self) == 0 or np.abs(self.vectors).max(initial=0) < 1 << 15
        kind = "int16" if small else "float64"
        return {
            "n": len(self), "dim": self.vectors.shape[1], "kind": kind,
            "ids": self.ids.tobytes(), "has_id": self.has_id.tobytes(), "labels": self.labels.tobytes(),
            "norms": self.norms.tobytes(), "angles": self.angles.astype(np.float32).tobytes(),
            "vectors": self.vectors.astype(kind).tobytes(),
        }

    @staticmethod
    def unpack(row: dict) -> Block:
        n = row["n"]
        return Block(
            np.frombuffer(row["ids"], np.int64), np.frombuffer(row["has_id"], bool), np.frombuffer(row["labels"], np.int64),
            np.frombuffer(row["norms"], np.float64), np.frombuffer(row["angles"], np.float32).reshape(n, -1).astype(np.float64),
            np.frombuffer(row["vectors"], row["kind"]).reshape(n, row["dim"]).astype(np.float64),
        )


def join_blocks(blocks: list[Block]) -> Block:
    """One block of all rows, vectors filled up with zeros."""
    dim = max(b.vectors.shape[1] for b in blocks)
    wide = [np.pad(b.vectors, ((0, 0), (0, dim - b.vectors.shape[1]))) for b in blocks]
    rest = [np.concatenate([getattr(b, f) for b in blocks]) for f in ("ids", "has_id", "labels", "norms", "angles")]
    return Block(*rest, np.concatenate(wide))


# -- angles and bounds ------------------------------------------------------------


def choose_references(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Unit vectors far from each other: each next one is the sample vector
    whose smallest angle to those before is greatest."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 0))
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(n, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles_to(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of every row to every reference; a zero vector counts as upright."""
    dim = min(vectors.shape[1], references.shape[1])
    cosines = vectors[:, :dim] @ references[:, :dim].T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def _outward(products: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number bounds of the score from the angle's interval."""
    products = np.minimum(products, 1e300)
    margin = 1 + products * 1e-9
    high = np.ceil(products * np.cos(np.clip(near - SLACK, 0, np.pi)) + margin)
    low = np.floor(products * np.cos(np.clip(far + SLACK, 0, np.pi)) - margin)
    return np.clip(low, -LONG_MAX, LONG_MAX), np.clip(high, -LONG_MAX, LONG_MAX)


def score_bounds(anchors: Block, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor and row, bounds that hold their integer score."""
    near = np.zeros((len(anchors), len(rows)))
    far = np.full_like(near, np.pi)
    for r in range(anchors.angles.shape[1]):
        s, t = anchors.angles[:, r, None], rows.angles[None, :, r]
        np.maximum(near, np.abs(s - t), out=near)
        total = s + t
        np.minimum(far, np.minimum(total, 2 * np.pi - total), out=far)
    return _outward(anchors.norms[:, None] * rows.norms[None, :], near, far)


def block_bounds(anchors: Block, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor, bounds that hold its score with any row of the block."""
    least, most = rows.angles.min(axis=0), rows.angles.max(axis=0)
    s = anchors.angles
    near = np.maximum(0, np.maximum(least - s, s - most)).max(axis=1)
    lo_total, hi_total = s + least, s + most
    # the greatest min(x, 2 pi - x) for x between the two sums
    far = np.where(
        (lo_total <= np.pi) & (hi_total >= np.pi), np.pi,
        np.maximum(np.minimum(lo_total, 2 * np.pi - lo_total), np.minimum(hi_total, 2 * np.pi - hi_total)),
    ).min(axis=1)
    low, high = _outward(anchors.norms * rows.norms.max(), near, far)
    low_small, high_small = _outward(anchors.norms * rows.norms.min(), near, far)
    return np.minimum(low, low_small), np.maximum(high, high_small)


def scores_of(anchors: Block, rows: Block, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer scores of the pairs (anchors[a[i]], rows[b[i]])."""
    dim = min(anchors.vectors.shape[1], rows.vectors.shape[1])
    out = np.empty(len(a), dtype=np.int64)
    exact = not len(a) or anchors.norms[a].max() * rows.norms[b].max() < EXACT / 2
    step = max(1, (4 << 20) // max(1, dim))
    for i in range(0, len(a), step):
        x, y = anchors.vectors[a[i : i + step], :dim], rows.vectors[b[i : i + step], :dim]
        if exact:
            out[i : i + step] = np.einsum("ij,ij->i", x, y)
        else:
            out[i : i + step] = [
                max(-LONG_MAX, min(LONG_MAX, sum(int(p) * int(q) for p, q in zip(u, v, strict=True)))) for u, v in zip(x, y, strict=True)
            ]
    return out


# -- the block table ---------------------------------------------------------------


def _blocks_of(batch: list[tuple], references: np.ndarray) -> Iterator[Block]:
    """Sort rows by their nearest reference and the angle to it; cut them up."""
    dims = np.array([len(v) for _, _, v in batch])
    vectors = np.zeros((len(batch), int(dims.max(initial=0))))
    for i, (_, _, v) in enumerate(batch):
        vectors[i, : len(v)] = v
    biggest = np.abs(vectors).max(axis=1, initial=0)
    unit = np.where(biggest > 0, biggest, 1)  # so that squares can't overflow
    norms = np.linalg.norm(vectors / unit[:, None], axis=1) * unit
    angles = angles_to(vectors / unit[:, None], norms / unit, references)
    cell = angles.argmin(axis=1)
    order = np.lexsort((angles[np.arange(len(batch)), cell], cell))
    whole = Block(
        np.array([i or 0 for i, _, _ in batch], dtype=np.int64), np.array([i is not None for i, _, _ in batch], dtype=bool),
        np.array([label for _, label, _ in batch], dtype=np.int64), norms, angles, vectors,
    ).rows(order)
    edges = np.flatnonzero(np.diff(cell[order])) + 1
    for part in np.split(np.arange(len(batch)), edges):
        for start in range(0, len(part), BLOCK_ROWS):
            yield whole.rows(part[start : start + BLOCK_ROWS])


def block_table(rows: DataFrame, references: np.ndarray, scale: float = SCALE) -> DataFrame:
    """Rows (id long, label long, vector array) as blocks, task by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([b.pack() for b in _blocks_of(held, references)], schema=schema)

        held, size, widest = [], 0, 0
        for batch in batches:
            offsets = batch.column("vector").offsets.to_numpy()
            flat = batch.column("vector").values.to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                for i, key, label in zip(range(batch.num_rows), batch.column("id").to_pylist(), batch.column("label").to_pylist(), strict=True):
                    vector = np.floor(scale * flat[offsets[i] : offsets[i + 1]].astype(np.float64))
                    if not np.isfinite(vector).all():
                        continue
                    widest = max(widest, len(vector))
                    held.append((key, label, vector))
                    size = len(held) * 8 * max(1, widest)
                    if size >= SORT_BYTES:
                        yield emit(held)
                        held, size, widest = [], 0, 0
        if held:
            yield emit(held)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_BLOCK))
    return rows.mapInArrow(run, _BLOCK)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block.unpack(batch.slice(i, 1).to_pylist()[0])


# -- best rows per anchor -------------------------------------------------------------


class Best:
    """The first ``k`` rows per slot by (score descending, id, no id last)."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = np.empty(0, np.int64)
        self.score, self.key, self.none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        #: score of the last of ``k`` rows: only as good ones still matter
        self.floor = np.full(slots, -LONG_MAX, dtype=np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray, none: np.ndarray) -> None:
        good = score >= self.floor[slot]
        if not good.any():
            return
        slot = np.concatenate([self.slot, slot[good]])
        score = np.concatenate([self.score, score[good]])
        key, none = np.concatenate([self.key, key[good]]), np.concatenate([self.none, none[good]])
        order = np.lexsort((key, none, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        first = rank < self.k
        self.slot, order = slot[first], order[first]
        self.score, self.key, self.none = score[order], key[order], none[order]
        last = rank[first] == self.k - 1
        self.floor[self.slot[last]] = self.score[last]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.slot), pa.array(self.score), pa.array(self.key, mask=self.none)], names=["slot", "score", "id"]
        )


_FOUND = "slot long, score long, id long"


def _pairs(group: Block, rows: Block, at_least: np.ndarray, at_most: np.ndarray | None, same: bool) -> Iterator[tuple]:
    """Pairs whose bounds overlap [at_least, at_most], with integer scores."""
    low, high = block_bounds(group, rows)
    open_ = high >= at_least
    if at_most is not None:
        open_ &= low <= at_most
    live = np.flatnonzero(open_)
    step = max(1, (1 << 20) // len(rows))
    for start in range(0, len(live), step):
        part = live[start : start + step]
        low, high = score_bounds(group.rows(part), rows)
        keep = high >= at_least[part, None]
        if at_most is not None:
            keep &= low <= at_most[part, None]
        keep &= (group.labels[part, None] == rows.labels[None, :]) == same
        keep &= ~rows.has_id[None, :] | (group.ids[part, None] != rows.ids[None, :])
        a, b = np.nonzero(keep)
        a = part[a]
        yield a, b, scores_of(group, rows, a, b)


def find_positives(group: Block, blocks: Iterator[Block], k: int) -> Best:
    best = Best(len(group), k)
    for rows in blocks:
        for a, b, score in _pairs(group, rows, best.floor, None, same=True):
            best.add(a, score, rows.ids[b], ~rows.has_id[b])
    return best


def windows(positive: np.ndarray, known: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative, per positive; none: an empty window."""
    flat = [(-(-low * int(p) // 100), high * int(p) // 100) if k else (1, 0) for p, k in zip(positive.ravel(), known.ravel(), strict=True)]
    least, most = np.array(flat, dtype=np.int64).reshape(-1, 2).T
    return least.reshape(positive.shape), most.reshape(positive.shape)


def find_negatives(group: Block, blocks: Iterator[Block], least: np.ndarray, most: np.ndarray, k: int) -> Best:
    """``least`` and ``most``: windows per anchor and positive.  A slot is
    the anchor's number times the positives, plus the positive's place."""
    n_pos = least.shape[1]
    best = Best(least.size, k)
    some = (least <= most).any(axis=1)
    most_any = np.where(least <= most, most, -LONG_MAX).max(axis=1)
    for rows in blocks:
        floors = np.maximum(least, best.floor.reshape(least.shape))
        need = np.where(least <= most, floors, LONG_MAX).min(axis=1)
        need[~some] = LONG_MAX
        for a, b, score in _pairs(group, rows, need, most_any, same=False):
            for p in range(n_pos):
                fits = (score >= least[a, p]) & (score <= most[a, p])
                best.add(a[fits] * n_pos + p, score[fits], rows.ids[b[fits]], ~rows.has_id[b[fits]])
    return best


# -- jobs ------------------------------------------------------------------------------


def _scan(blocks: DataFrame, find: Callable[[Iterator[Block]], Best]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield find(_read(batches)).batch()

    return blocks.mapInArrow(run, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each slot, of all tasks' first ones."""
    order = W.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _groups(anchors: DataFrame, size: int) -> Iterator[Block]:
    """Anchor blocks, put together up to ``size`` bytes; one partition of the
    blocks at a time reaches the driver."""
    held, bytes_ = [], 0
    for row in anchors.toLocalIterator():
        block = Block.unpack(row.asDict())
        if held and bytes_ + block.vectors.nbytes > size:
            yield join_blocks(held)
            held, bytes_ = [], 0
        held.append(block)
        bytes_ += block.vectors.nbytes
    if held:
        yield join_blocks(held)


def _references(rows: DataFrame, n: int, scale: float) -> np.ndarray:
    """From a bounded sample, spread over the rows by a hash."""
    total = rows.count()
    share = min(1.0, SAMPLE / max(1, total))
    picked = rows.where(F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 20)) <= int(share * (1 << 20)))
    sample = [np.floor(scale * np.array(r[0][:4096], dtype=np.float64)) for r in picked.select("vector").limit(2 * SAMPLE).collect()]
    sample = [v / np.abs(v).max() for v in sample if len(v) and np.isfinite(v).all() and np.abs(v).max() > 0]
    dim = max((len(v) for v in sample), default=1)
    return choose_references(np.array([np.pad(v, (0, dim - len(v))) for v in sample]).reshape(-1, dim), n)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    scale: float = SCALE,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for the rows of ``vectors`` where ``is_anchor`` holds.

    ``label`` is an integer column expression over ``vectors``.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"),
        (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("anchor"),
    ).where(F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
    references = _references(rows, REFERENCES, scale)
    blocks = staged(block_table(rows.select("id", "label", "vector"), references, scale), "angle-blocks")
    anchors = staged(block_table(rows.where("anchor").select("id", "label", "vector"), references, scale), "anchor-blocks")
    path = scratch_path(spark, "hard-negatives")
    out = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    out.write.parquet(path)
    for group in _groups(anchors, group_bytes):
        _mine_group(spark, blocks, group, n_positives, n_negatives, low_percent, high_percent).write.mode("append").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _mine_group(spark: SparkSession, blocks: DataFrame, group: Block, n_pos: int, n_neg: int, low: int, high: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(group)
    best = _first(_scan(blocks, lambda it: find_positives(sent.value, it, n_pos)), n_pos).collect()  # n_pos an anchor
    shape = (len(group), n_pos)
    score, known = np.zeros(shape, np.int64), np.zeros(shape, bool)
    ids: dict[int, int | None] = {}
    for r in best:
        score[r.slot, r.rank - 1], known[r.slot, r.rank - 1] = r.score, True
        ids[r.slot * n_pos + r.rank - 1] = r.id
    least, most = windows(score, known, low, high)
    bounds = spark.sparkContext.broadcast((least, most))
    found = _first(_scan(blocks, lambda it: find_negatives(sent.value, it, *bounds.value, n_neg)), n_neg)
    slots = spark.createDataFrame(
        [(s, int(group.ids[s // n_pos]), i, int(score[s // n_pos, s % n_pos])) for s, i in ids.items()],
        "slot long, anchor_id long, positive_id long, positive_score long",
    )
    return found.join(slots, "slot").select(  # one row per anchor and positive of the group
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
