"""SimHash near-duplicates by the generalised pigeonhole (operator 9).

1. Every text gets a 64-bit fingerprint (majority bits of the XXH64 hashes of
   its word shingles); equal fingerprints collapse to one row, so exact copies
   never meet in a join.
2. Bits are grouped into partitions, correlated bits together (one aggregate
   of 64x64 co-occurrence counts).  For several partition counts a dynamic
   programme shares out ``max_bits + 1`` threshold units over the partitions:
   with ``t`` units a partition is probed for keys within ``t - 1`` bits (0
   units: not probed).  Fingerprints within ``max_bits`` bits meet in at least
   one probed partition.  Costs come from the key counts over all
   fingerprints.
3. Probe keys join the partition keys; the join condition verifies the exact
   distance, so only true links leave the join.
4. A key shared by more than ``hot_bucket`` fingerprints is not joined.  Its
   fingerprints, and those that probe it, meet through the points of their
   Hamming balls instead: two fingerprints within 3 bits share a point that is
   within 1 bit of one and 2 bits of the other.  That is linear in the
   fingerprints (2,081 points each) and exact; a point gathers at most 2,081
   of them.  ``hot_bucket`` is twice that, where the join begins to cost more.
5. Links contract to components by alternating large-star and small-star
   steps, each staged in the shared folder.

Defined results: null, empty and blank texts have fingerprint zero and link
like any other; ``component_id`` is the smallest non-null id reachable (null
if there is none); repeated rows each give a row; empty input, empty output.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate, free_name, staged

BITS = 64
SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Partition counts among which the dynamic programme's costs decide.
PARTITION_COUNTS = (2, 3, 4, 5, 6)
HOT_BUCKET = 2 * (1 + BITS + math.comb(BITS, 2))
#: Cost of a probe row against a verified candidate (a row is shuffled).
PROBE_COST = 4.0


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a UTF-8 text."""
    words = data.lower().split()  # bytes: lower-cases A-Z only, splits on \x20 \x09-\x0D
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    begins = [0, *ends[: n - 1]]
    stops = [e - 1 for e in ends[-n:]]
    digest = xxhash.xxh64_intdigest
    votes, total = np.zeros(BITS, dtype=np.int64), n
    for lo in range(0, n, 65536):
        hashes = np.fromiter(
            (digest(line[a:b], seed) for a, b in zip(begins[lo : lo + 65536], stops[lo : lo + 65536], strict=True)),
            np.uint64,
        )
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.int64)[0])


def with_fingerprint(
    docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint_bits", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each whole text."""

    def make() -> Callable[[list[str]], list]:
        return lambda texts: [[fingerprint(t.encode(), shingle, seed) for t in texts]]

    return annotate(docs, text_col, f"`{out_col}` long", make)


# --- partitions and thresholds ---------------------------------------------


@dataclass(frozen=True)
class Part:
    """A partition: its bits, and the largest distance its probes cover."""

    bits: tuple[int, ...]
    reach: int


def _bit_moments(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64x64 counts of bits set together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(values)
        cells = np.concatenate([both.ravel(), [n]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    sums = prints.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1)
    for row in sums.toLocalIterator():  # 4,097 rows whatever the input
        flat[row.cell] = row.n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of near equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for g in range(parts):
        size = len(free) // (parts - g)
        first = max(free, key=lambda b: (corr[b, free].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(tuple(sorted(group)))
    return groups


def allot(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Share ``units`` out over partitions at the least total cost;
    ``costs[i][t]`` is the cost of partition ``i`` with ``t`` units."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * units
    for cost in costs:
        best = [
            min((best[u - t][0] + cost[t], [*best[u - t][1], t]) for t in range(u + 1) if t < len(cost))
            for u in range(units + 1)
        ]
    return best[units]


def _mask(bits: tuple[int, ...]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def plan_parts(prints: DataFrame, max_bits: int = MAX_BITS, counts: tuple[int, ...] = PARTITION_COUNTS) -> tuple[list[Part], int]:
    """The cheapest partitions and thresholds for these fingerprints, and the
    largest number of fingerprints that share a key of a probed partition."""
    n, both = _bit_moments(prints)
    groups = [(m, g) for m in counts for g in group_bits(n, both, m)]
    keys = prints.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(_mask(b))).alias("k")) for i, (_, b) in enumerate(groups)])
        ).alias("x")
    ).groupBy("x.g", "x.k").agg(F.count(F.lit(1)).alias("c"))
    found = keys.groupBy("g").agg(
        F.sum(F.col("c").cast("double") * F.col("c")).alias("same"), F.max("c").alias("most")
    ).collect()  # one row per partition tried
    same = {r.g: r.same for r in found}
    most = {r.g: r.most for r in found}
    p = np.diag(both) / max(n, 1)
    differ = np.clip(2 * p * (1 - p), 1e-3, 0.5)
    options = []
    for m in counts:
        mine = [i for i, (c, _) in enumerate(groups) if c == m]
        costs = []
        for i in mine:
            bits = groups[i][1]
            near = [1.0]  # of pairs with j differing bits, against equal ones
            for b in bits:
                odds = differ[b] / (1 - differ[b])
                near = [x + (near[j - 1] * odds if j else 0) for j, x in enumerate([*near, 0.0])]
            costs.append([0.0] + [
                PROBE_COST * n * sum(math.comb(len(bits), j) for j in range(t)) + same.get(i, 0.0) / 2 * sum(near[:t])
                for t in range(1, max_bits + 2)
            ])
        cost, units = allot(costs, max_bits + 1)
        options.append((cost, m, units, mine))
    _, _, units, mine = min(options)
    chosen = [(i, u) for i, u in zip(mine, units, strict=True) if u]
    return [Part(groups[i][1], u - 1) for i, u in chosen], max((most.get(i, 0) for i, _ in chosen), default=0)


# --- links -------------------------------------------------------------------


def _keyed(prints: DataFrame, parts: list[Part], probes: bool) -> DataFrame:
    """(part, key, fp): own keys, or with ``probes`` also those within reach."""
    def keys(i: int, part: Part) -> Column:
        flips = [0] + [
            _mask(c) for r in range(1, (part.reach if probes else 0) + 1) for c in itertools.combinations(part.bits, r)
        ]
        own = F.col("fp").bitwiseAND(F.lit(_mask(part.bits)))
        return F.transform(
            F.array(*[F.lit(f).cast("long") for f in flips]),
            lambda x: F.struct(F.lit(i).alias("part"), own.bitwiseXOR(x).alias("key")),
        )

    out = [keys(i, part) for i, part in enumerate(parts)]
    return prints.select("fp", F.explode(F.concat(*out)).alias("x")).select("x.part", "x.key", "fp")


def _ball_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect all fingerprints within ``max_bits`` of each other,
    through shared points: inner radius ``max_bits // 2``, outer the rest."""
    inner, outer = max_bits // 2, max_bits - max_bits // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = [(sum(1 << b for b in c), r <= inner) for r in range(outer + 1) for c in itertools.combinations(range(BITS), r)]
        masks = np.array([f for f, _ in flips], dtype=np.uint64).view(np.int64)
        close = np.array([c for _, c in flips])
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(values), 256):
                part = values[lo : lo + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((part[:, None] ^ masks[None, :]).ravel()),
                        pa.array(np.repeat(part, len(masks))),
                        pa.array(np.tile(close, len(part))),
                    ],
                    names=["point", "fp", "close"],
                )

    points = prints.select("fp").mapInArrow(run, "point long, fp long, close boolean")
    at = points.groupBy("point").agg(
        F.min(F.when(F.col("close"), F.col("fp"))).alias("u"), F.collect_set("fp").alias("all")
    )  # at most one ball of fingerprints around a point
    return at.where(F.col("u").isNotNull() & (F.size("all") > 1)).select("u", F.explode("all").alias("v")).where("u != v")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET, counts: tuple[int, ...] = PARTITION_COUNTS) -> DataFrame:
    """Links (u, v), u < v, between distinct fingerprints ``fp`` that connect
    exactly the pairs at ``max_bits`` or fewer differing bits."""
    parts, most = plan_parts(prints, max_bits, counts)
    index, probe = _keyed(prints, parts, False), _keyed(prints, parts, True)
    balls = None
    if most > hot_bucket:
        hot = staged(
            index.groupBy("part", "key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot_bucket).drop("c"), "hot-keys"
        )
        balls = _ball_links(probe.join(hot, ["part", "key"], "left_semi").select("fp").distinct(), max_bits)
        index = index.join(hot, ["part", "key"], "left_anti")
    a, b = index.alias("a"), probe.alias("b")
    links = a.join(
        b,
        (F.col("a.part") == F.col("b.part"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits),
    ).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    if balls is not None:
        links = links.unionByName(balls.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); the root is the
    smallest node of the component.  Large-star and small-star steps alternate
    until no link changes."""
    edges = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u != v")
            .distinct()
        )
        edges = staged(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v"), F.col("v")).distinct()
            )
        state = now


def _classes(prints: DataFrame, max_bits: int, hot_bucket: int) -> DataFrame:
    """(fp, component_id) for every fingerprint linked to another one;
    ``prints`` has (fp, rep)."""
    nodes = components(near_links(prints, max_bits, hot_bucket))
    rooted = prints.join(nodes, F.col("fp") == F.col("node")).select("fp", "root", "rep")
    ids = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """One row per document: doc_id, ``fingerprint`` (16 hex digits) and
    ``component_id``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(with_fingerprint(rows, "text", "fp", shingle).drop("text"), "fingerprints")
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    linked = _classes(prints, max_bits, hot_bucket)
    # staged, so that the last join has two plain exchanges and Spark can
    # split the rows of a fingerprint that very many documents share
    own = staged(
        prints.join(linked, "fp", "left").select(F.col("fp").alias("p"), F.coalesce("component_id", "rep").alias("component_id")),
        "fingerprint-classes",
    )
    return rows.join(own, F.col("fp") == F.col("p")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """One document of each component, the one with the smallest id (null ids
    last), with its columns unchanged.  Different rows that repeat that id
    inside the component are told apart by a hash of the row; of identical
    rows one stays.  The rows join their winners by fingerprint, id and row
    hash together, so the copies of a large group spread over all tasks."""
    fp, tag = free_name(docs, "_fp"), free_name(docs, "_row")
    base = [F.col(f"`{c}`") for c in docs.columns]
    ident = F.col(f"`{id_col}`")
    rows = with_fingerprint(docs, text_col, fp, shingle).withColumn(tag, F.xxhash64(*base))
    narrow = rows.select(F.col(fp).alias("fp"), ident.isNull().alias("no_id"), ident.alias("id"), F.col(tag).alias("tag"))
    counted = narrow.groupBy("fp", "no_id", "id", "tag").agg(F.count(F.lit(1)).alias("n"))
    prints = staged(
        counted.groupBy("fp").agg(F.min(F.struct("no_id", "id", "tag", "n")).alias("w")), "distinct-fingerprints"
    )
    nodes = components(near_links(prints, max_bits, hot_bucket))
    winners = staged(
        prints.join(nodes, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp").alias("class"))
        .agg(F.min(F.struct("w.no_id", "w.id", "w.tag", "w.n", "fp")).alias("w"))
        .select("w.fp", "w.id", "w.tag", "w.n"),
        "class-winners",
    )

    def winning(subset: DataFrame) -> DataFrame:
        w = subset.select(F.col("fp").alias("w_fp"), F.col("id").alias("w_id"), F.col("tag").alias("w_tag")).alias("w")
        r = rows.alias("r")
        return r.join(
            w,
            (F.col(f"r.{fp}") == F.col("w.w_fp"))
            & F.col(f"r.`{id_col}`").eqNullSafe(F.col("w.w_id"))
            & (F.col(f"r.{tag}") == F.col("w.w_tag")),
            "left_semi",
        ).select(*base)

    repeated = winners.where("n > 1")
    if repeated.isEmpty():
        return winning(winners)
    return winning(winners.where("n = 1")).unionByName(winning(repeated).dropDuplicates())
