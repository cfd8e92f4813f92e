"""Quality classifier: regularised quadratic discriminant (operator 1).

Each whole text becomes a short vector of transformed statistics (logarithms
of counts, square roots of shares).  The labelled rows outside the held-out
fold give, per class, a count, a mean and a covariance (sums over all of them,
computed in Spark).  Each class covariance is shrunk towards the pooled one
and its diagonal; its Cholesky factor is computed once.  The score is the
logistic of the difference of the two log densities (Mahalanobis distance and
log determinant) plus the log prior odds.

Labels, language, source and id are no inputs of a score: the model sees the
text's statistics only.

Defined results: null and empty texts have zero statistics and a score like
any other; labels that are null, or of a null id, teach nothing; a repeated
label row counts each time; without rows of both classes the score is the
share of label 1 (0.5 without any label); empty input gives empty output.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate, held_out, staged

#: Fold of the held-out documents: crc32(doc_id) mod FOLDS is 1.
FOLDS = 3
#: Shrinkage of a class covariance to the pooled one, and of both to a diagonal.
TO_POOLED, TO_DIAGONAL = 0.2, 0.05
FEATURES = (
    "words", "word_length", "word_spread", "upper", "upper_words", "digits", "symbols", "exclaims", "bars", "stops",
    "distinct_words", "repeat_pairs", "repeat_triples", "repeat_lines", "line_length",
)
_CAPITALS = bytes(range(0x41, 0x5B))


def _lost(data: bytes, chars: bytes) -> int:
    """How many bytes of ``data`` are among ``chars``."""
    return len(data) - len(data.translate(None, chars))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of ``FEATURES``."""
    data = text.encode()
    words = data.split()
    n, chars = len(words), max(1, len(data))
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), np.float64, n)
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    codes = np.array([number[w] for w in words], dtype=np.int64)
    pairs = codes[:-1] * len(number) + codes[1:]
    distinct_pairs, pair_codes = np.unique(pairs, return_inverse=True)
    triples = pair_codes[:-1] * len(number) + codes[2:] if n > 2 else pairs[:0]
    lines = [line for line in data.split(b"\n") if line.strip()]
    capitals = sum(1 for w in words if w.isupper() and len(w) > 1)
    return [
        np.log1p(n),
        np.log(lengths.mean()),
        np.log1p(lengths.std()),
        np.sqrt(_lost(data, _CAPITALS) / chars),
        np.sqrt(capitals / n),
        np.sqrt(_lost(data, b"0123456789") / chars),
        np.sqrt(_lost(data, b"#*$%&<>=+^~@\\{}[]_") / n),
        np.sqrt(_lost(data, b"!?") / n),
        np.sqrt(_lost(data, b"|") / n),
        np.sqrt(_lost(data, b".") / n),
        np.log(len(number) / n),
        np.sqrt(1 - len(distinct_pairs) / max(1, len(pairs)) if len(pairs) else 0.0),
        np.sqrt(1 - len(np.unique(triples)) / len(triples) if len(triples) else 0.0),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.log1p(n / len(lines)),
    ]


@dataclass
class Model:
    """Means, Cholesky factors (inverse) and offsets of the two classes."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    whiteners: list[np.ndarray]
    offsets: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        if not self.means:
            return np.full(len(x), self.offsets[0])
        z = (x - self.centre) / self.scale
        logs = [
            offset - 0.5 * np.square((z - mean) @ white.T).sum(axis=1)
            for mean, white, offset in zip(self.means, self.whiteners, self.offsets, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit_moments(n: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Model:
    """The model for the counts (2), sums (2, d) and cross products (2, d, d)."""
    if n.min() < 2:
        return Model(np.zeros(0), np.ones(0), [], [], [float(n[1] / n.sum()) if n.sum() else 0.5])
    centre = sums.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / n.sum() - centre**2, 1e-12))
    means, covariances = [], []
    for c in (0, 1):
        mean = sums[c] / n[c]
        covariances.append((squares[c] / n[c] - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()
    whiteners, offsets = [], []
    for c in (0, 1):
        cov = (1 - TO_POOLED) * covariances[c] + TO_POOLED * pooled
        cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.maximum(np.diag(cov), 1e-3))
        factor = np.linalg.cholesky(cov + 1e-6 * np.eye(len(cov)))
        whiteners.append(np.linalg.inv(factor))
        offsets.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum()))
    return Model(centre, scale, means, whiteners, offsets)


def fit(rows: DataFrame, label: str, x: str) -> Model:
    """Fit on rows with a 0/1 label and an array of statistics; the sums are
    computed in Spark, one small vector of cells per class and task."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.array(batch.column(1).to_pylist(), dtype=np.float64)
            for c in (0, 1):
                part = values[y == c]
                total[c] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "v"])

    sums = rows.select(F.col(label).cast("int"), x).mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    total = np.zeros(2 * (1 + d + d * d))
    for row in sums.collect():  # a few hundred cells
        total[row.cell] = row.v
    total = total.reshape(2, -1)
    return fit_moments(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = FOLDS
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    The texts are read once; their statistics are staged and used both for
    the fit (joined with the labels) and for the scores.
    """

    def make() -> Callable[[list[str]], list]:
        kind = pa.list_(pa.float64())
        return lambda texts: [pa.array([statistics(t) for t in texts], kind)]

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = annotate(rows, "text", "x array<double>", make).drop("text")
    rows = staged(rows.withColumn("held_out", held_out(F.col("doc_id"), folds)), "text-statistics")
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).alias("y")).where(F.col("y").isin(0, 1))
    model = fit(rows.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("l_id")), "y", "x")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
            p = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    out = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return rows.select("doc_id", "held_out", "x").mapInArrow(score, out)
