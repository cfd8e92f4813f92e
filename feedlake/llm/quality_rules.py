"""Quality rules with host verdicts (operator 8).

Every text is measured in one pass.  Its own rules decide ``base_failed``.
The failures are then counted per host, and each host's failure rate is shrunk
towards the corpus with an empirical beta prior, fitted by moments over all
hosts.  A host is bad if its posterior leaves little doubt that it fails much
more often than the corpus: the rate less ``DOUBT`` posterior deviations is
above ``MARGIN`` times the corpus' rate.  Where the hosts differ no more than
chance explains, the prior is strong and no host is bad.  The verdict is joined
back: documents of a bad host must also meet the strict rules.  The join
carries only the (few) bad hosts, and Spark may split a hot host's rows since
nothing groups by host.

Defined results: null, empty and blank texts have no words and fail; a null
host has no verdict of its own; repeated rows each count; empty input gives
empty output.  Input columns named like an output column are replaced.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate, free_name, staged

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
#: A bad host's rate, less so many posterior deviations (97.5 % one-sided), is
#: above this multiple of the corpus' rate; its documents are held to strict rules.
DOUBT, MARGIN = 1.96, 1.5
#: Most documents that the prior may weigh.
MOST_STRENGTH = 1000.0
#: Strict rules: percent of symbols per word, of repeated lines per word.
STRICT_SYMBOL_PERCENT = 10
STRICT_LINE_PERCENT = 10

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _codes(values: np.ndarray) -> np.ndarray:
    return pd.factorize(values)[0].astype(np.int64)


def repeat_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per text, its words that lie in a window found twice or more in it.

    Window identity is exact: words become integer codes, and codes of growing
    runs are paired and coded again, so no hash stands for a window.
    """
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    total = int(sizes.sum())
    doc = np.repeat(np.arange(len(words)), sizes)
    if total < window + 1:
        return np.zeros(len(words), dtype=np.int64)
    seen: dict[bytes, int] = defaultdict(itertools.count().__next__)
    word = np.array([seen[w] for ws in words for w in ws], dtype=np.int64)
    run = word
    for step in range(1, window):
        run = _codes(run[: total - step] * len(seen) + word[step:])
    starts = np.flatnonzero(doc[: total - window + 1] == doc[window - 1 :])
    keys = _codes(run[starts] * len(words) + doc[starts])
    repeated = starts[np.bincount(keys)[keys] > 1] if len(keys) else starts
    edge = np.bincount(repeated, minlength=total + 1) - np.bincount(repeated + window, minlength=total + 1)
    covered = np.cumsum(edge)[:total] > 0
    return np.bincount(doc[covered], minlength=len(words))


def measures() -> Callable[[list[str]], list]:
    """The function that maps texts to the columns of ``STATS``."""

    def compute(texts: list[str]) -> list:
        raw = [t.encode() for t in texts]
        words = [r.split() for r in raw]  # bytes split on exactly \x20 \x09-\x0D
        chars, symbols, dup_lines = [], [], []
        for text, data in zip(texts, raw, strict=True):
            chars.append(len(text) - (len(data) - len(data.translate(None, BLANKS))))
            symbols.append(len(data) - len(data.translate(None, SYMBOLS)))
            lines = [line for line in data.split(b"\n") if line.strip()]
            dup_lines.append(len(lines) - len(set(lines)))
        return [[len(w) for w in words], chars, symbols, dup_lines, repeat_words(words)]

    return compute


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat * 100 > n_words * REPEAT_PERCENT)


def strict_failed(n_words: Column, n_symbols: Column, n_dup_lines: Column) -> Column:
    return (n_symbols * 100 > n_words * STRICT_SYMBOL_PERCENT) | (
        n_dup_lines * 100 > n_words * STRICT_LINE_PERCENT
    )


def host_rates(flags: DataFrame, host_col: str, failed_col: str) -> DataFrame:
    """Per host: documents, failures, the failure rate shrunk by a beta prior
    whose mean and strength are fitted by moments over all hosts, its posterior
    deviation, and the corpus' rate."""
    hosts = (
        flags.where(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(failed_col).cast("long")).alias("f"))
    )
    hosts = staged(hosts, "host-failures")  # one row per host
    whole = hosts.agg(
        F.count(F.lit(1)).alias("h"), F.sum("n").alias("n"), F.sum("f").alias("f")
    ).first()
    if not whole.n:
        return hosts.withColumns({"rate": F.lit(0.0), "deviation": F.lit(0.0), "corpus": F.lit(0.0)})
    mean = whole.f / whole.n
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("f") / F.col("n") - mean, 2))).first()[0] / whole.n
    noise = mean * (1 - mean)
    excess = spread - noise * whole.h / whole.n
    strength = MOST_STRENGTH if excess <= 0 else min(MOST_STRENGTH, max(1.0, noise / excess - 1))
    hosts = hosts.withColumn("rate", (F.col("f") + mean * strength) / (F.col("n") + strength))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + strength + 1))
    return hosts.withColumns({"deviation": deviation, "corpus": F.lit(float(mean))})


def _verdicts(rows: DataFrame, flags: DataFrame, host_col: str, failed: str, strict: str, kept: str, margin: float) -> DataFrame:
    """``rows`` with the boolean column ``kept``."""
    bad = free_name(rows, "_bad_host")
    hosts = (
        host_rates(flags, host_col, failed)
        .where(F.col("rate") - DOUBT * F.col("deviation") > margin * F.col("corpus"))
        .select(F.col("host").alias(bad))
    )
    joined = rows.join(hosts, F.col(host_col) == F.col(bad), "left")
    return joined.withColumn(
        kept, ~F.col(failed) & ~(F.col(bad).isNotNull() & F.col(strict))
    ).drop(bad)


def rule_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    margin: float = MARGIN,
) -> DataFrame:
    """Per document: id, the measures, ``base_failed`` and ``kept``.

    The texts are read once: the measures, a few dozen bytes a document, are
    staged, and host counts and verdicts work on those.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")
    )
    stats = annotate(narrow, "text", STATS, measures).drop("text")
    stats = staged(
        stats.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))).withColumn(
            "strict_failed", strict_failed(F.col("n_words"), F.col("n_symbols"), F.col("n_dup_lines"))
        ),
        "rule-measures",
    )
    return _verdicts(stats, stats, "host", "base_failed", "strict_failed", "kept", margin).drop(
        "host", "strict_failed"
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", margin: float = MARGIN
) -> DataFrame:
    """The documents that the rules keep, with their columns unchanged.

    The host counts need a pass of their own over the texts; the second pass
    carries the rows, so no text is shuffled or written in between.
    """
    names = [free_name(docs, f"_rule_{i}") for i in range(5)]
    fields = ", ".join(f"{n} long" for n in names)
    failed, strict, kept = (free_name(docs, f"_{n}") for n in ("failed", "strict", "kept"))
    words, _, symbols, lines, repeats = names

    def flagged(rows: DataFrame) -> DataFrame:
        return annotate(rows, text_col, fields, measures).withColumn(
            failed, base_failed(F.col(words), F.col(repeats))
        ).withColumn(strict, strict_failed(F.col(words), F.col(symbols), F.col(lines)))

    flags = flagged(docs.select(host_col, text_col)).select(host_col, failed)
    out = _verdicts(flagged(docs), flags, host_col, failed, strict, kept, margin)
    return out.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
