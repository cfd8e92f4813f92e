"""Run report: per feed, files seen, rows produced and files quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.columns import UNRECOGNISED
from feedlake.operators import feeds


def run_report(routed: DataFrame, doc_col: str = "doc") -> DataFrame:
    """``(kind, n_files, n_rows, n_bad, status)`` for every kind seen.

    One scan of the landing frame, each document parsed once: its row count
    and problem list are column expressions, summed by a single aggregation (partial
    aggregates per task, one tiny shuffle).  ``status`` is ``ok`` when no
    file of the kind was quarantined, else ``partial``; unrecognised files
    are counted, never parsed.
    """
    parsed = routed if feeds.REASONS_COL in routed.columns else feeds.parse_documents(routed, doc_col)
    per_doc = parsed.select(
        "kind",
        feeds.typed_row_count(parsed).alias("_rows"),
        (F.size(feeds.problem_reasons(parsed)) > 0).cast("long").alias("_bad"),
    )
    out = per_doc.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("_rows").alias("n_rows"),
        F.sum("_bad").alias("n_bad"),
    )
    return out.select(
        "kind",
        "n_files",
        "n_rows",
        "n_bad",
        F.when(F.col("kind") == UNRECOGNISED, "skipped")
        .when(F.col("n_bad") > 0, "partial")
        .otherwise("ok")
        .alias("status"),
    )
