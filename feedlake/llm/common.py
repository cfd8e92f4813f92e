"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from feedlake.session import scratch_path

#: UTF-8 bytes of text handled at once inside a task: bounds the Python memory
#: whatever an Arrow batch holds (a longer text is a slice alone).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back:
    cuts the lineage, computes the rows once, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[list[str]]:
    """The texts of an Arrow column, nulls as empty texts, in lists of about
    ``size`` bytes each; only one list exists as Python texts at a time."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_numpy()
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(before + size, "right")))
        yield [t or "" for t in column.slice(start, stop - start).to_pylist()]
        start = stop


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def annotate(
    docs: DataFrame, text_col: str, fields: str, make: Callable[[], Callable[[list[str]], list]]
) -> DataFrame:
    """Append columns computed from whole texts, Arrow batch by Arrow batch.

    ``fields`` is the DDL of the new columns; an input column of one of their
    names is replaced.  ``make()`` runs once per task and returns the function
    that maps a list of texts to one sequence per new column.  Every other
    column passes through unchanged, so the result needs no join.
    """
    added = StructType.fromDDL(fields)
    names = {f.name.lower() for f in added}
    replaced = [c for c in docs.columns if c.lower() in names and c != text_col]
    source = free_name(docs, "_text") if text_col.lower() in names else text_col
    kept = docs.drop(*replaced)
    if source != text_col:
        kept = kept.withColumnRenamed(text_col, source)
    out = StructType([f for f in kept.schema if f.name != source or source == text_col] + list(added))
    types = [to_arrow_type(f.dataType) for f in added]
    through = [f.name for f in out][: len(out) - len(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            parts: list[list] = [[] for _ in types]
            for texts in text_slices(batch.column(source)):
                for part, values in zip(parts, compute(texts), strict=True):
                    part.append(values if isinstance(values, pa.Array) else pa.array(values))
            arrays = [
                pa.concat_arrays([v.cast(t) for v in part]) if part else pa.array([], t)
                for part, t in zip(parts, types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in through] + arrays, names=[f.name for f in out]
            )

    return kept.mapInArrow(run, out)


def crc_mod(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; a null id gives null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def held_out(doc_id: Column, n: int) -> Column:
    """True where the remainder is 1; a null id is never held out."""
    return F.coalesce(crc_mod(doc_id, n) == 1, F.lit(False))
