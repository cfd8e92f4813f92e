"""Reading tables and typed documents back."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Table scan; ``fmt="delta"`` works when Delta is on the classpath.

    A replacement of the table that was committed but interrupted is finished
    first (``sinks.commit``)."""
    from feedlake.sinks.commit import settle

    settle(spark, path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_json_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = True,
    glob: str | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Typed read of JSON documents (a document may span many lines).

    With ``multi_line`` each file holds one JSON value; a root array yields
    one row per element.  ``corrupt_column`` keeps unparseable text instead of
    dropping it (PERMISSIVE mode), for the quarantine.
    """
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", str(multi_line).lower())
    if corrupt_column:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


#: Options with which a CSV export reads back unchanged.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: Texts that are the null mark, or are it after more backslashes.
CSV_NULL_LIKE = r"^\\+N$"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV as ``export_csv`` writes it; line breaks inside a value are kept,
    so a file is read by one task (the writer keeps files bounded)."""
    raw = spark.read.schema(schema).options(**CSV_OPTIONS, header="true", multiLine="true", emptyValue="").csv(path)
    return raw.select(
        *[
            F.when(F.col(f.name).rlike(r"^\\{2,}N$"), F.expr(f"substring(`{f.name}`, 2)")).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


#: Directories listed at once.
LISTERS = 16


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for every table, as one union of counts.

    A ``count(*)`` over Parquet is answered from row-group metadata; the
    per-table aggregates are one-row results, so the union is tiny.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    if not parts:
        return SparkSession.getActiveSession().createDataFrame([], "table_name string, n_rows long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_paths(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, str]:
    """Tables at any depth under ``root``: relative name -> format.

    A directory is a table if it holds a ``_delta_log``, a job's ``_SUCCESS``
    marker, ``key=value`` partitions or data files of ``fmt``; what lies below
    a table is the table's.  Any other directory is searched, one without a
    table is passed over.  Only directories above the partitions are listed,
    a level at a time, on the driver; no data is read.
    """
    from feedlake.sinks.commit import RECORD, TableFiles, settle

    files = TableFiles(spark, root)
    base = root.rstrip("/")

    def look(name: str) -> tuple[str | None, list[str]]:
        entries = files.names(name)
        if any(n == RECORD for n, _ in entries):
            settle(spark, f"{base}/{name}")
            entries = files.names(name)
        if ("_delta_log", True) in entries:
            return "delta", []
        own = {n for n, is_dir in entries if not is_dir}
        folders = [n for n, is_dir in entries if is_dir and not n.startswith(("_", "."))]
        if name and ("_SUCCESS" in own or any("=" in n for n in folders) or any(n.endswith(f".{fmt}") and n[0] not in "_." for n in own)):
            return fmt, []
        return None, [f"{name}/{n}".lstrip("/") for n in folders]

    found, level = {}, [""]
    while level:
        with ThreadPoolExecutor(LISTERS) as pool:
            seen = list(pool.map(look, level))
        found.update({name: kind for name, (kind, _) in zip(level, seen, strict=True) if kind})
        level = [name for _, below in seen for name in below]
    return dict(sorted(found.items()))


def discover_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables of ``table_paths`` as frames, by relative name.  A table
    without a data file (none was ever written) has no rows and no columns."""
    frames = {}
    for name, kind in table_paths(spark, root, fmt).items():
        try:
            frames[name] = spark.read.format(kind).load(f"{root.rstrip('/')}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            frames[name] = spark.createDataFrame([], T.StructType([]))
    return frames
