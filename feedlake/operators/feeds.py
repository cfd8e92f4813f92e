"""Feed transforms: landed documents -> typed rows.

Each transform takes a frame of documents (one row per landed file, with a
``doc`` text column and any context columns such as ``file_name`` or
``snapshot_ts``) and returns typed rows.  Parsing runs on the executors with
explicit schemas (``from_json``), never on the driver.

Parse once.  JSON parsing is the dominant cost of this workload, and one
landing run feeds several outputs (prices, volumes, quarantine, report).
``parse_documents`` parses every document once, by its routed kind, into
typed columns; every transform below reads those columns when present and
otherwise parses its own feed's, in projections of its own.

Problems never fail the job and never silently disappear: ``problem_reasons``
lists, per document, why it or some of its rows cannot be used;
``quarantine`` turns that into rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.columns import epoch_ms_in_range, epoch_ms_to_ts, epoch_s_to_ts, finite_number
from feedlake.schemas import (
    CATALOG_DOC,
    CATALOG_ITEM,
    CHART_DOC,
    CHART_FIELDS,
    PAIR,
    PAIR_LIST,
    SPOT_DOC,
    SPOT_ENTRY,
    TEXT_LIST,
    TEXT_MAP,
)

CONTEXT = ("file_name", "snapshot_ts")

# Fixed value: the per-asset update-time key the spot endpoint adds when asked.
SPOT_TIME_KEY = "last_updated_at"

# Columns added by parse_documents.
CHART_COL, SPOT_COL, CATALOG_COL = "_chart", "_spot", "_catalog"
REASONS_COL, REJECTED_COL = "_reasons", "_rejected_doc"


def _context(docs: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in keep if c in docs.columns]


# -- parsing -------------------------------------------------------------------------
#
# A parse is null exactly when the document is not usable as its feed:
# chart - not a JSON object; spot - not a JSON object; catalog - not a JSON
# array.  A well-formed document is tokenised once.  Only when a part of it
# doesn't fit the feed is it parsed again, part by part, so that the damage
# stays with the part: a bad pair, entry or element becomes null (with a
# reason), its neighbours keep their rows.
#
# Each step is a projection of its own whose columns the next one uses more
# than once; the optimizer doesn't merge such projections, so a parse is
# written once in the plan.  Two things would copy it back into a condition:
# an ``explode`` (the optimizer filters empty arrays below it, on the
# expression itself) and a parse used inside a generator.  Hence the outer
# explodes over columns below, whose null rows the transforms drop anyway.

_DAMAGED = "_damaged"


def _steps(docs: DataFrame, *steps: dict[str, Column]) -> DataFrame:
    for step in steps:
        docs = docs.withColumns(step)
    return docs


def _of_kind(kind: str, kind_col: str | None, parse: Column) -> Column:
    return parse if kind_col is None else F.when(F.col(kind_col) == kind, parse)


def parse_charts(
    docs: DataFrame, doc_col: str = "doc", kind_col: str | None = None, fields: Sequence[str] = CHART_FIELDS
) -> DataFrame:
    """Adds ``_chart``: the pair lists, and ``bad``: present fields that are no list.

    ``from_json`` fills the extra column with the text of a document that
    doesn't fit, which tells a damaged field from an absent one."""
    doc, fit, parts = F.col(doc_col), F.col("_fit"), F.col("_parts")
    schema = T.StructType([f for f in CHART_DOC.fields if f.name in fields] + [T.StructField(_DAMAGED, T.StringType())])
    fits = fit.isNotNull() & fit[_DAMAGED].isNull()
    whole = F.struct(*[fit[f].alias(f) for f in fields], F.array().cast(TEXT_LIST).alias("bad"))

    def pairs(field: str) -> Column:
        return F.transform(F.col(f"_list_{field}"), lambda pair: F.from_json(pair, PAIR)).cast(PAIR_LIST)

    bad = F.array_compact(F.array(*[F.when(parts[f].isNotNull() & F.col(f"_list_{f}").isNull(), F.lit(f)) for f in fields]))
    rescued = F.struct(*[pairs(f).alias(f) for f in fields], bad.alias("bad"))
    out = _steps(
        docs,
        {"_fit": _of_kind("chart", kind_col, F.from_json(doc, schema, {"columnNameOfCorruptRecord": _DAMAGED}))},
        {"_parts": _of_kind("chart", kind_col, F.when(~fits, F.from_json(doc, TEXT_MAP)))},
        {f"_list_{f}": F.when(parts.isNotNull(), F.from_json(parts[f], TEXT_LIST)) for f in fields},
        {CHART_COL: F.when(fits, whole).when(parts.isNotNull(), rescued)},
    )
    return out.drop("_fit", "_parts", *[f"_list_{f}" for f in fields])


def parse_spots(docs: DataFrame, doc_col: str = "doc", kind_col: str | None = None) -> DataFrame:
    """Adds ``_spot``: a quote map per asset; null for an asset whose entry is
    no object."""
    doc, fit = F.col(doc_col), F.col("_fit")
    parts = F.transform_values("_parts", lambda _, entry: F.from_json(entry, SPOT_ENTRY))
    out = _steps(
        docs,
        {"_fit": _of_kind("spot", kind_col, F.from_json(doc, SPOT_DOC))},
        {"_parts": _of_kind("spot", kind_col, F.when(fit.isNull(), F.from_json(doc, TEXT_MAP)))},
        {SPOT_COL: F.coalesce(fit, parts)},
    )
    return out.drop("_fit", "_parts")


def parse_catalogs(docs: DataFrame, doc_col: str = "doc", kind_col: str | None = None) -> DataFrame:
    """Adds ``_catalog``: the elements of the root array; null for one that is
    no object."""
    doc, fit = F.col(doc_col), F.col("_fit")
    is_array = F.ltrim(doc).startswith("[")
    element = lambda item: F.when(F.ltrim(item).startswith("{"), F.from_json(item, CATALOG_ITEM))
    out = _steps(
        docs,
        {"_fit": _of_kind("catalog", kind_col, F.when(is_array, F.from_json(doc, CATALOG_DOC)))},
        {"_parts": _of_kind("catalog", kind_col, F.when(is_array & fit.isNull(), F.from_json(doc, TEXT_LIST)))},
        {CATALOG_COL: F.coalesce(fit, F.transform("_parts", element))},
    )
    return out.drop("_fit", "_parts")


_PARSERS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "chart": (CHART_COL, parse_charts),
    "spot": (SPOT_COL, parse_spots),
    "catalog": (CATALOG_COL, parse_catalogs),
}


def parse_documents(docs: DataFrame, doc_col: str = "doc", kind_col: str = "kind", keep_doc: bool = True) -> DataFrame:
    """Parse each document once, by its kind, into ``_chart``/``_spot``/``_catalog``.

    ``_reasons`` lists its problems.  ``_rejected_doc`` is the whole text of a
    document that has one and null for the others.  With ``keep_doc=False`` it
    replaces the raw text, which is what a persisted frame should hold: the
    few rejected texts.
    """
    out = docs
    for _, parse in _PARSERS.values():
        out = parse(out, doc_col, kind_col)
    out = out.withColumn(REASONS_COL, _reasons_of(kind_col))
    out = out.withColumn(REJECTED_COL, F.when(F.size(REASONS_COL) > 0, F.col(doc_col)))
    return out if keep_doc else out.drop(doc_col)


def _parsed(docs: DataFrame, kind: str, doc_col: str, **options) -> DataFrame:
    """``docs`` with the kind's typed column, parsed here if it isn't yet."""
    col, parse = _PARSERS[kind]
    return docs if col in docs.columns else parse(docs, doc_col, **options)


# -- catalog (coins_list) --------------------------------------------------------


def _catalog_item_ok(i: Column) -> Column:
    present = i["id"].isNotNull() & i["symbol"].isNotNull() & i["name"].isNotNull()
    return F.coalesce(i.isNotNull() & present, F.lit(False))


def catalog_rows(docs: DataFrame, doc_col: str = "doc", keep: Sequence[str] = CONTEXT) -> DataFrame:
    """Root array of ``{id, symbol, name}`` -> one row per element.

    All three fields are required; elements missing one are quarantined.
    ``[]`` gives zero rows.
    """
    parsed = _parsed(docs, "catalog", doc_col)
    items = parsed.select(*_context(docs, keep), F.explode_outer(CATALOG_COL).alias("_item"))
    return items.filter(_catalog_item_ok(F.col("_item"))).select(
        "_item.id", "_item.symbol", "_item.name", *_context(docs, keep)
    )


# -- spot (simple_price) -----------------------------------------------------------


def _only_quotes(quotes: Column) -> Column:
    """Quote map without the optional update-time key."""
    return F.map_filter(quotes, lambda k, _: k != F.lit(SPOT_TIME_KEY))


def _quote_time(quotes: Column) -> Column:
    return epoch_s_to_ts(F.try_element_at(quotes, F.lit(SPOT_TIME_KEY)))


def spot_long(docs: DataFrame, doc_col: str = "doc", keep: Sequence[str] = CONTEXT) -> DataFrame:
    """``{asset: {currency: value}}`` -> ``(coin_id, currency, price, quote_ts)``.

    Integral and fractional quotes both become double; a null quote is
    dropped; a quote that is no finite number loses only its own row, an
    entry that is no object only its own asset (both quarantined).
    ``quote_ts`` is the asset's ``last_updated_at`` (epoch seconds) when the
    document carries it, else null; it is not a currency.
    """
    assets = _parsed(docs, "spot", doc_col).select(
        *_context(docs, keep), F.explode_outer(SPOT_COL).alias("coin_id", "_quotes")
    )
    # the update time is a pair like the quotes here, and goes after
    quotes = assets.select(
        *_context(docs, keep),
        "coin_id",
        _quote_time(F.col("_quotes")).alias("quote_ts"),
        F.explode_outer("_quotes").alias("currency", "_raw"),
    ).filter(F.col("currency") != SPOT_TIME_KEY)
    return quotes.select(
        "coin_id",
        "currency",
        finite_number("_raw").alias("price"),
        "quote_ts",
        *_context(docs, keep),
    ).filter(F.col("price").isNotNull())


def spot_quote(
    docs: DataFrame, currency: str = "usd", doc_col: str = "doc", keep: Sequence[str] = CONTEXT
) -> DataFrame:
    """Assets that carry a numeric quote in ``currency``: ``(coin_id, <currency>, quote_ts)``.

    As in ``spot_long``, a null quote is dropped and a non-numeric one is
    left to the quarantine, so the column never holds a null price.
    """
    assets = _parsed(docs, "spot", doc_col).select(
        *_context(docs, keep), F.explode_outer(SPOT_COL).alias("coin_id", "_quotes")
    )
    return (
        assets.filter(F.map_contains_key("_quotes", currency))
        .select(
            "coin_id",
            finite_number(F.col("_quotes")[currency]).alias(currency),
            _quote_time(F.col("_quotes")).alias("quote_ts"),
            *_context(docs, keep),
        )
        .filter(F.col(currency).isNotNull())
    )


def spot_wide(
    long: DataFrame,
    currencies: Sequence[str] | None = None,
    key: str = "coin_id",
    pivot_col: str = "currency",
    value: str = "price",
    order: Sequence[str] = ("snapshot_ts",),
) -> DataFrame:
    """One row per asset, one double column per currency (null when absent).

    Latest value per cell by ``order``.  Passing ``currencies`` avoids the
    extra distinct job Spark runs to discover the pivot values.  The pivot
    is a single aggregation with map-side partial aggregation, so a hot
    asset is combined before the shuffle.
    """
    grouped = long.groupBy(key)
    pivoted = grouped.pivot(pivot_col, list(currencies)) if currencies else grouped.pivot(pivot_col)
    return pivoted.agg(F.max_by(value, F.struct(*order)))


# -- chart (market_chart_<id>) --------------------------------------------------------


def _pair_short(p: Column) -> Column:
    """No list, or without two cells that hold something."""
    return p.isNull() | F.get(p, 0).isNull() | F.get(p, 1).isNull()


def _pair_ok(p: Column) -> Column:
    return F.coalesce(finite_number(F.get(p, 0)).isNotNull() & finite_number(F.get(p, 1)).isNotNull(), F.lit(False))


def chart_points(
    docs: DataFrame,
    field: str = "prices",
    value_name: str = "price",
    doc_col: str = "doc",
    asset_col: str = "asset_id",
    keep: Sequence[str] = CONTEXT,
) -> DataFrame:
    """``[[epoch_ms, v], ...]`` under ``field`` -> ``(coin_id, timestamp, v, date)``.

    A document without ``field`` gives no rows.  Pairs without two finite
    numbers are quarantined one by one; extra elements are ignored.
    ``date`` is the UTC calendar date of the point.
    """
    parsed = _parsed(docs, "chart", doc_col, fields=(field,))
    pairs = parsed.select(*_context(docs, (asset_col, *keep)), F.explode_outer(f"{CHART_COL}.{field}").alias("_pair"))
    pairs = pairs.select(
        *_context(docs, (asset_col, *keep)),
        finite_number(F.get("_pair", 0)).alias("_ms"),
        finite_number(F.get("_pair", 1)).alias("_val"),
    )
    ms, val = F.col("_ms"), F.col("_val")
    return (
        pairs.filter(ms.isNotNull() & val.isNotNull())
        .select(
            F.col(asset_col).alias("coin_id"),
            epoch_ms_to_ts(ms).alias("timestamp"),
            val.alias(value_name),
            *_context(docs, keep),
        )
        .withColumn("date", F.to_date("timestamp"))
        .filter(F.col("timestamp").isNotNull())
    )


# -- per-document checks ------------------------------------------------------------------
#
# Per document, the reasons it (or some of its rows) cannot be used, and the
# number of typed rows it yields, as column expressions over the parsed
# document.  The quarantine and the run report are then one scan each.


def _repeat(reason: str, n: Column) -> Column:
    return F.array_repeat(F.lit(reason), F.coalesce(n, F.lit(0)))


def _bad_time(p: Column) -> Column:
    return _pair_ok(p) & ~epoch_ms_in_range(F.get(p, 0))


def _chart_reasons(parsed: Column, fields: Sequence[str] = CHART_FIELDS) -> Column:
    reasons = [F.transform(parsed["bad"], lambda f: F.concat(f, F.lit(" is not a list")))]
    for f in fields:
        bad = lambda p: ~_pair_short(p) & ~_pair_ok(p)
        reasons.append(_repeat(f"short pair in {f}", F.size(F.filter(parsed[f], _pair_short))))
        reasons.append(_repeat(f"non-numeric pair in {f}", F.size(F.filter(parsed[f], bad))))
        reasons.append(_repeat(f"time out of range in {f}", F.size(F.filter(parsed[f], _bad_time))))
    return F.when(parsed.isNull(), F.array(F.lit("not a JSON object"))).otherwise(F.concat(*reasons))


def _spot_reasons(parsed: Column) -> Column:
    entries = F.map_entries(parsed)
    bad_quotes = F.flatten(
        F.transform(
            entries,
            lambda asset: F.transform(
                F.filter(
                    F.coalesce(
                        F.map_entries(_only_quotes(asset["value"])),
                        F.array().cast("array<struct<key:string,value:string>>"),
                    ),
                    lambda q: q["value"].isNotNull() & finite_number(q["value"]).isNull(),
                ),
                lambda q: F.concat(F.lit("non-numeric quote "), asset["key"], F.lit("."), q["key"]),
            ),
        )
    )
    bad_entries = F.transform(
        F.filter(entries, lambda asset: asset["value"].isNull()),
        lambda asset: F.concat(F.lit("no quotes under "), asset["key"]),
    )
    return F.when(parsed.isNull(), F.array(F.lit("not a keyed JSON object"))).otherwise(F.concat(bad_entries, bad_quotes))


def _catalog_reasons(parsed: Column) -> Column:
    no_object = F.size(F.filter(parsed, lambda i: i.isNull()))
    missing = F.size(F.filter(parsed, lambda i: i.isNotNull() & ~_catalog_item_ok(i)))
    return F.when(parsed.isNull(), F.array(F.lit("not a JSON array"))).otherwise(
        F.concat(_repeat("element is not an object", no_object), _repeat("missing required field", missing))
    )


def _reasons_of(kind_col: str) -> Column:
    kind = F.col(kind_col)
    return (
        F.when(kind == "chart", _chart_reasons(F.col(CHART_COL)))
        .when(kind == "spot", _spot_reasons(F.col(SPOT_COL)))
        .when(kind == "catalog", _catalog_reasons(F.col(CATALOG_COL)))
        .otherwise(F.array().cast("array<string>"))
    )


def problem_reasons(parsed: DataFrame) -> Column:
    """``array<string>`` of reasons per document of ``parse_documents`` (empty
    when all of it is usable)."""
    return parsed[REASONS_COL]


def typed_row_count(parsed: DataFrame, kind_col: str = "kind") -> Column:
    """Rows a document of ``parse_documents`` yields in its feed's main table
    (chart: prices)."""
    kind = parsed[kind_col]
    chart = parsed[CHART_COL]["prices"]
    chart_rows = F.size(F.filter(chart, lambda p: _pair_ok(p) & epoch_ms_in_range(F.get(p, 0))))
    spot_values = F.flatten(
        F.transform(
            F.map_values(parsed[SPOT_COL]),
            lambda q: F.coalesce(F.map_values(_only_quotes(q)), F.array().cast("array<string>")),
        )
    )
    spot_rows = F.size(F.filter(spot_values, lambda v: finite_number(v).isNotNull()))
    catalog_rows_n = F.size(F.filter(parsed[CATALOG_COL], _catalog_item_ok))
    n = F.when(kind == "chart", chart_rows).when(kind == "spot", spot_rows).when(kind == "catalog", catalog_rows_n)
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("long")


def quarantine(routed: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Everything that could not be used, with a reason, across all feeds.

    One pass over the documents: ``(file_name, file_path, kind, problem_no,
    reason, rejected_doc)``, one row per problem.  The whole text of the document
    comes with the first of its problems only, so that it is stored once.
    """

    if REASONS_COL not in routed.columns:
        routed = parse_documents(routed, doc_col)

    def ref(c):
        return F.col(c) if c in routed.columns else F.lit(None).cast("string")

    rows = routed.select(
        ref("file_name").alias("file_name"),
        ref("file_path").alias("file_path"),
        F.col("kind"),
        F.col(REJECTED_COL),
        F.posexplode_outer(REASONS_COL).alias("problem_no", "reason"),
    ).filter(F.col("problem_no").isNotNull())
    text = F.when(F.col("problem_no") == 0, F.col(REJECTED_COL)).alias("rejected_doc")
    return rows.select("file_name", "file_path", "kind", "problem_no", "reason", text)


def _problems_of(kind: str):
    def problems(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
        return quarantine(docs.withColumn("kind", F.lit(kind)), doc_col)

    problems.__doc__ = f"Quarantine rows of documents read as the {kind} feed."
    return problems


catalog_problems = _problems_of("catalog")
spot_problems = _problems_of("spot")
chart_problems = _problems_of("chart")


def cast_measures(df: DataFrame, keep: Sequence[str], to: str = "double") -> DataFrame:
    """Every numeric or text column except ``keep`` -> ``to`` with try_cast.

    One ``select`` over the schema (one projection, whatever the width);
    text that is not a number becomes null instead of failing the job.
    Columns of other types are passed through.
    """
    from pyspark.sql.types import NumericType, StringType

    cols = []
    for field in df.schema.fields:
        if field.name in keep or not isinstance(field.dataType, (NumericType, StringType)):
            cols.append(F.col(field.name))
        else:
            cols.append(F.col(field.name).try_cast(to).alias(field.name))
    return df.select(*cols)
