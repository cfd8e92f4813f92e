"""Column expressions used across the package.

All of them are built from ``pyspark.sql.functions``; none needs a Python
worker, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the landed data and the reference's outputs.
# ---------------------------------------------------------------------------

# Feed dispatch by file-name substring, first match wins.
FEED_RULES: tuple[tuple[str, str], ...] = (
    ("simple_price", "spot"),
    ("coins_list", "catalog"),
    ("market_chart", "chart"),
)
UNRECOGNISED = "unrecognised"

# Landing file names: <kind>[_<asset id>]_<yyyyMMdd_HHmmss>.json
SNAPSHOT_PATTERN = r"_(\d{8}_\d{6})\.json$"
SNAPSHOT_FORMAT = "yyyyMMdd_HHmmss"
CHART_NAME_PATTERN = r"^market_chart_(.+)_(\d{8}_\d{6})\.json$"

# Display labels of the two assets the spot feed requests.
ASSET_LABELS: dict[str, tuple[str, str]] = {
    "bitcoin": ("Bitcoin", "BTC"),
    "ethereum": ("Ethereum", "ETH"),
}

# Time-of-day text, same as Python's datetime.time str with microseconds.
TIME_OF_DAY_FORMAT = "HH:mm:ss.SSSSSS"

# ---------------------------------------------------------------------------


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time ---------------------------------------------------------------------


# Epoch range accepted as a point in time: 0001-01-01 to 9999-12-31 (UTC).
# Outside it, timestamp_millis/seconds would overflow (an error under ANSI).
MIN_EPOCH_MS = -62_135_596_800_000
MAX_EPOCH_MS = 253_402_300_799_999


FINITE_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def finite_number(value: str | Column) -> Column:
    """Number or decimal text -> double; null for anything else, and for
    text that only a lenient cast takes as a number (NaN, Infinity, ``1.5d``)
    or that overflows."""
    value = col_(value)
    number = F.when(value.cast("string").rlike(FINITE_NUMBER), value.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def epoch_ms_in_range(ms: str | Column) -> Column:
    """Numeric (or numeric text) epoch ms inside the supported range."""
    return col_(ms).try_cast("double").between(F.lit(float(MIN_EPOCH_MS)), F.lit(float(MAX_EPOCH_MS)))


def epoch_ms_to_ts(ms: str | Column) -> Column:
    """Epoch milliseconds (number, possibly fractional) -> timestamp.

    Fractional milliseconds are kept to the microsecond, rounded half up.
    Out of range -> null (never an overflow error that fails the job).
    """
    micros = F.round(col_(ms).try_cast("double") * F.lit(1000.0)).try_cast("long")
    return F.when(epoch_ms_in_range(ms), F.timestamp_micros(micros))


def epoch_s_to_ts(seconds: str | Column) -> Column:
    """Epoch seconds -> timestamp (``from_unixtime`` would give a string); null out of range."""
    s = col_(seconds).try_cast("double")
    in_range = s.between(F.lit(float(MIN_EPOCH_MS // 1000)), F.lit(float(MAX_EPOCH_MS // 1000)))
    return F.when(in_range, F.timestamp_seconds(s.try_cast("long")))


def ts_to_epoch_ms(ts: str | Column) -> Column:
    """Timestamp (with or without time zone) -> epoch ms, floored."""
    return F.unix_millis(col_(ts).cast("timestamp"))


def to_ntz(ts: str | Column) -> Column:
    """Session-zone timestamp -> wall-clock timestamp_ntz (UTC session)."""
    return col_(ts).cast("timestamp_ntz")


def time_of_day(ts: str | Column) -> Column:
    return F.date_format(col_(ts), TIME_OF_DAY_FORMAT)


# -- landing file names ---------------------------------------------------------


def snapshot_time(file_name: str | Column) -> Column:
    """Snapshot time written by the fetcher into the file name (UTC)."""
    text = F.regexp_extract(col_(file_name), SNAPSHOT_PATTERN, 1)
    return F.try_to_timestamp(text, F.lit(SNAPSHOT_FORMAT))


def chart_asset_id(file_name: str | Column) -> Column:
    """Asset id of a chart file; keeps ids that contain ``_``."""
    return F.nullif(F.regexp_extract(col_(file_name), CHART_NAME_PATTERN, 1), F.lit(""))


def name_field(text: str | Column, sep: str, position: int) -> Column:
    """1-based ``sep``-separated field, '' when absent (``split(sep)[i]``)."""
    return F.split_part(col_(text), F.lit(sep), F.lit(position))


def file_stem(path: str | Column) -> Column:
    """Base name without directory and extension."""
    return F.regexp_extract(col_(path), r"([^/]+?)(\.[^./]*)?$", 1)


def route_by_name(
    name: str | Column,
    rules: Sequence[tuple[str, str]] = FEED_RULES,
    default: str = UNRECOGNISED,
) -> Column:
    """First rule whose substring occurs in the name wins."""
    name = col_(name)
    out = None
    for needle, kind in rules:
        cond = name.contains(needle)
        out = F.when(cond, F.lit(kind)) if out is None else out.when(cond, F.lit(kind))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


# -- JSON documents ----------------------------------------------------------------


def json_keys(doc: str | Column) -> Column:
    """Top-level keys of a JSON object; null for arrays, scalars and bad text."""
    return F.json_object_keys(col_(doc))


def is_json_array(doc: str | Column) -> Column:
    return F.ltrim(col_(doc)).startswith("[")


def shape_probes(doc: str | Column) -> dict[str, Column]:
    """The measurements shape classification needs: one parse of a document
    into its fields, or into its elements."""
    doc = col_(doc)
    return {
        "_fields": F.when(F.ltrim(doc).startswith("{"), F.from_json(doc, "map<string,string>")),
        "_items": F.when(is_json_array(doc), F.from_json(doc, "array<string>")),
    }


def shape_from_probes(p: dict[str, Column]) -> Column:
    """Feed of a document judged by its shape alone.

    chart        - object with ``prices`` or ``total_volumes``
    catalog      - array whose first element has ``id`` and ``symbol``
    spot         - non-empty object whose every value is an object (this
                   includes the ``bitcoin``/``ethereum`` documents)
    invalid      - neither a JSON object nor a JSON array (malformed text, or
                   a bare scalar, which no feed lands)
    unrecognised - any other object or array
    """
    fields, first = p["_fields"], F.get(p["_items"], 0)
    all_objects = F.forall(F.map_values(fields), lambda v: F.coalesce(F.ltrim(v).startswith("{"), F.lit(False)))
    return (
        F.when(F.map_contains_key(fields, "prices") | F.map_contains_key(fields, "total_volumes"), "chart")
        .when(F.get_json_object(first, "$.id").isNotNull() & F.get_json_object(first, "$.symbol").isNotNull(), "catalog")
        .when((F.size(fields) > 0) & all_objects, "spot")
        .when(fields.isNull() & p["_items"].isNull(), "invalid")
        .otherwise(UNRECOGNISED)
    )


def shape_kind(doc: str | Column) -> Column:
    """Single-expression form of ``shape_from_probes`` (see there)."""
    return shape_from_probes(shape_probes(doc))


def pretty_json(*cols: str | Column) -> Column:
    """Indented JSON text of the given columns (one object per row)."""
    return F.to_json(F.struct(*[col_(c) for c in cols]), {"pretty": "true"})


# -- text ----------------------------------------------------------------------------


def line_count(text: str | Column) -> Column:
    """Lines as a text reader counts them: newlines, plus a last unterminated line."""
    text = col_(text)
    newlines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    tail = F.when((F.length(text) > 0) & ~text.endswith("\n"), 1).otherwise(0)
    return (newlines + tail).cast("long")


def money(value: str | Column, digits: int = 2) -> Column:
    """``$1,234.50`` - thousands separators, fixed decimals."""
    return F.concat(F.lit("$"), F.format_number(col_(value), digits))


def label_lookup(key: str | Column, mapping: Mapping[str, str]) -> Column:
    """Literal map lookup; null for keys not in the mapping."""
    pairs: list[Column] = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col_(key))


def asset_label(key: str | Column, labels: Mapping[str, tuple[str, str]] = ASSET_LABELS) -> Column:
    return label_lookup(key, {k: v[0] for k, v in labels.items()})


def asset_code(key: str | Column, labels: Mapping[str, tuple[str, str]] = ASSET_LABELS) -> Column:
    return label_lookup(key, {k: v[1] for k, v in labels.items()})


def metric_line(metric: str, label: str, label_value: str | Column, count: str | Column) -> Column:
    """``name{label="value"} n`` - exposition-format sample line.

    A null label value prints as ``None``, as the reference's f-string does.
    """
    value = F.coalesce(col_(label_value).cast("string"), F.lit("None"))
    return F.format_string(f'{metric}{{{label}="%s"}} %d', value, col_(count))


def names_matching(columns: Iterable[str], needles: Sequence[str]) -> list[str]:
    """Column names containing any needle, case-insensitive (schema metadata)."""
    lowered = [n.lower() for n in needles]
    return [c for c in columns if any(n in c.lower() for n in lowered)]
