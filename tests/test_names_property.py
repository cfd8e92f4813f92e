"""File-name parsing and routing against a plain-Python model."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.functions.columns import FEED_RULES, UNRECOGNISED
from feedlake.sources.landing import describe_files

ids = st.from_regex(r"[a-z0-9]{1,6}(_[a-z0-9]{1,6}){0,2}", fullmatch=True)
stamps = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2099, 12, 31)).map(
    lambda t: t.replace(microsecond=0)
)
kinds = st.sampled_from(["simple_price", "coins_list", "market_chart", "other_feed"])


def model(name):
    kind = next((k for needle, k in FEED_RULES if needle in name), UNRECOGNISED)
    m = re.match(r"^market_chart_(.+)_(\d{8}_\d{6})\.json$", name)
    s = re.search(r"_(\d{8}_\d{6})\.json$", name)
    snap = dt.datetime.strptime(s.group(1), "%Y%m%d_%H%M%S") if s else None
    return kind, (m.group(1) if m else None), snap


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(kinds, ids, stamps), min_size=1, max_size=20))
def test_names_match_model(spark, entries):
    names = []
    for kind, asset, stamp in entries:
        middle = f"_{asset}" if kind == "market_chart" else ""
        names.append(f"{kind}{middle}_{stamp:%Y%m%d_%H%M%S}.json")
    df = spark.createDataFrame([(n, "{}") for n in names], "file_name string, doc string")
    got = [(r.kind, r.asset_id, r.snapshot_ts) for r in describe_files(df).collect()]
    assert got == [model(n) for n in names]
