"""A well-formed document is tokenised once, whatever reads it."""

import re

import pytest

from feedlake.operators import feeds, report
from feedlake.sources.landing import describe_files

CHART, SPOT, CATALOG = "market_chart_btc_20250722_000000.json", "simple_price_20250722_000000.json", "coins_list_20250722_000000.json"


@pytest.fixture()
def docs(spark, tmp_path):
    rows = [
        (CHART, '{"prices":[[1000,1.0],[2000,2.5]],"total_volumes":[[1000,2.0]]}'),
        (SPOT, '{"bitcoin":{"usd":1.5,"last_updated_at":1753142400}}'),
        (CATALOG, '[{"id":"a","symbol":"a","name":"A"}]'),
    ]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "file_name string, doc string").write.parquet(path)
    return describe_files(spark.read.parquet(path))


def parses(df):
    """(parses of a whole document without a condition, all parses) in the optimized plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    calls = re.findall(r"from_json\(", plan)
    whole = re.findall(r"from_json\((?:[^()]|\([^()]*\))*?, doc#\d+", plan)
    return plan, len(whole), len(calls)


@pytest.mark.parametrize(
    "transform, most",
    [
        (lambda d: feeds.chart_points(d), 4),
        (lambda d: feeds.chart_points(d, "total_volumes", "volume"), 4),
        (lambda d: feeds.spot_long(d), 3),
        (lambda d: feeds.spot_quote(d), 3),
        (lambda d: feeds.catalog_rows(d), 3),
        # three feeds; a chart has two fields, each with its list and its pairs
        (lambda d: feeds.quarantine(d), 12),
        (lambda d: report.run_report(d), 12),
    ],
)
def test_each_parse_is_written_once_in_the_plan(docs, transform, most):
    """Per feed one parse of the document, one of a damaged one, and those of
    a damaged one's parts; nothing copied into filters or generators."""
    plan, _, calls = parses(transform(docs))
    assert calls <= most
    for line in plan.splitlines():
        if "Generate" in line or line.lstrip(" :+-").startswith("Filter"):
            assert "from_json" not in line


def test_only_the_wanted_chart_field_is_parsed(docs):
    plan, _, _ = parses(feeds.chart_points(docs))
    assert "total_volumes" not in plan


def test_results_are_those_of_the_parsed_frame(docs):
    parsed = feeds.parse_documents(docs)
    by_kind = {k: (docs.filter(f"kind = '{k}'"), parsed.filter(f"kind = '{k}'")) for k in ("chart", "spot", "catalog")}
    for kind, transform, rows in (("chart", feeds.chart_points, 2), ("spot", feeds.spot_long, 1), ("catalog", feeds.catalog_rows, 1)):
        raw, ready = (sorted(map(str, transform(d).collect())) for d in by_kind[kind])
        assert raw == ready and len(raw) == rows
