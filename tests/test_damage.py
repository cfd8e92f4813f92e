"""Damage stays with the part it hits: a bad cell, entry or element never
takes its neighbours along, and every loss has a reason (quarantine)."""

import datetime as dt

from feedlake.operators import feeds, report
from feedlake.sources.landing import describe_files


def described(spark, **files):
    return describe_files(spark.createDataFrame(list(files.items()), "file_name string, doc string"))


def doc(spark, name, text):
    return describe_files(spark.createDataFrame([(name, text)], "file_name string, doc string"))


CHART, SPOT, CATALOG = "market_chart_btc_20250722_000000.json", "simple_price_20250722_000000.json", "coins_list_20250722_000000.json"


def reasons(frame):
    return sorted(r.reason for r in feeds.quarantine(frame).collect())


def test_bad_chart_cell_keeps_its_neighbours(spark):
    d = doc(spark, CHART, '{"prices":[[1000,1.0],[2000,"x"],[3000,"NaN"],5,[4000]],"total_volumes":[[1000,2.0]]}')
    assert [r.price for r in feeds.chart_points(d).collect()] == [1.0]
    assert [r.volume for r in feeds.chart_points(d, "total_volumes", "volume").collect()] == [2.0]
    assert reasons(d) == [
        "non-numeric pair in prices", "non-numeric pair in prices", "short pair in prices", "short pair in prices",
    ]
    (row,) = report.run_report(d).collect()
    assert (row.n_files, row.n_rows, row.n_bad, row.status) == (1, 1, 1, "partial")


def test_chart_field_that_is_no_list_has_a_reason(spark):
    d = doc(spark, CHART, '{"prices":{"a":1},"total_volumes":[[1000,2]]}')
    assert feeds.chart_points(d).count() == 0
    assert feeds.chart_points(d, "total_volumes", "volume").count() == 1
    assert reasons(d) == ["prices is not a list"]
    assert reasons(doc(spark, CHART, '{"prices":null}')) == [] == reasons(doc(spark, CHART, "{}"))
    for text in ("", "[1,2]", "5", '{"prices":[[1,2]', "null"):
        assert reasons(doc(spark, CHART, text)) == ["not a JSON object"]


def test_bad_spot_entry_keeps_the_other_assets(spark):
    d = doc(spark, SPOT, '{"bitcoin":{"usd":1.5,"eur":"Infinity","gbp":"1.5d","chf":1e999,"jpy":" 2e3 "},"status":5}')
    assert sorted((r.coin_id, r.currency, r.price) for r in feeds.spot_long(d).collect()) == [
        ("bitcoin", "jpy", 2000.0), ("bitcoin", "usd", 1.5),
    ]
    assert reasons(d) == [
        "no quotes under status", "non-numeric quote bitcoin.chf", "non-numeric quote bitcoin.eur", "non-numeric quote bitcoin.gbp",
    ]
    assert reasons(doc(spark, SPOT, "[1]")) == ["not a keyed JSON object"]


def test_bad_catalog_element_keeps_the_others(spark):
    d = doc(spark, CATALOG, '[{"id":"a","symbol":"a","name":"A"},5,{"id":"b"},null,"x"]')
    assert [r.id for r in feeds.catalog_rows(d).collect()] == ["a"]
    assert reasons(d) == ["element is not an object"] * 3 + ["missing required field"]
    assert reasons(doc(spark, CATALOG, '{"id":1}')) == ["not a JSON array"]


def test_quarantine_keeps_the_whole_rejected_text_once(spark):
    long = '{"bitcoin":{"usd":"x","eur":"y"},"pad":{"k":' + "1" * 5000 + "}}"
    routed = feeds.parse_documents(doc(spark, SPOT, long), keep_doc=False)
    assert "doc" not in routed.columns
    texts = sorted((r.rejected_doc or "") for r in feeds.quarantine(routed).collect())
    assert texts[-1] == long and not any(texts[:-1])
    clean = feeds.parse_documents(doc(spark, SPOT, '{"a":{"usd":1}}'), keep_doc=False)
    assert clean.first()[feeds.REJECTED_COL] is None


def test_fractional_milliseconds_are_kept(spark):
    d = doc(spark, CHART, '{"prices":[[1753142400000.5,1],[1753142400000.125,2]]}')
    assert [r.timestamp.microsecond for r in feeds.chart_points(d).collect()] == [500, 125]
    assert feeds.chart_points(d).first().timestamp.replace(microsecond=0) == dt.datetime(2025, 7, 22)
