"""Feed transforms on literal documents: every decision of SURVEY §1.5."""

import datetime as dt

from pyspark.sql import functions as F

from feedlake.operators import feeds
from feedlake.sources.landing import describe_files


def docs(spark, *pairs):
    """(file_name, doc) pairs -> described landing frame."""
    df = spark.createDataFrame(list(pairs), "file_name string, doc string")
    return describe_files(df)


def test_spot_integral_and_fractional_are_double(spark):  # Q2
    d = docs(spark, ("simple_price_20250722_192230.json", '{"bitcoin":{"usd":119800},"ethereum":{"usd":3715.55}}'))
    out = {r.coin_id: r.price for r in feeds.spot_long(d).collect()}
    assert out == {"bitcoin": 119800.0, "ethereum": 3715.55}
    assert dict(feeds.spot_long(d).dtypes)["price"] == "double"


def test_spot_null_quote_dropped_empty_object_no_rows_two_currencies(spark):  # Q13
    d = docs(
        spark,
        ("simple_price_20250722_192230.json", '{"a":{"usd":null,"eur":2},"b":{},"c":{"usd":1,"eur":3}}'),
    )
    rows = sorted((r.coin_id, r.currency, r.price) for r in feeds.spot_long(d).collect())
    assert rows == [("a", "eur", 2.0), ("c", "eur", 3.0), ("c", "usd", 1.0)]
    wide = feeds.spot_wide(feeds.spot_long(d), ["usd", "eur"]).orderBy("coin_id").collect()
    assert [(r.coin_id, r.usd, r.eur) for r in wide] == [("a", None, 2.0), ("c", 1.0, 3.0)]


def test_spot_non_numeric_quote_loses_one_row_and_is_quarantined(spark):  # Q14
    d = docs(spark, ("simple_price_20250722_192230.json", '{"a":{"usd":"n/a","eur":2}}'))
    assert [(r.currency, r.price) for r in feeds.spot_long(d).collect()] == [("eur", 2.0)]
    bad = feeds.quarantine(d).collect()
    assert [r.reason for r in bad] == ["non-numeric quote a.usd"]


def test_truncated_and_empty_documents_are_quarantined(spark):  # Q6, Q12
    d = docs(
        spark,
        ("simple_price_20250722_192230.json", '{"a":{"usd":1'),
        ("coins_list_20250722_192230.json", ""),
        ("coins_list_20250722_192231.json", "[]"),
        ("market_chart_bitcoin_20250722_192230.json", '{"prices":[[1,'),
    )
    bad = sorted((r.kind, r.reason) for r in feeds.quarantine(d).collect())
    assert bad == [("catalog", "not a JSON array"), ("chart", "not a JSON object"), ("spot", "not a keyed JSON object")]
    assert feeds.catalog_rows(d.filter("kind = 'catalog'")).count() == 0


def test_catalog_required_fields(spark):  # S3
    d = docs(
        spark,
        ("coins_list_20250722_192230.json", '[{"id":"a","symbol":"a","name":"A"},{"id":"b","symbol":"b"}]'),
    )
    assert [r.id for r in feeds.catalog_rows(d).collect()] == ["a"]
    assert [r.reason for r in feeds.quarantine(d).collect()] == ["missing required field"]


def test_chart_asset_id_with_underscore_and_snapshot_time(spark):  # Q5, F21
    d = docs(spark, ("market_chart_wrapped_btc_20250722_192230.json", '{"prices":[[1753212150000,1.5]]}'))
    r = d.first()
    assert r.asset_id == "wrapped_btc" and r.kind == "chart"
    assert r.snapshot_ts == dt.datetime(2025, 7, 22, 19, 22, 30)
    assert feeds.chart_points(d).first().coin_id == "wrapped_btc"


def test_chart_all_integral_pairs_are_double_and_pair_lengths(spark):  # Q11, Q12
    d = docs(
        spark,
        ("market_chart_bitcoin_20250722_192230.json", '{"prices":[[1000,5],[2000],[3000,7,9]],"total_volumes":[[1000,3]]}'),
    )
    pts = feeds.chart_points(d).orderBy("timestamp").collect()
    assert [(r.timestamp, r.price) for r in pts] == [
        (dt.datetime(1970, 1, 1, 0, 0, 1), 5.0),
        (dt.datetime(1970, 1, 1, 0, 0, 3), 7.0),
    ]
    assert [r.reason for r in feeds.quarantine(d).collect()] == ["short pair in prices"]


def test_chart_without_total_volumes(spark):  # P11
    d = docs(spark, ("market_chart_bitcoin_20250722_192230.json", '{"prices":[[1000,5]]}'))
    assert feeds.chart_points(d, "prices").count() == 1
    assert feeds.chart_points(d, "total_volumes", "volume").count() == 0
    assert feeds.quarantine(d).count() == 0


def test_date_is_utc_around_midnight(spark):  # Q7
    ms_before = int(dt.datetime(2025, 7, 22, 23, 59, 59, 999000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    d = docs(spark, ("market_chart_bitcoin_20250722_192230.json", f'{{"prices":[[{ms_before},1],[{ms_before + 1},2]]}}'))
    dates = sorted(str(r.date) for r in feeds.chart_points(d).collect())
    assert dates == ["2025-07-22", "2025-07-23"]


def test_epoch_ms_matches_division_form(spark):  # Q8
    df = spark.range(1753228800000, 1753228800000 + 5000).select(F.col("id").alias("ms"))
    from feedlake.functions.columns import epoch_ms_to_ts

    same = df.select((epoch_ms_to_ts("ms") == F.timestamp_micros(F.col("ms") * 1000)).alias("eq"))
    assert same.filter(~F.col("eq")).count() == 0


def test_cast_measures_keeps_keys_and_try_casts(spark):  # P5, F10
    df = spark.createDataFrame([("a", "1.5", 2, "x")], "coin_id string, usd string, eur int, bad string")
    out = feeds.cast_measures(df, keep=("coin_id",))
    assert out.dtypes == [("coin_id", "string"), ("usd", "double"), ("eur", "double"), ("bad", "double")]
    assert tuple(out.first()) == ("a", 1.5, 2.0, None)


def test_spot_usd_key_exists(spark):  # P7
    d = docs(spark, ("simple_price_20250722_192230.json", '{"a":{"usd":1},"b":{"eur":2}}'))
    assert [(r.coin_id, r.usd) for r in feeds.spot_quote(d, "usd").collect()] == [("a", 1.0)]


def test_spot_last_updated_is_a_time_not_a_currency(spark):  # Q17
    d = docs(
        spark,
        ("simple_price_20250722_192230.json", '{"a":{"usd":1,"last_updated_at":1753212150},"b":{"usd":2}}'),
    )
    rows = sorted((r.coin_id, r.currency, r.quote_ts) for r in feeds.spot_long(d).collect())
    assert rows == [("a", "usd", dt.datetime(2025, 7, 22, 19, 22, 30)), ("b", "usd", None)]
    assert feeds.quarantine(d).count() == 0
    from feedlake.operators.report import run_report

    assert run_report(d).first().n_rows == 2


def test_chart_time_out_of_range_is_quarantined(spark):  # contract: nothing disappears silently
    d = docs(spark, ("market_chart_btc_20250722_192230.json", '{"prices":[[1e30,5],[1000,6]]}'))
    assert [r.price for r in feeds.chart_points(d).collect()] == [6.0]
    assert [r.reason for r in feeds.quarantine(d).collect()] == ["time out of range in prices"]


def test_spot_quote_keeps_numeric_quotes_only(spark):  # P7, Q13, Q14
    d = docs(spark, ("simple_price_20250722_192230.json", '{"a":{"usd":1},"b":{"usd":null},"c":{"usd":"x"},"d":{"eur":2}}'))
    assert [(r.coin_id, r.usd) for r in feeds.spot_quote(d, "usd").collect()] == [("a", 1.0)]
    assert [r.reason for r in feeds.quarantine(d).collect()] == ["non-numeric quote c.usd"]


def test_epoch_overflow_never_fails_the_job(spark):  # Q11 under ANSI
    d = docs(spark, ("market_chart_btc_20250722_192230.json", '{"prices":[[1e17,5],[-1e17,6],[1e15,7],[1000,8]]}'))
    assert sorted(r.price for r in feeds.chart_points(d).collect()) == [8.0]
    reasons = [r.reason for r in feeds.quarantine(d).collect()]
    assert reasons == ["time out of range in prices"] * 3
    from feedlake.operators.report import run_report

    assert run_report(d).first().n_rows == 1
    spot = docs(spark, ("simple_price_20250722_192230.json", '{"a":{"usd":1,"last_updated_at":1e17}}'))
    assert feeds.spot_long(spot).first().quote_ts is None
