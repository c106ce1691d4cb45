from datetime import date

import pytest
from pyspark.sql import functions as F

from tickloom.operators import validate

GOOD = dict(ticker="AAPL", date="2024-01-02", open="150", high="152", low="149", close="151", volume="50000000")


def error_of(spark, limits=validate.BarLimits(), drop=(), **change):
    row = {**GOOD, **change}
    kept = [k for k in row if k not in drop]
    df = spark.createDataFrame([tuple(row[k] for k in kept)], ", ".join(f"{k} string" for k in kept))
    return validate.validate_bars(df, limits).first()["validation_error"]


@pytest.mark.parametrize("change, expected", [
    ({}, None),
    ({"close": "0.001"}, "outside valid range"),
    ({"high": "148", "low": "150"}, "High < Low"),
    ({"close": "160"}, "Close outside OHLC range"),
    ({"volume": "50000"}, "Volume 50000 below minimum"),
    ({"high": "240"}, "Unusual price range: 61.07%"),
    ({"high": "200"}, None),
    ({"open": "not_a_number"}, "Type error"),
    ({"close": "NaN"}, "Type error"),
    ({"date": None}, "Missing required field: date"),
    ({"ticker": None, "date": None}, "Missing required field: ticker"),
    ({"close": None, "open": "x"}, "Missing required field: close"),
    ({"low": "0", "high": "151"}, "Unusual price range"),
])
def test_rules(spark, change, expected):
    got = error_of(spark, **change)
    assert got is None if expected is None else expected in got


def test_absent_column(spark):
    assert error_of(spark, drop=("close",)) == "Missing required field: close"


def test_split_and_stats(spark):
    rows = [("A", date(2024, 1, 1), 10.0, 11.0, 9.0, 10.0, 200000), ("B", None, 10.0, 11.0, 9.0, 10.0, 200000)]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume bigint")
    good, bad = validate.split_valid(df)
    assert (good.count(), bad.count()) == (1, 1)
    assert bad.first()["validation_error"] == "Missing required field: date"
    stats = validate.ingestion_stats(validate.validate_bars(df)).first()
    assert (stats["total_records"], stats["inserted_records"], stats["validation_errors"]) == (2, 1, 1)
    none, nothing = validate.split_valid(df.limit(0))
    assert none.isEmpty() and nothing.isEmpty()


def test_gate(spark):
    q = spark.createDataFrame([(1.0,), (0.5,)], "quality_score double")
    summary = validate.quality_summary(q)
    assert validate.quality_gate(summary, 3, 0.7) == 0.75
    with pytest.raises(validate.QualityGateError, match="below threshold"):
        validate.quality_gate(summary)
    with pytest.raises(validate.QualityGateError, match="No records"):
        validate.quality_gate(summary, 0, 0.1)


def test_quality_flags_from_data(spark, bars):
    spiked = bars.withColumn("volume", F.when((F.col("date") == date(2020, 3, 1)) & (F.col("ticker") == "AAPL"), 10**9).otherwise(F.col("volume")))
    gapped = spiked.where(~F.col("date").between(date(2020, 4, 1), date(2020, 4, 10)))
    q = validate.quality_metrics(gapped)
    flagged = {(r["ticker"], r["date"]): r for r in q.where("volume_outlier or data_gap").collect()}
    assert flagged["AAPL", date(2020, 3, 1)]["volume_outlier"] and flagged["AAPL", date(2020, 3, 1)]["quality_score"] == 0.75
    assert flagged["GOOGL", date(2020, 4, 11)]["validation_errors"] == '["data_gap"]'


def test_latest_breaks_ties_by_source(spark):
    rows = [("A", date(2024, 1, 1), 1.0, "x"), ("A", date(2024, 1, 2), 2.0, "x"), ("A", date(2024, 1, 2), 3.0, "y")]
    out = validate.latest_per_ticker(spark.createDataFrame(rows, "ticker string, date date, close double, source string")).first()
    assert (out["close"], out["source"]) == (3.0, "y")


def test_newest_wins_is_stable(spark):
    old = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 1.0)], "k string, version int, v double")
    new = spark.createDataFrame([("A", 2, 2.0), ("B", 0, 9.0), ("C", 1, 3.0)], "k string, version int, v double")
    once = validate.newest_wins(old, new, ("k",), "version")
    twice = validate.newest_wins(once, new, ("k",), "version")
    want = {("A", 2, 2.0), ("B", 1, 1.0), ("C", 1, 3.0)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}
