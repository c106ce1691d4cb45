import numpy as np
import pandas as pd
import pytest

from tests.conftest import price_series
from tickloom.functions.ema import with_ema
from tickloom.operators import indicators, targets


def joined(df, pdf, column):
    got = df.select("ticker", "date", column).toPandas().merge(pdf[["ticker", "date"]], on=["ticker", "date"], how="right")
    return got[column].astype(float).to_numpy()


def per_ticker(pdf, f):
    return np.concatenate([np.asarray(f(g), dtype=float) for _, g in pdf.groupby("ticker", sort=False)])


def same(a, b):
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)


def gains(c, first_zero):
    d = c.diff()
    up, down = d.clip(lower=0), -d.clip(upper=0)
    if first_zero:
        up, down = up.fillna(0), down.fillna(0)
    return up.rolling(14).mean(), down.rolling(14).mean()


def test_ema_of_long_series(spark):
    pdf = price_series(2500, seed=3)
    df = with_ema(spark.createDataFrame(pdf), "close", {"e12": 12, "e26": 26, "e9": 9, "e200": 200})
    for name, span in [("e12", 12), ("e26", 26), ("e9", 9), ("e200", 200)]:
        same(joined(df, pdf, name), pdf["close"].ewm(span=span, adjust=False).mean())


def test_macd(bars, bars_pdf):
    df = indicators.with_macd(bars)

    def macd(g):
        return g["close"].ewm(span=12, adjust=False).mean() - g["close"].ewm(span=26, adjust=False).mean()

    same(joined(df, bars_pdf, "macd_signal"), per_ticker(bars_pdf, lambda g: macd(g).ewm(span=9, adjust=False).mean()))
    same(joined(df, bars_pdf, "macd"), per_ticker(bars_pdf, macd))


@pytest.mark.parametrize("mode", ["null_first", "zero_first"])
def test_rsi(bars, bars_pdf, mode):
    def rsi(g):
        up, down = gains(g["close"], mode == "zero_first")
        return 100 - 100 / (1 + up / down)

    got = joined(indicators.with_rsi(bars, mode=mode), bars_pdf, "rsi_14")
    same(got, per_ticker(bars_pdf, rsi))
    assert np.isnan(got[:14]).sum() == (14 if mode == "null_first" else 13)


def test_rsi_without_losses(spark):
    pdf = price_series(20)
    pdf["close"] = np.arange(1.0, 21.0)
    df = spark.createDataFrame(pdf)
    assert np.isnan(joined(indicators.with_rsi(df), pdf, "rsi_14")).all()
    assert joined(indicators.with_rsi(df, mode="zero_first"), pdf, "rsi_14")[-1] == 100
    flat = df.withColumn("close", df.close * 0 + 1)
    assert np.isnan(joined(indicators.with_rsi(flat, mode="zero_first"), pdf, "rsi_14")).all()


def test_bollinger_atr_volatility(bars, bars_pdf):
    same(joined(indicators.with_bollinger(bars), bars_pdf, "bb_upper"),
         per_ticker(bars_pdf, lambda g: g["close"].rolling(20).mean() + 2 * g["close"].rolling(20).std()))

    def atr(g):
        pc = g["close"].shift()
        tr = pd.concat([g["high"] - g["low"], (g["high"] - pc).abs(), (g["low"] - pc).abs()], axis=1).max(axis=1)
        return tr.rolling(14).mean()

    same(joined(indicators.with_atr(bars), bars_pdf, "atr_14"), per_ticker(bars_pdf, atr))
    same(joined(indicators.with_volatility(bars), bars_pdf, "volatility_10"), per_ticker(bars_pdf, lambda g: g["close"].pct_change().rolling(10).std()))


def test_temporal_features(spark):
    pdf = price_series(100)[["ticker", "date", "close", "volume"]]
    out = indicators.temporal_features(spark.createDataFrame(pdf), [1, 5, 10], [5, 20])
    assert out.count() == 81
    assert {"close_lag_10", "volume_rolling_std_20"} <= set(out.columns)
    assert not [c for c in out.columns if c.count("_rolling_") > 1 or "lag_1_rolling" in c]
    want = pdf["close"].rolling(20).std().to_numpy()[19:]
    same(np.array([r[0] for r in out.orderBy("date").select("close_rolling_std_20").collect()]), want)


def test_technical_table(bars):
    out = indicators.technical_features(bars)
    assert out.columns == ["ticker", "date", *indicators.TECHNICAL_COLUMNS] and len(indicators.TECHNICAL_COLUMNS) == 19
    assert out.count() == bars.count()


def test_sequences(spark):
    pdf = price_series(30)
    s = targets.sequences(spark.createDataFrame(pdf), ["open", "close"], 10).orderBy("date").collect()
    assert len(s) == 20
    np.testing.assert_allclose(s[0]["x"], pdf[["open", "close"]].to_numpy()[:10])
    assert s[0]["y"] == pdf["close"][10]


def test_sql_functions(spark, bars):
    from datetime import date

    from tickloom.functions import sql

    bars.createOrReplaceTempView("bars_for_sql")
    spark.createDataFrame([("AAPL", date(2020, 3, 2), 0.25)], "ticker string, date date, quality_score double").createOrReplaceTempView("quality_for_sql")
    sql.register(spark, "bars_for_sql", "quality_for_sql")
    rows = spark.sql("SELECT * FROM validate_market_data(DATE '2020-03-02') ORDER BY ticker").collect()
    assert [(r["ticker"], r["has_missing"], r["has_outliers"], r["quality_score"]) for r in rows] == [("AAPL", False, False, 0.25), ("GOOGL", False, False, 0.5)]
    assert spark.sql("SELECT * FROM validate_market_data()").count() == 0
    expected = {(r["ticker"], r["date"]): r["rsi"] for r in indicators.rsi_of(bars, 9).collect()}
    got = spark.sql("SELECT ticker, date, compute_rsi(ticker, date, 9) AS rsi FROM bars_for_sql").collect()
    assert len(got) == len(expected)
    for r in got:
        want = expected[r["ticker"], r["date"]]
        assert (r["rsi"] is None) == (want is None) and (want is None or abs(r["rsi"] - want) < 1e-9)
    one = spark.sql("SELECT compute_rsi('AAPL', DATE '2030-01-01') AS last, compute_rsi('none', DATE '2020-03-02') AS none, compute_rsi('AAPL', DATE '2020-01-03') AS early").first()
    assert one["last"] is not None and one["none"] is None and one["early"] is None
