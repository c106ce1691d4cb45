"""Technical indicators. Each function adds columns to a bar table; all windows share one order per ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ema import with_ema
from tickloom.functions.rolling import bars_window, pct_change, rolling, running, safe_ratio
from tickloom.functions.stats import pearson


def _num(name: str) -> Column:
    return F.col(name).cast("double")


def with_returns(bars: DataFrame) -> DataFrame:
    close = _num("close")
    previous = F.lag(close).over(bars_window())
    return bars.withColumns({
        "returns": F.try_divide(close, previous) - 1,
        "log_returns": F.ln(F.try_divide(close, previous)),
    })


def with_sma(bars: DataFrame, windows: Sequence[int] = (5, 10, 20)) -> DataFrame:
    return bars.withColumns({f"sma_{n}": rolling(F.avg, _num("close"), n) for n in windows})


def with_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """EMA pair, their difference, its own EMA, and the histogram."""
    f, s = f"ema_{fast}", f"ema_{slow}"
    out = with_ema(bars, "close", {f: fast, s: slow}).withColumn("macd", F.col(f) - F.col(s))
    out = with_ema(out, "macd", {"macd_signal": signal})
    return out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def with_rsi(bars: DataFrame, period: int = 14, mode: str = "null_first", name: str | None = None) -> DataFrame:
    """Relative strength index on simple means.

    ``null_first``: the first bar has no change; no losses in the window give null.
    ``zero_first``: the first bar counts as no change; no losses give 100 (null if there are no gains either).
    """
    if mode not in ("null_first", "zero_first"):
        raise ValueError(f"unknown RSI mode {mode}")
    delta = _num("close") - F.lag(_num("close")).over(bars_window())
    if mode == "zero_first":
        delta = F.coalesce(delta, F.lit(0.0))
    out = bars.withColumns({"__gain": F.greatest(delta, delta * 0), "__loss": F.greatest(-delta, delta * 0)})
    gain, loss = rolling(F.avg, F.col("__gain"), period), rolling(F.avg, F.col("__loss"), period)
    out = out.withColumns({"__gain": gain, "__loss": loss})
    strength = F.try_divide(F.col("__gain"), F.col("__loss"))
    rsi = 100 - F.try_divide(F.lit(100.0), 1 + strength)
    if mode == "zero_first":
        rsi = F.when((F.col("__loss") == 0) & (F.col("__gain") > 0), F.lit(100.0)).otherwise(rsi)
    return out.withColumn(name or f"rsi_{period}", rsi).drop("__gain", "__loss")


def with_bollinger(bars: DataFrame, n: int = 20, width: float = 2.0,
                   names: Sequence[str] = ("bb_mid", "bb_upper", "bb_lower")) -> DataFrame:
    mid, dev = rolling(F.avg, _num("close"), n), rolling(F.stddev_samp, _num("close"), n)
    return bars.withColumns({names[0]: mid, names[1]: mid + width * dev, names[2]: mid - width * dev})


def with_atr(bars: DataFrame, period: int = 14) -> DataFrame:
    high, low = _num("high"), _num("low")
    previous = F.lag(_num("close")).over(bars_window())
    out = bars.withColumn("__tr", F.greatest(high - low, F.abs(high - previous), F.abs(low - previous)))
    return out.withColumn(f"atr_{period}", rolling(F.avg, F.col("__tr"), period)).drop("__tr")


def with_candle_shape(bars: DataFrame, percent: bool = False) -> DataFrame:
    """Range and shadows of a bar. ``price_range_pct`` is a fraction, or a percentage as in the feature table."""
    spread = _num("high") - _num("low")
    return bars.withColumns({
        "price_range": spread,
        "price_range_pct": safe_ratio(spread, _num("close")) * (100 if percent else 1),
        "upper_shadow": safe_ratio(_num("high") - _num("close"), _num("close")) * 100,
        "lower_shadow": safe_ratio(_num("close") - _num("low"), _num("close")) * 100,
    })


def with_volume_features(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.withColumns({
        "volume_change": pct_change(_num("volume")),
        "volume_sma": rolling(F.avg, _num("volume"), n),
    })


def with_volatility(bars: DataFrame, n: int = 10) -> DataFrame:
    out = bars if "returns" in bars.columns else with_returns(bars)
    return out.withColumn(f"volatility_{n}", rolling(F.stddev_samp, F.col("returns"), n))


def with_obv(bars: DataFrame) -> DataFrame:
    """On-balance volume: running sum of volume signed by the change of close."""
    sign = F.coalesce(F.signum(_num("close") - F.lag(_num("close")).over(bars_window())), F.lit(0.0))
    out = bars.withColumn("__signed", (sign * F.col("volume")).cast("bigint"))
    return out.withColumn("obv", F.sum("__signed").over(running())).drop("__signed")


def engineer_features(bars: DataFrame) -> DataFrame:
    """The feature set of the file pipeline."""
    out = with_returns(bars)
    out = with_sma(out, (5, 10, 20))
    out = with_macd(out).drop("macd_histogram")
    out = with_bollinger(with_rsi(out))
    out = with_candle_shape(out).drop("upper_shadow", "lower_shadow")
    out = out.withColumn("volume_change", pct_change(_num("volume")))
    return with_volatility(out)


def technical_features(bars: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 19 columns of the technical feature table, keyed by (ticker, date), and columns that are only passed on."""
    out = with_sma(bars, (20, 50, 200))
    out = with_macd(out).withColumnRenamed("macd", "macd_line")
    out = with_atr(with_rsi(out, mode="zero_first"))
    out = with_bollinger(out, names=("bollinger_middle", "bollinger_upper", "bollinger_lower"))
    out = with_obv(with_volume_features(out)).withColumn("volume_sma", F.col("volume_sma").cast("bigint"))
    out = with_candle_shape(out, percent=True)
    return out.select("ticker", "date", *TECHNICAL_COLUMNS, *carry)


# Names of the technical feature table.
TECHNICAL_COLUMNS = [
    "rsi_14", "macd_line", "macd_signal", "macd_histogram", "sma_20", "sma_50", "sma_200", "ema_12", "ema_26", "atr_14",
    "bollinger_upper", "bollinger_middle", "bollinger_lower", "obv", "volume_sma", "price_range", "price_range_pct",
    "upper_shadow", "lower_shadow",
]


def rsi_of(bars: DataFrame, period: int = 14) -> DataFrame:
    """RSI of every (ticker, date) as a table."""
    return with_rsi(bars, period, name="rsi").select("ticker", "date", "rsi")


def temporal_features(bars: DataFrame, lags: Sequence[int], windows: Sequence[int],
                      columns: Sequence[str] | None = None, drop: bool = True) -> DataFrame:
    """``{c}_lag_{k}``, ``{c}_rolling_mean_{n}`` and ``{c}_rolling_std_{n}`` of the original numeric columns."""
    numeric = list(columns or [n for n, t in bars.dtypes if t in ("double", "bigint")])
    w = bars_window()
    added: dict[str, Column] = {f"{c}_lag_{k}": F.lag(c, k).over(w) for k in lags for c in numeric}
    for n in windows:
        for c in numeric:
            added[f"{c}_rolling_mean_{n}"] = rolling(F.avg, _num(c), n)
            added[f"{c}_rolling_std_{n}"] = rolling(F.stddev_samp, _num(c), n)
    out = bars.withColumns(added)
    return out.na.drop() if drop else out


def with_rolling_corr(bars: DataFrame, benchmark: DataFrame, n: int, name: str, on: Sequence[str] = ("date",)) -> DataFrame:
    """Correlation of ``returns`` with a benchmark's ``benchmark_return`` over the last ``n`` common rows."""
    out = bars.join(benchmark, list(on), "left")
    both = F.when(F.col("returns").isNotNull() & F.col("benchmark_return").isNotNull(), F.lit(1))
    frame = bars_window().rowsBetween(-(n - 1), 0)
    corr = pearson(F.col("returns"), F.col("benchmark_return"), lambda c: c.over(frame))
    return out.withColumn(name, F.when(F.count(both).over(frame) >= n, corr)).drop("benchmark_return")


def sector_context(bars_with_returns: DataFrame) -> DataFrame:
    """Mean and deviation of returns in each (sector, date)."""
    return bars_with_returns.groupBy("sector", "date").agg(
        F.avg("returns").alias("sector_momentum"), F.stddev_samp("returns").alias("sector_volatility")
    )


def market_conditions(bars_with_returns: DataFrame, flat: float = 0.02, trend_rows: int = 5) -> DataFrame:
    """One row per date over the whole cross-section.

    Sentiment: mean return above ``flat`` is bullish, below ``-flat`` bearish. Trend: the mean of the last
    ``trend_rows`` cross-section returns, judged the same way; strength: share of those rows that point the same
    way as their mean. Volatility: deviation of returns across tickers.
    """
    daily = bars_with_returns.groupBy("date").agg(
        F.avg("returns").alias("market_return"), F.stddev_samp("returns").alias("market_volatility")
    )
    # One row per calendar date: the unpartitioned order is as long as the calendar.
    w = bars_window(()).rowsBetween(-(trend_rows - 1), 0)
    trend = F.avg("market_return").over(w)
    agree = F.count_if(F.signum("market_return") == F.signum(F.col("__trend"))).over(w)
    out = daily.withColumn("__trend", trend).withColumn("__agree", agree)

    def judged(x: Column, up: str, down: str, middle: str) -> Column:
        return F.when(x > flat, F.lit(up)).when(x < -flat, F.lit(down)).otherwise(F.lit(middle))

    return out.select(
        "date", "market_return", "market_volatility",
        judged(F.col("market_return"), "bullish", "bearish", "neutral").alias("market_sentiment"),
        judged(F.col("__trend"), "uptrend", "downtrend", "sideways").alias("market_trend"),
        F.try_divide(F.col("__agree").cast("double"), F.count("market_return").over(w).cast("double")).alias("market_trend_strength"),
    )


def market_context(bars: DataFrame, tech_sector: str, corr_rows: int = 20) -> DataFrame:
    """The market-context feature table. The index return is the mean return of all tickers; the tech index is the
    mean return of one sector."""
    r = with_returns(bars).select("ticker", "sector", "date", "returns")
    sector, market = sector_context(r), market_conditions(r)
    out = with_rolling_corr(r, market.select("date", F.col("market_return").alias("benchmark_return")), corr_rows, "correlation_sp500")
    bench = sector.select("sector", "date", F.col("sector_momentum").alias("benchmark_return"))
    out = with_rolling_corr(out, bench, corr_rows, "correlation_sector", ("sector", "date"))
    tech = bench.where(F.col("sector") == tech_sector).drop("sector")
    out = with_rolling_corr(out, tech, corr_rows, "correlation_tech")
    return out.join(sector, ["sector", "date"], "left").join(market.drop("market_return"), "date", "left").select(
        "ticker", "date", *CONTEXT_COLUMNS
    )


# Names of the market-context feature table.
CONTEXT_COLUMNS = [
    "market_sentiment", "sector_momentum", "sector_volatility", "correlation_sp500", "correlation_sector",
    "correlation_tech", "market_volatility", "market_trend", "market_trend_strength",
]
