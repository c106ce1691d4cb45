"""Registered queries on bars: loading, validation, quality, indicators, targets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import clean, indicators, targets, validate
from tickloom.plans import datasets
from tickloom.plans.registry import BARS_SQL, WINDOW_SQL, day_sql, frame, query, rolling_sql, rounded, rsql
from tickloom.sources import readers

BARS = f"WITH {BARS_SQL}"
LIMITS = validate.BarLimits(max_price="400000", min_volume=2, max_range="5.0")
SECTORS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
AS_OF = date(2001, 6, 30)
KEY = f"ticker, {day_sql('date')} AS date"


def keyed(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return rounded(df.select("ticker", "date", *digits), digits)


@query("ohlcv_bars", f"{BARS} SELECT ticker, sector, {day_sql('date')} AS date, open, high, low, close, volume FROM bars")
def ohlcv_bars(spark, folder):
    return datasets.bars(spark, folder)


@query("tick_bars", f"""SELECT event_type AS ticker, {day_sql('CAST(ts AS DATE)')} AS date, arg_min(value, ts) AS open,
  max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS volume
  FROM events GROUP BY event_type, CAST(ts AS DATE)""")
def tick_bars(spark, folder):
    return datasets.tick_bars(datasets.table(spark, folder, "events"))


WIDE = ", ".join(f"avg(close) FILTER (sector = '{s}') AS \"{s}\"" for s in SECTORS)


@query("unpivot_wide_prices", f"""{BARS}, wide AS (SELECT date, {WIDE} FROM bars GROUP BY date)
  SELECT {day_sql('date')} AS date, ticker, {rsql('close', 4)} AS close, {rsql('close', 4)} AS open,
  {rsql('close', 4)} AS high, {rsql('close', 4)} AS low, CAST(0 AS BIGINT) AS volume
  FROM wide UNPIVOT INCLUDE NULLS (close FOR ticker IN ({', '.join(f'"{s}"' for s in SECTORS)}))""")
def unpivot_wide_prices(spark, folder):
    b = datasets.bars(spark, folder)
    wide = b.groupBy("date").pivot("sector", SECTORS).agg(F.avg("close"))
    return rounded(readers.wide_closes_to_long(wide), {"close": 4, "open": 4, "high": 4, "low": 4})


LINE = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_first", f"""SELECT l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, {', '.join(LINE)} FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {', '.join(LINE)}) = 1""")
def dedup_first(spark, folder):
    lines = datasets.table(spark, folder, "lineitem")
    return clean.keep_first(lines, ("l_suppkey", "l_shipdate"), LINE)


WIDTH = "(high - low) / low"
ERROR_SQL = f"""CASE WHEN close < 0.01 OR close > 400000 THEN 'Price ' || CAST(close AS VARCHAR) || ' outside valid range'
  WHEN high < low THEN 'High < Low' WHEN close > high OR close < low THEN 'Close outside OHLC range'
  WHEN volume < 2 THEN 'Volume ' || CAST(volume AS VARCHAR) || ' below minimum'
  WHEN {WIDTH} > 5.0 THEN 'Unusual price range: ' || printf('%.2f', round({WIDTH} * 100, 2)) || '%' END"""


@query("validate_rules", f"{BARS} SELECT {KEY}, {ERROR_SQL} AS validation_error FROM bars")
def validate_rules(spark, folder):
    return validate.validate_bars(datasets.bars(spark, folder), LIMITS).select("ticker", "date", "validation_error")


@query("validate_split_counts", f"""{BARS}, c AS (SELECT ticker, {ERROR_SQL} AS e FROM bars)
  SELECT ticker, CAST(count(*) FILTER (e IS NULL) AS BIGINT) AS valid, CAST(count(*) FILTER (e IS NOT NULL) AS BIGINT) AS invalid
  FROM c GROUP BY ticker""")
def validate_split_counts(spark, folder):
    good, bad = validate.split_valid(datasets.bars(spark, folder), LIMITS)
    both = good.select("ticker", F.lit(True).alias("ok")).unionByName(bad.select("ticker", F.lit(False).alias("ok")))
    return both.groupBy("ticker").agg(F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("invalid"))


@query("ingestion_stats", f"""{BARS}, c AS (SELECT ticker, {ERROR_SQL} AS e FROM bars)
  SELECT count(*) AS total_records, count(*) FILTER (e IS NULL) AS inserted_records,
  count(*) FILTER (e IS NOT NULL) AS validation_errors, count(DISTINCT ticker) AS tickers_processed FROM c""")
def ingestion_stats(spark, folder):
    return validate.ingestion_stats(validate.validate_bars(datasets.bars(spark, folder), LIMITS))


@query("quality_flags", f"""{BARS} SELECT {KEY}, (open IS NULL OR close IS NULL OR volume IS NULL) AS missing_ohlcv,
  (close > high OR close < low) AS price_outlier FROM bars""")
def quality_flags(spark, folder):
    return validate.quality_flags(datasets.bars(spark, folder))


PAST = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
QUALITY_SQL = f"""r AS (SELECT *, close / lag(close) OVER w - 1 AS ret, date - lag(date) OVER w AS gap FROM bars {WINDOW_SQL}),
  f AS (SELECT ticker, date, (open IS NULL OR close IS NULL OR volume IS NULL) AS missing_ohlcv,
    (close > high OR close < low OR coalesce(count(ret) OVER {PAST} >= 20
      AND abs(ret - avg(ret) OVER {PAST}) > 1.5 * stddev_samp(ret) OVER {PAST}, false)) AS price_outlier,
    coalesce(volume > 2.0 * avg(volume) OVER {PAST}, false) AS volume_outlier,
    coalesce(gap > 10, false) AS data_gap FROM r),
  q AS (SELECT *, CAST(1 - 0.25 * (missing_ohlcv::INT + price_outlier::INT + volume_outlier::INT + data_gap::INT) AS DOUBLE) AS quality_score FROM f)"""
QUALITY_LIMITS = validate.BarLimits(outlier_sigmas=1.5, max_volume_spike=2.0)


def _quality(bars: DataFrame) -> DataFrame:
    return validate.quality_metrics(bars, QUALITY_LIMITS, max_gap_days=10)


@query("quality_metrics", f"{BARS}, {QUALITY_SQL} SELECT {KEY}, missing_ohlcv, price_outlier, volume_outlier, data_gap, quality_score FROM q")
def quality_metrics(spark, folder):
    return _quality(datasets.bars(spark, folder)).drop("validation_errors")


REPORT_SQL = f"""{BARS}, {QUALITY_SQL}, kept AS (SELECT * FROM q WHERE quality_score < 1)
  SELECT bars.ticker, CAST(bars.date AS VARCHAR) AS validation_date,
  (open IS NULL OR close IS NULL OR volume IS NULL) AS has_missing, (close > high OR close < low) AS has_outliers,
  coalesce(quality_score, 0.5) AS quality_score FROM bars LEFT JOIN kept ON bars.ticker = kept.ticker AND bars.date = kept.date"""


@query("quality_report", REPORT_SQL)
def quality_report(spark, folder):
    b = datasets.bars_table(spark, folder)
    return validate.quality_report(b, _quality(b).where(F.col("quality_score") < 1))


@query("quality_summary", f"""{BARS}, {QUALITY_SQL} SELECT count(*) AS total_records,
  count(*) FILTER (quality_score >= 0.9) AS high_quality_records, {rsql('avg(quality_score)', 6)} AS avg_quality_score FROM q""")
def quality_summary(spark, folder):
    return rounded(validate.quality_summary(_quality(datasets.bars(spark, folder))), {"avg_quality_score": 6})


@query("daily_quality", f"""SELECT n_name AS ticker, {day_sql('CAST(o_orderdate AS DATE)')} AS date, count(*) AS record_count,
  min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, {rsql('avg(o_orderkey)', 3)} AS avg_volume, count(*) > 0 AS has_data
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, CAST(o_orderdate AS DATE)""")
def daily_quality(spark, folder):
    o, c, n = (datasets.table(spark, folder, t) for t in ("orders", "customer", "nation"))
    raw = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("ticker"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("close"), F.col("o_orderkey").alias("volume"))
    return rounded(validate.daily_quality(raw), {"avg_volume": 3})


@query("latest_per_ticker", f"{BARS} SELECT DISTINCT ON (ticker) {KEY}, close, volume FROM bars ORDER BY ticker, bars.date DESC")
def latest_per_ticker(spark, folder):
    return validate.latest_per_ticker(datasets.bars(spark, folder), ["date", "close", "volume"])


@query("recent_bars", f"{BARS} SELECT {KEY}, close, volume, high, low FROM bars WHERE bars.date >= DATE '2001-06-30' - 200")
def recent_bars(spark, folder):
    return readers.recent(datasets.bars(spark, folder), AS_OF, 200).select("ticker", "date", "close", "volume", "high", "low")


@query("recent_bars_until", f"""{BARS} SELECT {KEY}, close, volume, high, low FROM bars
  WHERE bars.date BETWEEN DATE '1998-06-01' - 200 AND DATE '1998-06-01'""")
def recent_bars_until(spark, folder):
    """The same for a run of an earlier day."""
    day = date(1998, 6, 1)
    return readers.recent(datasets.bars(spark, folder), day, 200, until=day).select("ticker", "date", "close", "volume", "high", "low")


@query("bars_by_parameter", f"""{BARS} SELECT {KEY}, sector, open, high, low, close, volume FROM bars
  WHERE ticker = 'NATION_3' AND bars.date = DATE '1998-06-01'""")
def bars_by_parameter(spark, folder):
    return readers.for_ticker_date(spark, datasets.bars(spark, folder), "NATION_3", date(1998, 6, 1))


@query("distinct_tickers", f"{BARS} SELECT DISTINCT ticker FROM bars")
def distinct_tickers(spark, folder):
    return datasets.bars(spark, folder).select("ticker").distinct()


@query("returns", f"""{BARS} SELECT {KEY}, {rsql('close / lag(close) OVER w - 1', 8)} AS returns,
  {rsql('ln(close / lag(close) OVER w)', 8)} AS log_returns FROM bars {WINDOW_SQL.replace('date)', 'bars.date)')}""")
def returns(spark, folder):
    return keyed(indicators.with_returns(datasets.bars(spark, folder)), {"returns": 8, "log_returns": 8})


# Prices have two decimals: a mean of n of them is exact at these places, so that rounding meets no ties.
SMA_DIGITS = {5: 4, 10: 4, 20: 5, 50: 5, 200: 6}


def _sma(n: int) -> str:
    return f"{rsql(rolling_sql('avg', 'close', n), SMA_DIGITS[n])} AS sma_{n}"


INNER = "SELECT CAST(date AS VARCHAR) AS date, * EXCLUDE (date) FROM"


@query("sma_set", f"{BARS} {INNER} (SELECT ticker, date, {', '.join(_sma(n) for n in (5, 10, 20, 50, 200))} FROM bars)")
def sma_set(spark, folder):
    ns = (5, 10, 20, 50, 200)
    return keyed(indicators.with_sma(datasets.bars(spark, folder), ns), {f"sma_{n}": SMA_DIGITS[n] for n in ns})


MID, DEV = rolling_sql("avg", "close", 20), rolling_sql("stddev_samp", "close", 20)


@query("bollinger", f"""{BARS} {INNER} (SELECT ticker, date, {rsql(MID, 5)} AS bb_mid,
  {rsql(f'{MID} + 2 * {DEV}', 3)} AS bb_upper, {rsql(f'{MID} - 2 * {DEV}', 3)} AS bb_lower FROM bars)""")
def bollinger(spark, folder):
    return keyed(indicators.with_bollinger(datasets.bars(spark, folder)), {"bb_mid": 5, "bb_upper": 3, "bb_lower": 3})


def _rsi_sql(delta: str, full_gain: str) -> str:
    g, l = rolling_sql("avg", "gain", 14), rolling_sql("avg", "loss", 14)
    return f"""d AS (SELECT ticker, date, {delta} AS delta FROM bars {WINDOW_SQL}),
  gl AS (SELECT ticker, date, greatest(delta, delta * 0) AS gain, greatest(-delta, delta * 0) AS loss FROM d),
  m AS (SELECT ticker, date, {g} AS g, {l} AS l FROM gl),
  rsi AS (SELECT ticker, date, CASE WHEN l = 0 THEN {full_gain} ELSE 100 - 100 / (1 + g / l) END AS rsi_14 FROM m)"""


RSI_A = _rsi_sql("close - lag(close) OVER w", "NULL")
RSI_B = _rsi_sql("coalesce(close - lag(close) OVER w, 0)", "CASE WHEN g > 0 THEN 100 END")


@query("rsi_a", f"{BARS}, {RSI_A} SELECT {KEY}, {rsql('rsi_14', 6)} AS rsi_14 FROM rsi")
def rsi_a(spark, folder):
    return keyed(indicators.with_rsi(datasets.bars(spark, folder)), {"rsi_14": 6})


@query("rsi_b", f"{BARS}, {RSI_B} SELECT {KEY}, {rsql('rsi_14', 6)} AS rsi_14 FROM rsi")
def rsi_b(spark, folder):
    return keyed(indicators.with_rsi(datasets.bars(spark, folder), mode="zero_first"), {"rsi_14": 6})


ATR_SQL = f"""p AS (SELECT *, lag(close) OVER w AS pc FROM bars {WINDOW_SQL}),
  t AS (SELECT ticker, date, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr FROM p),
  atr AS (SELECT ticker, date, {rolling_sql('avg', 'tr', 14)} AS atr_14 FROM t)"""


@query("atr", f"{BARS}, {ATR_SQL} SELECT {KEY}, {rsql('atr_14', 4)} AS atr_14 FROM atr")
def atr(spark, folder):
    return keyed(indicators.with_atr(datasets.bars(spark, folder)), {"atr_14": 4})


RETURNS_SQL = f"rets AS (SELECT ticker, sector, date, close, volume, close / lag(close) OVER w - 1 AS returns FROM bars {WINDOW_SQL})"


@query("volatility", f"{BARS}, {RETURNS_SQL} {INNER} (SELECT ticker, date, {rsql(rolling_sql('stddev_samp', 'returns', 10), 6)} AS volatility_10 FROM rets)")
def volatility(spark, folder):
    return keyed(indicators.with_volatility(datasets.bars(spark, folder)), {"volatility_10": 6})


@query("obv", f"""{BARS}, s AS (SELECT ticker, date, coalesce(sign(close - lag(close) OVER w), 0) * volume AS v FROM bars {WINDOW_SQL})
  {INNER} (SELECT ticker, date, CAST(sum(v) OVER w AS BIGINT) AS obv FROM s {WINDOW_SQL})""")
def obv(spark, folder):
    return indicators.with_obv(datasets.bars(spark, folder)).select("ticker", "date", "obv")


@query("volume_features", f"""{BARS} {INNER} (SELECT ticker, date, {rsql('volume / lag(volume) OVER w - 1', 8)} AS volume_change,
  {rsql(rolling_sql('avg', 'volume', 20), 4)} AS volume_sma FROM bars {WINDOW_SQL})""")
def volume_features(spark, folder):
    return keyed(indicators.with_volume_features(datasets.bars(spark, folder)), {"volume_change": 8, "volume_sma": 4})


@query("candle_shape", f"""{BARS} SELECT {KEY}, {rsql('high - low', 2)} AS price_range, {rsql('(high - low) / close', 8)} AS price_range_pct,
  {rsql('(high - close) / close * 100', 6)} AS upper_shadow, {rsql('(close - low) / close * 100', 6)} AS lower_shadow FROM bars""")
def candle_shape(spark, folder):
    digits = {"price_range": 2, "price_range_pct": 8, "upper_shadow": 6, "lower_shadow": 6}
    return keyed(indicators.with_candle_shape(datasets.bars(spark, folder)), digits)


def _ema_list(xs: str, span: int) -> str:
    a = 2 / (span + 1)
    return f"list_reduce({xs}, lambda s, x: s * {1 - a!r}::DOUBLE + x * {a!r}::DOUBLE)"


EMA_SQL = f"""l AS (SELECT ticker, date, list(close) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS xs FROM bars),
  e AS (SELECT ticker, date, {_ema_list('xs', 12)} AS ema_12, {_ema_list('xs', 26)} AS ema_26 FROM l),
  ml AS (SELECT *, ema_12 - ema_26 AS macd, list(ema_12 - ema_26) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS ms FROM e),
  macd AS (SELECT ticker, date, ema_12, ema_26, macd, {_ema_list('ms', 9)} AS macd_signal FROM ml)"""


@query("ema_macd", f"""{BARS}, {EMA_SQL} SELECT {KEY}, {rsql('ema_12', 3)} AS ema_12, {rsql('ema_26', 3)} AS ema_26, {rsql('macd', 3)} AS macd,
  {rsql('macd_signal', 3)} AS macd_signal, {rsql('macd - macd_signal', 3)} AS macd_histogram FROM macd""")
def ema_macd(spark, folder):
    digits = dict.fromkeys(["ema_12", "ema_26", "macd", "macd_signal", "macd_histogram"], 3)
    return keyed(indicators.with_macd(datasets.bars(spark, folder)), digits)


LAGS, ROLLS = (1, 5, 10), (5, 20)
LAG_SQL = ", ".join(f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for k in LAGS for c in ("close", "volume"))
ROLL_SQL = ", ".join(
    f"{rsql(rolling_sql('avg', c, n), 5)} AS {c}_rolling_mean_{n}, {rsql(rolling_sql('stddev_samp', c, n), 3)} AS {c}_rolling_std_{n}"
    for n in ROLLS for c in ("close", "volume"))


@query("lag_roll_features", f"""{BARS} {INNER} (SELECT ticker, date, close, volume, {LAG_SQL}, {ROLL_SQL} FROM bars {WINDOW_SQL})
  WHERE close_lag_10 IS NOT NULL AND close_rolling_std_20 IS NOT NULL""")
def lag_roll_features(spark, folder):
    b = datasets.bars(spark, folder).select("ticker", "date", "close", "volume")
    out = indicators.temporal_features(b, LAGS, ROLLS)
    digits = {c: 5 if "_mean_" in c else 3 for c in out.columns if "_rolling_" in c}
    return rounded(out, digits)


TARGET_SQL = f"""n AS (SELECT ticker, date, close, lead(close) OVER w AS target_close FROM bars {WINDOW_SQL}),
  tg AS (SELECT *, (target_close - close) / close AS target_return FROM n)"""


@query("targets", f"""{BARS}, {TARGET_SQL} SELECT {KEY}, {rsql('target_return', 8)} AS target_return,
  CASE WHEN target_return > 0 THEN 1 ELSE 0 END AS target_binary,
  CASE WHEN target_return > 0 THEN 'up' WHEN target_return < 0 THEN 'down' ELSE 'flat' END AS target_direction
  FROM tg WHERE target_return IS NOT NULL""")
def target_rows(spark, folder):
    return rounded(targets.target_table(datasets.bars(spark, folder)).drop("confidence"), {"target_return": 8})


@query("targets_ahead", f"""{BARS}, n AS (SELECT ticker, date, close, lead(close, 3) OVER w AS target_close FROM bars {WINDOW_SQL})
  SELECT {KEY}, target_close, {rsql('(target_close - close) / close', 8)} AS target_return,
  CASE WHEN (target_close - close) / close > 0 THEN 1 ELSE 0 END AS target_direction FROM n""")
def targets_ahead(spark, folder):
    out = targets.with_targets(datasets.bars(spark, folder), 3)
    return rounded(out.select("ticker", "date", "target_close", "target_return", "target_direction"), {"target_return": 8})


CALENDAR_SQL = """span AS (SELECT ticker, min(date) AS lo, max(date) AS hi FROM bars GROUP BY ticker),
  cal AS (SELECT ticker, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS date FROM span),
  full_rows AS (SELECT cal.ticker, cal.date, close FROM cal LEFT JOIN bars ON cal.ticker = bars.ticker AND cal.date = bars.date)"""


@query("gap_fill", f"""{BARS}, {CALENDAR_SQL} {INNER} (SELECT ticker, date, last_value(close IGNORE NULLS) OVER w AS close,
  CASE WHEN close IS NULL THEN 'forward_fill' ELSE 'raw' END AS cleaning_method FROM full_rows {WINDOW_SQL})""")
def gap_fill(spark, folder):
    return clean.fill_gaps(datasets.bars_table(spark, folder), "forward_fill", 7).select("ticker", "date", "close", "cleaning_method")


AHEAD = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
KNOWN_DAY = "CASE WHEN close IS NOT NULL THEN date END"


@query("gap_interpolate", f"""{BARS}, {CALENDAR_SQL}, k AS (SELECT ticker, date, close, last_value(close IGNORE NULLS) OVER w AS c0,
  last_value({KNOWN_DAY} IGNORE NULLS) OVER w AS d0, first_value(close IGNORE NULLS) OVER {AHEAD} AS c1,
  first_value({KNOWN_DAY} IGNORE NULLS) OVER {AHEAD} AS d1 FROM full_rows {WINDOW_SQL})
  SELECT {KEY}, {rsql('coalesce(close, c0 + (c1 - c0) * ((date - d0) / nullif(d1 - d0, 0)))', 8)} AS close,
  CASE WHEN close IS NULL THEN 'interpolation' ELSE 'raw' END AS cleaning_method FROM k""")
def gap_interpolate(spark, folder):
    out = clean.fill_gaps(datasets.bars_table(spark, folder), "interpolation", 7)
    return rounded(out.select("ticker", "date", "close", "cleaning_method"), {"close": 8})


@query("sector_context", f"""{BARS}, {RETURNS_SQL} SELECT sector, {day_sql('date')} AS date, {rsql('avg(returns)', 6)} AS sector_momentum,
  {rsql('stddev_samp(returns)', 6)} AS sector_volatility FROM rets GROUP BY sector, rets.date""")
def sector_context(spark, folder):
    r = indicators.with_returns(datasets.bars(spark, folder))
    return rounded(indicators.sector_context(r), {"sector_momentum": 6, "sector_volatility": 6})


MARKET_SQL = """mk AS (SELECT date, avg(returns) AS market_return, stddev_samp(returns) AS market_volatility FROM rets GROUP BY date),
  tr AS (SELECT *, avg(market_return) OVER f AS trend FROM mk WINDOW f AS (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
  st AS (SELECT *, CAST(count(*) FILTER (sign(market_return) = sign(trend)) OVER f AS DOUBLE) / count(market_return) OVER f AS strength
    FROM tr WINDOW f AS (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""


@query("market_conditions", f"""{BARS}, {RETURNS_SQL}, {MARKET_SQL} SELECT {day_sql('date')} AS date, {rsql('market_return', 6)} AS market_return,
  {rsql('market_volatility', 6)} AS market_volatility,
  CASE WHEN market_return > 0.02 THEN 'bullish' WHEN market_return < -0.02 THEN 'bearish' ELSE 'neutral' END AS market_sentiment,
  CASE WHEN trend > 0.02 THEN 'uptrend' WHEN trend < -0.02 THEN 'downtrend' ELSE 'sideways' END AS market_trend,
  {rsql('CASE WHEN isfinite(strength) THEN strength END', 6)} AS market_trend_strength FROM st""")
def market_conditions(spark, folder):
    out = indicators.market_conditions(indicators.with_returns(datasets.bars(spark, folder)))
    return rounded(out, {"market_return": 6, "market_volatility": 6, "market_trend_strength": 6})


def _corr_sql(other: str) -> str:
    f = frame(20)
    return f"""CASE WHEN count(CASE WHEN returns IS NOT NULL AND {other} IS NOT NULL THEN 1 END) OVER {f} >= 20 THEN
      covar_pop(returns, {other}) OVER {f} / nullif(stddev_pop(CASE WHEN {other} IS NOT NULL THEN returns END) OVER {f}
      * stddev_pop(CASE WHEN returns IS NOT NULL THEN {other} END) OVER {f}, 0) END"""


@query("rolling_corr", f"""{BARS}, {RETURNS_SQL}, m AS (SELECT date, avg(returns) AS a FROM rets GROUP BY date),
  s AS (SELECT sector, date, avg(returns) AS b FROM rets GROUP BY sector, date),
  j AS (SELECT rets.ticker, rets.date, returns, a, s.b AS b, t.b AS c FROM rets LEFT JOIN m ON rets.date = m.date
    LEFT JOIN s ON rets.sector = s.sector AND rets.date = s.date LEFT JOIN s AS t ON t.sector = 'ASIA' AND rets.date = t.date)
  {INNER} (SELECT ticker, date, {rsql(_corr_sql('a'), 6)} AS correlation_sp500, {rsql(_corr_sql('b'), 6)} AS correlation_sector,
  {rsql(_corr_sql('c'), 6)} AS correlation_tech FROM j)""")
def rolling_corr(spark, folder):
    out = indicators.market_context(datasets.bars_table(spark, folder), "ASIA", 20)
    return keyed(out, dict.fromkeys(["correlation_sp500", "correlation_sector", "correlation_tech"], 6))


SCORE_FEATURES = ["open", "high", "low", "volume"]
SCORE_SQL = " UNION ALL ".join(
    f"SELECT ticker AS model_version, '{f}' AS feature_name, 'correlation' AS importance_type, {rsql(f'CASE WHEN isfinite(corr({f}, close)) THEN abs(corr({f}, close)) END', 6)} AS importance_score FROM bars GROUP BY ticker"
    for f in SCORE_FEATURES)


@query("importance_rank", f"""{BARS}, sc AS ({SCORE_SQL})
  SELECT *, CAST(rank() OVER (PARTITION BY model_version, importance_type ORDER BY importance_score DESC NULLS LAST) AS INTEGER) AS rank FROM sc""")
def importance_rank(spark, folder):
    from tickloom.functions.stats import pearson

    b = datasets.bars(spark, folder)
    scores = [F.struct(F.lit(f).alias("feature_name"), (F.round(F.abs(pearson(F.col(f), F.col("close"))), 6) + F.lit(0.0)).alias("importance_score"))
              for f in SCORE_FEATURES]
    wide = b.groupBy(F.col("ticker").alias("model_version")).agg(F.array(*scores).alias("s"))
    rows = wide.select("model_version", F.lit("correlation").alias("importance_type"), F.inline("s"))
    return validate.rank_importance(rows)
