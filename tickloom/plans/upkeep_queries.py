"""Registered queries of tables that are kept up to date: features after late and corrected bars, newest rows with retraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import maintained, recurrence
from tickloom.operators.indicators import technical_features
from tickloom.plans import datasets
from tickloom.plans.market_queries import BARS, EMA_SQL, RSI_B
from tickloom.plans.registry import WINDOW_SQL, day_sql, query, rolling_sql, rounded, rsql
from tickloom.session import stored, work_folder

LATE = "ticker LIKE '%3' AND date BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'"
CORRECTED = "ticker LIKE '%7' AND (date BETWEEN DATE '1999-06-01' AND DATE '1999-06-20' OR date > DATE '2000-01-01' AND dayofyear(date) < 5)"
DIGITS = {"ema_12": 3, "ema_26": 3, "macd_signal": 3, "sma_200": 6, "rsi_14": 6}


@query("incremental_features", f"""{BARS}, {EMA_SQL}, {RSI_B}, v AS (SELECT *, coalesce(sign(close - lag(close) OVER w), 0) * volume AS v FROM bars {WINDOW_SQL}),
  o AS (SELECT ticker, date, CAST(sum(v) OVER w AS BIGINT) AS obv, {rolling_sql('avg', 'close', 200)} AS sma_200 FROM v {WINDOW_SQL}),
  c AS (SELECT ticker, min(date) AS first FROM bars WHERE {LATE} OR {CORRECTED} GROUP BY ticker)
  SELECT o.ticker, {day_sql('o.date')} AS date, {rsql('ema_12', 3)} AS ema_12, {rsql('ema_26', 3)} AS ema_26, {rsql('macd_signal', 3)} AS macd_signal, obv,
  {rsql('sma_200', 6)} AS sma_200, {rsql('rsi_14', 6)} AS rsi_14, coalesce(o.date >= first, false) AS renewed
  FROM o JOIN macd m ON o.ticker = m.ticker AND o.date = m.date JOIN rsi r ON o.ticker = r.ticker AND o.date = r.date LEFT JOIN c ON o.ticker = c.ticker""")
def incremental_features(spark, folder):
    """Features of bars of which some came late and some were corrected: only rows from the first change on are renewed."""
    bars = datasets.bars_table(spark, folder)
    wrong = F.when(F.expr(CORRECTED), F.col("close") * 1.01).otherwise(F.col("close"))
    early = bars.where(~F.expr(LATE)).withColumn("close", wrong)
    kept = stored(technical_features(early), "features")
    before, now = (stored(recurrence.month_blocks(b), "months") for b in (early, bars))
    seeded = stored(recurrence.seeds(now, recurrence.first_changes(before, now)), "seeds")
    renewed = stored(recurrence.replayed(bars, seeded), "replayed")
    rows = kept.join(renewed.select("ticker", "date"), ["ticker", "date"], "left_anti").withColumn("renewed", F.lit(False)).unionByName(renewed.withColumn("renewed", F.lit(True)))
    return rounded(rows.select("ticker", "date", *DIGITS, "obv", "renewed"), DIGITS)


GONE = "dayofyear(date) % 3 = 0 AND date > DATE '2001-01-01' AND length(ticker) = 8"


@query("latest_maintained", f"""{BARS}, b AS (SELECT * FROM bars WHERE NOT ({GONE}))
  SELECT ticker, {day_sql('max(date)')} AS date, arg_max(close, date) AS close, arg_max(volume, date) AS volume FROM b GROUP BY ticker""")
def latest_maintained(spark, folder):
    """Newest bar of every ticker after inserts, a correction and deletions, each applied to the view and each applied twice."""
    bars = datasets.bars_table(spark, folder).select("ticker", "date", "close", "volume")
    path, flag = work_folder(spark, "view"), lambda df, gone: df.withColumn("deleted", F.lit(gone))
    first = bars.where("date <= DATE '2000-06-01'").withColumn("close", F.col("close") + F.when(F.col("date") > F.lit("2000-01-01"), 1).otherwise(0))
    middle = bars.where("date <= DATE '2001-03-01'")
    steps = [(first, flag(first, False)), (middle, flag(middle.where("date > DATE '2000-01-01'"), False)), (bars, flag(bars.where("date > DATE '2001-03-01'"), False)),
             (bars.where(f"NOT ({GONE})"), flag(bars.where(GONE), True))]
    for base, changes in steps:
        for _ in range(2):
            maintained.maintain(spark, path, base, changes, ["ticker"], "date", bars.schema, 8)
    return maintained.view_rows(spark, path, ["ticker"], bars.schema)
