"""Indicators kept up to date: what recurrences remember of each month, and their replay from the first changed bar.

Exponential averages, the MACD signal and on-balance volume depend on all bars before. A month acts on the averages as an
affine map, so a ticker's state at any month follows from the short list of its months by composing these maps, and a
late or corrected bar changes the map of its own month only. Rows before that bar stay; later ones are computed anew from the
state at a month far enough back to fill the longest window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.rolling import bars_window
from tickloom.operators.indicators import TECHNICAL_COLUMNS, technical_features

FAST, SLOW, SIGNAL = 12, 26, 9
#: Rows before the first changed one that its windows read.
TAIL = 200
BLOCK_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("month", T.StringType()),
    T.StructField("bars", T.ArrayType(T.StructType([T.StructField("date", T.DateType()), T.StructField("hash", T.LongType())]))),
    *[T.StructField(c, T.LongType() if c in ("n", "first_volume", "obv") else T.DoubleType())
      for c in ("n", "first_close", "first_volume", "last_close", "f", "s", "gf", "gs", "g", "obv")],
])


def _share(span: int) -> float:
    return 2 / (span + 1)


AF, AS, AG = _share(FAST), _share(SLOW), _share(SIGNAL)
KF, KS, KG = 1 - AF, 1 - AS, 1 - AG

# One bar x after another: fast average f = kf^n f0 + f, slow one s, and signal g = kg^n g0 + gf f0 + gs s0 + g.
_START = "named_struct('f', 0D, 's', 0D, 'pf', 1D, 'ps', 1D, 'gf', 0D, 'gs', 0D, 'g', 0D, 'last', CAST(NULL AS DOUBLE), 'obv', 0L)"
_STEP = f"""named_struct('f', {KF!r}D * a.f + {AF!r}D * b.close, 's', {KS!r}D * a.s + {AS!r}D * b.close, 'pf', {KF!r}D * a.pf, 'ps', {KS!r}D * a.ps,
  'gf', {KG!r}D * a.gf + {AG!r}D * {KF!r}D * a.pf, 'gs', {KG!r}D * a.gs - {AG!r}D * {KS!r}D * a.ps,
  'g', {KG!r}D * a.g + {AG!r}D * ({KF!r}D * a.f + {AF!r}D * b.close - {KS!r}D * a.s - {AS!r}D * b.close),
  'last', b.close, 'obv', a.obv + CAST(coalesce(signum(b.close - a.last), 0D) * b.volume AS BIGINT))"""
_STATE = "struct<month: string, n: bigint, f: double, s: double, g: double, obv: bigint, last: double>"
# One month after another; the state in front of each is kept. Before the first bar both averages stand at its price.
_MONTHS = f"""aggregate(blocks, named_struct('n', 0L, 'f', blocks[0].first_close, 's', blocks[0].first_close, 'g', 0D, 'obv', 0L, 'last', CAST(NULL AS DOUBLE),
    'out', CAST(array() AS array<{_STATE}>)),
  (a, b) -> named_struct('n', a.n + b.n, 'f', pow({KF!r}D, b.n) * a.f + b.f, 's', pow({KS!r}D, b.n) * a.s + b.s,
    'g', pow({KG!r}D, b.n) * a.g + b.gf * a.f + b.gs * a.s + b.g,
    'obv', a.obv + CAST(coalesce(signum(b.first_close - a.last), 0D) * b.first_volume AS BIGINT) + b.obv, 'last', b.last_close,
    'out', concat(a.out, array(named_struct('month', b.month, 'n', a.n, 'f', a.f, 's', a.s, 'g', a.g, 'obv', a.obv, 'last', a.last)))),
  a -> a.out)"""


def month_blocks(bars: DataFrame) -> DataFrame:
    """One row per ticker and month: how the month acts on the recurrences, and a hash of each of its bars.

    ``bars`` has one row per ticker and date; a month is bounded by the calendar. Bars need a close; a null volume counts
    as none.
    """
    hashed = F.xxhash64(*[F.col(c).cast("double") for c in ("open", "high", "low", "close")], F.col("volume").cast("bigint"))
    bar = F.struct("date", F.col("close").cast("double").alias("close"), F.coalesce(F.col("volume").cast("bigint"), F.lit(0)).alias("volume"), hashed.alias("hash"))
    rows = bars.groupBy("ticker", F.date_format("date", "yyyy-MM").alias("month")).agg(F.array_sort(F.collect_list(bar)).alias("b"))
    rows = rows.withColumn("end", F.expr(f"aggregate(b, {_START}, (a, b) -> {_STEP})"))
    return rows.select(
        "ticker", "month", F.transform("b", lambda b: F.struct(b["date"].alias("date"), b["hash"].alias("hash"))).alias("bars"), F.size("b").cast("bigint").alias("n"),
        F.get("b", F.lit(0))["close"].alias("first_close"), F.get("b", F.lit(0))["volume"].alias("first_volume"), F.col("end.last").alias("last_close"),
        *[F.col(f"end.{c}").alias(c) for c in ("f", "s", "gf", "gs", "g", "obv")])


def merged_blocks(before: DataFrame, now: DataFrame) -> DataFrame:
    """``before`` with the months of ``now`` in place of its own."""
    return before.join(now.select("ticker", "month"), ["ticker", "month"], "left_anti").unionByName(now)


def first_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(ticker, first_date): the earliest bar that is new, gone or different, among the months of ``now``."""
    old = before.select("ticker", "month", F.col("bars").alias("old"))
    both = now.select("ticker", "month", "bars").join(old, ["ticker", "month"], "left")
    none = F.array().cast("array<struct<date: date, hash: bigint>>")
    was = F.coalesce("old", none)
    odd = F.concat(F.array_except("bars", was), F.array_except(was, "bars"))
    dates = both.select("ticker", F.array_min(F.transform(odd, lambda d: d["date"])).alias("date"))
    return dates.groupBy("ticker").agg(F.min("date").alias("first_date")).where("first_date IS NOT NULL")


def seeds(blocks: DataFrame, changes: DataFrame, tail: int = TAIL) -> DataFrame:
    """(ticker, first_date, seed): for each changed ticker the state in front of the month from which to replay.

    Per ticker one short list: its months. They are read for the changed tickers only.
    """
    own = blocks.join(changes.select("ticker"), "ticker", "left_semi").drop("bars")
    listed = own.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("month", *[c for c in own.columns if c not in ("ticker", "month")]))).alias("blocks"))
    states = listed.select("ticker", F.expr(_MONTHS).alias("states")).join(changes, "ticker")
    there = F.coalesce(F.array_max(F.filter("states", lambda s: s["month"] <= F.date_format("first_date", "yyyy-MM")))["n"], F.lit(0))
    back = F.filter("states", lambda s: (s["n"] == 0) | (s["n"] <= there - tail))
    return states.select("ticker", "first_date", F.array_max(back).alias("seed"))


def _decayed(k: float) -> Column:
    return F.pow(F.lit(k), F.col("pos") + 1)


def replayed(bars: DataFrame, seeded: DataFrame) -> DataFrame:
    """The technical features of every bar from ``first_date`` on of the tickers in ``seeded`` (ticker, first_date, seed).

    Indicators are computed as if the series began with the replay; what the state before adds decays from there on in closed
    form, as the recurrences are linear.
    """
    own = bars.join(seeded, "ticker").where(F.date_format("date", "yyyy-MM") >= F.col("seed.month"))
    w = bars_window()
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    close, volume = F.col("close").cast("double"), F.coalesce(F.col("volume").cast("bigint"), F.lit(0))
    entry = F.coalesce(F.signum(F.first(close).over(whole) - F.col("seed.last")), F.lit(0.0)) * F.first(volume).over(whole)
    marks = {"pos": F.row_number().over(w) - 1, "x0": F.first(close).over(whole), "entry": entry.cast("bigint")}
    rows = technical_features(own.withColumns(marks), ("first_date", "seed", *marks))
    df, ds = F.col("seed.f") - F.col("x0"), F.col("seed.s") - F.col("x0")
    fast, slow = _decayed(KF) * df, _decayed(KS) * ds
    through = lambda k, d: AG * k * (_decayed(k) - _decayed(KG)) / (k - KG) * d
    signal = _decayed(KG) * F.col("seed.g") + through(KF, df) - through(KS, ds)
    added = {"ema_12": fast, "ema_26": slow, "macd_line": fast - slow, "macd_signal": signal, "macd_histogram": fast - slow - signal,
             "obv": F.col("seed.obv") + F.col("entry")}
    out = rows.where(F.col("date") >= F.col("first_date"))
    return out.select("ticker", "date", *[(F.col(c) + added[c]).alias(c) if c in added else F.col(c) for c in TECHNICAL_COLUMNS])
