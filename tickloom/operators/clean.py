"""Coercion, de-duplication, null handling and gap filling of bars."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import bars_window, running
from tickloom.sources.schemas import OHLCV


def coerce_bars(df: DataFrame, numeric: Sequence[str] = OHLCV) -> DataFrame:
    """Parse the date and the numbers; a row with a value that does not parse is dropped."""
    parsed = df.withColumns({
        "date": F.try_to_timestamp(F.col("date").cast("string")).cast("date"),
        **{c: F.col(c).cast("string").try_cast("double") for c in numeric},
    })
    return parsed.na.drop(subset=["date", *numeric])


def keep_first(df: DataFrame, keys: Sequence[str] = ("ticker", "date"), order: Sequence[str] | None = None) -> DataFrame:
    """First row of each key along ``order`` (all other columns by default).

    Spark keeps one row per key on the map side already (a window group limit), so a key with many copies does not
    gather in one task.
    """
    rest = list(order or [c for c in df.columns if c not in keys])
    w = Window.partitionBy(*keys).orderBy(*rest)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def concat(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_incomplete(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop rows with a null or NaN anywhere outside ``ignore``."""
    return df.na.drop(subset=[c for c in df.columns if c not in ignore])


def fill_defaults(df: DataFrame) -> DataFrame:
    """Optional bar fields: adj_close may be absent, source falls back to 'unknown'."""
    adj = F.col("adj_close") if "adj_close" in df.columns else F.lit(None).cast("double")
    src = F.col("source") if "source" in df.columns else F.lit(None).cast("string")
    return df.withColumns({"adj_close": adj, "source": F.coalesce(src, F.lit("unknown"))})


def calendar(bars: DataFrame, step_days: int = 1) -> DataFrame:
    """Each ticker with every date between its first and last bar."""
    span = bars.groupBy("ticker").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    step = F.make_dt_interval(F.lit(step_days))
    return span.select("ticker", F.explode(F.sequence("lo", "hi", step)).alias("date"))


def fill_gaps(bars: DataFrame, method: str = "forward_fill", step_days: int = 1,
              columns: Sequence[str] = ("close",)) -> DataFrame:
    """Put bars on a full calendar. ``raw`` leaves gaps null, ``forward_fill`` repeats the last value,
    ``interpolation`` draws a line (by days) between the last and the next known value."""
    if method not in ("raw", "forward_fill", "interpolation"):
        raise ValueError(f"unknown cleaning method {method}")
    known = bars.select("ticker", "date", *columns)
    full = calendar(bars, step_days).join(known, ["ticker", "date"], "left")
    w = bars_window()
    back, ahead = running(w), w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = {}
    for c in columns:
        point = F.when(F.col(c).isNotNull(), F.struct(F.col("date").alias("d"), F.col(c).cast("double").alias("v")))
        last, nxt = F.last(point, ignorenulls=True).over(back), F.first(point, ignorenulls=True).over(ahead)
        if method == "forward_fill":
            out[c] = last["v"]
        elif method == "interpolation":
            share = F.datediff(F.col("date"), last["d"]) / F.nullif(F.datediff(nxt["d"], last["d"]), F.lit(0))
            out[c] = F.coalesce(F.col(c).cast("double"), last["v"] + (nxt["v"] - last["v"]) * share)
    filled = F.col(columns[0]).isNull()
    marked = full.withColumn("cleaning_method", F.when(filled, F.lit(method)).otherwise(F.lit("raw")))
    return marked.withColumns(out) if out else marked
