"""Bar validation, quality flags, quality reports and referential checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.rolling import bars_window

EXACT = "decimal(28,10)"

# Fields every bar must carry, in the order they are checked.
CHECKED_FIELDS = ["ticker", "date", "open", "high", "low", "close", "volume"]


@dataclass(frozen=True)
class BarLimits:
    """Limits of a valid bar."""

    min_price: str = "0.01"
    max_price: str = "100000.00"
    min_volume: int = 100000
    max_range: str = "0.5"
    max_volume_spike: float = 10.0
    outlier_sigmas: float = 3.0


def bar_error(bars: DataFrame, limits: BarLimits = BarLimits()) -> Column:
    """Message of the first rule a bar breaks, or null. Rules in order: missing field, type, price range,
    high below low, close outside the bar, volume, width of the bar. Prices are compared as decimals."""
    columns = bars.columns

    def number(c: str) -> Column:
        return F.col(c).try_cast(EXACT)

    missing = F.lit(None).cast("string")
    for f in reversed(CHECKED_FIELDS):
        absent = F.col(f).isNull() if f in columns else F.lit(True)
        missing = F.when(absent, F.lit(f"Missing required field: {f}")).otherwise(missing)
    present = [f for f in CHECKED_FIELDS if f in columns]
    if len(present) < len(CHECKED_FIELDS):
        return missing

    close, high, low = number("close"), number("high"), number("low")
    text_volume = isinstance(bars.schema["volume"].dataType, T.StringType)
    volume = (F.col("volume").try_cast("double") if text_volume else F.col("volume")).try_cast("bigint")
    bad_type = F.lit(None).cast("string")
    for f, parsed in reversed([(c, number(c)) for c in ("close", "high", "low", "open")] + [("volume", volume)]):
        text = F.concat(F.lit("Type error: "), F.lit(f), F.lit("="), F.col(f).cast("string"))
        bad_type = F.when(parsed.isNull(), text).otherwise(bad_type)
    width = F.try_divide((high - low).cast("double"), low.cast("double"))
    too_wide = (low <= 0) | (high - low > F.lit(limits.max_range).cast("decimal(9,4)") * low)
    return (
        F.when(missing.isNotNull(), missing)
        .when(bad_type.isNotNull(), bad_type)
        .when(
            (close < F.lit(limits.min_price).cast(EXACT)) | (close > F.lit(limits.max_price).cast(EXACT)),
            F.concat(F.lit("Price "), F.col("close").cast("string"), F.lit(" outside valid range")),
        )
        .when(high < low, F.lit("High < Low"))
        .when((close > high) | (close < low), F.lit("Close outside OHLC range"))
        .when(volume < limits.min_volume, F.concat(F.lit("Volume "), volume.cast("string"), F.lit(" below minimum")))
        .when(too_wide, F.concat(
            F.lit("Unusual price range: "),
            F.coalesce(F.format_string("%.2f%%", F.round(width * 100, 2)), F.lit("not defined")),
        ))
    )


def validate_bars(bars: DataFrame, limits: BarLimits = BarLimits()) -> DataFrame:
    return bars.withColumn("validation_error", bar_error(bars, limits))


def split_valid(bars: DataFrame, limits: BarLimits = BarLimits()) -> tuple[DataFrame, DataFrame]:
    """(valid bars, invalid bars with their ``validation_error``)."""
    checked = validate_bars(bars, limits)
    bad = F.col("validation_error").isNotNull()
    return checked.where(~bad).drop("validation_error"), checked.where(bad)


def missing_ohlcv() -> Column:
    return F.col("open").isNull() | F.col("close").isNull() | F.col("volume").isNull()


def price_outside_bar() -> Column:
    return F.coalesce((F.col("close") > F.col("high")) | (F.col("close") < F.col("low")), F.lit(False))


def quality_metrics(bars: DataFrame, limits: BarLimits = BarLimits(), lookback: int = 20, max_gap_days: int = 4) -> DataFrame:
    """Quality row per bar, from the data itself.

    ``price_outlier``: close outside its bar, or a return more than ``outlier_sigmas`` trailing deviations from the
    trailing mean. ``volume_outlier``: volume above ``max_volume_spike`` times the trailing mean. ``data_gap``: more
    than ``max_gap_days`` since the previous bar. Trailing means leave out the current bar. Each raised flag takes
    a quarter off the score.
    """
    w = bars_window()
    past = w.rowsBetween(-lookback, -1)
    with_returns = bars.withColumn("__r", F.try_divide(F.col("close").cast("double"), F.lag("close").over(w).cast("double")) - 1)
    full = F.count("__r").over(past) >= lookback
    far = F.abs(F.col("__r") - F.avg("__r").over(past)) > limits.outlier_sigmas * F.stddev_samp("__r").over(past)
    spike = F.col("volume") > limits.max_volume_spike * F.avg("volume").over(past)
    gap = F.datediff(F.col("date"), F.lag("date").over(w)) > max_gap_days
    flags = with_returns.withColumns({
        "missing_ohlcv": missing_ohlcv(),
        "price_outlier": price_outside_bar() | F.coalesce(full & far, F.lit(False)),
        "volume_outlier": F.coalesce(spike, F.lit(False)),
        "data_gap": F.coalesce(gap, F.lit(False)),
    })
    names = ["missing_ohlcv", "price_outlier", "volume_outlier", "data_gap"]
    raised = sum((F.col(n).cast("int") for n in names[1:]), F.col(names[0]).cast("int"))
    return flags.select(
        "ticker", "date", *names, (1 - 0.25 * raised).alias("quality_score"),
        F.to_json(F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in names]))).alias("validation_errors"),
    )


def quality_flags(bars: DataFrame) -> DataFrame:
    """The two plain flags of a bar: a missing value, and a close outside low..high."""
    return bars.select("ticker", "date", missing_ohlcv().alias("missing_ohlcv"), price_outside_bar().alias("price_outlier"))


def quality_report(bars: DataFrame, quality: DataFrame, day: date | Column | None = None) -> DataFrame:
    """Bars of a day (all days if none is given) with their quality score, 0.5 where there is none."""
    picked = bars if day is None else bars.where(F.col("date") == (F.lit(day) if isinstance(day, date) else day))
    joined = picked.join(quality.select("ticker", "date", "quality_score"), ["ticker", "date"], "left")
    return joined.select(
        "ticker", F.col("date").alias("validation_date"), missing_ohlcv().alias("has_missing"),
        price_outside_bar().alias("has_outliers"), F.coalesce("quality_score", F.lit(0.5)).alias("quality_score"),
    ).orderBy("ticker", "validation_date")


def quality_summary(quality: DataFrame, high: float = 0.9) -> DataFrame:
    return quality.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("quality_score") >= high).alias("high_quality_records"),
        F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality_score"),
    )


def daily_quality(bars: DataFrame) -> DataFrame:
    """Count, close range and mean volume of each (ticker, date)."""
    return bars.groupBy("ticker", "date").agg(
        F.count("*").alias("record_count"), F.min("close").alias("min_price"), F.max("close").alias("max_price"),
        F.avg("volume").alias("avg_volume"),
    ).withColumn("has_data", F.col("record_count") > 0)


def ingestion_stats(checked: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """Totals of an ingestion run from validated bars (``validation_error``) and, if given, the rows written."""
    ok = F.col("validation_error").isNull()
    totals = checked.agg(
        F.count("*").alias("total_records"), F.count_if(ok).alias("inserted_records"),
        F.count_if(~ok).alias("validation_errors"), F.count_distinct("ticker").alias("tickers_processed"),
    )
    if inserted is None:
        return totals
    return totals.withColumn("inserted_records", inserted.agg(F.count("*").alias("n")).scalar())


class QualityGateError(ValueError):
    """A run must stop: too little quality, or nothing inserted."""


def quality_gate(summary: DataFrame, inserted: int | None = None, threshold: float = 0.85) -> float:
    """Raise unless the average score reaches ``threshold`` and rows were inserted; returns the score."""
    score = float(summary.first()["avg_quality_score"])
    if inserted is not None and inserted == 0:
        raise QualityGateError("No records inserted")
    if score < threshold:
        raise QualityGateError(f"Data quality below threshold: {score:.2%} < {threshold:.2%}")
    return score


def latest_per_ticker(bars: DataFrame, columns: list[str] | None = None, ties: list[str] | None = None) -> DataFrame:
    """Newest row of each ticker. Bars of several sources can share a date; ties then fall to the greatest of ``ties``
    (the source by default). With one row per date each column is an aggregate of its own, which Spark hashes."""
    cols = columns or [c for c in bars.columns if c != "ticker"]
    ties = ties if ties is not None else [c for c in ("source",) if c in bars.columns]
    if not ties:
        return bars.groupBy("ticker").agg(*[(F.max(c) if c == "date" else F.max_by(c, "date")).alias(c) for c in cols])
    newest = bars.groupBy("ticker").agg(F.max_by(F.struct(*cols), F.struct("date", *ties)).alias("__newest"))
    return newest.select("ticker", "__newest.*")


def orphans(child: DataFrame, parent: DataFrame, keys: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """Child rows whose key has no parent."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def cascade(child: DataFrame, parent: DataFrame, keys: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """Child rows that remain when rows without a parent are deleted with it."""
    return child.join(parent.select(*keys), list(keys), "left_semi")


def insert_candidates(new: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("ticker", "date", "source")) -> DataFrame:
    """Rows to append: one per key, and only keys not stored yet."""
    from tickloom.operators.clean import keep_first

    return keep_first(new, keys).join(existing.select(*keys), list(keys), "left_anti")


def newest_wins(existing: DataFrame, new: DataFrame, keys: tuple[str, ...], version: str) -> DataFrame:
    """Union of both sides with the row of greatest ``version`` kept per key (ties go to ``new``)."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys and c != "__new"]
    picked = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, "__new")).alias("__row"))
    return picked.select(*keys, "__row.*")


def rank_importance(scores: DataFrame) -> DataFrame:
    """Rank of each feature within (model, kind of importance).

    A model has one score per feature, so a group is as large as one feature list.
    """
    w = Window.partitionBy("model_version", "importance_type").orderBy(F.col("importance_score").desc_nulls_last())
    return scores.withColumn("rank", F.rank().over(w))
