"""The daily run: ingest, judge quality, compute indicators, describe the dataset, log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import modeling, recurrence, splits, validate
from tickloom.operators.clean import fill_defaults
from tickloom.session import stored
from tickloom.sources import readers, schemas, sinks
from tickloom.sources.key_filter import KeyFilter


@dataclass(frozen=True)
class DailyConfig:
    """Where the tables live and what a good run is."""

    root: str
    pipeline: str = "daily_bars"
    quality_threshold: float = 0.85
    lookback_days: int = 200
    limits: validate.BarLimits = validate.BarLimits()

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def ingest(spark: SparkSession, config: DailyConfig, landed: DataFrame, tickers: Sequence[str] | None = None) -> dict:
    """Validated bars into the raw table; rows that fail go to the quarantine table. Returns the run's counts."""
    picked = landed if tickers is None else landed.where(F.col("ticker").isin(list(tickers)))
    checked = stored(validate.validate_bars(fill_defaults(picked), config.limits), "checked")
    bad = F.col("validation_error").isNotNull()
    table = config.table("raw_market_data")
    good, rejected = sinks.storable(spark, checked.where(~bad).drop("validation_error"), table, schemas.RAW_BARS, ("ingested_at", "updated_at"))
    inserted = sinks.append_if_absent(spark, good, table, known=KeyFilter(f"{table}_keys", sinks.BAR_KEY))
    sinks.append_new_rows(spark, checked.where(bad), config.table("quarantine"))
    stats = validate.ingestion_stats(checked).first().asDict()
    return {**stats, "inserted_records": inserted, "rejected_bars": rejected}


def judge(spark: SparkSession, config: DailyConfig, day: date, inserted: int | None = None) -> float:
    """Quality rows of a day into the quality table, then the gate on their mean score."""
    raw = sinks.read_table(spark, config.table("raw_market_data"), schemas.RAW_BARS)
    recent = readers.recent(raw, day, config.lookback_days, until=day)
    quality = stored(validate.quality_metrics(recent, config.limits).where(F.col("date") == F.lit(day)), "quality")
    sinks.upsert(spark, quality.withColumn("validated_at", F.current_timestamp().cast("timestamp_ntz")), config.table("data_quality_metrics"),
                 schemas.QUALITY, version="validated_at")
    return validate.quality_gate(validate.quality_summary(quality), inserted, config.quality_threshold)


def indicators(spark: SparkSession, config: DailyConfig, day: date, stats: dict | None = None, months: Sequence[str] | None = None) -> DataFrame:
    """Indicators up to ``day`` in the feature table, brought up to date from the first changed bar of each ticker on.

    Bars are compared with the stored memory of their months (all of them, or ``months`` and those after the last stored
    one), so late, corrected and re-sourced bars reach every later row; earlier rows and other tickers stay as they are. The memory
    is written last: a run that fails finds the same changes again. ``stats`` gets ``changed_tickers``, ``replayed_rows`` and
    ``rejected_features``, the count of rows with a value that the table cannot hold.
    """
    path, features = config.table("feature_memory"), config.table("feature_technical_indicators")
    raw = sinks.read_table(spark, config.table("raw_market_data"), schemas.RAW_BARS).where(F.col("date") <= F.lit(day))
    one_source = lambda rows: validate.newest_wins(raw.limit(0).drop(sinks.MONTH), rows.drop(sinks.MONTH), ("ticker", "date"), "source")
    memory = sinks.read_table(spark, path, T.StructType([f for f in recurrence.BLOCK_SCHEMA if f.name != sinks.MONTH]))
    wanted = None
    if months is not None:
        last = memory.agg(F.max(sinks.MONTH)).first()[0]
        wanted = F.col(sinks.MONTH).isin(list(months)) | F.lit(last is None) | (F.col(sinks.MONTH) >= F.lit(last))
    now = stored(recurrence.month_blocks(one_source(raw if wanted is None else raw.where(wanted))), "months")
    changes = stored(recurrence.first_changes(memory if wanted is None else memory.where(wanted), now), "changes")
    seeded = stored(recurrence.seeds(recurrence.merged_blocks(memory, now), changes), "seeds")
    first = seeded.agg(F.min("seed.month")).first()[0]
    counts = {"changed_tickers": seeded.count(), "replayed_rows": 0, "rejected_features": 0}
    if first is not None:
        bars = one_source(raw.where(F.col(sinks.MONTH) >= first).join(seeded.select("ticker"), "ticker", "left_semi"))
        rows = stored(recurrence.replayed(bars, seeded), "replayed")
        stamped = rows.withColumns({"computed_at": F.current_timestamp().cast("timestamp_ntz"), "feature_version": F.lit(1)})
        counts |= {"replayed_rows": rows.count(), "rejected_features": sinks.upsert(spark, stamped, features, schemas.TECHNICAL)}
        changed = now.join(seeded.select("ticker"), "ticker", "left_semi")
        sinks.replace_months(spark, recurrence.merged_blocks(memory.where(F.col(sinks.MONTH).isin(sinks.months_of(changed))), changed), path)
    if stats is not None:
        stats |= counts
    return sinks.read_table(spark, features, schemas.TECHNICAL)


def describe(spark: SparkSession, config: DailyConfig, features: Sequence[str], name: str = "daily_training_dataset") -> DataFrame:
    """Snapshot of the stored features with real counts per split."""
    table = sinks.read_table(spark, config.table("feature_technical_indicators"), schemas.TECHNICAL)
    snapshot = modeling.dataset_snapshot(splits.positional_split(table), features, name)
    sinks.append_snapshot(snapshot, config.table("training_dataset_metadata"))
    return snapshot


def run_daily(spark: SparkSession, config: DailyConfig, landed: DataFrame, day: date, tickers: Sequence[str] | None = None,
              features: Sequence[str] = ("sma_20", "sma_50", "rsi_14", "atr_14")) -> dict:
    """All stages in order; the outcome is logged whether or not it succeeds."""
    start, stats, error = datetime.now(), {}, None
    try:
        stats = ingest(spark, config, landed, tickers)
        stats["avg_quality_score"] = judge(spark, config, day, stats["inserted_records"])
        indicators(spark, config, day, stats, sinks.months_of(sinks.with_month(landed)))
        describe(spark, config, features)
        return stats
    except Exception as e:
        error = str(e)
        raise
    finally:
        end = datetime.now()
        sinks.append_run(spark, config.table("pipeline_execution_log"), config.pipeline, start, end, "failed" if error else "success",
                         stats.get("inserted_records"), stats.get("validation_errors"), error)
        sinks.append_lineage(spark, config.table("data_lineage"), "landing", "feature_technical_indicators", config.pipeline, error is None,
                             stats.get("total_records"), stats.get("inserted_records"), int((end - start).total_seconds() * 1000), config.pipeline, end)
