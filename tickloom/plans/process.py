"""From bar files to features, targets and time-ordered splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import clean
from tickloom.operators.feature_store import feature_columns
from tickloom.operators.indicators import engineer_features
from tickloom.operators.splits import positional_split
from tickloom.operators.targets import with_targets
from tickloom.sources import readers, sinks

# Target columns of the processed dataset.
TARGET_COLUMNS = ["target_close", "target_return", "target_direction"]


@dataclass(frozen=True)
class ProcessConfig:
    ticker: str | None = None
    horizon: int = 1
    train: float = 0.7
    validation: float = 0.15


def clean_bars(raw: DataFrame, ticker: str | None = None) -> tuple[DataFrame, bool]:
    """Bars ready for indicators, and whether the input held closes only (its volume is then meaningless)."""
    long = readers.wide_closes_to_long(raw)
    close_only = long is not raw
    named = readers.assign_ticker(readers.require_columns(long), ticker)
    keep = ["ticker", *readers.REQUIRED, *[c for c in ("sector", "source", "adj_close") if c in named.columns]]
    return clean.keep_first(clean.coerce_bars(named.select(*keep))), close_only


def process_bars(bars: DataFrame, config: ProcessConfig = ProcessConfig(), close_only: bool = False) -> DataFrame:
    """Features, targets, complete rows only, and the ``split`` of each row. All windows share one shuffle by ticker.

    Closes without volume have no volume change; that column then does not decide which rows are complete.
    """
    featured = with_targets(engineer_features(bars), config.horizon)
    complete = clean.drop_incomplete(featured, ("volume_change",) if close_only else ())
    return positional_split(complete, config.train, config.validation)


def process_file(spark: SparkSession, source: str, target: str, config: ProcessConfig = ProcessConfig(), fmt: str = "csv") -> dict:
    """Read ``source``, write the splits under ``target`` and a metadata file beside them; one pass over the data."""
    rows_in, rows_out = Observation("rows_in"), Observation("rows_out")
    bars, close_only = clean_bars(readers.read_bar_csv(spark, source), config.ticker)
    out = process_bars(bars.observe(rows_in, F.count(F.lit(1)).alias("n")), config, close_only)
    out = out.observe(rows_out, F.count(F.lit(1)).alias("n"))
    sinks.write_splits(out, target, fmt)
    metadata = {
        "input_path": source, "output_path": target, "ticker": config.ticker, "rows_in": sinks.observed(rows_in, "n"),
        "rows_out": sinks.observed(rows_out, "n"), "prediction_horizon": config.horizon,
        "feature_columns": [c for c in feature_columns(out) if c != "split"], "target_columns": TARGET_COLUMNS,
        "split_paths": {s: f"{target}/split={s}" for s in ("train", "validation", "test")},
    }
    sinks.write_metadata(spark, f"{target}.metadata.json", **metadata)
    return metadata
