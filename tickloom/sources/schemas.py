"""Fixed table schemas. Every reader states its schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, DAY, LONG, INT, FLAG, TIME = (
    T.StringType(), T.DateType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType())
TEXTS = T.ArrayType(T.StringType())


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


PRICE, RETURN, PERCENT, RATIO = _dec(10, 4), _dec(8, 6), _dec(5, 2), _dec(4, 3)

RAW_BARS = _struct(
    ticker=TEXT, date=DAY, open=PRICE, high=PRICE, low=PRICE, close=PRICE, volume=LONG, adj_close=PRICE, source=TEXT,
    ingested_at=TIME, updated_at=TIME,
)

QUALITY = _struct(
    ticker=TEXT, date=DAY, missing_ohlcv=FLAG, price_outlier=FLAG, volume_outlier=FLAG, data_gap=FLAG,
    quality_score=_dec(3, 2), validation_errors=TEXT, validated_at=TIME,
)

RUN_LOG = _struct(
    pipeline_name=TEXT, execution_start=TIME, execution_end=TIME, status=TEXT, records_processed=INT, records_failed=INT,
    error_message=TEXT, dag_run_id=TEXT,
)

PROCESSED_BARS = _struct(
    ticker=TEXT, date=DAY, open=PRICE, high=PRICE, low=PRICE, close=PRICE, volume=LONG, adj_close=PRICE, returns=RETURN,
    log_returns=RETURN, cleaning_method=TEXT, processed_at=TIME, processed_version=INT,
)

TECHNICAL = _struct(
    ticker=TEXT, date=DAY, rsi_14=PERCENT, macd_line=RETURN, macd_signal=RETURN, macd_histogram=RETURN, sma_20=PRICE,
    sma_50=PRICE, sma_200=PRICE, ema_12=PRICE, ema_26=PRICE, atr_14=_dec(8, 4), bollinger_upper=PRICE,
    bollinger_middle=PRICE, bollinger_lower=PRICE, obv=LONG, volume_sma=LONG, price_range=_dec(8, 4),
    price_range_pct=PERCENT, upper_shadow=PERCENT, lower_shadow=PERCENT, computed_at=TIME, feature_version=INT,
)

MARKET_CONTEXT = _struct(
    ticker=TEXT, date=DAY, market_sentiment=TEXT, sector_momentum=RETURN, sector_volatility=PERCENT, correlation_sp500=RATIO,
    correlation_sector=RATIO, correlation_tech=RATIO, market_volatility=PERCENT, market_trend=TEXT,
    market_trend_strength=RATIO, computed_at=TIME, feature_version=INT,
)

TARGETS = _struct(
    ticker=TEXT, date=DAY, target_return=RETURN, target_binary=INT, target_direction=TEXT, confidence=_dec(3, 2), computed_at=TIME,
)

DATASET_SNAPSHOT = _struct(
    dataset_id=TEXT, dataset_name=TEXT, version=INT, start_date=DAY, end_date=DAY, tickers=TEXTS, total_records=LONG,
    train_records=LONG, validation_records=LONG, test_records=LONG, feature_count=INT, features_used=TEXTS,
    preprocessing_steps=TEXT, data_split_method=TEXT,
)

FEATURE_IMPORTANCE = _struct(model_version=TEXT, feature_name=TEXT, importance_score=RETURN, importance_type=TEXT)

LINEAGE = _struct(
    source_table=TEXT, target_table=TEXT, transformation_name=TEXT, successful=FLAG, records_input=LONG, records_output=LONG,
    execution_time_ms=LONG, executed_by=TEXT, executed_at=TIME, lineage_details=TEXT,
)

OHLCV = ["open", "high", "low", "close", "volume"]
REQUIRED = ["date", *OHLCV]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a table schema at its edge; columns the frame lacks become null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema
    ])


def lost(df: DataFrame, schema: T.StructType) -> Column:
    """Names of the columns whose value ``conform`` would turn into null; NaN counts as missing already."""

    def name(f: T.StructField) -> Column:
        given = F.col(f.name).isNotNull()
        if isinstance(df.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
            given &= ~F.isnan(f.name)
        return F.when(given & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))

    names = [name(f) for f in schema if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
