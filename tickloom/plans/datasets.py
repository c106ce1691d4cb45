"""Market tables derived by Spark from the test tables. All of them are plain aggregates and joins over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.backtest import crossover_signals
from tickloom.operators.indicators import technical_features
from tickloom.operators.targets import target_table
from tickloom.session import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly bars per nation from order prices: a nation is a ticker, its region the sector."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, folder, "region").select("r_regionkey", "r_name")
    week = F.date_trunc("week", "o_orderdate").cast("date")
    # Customers meet orders on their key alone; the week and the names are attached to the aggregate's few keys.
    weekly = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", week.alias("date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count("*").alias("volume"),
        )
    )
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return weekly.join(named, weekly.c_nationkey == named.n_nationkey).select(
        F.col("n_name").alias("ticker"), F.col("r_name").alias("sector"), "date", "open", "high", "low", "close", "volume"
    )


def bars_table(spark: SparkSession, folder: str) -> DataFrame:
    """Bars written once, for plans that read them in several branches; they are far fewer than the orders behind them."""
    return stored(bars(spark, folder), "bars")


def tick_bars(events: DataFrame) -> DataFrame:
    """Daily bars per event type from single values."""
    from tickloom.operators.ticks import bars_from_ticks

    return bars_from_ticks(events, "event_type", "ts", "value")


def metric_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Events as metric samples with their user as a label."""
    e = table(spark, folder, "events")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("metric"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"), "value",
    )


def signals(b: DataFrame) -> DataFrame:
    return crossover_signals(b)


def known_next_day(df: DataFrame) -> DataFrame:
    """Rows become known one day after their date."""
    return df.withColumn("computed_at", F.date_add("date", 1).cast("timestamp"))


def technical_rows(b: DataFrame) -> DataFrame:
    return known_next_day(technical_features(b))


def target_rows(b: DataFrame) -> DataFrame:
    return known_next_day(target_table(b))
