"""Bars from single prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bars_from_ticks(ticks: DataFrame, ticker: str, ts: str, price: str, ties: str | None = None) -> DataFrame:
    """Daily open, high, low, close and tick count; every part combines on the map side."""
    order = F.struct(ts, ties) if ties else F.col(ts)
    return ticks.groupBy(F.col(ticker).alias("ticker"), F.col(ts).cast("date").alias("date")).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, order).alias("close"), F.count("*").alias("volume"),
    )
