"""Forward targets and model inputs derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rolling import bars_window, last_rows


def with_targets(bars: DataFrame, horizon: int = 1) -> DataFrame:
    close = F.col("close").cast("double")
    ahead = F.lead(close, horizon).over(bars_window())
    change = F.try_divide(ahead - close, close)
    return bars.withColumns({
        "target_close": ahead,
        "target_return": change,
        "target_direction": F.when(change > 0, 1).otherwise(0),
    })


def target_table(bars: DataFrame, horizon: int = 1) -> DataFrame:
    """Target rows: return, 1/0, and up/down/flat. Rows without a next close have no target."""
    change = F.col("target_return")
    return with_targets(bars, horizon).where(change.isNotNull()).select(
        "ticker", "date", change,
        F.when(change > 0, 1).otherwise(0).alias("target_binary"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("flat").alias("target_direction"),
        F.lit(None).cast("double").alias("confidence"),
    )


def sequences(df: DataFrame, columns: Sequence[str], length: int) -> DataFrame:
    """Model inputs: ``x`` holds ``length`` rows of ``columns``, ``y`` the last column of the row after them."""
    w = bars_window()
    row = F.array(*[F.col(c).cast("double") for c in columns])
    x = F.collect_list(row).over(last_rows(length))
    y = F.lead(F.col(columns[-1]).cast("double")).over(w)
    out = df.select("ticker", "date", x.alias("x"), y.alias("y"), F.lead(F.lit(True)).over(w).alias("__more"))
    return out.where((F.size("x") == length) & F.col("__more")).drop("__more")
