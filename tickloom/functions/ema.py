"""Exponential moving average as window sums.

y0 = x0, y = (1 - a) * y + a * x with a = 2 / (span + 1). Unrolled, y is a sum of weighted inputs. The series is
cut into blocks of K rows where (1 - a)^K is about 1e-16; inside a block the weights are scaled by the row
number in the block, so one running sum gives every row, and the block before enters through its own last
value. Anything older weighs less than the rounding of a double.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import KEYS, ORDER, bars_window


def block_rows(span: int) -> int:
    return ceil(37 / -log(1 - 2 / (span + 1)))


def with_ema(df: DataFrame, column: str, spans: dict[str, int], keys: Sequence[str] = KEYS, order: str = ORDER) -> DataFrame:
    """Add one column per entry of ``spans`` (name -> span). Gaps must be filled first."""
    w = bars_window(keys, order)
    x = F.col(column).cast("double")
    out = df.withColumn("__pos", F.row_number().over(w) - 1)
    pos = F.col("__pos")
    parts = []
    for name, span in spans.items():
        a, k = 2 / (span + 1), block_rows(span)
        keep = 1 - a
        j = pos % k
        out = out.withColumn(f"__b_{name}", F.floor(pos / k))
        weight = F.when(pos == 0, F.lit(1.0)).otherwise(F.lit(a))
        block = Window.partitionBy(*keys, f"__b_{name}").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        scaled = F.sum(x * weight * F.pow(F.lit(keep), -j)).over(block)
        out = out.withColumn(f"__s_{name}", scaled * F.pow(F.lit(keep), j))
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        closed = F.last(F.when(j == k - 1, F.col(f"__s_{name}")), ignorenulls=True).over(before)
        parts.append((F.col(f"__s_{name}") + F.pow(F.lit(keep), j + 1) * F.coalesce(closed, F.lit(0.0))).alias(name))
    return out.select(*df.columns, *parts)
