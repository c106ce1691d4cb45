"""Scaling, regression metrics and dataset snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """Per-column scaling. ``fit`` is one aggregate; its single row is read by the plan that applies it."""

    columns: Sequence[str]
    method: str = "standard"
    fitted: DataFrame | None = None

    def fit(self, df: DataFrame) -> Scaler:
        if self.method not in ("standard", "minmax"):
            raise ValueError(f"unknown scaling {self.method}")
        shift, spread = (F.avg, F.stddev_pop) if self.method == "standard" else (F.min, lambda c: F.max(c) - F.min(c))
        parts = []
        for c in self.columns:
            x = F.col(c).cast("double")
            wide = spread(x)
            parts.append(F.struct(shift(x).alias("shift"), F.when(wide == 0, 1.0).otherwise(wide).alias("scale")).alias(c))
        return Scaler(self.columns, self.method, df.agg(F.struct(*parts).alias("p")))

    def _apply(self, df: DataFrame, rule) -> DataFrame:
        if self.fitted is None:
            raise ValueError("fit the scaler first")
        p = self.fitted.scalar()
        return df.withColumns({c: rule(F.col(c).cast("double"), p[c]["shift"], p[c]["scale"]) for c in self.columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return self._apply(df, lambda x, a, b: (x - a) / b)

    def inverse_transform(self, df: DataFrame) -> DataFrame:
        return self._apply(df, lambda x, a, b: x * b + a)


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, r2, mape and share of equal signs over the rows where both sides are present."""
    a, b = F.col(y).cast("double"), F.col(yhat).cast("double")
    e = a - b
    same: Column = (F.signum(a) == F.signum(b)).cast("double")
    return df.where(a.isNotNull() & b.isNotNull()).groupBy(*keys).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(a) * F.count(a))).alias("r2"),
        F.avg(F.abs(F.try_divide(e, a))).alias("mape"), F.avg(same).alias("direction_accuracy"),
    )


def dataset_id(name: Column) -> Column:
    return F.substring(F.md5(name.cast("binary")), 1, 16)


def dataset_snapshot(split: DataFrame, features: Sequence[str], name: str, version: int = 1) -> DataFrame:
    """One row that describes a split dataset: range, tickers, real counts per part, features."""
    part = F.col("split")
    spec = F.concat_ws("_", F.lit(name), F.lit(version), F.min("date").cast("string"), F.max("date").cast("string"))
    return split.agg(
        dataset_id(spec).alias("dataset_id"), F.lit(name).alias("dataset_name"), F.lit(version).alias("version"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.array_sort(F.collect_set("ticker")).alias("tickers"), F.count("*").alias("total_records"),
        F.count_if(part == "train").alias("train_records"), F.count_if(part == "validation").alias("validation_records"),
        F.count_if(part == "test").alias("test_records"), F.lit(len(features)).alias("feature_count"),
        F.array(*[F.lit(f) for f in features]).alias("features_used"), F.lit("temporal").alias("data_split_method"),
    )
