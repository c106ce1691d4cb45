"""Checks of feature vectors and batch scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VECTOR_SIZE = 30


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def vector_mean(a: Column) -> Column:
    return F.try_divide(_sum(a), F.size(a).cast("double"))


def vector_std(a: Column) -> Column:
    """Population deviation in one pass over (count, sum, sum of squares) of the distances from the first value.

    Nothing but the element itself is used inside the lambda, except the first value: an aggregate there would be
    evaluated again for each element.
    """
    first = F.coalesce(F.get(a, F.lit(0)), F.lit(0.0))
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))

    def add(t: Column, x: Column) -> Column:
        d = x - first
        return F.struct((t["n"] + 1.0).alias("n"), (t["s"] + d).alias("s"), (t["q"] + d * d).alias("q"))

    def finish(t: Column) -> Column:
        mean = F.try_divide(t["s"], t["n"])
        return F.sqrt(F.greatest(F.lit(0.0), F.try_divide(t["q"], t["n"]) - mean * mean))

    return F.aggregate(a, zero, add, finish)


def _infinite(x: Column) -> Column:
    return F.abs(x) == F.lit(float("inf"))


def request_error(ticker: str = "ticker", features: str = "features", size: int = VECTOR_SIZE) -> Column:
    """What is wrong with a request, or null. ``size`` is the length that the model expects."""
    t, f = F.col(ticker), F.col(features)
    bad_range = F.exists(f, lambda x: x.isNull() | F.isnan(x) | ~((x > -1e6) & (x < 1e6)))
    return (
        F.when(t.isNull() | (F.length(t) == 0) | (F.length(t) > 10), F.lit("Invalid ticker format"))
        .when(f.isNull() | (F.size(f) != size), F.lit(f"Must provide exactly {size} features"))
        .when(bad_range, F.lit("Feature values out of acceptable range"))
    )


def check_requests(df: DataFrame, size: int = VECTOR_SIZE) -> DataFrame:
    return df.withColumns({"error": request_error(size=size), "ticker": F.upper("ticker")})


def vector_report(df: DataFrame, features: str = "features", size: int = VECTOR_SIZE) -> DataFrame:
    """Issues, warnings and statistics of each vector, as one struct column ``report``."""
    f = F.col(features)
    issues = F.array_compact(F.array(
        F.when(F.size(f) != size, F.format_string(f"Expected {size} features, got %d", F.size(f))),
        F.when(F.exists(f, lambda x: F.isnan(x)), F.lit("Features contain NaN values")),
        F.when(F.exists(f, _infinite), F.lit("Features contain Inf values")),
    ))
    warnings = F.array_compact(F.array(
        F.when(F.exists(f, lambda x: ~F.isnan(x) & (F.abs(x) > 1e5)), F.lit("Some features are very large (>1e5)")),
        F.when(vector_std(f) < 0.01, F.lit("Features have very low variance")),
    ))
    return df.withColumn("report", F.struct(
        (F.size(issues) == 0).alias("valid"), issues.alias("issues"), warnings.alias("warnings"),
        vector_mean(f).alias("mean"), vector_std(f).alias("std"), F.array_min(f).alias("min"), F.array_max(f).alias("max"),
    ))


def clip_vector(f: Column, bound: float = 1e5) -> Column:
    return F.transform(f, lambda x: F.greatest(F.lit(-bound), F.least(F.lit(bound), x)))


def model_input_error(f: Column, size: int = VECTOR_SIZE) -> Column:
    return (
        F.when(F.size(f) != size, F.format_string(f"Expected {size} features, got %d", F.size(f)))
        .when(F.exists(f, lambda x: x.isNull() | F.isnan(x) | _infinite(x)), F.lit("Features contain NaN or Inf values"))
    )


def confidence(f: Column, prediction: Column) -> Column:
    """0.85, less for a flat vector and for an extreme prediction, kept within 0.5 and 0.95."""
    c = F.lit(0.85) - F.when(vector_std(f) < 0.1, 0.10).otherwise(0.0) - F.when(F.abs(prediction) > 10000, 0.05).otherwise(0.0)
    return F.greatest(F.lit(0.5), F.least(F.lit(0.95), c))


def request_key(ticker: str = "ticker", features: str = "features") -> Column:
    """Ticker and a hash of the features rounded to four places, as whole ten-thousandths so that the text form is one."""
    rounded = F.transform(F.col(features), lambda x: F.round(x * 10000).cast("bigint").cast("string"))
    return F.concat_ws("_", F.upper(ticker), F.md5(F.array_join(rounded, ",").cast("binary")))


Layer = tuple[np.ndarray, np.ndarray]


def forward(x: np.ndarray, layers: Sequence[Layer]) -> np.ndarray:
    """Dense layers with ReLU between them; ``x`` is (rows, inputs)."""
    for at, (weight, bias) in enumerate(layers):
        x = x @ weight + bias
        if at < len(layers) - 1:
            x = np.maximum(x, 0.0)
    return x[:, 0]


def score_batch(df: DataFrame, layers: Sequence[Layer], features: str = "features") -> DataFrame:
    """Predicted price and confidence of each row; a row that cannot be scored carries its ``error`` instead.

    ``layers`` are the weights of a model the caller trained, read once per task from a Spark broadcast; the first one
    has as many rows as a vector must have entries.
    """
    size = len(layers[0][0])
    model = df.sparkSession.sparkContext.broadcast([(np.asarray(w, float), np.asarray(b, float)) for w, b in layers])

    @F.pandas_udf(T.DoubleType())
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            out = np.full(len(vectors), np.nan)
            ok = vectors.notna().to_numpy()
            if ok.any():
                out[ok] = forward(np.stack(vectors[ok].to_numpy()).astype(float), model.value)
            yield pd.Series(out)

    f = F.col(features)
    checked = df.withColumn("error", model_input_error(f, size))
    usable = F.when(F.col("error").isNull(), clip_vector(f))
    scored = checked.withColumn("predicted_price", predict(usable))
    scored = scored.withColumn("predicted_price", F.when(F.col("error").isNull(), F.col("predicted_price")))
    return scored.withColumn(
        "confidence", F.when(F.col("error").isNull(), confidence(clip_vector(f), F.col("predicted_price"))))


def within_batch_limit(df: DataFrame, batch: str = "batch_id", limit: int = 100) -> DataFrame:
    """``batch_error`` per row of a request table: batches above ``limit`` items are refused as a whole."""
    sizes = df.groupBy(batch).agg(F.count("*").alias("batch_size"))
    return df.join(sizes, batch).withColumn(
        "batch_error", F.when(F.col("batch_size") > limit, F.lit(f"Batch size exceeds {limit}")))


def newest_run(runs: DataFrame) -> DataFrame:
    """The model run that started last."""
    cols = [c for c in runs.columns if c != "start_time"]
    return runs.agg(F.max_by(F.struct("start_time", *cols), F.struct("start_time", "run_id")).alias("r")).select("r.*")
