"""Checks for information that leaks from the future or from the target into features.

Every correlation is one aggregate over the whole table, combined on the map side; nothing is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import gram
from tickloom.functions.rolling import bars_window
from tickloom.functions.stats import clean_number, pearson, pearson_p_value

# Names of the issue types and the order of severities.
LOOKAHEAD = "look-ahead bias"
TARGET_DEPENDENT = "target-dependent feature"
TEMPORAL = "temporal leakage"
MULTI_COLLINEARITY = "multi-collinearity"
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


Pair = tuple[str, str, str | None, str, str]


def _against(kind: str, features: Sequence[str], target: str) -> list[Pair]:
    return [(kind, f, None, f, target) for f in features]


def _among(features: Sequence[str]) -> list[Pair]:
    return [(MULTI_COLLINEARITY, a, b, a, b) for a, b in combinations(features, 2)]


def _measure(df: DataFrame, pairs: Sequence[Pair], blocked: bool | None = None) -> DataFrame:
    """(kind, feature1, feature2, value, pairs): the correlation of every listed pair of columns.

    By blocked matrix products where ``blocked``, by default for more than eight pairs a column; otherwise a row is unfolded
    into (pair number, x, y) and reduced at once by pair number on the map side, which needs no Python. Either way what is
    shuffled is one short row per pair and task. Rows in which either side is missing count for the other pairs only.
    """
    if not pairs:
        raise ValueError("nothing to measure")
    columns = list(dict.fromkeys(c for p in pairs for c in p[3:]))
    number = {c: k for k, c in enumerate(columns)}
    places = [(number[x], number[y]) for *_, x, y in pairs]
    if blocked is None:
        blocked = len(pairs) > 8 * len(columns)
    found = gram.correlations(df, columns, places) if blocked else _unfolded(df, columns, places)
    named = (_named_by_number if blocked else _named)(found, pairs)
    return named.withColumn("value", F.when(F.col("kind") == MULTI_COLLINEARITY, F.abs("value")).otherwise(F.col("value")))


PARTS = ("kind", "feature1", "feature2")


def _named(found: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    def name(part: int) -> Column:
        return F.get(F.array(*[F.lit(p[part]).cast("string") for p in pairs]), F.col("at")).alias(PARTS[part])

    return found.select(name(0), name(1), name(2), "value", "pairs")


def _named_by_number(found: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """The same for many pairs: names are looked up by number, so that the plan grows with the columns, not the pairs."""
    names = list(dict.fromkeys(p[k] for p in pairs for k in (0, 1, 2) if p[k] is not None))
    at = {n: k for k, n in enumerate(names)}
    index = np.array([[at.get(p[k], -1) for k in (0, 1, 2)] for p in pairs], dtype="int32")

    @F.pandas_udf("kind int, feature1 int, feature2 int")
    def numbers(pair: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(index[pair.to_numpy()], columns=["kind", "feature1", "feature2"])

    def name(part: str) -> Column:
        k = F.col(f"p.{part}")
        return F.when(k >= 0, F.get(F.array(*[F.lit(n) for n in names]), k)).alias(part)

    return found.withColumn("p", numbers("at")).select(*[name(p) for p in PARTS], "value", "pairs")


def _unfolded(df: DataFrame, columns: Sequence[str], places: Sequence[tuple[int, int]]) -> DataFrame:
    picks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in places])
    values = df.select(F.array(*[clean_number(F.col(c)) for c in columns]).alias("v"))
    rows = values.select(F.posexplode(picks).alias("at", "p"), "v")
    rows = rows.select("at", F.get("v", F.col("p.i")).alias("x"), F.get("v", F.col("p.j")).alias("y"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return rows.groupBy("at").agg(pearson(F.col("x"), F.col("y")).alias("value"), F.count("*").alias("pairs"))


def _led(df: DataFrame, target: str, days: int) -> DataFrame:
    return df.withColumn("__future", F.lead(target, days).over(bars_window()))


def _correlations(found: DataFrame) -> DataFrame:
    return found.select(F.col("feature1").alias("feature"), F.col("value").alias("correlation"), "pairs")


def lookahead_correlations(df: DataFrame, target: str, features: Sequence[str], days: int = 1) -> DataFrame:
    """(feature, correlation with the target ``days`` rows ahead, pairs)."""
    return _correlations(_measure(_led(df, target, days), _against(LOOKAHEAD, features, "__future")))


def target_correlations(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    return _correlations(_measure(df, _against(TARGET_DEPENDENT, features, target)))


def pair_correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature1, feature2, absolute correlation) of every pair, feature1 before feature2 in the given order."""
    return _measure(df, _among(features), True).select("feature1", "feature2", F.col("value").alias("correlation"))


@F.pandas_udf(T.DoubleType())
def _p_value(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for r, n in batches:
        yield pd.Series([None if pd.isna(b) else pearson_p_value(a, int(b)) for a, b in zip(r, n)], dtype="float64")


def _worded(found: DataFrame, column: str = "date", days: int = 1) -> DataFrame:
    """Findings as issues: severity, text, evidence, columns, advice."""
    kind, v, a, b = (F.col(c) for c in ("kind", "value", "feature1", "feature2"))
    found = found.withColumn("p", _p_value("value", "pairs"))

    def by_kind(ahead: Column, target: Column, time: Column, pair: Column) -> Column:
        return F.when(kind == LOOKAHEAD, ahead).when(kind == TARGET_DEPENDENT, target).when(kind == TEMPORAL, time).otherwise(pair)

    gap = F.lit("gap_days")
    overlap = F.col("severity") == "CRITICAL"
    return found.withColumn("severity", by_kind(
        F.lit("CRITICAL"), F.when(F.abs(v) > 0.9, "HIGH").otherwise("MEDIUM"), F.when(a == "overlap", "CRITICAL").otherwise("HIGH"),
        F.lit("MEDIUM"),
    )).select(
        kind.alias("issue_type"), "severity",
        by_kind(
            F.format_string(f"'%s' correlates %.3f with the target {days} day(s) ahead", a, v),
            F.format_string("'%s' correlates %.3f with the target", a, v),
            F.when(overlap, F.format_string("Validation starts %.0f days before training ends", -v))
            .otherwise(F.format_string("No gap between training and validation (%.0f days)", v)),
            F.format_string("'%s' and '%s' correlate %.3f", a, b, v),
        ).alias("description"),
        by_kind(
            F.create_map(F.lit("correlation"), v, F.lit("future_days"), F.lit(float(days))),
            F.create_map(F.lit("correlation"), v, F.lit("p_value"), F.col("p")),
            F.when(overlap, F.create_map(gap, v, F.lit("overlap_days"), -v)).otherwise(F.create_map(gap, v)),
            F.create_map(F.lit("correlation"), v),
        ).alias("evidence"),
        by_kind(F.array(a), F.array(a), F.array(F.lit(column)), F.array(a, b)).alias("affected_columns"),
        by_kind(
            F.format_string(f"Remove '%s' or lag it by {days} day(s)", a), F.format_string("Check how '%s' is derived from the target", a),
            F.lit("Start validation at least one day after training ends"), F.format_string("Keep one of '%s' and '%s'", a, b),
        ).alias("recommendation"),
    )


def _flagged(found: DataFrame, lookahead: float = 0.7, dependence: float = 0.8, collinear: float = 0.95) -> DataFrame:
    kind, v = F.col("kind"), F.col("value")
    return found.where(
        ((kind == LOOKAHEAD) & (F.abs(v) > lookahead)) | ((kind == TARGET_DEPENDENT) & (F.abs(v) > dependence))
        | ((kind == MULTI_COLLINEARITY) & (v > collinear)) | ((kind == TEMPORAL) & F.when(F.col("feature1") == "overlap", v <= 0).otherwise(v < 1))
    )


def detect_lookahead(df: DataFrame, target: str, features: Sequence[str], days: int = 1, threshold: float = 0.7) -> DataFrame:
    found = _measure(_led(df, target, days), _against(LOOKAHEAD, features, "__future"))
    return _worded(_flagged(found, lookahead=threshold), days=days)


def detect_target_dependence(df: DataFrame, target: str, features: Sequence[str], threshold: float = 0.8) -> DataFrame:
    return _worded(_flagged(_measure(df, _against(TARGET_DEPENDENT, features, target)), dependence=threshold))


def detect_collinearity(df: DataFrame, features: Sequence[str], threshold: float = 0.95) -> DataFrame:
    return _worded(_flagged(_measure(df, _among(features), True), collinear=threshold))


def _gap(train: DataFrame, validation: DataFrame, column: str) -> DataFrame:
    """The two conditions on the days between the last training date and the first validation date."""

    def dated(df: DataFrame, part: str) -> DataFrame:
        return df.select(F.lit(part).alias("part"), F.col(column).cast("date").alias("d"))

    both = dated(train, "train").unionByName(dated(validation, "val"))
    first, last = F.min(F.when(F.col("part") == "val", F.col("d"))), F.max(F.when(F.col("part") == "train", F.col("d")))
    days = both.agg(F.datediff(first, last).cast("double").alias("value"))
    return days.select(
        F.lit(TEMPORAL).alias("kind"), F.explode(F.array(F.lit("overlap"), F.lit("gap"))).alias("feature1"),
        F.lit(None).cast("string").alias("feature2"), "value", F.lit(None).cast("bigint").alias("pairs"),
    )


def detect_temporal(train: DataFrame, validation: DataFrame, column: str = "date") -> DataFrame:
    """CRITICAL when validation starts on or before the last training date, HIGH when the gap is under a day."""
    return _worded(_flagged(_gap(train, validation, column)), column)


def all_issues(train: DataFrame, validation: DataFrame, target: str, features: Sequence[str], column: str = "date") -> DataFrame:
    """Issues of every check; collinearity is checked in both periods.

    Training rows are read once for all of their correlations, validation rows once for theirs, and the two dates once more.
    """
    on_train = _against(LOOKAHEAD, features, "__future") + _against(TARGET_DEPENDENT, features, target) + _among(features)
    found = _measure(_led(train, target, 1), on_train)
    if len(features) > 1:
        found = found.unionByName(_measure(validation, _among(features)))
    return _worded(_flagged(found.unionByName(_gap(train, validation, column))), column)


def summarize_issues(issues: DataFrame) -> DataFrame:
    counts = {s.lower(): F.count_if(F.col("severity") == s) for s in SEVERITIES[:3]}
    return issues.agg(F.count("*").alias("total_issues"), *[c.alias(n) for n, c in counts.items()]).withColumns({
        "has_critical_leakage": F.col("critical") > 0,
        "is_safe": (F.col("critical") == 0) & (F.col("high") == 0),
    })


def report_lines(issues: DataFrame) -> DataFrame:
    """Issues as text lines in order of severity. One line per issue, so no long text is built in one row."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    line = F.format_string("[%s] %s: %s | affected: %s | action: %s", "severity", "issue_type", "description",
                           F.concat_ws(", ", "affected_columns"), "recommendation")
    return issues.select(rank.alias("rank"), line.alias("line")).orderBy("rank", "line")
