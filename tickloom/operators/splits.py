"""Time-ordered splits, walk-forward folds and checks on them.

Fold bounds are computed in the plan from the first and last date (a scalar subquery) and travel as one short
array literal, so assigning rows to folds needs neither a join nor a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import bars_window

STRATEGIES = ("temporal", "anchored", "sliding")


def positional_split(df: DataFrame, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """``split`` by row position in each ticker's time order: first 70 %, next 15 %, rest."""
    w = bars_window()
    n = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    out = df.withColumns({"__row": F.row_number().over(w) - 1, "__n": n})
    train_end = F.floor(F.col("__n") * F.lit(train))
    val_end = F.floor(F.col("__n") * F.lit(train + validation))
    part = F.when(F.col("__row") < train_end, "train").when(F.col("__row") < val_end, "validation").otherwise("test")
    return out.withColumn("split", part).drop("__row", "__n")


def date_split(df: DataFrame, train_start: date, train_end: date, val_start: date, val_end: date,
               column: str = "date") -> tuple[DataFrame, DataFrame]:
    """Two date ranges, both ends inclusive; validation must start after training ends."""
    if val_start <= train_end:
        raise ValueError("Validation must start after training ends")
    return df.where(F.col(column).between(train_start, train_end)), df.where(F.col(column).between(val_start, val_end))


def date_violations(df: DataFrame, feature_date: str = "date", target_date: str = "target_date") -> DataFrame:
    return df.where(F.col(feature_date) > F.col(target_date))


def feature_dates_ok(df: DataFrame, feature_date: str = "date", target_date: str = "target_date") -> bool:
    return date_violations(df, feature_date, target_date).isEmpty()


@dataclass(frozen=True)
class FoldPlan:
    """Walk-forward settings, in days."""

    n_splits: int = 5
    train_days: int = 252
    val_days: int = 63
    test_days: int = 0
    gap_days: int = 1
    min_train_size: int = 100
    strategy: str = "temporal"

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {self.strategy}")


def fold_array(start: Column, end: Column, plan: FoldPlan) -> Column:
    """Array of fold structs between two dates; folds whose validation passes ``end`` are left out.

    ``anchored`` grows from ``start``; the others keep the training length. The number of folds falls to one when the
    range is shorter than one whole window.
    """
    p = plan
    short = F.datediff(end, start) < p.train_days + p.val_days + p.test_days
    count = F.when(short, 1).otherwise(p.n_splits)
    step = max(1, p.val_days) if p.strategy == "temporal" else p.val_days

    def bounds(i: Column) -> Column:
        walk_end = F.date_sub(end, (count - i) * step)
        train_start = start if p.strategy == "anchored" else F.date_sub(walk_end, F.lit(p.train_days))
        val_start = F.date_add(walk_end, p.gap_days)
        val_end = F.date_add(val_start, p.val_days)
        test_start = F.date_add(val_end, p.gap_days)
        test_end = F.date_add(test_start, p.test_days)
        has_test = F.lit(p.test_days > 0) & (test_end <= end)
        return F.struct(
            i.alias("fold"), train_start.alias("train_start"), walk_end.alias("train_end"), val_start.alias("val_start"),
            val_end.alias("val_end"), F.when(has_test, test_start).alias("test_start"), F.when(has_test, test_end).alias("test_end"),
        )

    every = F.transform(F.sequence(F.lit(0), count - 1), bounds)
    return F.filter(every, lambda f: f["val_end"] <= end)


def data_folds(df: DataFrame, plan: FoldPlan, column: str = "date") -> Column:
    """``fold_array`` of a table, its date range read by a scalar subquery."""
    span = df.agg(fold_array(F.min(column), F.max(column), plan).alias("folds"))
    return span.scalar()


def fold_table(df: DataFrame, plan: FoldPlan, column: str = "date") -> DataFrame:
    """One row per fold."""
    return df.agg(fold_array(F.min(column), F.max(column), plan).alias("folds")).select(F.inline("folds"))


def assign_folds(df: DataFrame, folds: Column, plan: FoldPlan, column: str = "date") -> DataFrame:
    """Each row once for every (fold, role) it belongs to. The gap is kept again before the validation rows."""
    d = F.col(column)

    def roles(f: Column) -> Column:
        tests = [
            ("train", d.between(f["train_start"], f["train_end"])),
            ("val", d.between(F.date_add(f["val_start"], plan.gap_days), f["val_end"])),
            ("test", d.between(f["test_start"], f["test_end"])),
        ]
        hit = F.array(*[F.when(c, F.struct(f["fold"].alias("fold"), F.lit(r).alias("role"))) for r, c in tests])
        return F.array_compact(hit)

    out = df.withColumn("__folds", folds)
    out = out.withColumn("__hit", F.explode(F.flatten(F.transform("__folds", roles)))).drop("__folds")
    return out.withColumns({"fold": F.col("__hit.fold"), "role": F.col("__hit.role")}).drop("__hit")


def walk_forward(df: DataFrame, plan: FoldPlan, column: str = "date") -> DataFrame:
    return assign_folds(df, data_folds(df, plan, column), plan, column)


def fold_statistics(df: DataFrame, plan: FoldPlan, column: str = "date") -> DataFrame:
    """Bounds and row counts of each fold; folds with too few training rows are dropped."""
    sizes = walk_forward(df.select(column), plan, column).groupBy("fold").agg(
        *[F.count_if(F.col("role") == r).alias(f"{r}_size") for r in ("train", "val", "test")]
    )
    bounds = fold_table(df, plan, column).select("fold", "train_start", "train_end", "val_start", "val_end")
    return bounds.join(sizes, "fold").where(F.col("train_size") >= plan.min_train_size)


def fold_overlaps(folds: DataFrame, pair_type: str = "train-train") -> DataFrame:
    """Pairs of folds where the earlier one's training reaches into the later one's training window.

    With ``pair_type='train-val'`` the later fold's validation window is compared instead. ``folds`` has one row per
    fold; the later folds of each row come from one array of all folds.
    """
    other = "train_start" if pair_type == "train-train" else "val_start"
    late = F.struct(F.col("fold").alias("fold2"), F.col(other).alias("start2"))
    every = folds.agg(F.collect_list(late).alias("a")).scalar()
    pairs = folds.select(F.col("fold").alias("fold1"), "train_end", F.inline(every))
    return pairs.where((F.col("fold1") < F.col("fold2")) & (F.col("train_end") >= F.col("start2"))).select(
        "fold1", "fold2", F.lit(pair_type).alias("type"), F.datediff("train_end", "start2").alias("overlap_days")
    )


def fold_leakage(folds: DataFrame) -> DataFrame:
    """One row per problem of a fold: validation starting inside training, or no gap between them."""
    gap = F.datediff("val_start", "train_end")
    late = F.when(F.col("val_start") <= F.col("train_end"), F.struct(
        F.lit("Validation starts before training ends").alias("issue"), F.lit("CRITICAL").alias("severity")))
    near = F.when(gap < 1, F.struct(
        F.format_string("No gap between train/val (gap=%d)", gap).alias("issue"), F.lit("HIGH").alias("severity")))
    return folds.select("fold", F.inline(F.array_compact(F.array(late, near))))


def fold_leakage_summary(folds: DataFrame) -> DataFrame:
    """Totals over all folds; a valid fold has no CRITICAL problem."""
    gap = F.datediff("val_start", "train_end")
    late = F.col("val_start") <= F.col("train_end")
    return folds.agg(
        F.count("*").alias("total_folds"), (F.count_if(late) + F.count_if(gap < 1)).alias("issues"),
        F.count_if(~late).alias("valid_folds"),
    ).withColumn("has_leakage", F.col("issues") > 0)


def sample_distribution(stats: DataFrame) -> DataFrame:
    """Totals and means of fold sizes, from ``fold_statistics``."""
    return stats.agg(
        F.count("*").alias("total_folds"),
        F.coalesce(F.sum("train_size"), F.lit(0)).alias("total_train_samples"),
        F.coalesce(F.sum("val_size"), F.lit(0)).alias("total_val_samples"),
        F.coalesce(F.avg("train_size"), F.lit(0.0)).alias("avg_train_per_fold"),
        F.coalesce(F.avg("val_size"), F.lit(0.0)).alias("avg_val_per_fold"),
    ).withColumn("train_val_ratio", F.coalesce(
        F.try_divide(F.col("total_train_samples").cast("double"), F.col("total_val_samples").cast("double")), F.lit(0.0)))


def fold_ratios(stats: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.col("train_size").cast("double"), F.col("val_size").cast("double"))
    return stats.select("fold", F.col("train_size").alias("train"), F.col("val_size").alias("val"),
                        F.coalesce(ratio, F.lit(0.0)).alias("ratio"))


def month_blocks(df: DataFrame, n_splits: int = 5, column: str = "date") -> DataFrame:
    """``val_fold`` of each row: blocks of ``n // k`` months in order, the last block taking the remainder.

    A row is validation in its own fold and training in all others. The distinct months are reduced on the map side
    and are as many as the calendar holds.
    """
    month = F.trunc(column, "MM")
    months = df.agg(F.array_sort(F.collect_set(month)).alias("months")).scalar()
    size = F.floor(F.size(months) / n_splits)
    block = F.floor(F.try_divide((F.array_position(months, month) - 1).cast("double"), size.cast("double")))
    return df.withColumn("val_fold", F.coalesce(F.least(block, F.lit(n_splits - 1)), F.lit(n_splits - 1)).cast("int"))


def month_fold_role(df: DataFrame, fold: int) -> DataFrame:
    """``role`` of each row of ``month_blocks`` in one fold; training is the complement of validation."""
    return df.withColumn("role", F.when(F.col("val_fold") == fold, "val").otherwise("train"))
