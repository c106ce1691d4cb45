from datetime import date

import pytest

from tests.conftest import price_series
from tickloom.operators import splits


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(price_series(1461))


def test_positional(bars):
    got = {(r["ticker"], r["split"]): r["count"] for r in splits.positional_split(bars).groupBy("ticker", "split").count().collect()}
    assert got["AAPL", "train"] == 182 and got["AAPL", "validation"] == 39 and got["AAPL", "test"] == 39
    assert sum(got.values()) == bars.count()


@pytest.mark.parametrize("strategy", splits.STRATEGIES)
def test_folds_are_ordered(daily, strategy):
    plan = splits.FoldPlan(n_splits=5, train_days=252, val_days=63, gap_days=1, strategy=strategy)
    folds = splits.fold_table(daily, plan).orderBy("fold").collect()
    assert len(folds) == 4  # with a gap the last fold would pass the end of the data
    for f in folds:
        assert f["train_start"] < f["train_end"] < f["val_start"] < f["val_end"] <= date(2023, 12, 31)
    lengths = {(f["train_end"] - f["train_start"]).days for f in folds}
    assert len(lengths) == (4 if strategy == "anchored" else 1)


def test_roles_do_not_overlap(daily):
    plan = splits.FoldPlan(n_splits=4, train_days=252, val_days=63, test_days=30, gap_days=2)
    rows = splits.walk_forward(daily, plan)
    spans = {(r["fold"], r["role"]): (r["lo"], r["hi"]) for r in rows.groupBy("fold", "role").agg({"date": "min"}).withColumnRenamed("min(date)", "lo")
             .join(rows.groupBy("fold", "role").agg({"date": "max"}).withColumnRenamed("max(date)", "hi"), ["fold", "role"]).collect()}
    for fold in {k[0] for k in spans}:
        assert (spans[fold, "val"][0] - spans[fold, "train"][1]).days == 2 * plan.gap_days
        if (fold, "test") in spans:
            assert spans[fold, "test"][0] > spans[fold, "val"][1]


def test_small_folds_are_dropped(spark):
    df = spark.createDataFrame(price_series(100))
    assert splits.fold_statistics(df, splits.FoldPlan(n_splits=3, train_days=10, val_days=5, min_train_size=100)).count() == 0


def test_short_range_gives_one_fold(spark):
    df = spark.createDataFrame(price_series(200))
    plan = splits.FoldPlan(n_splits=5, train_days=252, val_days=63, gap_days=0)
    assert splits.fold_table(df, plan).count() == 1


def test_overlap_and_leakage(daily):
    plan = splits.FoldPlan(n_splits=3, train_days=252, val_days=63, gap_days=0)
    folds = splits.fold_table(daily, plan)
    assert splits.fold_overlaps(folds).count() == 3
    assert splits.fold_overlaps(folds, "train-val").count() == 0
    assert {r["severity"] for r in splits.fold_leakage(folds).collect()} == {"CRITICAL", "HIGH"}
    s = splits.fold_leakage_summary(splits.fold_table(daily, splits.FoldPlan(n_splits=3, gap_days=1))).first()
    assert not s["has_leakage"] and s["valid_folds"] == s["total_folds"]


def test_date_rules(spark, daily):
    with pytest.raises(ValueError):
        splits.date_split(daily, date(2020, 1, 1), date(2022, 12, 31), date(2022, 12, 31), date(2023, 6, 1))
    train, val = splits.date_split(daily, date(2020, 1, 1), date(2022, 12, 31), date(2023, 1, 1), date(2023, 12, 31))
    assert train.count() == 1096 and val.count() == 365
    df = spark.createDataFrame([(date(2020, 1, 1), date(2020, 1, 2)), (date(2020, 1, 3), date(2020, 1, 2))], "date date, target_date date")
    assert not splits.feature_dates_ok(df)
    assert splits.feature_dates_ok(df.limit(1))


def test_month_blocks(daily):
    blocks = splits.month_blocks(daily, 5)
    months = {r["val_fold"]: r["n"] for r in blocks.selectExpr("val_fold", "trunc(date, 'MM') m").distinct().groupBy("val_fold").count().withColumnRenamed("count", "n").collect()}
    assert months == {0: 9, 1: 9, 2: 9, 3: 9, 4: 12}
    few = splits.month_blocks(daily.where("date < '2020-03-01'"), 5)
    assert {r[0] for r in few.select("val_fold").collect()} == {4}
