"""Series of unbounded length, on data where one key holds most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import slices


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.RandomState(1)
    n = 4000
    key = np.where(rng.rand(n) < 0.6, "hot", rng.choice(list("abcdef"), n))
    seconds = np.sort(rng.randint(0, 200_000, n))
    pdf = pd.DataFrame({"id": np.arange(n), "key": key, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(seconds, unit="s"), "v": np.round(rng.lognormal(0, 2, n), 3)})
    pdf.loc[::97, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf.astype({"v": object}).where(pdf.notna(), None), "id long, key string, ts timestamp, v double").cache()


def by_id(df, column):
    return df.select("id", column).toPandas().sort_values("id")[column].astype(float).to_numpy()


@pytest.mark.parametrize("seconds", [60, 600, 86400, 10**7])
def test_previous(skewed, seconds):
    pdf, df = skewed
    got = by_id(slices.with_previous(df, ["key"], "ts", "v", "p", ["id"], seconds), "p")
    np.testing.assert_array_equal(got, pdf.groupby("key")["v"].shift().to_numpy())


@pytest.mark.parametrize("seconds", [60, 3600])
def test_running_sum(skewed, seconds):
    pdf, df = skewed
    got = by_id(slices.with_running_sum(df, ["key"], "ts", "v", "s", ["id"], seconds), "s")
    np.testing.assert_allclose(got, pdf["v"].fillna(0).groupby(pdf["key"]).cumsum().to_numpy())


def test_newest(skewed):
    pdf, df = skewed
    got = slices.newest_rows(df, ["key"], ["ts", "id"], 100, 8).select("id").toPandas()["id"]
    assert set(got) == set(pdf.groupby("key").tail(100)["id"])


def test_order_statistics(skewed):
    pdf, df = skewed
    got = {r["key"]: r for r in slices.order_statistics(df, ["key"], "v", {"lo": 0.0, "mid": 0.5, "p99": 0.99}).collect()}
    for key, g in pdf.dropna().groupby("key"):
        x = np.sort(g["v"].to_numpy())
        assert [got[key][c] for c in ("lo", "mid", "p99")] == [x[0], x[len(x) // 2], x[int(len(x) * 0.99)]]


def test_order_statistics_with_signs(spark):
    x = [-5.0, -0.5, -0.5, 0.0, 0.2, 7.0, 7.0, 300.0]
    got = slices.order_statistics(spark.createDataFrame([("k", v) for v in x], "key string, v double"), ["key"], "v", {f"q{i}": i / 8 for i in range(8)}).first()
    assert [got[f"q{i}"] for i in range(8)] == x


@pytest.mark.parametrize("low, width", [(0.0, 1e-4), (1.0, 1e-5), (-2e-9, 4e-9), (5e6, 3.0), (0.0, 0.0)])
def test_order_statistics_of_values_close_together(spark, low, width):
    x = low + width * np.random.RandomState(2).rand(20_000)
    got = slices.order_statistics(spark.createDataFrame(pd.DataFrame({"key": "k", "v": x})), ["key"], "v", {"lo": 0.0, "mid": 0.5, "p99": 0.99, "end": 0.9999}).first()
    s = np.sort(x)
    assert [got[c] for c in ("lo", "mid", "p99", "end")] == [s[0], s[10_000], s[19_800], s[19_998]]


def test_slices_ascend_with_the_value(spark):
    rng = np.random.RandomState(3)
    x = np.concatenate([rng.randn(4000) * 10.0 ** rng.randint(-300, 300, 4000), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]])
    rows = spark.createDataFrame(pd.DataFrame({"v": np.sort(x)})).select("v", slices.value_slice(F.col("v")).alias("s")).orderBy("v").collect()
    numbers = [r["s"] for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) > 3000
    small = spark.range(1000).select(slices.value_slice((F.col("id") + 1) / 1e7).alias("s"))
    assert small.distinct().count() > 300


def test_suggested_width(skewed):
    _, df = skewed
    assert 500 < slices.suggest_slice_seconds(df, ["key"], "ts", 100) * 0.6 * 4000 / 200_000 * 10 < 2000
