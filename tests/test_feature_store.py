from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tickloom.operators import feature_store as fs
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def views(spark):
    rng = np.random.RandomState(3)
    rows = pd.DataFrame({
        "ticker": np.where(rng.rand(600) < 0.6, "HOT", rng.choice(["A", "B"], 600)),
        "computed_at": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.randint(0, 400 * 86400, 600), unit="s"), "x": np.round(rng.rand(600), 4)})
    rows = rows.drop_duplicates(["ticker", "computed_at"])
    other = rows.iloc[::5].rename(columns={"x": "y"})
    return rows, other, fs.FeatureView("one", spark.createDataFrame(rows), ["x"], 10), fs.FeatureView("two", spark.createDataFrame(other), ["y"], None)


@pytest.mark.parametrize("seconds", [3600, 86400, 30 * 86400])
def test_point_in_time(spark, views, seconds):
    rows, other, one, two = views
    rng = np.random.RandomState(4)
    spine = pd.DataFrame({"ticker": rng.choice(["HOT", "A", "B", "NONE"], 300),
                          "event_timestamp": pd.Timestamp("2023-12-20") + pd.to_timedelta(rng.randint(0, 450 * 86400, 300), unit="s"), "id": range(300)})
    spine.loc[0, ["ticker", "event_timestamp"]] = [rows["ticker"].iloc[0], rows["computed_at"].iloc[0]]  # equal times are visible
    got = fs.point_in_time(spark.createDataFrame(spine), [one, two], slice_seconds=seconds).toPandas().sort_values("id")
    want = spine.sort_values("event_timestamp")
    for name, src in (("x", rows), ("y", other)):
        want = pd.merge_asof(want, src.sort_values("computed_at").rename(columns={"computed_at": f"at_{name}"}), left_on="event_timestamp", right_on=f"at_{name}", by="ticker")
    want.loc[want["event_timestamp"] - want["at_x"] > timedelta(days=10), "x"] = np.nan
    want = want.sort_values("id")
    assert len(got) == 300 and want["x"].notna().sum() > 50 and want["x"].isna().sum() > 10
    for name in ("x", "y"):
        np.testing.assert_array_equal(got[name].astype(float), want[name].astype(float))


def test_spine(spark):
    t = spark.createDataFrame([("A",), ("B",), ("A",)], "ticker string")
    s = fs.date_spine(t, date(2024, 2, 27), date(2024, 3, 1))
    assert s.count() == 8


def test_services(spark, views):
    rows, _, one, two = views
    service = fs.FeatureService("inference", [one, two], [fs.OnDemandView("twice", lambda df: df.withColumn("twice", F.col("x") * 2))])
    got = {r["ticker"]: r for r in fs.online_features(spark.createDataFrame([("HOT",), ("NONE",)], "ticker string"), service).collect()}
    newest = rows[rows["ticker"] == "HOT"].sort_values("computed_at").iloc[-1]["x"]
    assert got["HOT"]["x"] == newest and got["HOT"]["twice"] == 2 * newest and got["NONE"]["x"] is None
    hist = fs.historical_features(spark.createDataFrame([("HOT", datetime(2024, 6, 1))], "ticker string, event_timestamp timestamp"), service)
    assert hist.columns == ["ticker", "event_timestamp", "x", "y", "twice"]
    assert fs.project_service(hist, fs.FeatureService("s", [one])).columns == ["ticker", "x"]


def test_momentum(spark):
    out = fs.price_momentum(spark.createDataFrame([(110.0, 90.0, 100.0), (1.0, 1.0, 0.0)], "sma_20 double, sma_50 double, current_price double")).collect()
    assert abs(out[0]["momentum_5d"] - 0.1) < 1e-12 and abs(out[0]["momentum_20d"] + 0.1) < 1e-12 and out[1]["momentum_5d"] is None


def test_catalogue(spark, views):
    rows = fs.feature_catalogue(spark, views[2:]).collect()
    assert [(r["feature_view"], r["feature"], r["type"]) for r in rows] == [("one", "x", "double"), ("two", "y", "double")]
