import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import modeling, scoring
from tickloom.plans.model_queries import rule_layers

SCHEMA = "ticker string, features array<double>"


@pytest.mark.parametrize("ticker, features, expected", [
    ("aapl", [1.0] * 30, None), ("", [1.0] * 30, "ticker"), ("ABCDEFGHIJK", [1.0] * 30, "ticker"), ("A", [1.0] * 3, "exactly 30"),
    ("A", [1e6] + [1.0] * 29, "range"), ("A", [float("nan")] + [1.0] * 29, "range"), ("A", None, "exactly 30"),
])
def test_requests(spark, ticker, features, expected):
    r = scoring.check_requests(spark.createDataFrame([(ticker, features)], SCHEMA)).first()
    assert r["error"] is None if expected is None else expected in r["error"]
    assert r["ticker"] == ticker.upper()


def test_report(spark):
    rng = np.random.RandomState(0)
    rows = [("ok", rng.randn(30).tolist()), ("short", [1.0, 2.0]), ("nan", [float("nan")] + [1.0] * 29), ("inf", [float("inf")] + [1.0] * 29), ("big", [2e5] + [0.0] * 29)]
    got = {r["ticker"]: r["report"] for r in scoring.vector_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["ok"]["valid"] and abs(got["ok"]["std"] - np.std(rows[0][1])) < 1e-12 and got["ok"]["max"] == max(rows[0][1])
    assert got["short"]["issues"] == ["Expected 30 features, got 2"]
    assert got["nan"]["issues"] == ["Features contain NaN values"] and got["inf"]["issues"] == ["Features contain Inf values"]
    assert got["big"]["warnings"] == ["Some features are very large (>1e5)"]


def test_batch(spark):
    rng = np.random.RandomState(1)
    good = rng.randn(20, 30) * 3
    rows = [(f"T{i}", v.tolist()) for i, v in enumerate(good)] + [("bad", [1.0]), ("nan", [float("nan")] * 30), ("huge", [1e9] + [0.0] * 29), ("flat", [0.001] * 30)]
    layers = rule_layers((30, 64, 32, 1))
    got = {r["ticker"]: r for r in scoring.score_batch(spark.createDataFrame(rows, SCHEMA).repartition(3), layers).collect()}
    for i, p in enumerate(scoring.forward(good, layers)):
        assert abs(got[f"T{i}"]["predicted_price"] - p) < 1e-9 and got[f"T{i}"]["confidence"] == 0.85
    assert got["bad"]["error"] and got["bad"]["predicted_price"] is None and got["bad"]["confidence"] is None
    assert "NaN or Inf" in got["nan"]["error"]
    clipped = np.array([[1e5] + [0.0] * 29])
    assert abs(got["huge"]["predicted_price"] - scoring.forward(clipped, layers)[0]) < 1e-6 and abs(got["huge"]["confidence"] - 0.8) < 1e-12
    assert abs(got["flat"]["confidence"] - 0.75) < 1e-12


def test_keys_and_limits(spark):
    df = spark.createDataFrame([("a", [1.00001] * 30), ("A", [1.00002] * 30), ("A", [1.1] * 30)], SCHEMA)
    assert df.select(scoring.request_key()).distinct().count() == 2
    batches = spark.range(150).select(F.when(F.col("id") < 148, "x").otherwise("y").alias("batch_id"))
    got = {r[0]: r[1] for r in scoring.within_batch_limit(batches).select("batch_id", "batch_error").distinct().collect()}
    assert got == {"x": "Batch size exceeds 100", "y": None}


def test_newest_run(spark):
    runs = spark.createDataFrame([("r1", "2024-01-01"), ("r2", "2024-03-01"), ("r3", "2024-02-01")], "run_id string, start_time string")
    assert scoring.newest_run(runs).first()["run_id"] == "r2"


@pytest.mark.parametrize("method", ["standard", "minmax"])
def test_scaler(spark, method):
    x = np.random.RandomState(2).rand(1000, 3) * [1, 50, 0] + [0, 5, 7]
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    s = modeling.Scaler(["a", "b", "c"], method).fit(df)
    scaled = s.transform(df)
    y = np.array(scaled.collect())
    low, width = (x.mean(0), x.std(0)) if method == "standard" else (x.min(0), np.ptp(x, 0))
    np.testing.assert_allclose(y, (x - low) / np.where(width < 1e-9, 1, width), atol=1e-9)
    np.testing.assert_allclose(np.array(s.inverse_transform(scaled).collect()), x, rtol=1e-9)


def test_regression(spark):
    def m(y, h):
        return modeling.regression_metrics(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, h)], "y double, yhat double")).first()

    perfect = m([1, 2, 3, 4, 5], [1, 2, 3, 4, 5])
    assert perfect["rmse"] == 0 and perfect["r2"] == 1
    assert m([1, 2, 3, 4, 5], [5, 4, 3, 2, 1])["rmse"] > 0
    assert m([1, -2, 3, -4, 5], [0.9, -2.1, 2.8, -4.2, 5.1])["direction_accuracy"] == 1
    r = m([1, 2, 4, 0], [1.5, 2, 3, 1])
    assert abs(r["mae"] - 0.625) < 1e-12 and abs(r["mape"] - 0.25) < 1e-12
