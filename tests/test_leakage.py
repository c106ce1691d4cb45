from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from tests.conftest import price_series
from tickloom.functions import gram
from tickloom.functions.stats import pearson_p_value
from tickloom.operators import leakage


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.RandomState(42)
    pdf = price_series(1000)
    pdf["target"] = rng.randn(1000)
    pdf["suspicious"] = pdf["target"].shift(-1)
    pdf["dependent"] = pdf["target"] + rng.randn(1000) * 0.1
    pdf["twin"] = pdf["close"] + rng.randn(1000) * 0.01
    pdf["constant"] = 1.0
    pdf.loc[5:9, "dependent"] = np.nan
    return pdf, spark.createDataFrame(pdf).cache()


def test_planted_leaks_are_found(planted):
    pdf, df = planted
    ahead = leakage.detect_lookahead(df, "target", ["suspicious", "close", "constant"]).collect()
    assert [r["affected_columns"] for r in ahead] == [["suspicious"]] and ahead[0]["severity"] == "CRITICAL"
    dep = leakage.detect_target_dependence(df, "target", ["dependent", "volume"], 0.7).collect()
    want = pdf[["dependent", "target"]].dropna().corr().iloc[0, 1]
    assert len(dep) == 1 and abs(dep[0]["evidence"]["correlation"] - want) < 1e-12 and dep[0]["evidence"]["p_value"] < 1e-10
    twins = leakage.detect_collinearity(df, ["close", "twin", "constant"]).collect()
    assert [r["affected_columns"] for r in twins] == [["close", "twin"]]


def test_pairs_match_pandas(planted):
    pdf, df = planted
    names = ["open", "close", "dependent", "target", "suspicious", "volume"]
    want = pdf[names].corr().abs()
    for r in leakage.pair_correlations(df, names).collect():
        assert abs(r["correlation"] - want.loc[r["feature1"], r["feature2"]]) < 1e-9


def test_temporal(spark):
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(366)]
    df = spark.createDataFrame(pd.DataFrame({"date": days}))
    train, val = df.where(f"date <= '{days[199]}'"), df.where(f"date between '{days[150]}' and '{days[249]}'")
    got = leakage.detect_temporal(train, val).collect()
    assert sorted(r["severity"] for r in got) == ["CRITICAL", "HIGH"]
    assert {r["evidence"].get("overlap_days") for r in got} == {49.0, None}
    assert leakage.detect_temporal(train, df.where(f"date > '{days[199]}'")).isEmpty()


def test_summary_and_report(planted):
    _, df = planted
    train, val = df.where("date < '2022-01-01'"), df.where("date >= '2022-01-01'")
    bad = leakage.all_issues(train, val, "target", ["suspicious", "dependent", "close", "twin"])
    s = leakage.summarize_issues(bad).first()
    assert (s["critical"], s["high"], s["medium"], s["is_safe"]) == (1, 1, 2, False)
    lines = [r["line"] for r in leakage.report_lines(bad).collect()]
    assert lines[0].startswith("[CRITICAL]") and lines[-1].startswith("[MEDIUM]")
    assert leakage.summarize_issues(leakage.all_issues(train, val, "target", ["volume", "open"])).first()["is_safe"]


@pytest.mark.parametrize("r, n, p", [(0.5, 10, 0.14111), (0.9, 12, 6.7e-05), (0.1, 1000, 0.001544), (0.0, 50, 1.0)])
def test_p_values(r, n, p):
    assert abs(pearson_p_value(r, n) - p) / p < 0.02


def test_blocks_of_columns(spark, monkeypatch):
    """Many columns with missing values, a constant and large values, in blocks smaller than their number."""
    monkeypatch.setattr(gram, "BLOCK", 16)
    monkeypatch.setattr(gram, "BLOCKS_AT_ONCE", 3)
    rng = np.random.RandomState(3)
    data = rng.randn(300, 40) @ rng.randn(40, 40)
    data[rng.rand(300, 40) < 0.1] = np.nan
    data[:, 7] = 0.1
    data[:, 8] = 1e9 + data[:, 9]
    data[:, 10] = np.nan
    names = [f"f{k}" for k in range(40)]
    pdf = pd.DataFrame(data, columns=names)
    want = pdf.corr().abs()
    got = leakage.pair_correlations(spark.createDataFrame(pdf).repartition(5), names).collect()
    assert len(got) == 39 * 38 // 2
    for r in got:
        value = r["correlation"]
        if "f7" in (r["feature1"], r["feature2"]):
            assert value is None
        else:
            assert abs(value - want.loc[r["feature1"], r["feature2"]]) < 1e-6
    assert leakage.pair_correlations(spark.createDataFrame(pdf).where("1 = 0"), names).isEmpty()


def test_a_thousand_columns(spark):
    rng = np.random.RandomState(4)
    data = rng.randn(200, 1000)
    data[:, 999] = data[:, 0] * 2
    names = [f"f{k}" for k in range(1000)]
    found = leakage.detect_collinearity(spark.createDataFrame(pd.DataFrame(data, columns=names)), names).collect()
    assert [r["affected_columns"] for r in found] == [["f0", "f999"]]
