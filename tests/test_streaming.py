import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.validate import BarLimits
from tickloom.streaming import jobs, stateful

START = datetime(2024, 1, 1)
SCHEMA = "id long, key string, ts timestamp, value double"


def write(spark, folder, name, rows, age):
    """One file per batch, read in order of modification time."""
    path = f"{folder}/{name}.parquet"
    pd.DataFrame([(i, k, START + timedelta(seconds=s), float(v)) for i, k, s, v in rows], columns=["id", "key", "ts", "value"]).to_parquet(
        path, coerce_timestamps="us", index=False)
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.fixture
def batches(spark, tmp_path):
    def make(*parts):
        for i, rows in enumerate(parts):
            write(spark, tmp_path, f"b{i}", rows, i * 10)
        return stream(spark, tmp_path)

    return make


def test_sustained_across_batches(batches):
    on = [(i, "k", 60 * i, 10) for i in range(0, 6)]
    still = [(i, "k", 60 * i, 10) for i in range(6, 10)] + [(99, "k", 600, 0)]
    end = [(100, "z", 7200, 0)]
    out = stateful.sustained_alerts(batches(on, still, end), F.col("key"), "ts", F.avg("value") > 5, 300, 60, "1 minute")
    rows = jobs.run_to_table(out, "t").where("series = 'k'").orderBy("at").collect()
    assert [(r["state"], (r["at"] - START).seconds) for r in rows] == [("PENDING", 60), ("FIRING", 360), ("RESOLVED", 660)]


def test_silence_fires_by_timer(batches):
    first = [(0, "k", 0, 1), (1, "k", 30, 1), (2, "other", 0, 1)]
    rest = [(3, "other", 60 * i, 1) for i in range(1, 40)]
    out = stateful.silence_alerts(batches(first, rest, [(9, "other", 2500, 1)], [(10, "other", 2600, 1)]), F.col("key"), "ts", 900, 60, "1 minute")
    rows = jobs.run_to_table(out, "t").collect()
    assert [(r["series"], r["state"], (r["at"] - START).seconds) for r in rows] == [("k", "FIRING", 930)]


def test_silence_resolves(batches):
    out = stateful.silence_alerts(batches([(0, "k", 0, 1)], [(1, "k", 3000, 1)], [(2, "z", 3300, 1)]), F.col("key"), "ts", 900, 60, "1 minute")
    rows = jobs.run_to_table(out, "t").where("series = 'k'").orderBy("at").collect()
    assert [(r["state"], (r["at"] - START).seconds) for r in rows] == [("FIRING", 900), ("RESOLVED", 3000)]


@pytest.mark.parametrize("cut", [1, 4])
def test_once_per_period(spark, batches, cut):
    rows = [(i, "hot", 97 * i, 0) for i in range(200)] + [(500 + i, "b", 3600 * i, 0) for i in range(6)]
    rows.sort(key=lambda r: r[2])
    parts = [rows[k * len(rows) // cut : (k + 1) * len(rows) // cut] for k in range(cut)]
    kept = jobs.run_to_table(stateful.once_per_period(batches(*parts), ["key"], "ts", 3600), "t")
    expected, last = [], {}
    for i, k, s, _ in rows:
        if k not in last or s - last[k] > 3600:
            expected.append(i)
            last[k] = s
    assert sorted(r["id"] for r in kept.collect()) == sorted(expected)
    assert abs(jobs.hit_ratio(kept, spark.range(len(rows))).first()["hit_ratio"] - (1 - len(expected) / len(rows))) < 1e-12


class Handle:
    """State of one key in memory."""

    def __init__(self):
        self.value = None

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):
        return []

    def registerTimer(self, _):
        pass


def test_a_hot_key_is_not_held_at_once(monkeypatch):
    """Chunks of a key in any order are never put together beyond a run, and ties are broken across runs."""
    monkeypatch.setattr(stateful, "RUN_ROWS", 100, raising=False)
    largest, concat = [], pd.concat
    monkeypatch.setattr(stateful.pd, "concat", lambda parts: largest.append(sum(map(len, parts := list(parts)))) or concat(parts))
    rng = random.Random(4)
    for period in (5, 400):
        rows = [(i, START + timedelta(seconds=rng.randrange(9000))) for i in rng.sample(range(10_000), 3000)]
        keeper = stateful.OncePerPeriod(period, "ts", ["id"])
        keeper.init(Handle())
        got, half = [], START + timedelta(seconds=4500)
        for batch in ([r for r in rows if r[1] < half], [r for r in rows if r[1] >= half]):
            chunks = (pd.DataFrame(batch[k : k + 30], columns=["id", "ts"]) for k in range(0, len(batch), 30))
            got += [i for table in keeper.handleInputRows(("k",), chunks, None) for i in table["id"]]
        expected, last = [], None
        for i, at in sorted(rows, key=lambda r: (r[1], r[0])):
            if last is None or (at - last).total_seconds() > period:
                expected.append(i)
                last = at
        assert sorted(got) == sorted(expected)
    assert max(largest) < 200


def test_push_ignores_older_rows(batches, tmp_path):
    rows = batches([(0, "a", 100, 1), (1, "b", 10, 1)], [(2, "a", 50, 2), (3, "b", 20, 3)]).drop("id")
    table = jobs.push_latest(rows, ["key"], "ts", f"{tmp_path}/out/latest")
    assert {r["key"]: r["value"] for r in table.collect()} == {"a": 1.0, "b": 3.0}


def test_counters_across_batches(batches, tmp_path):
    got = jobs.running_counters(batches([(0, "a", 1, 2), (1, "b", 1, 5)], [(2, "a", 9, 4)]), ["key"], "ts", "value", f"{tmp_path}/out/counters")
    assert {r["key"]: (r["samples"], r["total"], r["value"]) for r in got.collect()} == {"a": (2, 6.0, 4.0), "b": (1, 5.0, 5.0)}


def test_validation_sinks(spark, batches, tmp_path):
    bars = batches([(0, "a", 0, 10), (1, "b", 0, -1)], [(2, "c", 0, 20)]).select(
        F.col("key").alias("ticker"), F.col("ts").cast("date").alias("date"), *[F.col("value").alias(c) for c in ("open", "high", "low", "close")], F.lit(200000).alias("volume"))
    jobs.validate_stream(bars, f"{tmp_path}/out", BarLimits())
    assert {r["ticker"] for r in spark.read.parquet(f"{tmp_path}/out/valid").collect()} == {"a", "c"}
    assert [r["validation_error"] for r in spark.read.parquet(f"{tmp_path}/out/quarantine").collect()] == ["Price -1.0 outside valid range"]


def test_bars_and_rates_match_batch(spark, batches):
    rows = [(i, "a", 600 * i, i % 7) for i in range(600)]
    src = batches(rows[:300], rows[300:])
    got = jobs.run_to_table(jobs.bars_from_stream(src, "key", "ts", "value", "1 hour"), "t").orderBy("date").collect()
    day = [r for r in rows if r[2] < 86400]
    assert got[0]["volume"] == len(day) and got[0]["close"] == day[-1][3] and len(got) == 4
    rate = jobs.run_to_table(jobs.sliding_rate(src, ["key"], "ts", F.lit(1), "1 hour", "30 minutes", 3600, "10 minutes"), "t")
    assert {r["increase"] for r in rate.where("window_end > '2024-01-01 01:00:00'").collect()} == {6}


def test_approximate_quantiles(batches):
    rows = [(i, "a", i, i) for i in range(300)] + [(999, "a", 9000, 0)]
    got = jobs.run_to_table(jobs.approximate_quantiles(batches(rows), ["key"], "ts", "value", {"p50": 0.5}, "5 minutes", "5 minutes"), "t").first()
    assert abs(got["p50"] - 149.5) < 2


def test_ratio_of_two_streams(spark, tmp_path):
    """Windows that only one side has come out once the slower stream has passed them."""
    for name, rows in (("hits", [(0, "a", 10, 1), (1, "a", 20, 1), (2, "b", 30, 1), (3, "a", 700, 1), (4, "z", 5000, 1)]), ("misses", [(0, "a", 15, 1), (1, "c", 650, 1), (2, "z", 4000, 1)])):
        (tmp_path / name).mkdir()
        write(spark, tmp_path / name, "f", rows, 0)
    out = jobs.ratio_of_streams(stream(spark, f"{tmp_path}/hits"), stream(spark, f"{tmp_path}/misses"), ["key"], "ts", "10 minutes", "1 minute")
    got = {(r["key"], (r["window_end"] - START).seconds): (r["top"], r["other"], round(r["ratio"], 3)) for r in jobs.run_to_table(out, "ratio").collect()}
    assert got == {("a", 600): (2, 1, 0.667), ("b", 600): (1, 0, 1.0), ("a", 1200): (1, 0, 1.0), ("c", 1200): (0, 1, 0.0)}
