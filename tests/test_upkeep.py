"""Features brought up to date, the maintained view and the latest-value store, against full recomputation."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import maintained, recurrence
from tickloom.operators.indicators import TECHNICAL_COLUMNS, technical_features
from tickloom.plans import daily
from tickloom.plans.daily import DailyConfig
from tickloom.sources import schemas, sinks
from tickloom.sources.latest_store import LatestStore
from tickloom.streaming import jobs

START = datetime(2024, 1, 1)


def by_key(df):
    return {(r["ticker"], r["date"]): r for r in df.collect()}


def close_to(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-8 * max(1.0, abs(b)))


@pytest.mark.parametrize("change", ["late", "corrected", "first", "gone", "new ticker"])
def test_replay_equals_a_full_run(spark, bars, change):
    day = F.col("date") == F.lit(date(2020, 8, 10))
    other = (F.col("ticker") == "GOOGL")
    before = {
        "late": bars.where(~(day & ~other)), "corrected": bars.withColumn("close", F.when(day & ~other, F.col("close") + 7).otherwise(F.col("close"))),
        "first": bars.where("date > '2020-01-02'"), "gone": bars, "new ticker": bars.where(~other)}[change]
    now = bars.where(~(day & ~other)) if change == "gone" else bars
    old, new = recurrence.month_blocks(before), recurrence.month_blocks(now)
    changes = recurrence.first_changes(old, new)
    first = {r["ticker"]: r["first_date"] for r in changes.collect()}
    assert first == {"late": {"AAPL": date(2020, 8, 10)}, "corrected": {"AAPL": date(2020, 8, 10)}, "gone": {"AAPL": date(2020, 8, 10)},
                     "first": dict.fromkeys(("AAPL", "GOOGL"), date(2020, 1, 1)), "new ticker": {"GOOGL": date(2020, 1, 1)}}[change]
    got = by_key(recurrence.replayed(now, recurrence.seeds(recurrence.merged_blocks(old, new), changes, 20 if change == "none" else 200)))
    whole = {k: r for k, r in by_key(technical_features(now)).items() if k[0] in first and k[1] >= first[k[0]]}
    assert got.keys() == whole.keys() and got
    assert all(close_to(got[k][c], whole[k][c]) for k in got for c in TECHNICAL_COLUMNS)


def test_replay_from_the_middle_uses_the_state(spark, bars):
    """With a short tail the averages come from the state of a late month, not from the bars before it."""
    blocks = recurrence.month_blocks(bars)
    changes = spark.createDataFrame([("AAPL", date(2020, 9, 1))], "ticker string, first_date date")
    seeded = recurrence.seeds(blocks, changes, 40)
    assert seeded.first()["seed"]["month"] == "2020-07"
    recent = bars.where("date >= '2020-07-01'")
    got, whole = by_key(recurrence.replayed(recent, seeded)), by_key(technical_features(bars))
    exact = ("ema_12", "ema_26", "macd_line", "macd_signal", "macd_histogram", "obv", "rsi_14", "atr_14", "sma_20")
    assert min(d for _, d in got) == date(2020, 9, 1) and all(close_to(r[c], whole[k][c]) for k, r in got.items() for c in exact)
    assert recurrence.replayed(bars.limit(0), seeded).count() == 0 and recurrence.seeds(blocks, changes.limit(0)).count() == 0


def test_a_late_bar_reaches_the_stored_features(spark, bars, tmp_path):
    config, day = DailyConfig(root=str(tmp_path)), date(2020, 9, 16)
    landed = bars.withColumn("source", F.lit("yfinance"))
    late = (F.col("ticker") == "AAPL") & (F.col("date") == F.lit(date(2020, 8, 10)))
    # A bar of a source that wins over the stored one corrects it.
    corrected = landed.where((F.col("ticker") == "GOOGL") & (F.col("date") == F.lit(date(2020, 6, 20)))).withColumns({"source": F.lit("zz"), "close": F.col("close") + 0.5, "high": F.col("high") + 1})
    daily.ingest(spark, config, landed.where(~late))
    stats = {}
    before = by_key(daily.indicators(spark, config, day, stats))
    assert stats["changed_tickers"] == 2 and stats["replayed_rows"] == len(before)
    daily.ingest(spark, config, landed.where(late).unionByName(corrected))
    again = {}
    after = by_key(daily.indicators(spark, config, day, again, ["2020-08", "2020-06"]))
    from_day = {"AAPL": date(2020, 8, 10), "GOOGL": date(2020, 6, 20)}
    kept = {k for k in after if k[1] < from_day[k[0]]}
    assert all(after[k] == before[k] for k in kept) and all(after[k]["computed_at"] > before[k]["computed_at"] for k in before if k not in kept)
    assert again["changed_tickers"] == 2 and again["replayed_rows"] == len(after) - len(kept)
    fixed = landed.join(corrected.select("ticker", "date"), ["ticker", "date"], "left_anti").unionByName(corrected)
    whole = by_key(schemas.conform(technical_features(fixed.where(F.col("date") <= F.lit(day))), schemas.TECHNICAL))
    assert after.keys() == whole.keys()
    for k, r in after.items():
        for c in TECHNICAL_COLUMNS:
            a, b = r[c], whole[k][c]
            assert a == b or abs(float(a) - float(b)) < 2e-4, (k, c, a, b)
    idle = {}
    daily.indicators(spark, config, day, idle)
    assert idle == {"changed_tickers": 0, "replayed_rows": 0, "rejected_features": 0}


VIEW = T.StructType().add("k", "string").add("at", "integer").add("v", "integer")


def test_maintained_view(spark, tmp_path):
    rng, path = random.Random(3), f"{tmp_path}/view"
    table = {}
    for step in range(6):
        changes = {}
        for _ in range(rng.choice([1, 8, 20])):
            key = (rng.choice("abcdef"), rng.randint(0, 6))
            gone = key in table and rng.random() < 0.4
            changes[key] = (rng.randint(0, 99), gone)
        if step == 4:
            changes |= {k: (0, True) for k in table if k[0] in "ab"}
        for key, (v, gone) in changes.items():
            if gone:
                table.pop(key, None)
            else:
                table[key] = v
        base = spark.createDataFrame([(*k, v) for k, v in table.items()], VIEW)
        batch = spark.createDataFrame([(*k, v, gone) for k, (v, gone) in changes.items()], T.StructType([*VIEW.fields, T.StructField("deleted", T.BooleanType())]))
        for _ in range(2):
            maintained.maintain(spark, path, base, batch, ["k"], "at", VIEW, 4)
        expected = {}
        for (k, at), v in table.items():
            expected[k] = max(expected.get(k, (-1, 0)), (at, v))
        assert {r["k"]: (r["at"], r["v"]) for r in maintained.view_rows(spark, path, ["k"], VIEW).collect()} == expected
    maintained.maintain(spark, path, base, batch.limit(0), ["k"], "at", VIEW, 4)


def test_view_reads_the_table_for_lost_keys_only(spark):
    view = spark.createDataFrame([("a", 5, 1), ("b", 5, 1), ("c", 5, 1)], VIEW)
    changes = spark.createDataFrame([("a", 9, 2), ("b", 3, 0), ("c", 5, 7), ("d", 1, 1)], VIEW).select("k", "at")
    assert [r["k"] for r in maintained.lost_keys(view, changes, ["k"], "at").collect()] == ["c"]


STORE = T.StructType().add("k", "string").add("ts", "timestamp").add("v", "integer")


def rows_of(spark, rows):
    return spark.createDataFrame([(k, START + timedelta(seconds=s), v) for k, s, v in rows], STORE)


def tree(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_store_writes_follow_the_batch(spark, tmp_path):
    store = LatestStore(f"{tmp_path}/s", ("k",), "ts", STORE, 8)
    store.write(rows_of(spark, [(f"k{i}", i % 50, i) for i in range(20_000)]), 0)
    big = tree(store.path)
    store.write(rows_of(spark, [("k7", 1000, -1), ("new", 5, 1), (None, 5, 1)]), 1)
    small = {p: n for p, n in tree(store.path).items() if p not in big}
    assert len(small) <= 2 and sum(small.values()) < sum(big.values()) / 20 and big.items() <= tree(store.path).items()
    assert store.read(spark).count() == 20_001
    found = store.lookup(spark.createDataFrame([("k7",), ("new",), ("none",), ("k7",)], "k string"))
    assert {r["k"]: r["v"] for r in found.collect()} == {"k7": -1, "new": 1}
    plan = store.lookup(spark.createDataFrame([("k7",)], "k string"))._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_store_against_a_dictionary(spark, tmp_path):
    rng, store = random.Random(5), LatestStore(f"{tmp_path}/s", ("k",), "ts", STORE, 4)
    assert store.read(spark).count() == 0 and store.folded(spark) is None
    best = {}
    for n in range(8):
        rows = [(f"k{rng.randint(0, 30)}", rng.randint(0, 40), rng.randint(0, 99)) for _ in range(25)]
        for _ in range(2):  # a repeated batch changes nothing
            store.write(rows_of(spark, rows), n)
        for k, s, v in rows:
            best[k] = max(best.get(k, (-1, 0)), (s, v))
        if n == 2:
            store.compact(spark, 2, [0, 1])
        if n == 4:
            store.compact(spark, 4, [1, 2, 3])
            store.compact(spark, 4, [1, 2, 3])
            store.write(rows_of(spark, rows), n)  # a batch that comes again after it was folded
        if n == 6:
            store.compact(spark, 5)
        assert {r["k"]: (int((r["ts"] - START).total_seconds()), r["v"]) for r in store.read(spark).collect()} == best
        some = rng.sample(sorted(best), 3)
        found = store.lookup(spark.createDataFrame([(k,) for k in some], "k string")).collect()
        assert {r["k"]: r["v"] for r in found} == {k: best[k][1] for k in some}
    assert store.folded(spark) == 5 and store.manifest(spark) == dict.fromkeys(range(4), 5)


def test_stream_into_the_store(spark, tmp_path):
    import pandas as pd

    os.makedirs(f"{tmp_path}/in")
    for i in range(5):
        frame = pd.DataFrame([(f"k{j}", START + timedelta(seconds=10 * i - j), 100 * i + j) for j in range(3 + i)], columns=["k", "ts", "v"]).astype({"v": "int32"})
        frame.to_parquet(f"{tmp_path}/in/{i}.parquet", coerce_timestamps="us", index=False)
        os.utime(f"{tmp_path}/in/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    store = LatestStore(f"{tmp_path}/s", ("k",), "ts", STORE, 4)
    jobs.push_to_store(spark.readStream.schema(STORE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), store, 2)
    assert {r["k"]: r["v"] for r in store.read(spark).collect()} == {f"k{j}": 400 + j for j in range(7)} and store.manifest(spark)
