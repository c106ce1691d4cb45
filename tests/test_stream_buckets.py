"""Streams of many keys: the cost of state and calls is that of buckets, the results are those of single keys."""

import os
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from tickloom.operators import alerts
from tickloom.operators.alerts import AlertRule
from tickloom.streaming import jobs, rules, stateful

START = datetime(2024, 1, 1)


class Handle:
    """State in memory that counts how often it is used."""

    def __init__(self):
        self.value, self.uses, self.timers = None, 0, []

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def __getattr__(self, name):
        def use(*given):
            self.uses += 1
            return self.used(name, *given)

        return use

    def used(self, name, *given):
        if name == "registerTimer":
            self.timers.append(given[0])
        elif name == "deleteTimer":
            self.timers.remove(given[0])
        elif name in ("update", "clear"):
            self.value = given[0] if given else None
        return {"exists": self.value is not None, "get": self.value, "listTimers": list(self.timers)}.get(name)


class Clock:
    def __init__(self, seconds):
        self.millis = seconds * 1000

    def getCurrentWatermarkInMs(self):
        return self.millis


def test_a_bucket_of_series_uses_its_state_once():
    own = [AlertRule("High", alerts.instant("g", seconds=60), ">", 5, 60, "x", 30)]
    windows = rules.Windows(rules.read_metrics(own), (), 30, rules.lone_rules(own))
    state = rules.RuleState(own)
    handles = Handle(), Handle()
    for processor, handle in zip((windows, state), handles):
        processor.init(handle)
    n = 400
    rows = pd.DataFrame([("g", f'{{"k":"{i}"}}', t, None, None, 9.0, t * 10**6, 9.0, 1, []) for i in range(n) for t in (30, 60, 90)],
                        columns=["metric", "labels", "tick", "increase", "first", "value", "last_at", "total", "n", "counts"])
    (found,) = windows.handleInputRows((0,), iter([rows[:500], rows[500:]]), None)
    assert len(found) == n and all(t == [30, 60, 90] for t in found["ticks"])
    (rest,) = windows.handleExpiredTimer((0,), Clock(1000), None)
    assert all(t == [120] for t in rest["ticks"]) and not handles[0].timers
    met = found.explode(["ticks", "totals"]).rename(columns={"ticks": "tick", "totals": "value"}).assign(active=True).astype({"tick": int, "value": float})
    (events,) = state.handleInputRows((0,), iter([met]), None)
    assert events["state"].value_counts().to_dict() == {"PENDING": n, "FIRING": n}
    (ends,) = state.handleExpiredTimer((0,), Clock(120), None)
    assert len(ends) == n and set(ends["state"]) == {"RESOLVED"} and handles[1].value is None
    assert max(h.uses for h in handles) <= 20


def test_a_bucket_of_request_keys_uses_its_state_once():
    keeper, handle = stateful.OncePerPeriod(3600, "ts", ["id"], "key"), Handle()
    keeper.init(handle)
    n, times = 400, (0, 1800, 3600, 3601, 9000)
    rows = pd.DataFrame([(i, f"k{i}", START + timedelta(seconds=s + i), 0) for s in times for i in range(n)], columns=["id", "key", "ts", "key_bucket"])
    got = [(r.id, (r.ts - START).total_seconds() - r.id) for part in (rows[:900], rows[900:])
           for table in keeper.handleInputRows((0,), iter([part.sample(frac=1, random_state=1)]), None) for r in table.itertuples()]
    assert sorted(got) == [(i, s) for i in range(n) for s in (0.0, 3601.0, 9000.0)]
    assert handle.uses <= 20
    last = int((START - datetime(1970, 1, 1)).total_seconds()) + 9000 + 3600
    list(keeper.handleExpiredTimer((0,), Clock(last + 100), None))
    assert len(keeper.load()) == n - 100


def test_keys_over_several_runs(monkeypatch):
    """A bucket whose rows don't fit a run gives the same rows, ties broken by order."""
    rows = pd.DataFrame([(i, f"k{i % 7}", START + timedelta(seconds=37 * (i // 14)), 0) for i in range(4000)], columns=["id", "key", "ts", "key_bucket"]).sample(frac=1, random_state=3)
    found = []
    for size in (200_000, 100):
        monkeypatch.setattr(stateful, "RUN_ROWS", size)
        keeper = stateful.OncePerPeriod(600, "ts", ["id"], "key")
        keeper.init(Handle())
        found.append(sorted(i for table in keeper.handleInputRows((0,), (rows[k : k + 30] for k in range(0, len(rows), 30)), None) for i in table["id"]))
    assert found[0] == found[1] and len(found[0]) > 50


def test_keys_are_told_apart_exactly(spark, tmp_path):
    """Nulls, large numbers with nulls beside them, and times a microsecond apart are keys of their own."""
    n, big, at = None, 2**60, START + timedelta(microseconds=1)
    keys = [(n, "a", START), ("a", n, START), (n, n, n), (n, n, START), (n, n, at), ("a", "a", START), ("null", "a", START)]
    rows = [(i, *k, big + i % 2, START + timedelta(seconds=j)) for j in range(2) for i, k in enumerate(keys)] + [(99, n, n, n, n, START)]
    kinds = pa.schema([("id", pa.int64()), ("a", pa.string()), ("b", pa.string()), ("c", pa.timestamp("us")), ("d", pa.int64()), ("ts", pa.timestamp("us"))])
    os.makedirs(f"{tmp_path}/in")
    pq.write_table(pa.table([pa.array(x, t) for x, t in zip(zip(*rows), kinds.types)], schema=kinds), f"{tmp_path}/in/f.parquet")
    stream = spark.readStream.schema("id long, a string, b string, c timestamp, d long, ts timestamp").parquet(f"{tmp_path}/in")
    kept = jobs.run_to_table(stateful.once_per_period(stream, ["a", "b", "c", "d"], "ts", 3600, ["id"]), "keys").collect()
    assert sorted(r["id"] for r in kept) == [*range(len(keys)), 99] and {r["d"] for r in kept} == {big, big + 1, None}
