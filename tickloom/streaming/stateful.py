"""Alerts that need a memory per series: a condition that holds, and a signal that stays away.

Samples are reduced to one row per series and step by a windowed aggregate before they reach Python, so the work of a
series follows the clock and not its number of samples.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.streaming.jobs import METRIC_DELAY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a key that are held and sorted at once; more are sorted in runs on disk.
RUN_ROWS = 200_000
#: Groups that keys are dealt to by hash; part of what a checkpoint holds.
BUCKETS = 1024
#: Column that numbers the keys of a bucket.
KEY = "__key"
EVENTS = "series string, state string, since timestamp, at timestamp"


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store."""
    spark.conf.set(PROVIDER, ROCKSDB)


def bucket_of(*names: str, buckets: int = BUCKETS) -> Column:
    """Bucket of a key."""
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")


class Bucketed(StatefulProcessor):
    """Processor of a bucket of keys: what it remembers of them is one value, read and written once a batch.

    A call, a state access and a timer cost more than the rows of most keys, so they are paid per bucket. A bucket's timer is that
    of the key that needs it first.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "keys binary")

    def load(self) -> dict:
        return pickle.loads(self.memory.get()[0]) if self.memory.exists() else {}

    def keep(self, held: dict, wake: int | None) -> None:
        """Remember ``held`` and set the timer, in milliseconds."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if wake is not None:
            self.handle.registerTimer(wake)
        if held:
            self.memory.update((pickle.dumps(held, pickle.HIGHEST_PROTOCOL),))
        elif self.memory.exists():
            self.memory.clear()

    def close(self) -> None:
        pass


def _in_order(rows: Iterator[pd.DataFrame], column: str) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(column)


def _events(series: str, out: list[tuple]) -> Iterator[pd.DataFrame]:
    if out:
        frame = pd.DataFrame(out, columns=["state", "since", "at"])
        frame.insert(0, "series", series)
        yield frame


class Sustained(StatefulProcessor):
    """PENDING when a condition turns true, FIRING once it has held, RESOLVED when a firing one ends.

    A condition ends with a false step or with a missing one.
    """

    def __init__(self, hold_seconds: int, step_seconds: int) -> None:
        self.hold, self.step = pd.Timedelta(seconds=hold_seconds), pd.Timedelta(seconds=step_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("memory", "since timestamp, seen timestamp, firing boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        since = seen = None
        firing = False
        if self.memory.exists():
            since, seen, firing = self.memory.get()
            since, seen = pd.Timestamp(since), pd.Timestamp(seen)
        out: list[tuple] = []
        for tick, active in _in_order(rows, "tick")[["tick", "active"]].itertuples(index=False):
            tick = pd.Timestamp(tick)
            if since is not None and (not active or tick - seen > self.step):
                if firing:
                    out.append(("RESOLVED", since, min(tick, seen + self.step)))
                since, firing = None, False
            if active:
                if since is None:
                    since = tick
                    out.append(("PENDING", since, tick))
                if not firing and tick - since >= self.hold:
                    firing = True
                    out.append(("FIRING", since, tick))
                seen = tick
        if since is None:
            self.memory.clear()
        else:
            self.memory.update((since.to_pydatetime(), seen.to_pydatetime(), firing))
        yield from _events(key[0], out)

    def close(self) -> None:
        pass


class Silence(StatefulProcessor):
    """FIRING when a series has been silent for ``limit_seconds`` of event time, RESOLVED when it speaks again."""

    def __init__(self, limit_seconds: int) -> None:
        self.limit = pd.Timedelta(seconds=limit_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "seen timestamp, firing boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen, firing = None, False
        if self.memory.exists():
            seen, firing = self.memory.get()
            seen = pd.Timestamp(seen)
        out: list[tuple] = []
        for first, last in _in_order(rows, "first")[["first", "last"]].itertuples(index=False):
            first, last = pd.Timestamp(first), pd.Timestamp(last)
            if seen is not None and first - seen >= self.limit:
                if not firing:
                    out.append(("FIRING", seen, seen + self.limit))
                out.append(("RESOLVED", seen, first))
            firing = False
            seen = last if seen is None else max(seen, last)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(_millis(seen + self.limit))
        self.memory.update((seen.to_pydatetime(), firing))
        yield from _events(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seen, firing = self.memory.get()
        if not firing:
            seen = pd.Timestamp(seen)
            self.memory.update((seen.to_pydatetime(), True))
            yield from _events(key[0], [("FIRING", seen, seen + self.limit)])

    def close(self) -> None:
        pass


class StaleValue(StatefulProcessor):
    """PENDING when a value that is a time has become older than ``limit_seconds``, FIRING once that has held, RESOLVED by a newer one.

    Timers are set from the value itself and set anew when it changes, so they need no further input. ``since`` is when
    the value becomes too old, or when a value came in that already was.
    """

    def __init__(self, limit_seconds: int, hold_seconds: int) -> None:
        self.limit, self.hold = limit_seconds * 1_000_000, hold_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "since long, told int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        since, told = self.memory.get() if self.memory.exists() else (None, 0)
        out: list[tuple] = []
        for at, value in _in_order(rows, "at")[["at", "held"]].itertuples(index=False):
            told = self._tell(since, told, at, out)
            due = value + self.limit
            if due > at:
                if told == 2:
                    out.append(("RESOLVED", since, at))
                since, told = due, 0
            elif since is None or since > at:
                since, told = at, 0
        self._keep(since, told, timerValues)
        yield from self._events(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since, told = self.memory.get()
        out: list[tuple] = []
        told = self._tell(since, told, timerValues.getCurrentWatermarkInMs() * 1000, out)
        self._keep(since, told, timerValues)
        yield from self._events(key, out)

    def _tell(self, since: int | None, told: int, now: int, out: list[tuple]) -> int:
        """States that have been reached by ``now``: 0 none, 1 pending, 2 firing."""
        if since is not None and told == 0 and since <= now:
            out.append(("PENDING", since, since))
            told = 1
        if told == 1 and since + self.hold <= now:
            out.append(("FIRING", since, since + self.hold))
            told = 2
        return told

    def _keep(self, since: int, told: int, timerValues) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if told < 2:
            self.handle.registerTimer(-(-(since + self.hold * told) // 1000))
        self.memory.update((since, told))

    @staticmethod
    def _events(key, out: list[tuple]) -> Iterator[pd.DataFrame]:
        for frame in _events(key[0], out):
            yield frame.assign(**{c: pd.to_datetime(frame[c], unit="us", utc=True) for c in ("since", "at")})

    def close(self) -> None:
        pass


class _Run:
    """Rows in the order of their key and time. Keys are numbers here."""

    def __init__(self, table: pd.DataFrame, ts: str) -> None:
        self.table, self.times = table, table[ts].to_numpy().astype("datetime64[us]").astype("int64")
        self.keys = table[KEY].to_numpy().astype("int64")

    def after(self, key: int, time: int) -> int:
        """First place beyond a time of a key."""
        a, b = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right")
        return int(a + np.searchsorted(self.times[a:b], time, "right"))

    def rank(self, k: int) -> tuple:
        return ()

    def rows(self, places: list[int]) -> pd.DataFrame:
        return self.table.iloc[places]


class _StoredRun(_Run):
    """One of several runs, in local files; keys, times and the places of what breaks ties are mapped, not held."""

    def __init__(self, path: str, table: pd.DataFrame, ts: str, order: list[str]) -> None:
        super().__init__(table, ts)
        self.path, starts = path, np.zeros(len(table), np.int64)
        table.to_pickle(f"{path}.rows")
        with open(f"{path}.ranks", "wb") as out:
            for k, values in enumerate(zip(*[table[c] for c in order]) if order else [()] * len(table)):
                starts[k] = out.tell()
                pickle.dump(tuple((bool(pd.isna(v)), None if pd.isna(v) else v) for v in values), out)
        for name, values in (("keys", self.keys), ("times", self.times), ("starts", starts)):
            np.save(f"{path}.{name}.npy", values)
        self.table, self.keys, self.times, self.starts = None, *[np.load(f"{path}.{x}.npy", mmap_mode="r") for x in ("keys", "times", "starts")]

    def rank(self, k: int) -> tuple:
        with open(f"{self.path}.ranks", "rb") as f:
            f.seek(self.starts[k])
            return pickle.load(f)

    def rows(self, places: list[int]) -> pd.DataFrame:
        return pd.read_pickle(f"{self.path}.rows").iloc[places]


class OncePerPeriod(Bucketed):
    """Keeps a row when the last kept one of its key is older than the period; a key is forgotten once no row can hit it.

    The rows of a bucket of keys come together, their key as text in the column ``key``; without one, all are of one key.
    What is remembered of a key is its last kept time in microseconds.
    """

    def __init__(self, period_seconds: float, ts: str, order: list[str], key: str | None = None) -> None:
        self.period, self.ts, self.order, self.key = pd.Timedelta(seconds=period_seconds).value // 1000, ts, order, key

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.load()
        numbers = {k: i for i, k in enumerate(held)}
        tables = self._sorted(rows, held, numbers)
        begun = list(itertools.islice(tables, 2))
        if len(begun) < 2:
            runs = [_Run(table, self.ts) for table in begun]
            places, newest = self._first_of_periods(runs)
            yield from (self._plain(run.rows(taken)) for run, taken in zip(runs, places) if taken)
        else:
            with tempfile.TemporaryDirectory() as folder:
                runs = [_StoredRun(f"{folder}/{i}", table, self.ts, self.order) for i, table in enumerate(itertools.chain(begun, tables))]
                places, newest = self._first_of_periods(runs)
                yield from (self._plain(run.rows(taken)) for run, taken in zip(runs, places) if taken)
        if newest:
            names = list(numbers)
            self._store(held | {names[k]: at for k, at in newest.items()})

    def _plain(self, table: pd.DataFrame) -> pd.DataFrame:
        return table.drop(columns=[KEY, *([] if self.key is None else [self.key, f"{self.key}_bucket"])])

    def _sorted(self, rows: Iterator[pd.DataFrame], held: dict[str, int], numbers: dict[str, int]) -> Iterator[pd.DataFrame]:
        """Sorted runs of at most about ``RUN_ROWS`` rows; answered rows and all but the first of a time are left out."""
        parts, size = [], 0
        until = np.array([at + self.period for at in held.values()], np.int64)

        def run() -> pd.DataFrame:
            return pd.concat(parts).sort_values([KEY, self.ts, *self.order], kind="stable").drop_duplicates([KEY, self.ts]).reset_index(drop=True)

        for table in rows:
            table = table[table[self.ts].notna()]
            own = np.array([numbers.setdefault(k, len(numbers)) for k in table[self.key]] if self.key else [numbers.setdefault("", 0)] * len(table), np.int64)
            table = table.assign(**{KEY: own})
            known = own < len(until)
            if known.any():
                answered = np.zeros(len(own), bool)
                answered[known] = table[self.ts].to_numpy().astype("datetime64[us]").astype("int64")[known] <= until[own[known]]
                table = table[~answered]
            if len(table):
                parts.append(table)
                size += len(table)
            if size >= RUN_ROWS:
                parts = [run()]
                size = len(parts[0])
                if size >= RUN_ROWS // 2:
                    yield parts.pop()
                    size = 0
        if parts:
            yield run()

    def _first_of_periods(self, runs: list[_Run]) -> tuple[list[list[int]], dict[int, int]]:
        """Places in each run of the rows to keep, by a merge that skips what a kept row answers, and the newest kept time by key."""
        places: list[list[int]] = [[] for _ in runs]
        newest: dict[int, int] = {}
        heads = [(run.keys[0], run.times[0], run.rank(0), i, 0) for i, run in enumerate(runs)]
        heapq.heapify(heads)
        while heads:
            key, at, _, i, k = heads[0]
            if key not in newest or at > newest[key] + self.period:
                places[i].append(k)
                newest[int(key)] = int(at)
            k = runs[i].after(key, newest[key] + self.period)
            if k < len(runs[i].times):
                heapq.heapreplace(heads, (runs[i].keys[k], runs[i].times[k], runs[i].rank(k), i, k))
            else:
                heapq.heappop(heads)
        return places, newest

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self._store({k: at for k, at in self.load().items() if self._due(at) > now})
        yield from ()

    def _due(self, kept: int) -> int:
        """When no row can be answered by a kept one any more; rounded up to milliseconds."""
        return -(-(kept + self.period) // 1000) + 1

    def _store(self, held: dict[str, int]) -> None:
        self.keep(held, self._due(min(held.values())) if held else None)


def _millis(t: pd.Timestamp) -> int:
    """Event time of a timer; rounded up, so that it cannot expire early."""
    return -(-t.tz_localize(None).value // 1_000_000) if t.tzinfo else -(-t.value // 1_000_000)


def sustained_alerts(samples: DataFrame, series: Column, ts: str, condition: Column, hold_seconds: int, step_seconds: int,
                     delay: str = METRIC_DELAY) -> DataFrame:
    """State changes of an alert per series. ``condition`` is an aggregate over one step, such as a mean above a limit."""
    use_rocksdb(samples.sparkSession)
    steps = samples.withWatermark(ts, delay).groupBy(F.window(ts, f"{step_seconds} seconds").alias("window"), series.alias("series"))
    ticks = steps.agg(condition.alias("active")).select(
        "series", F.window_time("window").alias("event_time"), F.col("window.end").alias("tick"), F.coalesce("active", F.lit(False)).alias("active"))
    return ticks.groupBy("series").transformWithStateInPandas(
        Sustained(hold_seconds, step_seconds), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")


def silence_alerts(samples: DataFrame, series: Column, ts: str, limit_seconds: int, step_seconds: int = 60,
                   delay: str = METRIC_DELAY) -> DataFrame:
    """Absence of samples per series: no request served for a while, or no newer model version for a week."""
    use_rocksdb(samples.sparkSession)
    steps = samples.withWatermark(ts, delay).groupBy(F.window(ts, f"{step_seconds} seconds").alias("window"), series.alias("series"))
    ticks = steps.agg(F.min(ts).alias("first"), F.max(ts).alias("last")).select(
        "series", F.window_time("window").alias("event_time"), "first", "last")
    return ticks.groupBy("series").transformWithStateInPandas(
        Silence(limit_seconds), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")


def stale_value_alerts(samples: DataFrame, series: Column, ts: str, value_time: Column, limit_seconds: int, hold_seconds: int,
                       step_seconds: int = 60, delay: str = METRIC_DELAY) -> DataFrame:
    """Changes of state of a gauge that holds a time, such as that of the newest model version: too old, for long, renewed.

    The last value of each step counts. A series that stays silent still fires, by a timer set from its last value; a value that
    goes back to an old time is too old from its sample on. Samples without a value are left out.
    """
    use_rocksdb(samples.sparkSession)
    rows = samples.withColumn("held", F.unix_micros(value_time.cast("timestamp"))).where("held IS NOT NULL")
    steps = rows.withWatermark(ts, delay).groupBy(F.window(ts, f"{step_seconds} seconds").alias("window"), series.alias("series"))
    ticks = steps.agg(F.unix_micros(F.max(ts)).alias("at"), F.max_by("held", ts).alias("held")).select(
        "series", F.window_time("window").alias("event_time"), "at", "held")
    return ticks.groupBy("series").transformWithStateInPandas(
        StaleValue(limit_seconds, hold_seconds), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")


def once_per_period(requests: DataFrame, key: list[str], ts: str, period_seconds: float = 3600, order: list[str] | None = None,
                    delay: str = METRIC_DELAY, buckets: int = BUCKETS) -> DataFrame:
    """Requests that a result kept for ``period_seconds`` does not answer: the first of each key, and then each that is
    more than the period later than the last one kept.

    Keys are dealt to ``buckets``, and rows of a key in a batch are taken in event-time order, ties by ``order``; beyond
    ``RUN_ROWS`` in a bucket they are sorted in runs on local disk. Kept rows leave at once, so a row counts as answered when it comes in a later batch than a newer kept row
    of its key: the result does not depend on how rows fall into batches as long as each key's batches are in order.
    The state is one time per key seen within the period.
    """
    use_rocksdb(requests.sparkSession)
    # A key as text: exact for each type, as grouping would take it.
    floats = {f.name for f in requests.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    own = F.struct(*[(F.col(c) + F.lit(0.0).cast(requests.schema[c].dataType) if c in floats else F.col(c)).alias(f"k{i}") for i, c in enumerate(key)])
    exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = F.to_json(own, {"ignoreNullFields": "false", "timestampFormat": f"{exact}XXX", "timestampNTZFormat": exact})
    name = "key"
    while {name, f"{name}_bucket"} & {c.lower() for c in requests.columns}:
        name += "_"
    dealt = requests.withWatermark(ts, delay).withColumn(name, text).withColumn(f"{name}_bucket", bucket_of(name, buckets=buckets))
    return dealt.groupBy(f"{name}_bucket").transformWithStateInPandas(
        OncePerPeriod(period_seconds, ts, order or [], name), outputStructType=requests.schema, outputMode="Append", timeMode="EventTime")
