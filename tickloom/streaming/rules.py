"""Alert rules as data on live metrics: the rules of :mod:`tickloom.operators.alerts`, all at once, on one stream of samples.

Each sample is read once. Samples become one partial row per series and step; every window of every rule is merged from
those partials, which a series keeps by step. Readings of a rule are added up before they meet in its state, so a rule
over all series gets one row per step and reading, whatever the number of series. Rules that read a single series have nothing to
add up: their readings pass that step as one row per series and batch. What a rule remembers is one row
per label set. Both memories are kept per bucket of keys and can be loaded from a batch run over the samples before the stream.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from tickloom.operators.alerts import OPERATORS, AlertRule, Reading, condition
from tickloom.operators.metrics import counter_increases, step_end
from tickloom.streaming.jobs import METRIC_DELAY
from tickloom.streaming.stateful import Bucketed, bucket_of, use_rocksdb

READ = "event_time timestamp, rule string, part int, labels string, total double, members long, ticks array<long>, totals array<double>"
EVENTS = "rule string, labels string, state string, since timestamp, at timestamp, value double"
SERIES_STATE = "metric string, labels string, tick long, increase double, last_at long, value double, total double, n long, counts array<long>, next long"
RULE_STATE = "rule string, labels string, since long, seen long, firing boolean, value double"


def base_step(rules: Sequence[AlertRule]) -> int:
    """The step in which samples are put together: every rule's step and window is a multiple of it."""
    if not rules:
        raise ValueError("no rules")
    for rule in rules:
        for reading in rule.expression.readings:
            if reading.seconds % rule.step:
                raise ValueError("the window must be a multiple of the step")
    return gcd(*[rule.step for rule in rules])


def read_metrics(rules: Sequence[AlertRule]) -> dict[str, list[tuple[str, int, int, Reading]]]:
    """Readings by metric: (rule, place in the rule, step of the rule, reading)."""
    out: dict[str, list[tuple[str, int, int, Reading]]] = {}
    for rule in rules:
        for part, reading in enumerate(rule.expression.readings):
            out.setdefault(reading.metric, []).append((rule.name, part, rule.step, reading))
    return out


def lone_rules(rules: Sequence[AlertRule]) -> frozenset[str]:
    """Rules whose value is that of one reading of one series: no other row adds to it."""
    return frozenset(r.name for r in rules if [(x.by, x.kind == "average") for x in r.expression.readings] == [(None, False)])


def bounds_of(rules: Sequence[AlertRule]) -> tuple[float, ...]:
    """All bucket bounds that a rule asks for."""
    return tuple(sorted({float(b) for rule in rules for r in rule.expression.readings for b in r.bounds}))


def json_labels(labels: Column) -> Column:
    """Sorted labels as text."""
    return F.to_json(F.map_from_entries(labels))


def step_partials(samples: DataFrame, rules: Sequence[AlertRule], delay: str | None = METRIC_DELAY) -> DataFrame:
    """One row per series and step: what can be merged into any window over it.

    ``samples`` as from ``alerts.sample_table``. A step is open at its start, so windows are cut from a microsecond before the
    sample. Only counters that a rule asks for keep the samples of a step, to put them in order.
    """
    metrics, bounds = read_metrics(rules), bounds_of(rules)
    counters = [m for m, own in metrics.items() if any(r.kind in ("rate", "increase") for *_, r in own)]
    rows = samples.where(F.col("metric").isin(*metrics) & F.col("value").isNotNull()).select(
        (F.col("ts") - F.expr("INTERVAL 1 MICROSECOND")).alias("before"), F.unix_micros("ts").alias("at"), "metric", json_labels(F.col("labels")).alias("labels"), "value")
    rows = rows if delay is None else rows.withWatermark("before", delay)
    kept = F.when(F.col("metric").isin(*counters), F.struct("at", "value"))
    counts = [F.count_if((F.col("value") <= b)).alias(f"c{i}") for i, b in enumerate(bounds)]
    grouped = rows.groupBy(F.window("before", f"{base_step(rules)} seconds").alias("w"), "metric", "labels").agg(
        F.array_sort(F.collect_list(kept)).alias("kept"), F.max("at").alias("last_at"), F.max_by("value", "at").alias("value"),
        F.sum("value").alias("total"), F.count("*").alias("n"), *counts)
    grown = F.when(F.size("kept") > 0, F.aggregate(
        F.col("kept"), F.struct(F.lit(0.0).alias("sum"), F.get(F.col("kept"), F.lit(0))["value"].alias("before")),
        lambda acc, s: F.struct((acc["sum"] + F.when(s["value"] < acc["before"], s["value"]).otherwise(s["value"] - acc["before"])).alias("sum"), s["value"].alias("before")),
        lambda acc: acc["sum"]))
    return grouped.select(
        "metric", "labels", F.window_time("w").alias("event_time"), F.unix_timestamp("w.end").alias("tick"), grown.alias("increase"),
        F.get(F.col("kept"), F.lit(0))["value"].alias("first"), F.coalesce(F.get(F.col("kept"), F.size("kept") - 1)["value"], F.col("value")).alias("value"), "last_at", "total", "n",
        F.array(*[F.col(f"c{i}") for i in range(len(bounds))]).cast("array<long>").alias("counts"))


def text_of(labels: dict[str, str]) -> str:
    return json.dumps(labels, separators=(",", ":"), ensure_ascii=False)


def holds(reading: Reading, labels: dict[str, str]) -> bool:
    """Label conditions; a pattern must match the whole value."""
    return all(labels.get(k) == v for k, v in reading.equal) and all(k in labels and re.fullmatch(v, labels[k]) for k, v in reading.regex)


def estimated(counts: Sequence[int], total: int, bounds: Sequence[float], q: float) -> float | None:
    """Quantile from cumulative counts: linear inside the first bucket that reaches the rank, the top bucket gives its lower bound."""
    if not total:
        return None
    rank, lower, below = q * total, min(0.0, bounds[0]), 0
    for le, count in zip(bounds, counts):
        if count >= rank:
            return le if le <= 0 else lower + (le - lower) * (rank - below) / (count - below) if count > below else None
        lower, below = le, count
    return lower


class Windows(Bucketed):
    """Readings of the series of a bucket at every grid time at which their window holds a step: (rule, part, group labels, value).

    A series holds the steps of its longest window. A timer evaluates grid times without new samples until the last
    window is empty; then only the last value stays, from which the next increase counts. What is remembered of a series:
    its last value, the next grid time to look at, None when all windows are empty, and its steps.
    """

    def __init__(self, metrics: dict[str, list[tuple[str, int, int, Reading]]], bounds: Sequence[float], base: int, lone: frozenset[str]) -> None:
        self.metrics, self.bounds, self.base, self.lone = metrics, tuple(bounds), base, lone
        self.longest = {m: max(r.seconds for *_, r in own) for m, own in metrics.items()}

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = self.load()
        for row in initialState.sort_values("tick").itertuples(index=False):
            *_, ring = held.get((row.metric, row.labels), (None, None, {}))
            ring[int(row.tick)] = (row.increase, int(row.last_at), row.value, row.total, int(row.n), [int(c) for c in row.counts])
            newest = ring[max(ring)]
            held[row.metric, row.labels] = (newest[2], int(row.next), dict(sorted(ring.items())))
        self._store(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, out, wanted = self.load(), Found(), {}
        names = ["metric", "labels", "tick", "increase", "first", "value", "last_at", "total", "n", "counts"]
        frame = pd.concat(list(rows)).sort_values("tick")
        for metric, labels, tick, grown, first, new, last_at, total, n, counts in zip(*[frame[c].tolist() for c in names]):
            series = metric, labels
            own = wanted.get(series) or wanted.setdefault(series, self._wanted(*series))
            value, following, ring = held.get(series, (None, None, {}))
            following = tick if following is None else self._evaluate(metric, own, ring, following, tick - self.base, out)
            increase = 0.0 if pd.isna(grown) else grown
            if value is not None and not pd.isna(first):
                increase += first if first < value else first - value
            ring[tick] = (increase, last_at, new, total, n, list(counts))
            held[series] = (new, self._evaluate(metric, own, ring, tick if following is None else following, tick, out), ring)
        self._store(held)
        yield from out.frames()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, out = self.load(), Found()
        until = timerValues.getCurrentWatermarkInMs() // 1000 // self.base * self.base
        for series, (value, following, ring) in held.items():
            if following is not None and following <= until:
                held[series] = (value, self._evaluate(series[0], self._wanted(*series), ring, following, until, out), ring)
        self._store(held)
        yield from out.frames()

    def _wanted(self, metric: str, text: str) -> list[tuple[str, int, int, Reading, str]]:
        """Readings that a series takes part in: (rule, place, step, reading, group labels)."""
        labels = json.loads(text)
        return [(rule, part, step, r, text if r.by is None else text_of({k: labels[k] for k in sorted(r.by) if k in labels}))
                for rule, part, step, r in self.metrics[metric] if holds(r, labels)]

    def _evaluate(self, metric: str, wanted: list[tuple[str, int, int, Reading, str]], ring: dict[int, tuple], tick: int, until: int, out: Found) -> int | None:
        """Readings from ``tick`` to ``until``; returns the next time to look at, None when all windows are empty."""
        before: list[tuple] = [([], None)] * len(wanted)  # a window often holds the same steps as at the time before
        while tick <= until:
            for old in [t for t in ring if t <= tick - self.longest[metric]]:
                del ring[old]
            if not ring:
                return None
            for i, (rule, part, step, reading, group) in enumerate(wanted):
                window = [p for t, p in ring.items() if tick - reading.seconds < t <= tick] if tick % step == 0 else []
                if window and window != before[i][0]:
                    before[i] = (window, self._value(reading, window))
                if window and (found := before[i][1]) is not None:
                    if rule in self.lone:
                        out.alone(rule, group, tick, found[0])
                    else:
                        out.rows.append((tick, rule, part, group, *found))
            tick += self.base
        return tick

    def _value(self, reading: Reading, window: list[tuple]) -> tuple[float, int] | None:
        if reading.kind == "last":
            return max(window, key=lambda p: p[1])[2], 1
        if reading.kind == "average":
            return sum(p[3] for p in window), sum(p[4] for p in window)
        if reading.kind == "quantile":
            counts = [sum(p[5][self.bounds.index(b)] for p in window) for b in reading.bounds]
            value = estimated(counts, sum(p[4] for p in window), reading.bounds, reading.quantile)
            return None if value is None else (value, 1)
        increase = sum(p[0] for p in window)
        return (increase / reading.seconds if reading.kind == "rate" else increase), 1

    def _store(self, held: dict[tuple[str, str], tuple]) -> None:
        following = [f for _, f, _ in held.values() if f is not None]
        self.keep(held, min(following) * 1000 if following else None)


class Found:
    """Readings of a call: rows that are added up with others, and those of a lone rule and series, which travel together."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.lone: dict[tuple[str, str], tuple[list[int], list[float]]] = {}

    def alone(self, rule: str, labels: str, tick: int, value: float) -> None:
        ticks, values = self.lone.setdefault((rule, labels), ([], []))
        ticks.append(tick)
        values.append(value)

    def frames(self) -> Iterator[pd.DataFrame]:
        rows = [(*r, None, None) for r in self.rows] + [(ticks[-1], rule, 0, labels, None, None, ticks, values) for (rule, labels), (ticks, values) in self.lone.items()]
        if rows:
            frame = pd.DataFrame(rows, columns=["tick", "rule", "part", "labels", "total", "members", "ticks", "totals"])
            frame["members"] = frame["members"].astype("Int64")
            frame.insert(0, "event_time", pd.to_datetime(frame.pop("tick") * 1_000_000 - 1, unit="us", utc=True))
            yield frame


class RuleState(Bucketed):
    """PENDING when a rule's condition turns true for a label set, FIRING once it has held, RESOLVED when a firing one ends.

    A condition ends with a grid time at which it doesn't hold or that is missing; such rows need not come, a timer notices. What is
    remembered of a rule and label set whose condition holds: since when, the last grid time, whether it fires, its value.
    """

    def __init__(self, rules: Sequence[AlertRule]) -> None:
        self.times = {r.name: (r.hold_seconds, r.step) for r in rules}

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = self.load()
        for row in initialState.itertuples(index=False):
            held[row.rule, row.labels] = (int(row.since), int(row.seen), bool(row.firing), row.value)
        self._store(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, out = self.load(), []
        frame = pd.concat(list(rows)).sort_values("tick")
        for rule, labels, tick, value, active in zip(*[frame[c].tolist() for c in ("rule", "labels", "tick", "value", "active")]):
            own, (hold, step) = (rule, labels), self.times[rule]
            if own in held and (not active or tick - held[own][1] > step):
                self._ended(own, held.pop(own), out)
            if active:
                if own not in held:
                    held[own] = (tick, tick, False, value)
                    out.append((*own, "PENDING", tick, tick, value))
                since, _, firing, _ = held[own]
                if not firing and tick - since >= hold:
                    firing = True
                    out.append((*own, "FIRING", since, tick, value))
                held[own] = (since, tick, firing, value)
        self._store(held)
        yield from self._events(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, out, now = self.load(), [], timerValues.getCurrentWatermarkInMs()
        # A grid time is known once the watermark has passed it; a later row of this batch has moved ``seen`` on.
        for own in [k for k, state in held.items() if now >= self._due(k, state)]:
            self._ended(own, held.pop(own), out)
        self._store(held)
        yield from self._events(out)

    def _due(self, own: tuple[str, str], state: tuple) -> int:
        return (state[1] + self.times[own[0]][1]) * 1000

    def _ended(self, own: tuple[str, str], state: tuple, out: list[tuple]) -> None:
        since, seen, firing, value = state
        if firing:
            out.append((*own, "RESOLVED", since, seen + self.times[own[0]][1], value))

    def _store(self, held: dict[tuple[str, str], tuple]) -> None:
        self.keep(held, min((self._due(k, state) for k, state in held.items()), default=None))

    @staticmethod
    def _events(out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            frame = pd.DataFrame(out, columns=["rule", "labels", "state", "since", "at", "value"])
            for c in ("since", "at"):
                frame[c] = pd.to_datetime(frame[c], unit="s", utc=True)
            yield frame


def rule_values(read: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """(rule, labels, event_time, tick, value, active): readings put together, a row per rule, label set and grid time whose condition holds.

    Readings of lone rules are part of the grouping key: they are added to nothing, and the sums stay in a hash aggregate.
    """
    most = max(len(r.expression.readings) for r in rules)
    own = [F.when(F.col("part") == i, F.col(c)) for i in range(most) for c in ("total", "members")]
    names = [f"{c}{i}" for i in range(most) for c in ("total", "members")]
    met = read.groupBy(F.window("event_time", f"{base_step(rules)} seconds").alias("w"), "rule", "labels", "ticks", "totals").agg(*[F.sum(c).alias(n) for n, c in zip(names, own)])
    together = F.struct(F.unix_timestamp("w.end").alias("tick"), F.col("total0").alias("total"), F.col("members0").alias("members"))
    alone = F.transform(F.arrays_zip("ticks", "totals"), lambda r: F.struct(r["ticks"].alias("tick"), r["totals"].alias("total"), F.lit(1).cast("long").alias("members")))
    met = met.select("rule", "labels", F.window_time("w").alias("event_time"), F.explode(F.coalesce(alone, F.array(together))).alias("r"), *names[2:]).select(
        "rule", "labels", "event_time", F.timestamp_seconds("r.tick").alias("eval_ts"), F.col("r.total").alias("total0"), F.col("r.members").alias("members0"), *names[2:])
    value, active = F.lit(None).cast("double"), F.lit(False)
    for rule in rules:
        parts = [F.col(f"total{i}") / F.col(f"members{i}") if r.fold == "avg" else F.col(f"total{i}") for i, r in enumerate(rule.expression.readings)]
        value = F.when(F.col("rule") == rule.name, rule.expression.combine(F.col("eval_ts"), parts).cast("double")).otherwise(value)
        active = F.when(F.col("rule") == rule.name, OPERATORS[rule.operator](F.col("value"), rule.threshold)).otherwise(active)
    met = met.withColumn("value", value)
    return met.select("rule", "labels", "event_time", F.unix_timestamp("eval_ts").alias("tick"), "value", active.alias("active")).where("active")


def rule_alerts(samples: DataFrame, rules: Sequence[AlertRule], delay: str = METRIC_DELAY, history: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(rule, labels, state, since, at, value): changes of state of all rules over a stream of samples.

    ``samples`` as from ``alerts.sample_table``; ``labels`` come out as JSON text. ``history``: the memories that
    ``state_before`` has computed from the samples before the stream. Samples without a value and metrics that no rule
    names are left out; a sample later than ``delay`` is dropped by the watermark. Two rules of one name are refused.
    """
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("rules need different names")
    use_rocksdb(samples.sparkSession)
    series, memory = history or (None, None)

    def dealt(df: DataFrame, *key: str) -> GroupedData:
        return df.withColumn("bucket", bucket_of(*key)).groupBy("bucket")

    read = dealt(step_partials(samples, rules, delay), "metric", "labels").transformWithStateInPandas(
        Windows(read_metrics(rules), bounds_of(rules), base_step(rules), lone_rules(rules)), outputStructType=READ, outputMode="Append", timeMode="EventTime",
        initialState=None if series is None else dealt(series, "metric", "labels"), eventTimeColumnName="event_time")
    return dealt(rule_values(read, rules), "rule", "labels").transformWithStateInPandas(
        RuleState(rules), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime",
        initialState=None if memory is None else dealt(memory, "rule", "labels"))


def state_before(samples: DataFrame, rules: Sequence[AlertRule], until: Column) -> tuple[DataFrame, DataFrame]:
    """Memories of the series and of the rules at ``until`` (seconds of the epoch, on every rule's grid), from samples in batch.

    Series: their steps in the longest window, or the last step, with increases counted from all samples before.
    Rules: the conditions that hold at their newest grid time.
    """
    base, metrics, bounds, until = base_step(rules), read_metrics(rules), bounds_of(rules), until.cast("long")
    longest = max(r.seconds for own in metrics.values() for *_, r in own)
    known = samples.where(F.col("metric").isin(*metrics) & F.col("value").isNotNull() & (F.unix_micros("ts") <= until * 1_000_000))
    grown = counter_increases(known, ["metric", "labels"], ties=["value"])
    steps = grown.withColumn("tick", step_end("ts", base)).groupBy("metric", "labels", "tick").agg(
        F.sum("increase").alias("increase"), F.unix_micros(F.max("ts")).alias("last_at"), F.max(F.struct("ts", "value"))["value"].alias("value"),
        F.sum("value").alias("total"), F.count("*").alias("n"), *[F.count_if(F.col("value") <= b).alias(f"c{i}") for i, b in enumerate(bounds)])
    newest = F.max("tick").over(Window.partitionBy("metric", "labels"))  # one row per step
    kept = steps.withColumn("newest", newest).where((F.col("tick") > until - longest) | (F.col("tick") == F.col("newest")))
    series = kept.select(
        "metric", json_labels(F.col("labels")).alias("labels"), F.col("tick").cast("long").alias("tick"), "increase", "last_at", "value", "total", "n",
        F.array(*[F.col(f"c{i}") for i in range(len(bounds))]).cast("array<long>").alias("counts"), (until + base).cast("long").alias("next"))
    memory = None
    for rule in rules:
        on = condition(rule, known).where("active").withColumn("tick", F.unix_timestamp("eval_ts")).where(F.col("tick") <= until)
        w = Window.partitionBy("labels").orderBy("tick")
        fresh = on.withColumn("new", F.coalesce(F.col("tick") - F.lag("tick").over(w) > rule.step, F.lit(True)))
        last = fresh.groupBy("labels").agg(F.max(F.when(F.col("new"), F.col("tick"))).alias("since"), F.max("tick").alias("seen"), F.max_by("value", "tick").alias("value"))
        own = last.where(F.col("seen") == until).select(
            F.lit(rule.name).alias("rule"), json_labels(F.col("labels")).alias("labels"), "since", "seen",
            (F.col("seen") - F.col("since") >= rule.hold_seconds).alias("firing"), F.col("value").cast("double").alias("value"))
        memory = own if memory is None else memory.union(own)
    return series, memory
