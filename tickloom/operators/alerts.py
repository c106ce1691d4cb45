"""Alert rules as data: an expression over samples, a threshold, and how long it must hold.

Every expression yields (labels, eval_ts, value) on a grid of evaluation times. A series has one row per grid time,
whatever the number of samples, so the islands of a condition are ordered over the clock and not over the data.

An expression also says what it reads and how the readings combine, so that :mod:`tickloom.streaming.rules` can
evaluate the same rules on a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.metrics import BUCKETS, counter_increases, label_set, matches, rate, sliding, windowed_quantiles

STALENESS = 300


@dataclass(frozen=True)
class Reading:
    """What an expression takes from one metric: series read over a window, perhaps put together by some of their labels.

    ``kind``: last, rate, increase, average or quantile. ``by``: labels that stay, None for a series of its own.
    """

    metric: str
    kind: str
    seconds: int
    equal: tuple[tuple[str, str], ...] = ()
    regex: tuple[tuple[str, str], ...] = ()
    by: tuple[str, ...] | None = None
    fold: str = "sum"
    quantile: float = 0.0
    bounds: tuple[float, ...] = ()


@dataclass(frozen=True)
class Expression:
    """``run(samples, step)`` gives the values in batch; ``combine(eval_ts, values)`` gives them from those of the readings."""

    run: Callable[[DataFrame, int], DataFrame] = field(repr=False)
    readings: tuple[Reading, ...]
    combine: Callable[[Column, Sequence[Column]], Column] = field(default=lambda at, values: values[0], repr=False)

    def __call__(self, samples: DataFrame, step: int) -> DataFrame:
        return self.run(samples, step)


def _pairs(labels: Mapping[str, str] | None) -> tuple[tuple[str, str], ...]:
    return tuple(sorted((labels or {}).items()))


def sample_table(df: DataFrame, ts: str = "ts", metric: str = "metric", labels: str = "labels", value: str = "value") -> DataFrame:
    """Samples with their labels as a sorted array."""
    return df.select(F.col(ts).cast("timestamp").alias("ts"), F.col(metric).alias("metric"),
                     label_set(F.col(labels)).alias("labels"), F.col(value).cast("double").alias("value"))


def _select(samples: DataFrame, metric: str, equal: Mapping[str, str] | None, regex: Mapping[str, str] | None) -> DataFrame:
    return samples.where((F.col("metric") == metric) & matches(F.col("labels"), equal, regex)).drop("metric")


def instant(metric: str, equal: Mapping[str, str] | None = None, regex: Mapping[str, str] | None = None, seconds: int = STALENESS) -> Expression:
    """Last value not older than ``seconds``."""

    def run(samples: DataFrame, step: int) -> DataFrame:
        return sliding(
            _select(samples, metric, equal, regex), ["labels"], seconds, step,
            {"t": F.max("ts"), "v": F.max_by("value", "ts")}, {"value": F.max_by("v", "t")},
        ).select("labels", "eval_ts", "value")

    return Expression(run, (Reading(metric, "last", seconds, _pairs(equal), _pairs(regex)),))


def _over(metric: str, seconds: int, equal: Mapping[str, str] | None, column: str) -> Expression:
    def run(samples: DataFrame, step: int) -> DataFrame:
        grown = counter_increases(_select(samples, metric, equal, None), ["labels"], ties=["value"])
        return rate(grown, ["labels"], seconds, step).select("labels", "eval_ts", F.col(column).alias("value"))

    return Expression(run, (Reading(metric, column, seconds, _pairs(equal)),))


def rate_of(metric: str, seconds: int = 300, equal: Mapping[str, str] | None = None) -> Expression:
    return _over(metric, seconds, equal, "rate")


def increase_of(metric: str, seconds: int, equal: Mapping[str, str] | None = None) -> Expression:
    return _over(metric, seconds, equal, "increase")


def quantile_of(metric: str, q: float, seconds: int = 300, equal: Mapping[str, str] | None = None,
                bounds: Sequence[float] | None = None) -> Expression:
    """Quantile of observed values from the buckets of their metric."""

    def run(samples: DataFrame, step: int) -> DataFrame:
        return windowed_quantiles(_select(samples, metric, equal, None), ["labels"], bounds or BUCKETS[metric], {"value": q}, seconds, step)

    return Expression(run, (Reading(metric, "quantile", seconds, _pairs(equal), quantile=q, bounds=tuple(bounds or BUCKETS[metric])),))


def average_of(metric: str, seconds: int = 300) -> Expression:
    def run(samples: DataFrame, step: int) -> DataFrame:
        out = sliding(_select(samples, metric, None, None), ["labels"], seconds, step,
                      {"s": F.sum("value"), "n": F.count("value")}, {"s": F.sum("s"), "n": F.sum("n")})
        return _by(out.groupBy(F.array().cast("array<struct<key:string,value:string>>").alias("labels"), "eval_ts")
                   .agg(F.try_divide(F.sum("s"), F.sum("n").cast("double")).alias("value")))

    return Expression(run, (Reading(metric, "average", seconds, by=(), fold="avg"),))


def _by(df: DataFrame) -> DataFrame:
    return df.select("labels", "eval_ts", "value")


def grouped(expr: Expression, how: str, by: Sequence[str] = ()) -> Expression:
    """``sum`` or ``avg`` of an expression by some of its labels."""
    fold = {"sum": F.sum, "avg": F.avg}[how]

    def run(samples: DataFrame, step: int) -> DataFrame:
        out = expr(samples, step)
        kept = F.filter("labels", lambda e: e["key"].isin(*by)) if by else F.filter("labels", lambda e: F.lit(False))
        return _by(out.withColumn("labels", kept).groupBy("labels", "eval_ts").agg(fold("value").alias("value")))

    (reading,) = expr.readings
    if reading.by is not None or reading.kind == "quantile":
        raise ValueError("only the series of one metric can be grouped, and no quantiles")
    return Expression(run, (replace(reading, by=tuple(by), fold=how),), expr.combine)


def matched(a: Expression, b: Expression, rule: Callable[[Column, Column], Column]) -> Expression:
    """Two expressions met on equal labels and time."""

    def run(samples: DataFrame, step: int) -> DataFrame:
        right = b(samples, step).withColumnRenamed("value", "other")
        return a(samples, step).join(right, ["labels", "eval_ts"]).select(
            "labels", "eval_ts", rule(F.col("value"), F.col("other")).alias("value"))

    return _of_two(run, a, b, rule)


def _of_two(run: Callable[[DataFrame, int], DataFrame], a: Expression, b: Expression, rule: Callable[[Column, Column], Column]) -> Expression:
    n = len(a.readings)
    return Expression(run, a.readings + b.readings, lambda at, v: rule(a.combine(at, v[:n]), b.combine(at, v[n:])))


def ratio(a: Expression, b: Expression) -> Expression:
    return matched(a, b, lambda x, y: F.try_divide(x, y))


def both(a: Expression, b: Expression, b_holds: Callable[[Column], Column]) -> Expression:
    """Values of ``a`` where ``b`` has an equal series that holds."""

    def run(samples: DataFrame, step: int) -> DataFrame:
        other = b(samples, step).where(b_holds(F.col("value"))).select("labels", "eval_ts")
        return a(samples, step).join(other, ["labels", "eval_ts"], "left_semi")

    return _of_two(run, a, b, lambda x, y: F.when(b_holds(y), x))


def mapped(a: Expression, f: Callable[[Column], Column]) -> Expression:
    def run(samples: DataFrame, step: int) -> DataFrame:
        return a(samples, step).withColumn("value", f(F.col("value")))

    return Expression(run, a.readings, lambda at, v: f(a.combine(at, v)))


def age_of(metric: str) -> Expression:
    """Seconds between the evaluation and a gauge that holds a time."""

    last = instant(metric)

    def run(samples: DataFrame, step: int) -> DataFrame:
        return last(samples, step).withColumn("value", F.unix_timestamp("eval_ts") - F.col("value"))

    return Expression(run, last.readings, lambda at, v: F.unix_timestamp(at) - v[0])


OPERATORS: dict[str, Callable[[Column, float], Column]] = {
    ">": lambda v, t: v > t, "<": lambda v, t: v < t, "==": lambda v, t: v == t, "!=": lambda v, t: v != t,
}


@dataclass(frozen=True)
class AlertRule:
    name: str
    expression: Expression = field(repr=False)
    operator: str
    threshold: float
    hold_seconds: int
    severity: str
    step: int = 30


def condition(rule: AlertRule, samples: DataFrame) -> DataFrame:
    """The rule at every grid time where its expression has a value."""
    out = rule.expression(samples, rule.step)
    return out.select(
        F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"), "labels", "eval_ts", "value",
        F.coalesce(OPERATORS[rule.operator](F.col("value"), rule.threshold), F.lit(False)).alias("active"),
        F.lit(rule.hold_seconds).alias("hold_seconds"), F.lit(rule.step).alias("step"),
    )


def sustained(conditions: DataFrame, keys: Sequence[str] = ("rule", "labels")) -> DataFrame:
    """Unbroken active periods that lasted at least ``hold_seconds``. A missing grid time breaks a period."""
    w = Window.partitionBy(*keys).orderBy("eval_ts")
    on = conditions.where("active")
    fresh = F.unix_timestamp("eval_ts") - F.lag(F.unix_timestamp("eval_ts")).over(w) > F.col("step")
    marked = on.withColumn("__new", F.coalesce(fresh, F.lit(True)).cast("int"))
    numbered = marked.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy(*keys, "__island").agg(
        F.min("eval_ts").alias("active_since"), F.max("eval_ts").alias("active_until"), F.max("hold_seconds").alias("hold_seconds"),
        F.max_by("value", "eval_ts").alias("last_value"),
    )
    lasted = F.unix_timestamp("active_until") - F.unix_timestamp("active_since")
    return spans.where(lasted >= F.col("hold_seconds")).withColumn(
        "firing_since", F.timestamp_seconds(F.unix_timestamp("active_since") + F.col("hold_seconds"))
    ).drop("__island", "hold_seconds")


def evaluate(rules: Sequence[AlertRule], samples: DataFrame) -> DataFrame:
    """Alerts of all rules as one table."""
    out = None
    for rule in rules:
        part = sustained(condition(rule, samples), ("rule", "severity", "labels"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no rules")
    return out


def platform_rules(api_job: str, data_mount: str = "/var/lib/postgresql/data") -> list[AlertRule]:
    """The monitored platform's rules. Names, metrics, thresholds, hold times and severities."""
    minute, hour, day = 60, 3600, 86400
    errors, served = rate_of("prediction_errors_total"), rate_of("predictions_total")
    hits, misses = rate_of("cache_hits_total"), rate_of("cache_misses_total")
    idle = grouped(rate_of("node_cpu_seconds_total", equal={"mode": "idle"}), "avg", ["instance"])
    free_memory = ratio(instant("node_memory_MemAvailable_bytes"), instant("node_memory_MemTotal_bytes"))
    disk_size = instant("node_filesystem_size_bytes")
    broken = instant("kube_pod_status_phase", regex={"phase": "Failed|Unknown"})
    ready = instant("kube_node_status_condition", {"condition": "Ready", "status": "true"})
    replicas = matched(instant("kube_statefulset_status_replicas_ready"), instant("kube_statefulset_status_replicas"), lambda a, b: a - b)

    def total(e: Expression) -> Expression:
        return grouped(e, "sum")

    return [
        AlertRule("APIServiceDown", instant("up", {"job": api_job}), "==", 0, 2 * minute, "critical"),
        AlertRule("HighErrorRate", ratio(total(errors), total(served)), ">", 0.05, 5 * minute, "warning"),
        AlertRule("HighLatency", quantile_of("http_requests_duration_seconds", 0.95, equal={"job": api_job}), ">", 1, 5 * minute, "warning"),
        AlertRule("PredictionCacheHitRateLow", ratio(hits, matched(hits, misses, lambda a, b: a + b)), "<", 0.5, 10 * minute, "info"),
        AlertRule("PostgreSQLDown", instant("up", {"job": "postgres"}), "==", 0, minute, "critical"),
        AlertRule("PostgreSQLHighConnections", instant("pg_stat_activity_count"), ">", 80, 5 * minute, "warning"),
        AlertRule("PostgreSQLSlowQueries", rate_of("pg_stat_statements_total_time"), ">", 1000, 5 * minute, "warning"),
        AlertRule("PostgreSQLDiskSpace", ratio(instant("node_filesystem_avail_bytes", {"mountpoint": data_mount}), disk_size), "<", 0.1, 10 * minute, "critical"),
        AlertRule("RedisDown", instant("up", {"job": "redis"}), "==", 0, minute, "warning"),
        AlertRule("RedisHighMemoryUsage", ratio(instant("redis_memory_used_bytes"), instant("redis_memory_max_bytes")), ">", 0.8, 5 * minute, "warning"),
        AlertRule("RedisEvictions", rate_of("redis_evicted_keys_total"), ">", 0, 5 * minute, "warning"),
        AlertRule("ModelInferenceTimeHigh", quantile_of("model_inference_duration_seconds", 0.95), ">", 0.5, 5 * minute, "warning"),
        AlertRule("ModelPredictionConfidenceLow", average_of("model_prediction_confidence"), "<", 0.7, 10 * minute, "info"),
        AlertRule("HighCPUUsage", mapped(idle, lambda v: 1 - v), ">", 0.8, 5 * minute, "warning"),
        AlertRule("HighMemoryUsage", mapped(free_memory, lambda v: 1 - v), ">", 0.85, 5 * minute, "warning"),
        AlertRule("DiskSpaceLow", ratio(instant("node_filesystem_avail_bytes"), disk_size), "<", 0.1, 10 * minute, "critical"),
        AlertRule("KubernetesNodeNotReady", ready, "==", 0, 5 * minute, "critical"),
        AlertRule("KubernetesPodCrashLooping", rate_of("kube_pod_container_status_restarts_total", 900), ">", 0.1, 5 * minute, "warning"),
        AlertRule("KubernetesPodNotHealthy", both(mapped(broken, lambda v: (v == 1).cast("double")), broken, lambda v: v > 0), ">", 0, 5 * minute, "warning"),
        AlertRule("KubernetesStatefulsetReplicasMismatch", replicas, "!=", 0, 5 * minute, "warning"),
        AlertRule("NoNewPredictions", increase_of("predictions_total", 600), "==", 0, 15 * minute, "warning", 60),
        AlertRule("ModelVersionStale", age_of("model_version_timestamp_seconds"), ">", 7 * day, hour, "info", 60),
    ]
