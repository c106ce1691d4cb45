"""Registered queries on service metrics. Events serve as samples: their type is the metric, their user a label."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import alerts, metrics
from tickloom.plans import datasets
from tickloom.plans.registry import query, rounded, rsql, second_sql

BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def events(spark, folder):
    return datasets.table(spark, folder, "events")


@query("event_counters", f"SELECT event_type, user_id, count(*) AS samples, {rsql('sum(value)', 4)} AS total FROM events GROUP BY event_type, user_id")
def event_counters(spark, folder):
    return rounded(metrics.counters(events(spark, folder), ["event_type", "user_id"]), {"total": 4})


@query("event_gauges", f"""SELECT event_type, user_id, {second_sql('max(ts)')} AS last_seen, arg_max(value, ts) AS value FROM events GROUP BY event_type, user_id""")
def event_gauges(spark, folder):
    return metrics.gauges(events(spark, folder), ["event_type", "user_id"])


LE_SQL = " UNION ALL ".join(
    [f"SELECT event_type, '{b}' AS le, count(*) FILTER (value <= {b}) AS count FROM events GROUP BY event_type" for b in BOUNDS]
    + ["SELECT event_type, '+Inf', count(*) FROM events GROUP BY event_type"])


@query("latency_buckets", LE_SQL)
def latency_buckets(spark, folder):
    rows = metrics.bucket_rows(metrics.histogram(events(spark, folder), ["event_type"], BOUNDS), ["event_type"])
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string")))


@query("histogram_totals", f"SELECT event_type, {rsql('sum(value)', 3)} AS sum, count(*) AS count FROM events GROUP BY event_type")
def histogram_totals(spark, folder):
    return rounded(metrics.histogram(events(spark, folder), ["event_type"], BOUNDS).drop("buckets"), {"sum": 3})


def _quantile_sql(q: float) -> str:
    """Linear inside the first bucket that reaches the rank; the top bucket gives its lower bound."""
    cases, low, below = [], "0", "0"
    for i, b in enumerate(BOUNDS):
        cases.append(f"WHEN b{i} >= {q}::DOUBLE * n THEN {low} + ({b} - {low}) * (({q}::DOUBLE * n - {below}) / (b{i} - {below}))")
        low, below = f"{b}::DOUBLE", f"b{i}"
    return f"CASE {' '.join(cases)} ELSE {BOUNDS[-1]} END"


COUNTS_SQL = ", ".join(f"count(*) FILTER (value <= {b}) AS b{i}" for i, b in enumerate(BOUNDS)) + ", count(*) AS n"


@query("bucket_quantile", f"WITH c AS (SELECT event_type, {COUNTS_SQL} FROM events GROUP BY event_type) SELECT event_type, "
       + ", ".join(f"{rsql(_quantile_sql(q), 4)} AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99)) + " FROM c")
def bucket_quantile(spark, folder):
    h = metrics.histogram(events(spark, folder), ["event_type"], BOUNDS)
    out = h.select("event_type", *[metrics.bucket_quantile(F.col("buckets"), q).alias(f"p{round(q * 100)}") for q in (0.5, 0.95, 0.99)])
    return rounded(out, {"p50": 4, "p95": 4, "p99": 4})


def _latency_sql(kept: str) -> str:
    point = "list_sort(list(value))[CAST(floor(count(*) * {q}::DOUBLE) AS BIGINT) + 1]"
    return f"""WITH t AS (SELECT event_type, count(*) AS total_requests, count(*) FILTER (value > 100) AS error_count FROM events GROUP BY event_type),
  k AS ({kept}), s AS (SELECT event_type, min(value) AS min_latency, max(value) AS max_latency, {rsql('avg(value)', 6)} AS mean_latency,
    {point.format(q=0.5)} AS median_latency, {point.format(q=0.95)} AS p95_latency, {point.format(q=0.99)} AS p99_latency FROM k GROUP BY event_type)
  SELECT t.event_type, total_requests, error_count, {rsql('error_count::DOUBLE / total_requests', 8)} AS error_rate, s.* EXCLUDE (event_type) FROM t JOIN s ON t.event_type = s.event_type"""


def _latency(spark, folder, keep):
    out = metrics.latency_stats(events(spark, folder), ["event_type"], "value", F.col("value") > 100, ["ts", "event_id"], keep)
    return rounded(out, {"mean_latency": 6, "error_rate": 8})


@query("latency_index_stats", _latency_sql("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 1000"))
def latency_index_stats(spark, folder):
    return _latency(spark, folder, metrics.KEPT_REQUESTS)


@query("latency_index_all", _latency_sql("SELECT * FROM events"))
def latency_index_all(spark, folder):
    return _latency(spark, folder, None)


@query("service_stats", f"""SELECT user_id, count(*) AS requests, count(*) FILTER (event_type = 'error') AS errors,
  {rsql("(epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6", 6)} AS uptime_seconds, {rsql("count(*) FILTER (event_type = 'error')::DOUBLE / count(*)", 8)} AS error_rate,
  {rsql("coalesce(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 0)", 8)} AS request_rate FROM events GROUP BY user_id""")
def service_stats(spark, folder):
    out = metrics.service_stats(events(spark, folder), ["user_id"], F.col("event_type") == "error")
    return rounded(out, {"uptime_seconds": 6, "error_rate": 8, "request_rate": 8})


INCREASE_SQL = """inc AS (SELECT event_type, ts, event_id, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS increase
  FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM events))"""


@query("counter_increase", f"WITH {INCREASE_SQL} SELECT event_id, event_type, {rsql('increase', 4)} AS increase FROM inc")
def counter_increase(spark, folder):
    out = metrics.counter_increases(events(spark, folder), ["event_type"], ties=["event_id"])
    return rounded(out.select("event_id", "event_type", "increase"), {"increase": 4})


def _windows_sql(source: str, seconds: int, step: int) -> str:
    return f"""win AS (SELECT *, make_timestamp(CAST((ceil(epoch_us(ts) / {step}e6) + k) * {step} * 1000000 AS BIGINT)) AS tick
    FROM {source}, (SELECT unnest(range({seconds // step})) AS k))"""


@query("counter_rate", f"""WITH {INCREASE_SQL}, {_windows_sql('inc', 300, 60)} SELECT event_type, {second_sql('tick')} AS eval_ts, {rsql('sum(increase)', 4)} AS increase,
  {rsql('sum(increase) / 300', 7)} AS rate FROM win GROUP BY event_type, tick""")
def counter_rate(spark, folder):
    inc = metrics.counter_increases(events(spark, folder), ["event_type"], ties=["event_id"])
    return rounded(metrics.rate(inc, ["event_type"], 300, 60), {"increase": 4, "rate": 7})


@query("error_ratio", f"""WITH {_windows_sql('events', 3600, 600)} SELECT {second_sql('tick')} AS eval_ts, count(*) FILTER (event_type = 'error') AS top, count(*) AS bottom,
  {rsql("count(*) FILTER (event_type = 'error')::DOUBLE / count(*)", 8)} AS ratio FROM win GROUP BY tick""")
def error_ratio(spark, folder):
    out = metrics.ratio_in_one_pass(events(spark, folder), [], F.col("event_type") == "error", F.col("event_type").isNotNull(), 3600, 600)
    return rounded(out.select("eval_ts", F.col("top").cast("bigint"), F.col("bottom").cast("bigint"), "ratio"), {"ratio": 8})


@query("windowed_quantiles", f"""WITH {_windows_sql('events', 3600, 900)}, c AS (SELECT event_type, tick, {COUNTS_SQL} FROM win GROUP BY event_type, tick)
  SELECT event_type, {second_sql('tick')} AS eval_ts, """ + ", ".join(f"{rsql(_quantile_sql(q), 4)} AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99)) + " FROM c")
def windowed_quantiles(spark, folder):
    out = metrics.windowed_quantiles(events(spark, folder), ["event_type"], BOUNDS, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, 3600, 900)
    return rounded(out, {"p50": 4, "p95": 4, "p99": 4})


@query("label_match", """SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS user, count(*) AS samples, round(sum(value), 4) + 0.0 AS total FROM events
  WHERE event_type = 'error' AND regexp_full_match(CAST(user_id AS VARCHAR), '1[0-9]|7') GROUP BY 1, 2""")
def label_match(spark, folder):
    s = alerts.sample_table(datasets.metric_samples(spark, folder))
    hit = s.where((F.col("metric") == "error") & metrics.matches(F.col("labels"), regex={"user": "1[0-9]|7"}))
    out = metrics.counters(hit.withColumn("user", metrics.label(F.col("labels"), "user")), ["metric", "user"])
    return rounded(out, {"total": 4})


RULE = alerts.AlertRule("SlowErrors", alerts.average_of("error", 3600), ">", 30, 1800, "warning", 600)


@query("sustained_alerts", f"""WITH {_windows_sql("(SELECT * FROM events WHERE event_type = 'error')", 3600, 600)}, c AS (SELECT tick, avg(value) AS v FROM win GROUP BY tick),
  a AS (SELECT *, CASE WHEN tick - lag(tick) OVER (ORDER BY tick) <= INTERVAL 600 SECOND THEN 0 ELSE 1 END AS fresh FROM c WHERE v > 30),
  i AS (SELECT *, sum(fresh) OVER (ORDER BY tick) AS island FROM a)
  SELECT 'SlowErrors' AS rule, 'warning' AS severity, {second_sql('min(tick)')} AS active_since, {second_sql('max(tick)')} AS active_until,
  {rsql('arg_max(v, tick)', 9)} AS last_value, {second_sql("min(tick) + INTERVAL 1800 SECOND")} AS firing_since FROM i GROUP BY island HAVING max(tick) - min(tick) >= INTERVAL 1800 SECOND""")
def sustained_alerts(spark, folder):
    out = alerts.evaluate([RULE], alerts.sample_table(datasets.metric_samples(spark, folder)))
    return rounded(out.drop("labels"), {"last_value": 9})


HIGH_VALUE = alerts.AlertRule("HighValue", alerts.instant("purchase"), ">", 60, 120, "info", 60)


@query("gauge_alerts", f"""WITH w0 AS (SELECT user_id, value, ts, make_timestamp(CAST((ceil(epoch_us(ts) / 60e6) + k) * 60 * 1000000 AS BIGINT)) AS tick
    FROM events, (SELECT unnest(range(5)) AS k) WHERE event_type = 'purchase'),
  c AS (SELECT user_id, tick, arg_max(value, ts) AS v FROM w0 GROUP BY user_id, tick),
  a AS (SELECT *, CASE WHEN tick - lag(tick) OVER u <= INTERVAL 60 SECOND THEN 0 ELSE 1 END AS fresh FROM c WHERE v > 60 WINDOW u AS (PARTITION BY user_id ORDER BY tick)),
  i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY tick) AS island FROM a)
  SELECT CAST(user_id AS VARCHAR) AS user, {second_sql('min(tick)')} AS active_since, {second_sql('max(tick)')} AS active_until, arg_max(v, tick) AS last_value
  FROM i GROUP BY user_id, island HAVING max(tick) - min(tick) >= INTERVAL 120 SECOND""")
def gauge_alerts(spark, folder):
    out = alerts.evaluate([HIGH_VALUE], alerts.sample_table(datasets.metric_samples(spark, folder)))
    return out.select(metrics.label(F.col("labels"), "user").alias("user"), "active_since", "active_until", "last_value")


def _silence_sql(key: str, quiet: int, total: int) -> str:
    return f"""WITH g AS (SELECT {key}, lag(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS last_seen, ts, ts AS until FROM events
    UNION ALL SELECT {key}, max(ts), NULL, (SELECT max(ts) FROM events) FROM events GROUP BY {key})
  SELECT {key}, {second_sql('last_seen')} AS last_seen, {second_sql(f'last_seen + INTERVAL {quiet} SECOND')} AS pending_at,
  {second_sql(f'last_seen + INTERVAL {total} SECOND')} AS firing_at, {second_sql('ts')} AS resolved_at FROM g WHERE until - last_seen >= INTERVAL {total} SECOND"""


@query("absence_alerts", _silence_sql("event_type", 600, 1500))
def absence_alerts(spark, folder):
    return metrics.absence_periods(events(spark, folder), ["event_type"], 600, 900, ties=["event_id"])


@query("absence_of_users", _silence_sql("user_id", 86400, 172800))
def absence_of_users(spark, folder):
    """Silences of two days, those that are still open included."""
    return metrics.absence_periods(events(spark, folder), ["user_id"], 86400, 86400, ties=["event_id"])
