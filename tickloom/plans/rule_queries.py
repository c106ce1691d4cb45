"""Registered queries of rules on live metrics: events as samples, their type the metric and their user a label."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import alerts
from tickloom.operators.alerts import AlertRule
from tickloom.plans.metric_queries import BOUNDS, COUNTS_SQL, _quantile_sql
from tickloom.plans.registry import query, rounded, rsql, second_sql
from tickloom.streaming import jobs, rules, stateful

MARK_US = "(SELECT (epoch_us(max(ts)) - 1) // 1000 * 1000 - 600000000 FROM events)"
HOUR = 3600
STEP = 600


def event_rules() -> list[AlertRule]:
    """A rule of each kind of expression that the platform's rules have."""
    click, errors, views = (alerts.rate_of(m, HOUR) for m in ("click", "error", "view"))
    bought, viewed = alerts.instant("purchase", seconds=HOUR), alerts.instant("view", seconds=HOUR)
    return [
        AlertRule("HighPurchase", bought, ">", 30, 1200, "warning", STEP),
        AlertRule("FastClicks", click, ">", 0.005, 1200, "warning", STEP),
        AlertRule("NoNewViews", alerts.increase_of("view", 2 * HOUR), "==", 0, 3000, "info", STEP),
        AlertRule("SlowErrors", alerts.average_of("error", HOUR), ">", 30, 1800, "warning", STEP),
        AlertRule("LongSignups", alerts.quantile_of("signup", 0.95, 2 * HOUR, bounds=BOUNDS), ">", 40, 600, "warning", STEP),
        AlertRule("ErrorShare", alerts.ratio(alerts.grouped(errors, "sum"), alerts.grouped(views, "sum")), ">", 1.5, 1200, "critical", STEP),
        AlertRule("CalmClicks", alerts.mapped(alerts.grouped(click, "avg"), lambda v: 1 - v), ">", 0.995, 1200, "info", 2 * STEP),
        AlertRule("Undecided", alerts.both(bought, viewed, lambda v: v > 10), ">", 0, 600, "info", STEP),
    ]


SAMPLES_SQL = """s0 AS (SELECT ts, event_type AS metric, '{"user":"' || user_id || '"}' AS labels, value, lag(value) OVER (PARTITION BY event_type, user_id ORDER BY ts, value) AS p FROM events),
  s AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS inc FROM s0)"""


def _read_sql(metric: str, value: str, seconds: int, step: int = STEP, labels: str = "labels") -> str:
    return f"""SELECT {labels} AS labels, (ceil(epoch_us(ts) / {step}e6)::BIGINT + k) * {step} AS tick, {value} AS v
    FROM s, (SELECT unnest(range({seconds // step})) AS k) WHERE metric = '{metric}' GROUP BY ALL"""


def _together(read: str, fold: str) -> str:
    return f"SELECT '{{}}' AS labels, tick, {fold}(v) AS v FROM ({read}) GROUP BY tick"


def _rates(metric: str, step: int = STEP) -> str:
    return _read_sql(metric, f"sum(inc) / {HOUR}", HOUR, step)


_QUANTILE = f"SELECT labels, tick, {_quantile_sql(0.95)} AS v FROM (SELECT labels, tick, unnest(v) FROM ({_read_sql('signup', 'struct_pack(' + ', '.join(x.split(' AS ')[1] + ' := ' + x.split(' AS ')[0] for x in COUNTS_SQL.split(', ')) + ')', 2 * HOUR)}))"
VALUES_SQL = {
    "HighPurchase": _read_sql("purchase", "arg_max(value, ts)", HOUR),
    "FastClicks": _rates("click"),
    "NoNewViews": _read_sql("view", "sum(inc)", 2 * HOUR),
    "SlowErrors": _read_sql("error", "avg(value)", HOUR, labels="'{}'"),
    "LongSignups": _QUANTILE,
    "ErrorShare": f"SELECT a.labels, a.tick, a.v / nullif(b.v, 0) AS v FROM ({_together(_rates('error'), 'sum')}) a JOIN ({_together(_rates('view'), 'sum')}) b USING (tick)",
    "CalmClicks": f"SELECT labels, tick, 1 - v AS v FROM ({_together(_rates('click', 2 * STEP), 'avg')})",
    "Undecided": f"""SELECT a.labels, a.tick, a.v FROM ({_read_sql('purchase', 'arg_max(value, ts)', HOUR)}) a
      JOIN ({_read_sql('view', 'arg_max(value, ts)', HOUR)}) b ON a.labels = b.labels AND a.tick = b.tick WHERE b.v > 10""",
}


def _rules_sql() -> str:
    parts = []
    for r in event_rules():
        test = {"==": "="}.get(r.operator, r.operator)
        parts.append(f"SELECT '{r.name}' AS rule, labels, tick, v, {r.hold_seconds} AS hold, {r.step} AS step FROM ({VALUES_SQL[r.name]}) WHERE v {test} {r.threshold}")
    return f"""WITH {SAMPLES_SQL}, c AS ({' UNION ALL '.join(parts)}),
  a AS (SELECT *, CASE WHEN tick - lag(tick) OVER w <= step THEN 0 ELSE 1 END AS fresh FROM c WHERE tick * 1000000 <= {MARK_US} WINDOW w AS (PARTITION BY rule, labels ORDER BY tick)),
  i AS (SELECT *, sum(fresh) OVER (PARTITION BY rule, labels ORDER BY tick) AS island FROM a),
  f AS (SELECT *, min(tick) OVER (PARTITION BY rule, labels, island) AS since FROM i),
  g AS (SELECT rule, labels, since, max(tick) AS last, any_value(step) AS step, any_value(hold) AS hold, arg_min(v, tick) AS v0, max(v) FILTER (tick = since + hold) AS v1, arg_max(v, tick) AS v2
    FROM f GROUP BY rule, labels, island, since),
  e AS (SELECT rule, labels, 'PENDING' AS state, since, since AS moment, v0 AS value FROM g UNION ALL SELECT rule, labels, 'FIRING', since, since + hold, v1 FROM g WHERE last - since >= hold
    UNION ALL SELECT rule, labels, 'RESOLVED', since, last + step, v2 FROM g WHERE last - since >= hold AND (last + step) * 1000000 <= {MARK_US})
  SELECT rule, labels, state, {second_sql('make_timestamp(since * 1000000)')} AS since, {second_sql('make_timestamp(moment * 1000000)')} AS at, {rsql('value', 6)} AS value FROM e"""


def _samples(spark, folder):
    e = jobs.file_stream(spark, folder, "events", "ts")
    return alerts.sample_table(e.select("ts", F.col("event_type").alias("metric"), F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"), "value"))


@query("stream_rules", _rules_sql())
def stream_rules(spark, folder):
    """Eight rules over one stream of samples, each sample read once."""
    return rounded(jobs.run_to_table(rules.rule_alerts(_samples(spark, folder), event_rules()), "stream-rules"), {"value": 6})


STALE_LIMIT, STALE_HOLD = 12 * HOUR, HOUR


@query("stream_staleness", f"""WITH m AS (SELECT user_id, epoch_us(ts) // 60000000 AS minute, epoch_us(max(ts)) AS seen, arg_max(epoch_us(ts) - CAST(floor(value) AS BIGINT) * 60000000, ts) AS held FROM events GROUP BY ALL),
  r AS (SELECT user_id, seen, held + {STALE_LIMIT}000000 AS due, lead(seen) OVER w AS until FROM m WHERE (minute + 1) * 60000000 <= {MARK_US} + 1 WINDOW w AS (PARTITION BY user_id ORDER BY seen)),
  t AS (SELECT user_id, seen, greatest(seen, due) AS since, coalesce(until, 9000000000000000) AS until FROM r WHERE due < coalesce(until, 9000000000000000)),
  n AS (SELECT *, CASE WHEN since = seen AND lag(until) OVER w = seen THEN 0 ELSE 1 END AS fresh FROM t WINDOW w AS (PARTITION BY user_id ORDER BY seen)),
  g AS (SELECT user_id, min(since) AS since, max(until) AS until FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY seen) AS island FROM n) GROUP BY user_id, island),
  e AS (SELECT user_id, 'PENDING' AS state, since, since AS moment FROM g WHERE since <= {MARK_US}
    UNION ALL SELECT user_id, 'FIRING', since, since + {STALE_HOLD}000000 FROM g WHERE since + {STALE_HOLD}000000 <= least(until, {MARK_US})
    UNION ALL SELECT user_id, 'RESOLVED', since, until FROM g WHERE since + {STALE_HOLD}000000 <= until AND until < 9000000000000000)
  SELECT CAST(user_id AS VARCHAR) AS series, state, {second_sql('make_timestamp(since)')} AS since, {second_sql('make_timestamp(moment)')} AS at FROM e""")
def stream_staleness(spark, folder):
    """A gauge per user that holds a time: too old after twelve hours, firing after one more, over when it is renewed."""
    e = jobs.file_stream(spark, folder, "events", "ts")
    held = F.timestamp_micros(F.unix_micros("ts") - F.floor("value").cast("bigint") * 60_000_000)
    out = stateful.stale_value_alerts(e, F.col("user_id").cast("string"), "ts", held, STALE_LIMIT, STALE_HOLD)
    return jobs.run_to_table(out, "stream-staleness")
