"""Registered streaming queries: each reads its table as a file stream, runs until nothing is left, and returns the table
it wrote. A window is emitted once the watermark (latest event time minus the delay) has passed its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators.validate import BarLimits
from tickloom.plans import datasets
from tickloom.plans.metric_queries import BOUNDS, COUNTS_SQL, _quantile_sql
from tickloom.plans.registry import day_sql, query, rounded, rsql, second_sql
from tickloom.session import work_folder
from tickloom.streaming import jobs, stateful

MARK = "(SELECT max(ts) FROM events) - INTERVAL {delay}"


def _events(spark, folder):
    return jobs.file_stream(spark, folder, "events", "ts")


@query("stream_bars", f"""SELECT event_type AS ticker, {day_sql('CAST(ts AS DATE)')} AS date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, ts) AS close, count(*) AS volume FROM events GROUP BY event_type, CAST(ts AS DATE)""")
def stream_bars(spark, folder):
    return jobs.run_to_latest(jobs.bars_from_stream(_events(spark, folder), "event_type", "ts", "value"), ["ticker", "date"], "stream-bars")


def _sliding_sql(seconds: int, step: int) -> str:
    return f"""win AS (SELECT *, make_timestamp(CAST((floor(epoch_us(ts) / {step}e6) + 1 + k) * {step} * 1000000 AS BIGINT)) AS tick
    FROM events, (SELECT unnest(range({seconds // step})) AS k)), closed AS (SELECT * FROM win)"""


@query("stream_rate", f"""WITH {_sliding_sql(300, 60)} SELECT event_type, {second_sql('tick')} AS window_end, count(*) AS increase, {rsql('count(*) / 300', 8)} AS rate
  FROM closed GROUP BY event_type, tick""")
def stream_rate(spark, folder):
    out = jobs.sliding_rate(_events(spark, folder), ["event_type"], "ts", F.lit(1).cast("bigint"), "5 minutes", "1 minute")
    return rounded(jobs.run_to_latest(out, ["event_type", "window_end"], "stream-rate"), {"rate": 8})


@query("stream_quantiles", f"""WITH {_sliding_sql(3600, 900)}, c AS (SELECT event_type, tick, {COUNTS_SQL} FROM closed GROUP BY event_type, tick)
  SELECT event_type, {second_sql('tick')} AS window_end, """ + ", ".join(f"{rsql(_quantile_sql(q), 4)} AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99)) + " FROM c")
def stream_quantiles(spark, folder):
    out = jobs.sliding_quantiles(_events(spark, folder), ["event_type"], "ts", "value", BOUNDS, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, "1 hour", "15 minutes")
    return rounded(jobs.run_to_latest(out, ["event_type", "window_end"], "stream-quantiles"), {"p50": 4, "p95": 4, "p99": 4})


@query("stream_alerts", f"""WITH t0 AS (SELECT event_type AS series, make_timestamp(CAST((floor(epoch_us(ts) / 3600e6) + 1) * 3600 * 1000000 AS BIGINT)) AS tick, avg(value) > 20 AS active
    FROM events GROUP BY 1, 2), t AS (SELECT * FROM t0 WHERE tick <= {MARK.format(delay='10 MINUTE')}),
  a AS (SELECT *, CASE WHEN tick - lag(tick) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM t WHERE active WINDOW w AS (PARTITION BY series ORDER BY tick)),
  i AS (SELECT *, sum(fresh) OVER (PARTITION BY series ORDER BY tick) AS island FROM a),
  f AS (SELECT series, min(tick) AS first, max(tick) AS last, max(tick) - min(tick) >= INTERVAL 2 HOUR AS fired, (SELECT max(tick) FROM t WHERE t.series = i.series) AS newest FROM i GROUP BY series, island)
  SELECT series, 'PENDING' AS state, {second_sql('first')} AS since, {second_sql('first')} AS at FROM f
  UNION ALL SELECT series, 'FIRING', {second_sql('first')}, {second_sql('first + INTERVAL 2 HOUR')} FROM f WHERE fired
  UNION ALL SELECT series, 'RESOLVED', {second_sql('first')}, {second_sql('last + INTERVAL 1 HOUR')} FROM f WHERE fired AND newest > last""")
def stream_alerts(spark, folder):
    out = stateful.sustained_alerts(_events(spark, folder), F.col("event_type"), "ts", F.avg("value") > 20, 7200, 3600)
    return jobs.run_to_table(out, "stream-alerts")


@query("stream_absence", f"""WITH m0 AS (SELECT event_type AS series, make_timestamp(CAST((floor(epoch_us(ts) / 60e6) + 1) * 60 * 1000000 AS BIGINT)) AS tick, min(ts) AS first, max(ts) AS last
    FROM events GROUP BY 1, 2), m AS (SELECT * FROM m0 WHERE tick <= {MARK.format(delay='10 MINUTE')}),
  g AS (SELECT series, last AS since, lead(first) OVER (PARTITION BY series ORDER BY tick) AS next FROM m)
  SELECT series, 'FIRING' AS state, {second_sql('since')} AS since, {second_sql('since + INTERVAL 1500 SECOND')} AS at FROM g
  WHERE coalesce(next, {MARK.format(delay='10 MINUTE')}) - since >= INTERVAL 1500 SECOND
  UNION ALL SELECT series, 'RESOLVED', {second_sql('since')}, {second_sql('next')} FROM g WHERE next - since >= INTERVAL 1500 SECOND""")
def stream_absence(spark, folder):
    out = stateful.silence_alerts(_events(spark, folder), F.col("event_type"), "ts", 1500)
    return jobs.run_to_table(out, "stream-absence")


KEPT_SQL = """kept AS (SELECT event_type, user_id, min(ts) AS ts FROM events GROUP BY ALL
  UNION ALL SELECT e.event_type, e.user_id, min(e.ts) AS ts FROM kept k JOIN events e ON e.event_type = k.event_type AND e.user_id = k.user_id AND e.ts > k.ts + INTERVAL 1 HOUR
  GROUP BY e.event_type, e.user_id)"""


def _kept(spark, folder):
    return jobs.run_to_table(stateful.once_per_period(_events(spark, folder), ["event_type", "user_id"], "ts", 3600, ["event_id"]), "stream-dedup")


@query("stream_dedup", f"WITH RECURSIVE {KEPT_SQL} SELECT event_type, user_id, {second_sql('ts')} AS ts FROM kept")
def stream_dedup(spark, folder):
    """Times at which a request of a key was not answered by a result of the hour before."""
    return _kept(spark, folder).select("event_type", "user_id", "ts")


@query("stream_hit_ratio", f"WITH RECURSIVE {KEPT_SQL} SELECT count(*) AS kept, {rsql('1 - count(*) / (SELECT count(*) FROM events)', 9)} AS hit_ratio FROM kept")
def stream_hit_ratio(spark, folder):
    return rounded(jobs.hit_ratio(_kept(spark, folder), datasets.table(spark, folder, "events")), {"hit_ratio": 9})


LOWER_MARK = "(SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'view')) FROM events) - INTERVAL 10 MINUTE"


@query("stream_ratio_of_two", f"""WITH c AS (SELECT user_id % 10 AS shard, make_timestamp(CAST((floor(epoch_us(ts) / 3600e6) + 1) * 3600 * 1000000 AS BIGINT)) AS tick,
    count(*) FILTER (event_type = 'click') AS hits, count(*) FILTER (event_type = 'view') AS misses FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL)
  SELECT shard, {second_sql('tick')} AS window_end, hits AS top, misses AS other, {rsql('hits / (hits + misses)', 8)} AS ratio FROM c WHERE tick <= {LOWER_MARK}""")
def stream_ratio_of_two(spark, folder):
    """Clicks among clicks and views by hour, from two streams that are each read by themselves."""
    shard = (F.col("user_id") % 10).alias("shard")
    one, two = (_events(spark, folder).where(F.col("event_type") == kind).select(shard, "ts") for kind in ("click", "view"))
    return rounded(jobs.run_to_table(jobs.ratio_of_streams(one, two, ["shard"], "ts", "1 hour"), "stream-ratio"), {"ratio": 8})


@query("stream_counters", f"""SELECT event_type, user_id, count(*) AS samples, {rsql('sum(value)', 4)} AS total, arg_max(value, ts) AS value FROM events GROUP BY event_type, user_id""")
def stream_counters(spark, folder):
    path = work_folder(spark, "stream-counters")
    return rounded(jobs.running_counters(_events(spark, folder), ["event_type", "user_id"], "ts", "value", path), {"total": 4})


@query("stream_push", f"SELECT user_id, {second_sql('max(ts)')} AS ts, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value FROM events GROUP BY user_id")
def stream_push(spark, folder):
    rows = _events(spark, folder).select("user_id", "ts", "event_type", "value")
    return jobs.push_latest(rows, ["user_id"], "ts", work_folder(spark, "stream-push"))


@query("stream_validation", f"""SELECT o_orderkey, CASE WHEN o_totalprice < 0.01 OR o_totalprice > 400000 THEN 'Price ' || CAST(o_totalprice AS VARCHAR) || ' outside valid range'
  WHEN o_orderkey < 100 THEN 'Volume ' || CAST(o_orderkey AS VARCHAR) || ' below minimum' END AS validation_error FROM orders""")
def stream_validation(spark, folder):
    price = F.col("o_totalprice")
    rows = jobs.file_stream(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").cast("date").alias("date"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"), F.col("o_orderkey").alias("volume"))
    path = work_folder(spark, "stream-validation")
    jobs.validate_stream(rows, path, BarLimits(max_price="400000", min_volume=100))
    good = spark.read.parquet(f"{path}/valid").select("o_orderkey", F.lit(None).cast("string").alias("validation_error"))
    return good.unionByName(spark.read.parquet(f"{path}/quarantine").select("o_orderkey", "validation_error"))
