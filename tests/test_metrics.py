from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import alerts, metrics

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, metric string, labels map<string,string>, value double"


def samples(spark, rows):
    return alerts.sample_table(spark.createDataFrame([(START + timedelta(seconds=s), m, l, float(v)) for s, m, l, v in rows], SCHEMA))


def test_latency_points(spark):
    rows = [("a", i, 0.1 * (i + 1), i in (1, 3)) for i in range(5)] + [("b", i, float(i), i % 2 == 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, at long, duration double, failed boolean")
    got = {r["k"]: r for r in metrics.latency_stats(df, ["k"], "duration", F.col("failed"), ["at"]).collect()}
    a, b = got["a"], got["b"]
    assert abs(a["mean_latency"] - 0.3) < 1e-12 and abs(a["median_latency"] - 0.3) < 1e-12 and a["error_rate"] == 0.4
    # only the 1000 newest count for latencies, all requests for the totals
    assert (b["total_requests"], b["error_rate"], b["min_latency"], b["median_latency"], b["p95_latency"], b["p99_latency"]) == (2000, 0.5, 1000, 1500, 1950, 1990)


def test_histogram_and_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (0.5, 1.5, 1.5, 3.0, 99.0)], "value double")
    h = metrics.histogram(df, [], (1.0, 2.0, 5.0)).withColumn("p", metrics.bucket_quantile(F.col("buckets"), 0.5)).withColumn("top", metrics.bucket_quantile(F.col("buckets"), 0.99)).first()
    assert [(b["le"], b["count"]) for b in h["buckets"]] == [(1.0, 1), (2.0, 3), (5.0, 4), (float("inf"), 5)]
    assert (h["sum"], h["count"], h["p"], h["top"]) == (105.5, 5, 1.75, 5.0)


def test_increase_survives_a_restart(spark):
    df = spark.createDataFrame([("c", START + timedelta(minutes=m), float(v)) for m, v in [(0, 5), (1, 8), (2, 2), (30, 9)]], "k string, ts timestamp, value double")
    got = [r["increase"] for r in metrics.counter_increases(df, ["k"]).orderBy("ts").collect()]
    assert got == [0, 3, 2, 7]


def test_rate_window_is_half_open(spark):
    df = spark.createDataFrame([("c", START + timedelta(seconds=s), 30.0) for s in (0, 60, 61)], "k string, ts timestamp, increase double")
    got = {(r["eval_ts"] - START).seconds: r["increase"] for r in metrics.rate(df, ["k"], 120, 60).collect()}
    assert got == {0: 30, 60: 60, 120: 60, 180: 30}


def test_label_patterns(spark):
    s = samples(spark, [(0, "m", {"phase": "Failed", "x": "1"}, 1), (0, "m", {"phase": "FailedNot"}, 1), (0, "m", {}, 1)])
    assert s.where(metrics.matches(F.col("labels"), regex={"phase": "Failed|Unknown"})).count() == 1
    assert s.where(metrics.matches(F.col("labels"), {"x": "1"})).count() == 1


def every(step, until, metric, labels, value):
    return [(t, metric, labels, value(t) if callable(value) else value) for t in range(0, until + 1, step)]


HOUR = 3600
RULE_CASES = {
    "APIServiceDown": every(30, 600, "up", {"job": "api"}, 0),
    "HighErrorRate": every(30, 1200, "prediction_errors_total", {"error_type": "x"}, lambda t: t) + every(30, 1200, "predictions_total", {"model": "m"}, lambda t: 2 * t),
    "HighLatency": every(5, 1200, "http_requests_duration_seconds", {"job": "api"}, 3.0),
    "PredictionCacheHitRateLow": every(30, 1500, "cache_hits_total", {}, lambda t: t) + every(30, 1500, "cache_misses_total", {}, lambda t: 3 * t),
    "PostgreSQLDown": every(30, 600, "up", {"job": "postgres"}, 0),
    "PostgreSQLHighConnections": every(30, 600, "pg_stat_activity_count", {}, 81),
    "PostgreSQLSlowQueries": every(30, 1200, "pg_stat_statements_total_time", {}, lambda t: 2000 * t),
    "PostgreSQLDiskSpace": [r for m, v in (("node_filesystem_avail_bytes", 5), ("node_filesystem_size_bytes", 100)) for r in every(30, 1200, m, {"mountpoint": "/var/lib/postgresql/data"}, v)],
    "RedisDown": every(30, 600, "up", {"job": "redis"}, 0),
    "RedisHighMemoryUsage": every(30, 600, "redis_memory_used_bytes", {}, 9) + every(30, 600, "redis_memory_max_bytes", {}, 10),
    "RedisEvictions": every(30, 1200, "redis_evicted_keys_total", {}, lambda t: t),
    "ModelInferenceTimeHigh": every(5, 1200, "model_inference_duration_seconds", {}, 0.4),
    "ModelPredictionConfidenceLow": every(30, 1500, "model_prediction_confidence", {}, 0.6),
    "HighCPUUsage": [r for cpu in "01" for r in every(30, 1200, "node_cpu_seconds_total", {"mode": "idle", "instance": "i", "cpu": cpu}, lambda t: 0.1 * t)],
    "HighMemoryUsage": every(30, 600, "node_memory_MemAvailable_bytes", {"instance": "i"}, 10) + every(30, 600, "node_memory_MemTotal_bytes", {"instance": "i"}, 100),
    "DiskSpaceLow": every(30, 1200, "node_filesystem_avail_bytes", {"mountpoint": "/"}, 5) + every(30, 1200, "node_filesystem_size_bytes", {"mountpoint": "/"}, 100),
    "KubernetesNodeNotReady": every(30, 600, "kube_node_status_condition", {"condition": "Ready", "status": "true", "node": "n"}, 0),
    "KubernetesPodCrashLooping": every(30, 2000, "kube_pod_container_status_restarts_total", {"pod": "p"}, lambda t: t),
    "KubernetesPodNotHealthy": every(30, 600, "kube_pod_status_phase", {"phase": "Failed", "pod": "p"}, 1),
    "KubernetesStatefulsetReplicasMismatch": every(30, 600, "kube_statefulset_status_replicas_ready", {"s": "x"}, 1) + every(30, 600, "kube_statefulset_status_replicas", {"s": "x"}, 3),
    "NoNewPredictions": every(60, 2 * HOUR, "predictions_total", {}, 7),
    "ModelVersionStale": every(60, 2 * HOUR, "model_version_timestamp_seconds", {}, START.timestamp() - 8 * 86400),
}
# ModelInferenceTimeHigh cannot fire from its buckets: the top finite bound equals the limit.
SILENT = {"ModelInferenceTimeHigh"}


def test_rule_table_is_whole():
    rules = alerts.platform_rules("api")
    assert {r.name for r in rules} == set(RULE_CASES) and len(rules) == 22


@pytest.mark.parametrize("name", sorted(RULE_CASES))
def test_rule(spark, name):
    rule = next(r for r in alerts.platform_rules("api") if r.name == name)
    fired = alerts.evaluate([rule], samples(spark, RULE_CASES[name])).collect()
    assert len(fired) == (0 if name in SILENT else 1)
    for f in fired:
        assert (f["firing_since"] - f["active_since"]).total_seconds() == rule.hold_seconds and f["severity"] == rule.severity
    calm = samples(spark, [(0, "up", {"job": "api"}, 1)])
    assert alerts.evaluate([rule], calm).isEmpty()


def test_short_condition_does_not_fire(spark):
    rule = next(r for r in alerts.platform_rules("api") if r.name == "APIServiceDown")
    flapping = [(t, "up", {"job": "api"}, 0 if t % 120 else 1) for t in range(0, 1201, 30)]
    assert alerts.evaluate([rule], samples(spark, flapping)).isEmpty()


def test_absence(spark):
    df = spark.createDataFrame([("k", START + timedelta(minutes=m)) for m in (0, 10, 40, 65)], "k string, ts timestamp")
    got = metrics.absence_periods(df, ["k"], 600, 900).orderBy("last_seen").collect()
    assert [(r["last_seen"] - START).seconds // 60 for r in got] == [10, 40]
