"""All alert rules on one stream, staleness of a value, against the batch form and by hand."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import alerts
from tickloom.operators.alerts import AlertRule
from tickloom.streaming import jobs, rules, stateful

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, metric string, labels map<string,string>, value double"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each of the four stateful steps of a query keeps a store per partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def write(folder, name, rows, age):
    """(seconds, metric, labels, value) as one file of the stream."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = pa.schema([("ts", pa.timestamp("us")), ("metric", pa.string()), ("labels", pa.map_(pa.string(), pa.string())), ("value", pa.float64())])
    columns = [[START + timedelta(seconds=r[0]) for r in rows], [r[1] for r in rows], [list(r[2].items()) for r in rows], [r[3] for r in rows]]
    path = f"{folder}/{name}.parquet"
    pq.write_table(pa.table([pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds), path)
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def streamed(spark, folder, parts):
    os.makedirs(folder)
    for i, rows in enumerate(parts):
        write(folder, f"b{i}", rows, i * 10)
    return alerts.sample_table(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder)))


def batch(spark, rows):
    return alerts.sample_table(spark.createDataFrame([(START + timedelta(seconds=s), m, l, None if v is None else float(v)) for s, m, l, v in rows], SCHEMA))


def every(step, until, metric, labels, value, start=0):
    return [(t, metric, labels, float(value(t) if callable(value) else value)) for t in range(start, until + 1, step)]


def seconds(t):
    return int((t - START).total_seconds())


def platform_samples():
    """Samples that fire a dozen of the platform's rules, some of which end again."""
    rows = every(30, 1500, "up", {"job": "api"}, lambda t: 0 if 300 <= t <= 900 else 1) + every(30, 1500, "up", {"job": "postgres"}, 1)
    rows += every(30, 1500, "prediction_errors_total", {"type": "x"}, lambda t: t) + every(30, 1500, "predictions_total", {"model": "m"}, lambda t: 2 * t)
    rows += every(30, 1500, "prediction_errors_total", {"type": "y"}, lambda t: t / 3)
    rows += every(5, 1500, "http_requests_duration_seconds", {"job": "api"}, lambda t: 3.0 if t < 700 else 0.02)
    rows += every(30, 1500, "cache_hits_total", {}, lambda t: t) + every(30, 1500, "cache_misses_total", {}, lambda t: 3 * t % 900)
    rows += every(30, 1500, "redis_memory_used_bytes", {"i": "1"}, 90) + every(30, 1500, "redis_memory_max_bytes", {"i": "1"}, 100)
    rows += every(30, 1500, "node_cpu_seconds_total", {"instance": "a", "cpu": "0", "mode": "idle"}, lambda t: 0.1 * t)
    rows += every(30, 900, "node_cpu_seconds_total", {"instance": "a", "cpu": "1", "mode": "idle"}, lambda t: 0.05 * t)
    rows += every(30, 1500, "node_cpu_seconds_total", {"instance": "b", "cpu": "0", "mode": "idle"}, lambda t: 0.9 * t)
    rows += every(30, 1500, "kube_pod_status_phase", {"pod": "p", "phase": "Failed"}, 1) + every(30, 1500, "kube_pod_status_phase", {"pod": "p", "phase": "Running"}, 1)
    rows += every(60, 1500, "kube_statefulset_status_replicas_ready", {"s": "x"}, 2) + every(60, 1500, "kube_statefulset_status_replicas", {"s": "x"}, 3)
    rows += every(30, 1500, "model_prediction_confidence", {"m": "1"}, 0.6) + every(45, 1500, "model_prediction_confidence", {"m": "2"}, 0.65)
    rows += every(60, 1500, "kube_node_status_condition", {"condition": "Ready", "status": "true"}, 0)
    return sorted(rows, key=lambda r: r[0]) + [(6000, "other", {}, 1.0), (6000, "up", {"job": "end"}, 1.0)]


def periods(events):
    """(rule, labels, active since, firing since, end) of what fired."""
    found = {}
    for r in events:
        if r["state"] != "PENDING":
            found.setdefault((r["rule"], r["labels"], seconds(r["since"])), {})[r["state"]] = seconds(r["at"])
    return {k: (v["FIRING"], v.get("RESOLVED")) for k, v in found.items()}


def expected(spark, platform, rows):
    steps = {r.name: r.step for r in platform}
    out = {}
    for r in alerts.evaluate(platform, batch(spark, rows)).withColumn("labels", rules.json_labels(F.col("labels"))).collect():
        out[r["rule"], r["labels"], seconds(r["active_since"])] = (seconds(r["firing_since"]), seconds(r["active_until"]) + steps[r["rule"]])
    return out


@pytest.mark.parametrize("cuts", [(), (500, 501, 1111)])
def test_platform_rules(spark, tmp_path, cuts):
    rows, platform = platform_samples(), alerts.platform_rules("api")
    bounds = [-1, *cuts, 10_000]
    parts = [[r for r in rows if a < r[0] <= b] for a, b in zip(bounds, bounds[1:])]
    # One more file moves the watermark past the last grid times.
    stream = streamed(spark, f"{tmp_path}/in", [*parts, [(9000, "up", {"job": "end"}, 1.0)]])
    got = periods(jobs.run_to_table(rules.rule_alerts(stream, platform, "1 minute"), "rules").collect())
    wanted = expected(spark, platform, rows)
    assert len({k[0] for k in wanted}) >= 10 and got == wanted


def small_rules():
    rate = alerts.rate_of("c", 120)
    return [
        AlertRule("Last", alerts.instant("g", seconds=60), ">", 5, 60, "x", 30),
        AlertRule("Rate", rate, ">", 0.5, 60, "x", 30),
        AlertRule("Share", alerts.ratio(alerts.grouped(rate, "sum"), alerts.grouped(rate, "avg")), ">", 1.5, 90, "x", 60),
        AlertRule("Quantile", alerts.quantile_of("g", 0.5, 120, bounds=(1.0, 5.0, 10.0)), ">", 4, 60, "x", 60),
    ]


def small_samples():
    rows = every(20, 1800, "g", {"k": "a"}, lambda t: 9 if 300 < t < 1000 else 1) + every(35, 1200, "g", {"k": "b", "z": "é"}, lambda t: t % 11)
    return rows + every(15, 1800, "c", {"k": "a"}, lambda t: t if t < 700 else t / 9) + every(25, 1300, "c", {"k": "b"}, lambda t: 3 * t % 600)


def test_memory_from_a_batch_run(spark, tmp_path):
    """A stream that begins with the memory of the samples before it goes on as one over all samples."""
    rows, own = small_samples(), small_rules()
    end = [(5000, "g", {"k": "end"}, 0.0)]
    whole = jobs.run_to_table(rules.rule_alerts(streamed(spark, f"{tmp_path}/whole", [rows, end]), own, "1 minute"), "whole").collect()
    for cut in (840,):
        later = [r for r in rows if r[0] > cut]
        cut_at = int((START - datetime(1970, 1, 1)).total_seconds()) + cut
        history = rules.state_before(batch(spark, rows), own, F.lit(cut_at))
        rest = jobs.run_to_table(rules.rule_alerts(streamed(spark, f"{tmp_path}/from{cut}", [later, end]), own, "1 minute", history), "rest").collect()
        key = lambda r: (r["rule"], r["labels"], r["state"], r["since"], r["at"], round(r["value"], 9))
        assert sorted(map(key, rest)) == sorted(key(r) for r in whole if seconds(r["at"]) > cut)
        assert any(seconds(r["since"]) <= cut for r in rest)


def test_odd_samples(spark, tmp_path):
    rows = [(0, "g", {"k": "a"}, 9.0), (0, "g", {"k": "a"}, 9.0), (10, "g", {}, 9.0), (30, "unknown", {"k": "a"}, 9.0), (30, "g", {"k": "a"}, None), (60, "g", {"k": "a"}, 9.0)]
    stream = streamed(spark, f"{tmp_path}/in", [rows, [(900, "g", {"k": "end"}, 0.0)]])
    got = jobs.run_to_table(rules.rule_alerts(stream, small_rules()[:1], "1 second"), "odd").collect()
    seen = sorted((r["labels"], r["state"], seconds(r["since"]), seconds(r["at"])) for r in got)
    assert seen == [("{\"k\":\"a\"}", "FIRING", 0, 60), ("{\"k\":\"a\"}", "PENDING", 0, 0), ("{\"k\":\"a\"}", "RESOLVED", 0, 120), ("{}", "PENDING", 30, 30)]
    with pytest.raises(ValueError):
        rules.rule_alerts(stream, [])
    with pytest.raises(ValueError):
        rules.rule_alerts(stream, small_rules()[:1] * 2)
    with pytest.raises(ValueError):
        rules.base_step([AlertRule("x", alerts.instant("g", seconds=100), ">", 1, 0, "x", 30)])


def test_a_value_goes_stale_recovers_and_goes_stale_again(spark, tmp_path):
    stamp = lambda s: (START - datetime(1970, 1, 1)).total_seconds() + s
    version = [(0, stamp(0)), (600, stamp(0)), (5000, stamp(4900)), (5100, stamp(4900))]
    rows = [(t, "model", {}, float(v)) for t, v in version]
    clock = [(t, "clock", {}, 0.0) for t in range(0, 20_000, 500)]
    both = sorted(rows + clock, key=lambda r: r[0])
    parts = [[r for r in both if a <= r[0] < b] for a, b in ((0, 4000), (4000, 9000), (9000, 30_000))]
    stream = streamed(spark, f"{tmp_path}/in", [*parts, [(30_000, "clock", {}, 0.0)]])
    held = F.when(F.col("metric") == "model", F.timestamp_seconds("value")).otherwise(F.col("ts"))
    out = stateful.stale_value_alerts(stream, F.col("metric"), "ts", held, 1000, 600, 60, "1 minute")
    got = jobs.run_to_table(out, "stale").where("series = 'model'").orderBy("at", "state").collect()
    assert [(r["state"], seconds(r["since"]), seconds(r["at"])) for r in got] == [
        ("PENDING", 1000, 1000), ("FIRING", 1000, 1600), ("RESOLVED", 1000, 5000), ("PENDING", 5900, 5900), ("FIRING", 5900, 6500)]


def test_a_value_that_goes_back(spark, tmp_path):
    stamp = lambda s: (START - datetime(1970, 1, 1)).total_seconds() + s
    rows = [(0, "m", {}, stamp(0)), (100, "m", {}, stamp(-5000)), (200, "m", {}, stamp(150)), (300, "m", {}, stamp(-9000)), (300, "n", {}, None)]
    stream = streamed(spark, f"{tmp_path}/in", [rows, [(4000, "end", {}, stamp(4000))]])
    out = stateful.stale_value_alerts(stream.where("value IS NOT NULL OR metric = 'n'"), F.col("metric"), "ts", F.timestamp_seconds("value"), 1000, 500, 10, "1 second")
    got = jobs.run_to_table(out, "back").where("series <> 'end'").orderBy("at", "state").collect()
    assert [(r["state"], seconds(r["since"]), seconds(r["at"])) for r in got] == [("PENDING", 100, 100), ("PENDING", 300, 300), ("FIRING", 300, 800)]


def test_labels_as_text():
    assert rules.text_of({"a": "é\"", "b": "1"}) == '{"a":"é\\"","b":"1"}'
