"""Registered queries of the latest-value store: written by a stream in batches, compacted on the way, read and looked up."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans import datasets
from tickloom.plans.registry import query, second_sql
from tickloom.session import work_folder
from tickloom.sources.latest_store import LatestStore
from tickloom.streaming import jobs

FIELDS = T.StructType().add("user_id", "long").add("event_type", "string").add("ts", "timestamp").add("value", "double")


def events_store(spark, folder: str) -> LatestStore:
    """Newest event of each user and type: seven batches, by day, each one pushed twice; half the buckets are folded after every third."""
    store = LatestStore(work_folder(spark, "latest-store"), ("user_id", "event_type"), "ts", FIELDS, 8)
    events = datasets.table(spark, folder, "events").select(F.col("user_id").cast("long").alias("user_id"), "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    for n in range(7):
        batch = events.where(F.pmod(F.dayofmonth("ts"), F.lit(7)) == (3 * n) % 7)
        for _ in range(2):
            store.write(batch, n)
        if n % 3 == 2:
            store.compact(spark, n, range(n // 3 * 4, n // 3 * 4 + 4))
    return store


NEWEST = "SELECT user_id, event_type, {ts} AS ts, arg_max(value, ts) AS value FROM events {where} GROUP BY user_id, event_type".format(ts=second_sql("max(ts)"), where="{where}")


@query("store_latest", NEWEST.format(where=""))
def store_latest(spark, folder):
    return events_store(spark, folder).read(spark)


@query("store_lookup", NEWEST.format(where="WHERE user_id IN (SELECT o_custkey % 40 FROM orders WHERE o_orderpriority LIKE '1%')"))
def store_lookup(spark, folder):
    """Newest rows of the users that urgent orders name."""
    store = events_store(spark, folder)
    orders = datasets.table(spark, folder, "orders").where(F.col("o_orderpriority").startswith("1"))
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    return store.lookup(orders.select((F.col("o_custkey") % 40).cast("long").alias("user_id"), F.explode(kinds).alias("event_type")))


@query("stream_store", NEWEST.format(where=""))
def stream_store(spark, folder):
    """The same store fed by a stream."""
    store = LatestStore(work_folder(spark, "latest-store"), ("user_id", "event_type"), "ts", FIELDS, 8)
    rows = jobs.file_stream(spark, folder, "events", "ts").select(F.col("user_id").cast("long").alias("user_id"), "event_type", "ts", "value")
    jobs.push_to_store(rows, store, fold_every=2)
    return store.read(spark)
