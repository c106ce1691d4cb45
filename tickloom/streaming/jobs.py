"""Streaming forms of the operators: bars, rates, quantiles, counters, validation, latest values, once-per-period keys.

All of them run in append or update mode on event time with a watermark, so their state is bounded by the watermark and
the number of keys. Rows later than the watermark are dropped by Spark, which counts them in the query progress.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.operators.metrics import _bucket_counts, bucket_array, bucket_quantile
from tickloom.operators.validate import BarLimits, newest_wins, split_valid
from tickloom.session import work_folder
from tickloom.sources.latest_store import LatestStore

METRIC_DELAY = "10 minutes"
BAR_DELAY = "2 days"


def file_stream(spark: SparkSession, folder: str, name: str, ts: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """A parquet table, one file or a folder of files, as a stream.

    ``ts`` becomes a zoned timestamp so that it can carry a watermark. The path is written as a pattern because a stream
    accepts a single file only that way.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/{name}[.]parquet")
    return stream if ts is None else stream.withColumn(ts, F.col(ts).cast("timestamp"))


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Process everything that is available into a parquet table of the shared folder and return the table."""
    spark = stream.sparkSession
    root = work_folder(spark, label)
    query = (
        stream.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table")


def run_to_latest(stream: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The same in update mode: the newest row of each key, windows that are still open included."""
    spark, root = stream.sparkSession, work_folder(stream.sparkSession, label)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(f"{root}/table", batch_id))

    run_batches(stream, label, sink, "update")
    rest = [c for c in stream.columns if c not in keys]
    full = StructType([*stream.schema.fields, StructField("batch_id", LongType())])
    written = spark.read.schema(full).parquet(f"{root}/table")
    return written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r")).select(*keys, "r.*").select(*stream.columns)


def run_batches(stream: DataFrame, label: str, sink, mode: str = "append") -> StreamingQuery:
    """Process everything that is available through ``sink(batch, batch_id)``."""
    root = work_folder(stream.sparkSession, label)
    query = (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").outputMode(mode)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def bars_from_stream(ticks: DataFrame, ticker: str, ts: str, price: str, delay: str = BAR_DELAY) -> DataFrame:
    """Daily bars, emitted once the watermark has passed the day."""
    days = ticks.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("day"), F.col(ticker).alias("ticker"))
    bars = days.agg(
        F.min_by(price, ts).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, ts).alias("close"), F.count("*").alias("volume"),
    )
    return bars.select("ticker", F.col("day.start").cast("date").alias("date"), "open", "high", "low", "close", "volume")


def sliding_rate(events: DataFrame, keys: Sequence[str], ts: str, increment, window: str = "5 minutes", slide: str = "30 seconds",
                 seconds: int = 300, delay: str = METRIC_DELAY) -> DataFrame:
    """Increase and per-second rate of event increments over a sliding window."""
    w = events.withWatermark(ts, delay).groupBy(F.window(ts, window, slide).alias("w"), *keys)
    out = w.agg(F.sum(increment).alias("increase"))
    return out.select(*keys, F.col("w.end").alias("window_end"), "increase", (F.col("increase") / seconds).alias("rate"))


def sliding_quantiles(events: DataFrame, keys: Sequence[str], ts: str, value: str, bounds: Sequence[float], quantiles: Mapping[str, float],
                      window: str = "5 minutes", slide: str = "1 minute", delay: str = METRIC_DELAY) -> DataFrame:
    """Bucket quantiles over a sliding window; the state of a window is its few bucket counts."""
    names = [f"__b{i}" for i in range(len(bounds) + 1)]
    w = events.withWatermark(ts, delay).groupBy(F.window(ts, window, slide).alias("w"), *keys)
    out = w.agg(*[c.alias(n) for n, c in zip(names, _bucket_counts(value, bounds))])
    out = out.withColumn("__buckets", bucket_array([F.col(n) for n in names], bounds))
    return out.select(*keys, F.col("w.end").alias("window_end"), *[bucket_quantile(F.col("__buckets"), q).alias(n) for n, q in quantiles.items()])


def approximate_quantiles(events: DataFrame, keys: Sequence[str], ts: str, value: str, quantiles: Mapping[str, float],
                          window: str = "5 minutes", slide: str = "1 minute", delay: str = METRIC_DELAY) -> DataFrame:
    """The same from Spark's quantile summary, without fixed buckets."""
    w = events.withWatermark(ts, delay).groupBy(F.window(ts, window, slide).alias("w"), *keys)
    out = w.agg(F.percentile_approx(value, list(quantiles.values())).alias("__q"))
    return out.select(*keys, F.col("w.end").alias("window_end"), *[F.col("__q")[i].alias(n) for i, n in enumerate(quantiles)])


def ratio_of_streams(top: DataFrame, other: DataFrame, keys: Sequence[str], ts: str, window: str = "5 minutes", delay: str = METRIC_DELAY) -> DataFrame:
    """(keys, window_end, top, other, ratio): share of ``top`` among the rows of two streams in each window and label set.

    Both streams are counted by window first, so the join holds one row per window, label set and side. A window that only one
    side has comes out when the watermark, the lower one of both streams, has passed it; the other side then counts as zero.
    """
    def counted(rows: DataFrame, name: str) -> DataFrame:
        w = rows.withWatermark(ts, delay).groupBy(F.window(ts, window).alias(f"w_{name}"), *[F.col(k).alias(f"{k}_{name}") for k in keys])
        return w.agg(F.count("*").alias(name))

    a, b = counted(top, "top"), counted(other, "other")
    met = F.col("w_top") == F.col("w_other")
    for k in keys:
        met = met & (F.col(f"{k}_top") == F.col(f"{k}_other"))
    both = a.join(b, met, "full_outer")
    n, m = F.coalesce("top", F.lit(0)), F.coalesce("other", F.lit(0))
    return both.select(*[F.coalesce(f"{k}_top", f"{k}_other").alias(k) for k in keys], F.coalesce(F.col("w_top.end"), F.col("w_other.end")).alias("window_end"),
                       n.alias("top"), m.alias("other"), (n / (n + m)).alias("ratio"))


def hit_ratio(kept: DataFrame, requests: DataFrame) -> DataFrame:
    """Share of requests answered by an earlier one."""
    n, k = requests.agg(F.count("*").alias("n")).scalar(), F.count("*")
    return kept.agg(k.alias("kept")).withColumn("hit_ratio", 1 - F.try_divide(F.col("kept").cast("double"), n.cast("double")))


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def validate_stream(bars: DataFrame, path: str, limits: BarLimits = BarLimits()) -> None:
    """Valid and quarantined bars in two tables. A repeated batch replaces its own folder, so nothing is doubled."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_valid(batch, limits)
        good.write.mode("overwrite").parquet(_batch_folder(f"{path}/valid", batch_id))
        bad.write.mode("overwrite").parquet(_batch_folder(f"{path}/quarantine", batch_id))

    run_batches(bars, "validate", sink)


def running_counters(events: DataFrame, keys: Sequence[str], ts: str, value: str, path: str) -> DataFrame:
    """Totals, counts and last values per label set in update mode; returns the newest totals of every key."""
    totals = events.groupBy(*keys).agg(
        F.count("*").alias("samples"), F.sum(value).alias("total"), F.max_by(value, ts).alias("value"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    run_batches(totals, "counters", sink, "update")
    written = events.sparkSession.read.parquet(path)
    newest = written.groupBy(*keys).agg(F.max_by(F.struct("samples", "total", "value"), "batch_id").alias("r"))
    return newest.select(*keys, "r.*")


def push_latest(rows: DataFrame, keys: Sequence[str], ts: str, path: str) -> DataFrame:
    """Latest-value table fed by a stream: the newest row per key by event time wins, older rows change nothing.

    Rows without an event time count as arriving now. Each batch writes a new version of the table from the version before
    it, so a repeated batch gives the same version. The table has one row per key.
    """
    spark, seen = rows.sparkSession, []
    now = F.current_timestamp()
    rows = rows.withColumn(ts, F.coalesce(F.col(ts), now) if ts in rows.columns else now)

    def sink(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(*keys).agg(F.max(F.struct(ts, *[c for c in batch.columns if c not in (ts, *keys)])).alias("r")).select(*keys, "r.*")
        try:
            before = batch.sparkSession.read.parquet(f"{path}/version={batch_id - 1}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
            before = newest.limit(0)
        newest_wins(before, newest, tuple(keys), ts).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        seen.append(batch_id)

    run_batches(rows, "push", sink)
    return spark.read.parquet(f"{path}/version={max(seen)}")


def push_to_store(rows: DataFrame, store: LatestStore, fold_every: int = 20) -> StreamingQuery:
    """Latest values of a stream into a log-structured store: each batch writes its own newest rows and nothing else.

    After every ``fold_every`` batches one share of the buckets is folded, each in turn, so that all are after
    ``fold_every`` rounds. A repeated batch changes nothing.
    """

    def sink(batch: DataFrame, number: int) -> None:
        store.write(batch, number)
        if number % fold_every == fold_every - 1:
            turn = number // fold_every % fold_every
            store.compact(batch.sparkSession, number, range(turn, store.buckets, fold_every))

    return run_batches(rows, "push-store", sink)
