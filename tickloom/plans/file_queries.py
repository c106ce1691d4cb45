"""Registered queries over files: a derived table is written to the shared folder as files and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tickloom.operators import scoring
from tickloom.operators.clean import coerce_bars, concat
from tickloom.plans import datasets
from tickloom.plans.registry import BARS_SQL, day_sql, query
from tickloom.session import work_folder
from tickloom.sources import readers, schemas, sinks, ticker_files

COLUMNS = ["ticker", "date", "open", "high", "low", "close", "volume"]
READ_BACK = f"WITH {BARS_SQL} SELECT ticker, {day_sql('date')} AS date, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM bars"


@query("csv_mixed_headers", READ_BACK)
def csv_mixed_headers(spark, folder):
    """Bars in CSV files of two column orders and spellings, read by their own headers."""
    path = work_folder(spark, "csv-bars")
    bars = datasets.bars_table(spark, folder).select(*COLUMNS)
    even = F.pmod(F.xxhash64("ticker"), F.lit(2)) == 0
    spelled = bars.where(even).withColumnsRenamed({c: c.title() for c in COLUMNS})
    sinks.write_bars(spelled, f"{path}/a")
    sinks.write_bars(bars.where(~even).select(*reversed(COLUMNS)), f"{path}/b")
    return coerce_bars(readers.read_bar_csv(spark, f"{path}/*")).select(*COLUMNS)


@query("month_storage", READ_BACK)
def month_storage(spark, folder):
    """Bars stored by month and read back."""
    path = work_folder(spark, "month-bars")
    bars = datasets.bars_table(spark, folder).select(*COLUMNS[:-1], F.col("volume").cast("double").alias("volume"))
    sinks.write_by_month(bars, path)
    return sinks.read_table(spark, path, bars.schema).select(*COLUMNS)


def _ticker_folder(spark, folder: str) -> str:
    """Files per ticker in CSV and compressed CSV, one that is no table and one without a close among them."""
    path = work_folder(spark, "ticker-files")
    bars = datasets.bars_table(spark, folder).select(*COLUMNS)
    zipped = F.pmod(F.xxhash64("ticker"), F.lit(3)) == 0
    for part, name, codec in ((bars.where(~zipped), "plain", "none"), (bars.where(zipped), "zipped", "gzip")):
        part.repartition("ticker").write.partitionBy("ticker").option("header", True).option("compression", codec).csv(f"{path}/{name}")
    first = bars.where("ticker < 'NATION_11'")
    first.select(F.concat(F.lit("no table "), "ticker").alias("text")).distinct().coalesce(1).write.text(f"{path}/broken/ticker=BROKEN")
    first.drop("close", "ticker").coalesce(1).write.option("header", True).csv(f"{path}/broken/ticker=SHORT")
    return path


APART = f"""WITH {BARS_SQL} SELECT ticker, {day_sql('date')} AS date, open, high, low, close, volume, NULL::VARCHAR AS error FROM bars
  UNION ALL SELECT 'BROKEN', NULL, NULL, NULL, NULL, NULL, NULL, 'Missing columns: date, open, high, low, close, volume'
  UNION ALL SELECT 'SHORT', NULL, NULL, NULL, NULL, NULL, NULL, 'Missing columns: close'"""


@query("ticker_files_apart", APART)
def ticker_files_apart(spark, folder):
    """Bars of all readable files and a row for each that is not."""
    rows = ticker_files.read_apart(spark, _ticker_folder(spark, folder), F.regexp_extract("path", "ticker=([^/]+)/", 1))
    return rows.select(*COLUMNS, "error")


@query("split_files", f"""WITH {BARS_SQL} SELECT CASE WHEN date < DATE '1999-01-01' THEN 'train' WHEN date < DATE '2000-01-01' THEN 'val' ELSE 'test' END AS split,
  ticker, count(*) AS bars, {day_sql('min(date)')} AS first, {day_sql('max(date)')} AS last, round(sum(close), 2) + 0.0 AS total FROM bars GROUP BY 1, 2""")
def split_files(spark, folder):
    """Splits written as CSV folders and read back together."""
    path = work_folder(spark, "splits")
    bars = datasets.bars_table(spark, folder)
    split = F.when(F.col("date") < "1999-01-01", "train").when(F.col("date") < "2000-01-01", "val").otherwise("test")
    sinks.write_splits(bars.withColumn("split", split), path)
    parts = [spark.read.option("header", True).schema(bars.schema).csv(f"{path}/split={s}").withColumn("split", F.lit(s)) for s in ("train", "val", "test")]
    out = concat(parts).groupBy("split", "ticker").agg(
        F.count("*").alias("bars"), F.min("date").alias("first"), F.max("date").alias("last"), (F.round(F.sum("close"), 2) + 0.0).alias("total"))
    return out


@query("run_log", f"""WITH {BARS_SQL}, m AS (SELECT strftime(date, '%Y') AS year, count(*) AS n, count(*) FILTER (volume < 2) AS bad FROM bars GROUP BY 1)
  SELECT 'year_' || year AS pipeline_name, CASE WHEN bad > n // 4 THEN 'failed' ELSE 'success' END AS status, n AS records_processed, bad AS records_failed,
  n AS records_input, n - bad AS records_output FROM m""")
def run_log(spark, folder):
    """A run per year of bars, its counts observed while its rows are checked, in the run log and the lineage table."""
    path, at = work_folder(spark, "logs"), datetime(2024, 1, 1)
    bars = datasets.bars_table(spark, folder).withColumn("year", F.date_format("date", "yyyy"))
    per_year = bars.groupBy("year").agg(F.count("*").alias("n"), F.count_if(F.col("volume") < 2).alias("bad"))
    for r in per_year.collect():  # one row per year
        name, status = f"year_{r['year']}", "failed" if r["bad"] > r["n"] // 4 else "success"
        sinks.append_run(spark, f"{path}/runs", name, at, at, status, r["n"], r["bad"])
        sinks.append_lineage(spark, f"{path}/lineage", "bars", name, name, status == "success", r["n"], r["n"] - r["bad"], 1, name, at)
    runs = spark.read.schema(schemas.RUN_LOG).parquet(f"{path}/runs")
    lines = spark.read.schema(schemas.LINEAGE).parquet(f"{path}/lineage")
    both = runs.join(lines, runs["pipeline_name"] == lines["transformation_name"])
    counts = [F.col(c).cast("bigint").alias(c) for c in ("records_processed", "records_failed", "records_input", "records_output")]
    return both.select("pipeline_name", "status", *counts)


@query("newest_run", f"""WITH {BARS_SQL}, r AS (SELECT ticker AS run_id, {day_sql('max(date)')} AS start_time, count(*) AS bars FROM bars GROUP BY ticker)
  SELECT * FROM r ORDER BY start_time DESC, run_id DESC LIMIT 1""")
def newest_run(spark, folder):
    """The run that started last, ties by its id; a ticker's bars serve as a run."""
    runs = datasets.bars_table(spark, folder).groupBy(F.col("ticker").alias("run_id")).agg(F.max("date").cast("string").alias("start_time"), F.count("*").alias("bars"))
    return scoring.newest_run(runs)
