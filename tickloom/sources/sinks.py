"""Writers: partitioned tables, append without duplicates, upsert, metadata, logs, retention."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.clean import keep_first
from tickloom.operators.validate import insert_candidates, newest_wins
from tickloom.session import stored, work_folder
from tickloom.sources import schemas
from tickloom.sources.key_filter import MAY_HOLD, KeyFilter

MONTH = "month"
BAR_KEY = ("ticker", "date", "source")


def with_month(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn(MONTH, F.date_format(column, "yyyy-MM"))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A month-partitioned table, empty when nothing has been written yet."""
    full = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    try:
        return spark.read.schema(full).option("recursiveFileLookup", False).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], full)


def write_by_month(df: DataFrame, path: str, mode: str = "append", column: str = "date") -> None:
    """Files by month, ordered by (ticker, date) inside a file so that column statistics can skip row groups.

    The rebalance hint lets adaptive execution cut a large month into several files and join small ones.
    """
    out = with_month(df, column)
    out = out.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "ticker", column)
    writer = out.write.mode(mode).partitionBy(MONTH)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _touched_months(df: DataFrame, column: str) -> list[str]:
    """Months in a batch. Bounded by the calendar; read on the driver so that the scan is pruned by literals."""
    return [r[0] for r in df.select(F.date_format(column, "yyyy-MM")).distinct().collect()]


def observed(seen: Observation, name: str) -> int:
    """A count seen by a finished write. A write that adaptive execution found to be empty runs no observed step and
    leaves no row to read; its count is zero."""
    try:
        return seen.get.get(name, 0)
    except Py4JJavaError:
        return 0


def storable(spark: SparkSession, new: DataFrame, path: str, schema: T.StructType, ignored: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """The rows whose values all fit the schema, and the count of the others; these go to ``<path>_quarantine`` as they are.

    ``ignored`` columns, such as the time of the run, are left out there, so that a repeated run adds nothing.
    """
    checked = stored(new.withColumn("__lost", schemas.lost(new, schema)), "storable")
    bad = checked.where(F.size("__lost") > 0)
    if count := bad.count():
        error = F.concat(F.lit("Value outside the stored type: "), F.array_join("__lost", ", "))
        append_new_rows(spark, bad.withColumn("validation_error", error).drop("__lost", *ignored), f"{path.rstrip('/')}_quarantine")
    return checked.where(F.size("__lost") == 0).drop("__lost"), count


def append_if_absent(spark: SparkSession, new: DataFrame, path: str, schema: T.StructType = schemas.RAW_BARS,
                     keys: tuple[str, ...] = BAR_KEY, known: KeyFilter | None = None) -> int:
    """Insert rows whose key is not stored; returns how many were inserted. A second run inserts none.

    Rows with a value that the schema cannot hold go to ``<path>_quarantine``. With ``known``, a filter of the stored keys,
    only months that may hold a key of the batch are read, and only for the rows in question; the result is the same.
    """
    new, _ = storable(spark, new, path, schema, ("ingested_at", "updated_at"))
    seen = Observation("inserted")
    if known is None:
        months = _touched_months(new, "date")
        existing = read_table(spark, path, schema).where(F.col(MONTH).isin(months))
        rows = insert_candidates(schemas.conform(new, schema), existing, keys)
    else:
        rows = _unknown_rows(spark, schemas.conform(new, schema), path, schema, keys, known)
    write_by_month(rows.observe(seen, F.count(F.lit(1)).alias("n")), path)
    return observed(seen, "n")


def _unknown_rows(spark: SparkSession, new: DataFrame, path: str, schema: T.StructType, keys: tuple[str, ...], known: KeyFilter) -> DataFrame:
    """Rows of ``new`` to insert. Their keys, and all keys of months that the filter did not know, are added to it before
    the rows are written: after a failure in between the filter tells too much, never too little."""
    marked = stored(known.mark(keep_first(new, keys)), "marked")
    months = _touched_months(marked.where(MAY_HOLD), "date")
    rows = marked.where(~F.col(MAY_HOLD)).drop(MAY_HOLD)
    if months:
        existing = read_table(spark, path, schema).where(F.col(MONTH).isin(months))
        rows = rows.unionByName(marked.where(MAY_HOLD).drop(MAY_HOLD).join(existing.select(*keys), list(keys), "left_anti"))
        learned = existing.where(~F.col(MONTH).isin(known.months(spark))).select(*keys)
        rows = stored(rows, "unknown")
        known.add(rows.select(*keys).unionByName(learned))
    else:
        known.add(rows)
    return rows


def append_new_rows(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Append the rows of which no equal one is stored, so that a repeated run adds nothing."""
    digest = F.sha2(F.to_json(F.struct(*sorted(new.columns))), 256)
    try:
        known = spark.read.schema(new.schema).parquet(path).select(digest.alias("__known")).distinct()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        known = spark.createDataFrame([], "__known string")
    fresh = new.withColumn("__own", digest).join(known, F.col("__own") == F.col("__known"), "left_anti").drop("__own")
    fresh.write.mode("append").parquet(path)


def upsert(spark: SparkSession, new: DataFrame, path: str, schema: T.StructType, keys: tuple[str, ...] = ("ticker", "date"),
           version: str = "computed_at") -> int:
    """Insert or replace by key, the greatest ``version`` winning. Only the months of the batch are rewritten.

    Rows with a value that the schema cannot hold go to ``<path>_quarantine``; returns how many.

    The merged months are written to the shared work folder first, because a table cannot be read and replaced in
    one job; a run that fails before the second write leaves the table as it was.
    """
    new, rejected = storable(spark, new, path, schema, (version,))
    months = _touched_months(new, "date")
    existing = read_table(spark, path, schema).where(F.col(MONTH).isin(months)).drop(MONTH)
    staged = work_folder(spark, "upsert")
    newest_wins(existing, schemas.conform(new, schema), keys, version).write.parquet(staged)
    write_by_month(spark.read.schema(schema).parquet(staged), path, "overwrite")
    return rejected


def months_of(df: DataFrame) -> list[str]:
    """Months of a table that has them as a column; bounded by the calendar."""
    return [r[0] for r in df.select(MONTH).where(F.col(MONTH).isNotNull()).distinct().collect()]


def replace_months(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Write whole months in place of those of the table; ``rows`` may be read from it, so they are staged first."""
    staged = stored(rows, "months")
    staged.hint("rebalance", F.col(MONTH)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def write_splits(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One subfolder per value of ``split``."""
    writer = df.write.mode("overwrite").partitionBy("split")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_bars(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_metadata(spark: SparkSession, path: str, **fields: object) -> None:
    """A one-row JSON description of a run."""
    spark.createDataFrame([(json.dumps(fields, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def append_run(spark: SparkSession, path: str, pipeline: str, start: datetime, end: datetime | None, status: str,
               processed: int | None = None, failed: int | None = None, error: str | None = None, run_id: str | None = None) -> None:
    row = [(pipeline, start, end, status, processed, failed, error, run_id)]
    spark.createDataFrame(row, schemas.RUN_LOG).write.mode("append").parquet(path)


def append_lineage(spark: SparkSession, path: str, source: str, target: str, name: str, ok: bool, rows_in: int | None,
                   rows_out: int | None, millis: int, by: str, at: datetime, details: dict | None = None) -> None:
    row = [(source, target, name, ok, rows_in, rows_out, millis, by, at, json.dumps(details or {}, default=str))]
    spark.createDataFrame(row, schemas.LINEAGE).write.mode("append").parquet(path)


def append_snapshot(snapshot: DataFrame, path: str) -> None:
    schemas.conform(snapshot, schemas.DATASET_SNAPSHOT).write.mode("append").parquet(path)


def split_by_age(df: DataFrame, as_of: date, keep_days: int, column: str = "date") -> tuple[DataFrame, DataFrame]:
    """(rows kept, rows past the limit)."""
    bound = F.date_sub(F.lit(as_of), keep_days)
    return df.where(F.col(column) >= bound), df.where(F.col(column) < bound)


def archive_expired(df: DataFrame, archive: str, as_of: date, keep_days: int, column: str = "date") -> Sequence[str]:
    """Copy whole expired months to an archive; returns the months, whose partitions the table owner may then drop."""
    limit = F.date_format(F.date_sub(F.lit(as_of), keep_days), "yyyy-MM")
    old = with_month(df.drop(MONTH), column).where(F.col(MONTH) < limit)
    months = sorted(_touched_months(old, column))
    if months:
        write_by_month(old.drop(MONTH), archive, "overwrite", column)
    return months


RAW_KEEP_DAYS = 730
