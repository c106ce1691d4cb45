"""The newest row of each key as a maintained view: inserts, corrections and deletions with retraction.

A change decides by itself when it is newer than the view's row or touches an older one. Only where the view's own row was
corrected or deleted does the next one come back from the base table, read for those keys alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import stored

BUCKET = "bucket"


def newest(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def lost_keys(view: DataFrame, changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keys whose row in the view was corrected or deleted: ``changes`` has (keys, order) of every changed row."""
    hit = changes.select(*keys, F.col(order).alias("changed")).distinct()
    return view.select(*keys, order).join(hit, list(keys)).where(F.col(order) == F.col("changed")).select(*keys).distinct()


def refreshed(view: DataFrame, base: DataFrame, changes: DataFrame, keys: Sequence[str], order: str, deleted: str = "deleted") -> DataFrame:
    """New rows of the view for the keys in ``changes``; a key without any row left has none.

    ``base`` is the table after the changes; ``changes`` has its columns and a flag for deletions. One row per (keys,
    order) in ``base``. A key that only has newer inserts, or changes of older rows, doesn't read ``base``.
    """
    columns = [c for c in view.columns]
    touched = changes.select(*keys).distinct()
    lost = stored(lost_keys(view, changes, keys, order), "lost-keys")
    again = newest(base.join(lost, list(keys), "left_semi").select(*columns), keys, order)
    sure = view.join(touched, list(keys), "left_semi").unionByName(changes.where(~F.col(deleted)).select(*columns))
    return newest(sure.join(lost, list(keys), "left_anti"), keys, order).unionByName(again)


def read_view(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored view with its bucket, empty when nothing has been written yet."""
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    try:
        return spark.read.schema(full).option("recursiveFileLookup", False).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], full)


def maintain(spark: SparkSession, path: str, base: DataFrame, changes: DataFrame, keys: Sequence[str], order: str, schema: T.StructType, buckets: int = 64) -> None:
    """Apply a batch of changes to the stored view. Only the buckets of its keys are read and written.

    A batch that is applied again changes nothing. Each written bucket has a row without a key, which readers leave out, so
    that a bucket that loses its last key is replaced too.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    own = [r[0] for r in changes.select(bucket).distinct().collect()]  # at most ``buckets`` rows
    if not own:
        return
    before = read_view(spark, path, schema).where(F.col(BUCKET).isin(own) & F.col(keys[0]).isNotNull())
    view = before.drop(BUCKET)
    fresh = refreshed(view, base, changes, keys, order)
    rest = view.join(changes.select(*keys).distinct(), list(keys), "left_anti")
    whole = rest.unionByName(fresh).select(*schema.names, bucket)
    marks = spark.createDataFrame([(b,) for b in own], f"{BUCKET} int").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], BUCKET)
    stored(whole.unionByName(marks), "view").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def view_rows(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of the stored view."""
    return read_view(spark, path, schema).where(F.col(keys[0]).isNotNull()).drop(BUCKET)
