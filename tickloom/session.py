"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tickloom", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; sizes stay with the caller."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        b = b.config(key.replace("__", "."), value)
    return b.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for written intermediate tables and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``, or where that is unset in the warehouse: both
    can be reached by every executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "work")
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result that several branches of a plan use and that is much smaller than what it came from: the branches then
    read it instead of scanning the raw data again, and a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
