"""A Bloom filter per month, kept beside a table: which keys of a batch the table may hold, without reading the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import stored

BITS_PER_MAP = 32768  # fixed by Spark's bitmap functions: 4 KB each
HASHES = 2
MAPS = "month string, hash int, bucket bigint, bits binary"
MAY_HOLD = "__may_hold"


class KeyFilter:
    """Bitmaps by (month, hash, bucket) under ``path``.

    ``buckets`` bitmaps per month and hash bound the size of a month (2 MB with 256) and suit some million keys; with more
    keys more of a batch is looked up in the table, and nothing else changes. Only bitmaps that hold a key are written. A
    batch adds its own bitmaps and ``compact`` folds them; both ``bitmap`` aggregates combine before the shuffle.

    A key that the table holds is always told as possible, provided that whoever stores rows adds them here first. A month
    without any bitmap is one that the filter does not know: all of its keys are told as possible.
    """

    def __init__(self, path: str, keys: Sequence[str], column: str = "date", buckets: int = 256):
        self.path, self.keys, self.column, self.buckets = path, tuple(keys), column, buckets

    def _bit(self, number: int) -> Column:
        """The place of a key among all bits of a hash, from one on; null-safe, since a null key hashes too."""
        values = [F.coalesce(F.col(k).cast("string"), F.lit("\0null")) for k in self.keys]
        return F.pmod(F.xxhash64(F.lit(number), *values), F.lit(self.buckets * BITS_PER_MAP)) + 1

    def _month(self) -> Column:
        return F.date_format(self.column, "yyyy-MM")

    def maps(self, spark: SparkSession) -> DataFrame:
        """The merged bitmaps."""
        try:
            written = spark.read.schema(MAPS).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
            written = spark.createDataFrame([], MAPS)
        return written.groupBy("month", "hash", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def months(self, spark: SparkSession) -> list[str]:
        """Months that the filter knows; bounded by the calendar."""
        return [r[0] for r in self.maps(spark).select("month").distinct().collect()]

    def add(self, rows: DataFrame) -> None:
        """Add the keys of ``rows``. Adding them again, as a repeated run does, changes no answer."""
        bits = F.explode(F.array(*[F.struct(F.lit(h).alias("hash"), self._bit(h).alias("bit")) for h in range(HASHES)]))
        placed = rows.select(self._month().alias("month"), bits.alias("b")).select("month", "b.hash", "b.bit")
        placed = placed.where("month is not null").withColumn("bucket", F.bitmap_bucket_number("bit"))
        maps = placed.groupBy("month", "hash", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        maps.write.mode("append").partitionBy("month").parquet(self.path)

    def compact(self, spark: SparkSession) -> None:
        """One bitmap per (month, hash, bucket)."""
        merged = stored(self.maps(spark), "key-filter")
        merged.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(self.path)

    def mark(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``__may_hold``: false means that the table does not hold the key."""
        spark = rows.sparkSession
        maps, known = self.maps(spark), self.months(spark)
        out = rows.withColumn("__month", self._month())
        hit = F.lit(True)
        for h in range(HASHES):
            own = maps.where(F.col("hash") == h).select(F.col("month").alias("__month"), F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
            out = out.withColumn("__bit", self._bit(h)).withColumn("__bucket", F.bitmap_bucket_number("__bit"))
            out = out.join(own, ["__month", "__bucket"], "left")
            at = F.bitmap_bit_position("__bit")
            byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
            out = out.withColumn(f"__hit{h}", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("__bit", "__bucket", "__bits")
            hit = hit & F.col(f"__hit{h}")
        return out.withColumn(MAY_HOLD, hit | ~F.coalesce(F.col("__month").isin(known), F.lit(False))).select(*rows.columns, MAY_HOLD)
