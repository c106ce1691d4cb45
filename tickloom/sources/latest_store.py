"""A store of the newest row of each key whose writes follow the batch and not the table.

Keys are dealt to a fixed number of buckets. A batch adds one small folder with its newest rows, by bucket. Compaction folds the
batches of some buckets into new bases and then adds one manifest version, which names the base of every bucket; until that
version is there, readers see the old bases and all batches. A lookup reads the buckets of its keys only.

    path/deltas/batch=7/bucket=3      rows of a batch
    path/bases/bucket=3/upto=7        rows of all batches up to 7
    path/manifest/version=2           (bucket, upto) of every bucket that has a base
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("upto", T.LongType()), T.StructField("version", T.LongType())])


@dataclass(frozen=True)
class LatestStore:
    """Where the store lies, its keys, the column whose greatest value is newest, its columns, and the number of buckets.

    Ties of ``ts`` go to the greatest row by the other columns, so the content doesn't depend on the order of batches.
    """

    path: str
    keys: tuple[str, ...]
    ts: str
    schema: T.StructType
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row per (bucket, key); combined before the shuffle."""
        rest = [c for c in self.schema.names if c not in (self.ts, *self.keys)]
        held = rows.groupBy("bucket", *self.keys).agg(F.max(F.struct(self.ts, *rest)).alias("r"))
        return held.select("bucket", *self.keys, "r.*").select(*self.schema.names, "bucket")

    def write(self, batch: DataFrame, number: int) -> None:
        """The newest rows of batch ``number``. A batch that is written again replaces itself; rows with a null key are left out."""
        known = batch.select(*self.schema.names).where(" AND ".join(f"`{k}` IS NOT NULL" for k in self.keys)).withColumn("bucket", self.bucket())
        self.newest(known).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/deltas/batch={number}")

    def _read(self, spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame | None:
        try:
            return spark.read.schema(schema).option("recursiveFileLookup", False).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
            return None

    def _with(self, *columns: str) -> T.StructType:
        return T.StructType([*self.schema.fields, *[T.StructField(c, T.IntegerType() if c == "bucket" else T.LongType()) for c in columns]])

    def manifest(self, spark: SparkSession) -> dict[int, int]:
        """The batch up to which each bucket has a base, by the newest version: at most one entry per bucket."""
        rows = self._read(spark, "manifest", MANIFEST)
        if rows is None:
            return {}
        newest = rows.groupBy("bucket").agg(F.max_by("upto", "version").alias("upto")).collect()
        return {r["bucket"]: r["upto"] for r in newest}

    def _rows(self, spark: SparkSession, buckets: Iterable[int] | None, upto: int | None = None) -> DataFrame:
        """Base rows and later batches of some buckets (all of them with None), batches after ``upto`` left out."""
        own = None if buckets is None else sorted(set(buckets))
        bases = self.manifest(spark)
        based = {b: n for b, n in bases.items() if own is None or b in own}
        out = spark.createDataFrame([], self._with("bucket"))
        deltas = self._read(spark, "deltas", self._with("batch", "bucket"))
        if deltas is not None:
            if own is not None:
                deltas = deltas.where(F.col("bucket").isin(own))
            if upto is not None:
                deltas = deltas.where(F.col("batch") <= upto)
            if based:
                # A filter of partition columns alone: folded batches are not opened.
                first = min(based.values()) if len(based) == (self.buckets if own is None else len(own)) else None
                known = F.create_map(*[F.lit(x) for pair in based.items() for x in pair])
                deltas = deltas.where(F.coalesce(F.col("batch") > known[F.col("bucket")], F.lit(True)))
                deltas = deltas if first is None else deltas.where(F.col("batch") > first)
            out = out.union(deltas.select(*self.schema.names, "bucket"))
        if based:
            files = self._read(spark, "bases", self._with("bucket", "upto"))
            by_upto: dict[int, list[int]] = {}
            for b, n in based.items():
                by_upto.setdefault(n, []).append(b)
            wanted = F.lit(False)
            for n, some in by_upto.items():
                wanted = wanted | ((F.col("upto") == n) & F.col("bucket").isin(some))
            out = out.union(files.where(wanted).select(*self.schema.names, "bucket"))
        return out

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The newest row of every key."""
        return self.newest(self._rows(spark, None, upto)).drop("bucket")

    def lookup(self, requests: DataFrame) -> DataFrame:
        """The newest rows of the keys in ``requests``, from their buckets alone. Unknown keys have no row."""
        spark, asked = requests.sparkSession, requests.select(*self.keys).distinct()
        buckets = [r[0] for r in asked.select(self.bucket()).distinct().collect()]  # at most one per bucket
        return self.newest(self._rows(spark, buckets).join(asked, list(self.keys), "left_semi")).drop("bucket")

    def compact(self, spark: SparkSession, upto: int, buckets: Sequence[int] | None = None) -> None:
        """Fold the batches up to ``upto`` of some buckets into new bases.

        Giving a share of the buckets each time bounds the work of one call. The manifest version comes last, so a call that
        fails leaves the store as it was and can be repeated.
        """
        own = list(range(self.buckets)) if buckets is None else sorted(set(buckets))
        before = self.manifest(spark)
        own = [b for b in own if before.get(b, -1) < upto]
        if not own:
            return
        whole = self.newest(self._rows(spark, own, upto)).withColumn("upto", F.lit(upto).cast("long"))
        # A bucket of an earlier base keeps its folder: dynamic overwriting replaces the folders that the rows name.
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "upto").parquet(f"{self.path}/bases")
        versions = self._read(spark, "manifest", MANIFEST)
        last = None if versions is None else versions.agg(F.max("version")).first()[0]
        rows = spark.createDataFrame([(b, upto) for b in own], "bucket int, upto long").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/manifest/version={0 if last is None else last + 1}")

    def folded(self, spark: SparkSession) -> int | None:
        """The last batch that every bucket's base holds: deltas up to it can be dropped."""
        bases = self.manifest(spark)
        return min(bases.values()) if len(bases) == self.buckets else None
