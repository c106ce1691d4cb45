"""Column access, document loops and folders that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: What clears the cache of an operator, by its module; only those that a worker has imported are there.
CACHES: dict[str, Callable[[], None]] = {}


def keep_cache_of(module: str) -> None:
    """Drop what other operators hold in this worker: the stages of a pipeline run in the same ones, and idle caches add up.

    What is freed goes back to the system: allocators keep it otherwise, and it counts beside what the next stage takes.
    """
    for name, clear in CACHES.items():
        if name != module:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def place_of(df: DataFrame, name: str) -> int:
    """Place of the first column of a name, spelled exactly so if there is one, else in any case."""
    return df.columns.index(name) if name in df.columns else [c.lower() for c in df.columns].index(name.lower())


def numbered(df: DataFrame) -> DataFrame:
    """The same columns called c0, c1, ...: no name can be ambiguous or clash with an added one."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The first column of each name. Other columns are left out, whatever they are called and however often."""
    return numbered(df).select(*[F.col(f"c{place_of(df, n)}").alias(n) for n in names])


def texts_of(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` as long and ``text``, a null text being empty."""
    own = picked(df, id_column, text_column)
    return own.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))


def each_text(docs: DataFrame, rows: Callable[[list[str]], Sequence[Sequence]], schema: str, key: str = "doc_id") -> DataFrame:
    """Apply ``rows`` to the texts of each Arrow batch; it returns the new columns, one value per text.

    Batches are bounded by Spark in rows and bytes; ``rows`` gets at most about four million characters at a time,
    or one text if that is longer.
    """
    out = docs.sparkSession.createDataFrame([], f"{key} long, {schema}").schema
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start = 0
            while start < len(texts):
                own, size = [], 0
                while start + len(own) < len(texts) and (not own or size < 4_000_000):
                    own.append(texts[start + len(own)].as_py())
                    size += len(own[-1])
                columns = rows(own)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, len(own)).cast(arrow.types[0])] + [pa.array(c, t) for c, t in zip(columns, arrow.types[1:], strict=True)], names)
                start += len(own)

    return docs.mapInArrow(run, out)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; where that is unset, as in tests, under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps don't repeat its work after a lost executor."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_new_text(docs: DataFrame, change: Callable[[str], str]) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` changed and ``n_chars``, if there, counted anew; a null text stays null."""
    plain, at = numbered(docs), place_of(docs, "text")
    count = place_of(docs, "n_chars") if "n_chars" in [c.lower() for c in docs.columns] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("")
        for batch in batches:
            columns = list(batch.columns)
            new = [None if t is None else change(t) for t in columns[at].to_pylist()]
            columns[at] = pa.array(new, columns[at].type)
            if count is not None:
                columns[count] = pa.array([None if t is None else len(t) for t in new], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
