"""Near-duplicate vectors by p-stable hashing.

Normalised vectors are projected on random Gaussian directions, and the quantised projections form a key in each of
several tables. Vectors that share a key are compared by exact cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import picked, written
from tickloom.llm.components import components

LEAST_COSINE = 0.93
TABLES = 16
PROJECTIONS = 4
WIDTH = 1.0
CELL_ROWS = 2048


def directions(size: int, tables: int, projections: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([9, size])
    return rng.standard_normal((size, tables * projections)), rng.uniform(0, width, tables * projections)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def bucket_keys(unit: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """(rows, tables) keys: the quantised projections of a table mixed into one number."""
    lines, shift = directions(unit.shape[1], tables, projections, width)
    codes = np.floor((unit @ lines + shift) / width).astype(np.int64).reshape(len(unit), tables, projections)
    odd = np.random.default_rng(99).integers(1, 1 << 62, projections, dtype=np.int64) * 2 + 1
    with np.errstate(over="ignore"):
        return (codes * odd).sum(axis=2)


def with_keys(classes: DataFrame, tables: int, projections: int, width: float) -> DataFrame:
    """(class_id, label, copies, vector binary, keys) of (class_id, label, copies, vector array<double>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(3).to_pylist()
            keys: list = [None] * len(rows)
            for size in {len(r) for r in rows}:
                own = [i for i, r in enumerate(rows) if len(r) == size]
                for i, k in zip(own, bucket_keys(unit_rows(np.array([rows[i] for i in own])), tables, projections, width).tolist()):
                    keys[i] = k
            data = [np.array(r, "<f8").tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(data, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["class_id", "label", "copies", "vector", "keys"])

    return classes.select("class_id", "label", "copies", "vector").mapInArrow(run, "class_id long, label string, copies long, vector binary, keys array<long>")


def linked_in(ids: np.ndarray, copies: np.ndarray, vectors: list[bytes], keys: np.ndarray, sides: np.ndarray, table: int, least: float) -> list[tuple[int, int, int]]:
    """(class_id, links, root) of the members of one cell. Pairs that met in an earlier table are left to it."""
    unit = unit_rows(np.frombuffer(b"".join(vectors), "<f8").reshape(len(ids), -1))
    links = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    split = sides.any()
    for start in range(0, len(ids), 512):
        stop = min(start + 512, len(ids))
        near = unit[start:stop] @ unit.T >= least
        i, j = np.nonzero(near)
        i += start
        pair = (i < j) & (ids[i] != ids[j])
        if split:
            pair &= sides[i] != sides[j]
        i, j = i[pair], j[pair]
        if table and len(i):
            fresh = np.concatenate([~(keys[i[k : k + 100_000], :table] == keys[j[k : k + 100_000], :table]).any(axis=1) for k in range(0, len(i), 100_000)])
            i, j = i[fresh], j[fresh]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        for a in np.unique(i):
            for b in j[i == a]:
                ra, rb = find(a), find(b)
                if ra != rb:
                    root[rb] = ra
    return [(int(ids[i]), int(links[i]), int(ids[find(i)])) for i in np.flatnonzero(links)]


def cell_links(keyed: DataFrame, least: float, cell_rows: int) -> DataFrame:
    """(class_id, links, root) found in all cells. A bucket is one cell; a large one is cut into blocks, and each pair of blocks is a cell."""
    tables = F.posexplode("keys").alias("table", "key")
    sizes = keyed.select("label", F.octet_length("vector").alias("size"), tables).groupBy("label", "size", "table", "key").agg(F.count("*").alias("n"))
    filled = written(sizes.where("n > 1"), "buckets")
    rows = keyed.select("class_id", "copies", "vector", "keys", "label", F.octet_length("vector").alias("size"), tables).join(filled, ["label", "size", "table", "key"])
    blocks = F.ceil(F.col("n") / (cell_rows // 2)).cast("int")
    block = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    other = F.when(F.col("n") <= cell_rows, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = rows.withColumn("blocks", blocks).withColumn("block", F.when(F.col("n") <= cell_rows, F.lit(0)).otherwise(block)).withColumn("other", F.explode(other))
    placed = cells.select(
        F.xxhash64("label", "size", "table", "key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "table", "label", "key",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"), "class_id", "copies", "vector", "keys")
    ordered = placed.repartition("cell").sortWithinPartitions("cell", "table", "label", "key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        mark = None
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            columns = [batch.column(k).to_pylist() for k in range(11)]
            for row in zip(*columns):
                where = (*row[:6], len(row[9]))
                if where != mark:
                    found += of_cell(held, mark, least)
                    held, mark = [], where
                held.append(row[6:])
            yield link_rows(found)
        yield link_rows(of_cell(held, mark, least))

    return ordered.mapInArrow(run, "class_id long, links long, root long")


def of_cell(held: list[tuple], mark: tuple | None, least: float) -> list[tuple[int, int, int]]:
    if len(held) < 2:
        return []
    side, ids, copies, vectors, keys = zip(*held)
    return linked_in(np.array(ids), np.array(copies), list(vectors), np.array(keys), np.array(side), mark[1], least)


def link_rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["class_id", "links", "root"])


def near_vectors(table: DataFrame, least: float = LEAST_COSINE, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH,
                 cell_rows: int = CELL_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each vector, linked within its label by cosine of at least ``least``.

    Equal vectors of a label are one class and are compared once; a vector counts every member of a linked class and its
    own copies. Null, zero and non-finite vectors, null labels and null ids link with nothing; such a row is its own
    component and kept. Vectors of different lengths don't link. Rows that share a vec_id are one vertex with the
    links of all of them. An empty table gives an empty one; other columns are left out.
    """
    own = picked(table, "vec_id", "embedding", "label").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(~bad & F.exists("vector", lambda x: x != 0), F.lit(False))
    marked = own.withColumn("digest", F.when(sound, F.sha2(F.to_json(F.struct("label", "vector")), 256)))
    valid = marked.where(F.col("digest").isNotNull())
    classes = written(valid.groupBy("digest").agg(F.min("vec_id").alias("class_id"), F.first("label").alias("label"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "vector-classes")
    keyed = written(with_keys(classes, tables, projections, width), "vector-keys")
    found = written(cell_links(keyed, least, cell_rows), "vector-links")
    joined = components(found.where("class_id <> root").select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    known = classes.select("digest", "class_id", "copies").join(links, "class_id", "left").join(joined.withColumnRenamed("id", "class_id"), "class_id", "left")
    known = known.select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component_id", "class_id").alias("component"))
    out = marked.join(known, "digest", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
