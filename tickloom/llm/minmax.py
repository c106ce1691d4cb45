"""Near-duplicate documents by min-max hashing.

Under each permutation of the shingle hashes both the least and the greatest value are kept, so half as many hashes are
evaluated for a signature. Bands of the signature are bucket keys; buckets with the same members are one. A bucket is cut into
blocks of bounded size, and a task that has a block with its full shingle sets counts common shingles through an inverted
list, joins what is alike, and gives out one row per joined member, never a pair. A first wave takes single blocks of the
first bands, which joins groups of copies; a second one takes every other bucket that still holds several components, all
pairs of its blocks among them, so that no pair that shares a band is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import CACHES, keep_cache_of, numbered, picked, place_of, written
from tickloom.llm.components import components

PERMUTATIONS = 100
BAND_VALUES = 5
PERCENT = 80
#: Shingles of a block; a single larger set is a block of its own.
BLOCK_SHINGLES = 250_000
#: Bands of the first wave: a pair at Jaccard 0.8 shares one of them in 95 of 100 cases, closer ones more surely.
FIRST_BANDS = 8
#: Size of a filter that leaves out most rows without a partner before they are shuffled; a full one lets all rows pass.
FILTER_BITS = 1 << 26
CACHED_WORDS = 400_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordHashes(dict):
    """Hash of each word met; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()
CACHES["minmax"] = HASHES.clear


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; with fewer words the whole sequence is one, without any none."""
    parts = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, parts), np.uint64, len(parts))
    n = max(1, len(h) - words + 1)
    x = mixed(h[:n])
    for k in range(1, min(words, len(h))):
        x = mixed(x + h[k : k + n])
    return np.unique(x)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(10)
    return rng.integers(0, 1 << 63, count, dtype=np.uint64), rng.integers(0, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], count: int = PERMUTATIONS) -> np.ndarray:
    """(sets, 2 * count) values of 16 bits: the minima, then the maxima. Each set holds something."""
    whole = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), 2 * count), np.uint64)
    for p, (salt, odd) in enumerate(zip(*permutations(count))):
        y = (whole ^ salt) * odd
        out[:, p] = np.minimum.reduceat(y, starts)
        out[:, count + p] = np.maximum.reduceat(y, starts)
    return (mixed(out) >> np.uint64(48)).astype("<u2")


def signed(texts: DataFrame, words: int, count: int) -> DataFrame:
    """(doc_id, n, digest of the set, signature) of (doc_id, text); digest and signature are null for an empty set."""

    def rows_of(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [s for s in sets if len(s)]
        made = iter(signatures(full, count)) if full else iter(())
        digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
        values = [next(made).tobytes() if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(values, pa.binary())],
            ["doc_id", "n", "digest", "signature"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("minmax")
        for batch in batches:
            ids, sets, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                sets.append(shingle_set(text.as_py() or "", words))
                size += len(sets[-1])
                if size > 500_000:
                    yield rows_of(ids, sets)
                    ids, sets, size = [], [], 0
            yield rows_of(ids, sets)

    return texts.mapInArrow(run, "doc_id long, n long, digest binary, signature binary")


def filter_of(keys: DataFrame) -> np.ndarray:
    """A bit for the hash of each value of the only column: at most 8 MB on the driver, however many values there are."""
    (name,) = keys.columns
    bit = F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))
    words = keys.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({name}), {FILTER_BITS}) % 64 AS INT))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def likely(rows: DataFrame, key: str, bits: np.ndarray) -> DataFrame:
    """Rows whose ``key`` may be among those of the filter; other rows are left out, apart from a few."""
    names = rows.columns
    marked = rows.withColumn("bit", F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy()
            keep = bits[place >> 6].view(np.uint64) >> (place & 63).astype(np.uint64) & np.uint64(1)
            yield batch.filter(pa.array(keep.astype(bool))).select(names)

    return marked.mapInArrow(run, rows.schema)


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("minmax")
        for batch in batches:
            made = [shingle_set(t.as_py() or "", words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["id", "shingles"])

    return texts.mapInArrow(run, "id long, shingles binary")


def buckets_of(reps: DataFrame, count: int) -> DataFrame:
    """(key, band, id, block, blocks) of each bucket of several members; of buckets with the same members, that of the first band."""
    width = 2 * BAND_VALUES
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(2 * count // BAND_VALUES)])
    bands = reps.select(F.col("doc_id").alias("id"), "n", F.posexplode(keys).alias("band", "key"))
    head = F.min(F.struct(F.xxhash64("id").alias("h"), "id"))["id"]
    filled = bands.groupBy("key").agg(
        F.min("band").alias("band"), F.count("*").alias("members"), F.sum("n").alias("size"), head.alias("head"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y")).where("members > 1")
    single = filled.groupBy("members", "x", "y").agg(F.min(F.struct("band", "key", "size", "head")).alias("b"))
    chosen = written(single.select("b.key", F.ceil(F.col("b.size") / BLOCK_SHINGLES).cast("int").alias("blocks"), "b.head"), "band-buckets")
    held = likely(bands.select("key", "band", "id"), "key", filter_of(chosen.select("key"))).join(chosen, "key")
    return held.select("key", "band", "id", F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int").alias("block"), "blocks", "head")


def joined(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component of each row, as the place of one of them, by links of at least so much Jaccard on the full sets.

    Rows of one id are one. With several blocks only pairs across them count. Common shingles of a row with all others
    come from the lists of rows that have each shingle; a row whose others are all joined to it is passed over.
    """
    n, sizes = len(ids), np.fromiter(map(len, sets), np.int64, len(sets))
    whole = np.concatenate(sets)
    order = np.argsort(whole, kind="stable")
    fresh = np.ones(len(whole), bool)
    fresh[1:] = whole[order[1:]] != whole[order[:-1]]
    number = np.empty(len(whole), np.int64)
    number[order] = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    often = np.diff(np.append(first, len(whole)))
    having = np.repeat(np.arange(n), sizes)[order]
    starts = np.cumsum(sizes) - sizes
    _, component = np.unique(ids, return_inverse=True)
    several, left = (blocks != blocks[0]).any(), len(np.unique(component))
    for i in range(n):
        if left == 1:
            break
        others = (component != component[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])) & (sizes > 0)
        others[:i] = False
        if several:
            others &= blocks != blocks[i]
        if not others.any():
            continue
        own = number[starts[i] : starts[i] + sizes[i]]
        own = own[often[own] > 1]
        lengths = often[own]
        places = np.repeat(first[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        common = np.bincount(having[places], minlength=n)
        hit = others & (100 * common >= percent * (sizes + sizes[i] - common))
        for other in np.unique(component[hit]):
            component[component == other] = component[i]
            left -= 1
    return component


def links_in_cells(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): in each cell of ``cells`` (cell, id, block) each joined row with the least id of its component."""
    placed = cells.join(sets, "id").select("cell", "block", "id", "shingles").repartition("cell").sortWithinPartitions("cell", "id")

    def found(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        blocks, ids = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        component = joined(ids, blocks, [np.frombuffer(r[2], np.uint64) for r in rows], percent)
        root = np.full(component.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(root, component, ids)
        moved = root[component] != ids
        return ids[moved], root[component][moved]

    def batch_of(out: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in range(2))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("")
        rows: list[tuple] = []
        mark = None
        for batch in batches:
            out = []
            for cell, *row in zip(*[batch.column(c).to_pylist() for c in range(3)], batch.column(3)):
                if cell != mark:
                    if len(rows) > 1:
                        out.append(found(rows))
                    rows, mark = [], cell
                rows.append((row[0], row[1], row[2].as_py()))
            yield batch_of(out)
        if len(rows) > 1:
            yield batch_of([found(rows)])

    return placed.mapInArrow(run, "a long, b long").distinct()


def near_links(texts: DataFrame, reps: DataFrame, words: int, percent: int, count: int) -> DataFrame:
    """(a, b) links between the representatives ``reps`` (doc_id, n, signature), enough to give every component."""
    buckets = written(buckets_of(reps, count), "bucket-members")
    members = buckets.select("id").distinct()
    sets = written(shingle_sets(likely(texts.select(F.col("doc_id").alias("id"), "text").where("id IS NOT NULL"), "id", filter_of(members)), words), "shingle-sets")
    early = buckets.where(F.col("band") < FIRST_BANDS)
    heads = early.where("blocks > 1").select("key", "block", F.col("head").alias("id")).distinct()
    first = early.select("key", "block", "id").union(heads).distinct()
    links = written(links_in_cells(first.select(F.xxhash64("key", "block").alias("cell"), "id", F.lit(0).alias("block")), sets, percent), "first-links")

    now = components(links)
    held = buckets.where((F.col("band") >= FIRST_BANDS) | (F.col("blocks") > 1)).join(now, "id", "left")
    held = written(held.select("key", "id", "block", "blocks", F.coalesce("component_id", "id").alias("component")), "open-members")
    open_keys = held.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    spread = held.join(open_keys, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    return links.union(written(links_in_cells(spread.select(cell.alias("cell"), "id", "block"), sets, percent), "second-links"))


def near_documents(docs: DataFrame, words: int = 5, percent: int = PERCENT, count: int = PERMUTATIONS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document.

    Documents with equal sets are one class with one representative. A pair of Jaccard 0.8 shares one of the 40
    bands but for one case in ten million, a closer pair more surely still. A null text is an empty one; documents without words link with
    nothing, as do rows with a null id, which are kept. Rows that share an id are one vertex. An empty table gives an
    empty one; other columns are left out.
    """
    texts = picked(docs, id_column, text_column).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    table = written(signed(texts, words, count), "signatures")
    sound = table.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = sound.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    reps = sound.join(classes, "digest").where(F.col("doc_id") == F.col("class_id")).dropDuplicates(["doc_id", "digest"]).select("doc_id", "n", "signature")
    joined = components(near_links(texts, reps, words, percent, count))
    known = classes.join(joined.withColumnRenamed("id", "class_id"), "class_id", "left").select("digest", F.coalesce("component_id", "class_id").alias("found"))
    named = table.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(known, "digest", "left")
    component = F.coalesce("found", "doc_id")
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns: one of each group, the one of least id."""
    gone = near_documents(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    own_id = F.col(f"c{place_of(docs, 'doc_id')}").cast("long")
    return numbered(docs).join(gone, own_id == F.col("gone_id"), "left_anti").toDF(*docs.columns)


def op10_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
