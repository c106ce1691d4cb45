"""Best-fit packing of token sequences, bulk-synchronously.

Texts become pieces of at most one sequence's tokens. Pieces and gaps are sorted by size; in each round the pieces of the
largest size left are matched with the successors of that size among the gaps, the fullest sequences first, conflicts being
resolved by rank: the n-th piece takes the n-th of the gaps. Then the gaps are updated, and the next size follows.

Equal pieces and equal gaps are interchangeable, so a round runs over classes, of which there are as many as sizes (2048)
whatever the data: only the count of pieces of each size leaves the cluster. The rows themselves are range-sorted and
numbered by Spark, and each finds its place from its rank.
"""

from __future__ import annotations

import gc
import json
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import CACHES, keep_cache_of, texts_of, written

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
CACHED_CHUNKS = 700_000
CACHED_WORDS = 500_000
#: Python parts a text at these, the tokenizer doesn't.
UNUSUAL = "\x1c\x1d\x1e\x1f"
# Fixed value: the pattern by which the vocabulary's tokenizer splits a text in lower case.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Cache:
    """A bounded mapping of two generations, so that what is in use stays."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """Keys that are not known; what was known in the older generation is moved to the younger."""
        gone = keys.difference(self.young)
        moved = {k for k in gone if k in self.old}  # an intersection with a mapping would go over all of it
        if moved:
            self.young.update((k, self.old[k]) for k in moved)
        return gone - moved

    def learn(self, found: dict[str, bytes], in_use: set[str]) -> None:
        self.young.update(found)
        if len(self.young) > self.size:
            self.old, self.young = self.young, {k: self.young[k] for k in in_use}  # what was looked up before stays reachable


class Tokens:
    """Ids of texts as little-endian 32-bit integers.

    Tokens never cross white space, so the ids of each chunk between spaces are kept in a bounded cache, and those of its
    words in lower case in another. New words are merged together by the tokenizer's model; a word's last token is marked.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        level = parts["pre_tokenizer"]["pretokenizers"][-1]
        plain = parts | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, level]}}
        self.words = Tokenizer.from_str(json.dumps(plain))
        suffix = parts["model"]["end_of_word_suffix"]
        self.last = np.zeros(max(parts["model"]["vocab"].values()) + 1, bool)
        self.last[[i for t, i in parts["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.chunk_cache, self.word_cache = Cache(CACHED_CHUNKS), Cache(CACHED_WORDS)

    def directly(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words in lower case, merged in one call."""
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return {w: self.directly(w) for w in words}
        data, out, begin = ids.tobytes(), {}, 0
        for word, end in zip(words, (ends * 4).tolist()):
            out[word] = data[begin:end]
            begin = end
        return out

    def learned(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks; a chunk whose words are all known is put together at once."""
        out, open_chunks, known = {}, {}, self.word_cache.young.get
        for chunk in chunks:
            if chunk.isascii():
                low = chunk.lower()
            else:
                whole = chunk if unicodedata.is_normalized("NFC", chunk) else unicodedata.normalize("NFC", chunk)
                low = whole.lower() if "\u03a3" not in whole else "".join(c.lower() for c in whole)  # the last sigma of a word
            if low.isalpha():
                if (ids := known(low)) is not None:
                    out[chunk] = ids
                else:
                    open_chunks[chunk] = (low,)
            else:
                words = (low[:-1], low[-1]) if low[-1] in ".,!?;:" and low[:-1].isalpha() else PIECES.findall(low)
                parts = list(map(known, words))
                if None in parts:
                    open_chunks[chunk] = words
                else:
                    out[chunk] = b"".join(parts)
        needed = set(chain.from_iterable(open_chunks.values()))
        fresh, found = list(self.word_cache.missing(needed)), {}
        for i in range(0, len(fresh), 20_000):
            found |= self.merged(fresh[i : i + 20_000])
        self.word_cache.learn(found, needed)
        get = self.word_cache.young.__getitem__
        out.update((c, b"".join(map(get, words))) for c, words in open_chunks.items())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Many tuples live for a moment and none is part of a cycle, so no cycles are looked for meanwhile."""
        looks = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if looks:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [None if any(c in t for c in UNUSUAL) else t.split() for t in texts]
        get = self.chunk_cache.young.get
        known = [None if s is None else list(map(get, s)) for s in split]
        gaps = [() if k is None else gaps_of(k) for k in known]
        unknown = {s[i] for s, g in zip(split, gaps) for i in g}
        if unknown:
            fresh = self.chunk_cache.missing(unknown)
            found = self.learned(fresh)
            found.update((c, self.chunk_cache.young[c]) for c in unknown - fresh)
            self.chunk_cache.learn(found, unknown)
            for s, k, g in zip(split, known, gaps):
                for i in g:
                    k[i] = found[s[i]]
        return [self.directly(t) if k is None else b"".join(k) for t, k in zip(texts, known)]


def gaps_of(values: list) -> list[int]:
    """Places of None."""
    out, i = [], -1
    try:
        while True:
            i = values.index(None, i + 1)
            out.append(i)
    except ValueError:
        return out


@lru_cache(2)
def tokens(path: str | None) -> Tokens:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return Tokens(path)


CACHES["packing"] = tokens.cache_clear


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the ids of each text and the end id, cut only above ``capacity``."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("packing")
        for batch in batches:
            keys, column, at = batch.column(0).to_pylist(), batch.column(1), 0
            while at < len(keys):
                own, size = [], 0
                while at + len(own) < len(keys) and (not own or size < 2_000_000):
                    own.append(column[at + len(own)].as_py())
                    size += len(own[-1])
                rows: list[tuple] = []
                for key, ids in zip(keys[at:], tokens(vocabulary).encode(own)):
                    ids += END_ID.to_bytes(4, "little")
                    for k, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        rows.append((key, k, start, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4").tolist() if keep_ids else None))
                at += len(own)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)

    return texts_of(docs, id_column, text_column).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """(rows of rank, sequence, offset; sequences used): from each rank on, pieces go to sequences from there on, at that offset.

    Ranks order the pieces by size, the largest first. A run of sequences with one gap stays together until a round
    takes a part of it, so at most two runs come with each size.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    out: list[tuple[int, int, int]] = []
    rank = used = 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, count))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(sizes, size)
            if at < len(sizes):
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
                taken = min(count, left)
                put(gap, first + taken, count - taken)
            else:
                gap, first = capacity, used
                taken = max(1, left // (capacity // size))  # sequences that this size fills, or one with the rest
                used += taken
            out.append((rank, first, capacity - gap))
            put(gap - size, first, taken)
            rank += taken
            left -= taken
    return np.array(out, np.int64).reshape(-1, 3), used


def packed(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if kept).

    A null or empty text is one piece of the end id alone. Repeated rows are packed each; a null id stays null; an
    empty table gives an empty one; other columns are left out.
    """
    # Written first, as a range partitioning reads its input twice, once for a sample.
    made = written(pieces(docs, vocabulary, capacity, keep_ids, id_column, text_column), "unplaced-pieces")
    ordered = made.repartitionByRange(F.desc("length"), F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.desc("length"), F.xxhash64("doc_id", "piece"), "doc_id", "piece")
    placed = written(ordered.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in placed.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    # The partition is in the upper bits of the row number; a count for each of them makes the numbers gapless.
    share = placed.groupBy(F.shiftright("__row", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    firsts = np.cumsum([0] + [r["n"] for r in share])[:-1]
    parts = np.array([r["part"] for r in share], np.int64)
    steps, _ = plan(counts, capacity)
    schema = placed.drop("__row").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(batch.num_columns - 1).to_numpy()
            rank = firsts[np.searchsorted(parts, row >> 33)] + (row & ((1 << 33) - 1))
            step = steps[np.searchsorted(steps[:, 0], rank, side="right") - 1]
            columns = [*batch.columns[:-1], pa.array(step[:, 1] + rank - step[:, 0]), pa.array(step[:, 2])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return placed.mapInArrow(run, schema)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
