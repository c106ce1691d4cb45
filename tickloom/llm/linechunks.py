"""Line deduplication by content-defined chunks of lines.

A rolling hash over each two neighbouring line hashes is taken at every line; where it is smaller than at both
neighbours, a chunk ends. Boundaries depend on a few lines around them only, so they return after an insertion, and a
chunk has two lines at least. Chunks with equal bytes that occur more than once in the whole table are kept where they
occur first, by (doc_id, place), and removed everywhere else.

Chunks alone miss most passages that two documents share, as a boundary beside the passage changes the chunk around it.
``without_repeats`` therefore also removes every run of whole lines with over ``WORDS`` words that occurs at an earlier
(doc_id, line): from each line the shortest run of over ``WORDS`` words that begins there and the shortest that ends
there are compared. Both depend on their own lines only, and together they cover any longer run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import keep_cache_of, numbered, picked, place_of

# Fixed value: a passage has more words than this.
WORDS = 50


def chunk_starts(lines: list[str]) -> list[int]:
    """Places of the lines that begin a chunk, and the end."""
    hashes = [hashlib.md5(x.encode()).hexdigest() for x in lines]
    rolled = [hashlib.md5((a + b).encode()).digest() for a, b in zip(hashes, hashes[1:])]
    ends = [i + 1 for i in range(1, len(rolled) - 1) if rolled[i - 1] > rolled[i] < rolled[i + 1]]
    return [0, *ends, len(lines)]


def chunks_of(text: str) -> list[tuple[int, int, str]]:
    """(first line, end, text) of the chunks of two or more lines."""
    lines = text.split("\n")
    if len(lines) < 2:
        return []
    cuts = chunk_starts(lines)
    return [(a, b, "\n".join(lines[a:b])) for a, b in zip(cuts, cuts[1:])]


def passages_of(text: str) -> list[tuple[int, int, bytes]]:
    """(first line, end, key) of the shortest runs of over ``WORDS`` words from and up to each line, each run once.

    A run begins and ends with a line that has a word, so it has at most ``WORDS`` + 1 of these; the key is a 128-bit
    BLAKE2 hash of the hashes of its lines and of the blank lines between them.
    """
    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    full = [i for i, n in enumerate(words) if n]
    parts, total = [], [0]
    for i, last in zip(full, [-1, *full]):
        blank = "\n".join(lines[last + 1 : i])
        parts += [_key(f"{i - last} {blank}".encode()), _key(lines[i].encode())]
        total.append(total[-1] + words[i])
    data, runs, a = b"".join(parts), set(), 0
    for b in range(len(full)):
        while total[b + 1] - total[a] > WORDS:  # each line that leaves here has its shortest run up to b
            runs.add((a, b))
            a += 1
        if a and total[b + 1] - total[a - 1] > WORDS:
            runs.add((a - 1, b))
    return [(full[a], full[b] + 1, _key(data[32 * a + 16 : 32 * (b + 1)])) for a, b in sorted(runs)]


def _key(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def without_lines(text: str, chunks: list[int], runs: list[dict[str, int]] = ()) -> tuple[str, int]:
    """Text without the numbered chunks and the runs of lines, and the count of lines removed."""
    lines = text.split("\n")
    cuts = chunk_starts(lines) if chunks else []
    spans = [(cuts[c], cuts[c + 1]) for c in chunks] + sorted((r["start"], r["end"]) for r in runs)
    gone, done = set(), 0
    for a, b in sorted(spans):
        gone.update(range(max(a, done), b))
        done = max(done, b)
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)


def chunk_table(texts: DataFrame, with_bytes: bool) -> DataFrame:
    """(doc_id, chunk, key[, bytes]) of a table of (doc_id, text)."""
    schema = "doc_id long, chunk int, key binary" + ", bytes binary" * with_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("")
        for batch in batches:
            ids, places, keys, values = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, (_, _, chunk) in enumerate(chunks_of(text)):
                    data = chunk.encode()
                    ids.append(doc)
                    places.append(i)
                    keys.append(hashlib.md5(data).digest())
                    if with_bytes:
                        values.append(data)
            columns = [pa.array(ids, pa.int64()), pa.array(places, pa.int32()), pa.array(keys, pa.binary())] + [pa.array(values, pa.binary())] * with_bytes
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "chunk", "key", "bytes"][: len(columns)])

    return texts.mapInArrow(run, schema)


def passage_table(texts: DataFrame) -> DataFrame:
    """(doc_id, start, end, key) of the runs of lines of a table of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("")
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if found := passages_of(text):
                    starts, ends, keys = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * len(found), pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(keys, pa.binary())],
                        ["doc_id", "start", "end", "key"])

    return texts.mapInArrow(run, "doc_id long, start int, end int, key binary")


def identified(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, text) of the rows that have both."""
    texts = picked(docs, id_column, text_column).toDF("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, runs): the runs of lines to remove, (start, end), from each document that has any."""
    place = F.struct("doc_id", "start")
    runs = passage_table(identified(docs, id_column, text_column))
    repeated = runs.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("uses")).where("uses > 1")
    found = runs.join(repeated.select("key", "first"), "key").where(~place.eqNullSafe(F.col("first")))
    return found.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("runs"))


def repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, chunks): the numbers of the chunks to remove from each document that has any.

    Rows are grouped by the bytes themselves, combined before the shuffle, so equality is that of the bytes. The short
    keys only carry the answer back; two different chunks of one key would both be left alone.
    """
    texts = identified(docs, id_column, text_column).where(F.instr("text", "\n") > 0)
    place = F.struct("doc_id", "chunk")
    by_bytes = chunk_table(texts, True).groupBy("bytes").agg(F.min(place).alias("first"), F.count("*").alias("uses"), F.first("key").alias("key"))
    repeated = by_bytes.where("uses > 1").groupBy("key").agg(F.first("first").alias("first"), F.count("*").alias("texts")).where("texts = 1")
    found = chunk_table(texts, False).join(repeated.select("key", "first"), "key").where(~place.eqNullSafe(F.col("first")))
    return found.groupBy("doc_id").agg(F.collect_set("chunk").alias("chunks"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", passages: bool = False) -> DataFrame:
    """All columns and rows of ``docs`` with repeated chunks, and ``passages`` if asked, removed from the text, and counts of lines.

    Adds ``n_lines`` and ``n_removed``. A null text stays null and has no lines; an empty text has one line. Rows that
    share a doc_id count as one document read once per row: a chunk is kept at its smallest place, in every such row.
    Rows with a null id lose nothing and make no other row lose a chunk. An empty table gives an empty one. Other columns stay as they are, whatever their names.
    """
    removed = repeated_chunks(docs, id_column, text_column)
    if passages:
        both = removed.unionByName(repeated_passages(docs, id_column, text_column), allowMissingColumns=True)
        removed = both.groupBy("doc_id").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("chunks", "runs")])
    names = removed.columns[1:]
    removed = removed.toDF("gone_id", *[f"gone_{c}" for c in names])
    plain = numbered(docs)
    joined = plain.join(removed, F.col(f"c{place_of(docs, id_column)}").cast("long") == F.col("gone_id"), "left").drop("gone_id")
    schema = joined.drop(*[f"gone_{c}" for c in names]).withColumns({"n_lines": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long")}).schema
    at, gone_at = place_of(docs, text_column), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("")
        for batch in batches:
            texts, *gone = [batch.column(k).to_pylist() for k in (at, *range(gone_at, gone_at + len(names)))]
            made = [(t, 0) if t is None or not any(c) else without_lines(t, *[x or [] for x in c]) for t, *c in zip(texts, *gone)]
            columns = list(batch.columns[:gone_at])
            columns[at] = pa.array([t for t, _ in made], columns[at].type)
            lines = [0 if t is None else t.count("\n") + 1 for t in texts]
            columns += [pa.array(lines, pa.int64()), pa.array([n for _, n in made], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema).toDF(*docs.columns, "n_lines", "n_removed")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The same rows and columns with repeated chunks and passages removed, and ``n_chars`` counted anew."""
    plain = numbered(deduplicated(docs, passages=True))
    text = F.col(f"c{place_of(docs, 'text')}")
    counts = {f"c{i}": F.length(text).cast(docs.schema[i].dataType) for i, c in enumerate(docs.columns) if c.lower() == "n_chars"}
    return plain.withColumns(counts).select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def _kept(docs: DataFrame, passages: bool) -> DataFrame:
    return deduplicated(docs.select("doc_id", "text"), passages=passages).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_kept"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark.read.parquet(f"{sf_dir}/documents.parquet"), False)


def op8_line_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line_dedup stage of the pipeline: chunks and passages."""
    return _kept(spark.read.parquet(f"{sf_dir}/documents.parquet"), True)


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS i, len(parts) AS n, parts[i] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), generate_series(1, 1000000) AS g(i)
  WHERE i <= len(parts)),
rolled AS (
  SELECT *, CASE WHEN i < n - 1 THEN md5(md5(line) || md5(lead(line) OVER w)) END AS r FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cut AS (
  SELECT *, coalesce(lag(r) OVER w > r AND r < lead(r) OVER w, false) AS ends FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM cut),
chunks AS (
  SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered WHERE n > 1 GROUP BY ALL),
gone AS (
  SELECT doc_id, chunk FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) AS rn FROM chunks) WHERE rn > 1),
marked AS (
  SELECT l.*, g.chunk IS NOT NULL AS removed FROM numbered l LEFT JOIN gone g USING (doc_id, chunk)),
kept AS (
  SELECT doc_id, count(*) AS n_lines, sum(removed::INT)::BIGINT AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT removed), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, length(k.text) AS n_kept, sha256(k.text) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)"""
