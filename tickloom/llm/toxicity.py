"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are rates of one text: hits in lexicons, their closeness to the second person, capitals, punctuation, digits
and obfuscated words. One lexicon is given; the other, of words and word beginnings, is learned from the labelled rows.
The trees are fitted on a bounded sample of labelled rows and calibrated on labelled rows that they have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import keep_cache_of, numbered, picked, place_of, written

TRAINING_ROWS = 20_000
LEXICON_TERMS = 400
LEAST_DOCUMENTS = 4
LEAST_ODDS = 1.0
PREFIXES = (4, 5)
REJECT_AT = 0.7

# A short list of insults, words of the second person, and signs that stand for letters.
INSULTS = frozenset("idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool jerk liar garbage filth vermin coward freak imbecile creep pig rat".split())
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
LOOKALIKES = str.maketrans("013457@$!|*", "oieastasiix")

WORD = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$!|*]++[^\W\d_]++|[^\W\d_](?:[.\-*_][^\W\d_]){3,}+")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
N_FEATURES = 18


@dataclass(frozen=True)
class Lexicon:
    """Learned terms with their log odds: whole words, and beginnings marked by a trailing star."""

    terms: dict[str, float]

    @cached_property
    def beginnings(self) -> list[tuple[int, frozenset[str]]]:
        own = [(k, frozenset(t[:-1] for t in self.terms if len(t) == k + 1 and t.endswith("*"))) for k in PREFIXES]
        return [(k, s) for k, s in own if s]

    def hits(self, words: list[str]) -> tuple[list[int], list[int], float]:
        """Places of whole-word hits and of hits on beginnings, and the highest odds."""
        terms = self.terms
        whole = [i for i, w in enumerate(words) if w in terms]
        first = sorted({i for k, s in self.beginnings for i, w in enumerate(words) if w[:k] in s})
        best = max([terms[words[i]] for i in whole] + [terms.get(words[i][:k] + "*", 0.0) for i in first for k in PREFIXES], default=0.0)
        return whole, first, best


def nearest(hits: list[int], others: list[int]) -> int | None:
    """Least distance of two sorted lists of places."""
    best, j = None, 0
    for i in hits:
        while j + 1 < len(others) and others[j + 1] <= i:
            j += 1
        for k in (j, j + 1):
            if k < len(others):
                best = min(best if best is not None else 1 << 30, abs(others[k] - i))
    return best


def features_of(text: str, lexicon: Lexicon) -> list[float]:
    data = text.encode()
    size = max(1, len(data))
    share = lambda chars: (len(data) - len(data.translate(None, chars))) / size
    words = WORD.findall(text.lower())
    n = max(1, len(words))
    plain = [i for i, w in enumerate(words) if w in INSULTS]
    whole, first, best = lexicon.hits(words)
    odd = OBFUSCATED.findall(text)
    cleared = [re.sub(r"[.\-_]", "", o).lower().translate(LOOKALIKES) for o in odd]
    hidden = sum(c in INSULTS or c in lexicon.terms for c in cleared)
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    all_hits = sorted({*plain, *whole, *first})
    gap = nearest(all_hits, persons) if persons else None
    return [
        len(plain) / n, float(len(plain)), len(whole) / n, float(len(whole)), len(first) / n, float(len(first)), best, float(hidden),
        0.0 if gap is None else 1.0 / (1.0 + gap), len(persons) / n,
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"!?"), share(b".,;:"), share(b"#$%&*@^~|<>"), share(b"0123456789"),
        len(odd) / n, len(STRETCHED.findall(text)) / n, math.log1p(len(words)),
    ]


def held_out(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``rows`` labelled rows outside the held-out third, chosen by hash.

    The sample of ids is bounded by ``rows`` and so may be broadcast: the texts are not shuffled.
    """
    known = picked(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = picked(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def learn_lexicon(sample: DataFrame, most: int = LEXICON_TERMS) -> Lexicon:
    """The terms whose odds between toxic and other texts are surely high; at most ``most`` of them, the surest first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(text.lower()))
                sums[toxic].update(words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k})
            terms = list(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string())] + [pa.array([s[t] for t in terms], pa.int64()) for s in sums], ["term", "clean", "toxic"])

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    counts = sample.select("text", F.col("toxic").cast("int")).mapInArrow(counted, "term string, clean long, toxic long")
    sums = counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_DOCUMENTS)
    odds = F.log((F.col("toxic") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (totals.get(0, 0) + 1))
    doubt = 2 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    sure = sums.select("term", odds.alias("odds"), (odds - doubt).alias("sure")).where(F.col("sure") >= LEAST_ODDS)
    return Lexicon({r["term"]: r["odds"] for r in sure.orderBy(F.desc("sure"), "term").limit(most).collect()})


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the array ``__features``."""
    at = docs.columns.index(text)
    schema = docs.withColumn("__features", F.array(F.lit(0.0))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_cache_of("")
        for batch in batches:
            made = [features_of(t or "", lexicon) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.float64()))], schema.names)

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """Lexicon, trees and calibration; without both labels in the sample, only the share of toxic rows."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def scored(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """All columns of ``docs`` and ``__score``. The raw probability orders rows that the calibration makes equal."""
        if self.trees is None:
            return docs.withColumn("__score", F.lit(self.share))
        rows = with_features(docs, self.lexicon, text).withColumn("__vector", array_to_vector("__features"))
        raw = self.trees.transform(rows).withColumn("__p", F.get(vector_to_array("__probability"), 1))
        fitted = self.calibration.transform(raw)
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.995 * F.col("__fit") + 0.005 * F.col("__p")))
        return fitted.select(*docs.columns, score.alias("__score"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Learn from the labelled rows outside the held-out third, at most ``rows`` of them; a third of those calibrates."""
    sample = written(training_sample(docs, labels, rows), "toxicity-sample")
    share, kinds = sample.agg(F.avg("toxic"), F.countDistinct("toxic")).first()
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3))
    parts = sample.groupBy((part == 0).alias("calibrates")).agg(F.countDistinct("toxic").alias("kinds")).collect()
    if kinds != 2 or len(parts) != 2 or min(p["kinds"] for p in parts) != 2:
        return Model(Lexicon({}), None, None, float(share or 0.0))
    fitting = sample.where(part != 0)
    lexicon = learn_lexicon(fitting)
    rows_made = with_features(sample.select("doc_id", "text", "toxic"), lexicon).select("doc_id", F.col("toxic").cast("double").alias("__label"), "__features")
    made = written(rows_made, "toxicity-features").coalesce(6).withColumn("__vector", array_to_vector("__features"))
    trees = GBTClassifier(featuresCol="__vector", labelCol="__label", predictionCol="__tree",
                          maxIter=25, maxDepth=4, stepSize=0.2, maxBins=64, seed=42)
    trees = trees.setProbabilityCol("__probability").setRawPredictionCol("__raw").fit(made.where(part != 0))
    unseen = trees.transform(made.where(part == 0)).withColumn("__p", F.get(vector_to_array("__probability"), 1))
    calibration = IsotonicRegression(featuresCol="__p", labelCol="__label", predictionCol="__fit").fit(unseen)
    return Model(lexicon, trees, calibration, float(share))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document.

    A null text is an empty one and gets a score like any other. A null id is not held out. Labels other than 0 and 1 are
    not used; of several labels of a document the highest counts. If the labelled rows don't hold both labels, the
    score of all rows is the share of toxic ones, 0 without any. Repeated rows give repeated rows, an empty table an
    empty one; other columns are left out.
    """
    own = picked(docs, "doc_id", "text")
    scored = fit(docs, labels, rows).scored(own)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= REJECT_AT).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    scored = fit(docs, labels).scored(numbered(docs), f"c{place_of(docs, 'text')}")
    return scored.where(F.col("__score") < REJECT_AT).drop("__score").toDF(*docs.columns)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
