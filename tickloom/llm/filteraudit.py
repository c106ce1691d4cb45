"""How text filters interact: what each removes alone, first, and in every order.

A document's failures are one row per failed filter, united and added up to a combination of bits. Copies are found by an
existential self-join: a document fails if there is a row with an equal hash, an equal text and a smaller id. Everything
else follows from the counts of the 32 combinations, so the orders of the filters are never run over the documents.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import picked, written

FILTERS = "ABCDE"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITAL_PERCENT = 5
MARKS = "[#$%&*|]"


def failed_alone(text: Column) -> Column:
    """Bits of the filters A to D that a text (not null) fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > MOST_CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(MARKS),
    }
    return sum((F.when(failed, BIT[name]).otherwise(0) for name, failed in fails.items()), F.lit(0))


def later_copies(texts: DataFrame) -> DataFrame:
    """Rows of ``texts`` (doc_id, text, h and others; h the hash of the text) whose text a row of smaller id has too.

    Only rows of a hash that several rows have are compared. The other side of the join is one row per text, with its
    smallest id, so a group of copies of any size costs a row each; Spark splits a skewed left side.
    """
    # Both small sides are written: an aggregate right below a join would keep Spark from splitting the other side.
    shared = written(texts.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "shared-hashes")
    inner = texts.join(shared, "h")
    kept = written(inner.where(F.col("doc_id").isNotNull()), "equal-hashes")
    firsts = written(kept.groupBy(F.col("h").alias("own_h"), F.col("text").alias("own_text")).agg(F.min("doc_id").alias("own_first")), "first-copies")
    later = kept.where(F.col("doc_id") > F.col("first"))
    return later.join(firsts, (F.col("h") == F.col("own_h")) & (F.col("text") == F.col("own_text")) & (F.col("own_first") < F.col("doc_id")), "left_semi").drop("first")


def combinations(docs: DataFrame, labels: DataFrame, part_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(part, bits, n, good, toxic): documents of each part by the filters they fail, and how many of them have such a label.

    A null text is empty, a null part the empty string. Rows that share an id count each. A row with a null id is
    nobody's copy and nobody's original. Several labels of an id count as one that is 1 if any is.
    """
    own = picked(docs, id_column, text_column, part_column)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    base = own.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    judged = base.select("doc_id", "part", failed_alone(F.col("text")).cast("int").alias("alone"), F.xxhash64("text").alias("h"), "text")
    copies = later_copies(judged)
    failures = judged.select("doc_id", "part", "alone", F.lit(1).alias("n"), F.lit(0).alias("copies")).union(
        copies.select("doc_id", "part", "alone", F.lit(0).alias("n"), F.lit(1).alias("copies")))
    by_id = failures.groupBy("doc_id", "part", "alone").agg(F.sum("n").alias("n"), F.sum("copies").alias("copies"))
    marks = picked(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    pair = lambda bits, n: F.struct(bits.alias("bits"), n.alias("n"))
    both = F.explode(F.array(pair(F.col("alone"), F.col("n") - F.col("copies")), pair(F.col("alone") + BIT["E"], F.col("copies"))))
    spread = by_id.join(marks, "doc_id", "left").select("part", both.alias("x"), "good", "toxic").where("x.n > 0")
    count = lambda c: F.coalesce(F.sum(F.col("x.n") * F.coalesce(c, F.lit(0))), F.lit(0)).cast("long")
    return spread.groupBy("part", F.col("x.bits").alias("bits")).agg(
        count(F.lit(1)).alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def audit(found: DataFrame) -> DataFrame:
    """All orders and steps of every part of ``combinations``: one row each, zeros included."""
    rows = []
    for order in ORDERS:
        before = 0
        for step, name in enumerate(order, 1):
            rows.append({"filter_order": order, "step": step, "own": BIT[name], "before": before, "after": before | BIT[name]})
            before |= BIT[name]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, own: int, before: int, after: int>>")
    parts = found.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("counts"))  # at most 32 of a part
    # Documents that fail nothing in a set of filters are those whose combination is disjoint from it.
    sets = f"sequence(0, {(1 << len(FILTERS)) - 1})"
    left = {k: F.expr(f"transform({sets}, s -> aggregate(filter(counts, c -> (c.bits & s) = 0), 0L, (sum, c) -> sum + c.{k}))") for k in ("n", "good", "toxic")}
    parts = parts.withColumns({f"{k}_left": c for k, c in left.items()})
    # In how many orders a set of filters comes before another one, by the size of the set.
    ahead = ", ".join(str(factorial(k) * factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS)))
    share = f"aggregate(filter({sets}, s -> (s & f) = 0), 0L, (sum, s) -> sum + array({ahead})[bit_count(s)] * (n_left[s] - n_left[s | f]))"
    names = ", ".join(f"{BIT[f]}" for f in FILTERS)
    parts = parts.withColumn("shares", F.expr(f"map_from_arrays(array({names}), transform(array({names}), f -> {share}))"))
    unique = F.expr("aggregate(filter(counts, c -> c.bits = s.own), 0L, (sum, c) -> sum + c.n)")
    at = lambda kind, place: F.col(f"{kind}_left")[F.col(f"s.{place}")]
    lost = lambda kind: at(kind, "before") - at(kind, "after")
    failing = F.col("n_left")[0] - at("n", "own")
    return parts.withColumn("s", F.explode(table)).select(
        "part", "s.filter_order", "s.step", at("n", "after").alias("kept"), lost("n").alias("removed"), (failing - lost("n")).alias("redundant"),
        unique.alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.col("shares")[F.col("s.own")].alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, part_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    600 rows per part: each order of the five filters, each step. Odd rows as in ``combinations``; an empty table has no
    parts and gives an empty result; other columns are left out.
    """
    return audit(combinations(docs, labels, part_column, id_column, text_column))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = """
WITH base AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
 worded AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM base),
 marks AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY 1),
 firsts AS (SELECT text, min(doc_id) AS first FROM base GROUP BY 1),
 judged AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {
   'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
   'C': 100 * len(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * len(w.text),
   'D': regexp_matches(w.text, '[#$%&*|]'), 'E': coalesce(first < w.doc_id, false)} AS fails
  FROM worded w JOIN firsts f ON w.text = f.text LEFT JOIN marks m ON w.doc_id = m.doc_id),
 bits AS (SELECT part, good, toxic, fails.A::INT + 2 * fails.B::INT + 4 * fails.C::INT + 8 * fails.D::INT + 16 * fails.E::INT AS bits FROM judged),
 counts AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM bits GROUP BY 1, 2),
 letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
 orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
 steps AS (SELECT filter_order, step::INT AS step, (1 << (ascii(filter_order[step]) - 65)) AS own,
  list_sum([1 << (ascii(x) - 65) for x in string_split(left(filter_order, step - 1), '') if x <> '']) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
 plain AS (SELECT filter_order, step, own::INT AS own, coalesce(earlier, 0)::INT AS earlier FROM steps),
 rows AS (SELECT part, filter_order, step, own,
  sum(n) FILTER (WHERE bits & (own | earlier) = 0) AS kept, sum(n) FILTER (WHERE bits & earlier = 0 AND bits & own > 0) AS removed,
  sum(n) FILTER (WHERE bits & earlier > 0 AND bits & own > 0) AS redundant, sum(n) FILTER (WHERE bits = own) AS unique_fails,
  sum(good) FILTER (WHERE bits & earlier = 0 AND bits & own > 0) AS good_lost,
  sum(toxic) FILTER (WHERE bits & earlier = 0 AND bits & own > 0) AS toxic_lost
  FROM counts, plain GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
 coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
 coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM rows
"""
