"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every id in ``links`` (a, b): the smallest id that can be reached.

    In each round every vertex is contracted into the neighbour (or itself) of least hash; the hash changes by round, so
    a constant share of the vertices goes, whatever the shape. All steps are aggregates that combine before the shuffle
    or joins on a unique side; nothing is collected. Each round is written, so a lost executor costs one round.
    """
    first = links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(F.col("a").cast("long"), F.col("b").cast("long"))
    left = written(first.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = left.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("root", F.col("id"))
    turn = 0
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        both = left.select("a", "b").union(left.select("b", "a"))
        into = both.groupBy(F.col("a").alias("from")).agg(F.min(rank("b")).alias("to"))
        into = written(into.select("from", F.when(rank("from") < F.col("to"), F.col("from")).otherwise(F.col("to.v")).alias("to")), "contraction")
        moved = roots.join(into, roots["root"] == into["from"], "left").select("id", F.coalesce("to", "root").alias("root"))
        roots = written(moved, "roots")
        a, b = into.toDF("a", "ra"), into.toDF("b", "rb")
        joined = left.join(a, "a").join(b, "b").where("ra <> rb")
        left = written(joined.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        turn += 1
    smallest = roots.groupBy("root").agg(F.min("id").alias("component_id"))
    return roots.join(smallest, "root").select("id", "component_id")
