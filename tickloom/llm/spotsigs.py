"""Document fingerprints from spot signatures, in DataFrame functions alone.

Common words are the anchors; each content word that follows one begins a chain of content words, and the set of hashed
chains is the fingerprint. Two fingerprints are compared by Jaccard; sets whose lengths differ too much to reach
the asked likeness are never compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import texts_of

# Common words of English, German, French and Spanish.
ANCHORS = tuple(dict.fromkeys(
    "the of and a in is that on was it for by this with from or are as to at be an can will not has have "
    "der die das und ist nicht ein eine zu von den dem mit auf im für als auch sich es sie er wie bei "
    "le la les de des du et un une que qui dans en pas pour sur est au par ce il elle se "
    "el los las y lo su se con para del no al como más una por son".split()))
CHAIN = 2
ENOUGH = 4
SIGNATURE_BITS = 40
DOCUMENTS_PER_RANGE = 100_000
LEAST_RANGES = 4096


def with_signatures(df: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """Add the sorted distinct signatures of a column. A text with fewer than ``ENOUGH`` chains also has one for
    each word, or without words one for the whole; an empty text has none.

    The steps are columns of their own, since an expression inside a lambda is evaluated for each element.
    """
    words = df.withColumn("__words", F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    content = words.withColumn("__content", F.filter(
        F.transform("__words", lambda w, i: F.struct(w.alias("word"), ((i > 0) & F.get("__words", i - 1).isin(*ANCHORS)).alias("begins"))),
        lambda x: ~x["word"].isin(*ANCHORS)))

    def chained(x: Column, i: Column) -> Column:
        following = [F.get("__content", i + k)["word"] for k in range(1, chain)]
        return F.when(x["begins"] & (i + F.lit(chain) <= F.size("__content")), F.shiftrightunsigned(F.xxhash64(x["word"], *following), 64 - SIGNATURE_BITS))

    chains = content.withColumn("__chains", F.filter(F.transform("__content", chained), lambda s: s.isNotNull()))
    def cut(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - SIGNATURE_BITS)

    single = F.transform("__words", lambda w: cut(F.xxhash64(w)))
    whole = F.when(F.size("__words") > 0, single).when(F.length(text) > 0, F.array(cut(F.xxhash64(F.lower(text))))).otherwise(F.array().cast("array<bigint>"))
    found = F.when(F.size("__chains") >= ENOUGH, F.col("__chains")).otherwise(F.concat("__chains", whole))
    return chains.withColumn(name, F.array_sort(F.array_distinct(found))).drop("__words", "__content", "__chains")


def fingerprint(signatures: str) -> Column:
    return F.concat_ws(",", F.transform(signatures, lambda s: F.lower(F.hex(s))))


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard of two sets, 1 for two empty ones. Pairs whose lengths rule out ``least`` give 0 without a comparison."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (F.when(long == 0, F.lit(1.0)).when(short < F.lit(least) * long, F.lit(0.0)).otherwise(common / (F.size(a) + F.size(b) - common)))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chain: int = CHAIN) -> DataFrame:
    """(doc_id, signatures) of each document; a null text is an empty one."""
    return with_signatures(texts_of(docs, id_column, text_column), "text", "signatures", chain).drop("text")


def matches(left: DataFrame, right: DataFrame, least: float = 0.8) -> DataFrame:
    """(left_id, right_id, likeness) of all pairs of two fingerprint tables that are at least so alike.

    Sets are partitioned by length in classes of ratio ``least``: a match lies in the same class or a neighbour. Within
    a class, pairs meet on the rarest signatures, of which two such sets must share one. Empty sets match nothing.
    """
    both = left.select(F.explode("signatures").alias("sig")).union(right.select(F.explode("signatures").alias("sig")))
    rank = both.groupBy("sig").agg(F.count("*").alias("uses"))

    def prefixes(df: DataFrame) -> DataFrame:
        n = F.size("signatures")
        rows = df.where(n > 0).select("doc_id", "signatures", F.explode("signatures").alias("sig")).join(rank, "sig")
        ordered = rows.groupBy("doc_id", "signatures").agg(F.transform(F.array_sort(F.collect_list(F.struct("uses", "sig"))), lambda x: x["sig"]).alias("rarest"))
        kept = F.slice("rarest", 1, (n - F.ceil(F.lit(least) * n - F.lit(1e-9)) + 1).cast("int"))
        return ordered.select("doc_id", "signatures", F.explode(kept).alias("sig"), F.floor(F.log(n.cast("double")) / F.lit(-math.log(least)) + F.lit(1e-9)).alias("size_class"))

    a = prefixes(left).select(F.col("doc_id").alias("left_id"), F.col("signatures").alias("a"), "sig", "size_class")
    b = prefixes(right).select(F.col("doc_id").alias("right_id"), F.col("signatures").alias("b"), "sig", F.explode(F.sequence(F.col("size_class") - 1, F.col("size_class") + 1)).alias("size_class"))
    pairs = a.join(b, ["sig", "size_class"]).where(F.least(F.size("a"), F.size("b")) >= F.lit(least) * F.greatest(F.size("a"), F.size("b")))
    return pairs.dropDuplicates(["left_id", "right_id"]).withColumn("likeness", likeness("a", "b", least)).where(F.col("likeness") >= least).select("left_id", "right_id", "likeness")


def with_next(docs: DataFrame, id_column: str, values: list[str]) -> DataFrame:
    """Add ``next_<value>`` of the next row by descending id; the last row is followed by the first.

    Ids are cut into ranges of about 100,000 rows. The first row of each range also goes, marked, into the range whose
    last row it follows, so one shuffle brings neighbours together and no task orders the whole table. Equal ids are
    ordered by the hash of their values; null ids come last.
    """
    low, high, count = docs.agg(F.min(id_column), F.max(id_column), F.count("*")).first()
    ranges = max(LEAST_RANGES, -(-(count or 0) // DOCUMENTS_PER_RANGE))
    width = max(1, -(-((high or 0) - (low or 0) + 1) // ranges))
    placed = docs.withColumn("__range", F.when(F.col(id_column).isNull(), F.lit(-1)).otherwise(F.floor((F.col(id_column) - F.lit(low or 0)) / F.lit(width))))
    ids = docs.select(F.col(id_column).alias("__head")).withColumn("__of", F.when(F.col("__head").isNull(), F.lit(-1)).otherwise(F.floor((F.col("__head") - F.lit(low or 0)) / F.lit(width))))
    heads = ids.groupBy("__of").agg(F.max("__head").alias("__head"))
    down = Window.orderBy(F.col("__of").desc())  # at most max(4096, rows / 100,000) rows
    ends = heads.select("__of", F.lag("__of").over(down).alias("__above"), F.min("__of").over(Window.partitionBy()).alias("__bottom"))
    copies = ends.select("__of", F.coalesce("__above", "__bottom").alias("__to"))
    first = heads.join(copies, "__of").select("__head", "__to", "__of")
    # At most max(4096, rows / 100,000) rows of three numbers, so they may be broadcast: the texts are shuffled once only.
    own = placed.join(F.broadcast(first), (placed["__range"] == first["__of"]) & placed[id_column].eqNullSafe(first["__head"]), "left").drop("__head", "__of")
    targets = F.when(F.col("__to").isNull(), F.array(F.struct(F.col("__range").alias("at"), F.lit(False).alias("copy")))).otherwise(
        F.array(F.struct(F.col("__range").alias("at"), F.lit(False).alias("copy")), F.struct(F.col("__to").alias("at"), F.lit(True).alias("copy"))))
    spread = own.withColumn("__place", F.explode(targets)).select(*docs.columns, F.col("__place.at").alias("__at"), F.col("__place.copy").alias("__copy"))
    w = Window.partitionBy("__at").orderBy("__copy", F.col(id_column).desc_nulls_last(), F.xxhash64(*values))
    return spread.select("*", *[F.lead(v).over(w).alias(f"next_{v}") for v in values]).where(~F.col("__copy")).drop("__at", "__copy")


def edited_likeness(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chain: int = CHAIN) -> DataFrame:
    """Fingerprint each document and its edited text, whose second half is the beginning of the next document.

    A null text is an empty one: no code points, an empty fingerprint, likeness 1 to another empty one. A single
    document is its own next one. Repeated rows follow each other; an empty table gives an empty one; other columns are
    left out.
    """
    own = with_signatures(texts_of(docs, id_column, text_column), "text", "sigs", chain)
    pairs = with_next(own, "doc_id", ["text", "sigs"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 2)))"), F.expr("substring(next_text, 1, int(floor(length(text) / 2)))"))
    with_edit = pairs.withColumn("edited", F.when(half > 0, edited).otherwise(F.col("text"))).withColumn("n_chars", n.cast("long")).drop("text", "next_text")
    signed = with_signatures(with_edit, "edited", "edited_sigs", chain)
    return signed.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint("sigs").alias("fingerprint"),
        fingerprint("edited_sigs").alias("edited_fingerprint"), likeness("sigs", "edited_sigs").alias("near_edited"), likeness("sigs", "next_sigs").alias("near_next"))


def op7_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))
