"""A Merkle manifest of a table of documents, with a proof for each document.

Leaves are hashed fields. Per group and then over the groups, runs of consecutive nodes are hashed until one is left. Proofs
are made by pointer jumping: each inner node holds the siblings on the way to an ancestor; a self-join on that ancestor
doubles the distance and concatenates the segments, until all reach the root. What stands above the leaves is the same
for a whole run, so leaves travel as runs and take their last step at the end. No step puts a group into one task:
places come from a range sort with counts per partition, and each hash reads one run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import picked, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 8
#: Group of the groups. Own groups begin with "=", or are empty for null.
TOP = "/"
NODE = ("g", "level", "i")
FAR = ("far_g", "far_level", "far_i")
SEGMENT = "array<struct<before: string, after: string>>"


def field(c: Column) -> Column:
    own = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own), F.lit("-"))


def digest(parts: Column) -> Column:
    """Hash of an array of strings."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaves(docs: DataFrame, group: str = "lang", fields: Sequence[str] = FIELDS, changed: Column | None = None) -> DataFrame:
    """(doc_id, g, digest, tampered): the hash of each row's fields, and of the row as it reads with ``changed`` for a text."""
    own = picked(docs, *fields)
    key = F.col(fields[0]).cast("long")
    parts = [field(key if f == fields[0] else F.col(f)) for f in fields]
    if changed is None:
        hit = F.coalesce(F.crc32(key.cast("string")) % 3 == 0, F.lit(False))
        changed = F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    other = [field(changed) if f == "text" else p for f, p in zip(fields, parts)]
    g = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    whole = F.sha2(F.concat(*parts), 256)
    tampered = F.when(changed.eqNullSafe(F.col("text")), whole).otherwise(F.sha2(F.concat(*other), 256))
    return own.select(key.alias("doc_id"), g.alias("g"), whole.alias("digest"), tampered.alias("tampered"))


def ranked(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with i, the place in the group g from 0 on, and m, the group's size.

    A range sort deals the rows; a count for each group and partition makes the places gapless.
    """
    kept = written(rows, f"{label}-rows")  # a range partitioning reads its input twice, once for a sample
    keys = [F.col("g"), *[F.asc_nulls_first(c) for c in order]]
    sorted_rows = kept.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    placed = written(sorted_rows.withColumn("task", F.shiftright("row", 33)), f"{label}-sorted")
    counts = placed.groupBy("g", "task").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = "coalesce(sum(n) OVER (PARTITION BY g ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    offsets = written(counts.select("g", "task", "first", F.expr(before).alias("offset"), F.expr("sum(n) OVER (PARTITION BY g)").alias("m")), f"{label}-offsets")
    return placed.join(offsets, ["g", "task"]).withColumn("i", F.col("row") - F.col("first") + F.col("offset")).drop("row", "task", "first", "offset")


def levels_of(rows: DataFrame) -> int:
    """How often runs are hashed until the largest group of ``rows`` (m) is one node."""
    most, levels = rows.agg(F.max("m")).first()[0] or 0, 0
    while most > 1:
        most, levels = -(-most // RUN), levels + 1
    return levels


def runs_by_level(rows: DataFrame, label: str, *payload: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of each level (g, p, m, members) of ``rows`` (g, i, m, digest), and (g, level, digest) of the last node of each group."""
    level, runs, tops = rows, [], []
    for k in range(levels_of(rows) + 1):
        tops.append(level.where("m = 1").select("g", F.lit(k).alias("level"), "digest"))
        if k == levels_of(rows):
            break
        members = F.array_sort(F.collect_list(F.struct("i", "digest", *(payload if k == 0 else ()))))
        run = level.where("m > 1").groupBy("g", F.expr(f"i div {RUN}").alias("p"), "m").agg(members.alias("members"))
        runs.append(written(run, f"{label}-runs"))
        level = runs[-1].select("g", F.col("p").alias("i"), F.expr(f"(m + {RUN - 1}) div {RUN}").alias("m"), digest(F.col("members.digest")).alias("digest"))
    last = tops[0]
    for t in tops[1:]:
        last = last.union(t)
    return runs, written(last, f"{label}-tops")


def siblings(members: str, place: str) -> Column:
    """What stands before and after one member of a run."""
    own, at = F.col(f"{members}.digest"), F.col(place)
    before, after = F.slice(own, F.lit(1), at), F.slice(own, at + 2, F.lit(RUN))
    return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))


def steps(runs: Sequence[DataFrame], from_level: int) -> list[DataFrame]:
    """A row for each node in the runs: its siblings, towards its parent."""
    out = []
    for k, run in enumerate(runs):
        if k >= from_level:
            nodes = run.select("g", "p", "members", F.posexplode("members").alias("place", "member"))
            out.append(nodes.select("g", F.lit(k).alias("level"), F.col("member.i").alias("i"), F.col("g").alias("far_g"), F.lit(k + 1).alias("far_level"),
                                    F.col("p").alias("far_i"), F.array(siblings("members", "place")).cast(SEGMENT).alias("segment")))
    return out


def jumped(nodes: DataFrame, distance: int) -> DataFrame:
    """``nodes`` (node, far node, segment) after so many self-joins that every far node is the root, which is its own far node."""
    reached = 1
    while reached < distance:
        ahead = nodes.select(*[F.col(n).alias(f) for n, f in zip(NODE, FAR)], *[F.col(f).alias(f"next_{f}") for f in FAR], F.col("segment").alias("more"))
        both = nodes.join(ahead, [*FAR])
        nodes = written(both.select(*NODE, *[F.col(f"next_{f}").alias(f) for f in FAR], F.concat("segment", "more").alias("segment")), "jumps")
        reached *= 2
    return nodes


def manifest(docs: DataFrame, group: str = "lang", fields: Sequence[str] = FIELDS, changed: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) of each row; ``proof``: the siblings of each level, before and after.

    ``folded_root`` is the root that follows from the row as ``changed`` has it and the original siblings. Null fields
    are hashed as such; rows with a null group are a group, the first one. Rows of one id are leaves of their own,
    ordered by their hash; a null id comes first and is never changed by the default. An empty table gives an
    empty manifest; other columns are left out.
    """
    rows = written(ranked(leaves(docs, group, fields, changed), ("doc_id", "digest"), "leaves"), "leaves")
    runs, tops = runs_by_level(rows, "tree", "doc_id", "tampered")
    groups = written(ranked(tops.select(F.lit(TOP).alias("g"), F.col("g").alias("own"), "level", "digest"), ("own",), "groups"), "groups")
    top_runs, root = runs_by_level(groups, "top")
    none = F.array().cast(SEGMENT)
    links = groups.select(F.col("own").alias("g"), "level", F.lit(0).cast("long").alias("i"), F.lit(TOP).alias("far_g"), F.lit(0).alias("far_level"),
                          F.col("i").alias("far_i"), none.alias("segment"))
    end = root.select("g", "level", F.lit(0).cast("long").alias("i"), F.col("g").alias("far_g"), F.col("level").alias("far_level"),
                      F.lit(0).cast("long").alias("far_i"), none.alias("segment"))
    nodes = links.union(end)
    for part in steps(runs, 1) + steps(top_runs, 0):
        nodes = nodes.union(part)
    paths = jumped(written(nodes, "nodes"), len(runs) + 1 + len(top_runs)).select(*NODE, "segment")
    named = groups.select(F.col("own").alias("g"), F.col("digest").alias("subroot"), F.col("g").alias("top"))
    named = written(named.join(root.select(F.col("g").alias("top"), F.col("digest").alias("root")), "top").drop("top"), "roots")
    known = paths.join(named, "g")
    alone = rows.where("m = 1").join(known.where("level = 0").drop("level", "i"), "g").select("doc_id", "digest", "tampered", "subroot", "root", F.col("segment").alias("proof"))
    if not runs:
        return _folded(alone)
    first = runs[0].withColumnRenamed("p", "i").join(known.where("level = 1").drop("level"), ["g", "i"])
    spread = first.select("members", "subroot", "root", "segment", F.posexplode("members").alias("place", "member"))
    own = spread.select("member.doc_id", "member.digest", "member.tampered", "subroot", "root",
                        F.concat(F.array(siblings("members", "place")).cast(SEGMENT), "segment").alias("proof"))
    return _folded(own.union(alone))


def _folded(rows: DataFrame) -> DataFrame:
    """The root that a leaf and its siblings give."""
    fold = F.aggregate("proof", F.col("tampered"), lambda h, s: F.sha2(F.concat(s.before, h, s.after), 256))
    return rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", fold.alias("folded_root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    held = F.transform("proof", lambda s: F.concat(s.before, s.after))
    return made.select("doc_id", "leaf", "subroot", "root", digest(held).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_BITS = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
_CRC = f"xor(list_reduce([4294967295] || [ascii(x)::BIGINT for x in string_split(doc_id::VARCHAR, '')], lambda c, b: {_BITS}), 4294967295)"
_LEAF = " || ".join(_FIELD.format(f) for f in FIELDS)
_OTHER = " || ".join(_FIELD.format(f if f != "text" else "changed") for f in FIELDS)


def _tree(name: str, rows: str) -> str:
    return f"""{name} AS (SELECT g, 0 AS level, i, m, digest FROM {rows} UNION ALL
  SELECT g, level + 1, i // 8, (m + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM {name} WHERE m > 1 GROUP BY g, level, m, i // 8)"""


def _fold(name: str, start: str, tree: str) -> str:
    return f"""{name} AS (SELECT * FROM ({start}) UNION ALL
  SELECT f.doc_id, f.leaf, f.own, f.g, f.level + 1, f.i // 8, (f.m + 7) // 8, sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.digest END, '' ORDER BY u.i)),
   f.proof || coalesce(string_agg(u.digest, '' ORDER BY u.i) FILTER (WHERE u.i <> f.i), '')
  FROM {name} f JOIN {tree} u ON u.g = f.g AND u.level = f.level AND u.i // 8 = f.i // 8 WHERE f.m > 1
  GROUP BY f.doc_id, f.leaf, f.own, f.g, f.level, f.i, f.m, f.h, f.proof)"""


OP11_SQL = f"""
WITH RECURSIVE changes AS (SELECT *, CASE WHEN {_CRC} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM documents),
 hashed AS (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_LEAF}) AS digest, sha256({_OTHER}) AS tampered FROM changes),
 places AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY g) AS m FROM hashed),
 {_tree("tree", "places")},
 tops AS (SELECT '/' AS g, g AS own, digest, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS m FROM tree WHERE m = 1),
 {_tree("above", "tops")},
 {_fold("lower_fold", "SELECT doc_id, digest AS leaf, g AS own, g, 0 AS level, i, m, tampered AS h, '' AS proof FROM places", "tree")},
 {_fold("upper_fold", "SELECT f.doc_id, f.leaf, f.own, t.g, 0 AS level, t.i, t.m, f.h, f.proof FROM lower_fold f JOIN tops t ON t.own = f.own WHERE f.m = 1", "above")}
SELECT doc_id, leaf, t.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = r.digest AS verified
FROM upper_fold f JOIN tops t ON t.own = f.own JOIN above r ON r.m = 1 WHERE f.m = 1
"""
