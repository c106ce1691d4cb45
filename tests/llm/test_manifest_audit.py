"""Prefix BPE, Merkle manifests and the filter audit against the library and brute force."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

from helpers import odd_texts, prose, table
from tickloom.llm import filteraudit, manifest, prefixbpe

DOCS = "doc_id long, source string, lang string, n_chars long, text string, TEXT string, g string, i int, m int, digest string, part string, h long"
LABELS = "doc_id long, quality int, toxic int, part string"


def documents(spark, rows):
    """(doc_id, source, lang, text) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, s, g, None if t is None else len(t), t, "other", "g", 1, 2, "x", "p", 3) for d, s, g, t in rows], DOCS)


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(prefixbpe.VOCABULARY))


def strange_texts():
    rng = random.Random(4)
    fixed = ["a\x1c!b \x1d c", "ΑΣ ΟΔΟΣ. Σ", "İstanbul", "<|endoftext|>", "x<|startoftext|>y <|endoftext|><|endoftext|>z <|", "don't we'll I'M 'S", "日本語 テスト 123",
             "ﬁ ß ẞ ² ½ Ⅷ", "🙂🙃 a🙂", "\x00\x01", "a" * 3000, "ab" * 2000, " x　y\u0085z", "café ́"]
    drawn = ["".join(rng.choice("aabcdehinorst") for _ in range(rng.randint(1, 90))) for _ in range(300)]
    return fixed + drawn + ["".join(rng.choice("aeinot'. éßΣσ1!-_\n\tÀ中あ́A<|>") for _ in range(rng.randint(1, 60))) for _ in range(300)]


def test_prefix_bpe(spark):
    texts = odd_texts() + prose(8) + list(enumerate(strange_texts(), 5000))
    whole = library()
    ids = [whole.encode(t or "", add_special_tokens=False).ids for _, t in texts]
    digest = lambda b: hashlib.sha256(b).hexdigest()
    expected = [(d, len(i), digest(np.array(i, "<u4").tobytes()), digest(whole.decode(i, skip_special_tokens=False).encode())) for (d, _), i in zip(texts, ids)]
    got = [tuple(r) for r in prefixbpe.prefix_digests(table(spark, texts)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    full = {r.doc_id: (list(r.ids), r.decoded) for r in prefixbpe.prefix_encoded(table(spark, texts[-40:])).collect()}
    assert full == {d: (i, whole.decode(i, skip_special_tokens=False)) for (d, _), i in zip(texts[-40:], ids[-40:])}
    assert prefixbpe.prefix_digests(table(spark, [])).count() == 0


def test_prefix_tokens_are_unique_and_equal_for_one_and_many_words():
    own, whole = prefixbpe.prefix_bpe(None), library()
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(1, 64))) for _ in range(400)] + ["a" * n for n in range(1, 40)]
    assert own._words_at_once(words) == [own._word(w) for w in words] == [np.array(whole.encode(w).ids, "<u4").tobytes() for w in words]


def test_caches_stay_bounded():
    cache = prefixbpe.BoundedCache(10_000)
    for i in range(5000):
        cache.put({str(i): b"1234"})
    assert len(cache.young) + len(cache.old) < 60 and cache.find(["4999", "1"]) == [b"1234", None]
    cache.put({"x" * 65: b"1"})
    assert cache.find(["x" * 65]) == [None]
    old = next(iter(cache.old))
    assert old not in cache.young and cache.find([old]) == [b"1234"] and old in cache.young


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, tampered=False):
    d, s, g, t = row
    if tampered and t is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 0:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    fields = [d, s, g, None if row[3] is None else len(row[3]), t]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climbed(digests):
    """(last node, list of levels)."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels[-1][0], levels


def brute_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (own, *climbed([leaf(r) for r in own]))
    root, above = climbed([trees[g][1] for g in order])
    out = []
    for k, g in enumerate(order):
        own, subroot, levels = trees[g]
        for i, row in enumerate(own):
            h, proof = leaf(row, True), ""
            for tree, at in ((levels, i), (above, k)):
                for level in tree[:-1]:
                    start = at - at % 8
                    run = level[start : start + 8]
                    proof += "".join(run[: at - start] + run[at - start + 1 :])
                    h = sha("".join(run[: at - start] + [h] + run[at - start + 1 :]))
                    at //= 8
            out.append((row[0], leaf(row), subroot, root, sha(proof), h))
    return out


def manifest_rows(made):
    proof = lambda r: sha("".join(s.before + s.after for s in r.proof))
    return [(r.doc_id, r.leaf, r.subroot, r.root, proof(r), r.folded_root) for r in made.collect()]


def many(n, langs):
    rng = random.Random(n)
    return [(i * 7 - 20, rng.choice(["s", None, "ü"]), rng.choice(langs), rng.choice([None, "", "Some Text", "ÄB c" * (i % 4), f"Text {i}"])) for i in range(n)]


@pytest.mark.parametrize("rows", [
    many(700, ["en", "en", "en", None, "de", "ü"]),
    many(65, ["en"]),
    many(8, [None]),
    [(1, "s", "en", "Aa"), (1, "s", "en", "Aa"), (1, "s", "en", "other"), (None, "s", "en", "No Id"), (None, None, None, None), (3, "s", "", "Empty Lang")],
    [(5, None, "en", "Lone Leaf")],
    [(6, "s", "fr", "x Y" * 40_000), (7, "s", "de", "")],
], ids=["groups", "one group", "one run", "repeated and null", "one leaf", "long text"])
def test_manifest(spark, rows):
    got = manifest_rows(manifest.manifest(documents(spark, rows)))
    assert sorted(got, key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_shows_tampering(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, many(200, ["en", "de"]))
    assert manifest.manifest(documents(spark, [])).count() == 0
    same = manifest.manifest(docs, changed=F.col("text"))
    assert same.where("folded_root <> root").count() == 0
    other = manifest.manifest(docs, changed=F.when(F.col("doc_id") == 1, "changed").otherwise(F.col("text")))
    assert [r.doc_id for r in other.where("folded_root <> root").collect()] == [1]
    groups = manifest.manifest(docs, group="source")
    assert groups.select("subroot").distinct().count() == 3 and groups.select("root").distinct().count() == 1


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    parts = {}
    for d, s, _, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = d is not None and any(e is not None and e < d and (u or "") == t for e, _, _, u in rows)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": copy}
        parts.setdefault(s or "", []).append(({f for f, x in fails.items() if x}, d in good, d in toxic))
    out = []
    for part, docs in parts.items():
        own, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in docs)
                shapley[f] += len(gone)
                own.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(x[0] == {f} for x in docs),
                            sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out += [r + (shapley[r[1][r[2] - 1]],) for r in own]
    return out


def audited(spark, rows, labels):
    found = filteraudit.filter_audit(documents(spark, rows), spark.createDataFrame([(*x, "p") for x in labels], LABELS))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in found.collect())


def audit_rows():
    rng = random.Random(9)
    words = ["alpha", "beta", "Gamma", "DELTA", "eps#", "zeta\t", "eta\n\n"] + [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        pool = words[: rng.choice([3, 7, 60, 200])]
        text = rng.choice([None, "", " \t", "x", " ".join(rng.choices(pool, k=rng.randint(1, 120)))])
        rows.append((i * 3 % 200, rng.choice(["a", "b", None, ""]), "en", text))
    return rows + [(1000 + i, "b", "en", rng.choice(rows)[3]) for i in range(60)]


def test_filter_audit(spark):
    rows = audit_rows()
    labels = [(d, i % 2, i % 3 == 0) for i, (d, *_) in enumerate(rows) if i % 5] + [(rows[0][0], 1, 1), (rows[0][0], 0, 0), (None, 1, 1), (99_999, 1, 1)]
    labels = [(d, q if q else None, int(t)) for d, q, t in labels]
    assert audited(spark, rows, labels) == sorted(brute_audit(rows, labels))


def test_filter_audit_of_odd_rows(spark):
    long = " ".join(f"w{i % 9000}" for i in range(60_000))
    rows = [(1, None, "en", long), (2, "", "en", long), (2, "", "en", long), (None, "", "en", long), (None, "s", "en", None), (3, "s", "en", ""), (4, "s", "en", None),
            (5, "s", "en", "A B " * 30), (5, "s", "en", "other text of one id"), (5, "t", "en", "other text of one id"), (6, "t", "en", "other text of one id")]
    assert audited(spark, rows, []) == sorted(brute_audit(rows, []))
    assert audited(spark, [], []) == []


def test_filter_audit_of_a_large_group_of_copies(spark):
    rows = [(i, "s" if i % 3 else "t", "en", "one and the same text") for i in range(3000)] + [(5000 + i, "s", "en", f"text {i}") for i in range(500)]
    got = audited(spark, rows, [])
    first = [r for r in got if r[1] == "EABCD" and r[2] == 1]
    assert {r[0]: r[4] for r in first} == {"s": 2000, "t": 999} and sum(r[3] for r in first) == 501
