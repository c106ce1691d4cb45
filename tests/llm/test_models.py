"""Toxicity, near-duplicate vectors, packing and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import odd_texts, prose, table
from tickloom.llm import embeddings, packing, toxicity

INSULTS = ["idiot", "grobzan", "vilknor"]


def labelled(n, seed=5):
    """Texts of which one in five is toxic; two of the insults are known from the labels only."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(200)]
    texts, labels = [], []
    for i in range(n):
        own = rng.choices(words, k=40)
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                own.insert(rng.randrange(len(own)), rng.choice(INSULTS) + rng.choice(["", "", "es"]))
        texts.append((i, " ".join(own)))
        labels.append((i, 1, toxic))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = labelled(900)
    extra = [(5000, None), (5001, ""), (None, "the house"), (5002, "you idiot " * 20_000), (5002, "you idiot " * 20_000)]
    rows = toxicity.toxicity(table(spark, texts + extra), spark.createDataFrame(labels + [(1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    truth = {d: t for d, _, t in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == len(texts) + 5 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held) and len(held) > 200
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_toxicity_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(table(spark, odd_texts()), empty).collect()} == {0.0}
    assert toxicity.toxicity(table(spark, []), empty).count() == 0
    ones = spark.createDataFrame([(d, 1, 1) for d in range(3)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(table(spark, odd_texts()), ones).count() == len(odd_texts())
    kept = toxicity.without_toxic(table(spark, odd_texts()), empty)
    assert kept.columns == table(spark, []).columns and kept.count() == len(odd_texts())


def test_features_do_not_need_quadratic_time():
    lexicon = toxicity.Lexicon({"bad": 3.0, "awfu*": 2.0})
    assert len(toxicity.features_of("", lexicon)) == toxicity.N_FEATURES
    for text in ("a" * 300_000, "1" * 300_000, "a.b." * 80_000, "bad you " * 60_000):
        toxicity.features_of(text, lexicon)


def brute_links(rows, least):
    out = {i: 0 for i, _, _ in rows}
    root = {i: i for i in out}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sound = [(i, np.array(v, float), l) for i, v, l in rows if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for k, (i, v, l) in enumerate(sound):
        for j, w, m in sound[k + 1 :]:
            if l == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                out[i] += 1
                out[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (out[i], find(i)) for i in out}


def vectors(seed, groups=12, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(size)
        for _ in range(rng.integers(1, 9)):
            rows.append([float(np.float32(x)) for x in centre + rng.standard_normal(size) * rng.choice([0.0, 0.1, 0.2])])
    labels = rng.integers(0, 2, len(rows)).tolist()
    odd = [(None, 0), ([], 0), ([0.0] * size, 0), ([float("nan")] * size, 0), ([1.0, None] + [0.0] * (size - 2), 0), ([1e30] * size, 0), ([1e30] * size, None), ([float("inf")] + [1.0] * (size - 1), 0), ([2e-30] * size, 0), ([1.0] * 3, 0)]
    return [(i, v, l) for i, (v, l) in enumerate([*zip(rows, labels), *odd])]


def test_near_vectors(spark):
    rows = vectors(1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit(1)).withColumn("keys", F.lit(2))
    expected = brute_links(rows, 0.93)
    for cell_rows in (2048, 4):  # also with every bucket cut into blocks
        got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df, tables=60, cell_rows=cell_rows).collect()}
        assert got == expected


def test_near_vectors_recall_and_odd(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 64))
    rows = [(i, (centres[i % 60] + rng.standard_normal(64) * 0.27).tolist(), 0) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected = brute_links(rows, 0.93)
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    links = sum(n for n, _ in expected.values())
    assert links > 100 and sum(got.values()) >= 0.9 * links and all(got[i] <= expected[i][0] for i in got)
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    twice = df.limit(1).union(df.limit(1)).union(spark.createDataFrame([(None, [1.0] * 64, 0)], df.schema))
    assert sorted((r.vec_id or -1, r.n_links, r.kept) for r in embeddings.near_vectors(twice).collect())[-1][1:] == (1, True)


def best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.choice([1, capacity // 3 + 1, capacity]) for _ in range(rng.randint(0, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps, used = packing.plan(counts, capacity)
    assert used == best_fit(lengths, capacity)
    filled = {}
    ends = [*steps[1:, 0].tolist(), len(lengths)] if len(steps) else []
    for (rank, first, offset), end in zip(steps.tolist(), ends):
        for k in range(rank, end):
            filled.setdefault(first + k - rank, []).append((offset, sorted(lengths, reverse=True)[k]))
    for places in filled.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= capacity


def test_packing(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    texts = prose(9, 30) + [t for t in odd_texts()] + [(900, "Ab\x1cc d'll <|endoftext|> ΑΣ İx é é"), (901, "x" * 5000)]
    whole = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    whole.encode_special_tokens = True
    rows = packing.packed(table(spark, texts), keep_ids=True).collect()
    expected = []
    for d, t in texts:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        expected += [(d, k, s, len(ids[s : s + 2048]), tuple(ids[s : s + 2048])) for k, s in enumerate(range(0, len(ids), 2048))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, tuple(r.ids)) for r in rows], key=key) == sorted(expected, key=key)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048
    assert packing.packed(table(spark, [])).count() == 0


def test_stages(spark, tmp_path):
    import corpus_pipeline

    texts, labels = labelled(400)
    twin = [(1000, texts[1][1] + " more"), (1001, "call +1 (234) 555-6789 now or write to nobody about the green boat that left this harbour at noon")]
    rows = [(d, t, "en", "s", len(t)) for d, t in texts + twin] + [(2000, None, None, None, None), (2001, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        seen[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "packing":
            assert docs.columns == before.columns
    toxic = {d for d, _, t in labels if t}
    ids = lambda n: {r.doc_id for r in seen[n].select("doc_id").collect()}
    assert len(ids("toxicity") & toxic) <= 2 and {1, 2, 1000, 1001, 2000, 2001} <= ids("toxicity")
    assert ids("line_dedup") == ids("toxicity") and 1000 not in ids("near_dedup") and {1, 1001, 2000, 2001} <= ids("near_dedup")
    masked = {r.doc_id: r for r in seen["pii"].collect()}
    assert masked[1001].text.startswith("call [PHONE] now") and masked[1001].n_chars == len(masked[1001].text) and masked[2000].text is None
    assert ids("packing") == ids("near_dedup") and corpus_pipeline.run(spark, str(tmp_path)).count() == seen["packing"].count()


def test_caches_of_other_operators_are_dropped():
    from tickloom.llm import common, minmax

    minmax.shingle_set("some words in a text", 2)
    packing.tokens(None).encode(["some words in a text"])
    common.keep_cache_of("packing")
    assert not minmax.HASHES and packing.tokens.cache_info().currsize == 1
    minmax.shingle_set("some words in a text", 2)
    common.keep_cache_of("minmax")
    assert minmax.HASHES and packing.tokens.cache_info().currsize == 0
