"""Suffixes, line chunks, near copies and fingerprints against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import covered_bytes, near_components, odd_texts, prose, shingles, table
from tickloom.llm import linechunks, minmax, spotsigs, suffixes
from tickloom.llm.components import components


def spans_by_doc(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes(spark, seed):
    texts = prose(seed) + [(2000, "ab" * 200), (2001, "x" + "ab" * 90), (2002, "\0" * 120), (2003, "z" * 20 + "\0" * 80), (2004, "q" * 49), (2005, "q" * 49)]
    assert spans_by_doc(suffixes.repeated_bytes(table(spark, texts))) == covered_bytes(texts)


def test_anchors_of_cut_texts(monkeypatch):
    texts = prose(3)
    data = [t.encode() for _, t in texts]
    whole = list(suffixes.anchors_of(data))
    monkeypatch.setattr(suffixes, "SEGMENT", 300)
    cut = list(suffixes.anchors_of(data))
    found = lambda parts: {(int(t), int(p), int(g)) for a in parts for t, p, g in zip(a.text, a.place, a.gram)}
    assert found(whole) == found(cut) and len(cut) > len(whole)
    contexts = lambda parts: {(int(t), int(p)): int(c) for a in parts for t, p, c in zip(a.text, a.place, a.contexts(np.arange(len(a.text))))}
    assert contexts(whole) == contexts(cut)


def test_frequent_anchors_give_the_same(spark):
    texts = prose(4)
    assert spans_by_doc(suffixes.repeated_bytes(table(spark, texts), frequent=1)) == covered_bytes(texts)


def test_suffix_sort_with_colliding_hashes():
    rng = np.random.default_rng(0)
    values = rng.integers(1, 3, (200, 8)).astype(np.int16)
    start, size = np.zeros(200, np.int64), np.full(200, 200)
    plain = suffixes.Suffixes(values)
    order, common = plain.ranks(start, size)
    assert [tuple(v) for v in values[order]] == sorted(map(tuple, values))
    broken = suffixes.Suffixes(values)
    broken.hashes[:] = 0
    again, common_again = broken.ranks(start, size)
    assert np.array_equal(values[order], values[again]) and np.array_equal(common, common_again)


def test_suffixes_odd(spark):
    rows = suffixes.repeated_bytes(table(spark, odd_texts()), keep_text=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(odd_texts()) and by[0][0].n_bytes == by[1][0].n_bytes == 0
    assert [r.n_removed for r in by[4]] == [r.n_bytes for r in by[4]] and by[3][0].n_removed == 0 and by[None][0].n_removed == 0
    assert by[7][0].kept == "b" and by[6][0].n_removed == 0
    assert suffixes.repeated_bytes(table(spark, [])).count() == 0


def test_line_chunks_odd(spark):
    shared = "\n".join(f"line {i * 31 % 97}" for i in range(40))
    texts = [(1, shared), (2, "zero\n" + shared + "\neight"), (3, None), (4, ""), (5, "single"), (5, "single"), (None, shared)]
    out = linechunks.deduplicated(table(spark, texts))
    names = out.columns
    assert names[-2:] == ["n_lines", "n_removed"] and names[: len(names) - 2] == table(spark, []).columns
    rows = [(r[0], r[1], r[-2], r[-1]) for r in out.collect()]
    by = {r[0]: r for r in rows}
    assert len(rows) == 7 and by[1][1] == shared and by[3][1] is None and by[4][1] == "" and by[5][3] == 0 and by[None][1] == shared
    assert 20 < by[2][3] < 42 and by[2][1].startswith("zero")
    assert linechunks.without_repeats(table(spark, texts)).columns == table(spark, []).columns
    assert linechunks.deduplicated(table(spark, [])).count() == 0


def test_chunks_return_after_an_insertion():
    lines = [f"line {i * 7919 % 1000}" for i in range(60)]
    a = {c for _, _, c in linechunks.chunks_of("\n".join(lines))}
    b = {c for _, _, c in linechunks.chunks_of("\n".join([*lines[:20], "new", *lines[20:]]))}
    assert len(a & b) >= len(a) - 3 and all(e - s >= 2 for s, e, _ in linechunks.chunks_of("\n".join(lines)))


def without_passages(texts, words=linechunks.WORDS):
    """Lines left after removing every run of over so many words that an earlier place has, by trying all runs."""
    split = {d: t.split("\n") for d, t in texts}
    runs = [(d, a, b) for d, x in split.items() for a in range(len(x)) for b in range(a + 1, len(x) + 1) if len(" ".join(x[a:b]).split()) > words]
    first, gone = {}, set()
    for d, a, b in sorted(runs):
        body = tuple(split[d][a:b])
        if first.setdefault(body, (d, a)) != (d, a):
            gone.update((d, i) for i in range(a, b) if any(split[d][k].strip() for k in range(a, i + 1)) and any(split[d][k].strip() for k in range(i, b)))
    return {d: [y for i, y in enumerate(x) if (d, i) not in gone] for d, x in split.items()}


def test_passages_shared_by_different_documents(spark, monkeypatch):
    """One to six shared lines in the midst of other lines, of 60 words and of 45; chunks alone leave nearly all of them."""
    new = lambda k, n: " ".join(f"w{k}_{i}" for i in range(n))
    texts, shared = [], {}
    for n in range(1, 7):
        shared[n] = [new(f"s{n}_{k}", 60 // n) for k in range(n)]
        short = [new(f"t{n}_{k}", 45 // n) for k in range(n)]
        for copy in range(2):
            own = [new(f"o{n}_{copy}_{k}", 9) for k in range(6)]
            texts.append((10 * n + copy, "\n".join([*own[:2], *shared[n], own[2], "", *short, *own[3:]])))
    texts += [(900, "\n".join(["x " * 20] * 7 + ["", "", "y"])), (901, "\n".join(["a"] * 30 + ["", " "] + ["b"] * 30)), (902, "\n".join(["a"] * 30 + ["", ""] + ["b"] * 30))]
    monkeypatch.setattr(linechunks, "repeated_chunks", lambda *a: spark.createDataFrame([], "doc_id long, chunks array<int>"))
    rows = {r[0]: r[1] for r in linechunks.without_repeats(table(spark, texts)).collect()}
    for d, lines in without_passages(texts).items():
        assert rows[d] == "\n".join(lines), d
    assert all(x not in rows[10 * n + 1].split("\n") and x in rows[10 * n].split("\n") for n in shared for x in shared[n])


def test_passages_and_chunks_together(spark):
    texts = prose(5, 40)
    before = {r[0]: r[-1] for r in linechunks.deduplicated(table(spark, texts)).collect()}
    after = {r[0]: (r[1], r[-1]) for r in linechunks.deduplicated(table(spark, texts), passages=True).collect()}
    assert all(after[d][1] >= n for d, n in before.items()) and sum(n for _, n in after.values()) > sum(before.values())


@pytest.mark.parametrize("words", [2, 5])
def test_near_documents(spark, words):
    texts = prose(words, 90)
    rows = minmax.near_documents(table(spark, texts), words).collect()
    expected = near_components(texts, words)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == {d: len(shingles(t, words)) for d, t in texts}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_documents_in_a_chain(spark):
    """Neighbours are alike, the ends are not; the middle ones must be found though no pivot is near all."""
    words = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(words[i * 12 : i * 12 + 150])) for i in range(12)] + [(100 + i, " ".join(f"v{i}_{k}" for k in range(50))) for i in range(5)]
    rows = minmax.near_documents(table(spark, texts), 2).collect()
    assert {r.doc_id: r.component_id for r in rows} == near_components(texts, 2)


@pytest.mark.parametrize("block, bands", [(60, 40), (60, 0), (400, 8), (250_000, 0)])
def test_near_documents_in_blocks(spark, monkeypatch, block, bands):
    """Documents with one long passage in common, near and not: no link is lost where buckets are cut, or left to the second wave."""
    monkeypatch.setattr(minmax, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(minmax, "FIRST_BANDS", bands)
    rng = np.random.default_rng(5)
    passage = [f"p{k}" for k in range(40)]
    texts = [(int(i), " ".join(passage + [f"w{i % 9}_{k}" for k in range(rng.integers(0, 16))] + [f"x{i}"])) for i in range(70)]
    rows = minmax.near_documents(table(spark, texts), 2).collect()
    assert {r.doc_id: r.component_id for r in rows} == near_components(texts, 2)


def test_joined_sets():
    sets = [np.array(s, np.uint64) for s in ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [2, 3, 4, 5, 6], [], [9, 10], [9, 10, 11])]
    assert minmax.joined(np.array([1, 2, 3, 4, 5, 6]), np.zeros(6), sets, 80).tolist() == [0, 0, 0, 3, 4, 5]
    assert minmax.joined(np.array([1, 2, 3, 4, 5, 5]), np.array([0, 0, 1, 1, 0, 1]), sets, 80).tolist() == [0, 1, 1, 3, 4, 4]


def test_filter_keeps_what_it_was_made_of(spark, monkeypatch):
    monkeypatch.setattr(minmax, "FILTER_BITS", 1 << 12)
    bits = minmax.filter_of(spark.range(0, 900, 3))
    kept = {r.id for r in minmax.likely(spark.range(3000), "id", bits).collect()}
    assert set(range(0, 900, 3)) <= kept and len(kept) < 900
    assert minmax.likely(spark.range(50), "id", minmax.filter_of(spark.range(0))).count() == 0


def test_near_documents_odd(spark):
    rows = minmax.near_documents(table(spark, odd_texts()), 2).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(odd_texts()) and (by[0].n_shingles, by[0].component_id, by[0].kept) == (0, 0, True)
    assert by[5].component_id == 5 and by[4].component_id == 3 and not by[4].kept and by[None].kept and by[None].component_id is None
    assert minmax.near_documents(table(spark, [])).count() == 0
    kept = minmax.one_of_each(table(spark, odd_texts()))
    assert kept.columns == table(spark, []).columns and kept.count() == 8


def test_components(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1002, 1001), (5000, 5000), (None, 3)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def chains(text, plain=False):
    """Signatures as tuples of words instead of hashes."""
    import re

    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    content = [(w, i > 0 and words[i - 1] in spotsigs.ANCHORS) for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    out = {(w, content[i + 1][0]) for i, (w, begins) in enumerate(content) if begins and i + 1 < len(content)}
    n = sum(begins and i + 1 < len(content) for i, (_, begins) in enumerate(content))
    return out if n >= spotsigs.ENOUGH else out | ({(w,) for w in words} if words else {(text.lower(), None)} if text else set())


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_fingerprints(spark):
    texts = prose(8, 40) + [(5000, ""), (5001, None), (5002, "x"), (5003, "..."), (5004, "the of and")]
    rows = {r.doc_id: r for r in spotsigs.edited_likeness(table(spark, texts)).collect()}
    by = {d: t or "" for d, t in texts}
    order = sorted(by, reverse=True)
    for d, nxt in zip(order, [*order[1:], order[0]]):
        t = by[d]
        edited = t[: len(t) - len(t) // 2] + by[nxt][: len(t) // 2]
        assert rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[d].n_chars == len(t)
        assert abs(rows[d].near_edited - likeness(chains(t), chains(edited))) < 1e-12
        assert abs(rows[d].near_next - likeness(chains(t), chains(by[nxt]))) < 1e-12
    assert rows[5000].fingerprint == rows[5001].fingerprint == ""


def test_fingerprints_odd(spark):
    rows = spotsigs.edited_likeness(table(spark, odd_texts())).collect()
    assert len(rows) == len(odd_texts()) and len({r.fingerprint for r in rows if r.doc_id in (3, 4)}) == 1
    assert spotsigs.edited_likeness(table(spark, [])).count() == 0
    assert spotsigs.edited_likeness(table(spark, [(9, "alone in the world")])).first()["near_next"] == 1.0


def test_fingerprints_use_functions_only(spark):
    plan = spotsigs.edited_likeness(table(spark, prose(1, 5)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_matches_equal_all_pairs(spark):
    texts = [(d, t) for d, t in prose(11, 70)]
    signed = spotsigs.fingerprints(table(spark, texts)).cache()
    got = {(r.left_id, r.right_id): r.likeness for r in spotsigs.matches(signed, signed, 0.7).collect()}
    sets = {r.doc_id: set(r.signatures) for r in signed.collect()}
    expected = {(a, b): likeness(x, y) for a, x in sets.items() for b, y in sets.items() if x and y and likeness(x, y) >= 0.7}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-12 for k in got)
    assert signed.where(F.size("signatures") == 0).count() == 0
