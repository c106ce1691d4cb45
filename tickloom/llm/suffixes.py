"""Exact deduplication of byte strings by a hash-compared suffix sort.

Every string of 50 bytes has an anchor, its part of 24 bytes of least hash, and equal strings have equal anchors at equal
places. So only the suffixes at anchors need sorting, and of those only the ones whose anchor occurs in several
documents. The steps exchange short hashes between batches of documents and buckets of hashes:

1. each batch asks which of its anchors occur in other documents;
2. for those, it asks whether the whole context (every byte that a string with this anchor can reach) begins in a smaller
   document already; then all of it goes. Anchors of very many documents ask so for each of their strings instead;
3. contexts seen here first are sorted in their anchor's bucket: suffixes from the anchor to the right, and reversed ones
   to the left, by mergesort. Two suffixes are compared by a binary search over their prefix polynomial hashes, which finds
   their common extension in six probes; neighbours are then compared byte by byte. Strings are equal if their right
   parts and their left parts are, so the ranks of both give the classes of equal strings, and each class its smallest
   document.

A hash occurs once in a batch's message whatever the number of its copies, buckets are dealt by hash, and very frequent
anchors don't enter the sort, so no task grows with the frequency of a string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import texts_of

LENGTH = 50
GRAM = 24
BATCH_BYTES = 2_000_000
BUCKET_BYTES = 8_000_000
LEAST_BUCKETS = 64
SEGMENT = 1_000_000
FREQUENT = 10_000

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
U = np.uint64
SIDE = LENGTH - GRAM
REACH = 2 * LENGTH - GRAM

RECORD = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("batch", "<i8"), ("at", "<i8"), ("left", "u1"), ("right", "u1"), ("bytes", "u1", (REACH,))])
SPAN = np.dtype([("doc", "<i8"), ("start", "<i8"), ("end", "<i8")])
ASK = np.dtype([("hash", "<u8"), ("doc", "<i8")])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


@lru_cache(2)
def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    up, down = np.full(count, U(BASE)), np.full(count, U(pow(BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Rolling:
    """Prefix polynomial hashes of a sequence: the hash of any part in one step."""

    def __init__(self, values: np.ndarray):
        size = 1 << int(len(values) + 1).bit_length()
        up, self.down = powers(size)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(values * up[: len(values)], dtype=U)])

    def parts(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.down[starts] + U(length))

    def all_parts(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n] + U(length))


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return x if step == width else np.minimum(x[: len(x) - (width - step)], x[width - step :])


def segments(texts: list[bytes]) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
    """Packs of (text, place of the segment, first and last string start, bytes); long texts are cut with enough overlap."""
    pack, size = [], 0
    for i, data in enumerate(texts):
        for low in range(0, len(data) - LENGTH + 1, SEGMENT):
            high = min(low + SEGMENT, len(data) - LENGTH + 1)
            begin = max(0, low - REACH)
            pack.append((i, begin, low, high, data[begin : high + REACH + LENGTH]))
            size += len(pack[-1][4])
            if size >= SEGMENT:
                yield pack
                pack, size = [], 0
    if pack:
        yield pack


class Anchors:
    """Anchors of some texts: text, place, hash of the anchor and of its context, and the hashes of strings on demand."""

    def __init__(self, pack: list[tuple[int, int, int, int, bytes]], texts: list[bytes]):
        self.texts = texts
        gap = b"\0" * LENGTH
        joined = gap + gap.join(s[4] for s in pack) + gap
        self.values = np.frombuffer(joined, np.uint8).astype(U) + U(1)
        places, valid, at = [], np.zeros(len(joined), bool), LENGTH
        for _, begin, low, high, data in pack:
            places.append(at)
            self.values[at - LENGTH : at] = 0  # bytes are 1 to 256, what is outside a text is 0
            valid[at + low - begin : at + high - begin] = True
            at += len(data) + LENGTH
        self.values[at - LENGTH :] = 0
        self.rolling = Rolling(self.values)
        h = self.rolling.all_parts(GRAM)
        least = least_of(h, SIDE + 1)
        least[~valid[: len(least)]] = 0
        edge = np.full(SIDE, U(MASK))
        most = ~least_of(np.concatenate([edge, ~least, edge]), SIDE + 1)
        self.where = np.flatnonzero(most[: len(h)] == h)
        own = np.searchsorted(places, self.where, side="right") - 1
        self.text = np.array([s[0] for s in pack])[own]
        self.shift = (np.array([s[1] for s in pack]) - np.array(places))[own]
        self.place = self.where + self.shift
        self.gram = h[self.where]

    def contexts(self, rows: np.ndarray) -> np.ndarray:
        return self.rolling.parts(self.where[rows] - SIDE, REACH)

    def strings(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, hash) of the strings that hold an anchor."""
        lengths = np.array([len(t) for t in self.texts])
        offset = np.tile(np.arange(SIDE + 1), len(rows))
        r = np.repeat(rows, SIDE + 1)
        place = self.place[r] - offset
        inside = (place >= 0) & (place + LENGTH <= lengths[self.text[r]])
        r, place = r[inside], place[inside]
        return self.text[r], place, self.rolling.parts(place - self.shift[r], LENGTH) ^ U(1)


def anchors_of(texts: list[bytes]) -> Iterator[Anchors]:
    for pack in segments(texts):
        yield Anchors(pack, texts)


def counted_grams(parts: list[Anchors]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct anchor hashes of a batch and in how many of its texts each occurs (at most 255)."""
    if not parts:
        return np.empty(0, U), np.empty(0, np.uint8)
    gram, text = np.concatenate([p.gram for p in parts]), np.concatenate([p.text for p in parts])
    order = np.lexsort((text, gram))
    gram, text = gram[order], text[order]
    fresh = np.r_[True, gram[1:] != gram[:-1]] if len(gram) else np.empty(0, bool)
    other = fresh | np.r_[True, text[1:] != text[:-1]] if len(gram) else fresh
    group = np.cumsum(fresh) - 1
    return gram[fresh], np.minimum(np.bincount(group[other], minlength=int(fresh.sum())), 255).astype(np.uint8)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> U(40)) % U(buckets)).astype(np.int64)


def texts_in(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids and bytes of a batch in a fixed order; rows without an id take no part."""
    rows = sorted((d, t) for d, t in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()) if d is not None)
    return np.array([d for d, _ in rows], np.int64), [t.encode() for _, t in rows]


MESSAGE = "target long, kind int, batch long, data binary"
#: Kinds of messages. Those to a batch have its number as target, those to a bucket a negative one.
GRAMS, CODES, ASKS, ANSWERS, RECORDS, SPANS = range(6)


def to_bucket(bucket: int) -> int:
    return -1 - bucket


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["target", "kind", "batch", "data"])


def split_out(bucket: np.ndarray, data: np.ndarray, kind: int, batch: int, to: list) -> None:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
    for part in np.split(order, cuts[1:]) if len(order) else []:
        to.append((to_bucket(int(bucket[part[0]])), kind, batch, data[part].tobytes()))


def parts_by(table: pa.Table, kind: int) -> dict[int, bytes]:
    """Data of the messages of a kind by bucket (in a batch) or by batch (in a bucket)."""
    return {b: d for k, b, d in zip(table.column("kind").to_pylist(), table.column("batch").to_pylist(), table.column("data").to_pylist()) if k == kind}


def put_back(bucket: np.ndarray, found: dict[int, bytes]) -> np.ndarray:
    """Answers, one byte each, in the order of the questions."""
    out = np.zeros(len(bucket), np.uint8)
    for b, data in found.items():
        out[bucket == b] = np.frombuffer(data, np.uint8)
    return out


def ask_grams(buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch, (_, texts) = key[0].as_py(), texts_in(table)
        gram, count = counted_grams(list(anchors_of(texts)))
        data = np.concatenate([gram[:, None].view(np.uint8)[:, :5], count[:, None]], axis=1) if len(gram) else np.empty((0, 6), np.uint8)
        out: list = []
        split_out(bucket_of(gram, buckets), data, GRAMS, batch, out)
        return messages(out)

    return run


def answer_grams(frequent: int):
    """For each anchor of each batch: 0 if no other document has it, 1 if one has, 2 if more than ``frequent`` have."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = {b: np.frombuffer(d, np.uint8).reshape(-1, 6) for b, d in parts_by(table, GRAMS).items()}
        whole = np.concatenate(list(rows.values()))
        low = np.zeros((len(whole), 8), np.uint8)
        low[:, :5] = whole[:, :5]
        _, group = np.unique(low.view("<u8").ravel(), return_inverse=True)
        uses = np.bincount(group, weights=whole[:, 5])[group]
        codes = np.where(uses > frequent, 2, np.where(uses > 1, 1, 0)).astype(np.uint8)
        out, at = [], 0
        for b, r in rows.items():
            out.append((b, CODES, -1 - key[0].as_py(), codes[at : at + len(r)].tobytes()))
            at += len(r)
        return messages(out)

    return run


def survivors(parts: list[Anchors], gram: np.ndarray, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of ordinary and of very frequent repeated anchors, for each part."""
    own = [codes[np.searchsorted(gram, p.gram)] for p in parts]
    return [(np.flatnonzero(c == 1), np.flatnonzero(c == 2)) for c in own]


def questions(ids: np.ndarray, parts: list[Anchors], kept: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of contexts and strings of a batch, and the smallest document of each."""
    hashes, docs = [np.empty(0, U)], [np.empty(0, np.int64)]
    for p, (plain, frequent) in zip(parts, kept):
        text, _, h = p.strings(frequent)
        hashes += [p.contexts(plain), h]
        docs += [ids[p.text[plain]], ids[text]]
    h, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((d, h))
    first = np.r_[True, h[order][1:] != h[order][:-1]] if len(h) else np.empty(0, bool)
    return h[order][first], d[order][first]


def ask_contexts(buckets: int):
    def run(key: tuple, docs: pa.Table, said: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return messages([])
        batch, (ids, texts) = key[0].as_py(), texts_in(docs)
        parts = list(anchors_of(texts))
        gram, _ = counted_grams(parts)
        codes = put_back(bucket_of(gram, buckets), parts_by(said, CODES))
        h, d = questions(ids, parts, survivors(parts, gram, codes))
        asks = np.empty(len(h), ASK)
        asks["hash"], asks["doc"] = h, d
        out: list = [(batch, CODES, -1, codes.tobytes())]
        split_out(bucket_of(h, buckets), asks, ASKS, batch, out)
        return messages(out)

    return run


def answer_contexts(key: tuple, table: pa.Table) -> pa.Table:
    """1 where a smaller document has the same; what a batch has sent to itself goes on."""
    target = key[0].as_py()
    if target >= 0:
        return table.select(["target", "kind", "batch", "data"])
    rows = {b: np.frombuffer(d, ASK) for b, d in parts_by(table, ASKS).items()}
    whole = np.concatenate(list(rows.values()))
    order = np.lexsort((whole["doc"], whole["hash"]))
    h = whole["hash"][order]
    first = np.r_[True, h[1:] != h[:-1]]
    least = np.empty(len(whole), np.int64)
    least[order] = whole["doc"][order][first][np.cumsum(first) - 1]
    seen = (least < whole["doc"]).astype(np.uint8)
    out, at = [], 0
    for b, r in rows.items():
        out.append((b, ANSWERS, -1 - target, seen[at : at + len(r)].tobytes()))
        at += len(r)
    return messages(out)


def spans_of(ids: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(text), SPAN)
    out["doc"], out["start"], out["end"] = ids[text], start, end
    return out


def send_records(buckets: int):
    def run(key: tuple, docs: pa.Table, said: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return messages([])
        batch, (ids, texts) = key[0].as_py(), texts_in(docs)
        parts = list(anchors_of(texts))
        gram, _ = counted_grams(parts)
        codes = np.frombuffer(parts_by(said, CODES).get(-1, b""), np.uint8)
        kept = survivors(parts, gram, codes)
        h, least = questions(ids, parts, kept)
        seen = put_back(bucket_of(h, buckets), parts_by(said, ANSWERS)).astype(bool)
        lengths = np.array([len(t) for t in texts], np.int64)
        out: list = []
        spans, sent = [], np.zeros(len(h), bool)
        for p, (plain, frequent) in zip(parts, kept):
            at = np.searchsorted(h, p.contexts(plain))
            doc = ids[p.text[plain]]
            gone = seen[at] | (least[at] < doc)
            r = plain[gone]
            spans.append(spans_of(ids, p.text[r], np.maximum(0, p.place[r] - SIDE), np.minimum(lengths[p.text[r]], p.place[r] + LENGTH)))
            text, place, own = p.strings(frequent)
            k = np.searchsorted(h, own)
            gone_s = seen[k] | (least[k] < ids[text])
            spans.append(spans_of(ids, text[gone_s], place[gone_s], place[gone_s] + LENGTH))
            # One record for each context of the document that has it first, also if it has it more than once.
            fresh = np.flatnonzero(~gone)
            r, k = plain[fresh], at[fresh]
            made = np.empty(len(r), RECORD)
            made["gram"], made["doc"], made["batch"], made["at"] = p.gram[r], doc[fresh], batch, p.place[r]
            made["left"] = np.minimum(SIDE, p.place[r])
            made["right"] = np.minimum(LENGTH, lengths[p.text[r]] - p.place[r])
            index = (p.where[r] - SIDE)[:, None] + np.arange(REACH)[None, :]
            made["bytes"] = np.maximum(p.values[index], U(1)) - U(1)
            split_out(bucket_of(made["gram"], buckets), made, RECORDS, batch, out)
        if spans and sum(map(len, spans)):
            out.append((batch, SPANS, -1, merged(np.concatenate(spans)).tobytes()))
        return messages(out)

    return run


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of overlapping or touching spans of each document."""
    spans = spans[np.lexsort((spans["start"], spans["doc"]))]
    if not len(spans):
        return spans
    rank = np.cumsum(np.r_[False, spans["doc"][1:] != spans["doc"][:-1]])
    room = np.int64(spans["end"].max() + 1)
    reach = np.maximum.accumulate(spans["end"] + rank * room)
    begins = np.r_[True, (spans["start"] + rank * room)[1:] > reach[:-1]]
    out = spans[begins].copy()
    out["end"] = (reach - rank * room)[np.r_[np.flatnonzero(begins)[1:] - 1, len(spans) - 1]]
    return out


class Suffixes:
    """Short suffixes (rows of values, 0 past their end) with the hashes of all their prefixes."""

    def __init__(self, values: np.ndarray):
        self.values, self.width = values, values.shape[1]
        self.hashes = np.zeros((len(values), self.width + 1), U)
        for j in range(self.width):
            self.hashes[:, j + 1] = self.hashes[:, j] * U(BASE) + values[:, j].astype(U) + U(1)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by binary search over prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width, np.int64)
        for _ in range(self.width.bit_length()):
            mid = (low + high + 1) >> 1
            same = self.hashes[a, mid] == self.hashes[b, mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        at = self.common(a, b)
        inside = np.minimum(at, self.width - 1)
        return np.where(at == self.width, or_equal, self.values[a, inside] < self.values[b, inside])

    def sorted_within(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Order of the rows after a bottom-up mergesort inside each group; ``start`` and ``size`` are those of each row's group."""
        order = np.arange(len(start))
        run = 1
        while run < size.max(initial=0):
            at = np.flatnonzero(size > run)
            inside = at - start[at]
            pair = start[at] + inside // (2 * run) * (2 * run)
            place = inside % (2 * run)
            right = place >= run
            other = np.where(right, pair, pair + run)
            count = np.where(right, run, np.clip(start[at] + size[at] - pair - run, 0, run))
            low, high = np.zeros(len(at), np.int64), count.copy()
            while (todo := np.flatnonzero(low < high)).size:
                mid = (low[todo] + high[todo]) >> 1
                before = self.less(order[other[todo] + mid], order[at[todo]], right[todo])
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
            moved = order.copy()
            moved[pair + np.where(right, place - run, place) + low] = order[at]
            order = moved
            run *= 2
        return order

    def ranks(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, common extension with the row before, -1 at the start of a group), checked byte by byte."""
        order = self.sorted_within(start, size)
        common = np.full(len(order), -1, np.int64)
        joined = np.flatnonzero(np.arange(len(order)) != start)
        a, b = order[joined - 1], order[joined]
        same = self.values[a] == self.values[b]
        exact = np.where(same.all(axis=1), self.width, same.argmin(axis=1))
        common[joined] = self.common(a, b)
        if not np.array_equal(common[joined], exact):  # two different prefixes with one hash: sort by the bytes
            order = np.lexsort([*self.values.T[::-1], start])
            a, b = order[joined - 1], order[joined]
            same = self.values[a] == self.values[b]
            common[joined] = np.where(same.all(axis=1), self.width, same.argmin(axis=1))
        return order, common


def sort_records(key: tuple, table: pa.Table) -> pa.Table:
    """Spans of the strings of each record that a smaller document of the bucket has too."""
    if key[0].as_py() >= 0:
        return table.select(["target", "kind", "batch", "data"])
    whole = np.concatenate([np.frombuffer(d, RECORD) for d in table.column("data").to_pylist()])
    whole = whole[np.argsort(whole["gram"], kind="stable")]
    first = np.r_[True, whole["gram"][1:] != whole["gram"][:-1]]
    group = np.cumsum(first) - 1
    begins = np.flatnonzero(first)
    sizes = np.diff(np.r_[begins, len(whole)])
    start, size = begins[group], sizes[group]
    data = whole["bytes"].astype(np.int16) + 1
    column = np.arange(REACH)[None, :]
    data[(column < SIDE - whole["left"].astype(int)[:, None]) | (column >= SIDE + whole["right"].astype(int)[:, None])] = 0
    right_order, right_common = Suffixes(data[:, SIDE:]).ranks(start, size)
    left_order, left_common = Suffixes(np.ascontiguousarray(data[:, :SIDE][:, ::-1])).ranks(start, size)
    right_class, left_class = np.empty(len(whole), np.int64), np.empty(len(whole), np.int64)
    found = []
    for offset in range(SIDE + 1):
        right_class[right_order] = np.cumsum(right_common < LENGTH - offset)
        left_class[left_order] = np.cumsum(left_common < offset)
        rows = np.flatnonzero((whole["left"] >= offset) & (whole["right"] >= LENGTH - offset))
        if not len(rows):
            continue
        _, kind = np.unique(right_class[rows] * (len(whole) + 1) + left_class[rows], return_inverse=True)
        least = np.full(kind.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, kind, whole["doc"][rows])
        hit = rows[least[kind] < whole["doc"][rows]]
        spans = np.empty(len(hit), SPAN)
        spans["doc"], spans["start"], spans["end"] = whole["doc"][hit], whole["at"][hit] - offset, whole["at"][hit] - offset + LENGTH
        found.append((whole["batch"][hit], spans))
    batch = np.concatenate([b for b, _ in found]) if found else np.empty(0, np.int64)
    spans = np.concatenate([s for _, s in found]) if found else np.empty(0, SPAN)
    order = np.argsort(batch, kind="stable")
    batch, spans = batch[order], spans[order]
    cuts = np.flatnonzero(np.r_[True, batch[1:] != batch[:-1]]) if len(batch) else np.empty(0, int)
    return messages([(int(batch[a]), SPANS, key[0].as_py(), merged(spans[a:b]).tobytes()) for a, b in zip(cuts, np.r_[cuts[1:], len(batch)])])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def cut_texts(keep_text: bool):
    def run(key: tuple, docs: pa.Table, said: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(d, SPAN) for d in said.column("data").to_pylist()]
        spans = merged(np.concatenate(blobs)) if blobs else np.empty(0, SPAN)
        out: list[tuple] = []
        for doc, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
            data, own = text.encode(), ()
            if doc is not None:
                own = spans[np.searchsorted(spans["doc"], doc) : np.searchsorted(spans["doc"], doc, side="right")]
            pieces, at, gone, runs = [], 0, 0, 0
            for s, e in zip(own["start"].tolist(), own["end"].tolist()) if len(own) else ():
                e = min(e, len(data))  # rows that share an id have their spans in common
                if s < e:
                    pieces.append(data[at:s])
                    at, gone, runs = e, gone + e - s, runs + 1
            kept = b"".join([*pieces, data[at:]])
            out.append((doc, len(data), gone, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if keep_text else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], RESULT.replace(" long", "").replace(" string", "").split(", "))

    return run


def repeated_bytes(docs: DataFrame, keep_text: bool = False, frequent: int = FREQUENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]): bytes covered by a 50-byte string that starts in a smaller document too are removed.

    ``kept`` is the rest as text, a cut character shown as a replacement. A null text is an empty one; nothing is removed
    from texts under 50 bytes. Rows without an id neither lose bytes nor make others lose them; rows that share an id
    are one document for the comparison with others, and each loses what any of them loses. An empty table gives an
    empty one; other columns are left out. Anchors of more than ``frequent`` documents are not sorted but asked for
    string by string; the result is the same.
    """
    own = texts_of(docs, id_column, text_column)
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-total // BATCH_BYTES))
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    # One shuffle of the texts serves all four passes over them, as each reads the same exchange.
    dealt = own.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))).repartition("batch")
    by_batch = dealt.groupBy("batch")
    grams = by_batch.applyInArrow(ask_grams(buckets), MESSAGE)
    codes = grams.groupBy("target").applyInArrow(answer_grams(frequent), MESSAGE)
    asked = by_batch.cogroup(codes.groupBy("target")).applyInArrow(ask_contexts(buckets), MESSAGE)
    answers = asked.groupBy("target").applyInArrow(answer_contexts, MESSAGE)
    records = by_batch.cogroup(answers.groupBy("target")).applyInArrow(send_records(buckets), MESSAGE)
    spans = records.groupBy("target").applyInArrow(sort_records, MESSAGE)
    result = by_batch.cogroup(spans.groupBy("target")).applyInArrow(cut_texts(keep_text), RESULT)
    return result if keep_text else result.drop("kept")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
