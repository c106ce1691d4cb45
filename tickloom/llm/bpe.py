"""Byte-level BPE, encoding and decoding.

Pre-tokenisation uses arrays instead of regular expressions: each code point gets a class, and whether a token starts at
it follows from the state of a small automaton. A block of text is a function from the state before it to the state
behind it; such functions compose associatively, so all blocks are reduced at once, a prefix scan over the blocks gives
each its entry state, and a last pass marks the boundaries. The slices between them go through a bounded cache in front
of the pair merges. Each token keeps its place in the text, so ids can be decoded to the exact bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import each_text, texts_of

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHED_SLICES = 200_000
BLOCK = 64

# The contraction endings of the pattern, and the code points that Unicode calls white space.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
SPACES = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Classes of code points in their place, and states of the automaton.
LETTER, NUMBER, OTHER, SPACE, JOINS, LAST_SPACE, SHORT, LONG, END = range(9)
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, JOINING, ONE_LEFT, TWO_LEFT = range(8)


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a token) by class and state."""
    after = np.zeros((9, 8), np.uint8)
    starts = np.ones((9, 8), bool)
    for kind, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS), (SPACE, IN_SPACE)):
        after[kind] = state
        starts[kind, state] = False
    for kind in (LETTER, NUMBER, OTHER):
        starts[kind, JOINING] = False
    after[LETTER, TWO_LEFT], after[LETTER, ONE_LEFT] = ONE_LEFT, FREE
    starts[LETTER, [TWO_LEFT, ONE_LEFT]] = False
    after[JOINS], after[LAST_SPACE], after[END] = JOINING, FREE, FREE
    for kind, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        after[kind] = state
        after[kind, [IN_OTHERS, JOINING]] = IN_OTHERS
        starts[kind, [IN_OTHERS, JOINING]] = False
    return after, starts


AFTER, STARTS = automaton()


@lru_cache(1)
def class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    major = np.frombuffer(kinds.encode("ascii"), np.uint8)
    table[major == ord("L")] = LETTER
    table[major == ord("N")] = NUMBER
    table[list(SPACES)] = SPACE
    return table


def classes_in_place(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each code point, seen with its neighbours. ``ends`` marks the places between texts."""
    kind = class_table()[points]
    kind[ends] = END
    follows = np.append(kind[1:], END)
    last = (kind == SPACE) & (follows != SPACE) & (follows != END)
    kind[last] = np.where(points[last] == 32, JOINS, LAST_SPACE)
    quotes = np.flatnonzero(points == ord("'"))
    quotes = quotes[kind[quotes] == OTHER]
    if len(quotes):
        padded = np.concatenate([np.where(ends, 0, points), [0, 0, 0]])
        one, two = padded[quotes + 1], padded[quotes + 2]
        kind[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SHORT
        for a, b in TWO_LETTERS:
            kind[quotes[(one == ord(a)) & (two == ord(b))]] = LONG
    return kind


def composed_before(functions: np.ndarray) -> np.ndarray:
    """Row i: the composition of all rows before i, by doubling. A row maps the state before to the state behind."""
    count, states = functions.shape
    whole = functions.copy()
    step = 1
    while step < count:
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].copy(), axis=1)
        step *= 2
    identity = np.arange(states, dtype=np.uint8)[None, :]
    return np.concatenate([identity, whole[:-1]])


def token_starts(kind: np.ndarray) -> np.ndarray:
    """Places at which a token (or a place between texts) starts."""
    blocks = -(-len(kind) // BLOCK)
    grid = np.full(blocks * BLOCK, END, np.uint8)
    grid[: len(kind)] = kind
    columns = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (blocks, 8))
    flat = AFTER.ravel()
    for column in columns:
        whole = flat[(column[:, None].astype(np.uint8) << 3) | whole]
    state = composed_before(whole)[:, FREE]
    marks = np.empty((BLOCK, blocks), bool)
    starting = STARTS.ravel()
    for i, column in enumerate(columns):
        at = (column << 3) | state
        marks[i] = starting[at]
        state = flat[at]
    return np.flatnonzero(marks.T.ravel()[: len(kind)])


class Encoder:
    """Ranks and the slices merged so far. The cache has two generations, so it is bounded and keeps what is in use."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: the adjacent pair of least rank is merged, the leftmost first, until none is known."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        if len(piece) > 100:
            return self.merged_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) < 1 << 30:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        return tuple(ranks[p] for p in parts)

    def merged_long(self, piece: bytes) -> tuple[int, ...]:
        """The same for a long slice, with a heap of pairs over a linked list: no time grows with the square of its length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def __call__(self, piece: str) -> tuple[int, ...]:
        if (ids := self.old.get(piece)) is None:
            ids = self.merged(piece.encode())
        if len(piece) <= 64:
            if len(self.young) >= CACHED_SLICES:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[tuple[array, np.ndarray]]:
        """(ids, start of each slice in code points) of each text."""
        whole = "\n".join(texts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        between = np.cumsum(lengths + 1) - 1
        ends = np.zeros(len(points), bool)
        ends[between] = True
        starts = token_starts(classes_in_place(points, ends))
        cuts = np.searchsorted(starts, between)
        bounds = starts.tolist()
        out, first = [], 0
        for cut, begin in zip(cuts.tolist(), (between - lengths).tolist()):
            own = bounds[first : cut + 1]
            ids: list[tuple[int, ...]] = []
            known = self.young
            for a, b in zip(own, own[1:]):
                piece = whole[a:b]
                try:
                    ids.append(known[piece])
                except KeyError:
                    ids.append(self(piece))
                    known = self.young
            out.append((array("I", chain.from_iterable(ids)), starts[first:cut] - begin))
            first = cut + 1
        return out

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(2)
def encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return Encoder(path)


def token_digests(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode each whole text, decode the ids, and give counts and digests of both. ``vocabulary``: path of a rank file.

    A null text is an empty one: no tokens, digests of nothing. Repeated rows give repeated rows; an empty table gives
    an empty one; a null id stays null; other columns are left out.
    """

    def rows(texts: list[str]) -> list[list]:
        own = encoder(vocabulary)
        ids = [i for i, _ in own.encode(texts)]
        return [[len(i) for i in ids], [hashlib.sha256(little_endian(i)).hexdigest() for i in ids], [hashlib.sha256(own.decode(i)).hexdigest() for i in ids]]

    return each_text(texts_of(docs, id_column, text_column), rows, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids array<long>, starts array<long>): the ids, and where each slice starts in code points."""

    def rows(texts: list[str]) -> list[list]:
        found = encoder(vocabulary).encode(texts)
        return [[i.tolist() for i, _ in found], [s.tolist() for _, s in found]]

    return each_text(texts_of(docs, id_column, text_column), rows, "ids array<long>, starts array<long>")


def little_endian(ids: array) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
