"""BPE encoding and decoding by dynamic programming over the prefixes of each word.

The merges of a word leave the merges of its prefixes as they are, so the ids of a prefix are those of a shorter prefix and
one last token, and that token is unique. A suffix automaton of the vocabulary gives the tokens that end at a place, the
longest first; the first one that stays apart from the last token of the prefix before it is stored. Ids are read off by
following the stored tokens back. Whether two tokens stay apart is found by taking them to pieces backwards in time and
looking for a merge across their border that would have come first. No merge is ever carried out on a text.

Words don't depend on each other, so a bounded cache keeps the ids of words, and one in front of it those of chunks
between spaces.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import each_text, texts_of

VOCABULARY = "word_bpe_49k.json"
CACHED_BYTES = 120_000_000
CACHED_PAIRS = 400_000
#: Longer chunks and words are not kept.
CACHED_LENGTH = 64
WORDS_AT_ONCE = 20_000
#: Rough size of an entry of a cache beside its key and value.
ENTRY_BYTES = 160
#: Python parts a text at these, the tokenizer doesn't.
UNUSUAL = regex.compile("[\x1c-\x1f]")
# Fixed value: the pattern by which the vocabulary's tokenizer splits a text in lower case.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Added to the code of a word's last symbol, which is another symbol than the same byte within a word.
LAST = 0x400


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it can be printed, else the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [chr(spare.get(b, b)) for b in range(256)]


def gaps_of(values: list) -> list[int]:
    """Places of None."""
    out, i = [], -1
    for _ in range(values.count(None)):
        i = values.index(None, i + 1)
        out.append(i)
    return out


class BoundedCache:
    """A mapping of two generations, bounded by bytes; what is looked up again moves to the younger one."""

    def __init__(self, limit: int = CACHED_BYTES):
        self.half, self.size, self.young, self.old = limit // 2, 0, {}, {}

    def find(self, keys: list[str]) -> list[bytes | None]:
        """The value of each key, None where it is not known."""
        found = [*map(self.young.get, keys)]
        if self.old and None in found:
            moved = {}
            for i in gaps_of(found):
                if (value := self.old.get(keys[i])) is not None:
                    found[i] = moved[keys[i]] = value
            self.put(moved)
        return found

    def put(self, entries: dict[str, bytes]) -> None:
        kept = {k: v for k, v in entries.items() if len(k) <= CACHED_LENGTH}
        size = ENTRY_BYTES * len(kept) + 2 * sum(map(len, kept)) + sum(map(len, kept.values()))
        if self.size + size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        if size <= self.half:
            self.young.update(kept)
            self.size += size


class NumberTable:
    """A mapping of numbers to numbers, looked up for whole arrays: open addressing in the next free place."""

    def __init__(self, entries: dict[int, int]):
        keys, values = np.array([*entries], np.int64), np.array([*entries.values()], np.int64)
        self.bits = max(4, (3 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        place, left = self.place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[place[left]] < 0]
            _, first = np.unique(place[free], return_index=True)
            put = free[first]
            self.keys[place[put]], self.values[place[put]] = keys[put], values[put]
            left = left[self.keys[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        place = self.place(keys)
        there = self.keys[place]
        out = np.where(there == keys, self.values[place], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[place[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.values[place[open_[same]]]
            open_ = open_[~same & (there >= 0)]
        return out


class SuffixAutomaton:
    """Suffix automaton of a set of strings; ``step`` maps (state, code) to the next state, packed into one number."""

    SHIFT = 11

    def __init__(self):
        self.longest, self.link, self.moves = [0], [-1], [{}]

    def add(self, word: str) -> int:
        """Add a string; returns the state whose longest string it is."""
        last = 0
        for code in map(ord, word):
            last = self._grow(last, code)
        return last

    def _new(self, longest: int, moves: dict[int, int]) -> int:
        self.longest.append(longest)
        self.link.append(0)
        self.moves.append(moves)
        return len(self.longest) - 1

    def _copy(self, at: int, code: int, whole: int) -> int:
        """Split off the strings of ``whole`` that are one longer than those of ``at``."""
        part = self._new(self.longest[at] + 1, dict(self.moves[whole]))
        self.link[part], self.link[whole] = self.link[whole], part
        while at >= 0 and self.moves[at].get(code) == whole:
            self.moves[at][code] = part
            at = self.link[at]
        return part

    def _grow(self, last: int, code: int) -> int:
        there = self.moves[last].get(code)
        if there is not None:
            return there if self.longest[there] == self.longest[last] + 1 else self._copy(last, code, there)
        new, at = self._new(self.longest[last] + 1, {}), last
        while at >= 0 and code not in self.moves[at]:
            self.moves[at][code] = new
            at = self.link[at]
        if at >= 0:
            there = self.moves[at][code]
            self.link[new] = there if self.longest[there] == self.longest[at] + 1 else self._copy(at, code, there)
        return new

    def packed(self) -> dict[int, int]:
        shift = self.SHIFT
        return {state << shift | code: to for state, own in enumerate(self.moves) for code, to in own.items()}


class PrefixBpe:
    """A vocabulary with its merges. Tokens are numbered here in the order of their making: single symbols, then merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        suffix, ids = model["end_of_word_suffix"], model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        if len(made) < len(merges):
            raise ValueError("two merges make one token")
        names = [t for t in ids if t not in made] + [a + b for a, b in merges]
        number = {t: k for k, t in enumerate(names)}
        self.first_merge = len(ids) - len(merges)
        self.left = [0] * self.first_merge + [number[a] for a, _ in merges]
        self.right = [0] * self.first_merge + [number[b] for _, b in merges]
        self.joined = {number[a] << 20 | number[b]: self.first_merge + k for k, (a, b) in enumerate(merges)}
        self.ids = np.array([ids[t] for t in names], "<u4")
        self.text = dict(zip(ids.values(), (t.encode() for t in ids)))
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in parts["added_tokens"]}
        self.text |= {t["id"]: t["content"].encode() for t in parts["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.characters = {b: c for b, c in enumerate(byte_characters()) if chr(b) != c}
        self.pairs: dict[int, bool] = {}
        self.words, self.chunks = BoundedCache(), BoundedCache()
        self._match(names, suffix)

    def _match(self, names: list[str], suffix: str) -> None:
        """Automaton of the tokens that can come out of merging; those that merge otherwise never do."""
        symbols = [t[: -len(suffix) - 1] + chr(ord(t[-len(suffix) - 1]) + LAST) if t.endswith(suffix) and t != suffix else t for t in names]
        sound, automaton, place = [True] * len(names), SuffixAutomaton(), {}
        for k, word in enumerate(symbols):
            if k >= self.first_merge:
                a, b = self.left[k], self.right[k]
                sound[k] = sound[a] and sound[b] and self.apart(a, b, 2 * k)
            if sound[k]:
                place[k] = automaton.add(word)
        own = dict(zip(place.values(), place))
        self.size = [len(s) for s in symbols]
        # Nearest token on the chain of suffix links, from each state and from above each token.
        order = sorted(range(len(automaton.link)), key=automaton.longest.__getitem__)
        nearest = [-1] * len(order)
        self.shorter = [-1] * len(names)
        for state in order[1:]:
            above = nearest[automaton.link[state]]
            nearest[state] = own.get(state, above)
            if state in own:
                self.shorter[own[state]] = above
        self.nearest, self.link, self.longest, self.step = nearest, automaton.link, automaton.longest, automaton.packed()
        self.step_table, self.join_table = NumberTable(self.step), NumberTable(self.joined)
        self.automaton = tuple(np.array(x) for x in (self.link, self.longest, self.nearest))
        self.lefts, self.rights, self.sizes, self.shorters = (np.array(x) for x in (self.left, self.right, self.size, self.shorter))

    def apart(self, a: int, b: int, until: int = 1 << 60) -> bool:
        """Whether no merge joins the end of token ``a`` and the start of ``b``, both merged alone, before the time ``until``.

        The time of merge k is 2k, or 2k + 1 for the one that is further right, as equal merges go from left to right.
        """
        joined, left, right, first = self.joined, self.left, self.right, self.first_merge
        while True:
            if 2 * joined.get(a << 20 | b, 1 << 60) < until:
                return False
            if a > b:
                if a < first:
                    return True
                until, a = min(until, 2 * a), right[a]
            else:
                if b < first:
                    return True
                until, b = min(until, 2 * b + 1), left[b]

    def _word(self, word: str) -> bytes:
        """Ids of one word in lower case."""
        data = word if word.isascii() else word.encode("utf-8", "surrogatepass").decode("latin-1")
        data = data.translate(self.characters)
        codes = [*map(ord, data)]
        codes[-1] += LAST
        shift, step, link, longest, nearest, size, shorter = SuffixAutomaton.SHIFT, self.step, self.link, self.longest, self.nearest, self.size, self.shorter
        pairs, apart = self.pairs, self.apart
        last: list[int] = []  # the last token of each prefix
        state = length = 0
        for end, code in enumerate(codes, 1):
            while (there := step.get(state << shift | code)) is None:
                state = link[state]
                length = longest[state]
            state, length = there, length + 1
            token = nearest[state] if length == longest[state] else nearest[link[state]]
            while (before := end - size[token]) > 0:
                pair = last[before - 1] << 20 | token
                if (fits := pairs.get(pair)) is None:
                    fits = pairs[pair] = apart(last[before - 1], token)
                if fits:
                    break
                token = shorter[token]
            last.append(token)
        if len(pairs) > CACHED_PAIRS:
            pairs.clear()
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= size[last[at - 1]]
        return self.ids[out[::-1]].tobytes()

    def _lowered(self, chunk: str) -> str:
        if chunk.isascii():
            return chunk.lower()
        whole = unicodedata.normalize("NFC", chunk)
        return whole.lower() if "Σ" not in whole else "".join(c.lower() for c in whole)  # sigma is no other at the end of a word

    def _apart_each(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``apart`` for each pair of tokens."""
        out, at, until = np.ones(len(a), bool), np.arange(len(a)), np.full(len(a), 1 << 60)
        while len(at):
            met = self.join_table.get(a << 20 | b)
            together = (met >= 0) & (2 * met < until)
            out[at[together]] = False
            later = a > b
            open_ = ~together & (np.maximum(a, b) >= self.first_merge)
            at, a, b, until, later = at[open_], a[open_], b[open_], until[open_], later[open_]
            until = np.minimum(until, 2 * np.maximum(a, b) + ~later)
            a, b = np.where(later, self.rights[a], a), np.where(later, b, self.lefts[b])
        return out

    def _words_at_once(self, words: list[str]) -> list[bytes]:
        """The same as ``_word`` for each of many words of bounded length, place by place through all of them."""
        data = [w if w.isascii() else w.encode("utf-8", "surrogatepass").decode("latin-1") for w in words]
        order = sorted(range(len(data)), key=lambda i: -len(data[i]))
        codes = np.frombuffer("".join([data[i] for i in order]).translate(self.characters).encode("utf-16-le"), "<u2").astype(np.int64)
        lengths = np.array([len(data[i]) for i in order])
        starts = np.cumsum(lengths) - lengths
        codes[starts + lengths - 1] += LAST
        last = np.zeros(len(codes), np.int64)  # the last token of each prefix
        state, length = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        links, longest, nearest = self.automaton
        for place in range(lengths[0]):
            n = np.searchsorted(-lengths, -place)  # words that are longer come first
            code, open_ = codes[starts[:n] + place], np.arange(n)
            while len(open_):
                there = self.step_table.get(state[open_] << SuffixAutomaton.SHIFT | code[open_])
                found = there >= 0
                state[open_[found]] = there[found]
                length[open_[found]] += 1
                open_ = open_[~found]
                state[open_] = links[state[open_]]
                length[open_] = longest[state[open_]]
            own = state[:n]
            token = nearest[np.where(length[:n] == longest[own], own, links[own])]
            open_ = np.arange(n)
            while len(open_):
                before = place + 1 - self.sizes[token[open_]]
                inner, before = open_[before > 0], before[before > 0]
                open_ = inner[~self._apart_each(last[starts[inner] + before - 1], token[inner])]
                token[open_] = self.shorters[token[open_]]
            last[starts[:n] + place] = token
        ends, at = np.zeros(len(codes), bool), lengths.copy()
        open_ = np.arange(len(order))
        while len(open_):
            place = starts[open_] + at[open_] - 1
            ends[place] = True
            at[open_] -= self.sizes[last[place]]
            open_ = open_[at[open_] > 0]
        ids = self.ids[last[ends]].tobytes()
        bounds = (4 * np.concatenate([[0], np.cumsum(np.add.reduceat(ends, starts))])).tolist()
        out = [b""] * len(order)
        for i, a, b in zip(order, bounds, bounds[1:]):
            out[i] = ids[a:b]
        return out

    def _split(self, chunk: str) -> tuple[str, ...] | list[str]:
        """Words of a chunk: letters are one word, also before a mark; the pattern cuts the rest."""
        low = self._lowered(chunk)
        if low.isalpha():
            return (low,)
        if low[-1] in ".,!?;:" and low[:-1].isalpha():
            return low[:-1], low[-1]
        return PIECES.findall(low)

    def _learned(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks."""
        split = [*map(self._split, chunks)]
        names = [*dict.fromkeys(chain.from_iterable(split))]
        words = dict(zip(names, self.words.find(names)))
        fresh = [w for w, ids in words.items() if ids is None]
        long, some, new = [w for w in fresh if len(w) > CACHED_LENGTH], [w for w in fresh if len(w) <= CACHED_LENGTH], {}
        for i in range(0, len(some), WORDS_AT_ONCE):
            part = some[i : i + WORDS_AT_ONCE]
            new.update(zip(part, self._words_at_once(part)))
        self.words.put(new)
        words.update(new)
        words.update((w, self._word(w)) for w in long)
        found = {c: words[parts[0]] if len(parts) == 1 else b"".join(map(words.__getitem__, parts)) for c, parts in zip(chunks, split)}
        self.chunks.put(found)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers. The strings of added tokens are these tokens."""
        known: list[list] = []
        open_: list[tuple[list, list[str], list[int]]] = []
        for text in texts:
            own: list = []
            for part in self.special.split(text) if self.special and "<" in text else (text,):
                if part in self.added:
                    own.append(self.added[part])
                    continue
                chunks = [part] if UNUSUAL.search(part) else part.split()
                found = [*map(self.chunks.young.get, chunks)]
                if None in found:
                    open_.append((found, chunks, gaps_of(found)))
                own.append(found)
            known.append(own)
        if open_:
            asked = [*dict.fromkeys([chunks[i] for _, chunks, gaps in open_ for i in gaps])]
            values = dict(zip(asked, self.chunks.find(asked)))
            values.update(self._learned([c for c, ids in values.items() if ids is None]))
            for found, chunks, gaps in open_:
                for i in gaps:
                    found[i] = values[chunks[i]]
        return [b"".join([x if isinstance(x, bytes) else b"".join(x) for x in own]) for own in known]

    def decode(self, ids: bytes) -> bytes:
        """The tokens of the ids, separated by spaces, as a vocabulary without a decoder has them."""
        return b" ".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def prefix_bpe(path: str | None) -> PrefixBpe:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return PrefixBpe(path)


def prefix_digests(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each whole text encoded, its ids decoded, digests of both.

    A null text is an empty one: no tokens, digests of nothing. Repeated rows give repeated rows; a null id stays null; an
    empty table gives an empty one; other columns are left out. ``vocabulary``: path of the vocabulary's file.
    """

    def rows(texts: list[str]) -> list[list]:
        own = prefix_bpe(vocabulary)
        ids = own.encode(texts)
        return [[len(i) // 4 for i in ids], [hashlib.sha256(i).hexdigest() for i in ids], [hashlib.sha256(own.decode(i)).hexdigest() for i in ids]]

    return each_text(texts_of(docs, id_column, text_column), rows, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def prefix_encoded(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of each whole text; odd rows as in ``prefix_digests``."""

    def rows(texts: list[str]) -> list[list]:
        own = prefix_bpe(vocabulary)
        ids = own.encode(texts)
        return [[np.frombuffer(i, "<i4").tolist() for i in ids], [own.decode(i).decode() for i in ids]]

    return each_text(texts_of(docs, id_column, text_column), rows, "ids array<int>, decoded string")


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
