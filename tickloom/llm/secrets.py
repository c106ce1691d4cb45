"""Secrets by assignment-aware lexing.

Each separator (``=``, ``:``, ``:=``, ``=>``) of source or configuration text is lexed into a name before it and a
literal or reference behind it. Constants are propagated through references and concatenations, and a literal is
reported when its target's name is sensitive and the value looks like a secret. The token rules of three base kinds
(assignments to the plain key words, access keys, long hexadecimal runs) are part of the lexer.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import each_text, texts_of

# Kinds in the order of the result, key words of the base rule, and parts of names that mark a secret.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "named")
KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "token": 0.9, "apikey": 1.0, "api_key": 1.0,
    "private_key": 1.0, "access_key": 1.0, "auth_key": 0.9, "signing_key": 0.9, "encryption_key": 0.9, "credential": 0.9, "credentials": 0.9, "bearer": 0.8,
}
PLACEHOLDERS = frozenset("changeme password secret token none null true false example your_password your_token redacted".split())
PREFIXES = ("${", "{{", "<", "%(", "//", "/")  # of templates and paths

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}+")
SEPARATOR = re.compile(r":=|=>|==|!=|<=|>=|[:=]")
QUOTED = re.compile(r"""[ \t]*(["'])((?:(?!\1)[^\\\n]|\\.)*+)\1""")
PLUS = re.compile(r"[ \t]*\+")
BARE = re.compile(r"[ \t]*([^\s\"',;#{}\[\]()<>]+)")
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost, non-overlapping matches of each base kind; matches below the least length are used up and dropped."""
    low = text.lower()
    assign = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if any(w in low for w in KEY_WORDS) else []
    access = [m.span() for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def name_before(text: str, at: int, floor: int) -> str:
    """The identifier that ends before a separator, quotes and blanks between them skipped."""
    end = at
    while end > floor and text[end - 1] in " \t":
        end -= 1
    if end > floor and text[end - 1] in "\"']":
        end -= 1
    while end > floor and text[end - 1] in "\"'":
        end -= 1
    start = end
    while start > floor and text[start - 1] in NAME_CHARS:
        start -= 1
    return text[start:end]


def pairs_of(text: str) -> list[tuple[str, str | None, str | None, tuple[int, int]]]:
    """(name, reference or None, literal, span) of each assignment, in order, those nested in a bare value included.

    The end of a bare token is found once for all separators in it. A value that holds further separators is given by
    its span alone, its literal None: it can't be a reference, and slices of it would add up to the square of its length.
    """
    out, floor, stop, last = [], 0, 0, 0
    for sep in SEPARATOR.finditer(text):
        if sep[0] in ("==", "!=", "<=", ">=") or sep.start() < floor:
            continue
        name = name_before(text, sep.start(), floor)
        floor = begin = sep.end()
        if not name:
            continue
        if first := QUOTED.match(text, sep.end()):
            parts, span, end = [first[2]], first.span(2), first.end()
            while (plus := PLUS.match(text, end)) and (more := QUOTED.match(text, plus.end())):
                parts.append(more[2])
                span, end = (span[0], more.end(2)), more.end()
            out.append((name, None, "".join(parts), span))
            floor = end
            continue
        if begin >= stop:
            if not (bare := BARE.match(text, begin)):
                continue
            begin, stop = bare.span(1)
            last = max(text.rfind(":", begin, stop), text.rfind("=", begin, stop))
        value = None if begin <= last else text[begin:stop]
        out.append((name, value, value, (begin, stop)))
    return out


def name_score(name: str) -> float:
    """Weight of the most telling part of a name: ``dbPassword`` and ``db-password`` both hold ``password``."""
    parts = [p for p in re.split(r"[_.\-]+", CAMEL.sub("_", name).lower()) if p]
    forms = {*parts, *map("_".join, zip(parts, parts[1:])), *map("".join, zip(parts, parts[1:]))}
    return max((SENSITIVE.get(f, 0.0) for f in forms), default=0.0)


def literal_score(value: str) -> float:
    """How much a value looks like a secret: its length and the entropy of its characters, 0 for placeholders."""
    low = value.lower()
    if len(value) < 6 or " " in value or low in PLACEHOLDERS or value.startswith(PREFIXES) or len(set(value)) < 4:
        return 0.0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return min(1.0, bits / 3.0) * (1.0 if any(c.isdigit() or not c.isalnum() for c in value) else 0.6)


def tail_scores(text: str, begins: list[int], stop: int) -> dict[tuple[int, int], float]:
    """``literal_score`` of the values that begin at ``begins``, in order, and all end at ``stop``: one pass from the end."""
    out, counts, total, mixed, at = {}, Counter(), 0.0, False, stop
    weigh = lambda n: n * math.log2(n) if n else 0.0
    for begin in reversed(begins):
        for c in reversed(text[begin:at]):
            counts[c] += 1
            total += weigh(counts[c]) - weigh(counts[c] - 1)
            mixed = mixed or c.isdigit() or not c.isalnum()
        at, size = begin, stop - begin
        if size < 6 or text.startswith(PREFIXES, begin) or len(counts) < 4:
            out[begin, stop] = 0.0
        else:
            out[begin, stop] = min(1.0, round(math.log2(size) - total / size, 9) / 3.0) * (1.0 if mixed else 0.6)
    return out


def named_spans(text: str, least: float = 0.6) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or through constants; each literal once."""
    if "=" not in text and ":" not in text:
        return []
    constants: dict[str, tuple[str, tuple[int, int]]] = {}
    found: set[tuple[int, int]] = set()
    pairs = pairs_of(text)
    nested: dict[int, list[int]] = {}
    for name, _, literal, (begin, stop) in pairs:
        if literal is None and name_score(name) > 0:
            nested.setdefault(stop, []).append(begin)
    scores: dict[tuple[int, int], float] = {}
    for stop, begins in nested.items():
        scores |= tail_scores(text, begins, stop)
    for name, reference, literal, span in pairs:
        if literal is None:
            if name_score(name) * scores.get(span, 0.0) >= least:
                found.add(span)
            continue
        value, place = (literal, span) if reference is None else constants.get(reference, (literal, span))
        if name_score(name) * literal_score(value) >= least:
            found.add(place)
        if reference is None or reference in constants:
            constants[name] = (value, place)
    return sorted(found)


def find_secrets(text: str, least: float = 0.6) -> dict[str, list[tuple[int, int]]]:
    return base_spans(text) | {"named": named_spans(text, least)}


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    places = sorted((a, kinds.index(k), k, b) for k in kinds for a, b in spans[k])
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in places)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.6) -> DataFrame:
    """One row per document with the count of each base kind and all spans.

    Whole texts are scanned. A null text is an empty one and has no spans; repeated rows give repeated rows; an empty
    table gives an empty one; a null id stays null; other columns are left out.
    """

    def rows(texts: list[str]) -> list[list]:
        found = [find_secrets(t, least) for t in texts]
        base = [joined(s, BASE) for s in found]
        return [*[[len(s[k]) for s in found] for k in BASE], [hashlib.sha256(b.encode()).hexdigest() for b in base], [joined(s, KINDS) for s in found]]

    schema = ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return each_text(texts_of(docs, id_column, text_column), rows, schema)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
