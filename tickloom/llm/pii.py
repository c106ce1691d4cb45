"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the places where something can be: at-signs, plus signs, URL schemes and the names of
identifiers. A deterministic parser for each kind grows the place to its boundaries and validates it. Numbers have no
literal anchor, so the first digit of a digit run is theirs.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import each_text, texts_of, with_new_text

# The kinds in the order of the result, the base ones first.
BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "ssn")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("iban", "ssn", "social security")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always begins at the start of a digit run, so the look-behind only saves retries inside long runs.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USERINFO = re.compile(r"([^\s/@:\"'<>]+):([^\s/@\"'<>]+)@[A-Za-z0-9.-]+")
IBAN = re.compile(r"[\s:#=]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
SSN = re.compile(r"[\s:#=]{0,4}(?:number|no\.?)?[\s:#=]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")


@lru_cache(1)
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in ("@", "+", *SCHEMES):
        found.add_word(word, (word, len(word)))
    for word in CUES:
        for form in {word, word.upper(), word.title()}:
            found.add_word(form, (word, len(form)))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def is_iban(value: str) -> bool:
    plain = value.replace(" ", "")
    turned = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def small_part(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def find_personal(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in code points, in order, not overlapping within a kind."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE + ADDED}
    taken = dict.fromkeys(BASE, 0)
    for last, (word, length) in anchors().iter(text):
        at = last - length + 1
        if word == "@":
            domain = DOMAIN.match(text, at + 1)
            start = at
            while domain and start > taken["email"] and text[start - 1] in LOCAL:
                start -= 1
            if domain and start < at:
                spans["email"].append((start, domain.end()))
                taken["email"] = domain.end()
        elif word == "+":
            if at >= taken["phone"] and (found := PHONE.match(text, at)):
                taken["phone"] = found.end()  # a match that fails the count is used up as well
                if 8 <= sum(c.isdigit() for c in found[0]) <= 15:
                    spans["phone"].append(found.span())
        elif word in SCHEMES:
            if found := USERINFO.match(text, last + 1):
                spans["url"].append((at, found.end()))
        elif word == "iban":
            if (found := IBAN.match(text, last + 1)) and is_iban(found[1]):
                spans["iban"].append(found.span(1))
        elif found := SSN.match(text, last + 1):
            spans["ssn"].append(found.span(1))
    for found in ADDRESS.finditer(text):
        if all(map(small_part, found[0].split("."))):
            spans["ip"].append(found.span())
    for found in NUMBER.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            spans["card"].append(found.span())
    return spans


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def personal_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document with the count of each base kind and all spans.

    Whole texts are scanned. A null text is an empty one and has no spans; repeated rows give repeated rows; an empty
    table gives an empty one; a null id stays null; other columns are left out.
    """

    def rows(texts: list[str]) -> list[list]:
        found = [find_personal(t) for t in texts]
        base = [joined(s, BASE) for s in found]
        return [*[[len(s[k]) for s in found] for k in BASE], [hashlib.sha256(b.encode()).hexdigest() for b in base], [joined(s, BASE + ADDED) for s in found]]

    schema = ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return each_text(texts_of(docs, id_column, text_column), rows, schema)


def mask_text(text: str) -> str:
    """``text`` with each personal span replaced by its kind; of overlapping spans the first one names the whole."""
    spans = sorted((a, b, k) for k, own in find_personal(text).items() for a, b in own)
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:] if out else text


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mask_documents(docs: DataFrame) -> DataFrame:
    """Documents with the personal data of ``text`` masked and ``n_chars`` counted anew; all rows and columns stay."""
    return with_new_text(docs, mask_text)

