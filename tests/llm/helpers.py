"""Tables and brute-force versions for the tests of the training-text operators."""

import hashlib
import random
import re

COLUMNS = "doc_id long, text string, TEXT string, lang string, lang string, n int, digest string, features string, n_lines int"


def table(spark, texts):
    """Documents with extra columns whose names clash with each other and with those that operators add."""
    rows = [(d, t, "other", "en", "de", 1, "x", "y", 7) for d, t in texts]
    return spark.createDataFrame(rows, COLUMNS)


def odd_texts():
    long = " ".join(f"w{i % 5000} the house{i}" for i in range(30_000))
    return [(0, None), (1, ""), (2, "a"), (3, long), (4, long), (4, long), (None, "text without an id " * 5), (5, " \n\t\n "), (6, "é" * 70), (7, "é" * 70 + "b")]


def prose(seed, documents=60, words=120):
    """Texts with exact copies, near copies, shared passages and shared lines."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "der", "une"] + ["".join(rng.choices("abcdefghiéß", k=rng.randint(2, 9))) for _ in range(300)]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, lines = sentence(25), [sentence(6) for _ in range(6)]
    out = []
    for i in range(documents):
        kind = i % 6
        if kind == 1 and out:
            text = rng.choice(out)
        elif kind == 2 and out:
            parts = rng.choice(out).split(" ")
            for _ in range(max(1, len(parts) // rng.choice((20, 60, 100)))):
                parts[rng.randrange(len(parts))] = rng.choice(vocabulary)
            text = " ".join(parts)
        else:
            text = "\n".join(sentence(rng.randint(1, words // 8)) for _ in range(rng.randint(1, 12)))
            if kind == 3:
                text = text[: len(text) // 2] + " " + passage + " " + text[len(text) // 2 :]
            if kind == 4:
                text = text + "\n" + "\n".join(lines) + "\n" + sentence(9)
        out.append(text)
    ids = rng.sample(range(1000), documents)
    return list(zip(ids, out))


def covered_bytes(texts, length=50):
    """(n_bytes, n_removed, n_spans, sha256) by document, by comparing every string with all smaller documents."""
    seen, out = set(), {}
    for doc, text in sorted(texts):
        data = (text or "").encode()
        strings = [data[i : i + length] for i in range(len(data) - length + 1)]
        gone = bytearray(len(data))
        for i, s in enumerate(strings):
            if s in seen:
                gone[i : i + length] = b"\1" * length
        seen.update(strings)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(parts) < words:
        return {tuple(parts)} if parts else set()
    return set(zip(*[parts[k:] for k in range(words)]))


def near_components(texts, words, percent=80):
    """Smallest document reachable over links of at least so much Jaccard."""
    sets = {d: shingles(t, words) for d, t in texts}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}
