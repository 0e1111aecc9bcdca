"""Small documents with every odd case, and brute-force answers."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, spans int, part string, start string, content string, component string, label string, stratum string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed: int = 1) -> dict[int, str | None]:
    """Distinct ids: prose, copies, near copies, shared passages, empty, null, blank, very long and periodic texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnoprstuvé") for _ in range(r.randint(2, 9))) for _ in range(600)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, out = prose(60), {}
    for i in range(40):
        out[i] = prose(r.randint(5, 160)) + ".\n" + prose(30)
    for i in range(40, 52):
        out[i] = prose(20) + " " + passage + "\n" + prose(r.randint(1, 30))
    for i in range(52, 60):
        words = out[i - 50].split(" ")
        if words:
            words[len(words) // 2] = "changed"
        out[i] = " ".join(words)
    for i in range(60, 66):
        out[i] = out[7]
    out |= {66: "", 67: None, 68: " \t\n ", 69: "one", 70: "One", 71: "one two three", 72: "a " * 400, 73: "x" * 3000, 74: prose(20_000), 75: "漢字 " * 100, 76: "A\x0bB\x0cC\x1cD E", 77: passage, 78: passage.upper(), 79: out[3] + "\n" + out[3]}
    return out


def frame(spark, docs: dict[int, str | None] | list[tuple], extra: list[tuple] = ()):
    """A documents table with columns whose names clash with those that operators use."""
    rows = list(docs.items()) if isinstance(docs, dict) else list(docs)
    full = [(k, t, ("en", "de", None)[i % 3], f"src{i % 2}", len(t) if t is not None else None, 1, "k", 2, "p", "s", "c", "x", "l", "q") for i, (k, t) in enumerate([*rows, *extra])]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def shingles(text: str | None, size: int) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def near_components(docs: dict[int, str | None], size: int, percent: int = 80) -> dict[int, int]:
    sets = {k: shingles(t, size) for k, t in docs.items()}
    parent = {k: k for k in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in docs}


def kept_by_windows(docs: dict[int, list], window: int) -> dict[int, list[bool]]:
    """Which items of each sequence are kept."""
    first: dict[tuple, int] = {}
    for k in sorted(docs):
        for i in range(len(docs[k]) - window + 1):
            first.setdefault(tuple(docs[k][i : i + window]), k)
    out = {}
    for k, items in docs.items():
        keep = [True] * len(items)
        for i in range(len(items) - window + 1):
            if first[tuple(items[i : i + window])] < k:
                keep[i : i + window] = [False] * window
        out[k] = keep
    return out


def digest(data: bytes | str) -> str:
    return sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeated_words(words: list[str]) -> int:
    triples = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(triples)
    return len({i + j for i, t in enumerate(triples) if counts[t] > 1 for j in range(3)})
