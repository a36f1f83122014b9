"""Small tables with the odd cases that every operator has to stand, and plain Python versions of the definitions."""

from __future__ import annotations

import random
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = "the of an re ti on er in at en ous ing ed ly ha é ü ñ".split()


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


def corpus(n: int = 60, seed: int = 1) -> list[tuple[int, str]]:
    """Texts with copies, near copies, shared passages and very different lengths."""
    rng = random.Random(seed)
    passage = sentence(rng, 30)
    out: list[str] = []
    for k in range(n):
        kind = k % 6
        if kind == 1 and out:
            out.append(rng.choice(out))
        elif kind == 2 and out:
            words = rng.choice(out).split(" ")
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = sentence(rng, 1)
            out.append(" ".join(words))
        elif kind == 3:
            out.append(f"{sentence(rng, 20)}\n{passage}\n{sentence(rng, 20)}")
        else:
            out.append(sentence(rng, rng.choice([2, 5, 40, 120, 300])))
    ids = list(range(n))
    rng.shuffle(ids)
    return list(zip(ids, out, strict=True))


ODD = [
    (1001, None), (1002, ""), (1003, " \n\t "), (None, "a text without an id that is long enough to hold a window of fifty bytes"),
    (1004, "same id, first text, with enough words to make a few shingles of four or five"),
    (1004, "same id, other text, with quite different words so that no shingle is shared at all"),
    (1005, "twice the same row and quite long so that it has windows of fifty bytes in it"),
    (1005, "twice the same row and quite long so that it has windows of fifty bytes in it"),
    (1006, "one"), (1007, "one two three"), (1008, "x" * 3000), (1009, "日本語のテキスト \U0001f600 é́"),
]
CLASHING = "score double, block int, row string, next string, digest string, kept string, a long, node long, ids string, Label string"


def table(spark, rows):
    """``doc_id`` and ``text`` with extra columns that operators use as names themselves."""
    extra = (0.5, 1, "r", "n", "d", "k", 7, 8, "i", "l")
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], f"doc_id long, text string, {CLASHING}")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def components(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingles(text: str | None, size: int) -> frozenset:
    found = words(text)
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[k : k + size]) for k in range(len(found) - size + 1))


def near_duplicates(rows, size=4, percent=80):
    sets = [(i, shingles(t, size)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    links = [
        (i, j) for k, (i, s) in enumerate(known) for j, t in known[:k] if 100 * len(s & t) >= percent * len(s | t)
    ]
    root = components({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), root.get(i), i is None or root[i] == i) for i, s in sets), key=repr)


def repeats(rows, window=50):
    """``doc_id``, bytes, removed bytes and kept bytes of each row, in the order of ids."""
    first = defaultdict(lambda: 1 << 62)
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        if i is not None:
            for k in range(len(b) - window + 1):
                first[b[k : k + window]] = min(first[b[k : k + window]], i)
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - window + 1 if i is not None else 0):
            if first[b[k : k + window]] < i:
                gone[k : k + window] = [True] * window
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out
