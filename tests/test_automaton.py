"""The automaton against plain walks, and what is cut by it."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kvetch.operators import segment
from kvetch.operators.automaton import Automaton, Texts, cut_cheapest, cut_longest, marked, rewrite_longest, steps

LETTERS = "abc日𠀀é"


def some_words(rng, n, longest=6):
    return sorted({"".join(rng.choices(LETTERS, k=rng.randint(1, longest))) for _ in range(n)})


def some_texts(rng, n):
    return ["".join(rng.choices(LETTERS + " x", k=rng.choice([0, 1, 3, 20, 200]))) for _ in range(n)] + [None, ""]


@pytest.mark.parametrize("seed", range(6))
def test_all_words_at_all_places(seed):
    rng = random.Random(seed)
    words, texts = some_words(rng, [1, 5, 40, 300, 2000, 30][seed]), some_texts(rng, 30)
    held = Texts(pa.array(texts))
    found = {(int(p), size, words[w]) for at, size, ws in Automaton.of(words).hits(held.chars, held.ends) for p, w in zip(at, ws, strict=True)}
    want = set()
    for text, start in zip(texts, held.bounds.tolist(), strict=False):
        for p in range(len(text or "")):
            want |= {(start + p, len(w), w) for w in words if text.startswith(w, p)}
    assert found == want


@pytest.mark.parametrize("seed", range(4))
def test_longest_match(seed):
    rng = random.Random(seed)
    words, texts = some_words(rng, 60), some_texts(rng, 200)
    pattern = re.compile("|".join(sorted(words, key=len, reverse=True)) + "|.", re.DOTALL)
    cut = cut_longest(Automaton.of(words), pa.array(texts))
    assert cut.to_pylist() == [pattern.findall(text or "") for text in texts]
    # A slice of a larger array, and texts in several steps.
    sliced = pa.array(["skip", *texts]).slice(1)
    parts = [cut_longest(Automaton.of(words), part) for part in steps(sliced, 50)]
    assert len(parts) > 5 and pa.concat_arrays(parts).to_pylist() == cut.to_pylist()


def cheapest(text, costs, other):
    best, back = [0], [0]
    for end in range(1, len(text) + 1):
        ways = [(best[s] + costs.get(text[s:end], other), s) for s in range(end) if end - s == 1 or text[s:end] in costs]
        cost, start = min(ways)
        best.append(cost)
        back.append(start)
    out, at = [], len(text)
    while at:
        out.append(text[back[at] : at])
        at = back[at]
    return out[::-1]


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_way(seed):
    rng = random.Random(seed)
    words, texts = some_words(rng, 80), some_texts(rng, 200)
    # Few different costs make ties.
    costs = {w: rng.choice([1, 2, 3] if seed % 2 else range(1, 10_000)) for w in words}
    cut = cut_cheapest(Automaton.of(words), pa.array(texts), np.array([costs[w] for w in words]), 4)
    assert cut.to_pylist() == [cheapest(text or "", costs, 4) for text in texts]


def test_outputs_of_any_length():
    words, outputs = ["a", "ab", "bc", "日本"], ["1", "", "two", "ニホン"]
    texts = ["abc", "bcab日本x", "", None, "日a本"]
    got = rewrite_longest(Automaton.of(words), pa.array(texts), pa.array(outputs)).to_pylist()
    assert got == ["c", "twoニホンx", "", None, "日1本"]


def test_marks_follow_jumps():
    rng = np.random.default_rng(2)
    jumps = np.minimum(np.arange(1000) + rng.integers(1, 9, 1000), 999)
    want, at = np.zeros(1000, bool), 3
    while not want[at]:
        want[at] = True
        at = jumps[at]
    assert np.array_equal(marked(np.array([3]), jumps), want)


def test_a_text_of_a_million_characters():
    automaton = Automaton.of(["ab", "abc", "cab"])
    text = "abcab" * 200_000
    assert cut_longest(automaton, pa.array([text]))[0].as_py() == ["abc", "ab"] * 200_000
    # One run that no place cuts: every step is a place of it.
    chain = Automaton.of(["aa", "a"])
    assert len(cut_cheapest(chain, pa.array(["a" * 30_000]), np.array([3, 2]), 9)[0].as_py()) == 15_000


def test_user_words_change_the_cut(spark):
    """Frequent words win over the longest match; a user's word wins over both."""
    lexicon = spark.createDataFrame(
        [("研究", 300), ("研究生", 20), ("生命", 400), ("命", 5), ("起源", 100), ("的", 900), ("的", 100), ("起", None)], "word string, frequency long"
    )
    texts = spark.createDataFrame([(1, "研究生命的起源"), (2, None), (3, ""), (4, "x研究生")], "id int, text string")

    def cut(words):
        return {r["id"]: r["tokens"] for r in segment.segment_by_frequency(texts, "text", words).collect()}

    longest = {r["id"]: r["tokens"] for r in segment.segment(texts, "text", lexicon).collect()}
    assert longest[1] == ["研究生", "命", "的", "起源"]
    assert cut(lexicon) == {1: ["研究", "生命", "的", "起源"], 2: [], 3: [], 4: ["x", "研究生"]}
    users = spark.createDataFrame([("生命的起源",), ("研究",), (None,)], "word string")
    both = segment.with_user_frequencies(lexicon, users)
    assert {r["word"]: r["frequency"] for r in both.collect() if r["word"] in ("研究", "生命的起源")} == {"研究": 1024, "生命的起源": 1024}
    assert cut(both)[1] == ["研究", "生命的起源"]


def test_no_words(spark):
    texts = spark.createDataFrame([("ab",), (None,)], "text string")
    none = spark.createDataFrame([], "word string, frequency long")
    assert sorted(r["tokens"] for r in segment.segment_by_frequency(texts, "text", none).collect()) == [[], ["a", "b"]]
