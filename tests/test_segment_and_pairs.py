import re

import pytest
from fixtures import COMMENTS, WORDS

from kvetch.operators import lexicon, pairs, segment


@pytest.mark.parametrize("in_tasks", [True, False])
def test_chinese(spark, in_tasks):
    texts = spark.createDataFrame([(i, text) for i, text, *_ in COMMENTS], "id int, text string")
    words = spark.createDataFrame([(word,) for word in WORDS], "word string")
    found = segment.segment(texts, "text", words, in_tasks=in_tasks).collect()
    assert {row["id"]: " ".join(row["tokens"]) for row in found} == {i: tokens for i, _, tokens, *_ in COMMENTS}


@pytest.mark.parametrize("in_tasks", [True, False])
def test_overlaps_blanks_and_long_texts(spark, in_tasks):
    words = ["ab", "abc", "bcd", "cde", "d", "𠀀b", "eab"]
    texts = ["", "x", "abcd", "abde", "abcabcdeab", "𠀀bc\nab", "zzab", "ab", "abcd" * 100 + "e" + "xab" * 50, "abx" * 40, "ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(word,) for word in words], "word string")
    found = segment.segment(rows, "text", table, in_tasks=in_tasks).collect()
    pattern = re.compile("|".join(sorted(words, key=len, reverse=True)) + "|.", re.DOTALL)
    assert {row["id"]: row["tokens"] for row in found} == {i: pattern.findall(text) for i, text in enumerate(texts)}


def test_empty_lexicon(spark):
    rows = spark.createDataFrame([("ab",)], "text string")
    none = spark.createDataFrame([], "word string")
    for in_tasks in (True, False):
        assert segment.segment(rows, "text", none, in_tasks=in_tasks).first()["tokens"] == ["a", "b"]


def test_user_words_win(spark):
    base = spark.createDataFrame([("a", "n"), ("b", "v"), ("b", "a")], "word string, nature string")
    user = spark.createDataFrame([("a", "x"), ("c", "mzm")], "word string, nature string")
    found = lexicon.with_user_words(base, user).collect()
    assert sorted(map(tuple, found)) == [("a", "x"), ("b", "a"), ("c", "mzm")]


LEXICON = [
    ("thing", "n"), ("name", "nz"), ("good", "a"), ("is", "vshi"), ("was", "v"), ("and", "w"), ("with", "mzm"), ("from", "mzd"),
]
TEXTS = ["thing good good thing name", "thing was is", "and with from good", "good", "", "thing was is", "unknown thing"]


def test_tags(spark):
    texts = spark.createDataFrame([(1, ["thing", "what", "was"])], "id int, tokens array<string>")
    tagged = lexicon.tag_tokens(texts, "tokens", spark.createDataFrame(LEXICON, "word string, nature string"))
    assert sorted(map(tuple, tagged.collect())) == [(1, 0, "thing", "n"), (1, 1, "what", "x"), (1, 2, "was", "v")]


@pytest.mark.parametrize("in_tasks", [True, False])
def test_pairs(spark, in_tasks):
    natures = dict(LEXICON)
    expected = {}
    for text in TEXTS:
        words = [(word, natures.get(word, "x")) for word in text.split()]
        for noun, n in words:
            for predicate, p in words:
                if n.startswith("n") and (p.startswith("a") or (p.startswith("v") and p != "vshi")):
                    key = (f"{noun}-{predicate}", f"{n}-{p}")
                    expected[key] = expected.get(key, 0) + 1
    texts = spark.createDataFrame([(text.split(),) for text in TEXTS], "tokens array<string>")
    table = spark.createDataFrame(LEXICON, "word string, nature string")
    found = pairs.noun_predicate_pairs(texts, table, in_tasks=in_tasks)
    assert {(row["words"], row["nature"]): row["cnt"] for row in found.collect()} == expected
    assert found.schema.simpleString() == "struct<words:string,nature:string,cnt:bigint>"


@pytest.mark.parametrize("in_tasks", [True, False])
def test_no_paired_words(spark, in_tasks):
    texts = spark.createDataFrame([(["a"],)], "tokens array<string>")
    table = spark.createDataFrame([("a", "w")], "word string, nature string")
    assert pairs.noun_predicate_pairs(texts, table, in_tasks=in_tasks).count() == 0


def test_a_text_of_many_pairs(spark, monkeypatch):
    """50,000 nouns and 50,000 predicates in one text, and sums that are sent on early."""
    table = spark.createDataFrame([(f"n{k}", "n") for k in range(700)] + [(f"v{k}", "v") for k in range(500)], "word string, nature string")
    long = [f"n{k % 700}" for k in range(50_000)] + [f"v{k % 500}" for k in range(50_000)]
    texts = spark.createDataFrame([(long,), (["n1", "v1"],), (None,)], "tokens array<string>")
    found = {r["words"]: r["cnt"] for r in pairs.noun_predicate_pairs(texts, table).collect()}
    assert len(found) == 350_000 and sum(found.values()) == 50_000 * 50_000 + 1
    assert found["n1-v1"] == sum(w == "n1" for w in long) * 100 + 1


@pytest.mark.parametrize("cell", [1, 2, 1000])
def test_grids_of_any_size(spark, monkeypatch, cell):
    monkeypatch.setattr(pairs, "_CELL", cell)
    monkeypatch.setattr(pairs, "_PRODUCTS", 3)
    texts = spark.createDataFrame([(text.split(),) for text in TEXTS] + [("thing name good was thing good".split(),)], "tokens array<string>")
    table = spark.createDataFrame(LEXICON, "word string, nature string")
    small, large = (sorted(map(str, pairs.noun_predicate_pairs(texts, table, in_tasks=x).collect())) for x in (True, False))
    assert small == large


def test_products_and_merges():
    import numpy as np

    rng = np.random.default_rng(4)
    sums, want = pairs._PairSums(20), np.zeros((20, 20), np.int64)
    noun = np.arange(20) < 12
    for _ in range(5):
        counts = rng.integers(0, 3, (7, 20))
        owner, place = np.nonzero(counts)
        assert not list(sums.add(owner, place, counts[owner, place], noun[place], 7))
        want += (counts * noun).T @ (counts * ~noun)
    got = sums.taken().to_pydict()
    assert {(a, b): c for a, b, c in zip(got["noun"], got["predicate"], got["cnt"])} == {(a, b): want[a, b] for a, b in zip(*np.nonzero(want))}
    assert sums.taken().num_rows == 0
