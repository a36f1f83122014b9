"""Natures in context, against all ways through short sentences."""

import math
import random
from collections import Counter

import pytest

from kvetch.operators import tagger

WORDS = {"book": "nv", "the": "d", "a": "d", "flight": "n", "light": "nva", "run": "nv", "red": "a", "fast": "ad", "you": "r"}


def sentences(rng, n, longest=9):
    return [[(w, rng.choice(WORDS[w])) for w in rng.choices(list(WORDS), k=rng.randint(1, longest))] for _ in range(n)]


def tagged_table(spark, found):
    rows = [(s, p, w, t) for s, sentence in enumerate(found) for p, (w, t) in enumerate(sentence)]
    return spark.createDataFrame(rows, "s int, pos int, word string, nature string")


def best_ways(found, texts):
    """Plain Viterbi, place by place."""
    natures = sorted({t for s in found for _, t in s} | {"x"})
    pairs, words = Counter(), Counter(x for s in found for x in s)
    for s in found:
        pairs.update(zip(["", *[t for _, t in s]], [t for _, t in s]))
    total = Counter()
    for (a, _), k in pairs.items():
        total[a] += k
    of = Counter(t for s in found for _, t in s)

    def follow(a, b):
        return round(math.log((total[a] + len(natures)) / (pairs[a, b] + 1)) * 1e6)

    out = []
    for text in texts:
        states = {"": (0, [])}
        for w in text or []:
            own = {t: round(math.log(of[t] / words[w, t]) * 1e6) for t in natures if words[w, t]} or {"x": 0}
            states = {
                t: min(((c + follow(a, t) + own[t], a, path + [t]) for a, (c, path) in states.items()), key=lambda x: x[:2]) for t in own
            }
            states = {t: (c, path) for t, (c, _, path) in states.items()}
        out.append(min(((c, t, path) for t, (c, path) in states.items()), key=lambda x: x[:2])[2])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_ways_equal_plain_viterbi(spark, seed):
    rng = random.Random(seed)
    found = sentences(rng, [3, 30, 200, 60][seed])
    texts = [rng.choices([*WORDS, "unseen", None], k=rng.choice([0, 1, 2, 5, 40])) for _ in range(60)] + [None]
    model = tagger.train_tagger(tagged_table(spark, found), "s")
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, tokens array<string>")
    got = {r["id"]: r["natures"] for r in tagger.with_natures(rows, "tokens", model).collect()}
    assert got == dict(enumerate(best_ways(found, texts)))


def test_neighbours_decide(spark):
    """A word with two natures gets the one that its neighbours ask for."""
    found = [[("the", "d"), ("book", "n")]] * 5 + [[("you", "r"), ("book", "v"), ("a", "d"), ("flight", "n")]] * 4
    model = tagger.train_tagger(tagged_table(spark, found), "s")
    rows = spark.createDataFrame([(1, "the book".split()), (2, "you book the flight".split()), (3, None)], "id int, tokens array<string>")
    tags = tagger.tag_in_context(rows, "tokens", model).collect()
    assert sorted(map(tuple, tags)) == [
        (1, 0, "the", "d"), (1, 1, "book", "n"), (2, 0, "you", "r"), (2, 1, "book", "v"), (2, 2, "the", "d"), (2, 3, "flight", "n"),
    ]


def test_long_sentence_and_empty_tables(spark):
    model = tagger.train_tagger(tagged_table(spark, [[("book", "n"), ("book", "v")]]), "s")
    rows = spark.createDataFrame([(["book"] * 20_000,)], "tokens array<string>")
    assert len(tagger.with_natures(rows, "tokens", model).first()["natures"]) == 20_000
    empty = tagger.train_tagger(tagged_table(spark, []), "s")
    assert tagger.with_natures(rows.limit(1), "tokens", empty).first()["natures"] == ["x"] * 20_000


def test_a_tagged_table_is_computed_once(spark):
    """Pairs, words and the words' table come from one pass over the tokens."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(s, k, word, nature) for s in range(5) for k, (word, nature) in enumerate([("a", "n"), ("b", "v"), ("b", "n"), (None, "n"), ("c", None)])]
    table = spark.createDataFrame(rows, "s int, pos int, word string, nature string")
    found = tagger.train_tagger(table.mapInArrow(seen, table.schema), "s")
    held = {(r["word"], r["nature"]): r["cost"] for r in found.words.collect()}
    assert read.value == len(rows) and set(held) == {("a", "n"), ("b", "v"), ("b", "n")}
    assert held["b", "v"] == 0 and found.natures == ["n", "v", "x"]
