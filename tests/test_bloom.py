"""The Bloom filter, and matches that go through it."""

import re

import pytest
from pyspark.sql import functions as F

from kvetch.operators import bloom, lookup

TOKENS = [(1, ["a", "x", None, "a", "b"]), (2, None), (3, []), (4, ["zz"]), (5, ["a", "x", None, "a", "b"])]


def test_no_word_is_held_back_and_few_others_pass(spark):
    words = spark.range(5000).select(F.concat(F.lit("word"), F.col("id")).alias("word"))
    may_be = bloom.word_filter(words.union(spark.createDataFrame([(None,)], "word string")))
    own = words.groupBy().agg(F.collect_list("word").alias("tokens")).select(may_be(F.col("tokens"))).first()[0]
    assert len(own) == 5000 and all(own)
    other = spark.range(20_000).groupBy().agg(F.collect_list(F.concat(F.lit("other"), F.col("id"))).alias("tokens"))
    assert sum(other.select(may_be(F.col("tokens"))).first()[0]) < 200


@pytest.mark.parametrize("bits", [bloom.MAX_BITS, 1 << 15])
def test_rare_matches_are_all_matches(spark, monkeypatch, bits):
    """Also where the filter is so full that it lets everything through."""
    monkeypatch.setattr(bloom, "MAX_BITS", bits)
    texts = spark.createDataFrame(TOKENS, "id int, tokens array<string>")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)] + [(f"w{k}", k) for k in range(50_000)], "word string, n int")
    plain = lookup.with_matches(texts, "tokens", table, "found").collect()
    rare = lookup.with_rare_matches(texts, "tokens", table, "found").collect()
    assert sorted(map(str, rare)) == sorted(map(str, plain))
    assert [len(r["found"]) for r in sorted(rare, key=lambda r: r["id"])] == [3, 0, 0, 0, 3]


def test_only_passing_tokens_are_exchanged(spark, monkeypatch):
    monkeypatch.setattr(lookup, "fits", lambda *_: False)
    texts = spark.createDataFrame(TOKENS, "id int, tokens array<string>")
    found = lookup.with_rare_matches(texts, "tokens", spark.createDataFrame([("a",)], "word string"), "found")
    text = found._jdf.queryExecution().executedPlan().toString()
    # Distinct texts are exchanged as their passing tokens; the token arrays themselves only with their own rows.
    first = re.search(r"partial_first\((\w+)#", text)
    assert first and first.group(1) == "_held"
