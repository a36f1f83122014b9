"""Parts of batches, indices without strings, files and counts of bounded size."""

import glob

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kvetch.operators import features, lookup
from kvetch.sources import sinks


@pytest.mark.parametrize("tokens", [1, 2, 1000])
def test_finder_looks_up_a_part_at_a_time(monkeypatch, tokens):
    monkeypatch.setattr(lookup, "_TOKENS", tokens)
    words = pa.array(["b", "", "ä", "a"])
    texts = pa.array([["a", "b", None], None, [], ["ä", "zz", "a", ""]])
    assert [part.to_pylist() for part in lookup.token_parts(texts)][:1] == ([texts.to_pylist()] if tokens == 1000 else [[["a", "b", None]]] if tokens == 1 else [[["a", "b", None]]])
    assert sum((part.to_pylist() for part in lookup.token_parts(texts)), []) == texts.to_pylist()
    assert lookup.finder(words)(texts.flatten()).tolist() == [3, 0, -1, 2, -1, 3, 1]
    assert lookup.finder(pa.array([], pa.string()))(texts.flatten()).tolist() == [-1] * 7


def test_finder_tells_words_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(lookup, "_hashes", lambda words: np.zeros(len(words), np.uint64))
    assert lookup.finder(pa.array(["x", "y", "z"]))(pa.array(["z", "y", "q", "x", None])).tolist() == [2, 1, -1, 0, -1]


def test_files_of_bounded_size(spark, table_name, tmp_path, monkeypatch):
    frame = spark.range(1000).select("id", F.repeat(F.lit("x"), 92).alias("text"))
    monkeypatch.setattr(sinks, "MAX_FILE_BYTES", 10_000)
    sinks.save_by_date(frame, table_name, 1, location=str(tmp_path / "t"), files=2)
    assert len(glob.glob(f"{tmp_path}/t/_versions/*/*.parquet")) == 10
    assert spark.table(table_name).count() == 1000


def test_counts_are_spread_by_the_number_of_tokens(spark, monkeypatch):
    monkeypatch.setattr(features, "_TOKENS_PER_TASK", 2)
    rows = [(k % 20, [f"w{k % 3}", "a", "a", None]) for k in range(40)] + [(None, ["a"]), (None, ["a"]), (7, None)]
    frame = spark.createDataFrame(rows, "id int, tokens array<string>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = features.count_features(frame)
        assert found.rdd.getNumPartitions() > 50
        counts = {(r["id"], r["word"]): r["value"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert counts[None, "a"] == 2 and counts[3, "a"] == 4 and sum(counts.values()) == 122
