"""What a Python worker holds while it packs, and what it keeps for other stages."""

from __future__ import annotations

import weakref

import numpy as np
import pyarrow as pa

from kvetch.llm import common, packing, queries

MODEL = queries.tokenizer_path("word_bpe_49k.json")


class Counted:
    """A tokenizer that notes how many words it gets at once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.sizes = tokenizer, []

    def encode_batch(self, words, **options):
        self.sizes.append(len(words))
        return self.tokenizer.encode_batch(words, **options)

    def encode_batch_fast(self, words, **options):
        self.sizes.append(len(words))
        return self.tokenizer.encode_batch_fast(words, **options)


class Given:
    """Stands for a table and holds the function that tasks run."""

    def __init__(self, spark):
        self.spark = spark

    def select(self, *columns):
        return self

    def mapInArrow(self, work, schema):  # noqa: N802
        self.work = work
        return self.spark.createDataFrame([], schema)


def test_a_task_leaves_no_words_behind(spark):
    given = Given(spark)
    packing.pack(given, MODEL)
    packing.encoder(MODEL).clear()
    batch = pa.record_batch({"doc_id": pa.array([1, 2], pa.int64()), "text": ["some words here", None]})
    pieces = given.work(iter([batch, batch]))
    first = next(pieces)
    assert first.column("doc_tokens").to_pylist()[-1] == 1 and len(packing.encoder(MODEL).keys) == 3
    list(pieces)
    assert len(packing.encoder(MODEL).keys) == 0
    # Neither does one whose rows are not read to the end.
    pieces = given.work(iter([batch, batch]))
    next(pieces)
    pieces.close()
    assert len(packing.encoder(MODEL).keys) == 0


def test_new_words_go_to_the_tokenizer_a_few_at_a_time():
    encoder = packing.WordEncoder(MODEL)
    words = [f"w{chr(97 + k % 26)}{'xyz'[k % 3]}{k:x}" for k in range(9_000)]
    want = [[*found.ids, packing.END_ID] for found in encoder.tokenizer.encode_batch(words, add_special_tokens=False)]
    encoder.tokenizer = Counted(encoder.tokenizer)
    ids, starts = encoder.encode(pa.array(words))
    assert [ids[lo:hi].tolist() for lo, hi in zip(starts, starts[1:], strict=False)] == want
    assert sum(encoder.tokenizer.sizes) == 9_000 and max(encoder.tokenizer.sizes) <= 2_000


def test_memory_is_given_back_when_a_groups_arrays_are_gone(monkeypatch):
    held, seen = [], []

    def work(table):
        values = np.arange(1000)
        held.append(weakref.ref(values))
        return table

    monkeypatch.setattr(common, "release", lambda: seen.append(held[0]() is None))
    assert common.trimmed(work, 5) == 5 and seen == [True]
