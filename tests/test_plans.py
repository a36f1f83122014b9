"""What the physical plans must and must not hold."""

import re

import pytest

from kvetch.operators import lookup
from kvetch.session import scratch_folder
from kvetch.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("comments") / "t")
    from registry import inputs

    inputs.comments(spark, sf_dir).write.partitionBy("dt").parquet(folder)
    return spark.read.parquet(folder)


def test_a_day_reads_its_partition_and_filters_in_the_scan(stored):
    text = plan(tables.scan_comments(stored, 20240101))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ = 20240101", text)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(nature,1\)", text)


def test_history_scan_reads_two_columns(stored):
    assert "ReadSchema: struct<content:string,nature:int>" in plan(tables.scan_all_comments(stored))


def test_classifying_comments_shuffles_nothing(spark, sf_dir, stored):
    from kvetch.plans import jobs
    from registry import inputs

    model = jobs.train_for_comments(inputs.document_lines(spark, sf_dir), inputs.dictionary(spark), 2)
    df = jobs.classify_comments(tables.scan_comments(stored, 20240101), inputs.dictionary(spark), model)
    text = plan(df)
    assert "Exchange" not in text
    assert text.count("regexp_extract_all") == 1


def test_pairs_shuffle_sums_only(spark, stored):
    from kvetch.functions.text import tokenize
    from kvetch.operators.pairs import noun_predicate_pairs
    from registry import inputs

    texts = tables.scan_all_comments(stored).select(tokenize(stored["content"]).alias("tokens"))
    text = plan(noun_predicate_pairs(texts, inputs.lexicon(spark)))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    # The texts are looked at once, and no row of a pair and a text is made.
    assert text.count("MapInArrow") == 1 and "ArrowEvalPython" not in text and "Generate" not in text


def test_limits(spark):
    table = spark.createDataFrame([("ab",), ("cd",)], "word string")
    assert lookup.fits(table, 2, 4)
    assert not lookup.fits(table, 1, 4)
    assert not lookup.fits(table, 2, 3)
    assert lookup.fits(table.where("false"), 0, 0)
    assert lookup.small_table(table, 1) is None


def test_scratch_folder_follows_the_session(spark):
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first.startswith(root.rstrip("/") + "/x-")
    assert first != second


def test_tables_too_large_to_broadcast(spark, monkeypatch):
    from kvetch.operators import lexicon, pairs, segment

    texts = spark.createDataFrame([(i, ["a", "b", "a", "c"]) for i in range(20)], "id int, tokens array<string>")
    table = spark.createDataFrame([("a", "n"), ("b", "v")], "word string, nature string")
    monkeypatch.setattr(lookup, "fits", lambda *_: False)
    tagged = lexicon.tag_tokens(texts, "tokens", table).groupBy("nature").count().collect()
    assert {row["nature"]: row["count"] for row in tagged} == {"n": 40, "v": 20, "x": 20}
    counted = pairs.noun_predicate_pairs(texts, table, in_tasks=False).collect()
    assert [tuple(row) for row in counted] == [("a-b", "n-v", 40)]
    solid = spark.createDataFrame([(i, "abac") for i in range(20)], "id int, text string")
    words = spark.createDataFrame([("ab",), ("ac",)], "word string")
    cut = segment.segment(solid, "text", words, in_tasks=False).collect()
    assert [row["tokens"] for row in cut] == [["ab", "ac"]] * 20


def test_a_training_pass_moves_no_tokens(spark, tmp_path):
    """Tokens join weights and texts in their own buckets; what is exchanged are sums per text and per word."""
    from kvetch.operators import training

    texts = spark.createDataFrame([(label, [f"w{k % 7}", f"v{k}", "all"]) for k in range(60) for label in "ab"], "label string, tokens array<string>")
    steps = training.training_passes(texts, in_tasks=False)
    model = next(steps)
    layout = training._Layout.written(texts, model.classes, str(tmp_path))
    assert {r["word"] for r in layout.hot.collect()} >= {"", "wall"}
    rows = training.wide(training._marked(model.terms), model.classes)
    weights = training._bucketed(layout.weights(rows), f"{tmp_path}/weights", "word", "salt")
    # A hot word's tokens lie in several buckets, each beside its weights.
    assert spark.table(layout.by_word).where("word = 'wall'").select("salt").distinct().count() > 1
    text = plan(layout.added(spark.table(weights), model))
    training._dropped(spark, layout.by_word, layout.by_text, weights)
    steps.close()
    exchanges = [re.sub(r"#\d+L?", "", found) for found in re.findall(r"Exchange (\w+\(.*?\)), ENSURE", text)]
    assert sorted(exchanges) == ["hashpartitioning(text, 8)", "hashpartitioning(word, 8)"]
    assert text.count("Bucketed: true") == 3
    # Each exchange is fed by a sum formed before it.
    assert text.count("partial_sum") >= 2 and len(re.findall(r"Exchange .*\n\W*HashAggregate", text)) == 2
