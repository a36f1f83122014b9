"""Both sides of every size switch on NULLs, repeated words and repeated texts, and inputs that reach their branch."""

import pytest
from pyspark.sql import functions as F

from kvetch.operators import features, keywords, lexicon, lookup, model, pairs, segment, training
from kvetch.sources import files, sinks, tables
from registry import inputs, queries

TOKENS = [(1, ["x", "y", "x"]), (2, None), (3, []), (4, ["z", None, "y"]), (5, ["x", "y", "x"])]
NATURES = [("x", "n"), ("y", "v"), ("y", "a"), ("x", "w"), (None, "n")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TOKENS, "id int, tokens array<string>")


@pytest.fixture(scope="module")
def natures(spark):
    return spark.createDataFrame(NATURES, "word string, nature string")


def rows(df):
    return sorted(map(str, df.collect()))


def test_pairs(texts, natures):
    small, large = (rows(pairs.noun_predicate_pairs(texts, natures, in_tasks=x)) for x in (True, False))
    assert small == large == ["Row(words='x-y', nature='n-a', cnt=4)"]


def test_tags(texts, natures, monkeypatch):
    small = rows(lexicon.tag_tokens(texts, "tokens", natures))
    monkeypatch.setattr(lookup, "fits", lambda *_: False)
    assert small == rows(lexicon.tag_tokens(texts, "tokens", natures))
    assert len(small) == 9  # one row per token, whatever the lexicon lists twice


@pytest.mark.parametrize("column", ["text", "other"])
def test_segments(spark, column, monkeypatch):
    frame = spark.createDataFrame([(1, "abxab"), (2, None), (3, ""), (4, "a.b+ab\n")], "id int, text string").withColumn("other", F.col("text"))
    words = spark.createDataFrame([("ab",), ("ab",), ("a.b+",), ("",), (None,)], "word string")
    short, joined = (rows(segment.segment(frame, column, words, in_tasks=x)) for x in (True, False))
    monkeypatch.setattr(segment, "MAX_LITERALS", 0)
    assert short == joined == rows(segment.segment(frame, column, words, in_tasks=True))
    monkeypatch.setattr(segment, "_BEGINNINGS", 0)
    assert short == rows(segment.segment(frame, column, words, in_tasks=False))


def test_keywords(spark, texts):
    dictionary = spark.createDataFrame(
        [("m", "x", "A", 3), ("m", "x", "B", 1), ("d", "y", "C", 100_000_000), ("d", "z", "A", 1)], "role string, word string, class string, mult long"
    )
    small, large = (
        keywords.classify_by_keywords(keywords.keyword_hits(texts, dictionary, max_literals=n)).withColumn("w", keywords.matched_words())
        .select("id", "w", "key_classes", "votes") for n in (5, 0)
    )
    assert rows(small) == rows(large)
    found = {r["id"]: r for r in small.collect()}
    assert found[2]["w"] == "|" and found[2]["key_classes"] == [keywords.NO_CLASS]
    assert found[1]["votes"][0]["votes"] == 100_000_000


def test_scores(spark, texts):
    trained = training.train(spark.createDataFrame([("p", ["x", "y"]), ("q", ["y", "z"])], "label string, tokens array<string>"), 3)
    # One token of a text may be NULL only where texts come from a split, which has none.
    known = texts.where("id <> 4")
    small = model.with_distribution(known, trained).select("id", "known", F.transform("p", lambda x: F.round(x, 9)).alias("p"))
    large = model.score_by_join(known.withColumn("tokens", F.array_distinct("tokens")), "tokens", trained).select(
        "id", "known", F.transform("p", lambda x: F.round(x, 9)).alias("p")
    )
    assert rows(small) == rows(large)


def test_stop_words(texts, monkeypatch, spark):
    listed = spark.createDataFrame([("x",), (None,)], "word string")
    small = rows(lookup.remove_words(texts, "tokens", listed).where("id <> 4"))
    monkeypatch.setattr(lookup, "MAX_LITERALS", 0)
    assert small == rows(lookup.remove_words(texts, "tokens", listed).where("id <> 4"))


def test_vocabulary_filter(texts, natures, monkeypatch):
    small = [rows(f(texts, natures)) for f in (features.binary_features, features.count_features)]
    monkeypatch.setattr(lookup, "fits", lambda *_: False)
    assert small == [rows(f(texts, natures)) for f in (features.binary_features, features.count_features)]
    assert len(small[0]) == 5


def test_training_needs_texts_and_classes(spark, monkeypatch):
    empty = spark.createDataFrame([], "label string, tokens array<string>")
    with pytest.raises(ValueError, match="no labelled texts"):
        training.train(empty, 2)
    monkeypatch.setattr(training, "MAX_CLASSES", 1)
    with pytest.raises(ValueError, match="more than 1 classes"):
        training.train(spark.createDataFrame([("p", ["x"]), ("q", ["y"])], empty.schema), 2)


def test_sinks_refuse_what_they_would_lose(spark, table_name, tmp_path):
    frame = spark.createDataFrame([(1, "a")], "id bigint, `odd.name` string")
    sinks.save_by_date(frame, table_name, 1, location=str(tmp_path / "t"))
    assert [tuple(r) for r in spark.table(table_name).collect()] == [(1, "a", 1)]
    for wrong in (
        frame.withColumn("more", F.lit(1)), frame.drop("odd.name"), frame.withColumn("id", F.lit(2.9)), frame.withColumn("id", F.lit(3)),
    ):
        with pytest.raises(ValueError, match="differ in name or type"):
            sinks.save_by_date(wrong, table_name, 1)
    assert spark.table(table_name).count() == 1


def test_pair_counts_beyond_32_bits(spark, natures):
    long = spark.createDataFrame([(1,)], "id int").select(
        F.concat(F.array_repeat(F.lit("x"), 50_000), F.array_repeat(F.lit("y"), 50_000)).alias("tokens")
    )
    for way in (True, False):
        assert [r["cnt"] for r in pairs.noun_predicate_pairs(long, natures, in_tasks=way).collect()] == [2_500_000_000]


def test_known_charset(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("1\t手机".encode("gbk"))
    assert files.read_lines(spark, str(tmp_path / "a.txt"), "GBK").first()["line"] == "1\t手机"


def test_inputs_reach_their_branches(spark, sf_dir):
    comments = inputs.comments(spark, sf_dir)
    day = tables.scan_comments(comments, inputs.DAY).count()
    assert 0 < day < tables.scan_all_comments(comments).count() < comments.count()
    messages = inputs.messages(spark, sf_dir)
    dropped = [
        messages.where(c).count()
        for c in (f"stat_date <> {inputs.DAY}", f"stat_hour <> {inputs.HOUR}", "content is null", "length(content) <= 2")
    ]
    assert all(dropped) and tables.scan_messages(messages, inputs.DAY, inputs.HOUR).count() > 0
    found = queries._keyword_classes(spark, sf_dir)
    size = {k: F.size(f"{k}_hits") > 0 for k in "md"}
    clear = F.exists(F.concat("m_hits", "d_hits"), lambda hit: ~hit["ambiguous"])
    all_ambiguous = found.where(size["m"] & size["d"] & ~clear & (F.get("key_classes", F.lit(0)) == keywords.NO_CLASS))
    assert all_ambiguous.count() > 0
