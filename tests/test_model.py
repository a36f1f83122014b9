import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kvetch.operators import features, model, training
from registry import queries as registered

TEXTS = [
    (1, "a", "x y z x"), (2, "a", "x y"), (3, "b", "y w"), (4, "b", "w v w"), (5, "c", "u"), (6, "a", "x y"), (7, "c", "u z"),
]


def trained_by_hand(passes, binary=True):
    """Class and word weights, and each text's weight, one text after the other."""
    texts = [(i, label, sorted(set(t.split())) if binary else t.split()) for i, label, t in TEXTS]
    classes = sorted({label for _, label, _ in texts})
    words = {word for _, _, tokens in texts for word in tokens}
    f, g, weight = defaultdict(float), defaultdict(float), defaultdict(float)
    for _ in range(passes):
        total = sum(g.values())
        sums = {c: sum(f[word, c] for word in words) for c in classes}
        steps = []
        for i, label, tokens in texts:
            logs = {
                c: math.log((g[c] + 1) / (total + len(classes)))
                + sum(math.log((f[word, c] + 1) / (sums[c] + len(words))) for word in tokens)
                for c in classes
            }
            shares = {c: math.exp(value) for c, value in logs.items()}
            steps.append((i, label, tokens, 1 - shares[label] / sum(shares.values())))
        for i, label, tokens, step in steps:
            g[label] += step
            weight[i] += step
            for word in tokens:
                f[word, label] += step
    return dict(g), {key: value for key, value in f.items() if value}, dict(weight)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.createDataFrame(TEXTS, "id int, label string, text string")
    return rows.select("id", "label", F.split("text", " ").alias("tokens"))


@pytest.mark.parametrize("in_tasks", [True, False])
@pytest.mark.parametrize("binary", [True, False])
def test_training(texts, in_tasks, binary):
    trained = training.train(texts, passes=4, in_tasks=in_tasks, binary=binary)
    classes, words, _ = trained_by_hand(4, binary)
    assert dict(zip(trained.classes, trained.class_weights, strict=True)) == pytest.approx(classes)
    assert {(r["word"], r["label"]): r["f"] for r in trained.terms.collect()} == pytest.approx(words)
    assert trained.vocabulary_size == 6


def test_text_weights(texts):
    steps = training.training_passes(texts)
    models = [next(steps) for _ in range(3)]
    steps.close()
    found = training.text_weights(texts, models).collect()
    assert {row["id"]: row["weight"] for row in found} == pytest.approx(trained_by_hand(4)[2])


@pytest.fixture(scope="module")
def trained(texts):
    return training.train(texts, passes=3)


@pytest.fixture(scope="module")
def unseen(spark):
    rows = [(1, ["x", "x", "y"]), (2, ["nothing", "known"]), (3, []), (4, ["w", "?"]), (5, ["w", "?"])]
    return spark.createDataFrame(rows, "id int, tokens array<string>")


def test_both_ways_of_scoring_agree(unseen, trained):
    ours = {r["id"]: r for r in model.with_distribution(unseen, trained).collect()}
    joined = model.score_by_join(unseen.withColumn("tokens", F.array_distinct("tokens")), "tokens", trained)
    theirs = {r["id"]: r for r in joined.collect()}
    assert set(ours) == set(theirs) == {1, 2, 3, 4, 5}
    for i, row in ours.items():
        assert row["known"] == theirs[i]["known"]
        assert row["p"] == pytest.approx(theirs[i]["p"])
        assert sum(row["p"]) == pytest.approx(1)


def test_gate_and_ranking(unseen, trained):
    scored = model.with_distribution(unseen, trained)
    best = {r["id"]: r for r in model.with_best_class(scored, trained).collect()}
    assert (best[1]["classid"], best[4]["classid"]) == ("a", "b")
    assert (best[2]["classid"], best[2]["cvalue"]) == (model.NO_WORDS_CLASS, 0.0)
    assert (best[3]["classid"], best[3]["cvalue"]) == (model.NO_WORDS_CLASS, 0.0)
    top = {r["id"]: r for r in model.with_top_classes(scored, trained).collect()}
    by_prior = [name for _, name in sorted(zip([-p for p in trained.prior], trained.classes, strict=True))]
    assert top[2]["pred_classes"] == top[3]["pred_classes"] == by_prior
    assert top[1]["pred_values"] == sorted(top[1]["pred_values"], reverse=True)


def test_save_and_load(spark, unseen, trained, tmp_path):
    trained.save(str(tmp_path / "model"))
    loaded = model.Model.load(spark, str(tmp_path / "model"))
    assert (loaded.classes, loaded.vocabulary_size) == (trained.classes, trained.vocabulary_size)
    ours = model.with_distribution(unseen, trained).orderBy("id").collect()
    theirs = model.with_distribution(unseen, loaded).orderBy("id").collect()
    for left, right in zip(ours, theirs, strict=True):
        assert left["p"] == pytest.approx(right["p"])


def test_model_too_large_for_tasks(spark, texts, unseen, monkeypatch):
    monkeypatch.setattr(model, "MAX_CELLS", 0)
    monkeypatch.setattr(training, "MAX_CELLS", 0)
    trained = training.train(texts, passes=2)
    assert trained.cells is None
    assert model.with_distribution(unseen, trained).count() == 5
    with pytest.raises(ValueError):
        training.train(texts, passes=1, in_tasks=True)


def test_single_class(spark):
    texts = spark.createDataFrame([("a", ["x"]), ("a", ["y"])], "label string, tokens array<string>")
    trained = training.train(texts, passes=2)
    best = model.with_best_class(model.with_distribution(texts, trained), trained).collect()
    assert [(row["classid"], row["cvalue"]) for row in best] == [("a", 1.0), ("a", 1.0)]


def test_features(spark):
    rows = [("1", ["a" * 19, "b" * 20, "手机", "x", "x"]), ("2", ["x"])]
    texts = spark.createDataFrame(rows, "label string, tokens array<string>")
    counts = {(r["word"], r["label"]): r["cnt"] for r in features.word_class_counts(texts).collect()}
    assert counts == {("a" * 19, "1"): 1, ("手机", "1"): 1, ("x", "1"): 2, ("x", "2"): 1}
    words = {r["word"]: (r["total"], r["class_cnt"]) for r in features.selected_words(texts).collect()}
    assert words == {"a" * 19: (1, 1), "x": (3, 2)}
    # Words of the class "1" stay whatever their total.
    assert {r["word"] for r in features.selected_words(texts, min_total=5).collect()} == set(words)
    kept = texts.select(features.usable_words("tokens").alias("tokens")).collect()
    assert [row["tokens"] for row in kept] == [["a" * 19, "x", "x"], ["x"]]


@pytest.mark.parametrize("in_tasks", [True, False])
def test_only_the_tables_in_use_stay(spark, texts, in_tasks, monkeypatch, tmp_path):
    monkeypatch.setattr(training, "scratch_folder", lambda *_: str(tmp_path / "train"))
    trained = training.train(texts, passes=3, in_tasks=in_tasks)
    left = sorted(path.name for path in (tmp_path / "train").iterdir())
    assert left == ([] if in_tasks else ["pass-3"])
    assert trained.terms.count() > 0


def test_registered_training_takes_all_passes():
    assert registered.PASSES == registered.PASSES_BY_JOIN == training.PASSES == 50


def test_training_tokenises_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame([("x", ["a", "b"]), ("y", ["b", None]), ("y", [])], "label string, tokens array<string>")
    assert training.train(table.mapInArrow(seen, table.schema), 3).classes == ["x", "y"]
    assert read.value == 3
