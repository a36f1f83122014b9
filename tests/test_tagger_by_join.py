"""Natures in context with more words than are sent to the tasks."""

from kvetch.operators import lookup, tagger


def test_both_ways_agree(spark, monkeypatch):
    rows = [(s, k, word, nature) for s, text in enumerate(["a:n b:v c:n a:v", "b:n a:n c:a", "c:v b:v a:n d:n", "a:a c:n"]) for k, (word, nature) in enumerate(x.split(":") for x in text.split())]
    trained = tagger.train_tagger(spark.createDataFrame(rows, "s int, pos int, word string, nature string"), "s")
    texts = [["a", "b", "c", "a", "b"], ["zz", "a", None, "c"], None, [], ["zz", None], ["d", "a"], [None, "a"], ["a", None], ["a", "b", "c", "a", "b"]]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, tokens array<string>")
    small = {r["id"]: r["natures"] for r in tagger.with_natures(frame, "tokens", trained).collect()}
    monkeypatch.setattr(tagger, "small_table", lambda table: None)
    monkeypatch.setattr(lookup, "fits", lambda *_: False)
    joined = tagger.with_natures(frame, "tokens", trained)
    assert joined.columns == ["id", "tokens", "natures"]
    assert {r["id"]: r["natures"] for r in joined.collect()} == small
    nothing = frame.where("id = 4")
    assert tagger.with_natures(nothing, "tokens", trained).first()["natures"] == small[4]
