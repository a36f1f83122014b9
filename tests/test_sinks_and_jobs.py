import pytest
from fixtures import COMMENTS, RULES, WORDS
from pyspark.sql import functions as F

from kvetch.operators import keywords, training
from kvetch.plans import jobs
from kvetch.sources import files, sinks, tables


def test_rerun_and_empty_rerun(spark, table_name, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    sinks.save_by_date(rows, table_name, "20240101", location=str(tmp_path / "t"))
    sinks.save_by_date(rows.select("name", "id"), table_name, 20240101, files=1)
    sinks.save_by_date(rows.where("id = 1"), table_name, 20240102)
    found = spark.table(table_name)
    assert found.schema.simpleString() == "struct<id:bigint,name:string,stat_date:bigint>"
    assert sorted(map(tuple, found.collect())) == [(1, "a", 20240101), (1, "a", 20240102), (2, "b", 20240101)]
    sinks.save_by_date(rows.where("id = 9"), table_name, 20240101)
    assert [tuple(row) for row in spark.table(table_name).collect()] == [(1, "a", 20240102)]


def test_string_partition(spark, table_name, tmp_path):
    rows = spark.createDataFrame([(True, 0.5)], "flag boolean, share double")
    value = "it's \\ \"1\""
    sinks.save_by_date(rows, table_name, value, "string", location=str(tmp_path / "t"))
    assert spark.table(table_name).first()["stat_date"] == value
    with pytest.raises(ValueError):
        sinks.save_by_date(rows, table_name, "2024-01-01 or 1=1")


def test_a_run_that_fails_changes_nothing(spark, table_name):
    def rows(n, fails=False):
        broken = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))) if fails else F.lit(None)
        return spark.range(0, n, 1, 4).select("id", F.coalesce(broken.cast("string"), F.lit("a")).alias("a"))

    sinks.save_by_hour(rows(5), table_name, 20240101, 3)
    sinks.save_by_hour(rows(7), table_name, 20240101, 4)
    # The other tasks have written their files by the time the last one fails.
    with pytest.raises(Exception, match="lost"):
        sinks.save_by_hour(rows(400, fails=True), table_name, 20240101, 3)
    with pytest.raises(Exception, match="lost"):
        sinks.save_by_hour(rows(400, fails=True), table_name, 20240101, 5)

    def counts():
        return sorted(map(tuple, spark.table(table_name).groupBy("stat_hour").count().collect()))

    assert counts() == [(3, 5), (4, 7)]
    sinks.save_by_hour(rows(400), table_name, 20240101, 3)
    assert counts() == [(3, 400), (4, 7)]


def test_readers_keep_the_version_they_began_with(spark, table_name):
    sinks.save_by_date(spark.range(0, 10, 1, 2), table_name, 20240101)
    begun = spark.table(table_name)
    assert len(begun.collect()) == 10
    sinks.save_by_date(spark.range(0, 3, 1, 1), table_name, 20240101)
    assert len(begun.collect()) == 10
    assert spark.table(table_name).count() == 3
    # The rows of a partition may come from the partition itself.
    sinks.save_by_date(spark.table(table_name).select((F.col("id") + 1).alias("id")), table_name, 20240101)
    assert sorted(r["id"] for r in spark.table(table_name).collect()) == [1, 2, 3]


def test_unsupported_type(spark, table_name):
    with pytest.raises(TypeError, match="timestamp"):
        sinks.save_by_date(spark.range(1).select(F.current_timestamp().alias("at")), table_name, 1)
    with pytest.raises(TypeError):
        sinks.partition_literal(1, "date")


def test_lines_out(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0.25, "x y"), ("", 1.0, "z")], "label string, confidence double, text string")
    sinks.save_lines(rows, str(tmp_path / "out"))
    found = sorted(row["value"] for row in spark.read.text(str(tmp_path / "out")).collect())
    assert found == ["\t1.0\tz", "a\t0.25\tx y"]


COLUMNS = (
    "commentid string, content string, nature int, devicecode string, brandcode string, storename string, "
    "storeid string, createtime bigint, dt bigint"
)


def comments(spark):
    rows = [(str(i), text, -1, "d", "b", "s", "i", i, 20240101) for i, text, *_ in COMMENTS]
    rows += [
        ("positive", "屏幕", 1, "d", "b", "s", "i", 1, 20240101),
        ("no nature", "屏幕", None, "d", "b", "s", "i", 1, 20240101),
        ("no content", None, 0, "d", "b", "s", "i", 1, 20240101),
        ("no time", "屏幕", 0, None, None, None, None, None, 20240101),
        ("no time", "屏幕", 0, None, None, None, None, None, 20240101),
        ("other day", "屏幕", 0, "d", "b", "s", "i", 1, 20240102),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_comment_scan(spark):
    ids = [row["commentid"] for row in tables.scan_comments(comments(spark), 20240101).collect()]
    assert sorted(ids) == sorted([str(i) for i, *_ in COMMENTS] + ["no time", "no time"])
    assert tables.scan_all_comments(comments(spark)).count() == len(ids) + 1


def test_message_scan(spark):
    rows = [("1", None), ("2", "a"), ("3", "ab"), ("4", "abc")]
    messages = spark.createDataFrame(
        [(i, content, 1, hour) for i, content in rows for hour in (1, 2)],
        "id string, content string, stat_date bigint, stat_hour bigint",
    )
    assert [tuple(row) for row in tables.scan_messages(messages, 1, 2).collect()] == [("4", "abc")]


@pytest.fixture
def inputs(spark, tmp_path):
    (tmp_path / "rules.txt").write_bytes("\n".join(RULES).encode("gbk"))
    training_lines = ["外观-屏幕\t屏幕烂", "外观-屏幕\t屏幕", "性能-发热\t手机发烫", "性能-发热\t电池烫", "bad line", "x\t手机"]
    (tmp_path / "train.txt").write_text("﻿" + "\n".join(training_lines), encoding="utf8")
    lexicon = spark.createDataFrame([(word,) for word in WORDS], "word string")
    return tmp_path, lexicon


def test_daily_classification(spark, inputs, table_name):
    folder, lexicon = inputs
    jobs.run_daily_classification(
        spark, comments(spark), str(folder / "rules.txt"), str(folder / "train.txt"), table_name, 20240101, passes=5,
        lexicon=lexicon, location=str(folder / "out"), files=1,
    )
    rows = spark.table(table_name).collect()
    found = {row["commentid"]: row for row in rows}
    assert len(rows) == len(COMMENTS) + 2
    assert {i: found[str(i)]["words"] for i, *_ in COMMENTS} == {i: words for i, _, _, words, _ in COMMENTS}
    # Keywords and model agree; a text without any word gets the model's first class.
    assert found["2"]["class"] == "外观-屏幕"
    assert found["5"]["class"] == "性能-发热"
    assert found["1"]["class"] in ("外观-屏幕", "性能-发热")
    assert found["no time"]["createtime"] is None
    assert spark.table(table_name).columns[-1] == "stat_date"


def test_ambiguous_words_are_not_trained(spark, inputs):
    folder, lexicon = inputs
    dictionary = keywords.build_dictionary(keywords.parse_rules(files.read_lines(spark, str(folder / "rules.txt"))))
    lines = files.read_lines(spark, str(folder / "train.txt"))
    texts = jobs.comment_training_texts(lines, dictionary, lexicon)
    # The text of the class x holds an ambiguous word only.
    assert sorted((r["label"], " ".join(r["tokens"])) for r in texts.collect()) == [
        ("外观-屏幕", "屏幕"), ("外观-屏幕", "屏幕 烂"), ("性能-发热", "发烫"), ("性能-发热", "电池 烫"),
    ]


def test_message_and_file_jobs(spark, inputs, table_name):
    folder, lexicon = inputs
    model = jobs.train_for_messages(files.read_lines(spark, str(folder / "train.txt")), lexicon=lexicon)
    messages = spark.createDataFrame(
        [("1", "屏幕屏幕", 1, 2), ("2", "天气今天", 1, 2), ("3", "屏幕", 1, 2)],
        "id string, content string, stat_date bigint, stat_hour bigint",
    )
    jobs.run_hourly_scoring(messages, model, table_name, 1, 2, lexicon, str(folder / "scores"))
    found = {row["id"]: row for row in spark.table(table_name).collect()}
    assert set(found) == {"1", "2"}
    assert found["1"]["classid"] == "外观-屏幕"
    assert (found["2"]["classid"], found["2"]["cvalue"]) == ("-100", 0.0)
    jobs.run_file_scoring(spark, str(folder / "train.txt"), model, True, str(folder / "scored"), lexicon)
    scored = [row["value"].split("\t") for row in spark.read.text(str(folder / "scored")).collect()]
    assert len(scored) == 6
    assert ["noclassid", "-100", "0.0", "bad line"] in scored
    jobs.run_fit_report(spark, str(folder / "train.txt"), str(folder / "fit"), passes=2)
    # One line has no label, and one only a stop word.
    assert spark.read.text(str(folder / "fit")).count() == 4


def test_pair_and_field_jobs(spark, inputs, table_name):
    folder, lexicon = inputs
    natures = spark.createDataFrame([("屏幕", "n"), ("烂", "a")], "word string, nature string")
    jobs.run_pair_count(comments(spark), natures, table_name, 7, lexicon, str(folder / "pairs"))
    assert [tuple(row) for row in spark.table(table_name).collect()] == [("屏幕-烂", "n-a", 3, 7)]
    (folder / "fields.txt").write_text("a\tb\tc\td\te\tf\nshort\tline\n", encoding="utf8")
    jobs.run_field_extract(spark, str(folder / "fields.txt"), f"{table_name}_fields", 7, str(folder / "fields"))
    assert [tuple(row) for row in spark.table(f"{table_name}_fields").collect()] == [("a", "b", 7)]


def test_default_passes():
    assert (training.PASSES, jobs.DEFAULT_PASSES) == (50, 1)
