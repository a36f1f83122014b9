from pyspark.sql import functions as F
import pytest

from kvetch.functions.lines import split_label, strip, tab_fields
from kvetch.functions.rows import explode_rows, where_not_empty
from kvetch.functions.text import fold_variants, fold_width, tokenize, without_words
from kvetch.sources import files


def column(spark, values, expression, name="v"):
    rows = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, {name} string")
    return [row[0] for row in rows.orderBy("i").select(expression(F.col(name))).collect()]


def lines(spark, values):
    return spark.createDataFrame([(value, i) for i, value in enumerate(values)], "line string, seq int")


def test_width(spark):
    values = ["ＮＩＡＥＰ　１２！～", "＀｟", "abc", ""]
    assert column(spark, values, fold_width) == ["NIAEP 12!~", "＀｟", "abc", ""]


def test_variants(spark):
    assert column(spark, ["手機壞了"], lambda c: fold_variants(c, {"機": "机", "壞": "坏"})) == ["手机坏了"]
    with pytest.raises(ValueError):
        fold_variants(F.col("v"), {"": "c"})


def test_phrases_beat_characters(spark):
    """Words change as a whole: the longest from the left, with outputs of any length, none of which is folded again."""
    table = {"機": "机", "頭髮": "头发", "髮": "发", "發": "发", "發現": "发现", "計算機": "电脑", "算機": "?", "囉": "", "ab": "b", "bc": "x"}
    texts = ["計算機和飛機", "頭髮發現囉", "發", "", None, "abc", "aabb\U0001f600bc", "\uffff\U0010ffff機"]
    want = ["电脑和飛机", "头发发现", "发", "", None, "bc", "abb\U0001f600x", "\uffff\U0010ffff机"]
    assert column(spark, texts, lambda c: fold_variants(c, table)) == want
    assert column(spark, ["計算機"], lambda c: F.array_join(tokenize(c, variants=table), "|")) == ["电脑"]


def test_tokens(spark):
    values = ["The The, é1b", "", "12 !"]
    assert column(spark, values, tokenize) == [["the", "the", "é", "b"], [], []]
    assert column(spark, values[:1], lambda c: tokenize(c, normalized=False)) == [["The", "The", "é", "b"]]
    assert column(spark, ["a b a c"], lambda c: without_words(tokenize(c), ["b", "c"])) == [["a", "a"]]


def test_fields(spark):
    sizes = column(spark, ["a\tb\tc", "a\tb\t", "\t\tc", "\t\t\t", "", "a\t\t\td\t\t"], lambda c: F.size(tab_fields(c)))
    assert sizes == [3, 2, 3, 1, 1, 4]
    assert column(spark, ["\t a　b \n", "\x00\x1fx"], strip) == ["a　b", "x"]


LABELLED = ["1\tgood", "﻿1\tgood mark", "￾2\tbad", "notab", "3\t", "\ttext", "1\ta\tb", "", "x\tsame", "y\tsame"]


def test_labelled_lines(spark):
    found = files.labelled_lines(lines(spark, LABELLED)).orderBy("seq").select("label", "text").collect()
    assert [tuple(row) for row in found] == [
        ("1", "good"), ("1", "good mark"), ("2", "bad"), ("1", "a\tb"), ("x", "same"), ("y", "same"),
    ]


def test_last_label_per_text(spark):
    found = files.last_label_per_text(lines(spark, LABELLED)).collect()
    assert {row["text"]: row["label"] for row in found} == {
        "good": "1", "good mark": "1", "bad": "2", "text": "", "a\tb": "1", "same": "y",
    }
    assert len(found) == 6


def test_lines_to_score(spark):
    values = ["1\tgood", "notab", "3\t", "\ttext", "", "﻿notab"]
    labelled = files.lines_to_score(lines(spark, values), True).orderBy("seq").select("id", "text").collect()
    assert [tuple(row) for row in labelled] == [
        ("1", "good"), ("noclassid", "notab"), ("noclassid", "3\t"), ("", "text"), ("noclassid", "﻿notab"),
    ]
    plain = files.lines_to_score(lines(spark, values), False).orderBy("seq").select("id", "text").collect()
    assert [tuple(row) for row in plain] == [("-100", value) for value in values]


def test_split_label_of_marked_line_keeps_the_mark_if_unsplit(spark):
    assert column(spark, ["﻿ab"], lambda c: split_label(c, "none")) == [("none", "﻿ab")]


def test_keyword_line_scans(spark):
    values = ["a\tb\tc", "a\tb\t", "1\t2\t3\t4\t5\t6", "1\t2\t3\t4\t5\t", "p\tq\t\t\t\tz"]
    assert files.keyword_lines(lines(spark, values)).count() == 4
    found = files.first_two_fields(lines(spark, values)).collect()
    assert sorted(map(tuple, found)) == [("1", "2"), ("p", "q")]


def test_files_in_two_charsets(spark, tmp_path):
    (tmp_path / "utf8.txt").write_bytes("﻿1\t你好手机\n2\té\n".encode())
    (tmp_path / "gbk.txt").write_bytes("1\tplain\n2\t你好手机\r\n".encode("gbk"))
    found = files.read_lines(spark, str(tmp_path))
    assert sorted(row["line"] for row in found.collect()) == ["1\tplain", "1\t你好手机", "2\té", "2\t你好手机"]


def test_order_within_a_file_decides_the_last_label(spark, tmp_path):
    count = 5000
    (tmp_path / "a.txt").write_text("".join(f"{i}\ttext {i % 7}\n" for i in range(count)), encoding="utf8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        found = files.last_label_per_text(files.read_lines(spark, str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {f"text {i % 7}": str(i) for i in range(count)}
    assert {row["text"]: row["label"] for row in found} == expected


def test_rows_from_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, items array<string>")
    assert sorted(map(tuple, explode_rows(df, "items", "item", "id").collect())) == [(1, "a"), (1, "b")]
    assert sorted(map(tuple, explode_rows(df, "items", "item", "id", pos="at").collect())) == [(1, 0, "a"), (1, 1, "b")]
    assert explode_rows(df, "items", "item", "id", nulls=True).count() == 4
    assert [row["id"] for row in where_not_empty(df, "items").collect()] == [1]
