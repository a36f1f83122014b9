"""The test tables in the shapes the jobs read.

Comments, messages, labelled lines and rule lines are all derived from whole tables. The
constants below are the only fixed inputs; each is looked up in, or applied to, a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.functions.text import FULL_WIDTH, HALF_WIDTH
from kvetch.operators.keywords import build_dictionary, parse_rules

# The day and hour that scans ask for; rows lie on five days, messages in three hours.
DAY = 20240101
HOUR = 9

# Keyword lines over words of the documents; they reach every case.
RULE_LINES = [
    "A\t1\tthing，thly worthless，pathetic",
    "A\t2\tthing，rest ti",
    "B\t1\teau oi",
    "C\t1\tzu\tein",
    "C\t2\tund ein",
    "B\t2\tci el",
    "A\t3\tst nd",
    "D\t1\tof worthy",
    "D\t2\tof worthy",
    "E\t1\tworthy by",
    "E\t2\tworthy by",
]
# The dictionary these lines make.
DICTIONARY = [
    ("m", "thing", "A-1"), ("m", "thly", "A-1"), ("d", "worthless", "A-1"), ("d", "pathetic", "A-1"),
    ("m", "thing", "A-2"), ("m", "rest", "A-2"), ("d", "ti", "A-2"), ("m", "eau", "B-1"), ("d", "oi", "B-1"),
    ("m", "zu", "C-1"), ("d", "ein", "C-1"), ("d", "ein", "C-2"), ("m", "und", "C-2"), ("m", "ci", "B-2"),
    ("d", "el", "B-2"), ("m", "st", "A-3"), ("d", "nd", "A-3"),
    ("m", "of", "D-1"), ("d", "worthy", "D-1"), ("m", "of", "D-2"), ("d", "worthy", "D-2"),
    ("m", "worthy", "E-1"), ("d", "by", "E-1"), ("m", "worthy", "E-2"), ("d", "by", "E-2"),
]
LEXICON = [
    ("thing", "n"), ("eau", "nz"), ("rest", "n"), ("tion", "nr"), ("worthless", "a"), ("pathetic", "ad"),
    ("is", "vshi"), ("was", "v"), ("are", "vn"), ("and", "w"), ("with", "mzm"), ("from", "mzd"),
    # Listed twice: the smaller nature stands.
    ("thing", "v"), ("rest", "a"), ("are", "n"),
]
SEGMENT_WORDS = ["thing", "thingtion", "tion", "the", "then", "in", "inter", "eaux", "eau", "und", "el", "en"]
# Words of the documents that have this many letters make a large lexicon.
LEXICON_LETTERS = 3
VARIANTS = {"é": "e", "è": "e", "ê": "e", "ç": "c", "ñ": "n", "ó": "o", "í": "i", "ü": "u", "ö": "o", "ä": "a"}
# Phrases overlap each other and hold letters of VARIANTS.
PHRASES = {**VARIANTS, "tion of": "t'n of", "of the": "o' th'", "the": "ye", "e du": "e del ", "é d": "", "und die": "&"}
STOP_WORDS = ["the", "of", "and", "de", "la", "und"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores where a test table is a single row group."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(read(spark, sf_dir, "documents").select(*columns), "doc_id")


def comments(spark: SparkSession, sf_dir: str, nature: Column | None = None) -> DataFrame:
    """Comments of five days; none is positive unless ``nature`` says so, and some have no content."""
    texts = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    return texts.select(
        F.col("doc_id").cast("string").alias("commentid"),
        F.when(F.col("doc_id") % 13 != 4, F.col("text")).alias("content"),
        (F.when(F.col("lang") == "en", -1).otherwise(0) if nature is None else nature).alias("nature"),
        F.col("lang").alias("devicecode"),
        F.col("lang").alias("brandcode"),
        F.col("source").alias("storename"),
        F.col("source").alias("storeid"),
        F.col("doc_id").alias("createtime"),
        (F.lit(DAY) + F.col("doc_id") % 5).alias("dt"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of five days and three hours, some short and some without content."""
    turns = spread(read(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return turns.select(
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.when(F.col("conv_id") % 11 == 10, None)
        .when(F.col("conv_id") % 5 == 0, F.substring("text", F.lit(1), (F.col("turn") * 2 + 1).cast("int")))
        .otherwise(F.col("text")).alias("content"),
        (F.lit(DAY) + F.col("conv_id") % 5).alias("stat_date"),
        (F.lit(HOUR) + F.col("turn") % 3 - 1).alias("stat_hour"),
    )


def label_of() -> Column:
    """A document's label as one of the keyword classes."""
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return F.when(good & ~toxic, "A-1").when(good, "B-1").when(~toxic, "C-2").otherwise("A-2")


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``label`` and ``text`` of the labelled documents."""
    texts = documents(spark, sf_dir, "doc_id", "text")
    return texts.join(read(spark, sf_dir, "labels"), "doc_id").select("doc_id", label_of().alias("label"), "text")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per document: marked by language, with its label if it has one.

    The text holds a stop word, so that dropping stop words shows.
    """
    texts = documents(spark, sf_dir, "doc_id", "text", "lang")
    joined = texts.join(read(spark, sf_dir, "labels"), "doc_id", "left")
    mark = F.when(F.col("lang") == "fr", "\ufeff").when(F.col("lang") == "de", "\ufffe").otherwise("")
    label = F.when(F.col("quality").isNotNull(), F.concat(label_of(), F.lit("\t"))).otherwise("")
    return joined.select("doc_id", F.concat(mark, label, F.replace("text", F.lit(" the "), F.lit(" 的 "))).alias("line"))


def sentence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One labelled line per line of each labelled document; equal lines come again."""
    sentences = explode_rows(labelled_texts(spark, sf_dir), F.split("text", "\n"), "text", "doc_id", "label", pos="pos")
    return sentences.select(
        F.concat_ws("\t", "label", "text").alias("line"), F.struct("doc_id", "pos").alias("seq")
    )


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule line from each line of each document."""
    texts = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    lines = explode_rows(texts, F.split("text", "\n"), "text", "doc_id", "lang", "source", pos="pos")
    return lines.select(
        "doc_id", "pos", F.concat_ws("\t", "lang", "source", F.translate(F.lower("text"), ",", "，")).alias("line")
    )


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of six fields per part, of which the last is empty for large parts."""
    parts = read(spark, sf_dir, "part")
    last = F.when(F.col("p_size") > 25, "").otherwise(F.col("p_type"))
    return parts.select(
        F.concat_ws("\t", "p_brand", "p_name", "p_type", "p_partkey", "p_size", last).alias("line")
    )


def dictionary(spark: SparkSession) -> DataFrame:
    return build_dictionary(parse_rules(spark.createDataFrame([(line,) for line in RULE_LINES], "line string")))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, nature string")


def nature_behind(before: Column) -> Column:
    """A nature for the column ``word``: of most words it depends on the word before."""
    word, even = F.col("word"), F.length(F.coalesce(before, F.lit(""))) % 2 == 0
    return F.when(F.length("word") > 9, "nz").when(word.rlike("[aeiou]$"), F.when(even, "n").otherwise("v")).when(
        word.rlike("[nrst]$"), F.when(even, "a").otherwise("n")
    ).otherwise("d")


def some_text() -> Column:
    """The text, NULL for every thirteenth document."""
    return F.when(F.col("doc_id") % 13 != 4, F.col("text"))


def wide_text() -> Column:
    """The text in full-width forms."""
    return F.translate("text", HALF_WIDTH, FULL_WIDTH)


def solid_text() -> Column:
    """The letters of the text, unspaced; NULL for some documents."""
    return F.regexp_replace(F.lower(some_text()), r"[^\p{L}]", "")
