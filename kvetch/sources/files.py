"""Scans of text files: keyword lines, labelled lines, lines to be scored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.functions.lines import split_label, tab_fields
from kvetch.operators.lookup import fits
from kvetch.session import java_charsets


# The id of a line that has no label, and of any line of a file without labels.
NO_LABEL_ID = "noclassid"
UNLABELLED_ID = "-100"


def read_lines(spark: SparkSession, path: str | list[str], charset: str | None = None) -> DataFrame:
    """``line`` and ``seq`` of text files, each file as UTF-8 or else as GBK.

    A file is GBK when any of its lines is malformed UTF-8. Both charsets keep the line
    feed as one byte of its own, so files are split at lines before they are decoded and
    a large file is read by many tasks. Only the names of malformed files are grouped.
    ``seq`` orders lines as they stand in their file. Where the ``charset`` is known, naming
    it saves the second read that finds it out.
    """
    raw = spark.read.text(path).select(
        F.col("value"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )
    if charset is not None:
        with java_charsets(spark):
            line = F.col("value") if charset.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
            return raw.select(line.alias("line"), "seq")
    malformed = (
        spark.read.text(path)
        .where(~F.is_valid_utf8("value"))
        .select(F.col("_metadata.file_path").alias("file"))
        .distinct()
        .withColumn("gbk", F.lit(True))
    )
    # One row per malformed file; their number grows with the input, so it is measured.
    named = F.broadcast(malformed) if fits(malformed.select("file")) else malformed
    joined = raw.join(named, F.col("seq.file") == F.col("file"), "left")
    with java_charsets(spark):
        decoded = F.decode(F.col("value").cast("binary"), "GBK")
        return joined.select(F.when(F.col("gbk"), decoded).otherwise(F.col("value")).alias("line"), "seq")


def keyword_lines(lines: DataFrame) -> DataFrame:
    """Lines with at least three fields."""
    return lines.where(F.size(tab_fields(F.col("line"))) > 2)


def first_two_fields(lines: DataFrame) -> DataFrame:
    """Fields one and two, as ``a`` and ``b``, of lines with more than five fields."""
    fields = lines.select(tab_fields(F.col("line")).alias("fields")).where(F.size("fields") > 5)
    return fields.select(F.col("fields")[0].alias("a"), F.col("fields")[1].alias("b"))


def _with_label(lines: DataFrame, missing: str) -> DataFrame:
    kept = [name for name in lines.columns if name != "line"]
    return (
        lines.where(F.length("line") > 0)
        .select(*kept, split_label(F.col("line"), missing).alias("parts"))
        .select(*kept, "parts.label", "parts.text")
    )


def labelled_lines(lines: DataFrame) -> DataFrame:
    """``label`` and ``text`` of lines that have both; other columns are carried along."""
    return _with_label(lines, "").where(F.col("label") != "")


def last_label_per_text(lines: DataFrame) -> DataFrame:
    """One row per text with the label of its last line by ``seq``; empty labels stay."""
    # NULL marks a line that cannot be split, as an empty label is valid here.
    parts = lines.where(F.length("line") > 0).select("seq", split_label(F.col("line"), None).alias("parts"))
    return (
        parts.where(F.col("parts.label").isNotNull())
        .groupBy(F.col("parts.text").alias("text"))
        .agg(F.max_by("parts.label", "seq").alias("label"))
    )


def lines_to_score(lines: DataFrame, has_label: bool) -> DataFrame:
    """``id`` and ``text``: the id is the label, or a fixed mark where there is none."""
    if has_label:
        return _with_label(lines, NO_LABEL_ID).withColumnRenamed("label", "id")
    return lines.withColumn("id", F.lit(UNLABELLED_ID)).withColumnRenamed("line", "text")
