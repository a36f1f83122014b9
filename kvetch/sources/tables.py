"""Scans of partitioned comment and message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMMENT_COLUMNS = (
    "commentid", "content", "nature", "devicecode", "brandcode", "storename", "storeid", "createtime",
)


def scan_comments(comments: DataFrame, dt: int) -> DataFrame:
    """One day's comments that are not positive (``nature < 1``)."""
    return comments.where(
        (F.col("dt") == dt) & (F.col("nature") < 1) & F.col("content").isNotNull()
    ).select(*COMMENT_COLUMNS)


def scan_all_comments(comments: DataFrame) -> DataFrame:
    """Content of all comments that are not positive, over the whole history."""
    return comments.where((F.col("nature") < 1) & F.col("content").isNotNull()).select("content")


def scan_messages(messages: DataFrame, stat_date: int, stat_hour: int) -> DataFrame:
    """One hour's messages longer than two characters."""
    return messages.where(
        (F.col("stat_date") == stat_date)
        & (F.col("stat_hour") == stat_hour)
        & F.col("content").isNotNull()
        & (F.length("content") > 2)
    ).select("id", "content")
