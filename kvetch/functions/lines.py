"""Column expressions for tab separated lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Byte order marks, the word separator of keyword lines (U+FF0C).
BYTE_ORDER_MARKS = ("\ufeff", "\ufffe")
WORD_SEPARATOR = "，"


def without_mark(line: Column) -> Column:
    """Drop one leading byte order mark."""
    marked = F.substring(line, 1, 1).isin(*BYTE_ORDER_MARKS)
    return F.when(marked, F.substr(line, F.lit(2))).otherwise(line)


def split_label(line: Column, missing: str) -> Column:
    """``struct<label,text>`` split at the first tab.

    A line without a tab, or with nothing after it, gets ``missing`` as its label and
    stays whole.
    """
    clean = without_mark(line)
    tab = F.instr(clean, "\t")
    good = (tab > 0) & (tab < F.length(clean))
    return F.struct(
        F.when(good, F.substr(clean, F.lit(1), tab - 1)).otherwise(F.lit(missing)).alias("label"),
        F.when(good, F.substr(clean, tab + 1)).otherwise(line).alias("text"),
    )


def tab_fields(line: Column) -> Column:
    """Tab separated fields; empty ones at the end do not count."""
    return F.split(F.regexp_replace(line, r"\t+\z", ""), "\t", -1)


def strip(text: Column) -> Column:
    """Trim every character up to U+0020 on both ends, not only the space."""
    # Most have none at either end, which is cheap to see.
    clean = (F.substring(text, 1, 1) > " ") & (F.substring(text, -1, 1) > " ")
    return F.when(clean, text).otherwise(F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+\z", ""))


def listed_words(text: Column) -> Column:
    """Words of a separated list, trimmed, without empty ones."""
    words = F.transform(F.split(text, WORD_SEPARATOR, -1), strip)
    return F.filter(words, lambda word: word != "")
