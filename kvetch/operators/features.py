"""Word counts, vocabularies and sparse features of labelled texts.

Inputs hold ``label`` and ``tokens``; features also keep the key columns they are given.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.functions.text import FEATURE_STOP_WORDS, without_words
from kvetch.operators.lookup import lookup_join, token_parts

# Words of this length or longer are no features; this class is always kept.
MAX_WORD_LENGTH = 20
KEPT_CLASS = "1"
# Tokens whose counts a task forms, about.
_TOKENS_PER_TASK = 1 << 22


def usable_words(tokens: str = "tokens", stop_words: Iterable[str] = FEATURE_STOP_WORDS) -> Column:
    """The tokens that feature selection lets through."""
    short = F.filter(tokens, lambda word: F.length(word) < MAX_WORD_LENGTH)
    return without_words(short, stop_words)


def word_class_counts(texts: DataFrame) -> DataFrame:
    """Occurrences of each short word in each class."""
    return (
        explode_rows(texts, "tokens", "word", "label")
        .where(F.length("word") < MAX_WORD_LENGTH)
        .groupBy("word", "label")
        .agg(F.count("*").alias("cnt"))
    )


def selected_words(texts: DataFrame, min_total: int = 1, stop_words: Iterable[str] = FEATURE_STOP_WORDS) -> DataFrame:
    """Feature words with their total count and the number of classes they occur in."""
    counts = word_class_counts(texts).where(~F.col("word").isin(*stop_words))
    return (
        counts.groupBy("word")
        .agg(
            F.sum("cnt").alias("total"),
            F.count("*").alias("class_cnt"),
            F.max(F.col("label") == KEPT_CLASS).alias("kept"),
        )
        .where((F.col("total") >= min_total) | F.col("kept"))
        .drop("kept")
    )


def vocabulary(texts: DataFrame) -> DataFrame:
    """Distinct words of all texts."""
    return explode_rows(texts, "tokens", "word").distinct()


def class_prior(texts: DataFrame) -> DataFrame:
    """Number and share of texts per class; the classes themselves are few."""
    counts = texts.groupBy("label").agg(F.count("*").alias("texts"))
    total = counts.agg(F.sum("texts").alias("total"))
    return counts.select("label", "texts", (F.col("texts") / total.scalar()).alias("share"))


def _feature_words(texts: DataFrame, tokens: Column | str, vocabulary: DataFrame | None) -> DataFrame:
    """The other columns and one row per token, of the ``vocabulary`` (column ``word``) if one is given."""
    kept = [name for name in texts.columns if name != "tokens"]
    words = explode_rows(texts, tokens, "word", *kept)
    return words if vocabulary is None else lookup_join(words, vocabulary.select("word"), "left_semi").select(*kept, "word")


def _counted(tokens: Column) -> Column:
    """The distinct words of each text with their numbers of occurrences; NULL is no word."""
    @F.arrow_udf("array<struct<word:string,n:bigint>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], pa.list_(pa.struct({"word": pa.string(), "n": pa.int64()})))]
            for texts in token_parts(batch):
                sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
                coded = texts.flatten().dictionary_encode()
                code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
                words = len(coded.dictionary) + 1
                pair, n = np.unique((np.repeat(np.arange(len(texts)), sizes) * words + code)[code >= 0], return_counts=True)
                offsets = np.searchsorted(pair, np.arange(len(texts) + 1) * words).astype("i4")
                items = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(pair % words)).cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"])
                parts.append(pa.ListArray.from_arrays(pa.array(offsets), items))
            yield pa.concat_arrays(parts)

    return counted(tokens)


def binary_features(texts: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """One row per text and distinct word, with value 1. Needs no shuffle of texts.

    With a ``vocabulary`` other words are no features, as a model's words are for new texts.
    """
    return _feature_words(texts, F.array_distinct("tokens"), vocabulary).withColumn("value", F.lit(1).cast("long"))


def count_features(texts: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """One row per text and distinct word with its number of occurrences.

    The columns besides ``tokens`` have to tell texts apart; rows that are equal in them count together. Repeats
    are combined in their own row, so no task holds counts of more than its share of the shuffle, which is set by the
    number of tokens. With a ``vocabulary`` other words are no features.
    """
    total = texts.agg(F.coalesce(F.sum(F.greatest(F.size("tokens"), F.lit(0))), F.lit(0))).first()[0]
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // _TOKENS_PER_TASK + 1)
    kept = [f"`{name}`" for name in texts.columns if name != "tokens"]
    rows = explode_rows(texts, _counted(F.col("tokens")), "_token", *kept).select(*kept, "_token.word", "_token.n")
    if vocabulary is not None:
        rows = lookup_join(rows, vocabulary.select("word"), "left_semi")
    keys = [*kept, "word"]
    return rows.repartition(parts, *keys).groupBy(*keys).agg(F.sum("n").alias("value"))
