"""Word classes from a lexicon table of ``word`` and ``nature``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.operators.lookup import lookup_join

UNKNOWN = "x"


def one_nature_per_word(lexicon: DataFrame) -> DataFrame:
    """A lexicon in which each word stands once; of several natures the smallest is taken."""
    return lexicon.where("word is not null").groupBy("word").agg(F.min("nature").alias("nature"))


def with_user_words(lexicon: DataFrame, user_words: DataFrame) -> DataFrame:
    """Add words to a lexicon; a user's row replaces the lexicon's row for that word."""
    both = lexicon.select("word", "nature", F.lit(False).alias("user")).unionByName(
        user_words.select("word", "nature", F.lit(True).alias("user"))
    )
    # Among several rows for a word in one table the smallest nature stands.
    return both.groupBy("word").agg(
        F.coalesce(F.min(F.when(F.col("user"), F.col("nature"))), F.min("nature")).alias("nature")
    )


def tag_tokens(df: DataFrame, tokens: str, lexicon: DataFrame) -> DataFrame:
    """One row per token: the other columns, ``pos``, ``word`` and its one ``nature``."""
    kept = [column for column in df.columns if column != tokens]
    words = explode_rows(df, tokens, "word", *kept, pos="pos")
    return lookup_join(words, one_nature_per_word(lexicon), "left").select(
        *kept, "pos", "word", F.coalesce("nature", F.lit(UNKNOWN)).alias("nature")
    )
