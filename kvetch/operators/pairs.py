"""Counts of noun and predicate word pairs within texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.operators.automaton import ranges
from kvetch.operators.lexicon import one_nature_per_word
from kvetch.operators.lookup import MAX_BYTES, MAX_ROWS, finder, fits, matches

# Natures left out, natures of nouns and predicates, the verb that is none.
DROPPED = ("mzd", "mzm", "w")
NOUN = "n"
ADJECTIVE = "a"
VERB = "v"
COPULA = "vshi"

# Products that are formed at a time in a task, and sums that it holds before it sends them on.
_PRODUCTS = 1_000_000
_HELD_PAIRS = 2_000_000
# About as many nouns, and as many predicates, of one text meet under one join key.
_CELL = 256


def _starts(column: Column, prefixes: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | column.startswith(prefix)
    return test


def paired_words(lexicon: DataFrame) -> DataFrame:
    """Words that take part in pairs, each once: ``word``, ``nature``, ``is_noun``."""
    nature = F.col("nature")
    noun = nature.startswith(NOUN)
    predicate = nature.startswith(ADJECTIVE) | (nature.startswith(VERB) & (nature != COPULA))
    return one_nature_per_word(lexicon).where(~_starts(nature, DROPPED) & (noun | predicate)).select(
        "word", "nature", noun.alias("is_noun")
    )


class _PairSums:
    """Sums over texts of noun counts times predicate counts: the product of two sparse matrices, texts by words.

    Products are formed for some texts at a time, or for some nouns of a text that is too long for that, and
    merged into sorted keys with their sums.
    """

    def __init__(self, words: int) -> None:
        self.words = words
        self.keys, self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, owner: np.ndarray, place: np.ndarray, n: np.ndarray, noun: np.ndarray, texts: int) -> Iterator[pa.RecordBatch]:
        """Add the distinct words of some texts: in which text, which word, how often, and whether it is a noun.

        Sums that have become many are sent on.
        """
        first, second = (tuple(x[side] for x in (owner, place, n)) for side in (noun, ~noun))
        nouns, predicates = (np.bincount(side[0], minlength=texts) for side in (first, second))
        # Each noun with as many predicates as its text has.
        times = predicates[first[0]]
        begin = (np.cumsum(predicates) - predicates)[first[0]]
        ends, at = np.cumsum(times), 0
        while at < len(times):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + _PRODUCTS, "right")))
            by = ranges(begin[at:to], times[at:to])
            keys = np.repeat(first[1][at:to], times[at:to]) * self.words + second[1][by]
            self._merge(keys, np.repeat(first[2][at:to], times[at:to]) * second[2][by])
            if len(self.keys) > _HELD_PAIRS:
                yield self.taken()
            at = to

    def _merge(self, keys: np.ndarray, sums: np.ndarray) -> None:
        keys, sums = np.concatenate([self.keys, keys]), np.concatenate([self.sums, sums])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
        self.keys, self.sums = keys[heads], np.add.reduceat(sums[order], heads) if len(heads) else sums

    def taken(self) -> pa.RecordBatch:
        """The sums so far, which are forgotten here."""
        columns = [pa.array((self.keys // self.words).astype("i4")), pa.array((self.keys % self.words).astype("i4")), pa.array(self.sums)]
        self.keys, self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(columns, names=["noun", "predicate", "cnt"])


def _pairs_in_tasks(texts: DataFrame, tokens: str, table: pa.Table) -> DataFrame:
    """Pairs summed in each task; only sums per pair leave it, whatever the texts' number and length."""
    spark = texts.sparkSession
    words = table["word"].cast(pa.string()).combine_chunks()
    shared = spark.sparkContext.broadcast((words, table["is_noun"].combine_chunks()))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, is_noun = shared.value
        find, noun = finder(words), is_noun.to_numpy(zero_copy_only=False)
        sums = _PairSums(max(len(words), 1))
        for batch in batches:
            lists = batch.column(0)
            found = find(lists.flatten())
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lists), dtype="i8"), lengths)[found >= 0]
            keys, counts = np.unique(owner * sums.words + found[found >= 0], return_counts=True)
            owner, place = keys // sums.words, keys % sums.words
            yield from sums.add(owner, place, counts, noun[place], len(lists))
        yield sums.taken()

    pairs = (
        texts.select(tokens)
        .mapInArrow(summed, "noun int, predicate int, cnt long")
        .groupBy("noun", "predicate")
        .agg(F.sum("cnt").alias("cnt"))
    )
    # The same words the tasks hold, so within the limits checked for them.
    named = spark.createDataFrame(table.append_column("place", pa.array(range(len(table)), pa.int32())))

    def side(name: str) -> DataFrame:
        return F.broadcast(
            named.select(F.col("place").alias(name), F.col("word").alias(f"{name}_word"), F.col("nature").alias(f"{name}_nature"))
        )

    return pairs.join(side("noun"), "noun").join(side("predicate"), "predicate")


def _pairs_by_join(texts: DataFrame, tokens: str, words: DataFrame) -> DataFrame:
    """Pairs formed by joining each distinct text's nouns with its predicates.

    Occurrences are counted per text first, so repeats do not multiply rows.
    """
    keys = ["print", "copies", "word", "nature", "is_noun"]
    counted = matches(texts, tokens, words).groupBy(*keys).agg(F.count("*").alias("n"))

    def side(name: str, chosen: Column) -> DataFrame:
        return counted.where(chosen).select(
            "print", "copies", F.col("word").alias(f"{name}_word"), F.col("nature").alias(f"{name}_nature"),
            F.col("n").alias(f"{name}_n"),
        )

    # A text's nouns are dealt over rows and its predicates over columns of a grid, so that no cell has many
    # products: as many rows as its nouns ask for, as many columns as its predicates do.
    sizes = counted.groupBy("print").agg(
        F.ceil(F.count_if("is_noun") / _CELL).cast("int").alias("rows"), F.ceil(F.count_if(~F.col("is_noun")) / _CELL).cast("int").alias("columns")
    ).where("rows > 0 and columns > 0")

    def dealt(name: str, own: str, other: str) -> DataFrame:
        """Each word in one row (or column) of its text's grid, and in every column (or row) of it."""
        cell = F.pmod(F.xxhash64(f"{name}_word"), F.col(own)).cast("int")
        words = side(name, F.col("is_noun") if name == "noun" else ~F.col("is_noun")).join(sizes, "print").withColumn(own[:-1], cell)
        kept = ["print", f"{name}_word", f"{name}_nature", f"{name}_n", own[:-1], *(["copies"] if name == "noun" else [])]
        return explode_rows(words, F.sequence(F.lit(0), F.col(other) - 1), other[:-1], *kept)

    nouns, predicates = dealt("noun", "rows", "columns"), dealt("predicate", "columns", "rows")
    return (
        nouns.join(predicates, ["print", "row", "column"])
        .groupBy("noun_word", "noun_nature", "predicate_word", "predicate_nature")
        .agg(F.sum(F.col("copies") * F.col("noun_n") * F.col("predicate_n")).alias("cnt"))
    )


def noun_predicate_pairs(
    texts: DataFrame, lexicon: DataFrame, tokens: str = "tokens", in_tasks: bool | None = None
) -> DataFrame:
    """``words``, ``nature`` and ``cnt`` of all noun and predicate pairs.

    Every occurrence of a noun pairs with every occurrence of a predicate in the same
    text, so counts are 64-bit. A lexicon within the limits is sent to the tasks (``in_tasks`` overrides the
    choice), a larger one is joined.
    """
    words = paired_words(lexicon)
    if in_tasks is None:
        in_tasks = fits(words, MAX_ROWS, MAX_BYTES)
    pairs = _pairs_in_tasks(texts, tokens, words.toArrow()) if in_tasks else _pairs_by_join(texts, tokens, words)
    return pairs.select(
        F.concat_ws("-", "noun_word", "predicate_word").alias("words"),
        F.concat_ws("-", "noun_nature", "predicate_nature").alias("nature"),
        F.col("cnt").cast("long").alias("cnt"),
    )
