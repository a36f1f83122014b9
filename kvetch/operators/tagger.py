"""Natures of words in context: a first-order hidden Markov model.

A tagged table says how often a word has each nature and how often one nature follows another. A sentence gets the
natures that cost least together: for each word the logarithm of how rare it is among its nature's words, and for each
neighbouring pair how rare the second nature is behind the first. Costs are whole numbers, so that sums are the same in any order.

A word with one nature decides its own; what stands between such words is solved by itself, and all of these runs of a batch
together, a place of each in a step (the Viterbi algorithm). So Python takes one step per word of the longest run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.operators.automaton import marked, ranges
from kvetch.operators.lexicon import UNKNOWN
from kvetch.operators.lookup import finder, small_table, with_matches
from kvetch.session import scratch_folder

_UNIT = 1_000_000
# Natures are rows and columns of a matrix.
MAX_NATURES = 1_000


@dataclass(frozen=True)
class Tagger:
    """``words``: ``word``, ``nature`` and ``cost``; ``natures`` in order, and the ``costs`` of each behind each, the last row being
    for the beginning of a sentence."""

    words: DataFrame
    natures: list[str]
    costs: np.ndarray


def _cost(total: Column, n: Column) -> Column:
    return F.round(F.log(total.cast("double") / n) * _UNIT).cast("long")


def train_tagger(tagged: DataFrame, *sentence: str) -> Tagger:
    """From a table of ``pos``, ``word``, ``nature`` and the columns that name a sentence.

    Rows without word or nature don't count. Every nature may follow every other: each pair counts once more than
    it was seen. Unknown words have a nature of their own.
    """
    known = tagged.where("word is not null and nature is not null")
    before = F.lag("nature").over(Window.partitionBy(*sentence).orderBy("pos"))
    # One pass over the tokens, written as the counts of words behind natures; pairs and words are sums of these.
    folder, spark = scratch_folder(tagged.sparkSession, "natures"), tagged.sparkSession
    tally = known.select("word", "nature", F.coalesce(before, F.lit("")).alias("before")).groupBy("word", "nature", "before").agg(F.count("*").alias("n"))
    tally.write.parquet(f"{folder}/counts")
    tally = spark.read.schema(tally.schema).parquet(f"{folder}/counts")
    pairs = tally.groupBy("before", "nature").agg(F.sum("n").alias("n"))
    seen = pairs.limit(MAX_NATURES**2 + 1).toArrow().to_pylist()
    natures = sorted({row["nature"] for row in seen} | {UNKNOWN})
    if len(natures) > MAX_NATURES:
        raise ValueError(f"there are more than {MAX_NATURES} natures")
    place = {nature: k for k, nature in enumerate(natures)}
    counts = np.zeros((len(natures) + 1, len(natures)))
    for row in seen:
        counts[place.get(row["before"], len(natures)), place[row["nature"]]] = row["n"]
    costs = np.round(np.log((counts.sum(1, keepdims=True) + len(natures)) / (counts + 1)) * _UNIT).astype(np.int64)
    words = tally.groupBy("word", "nature").agg(F.sum("n").alias("n"))
    # Written too: the table is measured, sent or joined.
    words.write.parquet(f"{folder}/words")
    words = spark.read.schema(words.schema).parquet(f"{folder}/words")
    totals = words.groupBy("nature").agg(F.sum("n").alias("total"))
    return Tagger(words.join(F.broadcast(totals), "nature").select("word", "nature", _cost(F.col("total"), F.col("n")).alias("cost")), natures, costs)


class _Candidates:
    """The natures that each word may have: places in a list of words, and of each the natures with their costs, in order."""

    def __init__(self, table: pa.Table, natures: list[str]) -> None:
        coded = table["word"].combine_chunks().dictionary_encode()
        word = coded.indices.to_numpy(zero_copy_only=False)
        nature = pc.index_in(table["nature"], pa.array(natures, pa.string())).to_numpy()
        order = np.lexsort((nature, word))
        self.words = coded.dictionary
        # One more word, for all that are unknown.
        self.nature = np.append(nature[order], natures.index(UNKNOWN)).astype(np.int64)
        self.cost = np.append(table["cost"].to_numpy()[order], 0).astype(np.int64)
        self.count = np.append(np.bincount(word, minlength=len(self.words)), 1)
        self.first = np.cumsum(self.count) - self.count


def _decoded(word: np.ndarray, starts: np.ndarray, held: _Candidates, costs: np.ndarray) -> np.ndarray:
    """The nature of each word of some sentences, none of them empty.

    Of equal ways the one with the first nature stands, compared from the sentence's end.
    """
    n = len(word)
    count = held.count[word]
    first = np.cumsum(count) - count
    entry = ranges(held.first[word], count)
    nature, own = held.nature[entry], held.cost[entry]
    best, back = np.zeros(len(entry), np.int64), np.arange(len(entry))
    begins = np.zeros(n, bool)
    begins[starts] = True
    opening = ranges(first[starts], count[starts])
    best[opening] = costs[-1][nature[opening]] + own[opening]
    # Runs begin with a sentence or with a word that has one nature, and end with the next of these, which they decide nothing of.
    pinned = count == 1
    head = np.flatnonzero(begins | pinned)
    end = np.append(head[1:], n)
    sentence_end = np.append(begins[1:], True)
    # A run's last place: the next head, unless that begins another sentence.
    last = np.where(np.append(begins, True)[end], end - 1, end)
    lengths = last - head
    order = np.argsort(-lengths, kind="stable")
    for step in range(1, int(lengths.max(initial=0)) + 1):
        runs = order[: np.searchsorted(-lengths[order], -step, "right")]
        at = head[runs] + step
        # Each nature here with each of the word before, the latter innermost.
        here = ranges(first[at], count[at])
        times = np.repeat(count[at - 1], count[at])
        there = ranges(np.repeat(first[at - 1], count[at]), times)
        cost = best[there] + costs[nature[there], np.repeat(nature[here], times)]
        begin = np.cumsum(times) - times
        least = np.minimum.reduceat(cost, begin)
        hit = np.flatnonzero(cost == np.repeat(least, times))
        back[here] = there[hit[np.searchsorted(hit, begin)]]
        # A pinned word is the beginning of the next run, from where costs count anew.
        best[here] = np.where(np.repeat(pinned[at], count[at]), 0, least + own[here])
    closing = np.flatnonzero(sentence_end)
    ends = ranges(first[closing], count[closing])
    begin = np.cumsum(count[closing]) - count[closing]
    hit = np.flatnonzero(best[ends] == np.repeat(np.minimum.reduceat(best[ends], begin), count[closing]))
    chosen = marked(ends[hit[np.searchsorted(hit, begin)]], back)
    return nature[chosen]


def _natures(texts: pa.Array, held: _Candidates, find: Callable[[pa.Array], np.ndarray], costs: np.ndarray, names: pa.Array) -> pa.Array:
    """The natures of a batch of token arrays."""
    sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
    found = find(texts.flatten())
    word = np.where(found < 0, len(held.words), found)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    tags = _decoded(word, starts, held, costs) if len(word) else word
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4"))
    return pa.ListArray.from_arrays(offsets, names.take(pa.array(tags)))


def _by_join(df: DataFrame, tokens: str, tagger: Tagger, name: str) -> DataFrame:
    """The natures of each text's own words are joined to it, once per distinct text, and solved as ever."""
    entries = tagger.words.groupBy("word").agg(F.collect_list(F.struct("nature", "cost")).alias("held"))
    # NULL tokens leave the text here: they have no entry.
    words = F.array_distinct(F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda word: word.isNotNull()))
    joined = with_matches(df.withColumn("_words", words), "_words", entries, "_entries")
    shared = df.sparkSession.sparkContext.broadcast((tagger.costs, tagger.natures))

    @F.arrow_udf("array<string>")
    def natures(texts: pa.Array, found: pa.Array) -> pa.Array:
        costs, names = shared.value
        _, word, held = found.flatten().flatten()
        first = np.unique(word.dictionary_encode().indices.to_numpy(zero_copy_only=False), return_index=True)[1]
        word, held = word.take(pa.array(first)), held.take(pa.array(first))
        nature, cost = held.flatten().flatten()
        owner = np.repeat(np.arange(len(word)), pc.list_value_length(held).to_numpy(zero_copy_only=False))
        table = pa.table({"word": word.take(pa.array(owner)), "nature": nature, "cost": cost})
        candidates = _Candidates(table, names)
        return _natures(texts, candidates, finder(candidates.words), costs, pa.array(names, pa.string()))

    return joined.withColumn(name, natures(F.col(tokens), F.col("_entries"))).drop("_words", "_entries")


def with_natures(df: DataFrame, tokens: str, tagger: Tagger, name: str = "natures") -> DataFrame:
    """Add ``name``: the natures of the tokens, each row being a sentence.

    NULL tokens are unknown words; rows without tokens have no natures. The words' table is sent to the tasks where it is
    within the limits of :func:`~kvetch.operators.lookup.fits`, else joined with the texts' words.
    """
    table = small_table(tagger.words)
    if table is None:
        return _by_join(df, tokens, tagger, name)
    shared = df.sparkSession.sparkContext.broadcast((_Candidates(table, tagger.natures), tagger.costs, tagger.natures))

    @F.arrow_udf("array<string>")
    def natures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, costs, names = shared.value
        find, names = finder(held.words), pa.array(names, pa.string())
        for texts in batches:
            yield _natures(texts, held, find, costs, names)

    return df.withColumn(name, natures(F.col(tokens)))


def tag_in_context(df: DataFrame, tokens: str, tagger: Tagger) -> DataFrame:
    """One row per token: the other columns, ``pos``, ``word`` and its ``nature``."""
    kept = [column for column in df.columns if column != tokens]
    tagged = with_natures(df, tokens, tagger, "_natures")
    rows = explode_rows(tagged, F.arrays_zip(F.col(tokens).alias("word"), F.col("_natures").alias("nature")), "_token", *kept, pos="pos")
    return rows.select(*kept, "pos", "_token.word", "_token.nature")
