"""The text classifier: a multinomial naive Bayes model and its application to tokens.

For a text with the tokens w1..wn the model gives each class c the score

    ln((g(c) + 1) / (sum of g + C)) + sum over i of ln((f(wi, c) + a) / (F(c) + a V))

where f are word weights per class, F their sums, g class weights, V the number of words
and C of classes. Unknown words count for nothing. Probabilities are the softmax of the
scores over the classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.operators.lookup import finder, fingerprint, fits, lookup_join, token_parts

# The answer for a text without any known word, the number of ranked classes.
NO_WORDS_CLASS = "-100"
RANKED_CLASSES = 3

# A model up to this many (word, class) cells is sent to every task.
MAX_CELLS = 8_000_000
# Texts are scored in groups of this size, to bound a task's memory.
_TEXTS_PER_STEP = 1_000
# Tokens in a block of texts that gets its words' weights, about.
_BLOCK_TOKENS = 1 << 21

TERMS_SCHEMA = "word string, label string, f double"


def wide(terms: DataFrame, classes: list[str]) -> DataFrame:
    """One row per word: the weights of all classes, 0 where a class lacks the word."""
    return terms.groupBy("word").agg(
        F.array(*[F.sum(F.when(F.col("label") == name, F.col("f")).otherwise(0.0)) for name in classes]).alias("f")
    )


def collect_cells(terms: DataFrame, classes: list[str], max_rows: int) -> tuple[pa.Array, np.ndarray] | None:
    """Words and weight matrix of a table of terms within the limits, or None."""
    if not fits(terms.select("word"), max_rows):
        return None
    rows = wide(terms, classes).toArrow().combine_chunks()
    weights = pc.list_flatten(rows["f"]).to_numpy()
    words = rows["word"].cast(pa.string()).combine_chunks()
    return words, weights.reshape(len(words), len(classes))


@dataclass
class Model:
    """Word weights per class, and the few numbers per class.

    The weights are a table (word, label, f), or ``words`` with a matrix of one column per
    class where they are known to be few. ``folder`` is where training wrote the table.
    """

    spark: SparkSession
    classes: list[str]
    class_weights: list[float]
    word_weights: list[float]
    vocabulary_size: int
    smoothing: float = 1.0
    table: DataFrame | None = field(default=None, repr=False)
    cells: tuple[pa.Array, np.ndarray] | None = field(default=None, repr=False)
    folder: str | None = None
    # The token blocks and text weights of a training that goes on.
    trained: tuple | None = field(default=None, repr=False, compare=False)

    @property
    def prior(self) -> list[float]:
        total = sum(self.class_weights) + len(self.classes)
        return [math.log((weight + 1) / total) for weight in self.class_weights]

    @property
    def base(self) -> list[float]:
        """Per class: the log of what each word's weight is divided by."""
        return [math.log(weight + self.smoothing * self.vocabulary_size) for weight in self.word_weights]

    @property
    def terms(self) -> DataFrame:
        """The table (word, label, f), without the classes that lack a word."""
        if self.table is None:
            words, matrix = self.cells
            word, label = np.nonzero((matrix > 0) | (len(self.classes) == 1))
            rows = pa.table(
                {
                    "word": words.take(pa.array(word)),
                    "label": pa.array(self.classes, pa.string()).take(pa.array(label)),
                    "f": matrix[word, label],
                }
            )
            self.table = self.spark.createDataFrame(rows, TERMS_SCHEMA)
        return self.table

    def small(self) -> tuple[pa.Array, np.ndarray] | None:
        """Words and weight matrix, or None if the model is too large to send around."""
        if self.cells is None and self.vocabulary_size * len(self.classes) <= MAX_CELLS:
            self.cells = collect_cells(self.terms, self.classes, MAX_CELLS)
        return self.cells

    def save(self, folder: str) -> None:
        self.terms.write.parquet(f"{folder}/terms")
        rows = list(zip(self.classes, self.class_weights, self.word_weights, strict=True))
        totals = self.spark.createDataFrame(rows, "label string, class_weight double, word_weight double")
        totals.withColumns(
            {"vocabulary_size": F.lit(self.vocabulary_size), "smoothing": F.lit(self.smoothing)}
        ).coalesce(1).write.parquet(f"{folder}/classes")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Model:
        totals = spark.read.parquet(f"{folder}/classes").orderBy("label").toArrow().to_pylist()
        return Model(
            spark,
            [row["label"] for row in totals],
            [row["class_weight"] for row in totals],
            [row["word_weight"] for row in totals],
            totals[0]["vocabulary_size"],
            totals[0]["smoothing"],
            spark.read.schema(TERMS_SCHEMA).parquet(f"{folder}/terms"),
        )


def known_places(find: Callable[[pa.Array], np.ndarray], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch of token arrays: which text each known token is in, and its place."""
    found = find(texts.flatten())
    lengths = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
    known = found >= 0
    return np.repeat(np.arange(len(texts)), lengths)[known], found[known]


def word_indexer(spark: SparkSession, words: pa.Array) -> Callable[[Column], Column]:
    """Token arrays to arrays of the places their known words have in ``words``; NULL to an empty one."""
    shared = spark.sparkContext.broadcast(words)

    @F.arrow_udf("array<int>")
    def places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = finder(shared.value)
        for batch in batches:
            parts = [pa.array([], pa.list_(pa.int32()))]
            for texts in token_parts(batch):
                owner, place = known_places(find, texts)
                counts = np.bincount(owner, minlength=len(texts))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("i4"))
                parts.append(pa.ListArray.from_arrays(offsets, pa.array(place.astype("i4"))))
            yield pa.concat_arrays(parts)

    return places


def shared_weights(model: Model) -> Broadcast:
    """The weights of a small model, for :func:`place_scorer`."""
    _, matrix = model.cells
    logs = np.log(matrix + model.smoothing) - np.asarray(model.base)
    return model.spark.sparkContext.broadcast((logs, np.asarray(model.prior)))


def _probabilities(owner: np.ndarray, place: np.ndarray, texts: int, logs: np.ndarray, prior: np.ndarray) -> pa.Array:
    """Class probabilities of texts from the places of their known words."""
    parts = [np.zeros((0, len(prior)))]
    for start in range(0, texts, _TEXTS_PER_STEP):
        size = min(_TEXTS_PER_STEP, texts - start)
        low, high = np.searchsorted(owner, [start, start + size])
        own, at = owner[low:high] - start, place[low:high]
        scores = np.stack([np.bincount(own, column[at], size) for column in logs.T], axis=1) + prior
        shares = np.exp(scores - scores.max(axis=1, keepdims=True))
        parts.append(shares / shares.sum(axis=1, keepdims=True))
    p = np.concatenate(parts)
    offsets = pa.array(np.arange(len(p) + 1, dtype="i4") * len(prior))
    return pa.ListArray.from_arrays(offsets, pa.array(p.ravel()))


def place_scorer(shared: Broadcast) -> Callable[[Column], Column]:
    """Arrays of word places to class probabilities, with the weights sent to every task."""
    @F.arrow_udf("array<double>")
    def probabilities(texts: pa.Array) -> pa.Array:
        logs, prior = shared.value
        owner = np.repeat(np.arange(len(texts)), pc.list_value_length(texts).to_numpy())
        return _probabilities(owner, texts.flatten().to_numpy(), len(texts), logs, prior)

    return probabilities


def text_scorer(model: Model) -> Callable[[Column], Column]:
    """Token arrays to the number of known words and the class probabilities, in one step."""
    words, shared = model.spark.sparkContext.broadcast(model.cells[0]), shared_weights(model)

    @F.arrow_udf("struct<known:int,p:array<double>>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = finder(words.value)
        logs, prior = shared.value
        for batch in batches:
            counts, shares = [pa.array([], pa.int32())], [pa.array([], pa.list_(pa.float64()))]
            for texts in token_parts(batch):
                owner, place = known_places(find, texts)
                counts.append(pa.array(np.bincount(owner, minlength=len(texts)).astype("i4")))
                shares.append(_probabilities(owner, place, len(texts), logs, prior))
            yield pa.StructArray.from_arrays([pa.concat_arrays(counts), pa.concat_arrays(shares)], names=["known", "p"])

    return scored


def _sums_by_word(df: DataFrame, tokens: str, weights: DataFrame, classes: range) -> DataFrame:
    """``print``, ``known`` and ``sums`` of token arrays, from each token's weights."""
    marked = F.concat(F.array(F.lit(None).cast("string")), tokens)
    words = explode_rows(df, marked, "word", fingerprint(F.col(tokens)).alias("print"), nulls=True)
    copies = F.count_if(F.col("word").isNull())
    return (
        lookup_join(words, weights, "left")
        .groupBy("print")
        .agg(
            (F.count("w0") / copies).cast("int").alias("known"),
            F.array(*[F.coalesce(F.sum(f"w{c}"), F.lit(0.0)) / copies for c in classes]).alias("sums"),
        )
    )


def _first_of_each(texts: pa.Table | pa.RecordBatch) -> pa.Table | pa.RecordBatch:
    _, first = np.unique(texts["print"].to_numpy(zero_copy_only=False), return_index=True)
    return texts.take(pa.array(first))


def _without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each print in a batch, so that a text that makes up much of the input moves once a batch."""
    for batch in batches:
        yield _first_of_each(batch)


def _block_words(texts: pa.Table) -> pa.Table:
    words = pc.list_flatten(texts["tokens"]).unique().drop_null()
    return pa.table({"own": pa.repeat(texts["block"][0], len(words)), "word": words})


def _sums_by_block(df: DataFrame, tokens: str, weights: DataFrame, classes: range) -> DataFrame:
    """As :func:`_sums_by_word`; what is joined is each word once for a block of texts that hold it."""
    blocks = (df.agg(F.sum(F.size(tokens))).first()[0] or 0) // _BLOCK_TOKENS + 1
    keyed = df.select(fingerprint(F.col(tokens)).alias("print"), F.col(tokens).alias("tokens"))
    block = F.pmod(F.xxhash64("print"), F.lit(blocks)).cast("int").alias("block")
    texts = keyed.mapInArrow(_without_copies, keyed.schema).select("print", "tokens", block).repartition("block")
    # Each block's words are formed from the same rows that get their weights, so texts move once.
    words = texts.groupBy("block").applyInArrow(_block_words, "own int, word string")
    logs = F.array(*[F.col(f"w{c}") for c in classes]).alias("logs")
    held = words.join(weights, "word").select("own", "word", logs)

    def summed(texts: pa.Table, weights: pa.Table) -> pa.Table:
        texts = _first_of_each(texts)
        tokens, words = texts["tokens"].combine_chunks(), weights["word"].combine_chunks()
        logs = pc.list_flatten(weights["logs"]).to_numpy().reshape(len(words), len(classes))
        known, sums = np.zeros(len(tokens), np.int32), np.zeros((len(tokens), len(classes)))
        find, start = finder(words), 0
        for part in token_parts(tokens):
            owner, place = known_places(find, part)
            end = start + len(part)
            known[start:end] = np.bincount(owner, minlength=len(part))
            for c in classes:
                sums[start:end, c] = np.bincount(owner, logs[:, c][place], len(part))
            start = end
        offsets = pa.array(np.arange(len(tokens) + 1, dtype="i4") * len(classes))
        return pa.table({"print": texts["print"], "known": pa.array(known), "sums": pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))})

    return texts.groupBy("block").cogroup(held.groupBy("own")).applyInArrow(summed, "print string, known int, sums array<double>")


def score_by_join(df: DataFrame, tokens: str, model: Model) -> DataFrame:
    """Add ``known`` and ``p`` by joining exploded tokens with the word weights.

    Texts with the same tokens share their sums, so these are divided by the number of
    such texts, which one extra NULL token per text counts. While the weights are within the
    limits of a broadcast, sums are formed before the shuffle and one short row per text moves;
    beyond them distinct texts are dealt into blocks, and each block gets the weights of its distinct words.
    """
    classes = range(len(model.classes))
    base = model.base
    # NULL tokens count as none.
    df = df.withColumn(tokens, F.coalesce(tokens, F.array().cast("array<string>")))
    weights = wide(model.terms, model.classes).select(
        "word", *[(F.log(F.col("f")[c] + model.smoothing) - F.lit(base[c])).alias(f"w{c}") for c in classes]
    )
    sums = _sums_by_word(df, tokens, weights, classes) if fits(weights) else _sums_by_block(df, tokens, weights, classes)
    keyed = df.withColumn("print", fingerprint(F.col(tokens)))
    joined = keyed.join(sums, "print", "left").drop("print")
    start = F.array(*[F.lit(value) for value in model.prior])
    scored = joined.withColumn("_scores", F.zip_with("sums", start, lambda left, right: left + right))
    shares = scored.withColumn(
        "_shares",
        F.transform("_scores", lambda score: F.exp(score - F.array_max("_scores"))),
    )
    total = F.aggregate("_shares", F.lit(0.0), lambda left, right: left + right)
    return (
        shares.withColumn("_total", total)
        .withColumn("p", F.transform("_shares", lambda share: share / F.col("_total")))
        .drop("sums", "_scores", "_shares", "_total")
    )


def with_distribution(df: DataFrame, model: Model, tokens: str = "tokens", binary: bool = True) -> DataFrame:
    """Add ``known``, the number of known words, and ``p``, the probabilities in the order
    of ``model.classes``. With ``binary`` repeats of a word count once.
    """
    seen = F.array_distinct(tokens) if binary else F.col(tokens)
    if model.small() is not None:
        scored = df.withColumn("_scored", text_scorer(model)(seen))
        return scored.withColumns({"known": F.col("_scored.known"), "p": F.col("_scored.p")}).drop("_scored")
    return score_by_join(df.withColumn("_seen", seen), "_seen", model).drop("_seen")


def ranked_classes(model: Model) -> Column:
    """Structs (class, p) of all classes, most probable first, then by class name."""
    names = F.array(*[F.lit(name) for name in model.classes])
    pairs = F.zip_with("p", names, lambda p, name: F.struct((-p).alias("rank"), name.alias("class")))
    return F.transform(
        F.array_sort(pairs), lambda pair: F.struct(pair["class"].alias("class"), (-pair["rank"]).alias("p"))
    )


def with_top_classes(scored: DataFrame, model: Model) -> DataFrame:
    """Add ``pred_classes`` and ``pred_values`` of the three most probable classes.

    A text without known words gets them too, by the classes' prior.
    """
    top = scored.withColumn("_top", F.slice(ranked_classes(model), 1, RANKED_CLASSES))
    return top.withColumns({"pred_classes": F.col("_top.class"), "pred_values": F.col("_top.p")}).drop("_top")


def with_best_class(scored: DataFrame, model: Model) -> DataFrame:
    """Add ``classid`` and ``cvalue``; a text without known words gets a fixed answer."""
    best = scored.withColumn("_best", ranked_classes(model)[0])
    known = F.col("known") > 0
    return best.withColumns(
        {
            "classid": F.when(known, F.col("_best.class")).otherwise(F.lit(NO_WORDS_CLASS)),
            "cvalue": F.when(known, F.col("_best.p")).otherwise(F.lit(0.0)),
        }
    ).drop("_best")
