"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins. Boosting goes round the features in turn, each time fitting
a shallow tree to the gradient of the logistic loss, and the trees of a feature add up to one
lookup table over its bins. Then the pairs of features with the most left to explain get tables
over their joint bins in the same way. A score is the sum of the tables' entries, through the
logistic function.

Features come from whole texts in one pass without a shuffle. The tables are fitted on at most
``SAMPLE_ROWS`` labelled rows, those with the smallest hash of their id, which is all that reaches
the driver; scoring adds table entries for a batch at a time.

Defined cases: a NULL or empty text has all features 0 and gets a score like any other. Labels that
are NULL or belong to no document aren't learned from; a document with several labels counts with
each. Without labelled rows every score is 0.5; with one class only, scores lie near that class.
Repeated rows get equal scores; a NULL id counts as not held out. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvetch.llm.common import released, slices, text_bytes

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 80
RATE = 0.15
LEAF_ROWS = 5
RIDGE = 1.0

FEATURES = [
    "log_bytes", "log_words", "upper", "digits", "marks", "bars", "symbols", "stops", "lines", "wide",
    "word_size", "distinct_words", "repeated_words", "repeated_lines", "longest_word", "capitals",
]

# Classes of bytes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 white space, 5 line end, 6 "!", 7 "|",
# 8 symbols, 9 stops, 10 bytes of characters beyond ASCII.
CLASSES = np.zeros(256, np.uint8)
for _k, _chars in enumerate(
    [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b"!", b"|",
     b"#$%&*+<=>@^_`~{}[]\\/", b".,;:?\"'()-"], 1,
):
    CLASSES[list(_chars)] = _k
CLASSES[128:] = 10


def features_of(raw: bytes) -> list[float]:
    """The features of one text."""
    n = len(raw)
    if n == 0:
        return [0.0] * len(FEATURES)
    count = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=11).tolist()
    words = raw.split()
    k = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x]
    letters = max(count[1] + count[2], 1)
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), count[2] / letters, count[3] / n, count[6] / k, count[7] / k,
        count[8] / k, count[9] / k, count[5] / k, count[10] / n, (n - count[4] - count[5]) / k, len(set(words)) / k,
        sum(map(bytes.__eq__, words, words[1:])) / k, 1 - len(set(lines)) / max(len(lines), 1),
        float(np.log1p(max(map(len, words), default=0))), sum(map(bytes.isupper, words)) / k,
    ]


def feature_matrix(texts: pa.Array) -> np.ndarray:
    data, starts = text_bytes(texts)
    raw = data.tobytes()
    rows = [features_of(raw[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


@dataclass
class Model:
    """Cuts of each feature, its table, and the tables of pairs over coarser bins."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, j], "right")]
        coarse = [np.searchsorted(cuts, x[:, j], "right") for j, cuts in enumerate(self.pair_cuts)]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def cuts_of(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(nl < LEAF_ROWS) | (n.sum() - nl < LEAF_ROWS)] = -1
    if len(gain) == 0 or gain.max() <= 0:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values of a shallow tree over the bins of one feature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*best_cut(g[a:b], h[a:b], n[a:b]), a, b) for a, b in parts]
        gain, cut, a, b = max(found)
        if gain <= 0:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree with a cut of one feature and a cut of the other on each side."""
    best = (0.0, np.zeros_like(g))
    for flip in (False, True):
        gg, hh, nn = (x.T if flip else x for x in (g, h, n))
        for cut in range(1, len(gg)):
            out, gain = np.zeros_like(gg), 0.0
            for a, b in ((0, cut), (cut, len(gg))):
                sums = [x[a:b].sum(0) for x in (gg, hh, nn)]
                _, at = best_cut(*sums)
                for c, d in ((0, at), (at, gg.shape[1])) if at else ((0, gg.shape[1]),):
                    s, t = sums[0][c:d].sum(), sums[1][c:d].sum()
                    gain += s**2 / (t + RIDGE)
                    out[a:b, c:d] = s / (t + RIDGE)
            gain -= g.sum() ** 2 / (h.sum() + RIDGE)
            if gain > best[0] + 1e-12:
                best = (gain, out.T if flip else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on the rows' features and labels."""
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if len(y) == 0:
        return Model(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width, [], [np.zeros(0)] * width, [])
    rate = np.clip(y.mean(), 1 / (len(y) + 2), 1 - 1 / (len(y) + 2))
    base = float(np.log(rate / (1 - rate)))
    cuts = [cuts_of(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    counts = [np.bincount(b, minlength=len(c) + 1) for b, c in zip(bins, cuts, strict=True)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slope()
            k = len(tables[j])
            step = RATE * tree(np.bincount(bins[j], g, k), np.bincount(bins[j], h, k), counts[j])
            tables[j] += step
            total += step[bins[j]]

    coarse_cuts = [cuts_of(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(coarse_cuts)]

    def grids(a: int, b: int) -> tuple[np.ndarray, ...]:
        g, h = slope()
        shape = (len(coarse_cuts[a]) + 1, len(coarse_cuts[b]) + 1)
        cell, size = coarse[a] * shape[1] + coarse[b], shape[0] * shape[1]
        return tuple(np.bincount(cell, w, size).reshape(shape) for w in (g, h, None))

    gains = [(pair_tree(*grids(a, b))[0], a, b) for a in range(width) for b in range(a + 1, width)]
    pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((len(coarse_cuts[a]) + 1, len(coarse_cuts[b]) + 1)) for a, b in pairs]
    for _ in range(ROUNDS // 4):
        for k, (a, b) in enumerate(pairs):
            step = RATE * pair_tree(*grids(a, b))[1]
            pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return Model(base, cuts, tables, pairs, coarse_cuts, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Whether a document may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents that aren't held out.

    The bound holds for labels and for the rows they belong to, so that an id on many rows brings no more to the driver.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    found = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "quality")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part in slices(batch, "text", 1 << 20):
                rows = feature_matrix(part.column("text"))
                values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), values, part.column("quality")], names=["doc_id", "x", "quality"])

    schema = T.StructType([found.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType())), found.schema["quality"]])
    first = found.mapInArrow(measured, schema).orderBy(F.xxhash64("doc_id"), "doc_id", "x", "quality").limit(sample_rows)
    rows = first.select("x", "quality").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    y = rows["quality"].to_numpy().astype(np.float64)
    # Sums of floats depend on the order of rows, which a cluster doesn't fix.
    order = np.lexsort([*x.T, y])
    return fit(x[order], (y[order] > 0).astype(np.float64))


def with_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents with the column ``name``; ``text`` has to be among theirs, ``name`` not."""
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])
    names = schema.names

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part in slices(batch, "text", 1 << 20):
                score = pa.array(model.score(feature_matrix(part.column("text"))))
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=names)

    return documents.mapInArrow(scored, schema)


def classify(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document."""
    model = train(documents, labels)
    return with_score(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that aren't rejected, with their columns."""
    name = max([*documents.columns, "score"], key=len) + "_"  # longer than any other
    scored = with_score(documents, train(documents, labels), name)
    return scored.where(F.col(name) >= threshold).select(*documents.columns)
