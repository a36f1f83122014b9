"""Language-model scores from a weighted backoff automaton.

States are histories: the empty one, the single tokens (or longer runs, by ``order``) and the start of a text. A state
has an arc for each token that followed it in training, and a failure arc to the state of the shorter history. The
weights are Dirichlet-smoothed probabilities. With c the counts of training and K = ``strength``,

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h w) + K * p(w | shorter h)) / (c(h) + K)

so an unseen token costs the failure arc's K / (c(h) + K) and then the shorter state's arc; probabilities of a state sum to
one, with one share of p(w) for all unknown tokens. A text is read once from left to right, the state being its last
tokens; the log10 weights of the arcs taken add up to its score.

The automaton of a large corpus fits no single machine, so its arcs stay where they are counted. Documents are dealt into
blocks. Each block counts its distinct n-grams and sends them to buckets by key, once each; a bucket adds up the counts of
all blocks and sends each block the totals of just the n-grams it asked for. With these arcs the block walks its texts,
all at once. Nothing but the two totals N and V is the same everywhere; they are sums over buckets.
Text is shuffled once; a frequent word is one entry per block.

n-grams travel as hashes: words with 64 bits, longer ones with ``GRAM_BITS``; of n distinct ones, n * n / 2**(bits + 1)
pairs are expected to be confused.

Defined cases: a NULL or empty text is the end token alone. A NULL id isn't held out. Repeated rows and ids count each
time. Without training texts all counts are 0. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvetch.llm.common import (
    blocks_of, bucket_cuts, from_planes, mix, packed_keys, planes, release, sorted_rows, text_bytes, unpacked_keys, word_keys,
)

ORDER = 2
STRENGTH = 64.0
GRAM_BITS = 54
START, END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0x1B873593CC9E2D51)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


class Block:
    """A block's tokens as keys, each text with its start in front and its end behind, and n-grams of each length."""

    def __init__(self, table: pa.Table, order: int) -> None:
        self.table = sorted_rows(table, "doc_id", "text", "held_out")
        words, bounds = word_keys(*text_bytes(self.table["text"]))
        n = np.diff(bounds)
        self.starts = np.concatenate([[0], np.cumsum(n + 2)])
        tokens = np.empty(self.starts[-1], np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[self.starts[:-1]] = inner[self.starts[1:] - 1] = False
        tokens[self.starts[:-1]], tokens[self.starts[1:] - 1], tokens[inner] = START, END, words
        self.tokens = tokens
        self.scored = np.ones(len(tokens), bool)
        self.scored[self.starts[:-1]] = False
        train = ~self.table["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        self.train = np.repeat(train, n + 2)
        # How many tokens of its text stand before each one.
        place = np.arange(len(tokens)) - np.repeat(self.starts[:-1], n + 2)
        self.grams, keys = [], tokens
        shift = np.uint64(64 - GRAM_BITS)
        for size in range(1, order + 1):
            if size > 1:
                longer = keys.copy()
                longer[1:] = mix(keys[:-1] * np.uint64(0x9E3779B97F4A7C15) + tokens[1:] + np.uint64(size))
                keys = longer
            # A gram starts no earlier than its text; the start itself counts as a history, not as a token.
            whole = place >= size - 1
            kept, inverse = np.unique(keys[whole] if size == 1 else keys[whole] >> shift, return_inverse=True)
            counts = np.bincount(inverse, weights=self.train[whole], minlength=len(kept)).astype(np.int64)
            self.grams.append((kept if size == 1 else kept << shift, counts, whole, inverse))


def squeezed(raw: bytes) -> bytes:
    """Planes of bytes by their entropy: most hold few different values, but no repeats that a faster codec would find."""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unsqueezed(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


REQUEST = "block int, bucket int, keys array<binary>, counts array<binary>"


def requests(table: pa.Table, buckets: int, order: int) -> pa.Table:
    """A block's distinct n-grams with their counts in its training texts: a row per bucket, n-grams by size."""
    block, rows = Block(table, order), []
    number = table["block"][0].as_py()
    cuts = [bucket_cuts(keys, buckets) for keys, _, _, _ in block.grams]
    shifts = [np.uint64(0 if size == 0 else 64 - GRAM_BITS) for size in range(order)]
    for k in np.flatnonzero(sum(map(np.diff, cuts))).tolist():
        parts = [slice(c[k], c[k + 1]) for c in cuts]
        rows.append((
            number, k, [squeezed(packed_keys(g[0][s] >> shift)) for g, s, shift in zip(block.grams, parts, shifts, strict=True)],
            [squeezed(planes(g[1][s])) for g, s in zip(block.grams, parts, strict=True)],
        ))
    lists = pa.list_(pa.binary())
    return table_of(rows, [pa.int32(), pa.int32(), lists, lists], ["block", "bucket", "keys", "counts"])


def table_of(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _merged(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of one size that a bucket has, and their counts over all blocks, added block by block."""
    keys, counts = ([row[size].as_py() for row in table[name]] for name in ("keys", "counts"))
    merged = np.unique(np.concatenate([unpacked_keys(unsqueezed(raw)) for raw in keys]))
    total = np.zeros(len(merged), np.int64)
    for raw, count in zip(keys, counts, strict=True):
        total[np.searchsorted(merged, unpacked_keys(unsqueezed(raw)))] += from_planes(unsqueezed(count))
    return merged, total


def shares(table: pa.Table) -> pa.Table:
    """A bucket's share of N and V."""
    merged, total = _merged(table, 0)
    total = total[merged != START]
    return pa.table({"tokens": pa.array([int(total.sum())]), "kinds": pa.array([int((total > 0).sum())])})


def totals(table: pa.Table) -> pa.Table:
    """For each block's n-grams of a bucket the counts over all blocks.

    One size of n-grams at a time, and of it one block at a time: only the distinct ones of the bucket are held unpacked.
    """
    replies = [[] for _ in range(table.num_rows)]
    for size in range(len(table["keys"][0])):
        merged, total = _merged(table, size)
        for row, reply in zip(table["keys"], replies, strict=True):
            reply.append(squeezed(planes(total[np.searchsorted(merged, unpacked_keys(unsqueezed(row[size].as_py())))])))
    bucket = table["bucket"][0].as_py()
    rows = [(block, bucket, reply) for block, reply in zip(table["block"].to_pylist(), replies, strict=True)]
    del merged, total, replies
    release()
    return table_of(rows, [pa.int32(), pa.int32(), pa.list_(pa.binary())], ["block", "bucket", "counts"])


def scores(text: pa.Table, replies: pa.Table, order: int, strength: float) -> pa.Table:
    """Walk the texts of a block along the arcs."""
    block = Block(text, order)
    all_tokens, kinds = (replies[x][0].as_py() for x in ("all_tokens", "all_kinds"))
    told = replies.sort_by("bucket")["counts"].to_pylist()
    counts = {size: [from_planes(unsqueezed(x[size - 1])) for x in told] for size in range(1, order + 1)}
    before = None
    for size, (_, _, whole, inverse) in enumerate(block.grams, 1):
        # The count of the gram that ends at each place; 0 where the text is shorter.
        count = np.zeros(len(block.tokens))
        count[whole] = np.concatenate(counts[size])[inverse]
        if size == 1:
            known = count > 0
            p = (count + 1) / (all_tokens + kinds + 1)
            base = np.log10(count + 1)
        else:
            # The state before each token, and its arc or its failure arc to what p says so far.
            state = np.concatenate([[0], before[:-1]])
            p = np.where(whole, (count + strength * p) / (state + strength), p)
        before = count
    log_p = np.log10(p)
    scored = block.scored

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.where(scored, values, 0), block.starts[:-1])

    n = np.diff(block.starts) - 1
    return pa.table(
        [block.table["doc_id"], block.table["held_out"], pa.array(n), pa.array(per_text(known.astype(np.int64))),
         pa.array(np.full(len(n), all_tokens)), pa.array(per_text(base) - n * np.log10(all_tokens + kinds + 1)), pa.array(per_text(log_p))],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def score(documents: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """Scores of all documents (``doc_id``, ``text``) under the model of those that aren't held out."""
    dealt = blocks_of(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out")),
        "doc_id", "text",
    )
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_block = dealt.groupBy("block")

    def ask(table: pa.Table) -> pa.Table:
        release()  # what the group before has left
        return requests(table, buckets, order)

    def answer(text: pa.Table, replies: pa.Table) -> pa.Table:
        release()
        return scores(text, replies, order, strength)

    asked = by_block.applyInArrow(ask, REQUEST)
    # Both read the same shuffle, the first only the single tokens in it.
    corpus = asked.groupBy("bucket").applyInArrow(shares, "tokens long, kinds long").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("all_kinds")
    )
    answered = asked.groupBy("bucket").applyInArrow(totals, "block int, bucket int, counts array<binary>")
    told = answered.withColumns({
        "all_tokens": corpus.select("all_tokens").scalar(), "all_kinds": corpus.select("all_kinds").scalar(),
    })
    return by_block.cogroup(told.groupBy("block")).applyInArrow(
        answer,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
