"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.session import scratch_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Text bytes that one step of a task works on, unless a single text is longer.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; no other character changes."""
    return F.translate(text, UPPER, UPPER.lower())


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks_of(df: DataFrame, *keys: str, factor: int = 2) -> DataFrame:
    """Add ``block``, dealt by a hash of ``keys``: ``factor`` blocks for each shuffle partition.

    As ``spark.sql.shuffle.partitions`` follows the input, so does the number of blocks, and
    a block stays within a task's memory.
    """
    count = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * factor)
    return df.withColumn("block", F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(count)).cast("int"))


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and where each starts (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    n, at = len(texts), texts.offset
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1, at * 8)
    start, end = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8, end - start, start) if end > start else np.zeros(0, np.uint8)
    return data, offsets - start


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` text bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def release() -> None:
    """Give freed memory back to the system, as a worker goes on to serve other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task's input; when they end, freed memory is given back."""
    for batch in batches:
        yield batch
        del batch
        release()


def trimmed(work: Callable[..., pa.Table], *given: object) -> pa.Table:
    """What ``work`` returns; what it held meanwhile is given back, also after a task's last group."""
    out = work(*given)
    release()
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0]+1, ... counts[0] values, starts[1], ...``."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - begin, counts)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, the way they compress best when most are small."""
    return np.ascontiguousarray(np.asarray(values, np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as planes of their differences."""
    keys = np.asarray(keys, np.uint64)
    return planes(np.diff(keys, prepend=np.uint64(0)).view(np.int64))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw).view(np.uint64), dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in ascending 64-bit keys, dealt by range; one more at the end."""
    step = (1 << 64) // buckets + 1
    edges = np.array([min(k * step, (1 << 64) - 1) for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_keys(data: np.ndarray, starts: np.ndarray, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the words of texts, and where each text's words start in them.

    Words are what stands between ASCII white space, A-Z counting as a-z. Equal words have
    equal keys; of n distinct words, n * n / 2**65 pairs are expected to share one.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    black = ~_SPACE[data]
    first = black.copy()
    first[1:] &= ~black[:-1]
    # A text's first byte begins a word even where the text before ends in one.
    heads = starts[:-1][starts[:-1] < n]
    first[heads] = black[heads]
    where = np.flatnonzero(first)
    bounds = np.searchsorted(where, starts)
    solid = np.flatnonzero(black)
    begin = np.searchsorted(solid, where)
    sizes = np.diff(begin, append=len(solid))
    out = np.zeros(len(where), np.uint64)
    if len(where) == 0:
        return out, bounds
    powers = np.full(int(sizes.max()), _MULTIPLIER)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    at = 0
    while at < len(where):
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + step)))
        lo = int(begin[at])
        hi = int(begin[to]) if to < len(where) else len(solid)
        place = np.arange(hi - lo) - np.repeat(begin[at:to] - lo, sizes[at:to])
        values = _BYTE_VALUES[_LOWER[data[solid[lo:hi]]]] * powers[place]
        out[at:to] = np.add.reduceat(values, begin[at:to] - lo)
        at = to
    return mix(out + sizes.astype(np.uint64)), bounds


def sorted_rows(table: pa.Table, *keys: str) -> pa.Table:
    """Rows in an order that doesn't depend on how they arrived."""
    return table.sort_by([(key, "ascending") for key in keys]).combine_chunks()


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the smallest node each can reach along them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a few batches by as many stars as they have components."""
    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1))
        nodes, roots = local_roots(a, b)
        away = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(roots[away])], names=["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 1_000_000:
            yield star(held)
            held, rows = [], 0
    if held:
        yield star(held)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable along edges (``a``, ``b``); roots have no row.

    Alternating stars: neighbours larger than a node are hung on the smallest one, then those
    smaller, until nothing moves. A round is a table written to the shared folder. Minima are
    formed before the shuffle and the joins may be split, so a node may have any number of edges.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    stars = both.mapInArrow(_contracted, "a long, b long")

    def step(stars: DataFrame) -> DataFrame:
        # Large star: from each node's larger neighbours to the smallest of all.
        there = stars.select("a", "b").union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = there.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            there.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        # Small star: every edge points down; a node's smaller neighbours go to the smallest of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lowest, "a")
        return (
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )

    def mark(stars: DataFrame) -> tuple:
        return tuple(stars.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.countDistinct("a")).first())

    stars = written(stars.mapInArrow(_contracted, "a long, b long").distinct(), "stars")
    seen = mark(stars)
    for _ in range(rounds):
        # Each node once, and no root hangs on another: done.
        if seen[0] == seen[2] and stars.select(F.col("b").alias("a")).join(stars, "a", "left_semi").isEmpty():
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        stars = written(step(stars), "stars")
        seen = mark(stars)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def text_digest(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes as 32 bytes; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Rows with the columns of their group; ``groups`` holds each ``key`` once, with its number of rows in ``size``.

    Groups of more than a 2 * partitions-th of all rows are fewer than 2 * partitions, whatever the data: those are
    broadcast, and their rows are dealt evenly past the shuffle that joins the others. ``groups`` is read three times.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    limit = total // (2 * parts) + 1
    values = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) > limit).select(F.col(key).alias("_key"), F.struct(*values).alias("_hot"))
    cold = groups.where(F.col(size) <= limit).select(F.col(key).alias("_key"), F.struct(*values).alias("_cold"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_key"), "left").drop("_key")
    # A key longer than any other joins with nothing and spreads a hot group's rows.
    past = F.concat(F.col(key), F.lit(":").cast("binary"), F.monotonically_increasing_id().cast("string").cast("binary"))
    marked = marked.withColumn("_at", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(past))
    joined = marked.join(cold, F.col("_at") == F.col("_key"), "left").withColumn("_of", F.coalesce("_hot", "_cold"))
    if how == "inner":
        joined = joined.where(F.col("_of").isNotNull())
    return joined.select(*rows.columns, *[F.col(f"_of.{c}").alias(c) for c in values])
