"""Near-duplicate documents by min-max hashing.

A document is the set of its shingles. Each permutation of the shingles' keys is evaluated once and
gives two signature values, its least and its greatest; both agree between two sets as often
as the sets are similar, so half the evaluations do. Values are banded, and documents that share a
band are candidates.

Candidates are linked on their whole sets:

* Documents with equal sets are one class, represented by its smallest id.
* Bands deal the representatives into buckets. A bucket hangs its members on one of them, never
  forming all pairs, and the components of these edges are *clusters*: every candidate pair
  lies within one.
* A cluster's sets meet in groups of at most ``GROUP`` documents, where all pairs are measured as a matrix
  product. A larger cluster is dealt into such groups, each with the same few well-connected members, so that
  what links to those is joined. Members outside the largest component are then compared with all
  others, group by group; that covers every pair which could still join two components.

With bands of ``ROWS`` values the chance that a pair at the threshold shares none is
``(1 - 0.8 ** ROWS) ** BANDS``, about 1e-4 at the settings here, and falls steeply above it.

Defined cases: a NULL or empty text has no shingles and is linked with nothing. A NULL id takes no part:
its component is NULL and the row is kept. Rows that share an id are one node. Empty tables give no
rows. Other columns are ignored, or carried as a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvetch.llm.common import components, mix, release, released, slices, text_bytes, word_keys, written

SHINGLE = 4
PERCENT = 80
BANDS = 40
ROWS = 7
# Documents that one task compares at once, and the shingles they may hold on average.
GROUP = 384
GROUP_SHINGLES = 1_500_000
PIVOTS = 8


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The distinct shingle keys of each text, ascending."""
    keys, bounds = word_keys(*text_bytes(texts))
    steps = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93] * size, np.uint64)
    steps = steps[:size] + np.arange(size, dtype=np.uint64) * np.uint64(1 << 20)
    joined = keys * steps[0]
    for k in range(1, size):
        joined[:-k] += keys[k:] * steps[k]
    joined = mix(joined)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = end - begin
        if n >= size:
            yield np.unique(joined[begin : end - size + 1])
        elif n:
            # Fewer words: the sequence as one, apart from all shingles by its length.
            yield mix((keys[begin:end] * steps[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    factors = mix(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)
    return factors, mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def signature(keys: np.ndarray, count: int) -> np.ndarray:
    """Least and greatest of each permutation of the keys, ``count`` of either."""
    factors, shifts = permutations(count)
    # The upper half of a product takes part in every bit of the key below it.
    low, high = np.full(count, 2**32 - 1, np.uint32), np.zeros(count, np.uint32)
    step = max(1, (1 << 18) // count)
    for at in range(0, len(keys), step):
        values = ((keys[at : at + step, None] * factors + shifts) >> np.uint64(32)).astype(np.uint32)
        low, high = np.minimum(low, values.min(0)), np.maximum(high, values.max(0))
    return np.concatenate([low, high])


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key per band; neighbouring bands take values of different permutations."""
    table = values.astype(np.uint64).reshape(-1)[: bands * rows].reshape(rows, bands)
    out = np.arange(bands, dtype=np.uint64)
    for row in table:
        out = mix(out + row)
    return out


def signatures(documents: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, a digest of the set and the bands' keys of each document."""
    count = -(-bands * rows // 2)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part in slices(batch, "text", 1 << 20):
                sizes, digests, bands_of = [], [], []
                for keys in shingle_sets(part.column("text"), size):
                    sizes.append(len(keys))
                    both = (mix(keys + np.uint64(1)).sum(), mix(keys ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(), len(keys))
                    digests.append(np.array(both, np.uint64).tobytes())
                    bands_of.append(band_keys(signature(keys, count), bands, rows).view(np.int64))
                values = pa.array(np.concatenate(bands_of) if bands_of else np.zeros(0, np.int64))
                ends = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.ListArray.from_arrays(ends, values)],
                    names=["doc_id", "n_shingles", "digest", "bands"],
                )

    return documents.mapInArrow(signed, "doc_id long, n_shingles long, digest binary, bands array<long>")


def links(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which of the sets are similar enough, as a matrix."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A shingle of one set only is in no intersection.
    several = count > 1
    place = np.cumsum(several) - 1
    pick = several[at]
    owner, at = owner[pick], place[at[pick]]
    common = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    step = 4096
    for lo in range(0, int(several.sum()), step):
        a, b = np.searchsorted(at, [lo, lo + step])
        table = np.zeros((len(sets), step), np.float32)
        table[owner[a:b], at[a:b] - lo] = 1
        common += table @ table.T
    both = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= percent * both


def spanning(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges from each id to the smallest one its component reaches."""
    order = np.argsort(ids, kind="stable")
    linked, ids = linked[np.ix_(order, order)], ids[order]
    root = np.full(len(ids), -1)
    for k in range(len(ids)):
        if root[k] >= 0:
            continue
        seen = np.zeros(len(ids), bool)
        seen[k] = True
        front = seen
        while front.any():
            front = linked[front].any(0) & ~seen
            seen |= front
        root[seen] = k
    return [(int(ids[k]), int(ids[r])) for k, r in enumerate(root) if ids[k] != ids[r]]


def joined_groups(members: DataFrame, percent: int) -> DataFrame:
    """Edges ``a``, ``b`` that join the similar documents of each group (``cluster``, ``slot``, ``doc_id``, ``keys``)."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2

    def compared(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("slot", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        cluster, slot, ids = (table[x].to_numpy() for x in ("cluster", "slot", "doc_id"))
        keys = table["keys"].combine_chunks()
        heads = np.flatnonzero(np.concatenate([[True], (cluster[1:] != cluster[:-1]) | (slot[1:] != slot[:-1])]))
        edges: list[tuple[int, int]] = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(ids)], strict=True):
            if b - a > 1:
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in keys[a:b]]
                edges += spanning(ids[a:b], links(sets, percent))
        release()
        return pa.table([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    dealt = members.select("cluster", "slot", "doc_id", "keys").withColumn(
        "part", F.pmod(F.xxhash64("cluster", "slot"), F.lit(parts)).cast("int")
    )
    return dealt.groupBy("part").applyInArrow(compared, "a long, b long")


def clusters(signed: DataFrame) -> DataFrame:
    """``doc_id``, ``cluster`` and ``degree`` of the documents that share a band with another."""
    keys = signed.select("doc_id", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.count("*").alias("n"), F.min("doc_id").alias("pivot")).where("n > 1")
    edges = written(
        keys.join(buckets, "band").groupBy("doc_id", "pivot").agg(F.sum("n").alias("degree")), "bands"
    )
    roots = components(edges.select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")))
    degrees = edges.groupBy("doc_id").agg(F.sum("degree").alias("degree"))
    return degrees.join(roots, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("cluster"), "degree"
    )


def linked_edges(documents: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges that join all documents linked directly or by others."""
    found = written(clusters(signed), "clusters")

    def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part in slices(batch, "text", 1 << 20):
                keys = [x.tobytes() for x in shingle_sets(part.column("text"), size)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in ("doc_id", "cluster", "degree")), pa.array(keys, pa.binary())],
                    names=["doc_id", "cluster", "degree", "keys"],
                )

    # Candidates grow with the documents and aren't broadcast at any size.
    sets = written(
        documents.join(found.hint("merge"), "doc_id").select("doc_id", "cluster", "degree", "text").mapInArrow(
            with_keys, "doc_id long, cluster long, degree long, keys binary"
        ),
        "sets",
    )
    totals = sets.groupBy("cluster").agg(F.count("*").alias("members"), F.sum(F.octet_length("keys") / 8).alias("shingles"))
    slots = F.greatest(F.ceil(F.col("members") / GROUP), F.ceil(F.col("shingles") / GROUP_SHINGLES))
    dealt = sets.join(totals, "cluster").withColumn("slots", slots).withColumn(
        "slot", F.pmod(F.xxhash64("doc_id"), F.col("slots"))
    )
    # In a cluster of several groups, the best connected member of each of a few hash classes joins them all.
    best = (
        dealt.where("slots > 1").groupBy("cluster", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PIVOTS)).alias("class"))
        .agg(F.max_by("doc_id", F.struct("degree", F.negate("doc_id"))).alias("doc_id")).select("cluster", "doc_id")
    )
    pivots = dealt.join(best, ["cluster", "doc_id"], "left_semi").withColumn(
        "slot", F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1), lambda k: k != F.col("slot")))
    )
    columns = ["cluster", "slot", "doc_id", "keys"]
    edges = written(joined_groups(dealt.select(*columns).union(pivots.select(*columns)), percent), "links")

    large = totals.where(slots > 1).select("cluster", slots.alias("slots"))
    if large.isEmpty():
        return edges
    # Several groups: members outside the largest component meet everyone.
    roots = components(edges)
    placed = sets.join(large, "cluster").join(roots, F.col("doc_id") == F.col("node"), "left").select(
        "cluster", "slots", "doc_id", "keys", F.coalesce("root", "doc_id").alias("root")
    )
    counted = placed.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    largest = counted.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    outside = F.col("root") != F.col("largest")
    placed = placed.join(largest, "cluster")
    rest = placed.where(outside).groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / GROUP), F.ceil(F.sum(F.octet_length("keys") / 8) / GROUP_SHINGLES)).alias("rows")
    )
    placed = placed.join(rest, "cluster")
    own = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("rows"))
    column = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("slots"))

    def steps(n: str):
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    strip = placed.where(outside).select("cluster", F.explode(F.transform(steps("slots"), lambda k: own * F.col("slots") + k)).alias("slot"), "doc_id", "keys")
    field = placed.select("cluster", F.explode(F.transform(steps("rows"), lambda k: k * F.col("slots") + column)).alias("slot"), "doc_id", "keys")
    # A document of the strip may meet itself; once is enough.
    pairs = strip.union(field).dropDuplicates(["cluster", "slot", "doc_id"])
    return edges.union(joined_groups(pairs, percent))


def near_duplicates(
    documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each document (``doc_id``, ``text``)."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(signatures(texts, size, bands, rows), "signatures")
    known = signed.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min_by("bands", "doc_id").alias("bands"))
    # Copies hang on the first of their class.
    copies = known.join(classes.select("digest", "first"), "digest").where("doc_id <> first").select(
        F.col("doc_id").alias("a"), F.col("first").alias("b")
    )
    firsts = classes.select(F.col("first").alias("doc_id"), "bands")
    edges = linked_edges(texts, firsts, size, percent)
    roots = components(edges.union(copies))
    return signed.join(roots, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one of each group, with their columns."""
    gone = near_duplicates(documents, size, percent).where(~F.col("kept")).select("doc_id").distinct()
    return documents.join(gone.hint("merge"), "doc_id", "left_anti").select(*documents.columns)
