"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one class; only classes are searched, so a vector that makes up a third of the table costs as much as any
other. Then

1. *Shards.* Centroids are fitted on at most ``SAMPLE`` classes (the smallest hashes). Each class belongs to the shards of its
   ``OVERLAP`` nearest centroids. What each shard holds is counted: members are dealt by hash into parts of about ``PART * SHARD``,
   queries into turns of about ``TURN * SHARD``, so a task has a part and a turn however dense the vectors lie.
2. *Build.* In each part every vector gets candidates (near ones and a few at random), of which robust pruning keeps those that no
   kept one stands in front of; reverse edges are added.
3. *Union.* The adjacency lists of a class from all its shards are united.
4. *Search.* Each class is a query to the shards of its ``PROBES`` nearest centroids: a greedy search walks the united graph from the
   parts' medoids, and when it stands in range of the query it goes on to everything in range that it can reach.
5. *Verify* each hit by the cosine in double precision, and *audit*: blocks of classes, the first of ``AUDIT``, are compared with all
   vectors until ``AUDIT_LINKS`` true links or ``AUDITED`` classes are seen. Where that leaves too few links to measure the search by,
   ``PLANTED`` classes of each length get a planted partner each, turned away from them by a cosine between the threshold and 1, which
   is searched for like all others but belongs to no part. If the recall is below ``RECALL``, shards, probes and beam are
   widened and the search runs again. Only if it still is after ``ROUNDS`` rounds are the remaining classes compared with all as
   well, in blocks. The links are those that the search found, and those the audit saw.

Links are emitted once per pair of classes, never per pair of copies.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing; so do rows with a NULL
id, whose component is NULL and which are kept. Vectors of different lengths don't link. Repeated rows count as further vectors;
rows that share an id but not a vector share a component only by links. Classes are told apart by 64-bit hashes of their bytes.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.llm.common import components, ranges, written

COSINE = 0.9
SAMPLE = 20_000
SHARD = 1_500
MAX_CENTROIDS = 2_048
OVERLAP = 2
PROBES = 4
NEAR = 40
RANDOM = 12
DEGREE = 24
MAX_DEGREE = 64
ALPHA = 1.2
BEAM = 32
STRIDE = 4
# Members of a part and queries of a turn, in shards' sizes; an even shard has OVERLAP and PROBES of them.
PART = 3
TURN = 6
# Rows that are dealt out at once.
DEALT = 20_000
SLACK = 0.08
AUDIT = 200
AUDIT_LINKS = 100
AUDITED = 4_000
PLANTED = 400
# Most classes that are compared with all at once, and most cosines in memory.
ASKED = 4_000
COSINES = 4_000_000
RECALL = 0.98
ROUNDS = 3
QUERIES = 1_000


def vector_rows(table: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    """Rows of doubles from a column of their bytes, all of one length."""
    raw = b"".join(table.column(column).to_pylist())
    return np.frombuffer(raw, np.float64).reshape(table.num_rows, -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, from a scale where squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and the components' bytes; NULL bytes where a vector can't be compared."""
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("embedding"):
                row = None if not value.is_valid or value.values.null_count else value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                good = row is not None and len(row) and np.isfinite(row).all() and row.any()
                # Adding zero turns -0.0 into 0.0.
                out.append((row + 0.0).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "bytes"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(coded, "vec_id long, bytes binary")


def fit_centroids(rows: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Directions that the rows (of length one) gather around."""
    rows = rows.astype(np.float32)
    centroids = rows[:: max(1, len(rows) // count)][:count].copy()
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        size = np.linalg.norm(sums, axis=1)
        centroids[size > 0] = sums[size > 0] / size[size > 0, None]
    return centroids


def pruned_graph(rows: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Neighbours of each row: candidates that no kept neighbour stands in front of, and reverse edges."""
    m = len(rows)
    if m == 1:
        return [np.zeros(0, np.int64)]
    cos = rows @ rows.T
    np.fill_diagonal(cos, -2)
    near = min(NEAR, m - 1)
    candidates = np.argpartition(-cos, near - 1, axis=1)[:, :near]
    random = np.random.default_rng(seed).integers(0, m, (m, RANDOM))
    candidates = np.concatenate([candidates, random], 1)
    to = np.take_along_axis(cos, candidates, 1)
    distance = np.sqrt(np.maximum(2 - 2 * to, 0))
    distance[to < -1.5] = np.inf
    kept: list[list[int]] = [[] for _ in range(m)]
    every = np.arange(m)
    for _ in range(DEGREE):
        pick = distance.argmin(1)
        open_ = np.isfinite(distance[every, pick])
        if not open_.any():
            break
        chosen = candidates[every, pick]
        for row in np.flatnonzero(open_):
            kept[row].append(int(chosen[row]))
        between = np.sqrt(np.maximum(2 - 2 * cos[chosen[:, None], candidates], 0))
        hidden = (ALPHA * between <= distance) | (candidates == chosen[:, None])
        distance[hidden] = np.inf
    reverse: list[list[int]] = [[] for _ in range(m)]
    for row, ends in enumerate(kept):
        for end in ends:
            if len(reverse[end]) < MAX_DEGREE - DEGREE:
                reverse[end].append(row)
    return [np.unique(np.array(a + b, np.int64)) for a, b in zip(kept, reverse, strict=True)]


def medoid(rows: np.ndarray) -> int:
    return int((rows @ rows.mean(0)).argmax())


def range_search(rows: np.ndarray, lists: np.ndarray, starts: list[int], queries: np.ndarray, cosine: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of query and row in range, found by walking the lists (padded with -1) from ``starts``.

    All queries take their steps together. A query goes on while the best place it hasn't left is among its ``beam`` best, or in
    range (less some slack) however many there are.
    """
    known = np.full((len(queries), len(rows)), -2, np.float32)
    left = np.zeros(known.shape, bool)
    known[:, starts] = queries @ rows[starts].T
    active = np.arange(len(queries))
    beam = min(beam, len(rows))
    stride = min(STRIDE, len(rows))
    while len(active):
        here = known[active]
        floor = np.partition(here, -beam, axis=1)[:, -beam]
        open_ = np.where(left[active], -3, here)
        best = np.argpartition(-open_, stride - 1, axis=1)[:, :stride]
        value = np.take_along_axis(open_, best, 1)
        going = (value > -2) & ((value >= floor[:, None]) | (value >= cosine - SLACK))
        go = going.any(1)
        active, best, going = active[go], best[go], going[go]
        who, which = np.nonzero(going)
        places, who = best[who, which], active[who]
        left[who, places] = True
        near = lists[places]
        query = np.repeat(who, near.shape[1])
        near = near.ravel()
        real = near >= 0
        query, near = query[real], near[real]
        fresh = known[query, near] <= -2
        query, near = query[fresh], near[fresh]
        # Each place once, though several steps may lead there.
        code = np.unique(query * len(rows) + near)
        query, near = code // len(rows), code % len(rows)
        for at in range(0, len(code), 1 << 16):
            q, n = query[at : at + (1 << 16)], near[at : at + (1 << 16)]
            known[q, n] = np.einsum("ij,ij->i", queries[q], rows[n])
    return np.nonzero(known >= cosine - 1e-4)


def nearest_shards(batch: pa.RecordBatch, centroids: dict[int, np.ndarray], probes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one length of vectors and their shards, the nearest first."""
    base = dict(zip(centroids, np.cumsum([0, *map(len, centroids.values())])[:-1].tolist(), strict=True))
    widths = pc.binary_length(batch.column("bytes")).to_numpy() // 8
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        near = unit(vector_rows(batch.take(pa.array(rows)), "bytes")).astype(np.float32) @ centroids[width].T
        yield rows, np.argsort(-near, axis=1, kind="stable")[:, : min(probes, near.shape[1])] + base[width]


def parts_and_turns(classes: DataFrame, centroids: dict[int, np.ndarray], overlap: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Into how many parts each shard's members are dealt, and into how many turns its queries."""
    shards = sum(map(len, centroids.values()))
    sent = classes.sparkSession.sparkContext.broadcast(centroids)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, queries = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
        for batch in batches:
            for _, order in nearest_shards(batch, sent.value, probes):
                members += np.bincount(order[:, :overlap].ravel(), minlength=shards)
                queries += np.bincount(order.ravel(), minlength=shards)
        held = np.flatnonzero(queries)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(members[held]), pa.array(queries[held])], names=["shard", "members", "queries"]
        )

    counts = classes.select("bytes").mapInArrow(counted, "shard int, members long, queries long").groupBy("shard").agg(
        F.sum("members").alias("members"), F.sum("queries").alias("queries")
    )
    parts, turns = np.ones(shards, np.int64), np.ones(shards, np.int64)
    for r in counts.collect():
        parts[r["shard"]] = max(1, -(-r["members"] // (PART * SHARD)))
        turns[r["shard"]] = max(1, -(-r["queries"] // (TURN * SHARD)))
    return parts, turns


def found_links(
    classes: DataFrame, centroids: dict[int, np.ndarray], parts: np.ndarray, turns: np.ndarray, overlap: int, probes: int, beam: int, cosine: float
) -> DataFrame:
    """Pairs ``a`` < ``b`` of classes in range of each other."""
    sent = classes.sparkSession.sparkContext.broadcast((centroids, parts, turns))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each shard, part and turn: members go to one part and all turns, queries to all parts and one turn."""
        centroids, parts, turns = sent.value
        for batch in batches:
            ids = batch.column("class").to_numpy().view(np.uint64)
            for rows, order in nearest_shards(batch, centroids, probes):
                for rank in range(order.shape[1]):
                    count, rounds = parts[order[:, rank]], turns[order[:, rank]]
                    step = max(1, DEALT // int((count + rounds).max()))
                    for lo in range(0, len(rows), step):
                        yield cells(batch, ids, rows[lo : lo + step], order[lo : lo + step, rank], count[lo : lo + step], rounds[lo : lo + step], rank < overlap)

    def cells(
        batch: pa.RecordBatch, ids: np.ndarray, rows: np.ndarray, shard: np.ndarray, count: np.ndarray, rounds: np.ndarray, inside: bool
    ) -> pa.RecordBatch:
        # A class's part and turn are the same in all shards that have as many.
        own_part = (ids[rows] % count.astype(np.uint64)).astype(np.int64)
        own_turn = ((ids[rows] >> np.uint64(32)) % rounds.astype(np.uint64)).astype(np.int64)
        every = np.arange(len(rows))
        at = np.repeat(every, count)
        place = ranges(np.zeros_like(count), count)
        turn, asks = own_turn[at], np.ones(len(at), bool)
        real = ~batch.column("planted").to_numpy(zero_copy_only=False)[rows]
        member = (place == own_part[at]) & inside & real[at]
        if inside:
            # Members stand in the other turns too, where they don't ask; planted ones are none.
            others = np.where(real, rounds - 1, 0)
            more = np.repeat(every, others)
            other = ranges(np.zeros_like(rounds), others)
            other += other >= own_turn[more]
            at, place, turn = np.concatenate([at, more]), np.concatenate([place, own_part[more]]), np.concatenate([turn, other])
            asks = np.concatenate([asks, np.zeros(len(more), bool)])
            member = np.concatenate([member, np.ones(len(more), bool)])
        part = batch.take(pa.array(rows[at]))
        return pa.RecordBatch.from_arrays(
            [pa.array(shard[at], pa.int32()), pa.array(place, pa.int32()), pa.array(turn, pa.int32()), pa.array(member), pa.array(asks),
             part.column("class"), part.column("bytes")],
            names=["shard", "part", "turn", "member", "asks", "class", "bytes"],
        )

    placed = classes.select("class", "bytes", "planted").mapInArrow(
        dealt, "shard int, part int, turn int, member boolean, asks boolean, class long, bytes binary"
    )

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("class").combine_chunks()
        ids = table["class"].to_numpy()
        rows = unit(vector_rows(table, "bytes")).astype(np.float32)
        lists = [ids[x] for x in pruned_graph(rows)]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))
        # The medoid's list begins with itself.
        first = np.zeros(len(ids), bool)
        first[medoid(rows)] = True
        return pa.table([table["class"], flat, pa.array(first)], names=["class", "near", "medoid"])

    edges = placed.where("member and asks").groupBy("shard", "part").applyInArrow(build, "class long, near array<long>, medoid boolean")
    # A class is a member of OVERLAP shards at most, so few lists meet.
    united = edges.groupBy("class").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.max("medoid").alias("medoid")
    )

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("class").combine_chunks()
        member = table["member"].to_numpy(zero_copy_only=False)
        all_ids, exact = table["class"].to_numpy(), unit(vector_rows(table, "bytes"))
        inside, asking = np.flatnonzero(member), np.flatnonzero(table["asks"].to_numpy(zero_copy_only=False))
        pairs, n = [np.zeros(0, np.int64)], max(1, len(all_ids))
        if len(inside):
            ids, rows = all_ids[inside], exact[inside].astype(np.float32)
            members = table.take(pa.array(inside))
            near = members["near"].combine_chunks()
            ends, flat = near.offsets.to_numpy(), near.flatten().to_numpy()
            counts = np.diff(ends)
            # Only what is in this part too; ids are sorted.
            place = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
            here = ids[place] == flat
            owner = np.repeat(np.arange(len(ids)), counts)[here]
            place = place[here]
            width = max(1, int(np.bincount(owner, minlength=len(ids)).max()) if len(owner) else 1)
            lists = np.full((len(ids), width), -1, np.int64)
            column = np.arange(len(owner)) - np.searchsorted(owner, owner)
            lists[owner, column] = place
            starts = sorted({medoid(rows), *np.flatnonzero(members["medoid"].to_numpy(zero_copy_only=False)).tolist()})
            for at in range(0, len(asking), QUERIES):
                some = asking[at : at + QUERIES]
                q, r = range_search(rows, lists, starts, exact[some].astype(np.float32), cosine, beam)
                a, b = some[q], inside[r]
                for k in range(0, len(a), 1 << 16):
                    x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
                    good = (x != y) & (np.einsum("ij,ij->i", exact[x], exact[y]) >= cosine)
                    # Ids are sorted, so their places are in the same order.
                    pairs.append(np.minimum(x, y)[good] * n + np.maximum(x, y)[good])
        code = np.unique(np.concatenate(pairs))
        return pa.table([pa.array(all_ids[code // n], pa.int64()), pa.array(all_ids[code % n], pa.int64())], names=["a", "b"])

    # Only members' lists are read.
    whole = placed.join(united, "class", "left").withColumn("near", F.when(F.col("member"), F.col("near")))
    return whole.groupBy("shard", "part", "turn").applyInArrow(search, "a long, b long").distinct()


def true_links(classes: DataFrame, asked: pa.Table, cosine: float) -> DataFrame:
    """The links of some classes, compared with all others."""
    sent = classes.sparkSession.sparkContext.broadcast(asked)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        sizes = pc.binary_length(asked["bytes"]).to_numpy()
        step = max(1, COSINES // asked.num_rows)
        for whole in batches:
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                own = pc.binary_length(batch.column("bytes")).to_numpy()
                for size in np.intersect1d(sizes, own).tolist():
                    left, right = asked.take(np.flatnonzero(sizes == size)), batch.take(pa.array(np.flatnonzero(own == size)))
                    q, r = np.nonzero(unit(vector_rows(left, "bytes")) @ unit(vector_rows(right, "bytes")).T >= cosine)
                    a, b = left["class"].to_numpy()[q], right.column("class").to_numpy()[r]
                    apart = a != b
                    a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return classes.select("class", "bytes").mapInArrow(compared, "a long, b long").distinct()


class Audit:
    """The true links of the classes asked so far."""

    def __init__(self, classes: DataFrame, total: int, cosine: float) -> None:
        self.classes, self.cosine = classes, cosine
        self.blocks = max(1, -(-total // AUDIT))
        self.asked, self.step, self.seen = 0, 1, 0
        self.links = classes.sparkSession.createDataFrame([], "a long, b long")

    @property
    def whole(self) -> bool:
        return self.asked == self.blocks

    def ask(self, enough: float, most: float = float("inf")) -> None:
        """Ask more classes, until ``enough`` links are seen, about ``most`` classes or all are asked."""
        number = F.pmod(F.xxhash64("class", F.lit(11)), F.lit(self.blocks))
        while self.seen < enough and self.asked * AUDIT < most and not self.whole:
            until = min(self.asked + self.step, self.blocks)
            asked = self.classes.where((number >= self.asked) & (number < until)).select("class", "bytes").toArrow()
            self.asked, self.step = until, min(4 * self.step, max(1, ASKED // AUDIT))
            if asked.num_rows:
                links = written(true_links(self.classes, asked, self.cosine), "audit")
                self.seen += links.count()
                self.links = self.links.union(links)

    def recall(self, links: DataFrame, planted: DataFrame | None) -> float:
        """The share of the true links, planted ones among them, that are among ``links``."""
        true = self.links.distinct()
        if planted is not None:
            true = true.union(planted.select("a", "b"))
        got = true.join(links.withColumn("found", F.lit(1)), ["a", "b"], "left").agg(F.count("*").alias("n"), F.count("found").alias("k")).first()
        return got["k"] / got["n"] if got["n"] else 1.0


def planted_partners(spark: SparkSession, samples: list[pa.Table], cosine: float, seed: int = 3) -> DataFrame:
    """Partners of the sampled classes at known cosines: ``class``, ``bytes`` and their link ``a`` < ``b``.

    A vector of one component has no other direction to be turned to, so it gets no partner.
    """
    rng, ids, rows = np.random.default_rng(seed), [], []
    for sample in samples:
        some = sample.slice(0, PLANTED)
        at = unit(vector_rows(some, "bytes"))
        if at.shape[1] == 1:
            continue
        away = rng.normal(size=at.shape)
        away = unit(away - np.einsum("ij,ij->i", away, at)[:, None] * at)
        near = np.minimum(cosine + (1 - cosine) * rng.random((len(at), 1)) + 1e-9, 1)
        ids += some["class"].to_pylist()
        rows += [x.tobytes() for x in near * at + np.sqrt(1 - near**2) * away]
    table = pa.table([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], names=["of", "bytes"])
    planted = spark.createDataFrame(table).withColumn("class", F.xxhash64("bytes"))
    # A partner that happens to be one of the sampled vectors tells nothing.
    return planted.where(F.col("class") != F.col("of")).select(
        "class", "bytes", F.least("class", "of").alias("a"), F.greatest("class", "of").alias("b")
    )


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each vector (``vec_id``, ``embedding``)."""
    rows = written(usable(vectors).withColumn("class", F.xxhash64("bytes")), "vectors")
    known = rows.where("vec_id is not null and bytes is not null")
    classes = written(
        known.groupBy("class").agg(F.first("bytes").alias("bytes"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "classes"
    )
    # One list of centroids for each length of vectors; lengths are few.
    lengths = classes.groupBy((F.octet_length("bytes") / 8).cast("int").alias("width")).agg(F.count("*").alias("n")).orderBy("width").limit(64).collect()
    if len(lengths) == 64:
        raise ValueError("vectors have more than 63 lengths")
    centroids, samples = {}, []
    for r in lengths:
        sample = classes.where(F.octet_length("bytes") == 8 * r["width"]).orderBy("class").limit(SAMPLE).select("class", "bytes").toArrow()
        samples.append(sample.slice(0, PLANTED))
        count = min(MAX_CENTROIDS, -(-r["n"] // SHARD), sample.num_rows)
        centroids[r["width"]] = fit_centroids(unit(vector_rows(sample, "bytes")), count)
    total = sum(r["n"] for r in lengths)
    overlap, probes, beam = OVERLAP, PROBES, BEAM
    links = rows.sparkSession.createDataFrame([], "a long, b long")
    audit = Audit(classes, total, cosine)
    audit.ask(AUDIT_LINKS, AUDITED)
    searched, planted = classes.select("class", "bytes", F.lit(False).alias("planted")), None
    if total and audit.seen < AUDIT_LINKS:
        planted = written(planted_partners(rows.sparkSession, samples, cosine), "planted")
        searched = searched.union(planted.select("class", "bytes", F.lit(True)))
    for _ in range(ROUNDS if total else 0):
        parts, turns = parts_and_turns(classes, centroids, overlap, probes)
        links = written(found_links(searched, centroids, parts, turns, overlap, probes, beam, cosine), "links")
        if audit.recall(links, planted) >= RECALL:
            break
        overlap, probes, beam = overlap + 1, probes * 2, beam * 2
    else:
        audit.ask(float("inf"))
    if planted is not None:
        # At most PLANTED for each of few lengths.
        names = F.broadcast(planted.select("class"))
        for end in ("a", "b"):
            links = links.join(names, F.col(end) == F.col("class"), "left_anti")
    links = written(links.union(audit.links).distinct(), "links")
    roots = components(links)
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = both.join(classes.select(F.col("class").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    placed = classes.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = (
        placed.join(least, "root").join(degrees, F.col("class") == F.col("a"), "left")
        .select("class", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    # Rows without a class keep to themselves.
    keyed = rows.withColumn("class", F.when(F.col("vec_id").isNotNull() & F.col("bytes").isNotNull(), F.col("class")))
    return keyed.select("vec_id", "class").join(by_class, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
