"""Exact dedup by an index of cuckoo filters, dealt by digest.

The index has shards, dealt by a hash of the text's digest (SHA-256). A shard has a cuckoo filter of 16-bit
fingerprints in buckets of four slots, the stored 64-bit keys it was made of, and the content of its texts, in the order of
their digests. A text whose key misses the filter is new: no content is looked at. A hit is compared with the content stored
under its digest; a false hit becomes an entry as well. A filter that can't place a fingerprint is made anew, twice as
large, from the stored keys.

:func:`keep_last` indexes a whole table at once: a task drops what its batches repeat, then the texts are
shuffled by shard, once, and sorted by digest, so that a shard is one pass and never holds more content than the text it is
at. :class:`Index` is the same index kept as tables, for live documents that come and go: an increment is probed by
the filters, and only hits meet stored content. A text leaves its filter when its last document is deleted.

Texts copied a million times arrive once per batch; their rows meet the answer by broadcast (:func:`join_groups`).

Defined cases: a NULL text is an empty one. Of equal texts the row with the largest id stays, a NULL id is less than
any other; of several such rows one stays. Every row has a row in the result, repeated rows as well. Empty tables give
none. Very long texts are compared whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.llm.common import join_groups, mix, released, slices, text_digest, written

SLOTS = 4
# Tries to find a fingerprint another place before the filter grows.
KICKS = 200
# Rows that one row of repeats is expanded to at a time.
EXPAND = 10_000
_LEAST = np.iinfo(np.int64).min


class CuckooFilter:
    """16-bit fingerprints of 64-bit keys, with deletion; a key may be in it a few times, as far as two buckets hold it.

    A key's two buckets differ by a hash of its fingerprint, so either is found from the other.
    """

    def __init__(self, bits: int = 4, keys: np.ndarray | None = None) -> None:
        self.table = np.zeros((1 << bits, SLOTS), np.uint16)
        self.keys = np.zeros(0, np.uint64)
        if keys is not None:
            self.insert(keys)

    @property
    def bits(self) -> int:
        return len(self.table).bit_length() - 1

    def _prints(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints, never 0, and first buckets."""
        mixed = mix(keys)
        return (mixed % np.uint64(65535) + np.uint64(1)).astype(np.uint16), (mixed >> np.uint64(20)).astype(np.int64) & len(self.table) - 1

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ (mix(prints.astype(np.uint64)) >> np.uint64(20)).astype(np.int64)) & len(self.table) - 1

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, bucket = self._prints(keys)
        here = (self.table[bucket] == prints[:, None]).any(1)
        return here | (self.table[self._other(bucket, prints)] == prints[:, None]).any(1)

    def insert(self, keys: np.ndarray) -> None:
        """Add keys; a filter that overflows is made anew from the stored keys, with twice the buckets."""
        keys = np.asarray(keys, np.uint64)
        self.keys = np.concatenate([self.keys, keys])
        bits = self.bits
        while len(self.keys) > 0.94 * SLOTS * (1 << bits):
            bits += 1
        if bits == self.bits and self._placed(keys):
            return
        while True:
            self.table = np.zeros((1 << bits, SLOTS), np.uint16)
            if self._placed(self.keys):
                return
            bits += 1
            if SLOTS << bits > 1024 * len(self.keys):
                raise ValueError("one key is inserted more often than its buckets have slots")

    def _placed(self, keys: np.ndarray) -> bool:
        prints, bucket = self._prints(keys)
        for kick in range(KICKS):
            for _ in range(2):
                # In each round a bucket takes as many of the waiting fingerprints as it has free slots.
                order = np.argsort(bucket, kind="stable")
                prints, bucket = prints[order], bucket[order]
                place = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
                free = self.table[bucket] == 0
                fits = place < free.sum(1)
                slot = np.argmax(np.cumsum(free[fits], 1) == place[fits, None] + 1, axis=1)
                self.table[bucket[fits], slot] = prints[fits]
                prints, bucket = prints[~fits], bucket[~fits]
                if len(prints) == 0:
                    return True
                bucket = self._other(bucket, prints)
            # Both buckets are full: a bucket's first waiting fingerprint takes the place of another.
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if np.all(bucket[1:] >= bucket[:-1]) else np.unique(bucket, return_index=True)[1]
            slot = (prints[first].astype(np.int64) + kick) % SLOTS
            out = self.table[bucket[first], slot].copy()
            self.table[bucket[first], slot] = prints[first]
            prints[first] = out
            bucket[first] = self._other(bucket[first], out)
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are in the filter, each once."""
        keys = np.sort(np.asarray(keys, np.uint64))
        stored = np.sort(self.keys)
        nth = np.arange(len(keys)) - np.searchsorted(keys, keys)
        at = np.searchsorted(stored, keys) + nth
        if len(keys) and (at.max(initial=0) >= len(stored) or (stored[np.minimum(at, len(stored) - 1)] != keys).any()):
            raise ValueError("a key to delete is not in the filter")
        self.keys = np.delete(stored, at)
        prints, bucket = self._prints(keys)
        for side in range(2):
            while len(prints):
                head = np.unique(bucket * 65536 + prints, return_index=True)[1]
                match = self.table[bucket[head]] == prints[head][:, None]
                found = match.any(1)
                self.table[bucket[head][found], match[found].argmax(1)] = 0
                if not found.any():
                    break
                keep = np.ones(len(prints), bool)
                keep[head[found]] = False
                prints, bucket = prints[keep], bucket[keep]
            bucket = self._other(bucket, prints)
        if len(prints):
            raise ValueError("a fingerprint to delete is not in the filter")

    def to_bytes(self) -> tuple[bytes, bytes]:
        return self.table.astype("<u2").tobytes(), np.sort(self.keys).astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, table: bytes, keys: bytes) -> CuckooFilter:
        out = cls()
        out.table = np.frombuffer(table, "<u2").astype(np.uint16).reshape(-1, SLOTS)
        out.keys = np.frombuffer(keys, "<u8").astype(np.uint64)
        return out


def _digests(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Digests of 32 bytes as rows of four big-endian words, which sort as the bytes do."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 4)


def _heads(digests: np.ndarray) -> np.ndarray:
    """Which of sorted digests differ from the one before."""
    out = np.ones(len(digests), bool)
    out[1:] = (digests[1:] != digests[:-1]).any(1)
    return out


_ENTRY = "digest binary, text string, keep_id long, keep_rows long, copies long"


def _largest(ids: np.ndarray, known: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs that start at ``at``: the largest id, whether there is one, and how many rows have it."""
    any_known = np.logical_or.reduceat(known, at)
    best = np.maximum.reduceat(np.where(known, ids, _LEAST), at)
    sizes = np.diff(np.append(at, len(ids)))
    has = np.where(np.repeat(any_known, sizes), known & (ids == np.repeat(best, sizes)), True)
    return best, any_known, np.add.reduceat(np.where(has, rows, 0), at)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct text of some rows once, with its largest id and number of rows."""
    for batch in released(batches):
        for part in slices(batch, "text"):
            digests = _digests(part.column("digest"))
            order = np.lexsort(digests.T[::-1])
            at = np.flatnonzero(_heads(digests[order]))
            known = pc.is_valid(part.column("doc_id")).to_numpy(zero_copy_only=False)[order]
            ids = pc.fill_null(part.column("doc_id"), 0).to_numpy(zero_copy_only=False)[order]
            texts = pc.fill_null(part.column("text"), "").take(pa.array(order))
            sizes = np.diff(np.append(at, len(order)))
            if not pc.all(pc.equal(texts, texts.take(pa.array(np.repeat(at, sizes))))).as_py():
                raise ValueError("two texts have one SHA-256")
            best, any_known, rows = _largest(ids, known, np.ones(len(ids), np.int64), at)
            first = pa.array(order[at])
            yield pa.RecordBatch.from_arrays(
                [part.column("digest").take(first), texts.take(pa.array(at)), pa.array(best, mask=~any_known), pa.array(rows), pa.array(sizes)],
                names=["digest", "text", "keep_id", "keep_rows", "copies"],
            )


def entries_of(documents: DataFrame) -> DataFrame:
    """Texts with their digests, dealt to shards; what one batch repeats is already one row."""
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest(F.col("text")).alias("digest"))
    found = found.mapInArrow(_entries, _ENTRY)
    shards = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(max(1, shards))).cast("int"))


_INDEXED = "shard int, digest binary, keep_id long, keep_rows long, copies long, slots binary, keys binary"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of whole shards, sorted by digest: one row per text, then a shard's filter and stored keys.

    A run of rows with one digest may go on in the next batch, so the last entry is held back.
    """
    state: dict = {"shard": None}

    def rows(shard: int, digests: list[bytes], best: np.ndarray, known: np.ndarray, keep: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(digests), pa.binary())
        columns = [pa.array([shard] * len(digests), pa.int32()), pa.array(digests, pa.binary()), pa.array(best, mask=~known), pa.array(keep), pa.array(copies), none, none]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _INDEXED.split(", ")])

    def one(last: dict) -> pa.RecordBatch:
        return rows(state["shard"], [last["digest"]], np.array([last["id"]]), np.array([last["known"]]), np.array([last["keep"]]), np.array([last["copies"]]))

    def closed() -> Iterator[pa.RecordBatch]:
        if state["shard"] is None:
            return
        yield one(state["last"])
        slots, keys = state["filter"].to_bytes()
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([state["shard"]], pa.int32()), pa.nulls(1, pa.binary()), none, none, none, pa.array([slots]), pa.array([keys])],
            names=[c.split()[0] for c in _INDEXED.split(", ")],
        )

    def added(part: pa.RecordBatch, shard: int) -> Iterator[pa.RecordBatch]:
        digests, texts = _digests(part.column("digest")), part.column("text")
        known = pc.is_valid(part.column("keep_id")).to_numpy(zero_copy_only=False)
        ids = pc.fill_null(part.column("keep_id"), 0).to_numpy(zero_copy_only=False)
        keep, copies = (part.column(c).to_numpy() for c in ("keep_rows", "copies"))
        head = _heads(digests)
        # What the filter hasn't seen is new. A hit is compared with the content of its bucket: of sorted digests, the one before.
        hit = state["filter"].contains(digests[:, 0])
        goes_on = bool(hit[0]) and state["last"] is not None and state["last"]["digest"] == part.column("digest")[0].as_py()
        if goes_on and state["last"]["text"] != texts[0].as_py():
            raise ValueError("two texts have one SHA-256")
        at = np.flatnonzero(head)
        sizes = np.diff(np.append(at, len(head)))
        new = at[1:] if goes_on else at
        state["filter"].insert(digests[new, 0])
        if not state["filter"].contains(digests[:, 0]).all() or not pc.all(pc.equal(texts, texts.take(pa.array(np.repeat(at, sizes))))).as_py():
            raise ValueError("two texts have one SHA-256")
        best, any_known, rows_of = _largest(ids, known, keep, at)
        copies = np.add.reduceat(copies, at)
        names = part.column("digest").take(pa.array(at)).to_pylist()
        if state["last"] is not None and not goes_on:
            yield one(state["last"])
        if goes_on:
            last = state["last"]
            mine, theirs = (last["known"], last["id"]), (bool(any_known[0]), int(best[0]) if any_known[0] else last["id"])
            rows_of[0] = last["keep"] + rows_of[0] if mine == theirs else last["keep"] if mine > theirs else rows_of[0]
            copies[0] += last["copies"]
            any_known[0], best[0] = max(mine, theirs)
        yield rows(shard, names[:-1], best[:-1], any_known[:-1], rows_of[:-1], copies[:-1])
        state["last"] = {"digest": names[-1], "text": texts[int(at[-1])].as_py(), "id": int(best[-1]), "known": bool(any_known[-1]), "keep": int(rows_of[-1]), "copies": int(copies[-1])}

    for batch in released(batches):
        for cut in slices(batch, "text"):
            shards = cut.column("shard").to_numpy()
            for part in np.split(np.arange(len(shards)), np.flatnonzero(np.diff(shards)) + 1):
                shard = int(shards[part[0]])
                if shard != state["shard"]:
                    yield from closed()
                    state.update(shard=shard, filter=CuckooFilter(), last=None)
                yield from added(cut.slice(int(part[0]), len(part)), shard)
    yield from closed()


def indexed(documents: DataFrame) -> DataFrame:
    """The index of a table, written: a row per text, and one per shard with its filter and stored keys."""
    dealt = entries_of(documents).repartition("shard").sortWithinPartitions("shard", "digest")
    return written(dealt.select("shard", "digest", "text", "keep_id", "keep_rows", "copies").mapInArrow(_indexed, _INDEXED), "cuckoo")


def _expanded(df: DataFrame, count: str) -> DataFrame:
    """``count`` rows for each row, ``nth`` from 0, however many those are."""
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({count} - 1) div {EXPAND}"))))
    left = F.least(F.lit(EXPAND), F.col(count) - F.col("_chunk") * EXPAND)
    return chunks.repartition("_chunk", *df.columns).withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), left - 1))).withColumn(
        "nth", F.col("_chunk") * EXPAND + F.col("_at")
    ).drop("_chunk", "_at")


def keep_last(documents: DataFrame) -> DataFrame:
    """One row per document (``doc_id``, ``text``): ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    entries = indexed(documents).where("digest is not null").select("digest", "keep_id", "keep_rows", "copies")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"))
    found = join_groups(rows, entries, "digest", "copies")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = [F.col("copies").alias("group_size"), F.lower(F.hex("digest")).alias("text_sha256")]
    # Several rows with the largest id are alike here: they are made from their number, and the first stays.
    alone = found.where(~(stays & (F.col("keep_rows") > 1))).select("doc_id", "keep_id", stays.alias("kept"), *out)
    alike = _expanded(entries.where("keep_rows > 1"), "keep_rows")
    alike = alike.select(F.col("keep_id").alias("doc_id"), "keep_id", (F.col("nth") == 0).alias("kept"), *out)
    return alone.unionByName(alike).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


# The index kept as tables


def _probed(state: pa.Table, asked: pa.Table) -> pa.Table:
    """Which of a shard's digests its filter has."""
    digests = _digests(asked.column("digest"))
    hit = np.zeros(len(digests), bool)
    if state.num_rows:
        hit = CuckooFilter.from_bytes(state.column("slots")[0].as_py(), state.column("keys")[0].as_py()).contains(digests[:, 0])
    return pa.table({"digest": asked.column("digest").cast(pa.binary()), "hit": hit})


def _moved(state: pa.Table, changes: pa.Table) -> pa.Table:
    """A shard's filter after insertions and deletions."""
    held = CuckooFilter.from_bytes(state.column("slots")[0].as_py(), state.column("keys")[0].as_py()) if state.num_rows else CuckooFilter()
    shard = (state if state.num_rows else changes).column("shard")[0].as_py()
    if changes.num_rows:
        keys, added = _digests(changes.column("digest"))[:, 0], changes.column("added").to_numpy(zero_copy_only=False)
        held.delete(keys[~added])
        held.insert(keys[added])
    slots, keys = held.to_bytes()
    return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([slots], pa.binary()), "keys": pa.array([keys], pa.binary())})


@dataclass(frozen=True)
class Index:
    """Live documents by text. Every change gives a new index and leaves this one as it is.

    ``members``: ``digest``, ``doc_id`` and number of ``rows``; ``content``: ``shard``, ``digest``, ``text``; ``filters``:
    ``shard``, ``slots``, ``keys``. The number of shards is fixed when the index is made.
    """

    shards: int
    members: DataFrame
    content: DataFrame
    filters: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession, shards: int | None = None) -> Index:
        shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(
            shards,
            spark.createDataFrame([], "digest binary, doc_id long, rows long"),
            spark.createDataFrame([], "shard int, digest binary, text string"),
            spark.createDataFrame([], "shard int, slots binary, keys binary"),
        )

    def _shard(self) -> F.Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int").alias("shard")

    def _rows(self, documents: DataFrame) -> DataFrame:
        return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), text_digest(F.col("text")).alias("digest"))

    def probe(self, digests: DataFrame) -> DataFrame:
        """``digest`` and ``hit``; a miss is certain, a hit has to be confirmed."""
        asked = digests.select("digest").distinct().select("digest", self._shard())
        return self.filters.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_probed, "digest binary, hit boolean")

    def find(self, documents: DataFrame) -> DataFrame:
        """``digest``, ``text`` and ``known`` of the distinct texts: hits are compared with stored content."""
        texts = self._rows(documents).groupBy("digest").agg(F.first("text").alias("text"))
        probed = texts.join(self.probe(texts), "digest")
        missed = probed.where(~F.col("hit")).select("digest", "text", F.lit(False).alias("known"))
        stored = self.content.select("digest", F.col("text").alias("stored"))
        same = F.when(F.col("stored") == F.col("text"), True).when(F.col("stored").isNull(), False).otherwise(
            F.raise_error(F.lit("two texts have one SHA-256")).cast("boolean")
        )
        hits = probed.where("hit").join(stored, "digest", "left").select("digest", "text", same.alias("known"))
        return missed.unionByName(hits)

    def _with(self, members: DataFrame, content: DataFrame, changes: DataFrame) -> Index:
        moved = self.filters.groupBy("shard").cogroup(changes.select("digest", "added", self._shard()).groupBy("shard"))
        filters = moved.applyInArrow(_moved, "shard int, slots binary, keys binary")
        return Index(self.shards, written(members, "members"), written(content, "content"), written(filters, "filters"))

    def insert(self, documents: DataFrame) -> Index:
        """The index with these rows; texts it doesn't know enter filters and content."""
        new = written(self.find(documents).where(~F.col("known")).select("digest", "text"), "new")
        rows = self._rows(documents).groupBy("digest", "doc_id").agg(F.count("*").alias("rows"))
        members = self.members.unionByName(rows).groupBy("digest", "doc_id").agg(F.sum("rows").alias("rows"))
        content = self.content.unionByName(new.select(self._shard(), "digest", "text"))
        return self._with(members, content, new.select("digest", F.lit(True).alias("added")))

    def delete(self, documents: DataFrame) -> Index:
        """The index without these rows (``doc_id``, ``text``), each of which it has to hold.

        A text's digest leaves its filter with the text's last row.
        """
        gone = self._rows(documents).groupBy("digest", "doc_id").agg((-F.count("*")).alias("rows"))
        # A group of its own for each (digest, id): a NULL id is one.
        left = self.members.unionByName(gone).groupBy("digest", "doc_id").agg(F.sum("rows").alias("rows"))
        left = left.where(F.when(F.col("rows") >= 0, F.col("rows") > 0).otherwise(F.raise_error(F.lit("a row to delete is not in the index")).cast("boolean")))
        left = written(left, "left")
        dead = written(gone.select("digest").distinct().join(left.select("digest").distinct(), "digest", "left_anti"), "dead")
        content = self.content.join(dead, "digest", "left_anti")
        return self._with(left, content, dead.select("digest", F.lit(False).alias("added")))

    def groups(self) -> DataFrame:
        """``digest``, ``keep_id`` and ``group_size`` of the live texts."""
        return self.members.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
