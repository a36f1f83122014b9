"""A Merkle tree over a dataset with a witness for every row, by aligned appends.

A row's leaf is the SHA-256 of its fields. Per source the leaves, by ascending id, are the bottom of a tree in which
every three consecutive nodes become one; the roots of the sources, by name, are the bottom of the tree whose root stands for
the dataset. A row's witness is the list of the siblings on its way up: who holds a row and its witness can recompute
the root.

*Incremental witnesses.* :class:`Appender` takes leaves one by one. Open subtrees carry the partial witnesses of the leaves below
them: when a run of three siblings is complete each of them extends the witnesses of the others, and what they become
is appended one level higher. Leaves are dealt into aligned blocks of 3 ** levels, each of which is a task's own Appender;
the roots of the blocks are appended in the same way, in blocks again, until one is left. So a source of any size is spread over
tasks, and the witnesses of the upper levels are made once per block of rows.

*Order.* Leaves are dealt by ranges of (source, id, leaf), and places are sums over ranges and within them. Equal rows are
one row with a number until a block lays them out, so neither a hot source nor a repeated row is one task.

:class:`Manifest` holds the written tables. :meth:`Manifest.append` adds rows behind those of each source: only blocks that
get new leaves, and the levels above blocks, are made again.

Defined cases: NULL fields are marked, also as leaves' ids and sources; a NULL id comes first in its source, a NULL
source first of all. Rows with one id are ordered by their leaves, repeated rows have neighbouring places and a row each in
the result. Texts are hashed whole. An empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvetch.llm.common import written

ARITY = 3
# Levels of the tree in one block, which makes 2,187 leaves.
LEVELS = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest_of(*parts: bytes) -> bytes:
    """SHA-256 of some inputs in a row, as lowercase hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class Appender:
    """Leaves appended one at a time, and a witness for each that grows as siblings complete.

    A witness is a list of pairs, level by level: the siblings to the left, those to the right, as hex text.
    """

    def __init__(self) -> None:
        self.witnesses: list[list[tuple[bytes, bytes]]] = []
        self._open: list[list[tuple[bytes, int, int]]] = [[]]  # by level: digest, first leaf, end

    def append(self, leaf: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._open[0].append((leaf, at, at + 1))
        level = 0
        while len(self._open[level]) == ARITY:
            self._close(level)
            level += 1

    def _close(self, level: int) -> None:
        """A run of siblings is complete: they extend each other's witnesses and become one node."""
        run = self._open[level]
        digests = [node[0] for node in run]
        for at, (_, first, end) in enumerate(run):
            step = b"".join(digests[:at]), b"".join(digests[at + 1 :])
            for leaf in range(first, end):
                self.witnesses[leaf].append(step)
        if level + 1 == len(self._open):
            self._open.append([])
        self._open[level] = []
        self._open[level + 1].append((digest_of(*digests), run[0][1], run[-1][2]))

    def finish(self, levels: int | None = None) -> bytes:
        """The root: runs left open are complete as they are, up to a single node or to a number of levels."""
        level = 0
        while True:
            if level == len(self._open):
                self._open.append([])
            above = any(self._open[level + 1 :])
            if levels is None and not above and len(self._open[level]) == 1 or level == levels:
                return self._open[level][0][0]
            if self._open[level]:
                self._close(level)
            level += 1


def fold(leaf: bytes, witness: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its witness lead to."""
    for left, right in witness:
        leaf = digest_of(left, leaf, right)
    return leaf


def pack_witness(witness: list[tuple[bytes, bytes]]) -> bytes:
    """Per level: how many siblings are to the left and to the right, and their digests."""
    return b"".join(bytes([len(left) // 64, len(right) // 64]) + bytes.fromhex((left + right).decode()) for left, right in witness)


def unpack_witness(raw: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(raw):
        left, right = raw[at], raw[at + 1]
        both = raw[at + 2 : at + 2 + 32 * (left + right)].hex().encode()
        out.append((both[: 64 * left], both[64 * left :]))
        at += 2 + 32 * (left + right)
    return out


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column | str = "text") -> Column:
    """A row's leaf as 32 bytes; ``text`` may stand in for the row's own."""
    fields = [F.col(name) for name in FIELDS[:-1]] + [F.col(text) if isinstance(text, str) else text]
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def _placed(nodes: DataFrame, order: list[str], offsets: DataFrame | None = None) -> DataFrame:
    """Add ``start``, the place of a row's first leaf in its ``tree``, and ``total`` leaves of it.

    Rows stand for ``n`` equal leaves each. They are dealt by ranges, so that a tree of any size is spread;
    ``offsets`` gives the leaves that a tree has before (``tree``, ``held``).
    """
    parts = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["tree", *order]
    dealt = nodes.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    sums = dealt.groupBy("tree", "part").agg(F.sum("n").alias("here"))
    if offsets is not None:
        sums = sums.join(offsets, "tree", "left")
    held = F.coalesce("held", F.lit(0)) if offsets is not None else F.lit(0)
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "tree", "part", (held + F.coalesce(F.sum("here").over(before), F.lit(0))).cast("long").alias("before"),
        (held + F.sum("here").over(Window.partitionBy("tree"))).cast("long").alias("total"),
    )
    inside = Window.partitionBy("tree", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, ["tree", "part"])
    return placed.withColumn("start", F.col("start") + F.col("before")).drop("part", "before")


def _in_blocks(placed: DataFrame, size: int) -> DataFrame:
    """A row for each block that a row's leaves lie in: ``block``, ``at`` the first of them, ``n`` how many."""
    end = F.col("start") + F.col("n")
    cut = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {size}, (start + n - 1) div {size})")))
    first = F.greatest(F.col("start"), F.col("block") * size)
    return cut.withColumn("at", first).withColumn("n", F.least(end, (F.col("block") + 1) * size) - first).drop("start")


def _appended(table: pa.Table, total: int, levels: int) -> tuple[pa.Table, Appender, bytes]:
    """A block's rows in order, their leaves appended, and its root; its tree has ``total`` leaves."""
    table = table.sort_by([("at", "ascending")]).combine_chunks()
    appender = Appender()
    for leaf, n in zip(table.column("leaf").to_pylist(), table.column("n").to_pylist(), strict=True):
        text = leaf.hex().encode()
        for _ in range(n):
            appender.append(text)
    root = appender.finish(None if total <= ARITY**levels else levels)
    return table, appender, root


_ROOT = "tree string, at long, leaf binary, witness binary, root boolean"


def _root(levels: int) -> Callable[[pa.Table], pa.Table]:
    """A block's root alone."""

    def root(table: pa.Table) -> pa.Table:
        table, _, top = _appended(table, table.column("total")[0].as_py(), levels)
        return pa.table({
            "tree": [table.column("tree")[0].as_py()], "block": [table.column("block")[0].as_py()],
            "leaf": pa.array([bytes.fromhex(top.decode())], pa.binary()),
        })

    return root


def _witnessed(levels: int) -> Callable[[pa.Table], pa.Table]:
    """The witnesses of a block's nodes within it, and its root."""

    def witnessed(table: pa.Table) -> pa.Table:
        table, appender, top = _appended(table, table.column("total")[0].as_py(), levels)
        tree, block, count = table.column("tree")[0].as_py(), table.column("block")[0].as_py(), len(appender.witnesses)
        first = table.column("at")[0].as_py()
        return pa.table({
            "tree": pa.array([tree] * (count + 1), pa.string()), "at": pa.array([*range(first, first + count), block], pa.int64()),
            "leaf": pa.array([None] * count + [bytes.fromhex(top.decode())], pa.binary()),
            "witness": pa.array([*map(pack_witness, appender.witnesses), None], pa.binary()),
            "root": pa.array([False] * count + [True]),
        })

    return witnessed


def _climb(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """From nodes (``tree``, ``at``, ``leaf``, ``total``) to the trees' roots and each node's witness.

    A round makes one node of each block; its witnesses go on with those of the next round.
    """
    size = ARITY**levels
    most = nodes.agg(F.max("total")).first()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        blocks = nodes.withColumn("block", F.expr(f"at div {size}")).withColumn("n", F.lit(1).cast("long"))
        made = written(blocks.groupBy("tree", "block").applyInArrow(_witnessed(levels), _ROOT), "climb")
        rounds.append(made.where(~F.col("root")).select("tree", "at", "witness"))
        totals = nodes.select("tree", F.expr(f"(total + {size - 1}) div {size}").alias("total")).distinct()
        nodes = made.where("root").select("tree", "at", "leaf").join(totals, "tree")
        if most <= size:
            break
        most = -(-most // size)
    witnesses = rounds.pop()
    while rounds:
        above = witnesses.select("tree", F.col("at").alias("block"), F.col("witness").alias("above"))
        lower = rounds.pop().withColumn("block", F.expr(f"at div {size}"))
        witnesses = lower.join(above, ["tree", "block"]).select("tree", "at", F.concat("witness", "above").alias("witness"))
    return nodes.select("tree", "leaf"), witnesses


_SEEN = (
    "doc_id long, leaf string, leaf_index long, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def _proved(levels: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The rows of a block: their witnesses, and what the leaves that were shown lead to."""

    def proved(table: pa.Table, above: pa.Table) -> pa.Table:
        table, appender, _ = _appended(table, above.column("held")[0].as_py(), levels)
        higher = unpack_witness(above.column("above")[0].as_py())
        subroot, root = (above.column(c)[0].as_py().hex() for c in ("subroot", "root"))
        columns = [table.column(c).to_pylist() for c in ("doc_id", "leaf", "shown", "at", "n")]
        witnesses = iter(appender.witnesses)
        out: list[list] = [[] for _ in range(8)]
        for doc_id, leaf, shown, at, n in zip(*columns, strict=True):
            for nth in range(n):
                witness = next(witnesses) + higher
                folded = fold((leaf if shown is None else shown).hex().encode(), witness).decode()
                proof = hashlib.sha256(b"".join(left + right for left, right in witness)).hexdigest()
                for column, value in zip(out, (doc_id, leaf.hex(), at + nth, subroot, root, proof, folded, folded == root), strict=True):
                    column.append(value)
        types = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.bool_()]
        names = [field.split()[0] for field in _SEEN.split(", ")]
        return pa.table([pa.array(column, kind) for column, kind in zip(out, types, strict=True)], names=names)

    return proved


@dataclass(frozen=True)
class Manifest:
    """``leaves``: rows in blocks (``tree`` for the source, ``block``, ``at``, ``n``, ``doc_id``, ``leaf``, ``shown``);
    ``blocks``: the root of each block (``tree``, ``block``, ``leaf``); ``totals``: leaves of each tree and its largest id.
    A block is ``levels`` levels high."""

    leaves: DataFrame
    blocks: DataFrame
    totals: DataFrame
    levels: int = LEVELS

    @classmethod
    def empty(cls, spark: SparkSession, levels: int = LEVELS) -> Manifest:
        return cls(
            spark.createDataFrame([], "tree string, doc_id long, leaf binary, shown binary, block long, at long, n long"),
            spark.createDataFrame([], "tree string, block long, leaf binary"),
            spark.createDataFrame([], "tree string, held long, last long"),
            levels,
        )

    def append(self, documents: DataFrame, shown: Column | None = None) -> Manifest:
        """The manifest with more rows; in each source they have to come behind those it has.

        ``shown`` is a text that stands in for the row's when its leaf is checked, NULL for the row's own.
        """
        other = F.lit(None).cast("binary") if shown is None else F.when(shown.isNotNull(), leaf_of(shown))
        tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree")
        rows = documents.select(tree, F.col("doc_id").cast("long").alias("doc_id"), leaf_of().alias("leaf"), other.alias("shown"))
        rows = written(rows.groupBy("tree", "doc_id", "leaf", "shown").agg(F.count("*").alias("n")), "leaves")
        first = self.totals.join(rows.groupBy("tree").agg(F.min("doc_id").alias("first"), F.count("doc_id").alias("known"), F.count("*").alias("all")), "tree")
        if not first.where("last is not null and (first <= last or known < all)").isEmpty():
            raise ValueError("rows have to be appended in the order of their ids")
        placed = _in_blocks(_placed(rows, ["doc_id", "leaf", "shown"], self.totals), ARITY**self.levels)
        placed = written(placed, "blocks")
        added = placed.groupBy("tree").agg(F.sum("n").alias("held"), F.max("doc_id").alias("last"))
        totals = written(self.totals.unionByName(added).groupBy("tree").agg(F.sum("held").alias("held"), F.max("last").alias("last")), "totals")
        leaves = self.leaves.unionByName(placed.drop("total"))
        # Full blocks keep their roots; a block that grew is appended anew.
        touched = placed.select("tree", "block", "total").distinct()
        grown = leaves.join(touched, ["tree", "block"])
        roots = grown.groupBy("tree", "block").applyInArrow(_root(self.levels), "tree string, block long, leaf binary")
        blocks = self.blocks.join(touched, ["tree", "block"], "left_anti").unionByName(roots)
        return Manifest(leaves, written(blocks, "roots"), totals, self.levels)

    def _above(self) -> DataFrame:
        """For each block the witness of its root, the source's root and the dataset's."""
        total = F.expr(f"(held + {ARITY**self.levels - 1}) div {ARITY**self.levels}").alias("total")
        nodes = self.blocks.join(self.totals.select("tree", total), "tree").select("tree", F.col("block").alias("at"), "leaf", "total")
        subroots, within = _climb(nodes, self.levels)
        subroots = written(subroots, "subroots")
        one = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "leaf", F.lit(1).cast("long").alias("n"))
        sources = written(_placed(one, ["name"]).withColumnRenamed("start", "at"), "sources")
        roots, over = _climb(sources.select("tree", "at", "leaf", "total"), self.levels)
        named = sources.select(F.col("name").alias("tree"), "at", F.col("leaf").alias("subroot")).join(over.select("at", F.col("witness").alias("upper")), "at")
        # The dataset has one root.
        root = roots.select("leaf").first()
        return within.join(named.drop("at"), "tree").join(self.totals.select("tree", "held"), "tree").select(
            "tree", F.col("at").alias("block"), F.concat("witness", "upper").alias("above"), "subroot", "held",
            F.lit(bytes(root[0]) if root else None).cast("binary").alias("root"),
        )

    def proofs(self) -> DataFrame:
        """One row per document: its leaf and place, the roots, a digest of its witness, and the check of what was shown."""
        blocks = self.leaves.groupBy("tree", "block").cogroup(self._above().groupBy("tree", "block"))
        return blocks.applyInArrow(_proved(self.levels), _SEEN)


def check(documents: DataFrame, shown: Column | None = None) -> DataFrame:
    """The proofs of a table's rows; ``shown`` is the text of a row that somebody holds, NULL if it is the row's own."""
    return Manifest.empty(documents.sparkSession).append(documents, shown).proofs()
