"""Alignment of two tokenizers over a corpus, each distinct text once.

Tokenizer A (byte-level BPE, a ``tokenizers`` file) and B (BPE with byte fallback, a SentencePiece file) cut the same
bytes, a space and the text. Places where tokens of both end cut them into groups; every token of A in a group is linked with
every token of B in it. An id pair's count is the number of documents that hold it linked.

1. *Distinct texts.* Documents are shuffled by their full text, copies combined before; a text's multiplicity is the weight
   of its pairs, however many copies it has. Each distinct text is cut and aligned once and written with its pairs.
2. *Counts.* A block of texts sends each of its pairs once, with the weights summed; sums, and the highest count of each
   A id, are DataFrame aggregates. Back comes each block's own pairs' counts.
3. *Measures* of each text are sums over its pairs; documents get them by the digest of their text (:func:`join_groups`).

Tokenizers work on chunks: no token of A crosses from a printable ASCII character to a space, and no piece of B from any
character to a space, so a text is cut there first and each distinct chunk is tokenised once per worker. Files that don't have
these properties are refused.

Defined cases: NULL and empty texts, and texts whose tokens don't give back the text's bytes (a literal U+2581, which B reads
as a space), have no tokens: all numbers 0, no groups. Rows are kept as they are, repeated ids and NULL ids too; each row is
a document. Long texts are whole; links within a group are counted from its distinct ids and never laid out one by one.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kvetch.llm.common import (
    blocks_of, from_planes, join_groups, packed_keys, planes, ranges, release, released, slices, text_bytes, text_digest, unpacked_keys, written,
)

# Distinct chunks whose ids a worker keeps.
CACHE_CHUNKS = 200_000
# Text bytes aligned at a time, unless a single text is longer, and links laid out at a time.
PART_BYTES = 512 << 10
STEP = 1_000_000
SPACE_MARK = "▁"


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + place): byte for place, byte in enumerate(rest)}


class _Vocabulary:
    """Ids of chunks, each beginning with a space, and the bytes of ids. Subclasses load and encode."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        # Decimal ids, with room for a separator behind each.
        names = [f"{k}," for k in range(len(tokens))]
        self.names = np.frombuffer("".join(names).encode(), np.uint8)
        self.name_sizes = np.fromiter(map(len, names), np.int64, len(names))
        self.name_starts = np.cumsum(self.name_sizes) - self.name_sizes
        self.clear()

    def clear(self) -> None:
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _encoded(self, chunks: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def add(self, chunks: list[str]) -> None:
        """Tokenise new chunks; each is the next entry."""
        for at in range(0, len(chunks), 5_000):
            found = self._encoded(chunks[at : at + 5_000])
            counts = np.fromiter(map(len, found), np.int64, len(found))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def tokens(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries in a row, and how many each has."""
        counts = self.ends[entries + 1] - self.ends[entries]
        return self.ids[ranges(self.ends[entries], counts)], counts


class ByteVocabulary(_Vocabulary):
    """A: byte-level BPE whose words begin with at most one space."""

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cutter = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or cutter.get("type") != "ByteLevel" or not cutter.get("use_regex") or cutter.get("add_prefix_space"):
            raise ValueError("A has to be a byte-level tokenizer without normalizer and prefix")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        symbols = byte_symbols()
        words = {i: token for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        last = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        super().__init__([bytes(symbols[char] for char in words.get(i, "")) for i in range(last + 1)])

    def _encoded(self, chunks: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]


class PieceVocabulary(_Vocabulary):
    """B: SentencePiece BPE that adds a space in front and changes nothing else."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, model.SentencePiece
        plain = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces and not spec.precompiled_charsmap
        inner = any(SPACE_MARK in piece.piece.lstrip(SPACE_MARK) for piece in model.pieces)
        own = any(piece.type == kinds.USER_DEFINED for piece in model.pieces)
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not plain or inner or own:
            raise ValueError("B has to be a BPE model that only adds a space, with marks of spaces at pieces' beginnings alone")
        self.processor = SentencePieceProcessor(model_file=path)
        tokens = []
        for piece in model.pieces:
            as_byte = piece.type == kinds.BYTE
            plain_text = piece.piece if piece.type == kinds.NORMAL else ""
            tokens.append(bytes([int(piece.piece[3:5], 16)]) if as_byte else plain_text.replace(SPACE_MARK, " ").encode())
        super().__init__(tokens)

    def _encoded(self, chunks: list[str]) -> list[list[int]]:
        # The model puts the space in front itself.
        return self.processor.encode([chunk[1:] for chunk in chunks], num_threads=1)


class Tokenizers:
    """Both tokenizers and the chunks they have seen."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteVocabulary(path_a), PieceVocabulary(path_b)
        self.known: dict[str, int] = {}

    def entries(self, chunks: pa.Array) -> np.ndarray:
        """The entry of each chunk in both vocabularies; only new chunks are tokenised."""
        if len(self.known) > CACHE_CHUNKS:
            self.known = {}
            self.a.clear()
            self.b.clear()
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = [self.known.get(chunk, -1) for chunk in distinct]
        new = [chunk for chunk, entry in zip(distinct, found, strict=True) if entry < 0]
        entries = np.array(found, np.int64)
        entries[entries < 0] = np.arange(len(self.known), len(self.known) + len(new))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.a.add(new)
        self.b.add(new)
        return entries[coded.indices.to_numpy(zero_copy_only=False)]


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(path_a: str, path_b: str) -> Tokenizers:
    """Both tokenizers, loaded once per worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Tokenizers(path_a, path_b)
        release()
    return _loaded[path_a, path_b]


def chunks_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks start in texts that begin with a space each (``starts``, one more at the end).

    Also at each space between a printable ASCII character and one that is no ASCII white space.
    """
    black = (data > 0x20) & (data != 0x7F)
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 0x20) & black[:-2] & (data[:-2] < 0x7F) & black[2:]
    # A text's last byte may be a space; what follows it is another text's.
    ends = starts[1:] - 1
    cut[ends[ends > 0]] = False
    cut[starts[:-1]] = True
    return np.flatnonzero(cut)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with a space before each, and where each starts."""
    data, starts = text_bytes(column)
    shifted = starts + np.arange(len(starts))
    out = np.full(len(data) + len(starts) - 1, 0x20, np.uint8)
    out[ranges(shifted[:-1] + 1, np.diff(starts))] = data
    return out, shifted


class Aligned:
    """Tokens, groups and links of some distinct texts, none of them NULL or empty."""

    def __init__(self, texts: pa.Array, path_a: str, path_b: str) -> None:
        self.texts = texts
        both = tokenizers_of(path_a, path_b)
        self.a, self.b = both.a, both.b
        data, starts = _texts(texts)
        cuts = chunks_of(data, starts)
        offsets = pa.array(np.append(cuts, len(data)), pa.int64())
        chunks = pa.LargeStringArray.from_buffers(len(cuts), offsets.buffers()[1], pa.py_buffer(data))
        owner = np.searchsorted(starts, cuts, "right") - 1
        entries = both.entries(chunks)
        tokens, agree = [], np.ones(len(texts), bool)
        for side in (self.a, self.b):
            ids, counts = side.tokens(entries)
            of_text = np.repeat(owner, counts)
            sizes = side.sizes[ids]
            held = np.bincount(of_text, sizes, len(texts)).astype(np.int64)
            agree &= held == np.diff(starts)
            tokens.append((ids, of_text, sizes))
        for side, (ids, of_text, sizes) in zip((self.a, self.b), tokens, strict=True):
            keep = agree[of_text]
            got = side.blob[ranges(side.starts[ids[keep]], sizes[keep])]
            fit = np.flatnonzero(agree)
            wanted = data[ranges(starts[fit], np.diff(starts)[fit])]
            wrong = np.flatnonzero(got != wanted)
            at = np.cumsum(np.diff(starts)[fit])
            agree[fit[np.unique(np.searchsorted(at, wrong, "right"))]] = False
        sides = []
        for ids, of_text, sizes in tokens:
            keep = agree[of_text]
            sides.append((ids[keep], of_text[keep], sizes[keep]))
        (self.ids_a, self.text_a, sizes_a), (self.ids_b, self.text_b, sizes_b) = sides
        # As both sides have the same bytes now, places in the joined bytes of what is left are the same for both.
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        count = len(shared)
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=count), np.bincount(self.group_b, minlength=count)
        self.group_text = np.zeros(count, np.int64)
        self.group_text[self.group_a] = self.text_a

    def numbers(self) -> list[np.ndarray]:
        """``n_a``, ``n_b``, ``n_groups`` and ``n_links`` of each text."""
        n = len(self.texts)
        links = np.zeros(n, np.int64)
        np.add.at(links, self.group_text, self.in_a * self.in_b)
        return [np.bincount(x, minlength=n).astype(np.int64) for x in (self.text_a, self.text_b, self.group_text)] + [links]

    def digests(self) -> list[bytes | None]:
        """SHA-256 of each text's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        before_a = np.cumsum(self.in_a) - self.in_a
        before_b = np.cumsum(self.in_b) - self.in_b
        # Places of tokens when each group's A tokens stand before its B tokens.
        place_a = np.arange(len(self.ids_a)) + before_b[self.group_a]
        place_b = np.arange(len(self.ids_b)) + (before_a + self.in_a)[self.group_b]
        total = len(self.ids_a) + len(self.ids_b)
        sizes, text, mark = np.zeros(total, np.int64), np.zeros(total, np.int64), np.full(total, ord(","), np.uint8)
        for place, side, ids, of_text in ((place_a, self.a, self.ids_a, self.text_a), (place_b, self.b, self.ids_b, self.text_b)):
            sizes[place], text[place] = side.name_sizes[ids], of_text
        mark[before_a + before_b + self.in_a - 1] = ord("|")
        mark[before_a + before_b + self.in_a + self.in_b - 1] = ord(";")
        ends = np.cumsum(sizes)
        out = np.zeros(int(ends[-1]) if total else 0, np.uint8)
        for place, side, ids in ((place_a, self.a, self.ids_a), (place_b, self.b, self.ids_b)):
            out[ranges(ends[place] - sizes[place], sizes[place])] = side.names[ranges(side.name_starts[ids], side.name_sizes[ids])]
        out[ends - 1] = mark
        first = np.searchsorted(text, np.arange(len(self.texts) + 1))
        edges = np.concatenate([[0], ends])[first].tolist()
        raw = out.tobytes()
        # The last separator of a text isn't part of it.
        return [hashlib.sha256(raw[lo : hi - 1]).digest() if hi > lo else None for lo, hi in zip(edges, edges[1:], strict=False)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, id pair (A's id * number of B's ids + B's id) and links of each distinct pair of a text, in order."""
        width, wide = len(self.b.sizes), len(self.a.sizes) * len(self.b.sizes)
        starts_a = np.cumsum(self.in_a) - self.in_a
        starts_b = np.cumsum(self.in_b) - self.in_b
        product = self.in_a * self.in_b
        keys, counts = [], []
        edges, at = np.concatenate([[0], np.cumsum(product)]), 0
        while at < len(product):
            to = max(at + 1, int(np.searchsorted(edges, edges[at] + STEP, "right")) - 1)
            some = slice(at, to)
            ids_a = self.ids_a[starts_a[at] : starts_a[to - 1] + self.in_a[to - 1]].astype(np.int64)
            ids_b = self.ids_b[starts_b[at] : starts_b[to - 1] + self.in_b[to - 1]].astype(np.int64)
            of = self.group_text[some]
            if to == at + 1 and product[at] > STEP:
                # A group as large as this goes by its distinct ids, a few of A's at a time.
                (ids_a, na), (ids_b, nb) = np.unique(ids_a, return_counts=True), np.unique(ids_b, return_counts=True)
                step = max(1, STEP // len(ids_b))
                for lo in range(0, len(ids_a), step):
                    keys.append((of[0] * wide + ids_a[lo : lo + step, None] * width + ids_b[None, :]).ravel())
                    counts.append((na[lo : lo + step, None] * nb[None, :]).ravel())
            else:
                na, nb = self.in_a[some], self.in_b[some]
                begin_a, begin_b = np.cumsum(na) - na, np.cumsum(nb) - nb
                # Each A token of a group meets the group's B tokens.
                times = np.repeat(nb, na)
                left = np.repeat(ids_a, times)
                right = ids_b[ranges(np.repeat(begin_b, na), times)]
                found, n = np.unique(np.repeat(of, na * nb) * wide + left * width + right, return_counts=True)
                keys.append(found)
                counts.append(n)
            at = to
        if not keys:
            return (np.zeros(0, np.int64),) * 3
        key, n = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[head] // wide, key[head] % wide, np.add.reduceat(n, head)


_TEXTS = (
    "block int, digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups binary, pairs binary, links binary"
)


def aligned_texts(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each distinct text with its numbers, the digest of its groups, its id pairs and their links; written."""
    names = [field.split()[0] for field in _TEXTS.split(", ")]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part in slices(batch, "text", PART_BYTES):
                found = Aligned(part.column("text"), path_a, path_b)
                text, pair, links = found.pairs()
                edges = np.searchsorted(text, np.arange(part.num_rows + 1)).tolist()
                cuts = list(zip(edges, edges[1:], strict=False))
                columns = [part.column("block"), part.column("digest"), part.column("copies"), *map(pa.array, found.numbers())]
                columns += [pa.array(x, pa.binary()) for x in (
                    found.digests(), [packed_keys(pair[lo:hi].astype(np.uint64)) for lo, hi in cuts], [planes(links[lo:hi]) for lo, hi in cuts],
                )]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # Copies of a text are combined in each task, then the texts are dealt by their whole content.
    distinct = documents.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    dealt = blocks_of(distinct, "text").select("block", "text", text_digest(F.col("text")).alias("digest"), "copies")
    return written(dealt.mapInArrow(align, _TEXTS), "aligned")


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct id pairs of each block in a batch, with the number of documents that hold them."""
    for batch in batches:
        blocks, copies = batch.column("block").to_numpy(), batch.column("copies").to_numpy()
        pairs = batch.column("pairs")
        for block in np.unique(blocks).tolist():
            rows = np.flatnonzero(blocks == block).tolist()
            held = [unpacked_keys(pairs[row].as_py()) for row in rows]
            if not sum(map(len, held)):
                continue
            keys, at = np.unique(np.concatenate(held), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, np.repeat(copies[rows], [len(x) for x in held]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), block, np.int32)), pa.array(keys.astype(np.int64)), pa.array(sums)], names=["block", "pair", "docs"]
            )


def pair_counts(texts: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """``block``, ``pair`` of each block; and each ``pair`` with its ``count`` and whether it is its A id's ``best``."""
    own = texts.select("block", "copies", "pairs").mapInArrow(_block_pairs, "block int, pair long, docs long")
    own = written(own.groupBy("block", "pair").agg(F.sum("docs").alias("docs")), "pairs")
    counts = own.groupBy("pair").agg(F.sum("docs").alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return own.select("block", "pair"), counts.select("pair", "count", (F.col("count") == highest).alias("best"))


_MEASURED = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups binary"


def _measured(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Measures of a block's texts from the counts of its pairs."""
    counts = counts.sort_by("pair").combine_chunks()
    keys, count, best = (counts.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "count", "best"))
    n_best, sums = [], []
    for pairs, links in zip(texts.column("pairs"), texts.column("links"), strict=True):
        at = np.searchsorted(keys, unpacked_keys(pairs.as_py()).astype(np.int64))
        links = from_planes(links.as_py())
        n_best.append(int(links[best[at]].sum()))
        sums.append(int((links * count[at]).sum()))
    names = [field.split()[0] for field in _MEASURED.split(", ")]
    out = texts.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
    return out.select(names).cast(pa.schema([(n, pa.binary() if n in ("digest", "groups") else pa.int64()) for n in names]))


def measures(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document (``doc_id``, ``text``): numbers of tokens, groups and links, and what the counts make of them."""
    texts = aligned_texts(documents, path_a, path_b)
    own, counts = pair_counts(texts, len(tokenizers_of(path_a, path_b).b.sizes))
    answers = own.join(counts, "pair")
    measured = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_measured, _MEASURED)
    measured = written(measured, "measured")
    text = F.when(F.col("text") != "", F.col("text"))
    # Rows without a text have no group and are dealt by themselves.
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text.isNotNull(), text_digest(text)).alias("digest"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    found = join_groups(rows.where("digest is not null"), measured, "digest", "copies").select(
        "doc_id", *numbers, F.coalesce(F.lower(F.hex("groups")), F.lit("")).alias("groups_sha256")
    )
    zero = F.lit(0).cast("long")
    none = rows.where("digest is null").select("doc_id", *[zero.alias(n) for n in numbers], F.lit("").alias("groups_sha256"))
    return found.unionByName(none)
