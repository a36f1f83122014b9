"""Packing by powers of two: no sequence crosses documents and none needs padding.

A document of n tokens is cut into pieces whose lengths are the binary digits of n: as many
pieces of the full length as fit, then one piece for each bit of the rest, longest first. Each
piece is a sequence of its own and goes to the bucket of its length, so a batch drawn from one
bucket has equal lengths.

A piece depends on its document alone: the job is one pass without a shuffle, and neither hot
sources nor copies skew it.

Defined cases: a NULL or empty text is the closing id alone, one piece of length 1. Repeated
rows and repeated ids are packed like any other row; a NULL id stays NULL. Empty tables give no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvetch.llm.common import ranges, release, released, slices, text_bytes, word_keys

FULL = 2048
END_ID = 1
# Distinct words whose ids a task keeps.
CACHE_WORDS = 1_000_000
# Words that the tokenizer gets at once, and text bytes that one step works on.
ENCODED_WORDS = 2_000
STEP_BYTES = 1 << 20
# Letters with ASCII punctuation behind them: the tokenizer cuts between the two, if normalising leaves the letters letters.
WORD = r"^(?P<core>\p{L}+)(?P<tail>[!-/:-@\[-`{-~]*)$"

LETTERS = r"^\p{L}+$"
# How the tokenizer normalises and cuts, and all that this module relies on.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts from a tokenizer that drops white space and never joins across it.

    Each distinct word is encoded once per task and then looked up, in flat arrays of some
    tens of bytes a word.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # A task has one core; threads of the tokenizer's own keep memory each.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        kinds = [part["type"] for part in (parts["normalizer"] or {}).get("normalizers", [])]
        cutters = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if kinds != NORMALIZERS or cutters[0].get("pattern") != {"Regex": CUT}:
            raise ValueError("the tokenizer has to drop white space and to cut letters from punctuation")
        self.clear()

    def clear(self) -> None:
        """Entry 0 is the empty word; entry k's ids and bytes end at ``ends[k]`` and ``stops[k]``."""
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes of words, ascending
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.blob, self.stops = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def known(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Entries of words by hash, confirmed by their bytes; -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        if len(self.keys) == 0:
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        entry, sizes = self.entry[at], np.diff(starts)
        hit = np.flatnonzero((self.keys[at] == keys) & (self.stops[entry] - self.stops[entry - 1] == sizes) & (sizes > 0))
        if len(hit):
            same = self.blob[ranges(self.stops[entry[hit] - 1], sizes[hit])] == data[ranges(starts[hit], sizes[hit])]
            whole = np.logical_and.reduceat(same, np.cumsum(sizes[hit]) - sizes[hit])
            out[hit[whole]] = entry[hit[whole]]
        return out

    def entries(self, words: pa.Array) -> np.ndarray:
        """Entries of distinct words without white space, after encoding the new ones."""
        data, starts = text_bytes(words)
        sizes = np.diff(starts)
        full = sizes > 0
        keys = np.zeros(len(sizes), np.uint64)
        keys[full] = word_keys(data, starts)[0]
        out = np.where(full, self.known(keys, data, starts), 0)
        new = np.flatnonzero(out < 0)
        if len(new) == 0:
            return out
        coded, counts = [self.ids], []
        for at in range(0, len(new), ENCODED_WORDS):
            part = words.take(pa.array(new[at : at + ENCODED_WORDS])).to_pylist()
            found = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            coded.append(np.fromiter(chain.from_iterable(found), np.int32, int(counts[-1].sum())))
        counts = np.concatenate(counts)
        first = len(self.ends)
        self.ids = np.concatenate(coded)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.blob = np.concatenate([self.blob, data[ranges(starts[new], sizes[new])]])
        self.stops = np.concatenate([self.stops, self.stops[-1] + np.cumsum(sizes[new])])
        out[new] = np.arange(first, first + len(new))
        order = np.argsort(keys[new], kind="stable")
        place = np.searchsorted(self.keys, keys[new][order])
        self.keys = np.insert(self.keys, place, keys[new][order])
        self.entry = np.insert(self.entry, place, out[new][order])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by END_ID, and where each text's ids start."""
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words, of_word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        parts = pc.extract_regex(words, WORD)
        letters = pc.fill_null(parts.field("core"), "")
        # U+0130 becomes two characters in lower case, and others do when they are composed: the second is no letter.
        other = pc.or_(pc.match_substring(letters, "\u0130"), pc.invert(pc.match_substring_regex(pc.utf8_normalize(letters, "NFC"), LETTERS)))
        whole = pc.or_(pc.is_null(parts), other)
        core = pc.if_else(whole, words, pc.ascii_lower(letters))
        tail = pc.if_else(whole, "", pc.fill_null(parts.field("tail"), ""))
        pair = []
        for side in (core, tail):
            coded_side = side.dictionary_encode()
            pair.append(self.entries(coded_side.dictionary)[coded_side.indices.to_numpy(zero_copy_only=False)])
        pair = np.stack(pair, 1)
        begin = np.where(pair > 0, self.ends[np.maximum(pair, 1) - 1], 0)
        size = np.where(pair > 0, self.ends[pair] - begin, 0)
        # The ids of each distinct word, then those of each place.
        flat = self.ids[ranges(begin.ravel(), size.ravel())]
        size = size.sum(1)
        begin = np.cumsum(size) - size
        bounds = split.offsets.to_numpy(zero_copy_only=False)
        bounds = bounds - bounds[0]
        counts = size[of_word]
        before = np.concatenate([[0], np.cumsum(counts)])
        starts = before[bounds] + np.arange(len(bounds))
        out = np.full(int(starts[-1]), END_ID, np.int32)
        spaces = np.ones(len(out), bool)
        spaces[starts[1:] - 1] = False
        out[spaces] = flat[ranges(begin[of_word], counts)]
        return out, starts


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def lengths(tokens: int, full: int = FULL) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    rest = tokens % full
    return [full] * (tokens // full) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pack(documents: DataFrame, tokenizer: str, full: int = FULL, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document (``doc_id``, ``text``); ``with_ids`` adds the token ids.

    ``sequence_id`` is unique within the result, ``bucket`` is the length's power of two.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def packed(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts = encoder(tokenizer).encode(part.column("text"))
        raw = ids.astype("<u4", copy=False)
        rows, columns = [], [[] for _ in range(4)]
        sizes = np.diff(starts).tolist()
        for row, (begin, total) in enumerate(zip(starts[:-1].tolist(), sizes, strict=True)):
            start = 0
            for length in lengths(total, full):
                crc = zlib.crc32(raw[begin + start : begin + start + length])
                rows.append(row)
                for column, value in zip(columns, (start, length, crc, total), strict=True):
                    column.append(value)
                start += length
        out = [part.column("doc_id").cast(pa.int64()).take(pa.array(rows, pa.int64()))]
        out += [pa.array(column, pa.int64()) for column in columns]
        if with_ids:
            # Pieces lie in the order of the ids, without gaps.
            ends = np.concatenate([[0], np.cumsum(columns[1])]).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
        return pa.RecordBatch.from_arrays(out, names=names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in released(batches):
                yield from map(packed, slices(batch, "text", STEP_BYTES))
                del batch
        finally:
            # The worker goes on to serve other stages: it keeps the tokenizer, not the words.
            if tokenizer in _encoders:
                _encoders[tokenizer].clear()
            release()

    cut = documents.select("doc_id", "text").mapInArrow(pieces, schema)
    return cut.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the pieces in one folder per length."""
    packed.write.partitionBy("bucket").parquet(path)
