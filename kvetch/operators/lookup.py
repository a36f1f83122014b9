"""Looking tokens up in word tables.

A word table whose size has been measured and is small travels to the tasks, so texts
are never shuffled. A larger one is joined: each distinct token array is exploded once,
joined on the word, and its matches are collected again per array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvetch.functions.rows import explode_rows
from kvetch.operators.bloom import word_filter

# Word tables up to these sizes are sent to every task.
MAX_ROWS = 1_000_000
MAX_BYTES = 128 << 20
# Word lists up to this length become literals of the plan.
MAX_LITERALS = 5_000


def fits(table: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Measure a table's rows and bytes."""
    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, T.NumericType | T.BooleanType):
            return F.lit(8)
        return F.octet_length(F.to_json(F.struct(field.name)))

    row = reduce(add, [width(field) for field in table.schema.fields])
    size = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def small_table(
    table: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> pa.Table | None:
    """The table's rows if it is within the limits, otherwise None. Its plan runs once."""
    own = not (table.storageLevel.useMemory or table.storageLevel.useDisk)
    if own:
        table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return table.toArrow() if fits(table, max_rows, max_bytes) else None
    finally:
        if own:
            table.unpersist()


# Words that are hashed, and tokens that are looked up, at a time.
_HASHED = 1 << 16
_TOKENS = 1 << 19


def _hashes(words: pa.Array) -> np.ndarray:
    parts = [words.slice(start, _HASHED).fill_null("").to_numpy(zero_copy_only=False) for start in range(0, len(words), _HASHED)]
    return np.concatenate([np.zeros(0, np.uint64), *[pd.util.hash_array(part, categorize=False) for part in parts]])


def finder(words: pa.Array) -> Callable[[pa.Array], np.ndarray]:
    """Places of tokens in ``words``, -1 for unknown ones. The index is built once, here.

    It is the words' hashes in order, 16 bytes a word and no Python string; a hit is compared with its word. Only the distinct tokens
    of a part of a batch are looked up.
    """
    words = words.cast(pa.large_string())
    hashes = _hashes(words)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    same = np.flatnonzero(hashes[1:] == hashes[:-1])
    # Different words of one hash are the rarest of things, and looked up as they are.
    twins = {words[place].as_py(): int(place) for at in same for place in order[at : at + 2]}

    def places(distinct: pa.Array) -> np.ndarray:
        if len(words) == 0:
            return np.full(len(distinct), -1)
        found = _hashes(distinct)
        at = order[np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)]
        hit = pc.fill_null(pc.equal(words.take(pa.array(at)), distinct), False).to_numpy(zero_copy_only=False)
        if twins:
            for k in np.flatnonzero(~hit):
                if (place := twins.get(distinct[k].as_py())) is not None:
                    at[k], hit[k] = place, True
        return np.where(hit, at, -1)

    def find(tokens: pa.Array) -> np.ndarray:
        found = [np.zeros(0, np.int64)]
        for start in range(0, len(tokens), _TOKENS):
            coded = tokens.slice(start, _TOKENS).dictionary_encode()
            known = places(coded.dictionary.cast(pa.large_string()))
            found.append(np.append(known, -1)[pc.fill_null(coded.indices, len(known)).to_numpy(zero_copy_only=False)])
        return np.concatenate(found)

    return find


def token_parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Token arrays in runs of a bounded number of tokens, unless one array has more."""
    before = np.cumsum(pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        done = before[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(before, done + _TOKENS, "right")))
        yield texts.slice(start, end - start)
        start = end


def lookup_join(left: DataFrame, table: DataFrame, how: str) -> DataFrame:
    """Join on ``word``: the table is broadcast if it is within the limits.

    Beyond them both sides are shuffled, and adaptive execution splits the rows of a hot
    word among tasks, as it can for any of the joins here.
    """
    return left.join(F.broadcast(table) if fits(table) else table, "word", how)


def fingerprint(tokens: Column) -> Column:
    """Key of a token array: its size and its tokens, with a separator no word holds."""
    return F.md5(F.concat_ws("\u0001", F.size(tokens).cast("string"), tokens))


def distinct_arrays(df: DataFrame, tokens: str) -> DataFrame:
    """``print``, ``tokens`` and number of ``copies`` of each distinct token array.

    Copies are combined before the shuffle, so a text that makes up much of the input
    costs no more than any other.
    """
    return (
        df.select(fingerprint(F.col(tokens)).alias("print"), F.col(tokens).alias("tokens"))
        .groupBy("print")
        .agg(F.first("tokens").alias("tokens"), F.count("*").alias("copies"))
    )


def matches(df: DataFrame, tokens: str, table: DataFrame, how: str = "inner") -> DataFrame:
    """``print``, ``copies``, ``pos``, ``word`` of the tokens of each distinct array that
    match ``table``.

    Other columns of the table follow.
    """
    words = explode_rows(distinct_arrays(df, tokens), "tokens", "word", "print", "copies", pos="pos")
    return lookup_join(words, table, how)


def with_matches(df: DataFrame, tokens: str, table: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """Add ``name``: the matches of each row's tokens in token order, as structs."""
    keyed = df.withColumn("print", fingerprint(F.col(tokens)))
    return _listed(keyed, matches(df, tokens, table, how), name)


def _listed(keyed: DataFrame, found: DataFrame, name: str) -> DataFrame:
    payload = [column for column in found.columns if column not in ("print", "copies", "pos")]
    listed = found.groupBy("print").agg(
        F.array_sort(F.collect_list(F.struct("pos", *payload))).alias(name)
    )
    return keyed.join(listed, "print", "left").drop("print").withColumn(
        name, F.coalesce(name, F.array())
    )


def with_rare_matches(df: DataFrame, tokens: str, table: DataFrame, name: str) -> DataFrame:
    """As :func:`with_matches`, for a large table that holds few of the tokens.

    A Bloom filter of the table's words is tested in the scan, and only tokens that pass it leave their row. Rows
    without any keep to themselves in the join that brings the matches back.
    """
    may_be = word_filter(table)
    numbered = F.transform(tokens, lambda word, pos: F.struct(pos.alias("pos"), word.alias("word")))
    held = df.withColumn("_held", may_be(F.col(tokens)))
    held = held.withColumn("_held", F.filter(numbered, lambda token: F.get("_held", token["pos"])))
    some = F.size("_held") > 0
    # Of rows without a match none has a partner, so each is dealt by itself.
    own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    keyed = held.withColumn("print", F.when(some, fingerprint(F.col(tokens))).otherwise(own))
    distinct = keyed.where(some).select("print", "_held").groupBy("print").agg(F.first("_held").alias("_held"))
    words = explode_rows(distinct, "_held", "token", "print").select("print", "token.pos", "token.word")
    return _listed(keyed.drop("_held"), lookup_join(words, table, "inner"), name)


def remove_words(df: DataFrame, tokens: str, words: DataFrame) -> DataFrame:
    """Drop the tokens listed in the one-column table ``words``; order and repeats stay.

    NULL tokens become an empty array.
    """
    listed = words.select(F.col(words.columns[0]).alias("word")).where("word is not null").distinct()
    few = small_table(listed, MAX_LITERALS)
    if few is not None:
        stop = few.column("word").to_pylist()
        held = F.coalesce(tokens, F.array().cast("array<string>"))
        return df.withColumn(tokens, F.filter(held, lambda word: ~word.isin(stop)) if stop else held)
    kept = with_matches(df, tokens, listed, "_kept", "left_anti")
    return kept.withColumn(tokens, F.col("_kept.word")).drop("_kept")
