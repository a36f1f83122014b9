"""Text folding and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from kvetch.operators.automaton import Automaton, rewrite_longest, steps

# U+3000 and U+FF01..U+FF5E, and what they fold to.
# Fixed values.
FULL_WIDTH = "\u3000" + "".join(chr(code) for code in range(0xFF01, 0xFF5F))
HALF_WIDTH = " " + "".join(chr(code - 65248) for code in range(0xFF01, 0xFF5F))

_ANY_FULL_WIDTH = "[\u3000\uff01-\uff5e]"

WORD = r"\p{L}+"

# Stop words of the training scan and of the feature selection.
TRAINING_STOP_WORDS = ("的", "很", "啊", "手机", "吧", "呀", "了")
FEATURE_STOP_WORDS = ("的", "很", "啊", "手机", "吧", "呀", "了", "@qq,com", "@", "qq", "com", "QQ")


def fold_width(text: Column) -> Column:
    """Full-width forms to half-width; everything else unchanged.

    Most texts have none, which a search tells at a third of the cost.
    """
    narrow = (F.octet_length(text) == F.length(text)) | ~F.rlike(text, F.lit(_ANY_FULL_WIDTH))
    return F.when(narrow, text).otherwise(F.translate(text, FULL_WIDTH, HALF_WIDTH))


def fold_variants(text: Column, variants: Mapping[str, str]) -> Column:
    """Replace characters and phrases by a caller-supplied table (traditional to simplified).

    At each place, from left to right, the longest phrase of the table is replaced by what it stands for, which may have
    any length and is not looked at again. A table of single characters is an expression, one with phrases is
    walked on Arrow batches.
    """
    if "" in variants:
        raise ValueError("variants of nothing")
    if not variants:
        return text
    if all(len(old) == 1 and len(new) == 1 for old, new in variants.items()):
        return F.translate(text, "".join(variants), "".join(variants.values()))
    automaton, outputs = Automaton.of(variants), pa.array(variants.values(), pa.string())

    @F.arrow_udf("string")
    def folded(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([rewrite_longest(automaton, part, outputs) for part in steps(texts)])

    return folded(text)


def normalize(text: Column, variants: Mapping[str, str] | None = None) -> Column:
    return F.lower(fold_variants(fold_width(text), variants or {}))


def tokenize(text: Column, normalized: bool = True, variants: Mapping[str, str] | None = None) -> Column:
    """Letter runs of a text in spaced script: ordered, repeats kept."""
    source = normalize(text, variants) if normalized else text
    return F.regexp_extract_all(source, F.lit(WORD), F.lit(0))


def without_words(tokens: Column, words: Iterable[str]) -> Column:
    """Drop listed tokens; order and repeats of the others stay."""
    listed = sorted(set(words))
    return F.filter(tokens, lambda word: ~word.isin(listed)) if listed else tokens
