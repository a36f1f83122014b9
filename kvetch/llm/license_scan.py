"""License scans by ordered signature rules.

A text's words (runs of digits, letters and characters beyond ASCII, A-Z in lower case) are written one after the other
with a space on either side of each. On that form work

* *base phrases*: each place where a phrase's words stand consecutively;
* *signature rules*: regular expressions over words, each with a label, a priority, a weight and a keyword. A rule is
  tried only where its keyword occurs. All places of a rule are intervals of words. An interval inside another one is
  suppressed, unless it has the higher priority; of equal intervals the rule that comes first in order stays. So
  ``GPL version 3 or later`` leaves one detection, not also those of ``GPL version 3`` and ``GPL``.

Everything is built-in expressions on the document's own row: nothing is shuffled, and long or hot documents move nowhere.
Texts without any keyword, nearly all, only have their words counted.

Labels are those of the base phrases found and of the rules that stay. The score is the greatest weight of what stays, base
phrases weighing ``BASE_WEIGHT``; 0 where nothing is found.

Defined cases: a NULL or empty text has 0 words and no labels. Repeated rows are scanned each, NULL ids stay NULL. Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvetch.llm.common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BASE_WEIGHT = 0.5


@dataclass(frozen=True)
class Rule:
    """A pattern over words: words apart by one space, ``(a|b)`` and ``(a )?`` as in regular expressions.

    The keyword is a word of all that the pattern matches.
    """

    label: str
    pattern: str
    keyword: str
    priority: int
    weight: float


# Families of licenses: keyword, names in words, label, versions. The versions are single words or several.
FAMILIES = [
    ("gnu", "gnu general public licen[sc]e", "gpl", ["1", "2", "3"]),
    ("gnu", "gnu lesser general public licen[sc]e", "lgpl", ["2 1", "3"]),
    ("gnu", "gnu library general public licen[sc]e", "lgpl", ["2"]),
    ("gnu", "gnu affero general public licen[sc]e", "agpl", ["1", "3"]),
    ("gnu", "gnu free documentation licen[sc]e", "gfdl", ["1 1", "1 2", "1 3"]),
    ("gpl", "gpl", "gpl", ["1", "2", "3"]),
    ("lgpl", "lgpl", "lgpl", ["2", "2 1", "3"]),
    ("agpl", "agpl", "agpl", ["1", "3"]),
    ("gfdl", "gfdl", "gfdl", ["1 1", "1 2", "1 3"]),
    ("apache", "apache( software)?( foundation)? licen[sc]e", "apache", ["1 0", "1 1", "2 0"]),
    ("mozilla", "mozilla public licen[sc]e", "mpl", ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", "mpl", ["1 0", "1 1", "2 0"]),
    ("eclipse", "eclipse public licen[sc]e", "epl", ["1 0", "2 0"]),
    ("european", "european union public licen[sc]e", "eupl", ["1 0", "1 1", "1 2"]),
    ("artistic", "artistic licen[sc]e", "artistic", ["1 0", "2 0"]),
    ("academic", "academic free licen[sc]e", "afl", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("open", "open software licen[sc]e", "osl", ["1 0", "1 1", "2 0", "2 1", "3 0"]),
    ("boost", "boost software licen[sc]e", "bsl", ["1 0"]),
    ("cddl", "cddl", "cddl", ["1 0", "1 1"]),
    ("common", "common development and distribution licen[sc]e", "cddl", ["1 0", "1 1"]),
    ("common", "common public licen[sc]e", "cpl", ["1 0"]),
    ("common", "common public attribution licen[sc]e", "cpal", ["1 0"]),
    ("zope", "zope public licen[sc]e", "zpl", ["1 1", "2 0", "2 1"]),
    ("educational", "educational community licen[sc]e", "ecl", ["1 0", "2 0"]),
    ("python", "python( software foundation)? licen[sc]e", "psf", ["2", "2 0"]),
    ("php", "php licen[sc]e", "php", ["3 0", "3 01"]),
    ("cecill", "cecill( free software licen[sc]e)?", "cecill", ["1 0", "1 1", "2 0", "2 1"]),
    ("open", "open database licen[sc]e", "odbl", ["1 0"]),
    ("sil", "sil open font licen[sc]e", "ofl", ["1 0", "1 1"]),
    ("latex", "latex project public licen[sc]e", "lppl", ["1 0", "1 1", "1 2", "1 3"]),
    ("reciprocal", "(microsoft )?reciprocal (public )?licen[sc]e", "rpl", ["1 1", "1 5"]),
    ("sleepycat", "sleepycat licen[sc]e", "sleepycat", []),
    ("ruby", "ruby licen[sc]e", "ruby", []),
]
# Creative Commons: what follows "cc" or "creative commons", with its label.
COMMONS = [
    ("by", "attribution", "cc-by"),
    ("by sa", "attribution share ?alike", "cc-by-sa"),
    ("by nc", "attribution non ?commercial", "cc-by-nc"),
    ("by nd", "attribution no ?deriv(ative)?s?( works)?", "cc-by-nd"),
    ("by nc sa", "attribution non ?commercial share ?alike", "cc-by-nc-sa"),
    ("by nc nd", "attribution non ?commercial no ?deriv(ative)?s?( works)?", "cc-by-nc-nd"),
]
COMMONS_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# Single signatures: label, pattern, keyword.
SINGLE = [
    ("mit", "mit licen[sc]e", "mit"),
    ("mit", "licen[sc]ed under( the)?( terms of the)? mit( licen[sc]e)?", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission"),
    ("x11", "x11 licen[sc]e", "x11"),
    ("isc", "isc licen[sc]e", "isc"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission"),
    ("0bsd", "(zero clause|0) bsd( licen[sc]e)?", "bsd"),
    ("0bsd", "0bsd( licen[sc]e)?", "0bsd"),
    ("0bsd", "zero clausebsd( licen[sc]e)?", "clausebsd"),
    ("bsd-2-clause", "(2|two) clause bsd( licen[sc]e)?", "bsd"),
    ("bsd-3-clause", "(3|three) clause bsd( licen[sc]e)?", "bsd"),
    ("bsd-4-clause", "(4|four) clause bsd( licen[sc]e)?", "bsd"),
    ("bsd-2-clause", "simplified bsd( licen[sc]e)?", "bsd"),
    ("bsd-2-clause", "bsd 2 clause( licen[sc]e)?", "bsd"),
    ("bsd-3-clause", "(new|modified|revised) bsd( licen[sc]e)?", "bsd"),
    ("bsd-3-clause", "bsd 3 clause( licen[sc]e)?", "bsd"),
    ("bsd", "bsd( style)? licen[sc]e", "bsd"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("zlib", "zlib( libpng)? licen[sc]e", "zlib"),
    ("unlicense", "the unlicense", "unlicense"),
    ("unlicense", "the unlicence", "unlicence"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "do what the fuck you want to public licen[sc]e", "fuck"),
    ("public-domain", "(in|into|to) the public domain", "domain"),
    ("public-domain", "public domain dedication", "domain"),
    ("cc0", "cc0( 1 0)?( universal)?", "cc0"),
    ("cc0", "creative commons zero", "commons"),
    ("all-rights-reserved", "all rights reserved", "reserved"),
    ("proprietary", "proprietary and confidential", "proprietary"),
    ("commercial", "commercial licen[sc]e", "commercial"),
    ("vim", "vim licen[sc]e", "vim"),
    ("json", "the software shall be used for good not evil", "evil"),
    ("beerware", "beer ware licen[sc]e", "ware"),
    ("beerware", "beerware licen[sc]e", "beerware"),
    ("openssl", "openssl licen[sc]e", "openssl"),
    ("curl", "curl licen[sc]e", "curl"),
    ("postgresql", "postgresql licen[sc]e", "postgresql"),
    ("unicode", "unicode( data files)? licen[sc]e", "unicode"),
    ("w3c", "w3c( software)? licen[sc]e", "w3c"),
    ("ncsa", "university of illinois( ncsa)?( open source)? licen[sc]e", "illinois"),
    ("ms-pl", "microsoft public licen[sc]e", "microsoft"),
]


def all_rules() -> list[Rule]:
    """The rules in order: the more a rule says, the earlier it comes."""
    rules = [
        Rule(label, f"spdx licen[sc]e identifier {label}( [0-9]+)*+( (only|or later))?", "spdx", 9, 1.0)
        for label in sorted({label for _, _, label, _ in FAMILIES})
    ]
    for keyword, name, label, versions in FAMILIES:
        for version in versions:
            number = f"(version |ver |v )?v?{version}" + ("( 0)?" if " " not in version else "")
            short = version.replace(" ", ".")
            later = "( of the licen[sc]e)?( or( at your option)? any later( version)?| or later| or newer)"
            rules.append(Rule(f"{label}-{short}-or-later", f"{name} {number}{later}", keyword, 7, 1.0))
            rules.append(Rule(f"{label}-{short}-only", f"{name} {number} only", keyword, 7, 1.0))
            rules.append(Rule(f"{label}-{short}", f"{name} {number}", keyword, 6, 0.95))
            rules.append(Rule(f"{label}-{short}", f"version {version} of the {name}", keyword, 6, 0.95))
        under = "(licen[sc]ed|released|distributed|available) under( the)?( terms of)?( the)?"
        rules.append(Rule(label, f"{under} {name}", keyword, 5, 0.9))
        rules.append(Rule(label, name, keyword, 4, 0.8 if "licen" in name else 0.6))
    for short, long, label in COMMONS:
        for version in COMMONS_VERSIONS:
            full = f"{label}-{version.replace(' ', '.')}"
            rules.append(Rule(full, f"cc {short}( licen[sc]e)? (version |v )?{version}", "cc", 7, 1.0))
            rules.append(Rule(full, f"creative commons {long} {version}", "commons", 7, 1.0))
            rules.append(Rule(full, f"creativecommons org licen[sc]es {short} {version}", "creativecommons", 8, 1.0))
        rules.append(Rule(label, f"creative commons {long}( licen[sc]e)?", "commons", 5, 0.9))
        rules.append(Rule(label, f"cc {short}", "cc", 4, 0.7))
    rules += [Rule(label, pattern, keyword, 4, 0.9) for label, pattern, keyword in SINGLE]
    return rules


def expression(pattern: str) -> str:
    """The pattern on the spaced form: two spaces lie between words, one of them its own and one the next word's."""
    # Groups that begin or end with a space carry the doubled one along.
    return f" {pattern.replace(' ', '  ').replace('  ?', '(  )?')} "


def spaced(text: Column) -> Column:
    """`` word  word `` of the text's words; empty without words."""
    words = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    return F.when(F.size(words) > 0, F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))).otherwise("")



def gathered(items: Column, state: Column, empty: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` collects in the field ``found`` while it carries ``state`` along the items.

    Arrays grow by copying, so items are taken in stretches as long as there are stretches: n items cost n to the power
    of 1.5 copied entries, not n squared.
    """
    width = F.ceil(F.sqrt(F.size(items))).cast("int")
    stretches = F.transform(
        F.sequence(F.lit(0), F.size(items) - 1, width), lambda at: F.slice(items, at + 1, width)
    )

    def stretch(acc: Column, part: Column) -> Column:
        start = F.struct(acc["state"].alias("state"), empty.alias("found"))
        return F.aggregate(
            part, start, step, lambda x: F.struct(x["state"].alias("state"), F.concat(acc["found"], x["found"]).alias("found"))
        )

    whole = F.aggregate(stretches, F.struct(state.alias("state"), empty.alias("found")), stretch, lambda acc: acc["found"])
    return F.when(F.size(items) > 0, whole).otherwise(empty)


def n_words(x: Column) -> Column:
    """Words of a part of the spaced form that has both spaces of each."""
    return ((F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit("")))) / 2).cast("int")


def intervals(lengths: Column) -> Column:
    """First and last word of each place, in order, from the words before it since the last one (``gap``) and in it (``hit``)."""
    def step(acc: Column, x: Column) -> Column:
        first = acc["state"] + x["gap"]
        place = F.struct(first.alias("first"), (first + x["hit"] - 1).alias("last"))
        return F.struct((first + x["hit"]).alias("state"), F.concat(acc["found"], F.array(place)).alias("found"))

    return gathered(lengths, F.lit(0), F.array().cast("array<struct<first:int,last:int>>"), step)


def with_detections(forms: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``detections``: all places in ``form`` of all rules whose keyword occurs, widest first from left to right.

    Each step is a column of its own, so that a pattern runs once to find and, where it does, once to split.
    """
    grouped: dict[str, list[tuple[int, Rule]]] = {}
    for k, rule in enumerate(rules):
        grouped.setdefault(rule.keyword, []).append((k, rule))
    table = F.array(*[
        F.struct(F.lit(f" {keyword} ").alias("keyword"), F.array(*[
            F.struct(F.lit(expression(r.pattern)).alias("pattern"), F.lit(-r.priority).alias("rank"), F.lit(k).alias("rule")) for k, r in group
        ]).alias("rules"))
        for keyword, group in grouped.items()
    ])
    form = F.col("form")
    tried = F.flatten(F.transform(F.filter(table, lambda x: F.contains(form, x["keyword"])), lambda x: x["rules"]))
    hits = F.transform(F.col("tried"), lambda r: F.struct(
        r["pattern"].alias("pattern"), r["rank"].alias("rank"), r["rule"].alias("rule"),
        F.regexp_extract_all(form, r["pattern"], F.lit(0)).alias("hits"),
    ))
    lengths = F.transform(F.filter("hit", lambda r: F.size(r["hits"]) > 0), lambda r: F.struct(
        r["rank"].alias("rank"), r["rule"].alias("rule"),
        F.filter(
            F.zip_with(F.split(form, r["pattern"], -1), r["hits"], lambda gap, hit: F.struct(n_words(gap).alias("gap"), n_words(hit).alias("hit"))),
            lambda x: x["hit"].isNotNull(),
        ).alias("lengths"),
    ))
    places = F.transform("lengths", lambda r: F.transform(intervals(r["lengths"]), lambda x: F.struct(
        x["first"].alias("first"), F.negate(x["last"]).alias("until"), r["rank"].alias("rank"), r["rule"].alias("rule")
    )))
    return (
        forms.withColumn("tried", F.when(form != "", tried)).withColumn("hit", hits).withColumn("lengths", lengths)
        .withColumn("detections", F.array_sort(F.flatten(places))).drop("tried", "hit", "lengths")
    )


def standing(found: Column) -> Column:
    """Drop what lies inside an interval of the same or a higher priority that sorts before it.

    For each priority the farthest end so far is carried along, so one pass over the sorted intervals decides.
    """
    levels = 10

    def step(acc: Column, x: Column) -> Column:
        last = F.negate(x["until"])
        level = F.negate(x["rank"])
        inside = F.exists(F.slice(acc["state"], level + 1, levels), lambda end: end >= last)
        ends = F.transform(acc["state"], lambda end, k: F.when(k == level, F.greatest(end, last)).otherwise(end))
        return F.when(inside, acc).otherwise(F.struct(ends.alias("state"), F.concat(acc["found"], F.array(x)).alias("found")))

    empty = F.array().cast("array<struct<first:int,until:int,rank:int,rule:int>>")
    return gathered(found, F.array_repeat(F.lit(-1), levels), empty, step)


def scan(documents: DataFrame, rules: list[Rule] | None = None, base: dict[str, str] = BASE) -> DataFrame:
    """Licenses of each document (``doc_id``, ``text``): counts, places, labels, score and ``detections``."""
    rules = all_rules() if rules is None else rules
    keywords = sorted({r.keyword for r in rules} | {p.split()[0] for p in base})
    gate = F.col("text").rlike(r"(?i)(?<![0-9a-z])(?:" + "|".join(map(re.escape, keywords)) + r")(?![0-9a-z])")
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    forms = texts.select(
        "doc_id", F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("n_words"),
        F.when(gate, spaced(F.col("text"))).otherwise("").alias("form"),
    )

    n_base, firsts, lasts, labels = F.lit(0).cast("long"), [], [], []
    for phrase, label in base.items():
        marked = f" {phrase.replace(' ', '  ')} "
        size = len(phrase.split())
        places = ((F.char_length("form") - F.char_length(F.replace("form", F.lit(marked), F.lit("")))) / len(marked)).cast("long")
        n_base = n_base + places
        here = F.contains("form", F.lit(marked))
        firsts.append(F.when(here, n_words(F.substring_index("form", marked, 1)).cast("long")))
        lasts.append(F.when(here, (n_words(F.col("form")) - n_words(F.substring_index("form", marked, -1)) - size).cast("long")))
        labels.append(F.when(here, F.lit(label)))
    found = with_detections(forms, rules).select(
        "doc_id", "n_words", n_base.alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base"), standing(F.col("detections")).alias("kept"),
    )
    names = F.array(*[F.lit(r.label) for r in rules])
    weights = F.array(*[F.lit(r.weight) for r in rules])
    kept = F.coalesce(F.col("kept.rule"), F.array().cast("array<int>"))
    staged = found.withColumn("rules", kept).withColumn(
        "all", F.array_sort(F.array_distinct(F.concat("base", F.transform("rules", lambda k: F.get(names, k)))))
    )
    best = F.array_max(F.transform("rules", lambda k: F.get(weights, k)))
    return staged.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join("all", ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_WEIGHT).otherwise(0.0)).alias("score"),
    )
