"""License scan, fingerprints, classifier and language model against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import texts
import xxhash
from pyspark.sql import functions as F

from kvetch.llm import backoff_lm, license_scan, quality_gam, queries, syncmers

LICENSES = [
    (7001, "Licensed under the Apache License, Version 2.0."), (7002, "MIT License mit-license MIT\nLICENSE"),
    (7003, "This work is licensed under the GNU General Public License, version 3 or later. GPL v3"),
    (7004, "CC BY cc-by CC BY-NC-SA 4.0 creativecommons.org/licenses/by/4.0"), (7005, "mit der Lizenz; ümit license; mit licenses"),
    (7006, "SPDX-License-Identifier: GPL-2.0-only"), (7007, "all rights reserved " * 40 + "apache license"), (7008, "Apache License apache license"),
]


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(texts.LOWER))


def scanned(text):
    """What the rules say, by Python's regular expressions over single-spaced words."""
    found = license_words(text)
    form = "".join(f" {w} " for w in found)
    base = [
        (k, label, len(p.split())) for p, label in license_scan.BASE.items()
        for k in range(len(found)) if found[k : k + len(p.split())] == p.split()
    ]
    hits = []
    for number, rule in enumerate(license_scan.all_rules()):
        if f" {rule.keyword} " in form:
            for m in re.finditer(license_scan.expression(rule.pattern), form):
                first = form[: m.start()].count(" ") // 2
                hits.append((first, -(first + m.group().count(" ") // 2 - 1), -rule.priority, number))
    kept = []
    for h in sorted(hits):
        if not any(k[1] <= h[1] and k[2] <= h[2] for k in hits if k < h):
            kept.append(h)
    rules = license_scan.all_rules()
    labels = {label for _, label, _ in base} | {rules[h[3]].label for h in kept}
    weight = max([rules[h[3]].weight for h in kept] + [0.5 if base else 0.0])
    places = [k for k, _, _ in base]
    return (
        len(found), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x, _ in base})),
        ",".join(sorted(labels)), weight,
    )


def test_license_scan_equals_plain_python(spark, rows):
    cases = LICENSES + rows
    got = license_scan.scan(texts.table(spark, cases)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *scanned(t)) for i, t in cases), key=repr)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7001]["labels"] == "apache,apache-2.0" and by_id[7003]["labels"] == "gpl,gpl-3,gpl-3-or-later"
    assert (by_id[7002]["n_base"], by_id[7002]["first_word"], by_id[7002]["last_word"]) == (3, 0, 4)
    assert by_id[7005]["n_base"] == 0 and by_id[7008]["n_base"] == 2
    assert by_id[1003]["n_words"] == 0 and by_id[1001]["labels"] == "" and by_id[1001]["score"] == 0


def test_license_rules_are_ordered_and_gated():
    rules = license_scan.all_rules()
    assert len(rules) > 300 and all(0 < r.weight <= 1 and 0 <= r.priority < 10 for r in rules)
    assert all(license_scan.BASE_WEIGHT <= r.weight for r in rules)


def wordings(pattern):
    """Examples of what a pattern matches: all choices, repeated parts none, one and two times."""
    def of(tree):
        out = [""]
        for op, value in tree:
            name = str(op)
            if name == "LITERAL":
                more = [chr(value)]
            elif name == "IN":
                more = [chr(x if str(kind) == "LITERAL" else x[0]) for kind, x in value]
            elif name == "BRANCH":
                more = [x for branch in value[1] for x in of(branch)]
            elif name == "SUBPATTERN":
                more = of(value[-1])
            else:
                assert name in ("MAX_REPEAT", "POSSESSIVE_REPEAT")
                more = [x * k for x in of(value[2]) for k in range(value[0], min(value[1], 2) + 1)]
            out = [a + b for a in out for b in dict.fromkeys(more)]
        return out

    return list(dict.fromkeys(of(re._parser.parse(pattern))))


def test_license_keywords_are_words_of_every_match():
    for rule in license_scan.all_rules():
        for wording in wordings(rule.pattern):
            assert rule.keyword in wording.split(), (rule, wording)


def test_license_scan_with_its_gate_equals_all_rules_tried(spark):
    cases = [
        "Educational Community License, Version 2.0", "THE BEER-WARE LICENSE (Revision 42)", "Beerware licence", "SPDX 0BSD", "0BSD License",
        "0-BSD", "Zero-Clause BSD", "The Unlicence", "The Unlicense", "WTFPL", "do what the fuck you want to public license",
    ] + [max(wordings(r.pattern), key=len) for r in license_scan.all_rules()[::5]]

    def ungated(text):
        found = license_words(text)
        form, rules = "".join(f" {w} " for w in found), license_scan.all_rules()
        hits = []
        for number, rule in enumerate(rules):
            for m in re.finditer(license_scan.expression(rule.pattern), form):
                first = form[: m.start()].count(" ") // 2
                hits.append((first, -(first + m.group().count(" ") // 2 - 1), -rule.priority, number))
        kept = [h for h in hits if not any(k[1] <= h[1] and k[2] <= h[2] for k in hits if k < h)]
        base = {label for p, label in license_scan.BASE.items() if f" {p.replace(' ', '  ')} " in form}
        labels = base | {rules[h[3]].label for h in kept}
        return ",".join(sorted(labels)), max([rules[h[3]].weight for h in kept] + [0.5 if base else 0.0])

    got = license_scan.scan(texts.table(spark, list(enumerate(cases)))).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got} == {k: ungated(t) for k, t in enumerate(cases)}
    assert [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])[:9]] == [
        "ecl-2.0", "beerware", "beerware", "0bsd", "0bsd", "0bsd", "0bsd", "unlicense", "unlicense"
    ]


def test_edited_texts_and_likeness(spark, documents, rows):
    got = syncmers.compare_with_next(documents).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(want, key=repr)
    marks = {}
    for (i, t) in order:
        marks.setdefault(t or "", set()).update(r["fingerprint"] for r in got if r["doc_id"] == i and i not in (1004,))
    assert all(len(x) <= 1 for x in marks.values())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert all((r["fingerprint"] == "") == (r["n_chars"] == 0) for r in got)
    assert sum(r["near_edited"] for r in got) > sum(r["near_next"] for r in got)


def murmur(values, seed=42):
    """Spark's hash of ints and longs (given as value, width in words)."""
    def rotated(x, n):
        return (x << n | x >> (32 - n)) & 0xFFFFFFFF

    h = seed
    for value, n_words in values:
        value &= (1 << 32 * n_words) - 1
        for k in range(n_words):
            h ^= rotated((value >> 32 * k & 0xFFFFFFFF) * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
            h = (rotated(h, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
        h ^= 4 * n_words
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    return h - (h >> 31 << 32)


def syncmer_links(text):
    """The fingerprint by its definition; None where it is the hash of the whole text."""
    spaced = f"[{syncmers.SPACED}]".replace(r"\x{", r"\U{")
    spaced = re.sub(r"\\U\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", spaced)
    tokens = []
    for run, single in re.findall(rf"({spaced}+)|([^\x00-\x7F])", text):
        tokens += [single] if single else [run] if len(run) <= syncmers.TOKEN else list(run)
    inner = []
    for x, y in zip(tokens, tokens[1:], strict=False):
        h = xxhash.xxh64_intdigest(y.encode(), xxhash.xxh64_intdigest(x.encode(), 42))
        inner.append(h - (h >> 63 << 64))
    found = []
    for k in range(len(inner) - 3):
        part = inner[k : k + 4]
        if min(part) in (part[0], part[3]):
            found.append((k, murmur([(part[0], 2), (part[2], 2), (part[3], 2)])))
    if not text:
        return []
    if len(found) < 2:
        return [h for _, h in found] or None
    return [murmur([(x, 1), (b - a, 1), (y, 1)]) for (a, x), (b, y) in zip(found, found[1:], strict=False)]


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(5)
    passage = texts.sentence(rng, 500)
    han = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(4000))
    table = [t for _, t in texts.corpus(30)] + [
        f"{texts.sentence(rng, 30000)} {passage} {texts.sentence(rng, 50)}", f"{texts.sentence(rng, 200)} {passage} {texts.sentence(rng, 30000)}",
        han, "好" + han, "q" + "".join(rng.choices("acgt", k=3000)), "\u0e01\u0e02\u0e03 a1 \U0001f600\U00020001 " * 20, "a b " * 50, "one two", "",
    ]
    got = {r["doc_id"]: r for r in syncmers.compare_with_next(texts.table(spark, list(enumerate(table)))).collect()}

    def hexed(links):
        return "".join(f"{x & 0xFFFFFFFF:08x}" for x in links)

    def alike(a, b):
        return 1.0 if a == b else len(set(a) & set(b)) / len(set(a) | set(b))

    for k, text in enumerate(table):
        after = table[(k + 1) % len(table)]
        links, edited, following = (syncmer_links(x) for x in (text, text[: len(text) - len(text) // 2] + after[: len(text) // 2], after))
        if links is not None:
            assert got[k]["fingerprint"] == hexed(links)
        if edited is not None:
            assert got[k]["edited_fingerprint"] == hexed(edited)
        if None not in (links, edited, following):
            assert got[k]["near_edited"] == pytest.approx(alike(links, edited), abs=1e-12)
            assert got[k]["near_next"] == pytest.approx(alike(links, following), abs=1e-12)
    # A passage shared by long texts, and a character put in front of an unspaced text.
    assert 0.005 < got[30]["near_next"] < 0.02 and got[32]["near_next"] > 0.99


def test_fingerprints_of_other_ranges(spark, rows):
    table = texts.table(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one, many = (
        sorted((r["doc_id"] or -1, r["text"], r["next"]["text"]) for r in syncmers.with_next(table, ["text"], n).collect())
        for n in (1 << 30, 200)
    )
    assert one == many
    single = syncmers.compare_with_next(texts.table(spark, [(5, "a lonely text with enough words to have anchors here")])).collect()[0]
    assert single["near_next"] == 1.0
    assert syncmers.compare_with_next(texts.table(spark, [])).count() == 0


def test_syncmers_are_free_of_context(spark):
    rng = random.Random(1)
    passage = texts.sentence(rng, 60)
    rows = [(1, passage), (2, f"{texts.sentence(rng, 17)} {passage} {texts.sentence(rng, 9)}")]
    one, two = (r["anchors"] for r in syncmers.with_anchors(texts.table(spark, rows)).orderBy("doc_id").collect())
    assert 10 < len(one) < 56
    assert {(a["place"] + 17, a["hash"]) for a in one} <= {(a["place"], a["hash"]) for a in two}
    # The definition, on the s-mers' hashes.
    inner = [r[0] for r in spark.createDataFrame([(passage,)], "text string").select(
        F.explode(syncmers.inner_hashes(syncmers.tokens(F.col("text"))))
    ).collect()]
    width = syncmers.K - syncmers.S
    closed = [k for k in range(len(inner) - width) if min(inner[k : k + width + 1]) in (inner[k], inner[k + width])]
    assert [a["place"] for a in one] == closed


def labelled(n=400, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        text, good = texts.sentence(rng, rng.choice([20, 60, 150])), k % 5 != 0
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", " %%% "), " | ".join(text.split(" ")[:8])])
        rows.append((k, text))
        labels.append((k, int(good), 0))
    return rows, labels


def test_classifier_on_held_out_rows(spark):
    rows, labels = labelled()
    got = quality_gam.classify(
        texts.table(spark, rows + texts.ODD), spark.createDataFrame(labels + [(9999, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    ).collect()
    assert len(got) == len(rows) + len(texts.ODD)
    truth = {i: q for i, q, _ in labels}
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(tested) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.95
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_classifier_learns_interactions():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert (0, 2) in model.pairs
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    # Scores are sums of table entries.
    flat = quality_gam.Model(model.base, model.cuts, model.tables, [], model.pair_cuts, [])
    assert not np.allclose(flat.score(x[:5]), model.score(x[:5]))


def test_classifier_without_labels_or_with_one_class(spark):
    rows, labels = labelled(40)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_gam.classify(texts.table(spark, rows), none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i, _, _ in labels], "doc_id long, quality int")
    assert min(r["score"] for r in quality_gam.classify(texts.table(spark, rows), one).collect()) > 0.8
    assert quality_gam.keep_good(texts.table(spark, []), none).count() == 0


def test_labelled_id_on_many_rows_stays_within_the_sample(spark, monkeypatch):
    rows, labels = labelled(60)
    hot = next(r[0] for r in labels if zlib.crc32(str(r[0]).encode()) % 5)
    documents = texts.table(spark, [*rows, *[(hot, f"copy {k} of a hot id") for k in range(300)]])
    seen, fit = [], quality_gam.fit
    monkeypatch.setattr(quality_gam, "fit", lambda x, y: seen.append((x, y)) or fit(x, y))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for _ in range(2):
        quality_gam.train(documents, table, 40)
    assert len(seen[0][0]) == len(seen[0][1]) == 40
    assert np.array_equal(seen[0][0], seen[1][0]) and np.array_equal(seen[0][1], seen[1][1])


def test_kept_documents_keep_their_columns(spark):
    rows, labels = labelled()
    table = texts.table(spark, rows)
    kept = quality_gam.keep_good(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == table.columns
    good = {i for i, q, _ in labels if q}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(good - ids) <= 3 and len(ids - good) <= 6


def model_scores(rows, order, strength):
    docs = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, [*texts.words(t), None]) for i, t in rows]
    count = Counter()
    for _, held, found in docs:
        if not held:
            padded = [0, *found]
            for size in range(1, order + 1):
                count.update(tuple(padded[k - size + 1 : k + 1]) for k in range(size - 1, len(padded)))
    tokens = {g: c for g, c in count.items() if len(g) == 1 and g != (0,)}
    total, kinds = sum(tokens.values()), len(tokens)
    out = []
    for i, held, found in docs:
        padded, base, score = [0, *found], 0.0, 0.0
        for k in range(1, len(padded)):
            p = (tokens.get((padded[k],), 0) + 1) / (total + kinds + 1)
            base += math.log10(p)
            for size in range(2, min(order, k + 1) + 1):
                gram = tuple(padded[k - size + 1 : k + 1])
                p = (count[gram] + strength * p) / (count[gram[:-1]] + strength)
            score += math.log10(p)
        out.append((i, held, len(found), sum((w,) in tokens for w in found), total, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores_equal_plain_python(documents, rows, order):
    key = repr
    got = sorted((tuple(r) for r in backoff_lm.score(documents, order, 3.0).collect()), key=lambda r: key(r[:5]) + key(round(r[5], 6)))
    want = sorted(model_scores(rows, order, 3.0), key=lambda r: key(r[:5]) + key(round(r[5], 6)))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-8)


def test_registered_model_knows_contexts_of_two_words(spark, rows, tmp_path):
    texts.table(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["score"] for r in queries.op8_backoff_lm(spark, str(tmp_path)).collect()))
    assert np.allclose(got, sorted(r[6] for r in model_scores(rows, 3, backoff_lm.STRENGTH)), atol=1e-8)
    assert not np.allclose(got, sorted(r[6] for r in model_scores(rows, 2, backoff_lm.STRENGTH)), atol=1e-3)


def test_backoff_probabilities_of_a_state_sum_to_one(spark):
    """All continuations of a history, as the ends of texts that aren't learned from."""
    rows = [(i, "a b a c a b d") for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2]
    tokens = ["a", "b", "c", "d", "unseen"]
    trials = [(held[0], "a")] + [(held[k + 1], f"a {w}") for k, w in enumerate(tokens)]
    got = {r["doc_id"]: r["score"] for r in backoff_lm.score(texts.table(spark, rows + trials)).collect()}
    ends = model_scores(rows + trials, 2, backoff_lm.STRENGTH)
    assert np.allclose([got[r[0]] for r in ends[len(rows):]], [r[6] for r in ends[len(rows):]])
    total, kinds = ends[0][4], 5
    c = Counter(w for _, t in rows for w in t.split()) | Counter({None: len(rows)})
    pairs = Counter(p for _, t in rows for p in zip(t.split(), [*t.split()[1:], None], strict=True))
    k = backoff_lm.STRENGTH
    weights = [(pairs["a", w] + k * (c[w] + 1) / (total + kinds + 1)) / (c["a"] + k) for w in ["a", "b", "c", "d", None, "unseen"]]
    assert abs(sum(weights) - 1) < 1e-9


def test_empty_tables(nothing):
    assert license_scan.scan(nothing).count() == 0
    assert backoff_lm.score(nothing).count() == 0


def test_rules_stand_long_repeats(spark):
    """Every rule's own words, and runs of numbers, some ten thousand times over: no rule may overflow the stack."""
    words = sorted({w for rule in license_scan.all_rules() for w in re.findall("[a-z0-9]+", rule.pattern) if len(w) > 1})
    rows = [(1, "spdx license identifier gpl" + " 1" * 30_000), (2, "spdx license identifier mit " + "gpl 2 0 " * 3_000), (3, " ".join(words) + " " + "licence version 2 0 or later " * 2_000)]
    got = {r["doc_id"]: r for r in license_scan.scan(texts.table(spark, rows)).collect()}
    assert "gpl" in got[1]["labels"].split(",") and got[1]["n_words"] == 30_004 and got[2]["n_words"] == 9_004
