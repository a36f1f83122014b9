"""Tokenizer alignment, the cuckoo index and the Merkle manifest."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import texts
from pyspark.sql import functions as F

from kvetch.llm import common, cuckoo_dedup, merkle_manifest, queries, tokenizer_alignment

BYTES, PIECES = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
TOKEN_CASES = [
    (2001, "<|endoftext|> <s> </s> <unk> <0x41>"), (2002, "a▁b"), (2003, " leading and trailing  "), (2004, "tabs\tand\n\nlines \n x  y"),
    (2005, "é" * 40 + " naïve 日本語 😀😀 ﬁ ½"), (2006, "x" * 5000), (2007, "  　  á \x00\x7f  .  ."), (2008, " "), (2009, "  "),
    (2010, "a "), (2011, "\n"), (2012, "!? ... 's 'S it's I'll’s 12345 67 ² a1b2"), (2013, " a b  c  d"), (2014, "日 本 語 "),
    (2015, "the cat" * 3), (2016, "the cat" * 3), (2016, "the cat" * 3),
]


def byte_level():
    """Bytes of A's symbols, in the usual way of byte-level vocabularies."""
    keep = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    out, n = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            out[chr(256 + n)] = b
            n += 1
    return out


def aligned(rows):
    """Rows of the result by whole texts, one after the other, with every link laid out."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    symbols, links_of, kept, docs = byte_level(), [], [], Counter()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    for i, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            parts_a = [bytes(symbols[c] for c in a.id_to_token(x)) for x in ids_a]
            parts_b = [b_bytes(x) for x in ids_b]
            if b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([*map(len, parts_a)]), np.cumsum([*map(len, parts_b)])
                cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
                groups = [([], []) for _ in cuts]
                for side, ids, ends in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
                    for x, end in zip(ids, ends.tolist(), strict=True):
                        groups[next(k for k, cut in enumerate(cuts) if cut >= end)][side].append(x)
        links = [(x, y) for left, right in groups for x in left for y in right]
        docs.update(set(links))
        links_of.append(links)
        kept.append((i, groups))
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for (i, groups), links in zip(kept, links_of, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def test_alignment_equals_brute_force(spark, rows):
    cases = rows + TOKEN_CASES
    got = tokenizer_alignment.measures(texts.table(spark, cases), BYTES, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == aligned(cases)


def test_chunks_are_cut_as_whole_texts(spark):
    """Random texts of awkward characters: ids by chunks are those of the whole text, for both tokenizers."""
    rng = random.Random(3)
    odd = list("ab,.'1 \t\n 　éß日😀́▁​!\x1f\x7f") + ["  ", " the", "'s ", "<s>", "▁▁", "A "]
    cases = ["".join(rng.choices(odd, k=rng.randint(1, 30))) for _ in range(3000)]
    both = tokenizer_alignment.tokenizers_of(BYTES, PIECES)
    a, b = both.a, both.b
    data, starts = tokenizer_alignment._texts(pa.array(cases))
    cuts = tokenizer_alignment.chunks_of(data, starts)
    raw = data.tobytes()
    chunks = [raw[lo:hi].decode() for lo, hi in zip(cuts.tolist(), [*cuts.tolist()[1:], len(raw)], strict=True)]
    owner = np.searchsorted(starts, cuts, "right") - 1
    for side, whole in ((a, [x.ids for x in a.tokenizer.encode_batch([" " + t for t in cases], add_special_tokens=False)]), (b, b.processor.encode(cases))):
        ids, counts = side.tokens(both.entries(pa.array(chunks, pa.large_string())))
        of_text = np.repeat(owner, counts)
        assert [ids[of_text == k].tolist() for k in range(len(cases))] == whole


def test_large_groups_by_distinct_ids(spark, monkeypatch):
    cases = pa.array(["日本語のテキスト" * 5, "a" * 300 + " " + "é" * 77, "b c d"])
    whole = [x.tolist() for x in tokenizer_alignment.Aligned(cases, BYTES, PIECES).pairs()]
    monkeypatch.setattr(tokenizer_alignment, "STEP", 3)
    found = tokenizer_alignment.Aligned(cases, BYTES, PIECES)
    assert [x.tolist() for x in found.pairs()] == whole
    assert sum(whole[2]) == found.numbers()[3].sum()


def test_alignment_refuses_other_files(spark, tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        tokenizer_alignment.ByteVocabulary(queries.tokenizer_path("word_bpe_49k.json"))


def test_alignment_of_a_hot_text_and_of_nothing(spark, nothing):
    cases = [(k, "the same text") for k in range(300)] + [(1000 + k, f"text {k}") for k in range(200)] + [(5000 + k, None) for k in range(200)]
    got = tokenizer_alignment.measures(texts.table(spark, cases), BYTES, PIECES).collect()
    assert sorted(map(tuple, got), key=repr) == aligned(cases)
    assert tokenizer_alignment.measures(nothing, BYTES, PIECES).count() == 0


# Exact dedup


def last_ones(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, keep, len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


HOT = [(k, "a text that a third of the rows hold") for k in range(400)] + [(399, "a text that a third of the rows hold")] * 30
HOT += [(None, "no ids at all")] * 25 + [(None, "same id, twice"), (7, "same id, twice"), (7, "same id, twice")] + [(k, f"own {k}") for k in range(300)]


@pytest.mark.parametrize("cases", [None, HOT])
def test_keep_last_equals_brute_force(spark, rows, cases, monkeypatch):
    monkeypatch.setattr(cuckoo_dedup, "EXPAND", 7)
    cases = cases or rows + texts.ODD
    got = cuckoo_dedup.keep_last(texts.table(spark, cases).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == last_ones(cases)


def test_runs_that_go_on_in_the_next_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = cuckoo_dedup.keep_last(texts.table(spark, HOT).repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=repr) == last_ones(HOT)


def test_keep_last_of_nothing(nothing):
    assert cuckoo_dedup.keep_last(nothing).count() == 0


def test_long_texts_differ_in_their_last_character(spark):
    cases = [(1, "x" * 3_000_000 + "a"), (2, "x" * 3_000_000 + "b"), (3, "x" * 3_000_000 + "a")]
    assert sorted(map(tuple, cuckoo_dedup.keep_last(texts.table(spark, cases)).collect()), key=repr) == last_ones(cases)


def test_filter_grows_and_forgets():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 60_000).astype(np.uint64)
    held = cuckoo_dedup.CuckooFilter()
    bits = []
    for part in np.array_split(keys, 40):
        held.insert(part)
        bits.append(held.bits)
    assert held.contains(keys).all() and bits == sorted(bits) and len(set(bits)) > 3
    assert len(keys) / held.table.size > 0.4
    others = rng.integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert held.contains(others).mean() < 0.002
    held.delete(keys[:30_000])
    assert held.contains(keys[30_000:]).all() and held.contains(keys[:30_000]).mean() < 0.002
    again = cuckoo_dedup.CuckooFilter.from_bytes(*held.to_bytes())
    assert again.contains(keys[30_000:]).all() and np.array_equal(again.keys, np.sort(keys[30_000:]))
    again.delete(keys[30_000:])
    assert not again.table.any() and len(again.keys) == 0
    with pytest.raises(ValueError):
        again.delete(keys[:1])
    with pytest.raises(ValueError):
        again.insert(np.full(30, 5, np.uint64))


def test_full_filter_is_made_anew_from_its_keys():
    held = cuckoo_dedup.CuckooFilter(bits=6)
    keys = np.arange(1, 241, dtype=np.uint64)
    held.insert(keys)
    assert held.bits >= 6 and held.contains(keys).all()
    held.delete(keys[::3])
    assert held.contains(np.delete(keys, np.s_[::3])).all()


def test_index_of_live_documents(spark):
    """Insertions and deletions in turn, against a plain table of the live rows."""
    rng = random.Random(5)
    index, live = cuckoo_dedup.Index.empty(spark, 3), []
    pool = [f"text number {k % 25}" for k in range(60)] + ["", None]
    for turn in range(3):
        new = [(turn * 100 + k, rng.choice(pool)) for k in range(40)] + [(None, "text number 1")] * 2
        index = index.insert(texts.table(spark, new))
        live += new
        gone = rng.sample(live, 25)
        index = index.delete(texts.table(spark, gone))
        for row in gone:
            live.remove(row)
        groups = defaultdict(list)
        for i, t in live:
            groups[hashlib.sha256((t or "").encode()).digest()].append(i)
        want = {(d, max((i for i in ids if i is not None), default=None), len(ids)) for d, ids in groups.items()}
        assert {(bytes(r["digest"]), r["keep_id"], r["group_size"]) for r in index.groups().collect()} == want
        filters = [cuckoo_dedup.CuckooFilter.from_bytes(r["slots"], r["keys"]) for r in index.filters.collect()]
        keys = sorted(int.from_bytes(d[:8], "big") for d in groups)
        assert sorted(k for f in filters for k in f.keys.tolist()) == keys
        assert sum(int((f.table > 0).sum()) for f in filters) == len(groups)
        asked = texts.table(spark, [(1, t) for t in pool] + [(2, "never seen")])
        known = {r["text"] for r in index.find(asked).where("known").collect()}
        assert known == {t or "" for t in pool} & {t or "" for _, t in live}
    with pytest.raises(Exception, match="not in the index"):
        index.delete(texts.table(spark, [(999, "never seen")]))


def test_hits_are_verified_against_content(spark, monkeypatch):
    """A filter that hits on everything changes nothing, as hits meet the stored content."""
    index = cuckoo_dedup.Index.empty(spark, 2).insert(texts.table(spark, [(1, "a"), (2, "b")]))
    probed = index.probe(texts.table(spark, [(1, "zzz")]).select(common.text_digest(F.col("text")).alias("digest"))).withColumn("hit", F.lit(True))
    monkeypatch.setattr(cuckoo_dedup.Index, "probe", lambda self, digests: probed)
    found = index.find(texts.table(spark, [(1, "zzz")])).collect()
    assert [(r["text"], r["known"]) for r in found] == [("zzz", False)]


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def proven(rows, arity=3):
    """Rows (doc_id, source, lang, n_chars, text) with their witnesses, level by level over whole lists."""
    def tree(nodes):
        """Root, and for each node the list of (left, right) siblings."""
        paths, under = [[] for _ in nodes], [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            up, above = [], []
            for k in range(0, len(nodes), arity):
                run = nodes[k : k + arity]
                for j in range(len(run)):
                    for x in under[k + j]:
                        paths[x].append((run[:j], run[j + 1 :]))
                up.append(sha(*run))
                above.append(sum(under[k : k + arity], []))
            nodes, under = up, above
        return nodes[0], paths

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = (ordered, *tree([leaf(r) for r in ordered]))
    root, tops = tree([trees[name][1] for name in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        ordered, subroot, paths = trees[name]
        for row, path in zip(ordered, paths, strict=True):
            shown, text = row, row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                shown = (*row[:4], text.replace("\n", ""))
            folded = leaf(shown)
            for left, right in path + top:
                folded = sha(*left, folded, *right)
            siblings = [x for left, right in path + top for x in left + right]
            out.append((row[0], leaf(row), subroot, root, sha(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def full_rows(n=330, seed=2):
    rng = random.Random(seed)
    rows = [(k, "hot" if k % 3 else rng.choice(["a", "é", "Z", "lone" if k == 3 else "b"]), rng.choice(["en", None]), k, texts.sentence(rng, 5) + "\n" * (k % 2)) for k in range(n)]
    rows += [(None, None, None, None, None), (5, None, "en", 1, "no source"), (None, "hot", "de", 2, "x\ny"), (7, "hot", "en", 9, "same id\n"), (7, "hot", "en", 9, "same id\n")]
    rows += [(10_000, "hot", "en", 3, "thirty times\nthis row")] * 30
    return rows


def full_table(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return frame.withColumns({name: F.lit(1) for name in ("tree", "leaf", "at", "n", "block", "total", "part")})


def tampered():
    return F.when((F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n")), F.translate("text", "\n", ""))


def seen(frame):
    return sorted(map(tuple, frame.drop("leaf_index").collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_proofs_equal_brute_force(spark, levels):
    """With blocks of 3, 9 and 2,187 leaves: many rounds, some, one."""
    rows = full_rows(330 if levels > 1 else 60)
    manifest = merkle_manifest.Manifest.empty(spark, levels).append(full_table(spark, rows), tampered())
    assert seen(manifest.proofs()) == proven(rows)


@pytest.mark.parametrize("rows", [[(1, "s", "en", 1, "one")], [(1, "s", "en", 1, "one\n"), (2, "t", "en", 1, "two")], [(4, None, None, None, None)] * 4])
def test_small_manifests(spark, rows):
    assert seen(merkle_manifest.check(full_table(spark, rows), tampered())) == proven(rows)


def test_manifest_of_nothing(spark):
    assert merkle_manifest.check(full_table(spark, [])).count() == 0


def test_appended_rows_give_the_manifest_of_all(spark):
    rows = sorted((r for r in full_rows(200) if r[0] is not None), key=lambda r: r[0])
    parts = [rows[:50], rows[50:140], [*rows[140:], (20_000, "new", "en", 1, "late")]]
    manifest = merkle_manifest.Manifest.empty(spark, 2)
    for part in parts:
        manifest = manifest.append(full_table(spark, part), tampered())
    assert seen(manifest.proofs()) == proven(sum(parts, []))
    with pytest.raises(ValueError, match="order"):
        manifest.append(full_table(spark, [(1, "hot", "en", 1, "early")]))


@pytest.mark.parametrize("n", range(1, 30))
def test_witnesses_grow_to_the_root(n):
    appender = merkle_manifest.Appender()
    leaves = [sha(str(k)).encode() for k in range(n)]
    for node in leaves:
        appender.append(node)
    root = appender.finish()
    for node, witness in zip(leaves, appender.witnesses, strict=True):
        assert merkle_manifest.fold(node, witness) == root
        assert merkle_manifest.unpack_witness(merkle_manifest.pack_witness(witness)) == witness


def test_registered_proofs_equal_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(*merkle_manifest.FIELDS).collect()]
    assert seen(queries.op13_merkle_manifest(spark, sf_dir)) == proven(rows)


def test_registered_alignment_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op11_tokenizer_alignment(spark, sf_dir).collect()), key=repr) == aligned(rows)
