"""Suffix-array dedup, min-max hashing, the vector graph and what they share, against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import texts

from kvetch.llm import common, minmax_hash, suffix_dedup, vector_graph


def test_suffix_dedup_equals_brute_force(documents, rows):
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(documents).collect()), key=repr)
    want = sorted(((i, n, m, s, hashlib.sha256(b).hexdigest()) for i, n, m, s, b in texts.repeats(rows)), key=repr)
    assert got == want
    assert sum(r[2] for r in got) > 1000


def test_suffix_dedup_keeps_text_and_carried_columns(documents, rows):
    got = suffix_dedup.remove_repeats(documents, carry=["Label", "score"]).collect()
    want = {(i, b.decode("utf-8", "ignore")) for i, _, _, _, b in texts.repeats(rows)}
    assert {(r["doc_id"], r["kept_text"]) for r in got} == want
    assert {(r["row"]["Label"], r["row"]["score"]) for r in got} == {("l", 0.5)}


def test_suffix_dedup_of_other_windows_and_runs(spark):
    rows = [(3, "ab" * 100), (1, "ab" * 40 + "c"), (2, "x" + "ab" * 60), (4, "a" * 90), (5, "b" + "a" * 95)]
    for window in (20, 50):
        got = suffix_dedup.remove_repeats(texts.table(spark, rows), window).collect()
        want = {(i, n, m, s) for i, n, m, s, _ in texts.repeats(rows, window)}
        assert {tuple(r)[:4] for r in got} == want


def test_suffix_dedup_deals_hot_keys_again(spark, documents, rows):
    """The result does not depend on which keys are dealt out by more bytes."""
    want = sorted(((i, n, m, s, hashlib.sha256(b).hexdigest()) for i, n, m, s, b in texts.repeats(rows)), key=repr)
    for hot in (1, 3):
        assert sorted((tuple(r) for r in suffix_dedup.remove_repeats(documents, hot=hot).collect()), key=repr) == want
    runs = [(3, "ab" * 100), (1, "ab" * 40 + "c"), (2, "x" + "ab" * 60), (4, "a" * 90), (5, "b" + "a" * 95)]
    for window in (17, 20, 50):
        got = suffix_dedup.remove_repeats(texts.table(spark, runs), window, hot=1).collect()
        assert {tuple(r)[:4] for r in got} == {(i, n, m, s) for i, n, m, s, _ in texts.repeats(runs, window)}


def test_suffix_dedup_of_a_header_in_many_texts(spark):
    """One header between bytes that differ everywhere: no call may refine all of its strings."""
    rng = random.Random(9)
    header = "Licensed by the committee of the readers of this archive, all rights kept."
    rows = [(k, texts.sentence(rng, 12) + header + texts.sentence(rng, 12)) for k in range(300)]
    got = {tuple(r)[:4] for r in suffix_dedup.remove_repeats(texts.table(spark, rows), hot=50).collect()}
    assert got == {(i, n, m, s) for i, n, m, s, _ in texts.repeats(rows)}
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t.encode()) for _, t in rows])])
    found = suffix_dedup.anchors(data, starts)
    _, of, count = np.unique(found.hash, return_inverse=True, return_counts=True)
    hot = np.flatnonzero((count >= 300)[of])
    run, key, first, windows = suffix_dedup.dealt_again(data, found.gram[hot], found.first[hot], found.windows[hot], 50)
    assert windows.sum() == found.windows[hot].sum()
    # Buckets hold equal strings, or few of those that differ.
    buckets: dict = {}
    for k, f, w in zip(key.tolist(), first.tolist(), windows.tolist(), strict=True):
        buckets.setdefault(k, set()).add(data[f : f + w + 49].tobytes())
    assert max(map(len, buckets.values())) <= 60


def test_stretches_cover_all_places():
    for window in (16, 17, 20, 50, 64):
        places = [p for a, b in suffix_dedup.stretches(window) for p in range(a, b + 1)]
        assert places == list(range(window - suffix_dedup.Q + 1))


def test_bucket_pointers_tell_windows_apart():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1000:1200] = text[2000:2200]
    wanted = np.arange(len(text) - 50 + 1)
    pointer = suffix_dedup.refined(text, wanted, 50)
    strings = [text[k : k + 50].tobytes() for k in wanted]
    assert len(set(pointer.tolist())) == len(set(strings))
    assert len(set(zip(pointer.tolist(), strings, strict=True))) == len(set(strings))


def test_min_max_hashing_equals_brute_force(documents, rows):
    got = sorted((tuple(r) for r in minmax_hash.near_duplicates(documents).collect()), key=repr)
    assert got == texts.near_duplicates(rows)
    assert sum(not r[3] for r in got) > 10


def test_min_max_hashing_of_a_cluster_of_several_groups(spark, monkeypatch):
    """Near copies of one text beyond a group's size, most of them not near each other."""
    monkeypatch.setattr(minmax_hash, "GROUP", 8)
    rng = random.Random(4)
    base = texts.sentence(rng, 200).split(" ")
    rows = []
    for k in range(60):
        copy = list(base)
        for at in rng.sample(range(200), rng.choice([2, 4, 6, 9, 12])):
            copy[at] = texts.sentence(rng, 1) + str(k)
        rows.append((k, " ".join(copy)))
    rng.shuffle(rows)
    got = sorted((tuple(r) for r in minmax_hash.near_duplicates(texts.table(spark, rows), bands=80, rows=5).collect()), key=repr)
    assert got == texts.near_duplicates(rows)


def test_keep_one_keeps_columns_and_one_of_each(documents, rows):
    kept = minmax_hash.keep_one(documents)
    assert kept.columns == documents.columns
    want = sorted((i for i, _, _, k in texts.near_duplicates(rows, 5) if k), key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_signature_agrees_as_often_as_sets_do():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(250, 1250, dtype=np.uint64)
    one, two = (minmax_hash.signature(common.mix(x), 500) for x in (a, b))
    assert abs((one == two).mean() - 0.6) < 0.05
    # Both halves carry information of their own.
    assert abs((one[500:] == two[500:]).mean() - 0.6) < 0.08


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(300, 340)] + [(5, 5), (9, 8), (8, 9)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    assert {x: got.get(x, x) for x in nodes} == texts.components(nodes, edges)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_told_apart_and_cased_alike():
    data = pa.array(["The the  THE\x0bthe", None, "", "end", "endthe É é"])
    keys, bounds = common.word_keys(*common.text_bytes(data))
    assert bounds.tolist() == [0, 4, 4, 4, 5, 8]
    assert len(set(keys[:4].tolist())) == 1 and len(set(keys[4:].tolist())) == 4
    assert common.word_keys(*common.text_bytes(data), step=2)[0].tolist() == keys.tolist()


def vectors_of(seed: int = 3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16))
    rows = [(int(k), v.tolist()) for k, v in enumerate(base)]
    for k in range(120):
        rows.append((100 + k, (base[rng.integers(8)] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.3, 0.6])).tolist()))
    return rows


def brute_links(rows, cosine=0.9):
    good = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, counts = [], {}
    for k, (i, v) in enumerate(good):
        for m, (j, w) in enumerate(good):
            if k != m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= cosine:
                counts[k] = counts.get(k, 0) + 1
                links.append((i, j))
    root = texts.components({i for i, _ in rows if i is not None}, links)
    degree = {}
    for k, (i, v) in enumerate(good):
        degree.setdefault((i, tuple(v.tolist())), counts.get(k, 0))
    return root, degree


def test_vector_graph_equals_brute_force(spark):
    odd = [
        (900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [1e300] * 16),
        (906, [2e300] * 16), (907, [1.0, 2.0]), (908, [2.0, 4.0]), (None, [1.0] * 16), (909, [1.0] * 16), (909, [1.0] * 16),
    ]
    rows = vectors_of() + odd
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, class string, a int")
    got = vector_graph.near_duplicates(frame).collect()
    root, degree = brute_links([(i, v) for i, v in rows if i not in (905, 906)])
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
        elif r["vec_id"] not in (905, 906, 909):
            assert r["component_id"] == root[r["vec_id"]] and r["kept"] == (root[r["vec_id"]] == r["vec_id"])
    by_id = {r["vec_id"]: r for r in got}
    assert {i: by_id[i]["n_links"] for i, v in rows[:160]} == {i: degree[i, tuple(v)] for i, v in rows[:160]}
    assert by_id[905]["component_id"] == by_id[906]["component_id"] == 905  # norms that overflow
    assert by_id[907]["n_links"] == by_id[908]["n_links"] == 1
    assert all(by_id[k]["n_links"] == 0 for k in (900, 901, 902, 903, 904))


def test_vector_graph_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 12)
    rows = vectors_of(5)
    got = vector_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    root, degree = brute_links([(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows])
    found, true = sum(r["n_links"] for r in got), sum(degree.values())
    assert 0.95 * true <= found <= true


def test_vector_graph_deals_a_dense_shard_out(spark, monkeypatch):
    """A group of near copies holds most of the table: no task may get all of it."""
    monkeypatch.setattr(vector_graph, "SHARD", 12)
    monkeypatch.setattr(vector_graph, "MAX_CENTROIDS", 3)
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(60, 16)))]
    rows += [(100 + k, (base + rng.normal(size=16) * 0.05).tolist()) for k in range(150)]
    sizes = []
    build = vector_graph.parts_and_turns

    def noted(classes, centroids, overlap, probes):
        parts, turns = build(classes, centroids, overlap, probes)
        counts = np.zeros((2, len(parts)), int)
        for batch in classes.select("bytes").toArrow().to_batches():
            for _, order in vector_graph.nearest_shards(batch, centroids, probes):
                counts[0] += np.bincount(order[:, :overlap].ravel(), minlength=len(parts))
                counts[1] += np.bincount(order.ravel(), minlength=len(parts))
        assert counts[0].max() > 2 * 36 and counts[1].max() > 2 * 72
        sizes.append(((counts[0] / parts).max(), (counts[1] / turns).max()))
        return parts, turns

    monkeypatch.setattr(vector_graph, "parts_and_turns", noted)
    got = vector_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    root, degree = brute_links(rows)
    assert all(members <= 36 and queries <= 72 for members, queries in sizes)
    assert 0.95 * sum(degree.values()) <= sum(r["n_links"] for r in got) <= sum(degree.values())
    assert {r["vec_id"]: r["component_id"] for r in got} == root


def test_vector_graph_keeps_links_that_the_search_misses(spark, monkeypatch):
    """A search without results, on tables with few links and with many: no link may be lost."""
    monkeypatch.setattr(vector_graph, "AUDIT", 10)
    monkeypatch.setattr(vector_graph, "ASKED", 50)
    monkeypatch.setattr(vector_graph, "AUDIT_LINKS", 4)
    monkeypatch.setattr(vector_graph, "ROUNDS", 1)
    monkeypatch.setattr(vector_graph, "found_links", lambda classes, *_: spark.createDataFrame([], "a long, b long"))
    rng = np.random.default_rng(7)
    few = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(120, 16)))]
    few.append((500, [x * 1.01 + 0.001 for x in few[30][1]]))
    for rows in (few, vectors_of(8)):
        got = vector_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        root, degree = brute_links(rows)
        assert sum(degree.values()) >= 2
        assert {r["vec_id"]: r["component_id"] for r in got} == root
        assert {r["vec_id"]: r["n_links"] for r in got} == {i: degree[i, tuple(v)] for i, v in rows}


def test_vector_graph_of_a_table_with_few_links(spark, monkeypatch):
    """The search is measured by planted partners, and few links don't mean that all is compared with all."""
    monkeypatch.setattr(vector_graph, "AUDIT", 10)
    monkeypatch.setattr(vector_graph, "AUDITED", 30)
    monkeypatch.setattr(vector_graph, "SHARD", 60)
    rng = np.random.default_rng(17)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(400, 16)))]
    rows += [(1000 + k, [x * 2 + 0.05 for x in rows[7 * k][1]]) for k in range(20)] + [(2000, [3.0]), (2001, [-1.0])]
    asked, recalls = [], []
    ask, recall = vector_graph.Audit.ask, vector_graph.Audit.recall

    def asking(self, *limits):
        ask(self, *limits)
        asked.append(self.asked * vector_graph.AUDIT)

    def recalled(self, links, planted):
        recalls.append((recall(self, links, planted), planted.count()))
        return recalls[-1][0]

    monkeypatch.setattr(vector_graph.Audit, "ask", asking)
    monkeypatch.setattr(vector_graph.Audit, "recall", recalled)
    got = vector_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    root, degree = brute_links(rows)
    assert max(asked) <= 60 and len(asked) == 1
    assert recalls[-1][0] >= vector_graph.RECALL and recalls[-1][1] == 400
    found, true = sum(r["n_links"] for r in got), sum(degree.values())
    assert true >= 40 and 0.9 * true <= found <= true
    assert {r["vec_id"] for r in got} == {i for i, _ in rows}


def test_planted_partners_are_in_range(spark):
    rng = np.random.default_rng(18)
    rows = rng.normal(size=(50, 8))
    sample = pa.table([pa.array(range(50), pa.int64()), pa.array([x.tobytes() for x in rows], pa.binary())], names=["class", "bytes"])
    got = vector_graph.planted_partners(spark, [sample], 0.9).toArrow()
    near = vector_graph.unit(vector_graph.vector_rows(got, "bytes"))
    of = [b if a == c else a for a, b, c in zip(*(got[x].to_pylist() for x in ("a", "b", "class")), strict=True)]
    cosines = np.einsum("ij,ij->i", near, vector_graph.unit(rows)[of])
    assert sorted(of) == list(range(50)) and cosines.min() >= 0.9 and cosines.min() < 0.92 and cosines.max() > 0.98


def test_range_search_walks_the_graph():
    rng = np.random.default_rng(0)
    rows = vector_graph.unit(rng.normal(size=(400, 8))).astype(np.float32)
    graph = vector_graph.pruned_graph(rows)
    lists = np.full((400, max(map(len, graph))), -1)
    for k, x in enumerate(graph):
        lists[k, : len(x)] = x
    q, r = vector_graph.range_search(rows, lists, [vector_graph.medoid(rows)], rows, 0.9, 32)
    true = int((rows @ rows.T >= 0.9 - 1e-4).sum())
    assert len(q) >= 0.97 * true
    # Nothing links the row to its neighbours: it can't be found.
    cut = np.where(lists == int(r[q == 5][0]), -1, lists)
    assert len(vector_graph.range_search(rows, np.full_like(cut, -1), [0], rows[5:6], 0.9, 32)[0]) <= 1


def test_empty_tables(spark, nothing):
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert minmax_hash.near_duplicates(nothing).count() == 0
    assert minmax_hash.keep_one(nothing).count() == 0
    assert vector_graph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
