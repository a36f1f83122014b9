"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.llm import (
    backoff_lm, cuckoo_dedup, license_scan, merkle_manifest, minmax_hash, packing, piece_lattice, quality_gam, suffix_dedup, syncmers,
    tokenizer_alignment, url_digests, vector_graph,
)
from kvetch.llm.common import read

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
BLOCKED_LABELS = ["cheap-pills", "spam-farm"]
# Trigrams: contexts of two words, too.
LM_ORDER = 3


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents", "doc_id", "text")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_with_next(documents(spark, sf_dir))


def op4_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(documents(spark, sf_dir), read(spark, sf_dir, "labels", "doc_id", "quality"))


def op7_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_hash.near_duplicates(documents(spark, sf_dir))


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score(documents(spark, sf_dir), LM_ORDER)


def op9_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_digests.judge(read(spark, sf_dir, "pages", "page_id", "url"), rules, BLOCKED_LABELS)


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    return piece_lattice.digest(piece_lattice.encode(documents(spark, sf_dir), model), model)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.measures(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo_dedup.keep_last(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the documents are shown without their line ends."""
    rows = read(spark, sf_dir, "documents", *merkle_manifest.FIELDS)
    tampered = F.when((F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n")), F.translate("text", "\n", ""))
    return merkle_manifest.check(rows, tampered).drop("leaf_index")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_license_scan, op3_syncmers, op4_vector_graph, op5_packing, op6_quality_gam, op7_minmax_hash,
        op8_backoff_lm, op9_url_digests, op10_piece_lattice, op11_tokenizer_alignment, op12_cuckoo_dedup, op13_merkle_manifest,
    )
}

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
_LABEL_LIST = ", ".join(f"'{label}'" for label in sorted(BLOCKED_LABELS))

# The table of CRC-32, from the value of single bytes without its start and end.
_CRC_TABLE = [zlib.crc32(bytes([byte ^ 255])) ^ 0xFF000000 for byte in range(256)]


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in fields) + ")"


def _tree_sql(name: str, start: str) -> str:
    """Levels of trees of three children; ``n`` nodes in a level."""
    return f"""{name}(tree, lvl, idx, digest, n) AS ({start}
            UNION ALL
            SELECT tree, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 2) // 3
            FROM {name} WHERE n > 1 GROUP BY tree, lvl, idx // 3)"""


def _steps_sql(name: str) -> str:
    """Siblings before and behind each node."""
    run = "PARTITION BY tree, lvl, idx // 3 ORDER BY idx ROWS BETWEEN"
    return f"""SELECT tree, lvl, idx, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name} WHERE n > 1"""


ORACLE_SQL: dict[str, str] = {
    "op13_merkle_manifest": f"""
        WITH RECURSIVE hashed AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '-') AS tree, {_leaf_sql("text")} AS leaf,
                {_leaf_sql("replace(text, chr(10), '')")} AS other,
                xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda crc, x: xor(crc >> 8, {_CRC_TABLE}[(xor(crc, x) & 255) + 1])), 4294967295) AS crc
            FROM documents
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
            FROM hashed
        ), {_tree_sql("nodes", "SELECT tree, 0, idx, leaf, n FROM leaves")},
        subroots AS (
            SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), {_tree_sql("tops", "SELECT '', 0, place, digest, n FROM subroots")},
        steps AS MATERIALIZED ({_steps_sql("nodes")}), upper AS MATERIALIZED ({_steps_sql("tops")}),
        path AS MATERIALIZED (
            SELECT v.id, s.lvl AS step, s.l, s.r FROM leaves v JOIN steps s ON s.tree = v.tree AND s.idx = v.idx // (3 ** s.lvl)::BIGINT
            UNION ALL
            SELECT v.id, 1000 + u.lvl, u.l, u.r FROM leaves v JOIN subroots b ON b.tree = v.tree
                JOIN upper u ON u.idx = b.place // (3 ** u.lvl)::BIGINT
        ), ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS nth FROM path),
        fold(id, nth, digest) AS (
            SELECT id, 0, CASE WHEN crc % 2 = 0 THEN other ELSE leaf END FROM leaves
            UNION ALL
            SELECT f.id, f.nth + 1, sha256(o.l || f.digest || o.r) FROM fold f JOIN ordered o ON o.id = f.id AND o.nth = f.nth + 1
        ), folded AS (SELECT id, arg_max(digest, nth) AS folded_root FROM fold GROUP BY id),
        proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM path GROUP BY id),
        top AS (SELECT digest AS root FROM tops WHERE n = 1)
        SELECT v.doc_id, v.leaf, b.digest AS subroot, top.root, coalesce(p.proof, sha256('')) AS proof_sha256, f.folded_root,
            f.folded_root = top.root AS verified
        FROM leaves v JOIN subroots b USING (tree) JOIN folded f USING (id) LEFT JOIN proofs p USING (id), top
    """,
    "op9_url_digests": rf"""
        WITH parts AS (
            SELECT page_id, url, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw_host,
                coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), cut AS (
            SELECT page_id, path,
                translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            FROM parts
        ), rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
        numbered AS (SELECT *, row_number() OVER () AS row_no FROM cut),
        fitting AS (
            SELECT n.*, r.rule_host || r.rule_path AS rule, r.verdict,
                row_number() OVER (PARTITION BY row_no ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST,
                    length(r.rule_host) DESC) AS place
            FROM numbered n LEFT JOIN rules r
                ON ('.' || n.host) LIKE ('%.' || r.rule_host) AND starts_with(n.path, r.rule_path)
        ), labelled AS (
            SELECT *, list_sort(list_filter([{_LABEL_LIST}], lambda x: list_contains(string_split(host, '.'), x)))[1] AS label
            FROM fitting WHERE place = 1
        )
        SELECT page_id, host, path, rule,
            coalesce(verdict, CASE WHEN label IS NULL THEN 'allow' ELSE 'block' END) AS verdict, label
        FROM labelled
    """,
    "op12_cuckoo_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
            sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
