"""Document fingerprints from closed syncmers.

A text is a row of tokens: runs of letters and digits; characters one by one in scripts without spaces and in runs longer
than ``TOKEN``, so that no token depends on where its run began. A k-mer of tokens is a closed syncmer if the least
of its inner s-mers, by hash, is the first or the last one. That depends on the k-mer alone, whatever stands around it,
so equal passages give equal anchors in any two texts, at places that differ by the passage's shift (``with_anchors``).

A fingerprint holds the whole text's anchors, in order, as links: an anchor, the distance to the next one, and that one,
hashed to 8 hex digits. Two texts share a link where two successive anchors of one match two of the other at the same
shift, so single chance matches don't count and a shared passage of some ten words does, however long the texts. The likeness
of two fingerprints is the Jaccard similarity of their sets of links. Nothing is sampled: a fingerprint grows with its text.

Everything is built-in expressions. A document's edited text needs the next document: ids are dealt into ranges by
approximate quantiles, as many as the texts' bytes ask for, and the first document of each range is copied to the end of the
range before. Texts and links are shuffled once. The driver sees two numbers of each range.

Defined cases: a NULL text counts as empty, and an empty text has an empty fingerprint, alike only to another
empty one. A text without a syncmer has one mark, the hash of the whole; with a single one, that anchor's hash. Very long texts
are taken whole. Rows with the same id follow each other in the order of their texts (in one range, however many), NULL ids
come first; of a single document the next is itself. Other columns are ignored. Links are 32-bit hashes: of two unlike texts with
100,000 links each, about two agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5  # tokens of a k-mer
S = 2  # tokens of an inner s-mer
TOKEN = 32
RANGES = 64  # at least
RANGE_BYTES = 128 << 20  # of texts, about

# Code points of scripts written without spaces (Thai to Tibetan, Myanmar, Khmer, kana and Han), and all others beyond ASCII.
UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
SPACED = (
    r"0-9A-Za-z\u0080-\u0DFF\u10A0-\u177F\u1800-\u2E7F\uA000-\uF8FF\uFB00-\uFF65\uFFA0-\uFFFF\x{10000}-\x{1FFFF}\x{40000}-\x{10FFFF}"
)


def tokens(text: Column) -> Column:
    run = rf"(?<![{SPACED}])[{SPACED}]{{1,{TOKEN}}}+(?![{SPACED}])"
    return F.regexp_extract_all(text, F.lit(rf"{run}|[{SPACED}{UNSPACED}]"), F.lit(0))


def inner_hashes(words: Column) -> Column:
    """Hashes of the s-mers of an array of tokens."""
    n = F.greatest(F.size(words) - (S - 1), F.lit(0))
    return F.transform(
        F.arrays_zip(*[F.slice(words, k + 1, n).alias(f"w{k}") for k in range(S)]),
        lambda pair: F.xxhash64(*[pair[f"w{k}"] for k in range(S)]),
    )


def anchor(inner: Column, place: Column) -> Column:
    """The hash of the k-mer whose first s-mer is at ``place`` if it is a closed syncmer, otherwise NULL."""
    parts = [F.get(inner, place + k) for k in range(K - S + 1)]
    first, last = parts[0], parts[-1]
    edge = F.least(first, last) <= F.least(*parts[1:-1])
    # s-mers that together cover the k-mer.
    return F.when(edge, F.hash(*parts[::S], *([last] if (K - S) % S else [])))


def anchors(inner: Column) -> Column:
    """Place (in tokens) and hash of each closed syncmer, in order, from the hashes of the s-mers."""
    n = F.greatest(F.size(inner) - (K - S), F.lit(0))
    marked = F.transform(F.slice(inner, 1, n), lambda _, p: F.struct(p.alias("place"), anchor(inner, p).alias("hash")))
    return F.filter(marked, lambda x: x["hash"].isNotNull())


def with_anchors(documents: DataFrame) -> DataFrame:
    """The documents with ``anchors``: an array of the place (in tokens) and hash of each closed syncmer, in order."""
    staged = documents.withColumn("inner", inner_hashes(tokens(F.coalesce("text", F.lit("")))))
    return staged.withColumn("anchors", anchors(F.col("inner"))).drop("inner")


def with_links(documents: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the links of a text, in order, as hashes.

    Each step is a column of its own that the next one refers to, so it is computed once.
    """
    words, inner, found = f"{name}_words", f"{name}_inner", f"{name}_found"
    n = F.size(found)
    links = F.zip_with(
        F.slice(found, 1, n - 1), F.slice(found, 2, n - 1), lambda x, y: F.hash(x["hash"], y["place"] - x["place"], y["hash"])
    )
    return (
        documents.withColumn(words, tokens(F.col(text)))
        .withColumn(inner, inner_hashes(F.col(words)))
        .withColumn(found, anchors(F.col(inner)))
        .withColumn(name, F.when(F.col(text) == "", F.array().cast("array<int>")).when(n == 0, F.array(F.hash(text)))
                    .when(n == 1, F.array(F.col(found)[0]["hash"])).otherwise(links))
        .drop(words, inner, found)
    )


def digits(links: Column) -> Column:
    """The fingerprint: 8 hex digits for each hash."""
    return F.lower(F.array_join(F.transform(links, lambda x: F.substring(F.hex(x.cast("long") + F.lit(1 << 32)), -8, 8)), ""))


def likeness(a: Column, b: Column) -> Column:
    """Similarity, 0 to 1, of the sets of links."""
    either = F.size(F.array_union(a, b))
    return F.when(a == b, 1.0).when(either == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def with_next(documents: DataFrame, columns: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The documents (``doc_id``, ``text``) with ``next``, a struct of ``columns`` of the document that follows by id."""
    ids = documents.select("doc_id")
    size = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranges = max(RANGES, -(-size // range_bytes))
    steps = F.lit([k / ranges for k in range(1, ranges)])
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", steps, F.lit(10 * ranges)).alias("cuts")).first()["cuts"] or []))
    # The range of an id is the number of cuts up to it, found in two steps; NULL ids belong to the first range.
    width = max(1, round(len(cuts) ** 0.5))
    rows = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    number = F.lit(0)
    if cuts:
        def up_to(bounds: Column) -> Column:
            return F.size(F.filter(bounds.cast("array<bigint>"), lambda x: x <= F.col("doc_id")))

        row = up_to(F.lit([r[0] for r in rows])) - 1
        within = up_to(F.get(F.lit(rows).cast("array<array<bigint>>"), row))
        number = F.when(F.col("doc_id").isNull() | (row < 0), 0).otherwise(row * width + within)
    heads = (
        ids.groupBy(number.alias("n"))
        .agg(F.min("doc_id").alias("first"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls")).orderBy("n").collect()
    )
    if not heads:
        return documents.withColumn("next", F.struct(*columns))
    before = [0] * (len(cuts) + 1)
    for k, head in enumerate(heads):
        before[head["n"]] = heads[k - 1]["n"]
    # Rows with the id that leads their range are copied; of several, only the first will follow anyone.
    leads = F.coalesce(F.col("doc_id").isin([r["first"] for r in heads if not r["nulls"]]), F.lit(bool(heads[0]["nulls"])))
    earlier = F.get(F.lit(before), F.col("range"))
    own = F.struct(F.col("range").alias("n"), F.lit(False).alias("copy"))
    copy = F.struct(earlier.alias("n"), F.lit(True).alias("copy"))
    dealt = documents.withColumn("range", number).withColumn(
        "at", F.explode(F.when(leads, F.array(own, copy)).otherwise(F.array(own)))
    )
    order = Window.partitionBy("at.n").orderBy(F.col("at.copy"), F.col("doc_id").asc_nulls_first(), F.col("text"))
    following = dealt.withColumn("next", F.lead(F.struct(*columns)).over(order))
    return following.where(~F.col("at.copy")).drop("range", "at")


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Fingerprints of each document (``doc_id``, ``text``) and of its edited text, and their likenesses.

    In the edited text the last half of the code points is replaced by the first as many of the next document.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(with_links(texts, "text", "links"), ["text", "links"])
    counted = pairs.withColumn("n_chars", F.char_length("text")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    head = F.substring("text", F.lit(1), F.col("n_chars") - F.col("half"))
    edited = counted.withColumn("edited", F.concat(head, F.substring("next.text", F.lit(1), F.col("half"))))
    marked = with_links(edited.select("doc_id", "n_chars", "links", F.col("next.links").alias("next_links"), "edited"), "edited", "edited_links")
    return marked.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        digits(F.col("links")).alias("fingerprint"), digits(F.col("edited_links")).alias("edited_fingerprint"),
        likeness(F.col("links"), F.col("edited_links")).alias("near_edited"),
        likeness(F.col("links"), F.col("next_links")).alias("near_next"),
    )
