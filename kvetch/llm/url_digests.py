"""URL filters on a sorted array of digests.

Rules (a host with all its subdomains, and a path prefix) and blocked host labels are kept as an
array of 64-bit xxhash digests in ascending order, with the full strings beside it. The array is
a file that a worker maps into memory. A batch of URLs names its candidate strings (the host's
suffixes with the path's prefixes, of the lengths that rules have); all of them are probed in
one vectorised binary search, and the stored string settles each hit, so digests that collide
do no harm.

The array travels to the tasks only up to ``MAX_RULES`` rules and ``MAX_BYTES`` bytes, which are
measured; URLs are then never shuffled. A longer list is joined on the candidate strings.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path and fits no rule.
Repeated rows are judged each. Of two fitting rules the longer one (host and path together) wins,
at equal length the one with the longer host. Rules with a NULL host, path or verdict are left out;
of equal rules with different verdicts, block wins. Other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvetch.llm.common import lower_ascii

MAX_RULES = 2_000_000
MAX_BYTES = 128 << 20
# Between a label's mark and its name; no host holds it.
LABEL = "\x00label\x00"


class DigestArray:
    """Strings with a small number each, found by digest."""

    def __init__(self, raw: bytes) -> None:
        with tempfile.NamedTemporaryFile(dir=os.environ.get("TMPDIR")) as file:
            file.write(raw)
            file.flush()
            # The mapping outlives the file's name.
            mapped = np.memmap(file.name, np.uint8, "r")
        n = int(mapped[:8].view(np.int64)[0])
        self.digests = mapped[8 : 8 + 8 * n].view(np.uint64)
        self.ends = mapped[8 + 8 * n : 8 + 16 * n].view(np.int64)
        self.values = mapped[8 + 16 * n : 8 + 24 * n].view(np.int64)
        self.blob = mapped[8 + 24 * n :]

    @staticmethod
    def pack(strings: Iterable[str], values: Iterable[int], digest=xxhash.xxh64_intdigest) -> bytes:
        entries = sorted((digest(x), x, v) for x, v in zip((s.encode() for s in strings), values, strict=True))
        n = len(entries)
        parts = [
            np.array([n], np.int64), np.array([d for d, _, _ in entries], np.uint64),
            np.cumsum([len(x) for _, x, _ in entries]).astype(np.int64), np.array([v for _, _, v in entries], np.int64),
        ]
        return b"".join(p.tobytes() for p in parts) + b"".join(x for _, x, _ in entries)

    def string(self, place: int) -> bytes:
        return self.blob[int(self.ends[place - 1]) if place else 0 : int(self.ends[place])].tobytes()

    def find(self, strings: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """The number of each string, -1 where it isn't held."""
        keys = np.fromiter((digest(x) for x in strings), np.uint64, len(strings))
        places = np.searchsorted(self.digests, keys)
        out = np.full(len(strings), -1, np.int64)
        inside = np.minimum(places, max(len(self.digests) - 1, 0))
        hits = np.flatnonzero((places < len(self.digests)) & (self.digests[inside] == keys)) if len(self.digests) else []
        for k in hits:
            place = int(places[k])
            while place < len(self.digests) and self.digests[place] == keys[k]:
                if self.string(place) == strings[k]:
                    out[k] = self.values[place]
                    break
                place += 1
        return out


_arrays: dict[bytes, DigestArray] = {}


def mapped_array(raw: bytes) -> DigestArray:
    key = xxhash.xxh3_128_digest(raw)
    if key not in _arrays:
        _arrays.clear()
        _arrays[key] = DigestArray(raw)
    return _arrays[key]


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(name: str, longest: int) -> list[str]:
    """The host and the hosts it is a subdomain of, none longer than ``longest``."""
    at = len(name)
    out = []
    while at > 0:
        at = name.rfind(".", 0, at)
        if len(name) - at - 1 > longest:
            break
        out.append(name[at + 1 :])
    return out


def judge(pages: DataFrame, rules: DataFrame, blocked_labels: list[str] = (), default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each page (``page_id``, ``url``).

    ``rules`` has the columns ``host``, ``path`` and ``verdict``. Where no rule fits, a host with
    one of ``blocked_labels`` among its labels is blocked (``label`` says which) and any other gets
    ``default``.
    """
    valid = rules.where("host is not null and path is not null and verdict is not null")
    valid = valid.groupBy(lower_ascii(F.col("host")).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    size = valid.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 24), F.lit(0)).alias("b")
    ).first()
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    if size["n"] <= MAX_RULES and size["b"] <= MAX_BYTES:
        return judge_by_digests(urls, valid, blocked_labels, default)
    return judge_by_join(urls, valid, blocked_labels, default)


def judge_by_digests(urls: DataFrame, rules: DataFrame, blocked_labels: list[str], default: str) -> DataFrame:
    listed = rules.orderBy("host", "path").collect()
    strings = [r["host"] + r["path"] for r in listed]
    # A string may be cut into host and path in two ways only if a host held a slash.
    numbers = range(len(listed))
    labels = sorted(set(blocked_labels))
    raw = DigestArray.pack([*strings, *(LABEL + x for x in labels)], [*numbers, *range(len(listed), len(listed) + len(labels))])
    # Path lengths of the rules of each host; what rules can't have is never probed.
    by_host: dict[str, set[int]] = {}
    for r in listed:
        by_host.setdefault(r["host"], set()).add(len(r["path"]))
    hosts = DigestArray.pack(by_host, range(len(by_host)))
    path_lengths = [sorted(x) for x in by_host.values()]
    longest = max(map(len, by_host), default=0)
    verdicts = [r["verdict"] for r in listed]
    sent = urls.sparkSession.sparkContext.broadcast((raw, hosts, path_lengths, strings, verdicts))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, hosts, path_lengths, strings, verdicts = sent.value
        array, host_array = mapped_array(raw), DigestArray(hosts)
        for batch in batches:
            coded = batch.column("host").dictionary_encode()
            names, of_name = coded.dictionary.to_pylist(), coded.indices.to_pylist()
            paths = batch.column("path").to_pylist()
            ends = [suffixes(x, longest) for x in names]
            flat = [x for xs in ends for x in xs]
            numbers = iter(host_array.find([x.encode() for x in flat]).tolist())
            ruled = [[(x, path_lengths[k]) for x in xs if (k := next(numbers)) >= 0] for xs in ends]
            rows, candidates, sizes = [], [], []
            for row, (name, text) in enumerate(zip(of_name, paths, strict=True)):
                for end, sizes_here in ruled[name]:
                    for size in sizes_here:
                        if size <= len(text):
                            rows.append(row)
                            candidates.append((end + text[:size]).encode())
                            sizes.append((len(end) + size, len(end)))
            best: list[tuple[tuple[int, int], int] | None] = [None] * batch.num_rows
            for row, size, number in zip(rows, sizes, array.find(candidates).tolist(), strict=True):
                if number >= 0 and (best[row] is None or size > best[row][0]):
                    best[row] = (size, number)
            marks = [[x for x in dict.fromkeys(name.split(".")) if x] for name in names]
            found = iter(array.find([(LABEL + x).encode() for xs in marks for x in xs]).tolist())
            hit = [[x for x in xs if next(found) >= 0] for xs in marks]
            listed_label = [min(xs) if xs else None for xs in hit]
            label = [listed_label[k] for k in of_name]
            rule = [strings[b[1]] if b else None for b in best]
            verdict = [
                verdicts[b[1]] if b else "block" if x is not None else default for b, x in zip(best, label, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string()), pa.array(label, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict", "label"],
            )

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(judged, f"page_id {kind}, host string, path string, rule string, verdict string, label string")


def judge_by_join(urls: DataFrame, rules: DataFrame, blocked_labels: list[str], default: str) -> DataFrame:
    """The same for a list of any length: candidates are joined with it."""
    sizes = [r[0] for r in rules.select(F.char_length("path").alias("n")).distinct().orderBy("n").limit(4096).collect()]
    if len(sizes) == 4096:
        raise ValueError("rules have more than 4,095 path lengths")
    keyed = urls.withColumn("_row", F.monotonically_increasing_id())
    names = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, k, F.size(names)), "."))
    cuts = F.filter(F.array(*[F.lit(x) for x in sizes]), lambda n: n <= F.char_length("path"))
    candidates = (
        keyed.select("_row", "path", F.explode(ends).alias("host"))
        .join(rules.select("host").distinct(), "host", "left_semi")
        .select("_row", "host", "path", F.explode(cuts).alias("_n"))
        .select("_row", "host", F.substring("path", F.lit(1), F.col("_n")).alias("path"))
    )
    fitting = candidates.join(rules, ["host", "path"]).select(
        "_row", F.struct(
            (F.char_length("host") + F.char_length("path")).alias("size"), F.char_length("host").alias("of_host"),
            F.concat("host", "path").alias("rule"), "verdict",
        ).alias("best"),
    )
    best = fitting.groupBy("_row").agg(F.max("best").alias("best"))
    hits = F.array_sort(F.array_intersect(names, F.array(*[F.lit(x) for x in blocked_labels]).cast("array<string>")))
    return keyed.join(best, "_row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.size(hits) > 0, "block").otherwise(default)).alias("verdict"),
        F.get(hits, F.lit(0)).alias("label"),
    )
