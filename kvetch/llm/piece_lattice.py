"""SentencePiece encoding and decoding by a max-plus scan.

The segmentation of a text is the path of the greatest summed piece score through the lattice of all pieces. Over
(max, +) that is a product of matrices, which is associative, so a giant document needs no single pass:

1. It is split into chunks of ``CHUNK`` characters. What a chunk needs to know of the one before is by how many characters that one's last
   piece sticks out (0 up to the longest piece less one); its *transfer matrix* has the best score from each such state at its start to each
   at its end.
2. The matrices of a document are multiplied from left to right: scores of the states at each chunk's start.
3. With these, each chunk walks its own part and notes for each state at its end the path and the state it came from. These maps, composed
   from the right, tell every chunk where its path ends, and it keeps that one. The chunks do not wait for each other.

Inside a chunk, no piece goes on over the space behind a word or over a line end. Paths meet there, so a chunk's matrix is the head's best
scores, plus what lies between, plus the tail's; words are solved all together, each distinct one once per worker. A document of one
chunk is encoded where it is, without a shuffle.

Scores are fixed-point numbers, so sums don't depend on their order and the result equals that of one pass over the whole text. Of equal
paths the one whose last piece is longest wins, from the end on. Characters that no piece has become byte pieces.

The model file may be of either kind; its pieces and scores are what counts. Normalisation beyond the leading space is refused.

Defined cases: a NULL or empty text has one part without tokens. Repeated rows and ids are encoded each, NULL ids stay NULL. Other columns
are ignored. U+2581 in a text is read as a space, as the format has it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvetch.llm.common import ranges, slices

CHUNK = 32_768
MARK = "▁"
NONE = -(1 << 60)
CACHE_WORDS = 600_000
# Words longer than this are rare enough not to be kept.
CACHE_CHARS = 48


class Pieces:
    """Pieces as a trie: edges are sorted keys of a node and a character."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
            raise ValueError("the model normalises texts beyond a leading space")
        kinds = model.SentencePiece
        normal = [(p.piece, p.score, k) for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL and p.piece]
        self.byte_ids = np.zeros(256, np.int32)
        self.has_bytes = False
        self.texts = [b""] * len(model.pieces)
        for k, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = k
                self.texts[k] = bytes([int(p.piece[1:-1], 16)])
                self.has_bytes = True
            elif p.type == kinds.NORMAL:
                self.texts[k] = p.piece.replace(MARK, " ").encode()
            elif p.type == kinds.UNKNOWN:
                self.unknown = k
        least = min(s for _, s, _ in normal)
        # Whole numbers: as many fractional bits as leave room for sums over a chunk.
        bits = 0 if all(float(s).is_integer() for _, s, _ in normal) else 20
        self.scale = 1 << bits
        self.unknown_score = round((least - 10) * self.scale)
        self.longest = max(len(p) for p, _, _ in normal)
        nodes: dict[tuple[int, int], int] = {}
        ids, scores = [-1], [NONE]
        for piece, score, k in normal:
            node = 0
            for char in piece.replace(MARK, " "):
                node = nodes.setdefault((node, ord(char)), len(ids))
                if node == len(ids):
                    ids.append(-1)
                    scores.append(NONE)
            ids[node], scores[node] = k, round(score * self.scale)
        edges = sorted((node << 21 | char, child) for (node, char), child in nodes.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.children = np.array([c for _, c in edges], np.int64)
        self.ids, self.scores = np.array(ids, np.int32), np.array(scores, np.int64)
        inner = [p.replace(MARK, " ") for p, _, _ in normal if len(p) > 1]
        # Whether texts may be cut in front of spaces and around line ends.
        self.cut_spaces = all(" " not in p.lstrip(" ") for p in inner)
        self.cut_lines = all("\n" not in p for p in inner)
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.blob = np.frombuffer(b"".join(self.texts), np.uint8)
        self.begin = np.cumsum(self.lengths) - self.lengths

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The children of nodes by a character each, -1 where there is none."""
        keys = nodes << 21 | chars
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.children[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes, the leading space included."""
        return self.blob[ranges(self.begin[ids], self.lengths[ids])].tobytes()


@dataclass
class Solved:
    """Best scores of the places of some units, and the piece that leads to each."""

    starts: np.ndarray  # of each unit's places
    best: np.ndarray
    length: np.ndarray  # of the last piece; 0 where a path begins
    piece: np.ndarray
    chars: np.ndarray


def solve(pieces: Pieces, units: list[str], limits: np.ndarray | None = None, first: np.ndarray | None = None) -> Solved:
    """Walk all units at once, a character at a time.

    Pieces of a unit begin before its limit. ``first`` has the scores of the first places of each unit; without it a unit
    begins at 0.
    """
    sizes = np.array([len(x) for x in units], np.int64)
    order = np.argsort(-sizes, kind="stable")
    chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    char_at = (np.cumsum(sizes) - sizes)[order]
    starts = np.cumsum(sizes + 1) - sizes - 1
    at, size = starts[order], sizes[order]
    limit = size if limits is None else limits[order]
    total = int((sizes + 1).sum())
    best = np.full(total, NONE, np.int64)
    length, piece = np.zeros(total, np.int16), np.full(total, -1, np.int32)
    if first is None:
        best[starts] = 0
    else:
        for k in range(first.shape[1]):
            fits = sizes >= k
            best[starts[fits] + k] = first[fits, k]
    for t in range(int(limit.max()) if len(limit) else 0):
        live = int(np.searchsorted(-size, -t, "left"))  # units with more than t characters
        here = np.flatnonzero((limit[:live] > t) & (best[at[:live] + t] > NONE))
        if len(here) == 0:
            continue
        node, score = np.zeros(len(here), np.int64), best[at[here] + t]
        for k in range(1, pieces.longest + 1):
            if k > 1:
                inside = size[here] >= t + k
                here, node, score = here[inside], node[inside], score[inside]
            child = pieces.step(node, chars[char_at[here] + t + k - 1])
            found = np.where(child >= 0, pieces.scores[child], NONE)
            ids = pieces.ids[child]
            if k == 1:
                lone = found == NONE
                ids, found = np.where(lone, pieces.unknown, ids), np.where(lone, pieces.unknown_score, found)
            place, value = at[here] + t + k, score + found
            better = (found > NONE) & (value > best[place])
            best[place[better]], length[place[better]], piece[place[better]] = value[better], k, ids[better]
            going = child >= 0
            here, node, score = here[going], child[going], score[going]
            if len(here) == 0:
                break
    return Solved(starts, best, length, piece, chars)


def paths(pieces: Pieces, solved: Solved, unit: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the paths that end at a place of a unit each: all ids, how many each has, and the place where it begins."""
    char_start = solved.starts - np.arange(len(solved.starts))
    begin = place.copy()
    owner, piece, char = [], [], []
    active = np.arange(len(unit))
    while len(active):
        node = solved.starts[unit[active]] + begin[active]
        step = solved.length[node]
        active, node, step = active[step > 0], node[step > 0], step[step > 0]
        begin[active] -= step
        owner.append(active)
        piece.append(solved.piece[node])
        char.append(solved.chars[char_start[unit[active]] + begin[active]] if len(active) else np.zeros(0, np.int64))
    owner, piece, char = (np.concatenate(x[::-1]) if x else np.zeros(0, np.int64) for x in (owner, piece, char))
    # Last steps come first now; a stable sort by path leaves each in reading order.
    order = np.argsort(owner, kind="stable")
    owner, piece, char = owner[order], piece[order].astype(np.int32), char[order]
    unknown = (piece == pieces.unknown) & pieces.has_bytes
    if unknown.any():
        spread = np.ones(len(piece), np.int64)
        spread[unknown] = 1 + (char[unknown] > 0x7F) + (char[unknown] > 0x7FF) + (char[unknown] > 0xFFFF)
        raw = np.frombuffer(char[unknown].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        wide = np.repeat(unknown, spread)
        owner, piece = np.repeat(owner, spread), np.repeat(piece, spread)
        piece[wide] = pieces.byte_ids[raw]
    return piece, np.bincount(owner, minlength=len(unit)), begin


class Words:
    """Ids of whole words, each distinct one solved once."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.count = 1
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)
        self.scores = np.zeros(1 << 16, np.int64)

    def add(self, words: list[str]) -> None:
        solved = solve(self.pieces, words)
        sizes = np.array([len(x) for x in words], np.int64)
        ids, counts, _ = paths(self.pieces, solved, np.arange(len(words)), sizes)
        first, used = self.count, int(self.ends[self.count - 1])
        need, total = first + len(words), used + len(ids)
        if need > len(self.ends):
            self.ends, self.scores = (np.resize(x, max(need, 2 * len(x))) for x in (self.ends, self.scores))
        if total > len(self.ids):
            self.ids = np.resize(self.ids, max(total, 2 * len(self.ids)))
        self.ends[first:need] = used + np.cumsum(counts)
        self.scores[first:need] = solved.best[solved.starts + sizes]
        self.ids[used:total] = ids
        self.count = need
        self.places.update(zip(words, range(first, need), strict=True))

    def entries(self, words: list[str]) -> np.ndarray:
        if self.count > CACHE_WORDS:
            self.clear()
        places = self.places
        new = [word for word in dict.fromkeys(words) if word not in places]
        # Words of like lengths together; very long ones in small company.
        new.sort(key=len)
        at = 0
        while at < len(new):
            to = min(len(new), at + max(1, (1 << 19) // max(16, len(new[min(at + 20_000, len(new) - 1)]))))
            self.add(new[at:to])
            at = to
        out = np.fromiter((places[word] for word in words), np.int64, len(words))
        for word in reversed(new):
            if len(word) <= CACHE_CHARS:
                break
            del places[word]
        return out

    def split(self, texts: pa.Array) -> pa.ListArray:
        """Words of texts, each with the spaces before it; line ends alone."""
        if not self.pieces.cut_spaces:
            return pa.array([[x] for x in texts.to_pylist()], pa.list_(pa.string()))
        mark = next(chr(c) for c in range(0xE000, 0xF8FF) if not pc.any(pc.match_substring(texts, chr(c))).as_py())
        texts = pc.replace_substring_regex(texts, " +", mark + "\\0")
        if self.pieces.cut_lines:
            texts = pc.replace_substring(texts, "\n", f"{mark}\n{mark}")
        return pc.split_pattern(texts, mark)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts (with their leading space), and where each text's ids start."""
        split = self.split(texts)
        coded = split.flatten().dictionary_encode()
        entry = self.entries(coded.dictionary.to_pylist())
        begin = np.where(entry > 0, self.ends[np.maximum(entry, 1) - 1], 0)
        size = np.where(entry > 0, self.ends[entry] - begin, 0)
        of_word = coded.indices.to_numpy(zero_copy_only=False)
        counts = size[of_word]
        bounds = split.offsets.to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[ranges(begin[of_word], counts)], before[bounds - bounds[0]]

    def parts(self, text: str, look: str) -> tuple[str, list[str], str | None]:
        """A chunk's head, the whole words within it and its tail; no tail where nothing cuts it."""
        words = [x for x in self.split(pa.array([text], pa.string()))[0].as_py()]
        cut = len(words) > 1
        # A run of spaces at the chunk's end may go on, so a tail begins with its run; one at its start may be an earlier run's rest.
        head, inner, tail = words[0], words[1:-1], words[-1] if cut else None
        if cut and not head.strip(" ") and text.startswith(" "):
            head, inner, tail = (head + words[1], words[2:-1], words[-1]) if len(words) > 2 else (text, [], None)
        return head, inner, tail

    def matrix(self, text: str, look: str) -> np.ndarray:
        """The chunk's transfer matrix: from a state at its start to one at its end."""
        n = self.pieces.longest
        head, inner, tail = self.parts(text, look)
        last = tail if tail is not None else head
        sources = np.full((n, n), NONE, np.int64)
        np.fill_diagonal(sources, 0)

        def ends(units: list[str], body: int, first: np.ndarray) -> np.ndarray:
            solved = solve(self.pieces, units, np.full(len(units), body), first)
            size = len(units[0])
            place = np.arange(body, body + n)
            out = np.full((len(units), n), NONE, np.int64)
            fits = place <= size
            out[:, fits] = solved.best[solved.starts[:, None] + place[fits]]
            return out

        if tail is None:
            return ends([last + look] * n, len(last), sources)
        through = ends([head] * n, len(head), sources)[:, 0]
        leaving = ends([last + look], len(last), np.zeros((1, 1), np.int64))[0]
        entry = self.entries(inner)  # may make room for more scores
        middle = int(self.scores[entry].sum())
        out = through[:, None] + middle + leaving[None, :]
        out[(through[:, None] <= NONE // 2) | (leaving[None, :] <= NONE // 2)] = NONE
        return out

    def backtraced(self, text: str, look: str, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Ids up to the tail, those of the tail for each state at the end, and the state at the start that each came from."""
        n = self.pieces.longest
        head, inner, tail = self.parts(text, look)

        def tails(unit: str, body: int, first: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
            solved = solve(self.pieces, [unit + look], np.array([body]), first[None, :])
            place = np.arange(body, min(body + n, len(unit + look) + 1))
            place = place[solved.best[place] > NONE]
            ids, counts, begin = paths(self.pieces, solved, np.zeros(len(place), np.int64), place)
            out, origin = [np.zeros(0, np.int32)] * n, np.full(n, -1)
            for p, x, b in zip(place.tolist(), np.split(ids, np.cumsum(counts)[:-1]), begin.tolist(), strict=True):
                out[p - body], origin[p - body] = x, b
            return out, origin

        if tail is None:
            found, origin = tails(head, len(head), first)
            return np.zeros(0, np.int32), found, origin
        solved = solve(self.pieces, [head], None, first[None, :])
        ids, _, begin = paths(self.pieces, solved, np.zeros(1, np.int64), np.array([len(head)]))
        entry = self.entries(inner)
        start = np.where(entry > 0, self.ends[np.maximum(entry, 1) - 1], 0)
        middle = self.ids[ranges(start, np.where(entry > 0, self.ends[entry] - start, 0))]
        found, _ = tails(tail, len(tail), np.zeros(1, np.int64))
        return np.concatenate([ids, middle]), found, np.full(n, begin[0])


_words: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def times(vector: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Max-plus product of a row of scores and a transfer matrix, with 0 as its greatest."""
    out = (vector[:, None] + matrix).max(0)
    out = np.where(out <= NONE // 2, NONE, out)
    return np.where(out > NONE, out - out.max(), NONE)


def encoded_giants(chunks: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``part``, ``n_parts`` and ``ids`` of the chunks of long documents.

    ``row`` tells documents apart, ``body`` is the chunk and ``look`` what follows it.
    """
    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [words_of(model).matrix(a, b).tobytes() for a, b in zip(batch["body"].to_pylist(), batch["look"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["part"], pa.array(raw, pa.binary())], names=["row", "part", "matrix"])

    def multiplied(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        vector, before = None, []
        for raw in table["matrix"].to_pylist():
            matrix = np.frombuffer(raw, np.int64)
            matrix = matrix.reshape(int(len(matrix) ** 0.5), -1)
            if vector is None:
                vector = np.full(len(matrix), NONE, np.int64)
                vector[0] = 0
            before.append(vector.tobytes())
            vector = times(vector, matrix)
        return pa.table([table["row"], table["part"], pa.array(before, pa.binary())], names=["row", "part", "first"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                columns = (part[x].to_pylist() for x in ("body", "look", "first"))
                found = [words_of(model).backtraced(a, b, np.frombuffer(f, np.int64)) for a, b, f in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part[x] for x in ("doc_id", "n_parts", "row", "part")), pa.array([x[0] for x in found], pa.list_(pa.int32())),
                     pa.array([x[1] for x in found], pa.list_(pa.list_(pa.int32()))), pa.array([x[2].tolist() for x in found], pa.list_(pa.int32()))],
                    names=["doc_id", "n_parts", "row", "part", "ids", "tails", "origin"],
                )

    def composed(table: pa.Table) -> pa.Table:
        """From the end, where nothing sticks out, to the start."""
        table = table.sort_by([("part", "descending")])
        state, out = 0, []
        for origin in table["origin"].to_pylist():
            out.append(state)
            state = origin[state]
        return pa.table([table["row"], table["part"], pa.array(out, pa.int32())], names=["row", "part", "state"])

    first = (
        chunks.select("row", "part", "body", "look").mapInArrow(matrices, "row long, part int, matrix binary").groupBy("row").applyInArrow(multiplied, "row long, part int, first binary")
    )
    maps = chunks.join(first, ["row", "part"]).mapInArrow(
        traced, "doc_id long, n_parts int, row long, part int, ids array<int>, tails array<array<int>>, origin array<int>"
    )
    states = maps.select("row", "part", "origin").groupBy("row").applyInArrow(composed, "row long, part int, state int")
    return maps.join(states, ["row", "part"]).select(
        "doc_id", "part", "n_parts", F.concat("ids", F.get("tails", F.col("state"))).alias("ids")
    )


def encode(documents: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id``, ``part``, ``n_parts`` and ``ids`` of each part of each document (``doc_id``, ``text``).

    A document's ids are those of its parts in order.
    """
    longest = Pieces(model).longest
    if chunk < longest:
        raise ValueError(f"chunks need {longest} characters at least")
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" "))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(text == "", "").otherwise(F.concat(F.lit(" "), text)).alias("text")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, starts = words_of(model).encode(part["text"])
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists], names=["doc_id", "ids"])

    short = texts.where(F.char_length("text") <= chunk).mapInArrow(whole, "doc_id long, ids array<int>")
    # Numbers follow the scan's splits, which are the same whenever the scan is read.
    giant = texts.withColumn("row", F.monotonically_increasing_id()).where(F.char_length("text") > chunk)
    count = F.ceil(F.char_length("text") / chunk).cast("int")
    chunks = giant.select("doc_id", "row", "text", count.alias("n_parts"), F.explode(F.sequence(F.lit(0), count - 1)).alias("part")).select(
        "doc_id", "row", "n_parts", "part", F.substring("text", F.col("part") * chunk + 1, F.lit(chunk)).alias("body"),
        F.substring("text", (F.col("part") + 1) * chunk + 1, F.lit(longest - 1)).alias("look"),
    )
    long = encoded_giants(chunks, model)
    return short.select("doc_id", F.lit(0).alias("part"), F.lit(1).alias("n_parts"), "ids").union(long)


def part_texts(pieces: Pieces, batch: pa.RecordBatch) -> list[str]:
    """The text of each part, without the space that leads the first one."""
    flat, ends = batch["ids"].flatten().to_numpy(), batch["ids"].offsets.to_numpy()
    ends = ends - ends[0]
    raw = [pieces.decode(flat[a:b]).decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return [x[1:] if part == 0 else x for x, part in zip(raw, batch["part"].to_pylist(), strict=True)]


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``part``, ``n_parts`` and ``text`` of encoded parts; a document's text is that of its parts in order."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*(batch[x] for x in ("doc_id", "part", "n_parts")), pa.array(part_texts(words_of(model).pieces, batch), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "n_parts", "text"])

    return encoded.select("doc_id", "part", "n_parts", "ids").mapInArrow(texts, "doc_id long, part int, n_parts int, text string")


def digest(encoded: DataFrame, model: str) -> DataFrame:
    """Counts and checksums of each part's ids (unsigned, little-endian, 32 bits) and of the text they decode to (UTF-8)."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = batch["ids"].flatten().to_numpy().astype("<u4"), batch["ids"].offsets.to_numpy()
            ends = ends - ends[0]
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            texts = part_texts(words_of(model).pieces, batch)
            numbers = (np.diff(ends), crc, list(map(len, texts)), [zlib.crc32(x.encode()) for x in texts])
            yield pa.RecordBatch.from_arrays(
                [*(batch[x] for x in ("doc_id", "part", "n_parts")), *(pa.array(x, pa.int64()) for x in numbers)],
                names=["doc_id", "part", "n_parts", "n_tokens", "ids_crc32", "n_chars", "text_crc32"],
            )

    return encoded.select("doc_id", "part", "n_parts", "ids").mapInArrow(
        summed, "doc_id long, part int, n_parts int, n_tokens long, ids_crc32 long, n_chars long, text_crc32 long"
    )
