"""A double-array automaton over a word list: all words at all places of many texts, a character a step.

Flat integer arrays hold a trie: a state's child by the character with code c is at ``base[state] + c``, if ``check`` there
names the state. They are built once, on the driver, and sent to the tasks; there they are walked from every
place of a batch of texts at once, so Python's work is one step per character of the longest word, not one per text or
character. What is taken from left to right, or from right to left, is marked by jumps of doubled length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters that are walked at a time, unless a single text is longer.
STEP_CHARS = 1 << 20
# Rounds in which states look for places before there are twice as many.
_TRIES = 100


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count says, in a row."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum()), dtype=np.int64) + np.repeat(starts - before, counts)


def _trie(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States of a trie of distinct words, level by level: each one's parent and character, and each word's state."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    chars = code_points("".join(words))
    starts = np.cumsum(sizes) - sizes
    state, open_ = np.zeros(len(words), np.int64), np.arange(len(words))
    parents, letters, count, depth = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1, 0
    while len(open_):
        keys = state[open_] << 21 | chars[starts[open_] + depth]
        found, at = np.unique(keys, return_inverse=True)
        parents.append(found >> 21)
        letters.append(found & (1 << 21) - 1)
        state[open_] = count + at
        count += len(found)
        depth += 1
        open_ = open_[sizes[open_] > depth]
    return np.concatenate(parents), np.concatenate(letters), state


@dataclass
class Automaton:
    """``codes`` maps code points to codes from 1 (0: in no word), ``word`` states to the word that ends there, or -1."""

    codes: np.ndarray
    base: np.ndarray
    check: np.ndarray
    word: np.ndarray
    longest: int

    @classmethod
    def of(cls, words: Iterable[str]) -> Automaton:
        """Of a list of distinct words, none of them empty; their numbers are their places in it."""
        words = list(words)
        parent, letter, end = _trie(words)
        # Frequent characters have small codes, so that children lie close together.
        alphabet, count = np.unique(letter[1:], return_counts=True)
        codes = np.zeros(int(letter.max(initial=0)) + 2, np.int32)  # the last stands for all higher ones
        codes[alphabet[np.argsort(-count, kind="stable")]] = np.arange(1, len(alphabet) + 1)
        code = codes[letter].astype(np.int64)
        place, base, top = cls._placed(parent, code, len(alphabet))
        check = np.full(top, -1, np.int32)
        check[place[1:]] = place[parent[1:]]
        bases, word = np.zeros(top, np.int32), np.full(top, -1, np.int32)
        bases[place] = base
        word[place[end]] = np.arange(len(words))
        return cls(codes, bases, check, word, max(map(len, words), default=0))

    @staticmethod
    def _placed(parent: np.ndarray, code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places of all states, and from where their children's places count; the root's place is 0.

        States with several children go first, those with most ahead, each round at random places. A single child fits
        any free place, so all of those are placed at once in what is left.
        """
        states = len(parent)
        order = np.lexsort((code, parent))
        order = order[order != 0]
        children = np.bincount(parent[1:], minlength=states)
        first = np.cumsum(children) - children
        place, base = np.zeros(states, np.int64), np.zeros(states, np.int64)
        size = states * 3 // 2 + 2 * width + 2
        taken = np.zeros(size, bool)
        taken[: width + 1] = True  # the root's place, and so that no base is below 0
        rng = np.random.default_rng(0)
        # States of about as many children try places together, until each has found free ones.
        weight = np.log2(np.maximum(children, 1)).astype(np.int64)
        for level in range(int(weight.max(initial=0)), 0, -1):
            waiting = np.flatnonzero((weight == level) & (children > 1))
            tries = 0
            while len(waiting):
                tries += 1
                if tries % _TRIES == 0:
                    size *= 2
                    taken = np.concatenate([taken, np.zeros(size - len(taken), bool)])
                tried = rng.integers(1, size - width, len(waiting))
                own = order[ranges(first[waiting], children[waiting])]
                slots = np.repeat(tried, children[waiting]) + code[own]
                mine = np.zeros(len(slots), bool)
                mine[np.unique(slots, return_index=True)[1]] = True
                mine &= ~taken[slots]
                fits = np.logical_and.reduceat(mine, np.cumsum(children[waiting]) - children[waiting])
                every = np.repeat(fits, children[waiting])
                place[own[every]] = slots[every]
                taken[slots[every]] = True
                base[waiting[fits]] = tried[fits]
                waiting = waiting[~fits]
        single = np.flatnonzero(children == 1)
        own = order[first[single]]
        free = np.flatnonzero(~taken)
        while len(free) < len(own):
            taken = np.concatenate([taken, np.zeros(states, bool)])
            free = np.flatnonzero(~taken)
        place[own] = free[: len(own)]
        base[single] = place[own] - code[own]
        return place, base, int(max(place.max(initial=0), base.max(initial=0))) + width + 1

    def hits(self, chars: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Words in code points of texts, ``ends`` being where the text of each place ends: for each size the places where
        words of that size start, in order, and which words those are."""
        codes = self.codes[np.minimum(chars, len(self.codes) - 1)]
        at = np.flatnonzero(codes)
        state = np.zeros(len(at), np.int64)
        for size in range(1, self.longest + 1):
            place = self.base[state] + codes[at + size - 1]
            keep = (self.check[place] == state) & (codes[at + size - 1] > 0)
            at, state = at[keep], place[keep]
            word = self.word[state]
            if (word >= 0).any():
                yield at[word >= 0], size, word[word >= 0]
            keep = at + size < ends[at]
            at, state = at[keep], state[keep]
            if len(at) == 0:
                return


@dataclass
class Edges:
    """Words that were found elsewhere, as an automaton: places and sizes, in order of the size. A word's number is its row."""

    at: np.ndarray
    size: np.ndarray

    def hits(self, chars: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        sizes, first = np.unique(self.size, return_index=True)
        first = np.append(first, len(self.size))
        for size, begin, end in zip(sizes.tolist(), first[:-1], first[1:], strict=True):
            yield self.at[begin:end], size, np.arange(begin, end)


def marked(starts: np.ndarray, jumps: np.ndarray) -> np.ndarray:
    """Which places are reached from some places by jumps any number of times; a place that is its own jump ends a way."""
    seen = np.zeros(len(jumps), bool)
    seen[starts] = True
    while True:
        before = int(seen.sum())
        seen[jumps[seen]] = True
        jumps = jumps[jumps]
        # Closed under these jumps means closed under single ones, as all shorter ways are in it.
        if int(seen.sum()) == before:
            return seen


class Texts:
    """Some texts as one row of code points; NULL counts as empty."""

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        self.count = len(texts)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64, self.count + 1, texts.offset * 8)
        self.data = b"" if data is None else memoryview(data)[offsets[0] : offsets[-1]]
        self.chars = code_points(bytes(self.data).decode("utf-8"))
        self.bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        size = 1 + (self.chars > 0x7F) + (self.chars > 0x7FF) + (self.chars > 0xFFFF)
        self.byte = np.concatenate([[0], np.cumsum(size)])

    def tokens(self, starts: np.ndarray) -> pa.Array:
        """Arrays of the texts' parts that begin at the marked places."""
        at = np.flatnonzero(starts)
        offsets = np.append(self.byte[at], self.byte[-1])
        parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data))
        lists = np.searchsorted(at, self.bounds)
        return pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), parts.cast(pa.string()))


def steps(texts: pa.Array, limit: int = STEP_CHARS) -> Iterator[pa.Array]:
    """The texts in runs of about as many characters as the limit."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield texts.slice(start, row - start)
            total, start = 0, row
        total += size
    yield texts.slice(start)


def longest_sizes(automaton: Automaton, texts: Texts) -> np.ndarray:
    """The size of the longest word at each place, 1 where there is none."""
    sizes = np.ones(len(texts.chars), np.int64)
    for at, size, _ in automaton.hits(texts.chars, texts.ends):
        sizes[at] = size
    return sizes


def cut_longest(automaton: Automaton, texts: pa.Array) -> pa.Array:
    """Tokens from left to right, the longest word at each place."""
    held = Texts(texts)
    return cut_at(held, longest_sizes(automaton, held))


def cut_at(held: Texts, sizes: np.ndarray) -> pa.Array:
    """Tokens from left to right, by the size of the token at each place."""
    n = len(held.chars)
    jumps = np.append(np.arange(n) + sizes, n)
    starts = held.bounds[:-1]
    return held.tokens(marked(starts[starts < held.bounds[1:]], jumps)[:n])


def rewrite_longest(automaton: Automaton, texts: pa.Array, outputs: pa.Array) -> pa.Array:
    """Texts with the longest word at each place, from left to right, replaced by its output; NULL stays NULL."""
    held = Texts(texts)
    n = len(held.chars)
    sizes, word = np.ones(n, np.int64), np.full(n, -1, np.int64)
    for at, size, words in automaton.hits(held.chars, held.ends):
        sizes[at], word[at] = size, words
    starts = held.bounds[:-1]
    taken = np.flatnonzero(marked(starts[starts < held.bounds[1:]], np.append(np.arange(n) + sizes, n))[:n])
    new = Texts(outputs)
    hit = word[taken] >= 0
    own, by = taken[hit], word[taken[hit]]
    # Pieces of the result: characters of the text, or outputs.
    piece = np.where(hit, 0, held.byte[taken + 1] - held.byte[taken])
    piece[hit] = new.byte[new.bounds[by + 1]] - new.byte[new.bounds[by]]
    ends = np.cumsum(piece)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - piece
    source, table = np.frombuffer(held.data, np.uint8), np.frombuffer(new.data, np.uint8)
    out[ranges(begin[~hit], piece[~hit])] = source[ranges(held.byte[taken[~hit]], piece[~hit])]
    out[ranges(begin[hit], piece[hit])] = table[ranges(new.byte[new.bounds[by]], piece[hit])] if len(own) else 0
    edges = np.concatenate([[0], ends])[np.searchsorted(taken, held.bounds)]
    rewritten = pa.LargeStringArray.from_buffers(held.count, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out))
    return pc.if_else(pc.is_valid(texts), rewritten, None).cast(pa.string())


def cut_cheapest(automaton: Automaton, texts: pa.Array, costs: np.ndarray, other: int) -> pa.Array:
    """Tokens of the way through each text whose words cost least; a character that no word is costs ``other``.

    Of equal ways the one with the longer last word stands. Where no word reaches across a place the ways to both sides are
    independent: such runs are solved together, a place of each in a step.
    """
    held = Texts(texts)
    n = len(held.chars)
    place = np.arange(n)
    starts, sizes, price = [place], [np.ones(n, np.int64)], [np.full(n, other, np.int64)]
    alone = price[0]
    for at, size, words in automaton.hits(held.chars, held.ends):
        if size == 1:
            alone[at] = costs[words]
        else:
            starts.append(at)
            sizes.append(np.full(len(at), size))
            price.append(costs[words])
    start, size, price = np.concatenate(starts), np.concatenate(sizes), np.concatenate(price)
    order = np.lexsort((size, start))
    end, price = (start + size)[order], price[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=n))])
    # Runs begin where no earlier word ends later.
    reach = np.maximum.accumulate(np.maximum.reduceat(end, first[:-1])) if n else end
    heads = np.flatnonzero(np.concatenate([[True], reach[:-1] <= place[1:]])) if n else place
    lengths = np.diff(np.append(heads, n))
    best, back = np.full(n + 1, np.iinfo(np.int64).max), np.arange(n + 1)
    # The start of a run costs nothing; its end is the next run's start, so ends are kept apart.
    last = np.full(len(heads), np.iinfo(np.int64).max)
    came = np.zeros(len(heads), np.int64)
    best[heads] = 0
    by_length = np.argsort(-lengths, kind="stable")
    for step in range(int(lengths.max(initial=0))):
        runs = by_length[: np.searchsorted(-lengths[by_length], -step, "left")]
        at = heads[runs] + step
        count = first[at + 1] - first[at]
        edge = ranges(first[at], count)
        run, origin, to = np.repeat(runs, count), np.repeat(at, count), end[edge]
        cost = best[origin] + price[edge]
        closing = to == heads[run] + lengths[run]
        inner = ~closing & (cost < best[np.minimum(to, n)])
        best[to[inner]], back[to[inner]] = cost[inner], origin[inner]
        final = np.flatnonzero(closing)
        final = final[cost[final] < last[run[final]]]
        last[run[final]], came[run[final]] = cost[final], origin[final]
    back[heads] = heads
    taken = marked(came, back) if n else np.zeros(1, bool)
    taken[heads] = True
    return held.tokens(taken[:n])
