"""Names of repeated substrings by recompression of arrays of words.

Rounds name runs of one symbol and pairs of neighbours. A pair is replaced if its first symbol is of the
left class and its second of the right one; the class is a bit of the symbol's name, so whether a pair
is replaced depends on the pair alone and equal substrings get equal symbols inside. Names are hashes of
what they replace: they are global without a dictionary, and a round that only names needs no exchange.
What tasks must exchange is which names occur in several documents.

A symbol is *determined* by the words between its ``low`` and ``high``: whatever stands outside, these
words are always cut so. Every window of words sees the symbols whose bounds lie inside it, at least its
single words; of them the window's *anchor* is the one of most words, ties by name. Equal windows so have
equal anchors, and neighbours mostly share one, so there are far fewer anchors than windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

ROUNDS = 4
CHUNK = 1 << 16

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def joined(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Names of ordered pairs of names."""
    return mix(a * U(0x9E3779B97F4A7C15) + b * U(0xC2B2AE3D27D4EB4F) + U(seed))


def second_names(names: np.ndarray) -> np.ndarray:
    return mix(names + U(0x632BE59BD9B4E019))


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_names(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two names, first byte and end of the words of some bytes; eight bytes of all words at a time.

    The second name is made from the bytes too, so that words are told apart by 128 bits.
    """
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~BLANK[raw]
    change = np.flatnonzero(np.diff(inside))
    start, end = change[::2], change[1::2]
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    a, b = mix((end - start).astype(np.uint64) + U(1)), mix((end - start).astype(np.uint64) + U(2))
    rest, at = np.arange(len(start)), start
    while len(rest):
        here = eight[at]
        left = np.minimum(end[rest] - at, 8)
        here = here & (~U(0) >> (U(64) - left.astype(np.uint64) * U(8)))
        a[rest], b[rest] = joined(a[rest], here, 11), joined(b[rest], mix(here + U(13)), 12)
        more = end[rest] - at > 8
        rest, at = rest[more], at[more] + 8
    return a, b, start, end


@dataclass
class Symbols:
    """Neighbouring symbols: name, first word and end, and the bounds of the words that determine them."""

    a: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of_words(cls, a: np.ndarray) -> Symbols:
        at = np.arange(len(a))
        return cls(a, at, at + 1, at, at + 1)

    def merged(self, first: np.ndarray, last: np.ndarray) -> Symbols:
        """Symbols from ``first`` to ``last``, still under the first one's name."""
        return Symbols(self.a[first], self.start[first], self.end[last], self.low[first], self.high[last])

    def judged(self, old: Symbols, first: np.ndarray, last: np.ndarray, left: np.ndarray | slice, right: np.ndarray | slice) -> Symbols:
        """Widen the bounds of the symbols at ``left`` and ``right``, where the neighbour had a say."""
        # Beyond the ends of the array lies what is not known.
        low, high = np.r_[-1, old.low], np.r_[old.high, len(old.a) and old.end[-1] + 1]
        self.low[left] = low[first[left]]
        self.high[right] = high[last[right] + 1]
        return self


def name_runs(s: Symbols, seed: int) -> Symbols:
    """Runs of one symbol become a symbol; both neighbours say where a run ends."""
    first = np.flatnonzero(np.r_[True, s.a[1:] != s.a[:-1]])
    length = np.diff(np.r_[first, len(s.a)])
    last = first + length - 1
    out = s.merged(first, last)
    many = np.flatnonzero(length > 1)
    out.a[many] = joined(out.a[many], length[many].astype(np.uint64), seed)
    return out.judged(s, first, last, slice(None), slice(None))


def name_pairs(s: Symbols, seed: int) -> Symbols:
    """Pairs of a left and a right symbol become a symbol."""
    lefts = (s.a >> U(seed % 61)) & U(1) == 0
    pair = lefts[:-1] & ~lefts[1:]
    first = np.flatnonzero(~np.r_[False, pair])
    two = np.r_[pair, False][first]
    last = first + two
    out = s.merged(first, last)
    both = np.flatnonzero(two)
    out.a[both] = joined(out.a[both], s.a[first[both] + 1], seed)
    # A symbol that stays alone does so because of the neighbour it might have been paired with.
    alone, as_left = ~two, lefts[first]
    return out.judged(s, first, last, np.flatnonzero(alone & ~as_left), np.flatnonzero(alone & as_left))


def rounds(a: np.ndarray) -> Iterator[Symbols]:
    """The words, their runs, and the symbols of each round of pairs."""
    s = Symbols.of_words(a)
    yield s
    s = name_runs(s, 1)
    for k in range(ROUNDS):
        yield s
        s = name_pairs(s, 3 + 2 * k)
    yield s


def anchors(levels: Iterable[Symbols], n: int, width: int) -> np.ndarray:
    """The anchor of each window of ``width`` words; ``best[i]`` belongs to the window at word i."""
    table = np.zeros((width + 1, n + 1), np.uint64)
    for s in levels:
        extent = s.high - s.low
        seen = (extent <= width) & (s.low >= 0) & (s.high <= n)
        rank = (s.end - s.start).astype(np.uint64) << U(58) | s.a >> U(6)
        np.maximum.at(table.reshape(-1), extent[seen] * (n + 1) + s.low[seen], rank[seen])
    best = table[0]
    for extent in range(1, width + 1):
        # What a stretch of words sees: what the stretches without its last or first word see, and itself.
        shorter = best
        best = table[extent]
        np.maximum(best, shorter, out=best)
        np.maximum(best[:-1], shorter[1:], out=best[:-1])
    return best[: n - width + 1]


def windows(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two names of the window of ``width`` words at each word, from those of windows of powers of two."""

    def named(x: np.ndarray, seed: int) -> np.ndarray:
        n = len(x) - width + 1
        whole, have, size = None, 0, 1
        while True:
            if width & size:
                whole = x[:n] if whole is None else joined(whole, x[have : have + n], seed)
                have += size
            if have == width:
                return whole
            x = joined(x[: len(x) - size], x[size:], seed + size)
            size *= 2

    if len(a) < width:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return named(a, 1001), named(b, 2001)


def window_anchors(a: np.ndarray, width: int) -> np.ndarray:
    """The anchor of the window at each word, in chunks that overlap by a window less a word.

    An anchor does not depend on where chunks begin.
    """
    found = [np.empty(0, np.uint64)]
    for begin in range(0, len(a) - width + 1, CHUNK):
        part = a[begin : begin + CHUNK + width - 1]
        found.append(anchors(rounds(part), len(part), width))
    return np.concatenate(found)
