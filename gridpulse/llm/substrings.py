"""Removal of repeated passages: words of windows that an earlier document holds too.

Texts are gathered into blocks of about ``BLOCK`` bytes and parsed by ``recompression``: rounds that name
runs and pairs give equal passages equal symbols inside, whatever surrounds them. Every window has an
anchor, the widest symbol that its words determine; neighbouring windows with one anchor are a *stretch*.
Then Spark exchanges names in two rounds.

1. *Reveal.* Blocks send the names of anchors and of their stretches. A stretch that a smaller id has
   settles all its windows: they are removed, and need not be compared, for the other document holds
   them as well. So the inside of a long repeat is verified by its stretches. Windows are left over only
   where several documents share an anchor in different stretches, as at the ends of a repeat.
2. *Verify.* Those are sent by their own 128-bit names, and come back where a smaller id has them.

Names go once a block with the least and greatest id that has them; an anchor with many stretches in a
block goes without their names, which leaves its windows to the second round. So the most frequent
passage makes a few rows a block, however many documents have it. Nothing is dropped for being frequent,
and texts of any length take part whole; a task holds one block, that is at least one whole text.

Cases: null text has no words; a null id is nobody's smaller id and loses nothing; rows that share an id
do not count as each other's smaller one; documents shorter than a window lose nothing; an empty table
gives an empty result. Further columns of the input are not read. Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import cut, pick
from gridpulse.llm.recompression import joined, window_anchors, windows, word_names

WIDTH = 13
BLOCK = 1 << 20

CELLS = ("block", "ids", "sizes", "payload")
NAMES = ["block", "a", "b", "lo", "hi"]
#: Stretches of one anchor that a block names at most.
STRETCHES = 4


def blocks(df: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK) -> DataFrame:
    """(block, ids, sizes, payload): texts in blocks, compressed, with their ids and sizes in bytes."""
    rows = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 33
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            sizes = [len(t) for t in texts]
            columns = [[number], [ids], [sizes], [pack.compress(b" ".join(texts))]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        names = ["block", "ids", "sizes", "payload"]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(key)
                texts.append((text or "").encode())
                size += len(texts[-1])
                if size >= block_bytes:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield block()

    return rows.mapInArrow(run, "block bigint, ids array<bigint>, sizes array<bigint>, payload binary")


class Block:
    """The words of a block: names, places in ``data``, their document and its id."""

    def __init__(self, ids: list, sizes: list[int], payload: bytes, width: int):
        self.data = zstandard.ZstdDecompressor().decompress(payload)
        self.ids = ids
        self.begin = np.r_[0, np.cumsum(np.array(sizes, np.int64) + 1)]
        self.a, self.b, self.start, self.end = word_names(self.data)
        self.doc = np.searchsorted(self.begin, self.start, "right") - 1
        self.known = np.array([i is not None for i in ids], bool)
        self.key = np.array([0 if i is None else i for i in ids], np.int64)[self.doc]
        first = np.arange(max(0, len(self.a) - width + 1))
        self.whole = self.within(first, first + width)

    def within(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether words ``[first, end)`` lie in one document that has an id."""
        return (self.doc[first] == self.doc[end - 1]) & self.known[self.doc[first]]


def once_a_block(a: np.ndarray, b: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct names (a, b) with their least and greatest key."""
    if not len(a):
        return a, b, keys, keys
    fresh = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (keys[1:] != keys[:-1])])
    a, b, keys = a[fresh], b[fresh], keys[fresh]
    order = np.lexsort((b, a))
    a, b, keys = a[order], b[order], keys[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    return a[first], b[first], np.minimum.reduceat(keys, first), np.maximum.reduceat(keys, first)


def find(a: np.ndarray, b: np.ndarray, among_a: np.ndarray, among_b: np.ndarray) -> np.ndarray:
    """The place of each name in a sorted list of names, or -1."""
    if not len(among_a):
        return np.full(len(a), -1)
    at = np.minimum(np.searchsorted(among_a, a), len(among_a) - 1)
    return np.where((among_a[at] == a) & (among_b[at] == b), at, -1)


def covered(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True where one of the ranges ``[first, end)`` lies."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0


def by_name(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b) of a block's names, sorted, and the order that sorts them."""
    a, b = (table.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
    order = np.lexsort((b, a))
    return a[order], b[order], order


def name_columns(block: int, a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in (np.full(len(a), block), a.view(np.int64), b.view(np.int64), lo, hi)]


@dataclass
class Stretches:
    """Neighbouring windows of a document with one anchor, ``width`` at most: names, first and last window."""

    a: np.ndarray
    b: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, block: Block, names: np.ndarray, width: int) -> Stretches:
        anchors = window_anchors(block.a, width)
        at = np.flatnonzero(block.whole)
        if not len(at):
            return cls(anchors[at], anchors[at], at, at)
        begins = np.r_[True, (np.diff(at) > 1) | (anchors[at[1:]] != anchors[at[:-1]]) | (block.doc[at[1:]] != block.doc[at[:-1]])]
        place = np.arange(len(at))
        inside = place - np.maximum.accumulate(np.where(begins, place, 0))
        begin = np.flatnonzero(inside % width == 0)
        first, last = at[begin], at[np.r_[begin[1:], len(at)] - 1]
        # The first and the last window hold all words of the stretch.
        b = joined(joined(names[first], names[last], 31), (last - first).astype(np.uint64), 32) | np.uint64(1)
        return cls(anchors[first], b, first, last)


def once_an_anchor(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct names, but of an anchor with many stretches only itself, with b = 0."""
    if not len(a):
        return a, b, lo, hi
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    count = np.diff(np.r_[first, len(a)])
    many = count > STRETCHES
    few = np.repeat(~many, count)
    least, greatest = np.minimum.reduceat(lo, first)[many], np.maximum.reduceat(hi, first)[many]
    parts = (a[few], a[first[many]]), (b[few], np.zeros(many.sum(), np.uint64)), (lo[few], least), (hi[few], greatest)
    return tuple(map(np.concatenate, parts))


def reveal(held: DataFrame, width: int) -> DataFrame:
    """Names that matter to a block, (block, a, b, least, various).

    ``least`` is the smallest id that has the stretch; ``various``: documents share the anchor in
    several stretches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, *cells = (batch.column(c)[row].as_py() for c in CELLS)
                block = Block(*cells, width)
                found = Stretches.of(block, windows(block.a, block.b, width)[0], width)
                names = once_an_anchor(*once_a_block(found.a, found.b, block.key[found.first]))
                yield pa.RecordBatch.from_arrays(name_columns(number, *names), names=NAMES)

    # Dealt by anchor once: both windows find their rows together.
    names = held.mapInArrow(run, ", ".join(f"{c} bigint" for c in NAMES)).repartition("a")
    stretch, anchor = Window.partitionBy("a", "b"), Window.partitionBy("a")
    known = names.withColumn("least", F.min("lo").over(stretch)).withColumns(
        {
            "ids": F.min("lo").over(anchor) < F.max("hi").over(anchor),
            "kinds": (F.min("b").over(anchor) < F.max("b").over(anchor)) | (F.col("b") == 0),
        }
    )
    various = F.col("ids") & F.col("kinds")
    settles = (F.col("b") != 0) & (F.col("least") < F.col("hi"))
    return cut(known.where(settles | various).select("block", "a", "b", "least", various.alias("various")), release=True)


def verify(held: DataFrame, revealed: DataFrame, width: int) -> DataFrame:
    """(block, mask): a bit for each window that a stretch settles; (block, a, b, least): others to remove."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number, *cells = (left.column(c)[0].as_py() for c in CELLS)
        names, masks = name_columns(number, *[np.empty(0, np.int64)] * 4), []
        if len(right):
            block = Block(*cells, width)
            a, b = windows(block.a, block.b, width)
            found = Stretches.of(block, a, width)
            known_a, known_b, order = by_name(right)
            at = find(found.a, found.b, known_a, known_b)
            settled = at >= 0
            settled[settled] = block.key[found.first[settled]] > right.column("least").to_numpy()[order][at[settled]]
            shared = known_a[right.column("various").to_numpy(zero_copy_only=False)[order]]
            open_ = np.isin(found.a, shared) & ~settled
            at = np.flatnonzero(covered(len(block.whole), found.first[open_], found.last[open_] + 1))
            names = name_columns(number, *once_a_block(a[at], b[at], block.key[at]))
            mask = covered(len(block.whole), found.first[settled], found.last[settled] + 1)
            masks = [np.packbits(mask).tobytes()] if settled.any() else []
        columns = [pa.concat_arrays([c, pa.nulls(len(masks), pa.int64())]) for c in names[1:]]
        given = [pa.array([None] * len(names[0]) + masks, pa.binary()), pa.array([number] * len(columns[0]), pa.int64())]
        return pa.Table.from_arrays([*given, *columns], names=["mask", *NAMES])

    schema = "mask binary, " + ", ".join(f"{c} bigint" for c in NAMES)
    told = held.groupBy("block").cogroup(revealed.groupBy("block")).applyInArrow(run, schema)
    told = cut(told, release=True)
    names = told.where("mask IS NULL").withColumn("least", F.min("lo").over(Window.partitionBy("a", "b")))
    columns = ["block", "a", "b", "least", "mask"]
    masks = told.where("mask IS NOT NULL").withColumn("least", F.lit(None).cast("bigint"))
    return cut(names.where("least < hi").select(*columns).unionByName(masks.select(*columns)), release=True)


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    want: tuple[str, ...] = ("n_words", "n_removed", "removed", "kept"),
    block_bytes: int = BLOCK,
) -> DataFrame:
    """``id_col`` and what is wanted of every row.

    ``n_words`` and ``n_removed``; ``removed``: ranges of words, ends not included; ``kept``: the words that
    stay, joined by one space; ``kept_sha256``: the hash of that text.
    """
    kind = df.schema[id_col].dataType
    held = cut(blocks(df, id_col, text_col, block_bytes))
    told = verify(held, reveal(held, width), width)
    types = {
        "n_words": ("bigint", pa.int64()),
        "n_removed": ("bigint", pa.int64()),
        "removed": ("array<array<bigint>>", pa.list_(pa.list_(pa.int64()))),
        "kept": ("string", pa.string()),
        "kept_sha256": ("string", pa.string()),
    }

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _, *cells = (left.column(c)[0].as_py() for c in CELLS)
        block = Block(*cells, width)
        gone = np.zeros(len(block.a), bool)
        if len(right):
            masks = [m for m in right.column("mask").to_pylist() if m is not None]
            n = len(block.whole)
            drop = np.unpackbits(np.frombuffer(masks[0], np.uint8), count=n).astype(bool) if masks else np.zeros(n, bool)
            verified = right.select(["a", "b", "least"]).drop_null()
            a, b, order = by_name(verified)
            at = find(*windows(block.a, block.b, width), a, b)
            hit = (at >= 0) & block.whole
            hit[hit] = block.key[:n][hit] > verified.column("least").to_numpy()[order][at[hit]]
            first = np.flatnonzero(drop | hit)
            gone = covered(len(block.a), first, first + width)
        ends = np.searchsorted(block.doc, np.arange(len(block.ids) + 1))
        out: dict[str, list] = {c: [] for c in want}
        for number in range(len(block.ids)):
            for column, value in document_results(block, gone, ends[number], ends[number + 1], want).items():
                out[column].append(value)
        columns = [pa.array(block.ids, pa.int64()), *[pa.array(out[c], types[c][1]) for c in want]]
        return pa.Table.from_arrays(columns, names=["id", *want])

    schema = ", ".join(["id bigint", *[f"{c} {types[c][0]}" for c in want]])
    found = held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)
    return found.select(F.col("id").cast(kind).alias(id_col), *want)


def document_results(block: Block, gone: np.ndarray, first: int, end: int, want: tuple[str, ...]) -> dict:
    """What is wanted of the document whose words are ``[first, end)``."""
    own = gone[first:end]
    out = {"n_words": end - first, "n_removed": int(own.sum())}
    if "removed" in want:
        out["removed"] = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8))).reshape(-1, 2).tolist()
    if "kept" in want or "kept_sha256" in want:
        if own.any():
            stay = first + np.flatnonzero(~own)
            words = [block.data[i:j] for i, j in zip(block.start[stay].tolist(), block.end[stay].tolist(), strict=True)]
        else:
            words = block.data[block.start[first] : block.end[end - 1]].split() if end > first else []
        kept = b" ".join(words)
        out |= {"kept": kept.decode() if "kept" in want else None, "kept_sha256": hashlib.sha256(kept).hexdigest()}
    return {c: out[c] for c in want}
