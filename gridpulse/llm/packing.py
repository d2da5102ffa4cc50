"""Best-fit packing of token sequences, improved by exchanges between underfull bins.

Texts become ids with a closing id; only longer ones are cut, into pieces of the capacity. Pieces are
dealt by a hash into groups of about ``group_rows``, and each group is packed by itself, so a group
costs at most a bin or two more than packing all pieces together. A group begins with best fit
decreasing; while it has more bins than its total length needs, local search moves one document, swaps
one for one, one for two or two for one between underfull bins. Each exchange raises the sum of squared
fills, so the search ends; bins that run empty are dropped.

Null text is an empty text and has one piece, the closing id. A full piece fills a sequence of its own.
Repeated rows are packed as often as they come. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.bpe import encode_texts
from gridpulse.llm.common import cut, pick
from gridpulse.llm.wordbpe import word_codec

VOCABULARY = "word_bpe_49k.json"


def pieces(
    df: DataFrame, capacity: int, closing: int, id_col: str, text_col: str, vocabulary: str | None = None
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every text; no shuffle."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    last, step = closing.to_bytes(4, "little"), 4 * capacity
    numbers = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}

    def run(batches):
        codec = word_codec(path)
        for batch in batches:
            owner, out = [], []
            coded = encode_texts(codec, (t.as_py() or "" for t in batch.column("text")))
            for i, ids in enumerate(coded):
                data = ids + last
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    owner.append(i)
                    out.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
            ids = batch.column("id").take(pa.array(owner, pa.int64()))
            columns = [pa.array([r[j] for r in out], t) for j, t in enumerate(numbers.values())]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", *numbers])

    return rows.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; each item goes to the bin with the least room that holds it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        at = bisect_left(rooms, size)
        if at == len(rooms):
            bins.append([item])
            b, room = len(bins) - 1, capacity
        else:
            room = rooms[at]
            b = by_room[room].pop()
            bins[b].append(item)
            if not by_room[room]:
                del by_room[room], rooms[at]
        room -= size
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(b)
    return bins


def _exchange(giver: list[int], taker: list[int], room: int, lengths: list[int]) -> tuple[list[int], list[int]] | None:
    """Items to give and to get back that fill the taker most: a move, 1 for 1, 1 for 2 or 2 for 1."""
    back = [(0, [])] + [(lengths[y], [y]) for y in taker]
    back += [(lengths[y] + lengths[z], [y, z]) for i, y in enumerate(taker) for z in taker[:i]]
    back.sort(key=lambda x: x[0])
    sizes = [size for size, _ in back]
    ones = [(lengths[x], [x]) for x in giver]
    twos = [(lengths[x] + lengths[y], [x, y]) for i, x in enumerate(giver) for y in giver[:i]]
    best, found = 0, None
    for given, items in ones + twos:
        # The smallest return that lets it fit gains most.
        at = bisect_left(sizes, given - room)
        while at < len(back) and len(items) == 2 and len(back[at][1]) == 2:
            at += 1
        if at < len(back) and given - sizes[at] > best:
            best, found = given - sizes[at], (items, back[at][1])
    return found


def least_bins(lengths: list[int], capacity: int) -> int:
    """Bins that any packing needs: by total length, and by items too long to share a bin with others.

    For each length k up to half a bin, items over ``capacity - k`` fill a bin for all that k or more is
    left in; items over half a bin have one each, and what is left there is all that the others of k or
    more can use without a new bin.
    """
    sizes = np.sort(np.asarray(lengths, np.int64))
    if not len(sizes):
        return 0
    total = np.r_[0, np.cumsum(sizes)]
    half = np.searchsorted(sizes, capacity // 2, "right")
    ks = np.unique(sizes[:half])
    ks = np.r_[ks[ks > 0], capacity // 2 + 1]
    whole = np.searchsorted(sizes, capacity - ks, "right")
    begin = np.minimum(np.searchsorted(sizes, ks), half)
    middle = np.maximum(whole - half, 0)
    room = middle * capacity - (total[np.maximum(whole, half)] - total[half])
    rest = np.maximum(0, total[half] - total[begin] - room)
    bound = len(sizes) - np.maximum(whole, half) + middle + -(-rest // capacity)
    return int(max(bound.max(), -(-int(total[-1]) // capacity)))


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, tries: int = 64) -> list[list[int]]:
    """Exchanges between underfull bins, from the emptier to the fuller, until none helps or the bound is met.

    Bins with the same lengths are alike: a pair of kinds that has no exchange is not tried again. The
    search also ends after ``tries`` attempts a bin.
    """
    needed = least_bins(lengths, capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    kind = [tuple(sorted(lengths[i] for i in b)) for b in bins]
    used, left, moved = len(bins), tries * len(bins), True
    hopeless: set[tuple] = set()
    while moved and used > needed and left > 0:
        moved = False
        under = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: fill[b])
        alike: dict[tuple, set[int]] = {}
        for b in reversed(under):
            alike.setdefault(kind[b], set()).add(b)
        kinds = list(alike)
        for giver in under:
            for other in kinds:
                if not bins[giver] or sum(other) < fill[giver] or left <= 0 or used <= needed:
                    break
                if (kind[giver], other) in hopeless:
                    continue
                taker = next((b for b in alike[other] if b != giver), None)
                if taker is None:
                    continue
                left -= 1
                found = _exchange(bins[giver], bins[taker], capacity - fill[taker], lengths)
                if found is None:
                    hopeless.add((kind[giver], other))
                    continue
                give, back = found
                gain = sum(lengths[i] for i in give) - sum(lengths[i] for i in back)
                for b, out, come in ((giver, give, back), (taker, back, give)):
                    alike[kind[b]].discard(b)
                    bins[b] = [i for i in bins[b] if i not in out] + come
                    kind[b] = tuple(sorted(lengths[i] for i in bins[b]))
                    fill[b] += gain if b == taker else -gain
                    if 0 < fill[b] < capacity:
                        alike.setdefault(kind[b], set()).add(b)
                used -= not bins[giver]
                moved = True
    return [b for b in bins if b]


def pack_group(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item."""
    bins = local_search(best_fit_decreasing(lengths, capacity), lengths, capacity)
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, items in enumerate(bins):
        at = 0
        for i in items:
            place[i], offset[i] = number, at
            at += lengths[i]
    return place, offset


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    closing: int = 1,
    group_rows: int = 8192,
    vocabulary: str | None = None,
) -> DataFrame:
    """Every piece of every row: id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut_up = pieces(df, capacity, closing, id_col, text_col, vocabulary)
    # Written with a number each, so that a task that runs again deals them alike.
    table = cut(cut_up.withColumn("number", F.monotonically_increasing_id()))
    groups = max(1, -(-table.count() // group_rows))
    dealt = table.withColumn("grp", F.pmod(F.xxhash64("number"), F.lit(groups)))
    kind = table.schema["id"].dataType.simpleString()

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number", ignore_index=True)
        place, offset = pack_group(rows["length"].tolist(), capacity)
        out = rows[["id", "piece", "start", "length", "ids_crc32"]].rename(columns={"id": id_col})
        return out.assign(sequence_id=(int(key[0]) << 32) + place, offset=offset)

    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("grp").applyInPandas(run, schema)
