import random
import time
import zlib

import public_tokenizers
import pytest

from gridpulse.llm import packing


def fewest(lengths, capacity):
    best, lengths = len(lengths), sorted(lengths, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_against_the_fewest_bins():
    rng = random.Random(1)
    total = excess = 0
    for _ in range(300):
        lengths = [rng.randrange(1, 31) for _ in range(rng.randrange(10))]
        want = fewest(lengths, 30)
        assert packing.least_bins(lengths, 30) <= want
        bins = packing.local_search(packing.best_fit_decreasing(lengths, 30), lengths, 30)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 30 for b in bins)
        total, excess = total + want, excess + len(bins) - want
    assert excess <= total // 100


def test_search_mends_a_bad_packing():
    lengths = [6, 4, 6, 4, 5, 5, 3, 7]
    bins = packing.local_search([[i] for i in range(8)], lengths, 10)
    assert len(bins) == 4


LONG = random.Random(2)
GROUPS = {
    "equal": [3000] * 8192,
    "equal and short": [464] * 8192,
    "over half": [LONG.randrange(2049, 4097) for _ in range(8192)],
    "over a third": [LONG.randrange(1400, 2049) for _ in range(8192)],
    "any": [LONG.randrange(1, 4097) for _ in range(8192)],
}


@pytest.mark.parametrize("name", GROUPS)
def test_a_full_group_is_packed_in_seconds(name):
    start = time.process_time()
    place, _ = packing.pack_group(GROUPS[name], 4096)
    assert time.process_time() - start < 30
    if name in ("equal", "over half", "any"):
        assert len(set(place.tolist())) == packing.least_bins(GROUPS[name], 4096)


def test_checksums_and_number_of_sequences(spark):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    rows = [(i, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(2500)))) for i in range(60)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, total = {}, 0
    for i, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[i, k] = (at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))
    got = packing.pack(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert sum(r["length"] for r in got) == total
    assert len({r["sequence_id"] for r in got}) <= packing.least_bins([r["length"] for r in got], 4096) + 1
