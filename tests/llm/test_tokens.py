import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridpulse.llm.bpe import round_trip
from gridpulse.llm.packing import best_fit_decreasing, local_search, pack
from gridpulse.llm.tokencount import LibraryCounter, count_long, token_counts
from gridpulse.llm.wordbpe import IncrementalDecoder, StreamEncoder, WordCodec, sufficient_lookahead, word_codec

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


TEXTS = st.text(st.sampled_from("abcdethe '\x1c éñß<|>!?12½\n中"), max_size=80)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_encoder_equals_the_library(text):
    assert ids_of(word_codec(PATH).encode(text)) == library_ids(text)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_stream_gives_the_same_ids_in_any_chunks(text, step):
    stream = StreamEncoder(word_codec(PATH))
    parts = [stream.feed(text[i : i + step]) for i in range(0, len(text), step)]
    assert ids_of(b"".join([*parts, stream.finish()])) == library_ids(text)


@pytest.mark.parametrize("word", ["the" * 4000, "a" * 9001, "inthaner" * 1500, "abcdefghij" * 900])
def test_window_equals_whole_word(word):
    assert word_codec(PATH).transduce(word.encode()) == library_ids(word)


def test_lookahead_is_enough_for_small_rule_lists():
    merges = [("a", "b"), ("b", "c"), ("c", "d"), ("ab", "cd"), ("a", "a"), ("aa", "aa")]
    need = sufficient_lookahead(merges, "</w>")
    codec = WordCodec(PATH)
    names = ["a", "b", "c", "d", *dict.fromkeys(x + y for x, y in merges)]
    codec.vocab = {n: i for i, n in enumerate(names)}
    codec.ranks = {codec.vocab[x] << 20 | codec.vocab[y]: r for r, (x, y) in enumerate(merges)}
    codec.results = [codec.vocab[x + y] for x, y in merges]
    random = np.random.default_rng(0)
    for _ in range(3000):
        letters = random.integers(0, 4, random.integers(1, 30)).tolist()
        whole = [names[i] for i in codec._merge(list(letters))]
        size = random.integers(1, len(letters) + 1)
        end = 0
        for k, token in enumerate(names[i] for i in codec._merge(letters[:size])):
            end += len(token)
            if end <= size - need:
                assert whole[k] == token


def test_decoder_keeps_bytes_of_a_cut_letter():
    pieces = [bytes([b]) for b in range(256)]
    text = "aé中😀"
    decoder = IncrementalDecoder(pieces)
    assert "".join(decoder.feed([b]) for b in text.encode()) + decoder.finish() == text
    assert IncrementalDecoder(pieces).feed([0xC3]) == ""


def test_round_trip_of_odd_texts(frames, odd_rows):
    df = frames.docs(odd_rows, extra=True)
    got = round_trip(df, want=("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")).collect()
    want = Counter((i, tuple(library_ids(t))) for i, t in odd_rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    for r in got:
        assert r["decoded"] == LIBRARY.decode(r["ids"], skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert r["n_tokens"] == len(r["ids"])


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (300, 40), (5000, 64)])
def test_counts_of_spliced_chunks(odd_rows, chunk, overlap):
    counter = LibraryCounter(PATH)
    for _, text in odd_rows:
        assert count_long(counter, text or "", chunk, overlap) == len(library_ids(text))


def test_token_counts_of_odd_texts(frames, odd_rows):
    got = token_counts(frames.docs(odd_rows, extra=True), chunk=1000, overlap=50).collect()
    want = Counter((i, len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 2048) for i, t in odd_rows)
    assert Counter(tuple(r) for r in got) == want


def test_empty_tables(frames):
    empty = frames.docs([])
    assert round_trip(empty).count() == token_counts(empty).count() == pack(empty).count() == 0


def test_packing_of_odd_texts(frames, odd_rows):
    rows = pack(frames.docs(odd_rows, extra=True), capacity=64, group_rows=40).toPandas()
    rows["doc_id"] = rows["doc_id"].fillna(-1)
    fill = rows.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 64
    ordered = rows.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()
    want = Counter()
    for i, text in odd_rows:
        want[-1 if i is None else i] += len(library_ids(text)) + 1
    assert rows.groupby("doc_id")["length"].sum().to_dict() == dict(want)
    assert (rows["start"] == 64 * rows["piece"]).all()


def test_local_search_empties_bins():
    lengths = [6, 4, 5, 5, 3, 3, 4]
    poor = [[0], [1, 2], [3, 4], [5, 6]]
    better = local_search(poor, lengths, 10)
    assert sorted(i for b in better for i in b) == list(range(7))
    assert len(better) == 3 and all(sum(lengths[i] for i in b) <= 10 for b in better)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_packing_never_overfills_or_loses(lengths):
    bins = local_search(best_fit_decreasing(lengths, 40), lengths, 40)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 40 for b in bins)
