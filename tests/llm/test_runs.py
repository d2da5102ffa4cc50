import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridpulse.llm.wordbpe import WordCodec, numbered_runs, split_words, word_codec

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


class Counting(dict):
    asked = 0

    def get(self, *args):
        self.asked += 1
        return super().get(*args)


def test_a_run_is_looked_up_once_a_group():
    codec = WordCodec(PATH)
    codec.words = Counting()
    texts = ["the cat, the dog\n" * 500, "the bird " * 2000]
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert codec.words.asked <= 6  # four runs and the empty ones at the ends


def test_runs_end_where_white_space_is():
    letters = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    spaces = [c for c in letters if c.isspace() or c in "᠎​⁠﻿"]
    texts = [f"a{c}b" for c in spaces] + [f"{c}a{c}{c}" for c in spaces] + [f"a{c}b" for c in letters[::97]]
    for some in ([t] for t in texts):
        runs, begins = numbered_runs(some)
        assert [r for r in runs.to_pylist() if r] == split_words(some[0]) and begins.tolist() == [0, len(runs)]
    runs, begins = numbered_runs(texts)
    every = runs.to_pylist()
    assert [[r for r in every[a:b] if r] for a, b in zip(begins, begins[1:])] == list(map(split_words, texts))


@pytest.mark.parametrize("texts", [
    [], [""], ["", " ", "\n\n"], ["ΣΑΣ ΑΣ. Σ", "İstanbul I'LL it'S"], ["́a ́́", "é e\ń"],
    ["a<b <|endoftext|> x<|startoftext|><|endoftext|>Y", "<|endoftext|", "<"], ["a\x1cb \x1f", "c d"], ["x" * 200 + " y", "x" * 200],
])
def test_groups_equal_the_library(texts):
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    for group in (1, 3, 1 << 22):
        assert [np.frombuffer(d, "<u4").tolist() for d in WordCodec(PATH).encode_all(texts, group)] == want


def test_a_small_memo_gives_the_same_ids():
    texts = [" ".join(f"w{i}x{i % 7}é" for i in range(k, k + 40)) for k in range(0, 400, 10)]
    small = WordCodec(PATH, memo_words=16)
    assert list(small.encode_all(texts, 200)) == list(word_codec(PATH).encode_all(texts))
    assert len(small.words) <= 16 + 200
