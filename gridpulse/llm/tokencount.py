"""Token counts of whole texts by overlap resynchronisation.

A text longer than ``chunk`` is encoded in overlapping chunks with offsets. Two neighbours are spliced
where both have a token boundary, both cut the shared text alike up to the chunk's end of it, and white
space stands at the boundary: white space is never part of a token, so nothing before it can change
what follows. If the overlap holds no such place, the overlap is doubled, at last to the whole rest.

The tokenizers library encodes each distinct run without white space once (with offsets); a chunk's
tokens are those of its runs. Null text counts as empty: 0 bytes, 0 tokens, not over the limit.
"""

from __future__ import annotations

import functools
import itertools
import os
from bisect import bisect_right

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from gridpulse.llm.common import pick
from gridpulse.llm.wordbpe import SPACES, split_words

VOCABULARY = "word_bpe_49k.json"
#: Short texts whose new runs are counted in one call.
GROUP = 256
RUNS = regex.compile(r"\S+")


class LibraryCounter:
    """Counts and offsets from the tokenizers library, with bounded memos of runs and of their words."""

    def __init__(self, path: str, memo_words: int = 600_000):
        # One thread: a task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo_words = memo_words
        self.counts: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.ends: dict[str, tuple[int, ...]] = {}

    def counts_of(self, texts: list[str]) -> list[int]:
        """Tokens of each text; what is new in any of them goes to the library in one call."""
        runs = [split_words(text) for text in texts]
        found = list(map(self.counts.get, itertools.chain.from_iterable(runs)))
        if None in found:
            every = itertools.chain.from_iterable(runs)
            new = {run for run, count in zip(every, found, strict=True) if count is None}
            learned = self._learn(new)
            every = itertools.chain.from_iterable(runs)
            found = [learned[run] if count is None else count for run, count in zip(every, found, strict=True)]
            self.counts.update(learned)
            halve(self.counts, self.memo_words)
        sums = list(itertools.accumulate(found, initial=0))
        ends = list(itertools.accumulate(map(len, runs), initial=0))
        return [sums[end] - sums[begin] for begin, end in itertools.pairwise(ends)]

    def _learn(self, runs: set[str]) -> dict[str, int]:
        """Tokens of new runs. Letters and one ASCII mark behind them are counted apart.

        The vocabulary's pattern always cuts there, and a mark of ASCII joins no letter before it.
        """
        cut = {}
        for run in runs:
            word, mark = run[:-1], run[-1]
            apart = mark.isascii() and not mark.isalnum() and word.isalpha()
            word, mark = (word, mark) if apart else (run, "")
            cut[run] = (word.lower() if word.isascii() and word.isalpha() else word, mark)
        new = list({part for parts in cut.values() for part in parts if part}.difference(self.words))
        coded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.words.update(zip(new, map(len, coded), strict=True))
        self.words[""] = 0
        learned = {run: self.words[word] + self.words[mark] for run, (word, mark) in cut.items()}
        halve(self.words, self.memo_words)
        return learned

    def boundaries(self, text: str, start: int, end: int) -> list[int]:
        """Ends of the tokens of ``text[start:end]`` as offsets in ``text``, one entry a token."""
        runs = [(m.start(), m[0]) for m in RUNS.finditer(text, start, end)]
        new = list({run for _, run in runs}.difference(self.ends))
        if new:
            if len(self.ends) + len(new) > self.memo_words // 8:
                self.ends.clear()
                new = list({run for _, run in runs})
            found = self.tokenizer.encode_batch(new, add_special_tokens=False)
            self.ends.update(zip(new, (tuple(e for _, e in f.offsets) for f in found), strict=True))
        return [at + e for at, run in runs for e in self.ends[run]]


def halve(memo: dict, most: int) -> None:
    """Forget the older half of a memo that has grown beyond its bound."""
    if len(memo) > most:
        for key in list(itertools.islice(memo, len(memo) // 2)):
            del memo[key]


def splice_point(text: str, left: list[int], right: list[int], begin: int, end: int) -> int | None:
    """The last white space of the overlap ``[begin, end)`` if both chunks cut alike up to it, or None.

    ``left`` ends at ``end`` and ``right`` begins at ``begin``; both hold token ends in order. A chunk
    may begin inside a word, so the comparison begins behind the overlap's first white space.
    """
    spaces = [m.start() for m in SPACES.finditer(text, begin, end)]
    if not spaces:
        return None
    first, last = spaces[0], spaces[-1]
    a = left[bisect_right(left, first) : bisect_right(left, last)]
    b = right[bisect_right(right, first) : bisect_right(right, last)]
    return last if a == b else None


def count_long(counter: LibraryCounter, text: str, chunk: int, overlap: int) -> int:
    """Tokens of a text of any length, at most ``chunk`` plus the overlap at a time."""
    n, begin, total = len(text), 0, 0
    end = min(n, chunk)
    left = counter.boundaries(text, begin, end)
    while end < n:
        wide, stop = overlap, min(n, end + chunk)
        while True:
            start = max(begin, end - wide)
            if start == begin:
                # Nothing proven back to the chunk's beginning: one chunk, of twice the size, takes both.
                stop = min(n, begin + 2 * (end - begin) + chunk)
                left = counter.boundaries(text, begin, stop)
                break
            right = counter.boundaries(text, start, stop)
            at = splice_point(text, left, right, start, end)
            if at is not None:
                total += bisect_right(left, at)
                left = right[bisect_right(right, at) :]
                begin = at
                break
            wide *= 2
        end = stop
    return total + len(left)


@functools.lru_cache(maxsize=4)
def library_counter(path: str) -> LibraryCounter:
    return LibraryCounter(path)


def token_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    chunk: int = 32_768,
    overlap: int = 512,
    vocabulary: str | None = None,
) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit of every row; no shuffle."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        counter = library_counter(path)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            sizes = [len(text) if text.isascii() else len(text.encode()) for text in texts]
            counts = [0 if len(text) <= chunk else count_long(counter, text, chunk, overlap) for text in texts]
            short = [i for i, text in enumerate(texts) if len(text) <= chunk]
            for some in itertools.batched(short, GROUP):
                for i, count in zip(some, counter.counts_of([texts[i] for i in some]), strict=True):
                    counts[i] = count
            columns = [
                batch.column("id"),
                pa.array(sizes, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([c > limit for c in counts], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
