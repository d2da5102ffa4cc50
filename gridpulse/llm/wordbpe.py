"""Byte-pair encoding of whole words with a known merge list: bounded-lookahead transducer and decoder.

The vocabulary file names the rules: NFC, white space as the only separator, lower case letter by
letter, a pattern that cuts words, byte-level spelling, and an end mark on the last symbol of a word.
White space is a certain boundary, because nothing but white space matches across it; so the encoding
of a text is the concatenation of the encodings of its runs without white space.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: str.split() also splits at these four, which are no white space in Unicode.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def split_words(text: str) -> list[str]:
    """Runs without Unicode white space."""
    if SEPARATORS.search(text):
        return [w for w in SPACES.split(text) if w]
    return text.split()


def numbered_runs(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Runs without Unicode white space of all texts, numbered by their distinct ones, and where each text begins.

    Empty runs stand where white space begins or ends a text. Arrow splits where str.split() does.
    """
    if any(map(SEPARATORS.search, texts)):
        split = pa.array(map(split_words, texts), pa.list_(pa.string()))
    else:
        split = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
    return split.flatten().dictionary_encode(), split.offsets.to_numpy()


def sufficient_lookahead(merges: list[tuple[str, str]], mark: str) -> int:
    """Symbols that must follow a token's end before no further text can change it.

    Let two texts share a prefix. Where the rules run in order, the last place up to which both are
    cut alike moves left only if the token before it is the left part of a rule, by that part's
    length, at most once a rule. After a move over ``u`` the next rule's right part must begin with
    ``u``. The largest sum of left lengths over such chains of rules is therefore enough.
    """
    reach: dict[str, int] = {}
    for left, right in merges:
        whole = not right.endswith(mark)
        core = right if whole else right[: -len(mark)]
        before = max((reach.get(core[:k], 0) for k in range(1, len(core) + whole)), default=0)
        reach[left] = max(reach.get(left, 0), len(left) + before)
    return max(reach.values(), default=0)


class WordCodec:
    """Encoder and decoder of one vocabulary file. ``memo_words`` bounds the words remembered."""

    def __init__(self, path: str, memo_words: int = 400_000):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        known = [(a, b) for a, b in pairs if a in self.vocab and b in self.vocab]
        #: Two ids in one key give the rule's rank, the rank gives the id of the result.
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: rank for rank, (a, b) in enumerate(known)}
        self.results = [self.vocab[a + b] for a, b in known]
        order = np.argsort(keys := np.fromiter(self.ranks, np.int64, len(self.ranks)))
        self.sorted_keys, self.sorted_ranks = keys[order], order.astype(np.int64)
        self.result_ids = np.array(self.results, np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.lines = regex.compile(rf"(?:{split['pattern']['Regex']})|\n")
        letters = byte_letters()
        self.symbols = [self.vocab.get(c) for c in letters]
        self.final = {self.vocab.get(c): self.vocab.get(c + self.mark) for c in letters}
        self.lookahead = sufficient_lookahead(pairs, self.mark) if self._ordered(pairs) else None
        size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.pieces = [b""] * size
        for token, number in [*self.vocab.items(), *self.special.items()]:
            self.pieces[number] = token.encode()
        self.lengths = [len(p.decode().removesuffix(self.mark)) for p in self.pieces]
        self.memo_words = memo_words
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _ordered(self, pairs: list[tuple[str, str]]) -> bool:
        """True if each rule joins only letters and results of earlier rules: the bound's condition."""
        made: set[str] = set()
        for left, right in pairs:
            if any(len(x.removesuffix(self.mark)) > 1 and x not in made for x in (left, right)):
                return False
            made.add(left + right)
        return True

    def _merge(self, ids: list[int]) -> list[int]:
        """Apply the rule of the lowest rank, leftmost first, until none fits; changes ``ids``."""
        get, none = self.ranks.get, len(self.results)
        ranks = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            made = ids[i] = self.results[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | made, none)
            if i < len(ranks):
                ranks[i] = get(made << 20 | ids[i + 1], none)
        return ids

    def transduce(self, word: Iterable[int]) -> list[int]:
        """Token ids of one word, read byte by byte with a window of constant size.

        A token is emitted once ``lookahead`` further symbols are known; the rest of the window is
        encoded again with what follows, which gives the same tokens as encoding the whole word.
        """
        out: list[int] = []
        window: list[int] = []
        limit = 4 * (self.lookahead + 1) if self.lookahead is not None else float("inf")
        for symbol in map(self.symbols.__getitem__, word):
            if len(window) >= limit:
                stable, end = len(window) - self.lookahead, 0
                for token in self._merge(list(window)):
                    if end + self.lengths[token] > stable:
                        break
                    end += self.lengths[token]
                    out.append(token)
                del window[:end]
            window.append(symbol)
        if window:
            window[-1] = self.final[window[-1]]
            out += self._merge(window)
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.sorted_keys, key), len(self.sorted_keys) - 1)
        return np.where(self.sorted_keys[at] == key, self.sorted_ranks[at], len(self.results))

    def _merge_batch(self, words: list[bytes]) -> list[bytes]:
        """``transduce`` for words that fit into one window, all at once.

        Words are held by their number of symbols, from many to few; a step applies each word's next
        rule, which makes it one symbol shorter, until none fits.
        """
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        symbols = np.array([-1 if s is None else s for s in self.symbols], np.int64)
        final = np.array([-1 if s is None else self.final[s] for s in self.symbols], np.int64)
        none = len(self.results)
        numbers, ids = np.empty(0, np.int64), np.empty((0, 0), np.int64)
        ranks = np.empty((0, 0), np.int64)
        for n in range(max(by_length, default=0), 0, -1):
            if own := by_length.get(n):
                raw = np.frombuffer(b"".join([words[i] for i in own]), np.uint8).reshape(-1, n)
                fresh = symbols[raw]
                fresh[:, -1] = final[raw[:, -1]]
                new_ranks = self._pair_ranks(fresh[:, :-1], fresh[:, 1:])
                if len(numbers):
                    numbers = np.concatenate([numbers, own])
                    ids, ranks = np.concatenate([ids, fresh]), np.concatenate([ranks, new_ranks])
                else:
                    numbers, ids, ranks = np.array(own), fresh, new_ranks
            if not len(numbers):
                continue
            best = ranks.min(1) if n > 1 else np.full(len(numbers), none)
            done = best == none
            data = ids[done].astype("<u4").tobytes()
            for k, i in enumerate(numbers[done].tolist()):
                out[i] = data[4 * n * k : 4 * n * (k + 1)]
            going = ~done
            numbers, ids, ranks, best = numbers[going], ids[going], ranks[going], best[going]
            if not len(numbers):
                continue
            at, row = ranks.argmin(1), np.arange(len(numbers))
            place = np.arange(n - 1)
            ids = np.take_along_axis(ids, place + (place > at[:, None]), 1)
            ids[row, at] = self.result_ids[best]
            if n > 2:
                ranks = np.take_along_axis(ranks, place[:-1] + (place[:-1] >= at[:, None]), 1)
                k = np.flatnonzero(at > 0)
                ranks[k, at[k] - 1] = self._pair_ranks(ids[k, at[k] - 1], ids[k, at[k]])
                k = np.flatnonzero(at < n - 2)
                ranks[k, at[k]] = self._pair_ranks(ids[k, at[k]], ids[k, at[k] + 1])
            else:
                ranks = np.empty((len(numbers), 0), np.int64)
        return out

    def _cut(self, runs: list[str]) -> list[str]:
        """The pattern's words of runs without special tokens, a line's end behind those of each run.

        A line's end is white space, which no word holds and nothing composes with. Letters are lowered
        one by one, so a capital sigma never becomes the one that ends words.
        """
        lines = unicodedata.normalize("NFC", "".join([f"{run}\n" for run in runs]))
        return self.lines.findall(lines.replace("\u03a3", "\u03c3").lower())

    def _sections(self, run: str) -> list[str | int]:
        """Words and ids of special tokens, in order."""
        out, at = [], 0
        for m in self.specials.finditer(run):
            out += [*self._cut([run[at : m.start()]])[:-1], self.special[m[0]]]
            at = m.end()
        return out + self._cut([run[at:]])[:-1]

    def _learn(self, runs: Iterable[str]) -> None:
        plain, special = [], {}
        for run in runs:
            if "<" in run and self.specials.search(run):
                special[run] = self._sections(run)
            else:
                plain.append(run)
        words = self._cut(plain)
        new = set(words).difference(self.parts, "\n")
        new.update(p for parts in special.values() for p in parts if isinstance(p, str) and p not in self.parts)
        new = list(new)
        coded = [p.encode() for p in new]
        fits = [i for i, c in enumerate(coded) if len(c) <= 48]
        self.parts.update(zip([new[i] for i in fits], self._merge_batch([coded[i] for i in fits]), strict=True))
        for part, c in zip(new, coded, strict=True):
            if len(c) > 48:
                self.parts[part] = array("I", self.transduce(c)).tobytes()
        code = lambda p: self.parts[p] if isinstance(p, str) else array("I", [p]).tobytes()
        known, following = self.parts.__getitem__, iter(words).__next__
        self.words.update({run: b"".join(map(known, iter(following, "\n"))) for run in plain})
        self.words.update({run: b"".join(map(code, parts)) for run, parts in special.items()})

    def _ids_of(self, runs: list[str]) -> list[bytes]:
        """Ids of distinct runs; what is new among them is learned."""
        found = list(map(self.words.get, runs))
        if None in found:
            self._learn([run for run, ids in zip(runs, found, strict=True) if ids is None])
            found = [self.words[run] if ids is None else ids for run, ids in zip(runs, found, strict=True)]
            for memo in (self.words, self.parts):
                if len(memo) > self.memo_words:
                    # The older half goes; what is frequent soon comes back.
                    for key in list(itertools.islice(memo, len(memo) // 2)):
                        del memo[key]
        return found

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text: those of the group's distinct runs, gathered by the numbers of all its runs."""
        runs, begins = numbered_runs(texts)
        numbers = runs.indices.to_numpy()
        found = self._ids_of(runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        ids = np.frombuffer(b"".join(found), "<u4")
        counts = sizes[numbers]
        ends = np.r_[0, np.cumsum(counts)]
        places = np.repeat((np.cumsum(sizes) - sizes)[numbers] - ends[:-1], counts)
        places += np.arange(len(places))
        ids = ids[places]
        for begin, end in itertools.pairwise(ends[begins].tolist()):
            yield ids[begin:end].tobytes()

    def encode_all(self, texts: Iterable[str], group: int = 1 << 22) -> Iterator[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers; ``group`` letters at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= group:
                yield from self._encode_group(held)
                held, size = [], 0
        if held:
            yield from self._encode_group(held)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]), b"")

    def decoder(self) -> IncrementalDecoder:
        return IncrementalDecoder(self.pieces, b" ")


class StreamEncoder:
    """Encode a text that arrives in chunks; only the run cut by a chunk's end is carried over."""

    def __init__(self, codec: WordCodec):
        self.codec, self.rest = codec, []

    def feed(self, chunk: str) -> bytes:
        cut = max((m.end() for m in SPACES.finditer(chunk)), default=0)
        if not cut:
            self.rest.append(chunk)
            return b""
        ready, self.rest = "".join([*self.rest, chunk[:cut]]), [chunk[cut:]]
        return self.codec.encode(ready)

    def finish(self) -> bytes:
        ready, self.rest = "".join(self.rest), []
        return self.codec.encode(ready)


class IncrementalDecoder:
    """Ids to text, a chunk at a time: pieces become bytes, bytes that end inside a letter are kept."""

    def __init__(self, pieces: list[bytes], joiner: bytes = b""):
        self.pieces, self.joiner, self.begun = pieces, joiner, False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        if not ids:
            return ""
        data = self.joiner.join(map(self.pieces.__getitem__, ids))
        data = self.joiner + data if self.begun else data
        self.begun = True
        return self.state.decode(data)

    def finish(self) -> str:
        return self.state.decode(b"", True)


@functools.lru_cache(maxsize=4)
def word_codec(path: str) -> WordCodec:
    """One codec a process and file."""
    return WordCodec(path)
