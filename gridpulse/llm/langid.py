"""Language ID by unigrams over a fixed public vocabulary, marginalised over segmentations.

Each language has a probability for every piece of the vocabulary. A word's likelihood is the sum over
all ways to cut its UTF-8 bytes into pieces of any length, by a forward algorithm; a text's is the product
over its words. A letter that is no whole piece is made of byte pieces, which every language has. Piece
probabilities come from expectation maximisation on the word counts of labelled texts: Spark counts the
words, tasks take the expected piece counts by forward and backward sums, Spark adds them up.

Training reads about ``docs_per_lang`` labelled texts of each language (chosen by a hash, the same on
every run); scoring reads every whole text, keeps a bounded memo of runs, and does not shuffle. Letters
are lower-cased; a run of over 64 letters is scored in parts of 64.

Null or empty text, or one without a letter (numerals like ½ or Ⅷ are none), is ``und`` with score 0; so is every text if nothing was
learned. Equal likelihoods go to the first language in order of name. Repeated rows score alike.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm.common import cut, hashed_share, pick
from gridpulse.llm.wordbpe import byte_letters

VOCABULARY = "word_bpe_49k.json"
LETTERS = regex.compile(r"\p{L}+")
END = "\x01"
RESCALED = 8
LONGEST_WORD = 64
UNKNOWN = 1e-6


def read_pieces(path: str) -> list[str]:
    """The vocabulary's pieces of letters or of parts of letters, a character a byte; one that ends a word carries ``END``."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    mark, to_byte = model["end_of_word_suffix"], {c: b for b, c in enumerate(byte_letters())}
    found = {END}
    for token in model["vocab"]:
        core = token.removesuffix(mark)
        piece = bytes(map(to_byte.__getitem__, core))
        try:
            fits = LETTERS.fullmatch(piece.decode()) is not None
        except UnicodeDecodeError:
            fits = True
        if fits:
            found.add(as_bytes(piece) if core == token else as_bytes(piece) + END)
    return sorted(found)


def as_bytes(text: str | bytes) -> str:
    """A character for each byte of the UTF-8 text."""
    return (text.encode() if isinstance(text, str) else text).decode("latin-1")


def words_of(run: str) -> list[str]:
    """Lower-case letter runs with their end mark, a character a byte."""
    if run.isalpha() and len(run) <= LONGEST_WORD:
        return [as_bytes(run.lower()) + END]
    out = []
    for word in LETTERS.findall(run.lower()):
        parts = [as_bytes(word[i : i + LONGEST_WORD]) for i in range(0, len(word), LONGEST_WORD)]
        out += [*parts[:-1], parts[-1] + END]
    return out


class PieceTable:
    """Numbers of pieces (from 1) by a rolling 64-bit hash, looked up for whole arrays at once."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)
    BITS = 18

    def __init__(self, pieces: list[str]):
        self.none, self.longest = len(pieces) + 1, max(map(len, pieces))
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.values = np.full(1 << self.BITS, self.none, np.int32)
        self.probes = 1
        for number, piece in enumerate(pieces, 1):
            key = 0
            for letter in piece:
                key = (key * int(self.FACTOR) + ord(letter) + 1) & 0xFFFFFFFFFFFFFFFF
            at, probe = int(self.slot(np.uint64(key))), 1
            while self.keys[at]:
                at, probe = (at + 1) & ((1 << self.BITS) - 1), probe + 1
            self.keys[at], self.values[at] = key, number
            self.probes = max(self.probes, probe)

    def slot(self, keys):
        with np.errstate(over="ignore"):
            return ((keys ^ (keys >> np.uint64(29))) * self.FACTOR >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray, default: int) -> np.ndarray:
        at = self.slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], default)
        for _ in range(self.probes - 1):
            at = (at + 1) & ((1 << self.BITS) - 1)
            out = np.where(self.keys[at] == keys, self.values[at], out)
        return out


class Lattice:
    """The pieces that fit at each place of some words of one length. Piece 0 is a letter that no piece has.

    ``fits[i]`` holds (k, rows, pieces) for the pieces of k letters from place i, and the rows (words) that have one.
    """

    def __init__(self, words: list[str], table: PieceTable):
        self.n = n = len(words[0])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.uint64) + np.uint64(1)
        self.words, self.longest = len(words), table.longest
        self.fits: list[list[tuple]] = [[] for _ in range(n)]
        key = np.zeros((len(words), n), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(1, min(table.longest, n) + 1):
                key = key[:, : n - k + 1] * table.FACTOR + letters[:, k - 1 :]
                found = table.find(key, table.none if k > 1 else 0)
                if k == 1:
                    for i in range(n):
                        self.fits[i].append((1, slice(None), found[:, i]))
                    continue
                places, rows = np.nonzero(found.T != table.none)
                ends = np.searchsorted(places, np.arange(n - k + 2))
                pieces = found[rows, places]
                for i in np.flatnonzero(ends[1:] > ends[:-1]):
                    own = slice(ends[i], ends[i + 1])
                    self.fits[i].append((k, rows[own], pieces[own]))

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over segmentations of every beginning, and the log of what they were divided by.

        ``p``: a row for each piece, a column for each language, the last row 0.
        """
        size = (self.n + 1, self.words, p.shape[1])
        a, scale = np.zeros(size), np.zeros(size)
        a[0] = 1
        log = np.zeros(size[1:])
        for i in range(self.n):
            for k, rows, pieces in self.fits[i]:
                a[i + k, rows] += a[i, rows] * p[pieces]
            scale[i + 1] = log
            if (i + 1) % RESCALED == 0:
                # Place i + 1 is complete; the sums begun after it are divided alike.
                begun, top = slice(i + 1, i + self.longest + 1), a[i + 1].copy()
                a[begun] /= top
                scale[i + 1] = log = log + np.log(top)
        return a, scale

    def likelihood(self, p: np.ndarray) -> np.ndarray:
        a, scale = self.forward(p)
        return np.log(a[-1]) + scale[-1]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, for one language."""
        a, scale = self.forward(p)
        a, logs = a[:, :, 0], scale[:, :, 0]
        total = np.log(a[-1]) + logs[-1]
        b = np.full((self.n + 1, self.words), -np.inf)
        b[self.n] = 0
        used, weights = [], []
        with np.errstate(divide="ignore"):
            log_p, log_a = np.log(p[:, 0]), np.log(a)
        for i in range(self.n - 1, -1, -1):
            reach = [log_p[pieces] + b[i + k, rows] for k, rows, pieces in self.fits[i]]
            for (_, rows, _), r in zip(self.fits[i], reach, strict=True):
                b[i, rows] = np.logaddexp(b[i, rows], r)
            before = log_a[i] + logs[i] - total
            for (_, rows, pieces), r in zip(self.fits[i], reach, strict=True):
                used.append(pieces)
                weights.append(counts[rows] * np.exp(before[rows] + r))
        return np.bincount(np.concatenate(used), np.concatenate(weights), len(p))


def by_length(words: list[str]):
    """Indexes of the words of each length, some thousands at a time."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for n, group in groups.items():
        step = max(64, 40_000 // n)
        for i in range(0, len(group), step):
            yield np.array(group[i : i + step])


def _grown(rows: np.ndarray, size: int) -> np.ndarray:
    """``rows`` with space for ``size`` at least."""
    if size <= len(rows):
        return rows
    out = np.zeros((max(size, 2 * len(rows)), rows.shape[1]))
    out[: len(rows)] = rows
    return out


class Scorer:
    """Log-likelihoods of texts under every language, with a bounded memo of runs."""

    def __init__(self, pieces: list[str], p: np.ndarray, memo_runs: int = 400_000):
        self.table = PieceTable(pieces)
        self.p, self.memo_runs = np.vstack([p, np.zeros((1, p.shape[1]))]), memo_runs
        self.clear()

    def clear(self) -> None:
        self.runs: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.found = np.zeros((1024, self.p.shape[1]))
        self.rows = np.zeros((1024, self.p.shape[1] + 1))

    def learn(self, runs: set[str]) -> None:
        if len(self.runs) + len(runs) > self.memo_runs and self.runs:
            self.clear()
        runs = list(runs)
        cuts = [words_of(run) for run in runs]
        words = list({w for cut in cuts for w in cut}.difference(self.words))
        at = len(self.words)
        self.found = _grown(self.found, at + len(words))
        for group in by_length(words):
            self.found[at + group] = Lattice([words[i] for i in group], self.table).likelihood(self.p)
        place = self.words
        place.update(zip(words, range(at, at + len(words)), strict=True))
        at = len(self.runs)
        self.rows = _grown(self.rows, at + len(runs))
        flat = np.array([place[w] for cut in cuts for w in cut], np.int64)
        sizes = np.array([len(cut) for cut in cuts], np.int64)
        owner = np.repeat(np.arange(len(runs)), sizes)
        fresh = np.zeros((len(runs), self.p.shape[1] + 1))
        for k in range(self.p.shape[1]):
            fresh[:, k] = np.bincount(owner, self.found[flat, k], len(runs))
        fresh[:, -1] = sizes
        self.rows[at : at + len(runs)] = fresh
        self.runs.update(zip(runs, range(at, at + len(runs)), strict=True))

    def score(self, texts: list[str], group: int = 1 << 20) -> np.ndarray:
        """A row for each text: log-likelihood of each language, number of words."""
        out, held, size, begin = np.zeros((len(texts), self.p.shape[1] + 1)), [], 0, 0
        for i, text in enumerate(texts):
            held.append(text.split())
            size += len(text)
            if size < group and i + 1 < len(texts):
                continue
            runs = set().union(*held)
            if len(self.runs) + len(runs) > self.memo_runs:
                self.clear()
            self.learn(runs.difference(self.runs))
            for k, own in enumerate(held):
                index = np.fromiter(map(self.runs.__getitem__, own), np.int64, len(own))
                out[begin + k] = self.rows[index].sum(0)
            begin, held, size = i + 1, [], 0
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of (lang, text)."""

    def count(batches):
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for run in text.split():
                    for word in words_of(run):
                        found[lang, word] = found.get((lang, word), 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["lang", "word", "n"])

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    return rows.mapInPandas(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def maximise(counts: DataFrame, langs: list[str], pieces: list[str], rounds: int) -> np.ndarray:
    """Piece probabilities (a column a language) after some rounds of expectation maximisation."""
    size, table = len(pieces) + 1, PieceTable(pieces)
    p = np.full((size, len(langs)), 1 / size)
    p[0] = UNKNOWN
    place = {lang: i for i, lang in enumerate(langs)}
    spark = counts.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(np.vstack([p, np.zeros((1, len(langs)))]))

        def expect(batches, shared=shared):
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                for lang, rows in batch.groupby("lang"):
                    column = np.ascontiguousarray(shared.value[:, [place[lang]]])
                    words, n = rows["word"].tolist(), rows["n"].to_numpy(float)
                    add = total.setdefault(lang, np.zeros(len(column)))
                    for group in by_length(words):
                        add += Lattice([words[i] for i in group], table).expected(column, n[group])
            for lang, sums in total.items():
                used = np.flatnonzero(sums[:-1] > 0)
                yield pd.DataFrame({"lang": lang, "piece": used, "n": sums[used]})

        found = counts.mapInPandas(expect, "lang string, piece int, n double")
        # At most one row for each piece and language: bounded by the vocabulary.
        expected = np.zeros((size, len(langs)))
        for row in found.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            expected[row["piece"], place[row["lang"]]] = row["n"]
        expected[0] = 0
        p = (expected + 0.05) / (expected.sum(0) + 0.05 * size)
        p[0] = UNKNOWN
        shared.unpersist()
    return p


def fit(docs: DataFrame, docs_per_lang: int = 800, rounds: int = 3, vocabulary: str | None = None):
    """(languages, pieces, probabilities) from rows of (id, lang, text)."""
    usable = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    pieces = read_pieces(vocabulary or public_tokenizers.path(VOCABULARY))
    if not langs:
        return [], pieces, np.zeros((len(pieces) + 1, 0))
    chosen: Column = F.lit(False)
    for lang in langs:
        chosen = chosen | ((F.col("lang") == lang) & hashed_share(F.col("id"), docs_per_lang, sizes[lang], "langid"))
    counts = cut(word_counts(usable.where(chosen)))
    return langs, pieces, maximise(counts, langs, pieces, rounds)


_SCORERS: dict[str, Scorer] = {}


def predictor(spark: SparkSession, model):
    """A function for tasks: texts to (languages, scores). A score is the language's posterior chance."""
    langs, pieces, p = model
    shared = spark.sparkContext.broadcast((pieces, p))
    name = f"{uuid.uuid4()}"

    def run(texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not langs or not texts:
            return ["und"] * len(texts), np.zeros(len(texts))
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(*shared.value)
        rows = _SCORERS[name].score(texts)
        logs, known = rows[:, :-1], rows[:, -1] > 0
        posterior = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
        found = [langs[b] if k else "und" for b, k in zip(logs.argmax(1), known, strict=True)]
        return found, np.where(known, posterior, 0.0)

    return run


def predict(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred and score of every row; all languages are equally likely before."""
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    find = predictor(df.sparkSession, model)

    def run(batches):
        for batch in batches:
            found, scores = find([t.as_py() or "" for t in batch.column("text")])
            columns = [batch.column("id"), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def keep_known(df: DataFrame, model, text_col: str = "text", least: float = 0.5, enough_words: int = 20) -> DataFrame:
    """The rows of ``df`` in a learned language, with all their columns; all rows if none was learned.

    A score under ``least`` rejects only a text of ``enough_words``: fewer may be words that languages share.
    """
    if not model[0]:
        return df
    find = predictor(df.sparkSession, model)

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(text_col)]
            found, scores = find(texts)
            short = np.array([len(t.split(None, enough_words)) < enough_words for t in texts], bool)
            yield batch.filter(pa.array((np.array(found, object) != "und") & (short | (scores >= least)), pa.bool_()))

    return df.mapInArrow(run, df.schema)
