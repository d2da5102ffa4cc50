"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact checks.

A document's set holds the distinct runs of ``width`` words (with fewer words: the whole sequence).
Documents of the same word sequence are one class and stand for each other. Class representatives meet
in the buckets of banded signatures:

1. every member of a bucket is paired with the bucket's smallest id; signatures are compared in batches,
   a pair is dropped as soon as the posterior chance that its similarity reaches the threshold is below
   ``miss``; survivors are checked on the full sets;
2. buckets whose members are still in several components are compared in blocks of bounded size, pairs
   across components only, first by signatures, then on full sets inside the task, which joins components
   as it goes. So no pair of a bucket is lost, and no task emits more links than members.

Words are runs without ASCII white space, A-Z in lower case. Null text and text without words have an
empty set and link with nothing. Rows that repeat an id and text are one document that comes out twice.
A row without an id belongs to the class of its text, but does not represent it. Empty tables give empty results.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import cut, pick
from gridpulse.llm.components import connected_components

BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
BATCH = 16
BLOCK = 2048
_RANDOM = np.random.default_rng(4)
FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64)
MIX = [np.uint64(x) for x in _RANDOM.integers(1 << 40, 1 << 63, 16, np.uint64) | np.uint64(1)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``width`` words."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b"\n".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out += h[k : k + n] * MIX[k % 16]
            out ^= out >> np.uint64(29)
            out *= MIX[(k + 7) % 16]
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The top 32 bits of the least value of each of ``HASHES`` hash functions."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 512):
            values = shingles[i : i + 512] * FACTORS[:, None] + SHIFTS[:, None]
            np.minimum(least, values.min(1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def least_matches(threshold: float, miss: float) -> list[int]:
    """For each batch end n: the fewest equal hashes at which similarity >= threshold has a chance of ``miss``.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1).
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail = [comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(n + 2)]
        out.append(next(m for m in range(n + 1) if sum(tail[: m + 1]) >= miss))
    return out


def survivors(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """True for the rows whose signatures pass every batch; a row that fails is not compared further."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(1)
        keep = matches >= need
        alive, matches = alive[keep], matches[keep]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def document_features(df: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n_shingles, class, sig) of every row; class and sig are null for an empty set.

    ``text_key`` is Spark's ``xxhash64`` of the text.
    """
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keys, sizes, classes, signatures = [], [], [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                key = xxhash.xxh64_intdigest((text or "").encode(), 42)
                keys.append(None if text is None else key - ((key >> 63) << 64))
                words = words_of(text)
                shingles = shingle_set(words, width)
                sizes.append(len(shingles))
                classes.append(xxhash.xxh128_digest(b"\n".join(words)) if words else None)
                signatures.append(signature(shingles).tobytes() if words else None)
            numbers = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64())]
            columns = [batch.column("id"), *numbers, pa.array(classes, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "n_shingles", "class", "sig"])

    return rows.mapInArrow(run, f"id {kind}, text_key bigint, n_shingles bigint, class binary, sig binary")


def bucket_rows(reps: DataFrame) -> DataFrame:
    """(bucket, band, id, leader, members) for every bucket of two or more."""
    band = f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(sig, {4 * ROWS} * b + 1, {4 * ROWS})))"
    rows = reps.select("id", F.posexplode(F.expr(band)).alias("band", "bucket"))
    sizes = rows.groupBy("bucket").agg(F.min("id").alias("leader"), F.count("*").alias("members"))
    return rows.join(sizes.where("members > 1"), "bucket")


def star_links(pairs: DataFrame, reps: DataFrame, texts: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """The pairs (id, leader) that are similar."""
    least = least_matches(percent / 100, miss)

    def prune(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, HASHES) for c in ("sig", "leader_sig")
            )
            keep = pa.array(survivors(a, b, least))
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(keep), batch.column("leader").filter(keep)], names=["id", "leader"])

    def verify(batches):
        for batch in batches:
            keep, known = [], {}
            for leader, text, other in zip(*(batch.column(c).to_pylist() for c in ("leader", "text", "leader_text")), strict=True):
                if leader not in known:
                    known = {leader: shingle_set(words_of(other), width)}
                keep.append(similar(shingle_set(words_of(text), width), known[leader], percent))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(keep), batch.column("leader").filter(keep)], names=["id", "leader"])

    kind = reps.schema["id"].dataType.simpleString()
    schema = f"id {kind}, leader {kind}"
    leaders = reps.select(F.col("id").alias("leader"), F.col("sig").alias("leader_sig"))
    likely = pairs.join(reps.select("id", "sig"), "id").join(leaders, "leader").mapInArrow(prune, schema)
    leader_texts = texts.select(F.col("id").alias("leader"), F.col("text").alias("leader_text"))
    return likely.join(texts, "id").join(leader_texts, "leader").mapInArrow(verify, schema)


def _likely_pairs(rows: pd.DataFrame, least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows i, j of a block whose components differ and whose signatures pass, most equal ones first.

    In a block pair only pairs of the two halves count; a block alone has one half. A pair that shares
    several buckets counts in that of the first band only.
    """
    band = rows["band"].iloc[0] if len(rows) else 0
    sig = np.frombuffer(b"".join(rows["sig"]), "<u4").reshape(-1, HASHES)
    comp, half = rows["component_id"].to_numpy(), rows["half"].to_numpy()
    two = len(np.unique(half)) > 1
    out_i, out_j, score = [], [], []
    for i in range(len(rows) - 1):
        others = np.arange(i + 1, len(rows))
        others = others[(comp[others] != comp[i]) & ((half[others] != half[i]) | (not two))]
        if len(others):
            equal = (sig[others] == sig[i]).reshape(-1, BANDS, ROWS).all(2)
            others = others[equal.argmax(1) == band]
            others = others[survivors(np.broadcast_to(sig[i], (len(others), HASHES)), sig[others], least)]
            out_i.append(np.full(len(others), i))
            out_j.append(others)
            score.append((sig[i] == sig[others]).sum(1))
    if not out_i:
        return (np.empty(0, int),) * 3
    i, j, s = map(np.concatenate, (out_i, out_j, score))
    order = np.argsort(-s, kind="stable")
    return i[order], j[order], s[order]


def rest_links(
    buckets: DataFrame, components: DataFrame, reps: DataFrame, texts: DataFrame, width: int, percent: int, miss: float
) -> DataFrame:
    """Links (id, leader) between components that still share a bucket, enough to join all that are similar."""
    least = least_matches(percent / 100, miss)
    kind = reps.schema["id"].dataType.simpleString()
    known = buckets.where("members > 2").join(components, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    mixed = known.groupBy("bucket").agg(
        F.min("component_id").alias("low"),
        F.max("component_id").alias("high"),
    )
    rows = known.drop("leader").join(mixed.where("low <> high").select("bucket"), "bucket")
    rows = rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # A row goes to each pair of blocks that holds its own.
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "bucket",
        "band",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        (F.col("block") < F.col("other")).alias("half"),
        "id",
        "component_id",
    )
    task = ["bucket", "first", "second"]

    def involved(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j, _ = _likely_pairs(rows, least)
        return rows.iloc[np.unique(np.concatenate([i, j])).astype(int)].drop(columns="sig")

    def link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        root = {c: c for c in rows["component_id"]}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        ids, comp, texts = rows["id"].tolist(), rows["component_id"].tolist(), rows["text"].tolist()
        sets: dict[int, np.ndarray] = {}
        out = []
        for i, j in zip(*(x.tolist() for x in _likely_pairs(rows, least)[:2]), strict=True):
            a, b = find(comp[i]), find(comp[j])
            if a == b:
                continue
            for k in (i, j):
                if k not in sets:
                    sets[k] = shingle_set(words_of(texts[k]), width)
            if similar(sets[i], sets[j], percent):
                root[a] = b
                out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["id", "leader"])

    signatures = reps.select("id", "sig")
    schema = f"bucket bigint, band int, first int, second int, half boolean, id {kind}, component_id {kind}"
    likely = cut(rows.join(signatures, "id").groupBy(*task).applyInPandas(involved, schema))
    full = likely.join(signatures, "id").join(texts, "id")
    return full.groupBy(*task).applyInPandas(link, f"id {kind}, leader {kind}")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
) -> DataFrame:
    """``id_col``, n_shingles, component_id (smallest id of the group), kept and text_key, for every row."""
    features = cut(document_features(df, width, id_col, text_col))
    classes = cut(features.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("rep")))
    own = features.join(classes.select("class", F.col("rep").alias("id")), ["class", "id"], "left_semi")
    reps = own.select("id", "sig").dropDuplicates(["id"])
    buckets = cut(bucket_rows(reps))
    candidates = buckets.select("id").distinct()
    texts = pick(df, id=id_col, text=text_col).join(candidates, "id", "left_semi").dropDuplicates(["id"])
    texts = cut(texts)
    some = cut(reps.join(candidates, "id", "left_semi"))
    pairs = buckets.where("id <> leader").select("id", "leader").distinct()
    links = cut(star_links(pairs, some, texts, width, percent, miss))
    components = connected_components(links, "id", "leader")
    rest = cut(rest_links(buckets, components, some, texts, width, percent, miss))
    components = connected_components(links.union(rest), "id", "leader")
    groups = classes.join(components, classes["rep"] == components["id"], "left").select(
        F.col("class"), F.coalesce("component_id", "rep").alias("component_id")
    )
    found = features.select("id", "text_key", "n_shingles", "class").join(groups, "class", "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        "text_key",
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df``, one document of each group: that of the smallest id, once if it is repeated."""
    kept = near_duplicates(df, id_col, text_col, width, percent).where("kept")
    kept = kept.select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).distinct()
    rows = df.withColumn("__text", F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)))
    same = rows[id_col].eqNullSafe(kept["__id"]) & rows["__text"].eqNullSafe(kept["__key"])
    return rows.join(kept, same, "left_semi").dropDuplicates([id_col, "__text"]).drop("__text")
