"""Quality scores: ridge regression on random Fourier features of document statistics, then calibration.

One pass over the texts takes about thirty statistics of each whole document (letters, punctuation,
repetition, lines). Labelled rows give the normal equations of a Gaussian kernel's random features:
each task sums its part, Spark adds the parts by row of the matrix, the driver solves one system of
fixed size. A held-back share of the labelled rows calibrates the scores by isotonic regression on a
histogram, so a score is the chance of label 1.

At most about ``max_labelled`` labelled rows are used for fitting, chosen by a hash. Null text is empty
text; an empty text has statistics of 0 and a score like any other. Without a labelled row every score
is 0.5. Rows without a label are scored only; a label given twice counts twice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import crc_mod, cut, hashed_share, pick

MARKS = ".,;:!?|*#$%&@/<>()[]{}=+-_~^\"'"
SHARES = [
    np.arange(65, 91),
    np.arange(97, 123),
    np.arange(48, 58),
    np.arange(128, 256),
    np.array([10]),
    np.array([9, 13, 32]),
    *[np.array([ord(c)]) for c in ".,!?|*#$%&@/<>"],
    np.array([ord(c) for c in MARKS]),
]
NAMES = 10 + len(SHARES)
STATS = [f"s{i}" for i in range(NAMES)]


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; ratios lie in [0, 1] or grow with a logarithm."""
    if not text:
        return [0.0] * NAMES
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    shares = [float(counts[s].sum()) / len(data) for s in SHARES]
    used = counts[counts > 0] / len(data)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    kinds = len(set(words))
    return [
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        len(text) / n if n > 1 else 0.0,
        kinds / n,
        float(np.log1p(kinds)),
        sum(map(str.__eq__, words, words[1:])) / n,
        float(np.log1p(len(lines))),
        len(set(lines)) / len(lines),
        float(np.log1p(len(data) / len(lines))),
        float(-(used * np.log(used)).sum()),
        *shares,
    ]


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the statistics of every row; no shuffle."""
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            values = np.array([statistics(t.as_py() or "") for t in batch.column("text")]).reshape(-1, NAMES)
            columns = [batch.column("id"), *(pa.array(values[:, i]) for i in range(NAMES))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *STATS])

    return rows.mapInArrow(run, ", ".join([f"id {kind}", *(f"{s} double" for s in STATS)]))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    chances: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features, and a constant."""
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights, 0, 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.chances), 0, 1)


def blank_model(features: int, width: float, seed: int) -> Model:
    random = np.random.default_rng(seed)
    return Model(
        np.zeros(NAMES),
        np.ones(NAMES),
        random.normal(size=(NAMES, features)) / width,
        random.uniform(0, 2 * np.pi, features),
        np.append(np.zeros(features), 0.5),
        np.array([0.0, 1.0]),
        np.array([0.5, 0.5]),
    )


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of f f' and f y over rows of statistics and label ``y``."""

    def partial(batches):
        total = None
        for batch in batches:
            f = model.features(batch[STATS].to_numpy(float))
            both = f.T @ np.hstack([f, batch[["y"]].to_numpy(float)])
            total = both if total is None else total + both
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": list(total)})

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "v": [np.sum(np.stack(parts["v"]), axis=0)]})

    parts = rows.mapInPandas(partial, "i int, v array<double>")
    size = len(model.weights)
    out = np.zeros((size, size + 1))
    # One row for each feature: a fixed size.
    for row in parts.groupBy("i").applyInPandas(add, "i int, v array<double>").collect():
        out[row["i"]] = row["v"]
    return out[:, :-1], out[:, -1]


def isotonic(levels: np.ndarray, counts: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Chances that do not fall with the level, by pooling neighbours that do."""
    blocks: list[list[float]] = []
    for c, o in zip(counts, ones, strict=True):
        blocks.append([o, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), o / c) for o, c, k in blocks])


def calibrate(rows: DataFrame, model: Model, bins: int = 500) -> None:
    """Fit the isotonic steps on (bin of raw score, rows, ones); at most ``bins`` + 1 rows reach the driver."""

    def binned(batches):
        for batch in batches:
            at = np.round(model.raw(batch[STATS].to_numpy(float)) * bins).astype(int)
            yield pd.DataFrame({"bin": at, "y": batch["y"].to_numpy(float)})

    found = rows.mapInPandas(binned, "bin int, y double").groupBy("bin")
    found = sorted(tuple(r) for r in found.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).collect())
    if found:
        level, n, ones = (np.array(x, float) for x in zip(*found, strict=True))
        model.steps, model.chances = level / bins, isotonic(level, n, ones)


def fit(
    stats: DataFrame,
    labels: DataFrame,
    features: int = 384,
    ridge: float = 1e-4,
    width: float = 4.0,
    max_labelled: int = 200_000,
    seed: int = 9,
) -> Model:
    """A model from statistics and rows of (id, y); every fifth labelled document calibrates."""
    model = blank_model(features, width, seed)
    labels = labels.where("y IS NOT NULL AND id IS NOT NULL")
    labels = labels.where(hashed_share(F.col("id"), max_labelled, labels.count(), "quality"))
    rows = cut(stats.join(labels, "id").withColumn("calibrates", F.pmod(F.xxhash64("id"), F.lit(5)) == 0))
    sums = [f(s).alias(f"{s}_{n}") for s in STATS for n, f in (("m", F.avg), ("d", F.stddev_pop))]
    row = rows.agg(F.count("*").alias("n"), *sums).first()
    if not row["n"]:
        return model
    model.mean = np.array([row[f"{s}_m"] for s in STATS])
    model.scale = np.maximum([row[f"{s}_d"] for s in STATS], 1e-6)
    left, right = normal_equations(rows.where("NOT calibrates"), model)
    seen = max(1.0, left[-1, -1])
    model.weights = np.linalg.solve(left + ridge * seen * np.eye(len(left)), right)
    calibrate(rows.where("calibrates"), model)
    return model


def score(stats: DataFrame, model: Model, id_col: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    kind = stats.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            chance = model.score(batch[STATS].to_numpy(float))
            yield pd.DataFrame({id_col: batch["id"], "score": chance, "predicted": (chance >= threshold).astype(int)})

    return stats.mapInPandas(run, f"`{id_col}` {kind}, score double, predicted int")


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int) -> tuple[DataFrame, Model]:
    """The statistics of every row, stored, and a model from the labelled ones outside the held-out fold."""
    stats = cut(document_statistics(docs, id_col, text_col))
    known = pick(labels, id=id_col, y=label_col).where(crc_mod("id", folds) != 0)
    return stats, fit(stats, known.select("id", F.col("y").cast("double").alias("y")))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    threshold: float = 0.3,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns; no shuffle of texts."""
    _, model = learn(docs, labels, id_col, text_col, label_col, folds)

    def run(batches):
        for batch in batches:
            values = np.array([statistics(t.as_py() or "") for t in batch.column(text_col)]).reshape(-1, NAMES)
            yield batch.filter(pa.array(model.score(values) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
) -> DataFrame:
    """``id_col``, held_out, score and predicted of every row; held-out ids never train."""
    stats, model = learn(docs, labels, id_col, text_col, label_col, folds)
    out = score(stats, model, id_col)
    return out.select(id_col, (crc_mod(id_col, folds) == 0).alias("held_out"), "score", "predicted")
