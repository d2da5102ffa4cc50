"""Walk-forward scores of ridge regression from one pass over the rows.

The bounds of all folds cut time into at most ``2k + 1`` segments. Each segment's moments (count, means,
and sums of products around the means) are gathered once; a fold's train part is the sum of the segments
up to its train end and its validation part the sum of those behind it. Fits and scores of any number of
penalties then need no rows: a fold's normal equations and its squared error are both in the moments.

Moments are merged around their own means, which loses no digits where values are far from zero. Every
task sends one row a segment, and segments are merged apart, so what is gathered grows with the number
of tasks and not with the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.timegrid import ntz
from gridpulse.spec import SeriesSpec

# Tasks get ``Moments`` by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "segment int, n bigint, means array<double>, products array<double>"


@dataclass(frozen=True)
class Moments:
    """Count, means, and products around the means of the features and, last, the label."""

    n: int
    means: np.ndarray
    products: np.ndarray

    @classmethod
    def none(cls, width: int) -> Moments:
        return cls(0, np.zeros(width), np.zeros((width, width)))

    @classmethod
    def of(cls, values: np.ndarray) -> Moments:
        means = values.mean(axis=0) if len(values) else np.zeros(values.shape[1])
        centred = values - means
        return cls(len(values), means, centred.T @ centred)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.means - self.means
        return Moments(
            n,
            self.means + apart * (other.n / n),
            self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n),
        )

    def spread(self) -> float:
        """Standard deviation of the label."""
        return float((self.products[-1, -1] / self.n) ** 0.5) if self.n else 0.0

    def fit(self, penalty: float) -> tuple[np.ndarray, float]:
        """Weights and intercept that minimise the mean squared error plus ``penalty`` times the squared weights.

        The intercept is not penalised. Without a penalty, dependent features share their weight.
        """
        own = self.products[:-1, :-1] + penalty * self.n * np.eye(len(self.means) - 1)
        weights = np.linalg.lstsq(own, self.products[:-1, -1], rcond=None)[0]
        return weights, float(self.means[-1] - weights @ self.means[:-1])

    def scores(self, weights: np.ndarray, intercept: float) -> dict[str, float | None]:
        """R² and RMSE of a linear model on these rows, to four places."""
        away = np.r_[-weights, 1.0]
        error = float(away @ self.products @ away) + self.n * float(away @ self.means - intercept) ** 2
        spread = float(self.products[-1, -1])
        return {
            "r2": round(1 - error / spread, 4) if spread else None,
            "rmse": round(max(error, 0.0) ** 0.5 / self.n**0.5, 4) if self.n else None,
        }


@dataclass(frozen=True)
class FoldMoments:
    """Moments of the train and validation part of each fold, in the order of ``folds``."""

    folds: list[dict[str, Any]]
    train: list[Moments]
    validation: list[Moments]

    def scores(self, penalty: float, by_spread: bool = False) -> list[dict[str, Any]]:
        """Each fold's bounds, R² and RMSE with a model fitted on its train part.

        ``by_spread`` divides the penalty by the deviation of the part's labels, as Spark's linear
        regression does, which fits scaled labels.
        """
        out = []
        for bounds, train, valid in zip(self.folds, self.train, self.validation, strict=True):
            own = penalty / (train.spread() or 1.0) if by_spread else penalty
            out.append({**bounds, **valid.scores(*train.fit(own))})
        return out


def segment_moments(
    frame: DataFrame, features: list[str], target: str, time_col: str, bounds: list[datetime]
) -> dict[int, Moments]:
    """Moments of the rows by the number of ``bounds`` (ascending) before their time.

    A row with a null or NaN among features and label is left out.
    """
    columns = [*features, target]
    segment = reduce(lambda total, bound: total + (F.col(time_col) > ntz(bound)).cast("int"), bounds, F.lit(0))
    rows = frame.select(segment.alias("segment"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    width = len(columns)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            values = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(width)])
            whole = ~np.isnan(values).any(axis=1)
            segments = batch.column(0).to_numpy()[whole]
            values = values[whole]
            for s in np.unique(segments).tolist():
                found[s] = found.get(s, Moments.none(width)) + Moments.of(values[segments == s])
        yield from table(found).to_batches()

    def table(found: dict[int, Moments]) -> pa.Table:
        return pa.table(
            {
                "segment": pa.array(list(found), pa.int32()),
                "n": pa.array([m.n for m in found.values()], pa.int64()),
                "means": pa.array([m.means.tolist() for m in found.values()], pa.list_(pa.float64())),
                "products": pa.array([m.products.ravel().tolist() for m in found.values()], pa.list_(pa.float64())),
            }
        )

    def merge(parts: pa.Table) -> pa.Table:
        every = [
            Moments(n, np.array(means), np.array(products).reshape(width, width))
            for n, means, products in zip(*(parts.column(c).to_pylist() for c in ("n", "means", "products")), strict=True)
        ]
        return table({parts.column("segment")[0].as_py(): reduce(Moments.__add__, every)})

    merged = rows.mapInArrow(gather, SCHEMA).groupBy("segment").applyInArrow(merge, SCHEMA)
    return {
        r["segment"]: Moments(r["n"], np.array(r["means"]), np.array(r["products"]).reshape(width, width))
        for r in merged.collect()
    }


def fold_moments(
    frame: DataFrame, features: list[str], spec: SeriesSpec, folds: list[dict[str, Any]]
) -> FoldMoments:
    """Moments of all folds from one pass over ``frame``."""
    bounds = sorted({f[side] for f in folds for side in ("train_end", "fold_end")})
    found = segment_moments(frame, features, spec.target_col, spec.time_col, bounds)
    empty = Moments.none(len(features) + 1)
    upto = [empty]
    for s in range(len(bounds)):
        upto.append(upto[-1] + found.get(s, empty))

    def between(first: int, last: int) -> Moments:
        return reduce(Moments.__add__, (found.get(s, empty) for s in range(first, last)), empty)

    place = {bound: i + 1 for i, bound in enumerate(bounds)}
    return FoldMoments(
        folds,
        [upto[place[f["train_end"]]] for f in folds],
        [between(place[f["train_end"]], place[f["fold_end"]]) for f in folds],
    )
