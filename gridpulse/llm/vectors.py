"""What the two vector operators share: usable vectors, bounded samples, clusters of a sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import hashed_share


#: Of (id, vec): the vector is not null, zero, or holds a null or non-finite component, and has an id.
USABLE = (
    "coalesce(id IS NOT NULL AND vec IS NOT NULL AND exists(vec, x -> x <> 0) "
    "AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')), false)"
)


def lengths(rows: DataFrame, many: int) -> tuple[list[int], bool]:
    """The most frequent length of vectors and all of over ``many`` rows, and whether there are others."""
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"))
    found = sizes.agg(
        F.max_by("dim", F.struct("n", "dim")).alias("top"),
        F.collect_set(F.when(F.col("n") > many, F.col("dim"))).alias("large"),
        F.count("*").alias("all"),
    ).first()
    dims = sorted({*found["large"], *([found["top"]] if found["all"] else [])})
    return dims, found["all"] > len(dims)


def sample(rows: DataFrame, bound: int, total: int, seed: str, *keys: str) -> np.ndarray:
    """About ``bound`` vectors, chosen by a hash of ``keys``; the first rows if none has a chosen hash."""
    chosen = rows.where(hashed_share(F.xxhash64(*keys), bound, total, seed)).orderBy(*keys)
    found = chosen.limit(2 * bound).select("vec").collect() or rows.orderBy(*keys).limit(64).select("vec").collect()
    return np.array([r["vec"] for r in found], np.float64)


def matrix(column) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix of doubles."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.empty((0, 1))


def stacked(column) -> np.ndarray:
    """The same of a pandas column."""
    return np.stack(column.to_numpy()).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_centres(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of ``k`` clusters of unit vectors."""
    random = np.random.default_rng(seed)
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres
