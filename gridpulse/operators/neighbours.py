"""Mutual information from distances to nearest neighbours, for features and a target that vary freely.

For every row the distance to its ``k``-th neighbour in the plane of a feature and the target (the larger
of both differences) is found, and the rows that are nearer than that in the feature alone and in the
target alone are counted; the mean of their digammas against those of ``k`` and all rows is the estimate.
Features and target are divided by their standard deviations and laid on a grid of ``1 / GRID`` of one,
so that distances are whole numbers and ties are the same in every engine. Where ``k`` other rows share
a row's place, the number of those takes the place of ``k`` and only equal values count as near.

How it spreads: equal points are one point with a weight. The points of a feature are ordered by feature
and target and cut into slabs of equal numbers, so no value, however frequent, makes a large slab. A slab
finds the nearest of its own points; a point whose distance reaches over its slab is sent to the slabs
whose box it touches, which answer with what is nearer. Counts on a line are differences of running
totals, which are summed over ranges of values. Nothing is compared with everything, and only the slabs'
boxes (``MAX_SLABS`` a feature) are gathered.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.sources.tables import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID = 1 << 20
SLAB_ROWS = 4096
MAX_SLABS = 2048
CHUNK = 256
FAR = np.iinfo(np.int64).max


def digamma(n: Column) -> Column:
    """Digamma of whole numbers from 1, by its series at ``n + 6``."""
    x = n + 6
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * F.pow(x, F.lit(4))) - 1 / (252 * F.pow(x, F.lit(6)))
    return series - sum((1 / (n + i) for i in range(1, 6)), 1 / n)


def grid_points(frame: DataFrame, features: list[str], target: str) -> DataFrame:
    """(position, x, y, w): distinct points on the grid and how many rows they stand for; nulls left out."""
    columns = [*features, target]
    values = frame.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    scales = values.agg(F.array(*[F.stddev_pop(f"v{i}") for i in range(len(columns))])).scalar()
    y = f"v{len(features)}"

    def on_grid(value: str, place: Column) -> Column:
        scaled = F.col(value) / F.nullif(F.get(scales, place), F.lit(0.0))
        return F.coalesce(F.floor(scaled * GRID + 0.5), F.lit(0)).cast("bigint")

    long = values.select(F.posexplode(F.array(*[f"v{i}" for i in range(len(features))])).alias("position", "x"), F.col(y).alias("y"))
    whole = long.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    placed = whole.select("position", on_grid("x", F.col("position")).alias("x"), on_grid("y", F.lit(len(features))).alias("y"))
    return placed.groupBy("position", "x", "y").agg(F.count("*").alias("w"))


def in_order(points: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``points`` with ``part``: ranges of rows by ``keys`` and ``order``, and ``place``, ascending in a range."""
    ranged = points.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = cut_lineage(ranged.withColumn("place", F.monotonically_increasing_id()))
    return placed.withColumn("part", F.shiftright("place", 33))


def with_slabs(points: DataFrame, slab_rows: int, max_slabs: int) -> DataFrame:
    """Number the points of a feature by (x, y) as ``rank`` and cut them into slabs of equal numbers."""
    placed = in_order(points, ["position"], ["x", "y"])
    parts = placed.groupBy("position", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    of_feature = Window.partitionBy("position")
    total = F.sum("n").over(of_feature)
    offsets = parts.select(
        "position",
        "part",
        (F.sum("n").over(of_feature.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.greatest(F.lit(slab_rows), F.ceil(total / max_slabs)).alias("rows"),
    )
    ranked = placed.join(offsets, ["position", "part"]).withColumn("rank", F.col("place") + F.col("shift"))
    return ranked.select("position", F.expr("cast(rank div rows as int)").alias("slab"), "rank", "x", "y", "w")


def nearest(
    x: np.ndarray, y: np.ndarray, limit: np.ndarray, px: np.ndarray, py: np.ndarray, pw: np.ndarray, k: int, own: bool
) -> tuple[list[list[int]], list[list[int]]]:
    """Distances and weights of the ``k`` nearest points to each query, as far as they are below ``limit``.

    Queries and points are sorted by y; a chunk of queries looks at the points of a band around it and
    widens the band until no point outside can be nearer. ``own``: the queries are the points.
    """
    found_d: list[list[int]] = []
    found_w: list[list[int]] = []
    most = min(k, len(px) - own)
    span = int(py[-1] - py[0]) + 1
    for begin in range(0, len(x), CHUNK):
        rows = np.arange(begin, min(begin + CHUNK, len(x)))
        d_out, w_out = [None] * len(rows), [None] * len(rows)
        band = max(1, span * 4 * k // len(px))
        todo = rows
        while len(todo):
            low = np.searchsorted(py, y[todo].min() - band)
            high = np.searchsorted(py, y[todo].max() + band, "right")
            d = np.maximum(np.abs(px[low:high] - x[todo, None]), np.abs(py[low:high] - y[todo, None]))
            if own:
                inside = (todo >= low) & (todo < high)
                d[np.flatnonzero(inside), todo[inside] - low] = FAR
            take = min(most, high - low)
            if take:
                at = np.argpartition(d, take - 1, axis=1)[:, :take] if take < high - low else np.argsort(d, axis=1)[:, :take]
                near = np.take_along_axis(d, at, 1)
                order = np.argsort(near, axis=1, kind="stable")
                at, near = np.take_along_axis(at, order, 1), np.take_along_axis(near, order, 1)
            else:
                at = near = np.empty((len(todo), 0), np.int64)
            whole = low == 0 and high == len(py)
            reach = near[:, -1] if take == most and take else np.full(len(todo), FAR)
            done = whole | (np.minimum(reach, limit[todo]) <= band) if most else np.ones(len(todo), bool)
            for i in np.flatnonzero(done):
                keep = (near[i] < limit[todo[i]]) & (near[i] < FAR)
                d_out[todo[i] - begin] = near[i][keep].tolist()
                w_out[todo[i] - begin] = pw[low + at[i][keep]].tolist()
            todo = todo[~done]
            band *= 4
        found_d += d_out
        found_w += w_out
    return found_d, found_w


def radius(near: list[int], weights: list[int], own: int, k: int) -> int:
    """Distance within which ``k`` other rows lie, ``own`` of them at the point; FAR if there are fewer."""
    seen = own
    for d, w in zip([0, *near], [0, *weights], strict=True):
        seen += w
        if seen >= k:
            return d
    return FAR


FOUND = "position int, rank bigint, target int, x bigint, y bigint, w bigint, bound bigint, near array<bigint>, weights array<bigint>"


def radii(points: DataFrame, k: int) -> DataFrame:
    """(position, rank, x, y, w, eps) of every point; ``eps`` is null where a feature has too few rows."""
    boxes = points.groupBy("position", "slab").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).orderBy("position", "slab").collect()
    box_of: dict[int, np.ndarray] = {}
    for position in {r[0] for r in boxes}:
        box_of[position] = np.array([tuple(r)[1:] for r in boxes if r[0] == position], np.int64)

    def inside(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        position, slab = int(key[0]), int(key[1])
        rows = rows.sort_values(["y", "x"], ignore_index=True)
        x, y, w, rank = (rows[c].to_numpy() for c in ("x", "y", "w", "rank"))
        limit = np.where(w - 1 >= k, 0, FAR)
        near, weights = nearest(x, y, limit, x, y, w, k, own=True)
        bound = np.array([radius(d, v, int(n) - 1, k) for d, v, n in zip(near, weights, w, strict=True)], np.int64)
        out = [(position, *row) for row in zip(rank, [slab] * len(x), x, y, w, bound, near, weights, strict=True)]
        box = box_of[position]
        number, x0, x1, y0, y1 = box.T
        for i in range(len(box)):
            if number[i] == slab:
                continue
            # How far the slab's box is from a point; FAR - 1 keeps what has no bound yet.
            away = np.maximum(np.maximum(x0[i] - x, x - x1[i]), np.maximum(y0[i] - y, y - y1[i]))
            for j in np.flatnonzero(np.maximum(away, 0) < bound):
                out.append((position, rank[j], int(number[i]), x[j], y[j], w[j], bound[j], None, None))
        return pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

    found = cut_lineage(points.groupBy("position", "slab").applyInPandas(inside, FOUND))
    asked = found.where("near IS NULL")

    def beside(key: tuple, asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["position", "rank", "near", "weights"]
        if not len(asked) or not len(rows):
            return pd.DataFrame([], columns=columns)
        rows = rows.sort_values("y", ignore_index=True)
        asked = asked.sort_values("y", ignore_index=True)
        x, y, bound = (asked[c].to_numpy() for c in ("x", "y", "bound"))
        px, py, pw = (rows[c].to_numpy() for c in ("x", "y", "w"))
        near, weights = nearest(x, y, bound, px, py, pw, k, own=False)
        return pd.DataFrame({"position": asked["position"], "rank": asked["rank"], "near": near, "weights": weights})[columns]

    answers = (
        asked.groupBy("position", "target")
        .cogroup(points.withColumnRenamed("slab", "target").groupBy("position", "target"))
        .applyInPandas(beside, "position int, rank bigint, near array<bigint>, weights array<bigint>")
    )
    own = found.where("near IS NOT NULL").select("position", "rank", "x", "y", "w", "near", "weights")
    nobody = [F.lit(None).cast("bigint").alias(c) for c in ("x", "y", "w")]
    every = own.unionByName(answers.select("position", "rank", *nobody, "near", "weights"))
    merged = every.groupBy("position", "rank").agg(
        *[F.max(c).alias(c) for c in ("x", "y", "w")],
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("near", "weights")))).alias("around"),
    )

    def further(state: Column, point: Column) -> Column:
        # The distance stays once k rows have been seen.
        enough = state["seen"] >= k
        return F.struct(
            (state["seen"] + point["weights"]).alias("seen"),
            F.when(enough, state["eps"]).otherwise(point["near"]).alias("eps"),
        )

    start = F.struct((F.col("w") - 1).alias("seen"), F.lit(0).cast("bigint").alias("eps"))
    reached = F.aggregate("around", start, further)
    return merged.select("position", "rank", "x", "y", "w", F.when(reached["seen"] >= k, reached["eps"]).alias("eps"))


def running_totals(points: DataFrame, asked: DataFrame) -> DataFrame:
    """(position, dim, v, upto): rows of the feature whose value in ``dim`` is at most v, for each asked v."""
    data = points.select("position", "w", F.posexplode(F.array("x", "y")).alias("dim", "v"))
    data = data.groupBy("position", "dim", "v").agg(F.sum("w").alias("w"))
    events = data.select("position", "dim", "v", F.lit(False).alias("ask"), "w").unionByName(
        asked.select("position", "dim", "v").distinct().withColumns({"ask": F.lit(True), "w": F.lit(0).cast("bigint")})
    )
    placed = in_order(events, ["position", "dim"], ["v", "ask"])
    key = ["position", "dim"]
    parts = placed.groupBy(*key, "part").agg(F.sum("w").alias("n"))
    before = parts.select(*key, "part", (F.sum("n").over(Window.partitionBy(*key).orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("w").over(Window.partitionBy(*key, "part").orderBy("place"))
    totals = placed.join(before, [*key, "part"]).withColumn("upto", F.col("before") + inside)
    return totals.where("ask").select(*key, "v", "upto")


def neighbour_information(
    frame: DataFrame,
    features: list[str],
    target: str,
    k: int = 3,
    slab_rows: int = SLAB_ROWS,
    max_slabs: int = MAX_SLABS,
) -> DataFrame:
    """Rows (position, feature, mi, score): information in nats, not below 0, and scaled to [0, 1].

    A feature with at most ``k`` rows has none. Sums are rounded to ten places, so that equal features tie.
    """
    points = cut_lineage(with_slabs(grid_points(frame, features, target), slab_rows, max_slabs))
    reached = cut_lineage(radii(points, k).where("eps IS NOT NULL"))
    reach = F.greatest("eps", F.lit(1))
    ends = [(dim, v, sign) for dim, v in enumerate("xy") for sign in (1, -1)]
    bounds = F.array(
        *[
            F.struct(F.lit(dim).alias("dim"), (F.col(v) + reach - 1 if sign > 0 else F.col(v) - reach).alias("v"), F.lit(sign).alias("sign"))
            for dim, v, sign in ends
        ]
    )
    asked = reached.select("position", "rank", F.explode(bounds).alias("b")).select("position", "rank", "b.*")
    counted = asked.join(running_totals(points, asked), ["position", "dim", "v"])
    near = counted.groupBy("position", "rank").agg(
        *[F.sum(F.when(F.col("dim") == dim, F.col("sign") * F.col("upto"))).alias(f"n{dim}") for dim in (0, 1)]
    )
    kth = F.when(F.col("eps") == 0, F.col("w") - 1).otherwise(k)
    term = F.col("w") * (digamma(kth) - digamma(F.col("n0")) - digamma(F.col("n1")))
    means = reached.join(near, ["position", "rank"]).groupBy("position").agg(F.sum("w").alias("n"), F.sum(term).alias("total"))
    information = F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("total") / F.col("n"))
    # One row per feature from here on.
    everything = Window.partitionBy(F.lit(1))
    low, high = F.min("mi").over(everything), F.max("mi").over(everything)
    return means.select("position", F.round(information, 10).alias("mi")).select(
        "position",
        F.element_at(F.array(*[F.lit(f) for f in features]), F.col("position") + 1).alias("feature"),
        "mi",
        ((F.col("mi") - low) / F.nullif(high - low, F.lit(0.0))).alias("score"),
    )
