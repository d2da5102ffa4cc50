"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the graph of nearest neighbours is cut into parts of equal size that keep
neighbours together, and a small network learns a vector's part (its own and its neighbours'). Every
row goes to the part the network finds likeliest; a query is compared exactly with all rows of its
likeliest parts. How many parts a query probes is chosen on a fifth of the sample that the parts and the
network have not seen, so that ``target`` of its true neighbours are met. Parts are dealt in blocks of
bounded size, queries too, so no part fills a task.

Vectors that are null, zero or hold a null or non-finite component neither ask nor answer. Vectors are
compared with those of their own length: the most frequent length and each of over ``sample_rows`` rows
have their own parts, any other length is one part. Ties go to the smaller id. A row is no neighbour of
rows of its own id; an id that repeats asks once, with its least vector. A product beyond the range of doubles is left out. With
fewer candidates than ``k`` all are returned. An empty table gives no rows. Fitting reads about
``sample_rows`` vectors of a length, and there are 64 parts at most.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import cut
from gridpulse.llm.vectors import USABLE, lengths, matrix, sample, stacked

BLOCK = 4096


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each row by inner product."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i : i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 6, slack: float = 1.05) -> np.ndarray:
    """Parts of nearly equal size with few neighbours apart: bisection along main axes, then moves by gain."""
    part = np.zeros(len(x), np.int64)
    for level in range(parts.bit_length() - 1):
        halves = part.copy()
        for p in range(1 << level):
            own = np.flatnonzero(part == p)
            centred = x[own] - x[own].mean(0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = own[np.argsort(centred @ axis, kind="stable")]
            halves[order] = 2 * p + (np.arange(len(order)) >= len(order) // 2)
        part = halves
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])
    starts = np.concatenate([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()])
    most, least = int(slack * len(x) / parts) + 1, int(len(x) / parts / slack)
    size = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        near = np.bincount(starts * parts + part[ends], minlength=len(x) * parts).reshape(len(x), parts)
        best = near.argmax(1)
        gain = near[np.arange(len(x)), best] - near[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < most and size[part[i]] > least:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: scores of the parts."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x / self.scale @ self.w1 + self.b1, 0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.w2 + self.b2


def train_router(x: np.ndarray, target: np.ndarray, width: int = 96, epochs: int = 25, seed: int = 1) -> Router:
    """Cross entropy against each row's distribution over parts, by Adam."""
    random = np.random.default_rng(seed)
    scale = float(np.sqrt((x * x).mean())) or 1.0
    router = Router(
        scale,
        random.normal(size=(x.shape[1], width)) * np.sqrt(2 / x.shape[1]),
        np.zeros(width),
        random.normal(size=(width, target.shape[1])) * np.sqrt(1 / width),
        np.zeros(target.shape[1]),
    )
    names = ("w1", "b1", "w2", "b2")
    first = {n: np.zeros_like(getattr(router, n)) for n in names}
    second = {n: np.zeros_like(getattr(router, n)) for n in names}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for i in range(0, len(x), 128):
            rows = order[i : i + 128]
            h = router.hidden(x[rows])
            z = h @ router.w2 + router.b2
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - target[rows]) / len(rows)
            dh = (d @ router.w2.T) * (h > 0)
            grads = {"w2": h.T @ d, "b2": d.sum(0), "w1": (x[rows] / scale).T @ dh, "b1": dh.sum(0)}
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(router, n, getattr(router, n) - 2e-3 * move)
    return router


def fit(x: np.ndarray, k: int, target: float, neighbours: int = 10) -> tuple[Router, int]:
    """A router and the number of parts to probe, chosen on a fifth of the rows that is kept from training."""
    order = np.random.default_rng(7).permutation(len(x))
    asked, x = x[order[: len(x) // 5]], x[order[len(x) // 5 :]]
    parts = 1 << max(0, min(6, (len(x) // 64).bit_length() - 1))
    if parts == 1:
        return train_router(x, np.ones((len(x), 1)), epochs=0), 1
    graph = neighbour_graph(x, min(neighbours, len(x) - 1))
    part = balanced_parts(x, graph, parts)
    soft = np.bincount(np.repeat(np.arange(len(x)), graph.shape[1]) * parts + part[graph].ravel(), minlength=len(x) * parts)
    soft = soft.reshape(len(x), parts) / graph.shape[1]
    router = train_router(x, 0.5 * soft + 0.5 * np.eye(parts)[part])
    # Every row is found in its likeliest part: count in which place of a query's list that is.
    found = router.scores(x).argmax(1)
    place = (-router.scores(asked)).argsort(1, kind="stable").argsort(1, kind="stable")
    near = np.argpartition(-(asked @ x.T), min(k, len(x)) - 1, axis=1)[:, : min(k, len(x))]
    ranks = place[np.arange(len(asked))[:, None], found[near]]
    share = np.array([(ranks < t).mean() for t in range(1, parts + 1)])
    return router, int(np.argmax(share >= min(target, share[-1]))) + 1


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """Exact best ``k`` rows of a block for each query: largest inner product, then smaller id."""
    out_q, out_v, out_s = [], [], []
    for i in range(0, len(queries), 256):
        s = queries[i : i + 256] @ rows.T
        s[query_ids[i : i + 256, None] == ids[None, :]] = -np.inf
        kth = -np.partition(-s, min(k, s.shape[1]) - 1, axis=1)[:, min(k, s.shape[1]) - 1]
        for j, q in enumerate(query_ids[i : i + 256]):
            # Sums again row by row, so that equal vectors have equal scores wherever they stand.
            at = np.flatnonzero((s[j] >= kth[j] - 1e-6 * abs(kth[j])) & np.isfinite(s[j]))
            exact = (rows[at] * queries[i + j]).sum(1)
            best = np.lexsort((ids[at], -exact))[:k]
            out_q += [q] * len(best)
            out_v.append(ids[at[best]])
            out_s.append(exact[best])
    if not out_q:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    return pd.DataFrame({"query_id": out_q, "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})


def route(rows: DataFrame, models: dict[int, tuple[Router, int]], own: bool = False) -> DataFrame:
    """(id, vec, dim, part): a row for each part to probe of its length, or for the likeliest if ``own``."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vec"))
            for dim in sizes.unique().to_pylist():
                some = batch.filter(pc.equal(sizes, dim))
                parts = np.zeros((some.num_rows, 1), np.int32)
                if dim in shared.value:
                    router, probes = shared.value[dim]
                    scores = router.scores(matrix(some.column("vec")))
                    parts = (-scores).argsort(1, kind="stable")[:, : 1 if own else probes].astype(np.int32)
                columns = [*some.columns, pa.array([dim] * len(parts), pa.int32()), pa.array(list(parts), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "vec", "dim", "parts"])

    routed = rows.select("id", "vec").mapInArrow(run, "id bigint, vec array<double>, dim int, parts array<int>")
    return routed.select("id", "vec", "dim", F.explode("parts").alias("part"))


def search(
    df: DataFrame,
    asks: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    target: float = 0.97,
    sample_rows: int = 6000,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``asks``."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec"), asks.alias("asks"))
    rows = cut(rows.where(USABLE))
    models: dict[int, tuple[Router, int]] = {}
    for dim in lengths(rows, sample_rows)[0]:
        own = rows.where(F.size("vec") == dim)
        models[dim] = fit(sample(own, sample_rows, own.count(), "partitions", "id", "vec"), k, target)
    if not models:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    placed = cut(route(rows, models, own=True))
    held_rows = placed.groupBy("dim", "part").agg(F.count("*").alias("n"))
    sizes = {(r["dim"], r["part"]): r["n"] for r in held_rows.where(F.col("dim").isin(*models)).collect()}
    for dim, (router, probes) in models.items():
        # A query must meet k rows besides its own even in the smallest parts.
        parts = len(router.b2)
        smallest = sorted(sizes.get((dim, p), 0) for p in range(parts))
        while probes < parts and sum(smallest[:probes]) <= k:
            probes += 1
        models[dim] = router, probes
    asked = cut(route(rows.where("asks").groupBy("id").agg(F.min("vec").alias("vec")), models))

    def blocks(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("dim", "part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    count = blocks(placed, "row_blocks").join(blocks(asked, "ask_blocks"), ["dim", "part"])

    def dealt(table: DataFrame, own: str, mine: str, other: str, theirs: str) -> DataFrame:
        """Each row in one block of its own kind, and there once for each block of the other kind."""
        table = table.join(count, ["dim", "part"]).withColumn(own, F.pmod(F.xxhash64("id", "vec"), F.col(mine)).cast("int"))
        return table.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))).drop(mine, theirs)

    def compare(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return nearest(stacked(queries["vec"]), queries["id"].to_numpy(), stacked(rows["vec"]), rows["id"].to_numpy(), k)

    key = ["dim", "part", "block", "query_block"]
    held = dealt(placed, "block", "row_blocks", "query_block", "ask_blocks").groupBy(*key)
    wanted = dealt(asked, "query_block", "ask_blocks", "block", "row_blocks").groupBy(*key)
    found = held.cogroup(wanted).applyInPandas(compare, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
