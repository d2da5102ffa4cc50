import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gridpulse.llm import flat_graph, learned_partitions, minhash
from gridpulse.llm.common import ship
from gridpulse.llm.components import connected_components
from gridpulse.llm.sharding import interleave
from pyspark.sql import functions as F


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def shingles(text, width):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def roots(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed, groups=6, copies=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text))
    rows += [rows[0].upper(), rows[0].replace(" ", " \n "), "a b", "A  b", "a", None, "", " \t", "É b c d e", "é b c d e"]
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_equal_brute_force(frames, width):
    rows = corpus(width)
    sets = {i: shingles(t, width) for i, t in rows}
    want = roots(sets, lambda a, b: bool(sets[a] & sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = minhash.near_duplicates(frames.docs(rows, extra=True), width=width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets
    }


def test_blocks_of_a_large_bucket(frames, monkeypatch):
    # One bucket in pairs of blocks: a row meets every other one, in its block or across.
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(7):
            text[rng.randrange(120)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    sets = {i: shingles(t, 4) for i, t in rows}
    want = roots(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = minhash.near_duplicates(frames.docs(rows), width=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_pruning_bounds():
    least = minhash.least_matches(0.8, 1e-6)
    assert least == sorted(least) and len(least) == minhash.HASHES // minhash.BATCH
    same = np.arange(minhash.HASHES)[None, :]
    assert minhash.survivors(same, same, least).all()
    assert not minhash.survivors(same, same + 1000, least).any()


def test_one_of_each_and_odd_rows(frames, odd_rows):
    df = frames.docs([*odd_rows, (50, "no ID here"), (51, "no id  here"), (None, None)], extra=True)
    kept = minhash.one_of_each(df)
    assert kept.columns == df.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 50: 1, None: 1})
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(odd_rows) + 3


def test_empty_documents(frames):
    assert minhash.near_duplicates(frames.docs([])).count() == 0
    assert interleave(frames.docs([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    found = connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), "a", "b").collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert {r["id"]: r["component_id"] for r in found} == want and len(found) == len(want)


def vectors(n=400, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, 60, 3):
        x[i + 1] = x[i] + rng.normal(size=dim) * 0.05
        x[i + 2] = 3 * x[i]
    x[100:140] = x[100] + rng.normal(size=(40, dim)) * 0.1
    x[200:210] = x[200]
    return x.astype(np.float32)


BAD = [(5001, None), (5002, []), (5003, [0.0] * 16), (5004, [1.0] * 15 + [None]), (5005, [1.0] * 15 + [float("nan")]), (5006, [float("inf")] * 16), (5007, [1.0] * 3)]


@pytest.mark.parametrize("size", [1024, 32])
def test_flat_graph_equals_brute_force(frames, monkeypatch, size):
    monkeypatch.setattr(flat_graph, "SHARD", size)
    x = vectors()
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = roots(range(len(x)), lambda a, b: near[a, b])
    got = {r["vec_id"]: r for r in flat_graph.near_duplicates(frames.vectors(rows + BAD, extra=True)).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    true = near.sum(1) - 1
    assert (links <= true).all() and links.sum() >= 0.97 * true.sum()
    if size == 1024:
        assert (links == true).all()
        assert all(got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i) for i in want)
    for i, _ in BAD:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def skewed(spark, frames):
    """Vectors of one large group and of pairs, and what finds only the links of the group."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(560, 16))
    x[:400] = x[0] + rng.normal(size=(400, 16)) * 0.02
    x[401:560:2] = x[400:560:2] + rng.normal(size=(80, 16)) * 0.02
    x = x.astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    group = [(i, int(near[i].sum()) - 1, 0) for i in range(400)]
    return x, near, spark.createDataFrame(group, "id BIGINT, links BIGINT, root BIGINT")


def test_audit_is_not_hidden_by_a_large_group(spark, frames):
    x, near, group = skewed(spark, frames)
    reps = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x.astype(float))], "id BIGINT, vec ARRAY<DOUBLE>, n BIGINT")
    assert near[:400].sum() - 400 >= 0.99 * (near.sum() - 560)
    assert flat_graph.audit(reps, group, reps, 0.95) < 0.5


def test_planted_vectors_have_links_where_rows_have_none(spark, frames, monkeypatch):
    x = flat_graph.unit(np.random.default_rng(12).normal(size=(300, 24)))
    assert (x @ x.T - np.eye(300)).max() < 0.95
    rows = [(i, v.tolist(), 1, str(i)) for i, v in enumerate(x)]
    reps = spark.createDataFrame(rows, "id BIGINT, vec ARRAY<DOUBLE>, n BIGINT, class STRING")
    probes = flat_graph.planted(reps, 512, 300, 0.95)
    moved = np.array([r["vec"] for r in probes.orderBy(F.desc("id")).collect()])
    near = moved @ x.T >= 0.95
    assert len(moved) == 300 and near.any(1).all()
    nothing = spark.createDataFrame([], "id BIGINT, links BIGINT, root BIGINT")
    assert flat_graph.audit(reps, nothing, probes, 0.95) == 0.0
    assert flat_graph.audit(reps, nothing, reps, 0.95) == 1.0
    centres = flat_graph.spherical_centres(x, 2, seed=3)
    found = flat_graph.linked(reps.select("id", "vec", "n").union(probes), centres, 2, 0.95)
    assert flat_graph.audit(reps, found, probes, 0.95) == 1.0
    # Planted vectors neither count nor join: only they have links.
    assert all(r["id"] < 0 and r["id"] == r["root"] for r in found.collect())
    # A search that finds nothing does not pass: the exact way is taken.
    taken = []
    exact = flat_graph.exact_rows
    monkeypatch.setattr(flat_graph, "linked", lambda *_: nothing)
    monkeypatch.setattr(flat_graph, "exact_rows", lambda *a: taken.append(1) or exact(*a))
    got = flat_graph.near_duplicates(frames.vectors([(i, v.tolist()) for i, v in enumerate(x)])).collect()
    assert taken and len(got) == 300 and all(r["n_links"] == 0 and r["kept"] for r in got)


def test_vectors_of_several_lengths_and_contents(frames):
    rng = np.random.default_rng(3)
    long, short = rng.normal(size=(40, 8)), rng.normal(size=(6, 5))
    long[1], short[1] = long[0] * 2, short[0] * 2
    rows = [(i, v.tolist()) for i, v in enumerate(long)] + [(100 + i, v.tolist()) for i, v in enumerate(short)]
    # One id with two vectors and one without; each row has the links of its own vector.
    rows += [(500, (long[5] * 3).tolist()), (500, (short[3] * 3).tolist()), (500, None)]
    got = [tuple(r) for r in flat_graph.near_duplicates(frames.vectors(rows)).collect()]
    assert len(got) == len(rows)
    want = {i: (0, i, True) for i, _ in rows} | {0: (1, 0, True), 1: (1, 0, False), 100: (1, 100, True), 101: (1, 100, False)}
    want |= {5: (1, 5, True), 103: (1, 103, True)}
    assert {g[0]: g[1:] for g in got if g[0] != 500} == {i: w for i, w in want.items() if i != 500}
    assert sorted(g[1:] for g in got if g[0] == 500) == [(0, 500, True), (1, 5, False), (1, 103, False)]
    found = learned_partitions.search(frames.vectors(rows), F.col("vec_id").isin(7, 100), k=50).toPandas()
    assert set(found[found["query_id"] == 7]["vec_id"]) == {*range(40), 500} - {7}
    assert set(found[found["query_id"] == 100]["vec_id"]) == {101, 102, 103, 104, 105, 500}


@pytest.mark.parametrize("size", [1024, 64])
def test_links_that_the_search_misses_are_found_exactly(spark, frames, monkeypatch, size):
    x, near, group = skewed(spark, frames)
    monkeypatch.setattr(flat_graph, "SHARD", size)
    real = flat_graph.linked

    def only_group(*args):
        sums = real(*args).groupBy("id").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
        return sums.where("links > 100")

    monkeypatch.setattr(flat_graph, "linked", only_group)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r["vec_id"]: r for r in flat_graph.near_duplicates(frames.vectors([*rows, (900, rows[500][1])])).collect()}
    want, twin = roots(range(560), lambda a, b: near[a, b]), near[500]
    assert {i: got[i]["component_id"] for i in want} == want
    assert [got[i]["n_links"] for i in want] == [near[i].sum() - 1 + twin[i] for i in want]
    assert (got[900]["n_links"], got[900]["component_id"]) == (got[500]["n_links"], want[500])


def test_graph_has_reverse_links():
    x = flat_graph.unit(np.random.default_rng(8).normal(size=(12, 8)))
    own = np.arange(12)
    links = np.repeat(own[:, None], flat_graph.DEGREE, 1)
    links[:, 0] = 0
    found = flat_graph.with_reverse(links, x @ x.T)
    assert set(found[0]) == set(own) and all(set(found[i]) == {0, i} for i in own[1:])


def test_range_search_walks_from_medoid():
    rng = np.random.default_rng(2)
    x = flat_graph.unit(np.vstack([rng.normal(size=(150, 8)), np.ones((30, 8)) + rng.normal(size=(30, 8)) * 0.05]))
    links, s = flat_graph.build(x)
    assert links.shape == (180, flat_graph.DEGREE)
    found, true = flat_graph.range_search(s, links, 0.95), s >= 0.95
    assert not (found & ~true).any() and found.sum() >= 0.98 * true.sum()


def test_learned_partitions_recall_and_order(frames):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[1000:1400] = x[1000]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = learned_partitions.search(frames.vectors(rows + BAD), F.col("vec_id") % 20 == 0).toPandas()
    y, hits = x.astype(float), 0
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and q not in set(part["vec_id"])
        s = (y * y[q]).sum(1)
        assert np.allclose(part["score"], s[part["vec_id"]], rtol=0, atol=1e-12)
        s[q] = -np.inf
        order = np.lexsort((np.arange(len(s)), -s))[:20]
        hits += len(set(order) & set(part["vec_id"]))
        assert list(zip(-part["score"], part["vec_id"])) == sorted(zip(-part["score"], part["vec_id"]))
    assert got["query_id"].nunique() == 150 and hits >= 0.9 * 3000


def test_learned_partitions_beyond_the_sample(frames):
    # Clusters, four times as many rows as fitting reads: few parts are probed, and recall holds.
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(40, 16)) * 2)[rng.integers(40, size=6000)] + rng.normal(size=(6000, 16)) * 0.7
    x = x.astype(np.float32).astype(float)
    router, probes = learned_partitions.fit(x[:1500], 20, 0.97)
    assert probes <= len(router.b2) // 2
    df = frames.vectors([(i, v.tolist()) for i, v in enumerate(x)])
    got = learned_partitions.search(df, F.col("vec_id") % 20 == 0, sample_rows=1500).toPandas()
    hits = 0
    for q, part in got.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & set(part["vec_id"]))
    assert len(got) == 6000 and hits >= 0.95 * 6000


def test_learned_partitions_of_few_distinct_ids(frames):
    rng = np.random.default_rng(2)
    rows = [(i % 2, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 4)))]
    got = learned_partitions.search(frames.vectors(rows), F.col("vec_id") == 0, sample_rows=50)
    assert got.count() == 20 and {r["vec_id"] for r in got.collect()} == {1}
    same = frames.vectors([(7, [1.0, 2.0])] * 300 + [(8, [1.0, 1.0])])
    got = learned_partitions.search(same, F.lit(True), sample_rows=10).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(7, 8)] + [(8, 7)] * 20


def test_learned_partitions_of_few_rows(frames):
    few = frames.vectors([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0]), (0, [1.0, 0.0]), (40, None)], extra=True)
    got = learned_partitions.search(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 2, 2.0), (0, 2, 1, 0.0)]
    assert learned_partitions.search(frames.vectors([]), F.lit(True)).count() == 0
    assert learned_partitions.search(frames.vectors([(20, [1.0])]), F.lit(True)).count() == 0
    empty = flat_graph.near_duplicates(frames.vectors([]))
    assert empty.count() == 0 and flat_graph.near_duplicates(frames.vectors([(1, [2.0])])).count() == 1


def test_balanced_parts_keep_their_size():
    x = np.random.default_rng(1).normal(size=(900, 6))
    parts = learned_partitions.balanced_parts(x, learned_partitions.neighbour_graph(x, 8), 8)
    sizes = np.bincount(parts, minlength=8)
    assert sizes.max() <= 1.06 * 900 / 8 + 1 and sizes.min() >= 900 / 8 / 1.06 - 1


def test_shards_match_the_mixture(frames, odd_rows):
    rng = random.Random(0)
    rows = [(i, f"text {i % 50}", "en", rng.choice(["a", "a", "a", "b", None])) for i in range(2000)] + odd_rows
    got = interleave(frames.docs(rows, extra=True)).toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and sorted(sizes.index) == list(range(8))
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    mixture = got.fillna({"stratum_source": "?"}).groupby(["stratum_source", "shard"]).size().unstack()
    assert (mixture.max(axis=1) - mixture.min(axis=1)).max() <= 2
    want = Counter((len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter(zip(got["size"], got["text_crc32"])) == want
    again = interleave(frames.docs(rows[::-1])).toPandas()
    key = ["doc_id", "size", "shard", "slot"]
    assert got[key].sort_values(key).fillna(-1).values.tolist() == again[key].sort_values(key).fillna(-1).values.tolist()
