"""Merkle manifest of a table: a content-addressed graph of digests, and proofs by descending it.

A row is a leaf: the hash of its fields. Leaves of a group ascend by id; every two neighbours become a
node until one is left, the group's subroot, and subroots in the order of their groups become the root
likewise. Digests are lowercase hex sha256 and are hashed as text; a node without a neighbour is hashed
alone; a lone leaf is its own subroot.

**Store.** A record maps a digest to its descendants of up to ``SEGMENT`` levels, the nearest children
last. Equal subtrees have one record. Building groups ``2 ** SEGMENT`` neighbours a task row, so the
rounds grow with the logarithm of the largest group and no group is ever in one task.

**Descent.** Requests name leaves by (tree, rank). The digits of a rank, high ones first, lead from the
root down: each step looks up the records of the digests reached so far, keeps the children that some
request needs, and appends the children not taken to the path. A step reads each record once, however
many leaves below it are asked for. At the leaf the path's segments are reversed into a proof.

Cases: a null id comes first in its group; a null group is a group of its own and the first one; null
fields hash as ``-``; rows that agree in group, id and leaf are interchangeable neighbours; an empty
table gives an empty result. Columns of any other name in the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import cut, pick

SEGMENT = 8


def leaf_digest(fields: list[Column]) -> Column:
    """Hash of fields, each as UTF-8 byte count, colon and text, or ``-`` if null."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, fields)), 256)


def ranked(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0, by ``order`` inside ``tree``) and ``total``, the rows of the tree.

    Rows are range-partitioned with a number each, so that equal ones spread too, and written. A row's
    place in its file and the counts of (tree, file) give its rank: no window holds rows, only counts.
    """
    spread = df.withColumn("_salt", F.monotonically_increasing_id())
    keys = [tree, *order, "_salt"]
    placed = cut(
        spread.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_salt")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy(tree, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    of_tree = Window.partitionBy(tree)
    offsets = parts.select(
        tree,
        "_part",
        (F.sum("_n").over(of_tree.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(of_tree).alias("total"),
    )
    found = placed.join(offsets, [tree, "_part"])
    return found.select(*df.columns, (F.col("_place") + F.col("_shift")).alias("rank"), "total")


def depth_of(total: Column) -> Column:
    """Levels above the leaves of a tree with so many leaves."""
    return F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0)


def _level_above(nodes: Column) -> Column:
    """Hashes of two neighbours each; the last one alone if it has none."""

    def node(i: Column) -> Column:
        return F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256)

    return F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(nodes) - 1, F.lit(2)).cast("int")), node)


@dataclass
class Forest:
    """Trees over numbered leaves: their subroots (tree, total, depth, digest) and records by segment."""

    roots: DataFrame
    records: list[DataFrame]


def build(leaves: DataFrame) -> Forest:
    """The forest over (tree, rank, total, digest)."""
    nodes = leaves.select("tree", F.col("rank").alias("prefix"), "total", depth_of(F.col("total")).alias("depth"), "digest")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    roots = nodes.where("depth = 0").select("tree", "total", "depth", "digest")
    records = []
    for below in range(0, deepest, SEGMENT):
        grouped = (
            nodes.where(F.col("depth") > below)
            .groupBy("tree", F.shiftright("prefix", SEGMENT).alias("prefix"))
            .agg(
                F.first("total").alias("total"),
                F.first("depth").alias("depth"),
                F.transform(F.array_sort(F.collect_list(F.struct("prefix", "digest"))), lambda x: x["digest"]).alias("base"),
            )
        )
        width = F.least(F.lit(SEGMENT), F.col("depth") - below)
        levels = F.aggregate(
            F.sequence(F.lit(1), width),
            F.array("base"),
            lambda done, _: F.concat(done, F.array(_level_above(F.element_at(done, -1)))),
        )
        segments = cut(
            grouped.withColumn("levels", levels).select(
                "tree", "prefix", "total", "depth", F.get(F.element_at("levels", -1), F.lit(0)).alias("digest"), "levels"
            )
        )
        records.append(segments.select("digest", "levels").dropDuplicates(["digest"]))
        nodes = segments.drop("levels")
        roots = roots.unionByName(nodes.where(F.col("depth") <= below + SEGMENT).select("tree", "total", "depth", "digest"))
    return Forest(roots, records)


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (tree, rank, total, …) with ``digest`` of their leaf and ``path``, from the top down.

    ``starts`` holds (tree, depth, digest, path) of the trees to enter; its other columns are handed
    down. A path has one entry a level: the child not taken, or an empty text where there is none.
    """
    handed = [c for c in starts.columns if c not in ("tree", "depth", "digest", "path")]
    columns = [*handed, *[c for c in requests.columns if c != "total"], "depth", "digest", "path"]
    reached = starts.withColumn("prefix", F.lit(0).cast("bigint"))
    for step in range(len(forest.records) - 1, 0, -1):
        below = step * SEGMENT
        found = reached.where(F.col("depth") > below).join(forest.records[step], "digest")
        wanted = requests.select("tree", F.shiftright("rank", below).alias("child")).distinct()
        wanted = wanted.withColumn("prefix", F.shiftright("child", SEGMENT))
        taken = _taken(found.join(wanted, ["tree", "prefix"])).withColumnRenamed("child", "prefix")
        waiting = reached.where(F.col("depth") <= below)
        reached = cut(waiting.unionByName(taken))
    lone = reached.where("depth = 0").join(requests.where("total = 1"), "tree").select(*columns)
    if not forest.records:
        return lone
    found = reached.where("depth > 0").join(forest.records[0], "digest")
    wanted = requests.select("*", F.col("rank").alias("child"), F.shiftright("rank", SEGMENT).alias("prefix"))
    return _taken(found.join(wanted, ["tree", "prefix"])).select(*columns).unionByName(lone)


def _taken(found: DataFrame) -> DataFrame:
    """Step from a record to the child that ``child`` names: its digest, and the path with the others."""
    at = F.col("child").bitwiseAND((1 << SEGMENT) - 1).cast("int")

    def other(level: Column) -> Column:
        beside = F.call_function("shiftright", at, level).bitwiseXOR(F.lit(1))
        return F.coalesce(F.get(F.get("levels", level), beside), F.lit(""))

    return found.select(
        *[c for c in found.columns if c not in ("digest", "path", "prefix", "levels")],
        F.get(F.get("levels", F.lit(0)), at).alias("digest"),
        F.concat("path", F.transform(F.sequence(F.size("levels") - 2, F.lit(0)), other)).alias("path"),
    )


def fold(leaf: Column, rank: Column, proof: Column) -> Column:
    """Digest that a leaf and a proof, from the bottom up, lead to."""

    def up(state: Column, sibling: Column) -> Column:
        right = F.pmod(state["rank"], F.lit(2)) == 1
        joined = F.when(right, F.concat(sibling, state["digest"])).otherwise(F.concat(state["digest"], sibling))
        return F.struct(F.sha2(joined, 256).alias("digest"), F.shiftright(state["rank"], 1).alias("rank"))

    start = F.struct(leaf.alias("digest"), rank.cast("bigint").alias("rank"))
    return F.aggregate(proof, start, up)["digest"]


@dataclass
class Manifest:
    """Forests of a table's groups and of their subroots, with the leaves' places."""

    root: str | None
    top: Forest
    groups: Forest
    subroots: DataFrame
    leaves: DataFrame


def manifest(leaves: DataFrame) -> Manifest:
    """Build both forests over (id, grp, leaf, …); further columns stay with the leaves."""
    key = F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit(""))
    placed = cut(ranked(leaves.withColumn("tree", key), "tree", ["id", "leaf"]))
    groups = build(placed.select("tree", "rank", "total", F.col("leaf").alias("digest")))
    named = groups.roots.select(F.lit("").alias("forest"), "tree", "depth", F.col("digest").alias("subroot"))
    subroots = cut(ranked(named, "forest", ["tree"]))
    top = build(subroots.select(F.col("forest").alias("tree"), "rank", "total", F.col("subroot").alias("digest")))
    root = top.roots.first()
    return Manifest(root and root["digest"], top, groups, subroots, placed)


def prove(found: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Leaves asked for (rows of ``found.leaves``; all by default) with subroot and proof.

    ``proof`` has one entry a level from leaf to root, the sibling or an empty text. ``rank`` leads up
    the first ``depth`` levels, ``group_rank`` up the rest.
    """
    requests = found.leaves if requests is None else requests
    entered = found.subroots.join(requests.select("tree").distinct(), "tree", "left_semi")
    tops = found.top.roots.select("tree", "depth", "digest", F.array().cast("array<string>").alias("path"))
    asked = entered.select(
        F.col("forest").alias("tree"),
        F.col("rank"),
        "total",
        F.col("tree").alias("inner_tree"),
        F.col("depth").alias("inner_depth"),
    )
    starts = cut(
        descend(found.top, tops, asked).select(
            F.col("inner_tree").alias("tree"),
            F.col("inner_depth").alias("depth"),
            "digest",
            "path",
            F.col("digest").alias("subroot"),
            F.col("rank").alias("group_rank"),
        )
    )
    return descend(found.groups, starts, requests).withColumn("proof", F.reverse("path")).drop("tree", "digest", "path")


def verified_manifest(
    df: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    counter: str = "n_chars",
    every: int = 7,
) -> DataFrame:
    """``id_col``, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Where ``every`` divides the crc32 of the id, the leaf that is folded has ``counter`` raised by one.
    """
    names = {name: f"f{i}" for i, name in enumerate(fields)}
    rows = pick(df, id=id_col, grp=group_col, **{new: old for old, new in names.items()})
    crc = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    raised = [F.col(new) + 1 if old == counter else F.col(new) for old, new in names.items()]
    leaves = cut(
        rows.select(
            "id",
            "grp",
            leaf_digest([F.col(new) for new in names.values()]).alias("leaf"),
            F.when(F.pmod(crc, F.lit(every)) == 0, leaf_digest(raised)).alias("tampered"),
        )
    )
    found = manifest(leaves)
    proofs = prove(found)
    lower, upper = F.slice("proof", 1, F.col("depth")), F.slice("proof", F.col("depth") + 1, F.size("proof"))
    inner = fold(F.coalesce("tampered", "leaf"), F.col("rank"), lower)
    root = F.lit(found.root).cast("string")
    return (
        proofs.withColumn("_inner", inner)
        .withColumn("folded_root", fold(F.col("_inner"), F.col("group_rank"), upper))
        .select(
            F.col("id").alias(id_col),
            "leaf",
            "subroot",
            root.alias("root"),
            F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == root).alias("verified"),
        )
    )
