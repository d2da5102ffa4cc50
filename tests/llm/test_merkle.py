import hashlib
import zlib

import pytest

from gridpulse.llm import merkle

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASHING = "id tree rank total digest leaf path prefix levels child depth grp f0 f1 proof root tampered".split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, count):
    doc_id, text, lang, source, _ = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, count, text)))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {g: levels([leaf(r, r[4]) for r in groups[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for at, row in enumerate(groups[g]):
            count = row[4]
            if zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 7 == 0 and count is not None:
                count += 1
            digest, proof = leaf(row, count), ""
            for tree, k in ((trees[g], at), (top, place)):
                for level in tree[:-1]:
                    run = level[k // 2 * 2 : k // 2 * 2 + 2]
                    proof += "".join(d for j, d in enumerate(run) if j != k % 2)
                    run[k % 2] = digest
                    digest, k = sha("".join(run)), k // 2
            root = top[-1][0]
            out.append((row[0], leaf(row, row[4]), trees[g][-1][0], root, sha(proof), digest, digest == root))
    return sorted(out, key=str)


def run(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.selectExpr("*", *[f"'x' AS `{n}`" for n in CLASHING]) if extra else df
    return sorted(map(tuple, merkle.verified_manifest(df).collect()), key=str)


def doc(i, lang="en", text=None):
    return (i, f"text {i} é" if text is None else text, lang, "a", 8)


CASES = {
    "one row": [doc(1)],
    "one row that is tampered with": [doc(7 * 11), doc(2, "fr")],
    "groups of one": [doc(i, f"l{i}") for i in range(5)],
    "null group, empty group": [doc(i, lang) for i, lang in enumerate([None, "", "é", "z", None, "", None])],
    "nulls": [(None, None, None, None, None), (None, "x", None, None, 1), (3, None, "en", None, None), (21, "", "en", "", 0)],
    "repeated rows": [doc(4)] * 5 + [doc(4, text="other"), doc(9)] + [doc(4)] * 6,
    "segment borders": [doc(i, "a") for i in range(256)] + [doc(i, "b") for i in range(257)] + [doc(i, "c") for i in range(3)],
    "long text": [doc(1, text="long " * 50_000), doc(2), doc(3)],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_tree(spark, name):
    got = run(spark, CASES[name])
    assert got == brute(CASES[name])


def test_more_groups_than_a_segment_and_clashing_columns(spark):
    rows = [doc(i, f"g{i % 300}") for i in range(900)]
    got = run(spark, rows, extra=True)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_three_segments(spark):
    rows = [doc(i, text="") for i in range(70_000)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_some_requests_get_the_same_proofs(spark):
    df = spark.createDataFrame([doc(i, "ab"[i % 2]) for i in range(900)], SCHEMA)
    fields = [df[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaves = df.select(df.doc_id.alias("id"), df.lang.alias("grp"), merkle.leaf_digest(fields).alias("leaf"))
    found = merkle.manifest(leaves)
    every = {r["id"]: r["proof"] for r in merkle.prove(found).collect()}
    some = merkle.prove(found, found.leaves.where("id % 100 = 3 AND grp = 'b'")).collect()
    assert {r["id"] for r in some} == {3 + 100 * k for k in range(9)}
    assert all(r["proof"] == every[r["id"]] for r in some)


def test_records_are_content_addressed(spark):
    rows = [doc(i % 1, text="same") for i in range(2048)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(df.select(df.doc_id.alias("id"), df.lang.alias("grp"), merkle.leaf_digest([df.text]).alias("leaf")))
    assert found.groups.records[0].count() == 1
