import hashlib
import heapq
import random
import re
import zlib

import pytest

from gridpulse.llm import repair
from gridpulse.llm.common import table
from gridpulse.llm.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def shown(value):
    return " " if value is None else str(value)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        chars = WORD.findall(text)
        faults.append("b" if not chars else "d" if (role, text) in seen else "t" if chars[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def cheapest(rows, faults):
    """All sequences of edits, by cost and then by their initials, until one ends in a legal order."""
    heap, done = [(0, "", 0, ())], set()
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        roles = "".join(r[:1] for r, _ in out)
        if not re.fullmatch("(s?(ua)*u?)?", roles) or (i, audit, roles) in done or len(out) > len(rows) + 3:
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out
        done.add((i, audit, roles))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, (*out, (role, ""))))
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, out))
            if faults[i] not in ("b", "d"):
                more = 5 if faults[i] == "t" else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, (*out, (own, text))))
                for role in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, (*out, (role, text))))


def brute(rows):
    rows = in_order(rows)
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, out = cheapest(rows, faults)
    text = "\n".join(f"{role}:{text}" for role, text in out)
    return (gaps, *map(faults.count, "bdt"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return {conv: brute(damage(some)) for conv, some in out.items()}


def found(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "user", "assistant"]
    texts = ["a.", "b.", "c!", "d", "  ", "e.", "f?", "g ", "h.\n", "i."]
    return [(rng.choice([None, 1, 2, 3, 4, 5, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("spool", [1, 1 << 20])
def test_edits_are_the_cheapest_and_least(spool):
    rng = random.Random(5)
    for _ in range(300):
        rows = in_order(random_rows(rng, rng.randrange(7)))
        one = repair.Conversation(spool)
        for row, fault in list(zip(rows, faults_of(rows), strict=True))[::-1]:
            one.add(*row, fault)
        assert one.result() == brute(rows), rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    df = REGISTRY["op13_conversation_repair"](spark, SF_DIR)
    assert df.columns == ["conv_id", *repair.COLUMNS]
    assert found(df) == by_conversation(rows)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(conv, *row) for conv in [None, 2**60 + 1, *range(120)] for row in random_rows(rng, 5)]
    rows += [(500, None, None, None), (501, None, "user", None), (502, 1, None, "a."), (503, 1, "", "x."), (503, 2, "user", "")]
    rows += [(504, 1, "user", "word " * 50_000 + "."), (504, 2, "assistant", "x" * 200_000), (504, 2, "assistant", "ok.")]
    rows += [(505, 3, "user", "same.")] * 4 + [(506, 2**60, "user", "a."), (506, 2**60 + 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in ("key", "kind", "copy", "fault", "nth", "dropped", "content", "conv")])
    assert found(repair.repair(df)) == by_conversation(rows)


def test_dropped_conversation_and_empty_table(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 1, "user", "a.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(repair.repair(df)) == {conv: (0, 0, 0, 0, 0, 0, "", empty)}
    assert found(repair.repair(df.limit(0))) == {}


def test_state_crosses_batches_and_one_conversation_may_hold_all_rows(spark):
    roles = ["user", "assistant"]
    rows = [(7, i, roles[i % 2], f"turn {i}.") for i in range(20_000)]
    (got,) = found(repair.repair(spark.createDataFrame(rows, SCHEMA), damage=False)).values()
    text = "\n".join(f"{role}:{text}" for _, _, role, text in rows)
    assert got == (0, 0, 0, 0, 0, 0, "K" * 20_000, hashlib.sha256(text.encode()).hexdigest())
