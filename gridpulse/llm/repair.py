"""Repair of conversation structure by secondary-sorted streaming.

A conversation's rows are repartitioned by conversation and sorted by turn, last first. One pass over
the Arrow batches carries, from a conversation's end to its start, the cost of the cheapest edits that
bring what follows into the order ``(s?(ua)+)?``, for each of the four states of that order. Every row
leaves one byte with the action of each state, and its role and text; both go to a spool that moves
from memory to a file beyond ``SPOOL`` bytes. When the conversation's first row has been read, the
actions are walked from start to end, which reads the spool backwards. A conversation of any length so
takes bounded memory; only its result, the string of edits, grows with it.

Edits: keep (0), rerole to user or assistant (1), delete (2; blank and duplicate rows must be), insert a
user or assistant row without text (5); a truncated row that is not deleted adds 5. From each state one
role is legal for a rerole or an insert, so the actions of a state differ in their initials and the
least initial among the cheapest gives the least string of edits.

Duplicates are found before the pass, by conversation and content, so no set of seen texts is kept.

Cases: null role or text is one space, so such a text is blank; a null id is a conversation of its own;
null turns come first; rows of one turn are ordered by role and text; an empty role has no initial, is
never legal where it stands and counts as an illegal neighbour; a conversation without rows has zeros,
no edits and the hash of the empty text; an empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import pick

BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States of the order: nothing yet, after a system, a user, an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (USER, USER, ASSISTANT, USER)
#: Cost of the rest after the last row, by state: inserts until the order may end.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Actions in the order of their initials; two bits a state make a row's byte.
INITIALS = "DIKR"
D, I, K, R = range(4)
LEGAL_PAIRS = {"su", "ua", "au"}
SPOOL = 1 << 20


def damaged(df: DataFrame) -> DataFrame:
    """(conv, turn, role, text) after seeded damage; a dropped row keeps its place with ``dropped`` set."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(shown("conv"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    text = shown("text")
    return (
        df.withColumn("kind", kind)
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv",
            "turn",
            F.when(F.col("kind") == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
            F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace(text, f"[{ENDS}]", "")).otherwise(text).alias("text"),
            (F.col("kind") == 0).alias("dropped"),
        )
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: b(lank), d(uplicate), t(runcated) or empty, the first that holds."""
    body = F.rtrim("text", F.lit(BLANKS))
    content = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    alike = Window.partitionBy("conv", "content").orderBy(F.col("dropped"), F.col("turn").asc_nulls_first())
    return (
        rows.withColumn("content", content)
        .withColumn("nth", F.row_number().over(alike))
        .select(
            "conv",
            "turn",
            "role",
            "text",
            "dropped",
            "nth",
            F.when(body == "", "b")
            .when(F.col("nth") > 1, "d")
            .when(~F.substring(body, -1, 1).isin(*ENDS), "t")
            .otherwise("")
            .alias("fault"),
        )
    )


def step(after: list[int], initial: str, fault: str) -> tuple[list[int], int]:
    """Costs before a row from those after it, and the byte with the action of each state."""
    must_go = fault in ("b", "d")
    extra = TRUNCATED if fault == "t" else 0
    costs, actions = [0] * 4, [D] * 4
    for q in range(4):
        best, action = DELETE + after[q], D
        if not must_go:
            to = FOLLOWS[q].get(initial)
            if to is not None and KEEP + extra + after[to] < best:
                best, action = KEEP + extra + after[to], K
            if REROLE + extra + after[NEXT_STATE[q]] < best:
                best, action = REROLE + extra + after[NEXT_STATE[q]], R
        costs[q], actions[q] = best, action
    # An insert leads to another state before the same row; two rounds settle every chain of inserts.
    for _ in range(3):
        for q in range(4):
            inserted = INSERT + costs[NEXT_STATE[q]]
            if inserted < costs[q] or (inserted == costs[q] and I < actions[q]):
                costs[q], actions[q] = inserted, I
    return costs, sum(a << 2 * q for q, a in enumerate(actions))


def scratch() -> str | None:
    """Spark's own scratch folder of this executor, for files that live no longer than their task."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None


class Conversation:
    """What is known of a conversation whose rows come from its last to its first."""

    def __init__(self, spool: int = SPOOL):
        self.costs = list(AT_END)
        self.rows = tempfile.SpooledTemporaryFile(max_size=spool, dir=scratch())
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.later: str | None = None
        self.turn: int | None = None
        self.turns, self.last = 0, None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.turn:
            self.last = turn if self.last is None else self.last
            self.turn, self.turns = turn, self.turns + 1
        if fault:
            self.counts[{"b": "blank", "d": "duplicate", "t": "truncated"}[fault]] += 1
        initial = role[:1]
        if self.later is not None and initial + self.later not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        self.later = initial
        self.costs, action = step(self.costs, initial, fault)
        name, body = role.encode(), text.encode()
        self.rows.write(name + body)
        self.rows.write(len(name).to_bytes(4, "little") + len(body).to_bytes(4, "little") + bytes([action]))

    def backwards(self, block: int = 1 << 16) -> Iterator[tuple[int, bytes, bytes]]:
        """Action byte, role and text of every row, the last written first; read in blocks."""
        at = self.rows.seek(0, os.SEEK_END)
        start, data = at, b""

        def back_to(place: int) -> None:
            nonlocal start, data
            if place < start:
                low = max(0, min(place, at - block))
                self.rows.seek(low)
                start, data = low, self.rows.read(at - low)

        while at:
            back_to(at - 9)
            tail = data[at - 9 - start : at - start]
            name, body = int.from_bytes(tail[:4], "little"), int.from_bytes(tail[4:8], "little")
            begin = at - 9 - name - body
            back_to(begin)
            record = data[begin - start : at - 9 - start]
            yield tail[8], record[:name], record[name:]
            at = begin

    def result(self) -> tuple:
        edits, digest, state, lines = [], hashlib.sha256(), EMPTY, 0

        def write(role: bytes, text: bytes) -> None:
            nonlocal lines
            digest.update(b"\n" * (lines > 0) + role + b":" + text)
            lines += 1

        for byte, role, text in self.backwards():
            while True:
                action = byte >> 2 * state & 3
                edits.append(INITIALS[action])
                if action == D:
                    break
                if action == K:
                    write(role, text)
                    state = FOLLOWS[state][role.decode()[:1]]
                    break
                write(NEXT_ROLE[state].encode(), b"" if action == I else text)
                state = NEXT_STATE[state]
                if action == R:
                    break
        while state in (SYSTEM, USER):
            edits.append(INITIALS[I])
            write(NEXT_ROLE[state].encode(), b"")
            state = NEXT_STATE[state]
        self.rows.close()
        gaps = self.last - self.turn + 1 - self.turns if self.turns else 0
        return gaps, *self.counts.values(), self.costs[EMPTY], "".join(edits), digest.hexdigest()


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damage: bool = True,
) -> DataFrame:
    """``id_col``, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    ``damage=False`` repairs the rows as they are.
    """
    rows = pick(df, conv=id_col, turn=turn_col, role=role_col, text=text_col).withColumn("turn", F.col("turn").cast("bigint"))
    if damage:
        rows = damaged(rows)
    else:
        given = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
        rows = rows.select("conv", "turn", *given, F.lit(False).alias("dropped"))
    kind = rows.schema["conv"].dataType
    last_first = [F.col("conv"), F.col("turn").desc_nulls_last(), *[F.col(c).desc() for c in ("role", "text", "nth")]]
    # Numbers travel as text: pandas turns a column of numbers with nulls into floats.
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("key")
    ordered = with_faults(rows).repartition("conv").sortWithinPartitions(*last_first)
    ordered = ordered.select(key, F.col("turn").cast("string").alias("turn"), "role", "text", "dropped", "fault")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, conv, out = None, None, []
        for batch in batches:
            for key, turn, role, text, dropped, fault in batch.itertuples(index=False, name=None):
                if current is None or key != conv:
                    if current is not None:
                        out.append((conv, *current.result()))
                    current, conv = Conversation(), key
                if not dropped:
                    current.add(None if pd.isna(turn) else int(turn), role, text, fault)
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=["key", *COLUMNS])
                out = []
        if current is not None:
            out.append((conv, *current.result()))
        yield pd.DataFrame(out, columns=["key", *COLUMNS])

    counts = ", ".join(f"{c} bigint" for c in COLUMNS[:6])
    found = ordered.mapInPandas(run, f"key string, {counts}, audit string, repaired_sha256 string")
    given = F.when(F.col("key") != "", F.substr("key", F.lit(2))).cast(kind)
    return found.select(given.alias(id_col), *COLUMNS)
