"""Conversation structure repair by a run-length min-plus dynamic programme.

Each row of a conversation, in order of its turn, is one symbol: the initial
of its role and its first fault (blank, duplicate, truncated). The cheapest
edits that make the role initials read ``(s?(ua)+)?`` are a shortest path over
the four states of that pattern. A row's symbol is a 4 x 4 min-plus matrix
(insertions before the row, then the row itself), so a run of k equal symbols
is a power of its matrix, put together from cached binary powers. Costs to go
are carried back over the runs to the ends of slices of ``SLICE`` rows; the
choices are then unrolled forward, slice by slice, always taking the letter
least in ASCII order among the cheapest, which gives the least audit.

Edits: (K)eep 0; (R)erole to user or assistant 3; (D)elete 4, the only way for
blank and duplicate rows; (I)nsert an empty user or assistant row 3; a
truncated row that stays adds 3.

Order and defined results: rows of one turn are ordered by role, then text;
null turns come first; null roles and texts count as one space; null
conversation ids are one conversation; a role whose initial is none of s, u, a
must be replaced or deleted. An empty table has no conversations; other
columns are ignored.

Scale: rows are dealt by ranges of (conversation, turn), so a long conversation
spreads over tasks. Duplicates are found by the first row of each text (combined
before the shuffle). What meets in one task of a conversation is one character a
row, as in the audit itself; texts join the edits by row number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

SLICE = 4096
RANK = {"s": 0, "u": 1, "a": 2}
NO_FAULT, TRUNCATED, BLANK, DUPLICATE = range(4)
#: A row's symbol is the letter at 4 * fault + rank of its initial (3: none of them).
SYMBOLS = "ABCDEFGHIJKLMNOP"

INSERT, REROLE, DELETE, CUT = 3, 3, 4, 3
#: States: nothing yet, after s, after u, after a. An insertion or a new role
#: brings the letter that the state waits for.
FORWARD = (2, 2, 3, 2)
LETTER = ("u", "u", "a", "u")
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, rank): next state
INF = 1 << 60

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


def _insertions() -> Matrix:
    rows = []
    for q in range(4):
        cost, at, total = [INF] * 4, q, 0
        while cost[at] > total:
            cost[at], at, total = total, FORWARD[at], total + INSERT
        rows.append(tuple(cost))
    return tuple(rows)


INSERTIONS = _insertions()
#: Cost to go behind the last row: the pattern may end at the start or after a.
END = apply(INSERTIONS, (0, INF, INF, 0))


def choices(symbol: str, q: int) -> list[tuple[str, int, int]]:
    """What a row allows in state ``q``: (letter, cost, next state)."""
    fault, rank = divmod(SYMBOLS.index(symbol), 4)
    out = [("D", DELETE, q)]
    if fault < BLANK:
        cut = CUT if fault == TRUNCATED else 0
        if (q, rank) in KEPT:
            out.append(("K", cut, KEPT[q, rank]))
        out.append(("R", REROLE + cut, FORWARD[q]))
    return out


@lru_cache(None)
def power(symbol: str, j: int) -> Matrix:
    """The symbol's transition to the power of 2 ** j."""
    if j:
        half = power(symbol, j - 1)
        return times(half, half)
    row = [[INF] * 4 for _ in range(4)]
    for q in range(4):
        for _, cost, to in choices(symbol, q):
            row[q][to] = min(row[q][to], cost)
    return times(INSERTIONS, tuple(map(tuple, row)))


def back(symbol: str, k: int, v: Vector) -> Vector:
    """Cost to go in front of ``k`` equal symbols."""
    for j in range(k.bit_length()):
        if k >> j & 1:
            v = apply(power(symbol, j), v)
    return v


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def unroll(symbols: str, q: int, v: Vector, last: bool) -> tuple[str, str, int]:
    """Audit letters and new roles of a slice entered in state ``q``, with
    cost to go ``v`` behind it; and the state it ends in. Insertions behind
    the last row belong to the last slice."""
    ends = [v]
    for s, k in reversed(runs(symbols)):
        ends.append(back(s, k, ends[-1]))
    letters, roles = [], []

    def insert() -> None:
        nonlocal q
        letters.append("I")
        roles.append(LETTER[q])
        q = FORWARD[q]

    for (s, k), end in zip(runs(symbols), reversed(ends[:-1])):
        steps = [end]  # cost to go behind each row of the run, last one first
        for _ in range(k):
            steps.append(apply(power(s, 0), steps[-1]))
        for behind, here in zip(reversed(steps[:-1]), reversed(steps[1:])):
            while True:
                best = min(
                    [(c, cost, to) for c, cost, to in choices(s, q) if cost + behind[to] == here[q]]
                    + [("I", INSERT, FORWARD[q])] * (INSERT + here[FORWARD[q]] == here[q])
                )
                if best[0] == "I":
                    insert()
                    continue
                letters.append(best[0])
                roles.append(LETTER[q] if best[0] == "R" else "-")
                q = best[2]
                break
    while last and v[q]:
        insert()
    return "".join(letters), "".join(roles), q


@lru_cache(100_000)
def _short(symbols: str) -> tuple[int, tuple[str, ...], tuple[str, ...]]:
    return _solve((symbols,))


def solve(slices: tuple[str, ...]) -> tuple[int, tuple[str, ...], tuple[str, ...]]:
    """Cost, audit and new roles of a conversation, given and returned slice
    by slice."""
    return _short(slices[0]) if len(slices) == 1 and len(slices[0]) < 100 else _solve(slices)


def _solve(slices: tuple[str, ...]) -> tuple[int, tuple[str, ...], tuple[str, ...]]:
    ends = [END]
    for symbols in reversed(slices):
        v = ends[-1]
        for s, k in reversed(runs(symbols)):
            v = back(s, k, v)
        ends.append(v)
    q, audit, roles = 0, [], []
    for i, (symbols, v) in enumerate(zip(slices, reversed(ends[:-1]))):
        letters, new, q = unroll(symbols, q, v, i == len(slices) - 1)
        audit.append(letters)
        roles.append(new)
    return ends[-1][0], tuple(audit), tuple(roles)


def illegal(symbols: str) -> int:
    """Neighbouring rows whose initials aren't su, ua or au."""
    rank = [SYMBOLS.index(s) % 4 for s in symbols]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(rank, rank[1:]))


# -- Spark --------------------------------------------------------------------


class Repaired(NamedTuple):
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    audits: DataFrame
    #: conv_id, place, edit, role, text; rows deleted are left out
    messages: DataFrame


#: White space, as the faults know it.
_SPACE = r"[\x20\x09-\x0D]"


def _symbol(first: Column) -> Column:
    text = F.regexp_replace("text", _SPACE + "+\\z", "")
    fault = (
        F.when(F.length(text) == 0, BLANK).when(~first, DUPLICATE)
        .when(~text.rlike(r"[.!?]\z"), TRUNCATED).otherwise(NO_FAULT)
    )
    initial = F.substring("role", 1, 1)
    rank = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.substring(F.lit(SYMBOLS), 4 * fault + rank + 1, F.lit(1))


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> Repaired:
    spark = rows.sparkSession
    prepare(spark)
    plain = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    ordered = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = written(ordered.withColumn("row", F.monotonically_increasing_id()), "conversation-rows")

    firsts = stored.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("row").alias("row"))
    marked = stored.join(firsts.select("row", F.lit(True).alias("first")), "row", "left")
    symbols = marked.select("conv_id", "row", "turn", _symbol(F.coalesce("first", F.lit(False))).alias("symbol"))
    in_order = F.array_sort(F.collect_list(F.struct("row", "symbol")))
    slices = symbols.groupBy("conv_id", F.floor(F.col("row") / SLICE).alias("slice")).agg(
        in_order.alias("rows"), F.min("turn").alias("lo"), F.max("turn").alias("hi"),
        F.size(F.collect_set("turn")).alias("turns"),
    )
    one = F.struct(
        F.element_at("rows", 1)["row"].alias("row"), F.array_join(F.col("rows")["symbol"], "").alias("symbols"),
        "lo", "hi", "turns",
    )
    whole = slices.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("slices"))
    audits = written(whole.mapInArrow(_audits, _AUDIT), "conversation-audits")

    parts = audits.select("conv_id", F.inline("parts"))
    edits = parts.mapInArrow(_edits, "conv_id long, place long, edit string, role string, row long")
    kept = edits.filter("edit in ('K', 'R')").withColumnRenamed("role", "new")
    messages = kept.join(stored.select("row", "role", "text"), "row").select(
        "conv_id", "place", "edit", F.when(F.col("edit") == "R", F.col("new")).otherwise(F.col("role")).alias("role"), "text"
    )
    inserted = edits.filter("edit = 'I'").select("conv_id", "place", "edit", "role", F.lit("").alias("text"))
    return Repaired(audits.drop("parts"), messages.unionByName(inserted))


_AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "parts array<struct<row: long, place: long, letters: string, roles: string>>"
)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string()), ("parts", pa.list_(pa.struct(
            [("row", pa.int64()), ("place", pa.int64()), ("letters", pa.string()), ("roles", pa.string())])))]
    )
    for batch in batches:
        out = []
        for conv, slices in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            symbols = "".join(s["symbols"] for s in slices)
            turned = [s for s in slices if s["lo"] is not None]
            # a turn may go on from slice to slice
            distinct = sum(s["turns"] for s in turned) - sum(a["hi"] == b["lo"] for a, b in zip(turned, turned[1:]))
            gaps = turned[-1]["hi"] - turned[0]["lo"] + 1 - distinct if turned else 0
            cost, audit, roles = solve(tuple(s["symbols"] for s in slices))
            count = {f: sum(symbols.count(c) for c in SYMBOLS[4 * f : 4 * f + 4]) for f in range(4)}
            place, parts = 0, []
            for s, letters, new in zip(slices, audit, roles):
                parts.append({"row": s["row"], "place": place, "letters": letters, "roles": new})
                place += len(letters)
            out.append({
                "conv_id": conv, "gaps": gaps, "blank": count[BLANK], "duplicate": count[DUPLICATE],
                "truncated": count[TRUNCATED], "illegal": illegal(symbols), "cost": cost, "audit": "".join(audit), "parts": parts,
            })
        yield pa.RecordBatch.from_pylist(out, schema)


_ROLES = {"u": "user", "a": "assistant", "-": None}


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row an edit; ``row`` is the row it is made on."""
    for batch in batches:
        for conv, row, place, letters, roles in zip(*(c.to_pylist() for c in batch.columns)):
            made = np.frombuffer(letters.encode(), np.uint8) != ord("I")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([conv] * len(letters), pa.int64()),
                    pa.array(place + np.arange(len(letters))),
                    pa.array(list(letters), pa.string()),
                    pa.array([_ROLES[r] for r in roles], pa.string()),
                    pa.array(row + np.cumsum(made) - 1, mask=~made),
                ],
                ["conv_id", "place", "edit", "role", "row"],
            )


def digests(ids: DataFrame, repaired: Repaired) -> DataFrame:
    """One row for each of the conversations in ``ids``: its audit and the
    SHA-256 of its repaired ``role:text`` lines, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"]
            )

        for batch in batches:
            for c, role, text in zip(*(x.to_pylist() for x in batch.columns)):
                if digest is None or c != conv:
                    if digest is not None:
                        yield out()
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if digest is not None:
            yield out()

    lines = repaired.messages.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    hashed = lines.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")
    found = repaired.audits.alias("a").join(hashed.alias("h"), F.expr("a.conv_id <=> h.conv_id"), "left").select("a.*", "repaired_sha256")
    every = ids.select(F.col(ids.columns[0]).cast("long").alias("conv_id")).distinct()
    none = hashlib.sha256().hexdigest()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.alias("e").join(found.alias("f"), F.expr("e.conv_id <=> f.conv_id"), "left").select(
        "e.conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )
