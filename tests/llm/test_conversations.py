"""Conversation repair against a plain shortest path over every row."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from revcast.llm import conversations
from revcast.llm.queries import damaged, op13_conversation_repair

NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(rows):
    """(cost, audit, edits) over rows of (initial, must go, truncated)."""

    def insertions(at):
        for _ in range(4):
            for state, (cost, audit, edits) in list(at.items()):
                letter, to = NEXT[state]
                offer(at, to, (cost + 3, audit + "I", (*edits, (letter, None))))

    def offer(at, to, path):
        if to not in at or path[:2] < at[to][:2]:
            at[to] = path

    at = {0: (0, "", ())}
    for i, (initial, must, cut) in enumerate(rows):
        insertions(at)
        then = {}
        for state, (cost, audit, edits) in at.items():
            offer(then, state, (cost + 4, audit + "D", edits))
            if not must:
                if (state, initial) in KEEP:
                    offer(then, KEEP[state, initial], (cost + 3 * cut, audit + "K", (*edits, (None, i))))
                letter, to = NEXT[state]
                offer(then, to, (cost + 3 + 3 * cut, audit + "R", (*edits, (letter, i))))
        at = then
    insertions(at)
    return min((at[s] for s in (0, 3) if s in at), key=lambda p: p[:2])


def spoilt(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)


def expected(rows):
    held = defaultdict(list)
    for row in spoilt(rows):
        held[row[0]].append(row)
    for conv in {r[0] for r in rows}:
        mine = sorted(held[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, count, plain = set(), Counter(), []
        for _, _, role, text in mine:
            core = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not core else "dup" if (role, text) in seen else "cut" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            plain.append((role[:1], fault in ("blank", "dup"), fault == "cut"))
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit, edits = cheapest(plain)
        lines = []
        for letter, i in edits:
            role = {"u": "user", "a": "assistant", None: None if i is None else mine[i][2]}[letter]
            lines.append(f"{role}:{'' if i is None else mine[i][3]}")
        yield (
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["dup"], count["cut"],
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    wide = [(*r, "x", 1, "y") for r in rows]
    return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, audit string, row long, symbol string")


@pytest.mark.parametrize("size", [4096, 5])
def test_awkward_conversations_in_slices_of_any_size(spark, monkeypatch, size):
    monkeypatch.setattr(conversations, "SLICE", size)
    rng = random.Random(2)
    texts = [None, "", " \n", "hi.", "what?", "cut", "ok!", "a.", "b", "c.  ", "x\x1c", "y "]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(30)]), rng.choice(["user", "assistant", "system", None, "", "Tool"]), rng.choice(texts))
        for _ in range(2000)
    ]
    df = frame(spark, rows)
    got = conversations.digests(df.select("conv_id"), conversations.repair(damaged(df)))
    assert found(got) == sorted(expected(rows), key=repr)


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_conversation_repair(spark, sf)) == sorted(expected(rows), key=repr)


def test_runs_of_equal_symbols():
    rng = random.Random(7)
    for _ in range(60):
        symbols = "".join(rng.choice(conversations.SYMBOLS) * rng.choice((1, 2, 3, 40)) for _ in range(rng.randrange(6)))
        rows = [("sua-"[conversations.SYMBOLS.index(s) % 4], s > "H", "D" < s < "I") for s in symbols]
        cost, audit, _ = cheapest(rows)
        cut = sorted(rng.randrange(len(symbols) + 1) for _ in range(3))
        slices = tuple(symbols[a:b] for a, b in zip([0, *cut], [*cut, len(symbols)]))
        got, letters, _ = conversations.solve(slices)
        assert (got, "".join(letters)) == (cost, audit)


def test_a_very_long_run():
    cost, audit, _ = conversations.solve(("B" * 3000,) * 5)  # 15,000 user rows
    assert cost == 15_000 / 2 * 3 and len(audit[0]) == 3000


def test_messages_are_the_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (2, 0, "user", "cut")]
    done = conversations.repair(frame(spark, rows))
    got = sorted((r.conv_id, r.place, r.edit, r.role, r.text) for r in done.messages.collect())
    audits = {r.conv_id: (r.cost, r.audit) for r in done.audits.collect()}
    assert audits[2] == (4, "D")
    for conv, place, edit, role, text in got:
        assert audits[conv][1][place] == edit
        assert (text == "") == (edit == "I")


def test_empty_table(spark):
    df = frame(spark, [])
    assert conversations.digests(df.select("conv_id"), conversations.repair(df)).collect() == []
