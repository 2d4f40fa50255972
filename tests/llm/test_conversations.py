import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pyarrow as pa
import pytest

from pactline.llm import conversations, survivors
from pactline.llm.survivors import Survivors, Turn

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(turns):
    """Cost and edits, by trying every edit of every row from the end back."""

    @lru_cache(None)
    def best(i, last, inserts):
        ways = [(0, "")] if i == len(turns) and last in ("", "a") else []
        due = "a" if last == "u" else "u"
        if inserts < 2:
            cost, edits = best(i, due, inserts + 1)
            ways.append((cost + 5, "I" + edits))
        if i < len(turns):
            initial, fault = turns[i]
            cost, edits = best(i + 1, last, 0)
            ways.append((cost + 2, "D" + edits))
            if fault in (None, "truncated"):
                more = 5 if fault else 0
                cost, edits = best(i + 1, due, 0)
                ways.append((cost + 1 + more, "R" + edits))
                if initial == due or (initial == "s" and last == ""):
                    cost, edits = best(i + 1, initial, 0)
                    ways.append((cost + more, "K" + edits))
        return min(ways, default=(10**9, ""))

    for i in range(len(turns), 0, -1):  # shallow recursion: what follows is known
        for last in ("", "s", "u", "a"):
            best(i, last, 0)
    return best(0, "", 0)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        names = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(names).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(conv, rows):
    rows = sorted(
        (r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    )
    seen, turns = set(), []
    for _, _, role, text in rows:
        solid = SOLID.findall(text)
        fault = None if solid and solid[-1] in ".!?" else "truncated"
        fault = "duplicate" if (role, text) in seen else fault
        turns.append((role[:1], fault if solid else "blank"))
        seen.add((role, text))
    cost, audit = cheapest(tuple(turns))
    numbers = [r[1] for r in rows if r[1] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = zip(turns, turns[1:], strict=False)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in pairs)
    made, last, todo = [], "", iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(todo)
        if edit == "K":
            made.append(f"{row[2]}:{row[3]}")
            last = row[2][:1]
        elif edit != "D":
            last = "a" if last == "u" else "u"
            role = {"u": "user", "a": "assistant"}[last]
            made.append(f"{role}:{row[3] if row else ''}")
    faults = [f for _, f in turns]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    sha = hashlib.sha256("\n".join(made).encode()).hexdigest()
    return (conv, gaps, *counts, illegal, cost, audit, sha)


def expect_all(rows):
    left = damaged(rows)
    return sorted((expected(c, left) for c in {r[0] for r in rows}), key=str)


def run(frame, **more):
    return sorted((tuple(r) for r in conversations.audited(frame, **more).collect()), key=str)


def made_rows(rng, count, most=9):
    texts = ["Hello there.", "What is it?", "cut off", " ", "", "Yes!", "A line.\nnext one", "é ü."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "Assistant", "", None]
    rows = []
    for conv in range(count):
        for n in range(rng.randint(1, most)):
            turn = rng.choice([n, n, n, n, n + 1, None])
            text = rng.choice([*texts, f"Own {conv} {n}.", f"Own {n}!", f"open {n}", None])
            rows.append((conv, turn, rng.choice(roles), text))
    return rows


@pytest.mark.parametrize("block_bytes", [conversations.BLOCK_BYTES, 300, 1])
def test_equals_brute_force(llm, block_bytes):
    rng = random.Random(1)
    rows = [*made_rows(rng, 60), *((None, n, "user", f"no id {n}.") for n in range(6))]
    rows += [(99, 0, "user", "the same.")] * 7 + [(99, 1, "assistant", "the same.")] * 3
    rng.shuffle(rows)
    frame = llm.createDataFrame(rows, SCHEMA).repartition(4)
    assert run(frame, block_bytes=block_bytes) == expect_all(rows)


def test_long_conversation_in_blocks(llm):
    rng = random.Random(2)
    roles = ["user", "assistant"]
    rows = [
        (1, n, roles[n % 2] if rng.random() < 0.8 else rng.choice(roles), rng.choice(
            [f"Turn {n}.", f"Turn {n}.", "", "again.", f"open {n}"]))
        for n in range(700)
    ] + made_rows(rng, 5)
    frame = llm.createDataFrame(rows, SCHEMA)
    want = expect_all(rows)
    assert run(frame, block_bytes=5_000) == want
    assert run(frame) == want


def test_sql_equals_brute_force():
    rows = [*made_rows(random.Random(6), 80), *((None, n, "user", f"no id {n}.") for n in range(6))]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    duck = duckdb.connect()
    duck.register("conversations", pa.table(columns, ["conv_id", "turn", "role", "text"]))
    found = sorted(duck.sql(conversations.ORACLE).fetchall(), key=str)
    assert found == expect_all(rows)


def turns_of(rng, n):
    return tuple(
        (rng.choice("suuaax"), rng.choice([None, None, None, "truncated", "blank", "duplicate"]))
        for _ in range(n)
    )


def test_survivors_equal_trying_all():
    rng = random.Random(3)
    for _ in range(1500):
        turns, edits = turns_of(rng, rng.randint(0, 9)), []
        found = Survivors(lambda edit, turn, edits=edits: edits.append(edit))
        for initial, fault in turns:
            found.step(Turn(initial, fault))
        _, cost = found.finish()
        assert (cost, "".join(edits)) == cheapest(turns)


def test_edits_come_out_as_they_become_certain():
    rng, edits, most = random.Random(4), [], 0
    found = Survivors(lambda edit, turn: edits.append(edit))
    for n in range(20_000):
        fault = "truncated" if rng.random() < 0.1 else None
        found.step(Turn("ua"[n % 2] if rng.random() < 0.9 else "s", fault))
        most = max(most, found.unresolved())
    assert most < 200 and len(edits) > 19_000


def test_passage_costs_equal_survivors():
    rng = random.Random(5)
    for _ in range(200):
        turns = [Turn(*t) for t in turns_of(rng, rng.randint(1, 6))]
        table = survivors.passage_costs(turns)
        for entry in survivors.STATES:
            found = Survivors(lambda edit, turn: None, entry)
            for turn in turns:
                found.step(turn)
            total = min(c + e for c, e in zip(table[entry], survivors.ENDING, strict=True))
            assert found.finish()[1] == total


def test_edits_are_a_table_of_repaired_rows(llm):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "More."), (1, 2, "assistant", "So."), (1, 3, "x", "")]
    found = conversations.repair(llm.createDataFrame(rows, SCHEMA)).edits.orderBy("step").collect()
    assert [r.edit for r in found] == ["D", "K", "K", "D"]
    assert [(r.role, r.text) for r in found if r.role] == [("user", "More."), ("assistant", "So.")]
    assert [r.fault for r in found] == [None, None, None, "blank"]


def test_very_long_text_and_extra_columns(llm):
    rows = [(5, 0, "user", "long " * 400_000 + "."), (5, 1, "assistant", "Yes.")]
    frame = llm.createDataFrame([(*r, 1, "b") for r in rows], SCHEMA + ", block int, edit string")
    assert run(frame) == expect_all(rows)
    assert run(frame, block_bytes=1000) == expect_all(rows)


def test_all_rows_dropped_and_empty_table(llm):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = llm.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA)
    assert run(frame) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert run(llm.createDataFrame([], SCHEMA)) == []
