"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from functools import lru_cache

import pytest

from clicktide.llm import conversations, queries
from tests.llm.helpers import SF, empty, needs_data, rows_of

TURNS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\f\r"


@lru_cache(maxsize=None)
def search(sequence):
    """The cheapest edits with the least audit, by shortest paths over (row, last initial)."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(sequence) and state in ("", "a"):
            return cost, audit
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for turn in after:
            if turn != "s":
                heapq.heappush(queue, (cost + 3, audit + "I", i, turn))
        if i < len(sequence):
            mark = sequence[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state))
            if mark == "d":
                continue
            extra = 3 if mark.isupper() else 0
            for turn in after:
                if mark.lower() == turn:
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, turn))
                elif turn != "s":
                    heapq.heappush(queue, (cost + 3 + extra, audit + "R", i + 1, turn))
    raise AssertionError


def damage(rows):
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        role, text = name(role), name(text)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def brute(rows):
    """What the contract asks for, conversation by conversation."""
    result = {}
    after = list(damage(rows))
    for conv in {r[0] for r in rows}:
        mine = [r for r in after if r[0] == conv]
        hashed = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashed(r)))
        turns = {r[1] for r in mine if r[1] is not None}
        row = {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0}
        row |= dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        sequence, seen = "", set()
        for _, _, role, text in mine:
            bare = text.rstrip(BLANK)
            mark = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not bare:
                row["blank"] += 1
                sequence += "d"
            elif (role, text) in seen:
                row["duplicate"] += 1
                sequence += "d"
            elif bare[-1] not in ".!?":
                row["truncated"] += 1
                sequence += mark.upper()
            else:
                sequence += mark
            seen.add((role, text))
        row["illegal"] = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        row["cost"], row["audit"] = search(sequence)
        repaired, at = [], 0
        for edit in row["audit"]:
            last = repaired[-1][0][:1] if repaired else ""
            if edit == "K":
                repaired.append(mine[at][2:])
            elif edit in "IR":
                repaired.append(("assistant" if last == "u" else "user", mine[at][3] if edit == "R" else ""))
            at += edit != "I"
        row["repaired_sha256"] = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        result[conv] = row
    return result


def random_rows(seed, conversations_=60, most=9):
    rnd = random.Random(seed)
    rows = []
    for conv in range(conversations_):
        for turn in range(rnd.randint(1, most)):
            role = rnd.choice(["user", "assistant", ["user", "assistant"][turn % 2], "system", "tool", "", "u", None])
            text = rnd.choice(["Yes.", "No", "  ", "", None, f"word {rnd.random()}.", f"cut {turn}", "ok!\n", "é?"])
            rows.append((conv if conv else None, rnd.choice([turn, turn + conv % 3, None]), role, text))
    rnd.shuffle(rows)
    return rows


def op13(spark, folder, rows, layout=TURNS):
    spark.createDataFrame(rows, layout).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return queries.op13_conversation_repair(spark, folder)


@pytest.mark.parametrize("length", range(0, 6))
def test_all_short_sequences(length):
    marks = "suxUd" if length > 3 else "suaxSUAXd"
    sequences = [""]
    for _ in range(length):
        sequences = [s + m for s in sequences for m in marks]
    for sequence in sequences:
        assert conversations.audit_of(sequence) == search(sequence), sequence


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_blocks_change_nothing(monkeypatch, rows):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", rows)
    rnd = random.Random(rows)
    for _ in range(300):
        sequence = "".join(rnd.choice("ssuuaaxSUAXd") for _ in range(rnd.randint(0, 30)))
        assert conversations.audit_of(sequence) == search(sequence), sequence


def test_long_sequence():
    rnd = random.Random(5)
    sequence = "s" + "".join(rnd.choice("uauauauauaUAxd") for _ in range(3000))
    assert conversations.audit_of(sequence) == search(sequence)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, folder, seed):
    rows = random_rows(seed)
    got = {r["conv_id"]: r for r in rows_of(op13(spark, folder, rows))}
    assert got == brute(rows)


@needs_data
def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = rows_of(queries.op13_conversation_repair(spark, SF))
    assert {r["conv_id"]: r for r in got} == brute(rows) and len(got) == len({r[0] for r in rows})


def test_one_long_conversation(spark, folder):
    rows = [(7, t, ["user", "assistant"][t % 2], f"Text {t // 3}." if t % 5 else "cut") for t in range(2000)]
    got = rows_of(op13(spark, folder, rows + [(7, 4, "user", "Text 1.")] * 500 + [(8, 1, "user", "Hm.")]))
    assert {r["conv_id"]: r for r in got} == brute(rows + [(7, 4, "user", "Text 1.")] * 500 + [(8, 1, "user", "Hm.")])


def test_awkward_rows(spark, folder):
    rows = [(None, None, None, None, "x"), (1, None, "user", "long " * 200_000, "x"), (2, 1, "Ünï", "😀\x00.", None),
            (2, 1, "Ünï", "😀\x00.", None), (2**62, -5, "assistant", ".", "x"), (3, 2**40, "system", "", "x")]
    frame = spark.createDataFrame(rows, f"{TURNS}, cost string")
    for name in ("audit", "place", "is_row", "key", "copies", "is_first", "edit", "damage", "col"):
        frame = frame.withColumn(name, frame["cost"])
    frame.write.parquet(f"{folder}/conversations.parquet")
    got = {r["conv_id"]: r for r in rows_of(queries.op13_conversation_repair(spark, folder))}
    assert got == brute([r[:4] for r in rows])
    assert rows_of(conversations.audits(empty(frame))) == []
    assert rows_of(conversations.repaired(empty(frame), conversations.audits(empty(frame)))) == []


def test_turns_of_the_operator(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (1, 3, "assistant", "Yes."), (2, 1, "assistant", "No.")]
    turns = spark.createDataFrame(rows, TURNS)
    got = conversations.repaired(turns, conversations.audits(turns)).where("place > 0")
    made = sorted((r.conv_id, r.place, r.role, r.text, r.edit) for r in got.collect())
    assert made == [
        (1, 1, "user", "Hi.", "K"), (1, 2, "assistant", "", "I"), (1, 3, "user", "Well?", "K"),
        (1, 4, "assistant", "Yes.", "K"), (2, 1, "user", "", "I"), (2, 2, "assistant", "No.", "K"),
    ]
