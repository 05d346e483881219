"""Repair of conversations: Wagner-Fischer alignment to the alternating grammar of roles.

A conversation's role initials must read ``(s?(ua)+)?``. Edits: Keep costs 0; Rerole (to user
or assistant) 3; Delete 4; Insert (an empty user or assistant turn, anywhere) 3. A row that is
kept or reroled though truncated costs 3 more; blank and duplicate rows must be deleted.

1. Rows become one mark each: role initial and fault, with texts as hashes. Equal rows of a
   turn are counted before they are shuffled; a text's first turn is found by aggregation and
   joined back by (conversation, turn, hash), so no key of these shuffles is larger than a
   turn. The marks of a conversation then pass one task as a sorted stream.
2. Required deletions leave the alignment, as they cost 4 wherever they stand. What is left is
   aligned in blocks of ``BLOCK_ROWS``: for every state in which a block can be entered, its
   rows are aligned with each feasible length of the grammar's string. Lengths come nearest
   first, and one is feasible as long as its difference alone does not exceed the incumbent
   cost; the same bound cuts the table to Ukkonen's band. Of the alignments that leave a block
   in the same state the cheapest stays, of equally cheap ones that with the least backtraced
   audit. Costs are summed from the last block back, then audits are chosen from the first on.
   Blocks change nothing: an audit that ends with a row is never the beginning of another.
3. The audits lead the texts of their conversations through a second sorted stream, which
   writes the repaired turns.

Only a byte for each row of a conversation meets in one task, as its audit is one value; texts
are streamed. Rows of a turn are ordered by role, then by the hash of role and text (MD5).
Turns that are null come first, a null role or text is one space, and null ids are a
conversation like any other. A role of any length or script is legal only by its initial. Empty
tables give empty results, ids without rows an empty audit; columns other than the four are
not read. Repeated rows are duplicates of the first. Texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clicktide.llm.common import tasks_for

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK_ROWS = 16
BLANK_CHARS = " \t\n\x0b\f\r"
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NEVER = 1 << 40


def _follows(entry: str, length: int) -> list[str]:
    """The grammar's strings of this length after a turn with initial ``entry`` ('': none)."""
    def alternating(first: str, n: int) -> str:
        return ((first + ("a" if first == "u" else "u")) * (n // 2 + 1))[:n]

    plain = alternating("a" if entry == "u" else "u", length)
    return [plain] if entry or not length else ["s" + alternating("u", length - 1), plain]


def _distance(rows: int, turns: int) -> int:
    """What it costs at least to make so many turns of so many rows."""
    return DELETE * (rows - turns) if rows > turns else INSERT * (turns - rows)


def _kept_as(mark: str, turn: str) -> int:
    """Cost of a row in the place of a turn."""
    extra = TRUNCATED if mark.isupper() else 0
    if mark.lower() == turn:
        return extra
    return REROLE + extra if turn in ROLES else _NEVER


def _align(marks: str, target: str, bound: int, to_the_end: bool) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest alignment, if it costs no more than ``bound``.

    Without ``to_the_end`` no turn is inserted behind the last row.
    """
    rows, turns = len(marks), len(target)
    rest = [[_NEVER] * (turns + 2) for _ in range(rows + 2)]
    for i in range(rows, -1, -1):
        for j in range(turns, -1, -1):
            if _distance(i, j) + _distance(rows - i, turns - j) > bound:
                continue  # outside the band
            best = 0 if (i, j) == (rows, turns) else _NEVER
            if i < rows:
                best = min(best, DELETE + rest[i + 1][j])
                if j < turns:
                    best = min(best, _kept_as(marks[i], target[j]) + rest[i + 1][j + 1])
            if j < turns and target[j] in ROLES and (i < rows or to_the_end):
                best = min(best, INSERT + rest[i][j + 1])
            rest[i][j] = best
    if rest[0][0] > bound or rest[0][0] >= _NEVER:
        return None
    i = j = 0
    audit = []
    while (i, j) != (rows, turns):
        left = rest[i][j]
        if i < rows and left == DELETE + rest[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < turns and target[j] in ROLES and (i < rows or to_the_end) and left == INSERT + rest[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if marks[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


@lru_cache(maxsize=100_000)
def _block(marks: str, entry: str, to_the_end: bool) -> dict[str, tuple[int, str]]:
    """Cost and audit by the state in which a block is left, for each that can be the best."""
    found: dict[str, tuple[int, str]] = {}
    lengths = sorted(range(2 * len(marks) + 4), key=lambda n: _distance(len(marks), n))
    for length in lengths:
        nearest = _distance(len(marks), length)
        if length > 1 and "u" in found and "a" in found:
            if nearest > max(found["u"][0], found["a"][0]):
                continue
        for target in _follows(entry, length):
            state = target[-1:] or entry
            incumbent = found[state][0] if state in found else _NEVER - 1
            if nearest > incumbent or (to_the_end and state not in ("", "a")):
                continue
            aligned = _align(marks, target, incumbent, to_the_end)
            if aligned and (state not in found or aligned < found[state]):
                found[state] = aligned
    return found


def cheapest_edits(marks: str) -> tuple[int, str]:
    """Cost and audit for a conversation's marks: s, u, a or x, in capitals if truncated."""
    blocks = [marks[i : i + BLOCK_ROWS] for i in range(0, len(marks), BLOCK_ROWS)] or [""]
    after = {"": 0, "a": 0}
    to_go = [after]
    for number in range(len(blocks) - 1, -1, -1):
        to_the_end = number == len(blocks) - 1
        costs = {}
        for entry in ("", "s", "u", "a"):
            ways = _block(blocks[number], entry, to_the_end).items()
            totals = [cost + after[state] for state, (cost, _) in ways if state in after]
            if totals:
                costs[entry] = min(totals)
        after = costs
        to_go.append(after)
    to_go.reverse()
    state, audit = "", []
    for number, block in enumerate(blocks):
        ways = _block(block, state, number == len(blocks) - 1)
        left = to_go[number][state]
        _, chosen, state = min(
            (cost + to_go[number + 1][to], edits, to)
            for to, (cost, edits) in ways.items()
            if cost + to_go[number + 1].get(to, _NEVER) == left
        )
        audit.append(chosen)
    return to_go[0][""], "".join(audit)


def audit_of(sequence: str) -> tuple[int, str]:
    """Cost and audit of marks among which ``d`` is a row that must be deleted."""
    kept = sequence.replace("d", "")
    cost, edits = cheapest_edits(kept)
    if len(kept) == len(sequence):
        return cost, edits
    audit, at = [], 0
    for mark in sequence:
        if mark == "d":
            audit.append("D")
            continue
        upto = at
        while edits[upto] == "I":
            upto += 1
        audit.append(edits[at : upto + 1])
        at = upto + 1
    audit.append(edits[at:])
    return cost + DELETE * (len(sequence) - len(kept)), "".join(audit)


class _Marks:
    """What one conversation's rows, in order, say about it."""

    def __init__(self) -> None:
        self.sequence: list[str] = []
        self.stats = dict.fromkeys(STATS, 0)
        self.lowest = self.latest = None
        self.turns = 0
        self.role = ""

    def add(self, turn, role: str, fault: str, is_first: bool, copies: int) -> None:
        if turn is not None and turn != self.latest:
            self.lowest = turn if self.lowest is None else self.lowest
            self.latest, self.turns = turn, self.turns + 1
        if self.role:
            self.stats["illegal"] += self.role + role not in LEGAL_PAIRS
        self.stats["illegal"] += (copies - 1) * (role + role not in LEGAL_PAIRS)
        self.role = role
        if fault == "blank":
            self.stats["blank"] += copies
            self.sequence.append("d" * copies)
            return
        repeats = copies - is_first
        self.stats["duplicate"] += repeats
        if is_first:
            self.stats["truncated"] += fault == "truncated"
            self.sequence.append(role.upper() if fault == "truncated" else role)
        self.sequence.append("d" * repeats)

    def row(self) -> dict:
        if self.turns:
            self.stats["gaps"] = self.latest - self.lowest + 1 - self.turns
        self.stats["cost"], audit = audit_of("".join(self.sequence))
        return {**self.stats, "audit": audit}


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names))


def _audit_stream(id_type: pa.DataType):
    """One row for each conversation of a partition that is sorted by conversation."""
    schema = pa.schema(
        [("conv_id", id_type), *((name, pa.int64()) for name in STATS), ("audit", pa.string())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, marks = None, None
        for batch in batches:
            done = []
            rows = _columns(batch, "conv_id", "turn", "mark", "fault", "is_first", "copies")
            for conv, turn, role, fault, is_first, copies in rows:
                if marks is None or conv != now:
                    if marks is not None:
                        done.append({"conv_id": now, **marks.row()})
                    now, marks = conv, _Marks()
                if copies:
                    marks.add(turn, role, fault, is_first, copies)
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if marks is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now, **marks.row()}], schema=schema)

    return read


def _cleaned(turns: DataFrame) -> DataFrame:
    """The four columns without null texts, and the hash that tells role and text apart."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "key", F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    )


def _fault() -> Column:
    last = F.substring(F.rtrim("text", F.lit(BLANK_CHARS)), -1, 1)
    return (
        F.when(last == "", "blank")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("none")
    )


def audits(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` per conversation.

    ``conversations`` (``conv_id``, repeated or not) adds ids that have no rows.
    """
    initial = F.substring("role", 1, 1)
    facts = (
        _cleaned(turns)
        .withColumns({
            "mark": F.when(initial.isin("s", "u", "a"), initial).otherwise("x"), "fault": _fault(),
        })
        .groupBy("conv_id", "turn", "role", "key")
        .agg(F.min("mark").alias("mark"), F.min("fault").alias("fault"), F.count("*").alias("copies"))
    )
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    firsts = facts.groupBy("conv_id", "key").agg(F.min(place).alias("first"))
    firsts = firsts.select(
        F.col("conv_id").alias("of"), F.col("key").alias("key_of"), F.col("first.turn").alias("first")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("of"))
        & F.col("turn").eqNullSafe(F.col("first"))
        & (F.col("key") == F.col("key_of"))
    )
    marked = facts.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "key", "mark", "fault", "copies",
        F.col("key_of").isNotNull().alias("is_first"),
    )
    if conversations is not None:
        ids = conversations.select("conv_id").distinct()
        marked = marked.unionByName(
            ids.withColumn("copies", F.lit(0).cast("long")), allowMissingColumns=True
        )
    id_type = facts.schema["conv_id"].dataType
    stats = ", ".join(f"{name} long" for name in STATS)
    return (
        marked.repartition(tasks_for(turns), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "key")
        .mapInArrow(
            _audit_stream(_arrow(id_type)), f"conv_id {id_type.simpleString()}, {stats}, audit string"
        )
    )


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Role, text and edit of the turns that an audit leaves of the rows."""
    before = ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if before == "u" else "u"]
        before = role[:1]
        yield role, text, edit


def _repair_stream(schema: pa.Schema, names: tuple[str, ...], most_bytes: int = 4 << 20):
    """The repaired turns of a partition in which a conversation's audit precedes its rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_rows() -> Iterator[tuple]:
            for batch in batches:
                yield from _columns(batch, "is_row", "role", "text", *names)

        rows = all_rows()
        held, size = [], 0
        for row in rows:
            # every row behind its audit is consumed by it, so this one is an audit
            fields = dict(zip(names, row[3:]))
            held.append({**fields, "place": 0})
            texts = ((next_row[1], next_row[2]) for next_row in rows)
            place = 0
            for role, text, edit in _edited(fields["audit"], texts):
                place += 1
                held.append(
                    {"conv_id": fields["conv_id"], "place": place, "role": role, "text": text, "edit": edit}
                )
                size += len(text)
                if size > most_bytes or len(held) >= 2000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return read


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text, edit`` and the audit's columns.

    Place 0 is the conversation's row of ``audits``, the others are its turns in order, with
    the edit that made them (K, R or I). A conversation's rows are neighbours in one partition.
    """
    names = ("conv_id", *STATS, "audit")
    heads = audited.select(*names).withColumn("is_row", F.lit(False))
    rows = _cleaned(turns).withColumn("is_row", F.lit(True))
    kind = turns.schema["conv_id"].dataType
    stats = ", ".join(f"{name} long" for name in STATS)
    layout = f"conv_id {kind.simpleString()}, place long, role string, text string, edit string, {stats}, audit string"
    schema = pa.schema([
        ("conv_id", _arrow(kind)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("edit", pa.string()), *((name, pa.int64()) for name in STATS), ("audit", pa.string()),
    ])
    return (
        heads.unionByName(rows, allowMissingColumns=True)
        .repartition(tasks_for(turns), "conv_id")
        .sortWithinPartitions("conv_id", "is_row", "turn", "role", "key")
        .select("is_row", "role", "text", *names)
        .mapInArrow(_repair_stream(schema, names), layout)
    )
