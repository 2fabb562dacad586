"""Repair of conversation structure by depth-first branch-and-bound.

A conversation is sound if its role initials read ``(s?(ua)+)?`` and no turn is blank or
said before. Each row is kept (K, cost 0), gets the role user or assistant (R, 3) or is
deleted (D, 4; required for blank and duplicate rows), and empty user or assistant turns
may be inserted anywhere (I, 3); a truncated row that stays costs 3 more. Wanted is the
cheapest series of edits, of equally cheap ones the one whose letters come first.

The search walks prefixes of edits with an explicit stack. A node is (rows consumed, what
the roles so far allow). Suffix lower bounds, computed backwards over the rows, are the
least cost of the remaining rows from each node with the order of the letters left out; a
prefix whose cost plus bound does not beat the incumbent (cost, audit) is cut, and so is
one that reaches a node again at no lower cost (the dominance table keeps each node's
least). Children are tried by bound, then by letter, so the first leaf already is the
answer and the rest of the stack only proves it: time and memory are linear in the rows.

Rows are dealt by conversation and sorted in Spark; every task reads its conversations as a
stream in which each one comes twice, first as one byte a row for the search and then with
its texts, to which the edits are applied row by row. So a conversation's texts are never
held together, and one that has a third of all rows needs about 65 bytes a row of one task
(its edits depend on each other, and its digest is one SHA-256 over its rows in order).

Defined cases: a null role or text is one space. A row whose role has another first letter
than s, u or a, or none, cannot be kept. Rows are ordered by turn (nulls first), equal
turns by role and text. Null conv_ids are one conversation. A conversation without rows
has cost 0 and no edits. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import WORD, map_arrow

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)  # a row's first fault
SYSTEM, USER, ASSISTANT, OTHER = range(4)  # a role's initial
# What the roles so far are: none, a system turn, up to a user turn, up to an assistant turn.
NONE, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_NEXT = {NONE: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}
_ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
_KEPT = {(NONE, SYSTEM): AFTER_SYSTEM, (NONE, USER): AFTER_USER, (AFTER_SYSTEM, USER): AFTER_USER,
         (AFTER_USER, ASSISTANT): AFTER_ASSISTANT, (AFTER_ASSISTANT, USER): AFTER_USER}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def edits(code: int, state: int) -> list[tuple[bytes, int, int]]:
    """(letter, cost, next state) of the edits that consume a row in a state."""
    initial, fault = code >> 2, code & 3
    out = [(b"D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT_OFF else 0
        kept = _KEPT.get((state, initial))
        if kept is not None:
            out.append((b"K", KEEP + more, kept))
        out.append((b"R", REROLE + more, _NEXT[state]))
    return out


# The edits of the 16 kinds of row in the 4 states.
_EDITS = [[edits(code, state) for state in range(4)] for code in range(16)]


def suffix_bounds(codes: bytes) -> array:
    """Least cost of the rows from i on in state s, at 4 * i + s."""
    n = len(codes)
    out = array("q", bytes(32 * (n + 1)))
    for i in range(n, -1, -1):
        if i == n:
            cost = [0, 2 * INSERT, INSERT, 0]
        else:
            after = out[4 * i + 4:4 * i + 8]
            cost = [min(c + after[to] for _, c, to in _EDITS[codes[i]][s]) for s in range(4)]
        for s in (AFTER_USER, AFTER_ASSISTANT, AFTER_USER, NONE, AFTER_SYSTEM):
            cost[s] = min(cost[s], INSERT + cost[_NEXT[s]])
        out[4 * i:4 * i + 4] = array("q", cost)
    return out


def cheapest(codes: bytes) -> tuple[int, bytes]:
    """(cost, letters) of the cheapest edits of a conversation; ``codes``: initial * 4 + fault of each row."""
    n, bound = len(codes), suffix_bounds(codes)
    least = array("q", [-1]) * (4 * (n + 1))  # dominance: the least cost that reached each node
    path = bytearray()
    incumbent: tuple[int, bytes] | None = None
    stack = [(0, NONE, 0, 0, b"")]
    while stack:
        i, state, cost, depth, letter = stack.pop()
        node = 4 * i + state
        if incumbent is not None and cost + bound[node] >= incumbent[0]:
            continue  # letters are tried in order, so an equal cost has later letters
        if least[node] >= 0 and least[node] <= cost:
            continue
        least[node] = cost
        del path[max(depth - 1, 0):]
        path += letter
        if i == n and state in (NONE, AFTER_ASSISTANT):
            incumbent = cost, bytes(path)
            continue
        children = [(INSERT + cost, b"I", i, _NEXT[state])]
        if i < n:
            children += [(cost + c, edit, i + 1, to) for edit, c, to in _EDITS[codes[i]][state]]
        children.sort(key=lambda x: (x[0] + bound[4 * x[2] + x[3]], x[1]), reverse=True)
        stack += [(at, to, c, depth + 1, edit) for c, edit, at, to in children]
    return incumbent


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage by crc32 of ``conv_id:turn`` modulo 20, nulls as one space: 0 drops the
    row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user.
    A dropped row stays as one without role and text, so that its conversation is known."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    harm = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    said = F.when(harm == 1, "").when(harm == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    marked = rows.select("conv_id", "turn", F.when(harm != 0, F.when(harm == 4, "user").otherwise(text("role"))).alias("role"),
                         F.when(harm != 0, said).alias("text"), harm.alias("harm"))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


_STREAM = ["conv_id", "phase", "turn", "role", "text", "code"]


def streamed(rows: DataFrame) -> DataFrame:
    """The rows dealt and sorted by conversation: all of one as codes, then all of it with texts.

    One shuffle, by conv_id; the windows and the sorts stay within its partitions and spill.
    Rows without a role are those that only name their conversation.
    """
    dealt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").repartition("conv_id")
    inside = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("place")
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(~F.col("text").rlike(WORD), BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
             .when(~end.isin(".", "!", "?"), CUT_OFF).otherwise(SOUND))
    coded = dealt.withColumn("place", F.row_number().over(inside)).withColumn("code", (initial * 4 + fault).cast("int"))
    twice = coded.select("*", F.explode(F.when(F.col("role").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("phase"))
    narrow = F.col("phase") == 0
    return (twice.withColumns({"text": F.when(~narrow, F.col("text")), "known": F.col("role").isNotNull()})
            .withColumn("role", F.when(~narrow, F.col("role")))
            .sortWithinPartitions("conv_id", "phase", "place").select(*_STREAM, "known"))


class Report:
    """Counts of a conversation's rows, taken in order."""

    def __init__(self):
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.low = self.high = self.last = None
        self.turns = 0

    def see(self, turn: int | None, code: int) -> None:
        self.faults[code & 3] += 1
        initial = code >> 2
        if self.before is not None and (self.before, initial) not in _LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


class Repaired:
    """One conversation: its report, then its repaired rows as its texts come by."""

    def __init__(self, conv_id):
        self.conv_id, self.report, self.codes = conv_id, Report(), bytearray()
        self.cost, self.audit = 0, b""
        self.at, self.state, self.solved = 0, NONE, False

    def see(self, turn, code) -> None:
        self.report.see(turn, code)
        self.codes.append(code)

    def solve(self) -> None:
        if not self.solved:
            self.cost, self.audit = cheapest(bytes(self.codes))
            self.solved = True

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns that are inserted here, as (edit, role, text)."""
        while self.at < len(self.audit) and self.audit[self.at:self.at + 1] == b"I":
            self.at, self.state = self.at + 1, _NEXT[self.state]
            yield "I", _ROLE[self.state], ""

    def apply(self, role: str, text: str, code: int) -> Iterator[tuple[str, str, str]]:
        """What becomes of the next row, with the turns inserted before it."""
        yield from self.inserted()
        letter = self.audit[self.at:self.at + 1]
        self.at += 1
        if letter != b"D":
            kept = letter == b"K"
            self.state = _KEPT[self.state, code >> 2] if kept else _NEXT[self.state]
            yield letter.decode(), role if kept else _ROLE[self.state], text


def _repair(batches) -> Iterator[tuple[Repaired, tuple[str, str, str] | None]]:
    """(conversation, repaired row) pairs in order; (conversation, None) ends each conversation."""
    now: Repaired | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_STREAM, "known")]
        for conv_id, phase, turn, role, text, code, known in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    now.solve()
                    yield from ((now, row) for row in now.inserted())
                    yield now, None
                now = Repaired(conv_id)
            if not phase:
                if known:
                    now.see(turn, code)
            else:
                now.solve()
                yield from ((now, row) for row in now.apply(role, text, code))
    if now is not None:
        now.solve()
        yield from ((now, row) for row in now.inserted())
        yield now, None


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, position, edit (K, R or I), role, text: the repaired conversations, turn by turn."""
    kind = rows.schema["conv_id"].dataType
    kinds = pa.schema([("conv_id", _arrow(kind)), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                       ("text", pa.string())])

    def run(batches):
        def turns():
            position = 0
            for conversation, row in _repair(batches):
                if row is None:
                    position = 0
                else:
                    yield conversation.conv_id, position, *row
                    position += 1
        yield from _batches(turns(), kinds)

    return map_arrow(streamed(rows), run, f"conv_id {kind.simpleString()}, position long, edit string, role string, text string")


def report(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    The digest is taken over the ``role:text`` lines of the repaired turns, as they are made.
    """
    kind = rows.schema["conv_id"].dataType
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = pa.schema([("conv_id", _arrow(kind)), *((n, pa.int64()) for n in names), ("audit", pa.string()),
                       ("repaired_sha256", pa.string())])

    def run(batches):
        def reports():
            sha, line = hashlib.sha256(), 0
            for conversation, row in _repair(batches):
                if row is not None:
                    sha.update(f"{chr(10) if line else ''}{row[1]}:{row[2]}".encode())
                    line += 1
                    continue
                r = conversation.report
                yield (conversation.conv_id, r.gaps, r.faults[BLANK], r.faults[DUPLICATE], r.faults[CUT_OFF], r.illegal,
                       conversation.cost, conversation.audit.decode(), sha.hexdigest())
                sha, line = hashlib.sha256(), 0
        yield from _batches(reports(), kinds)

    return map_arrow(streamed(rows), run, f"conv_id {kind.simpleString()}, " + ", ".join(f"{n} long" for n in names)
                     + ", audit string, repaired_sha256 string")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
