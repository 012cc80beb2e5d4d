"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, in order of turn, are edited until the initials of
their roles read ``(s?(ua)+)?``: each row is kept, given the role that fits, or
deleted, and empty rows are inserted. Depth-first search tries edits in ASCII
order of their initials (Delete, Insert, Keep, Rerole) under a cost bound that
rises to the least cost still open; a transposition table keeps, for each row
and grammar state, the cost that a failed search has proved to be missing. The
first accepting path is the cheapest and, among those, the ASCII-least.

Three jobs, none of which holds a conversation's texts in memory:

1. rows become faults: a row that repeats an earlier role and text is found by
   a hash aggregate over (conversation, text hash), joined back;
2. rows sorted by conversation and turn stream through tasks as one byte each.
   The search runs over segments of a few rows from the last to the first,
   each with the exact cost to go behind it, so its work is linear in the
   rows and its depth bounded; edits before a segment's rows belong to it, so
   segment paths join to the ASCII-least path of the whole;
3. the edits and the rows stream once more in the same order, to hash the
   repaired text.

The result has one string of edits and one hash over all texts a conversation,
so each conversation's stream passes one task by contract, in slices; that task
keeps a byte a row.

Defined cases: null ids, turns, roles and texts are one space for the damage
and in the repaired text; null turns come first, null conv_ids are one
conversation. Rows of one turn (repeated rows, ties) stand by role, then text,
after the damage. An empty role, or another initial than s, u, a, can't be
kept as it is. A conversation that lost all rows has zeros, no edits and the
hash of the empty string; an empty table gives no rows. Very long texts and
conversations are streamed. Other columns, also of clashing names, are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import BLANKS, slices, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEVER = 1 << 60
#: grammar states: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> {role initial: next state}
GRAMMAR = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT},
           ASSISTANT: {"u": USER}}
ROLES = {"u": "user", "a": "assistant"}
#: behind the last row: state -> inserts that end the conversation well
ENDINGS = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: rows of a segment: the search runs once for each, whatever the conversation
SEGMENT = 16
LEGAL = ["su", "ua", "au"]

# a row is one byte: its initial (s, u, a, other) and 4 times its kind
INITIALS = "sua"
SOUND, LOST, CUT = 0, 1, 2  # kept freely; must go (blank, duplicate); truncated


def edits(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, next state, rows used) of the edits at a row, in ASCII order."""
    kind, initial = code >> 2, "sua?"[code & 3]
    fits = next(iter(x for x in GRAMMAR[state] if x != "s"))
    found = [("D", DELETE, state, 1), ("I", INSERT, GRAMMAR[state][fits], 0)]
    if kind != LOST:
        more = TRUNCATED if kind == CUT else 0
        if initial in GRAMMAR[state]:
            found.append(("K", KEEP + more, GRAMMAR[state][initial], 1))
        if initial != fits:
            found.append(("R", REROLE + more, GRAMMAR[state][fits], 1))
    return found


EDITS = {(code, state): edits(code, state) for code in range(12) for state in range(4)}
LEAST = {SOUND: 0, LOST: DELETE, CUT: min(TRUNCATED, DELETE)}


@lru_cache(100_000)
def segment(codes: bytes, behind: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """For each state before the rows ``codes``: least cost to the end, given the
    costs ``behind`` them, the edits inside, and the state after them."""
    n, floor = len(codes), min(behind)
    ahead = [0] * (n + 1)  # what the rows' own faults cost at least
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + LEAST[codes[i] >> 2]
    missing: dict[tuple[int, int], int] = {}  # transposition table of failed states
    path: list[str] = []
    end = [START]

    def search(i: int, state: int, left: int) -> int:
        """0 if an accepting path costs at most ``left``, else the cost proved missing."""
        if i == n:
            end[0] = state
            return 0 if behind[state] <= left else behind[state]
        least = missing.get((i, state), ahead[i] + floor)
        if least > left:
            return least
        least = NEVER
        for name, cost, nxt, used in EDITS[codes[i], state]:
            if cost > left:
                least = min(least, cost)
                continue
            path.append(name)
            below = search(i + used, nxt, left - cost)
            if not below:
                return 0
            path.pop()
            least = min(least, cost + below)
        missing[i, state] = least
        return least

    found = []
    for state in range(4):
        bound = missing.get((0, state), ahead[0] + floor)
        path.clear()
        while open_cost := search(0, state, bound):
            bound = open_cost
        found.append((bound, "".join(path), end[0]))
    return tuple(found)


def repair(codes: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least cheapest edits of a conversation's rows."""
    behind = tuple(INSERT * ENDINGS[s] for s in range(4))
    plans = []
    for a in range(max(0, len(codes) - 1) // SEGMENT * SEGMENT, -1, -SEGMENT):
        plan = segment(codes[a:a + SEGMENT], behind)
        plans.append(plan)
        behind = tuple(cost for cost, _, _ in plan)
    state, parts = START, []
    for plan in reversed(plans):
        _, part, state = plan[state]
        parts.append(part)
    return behind[START], "".join(parts) + "I" * ENDINGS[state]


# Spark ---------------------------------------------------------------------------
def spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` of the rows that the damage leaves."""
    lot = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                lot.alias("lot")).where("lot <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("lot") == 3, 2).otherwise(1).alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """The rows with ``mark`` (role and text, hashed), ``late`` (an earlier turn
    has the same mark), ``blank`` and ``open`` (the last sign ends no sentence)."""
    rows = rows.withColumn("mark", F.md5(F.concat_ws("\x00", "role", "text")))
    conv = F.col("conv_id").eqNullSafe(F.col("_c"))
    first = (rows.groupBy(F.col("conv_id").alias("_c"), F.col("mark").alias("_m"))
             .agg(F.sum("copies").alias("_n"), F.min("turn").alias("_low"),
                  F.max(F.col("turn").isNull()).alias("_null")).where("_n > 1"))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    late = F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_low"))
    return (rows.join(first, conv & (F.col("mark") == F.col("_m")), "left")
            .select("conv_id", "turn", "role", "text", "copies", "mark",
                    F.coalesce(late, F.lit(False)).alias("late"),
                    (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("open")))


def in_order(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows behind their conversation's head, sorted inside tasks by conversation."""
    both = heads.withColumn("head", F.lit(True)).unionByName(
        rows.withColumn("head", F.lit(False)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("head").desc(), F.col("turn").asc_nulls_first(), "role", "text")


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
#: bytes of edits that wait for a record batch
WAIT = 1 << 20


class Conversation:
    """What one conversation's rows leave behind, a byte a row."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.before, self.initial = conv_id, bytearray(), None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, turn, initial, copies, mark, late, blank, open_):
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        late = late or (turn, mark) == self.before
        self.turn, self.before = turn, (turn, mark)
        for _ in range(copies):
            self.illegal += self.initial is not None and self.initial + initial not in LEGAL
            self.initial = initial
            kind = LOST if blank or late else CUT if open_ else SOUND
            self.blank += blank
            self.duplicate += late and not blank
            self.truncated += kind == CUT
            self.codes.append((INITIALS.find(initial) if initial in ("s", "u", "a") else 3) | kind << 2)
            late = True

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = repair(bytes(self.codes)) if self.codes else (0, "")
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def tabled(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * len(COUNTS), *[pa.string()] * (len(names) - len(COUNTS) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> a row a conversation, with its cheapest edits."""
    now, done, waiting, kind = None, [], 0, None
    names = ["conv_id", *COUNTS, "audit"]
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, head, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if head:
                if now:
                    done.append(now.result())
                    waiting += len(done[-1][-1]) + 64
                now = Conversation(conv_id)
                if waiting > WAIT:
                    yield tabled(done, kind, names)
                    done, waiting = [], 0
            else:
                now.add(*row)
    if now:
        yield tabled([*done, now.result()], kind, names)


class Repaired:
    """The hash of a conversation's repaired rows, as they come."""

    def __init__(self, values: list, audit: str):
        self.values, self.audit, self.at, self.state = values, audit, 0, START
        self.hash, self.any = hashlib.sha256(), False

    def put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "replace"))
        self.any = True

    def step(self, initial: str) -> str:
        self.state = GRAMMAR[self.state][initial]
        return ROLES.get(initial, initial)

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(self.step(next(x for x in GRAMMAR[self.state] if x != "s")), "")
            self.at += 1

    def add(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.step(role[0])
                self.put(role, text)
            elif edit == "R":
                self.put(self.step(next(x for x in GRAMMAR[self.state] if x != "s")), text)

    def result(self) -> tuple:
        self.inserted()
        return *self.values, self.audit, self.hash.hexdigest()


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows behind their conversation's edits -> the edits and the hash."""
    now, done, waiting, kind = None, [], 0, None
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    for batch in slices(batches):
        kind = batch.schema.field("conv_id").type
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for i, head in enumerate(columns["head"]):
            if head:
                if now:
                    done.append(now.result())
                    waiting += len(done[-1][-2]) + 128
                now = Repaired([columns[c][i] for c in ("conv_id", *COUNTS)], columns["audit"][i])
                if waiting > WAIT:
                    yield tabled(done, kind, names)
                    done, waiting = [], 0
            else:
                now.add(columns["role"][i], columns["text"][i], columns["copies"][i])
    if now:
        yield tabled([*done, now.result()], kind, names)


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, the counts of faults, cost and initials of the cheapest edits,
    and the hash of the repaired rows of every conversation."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    rows = stored(faults(damaged(conversations)), "conversations")
    kind = dict(conversations.dtypes)["conv_id"]
    out = f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string"
    ids = conversations.select("conv_id").distinct()
    plans = in_order(rows, ids).select(
        "conv_id", "head", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "mark", "late",
        "blank", "open").mapInArrow(searched, out)
    order = ["conv_id", "head", *COUNTS, "audit", "role", "text", "copies"]
    return in_order(rows.select("conv_id", "turn", "role", "text", "copies"), plans).select(*order).mapInArrow(
        hashed, out + ", repaired_sha256 string")
