"""Conversation structure repair by iterative-deepening A*.

A conversation is legal if the initials of its roles are ``(s?(ua)+)?``: an optional system turn, then
user and assistant in turn. Each turn is kept, given the role of user or assistant, or deleted, and empty
turns of either can be inserted; every edit has a cost. The search goes depth first through the
edits in the order of their initials (Delete, Insert, Keep, Rerole), under a bound that starts
at a lower bound of the cost and grows to the least that was beyond it. A table keeps, for each
state that failed, the cost that it needs at least: it is not entered again with less. The
first accepting path is the cheapest, and of those the one whose initials come first.

Conversations of more than 64 turns are searched in blocks of 64, from each role that may come
before to each that may come last, and the blocks' paths are joined; this gives the same path, in time
that grows with the number of turns.

Spark damages rows, tells blank and truncated ones and sorts each conversation's turns; a task
takes one conversation at a time. A conversation is one text to the digest, so it is the least
unit: a task holds the turns of one.

Cases: nulls of role and text count as one space; a null turn comes first and makes no gap; a null id
is an id; turns with the same number are ordered by role, then text; a role whose initial is none
of s, u and a (an empty one too) can't be kept; a conversation without rows has zeros, an empty audit and no
turns; repeated rows are duplicates; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import mapped, with_row

BLOCK = 64
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
NONE, SYSTEM, USER, ASSISTANT = range(4)  # the last role so far
NEXT = [USER, USER, ASSISTANT, USER]  # the role of user and assistant that may follow
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): rows with faults put in by a hash of conversation and turn.

    Of twenty hash values, 0 drops a row (it is not present), 1 empties its text, 2 takes the end
    marks out of it, 3 repeats it and 4 makes it the user's.
    """
    space = F.lit(" ")
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), space)
    kind = F.pmod(F.crc32(F.concat(filled(conv_id), F.lit(":"), filled(turn)).cast("binary")), F.lit(20))
    rows = rows.select(
        F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        filled(role).alias("role"), filled(text).alias("text"), kind.alias("kind"),
    )
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    ).drop("again")


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


class Search:
    """The cheapest path over ``rows`` (role, must go, is cut) from ``start`` to one of ``ends``."""

    def __init__(self, rows: list[tuple[int, bool, bool]], start: int, ends: tuple[int, ...]):
        self.rows, self.start, self.ends = rows, start, ends
        least = [0] * (len(rows) + 1)  # what each turn costs at least
        for i in range(len(rows) - 1, -1, -1):
            least[i] = least[i + 1] + (DELETE if rows[i][1] else CUT if rows[i][2] else 0)
        self.needs = {(i, s): least[i] for i in range(len(rows)) for s in range(4)}
        for s in range(4):
            steps, at = 0, s
            while at not in ends and steps < 3:
                steps, at = steps + 1, NEXT[at]
            self.needs[len(rows), s] = INSERT * steps if at in ends else NEVER

    def edits(self, i: int, last: int) -> Iterator[tuple[str, int, int, int]]:
        """(initial, cost, next row, next state) in the order of their initials."""
        role, gone, cut = self.rows[i] if i < len(self.rows) else (None, True, False)
        if i < len(self.rows):
            yield "D", DELETE, i + 1, last
        yield "I", INSERT, i, NEXT[last]
        if not gone:
            if role == NEXT[last] or (role == SYSTEM and last == NONE):
                yield "K", CUT * cut, i + 1, role
            yield "R", REROLE + CUT * cut, i + 1, NEXT[last]

    def _within(self, i: int, last: int, rest: int, path: list[str]) -> bool:
        if i == len(self.rows) and last in self.ends:
            return True
        beyond = NEVER
        for initial, cost, j, then in self.edits(i, last):
            need = cost + self.needs[j, then]
            if need <= rest:
                path.append(initial)
                if self._within(j, then, rest - cost, path):
                    return True
                path.pop()
                need = cost + self.needs[j, then]
            beyond = min(beyond, need)
        self.needs[i, last] = max(beyond, self.needs[i, last])
        return False

    def path(self) -> tuple[int, str] | None:
        """The cost and the initials, or None if no path leads there."""
        while (bound := self.needs[0, self.start]) < NEVER:
            path: list[str] = []
            if self._within(0, self.start, bound, path):
                return bound, "".join(path)
        return None


def cheapest(rows: list[tuple[int, bool, bool]]) -> tuple[int, str]:
    """The cost and the initials of the edits that make a whole conversation legal."""
    if len(rows) <= BLOCK:
        return Search(rows, NONE, (NONE, ASSISTANT)).path()
    best = {NONE: (0, "")}
    for k in range(0, len(rows), BLOCK):
        block, met = rows[k : k + BLOCK], {}
        system = any(role == SYSTEM and not gone for role, gone, _ in block)
        for start, (cost, path) in best.items():
            for end in range(4):
                if end == NONE != start or (end == SYSTEM != start and not (start == NONE and system)):
                    continue
                more, edits = Search(block, start, (end,)).path()
                met[end] = min(met.get(end, (NEVER, "")), (cost + more, path + edits))
        best = met
    return min(best[end] for end in (NONE, ASSISTANT) if end in best)


def _repaired(turns: list[tuple]) -> dict:
    """What the rows (turn, role, text, blank, truncated) of a conversation come to."""
    seen, rows, faults = set(), [], [0, 0, 0]
    for _, role, text, blank, truncated in turns:
        again = (role, text) in seen
        seen.add((role, text))
        fault = 0 if blank else 1 if again else 2 if truncated else None
        if fault is not None:
            faults[fault] += 1
        rows.append((INITIALS.get(role[:1]), fault in (0, 1), fault == 2))
    numbers = [t[0] for t in turns if t[0] is not None]
    cost, audit = cheapest(rows)
    made, last, i = [], NONE, 0
    for edit in audit:
        if edit == "I":
            made.append((ROLES[NEXT[last]], ""))
        elif edit != "D":
            made.append((turns[i][1] if edit == "K" else ROLES[NEXT[last]], turns[i][2]))
        if edit != "D":
            last = rows[i][0] if edit == "K" else NEXT[last]
        i += edit != "I"
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        "blank": faults[0],
        "duplicate": faults[1],
        "truncated": faults[2],
        "illegal": sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(turns, turns[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "turns": [{"role": role, "text": text} for role, text in made],
    }


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
MADE = pa.struct(
    [(c, pa.int64()) for c in COUNTS]
    + [("audit", pa.string()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
)
_MADE = f"struct<{','.join(f'{c}:bigint' for c in COUNTS)},audit:string,turns:array<struct<role:string,text:string>>>"
AT_ONCE = 256  # conversations of a batch that leaves a task


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; one may go on in the next batch."""
    kind, ids, made = None, [], []
    held: list[tuple] = []
    begun = False

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(made, MADE)], ["conv", "made"])
        ids.clear()
        made.clear()
        return batch

    for batch in batches:
        kind = batch.schema.field("conv").type
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "blank", "truncated", "present")]
        for conv, *turn, present in zip(*columns, strict=True):
            if not begun or conv != ids[-1]:
                if begun:
                    made.append(_repaired(held))
                    held = []
                if len(made) >= AT_ONCE:
                    yield out()
                ids.append(conv)
                begun = True
            if present:
                held.append(tuple(turn))
    if begun:
        made.append(_repaired(held))
        yield out()


def repaired(rows: DataFrame) -> DataFrame:
    """(conv, made) for each conversation of ``rows`` (conv, turn, role, text, present): counts of faults,
    the cost and the initials of the edits, and the ``turns`` that they leave.
    """
    told = rows.select("conv", "turn", "role", "text", _blank(F.col("text")).alias("blank"), _truncated(F.col("text")).alias("truncated"), "present")
    dealt = told.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return mapped(dealt, _conversations, with_row(rows, f"made {_MADE}", "conv"))


def op13(conversations: DataFrame) -> DataFrame:
    """The registered query: damaged conversations, their faults and their repair."""
    said = F.transform("made.turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return repaired(damaged(conversations.select("conv_id", "turn", "role", "text"))).select(
        F.col("conv").alias("conv_id"),
        *[f"made.{c}" for c in (*COUNTS, "audit")],
        F.sha2(F.array_join(said, "\n").cast("binary"), 256).alias("repaired_sha256"),
    )
