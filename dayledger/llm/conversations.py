"""Repair of conversations: the cheapest edits that make turns alternate.

A legal conversation is empty, or one system turn at most and then user and assistant
in turns, an assistant last. Turns are kept (free), given the role user or assistant
(``REROLE``), deleted (``DELETE``; a must for blank ones and for repeats) or inserted
without text (``INSERT``); a turn that breaks off costs ``TRUNCATED`` unless deleted.

Rows are dealt by conversation and sorted by turn; tasks stream them and carry the
state of the dynamic program from one Arrow batch to the next, so no conversation is
held, however long. There are two such streams:

1. ``plan`` reads rows without their texts, last turn first, carries the least cost
   from each state to the end, and spills a byte a row: the best edit from each of four
   states. Every ``CHUNK`` rows these bytes leave as a row of a written table.
2. ``replay`` reads the texts, first turn first, among them the bytes at the places
   they are needed, and walks from the start state: edits and repaired text.

Looking from the end makes ties easy: of edits that cost the same, the least letter
gives the least audit, as each edit leaves one state only. The program's state is four
small numbers, few of which ever differ, so a step is a lookup of what is known of
(kind of row, state).

Defined cases: nulls of role and text count as one space, a null turn comes first, and
null ids are one conversation; rows of one turn follow each other by role and digest of
the text. A conversation without rows has zeros, no audit and an empty text. An empty
table gives no rows. Columns beside the four are not read.
"""

from __future__ import annotations

from collections import deque
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.common import partitions, stage

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows whose edits travel together: a byte each.
CHUNK = 1 << 16

#: States: nothing yet, system seen, user seen, assistant seen. The next role after
#: each is given, unless a system turn opens the conversation.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
FINAL = (START, ASSISTANT)
#: The state after a turn that is kept, by state and by class of its role.
S, U, A, OTHER = range(4)
KEPT = {(START, S): SYSTEM, (START, U): USER, (SYSTEM, U): USER, (USER, A): ASSISTANT, (ASSISTANT, U): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LETTERS = "DIKR"
D, I, K, R = range(4)
#: Faults, the first of a row counts.
NONE, BLANK, DUPLICATE, CUT = range(4)
LEGAL = {(S, U), (U, A), (A, U)}
NEVER = 1 << 30

SPACES = " \t\n\x0b\x0c\r"
KEY = ("conv_id", "turn", "role", "digest")
#: Where a row stands in its conversation; equal rows follow each other by number.
PLACE = (*KEY[1:], "nth")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults that a checksum of conversation and turn chooses:
    ``conv_id, turn, role, text`` and ``gone`` where a row is dropped."""
    blank = F.lit(" ")
    place = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(F.concat(place[0], F.lit(":"), place[1]).cast("binary")) % 20).cast("int").alias("fault"),
    )
    fault, text = F.col("fault"), F.col("text")
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault == 0).alias("gone"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the digest of their text; dropped ones keep their conversation only."""
    there = ~F.col("gone")
    return rows.select(
        "conv_id",
        *(F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")),
        F.when(there, F.unhex(F.sha2(F.col("text").cast("binary"), 256))).alias("digest"),
        "gone",
    )


def _class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)


def kinds(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest`` and ``kind``: class of the role and fault, or -1
    for a dropped row; dealt by conversation and sorted, last turn first."""
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    slim = _keyed(rows).select(
        *KEY, "gone", (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut")
    )
    # dealt by conversation, so neither the window nor the sort deals again
    dealt = slim.repartition(partitions(rows.sparkSession), "conv_id")
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "digest").orderBy("turn"))
    fault = F.when(F.col("blank"), BLANK).when(nth > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE)
    kind = F.when(F.col("gone"), -1).otherwise(_class(F.col("role")) + 4 * fault)
    return dealt.select(*KEY, nth.cast("bigint").alias("nth"), kind.cast("int").alias("kind")).sortWithinPartitions(
        "conv_id", *(F.col(c).desc() for c in PLACE)
    )


class Steps:
    """One row of the dynamic program, from the end: costs from the four states to the
    end, before and after a row, and the edit that each state takes."""

    #: Costs after the last row: insert what is lacking.
    END = (0, 2 * INSERT, INSERT, 0)

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def __call__(self, kind: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int, int]:
        """Costs less their least, that least, and two bits of edit for each state."""
        found = self.known.get((kind, after))
        if found is None:
            found = self.known[kind, after] = self._step(kind & 3, kind >> 2, after)
        return found

    def _step(self, role: int, fault: int, after: tuple[int, ...]):
        cut = TRUNCATED if fault == CUT else 0
        best: list[tuple[int, int]] = []
        for state in range(4):
            options = [(DELETE + after[state], D)]
            if fault not in (BLANK, DUPLICATE):
                if (state, role) in KEPT:
                    options.append((cut + after[KEPT[state, role]], K))
                options.append((REROLE + cut + after[NEXT[state]], R))
            best.append(min(options))
        for _ in range(3):  # insertions before this row, one or two are ever of use
            best = [min(best[q], (INSERT + best[NEXT[q]][0], I)) for q in range(4)]
        least = min(cost for cost, _ in best)
        edits = sum(edit << 2 * q for q, (_, edit) in enumerate(best))
        return tuple(cost - least for cost, _ in best), least, edits


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLAN = "conv_id bigint, turn bigint, role string, digest binary, nth bigint, edits binary, " + ", ".join(
    f"{c} bigint" for c in COUNTS
)


class _Plan:
    """A conversation as read from its last turn: costs, edits not yet spilled, counts."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.costs, self.base, self.edits = Steps.END, 0, bytearray()
        self.faults, self.illegal, self.later = [0, 0, 0, 0], 0, None
        self.most = self.turn = None
        self.turns = 0
        self.place = (None,) * len(PLACE)

    def add(self, turn, kind: int, step: Steps) -> None:
        self.costs, least, edits = step(kind, self.costs)
        self.base += least
        self.edits.append(edits)
        self.faults[kind >> 2] += 1
        role = kind & 3
        if self.later is not None and (role, self.later) not in LEGAL:
            self.illegal += 1
        self.later = role
        if turn is not None and turn != self.turn:
            self.most = turn if self.most is None else self.most
            self.turn, self.turns = turn, self.turns + 1

    def spill(self) -> tuple:
        """The edits so far, at the place of the first row they are for."""
        edits = bytes(reversed(self.edits))
        self.edits.clear()
        return (self.conv_id, *self.place, edits)

    def end(self) -> tuple:
        gaps = self.most - self.turn + 1 - self.turns if self.turns else 0
        cost = self.base + self.costs[START]
        return (*self.spill(), gaps, *self.faults[1:], self.illegal, cost)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    arrow = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), arrow[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def plan(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The best edit of each row from each state, in chunks that stand at their first
    row, and with a conversation's first chunk its counts and least cost."""
    spilled = (None,) * len(COUNTS)

    def run(batches):
        step, open_, at = Steps(), None, None
        for batch in batches:
            out = []
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            convs, turns, kinds_ = (col[c].to_pylist() for c in ("conv_id", "turn", "kind"))
            places = [col[c] for c in PLACE]
            for i, conv in enumerate(convs):
                if open_ is None or conv != open_.conv_id:
                    if open_ is not None:
                        if at is not None:
                            open_.place = tuple(p[at].as_py() for p in places)
                        out.append(open_.end())
                    open_, at = _Plan(conv), None
                if kinds_[i] < 0:
                    continue
                open_.add(turns[i], kinds_[i], step)
                at = i
                if len(open_.edits) == chunk:
                    open_.place = tuple(p[i].as_py() for p in places)
                    out.append((*open_.spill(), *spilled))
            if at is not None:  # the next batch has other columns
                open_.place, at = tuple(p[at].as_py() for p in places), None
            yield _table(out, PLAN)
        if open_ is not None:
            yield _table([open_.end()], PLAN)

    return kinds(rows).mapInArrow(run, PLAN)


REPAIRED = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
CLASS = {"s": S, "u": U, "a": A}


class _Replay:
    """A conversation as read from its first turn: its state, edits and repaired text."""

    def __init__(self, conv_id):
        self.conv_id, self.state = conv_id, START
        self.waiting: deque = deque()
        self.at = 0
        self.counts = None
        self.audit: list[str] = []
        self.text = sha256()
        self.first = True

    def plan(self, edits: bytes, counts: tuple) -> None:
        if edits:
            self.waiting.append(edits)
        if counts[0] is not None:
            self.counts = counts

    def line(self, role: str, text: str) -> None:
        self.text.update(f"{role}:{text}".encode() if self.first else f"\n{role}:{text}".encode())
        self.first = False

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.audit.append("I")
        self.line(ROLE[self.state], "")

    def add(self, role: str, text: str) -> None:
        edits = self.waiting[0]
        code = edits[self.at]
        self.at += 1
        if self.at == len(edits):
            self.waiting.popleft()
            self.at = 0
        while (edit := code >> 2 * self.state & 3) == I:
            self.insert()
        self.audit.append(LETTERS[edit])
        if edit == K:
            self.state = KEPT[self.state, CLASS[role[0]]]
            self.line(role, text)
        elif edit == R:
            self.state = NEXT[self.state]
            self.line(ROLE[self.state], text)

    def end(self) -> tuple:
        while self.state not in FINAL:
            self.insert()
        return (self.conv_id, *self.counts, "".join(self.audit), self.text.hexdigest())


def replay(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cheapest edits and repaired text's digest."""
    texts = _keyed(rows.where(~F.col("gone"))).drop("gone").withColumn("is_row", F.lit(True))
    both = texts.unionByName(plans.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    dealt = both.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions(*KEY, "is_row", "nth")

    def run(batches):
        open_ = None
        for batch in batches:
            out = []
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            convs, is_row, roles, texts = (col[c].to_pylist() for c in ("conv_id", "is_row", "role", "text"))
            for i, conv in enumerate(convs):
                if open_ is None or conv != open_.conv_id:
                    if open_ is not None:
                        out.append(open_.end())
                    open_ = _Replay(conv)
                if is_row[i]:
                    open_.add(roles[i], texts[i])
                else:
                    open_.plan(col["edits"][i].as_py(), tuple(col[c][i].as_py() for c in COUNTS))
            yield _table(out, REPAIRED)
        if open_ is not None:
            yield _table([open_.end()], REPAIRED)

    return dealt.mapInArrow(run, REPAIRED)


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``conv_id``, its counts of faults, least cost, audit and repaired digest, of
    ``conv_id, turn, role, text`` and ``gone`` (rows that only name a conversation)."""
    return replay(rows, stage(plan(rows, chunk), "conversation-plan"))
