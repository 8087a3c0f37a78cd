"""Conversations brought back to a legal order of roles at the least cost.

A row's signature is one letter: its role's initial and its fault. Signatures of conversations are cut into strings of at
most ``BLOCK`` letters. All different strings together are an automaton that shares their ends: its nodes are the different
suffixes. Sorted by their reversed letters, strings that share an end stand next to each other, so a task walks the
automaton with the nodes of one string in hand, and works out the least cost and the best audit from each node once for
each state of the grammar, whatever the number of conversations that use it. A conversation then only strings together
the results of its blocks, last block first; since only the state between two blocks matters, a conversation of any
length is cut, sorted and solved by many tasks.

The grammar of role initials is ``(s?(ua)+)?``. In each of its states one role can be inserted, or a row given, so that an
audit (the initials of the edits: Delete, Insert, Keep, Rerole) and the rows say all about the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import SPACES, written

BLOCK = 64
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, after a system, a user, an assistant row
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = [USER, USER, ASSISTANT, USER]  # the state after the one role that can follow
ROLE = {USER: "user", ASSISTANT: "assistant"}
END = [(0, ""), (4, "II"), (2, "I"), (0, "")]  # cost and audit from each state when no row is left
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
LEGAL = {"su", "ua", "au"}
MOST = (1 << 63) - 1

Value = list[list[tuple[int, str] | None]]  # by state before and state after: least cost and its least audit
NOTHING_LEFT: Value = [[(0, "") if g == h else None for h in range(4)] for g in range(4)]


# ---- rows ------------------------------------------------------------------------------------


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (with ``present``, false for dropped ones) with faults by the CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 removes all of its ``.!?``, 3 repeats it, 4 makes it the user's. A null counts as
    one space. Only the four named columns are returned.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    named = rows.select(conv_col, turn_col, space(role_col).alias(role_col), space(text_col).alias(text_col), kind.alias("__kind"))
    kind, text = F.col("__kind"), F.col(text_col)
    hurt = named.withColumns(
        {
            role_col: F.when(kind == 4, "user").otherwise(F.col(role_col)),
            text_col: F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text),
            "present": kind != 0,
            "__copy": F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))),
        }
    )
    return hurt.drop("__kind", "__copy")


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    """conv as text, timed (false for null turns, which come first), turn, role, key, text, present."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv).cast("string").alias("conv"),
        F.col(turn).isNotNull().alias("timed"),
        F.col(turn).cast("long").alias("turn"),
        space(role).alias("role"),
        F.unhex(F.sha2(space(text), 256)).alias("key"),
        space(text).alias("text"),
        F.coalesce(present, F.lit(False)).alias("present"),
    )


def _signature() -> tuple[Column, Column]:
    """The initial (``o`` for any but s, u, a) and the letter: capital if truncated, ``b`` if blank."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    visible = F.rtrim("text", F.lit(SPACES))
    cut = ~F.right(visible, F.lit(1)).isin(".", "!", "?")
    return initial, F.when(visible == "", "b").when(cut, F.upper(initial)).otherwise(initial)


ORDER = ["conv", "timed", "turn", "role", "key"]


def _units(rows: DataFrame) -> DataFrame:
    """One row for all copies of a row (conv, turn, role, text): initial, letter, copies, and whether all of them are duplicates.

    Copies are counted before they are shuffled, and only (conv, role, text) that occur more than once are looked up.
    """
    initial, letter = _signature()
    units = rows.where("present").groupBy(*ORDER, initial.alias("initial"), letter.alias("letter")).agg(F.count("*").alias("copies"))
    units = written(units, "conversation_units")
    said = units.where("letter <> 'b'").groupBy("conv", "role", "key")
    again = said.agg(F.min(F.struct("timed", "turn")).alias("first"), F.count("*").alias("times")).where("times > 1")
    again = written(again.select(F.col("conv").alias("its_conv"), F.col("role").alias("its_role"), F.col("key").alias("its_key"), "first"), "conversation_repeats")
    same = F.col("conv").eqNullSafe(F.col("its_conv")) & (F.col("role") == F.col("its_role")) & (F.col("key") == F.col("its_key"))
    both = units.join(again, same, "left")
    late = F.coalesce(F.struct("timed", "turn") > F.col("first"), F.lit(False))
    return both.select(*ORDER, "initial", "letter", "copies", late.alias("late"))


# ---- blocks ----------------------------------------------------------------------------------

BLOCKS = (
    "conv STRING, slice INT, k BIGINT, signature STRING, first_initial STRING, last_initial STRING, first_turn STRING, last_turn STRING,"
    " turns BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT"
)


class _Block:
    def __init__(self):
        self.letters, self.initials = [], []
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, letter: str, initial: str, turn: str | None, again: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = self.first_turn or turn
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.illegal += 1
        self.initials.append(initial)
        if letter == "b":
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif letter.isupper():
            self.truncated += 1
        self.letters.append("x" if letter == "b" or again else letter)  # both must go, whatever their role

    def row(self, conv: str | None, part: int, k: int) -> tuple:
        ends = (self.initials[0], self.initials[-1], self.first_turn, self.last_turn, self.turns)
        return (conv, part, k, "".join(self.letters), *ends, self.blank, self.duplicate, self.truncated, self.illegal)


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted units to blocks; a conversation that goes on in the next partition has its later blocks there."""
    part, k, conv, block = TaskContext.get().partitionId(), 0, None, None
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    for f in frames:
        out = []
        columns = [f[c].tolist() for c in ("conv", "said_at", "initial", "letter", "copies", "late")]
        for here, turn, initial, letter, copies, late in zip(*columns, strict=True):
            if block is not None and here != conv:
                out.append(block.row(conv, part, k))
                k, block = k + 1, None
            conv = here
            for n in range(copies):
                if block is not None and len(block.letters) == BLOCK:
                    out.append(block.row(conv, part, k))
                    k, block = k + 1, None
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
                block = block or _Block()
                block.add(letter, initial, turn, late or n > 0)
        yield pd.DataFrame(out, columns=names)
    if block is not None:
        yield pd.DataFrame([block.row(conv, part, k)], columns=names)


# ---- the automaton -----------------------------------------------------------------------------


def _least(options: list[tuple[int, str, tuple[int, str] | None]]) -> tuple[int, str] | None:
    return min(((cost + rest[0], edit + rest[1]) for cost, edit, rest in options if rest is not None), default=None)


def node_value(letter: str, rest: Value) -> Value:
    """The value of the node that reads ``letter`` and goes on at a node of value ``rest``."""
    edits: Value = []
    extra = TRUNCATED if letter.isupper() else 0
    for g in range(4):
        after = []
        for h in range(4):
            options = [(DELETE, "D", rest[g][h])]
            if letter != "x":
                options.append((REROLE + extra, "R", rest[NEXT[g]][h]))
                kept = KEEPS.get((g, letter.lower()))
                if kept is not None:
                    options.append((extra, "K", rest[kept][h]))
            after.append(_least(options))
        edits.append(after)
    # two inserted rows lead through all states that inserting can reach
    return [
        [_least([(0, "", edits[g][h]), (INSERT, "I", edits[NEXT[g]][h]), (2 * INSERT, "II", edits[NEXT[NEXT[g]]][h])]) for h in range(4)]
        for g in range(4)
    ]


def _solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Signatures, sorted by their reversed letters, to values: a path of nodes is kept, and each node is worked out once."""
    path, values = "", [NOTHING_LEFT]
    for f in frames:
        costs, audits = [], []
        for signature in f["signature"]:
            back = signature[::-1]
            shared = 0
            while shared < min(len(path), len(back)) and path[shared] == back[shared]:
                shared += 1
            del values[shared + 1 :]
            for letter in back[shared:]:
                values.append(node_value(letter, values[-1]))
            path = back
            flat = [v for row in values[-1] for v in row]
            costs.append([-1 if v is None else v[0] for v in flat])
            audits.append([None if v is None else v[1] for v in flat])
        yield pd.DataFrame({"signature": f["signature"], "costs": costs, "audits": audits})


def solved(signatures: DataFrame) -> DataFrame:
    """signature, costs, audits: for each state before and after it (4 x 4), the least cost of its rows and the best audit."""
    spread = signatures.distinct().withColumn("back", F.reverse("signature")).repartitionByRange("back").sortWithinPartitions("back")
    return spread.select("signature").mapInPandas(_solve, "signature STRING, costs ARRAY<BIGINT>, audits ARRAY<STRING>")


# ---- conversations ------------------------------------------------------------------------------

REPORT = "gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, audit STRING"
REPORT_NAMES = [c.split()[0] for c in REPORT.split(", ")]


class _Conversation:
    """What is known of a conversation from its last block back to the one added last."""

    def __init__(self, conv: str | None):
        self.conv, self.best = conv, END
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_initial = self.first_turn = self.last_turn = None

    def add(self, b) -> None:
        costs, audits = b.costs, b.audits
        choices = [[(int(costs[4 * g + h]), audits[4 * g + h], self.best[h]) for h in range(4) if audits[4 * g + h] is not None] for g in range(4)]
        self.best = [_least(c) for c in choices]
        self.blank, self.duplicate, self.truncated = self.blank + b.blank, self.duplicate + b.duplicate, self.truncated + b.truncated
        self.illegal += b.illegal
        if self.first_initial is not None and b.last_initial + self.first_initial not in LEGAL:
            self.illegal += 1
        self.first_initial = b.first_initial
        if b.first_turn is not None:
            self.turns += b.turns - (b.last_turn == self.first_turn)
            self.first_turn = b.first_turn
            self.last_turn = self.last_turn or b.last_turn

    def row(self) -> tuple:
        gaps = 0 if self.first_turn is None else int(self.last_turn) - int(self.first_turn) + 1 - self.turns
        return (self.conv, min(gaps, MOST), self.blank, self.duplicate, self.truncated, self.illegal, *self.best[START])


def _join_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks with their values, each conversation's last block first, to one row a conversation."""
    now, names = None, ["conv", *REPORT_NAMES]
    for f in frames:
        out = []
        for b in f.itertuples(index=False):
            if now is not None and now.conv != b.conv:
                out.append(now.row())
                now = None
            now = now or _Conversation(b.conv)
            now.add(b)
        yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


def _reports(rows: DataFrame) -> DataFrame:
    units = written(_units(rows), "conversation_units")
    spread = units.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    narrow = spread.select("conv", F.col("turn").cast("string").alias("said_at"), "initial", "letter", "copies", "late")
    blocks = written(narrow.mapInPandas(_cut, BLOCKS), "conversation_blocks")
    values = written(solved(blocks.select("signature")), "conversation_values")
    both = blocks.join(values, "signature").drop("signature")
    back = both.repartition("conv").sortWithinPartitions(F.col("conv"), F.desc("slice"), F.desc("k"))
    return written(back.mapInPandas(_join_blocks, f"conv STRING, {REPORT}"), "conversation_reports")


def _with_reports(rows: DataFrame) -> DataFrame:
    """Every conversation's report, then its rows in order; rows that are not present only name it."""
    reports = _reports(rows).withColumn("kind", F.lit(0))
    names = rows.where("NOT present").select("conv", F.lit(1).alias("kind"))
    said = rows.where("present").select(*ORDER, "text", F.lit(2).alias("kind"))
    every = reports.unionByName(names, allowMissingColumns=True).unionByName(said, allowMissingColumns=True)
    every = every.repartition("conv").sortWithinPartitions("conv", "kind", *ORDER[1:])
    every = every.withColumn("gaps", F.col("gaps").cast("string"))  # a column with nulls reaches pandas as floats
    return every.select("conv", "kind", *REPORT_NAMES, F.col("turn").cast("string").alias("said_at"), "role", "text")


def _replay(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Events: ("report", conv, report), then ("row", edit, turn, role, text) in order, then ("end",). Rows pass, none is kept."""
    began, conv, audit, at, state = False, None, "", 0, START

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = NEXT[state]
            yield ("row", "I", None, ROLE[state], "")
            at += 1

    for f in frames:
        for r in f.itertuples(index=False):
            if began and r.conv != conv:
                yield from inserts()
                yield ("end",)
                began = False
            if not began:
                began, conv, at, state = True, r.conv, 0, START
                report = [int(r.gaps), int(r.blank), int(r.duplicate), int(r.truncated), int(r.illegal), int(r.cost), r.audit] if r.kind == 0 else [0] * 6 + [""]
                audit = report[-1]
                yield ("report", conv, report)
            if r.kind == 2:
                yield from inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = KEEPS[state, r.role[0]]
                    yield ("row", "K", r.said_at, r.role, r.text)
                elif edit == "R":
                    state = NEXT[state]
                    yield ("row", "R", r.said_at, ROLE[state], r.text)
    if began:
        yield from inserts()
        yield ("end",)


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from hashlib import sha256

    out, names = [], ["conv", *REPORT_NAMES, "repaired_sha256"]
    for event in _replay(frames):
        if event[0] == "report":
            head, digest, first = event[1:], sha256(), True
        elif event[0] == "row":
            digest.update(f"{'' if first else chr(10)}{event[3]}:{event[4]}".encode("utf-8", "surrogatepass"))
            first = False
        else:
            out.append((head[0], *head[1], digest.hexdigest()))
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
    yield pd.DataFrame(out, columns=names)


def _results(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out, size, names = [], 0, ["conv", "place", "edit", "turn", "role", "text"]
    for event in _replay(frames):
        if event[0] == "report":
            conv, place = event[1], 0
        elif event[0] == "row":
            place += 1
            out.append((conv, place, event[1], event[2], event[3], event[4]))
            size += len(event[4]) + 100
            if size > 16_000_000:
                yield pd.DataFrame(out, columns=names)
                out, size = [], 0
    yield pd.DataFrame(out, columns=names)


def repair_reports(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None,
) -> DataFrame:
    """One row a conversation: (conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows are taken by turn, null turns first, rows of one turn by role and then by the SHA-256 of their text. A null role or
    text counts as one space; rows whose conversation is null are one conversation. Rows for which ``present`` does not hold
    are no rows of their conversation, but name it: one with no other rows has zeros, an empty audit and the hash of nothing.
    Copies of a row are duplicates of it. ``gaps`` beyond 2^63 - 1 count as that. Texts are taken whole, of any length; other
    columns have no part. An empty table gives no rows. The hash is of ``role:text`` of ``repaired_rows``, one a line.

    A conversation's own hash is made by one task, through which its rows pass sorted, without being held; all else is spread.
    """
    parts = _rows(rows, conv_col, turn_col, role_col, text_col, F.lit(True) if present is None else present)
    out = _with_reports(parts).mapInPandas(_digests, f"conv STRING, {REPORT}, repaired_sha256 STRING")
    return out.select(F.col("conv").cast(rows.schema[conv_col].dataType).alias(conv_col), *REPORT_NAMES, "repaired_sha256")


def repaired_rows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None,
) -> DataFrame:
    """The repaired conversations: (conv_col, place from 1, edit, turn_col, role_col, text_col); inserted rows have no turn and no text.

    What ``repair_reports`` says of odd rows holds here too.
    """
    parts = _rows(rows, conv_col, turn_col, role_col, text_col, F.lit(True) if present is None else present)
    out = _with_reports(parts).mapInPandas(_results, "conv STRING, place BIGINT, edit STRING, turn STRING, role STRING, text STRING")
    return out.select(
        F.col("conv").cast(rows.schema[conv_col].dataType).alias(conv_col),
        "place",
        "edit",
        F.col("turn").cast("long").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("text").alias(text_col),
    )
