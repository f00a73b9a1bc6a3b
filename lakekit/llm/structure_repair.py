"""Conversation structure repair: a generalised LR parser whose actions also delete, rerole and insert turns.

The role grammar is ``S -> (empty) | P``, ``P -> H u a | P u a`` and
``H -> (empty) | s``: an optional system turn, then pairs of user and assistant
turns.  Its LR automaton runs over the turns of a conversation with a
graph-structured stack.  Beside keeping a turn, the parser may give it the role
user or assistant, delete it, or insert an empty turn, each at a price.  Stacks
whose tops are in the same state have the same future, so of these only the one
with the least (cost, audit) goes on; the audit is the string of the edits'
initials.

Spark deals the turns by conversation, sorts them within each task and streams
them through the parser.  Edits that all stacks share are settled and go out, so
a task holds the open edits of one conversation, not its turns.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import BLANKS, bounded_batches, small

#: The LR automaton of the role grammar, by the initials of the roles.  States in which a
#: turn can follow: 0 start, 1 after H, 2 after H u, 3 after P, 4 after P u.
SHIFT = {(0, "s"): 5, (1, "u"): 2, (2, "a"): 6, (3, "u"): 4, (4, "a"): 7}
#: Complete productions: the symbol they make and how many stack entries they take.
REDUCE = {5: ("H", 1), 6: ("P", 3), 7: ("P", 3)}
#: Where nothing becomes a symbol, if this role comes next.
EMPTY = {(0, "u"): "H"}
GOTO = {(0, "H"): 1, (0, "P"): 3}
#: States in which a conversation may end.
ACCEPT = (0, 3)

#: Prices of keeping, reroling and deleting a turn and of an inserted one; of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 1, 2, 5, 5
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
#: A stack dearer than another by more than this can't win: the other follows its best course with two
#: inserts and one deletion at most.
MARGIN = 2 * INSERT + DELETE


def step(state: int, below, symbol: str):
    """``(state, stack below)`` after a turn of this role, reductions done; None where it can't follow.

    A stack below is a linked list ``(state, stack below)``, shared between stacks.
    """
    made = EMPTY.get((state, symbol))
    if made:
        state, below = GOTO[state, made], (state, below)
    to = SHIFT.get((state, symbol))
    if to is None:
        return None
    stack = (state, below)
    if to not in REDUCE:
        return to, stack
    made, size = REDUCE[to]
    for _ in range(size - 1):
        stack = stack[1]
    return GOTO[stack[0], made], stack


class Parser:
    """The parse of one conversation: ``take`` its turns in order, then ``finish``.

    ``settle`` gets the edits all stacks share, in order.  Audits are kept from
    there on.  At one place and equal cost no audit is a proper prefix of
    another (the longer one has an insert more, which costs something), so what
    follows doesn't change their order, and merging by (cost, audit) is exact.
    """

    def __init__(self, settle):
        self.settle, self.open = settle, 0
        self.tops = {0: (0, "", None)}  # state -> (cost, open audit, stack below)
        self._insert()

    @staticmethod
    def _offer(tops: dict, to, cost: int, audit: str) -> bool:
        if to is None or to[0] in tops and tops[to[0]][:2] <= (cost, audit):
            return False
        tops[to[0]] = (cost, audit, to[1])
        return True

    def _insert(self) -> None:
        """Also hold the stacks that inserted turns lead to."""
        work = sorted(self.tops, key=lambda s: self.tops[s][:2])
        for state in work:
            cost, audit, below = self.tops[state]
            for symbol in "ua":
                to = step(state, below, symbol)
                if self._offer(self.tops, to, cost + INSERT, audit + "I"):
                    work.append(to[0])
        most = min(t[0] for t in self.tops.values()) + MARGIN
        self.tops = {s: t for s, t in self.tops.items() if t[0] <= most}

    def take(self, initial: str, fault: int) -> None:
        tops: dict = {}
        extra = TRUNCATED_STAYS if fault == TRUNCATED else 0
        for state, (cost, audit, below) in self.tops.items():
            self._offer(tops, (state, below), cost + DELETE, audit + "D")
            if fault not in (BLANK, DUPLICATE):
                self._offer(tops, step(state, below, initial), cost + KEEP + extra, audit + "K")
                for symbol in "ua":
                    self._offer(tops, step(state, below, symbol), cost + REROLE + extra, audit + "R")
        self.tops, self.open = tops, self.open + 1
        self._insert()
        if self.open >= 32:
            self._settle_shared()

    def _settle_shared(self) -> None:
        audits = [t[1] for t in self.tops.values()]
        low, high = min(audits), max(audits)
        n = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        self.settle(low[:n])
        self.tops = {s: (cost, audit[n:], below) for s, (cost, audit, below) in self.tops.items()}
        self.open = 0

    def finish(self) -> int:
        """Settle the rest of the best audit and return its cost."""
        cost, audit, _ = min((self.tops[s] for s in ACCEPT if s in self.tops), key=lambda t: t[:2])
        self.settle(audit)
        return cost


class Conversation:
    """Counts, parse and repaired turns of one conversation while its turns pass in order."""

    def __init__(self, key, emit):
        self.key, self.emit = key, emit
        self.pending: deque = deque()  # turns whose edit is not settled
        self.audit: list[str] = []
        self.counts = [0, 0, 0, 0]  # turns by fault
        self.illegal = self.distinct = self.placed = 0
        self.first = self.last = self.before = None
        self.system = 0
        self.parser = Parser(self._apply)

    def take(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.counts[fault] += 1
        self.pending.append((turn, role, text))
        self.parser.take(initial, fault)

    def _apply(self, edits: str) -> None:
        """Emit the turns that settled edits leave; a turn's place tells the role it gets."""
        self.audit.append(edits)
        for edit in edits:
            turn, role, text = (None, None, "") if edit == "I" else self.pending.popleft()
            if edit == "D":
                continue
            if edit == "K":
                if not self.placed and role[:1] == "s":
                    self.system = 1
            else:
                role = ("user", "assistant")[(self.placed - self.system) % 2]
            self.emit(self.key, self.placed, role, text, edit, turn)
            self.placed += 1

    def finish(self) -> tuple:
        cost = self.parser.finish()
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (gaps, *self.counts[1:], self.illegal, cost, "".join(self.audit))


def marked_turns(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", gone_col: str | None = None) -> DataFrame:
    """``(conv, turn, role, text, fault, gone)``, dealt by conversation and sorted by turn within each task.

    ``fault`` is the first of: 1 blank (nothing but ASCII white space), 2
    duplicate (role and text of an earlier turn), 3 truncated (the last other
    character is none of ``.!?``); 0 for none.  One exchange serves the search
    for duplicates and the parse.
    """
    gone = F.coalesce(F.col(f"`{gone_col}`"), F.lit(False)) if gone_col else F.lit(False)
    rows = turns.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
        gone.alias("gone"),
    ).repartition("conv")
    same = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("again", F.row_number().over(same) > 1)
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(bare == "", BLANK).when(F.col("again"), DUPLICATE).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(OK)
    rows = rows.select("conv", "turn", "role", "text", fault.alias("fault"), "gone")
    return rows.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "fault")


def _parse(batches, emit, done) -> None:
    """Generator: stream sorted turns through the parser; ``done`` gets each conversation's id and figures."""
    conv = None
    for batch in batches:
        for part in small([batch]):
            for key, turn, role, text, fault, gone in zip(*(c.to_pylist() for c in part.columns)):
                if conv is None or conv.key != key:
                    if conv is not None:
                        done(conv.key, conv.finish())
                    conv = Conversation(key, emit)
                if not gone:
                    conv.take(turn, role, text, fault)
            yield
    if conv is not None:
        done(conv.key, conv.finish())
    yield


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", **columns) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair and the digest of the repaired turns.

    Returns ``conv_col`` (bigint), ``gaps`` (missing turn numbers between the
    least and the greatest), ``blank``, ``duplicate``, ``truncated`` (turns by
    their first fault), ``illegal`` (neighbours whose role initials are none of
    su, ua, au), ``cost``, ``audit`` (initials of the edits Keep, Rerole, Delete,
    Insert in order; of equally cheap repairs the least in ASCII) and
    ``repaired_sha256`` (of the repaired ``role:text`` lines, joined by newlines).

    Null roles and texts are one space, null turns come first, rows without a
    conversation are one conversation of their own.  Turns of one number go by
    role, then text; repeated rows are duplicates.  ``gone_col`` names a boolean
    column: rows where it is true only announce their conversation, which has
    zeros, an empty audit and the empty string's digest if nothing else is left.
    An empty table gives an empty result; other columns, whatever their names,
    are not read.

    A task's memory is bounded by the edits that stay open, which are few unless
    two courses stay equally good for long, and by the audit, a byte a turn.
    """
    bounded_batches(turns)
    marked = marked_turns(turns, conv_col, **columns)
    schema = f"conv bigint, {', '.join(f'{n} bigint' for n in FIGURES)}, audit string, repaired_sha256 string"

    def parse(batches):
        rows: list[tuple] = []
        digest = hashlib.sha256()

        def emit(key, place, role, text, edit, turn):
            digest.update((f"\n{role}:{text}" if place else f"{role}:{text}").encode())

        def done(key, figures):
            nonlocal digest
            rows.append((key, *figures, digest.hexdigest()))
            digest = hashlib.sha256()

        types = [pa.int64()] * 7 + [pa.string()] * 2
        for _ in _parse(batches, emit, done):
            if rows:
                arrays = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, ["conv", *FIGURES, "audit", "repaired_sha256"])
                rows.clear()

    return marked.mapInArrow(parse, schema).withColumnRenamed("conv", conv_col)


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", **columns) -> DataFrame:
    """The repaired conversations: ``(conv_col, place, role, text, edit, turn)``, one row per turn that stays or is new.

    ``place`` counts from 0; ``edit`` is K, R or I; ``turn`` is the turn's old
    number (null for inserted ones).  Arguments and odd cases as in
    ``repair_conversations``; a conversation of which nothing stays has no row.
    """
    bounded_batches(turns)
    marked = marked_turns(turns, conv_col, **columns)

    def parse(batches):
        rows: list[tuple] = []
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        for _ in _parse(batches, lambda *row: rows.append(row), lambda key, figures: None):
            if rows:
                arrays = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, ["conv", "place", "role", "text", "edit", "turn"])
                rows.clear()

    schema = "conv bigint, place bigint, role string, text string, edit string, turn bigint"
    return marked.mapInArrow(parse, schema).withColumnRenamed("conv", conv_col)
