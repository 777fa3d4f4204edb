"""Repair of conversation structure by a run-length dynamic program.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Cheapest edits lead there: Keep 0,
Rerole to user/assistant 3, Delete 4, Insert an empty user/assistant turn 3; a truncated row that stays adds 3,
blank and duplicate rows must go. Of equally cheap edit sequences the one with the ASCII-least initials counts.

Only two things about a row matter: its role initial and its fault. So a conversation is a string over nine
symbols, held as runs of equal symbols. Consuming one symbol is a 4 x 4 matrix over (min, +) on the states
*empty, after s, after u, after a*; a run of n equal symbols is the matrix to the n-th power, advanced through
powers of two that are computed once per symbol and kept. That gives the cost to finish
from every run border, right to left. The edits are then unrolled left to right: a power of two is
halved down to single rows, each taking the first letter (D < I < K < R) that stays on a cheapest path; equal
halves are looked up. Roles need no search: an inserted or reroled turn has the one role its state allows.

On Spark the rows are shuffled once, by conversation. A row is sent twice to its task: first without text (symbol and turn, sorted:
these become the runs), then with text, in the same order, to meet the edits as a stream. A task holds one
Arrow batch, the runs and the audit of one conversation, never its texts. A conversation is one
stream because the SHA-256 of its repaired text is one chain; its rows are sorted with spilling.

Rows are ordered by turn (nulls first), then role and text hash; the copies of a row are adjacent. Null
``conv_id`` is a conversation of its own. Null role or text of a row counts as one space, as does a null id or turn in the damage key.
A role whose initial is none of s, u, a can only be reroled or deleted. Very long texts pass as they are. Other columns, whatever their
names, are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from geotrail.llm.common import small_batches

# Fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
END_MARKS = ".!?"

#: symbols: 2 * class (user, assistant, system, other) + truncated; 8: must be deleted
USER, ASSISTANT, SYSTEM, OTHER = range(4)
MUST_DELETE = 8
#: states: nothing yet, after s, after u, after a; the end is allowed in the first and the last
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
KEEP = {EMPTY: {SYSTEM: AFTER_S, USER: AFTER_U}, AFTER_S: {USER: AFTER_U}, AFTER_U: {ASSISTANT: AFTER_A}, AFTER_A: {USER: AFTER_U}}
#: the state after an inserted or reroled turn, and that turn's role
TURN = {EMPTY: (AFTER_U, "user"), AFTER_S: (AFTER_U, "user"), AFTER_U: (AFTER_A, "assistant"), AFTER_A: (AFTER_U, "user")}
FAR = 1 << 60


def _closed(after: list[int]) -> list[int]:
    """Cheapest cost per state when any number of turns may be inserted first."""
    best = list(after)
    for _ in range(3):  # no cheapest path inserts more than three turns in a row
        best = [min(best[s], INSERT + best[TURN[s][0]]) for s in range(4)]
    return best


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that consume a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if symbol != MUST_DELETE:
        kind, stays = symbol >> 1, TRUNCATED * (symbol & 1)
        if kind in KEEP[state]:
            out.append(("K", stays, KEEP[state][kind]))
        out.append(("R", REROLE + stays, TURN[state][0]))
    return out


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> tuple[tuple[int, ...], ...]:
    """Min-plus matrix of ``2 ** k`` rows of one symbol, insertions before each row included."""
    if k == 0:
        columns = []
        for end in range(4):
            after = [0 if s == end else FAR for s in range(4)]
            columns.append(_closed([min(c + after[t] for _, c, t in _moves(symbol, s)) for s in range(4)]))
        return tuple(tuple(columns[t][s] for t in range(4)) for s in range(4))
    half = power(symbol, k - 1)
    return tuple(tuple(min(FAR, *(half[s][m] + half[m][t] for m in range(4))) for t in range(4)) for s in range(4))


def _before(symbol: int, k: int, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(row[t] + after[t] for t in range(4)) for row in power(symbol, k))


@lru_cache(maxsize=200_000)
def _letters(symbol: int, k: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """Cheapest, then ASCII-least, edits of ``2 ** k`` rows from ``state``; and the state they end in."""
    if k:
        first, middle = _letters(symbol, k - 1, state, _relative(_before(symbol, k - 1, after)))
        second, end = _letters(symbol, k - 1, middle, after)
        return first + second, end
    best = _closed([min(c + after[t] for _, c, t in _moves(symbol, s)) for s in range(4)])
    out = []
    while True:
        moves = _moves(symbol, state)
        letter, cost, end = moves[0]
        if cost + after[end] == best[state]:
            return "".join(out) + letter, end
        if INSERT + best[TURN[state][0]] == best[state]:
            out.append("I")
            state = TURN[state][0]
            continue
        letter, _, end = next(m for m in moves[1:] if m[1] + after[m[2]] == best[state])
        return "".join(out) + letter, end


def _relative(costs: tuple[int, ...]) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


def _parts(length: int) -> list[int]:
    """Exponents of the powers of two that add up to ``length``, largest first."""
    return [k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def solve(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of a conversation given as runs ``(symbol, length)``."""
    parts = [(symbol, k) for symbol, length in runs for k in _parts(length)]
    after = tuple(_closed([0, FAR, FAR, 0]))
    borders = [after]
    for symbol, k in reversed(parts):
        borders.append(_before(symbol, k, borders[-1]))
    cost = borders.pop()[EMPTY]
    state, audit = EMPTY, []
    for symbol, k in parts:
        letters, state = _letters(symbol, k, state, _relative(borders.pop()))
        audit.append(letters)
    while state not in (EMPTY, AFTER_A):
        audit.append("I")
        state = TURN[state][0]
    return cost, "".join(audit)


class Conversation:
    """One conversation while its rows stream by: first the symbols, then the texts."""

    def __init__(self) -> None:
        self.runs: list[list[int]] = []
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.last = None
        self.initial: str | None = None
        self.cost, self.audit = 0, None
        self.at, self.state, self.lines = 0, EMPTY, 0
        self.sha = hashlib.sha256()

    def see(self, symbol: int, fault: str, initial: str, turn: int | None) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.last = turn

    def _solved(self) -> None:
        if self.audit is None:
            self.cost, self.audit = solve([tuple(r) for r in self.runs])

    def _write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state, role = TURN[self.state]
            self._write(role, "")

    def edit(self, symbol: int, role: str, text: str) -> None:
        self._solved()
        self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEEP[self.state][symbol >> 1]
            self._write(role, text)
        elif letter == "R":
            self.state, role = TURN[self.state]
            self._write(role, text)

    def result(self) -> tuple:
        self._solved()
        self._insert()
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, self.sha.hexdigest()


RESULT = pa.schema(
    [("conv_id", pa.int64())]
    + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
RESULT_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
FAULTS = {0: "", 1: "blank", 2: "duplicate", 3: "truncated"}
#: what a streamed row is: the mark that a conversation exists, a symbol, a text
MARKER, SYMBOL, TEXT = range(3)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, open_id, seen = None, None, False
    for batch in batches:
        done: list[tuple] = []
        for conv, kind, symbol, fault, initial, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if not seen or conv != open_id:
                if seen:
                    done.append((open_id, *here.result()))
                here, open_id, seen = Conversation(), conv, True
            if kind == SYMBOL:
                here.see(symbol, FAULTS[fault], initial, turn)
            elif kind == TEXT:
                here.edit(symbol, role, text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), RESULT.types)], schema=RESULT)
    if seen:
        row = (open_id, *here.result())
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, RESULT.types)], schema=RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: ``conv_id, turn, role, text`` with ``lost`` rows kept as marks of their conversation."""
    space = F.lit(" ")
    c = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    h = F.crc32(key.cast("binary")) % 20
    c = c.select(
        "conv_id",
        "turn",
        F.when(h == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.translate("text", END_MARKS, "")).otherwise(F.col("text")).alias("text"),
        (h == 0).alias("lost"),
        F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return c.drop("copy")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text`` without nulls in role and text, ``lost``)."""
    spark = rows.sparkSession
    small_batches(spark)
    white = F.lit(WHITE)
    marked = rows.select(
        "conv_id", "turn", "role", "text", "lost", F.md5(F.col("text").cast("binary")).alias("h"),
        (F.btrim(F.col("text"), white) == "").alias("is_blank"),
        (~F.substring(F.rtrim(F.col("text"), white), -1, 1).isin(*END_MARKS)).alias("is_cut"),
        F.substring("role", 1, 1).alias("initial"),
    )
    same = Window.partitionBy("conv_id", "lost", "role", "h").orderBy("turn")
    c = marked.repartition("conv_id").withColumn("is_copy", F.row_number().over(same) > 1)
    fault = F.when(F.col("is_blank"), 1).when(F.col("is_copy"), 2).when(F.col("is_cut"), 3).otherwise(0)
    kind = F.when(F.col("initial") == "u", USER).when(F.col("initial") == "a", ASSISTANT).when(F.col("initial") == "s", SYSTEM).otherwise(OTHER)
    c = c.withColumn("fault", fault)
    c = c.withColumn("symbol", F.when(F.col("fault").isin(1, 2), MUST_DELETE).otherwise(kind * 2 + (F.col("fault") == 3).cast("int")))
    kinds = F.when(F.col("lost"), F.array(F.lit(MARKER))).otherwise(F.array(F.lit(SYMBOL), F.lit(TEXT)))
    sent = c.withColumn("kind", F.explode(kinds)).sortWithinPartitions("conv_id", "kind", "turn", "role", "h", "symbol")
    is_text = F.col("kind") == TEXT
    sent = sent.select(
        "conv_id", "kind", "symbol", "fault", "initial", "turn",
        F.when(is_text, F.col("role")).alias("role"), F.when(is_text, F.col("text")).alias("text"),
    )
    return sent.mapInArrow(_repaired, RESULT_DDL)
