"""Conversation repair: the cheapest edits that turn a conversation into an alternation of roles.

A conversation's turns are aligned with the grammar ``(s?(ua)+)?`` by
Wagner-Fischer, once for each length that the grammar string can have. All
even strings share one table, as they end alike; so do the odd ones, whose first
letter is an s that only a kept system turn can give. A greedy repair gives an
incumbent cost, and Ukkonen's band leaves out the cells that cost more than
that: in them the rest of the turns and the rest of the string differ too much
in length. Backtraces prefer the ASCII-least edit at each step, and the audits
of all lengths that reach the least cost are compared.

A long conversation is cut into segments of ``SEGMENT`` turns. A segment is
aligned for each state of the grammar before and after it, and segments are
joined by cost and audit. That is exact: of two equally cheap audits of one
segment between the same states neither begins the other (what follows would be
inserts that lead nowhere), so the lesser one stays the lesser in any company.

Turns reach a task sorted, in a stream: first their one-letter symbols, from
which the audit follows, then their texts, which pass through the hash one by
one. So a task holds a letter per turn of one conversation, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
SEGMENT = 512
#: Symbol strings whose repair a task remembers, in each of two generations.
MEMO = 20_000
#: A turn that must go. Other symbols are initials: s, u, a, or o for any other, in capitals when truncated.
GONE = "x"
#: States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_FAR = 1 << 30
_ROLES = {"u": "user", "a": "assistant"}


# -- alignment --------------------------------------------------------------------


def _incumbent(symbols: str) -> int:
    """What a greedy repair costs above the sure costs (turns that must go, truncated ones), between any two states."""
    kept = [c.lower() for c in symbols if c != GONE]
    cost, wanted = 0, "u"
    for i, c in enumerate(kept):
        if c != wanted:
            cost += max(REROLE, INSERT)
            # An insert goes on from this turn's role, a new role from the wanted one.
            after = kept[i + 1] if i + 1 < len(kept) else wanted
            if c in _ROLES and after != c:
                wanted = c
        wanted = "a" if wanted == "u" else "u"
    # One insert at each end leads from any state to any state.
    return cost + 2 * INSERT


class Alignment:
    """Wagner-Fischer of ``symbols`` against all alternating strings that end with ``last``, in a band.

    ``cost[i, d]`` is the least cost of aligning the turns from ``i`` on with the
    last ``k`` letters, where ``k`` is ``d - self.fewer`` more than the turns from
    ``i`` on that may stay.
    """

    def __init__(self, symbols: str, last: str):
        self.symbols, self.last, n = symbols, last, len(symbols)
        left = np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            left[i] = left[i + 1] + (symbols[i] != GONE)
        over, cut = _incumbent(symbols), sum(c.isupper() for c in symbols)
        # Ukkonen: each missing letter costs an insert; deleting a truncated turn costs only one more than keeping it.
        more = over // INSERT
        self.fewer = over // (DELETE - CUT) if over <= cut else cut + (over - cut) // DELETE
        self.left, width = left, self.fewer + more + 1
        self.cost = np.full((n + 1, width + 1), _FAR, np.int64)  # the last column stays out of reach
        shift = np.arange(width) - self.fewer
        ends = INSERT * np.arange(width)
        self.cost[n, :width] = np.where(shift >= 0, INSERT * shift, _FAR)
        for i in range(n - 1, -1, -1):
            k = shift + left[i]
            below = self.cost[i + 1]
            if symbols[i] == GONE:
                best = below[:width] + DELETE
            else:
                fits = np.where(k % 2 == 1, symbols[i].lower() == last, symbols[i].lower() == _other(last))
                stay = below[:width] + np.where(fits, KEEP, REROLE) + CUT * symbols[i].isupper()
                best = np.minimum(below[1:] + DELETE, np.where(k > 0, stay, _FAR))
            best = np.where(k >= 0, best, _FAR)
            self.cost[i, :width] = np.minimum(np.minimum.accumulate(best - ends) + ends, _FAR)
        self.width = width

    def at(self, i: int, k: int) -> int:
        d = k - int(self.left[i]) + self.fewer
        return int(self.cost[i, d]) if 0 <= d < self.width and k >= 0 else _FAR

    def lengths(self, i: int, odd: bool, at_least: int) -> range:
        """The feasible string lengths from turn ``i`` on."""
        low = max(int(self.left[i]) - self.fewer, at_least)
        return range(low + (low % 2 != odd), int(self.left[i]) - self.fewer + self.width, 2)

    def audit(self, i: int, k: int) -> str:
        """The ASCII-least cheapest edits from turn ``i`` on against the last ``k`` letters."""
        out, n = [], len(self.symbols)
        while i < n or k:
            cost = self.at(i, k)
            if i < n and self.at(i + 1, k) + DELETE == cost:
                out.append("D")
                i += 1
            elif k and self.at(i, k - 1) + INSERT == cost:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.symbols[i].lower() == (self.last if k % 2 else _other(self.last)) else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _other(letter: str) -> str:
    return "u" if letter == "a" else "a"


Best = dict[int, tuple[int, str]]


def between(symbols: str, start: int, ends: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)) -> Best:
    """For each state in ``ends`` that ``symbols`` can lead to from ``start``: the least cost and the ASCII-least audit."""
    n, best = len(symbols), {}
    gone = DELETE * n
    if start in ends:
        best[start] = (gone, "D" * n)
    systems = [] if start != START else [(p, DELETE * p + KEEP + CUT * (c == "S")) for p, c in enumerate(symbols) if c in "sS"]
    if systems and SYSTEM in ends:
        _offer(best, SYSTEM, [(cost + DELETE * (n - p - 1), lambda p=p: "D" * p + "K" + "D" * (n - p - 1)) for p, cost in systems])
    for end, last in ((USER, "u"), (ASSISTANT, "a")):
        if end not in ends:
            continue
        table = Alignment(symbols, last)
        found = []
        odd = _NEXT[start] == last
        for length in table.lengths(0, odd, 1):
            found.append((table.at(0, length), lambda k=length: table.audit(0, k)))
        for p, cost in systems:
            # After the s the string begins with u.
            for length in table.lengths(p + 1, last == "u", 1):
                found.append((cost + table.at(p + 1, length), lambda p=p, k=length: "D" * p + "K" + table.audit(p + 1, k)))
        _offer(best, end, found)
    return best


def _offer(best: Best, state: int, found: list) -> None:
    """The cheapest of ``found`` (cost, audit maker) and of what ``best`` has; equal costs by audit."""
    least = min((cost for cost, _ in found), default=_FAR)
    if least >= _FAR:
        return
    audits = [make() for cost, make in found if cost == least]
    best[state] = min([(least, min(audits))] + ([best[state]] if state in best else []))


def repair(symbols: str, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; equal costs by the ASCII-least audit."""
    reached: Best = {START: (0, "")}
    for at in range(0, len(symbols), segment) if symbols else (0,):
        part = symbols[at : at + segment]
        ends = (START, ASSISTANT) if at + segment >= len(symbols) else (START, SYSTEM, USER, ASSISTANT)
        found: Best = {}
        for state, (cost, audit) in reached.items():
            for end, (more, edits) in between(part, state, ends).items():
                new = (cost + more, audit + edits)
                found[end] = min(found.get(end, new), new)
        reached = found
    return min(reached[s] for s in (START, ASSISTANT) if s in reached)


class _Memo:
    """``repair`` with two generations of remembered results."""

    def __init__(self):
        self.young: dict[str, tuple[int, str]] = {}
        self.old: dict[str, tuple[int, str]] = {}

    def __call__(self, symbols: str) -> tuple[int, str]:
        found = self.young.get(symbols) or self.old.get(symbols) or repair(symbols)
        if len(symbols) <= 64:
            if len(self.young) >= MEMO:
                self.old, self.young = self.young, {}
            self.young[symbols] = found
        return found


# -- one conversation, as a stream ----------------------------------------------------


class _Conversation:
    """The counts of one conversation and the hash of its repair."""

    def __init__(self, key):
        self.key = key
        self.symbols: list[str] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.turns = 0
        self.audit, self.cost, self.at = None, 0, 0
        self.hash, self.rows, self.wanted = hashlib.sha256(), 0, "u"

    def symbol(self, turn, initial: str, fault: str | None) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if fault:
            self.faults[fault] += 1
        letter = initial if initial in ("s", "u", "a") else "o"
        self.symbols.append(GONE if fault in ("blank", "duplicate") else letter.upper() if fault else letter)

    def settle(self, repaired: _Memo) -> None:
        """All symbols are there: find the audit, and take the inserts that come first."""
        if self.audit is None:
            self.cost, self.audit = repaired("".join(self.symbols))
            self._inserts()

    def text(self, role: str, text: str) -> None:
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = _ROLES[self.wanted]
        if edit != "D":
            self._row(f"{role}:{text}", role[:1])
        self._inserts()

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._row(f"{_ROLES[self.wanted]}:", self.wanted)

    def _row(self, row: str, letter: str) -> None:
        self.hash.update((f"\n{row}" if self.rows else row).encode("utf-8", "surrogatepass"))
        self.rows += 1
        self.wanted = "a" if letter == "u" else "u"

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, *self.faults.values(), self.illegal, self.cost, self.audit, self.hash.hexdigest())


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    memo, now, done = _Memo(), None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    for batch in batches:
        for key, phase, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.key != key:
                if now is not None:
                    now.settle(memo)
                    done.append(now.result())
                now = _Conversation(key)
            if phase == 1:
                now.symbol(turn, role[:1], fault)
            elif phase == 2:
                now.settle(memo)
                now.text(role, text)
        if len(done) >= 1000:
            yield out()
            done = []
    if now is not None:
        now.settle(memo)
        done.append(now.result())
    if done:
        yield out()


# -- Spark ------------------------------------------------------------------------


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, kept) after the damage: rows repeated, dropped ones without ``kept``; null roles and texts are one space."""
    blank = F.lit(" ")
    part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), blank)
    draw = F.pmod(F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col)).cast("binary")), F.lit(20))
    rows = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), part(role_col).alias("role"), part(text_col).alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv", "turn", F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("draw") != 0).alias("kept"), "draw")
    twice = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv", "turn", "role", "text", "kept", twice.alias("copy")).drop("copy")


def _fault(earlier: Column) -> Column:
    """The first fault of a row: blank, duplicate, truncated or null; ``earlier`` tells duplicates."""
    ended = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    return F.when(ended == "", F.lit("blank")).when(earlier, F.lit("duplicate")).when(~F.substring(ended, -1, 1).isin(".", "!", "?"), F.lit("truncated"))


def repaired(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, harm: bool = True) -> DataFrame:
    """One row per conversation of ``df``: conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    With ``harm`` the rows are first damaged (see ``damaged``). A conversation's
    rows are ordered by turn, null turns first, then by role and text; equal
    rows are neighbours, and all but the first are duplicates. A role counts by
    its initial. Null conversation ids are one conversation. One whose rows
    were all dropped has zeros, an empty audit and the hash of nothing. An empty
    table gives no rows; other columns are not read. Texts of any length pass
    one by one. Each conversation is one stream in one task, as the hash of
    its repair must be, however many rows it has; a task holds a letter a row.
    """
    if harm:
        rows = damaged(df, conv_col, turn_col, role_col, text_col)
    else:
        part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
        rows = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), part(role_col).alias("role"), part(text_col).alias("text"), F.lit(True).alias("kept"))
    # One shuffle by conversation serves both windows and the stream; dropped rows only tell that it existed.
    of_conv = Window.partitionBy("conv", "kept")
    rows = rows.repartition("conv").withColumn("place", F.row_number().over(of_conv.orderBy(F.asc_nulls_first("turn"), "role", "text")))
    earlier = F.row_number().over(Window.partitionBy("conv", "kept", "role", "text").orderBy("place")) > 1
    rows = rows.withColumn("earlier", earlier)
    rows = rows.withColumn("fault", _fault(F.col("earlier")))
    none = F.lit(None)
    symbol = F.struct(F.lit(1).alias("phase"), F.substring("role", 1, 1).alias("role"), none.cast("string").alias("text"))
    whole = F.struct(F.lit(2).alias("phase"), F.col("role").alias("role"), F.col("text").alias("text"))
    gone = F.struct(F.lit(0).alias("phase"), none.cast("string").alias("role"), none.cast("string").alias("text"))
    phases = rows.withColumn("of", F.explode(F.when(F.col("kept"), F.array(symbol, whole)).otherwise(F.array(gone))))
    stream = phases.select("conv", F.col("of.phase").alias("phase"), "turn", F.col("of.role").alias("role"), F.col("of.text").alias("text"), "fault", "place")
    stream = stream.sortWithinPartitions(F.asc_nulls_first("conv"), "phase", "place").drop("place")
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, {_COUNTS}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return stream.mapInArrow(lambda batches: _repaired(batches, arrow), schema).withColumnRenamed("conv", conv_col)
