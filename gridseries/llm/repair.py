"""Repair of conversations by Knuth's lightest derivation.

A repaired conversation's role initials match ``(s?(ua)+)?``. Items are (rows read, state of that pattern); each edit of the next row,
or an insertion, is a deduction that adds its cost and its letter. The agenda pops the item with the least
(cost, audit): deductions only add cost or, at equal cost, letters, and no audit of an item is the beginning of another one of the same cost,
so the functions are superior and monotone and a popped item is final. It ends when the goal item is popped.

A stretch of rows whose neighbours are not known has one item for each (state before, state after). Stretches
are joined by one more deduction, so a conversation of any length is the work of many tasks.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import staged

START, SYSTEM, USER, ASSISTANT, GOAL = range(5)
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: What a turn of the user or the assistant leads to, by state; another state cannot take it.
AFTER = {START: ("u", USER), SYSTEM: ("u", USER), ASSISTANT: ("u", USER), USER: ("a", ASSISTANT)}
NAMES = {"u": "user", "a": "assistant"}
#: A row is one symbol: its role's initial (o: another one), upper case if truncated; x must be deleted.
MUST_DELETE = "x"
STRETCH_ROWS = 256

Weight = tuple[int, str]
Table = dict[tuple[int, int], Weight]


def lightest(axioms: Iterable[tuple[Weight, Any]], deduce: Callable[[Any, Weight], Iterable[tuple[Weight, Any]]], goals: Callable[[Any], bool], all_goals: bool = False) -> dict[Any, Weight]:
    """Knuth's agenda: final weights of the goal items, the lightest one only or all that can be derived."""
    agenda = [(w, item) for w, item in axioms]
    heapq.heapify(agenda)
    final: dict[Any, Weight] = {}
    found: dict[Any, Weight] = {}
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if goals(item):
            found[item] = weight
            if not all_goals:
                break
        for w, head in deduce(item, weight):
            if head not in final:
                heapq.heappush(agenda, (w, head))
    return found


@lru_cache(maxsize=64)
def row_edits(symbol: str) -> dict[int, list[tuple[int, str, int]]]:
    """(cost, letter, state after) of each edit of a row, by state before."""
    initial = symbol.lower()
    out: dict[int, list[tuple[int, str, int]]] = {}
    for state, (turn, after) in AFTER.items():
        edits = [(COST[DELETE], DELETE, state)]
        if symbol != MUST_DELETE:
            more = TRUNCATED_COST * symbol.isupper()
            if initial == turn:
                edits.append((COST[KEEP] + more, KEEP, after))
            if initial == "s" and state == START:
                edits.append((COST[KEEP] + more, KEEP, SYSTEM))
            edits.append((COST[REROLE] + more, REROLE, after))
        out[state] = edits
    return out


def stretch(symbols: str, before: int, whole: bool) -> dict[int, Weight]:
    """Lightest weight of each state after the rows, from ``before``; of GOAL alone if they are the whole rest of a conversation.

    Items are (rows read, state, whether the last edit was an insertion). A stretch that others follow ends with a row's edit: an insertion belongs to the row after it.
    """
    n = len(symbols)

    def deduce(item: tuple[int, int, bool], weight: Weight) -> Iterator[tuple[Weight, tuple[int, int, bool]]]:
        at, state, _ = item
        cost, audit = weight
        if at < n:
            for more, letter, after in row_edits(symbols[at])[state]:
                yield (cost + more, audit + letter), (at + 1, after, False)
        elif whole and state in (START, ASSISTANT):
            yield weight, (n, GOAL, False)
        if at < n or whole:
            yield (cost + COST[INSERT], audit + INSERT), (at, AFTER[state][1], True)

    def is_goal(item: tuple[int, int, bool]) -> bool:
        return item[1] == GOAL if whole else item[0] == n and not item[2]

    def guarded(item: tuple[int, int, bool], weight: Weight) -> Iterable[tuple[Weight, tuple[int, int, bool]]]:
        return () if item[1] == GOAL else deduce(item, weight)

    found = lightest([((0, ""), (0, before, False))], guarded, is_goal, all_goals=not whole)
    return {state: weight for (_, state, _), weight in found.items()}


@lru_cache(maxsize=50_000)
def solved(symbols: str) -> Weight:
    """Weight of a whole conversation of at most STRETCH_ROWS rows."""
    return stretch(symbols, START, True)[GOAL]


def table(symbols: str) -> Table:
    """Weights of a stretch for every state before and after."""
    return {(q, r): w for q in (START, SYSTEM, USER, ASSISTANT) for r, w in stretch(symbols, q, False).items()}


def joined(left: Table, right: Table) -> Table:
    """Two neighbouring stretches as one: [i, q, j, r] and [j, r, k, s] derive [i, q, k, s]."""
    out: Table = {}
    for (q, r), (cost, audit) in left.items():
        for s in range(GOAL):
            if (r, s) in right:
                more, letters = right[r, s]
                known = out.get((q, s))
                # most sums cost more than what is known, so their audits need not be written out
                if known is None or cost + more <= known[0]:
                    weight = (cost + more, audit + letters)
                    out[q, s] = weight if known is None else min(known, weight)
    return out


def joined_all(tables: list[Table]) -> Table:
    """Many neighbouring stretches as one, by halves."""
    while len(tables) > 1:
        tables = [joined(tables[i], tables[i + 1]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return tables[0] if tables else {(q, q): (0, "") for q in AFTER}


def finished(rows: Table) -> Weight:
    """Weight of the conversation whose rows these are: the turns that are missing at the end are inserted."""
    ends = {state: stretch("", state, True)[GOAL] for state in AFTER}
    return min((w[0] + ends[r][0], w[1] + ends[r][1]) for (q, r), w in rows.items() if q == START)


@dataclass
class Part:
    """What a task has of one conversation: counts, what its ends need to meet their neighbours, and its symbols as stretches."""

    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    n: int = 0
    first: str = ""
    last: str = ""
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    pending: list[str] = field(default_factory=list)
    held: int = 0
    levels: list[Table | None] = field(default_factory=list)

    def add(self, turn: int | None, initial: str, symbol: str, fault: str, copies: int, duplicates: int) -> None:
        """``copies`` equal rows, of which the last ``duplicates`` repeat earlier ones."""
        if not copies:
            return
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.illegal += (self.n > 0 and (self.last + initial) not in LEGAL) + (copies - 1) * (2 * initial not in LEGAL)
        self.first, self.last, self.n = self.first if self.n else initial, initial, self.n + copies
        own = copies - duplicates
        self.blank += copies if fault == "blank" else 0
        if fault != "blank":
            self.duplicate += duplicates
            self.truncated += own if fault == "truncated" else 0
        for letter, times in ((symbol, own), (MUST_DELETE, duplicates)):
            while times:
                taken = min(times, STRETCH_ROWS - self.held)
                self.pending.append(letter * taken)
                self.held, times = self.held + taken, times - taken
                if self.held == STRETCH_ROWS:
                    self._close()

    def _close(self) -> None:
        """Turn the pending rows into a stretch; stretches of the same number of rows are joined, as in a binary counter."""
        made, level = table("".join(self.pending)), 0
        self.pending, self.held = [], 0
        while level < len(self.levels) and self.levels[level] is not None:
            made, self.levels[level] = joined(self.levels[level], made), None
            level += 1
        self.levels += [None] * (level + 1 - len(self.levels))
        self.levels[level] = made

    def whole(self) -> Weight:
        if not any(self.levels):
            return solved("".join(self.pending))
        return finished(self.tables())

    def tables(self) -> Table:
        rest = [table("".join(self.pending))] if self.pending else []
        return joined_all([t for t in reversed(self.levels) if t is not None] + rest)


LEGAL = {"su", "ua", "au"}
_TABLE = "array<struct<q:int,r:int,cost:long,audit:string>>"
_PART = f"conv_id {{kind}}, part long, first_turn long, last_turn long, turns long, n long, first string, last string, blank long, duplicate long, truncated long, illegal long, weights {_TABLE}"
VISIBLE = r"[^\x20\x09-\x0D]"


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows after damage by crc32 of ``conv:turn``; 0 copies if dropped, 2 if repeated. Nulls in text columns, and in the damage key, are one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(as_text(conv), F.lit(":"), as_text(turn)).cast("binary")) % 20
    new_role = F.when(code == 4, "user").otherwise(as_text(role))
    new_text = F.when(code == 1, "").when(code == 2, F.regexp_replace(as_text(text), "[.!?]", "")).otherwise(as_text(text))
    copies = F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long")
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), new_role.alias("role"), new_text.alias("text"), copies.alias("copies"))


def _fault(text: Column) -> Column:
    """What a text shows by itself: 'blank', 'truncated' or ''."""
    last = F.substring(F.regexp_replace(text, r"[\x20\x09-\x0D]+\z", ""), -1, 1)
    return F.when(~text.rlike(VISIBLE), "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")


def _ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text_hash, fault, copies, first): distinct rows with their number, and whether one is the first of its role and text.

    Equal rows are counted before anything is dealt by conversation, and the first of each role and text is found by grouping, so no key has many rows.
    """
    slim = rows.select("conv_id", "turn", F.when(F.col("copies") > 0, F.col("role")).otherwise("").alias("role"), F.when(F.col("copies") > 0, F.xxhash64("text")).otherwise(0).alias("text_hash"), F.when(F.col("copies") > 0, _fault(F.col("text"))).otherwise("").alias("fault"), "copies")
    keys = ["conv_id", "turn", "role", "text_hash", "fault"]
    slim = staged(slim.groupBy(*keys).agg(F.sum("copies").alias("copies")), "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    first = slim.where("copies > 0").groupBy("conv_id", "role", "text_hash", "fault").agg(F.min(place).alias("place"))
    first = first.select("conv_id", F.col("place.turn").alias("turn"), "role", "text_hash", "fault", F.lit(0).cast("long").alias("copies"), F.lit(1).alias("first"))
    both = slim.withColumn("first", F.lit(0)).unionByName(first)
    return both.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.max("first").alias("first"))


def _parts(ordered: DataFrame) -> DataFrame:
    """One row for each conversation and task: its counts and weights."""
    kind = ordered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now, part, done, at_start = TaskContext.get().partitionId(), None, None, [], True
        schema = None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            for conv, turn, role, _, fault, copies, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part is None or conv != now:
                    if part is not None:
                        done.append(_part_row(now, number, part, at_start))
                        at_start = False
                    now, part = conv, Part()
                    if len(done) >= 1000:
                        yield _part_batch(done, schema)
                        done = []
                initial = role[:1]
                symbol = initial if initial in ("s", "u", "a") else "o"
                symbol = MUST_DELETE if fault == "blank" else symbol.upper() if fault == "truncated" else symbol
                part.add(turn, initial, symbol, fault, copies, copies - (1 if first and copies else 0))
        if part is not None:
            done.append(_part_row(now, number, part, True))
            yield _part_batch(done, schema)

    placed = ordered.repartitionByRange("conv_id", "turn", "role", "text_hash").sortWithinPartitions("conv_id", "turn", "role", "text_hash")
    return placed.select("conv_id", "turn", "role", "text_hash", "fault", "copies", "first").mapInArrow(run, _PART.format(kind=kind))


def _part_row(conv: Any, number: int, part: Part, at_edge: bool) -> tuple:
    """A task's first and last conversations may go on in the neighbouring tasks: they keep all weights."""
    weights = part.tables() if at_edge else {(START, GOAL): part.whole()}
    listed = [{"q": q, "r": r, "cost": w[0], "audit": w[1]} for (q, r), w in weights.items()]
    return conv, number, part.first_turn, part.last_turn, part.turns, part.n, part.first, part.last, part.blank, part.duplicate, part.truncated, part.illegal, listed


def _part_batch(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    number = pa.int64()
    weight = pa.list_(pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", number), ("audit", pa.string())]))
    types = [conv, number, number, number, number, number, pa.string(), pa.string(), number, number, number, number, weight]
    names = ["conv_id", "part", "first_turn", "last_turn", "turns", "n", "first", "last", "blank", "duplicate", "truncated", "illegal", "weights"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


_RESULT = "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _merged(parts: DataFrame) -> DataFrame:
    """One row for each conversation: the parts that tasks have of it, joined. A group has a row for each task that met the conversation.

    A conversation inside one task has its goal's weight already.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    own = F.col("weights")[0]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    inside = parts.where(own["r"] == GOAL).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", own["cost"].alias("cost"), own["audit"].alias("audit"))

    def merge(group: pa.Table) -> pa.Table:
        rows = group.sort_by("part").to_pylist()
        filled = [r for r in rows if r["n"]]
        turned = [r for r in rows if r["turns"]]
        turns = sum(r["turns"] for r in turned) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:], strict=False))
        gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - turns if turned else 0
        illegal = sum(r["illegal"] for r in rows) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(filled, filled[1:], strict=False))
        tables = [{(w["q"], w["r"]): (w["cost"], w["audit"]) for w in r["weights"]} for r in rows]
        cost, audit = finished(joined_all(tables))
        values = [rows[0]["conv_id"], gaps, *(sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")), illegal, cost, audit]
        types = [group.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string()]
        return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return inside.unionByName(parts.where(own["r"] < GOAL).groupBy("conv_id").applyInArrow(merge, _RESULT.format(kind=kind)))


class Repaired:
    """Applies an audit to rows as they come and hashes what they become."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sum, self.empty = audit, 0, START, hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.sum.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def _turn(self, text: str) -> None:
        initial, self.state = AFTER[self.state]
        self._write(NAMES[initial], text)

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            self._turn("")

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == KEEP:
            self._write(role, text)
            self.state = SYSTEM if role[:1] == "s" else AFTER[self.state][1]
        elif letter == REROLE:
            self._turn(text)

    def digest(self) -> str:
        self._insertions()
        return self.sum.hexdigest()


def _hashed(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Add repaired_sha256: each conversation's audit, then its rows in order, stream through one task. SHA-256 takes its input in
    order, so this last step cannot be split; it holds one batch of rows and the audit."""
    kind = merged.schema["conv_id"].dataType.simpleString()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    held = rows.where("copies > 0").withColumn("text_hash", F.xxhash64("text"))
    both = held.unionByName(merged.withColumn("copies", F.lit(0).cast("long")), allowMissingColumns=True)
    placed = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("copies") > 0, "turn", "role", "text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, repaired, kind = None, None, None

        def result() -> list:
            return [*head, repaired.digest()]

        for batch in batches:
            done, kind = [], batch.schema.field("conv_id").type
            for conv, copies, role, text, *facts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not copies:
                    if repaired:
                        done.append(result())
                    head, repaired = [conv, *facts], Repaired(facts[-1])
                for _ in range(copies):
                    repaired.row(role, text)
            yield from made(done, kind)
        if repaired:
            yield from made([result()], kind)

    def made(done: list[list], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if done:
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=["conv_id", *numbers, "repaired_sha256"])

    return placed.select("conv_id", "copies", "role", "text", *numbers).mapInArrow(run, _RESULT.format(kind=kind) + ", repaired_sha256 string")


def repair_conversations(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation after damage.

    Rows are taken by turn, nulls first; rows that share a turn by role, then by a 64-bit hash of the text. Null roles and texts
    are one space, which is blank as a text and no legal initial as a role; an empty role has no legal initial either. Rows whose conv
    is null are one conversation. A conversation without rows after damage has zeros, an empty audit and the hash of
    the empty string. Very long conversations are solved in stretches by many tasks; only their hash is one task's stream. An empty
    table gives an empty result; other columns are not read.
    """
    after = damaged(rows, conv, turn, role, text)
    merged = staged(_merged(staged(_parts(_ordered(after)), "repair-parts")), "repair-audits")
    return _hashed(after, merged).withColumnRenamed("conv_id", conv)
