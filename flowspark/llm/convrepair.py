"""Repair of the structure of conversations: cheapest edits by a survivor-coalescence Viterbi.

A conversation's rows are read in order by one task, as a stream. A row is kept, gets
another role, or is deleted, and rows can be inserted, so that the role initials end up
as ``(s?(ua)+)?``. The search has four states (nothing yet, after s, after u, after a)
and keeps one survivor for each: the cheapest way there, and among those of equal cost
the one whose letters (D, I, K, R) come first as text.

Survivors are leaves of one backpointer tree with reference counts. What no survivor
needs is released, and as soon as all survivors descend from one child of the root, that
child's edits can't change any more: they are emitted, and the child becomes the root.
So memory holds the unresolved rows only, however long a conversation is. A survivor that
costs more than another one with the edits that lead to as good a state can't win and is
dropped, which lets the others meet.

Equal costs are decided on complete unresolved letters without walking them: every row adds
exactly one of D, K, R to every survivor, so of two survivors none is the beginning of the
other, and the order of their letters is kept as a rank that a further letter can only refine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from flowspark.llm.common import python_ready

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: What may come next in a state: role initials that can be kept, and the state after them.
KEPT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
#: The state after a new role or an inserted row, whose role the state decides.
MADE = [USER, USER, ASSISTANT, USER]
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
FLUSH_ROWS, FLUSH_BYTES = 4096, 1 << 20

EDITS = "step long, edit string, role string, text string, turn long, fault string, illegal boolean, cost int"
DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Node:
    """One row's edits on the way of some survivors: inserts, then D, K or R."""

    __slots__ = ("parent", "state", "letters", "row", "refs", "kids")

    def __init__(self, parent: Node | None, state: int, letters: str, row: tuple | None):
        self.parent, self.state, self.letters, self.row = parent, state, letters, row
        self.refs, self.kids = 0, []
        if parent is not None:
            parent.refs += 1
            parent.kids.append(self)

    def release(self) -> None:
        """One survivor less; nodes that nobody needs go."""
        node = self
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node.parent.kids.remove(node)
            node = node.parent
            node.refs -= 1


class Search:
    """The survivors of one conversation."""

    def __init__(self):
        self.root = Node(None, NONE, "", None)
        self.root.refs = 1
        #: state -> (cost, rank of the letters, node)
        self.held = {NONE: (0, 0, self.root)}

    def _with_inserts(self) -> dict[int, tuple]:
        """state -> (cost, rank, inserted letters, state before them)."""
        best = {s: (cost, rank, "", s) for s, (cost, rank, _) in self.held.items()}
        for source, target in ((NONE, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if source in best:
                cost, rank, letters, base = best[source]
                made = (cost + INSERT, rank, letters + "I", base)
                best[target] = min(best.get(target, made), made)
        return best

    def add(self, row: tuple, initial: str, fault: str | None) -> None:
        best: dict[int, tuple] = {}

        def offer(state: int, found: tuple) -> None:
            if state not in best or found < best[state]:
                best[state] = found

        extra = TRUNCATED if fault == "truncated" else 0
        for state, (cost, rank, letters, base) in self._with_inserts().items():
            offer(state, (cost + DELETE, rank, letters + "D", base))
            if fault in (None, "truncated"):
                kept = KEPT[state].get(initial)
                if kept is not None:
                    offer(kept, (cost + KEEP + extra, rank, letters + "K", base))
                offer(MADE[state], (cost + REROLE + extra, rank, letters + "R", base))
        for state in _beaten({s: found[0] for s, found in best.items()}):
            del best[state]
        old, held = self.held, {}
        for rank, state in enumerate(sorted(best, key=lambda s: best[s][1:3])):
            cost, _, letters, base = best[state]
            node = Node(old[base][2], base, letters, row)
            node.refs = 1
            held[state] = (cost, rank, node)
        for _, _, node in old.values():
            node.release()
        self.held = held

    def settled(self) -> Iterator[Node]:
        """The rows on whose edits all survivors agree."""
        while self.root.refs == 1 and self.root.kids:
            self.root = self.root.kids[0]
            self.root.parent = None
            yield self.root

    def finish(self) -> Iterator[Node]:
        """All further rows, and the inserts at the end as a node without a row."""
        best = self._with_inserts()
        cost, rank, letters, base = min(best[s] for s in (NONE, ASSISTANT) if s in best)
        way, node = [], self.held[base][2]
        while node is not self.root:
            way.append(node)
            node = node.parent
        yield from reversed(way)
        yield Node(None, base, letters, None)


def _beaten(cost: dict[int, int]) -> list[int]:
    """States whose survivor another one undercuts even with the edits that make up for the difference.

    After a, all goes on as before the first row, but that a system row has to be deleted there.
    """
    far = 1 << 60
    none, system, user, assistant = (cost.get(s, far) for s in range(4))
    ended = min(assistant, user + INSERT)
    out = {
        NONE: none > ended + DELETE, SYSTEM: system > ended, USER: user > min(assistant, system, none) + INSERT,
        ASSISTANT: assistant > user + INSERT,
    }
    return [s for s in cost if out[s]]


def fault_of(text: str, repeated: bool) -> str | None:
    """The first fault of a row: no visible character, said before, no full stop at the end."""
    last = text.rstrip(BLANKS)[-1:]
    if not last:
        return "blank"
    if repeated:
        return "duplicate"
    return None if last in ".!?" else "truncated"


class _Out:
    """Columns of edits, handed on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns, self.bytes = schema, [[] for _ in schema], 0
        self.step = 0

    def put(self, conv, edit, role, text, turn=None, fault=None, illegal=None, cost=0) -> None:
        for column, value in zip(self.columns, (conv, self.step, edit, role, text, turn, fault, illegal, cost)):
            column.append(value)
        self.step += 1
        self.bytes += len(text or "")

    def edits(self, conv, node: Node) -> None:
        state = node.state
        for letter in node.letters:
            if letter == "I":
                state = MADE[state]
                self.put(conv, "I", ROLE[state], "", cost=INSERT)
                continue
            turn, role, text, fault, illegal = node.row
            cost = DELETE
            if letter != "D":
                cost = (REROLE if letter == "R" else KEEP) + (TRUNCATED if fault == "truncated" else 0)
                role = ROLE[MADE[state]] if letter == "R" else role
            self.put(conv, letter, role, text, turn, fault, illegal, cost)

    def full(self) -> bool:
        return len(self.columns[0]) >= FLUSH_ROWS or self.bytes >= FLUSH_BYTES

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
        self.columns, self.bytes = [[] for _ in self.schema], 0
        return batch


def repair(rows: DataFrame, present: str | None = None) -> DataFrame:
    """The cheapest edits of every conversation, in order.

    ``rows`` has conv_id, turn, role and text; other columns are left out. Rows are taken by
    turn (nulls first), then role and text. Null role and text count as one space; a null
    conv_id is a conversation like others. Where the boolean column ``present`` is not true,
    a row only names its conversation.

    Returns conv_id, step (from 0), edit (K, R, D or I), role and text after it (those of a
    deleted row as they were), the row's turn, fault (blank, duplicate, truncated), illegal
    (its role may not follow the row before), cost. A conversation without rows has one row
    of nulls. A conversation's edits lie in one partition and in order.
    """
    python_ready(rows.sparkSession)
    space = F.lit(" ")
    # hidden names for the columns in use: conv_id keeps its own type
    ready = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), F.coalesce(F.col(present), F.lit(False)).alias("there") if present else F.lit(True).alias("there"),
    )
    # one exchange: the window's groups lie within a conversation's partition
    first = Window.partitionBy("conv_id", "there", "role", "text").orderBy(F.asc_nulls_first("turn"))
    ordered = (
        ready.repartition("conv_id").withColumn("nth", F.row_number().over(first))
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "nth")
    )
    schema = StructType([ready.schema["conv_id"], *_parse_datatype_string(EDITS).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, search, before, started = _Out(arrow), None, Search(), "", False

        def end() -> None:
            for node in search.finish():
                out.edits(conv, node)
            if not out.step:
                out.put(conv, None, None, None)

        for batch in batches:
            for this, turn, role, text, there, nth in zip(*[c.to_pylist() for c in batch.columns]):
                if not started or this != conv:
                    if started:
                        end()
                    conv, search, before, started, out.step = this, Search(), None, True, 0
                if there:
                    fault = fault_of(text, nth > 1)
                    initial = role[:1]
                    illegal = before is not None and before + initial not in LEGAL
                    search.add((turn, role, text, fault, illegal), initial, fault)
                    before = initial
                    for node in search.settled():
                        out.edits(conv, node)
                if out.full():
                    yield out.take()
        if started:
            end()
        if out.columns[0]:
            yield out.take()

    return ordered.mapInArrow(run, schema)


def digest(edits: DataFrame) -> DataFrame:
    """One row per conversation from the edits of :func:`repair`, in the order in which they lie there.

    gaps: turns missing between the least and the greatest (nulls don't count, at most the
    greatest long); numbers of faults, of illegal neighbours and the cost; audit: the edits'
    letters; repaired_sha256: of ``role:text`` lines after the edits.
    """
    schema = StructType([edits.schema["conv_id"], *_parse_datatype_string(DIGEST).fields])
    arrow = to_arrow_schema(schema)

    class Fold:
        def __init__(self, conv):
            self.conv, self.low, self.high, self.turns = conv, None, None, 0
            self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
            self.illegal = self.cost = 0
            self.audit, self.hash, self.lines = [], hashlib.sha256(), 0

        def add(self, edit, role, text, turn, fault, illegal, cost) -> None:
            if edit is None:
                return
            self.audit.append(edit)
            self.cost += cost
            self.illegal += bool(illegal)
            if fault:
                self.counts[fault] += 1
            if turn is not None and turn != self.high:
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            if edit != "D":
                self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
                self.lines += 1

        def result(self) -> tuple:
            gaps = min(self.high - self.low + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
            return (self.conv, gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())

    def pack(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, found = None, []
        for batch in batches:
            for conv, step, *edit in zip(*[c.to_pylist() for c in batch.columns]):
                if step == 0:
                    if fold:
                        found.append(fold.result())
                    fold = Fold(conv)
                fold.add(*edit)
            if len(found) >= FLUSH_ROWS:
                yield pack(found)
                found = []
        if fold:
            found.append(fold.result())
        if found:
            yield pack(found)

    return edits.mapInArrow(run, schema)
