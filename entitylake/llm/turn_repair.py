"""Conversation structure repair by Viterbi search with survivor coalescence.

A conversation is well formed when the first letters of its roles read ``(s?(ua)+)?``.  Every row is
kept, given another role or deleted, and empty turns may be inserted anywhere, at least cost; of the
cheapest ways the one whose edit letters (K, R, D, I) are least in ASCII order is taken.

Four states say what has been put out: nothing, a system turn, a user turn, an assistant turn.  The
survivor of a state is the cheapest way into it, unless another survivor is cheaper however the conversation
goes on (GAP); ways are kept as a tree of edits with pointers back and
counts of the references to each edit.  An edit that no survivor descends from goes at once, and when
only one edit is left below the last one put out, all survivors share it: it is put out and
forgotten.  Memory is what the survivors do not agree on yet.  Ways of equal cost are compared by
their complete edits since they parted.  (Two such ways into a state have equal rows behind
them, and none is the beginning of the other, or it would be cheaper; so the order holds for all that follows.)

Scale: rows are dealt by conversation once and sorted, then stream through the search; the repeated turns
of a conversation are found by a window of the same dealing.  The sort spills; no conversation is
collected.  A conversation is one sequence, so its rows pass through one task, however long it is.

Defined results: null roles and texts count as one space; rows are taken by turn (nulls first), then role, then
text; rows with a null conversation id are one conversation; a role without a letter at its
start, also the empty one, fits no place and is never kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1  # added for a truncated row that is not deleted
USER, ASSISTANT = "user", "assistant"
#: What may follow a state: the initial of the next turn -> the state after it.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
GIVEN = {0: (USER, 2), 1: (USER, 2), 2: (ASSISTANT, 3), 3: (USER, 2)}  # the role that rerole or insert gives, and the state after it
ACCEPTING = (0, 3)
#: GAP[a][b]: at most this much more does it cost to go on from state a than from b, whatever rows follow: by an
#: insertion (2), two (4), or deleting a system turn that only the beginning may keep (3).
GAP = {0: {1: 0, 2: 2, 3: 0}, 1: {0: 4, 2: 2, 3: 4}, 2: {0: 5, 1: 2, 3: 2}, 3: {0: 3, 1: 0, 2: 2}}
EDITS = "conv_id long, seq long, edit string, turn long, role string, text string, cost long, fault string, last boolean"


def or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def faults(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, fault)`` dealt by conversation and sorted; fault: blank, duplicate, truncated or null."""
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), or_space(F.col("role")).alias("role"), or_space(F.col("text")).alias("text")
    ).repartition("conv_id")
    order = (F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first())) > 1
    last = F.expr("right(body, 1)")
    rows = rows.withColumn("again", again).withColumn("body", F.rtrim("text", F.lit(SPACE)))
    fault = F.when(F.col("body") == "", "blank").when(F.col("again"), "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    return rows.select("conv_id", "turn", "role", "text", fault.alias("fault")).sortWithinPartitions("conv_id", *order)


class Edit:
    __slots__ = ("up", "depth", "letter", "row", "refs", "below")

    def __init__(self, up: Edit | None, letter: str, row: tuple | None):
        self.up, self.letter, self.row = up, letter, row
        self.depth = up.depth + 1 if up else 0
        self.refs, self.below = 0, {}  # survivors that end here, and the edits that follow (by their id)


class Search:
    """The survivors of one conversation; ``step`` takes its rows in order and returns the edits that are settled."""

    def __init__(self):
        self.root = Edit(None, "", None)
        self.live: dict[int, tuple[int, Edit]] = {}
        self._follow({0: (0, self.root)})

    def _before(self, a: tuple[Edit, str], b: tuple[Edit, str]) -> bool:
        """Whether way ``a`` (an edit and the letter after it) reads before ``b``: their edits since they parted."""
        x, y = [a[1]], [b[1]]
        a, b = a[0], b[0]
        while a is not b:
            if a.depth >= b.depth:
                x.append(a.letter)
                a = a.up
            else:
                y.append(b.letter)
                b = b.up
        return x[::-1] < y[::-1]

    def _offer(self, ways: dict, state: int, cost: int, up: Edit, letter: str, row: tuple | None) -> None:
        old = ways.get(state)
        if old is None or cost < old[0] or (cost == old[0] and self._before((up, letter), (old[1], old[2]))):
            ways[state] = cost, up, letter, row

    def _follow(self, reached: dict[int, tuple[int, Edit]]) -> None:
        """Survivors after any insertions: settled state by state, cheapest first, then hung into the tree."""
        done: dict[int, tuple[int, Edit]] = {}
        while reached:
            state = min(reached, key=lambda s: (reached[s][0], s))
            cost, edit = done[state] = reached.pop(state)
            role, to = GIVEN[state]
            if to in done:
                continue
            cost, old = cost + COST[INSERT], reached.get(to)
            if old is None or cost < old[0] or (cost == old[0] and self._before((edit, INSERT), (old[1].up, old[1].letter))):
                reached[to] = cost, Edit(edit, INSERT, (None, role, "", None))
        done = {s: way for s, way in done.items() if not any(done[o][0] + GAP[o][s] < way[0] for o in done if o != s)}
        for _, edit in done.values():
            self._hold(edit)
        for _, edit in self.live.values():
            edit.refs -= 1
            self._drop(edit)
        self.live = done

    def _hold(self, edit: Edit) -> None:
        edit.refs += 1
        while edit.up is not None and id(edit) not in edit.up.below:
            edit.up.below[id(edit)] = edit
            edit = edit.up

    def _drop(self, edit: Edit) -> None:
        while edit is not self.root and not edit.refs and not edit.below:
            up = edit.up
            up.below.pop(id(edit), None)
            edit = up

    def _settled(self) -> list[Edit]:
        """The edits all survivors share: as long as one edit follows the root and no survivor ends at the root."""
        out = []
        while len(self.root.below) == 1 and not self.root.refs:
            (self.root,) = self.root.below.values()
            self.root.up = None
            out.append(self.root)
        return out

    def step(self, role: str, fault: str | None, row: tuple) -> list[Edit]:
        ways: dict[int, tuple] = {}
        initial = role[:1]
        for state, (cost, edit) in self.live.items():
            self._offer(ways, state, cost + COST[DELETE], edit, DELETE, row)
            if fault in ("blank", "duplicate"):
                continue
            cost += TRUNCATED * (fault == "truncated")
            if initial in NEXT[state]:
                self._offer(ways, NEXT[state][initial], cost + COST[KEEP], edit, KEEP, row)
            given, to = GIVEN[state]
            self._offer(ways, to, cost + COST[REROLE], edit, REROLE, (row[0], given, row[2], row[3]))
        self._follow({s: (c, Edit(up, letter, r)) for s, (c, up, letter, r) in ways.items()})
        return self._settled()

    def end(self) -> tuple[int, list[Edit]]:
        """Total cost and the edits not put out so far."""
        best = None
        for state in ACCEPTING:
            if state in self.live:
                cost, edit = self.live[state]
                if best is None or cost < best[0] or (cost == best[0] and self._before((edit, ""), (best[1], ""))):
                    best = cost, edit
        out, edit = [], best[1]
        while edit is not self.root:
            out.append(edit)
            edit = edit.up
        return best[0], out[::-1]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits of sorted rows of many conversations, in order, as rows of EDITS."""
    search, now, seq = None, None, 0

    def line(edit: Edit) -> tuple:
        turn, role, text, fault = edit.row
        if edit.letter == DELETE:
            role = text = None
        return now, seq, edit.letter, turn, role, text, None, fault, False

    def finish() -> Iterator[tuple]:
        nonlocal seq
        cost, rest = search.end()
        for edit in rest:
            yield line(edit)
            seq += 1
        yield now, seq, None, None, None, None, cost, None, True

    for conv, turn, role, text, fault in rows:
        if search is None or conv != now:
            if search is not None:
                yield from finish()
            search, now, seq = Search(), conv, 0
        for edit in search.step(role, fault, (turn, role, text, fault)):
            yield line(edit)
            seq += 1
    if search is not None:
        yield from finish()


def _batches(lines: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    chars = 0
    for x in lines:
        held.append(x)
        chars += sum(len(v) for v in x if isinstance(v, str))
        if len(held) == size or chars > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repair(rows: DataFrame) -> DataFrame:
    """Edits of every conversation, one row each and in order (``seq``) within a task: conv_id, seq, edit, turn, role, text,
    fault.  Deleted rows have no role and text, inserted ones no turn.  After a conversation's edits
    a row with ``last`` and a null edit has its ``cost``."""
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("cost", pa.int64()), ("fault", pa.string()), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_edits(_rows_of(batches)), schema)

    return faults(rows).mapInArrow(run, EDITS)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seq (their order), turn (null: inserted), role, text."""
    return repair(rows).filter("edit is not null and edit <> 'D'").select("conv_id", "seq", "turn", "role", "text")


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows of the sorted input and their edits are folded as they stream by: no second shuffle."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    legal = ("su", "ua", "au")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen: list[dict] = []  # one open conversation, and the next once its first row is read

        def watched() -> Iterator[tuple]:
            for row in _rows_of(batches):
                conv, turn, role, _, fault = row
                if not seen or seen[-1]["conv"] != conv:
                    seen.append({"conv": conv, "before": None, "low": None, "at": None, "turns": 0, "illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0})
                s = seen[-1]
                s["illegal"] += s["before"] is not None and s["before"] + role[:1] not in legal
                s["before"] = role[:1]
                if turn is not None:
                    s["low"] = turn if s["low"] is None else s["low"]
                    s["turns"] += turn != s["at"]
                    s["at"] = turn
                if fault:
                    s[fault] += 1
                yield row

        audit, sha, first = [], hashlib.sha256(), True
        for _, _, edit, _, role, text, cost, _, last in _edits(watched()):
            if last:
                s = seen.pop(0)
                gaps = 0 if s["at"] is None else s["at"] - s["low"] + 1 - s["turns"]
                yield s["conv"], gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost, "".join(audit), sha.hexdigest()
                audit, sha, first = [], hashlib.sha256(), True
                continue
            audit.append(edit)
            if edit != DELETE:
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(fold(batches), schema)

    return faults(rows).mapInArrow(
        run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
