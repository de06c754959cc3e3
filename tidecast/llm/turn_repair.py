"""Conversation structure repair by generalised LR parsing over the role grammar.

A conversation should read ``(s?(ua)+)?``: an optional system turn, then user and assistant
turns in pairs. Its rows are the tokens. Besides shifting a row (Keep), the parser may
shift it as another role (Rerole), skip it (Delete) or shift a turn that is not there
(Insert), each at a cost. All ways run at once on a graph-structured stack, whose cells
share what lies below; ways that come to equal stacks after the same rows are merged by
the minimum of (cost, audit), the audit being the initials of the edits.

Two ways after the same rows compare in the same order for ever: equal costs of one stack
exclude that one audit is the other and some inserts. So what the next step does depends
on the stacks, their costs above the least, and the order of their audits alone. Ways that
are too far behind to win, whatever follows, are dropped. Steps are computed once per such
situation and kind of row and looked up afterwards; there are a few hundred.

Scale: rows are dealt out by ranges of (conversation, turn, ...), so that a conversation of
any length is spread over tasks. Each task cuts its rows into segments and parses every
segment from each stack that may stand before it. A conversation's segments, without
texts, are then chained in order; last, each segment's edits are written out along the
chosen way. No step holds a conversation's texts together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from tidecast.session import cut_lineage, reach_workers

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
MUST_GO = ("blank", "duplicate")
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
SPACE = "\\x20\\x09-\\x0D"
ROWS, CHARS = 4096, 1 << 21  # of a segment, but one row at least
STEPS = 200_000  # situations that a worker remembers

#: The role grammar: a left side and its right sides.
GRAMMAR = {"C": ("", "P", "sP"), "P": ("ua", "Pua")}
START = "C"


# ---- LR tables and the graph-structured stack ----------------------------------------


class Table:
    """LR(0) item sets of a grammar of one-letter symbols; reductions where a set holds one complete item and nothing else, or the input ends."""

    def __init__(self, grammar: dict[str, tuple[str, ...]], start: str):
        self.grammar = grammar | {"": (start,)}
        self.sets: list[frozenset] = []
        self.goto: dict[tuple[int, str], int] = {}
        self._set(frozenset({("", start, 0)}))

    def _closure(self, items: frozenset) -> frozenset:
        out, todo = set(items), list(items)
        while todo:
            _, right, dot = todo.pop()
            for more in self.grammar.get(right[dot:dot + 1] or None, ()):
                item = (right[dot], more, 0)
                if item not in out:
                    out.add(item)
                    todo.append(item)
        return frozenset(out)

    def _set(self, kernel: frozenset) -> int:
        items = self._closure(kernel)
        if items in self.sets:
            return self.sets.index(items)
        number = len(self.sets)
        self.sets.append(items)
        for symbol in sorted({right[dot] for _, right, dot in items if dot < len(right)}):
            moved = frozenset((left, right, dot + 1) for left, right, dot in items if right[dot:dot + 1] == symbol)
            self.goto[number, symbol] = self._set(moved)
        return number

    def complete(self, state: int) -> list[tuple[str, int]]:
        """(left side, length) of the rules that can be reduced in a state."""
        return sorted((left, len(right)) for left, right, dot in self.sets[state] if dot == len(right) and left)

    def only_reduces(self, state: int) -> bool:
        return len(self.sets[state]) == 1 and bool(self.complete(state))

    def accepts(self, state: int) -> bool:
        return ("", START, 1) in self.sets[state]


class Stacks:
    """Stacks as numbered cells (state, cell below); equal stacks are one cell."""

    def __init__(self, table: Table):
        self.table = table
        self.cells: list[tuple[int, int]] = []
        self.number: dict[tuple[int, int], int] = {}
        self.moves: dict[tuple[int, str], int] = {}
        self.empty = self._cell(0, -1)

    def _cell(self, state: int, below: int) -> int:
        cell = (state, below)
        if cell not in self.number:
            self.number[cell] = len(self.cells)
            self.cells.append(cell)
        return self.number[cell]

    def _reduce(self, top: int, left: str, length: int) -> int:
        for _ in range(length):
            top = self.cells[top][1]
        return self._cell(self.table.goto[self.cells[top][0], left], top)

    def shift(self, top: int, symbol: str) -> int:
        """The stack after a terminal and the reductions that follow by themselves; -1: none."""
        if (top, symbol) not in self.moves:
            state = self.table.goto.get((self.cells[top][0], symbol), -1)
            new = -1 if state < 0 else self._cell(state, top)
            while new >= 0 and self.table.only_reduces(self.cells[new][0]):
                new = self._reduce(new, *self.table.complete(self.cells[new][0])[0])
            self.moves[top, symbol] = new
        return self.moves[top, symbol]

    def accepts(self, top: int) -> bool:
        """Whether the input may end here."""
        seen, todo = set(), [top]
        while todo:
            top = todo.pop()
            if self.table.accepts(self.cells[top][0]):
                return True
            for left, length in self.table.complete(self.cells[top][0]):
                new = self._reduce(top, left, length)
                if new not in seen:
                    seen.add(new)
                    todo.append(new)
        return False

    def all(self) -> list[int]:
        """Every stack that some rows lead to (the language is regular: finitely many)."""
        out, k = [self.empty], 0
        while k < len(out):
            for symbol in "sua":
                new = self.shift(out[k], symbol)
                if new >= 0 and new not in out:
                    out.append(new)
            k += 1
        return out


# A situation: (stack, cost above the least, stand-in of the audit) of each way, by stack.
Situation = tuple[tuple[int, int, str], ...]
Way = tuple[int, str, int, str, str]  # cost, audit, number of the way before, edits and roles since


@dataclass
class Step:
    """From one situation to the next: for each way after it, the way before it and the edits between."""

    after: Situation
    least: int
    source: list[int]
    edits: list[str]
    roles: list[str]


def stand_ins(ways: Iterable[tuple[int, int, str]]) -> tuple[Situation, int]:
    """Ways with short audits that compare as the given ones do, and the least cost."""
    ways = sorted(ways, key=lambda w: w[2])
    least = min(w[1] for w in ways)
    out, base, group = [], None, -1
    for stack, cost, audit in ways:
        if base is None or not (audit.startswith(base) and set(audit[len(base):]) <= {"I"}):
            base, group = audit, group + 1
        out.append((stack, cost - least, chr(0x100 + group) + audit[len(base):]))
    return tuple(sorted(out)), least


class Repairer:
    """The parser: situations, and the steps between them."""

    def __init__(self):
        self.stacks = Stacks(Table(GRAMMAR, START))
        self.steps: dict[tuple[Situation, str | None, str | None], Step] = {}
        #: before any row
        self.start: Situation = ((self.stacks.empty, 0, chr(0x100)),)
        self.lag = self._lags()

    def _lags(self) -> dict[tuple[int, int], int]:
        """(x, y) -> by how much a way at stack x can fall behind one at y at most, whatever
        rows follow, if it answers each edit of y as well as it can. A way that is further
        behind than that of another way cannot win. Iterated from 0 until nothing changes."""
        stacks, shift = self.stacks.all(), self.stacks.shift
        reach = {x: {x: 0} for x in stacks}  # by inserts
        for x in stacks:
            todo = [x]
            while todo:
                at = todo.pop()
                for role in NAMES:
                    new = shift(at, role)
                    if new >= 0 and reach[x].get(new, 1 << 30) > reach[x][at] + INSERT:
                        reach[x][new] = reach[x][at] + INSERT
                        todo.append(new)
        lag = {(x, y): 0 for x in stacks for y in stacks}
        while True:
            new = {}
            for x, y in lag:
                worst = min(paid for z, paid in reach[x].items() if self.stacks.accepts(z)) if self.stacks.accepts(y) else 0
                for symbol in "sua":
                    after = shift(y, symbol)
                    if after < 0:
                        continue
                    same = [(paid, shift(z, symbol)) for z, paid in reach[x].items()]
                    answers = [paid + lag[to, after] for paid, to in same if to >= 0]
                    deletes = [paid + DELETE + lag[z, after] for z, paid in reach[x].items()]
                    worst = max(worst, min(answers + deletes))  # y keeps, or reroles at a cost that an answer by Rerole has too
                    if symbol in NAMES:
                        worst = max(worst, min(paid + lag[z, after] for z, paid in reach[x].items()) - INSERT)
                new[x, y] = worst
            if new == lag:
                return lag
            lag = new

    def _inserts(self, best: dict[int, Way]) -> None:
        """Adds the ways that end with inserts where they are better."""
        todo = list(best)
        while todo:
            stack = todo.pop()
            cost, audit, k, edits, roles = best[stack]
            for role in NAMES:
                if self._offer(best, new := self.stacks.shift(stack, role), (cost + INSERT, audit + "I", k, edits + "I", roles + role)):
                    todo.append(new)

    @staticmethod
    def _offer(best: dict[int, Way], stack: int, way: Way) -> bool:
        if stack < 0 or stack in best and best[stack][:2] <= way[:2]:
            return False
        best[stack] = way
        return True

    def _step(self, before: Situation, symbol: str | None, fault: str | None) -> Step:
        """Over one row, inserts before it included; symbol None: only the inserts after the last row."""
        shift, offer = self.stacks.shift, self._offer
        best: dict[int, Way] = {stack: (cost, audit, k, "", "") for k, (stack, cost, audit) in enumerate(before)}
        self._inserts(best)
        if symbol is not None:
            opened, best = best, {}
            for stack, (cost, audit, k, edits, roles) in opened.items():
                offer(best, stack, (cost + DELETE, audit + "D", k, edits + "D", roles + "-"))
                if fault not in MUST_GO:
                    cost += TRUNCATED if fault else 0
                    if symbol:
                        offer(best, shift(stack, symbol), (cost + KEEP, audit + "K", k, edits + "K", roles + symbol))
                    for role in NAMES:
                        offer(best, shift(stack, role), (cost + REROLE, audit + "R", k, edits + "R", roles + role))
            # what inserts after this row reach as well or better need not be carried: the next step finds it again
            closed = dict(best)
            self._inserts(closed)
            best = {stack: way for stack, way in best.items() if closed[stack] is way}
            costs = {stack: way[0] for stack, way in best.items()}
            best = {stack: way for stack, way in best.items() if not any(cost + self.lag[x, stack] < way[0] for x, cost in costs.items())}
        after, least = stand_ins((stack, way[0], way[1]) for stack, way in best.items())
        ways = [best[stack] for stack, *_ in after]
        return Step(after, least, [w[2] for w in ways], [w[3] for w in ways], [w[4] for w in ways])

    def step(self, before: Situation, symbol: str | None, fault: str | None) -> Step:
        key = (before, symbol, fault)
        known = self.steps.get(key)
        if known is None:
            if len(self.steps) >= STEPS:
                self.steps.clear()
            known = self.steps[key] = self._step(before, symbol, fault)
        return known

    def run(self, entry: int, symbols: Iterable[str], faults: Iterable[str | None]) -> dict[int, tuple[int, list[tuple[str, str]]]]:
        """For each stack after a segment's rows: the cost of the best way from stack
        ``entry``, and its (edits, roles) for each row."""
        now: Situation = ((entry, 0, chr(0x100)),)
        taken: list[Step] = []
        cost = 0
        for symbol, fault in zip(symbols, faults):
            step = self.step(now, symbol, fault)
            taken.append(step)
            now, cost = step.after, cost + step.least
        out = {}
        for k, (stack, more, _) in enumerate(now):
            path = []
            for step in reversed(taken):
                path.append((step.edits[k], step.roles[k]))
                k = step.source[k]
            path.reverse()
            out[stack] = (cost + more, path)
        return out


# ---- rows to segments ------------------------------------------------------------------


def _with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault`` to rows with ``conv_id, turn, role, text, id``: blank, duplicate,
    truncated or null. A row is a duplicate if its conversation has the same role and text
    earlier, by (turn, id). First occurrences come from an aggregate of hashes; only those
    of texts that do occur again are joined back."""
    hashed = rows.withColumn("hash", F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256))
    first = (hashed.groupBy("conv_id", "hash").agg(F.min(F.struct("turn", "id"))["id"].alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("conv_again"), F.col("hash").alias("hash_again"), "first"))
    joined = hashed.join(first, F.col("conv_id").eqNullSafe(F.col("conv_again")) & (F.col("hash") == F.col("hash_again")), "left")
    end = F.substring(F.regexp_replace("text", f"[{SPACE}]+$", ""), -1, 1)
    fault = (F.when(~F.col("text").rlike(f"[^{SPACE}]"), F.lit("blank"))
             .when(F.col("first") != F.col("id"), F.lit("duplicate"))
             .when(~end.isin(".", "!", "?"), F.lit("truncated")))
    return joined.select(*rows.columns, fault.alias("fault"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _schema(conv: DataType, ddl: str) -> StructType:
    return StructType([StructField("conv_id", conv), *StructType.fromDDL(ddl).fields])


SEGMENT = ("segment long, roles array<string>, texts array<string>, faults array<string>, turn_min long, turn_max long, turns long, "
           "illegal long, entries array<int>, exits array<int>, costs array<long>, audits array<string>")


def _segments(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()
        empty, entries = [repairer.stacks.empty], repairer.stacks.all()
        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []  # of the open segment
        conv, is_open, is_first, chars = None, False, False, 0
        done: list[tuple] = []
        size = 0

        def close() -> None:
            nonlocal rows, chars, number, size
            known = [turn for turn, *_ in rows if turn is not None]
            _, roles, texts, kinds = map(list, zip(*rows)) if rows else ([], [], [], [])
            initials = [role[:1] for role in roles]
            ways = [(entry, top, cost, "".join(edits for edits, _ in path)) for entry in (empty if is_first else entries)
                    for top, (cost, path) in repairer.run(entry, initials, kinds).items()]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            done.append((conv, number, roles, texts, kinds, min(known, default=None), max(known, default=None), len(set(known)), illegal,
                         *([w[k] for w in ways] for k in range(4))))
            size += chars + 100 * len(rows)
            number += 1
            rows, chars = [], 0

        for batch in batches:
            for conv_id, turn, role, text, fault, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if is_open and (conv_id != conv or len(rows) >= ROWS or chars >= CHARS):
                    close()
                    is_first = conv_id != conv  # the first conversation of a task may have begun in the task before
                conv, is_open = conv_id, True
                if not gone:
                    rows.append((turn, role, text, fault))
                    chars += len(text)
                if size >= CHARS:
                    yield _batch(done, schema)
                    done, size = [], 0
        if is_open:
            close()
        if done:
            yield _batch(done, schema)

    return run


CHOSEN = ("segment long, entry int, exit int, tail string, place long, "
          "report struct<gaps:long,illegal:long,cost:long,audit:string>")


def _chain(schema: pa.Schema):
    """Segments without texts, in order, to the way through each; the last of a conversation
    has the inserts after all rows (``tail``) and the report."""

    def rows(repairer: Repairer, parts: list[dict]) -> list[tuple]:
        now, cost = repairer.start, 0
        taken: list[dict[int, tuple[int, str]]] = []  # of each segment: stack after -> stack before, audit
        for part in parts:
            best: dict[int, tuple[int, str, int, str]] = {}
            before = {stack: (more, audit) for stack, more, audit in now}
            for entry, top, paid, audit in zip(part["entries"], part["exits"], part["costs"], part["audits"]):
                if entry in before:
                    way = (before[entry][0] + paid, before[entry][1] + audit, entry, audit)
                    if top not in best or way[:2] < best[top][:2]:
                        best[top] = way
            taken.append({top: way[2:] for top, way in best.items()})
            now, least = stand_ins((top, way[0], way[1]) for top, way in best.items())
            cost += least
        end = repairer.step(now, None, None)
        more, _, k = min((more, audit, k) for k, (top, more, audit) in enumerate(end.after) if repairer.stacks.accepts(top))
        cost += end.least + more
        top, tail = now[end.source[k]][0], end.roles[k]
        path = []
        for choices in reversed(taken):
            entry, audit = choices[top]
            path.append((entry, top, audit))
            top = entry
        path.reverse()
        illegal = place = distinct = 0
        least_turn = last_turn = last_initial = None
        out = []
        for part, (entry, top, audit) in zip(parts, path):
            if part["begins"] is not None:
                illegal += part["illegal"] + (last_initial is not None and last_initial + part["begins"] not in LEGAL)
                last_initial = part["ends"]
            if part["turn_min"] is not None:
                distinct += part["turns"] - (part["turn_min"] == last_turn)
                least_turn = part["turn_min"] if least_turn is None else least_turn
                last_turn = part["turn_max"]
            out.append((part["conv_id"], part["segment"], entry, top, "", place, None))
            place += len(audit)
        gaps = 0 if least_turn is None else last_turn - least_turn + 1 - distinct
        report = {"gaps": gaps, "illegal": illegal, "cost": cost, "audit": "".join(audit for *_, audit in path) + "I" * len(tail)}
        return [*out[:-1], (*out[-1][:4], tail, out[-1][5], report)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()
        parts: list[dict] = []
        done: list[tuple] = []
        for batch in batches:
            for part in batch.to_pylist():
                if parts and part["conv_id"] != parts[0]["conv_id"]:
                    done += rows(repairer, parts)
                    parts = []
                    if len(done) >= 2000:
                        yield _batch(done, schema)
                        done = []
                parts.append(part)
        if parts:
            done += rows(repairer, parts)
        if done:
            yield _batch(done, schema)

    return run


def _written(schema: pa.Schema, whole: bool):
    """Rows of segments with their chosen way: the edits, or one text for each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()
        done: list[tuple] = []
        size = 0
        for batch in batches:
            for conv, segment, roles, texts, kinds, entry, exit_, tail, place in zip(*(c.to_pylist() for c in batch.columns)):
                _, path = repairer.run(entry, [role[:1] for role in roles], kinds)[exit_]
                rows = []
                for role, text, kind, (edits, symbols) in zip(roles, texts, kinds, path):
                    for edit, symbol in zip(edits, symbols):
                        rows.append((edit, None, NAMES[symbol], "") if edit == "I" else (edit, kind, NAMES[symbol] if edit == "R" else role, text))
                rows += [("I", None, NAMES[symbol], "") for symbol in tail]
                if whole:
                    kept = [f"{role}:{text}" for edit, _, role, text in rows if edit != "D"]
                    if kept:
                        done.append((conv, segment, "\n".join(kept)))
                else:
                    done += [(conv, place + k, *row) for k, row in enumerate(rows)]
                size += sum(map(len, texts)) + 100 * len(rows)
                if size >= CHARS:
                    yield _batch(done, schema)
                    done, size = [], 0
        if done:
            yield _batch(done, schema)

    return run


class RepairedTurns:
    """Repairs rows ``conv_id, turn, role, text`` of conversations (other columns are not
    looked at) and gives the results as tables.

    Rows stand in order of turn (nulls first), then role and text; repeated rows are rows.
    Null roles and texts are one space, so such a row is blank or of no known role; a null
    ``conv_id`` is one more conversation. The first letter of a role is its symbol; an
    empty role has none, and only Rerole or Delete fits it. A conversation all of whose
    rows are ``gone`` is there without rows. An empty table gives empty tables. Texts may
    be of any length; one row is one value in memory."""

    def __init__(self, turns: DataFrame, gone: Column | None = None):
        reach_workers(turns.sparkSession)
        conv = turns.schema["conv_id"].dataType
        rows = cut_lineage(turns.select(  # written once, so that ids stay what they are
            "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.lit(False) if gone is None else gone).alias("gone"),
            F.monotonically_increasing_id().alias("id")))
        marks = rows.where("gone").select("conv_id", "turn", F.lit("").alias("role"), F.lit("").alias("text"), "gone", "id", F.lit(None).cast("string").alias("fault"))
        keys = ["conv_id", "turn", "role", "text", "id"]
        placed = _with_faults(rows.where("not gone")).unionByName(marks).repartitionByRange(*keys).sortWithinPartitions(*keys)
        kind = _schema(conv, SEGMENT)
        self.segments = cut_lineage(placed.select("conv_id", "turn", "role", "text", "fault", "gone").mapInArrow(_segments(to_arrow_schema(kind)), kind))
        small = self.segments.select(
            "conv_id", "segment", F.substring(F.get("roles", F.lit(0)), 1, 1).alias("begins"), F.substring(F.get("roles", F.size("roles") - 1), 1, 1).alias("ends"),
            "turn_min", "turn_max", "turns", "illegal", "entries", "exits", "costs", "audits")
        kind = _schema(conv, CHOSEN)
        chained = small.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(_chain(to_arrow_schema(kind)), kind)
        self.chosen = cut_lineage(chained)
        self.conv = conv

    def report(self) -> DataFrame:
        """conv_id, gaps (turn numbers missing between the least and the greatest), blank,
        duplicate, truncated (rows by first fault), illegal (neighbours whose roles may not
        follow each other), cost, audit (initials of the edits, in order)."""
        def of(kind: str) -> Column:
            return F.sum(F.size(F.filter("faults", lambda x: x == kind))).cast("long").alias(kind)

        found = self.segments.groupBy(F.col("conv_id").alias("conv")).agg(of("blank"), of("duplicate"), of("truncated"))
        last = self.chosen.where("report IS NOT NULL").select("conv_id", "report.*")
        return last.join(found, F.col("conv_id").eqNullSafe(F.col("conv"))).select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def _ways(self) -> DataFrame:
        return self.segments.drop("conv_id").join(self.chosen.drop("report"), "segment").select(
            "conv_id", "segment", "roles", "texts", "faults", "entry", "exit", "tail", "place")

    def edits(self) -> DataFrame:
        """conv_id, place (from 0), edit (K, R, D or I), fault, role and text after the edit (of a deleted row: as they were)."""
        kind = _schema(self.conv, "place long, edit string, fault string, role string, text string")
        return self._ways().mapInArrow(_written(to_arrow_schema(kind), False), kind)

    def texts(self) -> DataFrame:
        """conv_id, segment, text: the repaired turns as lines ``role:text``, in pieces of bounded size that follow each other by segment."""
        kind = _schema(self.conv, "segment long, text string")
        return self._ways().mapInArrow(_written(to_arrow_schema(kind), True), kind)
