"""Conversation repair against brute force."""

import hashlib
import heapq
import random
import re
import zlib

from conftest import SF01
from tidecast.llm import queries, turn_repair
from tidecast.llm.turn_repair import RepairedTurns, Repairer, stand_ins

# the role grammar as a plain automaton: nothing, after s, after u, after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
WORD = re.compile(r"[^\x20\x09-\x0D]")
SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows, faults):
    """(cost, audit, repaired) by trying edits in order of (cost, audit)."""
    todo, best = [(0, "", 0, 0, ())], None
    while todo:
        cost, audit, i, state, out = heapq.heappop(todo)
        if best is not None and cost > best[0]:
            return best
        if i == len(rows) and state in (0, 3) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, out)
        for r, name in NAMES.items():
            if (state, r) in NEXT and audit.count("I") <= 2 * len(rows) + 2:
                heapq.heappush(todo, (cost + 2, audit + "I", i, NEXT[state, r], (*out, f"{name}:")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(todo, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 1 if faults[i] else 0
                if (state, role[:1]) in NEXT:
                    heapq.heappush(todo, (cost + more, audit + "K", i + 1, NEXT[state, role[:1]], (*out, f"{role}:{text}")))
                for r, name in NAMES.items():
                    if (state, r) in NEXT:
                        heapq.heappush(todo, (cost + 2 + more, audit + "R", i + 1, NEXT[state, r], (*out, f"{name}:{text}")))
    return best


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(SPACE)[-1:]
        out.append("blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else None if end in (".", "!", "?") else "truncated")
        seen.add((role, text))
    return out


def expected(conv, rows):
    """The query's row for (turn, role, text) rows in order."""
    pairs = [r[1:] for r in rows]
    faults = faults_of(pairs)
    cost, audit, out = cheapest(pairs, faults)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def digest(repaired):
    lines = {}
    for r in sorted(repaired.edits().collect(), key=lambda r: (str(r.conv_id), r.place)):
        lines.setdefault(r.conv_id, [])
        if r.edit != "D":
            lines[r.conv_id].append(f"{r.role}:{r.text}")
    return {tuple(r)[0]: (*tuple(r), hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest()) for r in repaired.report().collect()}


def parsed(repairer, symbols, faults, cut=()):
    """Cost, audit and roles over segments that end at ``cut``."""
    now, cost, histories = repairer.start, 0, {repairer.stacks.empty: []}
    for a, b in zip((0, *cut), (*cut, len(symbols))):
        best = {}
        for stack, more, audit in now:
            for top, (paid, path) in repairer.run(stack, symbols[a:b], faults[a:b]).items():
                way = (more + paid, audit + "".join(e for e, _ in path), histories[stack] + path)
                if top not in best or way[:2] < best[top][:2]:
                    best[top] = way
        histories = {top: way[2] for top, way in best.items()}
        now, least = stand_ins((top, *way[:2]) for top, way in best.items())
        cost += least
    end = repairer.step(now, None, None)
    more, _, k = min((m, a, k) for k, (top, m, a) in enumerate(end.after) if repairer.stacks.accepts(top))
    path = histories[now[end.source[k]][0]]
    edits = "".join(e for e, _ in path) + end.edits[k]
    return cost + end.least + more, edits, "".join(r for _, r in path) + end.roles[k]


def test_parser_equals_brute_force_in_any_segments():
    rnd, repairer = random.Random(3), Repairer()
    for _ in range(500):
        n = rnd.randint(0, 6)
        symbols = [rnd.choice(["s", "u", "a", "u", "a", "t", ""]) for _ in range(n)]
        faults = [rnd.choice([None, None, None, "blank", "duplicate", "truncated"]) for _ in range(n)]
        cost, audit, out = cheapest([(s, "") for s in symbols], faults)
        cut = sorted(rnd.choices(range(n + 1), k=rnd.randint(0, 3)))
        got = parsed(repairer, symbols, faults, cut)
        assert got[:2] == (cost, audit) and [r for r in got[2] if r != "-"] == [x[0] for x in out]
        assert re.fullmatch("(s?(ua)+)?", got[2].replace("-", ""))


def test_situations_are_few():
    rnd, repairer = random.Random(4), Repairer()
    symbols = [rnd.choice("suat") for _ in range(60_000)]
    faults = [rnd.choice([None] * 6 + ["blank", "truncated"]) for _ in symbols]
    whole = parsed(repairer, symbols, faults)
    assert len(repairer.steps) < 5000
    assert parsed(repairer, symbols, faults, (1000, 1000, 30_001)) == whole


def test_cases(spark):
    T = "done."
    rows = [(1, 0, "user", "hi."), (1, 1, "assistant", T),                                  # right
            (2, 0, "assistant", T),                                                        # the user is missing
            (3, None, "user", "q?"), (3, None, "user", "q?"), (3, None, "assistant", T),   # repeated rows without turn numbers
            (4, 0, None, "x."), (4, 1, "user", None), (4, 9, "", "y."),                    # nulls, an empty role, gaps
            (5, 0, "system", "s."), (5, 1, "user", "q"), (5, 1, "assistant", "a"),         # ties, truncated
            (6, 0, "system", "s."),                                                        # nothing but the system turn
            (7, 2, "user", "  "), (7, 4, "tool", "t."), (None, 0, "user", "n."), (None, 1, "assistant", "n.")]
    table = spark.createDataFrame([(*r, "extra", 0) for r in rows], "conv_id long, turn long, role string, text string, fault string, segment int")
    got = digest(RepairedTurns(table))
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert got == {c: expected(c, sorted(v, key=key)) for c, v in by.items()}


def test_empty_table_and_conversations_without_rows(spark):
    table = spark.createDataFrame([(1, 0, "user", "x."), (2, 0, "user", "x.")], "conv_id long, turn long, role string, text string")
    none = RepairedTurns(table.limit(0))
    assert none.report().collect() == [] and none.edits().collect() == [] and none.texts().collect() == []
    from pyspark.sql import functions as F
    gone = RepairedTurns(table, gone=F.col("conv_id") == 1)
    assert {tuple(r) for r in gone.report().collect()} == {(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 2, "KI")}
    assert [(r.conv_id, r.edit, r.role) for r in sorted(gone.edits().collect(), key=lambda r: r.place)] == [(2, "K", "user"), (2, "I", "assistant")]


def test_a_conversation_over_many_tasks_and_segments(spark, monkeypatch):
    """One conversation of most rows, in small segments; identical rows are spread too."""
    rnd = random.Random(6)
    rows = [(1, k // 3, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b!", "c", " ", f"{k}."])) for k in range(300)]
    rows += [(c, k, "user", "same.") for c in (0, 2) for k in range(2)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    one = digest(RepairedTurns(table))
    monkeypatch.setattr(turn_repair, "ROWS", 7)
    monkeypatch.setattr(turn_repair, "CHARS", 20)
    many = RepairedTurns(table)
    assert many.segments.where("conv_id = 1").select("segment").distinct().count() > 8
    assert digest(many) == one
    ordered = sorted(((t, r, x) for c, t, r, x in rows if c == 1), key=lambda r: r)
    repairer = Repairer()
    cost, audit, _ = parsed(repairer, [r[:1] for _, r, _ in ordered], faults_of([r[1:] for r in ordered]))
    assert one[1][6:8] == (cost, audit)


def test_query_equals_brute_force(spark):
    talks = {}
    for c, t, role, text in sorted(spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()):
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        rows = talks.setdefault(c, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r) for r in queries.op13_turn_repair(spark, SF01).collect()}
    assert got == {c: expected(c, rows) for c, rows in talks.items()}
