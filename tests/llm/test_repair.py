from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from geoledger.llm import repair

NEXT = {"E": ("U", "user"), "S": ("U", "user"), "U": ("A", "assistant"), "A": ("U", "user")}
KEEP = {"Es": "S", "Eu": "U", "Su": "U", "Ua": "A", "Au": "U"}


def plain_repair(rows):
    """Cheapest first, then least audit, over (row, state), with whole strings. A row is (fault, role, text)."""
    heap, done = [(0, "", 0, "E", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "EA":
            return cost, audit, list(out)
        after, role = NEXT[state]
        heapq.heappush(heap, (cost + 3, audit + "I", i, after, (*out, (role, ""))))
        if i < len(rows):
            fault, was, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if state + was[:1] in KEEP and was:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, KEEP[state + was[0]], (*out, (was, text))))
                heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, after, (*out, (role, text))))
    raise AssertionError


SPACE = " \t\n\x0b\x0c\r"


def plain_summaries(rows):
    """The contract's columns of (conv_id, turn, role, text), row by row."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        def said(x):
            return " " if x is None else str(x)

        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        held[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, found in held.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for _, role, text in found:
            core = text.rstrip(SPACE)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((fault, role, text))
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, kept = plain_repair(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *[sum(f == x for f, _, _ in judged) for x in repair.FAULTS], illegal, cost, audit, digest))
    return out


def searched(rows):
    edits, out, depth = [], [], 0

    def emit(edit, count, role, row):
        edits.append(edit * count)
        if edit != "D":
            out.append((role or row[0], row[1] if row else ""))

    search = repair.Repairer(emit)
    for fault, role, text in rows:
        if fault in ("blank", "duplicate"):
            search.delete()
        else:
            search.take(role[:1], fault == "truncated", (role, text))
        nodes = set()
        for _, node in search.paths.values():
            while node is not None:
                nodes.add(node)
                node = node.parent
        depth = max(depth, len(nodes))
    return (search.end(), "".join(edits), out), depth


def test_the_search_finds_the_cheapest_and_least_edits():
    rng = random.Random(6)
    for k in range(6000):
        weights = rng.choice([(1, 1, 1, 0), (1, 5, 5, 0), (3, 3, 1, 1), (1, 1, 6, 2)])
        faults = ["", "", "", "truncated", "truncated", "blank"] if k % 2 else ["", "blank", "duplicate", "truncated"]
        rows = [
            (rng.choice(faults), rng.choices(["system", "user", "assistant", "oth"], weights)[0], f"t{i}")
            for i in range(rng.randint(0, 14))
        ]
        assert searched(rows)[0] == plain_repair(rows), rows


def test_bounds_of_the_cut_hold():
    """No rest costs more from one state than from another by more than BEHIND says."""
    rng = random.Random(7)
    names = dict(zip("ESUA", (repair.E, repair.S, repair.U, repair.A), strict=True))
    for _ in range(3000):
        rows = [
            (rng.choice(["", "blank", "truncated"]), rng.choice(["system", "user", "assistant", "x"]), "t")
            for _ in range(rng.randint(0, 7))
        ]
        cost = {q: least_from(rows, q) for q in names}
        for p in names:
            for q in names:
                assert p == q or cost[p] - cost[q] <= repair.BEHIND[names[p], names[q]], (rows, p, q)


def least_from(rows, state):
    costs = {state: 0}
    for fault, role, _ in [*rows, (None, "", "")]:
        for _ in range(2):
            for q, c in list(costs.items()):
                after = NEXT[q][0]
                costs[after] = min(costs.get(after, 99), c + 3)
        if fault is None:
            return min(costs[q] for q in "EA" if q in costs)
        extra, new = (3 if fault == "truncated" else 0), {}
        for q, c in costs.items():
            moves = [(q, c + 4)]
            if fault not in ("blank", "duplicate"):
                moves.append((NEXT[q][0], c + 3 + extra))
                if q + role[0] in KEEP:
                    moves.append((KEEP[q + role[0]], c + extra))
            for to, x in moves:
                new[to] = min(new.get(to, 99), x)
        costs = new
    raise AssertionError


def test_memory_stays_bounded_over_long_conversations():
    rng = random.Random(8)
    rows = [("blank" if rng.random() < 0.1 else "", rng.choice(["user", "assistant", "system"]), "t") for _ in range(30_000)]
    assert searched(rows)[1] <= 30
    one = [("", "system", "t")] + [("blank", "user", "")] * 30_000
    (cost, audit, out), depth = searched(one)
    assert depth <= 8 and audit == "D" * 30_001 and out == [] and cost == 4 * 30_001


def random_rows(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "", None]
    texts = ["Hello there.", "Yes!", "no end", "", " \t", None, "x .", "end. \n", "é?", "A.B.C", ". x"]
    return [
        (rng.choice([None, 1, 2, 3, -4, 50, *range(100, 140)]), rng.choice([None, *range(7)]), rng.choice(roles), rng.choice(texts))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_summaries_equal_a_plain_version(spark, seed):
    rows = random_rows(700, seed)
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, kind string")
    named = repair.named(table, "conv_id", "turn", "role", "text")
    got = [tuple(r) for r in repair.summaries(repair.damaged(named)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_summaries(rows)))


def test_edits_make_up_the_repaired_conversation(spark):
    rows = random_rows(500, 3)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "c string, turn long, role string, text string, place int, fault int")
    done = repair.repair(table, conv="c").collect()
    assert sum(r["edit"] != "I" for r in done) == len(rows)
    held = defaultdict(list)
    for r in done:
        held[r["c"]].append(r)
    for edits in held.values():
        edits.sort(key=lambda r: r["place"])
        assert [r["place"] for r in edits] == list(range(len(edits)))
        roles = "".join(r["role"][:1] for r in edits if r["edit"] != "D").removeprefix("s")
        assert roles == "ua" * (len(roles) // 2)
        assert all(r["turn"] is None for r in edits if r["edit"] == "I")


def test_empty_table_and_long_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = spark.createDataFrame([], schema)
    assert repair.repair(none).count() == 0
    assert repair.summaries(repair.damaged(repair.named(none, "conv_id", "turn", "role", "text"))).count() == 0
    long = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "x" * 500_000 + "!")]
    assert [r["edit"] for r in repair.repair(spark.createDataFrame(long, schema)).collect()] == ["K", "K"]
