"""Repair of the structure of conversations by the cheapest edits.

A repaired conversation is empty, or an optional system message and then pairs of a user's and an assistant's. Each
row is kept, given another role or deleted, and empty messages may be inserted; of the cheapest edits those with the
least audit string win. The search is a Viterbi over four states: nothing yet (E), behind a system message (S), behind
a user's (U), behind an assistant's (A).

Backpointers form a tree of nodes that count their references. A node that no survivor needs any more goes. Once all
survivors share an ancestor, its edits are final and leave at once, so what stays in memory is the part on which
survivors differ, whatever the length of the conversation. Survivors of equal cost are compared by the whole of that
part. A survivor that costs more than another could ever lose to it is dropped.

Rows meet by conversation in one shuffle, are sorted there and stream through; a long conversation is read as a stream
and never held. Copies are told by a row number in Spark, not by a memory of what was seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoledger.llm.rows import ship

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
E, S, U, A = range(4)
#: State behind a kept message, by state and first letter of its role.
KEEPS = {(E, "s"): S, (E, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: State behind a message whose role is chosen, and the role.
MADE = {E: (U, "user"), S: (U, "user"), U: (A, "assistant"), A: (U, "user")}
#: By how much the rest may cost more from the first state than from the second. From S nothing can be left out but by
#: a pair (6); from A or E one may start a pair, from U one insert leads to A; a system message that only E may keep
#: costs a deletion.
BEHIND = {
    (E, S): 0, (E, U): 3, (E, A): 0,
    (S, E): 6, (S, U): 3, (S, A): 6,
    (U, E): 7, (U, S): 3, (U, A): 3,
    (A, E): 4, (A, S): 0, (A, U): 3,
}
LEGAL = ("su", "ua", "au")
MARKS = ".!?"
WORD = r"[^\x20\x09-\x0D]"
CUT_OFF = r"[.!?][\x20\x09-\x0D]*\z"
FAULTS = ("blank", "duplicate", "truncated")

Run = list  # [edit, count, role, row]: one edit of a row, or so many deletions of rows without a choice


class Node:
    """Edits behind those of the parent, and how many nodes and survivors point here."""

    __slots__ = ("parent", "runs", "refs")

    def __init__(self, parent: Node | None, runs: list[Run]):
        self.parent, self.runs, self.refs = parent, runs, 0


def hold(node: Node | None) -> None:
    """One pointer more. A node points at its parent as long as it is pointed at."""
    while node:
        node.refs += 1
        node = node.parent if node.refs == 1 else None


def release(node: Node | None) -> None:
    """One pointer less."""
    while node:
        node.refs -= 1
        node = None if node.refs else node.parent


def less(one: Node, other: Node) -> bool:
    """Are the edits of one, as a string, before those of the other? Compared from their last common ancestor on."""
    above = {}
    node = one
    while node:
        above[id(node)] = True
        node = node.parent
    tails: list[list[Run]] = []
    common = other
    while id(common) not in above:
        common = common.parent
    for node in (one, other):
        runs: list[Run] = []
        while node is not common:
            runs = node.runs + runs
            node = node.parent
        tails.append(runs)
    left, right = iter(tails[0]), iter(tails[1])
    a, n, b, m = "", 0, "", 0
    while True:
        if not n:
            a, n = next(left, ("", 0, None, None))[:2]
        if not m:
            b, m = next(right, ("", 0, None, None))[:2]
        if a != b or not n:
            return a < b
        n, m = n - min(n, m), m - min(n, m)


class Repairer:
    """The search over one conversation. `emit` gets the final edits in order: (edit, count, role, row)."""

    def __init__(self, emit: Callable[[str, int, str | None, object], None]):
        self.emit = emit
        self.root = Node(None, [])
        self.paths: dict[int, tuple[int, Node]] = {}
        self.point({E: (0, self.root)})
        self.insert()

    def point(self, paths: dict[int, tuple[int, Node]]) -> None:
        """New survivors in place of the old ones."""
        for _, node in paths.values():
            hold(node)
        for _, node in self.paths.values():
            release(node)
        self.paths = paths
        for _, node in paths.values():
            self.shorten(node)

    def shorten(self, node: Node) -> None:
        """Takes nodes that only this one points at into it, so that a path has few nodes however long it is."""
        while node is not self.root and (above := node.parent) is not self.root and above.refs == 1:
            for run in node.runs:
                last = above.runs[-1]
                if run[0] == last[0] == "D" and run[3] is None and last[3] is None:
                    last[1] += run[1]
                else:
                    above.runs.append(run)
            node.runs, node.parent = above.runs, above.parent

    @staticmethod
    def better(found: dict[int, tuple[int, Node]], state: int, cost: int, node: Node) -> bool:
        """Takes the path if it is the best to its state so far."""
        if state in found:
            held, other = found[state]
            if held < cost or held == cost and not less(node, other):
                return False
        found[state] = (cost, node)
        return True

    def insert(self) -> None:
        """Survivors with messages inserted behind the last row, without those that have fallen behind for good."""
        found, open_ = dict(self.paths), list(self.paths)
        while open_:
            state = open_.pop(0)
            cost, node = found[state]
            after, role = MADE[state]
            if self.better(found, after, cost + INSERT, Node(node, [["I", 1, role, None]])):
                open_.append(after)
        ahead = list(found.items())
        self.point(
            {
                q: (cost, node)
                for q, (cost, node) in ahead
                if not any(p != q and cost > c + BEHIND[p, q] for p, (c, _) in ahead)
            }
        )

    def delete(self, row: object = None) -> None:
        """A row without a choice: every survivor deletes it. Rows that are not told apart are only counted."""
        moved = {}
        for state, (cost, node) in self.paths.items():
            if node.refs == 1 and node is not self.root:  # no one else's
                last = node.runs[-1]
                if row is None and last[0] == "D" and last[3] is None:
                    last[1] += 1
                else:
                    node.runs.append(["D", 1, None, row])
            else:
                node = Node(node, [["D", 1, None, row]])
            moved[state] = (cost + DELETE, node)
        self.point(moved)
        self.insert()
        self.settle()

    def take(self, initial: str, truncated: bool, row: object) -> None:
        """A row that may be kept, given another role or deleted."""
        found: dict[int, tuple[int, Node]] = {}
        extra = TRUNCATED if truncated else 0
        for state, (cost, node) in self.paths.items():
            self.better(found, state, cost + DELETE, Node(node, [["D", 1, None, row]]))
            if (after := KEEPS.get((state, initial))) is not None:
                self.better(found, after, cost + extra, Node(node, [["K", 1, None, row]]))
            after, role = MADE[state]
            self.better(found, after, cost + REROLE + extra, Node(node, [["R", 1, role, row]]))
        self.point(found)
        self.insert()
        self.settle()

    def settle(self) -> None:
        """Emits the edits that all survivors share."""
        while self.root.refs == 1:
            node = next(iter(self.paths.values()))[1]
            if node is self.root:
                return
            while node.parent is not self.root:
                node = node.parent
            self.advance(node)

    def advance(self, node: Node) -> None:
        for run in node.runs:
            self.emit(*run)
        node.runs, node.parent, self.root = [], None, node

    def end(self) -> int:
        """Emits the rest of the cheapest path and gives its cost."""
        ends = [self.paths[q] for q in (E, A) if q in self.paths]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or other[0] == best[0] and less(other[1], best[1]):
                best = other
        chain, node = [], best[1]
        while node is not self.root:
            chain.append(node)
            node = node.parent
        for node in reversed(chain):
            for run in node.runs:
                self.emit(*run)
        return best[0]


# -- rows -----------------------------------------------------------------------------------------------------------


def spoken(column: str) -> Column:
    """A value as text, one space for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def named(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text) of all rows."""
    names = ((conv, "conv"), (turn, "turn"), (role, "role"), (text, "text"))
    rows = df.select(*[F.col(f"`{theirs}`").alias(ours) for theirs, ours in names])
    return rows.withColumns({"turn": F.col("turn").cast("long"), "role": spoken("role"), "text": spoken("text")})


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with planted faults; `lost` marks those that are dropped, which stay as rows."""
    kind = F.crc32(F.concat(spoken("conv"), F.lit(":"), spoken("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind)
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").when(F.col("kind") == 0, "").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.col("kind") == 0, F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), times.alias("lost"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, lost) with their fault, a conversation's rows together and in order.

    A conversation's rows come by turn, nulls first, and rows of one turn by role and text. One shuffle serves the row
    numbers of copies and the order.
    """
    message = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    together = rows.withColumn("message", F.when(~F.col("lost"), message)).repartition("conv")
    nth = F.row_number().over(Window.partitionBy("conv", "message").orderBy(*order))
    fault = (
        F.when(F.col("lost"), "lost")
        .when(~F.col("text").rlike(WORD), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("text").rlike(CUT_OFF), "truncated")
    )
    return (
        together.withColumn("nth", nth)
        .select("conv", "turn", "role", "text", fault.alias("fault"), "nth")
        .sortWithinPartitions("conv", *order, "nth")
        .drop("nth")
    )


def conversations(batches) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(key, rows) of each conversation, from Arrow batches in order; the rows are an iterator to be read to its end."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True)

    yield from groupby(rows(), key=lambda row: row[0])


class Summary:
    """What a conversation's edits come to: audit string, digest of the repaired messages, counts of faults."""

    def __init__(self):
        self.audit, self.digest, self.first = [], hashlib.sha256(), True

    def edit(self, edit: str, count: int, role: str | None, row: tuple | None) -> None:
        self.audit.append(edit * count)
        if edit != "D":
            said = f"{role or row[0]}:{row[1] if row else ''}"
            self.digest.update((said if self.first else "\n" + said).encode("utf-8", "surrogatepass"))
            self.first = False


SUMMARY = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def summarized(batches):
    """For mapInArrow over rows in order: one row a conversation."""
    import pyarrow as pa

    out: list[tuple] = []
    kind = None

    def made():
        names = ["conv", *[x.split()[0] for x in SUMMARY.split(", ")]]
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def typed():
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield batch

    for key, rows in conversations(typed()):
        summary = Summary()
        search = Repairer(summary.edit)
        faults, illegal, before = dict.fromkeys(FAULTS, 0), 0, None
        turns, low, high = 0, None, None
        for _, turn, role, text, fault in rows:
            if fault == "lost":
                continue
            if turn is not None and turn != high:
                turns, low, high = turns + 1, turn if low is None else low, turn
            if before is not None:
                illegal += before + role[:1] not in LEGAL
            before = role[:1]
            if fault:
                faults[fault] += 1
            if fault in ("blank", "duplicate"):
                search.delete()
            else:
                search.take(before, fault == "truncated", (role, text))
        cost = search.end()
        gaps = high - low + 1 - turns if turns else 0
        out.append((key, gaps, *faults.values(), illegal, cost, "".join(summary.audit), summary.digest.hexdigest()))
        if len(out) == 5000:
            yield made()
    if out:
        yield made()


REPAIRED = "place long, edit string, turn long, role string, text string, fault string"


def edited(batches):
    """For mapInArrow over rows in order: one row an edit, with its place in the conversation's edits."""
    import pyarrow as pa

    out: list[tuple] = []
    kind, size = None, 0

    def made():
        nonlocal size
        names = ["conv", *[x.split()[0] for x in REPAIRED.split(", ")]]
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*out, strict=True))
        out.clear()
        size = 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def typed():
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield batch

    for key, rows in conversations(typed()):
        place = 0

        def put(edit: str, count: int, role: str | None, row: tuple | None, key=key) -> None:
            nonlocal place, size
            turn, was, text, fault = row or (None, None, "", None)
            out.append((key, place, edit, turn, role or was, text, fault))
            place, size = place + 1, size + len(text)

        search = Repairer(put)
        for _, turn, role, text, fault in rows:
            if fault == "lost":
                continue
            if fault in ("blank", "duplicate"):
                search.delete((turn, role, "", fault))
            else:
                search.take(role[:1], fault == "truncated", (turn, role, text, fault))
            if len(out) >= 5000 or size > 4 << 20:
                yield made()
        search.end()
    if out:
        yield made()


def key_type(rows: DataFrame) -> str:
    return rows.schema["conv"].dataType.simpleString()


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each edit: conversation, place among its edits, edit, and the turn, role, text and fault of its row.

    Edits are K (keep), R (another role, the new one stands in `role`), D (delete; the text is left empty) and I (an
    inserted message, without a turn). The repaired conversation is what is not deleted, by place. Null roles and texts
    count as one space, so a null text is blank; rows without a turn come first; rows of one turn come by role and
    text; equal rows are copies, of which the first may stay. Rows without a conversation form one. Very long
    conversations stream, very long texts are held one batch at a time. Other columns are left out; the conversation's
    column keeps its name. An empty table gives no rows.
    """
    ship(df.sparkSession)
    rows = in_order(named(df, conv, turn, role, text).withColumn("lost", F.lit(False)))
    return rows.mapInArrow(edited, f"conv {key_type(rows)}, {REPAIRED}").withColumnRenamed("conv", conv)


def summaries(rows: DataFrame) -> DataFrame:
    """One row a conversation of rows (conv, turn, role, text, lost): faults found, cost, audit string and digest of
    the repaired messages. Of a conversation without rows but lost ones all counts are zero and the audit is empty."""
    ship(rows.sparkSession)
    ordered = in_order(rows)
    return ordered.mapInArrow(summarized, f"conv {key_type(ordered)}, {SUMMARY}")


def op12_survivor_viterbi_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged by hash and repaired by the cheapest edits."""
    rows = named(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id", "turn", "role", "text")
    return summaries(damaged(rows)).withColumnRenamed("conv", "conv_id")


ORACLE = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END),
             4294967295::BIGINT) % 20 AS kind
  FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM src),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
num AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM ordered),
made(q, q2, role) AS (VALUES ('E', 'U', 'user'), ('S', 'U', 'user'), ('U', 'A', 'assistant'), ('A', 'U', 'user')),
moves AS (
  SELECT q, '' AS ins, q AS q2, '' AS said FROM made
  UNION ALL SELECT q, 'I', q2, chr(10) || role || ':' FROM made
  UNION ALL SELECT a.q, 'II', b.q2, chr(10) || a.role || ':' || chr(10) || b.role || ':'
  FROM made a JOIN made b ON a.q2 = b.q),
acts AS (
  SELECT q, 'R' AS edit, NULL::VARCHAR AS initial, q2, role, 3 AS cost FROM made
  UNION ALL SELECT q, 'D', NULL::VARCHAR, q, NULL::VARCHAR, 4 FROM made
  UNION ALL SELECT *, NULL::VARCHAR, 0 FROM (VALUES ('E', 'K', 's', 'S'), ('E', 'K', 'u', 'U'), ('S', 'K', 'u', 'U'),
                                         ('U', 'K', 'a', 'A'), ('A', 'K', 'u', 'U'))),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, 'E' AS q, 0::BIGINT AS cost, '' AS audit, '' AS said
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, q, best.cost, best.audit, best.said
  FROM (
    SELECT p.conv_id, n.i, a.q2 AS q, min(struct_pack(
             cost := p.cost + 3 * length(m.ins) + a.cost
                     + CASE WHEN a.edit <> 'D' AND n.fault = 'truncated' THEN 3 ELSE 0 END,
             audit := p.audit || m.ins || a.edit,
             said := p.said || m.said
                     || CASE WHEN a.edit = 'D' THEN '' ELSE chr(10) || coalesce(a.role, n.role) || ':' || n.text END)) AS best
    FROM paths p JOIN num n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.i = p.i + 1
    JOIN moves m ON m.q = p.q
    JOIN acts a ON a.q = m.q2 AND (a.edit = 'D' OR n.fault NOT IN ('blank', 'duplicate'))
                   AND (a.initial IS NULL OR a.initial = substr(n.role, 1, 1))
    GROUP BY ALL)),
facts AS (
  SELECT c.conv_id, coalesce(max(n.i), 0) AS n_rows,
         coalesce(max(n.turn) - min(n.turn) + 1 - count(DISTINCT n.turn), 0) AS gaps,
         count(*) FILTER (n.fault = 'blank') AS blank, count(*) FILTER (n.fault = 'duplicate') AS duplicate,
         count(*) FILTER (n.fault = 'truncated') AS truncated,
         count(*) FILTER (n.i > 1 AND substr(n.before, 1, 1) || substr(n.role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN num n ON n.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
       sha256(substr(best.said, 2)) AS repaired_sha256
FROM (
  SELECT f.conv_id, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal,
         min(struct_pack(cost := p.cost + 3 * length(m.ins), audit := p.audit || m.ins, said := p.said || m.said)) AS best
  FROM facts f JOIN paths p ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.n_rows
  JOIN moves m ON m.q = p.q AND m.q2 IN ('E', 'A')
  GROUP BY ALL)
"""
