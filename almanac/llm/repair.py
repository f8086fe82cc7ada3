"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation should be an optional system turn and then turns of user and assistant in pairs, (s?(ua)+)?. Its rows stream
in turn order past four states: nothing kept yet, a system turn, a user's, an assistant's. Each state keeps the cheapest
edits that lead to it. What survives is a tree of edits with reference counts: a branch that no survivor needs any more
is given back, and edits that all survivors share are emitted and leave memory.

Nodes of the tree that have one child are merged with it, so there are never more than seven for four survivors, and an
unresolved edit costs a byte a survivor. Equal costs are decided by the complete unresolved edits, the ASCII-least first.
Two survivors' edits never start with one another (each row leaves one letter that is no insertion), so longer ones keep
their order: the survivors' order says which of two is less, whatever comes. A survivor that another one beats even after
the dearest detour to its state is dropped, since it can't win or tie any more. No text is held: each survivor carries the
running digest of its own repaired turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import BLANKS

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
#: States, by the role that stands last.
NONE, SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: A turn's first fault, as the rows carry it.
SOUND, BLANK, DUPLICATE, CUT = range(4)
_next = {(NONE, "s"): SYSTEM, (NONE, "u"): AFTER_USER, (SYSTEM, "u"): AFTER_USER, (AFTER_USER, "a"): AFTER_ASSISTANT, (AFTER_ASSISTANT, "u"): AFTER_USER}
#: Roles that insertions from one state add, none to two, and where they lead: more would come back to a state.
_inserts = {x: [("", x)] for x in range(4)}
for _x, _ways in _inserts.items():
    for _role in "uaua":
        if len(_ways) < 3 and (_ways[-1][1], _role) in _next:
            _ways.append((_ways[-1][0] + _role, _next[_ways[-1][1], _role]))


def _moves() -> dict[tuple[str, bool], list[tuple[int, int, int, str, str]]]:
    """By a row's initial and whether it may stay: (from, to, cost, edits, roles inserted and then the row's new one)."""
    out = {}
    for initial in ("s", "u", "a", ""):
        for may_stay in (True, False):
            ways = []
            for x, inserts in _inserts.items():
                ways.append((x, x, DELETE, "D", ""))
                if not may_stay:
                    continue
                for added, y in inserts:
                    cost, letters = INSERT * len(added), "I" * len(added)
                    if (y, initial) in _next:
                        ways.append((x, _next[y, initial], cost + KEEP, letters + "K", added))
                    for role in "ua":
                        if (y, role) in _next:
                            ways.append((x, _next[y, role], cost + REROLE, letters + "R", added + role.upper()))
            out[initial, may_stay] = ways
    return out


_ways = _moves()
#: What state x costs at most beyond state y for the same rows to come: past that, x is beaten. From any state the edits
#: of another can be followed after the insertions that lead there, or, where a system turn is kept, deleting it.
_detour = {
    (NONE, SYSTEM): 6, (NONE, AFTER_USER): 7, (NONE, AFTER_ASSISTANT): 4, (SYSTEM, NONE): 6, (SYSTEM, AFTER_USER): 6, (SYSTEM, AFTER_ASSISTANT): 3,
    (AFTER_USER, NONE): 3, (AFTER_USER, SYSTEM): 3, (AFTER_USER, AFTER_ASSISTANT): 3, (AFTER_ASSISTANT, NONE): 6, (AFTER_ASSISTANT, SYSTEM): 6, (AFTER_ASSISTANT, AFTER_USER): 3,
}


class Node:
    """A stretch of edits that the same survivors share; refs counts its children and the survivors that end in it."""

    __slots__ = ("up", "edits", "refs")

    def __init__(self, up: Node | None, edits: bytes = b"") -> None:
        self.up, self.edits, self.refs = up, bytearray(edits), 0
        if up:
            up.refs += 1


class Survivor:
    __slots__ = ("state", "cost", "node", "digest", "turns")

    def __init__(self, state: int, cost: int, node: Node, digest, turns: int) -> None:
        self.state, self.cost, self.node, self.digest, self.turns = state, cost, node, digest, turns


class Repair:
    """The cheapest edits of one conversation, row by row; audit gets what is settled. Survivors stand in order of their edits."""

    def __init__(self) -> None:
        self.root = Node(None)
        self.root.refs = 1
        self.survivors = [Survivor(NONE, 0, self.root, hashlib.sha256(), 0)]
        self.audit = bytearray()
        self.most_held = 0

    def add(self, role: str, text: str, fault: int) -> None:
        """One row, by its role's initial; a blank or duplicate one must go."""
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        best: dict[int, tuple] = {}
        by_state = {s.state: (rank, s) for rank, s in enumerate(self.survivors)}
        for x, y, cost, letters, roles in _ways[initial, fault not in (BLANK, DUPLICATE)]:
            if x in by_state:
                rank, s = by_state[x]
                found = (s.cost + cost + (TRUNCATED if fault == CUT and letters != "D" else 0), rank, letters, roles)
                if y not in best or found < best[y]:
                    best[y] = found
        least = {y: f[0] for y, f in best.items()}
        best = {y: f for y, f in best.items() if all(f[0] <= c + _detour[y, z] for z, c in least.items() if z != y)}
        chosen = sorted(best.items(), key=lambda b: b[1][1:3])
        self._grow([(y, cost, self.survivors[rank], letters, self._added(roles, role if letters[-1] == "K" else None, text, letters)) for y, (cost, rank, letters, roles) in chosen])

    @staticmethod
    def _added(roles: str, kept: str | None, text: str, letters: str) -> list[str]:
        """The turns that edits leave, as role:text."""
        out = [f"{USER if r == 'u' else ASSISTANT}:" for r in roles if r.islower()]
        if letters[-1] == "K":
            out.append(f"{kept}:{text}")
        elif letters[-1] == "R":
            out.append(f"{USER if roles[-1] == 'U' else ASSISTANT}:{text}")
        return out

    def _grow(self, chosen: list[tuple]) -> None:
        before, ways = self.survivors, {}
        for c in chosen:
            ways[id(c[2])] = ways.get(id(c[2]), 0) + 1
        now = []
        for state, cost, s, letters, turns in chosen:
            alone = ways[id(s)] == 1
            if alone and s.node.refs == 1:
                s.node.edits += letters.encode()
                node = s.node
            else:
                node = Node(s.node, letters.encode())
            node.refs += 1
            digest, n = s.digest if alone else s.digest.copy(), s.turns
            for turn in turns:
                digest.update((("\n" if n else "") + turn).encode())
                n += 1
            now.append(Survivor(state, cost, node, digest, n))
        for s in before:
            self._release(s.node)
        self.survivors = now
        self._settle()

    def _release(self, node: Node | None) -> None:
        while node and node.up is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.up
        if node:
            node.refs -= 1

    def _settle(self) -> None:
        """Merge nodes with an only child, emit what all survivors share."""
        ends = {id(s.node) for s in self.survivors}
        for s in self.survivors:
            node = s.node
            while node.up is not None:
                up = node.up
                if up.refs == 1 and id(up) not in ends:  # node is its only child
                    up.edits += node.edits
                    node.edits, node.up = up.edits, up.up
                    if up is self.root:
                        self.root = node
                else:
                    node = up
        if self.root.edits:
            self.audit += self.root.edits
            self.root.edits = bytearray()
        nodes = {}
        for s in self.survivors:
            node = s.node
            while node is not None:
                nodes[id(node)] = node
                node = node.up
        self.most_held = max(self.most_held, sum(len(n.edits) for n in nodes.values()))

    def _edits(self, node: Node) -> bytes:
        parts = []
        while node is not None:
            parts.append(bytes(node.edits))
            node = node.up
        return b"".join(reversed(parts))

    def done(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest repair: missing turns at the end are inserted."""
        ends = []
        for rank, s in enumerate(self.survivors):
            for added, y in _inserts[s.state]:
                if y in (NONE, AFTER_ASSISTANT):
                    ends.append((s.cost + INSERT * len(added), rank, "I" * len(added), added))
        cost, rank, letters, added = min(ends)
        s = self.survivors[rank]
        digest, n = s.digest.copy(), s.turns
        for r in added:
            digest.update((("\n" if n else "") + f"{USER if r == 'u' else ASSISTANT}:").encode())
            n += 1
        return cost, (bytes(self.audit) + self._edits(s.node) + letters.encode()).decode(), digest.hexdigest()


def faults(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, fault) per row, a conversation's rows in one partition and in order.

    Null roles and texts count as one blank. In order: by turn, nulls first, then role, then text. A blank row has nothing
    but blanks, a duplicate one's role and text have been seen in an earlier row, a cut one's last character that is no
    blank is not one of ``.!?``; the first of these counts. Rows are shuffled once, by the conversation; equal rows are
    found by sorting there, so no task remembers what it has seen.
    """
    rows = turns.select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    rows = rows.repartition("conv_id").withColumn("_h", F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256))
    again = F.row_number().over(Window.partitionBy("conv_id", "_h").orderBy(F.asc_nulls_first("turn"))) > 1
    blank, end = ~F.col("text").rlike(f"[^{BLANKS}]"), F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(blank, BLANK).when(again, DUPLICATE).when(~end.isin(".", "!", "?"), CUT).otherwise(SOUND)
    rows = rows.select("conv_id", "turn", "role", "text", fault.alias("fault"))
    return rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")


_LEGAL = frozenset(("su", "ua", "au"))
FOUND = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row per conversation.

    gaps counts missing turn numbers between the least and the largest, the others are counts of rows by their fault, and of
    neighbours whose initials can't follow each other. audit holds the cheapest edits in order (K keep, R give another role,
    D delete, I insert an empty turn), the ASCII-least of equal cost, repaired_sha256 the digest of the turns that they
    leave, as lines of role:text. Blank and duplicate rows are deleted, cut ones cost TRUNCATED unless they are. Rows
    without a conversation's id make up one of their own; roles other than the three have to change or go. No rows give none.

    One task reads all of a conversation, as its digest asks, as a stream: it holds a few counters, four digests and the
    edits that are not settled. Very long texts pass once.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 7 + [pa.string(), pa.string()]
        names = [c.split()[0] for c in FOUND.split(", ")]
        key, repair, out = None, None, []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names)

        def finished():
            gaps = last_turn - first_turn + 1 - distinct if first_turn is not None else 0
            out.append((key[0], gaps, *counts[1:], illegal, *repair.done()))

        for batch in batches:
            for conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is None or key[0] != conv:
                    if key is not None:
                        finished()
                    key, repair, counts, illegal = (conv,), Repair(), [0, 0, 0, 0], 0
                    before, first_turn, last_turn, distinct = None, None, None, 0
                if turn is not None and turn != last_turn:
                    first_turn, last_turn, distinct = turn if first_turn is None else first_turn, turn, distinct + 1
                counts[fault] += 1
                illegal += before is not None and before + role[:1] not in _LEGAL
                before = role[:1]
                repair.add(role, text, fault)
            if len(out) >= 4096:
                yield flush()
                out = []
        if key is not None:
            finished()
        yield flush()

    return faults(turns, id_col, turn_col, role_col, text_col).mapInArrow(run, FOUND)


def repaired_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position, role, text, edit): the turns of each repaired conversation, numbered from 0.

    The audit's letters meet the rows again by their number in the conversation; insertions have none. What the edits leave
    alternates between user and assistant but for a kept system turn, which names the new roles."""
    rows = faults(turns, id_col, turn_col, role_col, text_col)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_c"), (F.row_number().over(order) - 1).alias("_n"), "role", "text")
    found = repair_conversations(turns, id_col, turn_col, role_col, text_col)
    edits = found.select("conv_id", F.posexplode(F.split("audit", "")).alias("_k", "edit")).where("edit <> ''")
    by = Window.partitionBy("conv_id").orderBy("_k")
    edits = edits.withColumn("_n", F.when(F.col("edit") != "I", F.count_if(F.col("edit") != "I").over(by) - 1))
    edits = edits.withColumn("_c", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    both = edits.where("edit <> 'D'").join(rows, ["_c", "_n"], "left")
    both = both.withColumn("position", F.row_number().over(by) - 1)
    first = F.max(F.when((F.col("position") == 0) & (F.col("edit") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(Window.partitionBy("conv_id"))
    own = F.when((F.col("position") - first) % 2 == 0, USER).otherwise(ASSISTANT)
    return both.select("conv_id", "position", F.when(F.col("edit") == "K", F.col("role")).otherwise(own).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")


def damaged(turns: DataFrame, by: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """turns with faults for tests and drills, by a column of numbers: 0 drops a row, 1 empties its text, 2 takes the ends
    of its sentences, 3 repeats it, 4 makes it a user's; others leave it. Null roles and texts become one blank."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    text = F.when(F.col("_by") == 1, "").when(F.col("_by") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("_by") == 4, USER).otherwise(F.coalesce(F.col(role_col).cast("string"), F.lit(" ")))
    rows = turns.withColumn("_by", by).where("_by IS NULL OR _by <> 0").withColumns({text_col: text, role_col: role})
    return rows.withColumn("_by", F.explode(F.when(F.col("_by") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_by")
