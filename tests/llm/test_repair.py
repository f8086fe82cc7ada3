"""Conversation repair against exhaustive search and a plain table of whole strings."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from almanac.llm import queries, repair
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")
ROLES = ("system", "user", "assistant", "tool")


def fault_of(rows, k):
    role, text = rows[k]
    if not WORD.search(text):
        return repair.BLANK
    if (role, text) in rows[:k]:
        return repair.DUPLICATE
    return repair.SOUND if WORD.findall(text)[-1] in ".!?" else repair.CUT


def exhaustive(rows):
    """All edits with at most three insertions in one place: (cost, audit, repaired turns) of the best."""
    best = None
    gaps = ["", "u", "a", "uu", "ua", "au", "aa", "uau", "aua"]

    def choices(k):
        role, text = rows[k]
        fault = fault_of(rows, k)
        yield 4, "D", []
        if fault not in (repair.BLANK, repair.DUPLICATE):
            more = 3 * (fault == repair.CUT)
            yield more, "K", [(role, text)]
            yield 3 + more, "R", [("user", text)]
            yield 3 + more, "R", [("assistant", text)]

    for added in itertools.product(gaps, repeat=len(rows) + 1):
        if sum(map(len, added)) > 3:
            continue
        for picks in itertools.product(*(list(choices(k)) for k in range(len(rows)))):
            turns, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                turns += [("user" if r == "u" else "assistant", "") for r in added[k]]
                audit += "I" * len(added[k])
                cost += 3 * len(added[k])
                if k < len(rows):
                    cost, audit, turns = cost + picks[k][0], audit + picks[k][1], turns + picks[k][2]
            if GRAMMAR.fullmatch("".join(t[0][0] if t[0] else " " for t in turns)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, turns
    return best


def plain(rows):
    """The same by a table per row and state of (cost, whole audit, all turns)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def widened(table):
        table = dict(table)
        for _ in range(3):
            for x, (cost, audit, turns) in list(table.items()):
                for r in "ua":
                    if (x, r) in step:
                        new = cost + 3, audit + "I", [*turns, ("user" if r == "u" else "assistant", "")]
                        y = step[x, r]
                        if y not in table or new[:2] < table[y][:2]:
                            table[y] = new
        return table

    table = {"": (0, "", [])}
    for k, (role, text) in enumerate(rows):
        fault, new = fault_of(rows, k), {}

        def offer(y, cost, audit, turns, new=new):
            if y not in new or (cost, audit) < new[y][:2]:
                new[y] = cost, audit, turns

        for x, (cost, audit, turns) in table.items():
            offer(x, cost + 4, audit + "D", turns)
        if fault not in (repair.BLANK, repair.DUPLICATE):
            more = 3 * (fault == repair.CUT)
            for x, (cost, audit, turns) in widened(table).items():
                if (x, role[:1]) in step:
                    offer(step[x, role[:1]], cost + more, audit + "K", [*turns, (role, text)])
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (x, r) in step:
                        offer(step[x, r], cost + 3 + more, audit + "R", [*turns, (name, text)])
        table = new
    return min(v for x, v in widened(table).items() if x in ("", "a"))


def streamed(rows):
    one = repair.Repair()
    for k, (role, text) in enumerate(rows):
        one.add(role, text, fault_of(rows, k))
    return one, one.done()


def sha(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def test_edits_are_the_cheapest_and_least():
    draw = random.Random(1)
    for n in (0, 1, 2, 2, 2, 3, 3, 3):
        for _ in range(6):
            rows = [(draw.choice(ROLES), draw.choice(["Fine.", "cut", "", "Other!", f"own{k}."])) for k in range(n)]
            want = exhaustive(rows)
            assert streamed(rows)[1] == (want[0], want[1], sha(want[2])), rows
            assert plain(rows)[:2] == want[:2]


def test_long_conversations_and_ties():
    draw = random.Random(2)
    for n in (5, 9, 14, 40, 120):
        for weights in ((1, 6, 6, 1), (0, 1, 0, 0), (0, 0, 0, 1), (3, 3, 3, 3), (0, 1, 1, 0)):
            for _ in range(8):
                rows = [(draw.choices(ROLES, weights)[0], f"{k}{draw.choice(['.', '.', '', '!'])}" if draw.random() < 0.85 else draw.choice(["", "same."])) for k in range(n)]
                want = plain(rows)
                assert streamed(rows)[1] == (want[0], want[1], sha(want[2])), rows


def test_survivors_coalesce():
    """A sound conversation settles as it goes; one of unknown roles only at its end, at a byte or two a row."""
    sound, _ = streamed([(("user", "assistant")[k % 2], f"{k}.") for k in range(20_000)])
    assert sound.most_held <= 64 and len(sound.audit) > 19_900
    unknown, (cost, audit, _) = streamed([("tool", f"{k}.") for k in range(5001)])
    assert (cost, audit) == (4 + 3 * 5000, "D" + "R" * 5000) and unknown.most_held <= 4 * 5001


def test_detours_are_no_less_than_any_future_needs():
    """What a state can cost more than another over any rows to come: all vectors of costs that rows can lead to."""
    end = tuple(min(3 * len(a) for a, y in repair._inserts[x] if y in (repair.NONE, repair.AFTER_ASSISTANT)) for x in range(4))
    seen, todo, worst = {end}, [end], defaultdict(int)
    while todo:
        v = todo.pop()
        for x, z in itertools.permutations(range(4), 2):
            worst[x, z] = max(worst[x, z], v[z] - v[x])
        for ways in repair._ways.values():
            for cut in (0, 3):
                new = [min(c + (cut if e != "D" else 0) + v[y] for x2, y, c, e, _ in ways if x2 == x) for x in range(4)]
                new = tuple(c - min(new) for c in new)
                if new not in seen:
                    seen.add(new)
                    todo.append(new)
    assert all(worst[k] <= d for k, d in repair._detour.items()), dict(worst)


def digests(rows):
    """The contract's row for a conversation's damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [(a[1][:1] + b[1][:1]) for a, b in itertools.pairwise(rows)]
    own = [r[1:] for r in rows]
    counts = Counter(fault_of(own, k) for k in range(len(own)))
    cost, audit, kept = plain(own)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts[repair.BLANK], counts[repair.DUPLICATE], counts[repair.CUT], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha(kept))


def damage(rows):
    """By conversation: its rows after damage; every conversation has an entry."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if by == 1 else re.sub("[.!?]", "", text) if by == 2 else text
        out[conv] += [(turn, "user" if by == 4 else role, text)] * (0 if by == 0 else 2 if by == 3 else 1)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_query(spark, tmp_path):
    odd = [(1, 0, "user", None), (1, None, None, "No turn."), (1, None, "user", "b."), (1, 1, "assistant", "Fine. \n"), (1, 1, "assistant", "Fine. \n"), (None, 0, "system", "You are."), (None, None, None, None), (2, None, "user", "x"),
           (7, 5, "", "Empty role."), (7, 9, "s", "Initial only!"), (7, 9, "user", "中文。"), (8, 3, "user", "long. " * 50_000), (8, 4, "assistant", "w" * 300_000)]
    odd += [(k, 0, "user", "Only one.") for k in range(20, 60)]
    odd += [(9, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(3000)]
    spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    for where in (data.DATA, data.DATA.replace("0.001", "0.01"), str(tmp_path)):
        rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{where}/conversations.parquet").collect()]
        want = {conv: digests(own) for conv, own in damage(rows).items()}
        got = queries.op13_repair(spark, where).collect()
        assert len(got) == len(want) and {r.conv_id: tuple(r[c] for c in NAMES) for r in got} == want
    assert any(v[-1] == hashlib.sha256().hexdigest() and not v[-2] for v in want.values())


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "tool", "T."), (1, 3, "user", "cut"), (2, 0, "assistant", "x."), (None, 0, "user", "q?"), (None, 1, "user", "q?"), (3, 0, "user", " ")]
    turns = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, edit string, position int")
    sums = {r.conv_id: r.repaired_sha256 for r in repair.repair_conversations(turns).collect()}
    found = defaultdict(list)
    for r in repair.repaired_turns(turns).orderBy("position").collect():
        found[r.conv_id].append((r.role, r.text))
    assert {k: sha(found[k]) for k in sums} == sums and set(sums) == {1, 2, 3, None}
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.repair_conversations(none).collect() == [] and repair.repaired_turns(none).collect() == []


def test_many_partitions(spark):
    """Conversations over several partitions after adaptive planning, one of them with a third of all rows."""
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") / 12).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 6 < 3, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id"), F.when(F.col("id") % 11 == 0, "").otherwise(F.lit("."))).alias("text"),
    )
    got = {r.conv_id: (r.cost, r.audit, r.repaired_sha256) for r in repair.repair_conversations(rows.repartition(8)).collect()}
    by = defaultdict(list)
    for r in rows.orderBy("turn").collect():
        by[r.conv_id].append((r.role, r.text))
    assert set(got) == set(by)
    for conv, own in by.items():
        if conv >= 0 and conv % 50 == 0:
            want = plain(own)
            assert got[conv] == (want[0], want[1], sha(want[2]))
    assert got[-1][0] == streamed(by[-1])[1][0] and len(got[-1][1].replace("I", "")) == n // 3
