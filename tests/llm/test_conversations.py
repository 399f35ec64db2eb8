"""Conversation repair against an exhaustive dynamic program over whole audit strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import conversations
from martloom.llm.runtime import Scratch

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """Least (cost, audit, lines) by a forward program on the roles so far; rows are (role, text, fault)."""
    machine = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for r in "ua":
                    if (state, r) in machine:
                        offer(best, machine[state, r], (cost + 2, audit + "I", [*lines, f"{name[r]}:"]))

    def offer(best, state, way):
        if state not in best or way[:2] < best[state][:2]:
            best[state] = way

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        insert(best)
        after = {}
        for state, (cost, audit, lines) in best.items():
            offer(after, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cut = fault == "truncated"
            if (state, role[:1]) in machine:
                offer(after, machine[state, role[:1]], (cost + cut, audit + "K", [*lines, f"{role}:{text}"]))
            for r in "ua":
                if (state, r) in machine:
                    offer(after, machine[state, r], (cost + 2 + cut, audit + "R", [*lines, f"{name[r]}:{text}"]))
        best = after
    insert(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda way: way[:2])


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        fate = zlib.crc32(":".join(shown).encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def expected(rows):
    """One row per conversation, as the query gives it."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = [r for r in damage(rows) if r[0] == conv]
        kept.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        told = faults([r[2:] for r in kept])
        turns = {r[1] for r in kept if r[1] is not None}
        cost, audit, lines = cheapest(told)
        initials = [r[2][:1] for r in kept]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[sum(f == kind for _, _, f in told) for kind in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def query(spark, df, path):
    df.write.parquet(f"{path}/conversations.parquet")
    return conversations.op13_conversation_repair(spark, str(path))


def as_dict(df):
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_search_is_exact_for_all_states():
    """Against all audits of short runs, by brute force over the edits."""
    r = random.Random(5)
    for _ in range(150):
        symbols = tuple(r.choice([0, 1, 2, 4, 5, 7, 8, 9, 12, 13]) for _ in range(r.randint(0, 5)))
        for entry in conversations.STATES:
            best = {}

            def walk(i, state, cost, audit, symbols=symbols, best=best):
                if i == len(symbols):
                    best[state] = min(best.get(state, (10**9, "")), (cost, audit))
                    return
                for initial, more, j, after in conversations.edits_at(symbols, i, state):
                    if not audit.endswith("III"):
                        walk(j, after, cost + more, audit + initial)

            walk(0, entry, 0, "")
            for goal in conversations.STATES:
                assert conversations.search(symbols, entry, goal) == best.get(goal)


def test_search_of_long_runs_ends():
    r = random.Random(6)
    for symbols in [(4,) * 64, (0,) * 64, (12,) * 64, (4, 4, 8, 8) * 16, tuple(r.choice([0, 1, 4, 5, 8, 9, 12, 7]) for _ in range(64))]:
        assert conversations.answers(symbols, 0)[0][0] <= 3 * 64


def test_random_conversations(spark, tmp_path):
    """Nulls, repeated rows, unknown roles, long conversations over several runs, clashing column names."""
    r = random.Random(11)
    rows = []
    for conv in [None, *range(60)]:
        n = r.choice([1, 2, 3, 5, 8, 20]) if conv != 7 else 400
        for turn in range(n):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["Yes.", "No!", "Why", "", " \n", None, f"text {r.random()}.", f"open {r.random()}"])
            rows.append((conv, r.choice([turn, turn, turn + 3, None]), role, text))
    rows += rows[:20]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "conv_id bigint, turn bigint, role string, text string, audit string, row int")
    found = as_dict(query(spark, df.repartition(3), tmp_path))
    assert found == expected(rows)
    assert len(found[7][6]) > 6 * 64


def test_supplied_conversations(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(conversations.op13_conversation_repair(spark, path)) == expected(rows)


def test_dropped_and_empty(spark, tmp_path):
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    zero = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert as_dict(query(spark, df, tmp_path / "one")) == {dropped: zero}
    assert query(spark, df.limit(0), tmp_path / "none").collect() == []


def test_one_conversation_over_many_tasks(spark):
    """A conversation of all rows is ordered and searched in runs by several tasks, with one result."""
    roles = F.element_at(F.array(*[F.lit(x) for x in ("user", "assistant", "user", "system")]), (F.crc32(F.col("id").cast("string")) % 4 + 1).cast("int"))
    df = spark.range(2000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    repaired, report = conversations.repair(df, Scratch(spark))
    row = report.first()
    rows = [(r["role"], r["text"], "") for r in df.orderBy("turn").collect()]
    cost, audit, lines = cheapest(rows)
    assert (row["cost"], row["audit"]) == (cost, audit)
    assert [f"{r['role']}:{r['text']}" for r in repaired.orderBy("run", "place").collect()] == lines


@pytest.mark.parametrize("huge", ["a" * 300_000 + ".", ". " * 100_000, " " * 200_000])
def test_long_texts(spark, tmp_path, huge):
    rows = [(5, 1, "user", huge), (5, 2, "assistant", huge)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert as_dict(query(spark, df, tmp_path)) == expected(rows)
