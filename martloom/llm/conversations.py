"""Repair of conversation structure: the cheapest edits that give an order of roles a chat model can be trained on.

A repaired conversation is empty, or user and assistant turns in alternation that start with a user and end with an
assistant, after at most one system turn. Rows are kept, given another role or deleted, and empty turns are inserted.

The edits of a run of rows are found by depth-first branch and bound with an explicit stack, for each state of the
conversation before and after the run. A conversation may be of any length, so its rows are put in order by range over
many tasks and cut into runs of at most :data:`RUN`; the runs' results are then put together from left to right. Of
two equally cheap prefixes that leave a conversation in one state neither is the beginning of the other (they would
differ by insertions, which cost), so the one that is less in ASCII order stays less whatever follows, and the parts
can be chosen one by one.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.llm.runtime import Scratch, map_batches, ship

#: Rows of one search; the number is a power of two.
RUN = 64

SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
#: States: nothing yet, after the system turn, after a user, after an assistant.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = STATES = range(4)
#: State after a row that is kept.
KEEP = {
    (START, SYSTEM): AFTER_SYSTEM, (START, USER): AFTER_USER, (AFTER_SYSTEM, USER): AFTER_USER,
    (AFTER_USER, ASSISTANT): AFTER_ASSISTANT, (AFTER_ASSISTANT, USER): AFTER_USER,
}
#: State after the turn that the state calls for.
CALLED = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLE = ("user", "user", "assistant", "user")
RETURNS = {START: 0, AFTER_SYSTEM: 2, AFTER_USER: 1, AFTER_ASSISTANT: 0}  # insertions that complete a conversation
CHANGE, DELETE, INSERT = 2, 3, 2

Symbol = int  # 4 * role + fault
Answers = tuple[tuple[int, str] | None, ...]


def least_costs(symbols: tuple[Symbol, ...]) -> tuple[list[int], list[int]]:
    """What the rows from each one on cost at least: before the first kept turn, and after it."""
    early, late = [0] * (len(symbols) + 1), [0] * (len(symbols) + 1)
    for i in range(len(symbols) - 1, -1, -1):
        role, fault = divmod(symbols[i], 4)
        cut = fault == TRUNCATED
        changed = DELETE if fault in (BLANK, DUPLICATE) else min(DELETE, CHANGE + cut)
        kept = min(changed, cut) if fault in (FINE, TRUNCATED) and role != OTHER else changed
        early[i] = early[i + 1] + kept
        late[i] = late[i + 1] + (changed if role == SYSTEM else kept)
    return early, late


def edits_at(symbols: tuple[Symbol, ...], i: int, state: int) -> list[tuple[str, int, int, int]]:
    """The edits possible before row ``i``, in ASCII order: initial, cost, next row, next state."""
    found = []
    role, fault = divmod(symbols[i], 4)
    found.append(("D", DELETE, i + 1, state))
    found.append(("I", INSERT, i, CALLED[state]))
    if fault in (FINE, TRUNCATED):
        if (state, role) in KEEP:
            found.append(("K", int(fault == TRUNCATED), i + 1, KEEP[state, role]))
        found.append(("R", CHANGE + (fault == TRUNCATED), i + 1, CALLED[state]))
    return found


def search(symbols: tuple[Symbol, ...], entry: int, goal: int) -> tuple[int, str] | None:
    """Cheapest (cost, audit) that leads from state ``entry`` through all rows to ``goal``, None if nothing does.

    Two descents by the same rules. The first takes cheap edits first and proves the least cost. The second takes the
    edits in ASCII order and cuts what that cost rules out; it meets prefixes in ASCII order, so the first
    that reaches a node at a cost is the least of that cost, and the first complete one is the answer.
    """
    early, late = least_costs(symbols)
    least = _descend(symbols, entry, goal, early, late, None)
    return least and _descend(symbols, entry, goal, early, late, least[0])


def _descend(
    symbols: tuple[Symbol, ...], entry: int, goal: int, early: list[int], late: list[int], proved: int | None
) -> tuple[int, str] | None:
    n = len(symbols)
    incumbent: tuple[int, str] | None = None
    reached: dict[tuple[int, int], int] = {}  # least cost at which a row and state were met
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        bound = cost + (early if state == START else late)[i]
        if (proved is not None and bound > proved) or (incumbent and bound >= incumbent[0]):
            continue
        if reached.get((i, state), cost + 1) <= cost:
            continue
        reached[i, state] = cost
        if i == n:
            if state == goal:
                incumbent = (cost, audit)
                if proved is not None:
                    return incumbent
            continue
        edits = edits_at(symbols, i, state)
        if proved is None:
            edits.sort(key=lambda e: e[1])
        stack.extend((j, after, cost + more, audit + initial) for initial, more, j, after in reversed(edits))
    return incumbent


@functools.lru_cache(maxsize=20_000)
def answers(symbols: tuple[Symbol, ...], entry: int) -> Answers:
    """The answers of :func:`search` from a state to each; nothing leads back to an earlier one of the first two."""
    return tuple(search(symbols, entry, g) if g >= min(entry, AFTER_USER) else None for g in STATES)


def _rows(conversations: DataFrame) -> DataFrame:
    columns = [F.col("conv_id"), F.col("turn").cast("bigint").alias("turn")]
    return conversations.select(*columns, *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that a hash of ``conv_id:turn`` deals out; nulls are one space in texts, roles and the hash."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = _rows(conversations).withColumn("fate", F.crc32(name.cast("binary")) % 20).filter("fate != 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))})
    twice = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(twice).alias("copy")).drop("copy")


def _symbol(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    return (kind * 4 + fault).cast("int")


def _runs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Runs of at most RUN rows of one conversation: conv_id, run, rows (numbers), symbols, and the costs and audits
    from each state (of a first run only from the start) to each.

    A row is a duplicate if an earlier one has its role and text: the least (turn, row) of each digest is aggregated
    map-side. The order is by range, so that the rows of a very long conversation, and of one turn in it, spread.
    """
    digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    narrow = rows.select(
        "conv_id", "turn", "role", F.substring("text", 1, 64).alias("opening"), digest.alias("digest"), "row",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    seen = narrow.filter("not blank").groupBy("conv_id", "digest").agg(F.min(F.struct("turn", "row")).alias("first"), F.count("*").alias("times"))
    again = scratch.keep(seen.filter("times > 1").select(F.col("conv_id").alias("of"), F.col("digest").alias("d"), "first.row"), "again")
    again = again.withColumnRenamed("row", "first")
    told = narrow.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("d")), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first") != F.col("row"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(FINE)
    order = ["conv_id", "turn", "role", "opening", "digest", "row"]
    told = told.select(*order, _symbol(F.col("role"), fault).alias("symbol"))
    ordered = told.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = scratch.keep(ordered.select("conv_id", F.monotonically_increasing_id().alias("id"), "row", "symbol"), "ordered")
    run = F.shiftright("id", RUN.bit_length() - 1).alias("run")
    # searching costs far more than the few bytes of a run tell, so Spark shall not gather the runs in few tasks
    spread = ordered.select("conv_id", run, "id", "row", "symbol").repartition(_tasks(rows), "conv_id", "run")
    runs = spread.groupBy("conv_id", "run").agg(F.sort_array(F.collect_list(F.struct("id", "row", "symbol"))).alias("r"))
    # all runs of a conversation but the first begin where the numbers of runs change
    inner = F.col("r.id")[0] % RUN == 0
    runs = runs.select("conv_id", "run", F.col("r.row").alias("rows"), F.col("r.symbol").alias("symbols"), inner.alias("inner"))

    def run_search(batch: pa.RecordBatch) -> pa.RecordBatch:
        costs, audits = [], []
        for symbols, maybe_inner in zip(batch.column("symbols").to_pylist(), batch.column("inner").to_pylist()):
            found = [a for e in (STATES if maybe_inner else [START]) for a in answers(tuple(symbols), e)]
            costs.append([a and a[0] for a in found])
            audits.append([a and a[1] for a in found])
        columns = [*batch.columns[:4], pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "run", "rows", "symbols", "costs", "audits"])

    kind = runs.schema["conv_id"].dataType.simpleString()
    found = f"conv_id {kind}, run bigint, rows array<bigint>, symbols array<int>, costs array<bigint>, audits array<string>"
    return scratch.keep(map_batches(runs, run_search, found), "runs")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class _Conversation:
    """What is known of a conversation while its runs pass: the best way into each state."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.last: int | None = None
        self.ways: dict[int, tuple[int, list[tuple]]] = {START: (0, [])}
        self.audit: list[str] = []

    def add(self, run: int, rows: list[int], symbols: list[int], costs: list[int | None], audits: list[str | None]) -> Iterator[tuple]:
        for symbol in symbols:
            self.counts[symbol % 4] += 1
            if self.last is not None:
                self.illegal += (self.last, symbol // 4) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
            self.last = symbol // 4
        ways = {}
        for goal in STATES:
            ends = []
            for entry, (cost, parts) in self.ways.items():
                at = 4 * entry + goal
                if costs[at] is not None:
                    ends.append((cost + costs[at], parts, (run, entry, audits[at], rows, symbols)))
            if ends:
                cost, parts, part = _best(ends)
                ways[goal] = (cost, [*parts, part])
        self.ways = ways
        # what all ways begin with is settled
        while all(parts for _, parts in ways.values()) and len({id(parts[0]) if len(ways) > 1 else 0 for _, parts in ways.values()}) == 1:
            part = next(iter(ways.values()))[1][0]
            for _, parts in ways.values():
                del parts[0]
            yield from self._edits(part)

    def end(self) -> Iterator[tuple]:
        ends = []
        for state, (cost, parts) in self.ways.items():
            ends.append((cost + INSERT * RETURNS[state], parts, (1 << 62, state, "I" * RETURNS[state], [], [])))
        cost, parts, part = _best(ends)
        for p in [*parts, part]:
            yield from self._edits(p)
        counts = (self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, cost)
        yield (self.conv_id, None, None, None, None, None, *counts, "".join(self.audit))

    def _edits(self, part: tuple) -> Iterator[tuple]:
        run, state, audit, rows, symbols = part
        self.audit.append(audit)
        i = 0
        for place, edit in enumerate(audit):
            role = ROLE[state] if edit in "IR" else None
            yield (self.conv_id, run, place, None if edit == "I" else rows[i], edit, role, None, None, None, None, None, None)
            if edit in "IR":
                state = CALLED[state]
            elif edit == "K":
                state = KEEP[state, symbols[i] // 4]
            i += edit != "I"


def _best(ends: list[tuple[int, list[tuple], tuple]]) -> tuple[int, list[tuple], tuple]:
    least = min(cost for cost, _, _ in ends)
    cheap = [e for e in ends if e[0] == least]
    return cheap[0] if len(cheap) == 1 else min(cheap, key=lambda e: "".join(p[2] for p in [*e[1], e[2]]))


_SOLVED = (
    "run bigint, place int, row bigint, edit string, new_role string, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)


def _solve(runs: DataFrame) -> DataFrame:
    """Rows of edits, and one with the counts, cost and audit for each conversation. Runs pass one after another."""
    kind = runs.schema["conv_id"].dataType
    passing = runs.repartition(_tasks(runs), "conv_id").sortWithinPartitions("conv_id", "run")
    ship(runs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        out: list[tuple] = []
        names = None
        for batch in batches:
            names = [*batch.schema.names[:1], *[part.split()[0] for part in _SOLVED.split(", ")]]
            types = [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5, pa.string()]
            for conv_id, *one_run in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.conv_id != conv_id:
                    if now:
                        out.extend(now.end())
                    now = _Conversation(conv_id)
                out.extend(now.add(*one_run))
                if len(out) > 10_000:
                    yield _batch(out, names, types)
                    out = []
        if now:
            out.extend(now.end())
            yield _batch(out, names, types)

    return passing.mapInArrow(run, f"conv_id {kind.simpleString()}, {_SOLVED}")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names)


def repair(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Two tables: the repaired rows, and a report of each conversation.

    ``conversations`` has columns conv_id, turn, role and text; others do not matter. Null roles and texts are one
    space, null turns come first, rows with a null conv_id are one conversation. Rows of one turn go by role, the
    first 64 characters of the text, and its digest; equal rows are duplicates. The repaired rows have conv_id, run and place (their order),
    role, text and edit: K kept, R with another role, I inserted (text empty). The report has conv_id, gaps,
    blank, duplicate, truncated, illegal, cost and audit, as :mod:`martloom.llm.conversations` and the README define
    them; gaps is null where it does not fit a long. An empty table gives two empty tables.
    """
    rows = scratch.keep(_rows(conversations).withColumn("row", F.monotonically_increasing_id()), "rows")
    solved = scratch.keep(_solve(_runs(rows, scratch)), "solved")
    scratch.drop("again", "ordered", "runs")
    edits = solved.filter("edit != 'D'").select("conv_id", "run", "place", F.col("row").alias("r"), "edit", "new_role")
    repaired = edits.join(rows.select("row", "role", "text"), F.col("r") == F.col("row"), "left").select(
        "conv_id", "run", "place", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit"
    )
    wide = "decimal(38,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count_distinct("turn")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(span, F.lit(0).cast(wide)).try_cast("bigint").alias("gaps"))
    report = solved.filter("audit is not null").select(
        F.col("conv_id").alias("c"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    report = gaps.join(report, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return repaired, report


def digests(repaired: DataFrame) -> DataFrame:
    """Columns conv_id and repaired_sha256 of the lines ``role:text``. A digest takes the lines one after another, and they stream."""
    kind = repaired.schema["conv_id"].dataType
    passing = repaired.select("conv_id", "run", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "run", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, schema = None, None, None
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), pa.field("repaired_sha256", pa.string())])
            done = []
            for conv_id, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                if state is None or conv_id != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = conv_id, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], schema.field(0).type), pa.array([state.hexdigest()])], schema=schema)

    return passing.mapInArrow(run, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    scratch = Scratch(spark)
    repaired, report = repair(damaged(conversations), scratch)
    all_ids = conversations.select("conv_id").distinct()
    report = report.withColumnRenamed("conv_id", "c")
    digest = digests(repaired).withColumnRenamed("conv_id", "d")
    found = all_ids.join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(digest, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    numbers = [F.when(F.col("c").isNull() & F.col("audit").isNull(), F.lit(0)).otherwise(F.col(n)).cast("bigint").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
