"""Incremental extraction by cursor and the load state that remembers it."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import TimestampType

from martloom.functions.dates import clock
from martloom.functions.documents import settings_map
from martloom.operators.merge import upsert_on_key
from martloom.schemas import ddl, empty_table

# Where a load starts when no state is stored, and how much a document load takes.
FIRST_ID = -1
FIRST_TS = datetime(2022, 1, 1)
DOCUMENT_LIMIT = 10000
EPOCH = datetime(1900, 1, 1)

#: Rows up to which a batch is a top-k, whose rows all pass one task, and a range of cursor values is sorted by one task.
TOP_K = DOCUMENT_LIMIT
#: Ranges into which cursor values are dealt to find the cut of a larger batch.
RANGES = 64

STATE_COLUMNS = {"workflow_key": "string", "workflow_settings": "string"}


def incremental_extract(
    source: DataFrame, cursor: str, last, limit: int | None = None, with_ties: bool = False
) -> DataFrame:
    """Next rows after ``last`` in cursor order, at most ``limit`` of them.

    The strict ``>`` is pushed down to the scan and a limit up to TOP_K plans as a distributed top-k.
    For a larger one the cut is found first, from counts per cursor value, and the batch is a filter.
    Where several rows share the cursor value at the cut, a plain limit would lose the rest of them
    once the cursor has moved on; ``with_ties`` takes them all. Without a limit everything new is
    taken and nothing has to be sorted.
    """
    # As a value of the column's own type, or the scan could not compare it.
    kind = source.schema[cursor].dataType
    after = clock(last, kind) if isinstance(last, datetime) else F.lit(last).cast(kind)
    fresh = source.filter(F.col(cursor) > after)
    if limit is None:
        return fresh
    if limit > TOP_K:
        found = _cut(fresh, cursor, limit)
        if found is None:
            return fresh
        cut, below, at = found
        if with_ties or below + at == limit:
            return fresh.filter(F.col(cursor) <= cut)
        return fresh.filter(F.col(cursor) < cut).unionAll(fresh.filter(F.col(cursor) == cut).limit(limit - below))
    batch = fresh.orderBy(cursor).limit(limit)
    if not with_ties:
        return batch
    cut = batch.agg(F.max(cursor)).scalar()
    return fresh.filter(F.col(cursor) <= cut)


def _cut(fresh: DataFrame, cursor: str, limit: int) -> tuple[Column, int, int] | None:
    """Cursor value of row number ``limit``, the rows below it and the rows that share it; None with fewer rows.

    Cursor values with their counts are dealt into ranges, and the range that holds the cut again, until
    it has at most TOP_K values: no task sorts or holds a share of the table.
    """
    kind = fresh.schema[cursor].dataType
    # A time as its microseconds, since the driver's own zone may repeat an hour.
    instant = isinstance(kind, TimestampType)

    def plain(c: Column) -> Column:
        return F.unix_micros(c) if instant else c

    def value(v) -> Column:
        if instant:
            return F.timestamp_micros(F.lit(v))
        return clock(v, kind) if isinstance(v, datetime) else F.lit(v).cast(kind)

    values = fresh.groupBy(F.col(cursor).alias("v")).agg(F.count("*").alias("n"))
    below = 0
    while True:
        dealt = values.repartitionByRange(RANGES, "v").withColumn("range", F.spark_partition_id()).groupBy("range")
        sums = dealt.agg(
            plain(F.min("v")).alias("low"), plain(F.max("v")).alias("high"), F.sum("n").alias("n"), F.count("*").alias("n_values")
        )
        for r in sorted(sums.collect(), key=lambda r: r["range"]):
            if below + r["n"] >= limit:
                break
            below += r["n"]
        else:
            return None
        values = values.filter(F.col("v").between(value(r["low"]), value(r["high"])))
        if r["n_values"] <= TOP_K:
            break
    running = values.withColumn("reached", F.lit(below) + F.sum("n").over(Window.orderBy("v")))
    last = running.filter(F.col("reached") >= limit).orderBy("v").select(plain(F.col("v")).alias("v"), "n", "reached").first()
    return value(last["v"]), last["reached"] - last["n"], last["n"]


def batch_cursor(batch: DataFrame, cursor: str):
    """Largest cursor value of a batch, None when it is empty; a time as a clock time of the session's zone."""
    last = F.max(cursor)
    if isinstance(batch.schema[cursor].dataType, TimestampType):
        last = last.cast("timestamp_ntz")
    return batch.agg(last).first()[0]


def high_water(columns: list[str], default) -> Column:
    """Greatest value over several columns of all rows, each defaulting when it has none."""
    start = clock(default) if isinstance(default, datetime) else F.lit(default)
    marks = [F.coalesce(F.max(c), start) for c in columns]
    return F.greatest(*marks) if len(marks) > 1 else marks[0]


def last_loaded(load_log: DataFrame, column: str = "load_dttm", default: datetime = EPOCH) -> Column:
    """Latest recorded load time as a scalar, ``default`` for an empty log."""
    return load_log.agg(F.coalesce(F.max(column), clock(default, load_log.schema[column].dataType))).scalar()


def changed_since(columns: list[str], moment: Column) -> Column:
    """True where any of the load times is after ``moment``."""
    changed = F.lit(False)
    for c in columns:
        changed = changed | (F.col(c) > moment)
    return changed


def empty_state(spark) -> DataFrame:
    return empty_table(spark, STATE_COLUMNS)


def get_setting(state: DataFrame, workflow_key: str) -> dict[str, str] | None:
    """Stored settings of one workflow, None when it never ran."""
    row = (
        state.filter(F.col("workflow_key") == workflow_key)
        .select(settings_map("workflow_settings").alias("settings"))
        .first()
    )
    return dict(row["settings"]) if row else None


def save_setting(state: DataFrame, workflow_key: str, settings: dict) -> DataFrame:
    """State table with the settings of one workflow replaced."""
    text = json.dumps({k: v.isoformat() if isinstance(v, datetime) else v for k, v in settings.items()})
    row = state.sparkSession.createDataFrame([(workflow_key, text)], ddl(STATE_COLUMNS))
    return upsert_on_key(state, row, ["workflow_key"])
