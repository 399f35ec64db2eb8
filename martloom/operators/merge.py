"""Keyed maintenance of tables: merge, upsert, insert-only, update.

Each function takes the current table and a batch and returns the new table (or the changed part of
it) as a DataFrame; :mod:`martloom.sources` writes it. Matching is SQL equality, so a NULL key
matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.functions.dates import clock
from martloom.operators.joins import not_in
from martloom.operators.keys import assign_keys


def one_row_per_key(
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """Guard against a batch that would change one target row twice.

    ``on_duplicate="error"`` fails the job on the second row of a key; ``"latest"`` keeps the first
    row in ``prefer`` order. The result stays partitioned by key, so a join on it adds no shuffle.
    """
    if on_duplicate == "latest":
        order = [*prefer, *[F.col(c) for c in source.columns if c not in keys]]
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        checked = source.withColumn("_place", place).filter("_place = 1")
    elif on_duplicate == "error":
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
        shown = F.to_json(F.struct(*keys))
        fail = F.raise_error(F.concat(F.lit("batch holds a key twice: "), shown)).cast("boolean")
        checked = source.withColumn("_place", place).filter(
            F.when(F.col("_place") == 1, F.lit(True)).otherwise(fail)
        )
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    return checked.drop("_place")


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    stamp: tuple[str, datetime] | None = None,
) -> DataFrame:
    """``target`` with the listed columns taken from its partner in ``source``, NULLs included.

    A left join from the target: a small batch is broadcast and the table never shuffles; with two
    large sides the adaptive skew join can still split the target. ``source`` holds a key once.
    """
    partner = source.select(
        *[F.col(c).alias(f"_src_{c}") for c in dict.fromkeys([*keys, *update_cols])],
        F.lit(True).alias("_hit"),
    )
    joined = target.join(partner, [F.col(k) == F.col(f"_src_{k}") for k in keys], "left")
    values = {c: F.when(F.col("_hit"), F.col(f"_src_{c}")).otherwise(F.col(c)) for c in update_cols}
    if stamp:
        column, moment = stamp
        stamped = clock(moment, target.schema[column].dataType)
        values[column] = F.when(F.col("_hit"), stamped).otherwise(F.col(column))
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in target.columns])


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` without a partner in ``target``; reads only the key columns of the target.

    The target is first cut to the keys the batch names, so a small batch against a large table
    costs one narrow scan and no shuffle of it.
    """
    wanted = source.select(*[F.col(k).alias(f"_src_{k}") for k in keys])
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    named = known.join(wanted, [F.col(f"_known_{k}") == F.col(f"_src_{k}") for k in keys], "left_semi")
    return source.join(named, [F.col(k) == F.col(f"_known_{k}") for k in keys], "left_anti")


def split_batch(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The batch as (rows whose key is new, rows whose key the target has)."""
    known = source.join(target.select(*keys), list(keys), "left_semi").select(*source.columns)
    return new_rows(source, target, keys), known


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str] | None = None,
    stamp: tuple[str, datetime] | None = None,
    id_column: str | None = None,
    numbered: DataFrame | None = None,
    on_duplicate: str = "error",
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """SQL MERGE: update the listed columns of matched rows, insert the others.

    ``stamp`` is a (column, time) written on every touched row. ``id_column`` gets new surrogate keys
    above those in ``numbered`` (the target unless given); kept rows keep theirs. Target columns outside
    ``insert_cols`` are NULL in new rows.
    """
    insert_cols = list(insert_cols or [*keys, *update_cols])
    has_key = _all(F.col(k).isNotNull() for k in keys)
    batch = one_row_per_key(source.filter(has_key), keys, on_duplicate, prefer)
    updated = update_from(target, batch, keys, update_cols, stamp)
    fresh = new_rows(batch, target, keys).select(*insert_cols)
    if any(source.schema[k].nullable for k in keys):
        # A NULL key matches nothing: such rows skip the joins and are inserted.
        fresh = fresh.unionByName(source.filter(~has_key).select(*insert_cols))
    if stamp:
        fresh = fresh.withColumn(stamp[0], clock(stamp[1], target.schema[stamp[0]].dataType))
    if id_column:
        numbered = target if numbered is None else numbered
        fresh = assign_keys(fresh, [*keys, *[c for c in insert_cols if c not in keys]], id_column, numbered)
    return updated.unionByName(_shaped(fresh, target))


def upsert_on_key(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """INSERT ... ON CONFLICT DO UPDATE: all columns of the batch replace the stored ones.

    Columns in ``keep`` (a creation time) are set on insert and left alone on update, as are target
    columns that the batch lacks.
    """
    update_cols = [c for c in source.columns if c not in keys and c not in keep]
    return merge_upsert(target, source, keys, update_cols, list(source.columns), **options)


def insert_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Insert-only dimension: add batch rows whose key is NOT IN the target."""
    return target.unionByName(inserted(target, source, key))


def inserted(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The rows that :func:`insert_new` adds."""
    return _shaped(not_in(source, key, target, key), target)


def touched_partitions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str
) -> DataFrame:
    """Partition values an upsert of ``source`` changes: its own and those that now hold its keys."""
    own = source.select(partition_col)
    if partition_col in keys:
        return own.distinct()
    wanted = source.select(*keys)
    moved = target.select(partition_col, *keys).join(wanted, list(keys), "left_semi").select(partition_col)
    return own.unionByName(moved).distinct()


def touched_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str
) -> DataFrame:
    """Rows of the partitions that an upsert of ``source`` changes.

    Where the partition is part of the key, untouched partitions are not read at all; otherwise only
    their key columns are. Merge into these rows and write the result with
    :func:`martloom.sources.tables.replace_touched`, which leaves the rest of the table alone.
    """
    return in_partitions(target, touched_partitions(target, source, keys, partition_col), partition_col)


def in_partitions(target: DataFrame, touched: DataFrame, partition_col: str) -> DataFrame:
    """Rows of ``target`` in the partitions that ``touched`` lists, the NULL partition like any other.

    The values, at most one per partition, are fetched, so that the scan lists only those folders.
    """
    kind = target.schema[partition_col].dataType
    shown = touched.select(F.col(partition_col).cast("string")).distinct().collect()
    values = [F.lit(r[0]).cast(kind) for r in shown if r[0] is not None]
    inside = F.col(partition_col).isin(*values) if values else F.lit(False)
    if len(values) < len(shown):
        inside = inside | F.col(partition_col).isNull()
    return target.filter(inside)


def upsert_partitions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """New content of the partitions that an upsert into a large partitioned table touches."""
    return upsert_on_key(touched_rows(target, source, keys, partition_col), source, keys, keep, **options)


def _shaped(df: DataFrame, target: DataFrame) -> DataFrame:
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
