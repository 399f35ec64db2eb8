"""Joins with the null and size rules the marts rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL ``column NOT IN (SELECT other_column FROM other)`` with its NULL rules.

    Spark plans the SQL form as a null-aware anti join that must broadcast the subquery. Here the
    NULL rules come from one scalar (is the subquery empty, does it hold a NULL), and the rest is a
    plain anti join, so the other side may be of any size. It is first cut to the values ``df`` names.
    """
    facts = other.agg(
        F.struct(
            (F.count(F.lit(1)) == 0).alias("is_empty"),
            (F.count_if(F.col(other_column).isNull()) > 0).alias("has_null"),
        )
    ).scalar()
    is_empty, has_null = facts.getField("is_empty"), facts.getField("has_null")
    candidates = df.filter(~has_null & (F.col(column).isNotNull() | is_empty))
    named = df.select(F.col(column).alias("_named"))
    known = other.select(F.col(other_column).alias("_known")).join(named, F.col("_known") == F.col("_named"), "left_semi")
    return candidates.join(known, F.col(column) == F.col("_known"), "left_anti")


def with_calendar(
    df: DataFrame, day: Column, calendar: DataFrame, calendar_day: str = "fact_date", how: str = "inner"
) -> DataFrame:
    """Attach ``date_id`` by day.

    The calendar has one row per day, at most 366 a year, so its broadcast is bounded by the span of
    dates and not by the data.
    """
    days = calendar.select(F.col(calendar_day).alias("_day"), "date_id")
    return df.join(F.broadcast(days), day == F.col("_day"), how).drop("_day")


def lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], take: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Join a dimension on equally named natural-key columns and take some of its columns.

    ``take`` maps dimension column -> output name. NULL keys find no partner. Spark broadcasts the
    dimension when its measured size allows and otherwise shuffles both sides; a key that holds a
    large share of ``df`` is split by the adaptive skew join.
    """
    renamed = dim.select(
        *[F.col(k).alias(f"_dim_{k}") for k in on], *[F.col(c).alias(f"_take_{o}") for c, o in take.items()]
    )
    matched = df.join(renamed, [F.col(k) == F.col(f"_dim_{k}") for k in on], how)
    kept = [c for c in df.columns if c not in take.values()]
    return matched.select(*kept, *[F.col(f"_take_{o}").alias(o) for o in take.values()])


def explode_items(df: DataFrame, array: Column, name: str = "item") -> DataFrame:
    """One row per array element; an empty or missing array gives no row."""
    return df.withColumn(name, F.explode(array))
