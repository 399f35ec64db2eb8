"""Best row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_of_group(
    df: DataFrame,
    keys: Sequence[str],
    best: Column,
    ties: str = "all",
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Rows that come first in their group by ``best``.

    ``ties="all"`` keeps every row equal to the best one (SQL ``RANK() = 1``); ``ties="first"`` keeps
    one, decided by ``tie_break``. Both plan a WindowGroupLimit before the shuffle.
    """
    if ties == "all":
        position = F.rank().over(Window.partitionBy(*keys).orderBy(best))
    elif ties == "first":
        position = F.row_number().over(Window.partitionBy(*keys).orderBy(best, *tie_break))
    else:
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    return df.withColumn("_rank", position).filter("_rank = 1").drop("_rank")


def most_frequent(
    df: DataFrame, group: Sequence[str], value: str, ties: str = "all"
) -> DataFrame:
    """Most frequent ``value`` per group with its count ``n`` (rows with a NULL value count zero)."""
    counts = df.groupBy(*group, value).agg(F.count(value).alias("n"))
    return top_of_group(counts, group, F.desc("n"), ties, [F.asc_nulls_last(value)])
