"""Shaping and cleaning of raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from martloom.session import materialize


def project(df: DataFrame, mapping: dict[str, object]) -> DataFrame:
    """Canonical column list: output name -> input column name or expression, in order."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()])


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns; absent ones are no error."""
    return df.drop(*names)


def default_column(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column unless the input brings its own."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def required(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which no named column is NULL; NaN is a value."""
    for name in names:
        df = df.filter(F.col(name).isNotNull())
    return df


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order, which should be total.

    Spark prunes to one row per key before the shuffle (WindowGroupLimit), so many copies of one key
    never meet in a single task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def keep_first_sparse(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """What :func:`keep_first` gives, for input in which few keys come twice; it is read twice.

    Keys that repeat are found by their hashes, and only rows of such hashes are shuffled whole.
    """
    place = F.xxhash64(*keys)
    counts = df.groupBy(place.alias("_place")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(counts.filter("_n > 1").select("_place"), "repeated-keys")
    if repeated.isEmpty():
        return df
    placed = df.withColumn("_place", place)
    several = placed.join(repeated, "_place", "left_semi").drop("_place")
    return placed.join(repeated, "_place", "left_anti").drop("_place").unionByName(keep_first(several, keys, order_by))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns]
    )


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select and cast by name to declared columns; one the input lacks becomes NULL."""
    present = set(df.columns)
    return df.select(
        *[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
    )
