"""Data-quality checks, their result log, and constraint checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martloom.operators.clean import required

PASSED, FAILED = 0, 1


@dataclass(frozen=True)
class Check:
    """A named condition over the aggregates of a table."""

    name: str
    passes: Column


def null_check(name: str, columns: Sequence[str]) -> Check:
    """No NULL in any of the columns."""
    nulls = F.lit(False)
    for c in columns:
        nulls = nulls | F.col(c).isNull()
    return Check(name, F.count_if(nulls) == 0)


def distinct_value_check(name: str, column: str, expected: int) -> Check:
    """The number of distinct values is exactly as expected."""
    return Check(name, F.count_distinct(F.col(column)) == expected)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], run_date: date) -> DataFrame:
    """One result row per check; all checks of a table share one aggregation."""
    outcomes = df.agg(
        *[
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.when(c.passes, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("result"),
            ).alias(f"check_{i}")
            for i, c in enumerate(checks)
        ]
    )
    rows = outcomes.select(F.inline(F.array(*outcomes.columns)))
    return rows.select(
        F.lit(table).alias("table_name"), "check_name", F.lit(run_date).alias("check_date"), "result"
    )


def file_arrival(
    files: DataFrame, expected: DataFrame, run_date: date, check_name: str = "file_sensor"
) -> DataFrame:
    """Result row per expected file: passed when a listed path ends in its name.

    ``files`` has a ``path`` column, ``expected`` has ``table_name`` and ``file_name``.
    """
    names = files.select(F.element_at(F.split("path", "/"), -1).alias("file_name")).distinct()
    found = names.withColumn("_found", F.lit(True))
    return expected.join(found, "file_name", "left").select(
        "table_name",
        F.lit(check_name).alias("check_name"),
        F.lit(run_date).alias("check_date"),
        F.when(F.col("_found"), F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("result"),
    )


@dataclass(frozen=True)
class Constraints:
    """Declared constraints of a table; Parquet enforces none of them by itself."""

    not_null: Sequence[str] = ()
    non_negative: Sequence[str] = ()
    one_of: dict[str, Sequence[str]] | None = None
    unique: Sequence[Sequence[str]] = ()


def violations(df: DataFrame, rules: Constraints) -> DataFrame:
    """Number of violating rows per rule, zero included; no rows without rules.

    Row rules take one narrow aggregation. Each unique rule counts rows beyond the first of a key,
    combined map-side, so many copies of one key cost no more than one row per task.
    """
    row_rules = {f"not_null({c})": F.col(c).isNull() for c in rules.not_null}
    row_rules |= {f"non_negative({c})": F.col(c) < 0 for c in rules.non_negative}
    row_rules |= {f"one_of({c})": ~F.col(c).isin(*v) for c, v in (rules.one_of or {}).items()}
    parts = []
    if row_rules:
        counted = df.agg(
            *[
                F.struct(F.lit(rule).alias("rule"), F.count_if(broken).alias("violations")).alias(f"r{i}")
                for i, (rule, broken) in enumerate(row_rules.items())
            ]
        )
        parts.append(counted.select(F.inline(F.array(*counted.columns))))
    for key in rules.unique:
        per_key = required(df, *key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
        parts.append(
            per_key.agg(surplus.alias("violations")).select(
                F.lit(f"unique({','.join(key)})").alias("rule"), "violations"
            )
        )
    result = df.sparkSession.createDataFrame([], "rule string, violations bigint")
    return reduce(DataFrame.unionByName, parts) if parts else result


def enforce(df: DataFrame, rules: Constraints) -> DataFrame:
    """``df`` unchanged, or an error that names the broken rules. Runs the check at once."""
    broken = violations(df, rules).filter("violations > 0").collect()  # one row per declared rule
    if broken:
        raise ValueError("constraints broken: " + ", ".join(f"{r.rule}: {r.violations}" for r in broken))
    return df
