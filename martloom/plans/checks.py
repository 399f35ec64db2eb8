"""Data-quality run over the staged logs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from martloom.operators.quality import distinct_value_check, null_check, run_checks

# Fixed value: number of distinct customers the logs are expected to hold.
EXPECTED_CUSTOMERS = 3


def log_checks(
    logs: dict[str, DataFrame],
    required: dict[str, list[str]],
    run_date: date,
    expected_customers: int = EXPECTED_CUSTOMERS,
) -> DataFrame:
    """Null check and customer-count check per log, one scan each."""
    result = None
    for table, df in logs.items():
        checks = [
            null_check(f"{table}_isNull", required[table]),
            distinct_value_check(f"check_row_count_{table}", "customer_id", expected_customers),
        ]
        rows = run_checks(df, table, checks, run_date)
        result = rows if result is None else result.unionByName(rows)
    return result
