"""Calendar, customer and item dimensions; daily activity and sales facts (full rebuild)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from martloom.functions.dates import as_day, date_key, month_name
from martloom.functions.numbers import guarded_ratio
from martloom.operators.clean import required
from martloom.operators.joins import with_calendar


def d_calendar(days: Sequence[DataFrame]) -> DataFrame:
    """One row per day that occurs in any source; each input has one date column.

    Days are made distinct map-side, so each task sends at most its own few thousand days.
    """
    named = [required(d.toDF("fact_date"), "fact_date") for d in days]
    distinct_days = reduce(DataFrame.unionByName, named).distinct()
    return distinct_days.select(
        date_key("fact_date").alias("date_id"),
        "fact_date",
        F.dayofmonth("fact_date").alias("day_num"),
        F.month("fact_date").alias("month_num"),
        month_name("fact_date").alias("month_name"),
        F.year("fact_date").alias("year_num"),
    )


def days_of(df: DataFrame, ts: str) -> DataFrame:
    return df.select(as_day(ts).alias("fact_date"))


def d_customer(orders: DataFrame) -> DataFrame:
    """One city per customer: the largest id seen."""
    return required(orders, "customer_id").groupBy("customer_id").agg(F.max("city_id").alias("city_id"))


def d_item(orders: DataFrame) -> DataFrame:
    """Distinct named items."""
    return required(orders.select("item_id", "item_name"), "item_id", "item_name").distinct()


def f_activity(activity: DataFrame, calendar: DataFrame) -> DataFrame:
    """Number of logged actions per kind and day.

    Counted per day before the calendar join, so the join sees one row per kind and day.
    """
    actions = required(activity.select("action_id", "date_time"), "action_id", "date_time")
    per_day = actions.groupBy(F.col("action_id").alias("activity_id"), as_day("date_time").alias("day")).agg(
        F.count(F.lit(1)).alias("click_number")
    )
    return with_calendar(per_day, F.col("day"), calendar).select("activity_id", "date_id", "click_number")


def f_daily_sales(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Mean unit price, quantity and payment per day, item and customer.

    Rows with quantity zero count in the sums and not in the mean price.
    """
    lines = required(
        orders.select("date_time", "item_id", "customer_id", "quantity", "payment_amount"),
        "date_time",
        "item_id",
        "customer_id",
    )
    unit_price = guarded_ratio(F.col("payment_amount").cast("double"), F.col("quantity").cast("double"))
    per_day = lines.groupBy(as_day("date_time").alias("day"), "item_id", "customer_id").agg(
        F.avg(unit_price).alias("price"),
        F.sum("quantity").alias("quantity"),
        F.sum("payment_amount").alias("payment_amount"),
    )
    return with_calendar(per_day, F.col("day"), calendar).select(
        "date_id", "item_id", "customer_id", "price", "quantity", "payment_amount"
    )
