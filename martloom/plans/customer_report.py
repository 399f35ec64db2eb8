"""Monthly customer report, built at first and then kept up to date from changed rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.dates import days_between, month_period
from martloom.functions.numbers import count_when, exact_median
from martloom.operators.incremental import changed_since, high_water, last_loaded
from martloom.operators.ranking import most_frequent
from martloom.session import materialize

# Order states of the report and the share the platform takes.
CREATED, IN_PROGRESS, DELIVERY, DONE = "created", "in progress", "delivery", "done"
PLATFORM_SHARE = "0.1"

CUSTOMER_ATTRIBUTES = [
    "customer_id", "customer_name", "customer_address", "customer_birthday", "customer_email",
]
REPORT_KEY = ["customer_id", "report_period"]


def order_details(
    f_order: DataFrame, d_craftsman: DataFrame, d_customer: DataFrame, d_product: DataFrame
) -> DataFrame:
    """Orders joined back to their dimensions, with the load time of each of the four rows."""
    craftsmen = d_craftsman.select("craftsman_id", F.col("load_dttm").alias("craftsman_load_dttm"))
    customers = d_customer.select(*CUSTOMER_ATTRIBUTES, F.col("load_dttm").alias("customers_load_dttm"))
    products = d_product.select(
        "product_id", "product_price", "product_type", F.col("load_dttm").alias("products_load_dttm")
    )
    orders = f_order.select(
        "order_id",
        "product_id",
        "craftsman_id",
        "customer_id",
        "order_status",
        days_between("order_created_date", "order_completion_date").alias("diff_order_date"),
        month_period("order_created_date").alias("report_period"),
        F.col("load_dttm").alias("order_load_dttm"),
    )
    return (
        orders.join(craftsmen, "craftsman_id").join(customers, "customer_id").join(products, "product_id")
    )


LOAD_TIMES = ["order_load_dttm", "craftsman_load_dttm", "customers_load_dttm", "products_load_dttm"]


def report_delta(details: DataFrame, load_log: DataFrame, mart: DataFrame) -> DataFrame:
    """Order rows of which any part changed since the last recorded load.

    ``is_reported`` tells whether the mart has the row's customer and month already.
    """
    changed = details.filter(changed_since(LOAD_TIMES, last_loaded(load_log)))
    reported = mart.select(*REPORT_KEY).withColumn("_reported", F.lit(True))
    joined = changed.join(reported, REPORT_KEY, "left")
    return joined.withColumn("is_reported", F.col("_reported").isNotNull()).drop("_reported")


def changed_orders(
    f_order: DataFrame, d_craftsman: DataFrame, d_customer: DataFrame, d_product: DataFrame, load_log: DataFrame
) -> DataFrame:
    """Orders that :func:`report_delta` can return: those of which any of the four rows changed since the last load.

    Each dimension is filtered on its own load time and only the ids of what changed meet the orders, so that just the
    orders found are joined with the attributes. Without a recorded load these are all orders.
    """
    since = last_loaded(load_log)
    found = changed_since(["load_dttm"], since)
    rows = f_order
    for dim, key in ((d_craftsman, "craftsman_id"), (d_customer, "customer_id"), (d_product, "product_id")):
        # Written first, so that Spark knows how few they are.
        moved = materialize(dim.filter(changed_since(["load_dttm"], since)).select(key).distinct(), "moved-ids")
        rows = rows.join(moved.withColumn(f"_moved_{key}", F.lit(True)), key, "left")
        found = found | F.col(f"_moved_{key}").isNotNull()
    return rows.filter(found).select(*f_order.columns)


def changed_customers(
    f_order: DataFrame,
    d_craftsman: DataFrame,
    d_customer: DataFrame,
    d_product: DataFrame,
    since: Column,
) -> DataFrame:
    """Customers whose report may differ since the last load.

    The same customers as in :func:`report_delta`, found without the full star join: each table is
    filtered on its own load time in the scan, and changed products and craftsmen reach their
    customers by a semi join over two fact columns.
    """
    new_orders = f_order.filter(F.col("load_dttm") > since).select("customer_id")
    moved = d_customer.filter(F.col("load_dttm") > since).select("customer_id")
    products = d_product.filter(F.col("load_dttm") > since).select("product_id")
    craftsmen = d_craftsman.filter(F.col("load_dttm") > since).select("craftsman_id")
    by_product = f_order.select("customer_id", "product_id").join(products, "product_id", "left_semi")
    by_craftsman = f_order.select("customer_id", "craftsman_id").join(craftsmen, "craftsman_id", "left_semi")
    return (
        new_orders.unionByName(moved)
        .unionByName(by_product.select("customer_id"))
        .unionByName(by_craftsman.select("customer_id"))
        .distinct()
    )


def report_lines(f_order: DataFrame, d_craftsman: DataFrame, d_product: DataFrame) -> DataFrame:
    """Orders as the report needs them: narrow rows with price and type of the product.

    Customer attributes are joined after the aggregation, so no order row carries them through a
    shuffle. Orders of an unknown craftsman or product drop out, as in the full star join.
    """
    orders = f_order.select(
        "order_id",
        "product_id",
        "craftsman_id",
        "customer_id",
        "order_status",
        days_between("order_created_date", "order_completion_date").alias("diff_order_date"),
        month_period("order_created_date").alias("report_period"),
    )
    products = d_product.select("product_id", "product_price", "product_type")
    known = d_craftsman.select("craftsman_id")
    return orders.join(products, "product_id").join(known, "craftsman_id", "left_semi").drop("product_id")


def customer_aggregates(lines: DataFrame, d_customer: DataFrame) -> DataFrame:
    """Money, order counts and the median completion time per customer and month."""
    status = F.col("order_status")
    money = F.sum("product_price").cast("decimal(28,2)")
    per_month = lines.groupBy(*REPORT_KEY).agg(
        money.alias("customer_money"),
        (money * F.lit(PLATFORM_SHARE).cast("decimal(2,1)")).alias("platform_money"),
        F.count("order_id").alias("count_order"),
        (money.cast("double") / F.count("product_price")).alias("avg_price_order"),
        exact_median("diff_order_date").alias("median_time_order_completed"),
        count_when(status == CREATED).alias("count_order_created"),
        count_when(status == IN_PROGRESS).alias("count_order_in_progress"),
        count_when(status == DELIVERY).alias("count_order_delivery"),
        count_when(status == DONE).alias("count_order_done"),
        count_when(status != DONE).alias("count_order_not_done"),
    )
    measures = [c for c in per_month.columns if c not in REPORT_KEY]
    return per_month.join(d_customer.select(*CUSTOMER_ATTRIBUTES), "customer_id").select(
        *CUSTOMER_ATTRIBUTES, *measures, "report_period"
    )


def top_categories(lines: DataFrame, ties: str = "first") -> DataFrame:
    """Most ordered product type per customer, over all months."""
    return most_frequent(lines, ["customer_id"], "product_type", ties)


def top_craftsmen(lines: DataFrame, ties: str = "first") -> DataFrame:
    """Craftsman with most orders per customer, over all months."""
    return most_frequent(lines, ["customer_id"], "craftsman_id", ties)


def report_rows(lines: DataFrame, d_customer: DataFrame, ties: str = "first") -> DataFrame:
    """Report rows of the customers in ``lines``, which must hold all of their orders.

    ``ties="first"`` gives one row per customer and month; ``"all"`` repeats it for each tied top
    category and craftsman.
    """
    category = top_categories(lines, ties).select(
        "customer_id", F.col("product_type").alias("top_product_category")
    )
    craftsman = top_craftsmen(lines, ties).select(
        "customer_id", F.col("craftsman_id").alias("top_craftsman_id")
    )
    rows = customer_aggregates(lines, d_customer)
    return rows.join(category, "customer_id", "left").join(craftsman, "customer_id", "left")


def customer_report(
    f_order: DataFrame,
    d_craftsman: DataFrame,
    d_customer: DataFrame,
    d_product: DataFrame,
    mart: DataFrame | None = None,
    load_log: DataFrame | None = None,
    ties: str = "first",
) -> DataFrame:
    """The mart after this load.

    Without a mart everything is reported. Otherwise the customers that a change touches are reported
    again from all of their orders, in place of all of their rows; the others keep theirs, so the result
    equals a full rebuild.
    """
    orders = f_order
    if mart is not None:
        touched = changed_customers(f_order, d_craftsman, d_customer, d_product, last_loaded(load_log))
        touched = materialize(touched, "changed_customers")
        orders = f_order.join(touched, "customer_id", "left_semi")
    # Three aggregations read the joined rows, so they are written once.
    lines = materialize(report_lines(orders, d_craftsman, d_product), "report_lines")
    rows = report_rows(lines, d_customer, ties)
    if mart is None:
        return rows
    return mart.join(touched, "customer_id", "left_anti").select(*rows.columns).unionByName(rows)


def latest_load(tables: Sequence[DataFrame], run_ts: datetime) -> DataFrame:
    """Load-log entry: the latest load time over all tables, the run time where a table has none."""
    per_table = [t.agg(high_water(["load_dttm"], run_ts).alias("load_dttm")) for t in tables]
    return reduce(DataFrame.unionByName, per_table).agg(F.max("load_dttm").alias("load_dttm"))
