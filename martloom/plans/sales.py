"""Sales mart: staged increments, insert-only dimensions, signed sales fact, weekly retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.functions.dates import as_day, clock
from martloom.functions.numbers import signed
from martloom.operators.clean import conform, default_column, drop_present, keep_first, keep_first_sparse
from martloom.operators.joins import with_calendar
from martloom.operators.merge import in_partitions, insert_new, inserted, upsert_on_key
from martloom.plans.retention import WEEKLY, WeeklyRetention, customer_counts, retention_of
from martloom.schemas import (
    F_SALES,
    F_SALES_RULES,
    REFUNDED,
    SALES_DIMENSIONS,
    SHIPPED,
    USER_ORDER_INCREMENT,
    ddl,
    empty_table,
)
from martloom.session import materialize
from martloom.sources import tables
from martloom.sources.bucketed import KeyIndex
from martloom.sources.files import read_csv
from martloom.sources.releases import Releases


def clean_increment(
    raw: DataFrame, order_by: Sequence[Column] | None = None, divided_by: Sequence[str] = (), sparse: bool = False
) -> DataFrame:
    """Drop the legacy id, keep one row per ``uniq_id``, default the status.

    ``order_by`` says which of several copies is the first; without it the order is by all columns,
    so the choice does not depend on how the input was partitioned. ``divided_by`` names columns that follow from the
    uniq_id; they are dropped, and rows that come partitioned by them are not shuffled. ``sparse`` is for input in which few
    uniq_ids come twice, see :func:`keep_first_sparse`.
    """
    df = drop_present(raw, "id")
    if "uniq_id" in df.columns:
        order = order_by or [F.col(c) for c in df.columns if c not in ("uniq_id", *divided_by)]
        first = keep_first_sparse if sparse else keep_first
        df = first(df, [*divided_by, "uniq_id"], order)
    return default_column(df.drop(*divided_by), "status", SHIPPED)


def stage_orders(increment: DataFrame, path: str, business_date: date) -> None:
    """Replace one business day's increment in staging; an empty increment clears the day."""
    tables.replace_period(increment, path, {"business_date": business_date.isoformat()})


def add_cities(d_city: DataFrame, orders: DataFrame) -> DataFrame:
    """Insert-only city dimension."""
    return insert_new(d_city, cities_of(orders), "city_id")


def add_items(d_item: DataFrame, orders: DataFrame) -> DataFrame:
    """Insert-only item dimension."""
    return insert_new(d_item, items_of(orders), "item_id")


def add_customers(d_customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Insert-only customer dimension with the largest city id per customer and name."""
    return insert_new(d_customer, customers_of(orders), "customer_id")


def cities_of(orders: DataFrame) -> DataFrame:
    return orders.select("city_id", "city_name").distinct()


def items_of(orders: DataFrame) -> DataFrame:
    return orders.select("item_id", "item_name").distinct()


def customers_of(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id", "first_name", "last_name").agg(F.max("city_id").alias("city_id"))


def upsert_dimension(dim: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Dimension whose attributes follow the newest load; the last name wins when a key has several."""
    others = [F.col(c).desc_nulls_last() for c in found.columns if c != key]
    return upsert_on_key(dim, found, [key], on_duplicate="latest", prefer=others)


def signed_sales(
    orders: DataFrame, calendar: DataFrame, business_date: date | None = None
) -> DataFrame:
    """Sales lines of one day (of all days when none is given); refunds have negative amounts."""
    if business_date is not None:
        orders = orders.filter(as_day("date_time") == F.lit(business_date))
    lines = orders.withColumn("status", F.coalesce(F.col("status"), F.lit(SHIPPED)))
    dated = with_calendar(lines, as_day("date_time"), calendar)
    refund = F.col("status") == REFUNDED
    return dated.select(
        "uniq_id",
        "date_id",
        "item_id",
        "customer_id",
        "city_id",
        "status",
        signed("quantity", refund).cast("decimal(18,3)").alias("quantity"),
        signed("payment_amount", refund).cast("decimal(18,2)").alias("payment_amount"),
    )


def load_f_sales(target: DataFrame, sales: DataFrame, run_ts: datetime) -> DataFrame:
    """Upsert by ``uniq_id``; a line loaded before keeps its creation time."""
    batch = conform(sales.withColumn("created_at", clock(run_ts)), F_SALES)
    return upsert_on_key(target, batch, ["uniq_id"], keep=["created_at"])


def f_sales_append(orders: DataFrame, calendar: DataFrame, business_date: date | None = None) -> DataFrame:
    """Append-only variant: unsigned lines, a missing calendar day leaves ``date_id`` NULL."""
    if business_date is not None:
        orders = orders.filter(as_day("date_time") == F.lit(business_date))
    return with_calendar(orders, as_day("date_time"), calendar, how="left").select(
        "date_id", "item_id", "customer_id", "city_id", "quantity", "payment_amount"
    )


def customer_retention(
    f_sales: DataFrame,
    calendar: DataFrame,
    business_date: date | None = None,
    by_year: bool = True,
) -> DataFrame:
    """New, returning and refunded customers per item and week.

    A customer is new for an item with one shipped line in the week and returning with more.
    ``customers_refunded`` counts refund lines. The period is ISO year and week (202153);
    ``by_year=False`` uses the bare week number, which puts the same week of all years together.
    Without ``business_date`` every week is computed in one pass.
    """
    return retention_of(customer_counts(f_sales, calendar, business_date, by_year))


def replace_retention_week(retention: DataFrame, path: str, period_id: int) -> None:
    """Replace one week of the stored mart; a week without sales is cleared."""
    of_week = retention.filter(F.col("period_id") == period_id)
    tables.replace_period(of_week, path, {"period_name": WEEKLY, "period_id": period_id})


def sales_index(spark: SparkSession, root: str, buckets: int = 16) -> KeyIndex:
    """The partitions of ``f_sales`` by ``uniq_id``."""
    store = Releases(spark, f"{root.rstrip('/')}/f_sales_index")
    return KeyIndex(store, "partitions", {"uniq_id": F_SALES["uniq_id"]}, ("date_id", F_SALES["date_id"]), buckets, unique=True)


def run_sales_day(
    spark: SparkSession,
    increment_csv: str,
    root: str,
    calendar: DataFrame,
    business_date: date,
    run_ts: datetime,
) -> None:
    """Daily run: increment file -> staging -> dimensions -> f_sales -> retention of the weeks that change.

    Staging replaces its own day, new dimension rows are added in one release, and
    of ``f_sales``, partitioned by ``date_id``, only the partitions that the increment touches are
    read and rewritten; an index tells in which ones the lines of its keys are. Retention is changed by the lines
    that come and those that they replace, also in earlier weeks. A rerun of a day gives the same tables.
    """
    root = root.rstrip("/")
    staging, facts = f"{root}/user_order_log", f"{root}/f_sales"

    increment = clean_increment(read_csv(spark, increment_csv, USER_ORDER_INCREMENT), sparse=True)
    stage_orders(conform(increment, USER_ORDER_INCREMENT), staging, business_date)
    staged = spark.read.schema(ddl({**USER_ORDER_INCREMENT, "business_date": "date"})).parquet(staging)
    orders = staged.filter(F.col("business_date") == F.lit(business_date))

    dims = Releases(spark, f"{root}/dimensions")
    empty = {name: empty_table(spark, columns) for name, columns in SALES_DIMENSIONS.items()}
    found = {
        "d_city": (cities_of(orders), "city_id"),
        "d_item": (items_of(orders), "item_id"),
        "d_customer": (customers_of(orders), "customer_id"),
    }
    dims.publish({}, added={n: inserted(dims.read(n, empty[n]), rows, key) for n, (rows, key) in found.items()})

    sales = signed_sales(orders, calendar, business_date).withColumn("created_at", clock(run_ts))
    batch = conform(sales, F_SALES)
    empty_table(spark, F_SALES).write.mode("ignore").partitionBy("date_id").parquet(facts)
    current = spark.read.schema(ddl(F_SALES)).parquet(facts)
    index = sales_index(spark, root)
    index.recover(current)
    touched = materialize(index.touched(batch), "touched")
    retention = WeeklyRetention(spark, root, calendar)
    retention.recover(current)
    met = materialize(beside_stored(in_partitions(current, touched, "date_id"), batch), "f_sales_met")
    moved = retention.moved(replaced_lines(met), met.filter("_loaded"))
    index.begin(touched)
    retention.begin(moved)
    tables.replace_touched(upserted_lines(met), facts, "date_id", touched, F_SALES_RULES, stored=True)
    index.finish(batch)
    retention.finish(moved)


def beside_stored(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The lines of a load, each beside the stored line that it replaces, and the other stored lines.

    The one join of the upsert. ``batch`` holds a uniq_id once; that the result does is checked when it is stored.
    """
    if stored.isEmpty():
        stored = empty_table(stored.sparkSession, F_SALES)
    old = stored.select(*[F.col(c).alias(f"_old_{c}") for c in F_SALES], F.lit(True).alias("_stored"))
    new = batch.select(*F_SALES).withColumn("_loaded", F.lit(True))
    return new.join(old, F.col("uniq_id") == F.col("_old_uniq_id"), "full_outer")


def replaced_lines(met: DataFrame) -> DataFrame:
    return met.filter("_loaded and _stored").select(*[F.col(f"_old_{c}").alias(c) for c in F_SALES])


def upserted_lines(met: DataFrame) -> DataFrame:
    """All lines of :func:`beside_stored` as stored from now on; a line loaded before keeps its creation time."""
    taken = {c: F.col("_loaded") for c in F_SALES} | {"created_at": F.col("_stored").isNull()}
    return met.select(*[F.when(taken[c], F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in F_SALES])
