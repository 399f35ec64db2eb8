"""Order-system documents to a relational warehouse: four dimensions, orders and product sales.

Documents are parsed once, by :func:`parse_orders`; every table derives from the parsed columns.
Surrogate ids depend only on the natural keys, so a full refresh over the same documents gives the
same ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from martloom.functions.dates import clock_time, from_iso_text, truncate_to_second
from martloom.functions.documents import parse_document
from martloom.functions.numbers import whole_number
from martloom.operators.clean import conform
from martloom.operators.joins import explode_items
from martloom.operators.keys import assign_keys
from martloom.operators.ranking import top_of_group
from martloom.schemas import (
    DM_ORDERS,
    DM_ORDERS_RULES,
    DM_PRODUCTS,
    DM_PRODUCTS_RULES,
    DM_RESTAURANTS,
    DM_RESTAURANTS_RULES,
    DM_TIMESTAMPS,
    DM_TIMESTAMPS_RULES,
    DM_USERS,
    DM_USERS_RULES,
    FAR_FUTURE,
    FCT_PRODUCT_SALES,
    FCT_PRODUCT_SALES_RULES,
    FINISHED_STATES,
    ORDER_DOCUMENT,
    RESTAURANT_DOCUMENT,
    USER_DOCUMENT,
)
from martloom.session import materialize

# Bonus granted per sale, as a share of the sum.
BONUS_SHARE = "0.05"


def parse_orders(documents: DataFrame, strict: bool = True) -> DataFrame:
    """Order documents as columns; the items stay an array."""
    doc = documents.withColumn("doc", parse_document("object_value", ORDER_DOCUMENT, strict))
    return doc.select(
        F.col("object_id").alias("order_key"),
        "update_ts",
        from_iso_text(F.col("doc.date")).alias("ordered_at"),
        F.col("doc.final_status").alias("order_status"),
        F.col("doc.restaurant.id").alias("restaurant_key"),
        F.col("doc.user.id").alias("user_key"),
        F.col("doc.order_items").alias("items"),
    )


def finished(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status").isin(*FINISHED_STATES))


def dm_users(documents: DataFrame) -> DataFrame:
    doc = documents.withColumn("doc", parse_document("object_value", USER_DOCUMENT))
    users = doc.select(
        F.col("object_id").alias("user_id"),
        F.col("doc.name").alias("user_name"),
        F.col("doc.login").alias("user_login"),
        F.lit(None).cast("bigint").alias("id"),
    )
    return conform(assign_keys(users, ["user_id"]), DM_USERS)


def dm_restaurants(documents: DataFrame) -> DataFrame:
    """Restaurants, valid from their last update on."""
    doc = documents.withColumn("doc", parse_document("object_value", RESTAURANT_DOCUMENT))
    restaurants = doc.select(
        F.col("object_id").alias("restaurant_id"),
        F.col("doc.name").alias("restaurant_name"),
        F.col("update_ts").alias("active_from"),
        _far_future().alias("active_to"),
    )
    return conform(assign_keys(restaurants, ["restaurant_id"]), DM_RESTAURANTS)


def dm_timestamps(orders: DataFrame) -> DataFrame:
    """Distinct order times, to the second, of finished orders."""
    times = finished(orders).select(truncate_to_second("ordered_at").alias("ts")).distinct()
    parts = times.select(
        "ts",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.to_date("ts").alias("date"),
        clock_time("ts").alias("time"),
    )
    return conform(assign_keys(parts, ["ts"]), DM_TIMESTAMPS)


def dm_products(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Products as last ordered, per restaurant, from orders in any state.

    The latest occurrence is found before the restaurant join, on the restaurant key of the document;
    equal update times fall to the larger order key, then to name and price.
    """
    sold = explode_items(orders.select("order_key", "update_ts", "restaurant_key", "items"), F.col("items"))
    latest = top_of_group(
        sold.select(
            "restaurant_key",
            F.col("item.id").alias("product_id"),
            F.col("item.name").alias("product_name"),
            F.col("item.price").cast("decimal(14,2)").alias("product_price"),
            "update_ts",
            "order_key",
        ),
        ["restaurant_key", "product_id"],
        F.desc("update_ts"),
        ties="first",
        tie_break=[F.desc("order_key"), F.asc("product_name"), F.asc("product_price")],
    )
    named = latest.join(_restaurant_ids(restaurants), "restaurant_key").select(
        "restaurant_id",
        "product_id",
        "product_name",
        "product_price",
        F.col("update_ts").alias("active_from"),
        _far_future().alias("active_to"),
    )
    return conform(assign_keys(named, ["restaurant_id", "product_id"]), DM_PRODUCTS)


def dm_orders(
    orders: DataFrame, restaurants: DataFrame, users: DataFrame, timestamps: DataFrame
) -> DataFrame:
    """Finished orders with the ids of their restaurant, user and time."""
    headers = finished(orders).select(
        "order_key",
        "order_status",
        "restaurant_key",
        "user_key",
        truncate_to_second("ordered_at").alias("ts"),
    )
    user_ids = users.select(F.col("user_id").alias("user_key"), F.col("id").alias("user_id"))
    time_ids = timestamps.select("ts", F.col("id").alias("timestamp_id"))
    linked = (
        headers.join(_restaurant_ids(restaurants), "restaurant_key")
        .join(user_ids, "user_key")
        .join(time_ids, "ts")
    )
    return conform(assign_keys(linked, ["order_key"]), DM_ORDERS)


def fct_product_sales(
    orders: DataFrame, dm_orders_: DataFrame, restaurants: DataFrame, products: DataFrame
) -> DataFrame:
    """Sold items of finished orders with sum and bonus.

    The order id is joined while the items are still one array per order, so that shuffle moves one
    row per order; items are unnested after it.
    """
    order_ids = dm_orders_.select("order_key", F.col("id").alias("order_id"))
    headers = finished(orders).select("order_key", "restaurant_key", "items").join(order_ids, "order_key")
    located = headers.join(_restaurant_ids(restaurants), "restaurant_key")
    items = explode_items(located, F.col("items")).select(
        "restaurant_id",
        F.col("item.id").alias("product_key"),
        "order_id",
        whole_number(F.col("item.quantity")).alias("count"),
        F.col("item.price").alias("price"),
    )
    product_ids = products.select(
        "restaurant_id", F.col("product_id").alias("product_key"), F.col("id").alias("product_id")
    )
    total = F.col("count") * F.col("price")
    sales = items.join(product_ids, ["restaurant_id", "product_key"]).select(
        "product_id",
        "order_id",
        "count",
        "price",
        total.cast("decimal(19,5)").alias("total_sum"),
        F.lit(0).cast("decimal(19,5)").alias("bonus_payment"),
        (total * F.lit(BONUS_SHARE).cast("decimal(3,2)")).cast("decimal(19,5)").alias("bonus_grant"),
    )
    return conform(assign_keys(sales, ["order_id", "product_id", "count", "price"]), FCT_PRODUCT_SALES)


@dataclass(frozen=True)
class DocumentWarehouse:
    dm_users: DataFrame
    dm_restaurants: DataFrame
    dm_timestamps: DataFrame
    dm_products: DataFrame
    dm_orders: DataFrame
    fct_product_sales: DataFrame


#: Constraints of the six tables, for publishing them.
RULES = {
    "dm_users": DM_USERS_RULES,
    "dm_restaurants": DM_RESTAURANTS_RULES,
    "dm_timestamps": DM_TIMESTAMPS_RULES,
    "dm_products": DM_PRODUCTS_RULES,
    "dm_orders": DM_ORDERS_RULES,
    "fct_product_sales": FCT_PRODUCT_SALES_RULES,
}


def build_document_warehouse(
    order_documents: DataFrame, user_documents: DataFrame, restaurant_documents: DataFrame
) -> DocumentWarehouse:
    """All six tables from the staged documents, parsed once.

    What several tables read (parsed orders, dimensions, orders) is written once in the shared
    folder. Publish the result with :class:`martloom.sources.releases.Releases` under ``RULES``, so that no
    reader sees tables of different refreshes or broken ones.
    """
    orders = materialize(parse_orders(order_documents), "orders")
    users, restaurants, timestamps, order_dim = build_order_tables(orders, user_documents, restaurant_documents)
    products = materialize(dm_products(orders, restaurants), "dm_products")
    sales = fct_product_sales(orders, order_dim, restaurants, products)
    return DocumentWarehouse(users, restaurants, timestamps, products, order_dim, sales)


def build_order_tables(
    orders: DataFrame, user_documents: DataFrame, restaurant_documents: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Users, restaurants, times and orders of a warehouse; the items of the orders are not read."""
    users = materialize(dm_users(user_documents), "dm_users")
    restaurants = materialize(dm_restaurants(restaurant_documents), "dm_restaurants")
    timestamps = materialize(dm_timestamps(orders), "dm_timestamps")
    order_dim = materialize(dm_orders(orders, restaurants, users, timestamps), "dm_orders")
    return users, restaurants, timestamps, order_dim


def _restaurant_ids(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        F.col("restaurant_id").alias("restaurant_key"), F.col("id").alias("restaurant_id")
    )


def _far_future():
    return F.lit(FAR_FUTURE).cast("timestamp_ntz")
