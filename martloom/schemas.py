"""Declared columns and constraints of inputs, dimensions, facts and marts.

A table's columns are a mapping of name to Spark type, in order; :func:`ddl` turns it into the schema
text that Spark readers and ``from_json`` take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.operators.quality import Constraints


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {type_}" for name, type_ in columns.items())


def empty_table(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    """Table without rows. The optimizer knows it is empty and removes joins with it, so a first
    load costs no more than its inserts."""
    return spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in columns.items()]).filter(F.lit(False))


# Accepted sales states, finished order states, open end of a validity period.
SHIPPED, REFUNDED = "shipped", "refunded"
FINISHED_STATES = ("CLOSED", "CANCELLED")
FAR_FUTURE = "2099-12-31 00:00:00"

# Inputs
USER_ORDER_LOG = {
    "date_time": "timestamp_ntz",
    "city_id": "int",
    "city_name": "string",
    "customer_id": "int",
    "first_name": "string",
    "last_name": "string",
    "item_id": "int",
    "item_name": "string",
    "quantity": "decimal(10,2)",
    "payment_amount": "decimal(10,2)",
}
USER_ORDER_INCREMENT = {
    "uniq_id": "string",
    "date_time": "timestamp_ntz",
    "city_id": "bigint",
    "city_name": "string",
    "customer_id": "bigint",
    "first_name": "string",
    "last_name": "string",
    "item_id": "bigint",
    "item_name": "string",
    "quantity": "decimal(18,3)",
    "payment_amount": "decimal(18,2)",
    "status": "string",
}
USER_ACTIVITY_LOG = {
    "date_time": "timestamp_ntz",
    "action_id": "int",
    "customer_id": "int",
    "quantity": "bigint",
}
CUSTOMER_RESEARCH = {
    "date_id": "int",
    "category_id": "int",
    "geo_id": "int",
    "sales_qty": "bigint",
    "sales_amt": "decimal(10,2)",
}
PRICE_LOG = {
    "datetime": "timestamp_ntz",
    "category_id": "int",
    "category_name": "string",
    "item_id": "int",
    "price": "decimal(10,2)",
}
RANKS = {
    "id": "bigint",
    "name": "string",
    "bonus_percent": "decimal(19,5)",
    "min_payment_threshold": "decimal(19,5)",
}
RANKS_RULES = Constraints(
    not_null=("id", "name", "bonus_percent", "min_payment_threshold"),
    non_negative=("bonus_percent", "min_payment_threshold"),
    unique=(("id",),),
)
STAGED_DOCUMENT = {
    "object_id": "string",
    "object_value": "string",
    "update_ts": "timestamp_ntz",
}
STAGED_DOCUMENT_RULES = Constraints(
    not_null=("object_id", "object_value", "update_ts"), unique=(("object_id",),)
)

# JSON documents. Price and quantity are decimals: declared INT, a quoted or fractional number
# would silently become NULL.
USER_DOCUMENT = {
    "name": "string",
    "login": "string",
}
RESTAURANT_DOCUMENT = {
    "name": "string",
}
ORDER_DOCUMENT = {
    "date": "string",
    "final_status": "string",
    "restaurant": "struct<id: string>",
    "user": "struct<id: string>",
    "order_items": "array<struct<id: string, name: string, price: decimal(19,5), quantity: decimal(19,5)>>",
}

# Sales marts
F_SALES = {
    "uniq_id": "string",
    "date_id": "int",
    "item_id": "bigint",
    "customer_id": "bigint",
    "city_id": "bigint",
    "status": "string",
    "quantity": "decimal(18,3)",
    "payment_amount": "decimal(18,2)",
    "created_at": "timestamp",
}
F_SALES_RULES = Constraints(
    not_null=(
        "uniq_id", "date_id", "item_id", "customer_id", "city_id", "status", "quantity",
        "payment_amount", "created_at",
    ),
    one_of={"status": (SHIPPED, REFUNDED)},
    unique=(("uniq_id",),),
)
F_CUSTOMER_RETENTION = {
    "new_customers_count": "int",
    "returning_customers_count": "int",
    "refunded_customers_count": "int",
    "period_name": "string",
    "period_id": "bigint",
    "item_id": "bigint",
    "new_customers_revenue": "decimal(10,2)",
    "returning_customers_revenue": "decimal(10,2)",
    "customers_refunded": "int",
}

#: Of each week what retention is computed from.
CUSTOMER_COUNTS = {
    "period_id": "bigint",
    "customer_id": "bigint",
    "item_id": "bigint",
    "n_lines": "bigint",
    "shipped_cnt": "bigint",
    "refunded_cnt": "bigint",
    "shipped_revenue": "decimal(28,2)",
}

SALES_DIMENSIONS = {
    "d_city": {"city_id": "bigint", "city_name": "string"},
    "d_item": {"item_id": "bigint", "item_name": "string"},
    "d_customer": {
        "customer_id": "bigint",
        "first_name": "string",
        "last_name": "string",
        "city_id": "bigint",
    },
}

# Warehouse of the craft market
D_CRAFTSMAN = {
    "craftsman_id": "bigint",
    "craftsman_name": "string",
    "craftsman_address": "string",
    "craftsman_birthday": "date",
    "craftsman_email": "string",
    "load_dttm": "timestamp",
}
D_PRODUCT = {
    "product_id": "bigint",
    "product_name": "string",
    "product_description": "string",
    "product_type": "string",
    "product_price": "decimal(18,2)",
    "load_dttm": "timestamp",
}
D_CUSTOMER = {
    "customer_id": "bigint",
    "customer_name": "string",
    "customer_address": "string",
    "customer_birthday": "date",
    "customer_email": "string",
    "load_dttm": "timestamp",
}
F_ORDER = {
    "order_id": "bigint",
    "product_id": "bigint",
    "craftsman_id": "bigint",
    "customer_id": "bigint",
    "order_created_date": "date",
    "order_completion_date": "date",
    "order_status": "string",
    "load_dttm": "timestamp",
}
F_ORDER_RULES = Constraints(
    not_null=("order_id", "product_id", "craftsman_id", "customer_id"), unique=(("order_id",),)
)
LOAD_LOG = {
    "load_dttm": "timestamp",
}

# Document warehouse
DM_USERS = {
    "id": "bigint",
    "user_id": "string",
    "user_name": "string",
    "user_login": "string",
}
DM_USERS_RULES = Constraints(not_null=tuple(DM_USERS), unique=(("id",),))
DM_RESTAURANTS = {
    "id": "bigint",
    "restaurant_id": "string",
    "restaurant_name": "string",
    "active_from": "timestamp_ntz",
    "active_to": "timestamp_ntz",
}
DM_RESTAURANTS_RULES = Constraints(not_null=tuple(DM_RESTAURANTS), unique=(("id",),))
DM_TIMESTAMPS = {
    "id": "bigint",
    "ts": "timestamp_ntz",
    "year": "int",
    "month": "int",
    "day": "int",
    "date": "date",
    "time": "string",
}
DM_TIMESTAMPS_RULES = Constraints(not_null=tuple(DM_TIMESTAMPS), unique=(("id",),))
DM_PRODUCTS = {
    "id": "bigint",
    "restaurant_id": "bigint",
    "product_id": "string",
    "product_name": "string",
    "product_price": "decimal(14,2)",
    "active_from": "timestamp_ntz",
    "active_to": "timestamp_ntz",
}
DM_PRODUCTS_RULES = Constraints(
    not_null=tuple(DM_PRODUCTS), non_negative=("product_price",), unique=(("id",),)
)
DM_ORDERS = {
    "id": "bigint",
    "order_key": "string",
    "order_status": "string",
    "restaurant_id": "bigint",
    "timestamp_id": "bigint",
    "user_id": "bigint",
}
DM_ORDERS_RULES = Constraints(not_null=tuple(DM_ORDERS), unique=(("id",),))
FCT_PRODUCT_SALES = {
    "id": "bigint",
    "product_id": "bigint",
    "order_id": "bigint",
    "count": "int",
    "price": "decimal(19,5)",
    "total_sum": "decimal(19,5)",
    "bonus_payment": "decimal(19,5)",
    "bonus_grant": "decimal(19,5)",
}
FCT_PRODUCT_SALES_RULES = Constraints(
    not_null=tuple(FCT_PRODUCT_SALES),
    non_negative=("count", "price", "total_sum", "bonus_payment", "bonus_grant"),
    unique=(("id",),),
)
