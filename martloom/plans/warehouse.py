"""Craft-market warehouse: four source shapes conformed to one, merged into dimensions and a fact."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from martloom.operators.clean import keep_first_sparse
from martloom.operators.joins import lookup
from martloom.operators.merge import merge_upsert
from martloom.session import materialize

# The canonical columns of a market line.
ORDER_COLUMNS = ["order_id", "order_created_date", "order_completion_date", "order_status"]
CRAFTSMAN_COLUMNS = [
    "craftsman_id", "craftsman_name", "craftsman_address", "craftsman_birthday", "craftsman_email",
]
PRODUCT_COLUMNS = ["product_id", "product_name", "product_description", "product_type", "product_price"]
CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "customer_address", "customer_birthday", "customer_email",
]
MARKET_COLUMNS = [*ORDER_COLUMNS, *CRAFTSMAN_COLUMNS, *PRODUCT_COLUMNS, *CUSTOMER_COLUMNS]

CRAFTSMAN_KEY = ["craftsman_name", "craftsman_email"]
PRODUCT_KEY = ["product_name", "product_description", "product_price"]
CUSTOMER_KEY = ["customer_name", "customer_email"]
ORDER_KEY = ["product_id", "craftsman_id", "customer_id", "order_created_date"]


@dataclass(frozen=True)
class MarketSources:
    """The four source shapes."""

    wide: DataFrame
    masters_products: DataFrame
    orders_customers: DataFrame
    orders_products: DataFrame
    craftsmen: DataFrame
    customers: DataFrame
    craft_products_orders: DataFrame
    external_customers: DataFrame


def conform_sources(s: MarketSources) -> DataFrame:
    """All sources in the canonical columns; equal rows once.

    The rows are as wide as all dimensions together, so they are written once and only those that can be equal are
    shuffled again.
    """
    shapes = [
        s.wide,
        s.orders_customers.join(s.masters_products, ["product_id", "craftsman_id"]),
        s.orders_products.join(s.craftsmen, "craftsman_id").join(s.customers, "customer_id"),
        s.craft_products_orders.join(s.external_customers, "customer_id"),
    ]
    rows = shapes[0].select(*MARKET_COLUMNS)
    for shape in shapes[1:]:
        rows = rows.unionByName(shape.select(*MARKET_COLUMNS))
    return keep_first_sparse(materialize(rows, "conformed"), MARKET_COLUMNS, [F.lit(1)])


@dataclass(frozen=True)
class Market:
    """The conformed market before it is joined: each line once with the source ids of its dimensions, and the distinct
    dimension rows that the lines name. An id can have several rows; a line goes with each of them."""

    lines: DataFrame
    craftsmen: DataFrame
    products: DataFrame
    customers: DataFrame

    def only(self, lines: DataFrame) -> Market:
        """Some of the lines, with the dimension rows that these name."""
        dims = {d: _rows_of(getattr(self, d), lines.select(key).distinct(), key) for d, key in SOURCE_IDS.items()}
        return Market(lines, **dims)


# The dimensions of a market and the source id of each.
SOURCE_IDS = {"craftsmen": "craftsman_id", "products": "product_id", "customers": "customer_id"}


def conform_tables(lines: DataFrame, craftsmen: DataFrame, products: DataFrame, customers: DataFrame) -> Market:
    """The market of sources that keep lines and dimensions apart: what :func:`conform_sources` gives, not joined.

    Lines without a partner in each dimension drop out, as in the joined form. The ids that have none are found among
    the distinct ids and are few as a rule, so that no line is shuffled to check them. ``lines`` is read several times.
    """
    dims = {"craftsmen": craftsmen.distinct(), "products": products.distinct(), "customers": customers.distinct()}
    lines = lines.select(*ORDER_COLUMNS, *SOURCE_IDS.values())
    whole, known = lines, {}
    for name, key in SOURCE_IDS.items():
        known[name] = materialize(lines.select(key).distinct(), "source-ids")
        lost = materialize(known[name].join(dims[name].select(key).distinct(), key, "left_anti"), "unknown-ids")
        if not lost.isEmpty():
            whole = whole.filter(F.col(key).isNotNull()).join(lost, key, "left_anti")
    market = Market(lines, **{d: _rows_of(dims[d], known[d], key) for d, key in SOURCE_IDS.items()})
    return market if whole is lines else market.only(whole)


def _rows_of(dim: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return dim.join(ids, key, "left_semi")


def merge_craftsmen(dim: DataFrame, market: DataFrame, run_ts: datetime, **options) -> DataFrame:
    return _merge_dim(dim, market, CRAFTSMAN_KEY, ["craftsman_address", "craftsman_birthday"],
                      "craftsman_id", run_ts, options)


def merge_products(dim: DataFrame, market: DataFrame, run_ts: datetime, **options) -> DataFrame:
    return _merge_dim(dim, market, PRODUCT_KEY, ["product_type"], "product_id", run_ts, options)


def merge_customers(dim: DataFrame, market: DataFrame, run_ts: datetime, **options) -> DataFrame:
    return _merge_dim(dim, market, CUSTOMER_KEY, ["customer_address", "customer_birthday"],
                      "customer_id", run_ts, options)


def _merge_dim(
    dim: DataFrame,
    market: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    id_column: str,
    run_ts: datetime,
    options: dict,
) -> DataFrame:
    # The update, the insert and their checks read the batch.
    found = materialize(market.select(*keys, *attributes).distinct(), "batch")
    return merge_upsert(
        dim, found, keys, attributes, stamp=("load_dttm", run_ts), id_column=id_column, **options
    )


def resolve_order_keys(
    market: DataFrame, d_craftsman: DataFrame, d_customer: DataFrame, d_product: DataFrame
) -> DataFrame:
    """Market lines with the warehouse ids of their three dimensions; unknown keys drop out."""
    lines = market.select(
        *CRAFTSMAN_KEY, *CUSTOMER_KEY, *PRODUCT_KEY,
        "order_created_date", "order_completion_date", "order_status",
    )
    resolved = lookup(lines, d_craftsman, CRAFTSMAN_KEY, {"craftsman_id": "craftsman_id"})
    resolved = lookup(resolved, d_customer, CUSTOMER_KEY, {"customer_id": "customer_id"})
    resolved = lookup(resolved, d_product, PRODUCT_KEY, {"product_id": "product_id"})
    return resolved.select(*ORDER_KEY, "order_completion_date", "order_status")


def resolve_lines(
    market: Market, d_craftsman: DataFrame, d_customer: DataFrame, d_product: DataFrame
) -> DataFrame:
    """What :func:`resolve_order_keys` gives for the joined lines, by the source ids of the lines.

    The natural keys are looked up once a dimension row, so the lines carry no names.
    """
    resolved = market.lines.drop("order_id")
    for rows, stored, natural_key, key in (
        (market.customers, d_customer, CUSTOMER_KEY, "customer_id"),
        (market.products, d_product, PRODUCT_KEY, "product_id"),
        (market.craftsmen, d_craftsman, CRAFTSMAN_KEY, "craftsman_id"),
    ):
        sources = rows.select(*natural_key, F.col(key).alias("_source"))
        ids = materialize(lookup(sources, stored, natural_key, {key: "_id"}).select("_source", "_id"), "ids")
        resolved = lookup(resolved, ids.withColumnRenamed("_source", key), [key], {"_id": "_id"})
        resolved = resolved.drop(key).withColumnRenamed("_id", key)
    return resolved.select(*ORDER_KEY, "order_completion_date", "order_status")


def merge_orders(
    f_order: DataFrame, resolved: DataFrame, run_ts: datetime, **options
) -> DataFrame:
    """Orders merged by product, craftsman, customer and creation day.

    Orders created outside the days of the load have no partner in it and stay as they are, without a join.
    """
    day = "order_created_date"
    options.setdefault("numbered", f_order)
    days = resolved.agg(F.min(day), F.max(day)).first()
    inside = F.coalesce(F.col(day).between(*(F.lit(d).cast("date") for d in days)), F.lit(False))
    return f_order.filter(~inside).unionByName(merge_upsert(
        f_order.filter(inside),
        resolved,
        ORDER_KEY,
        ["order_completion_date", "order_status"],
        stamp=("load_dttm", run_ts),
        id_column="order_id",
        **options,
    ))


def latest_order() -> list[Column]:
    """Order of preference when a load is told to keep one of several rows of a key."""
    return [F.desc_nulls_last("order_completion_date"), F.desc_nulls_last("order_status")]
