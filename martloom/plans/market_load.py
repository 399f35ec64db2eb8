"""One load of the craft market: sources -> dimensions -> orders -> customer report."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.functions.dates import month_period
from martloom.operators.merge import touched_partitions, touched_rows
from martloom.plans.customer_report import customer_report, latest_load
from martloom.plans.warehouse import (
    CRAFTSMAN_KEY,
    CUSTOMER_KEY,
    PRODUCT_KEY,
    Market,
    MarketSources,
    conform_sources,
    latest_order,
    merge_craftsmen,
    merge_customers,
    merge_orders,
    merge_products,
    resolve_lines,
    resolve_order_keys,
)
from martloom.schemas import (
    D_CRAFTSMAN,
    D_CUSTOMER,
    D_PRODUCT,
    F_ORDER,
    F_ORDER_RULES,
    LOAD_LOG,
    ddl,
    empty_table,
)
from martloom.session import materialize
from martloom.sources import tables
from martloom.sources.bucketed import LAST_IDS, BucketedTable, last_id, with_last_ids
from martloom.sources.releases import Releases

MONTH = "created_month"
IDS = {"d_craftsman": "craftsman_id", "d_product": "product_id", "d_customer": "customer_id"}


class MarketWarehouse:
    """Stored tables of the market below one folder.

    Dimensions, and report with load log, are published; a load reads and rewrites only the buckets of a dimension that
    its keys fall in (the report reads all). Orders are partitioned by the month of
    their creation day, a part of their key, so a load reads and rewrites only the months it brings.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.spark = spark
        self.orders_path = f"{root.rstrip('/')}/f_order"
        self.store = Releases(spark, f"{root.rstrip('/')}/published")
        self.dimensions = {
            name: BucketedTable(self.store, name, columns, keys, buckets) for name, columns, keys in (
                ("d_craftsman", D_CRAFTSMAN, CRAFTSMAN_KEY), ("d_product", D_PRODUCT, PRODUCT_KEY), ("d_customer", D_CUSTOMER, CUSTOMER_KEY),
            )
        }
        columns = {**F_ORDER, MONTH: "string"}
        empty_table(spark, columns).write.mode("ignore").partitionBy(MONTH).parquet(self.orders_path)

    def _merged(
        self, name: str, merge: Callable[..., DataFrame], market: DataFrame, run_ts: datetime, preferred: str
    ) -> tuple[DataFrame, list[int]]:
        """The buckets of a dimension that the market names, merged with it, and their numbers."""
        last = last_id(self.store, name, IDS[name])
        rows, touched = self.dimensions[name].changed(market, lambda stored: merge(
            stored, market, run_ts, numbered=last, on_duplicate="latest", prefer=[F.desc(preferred)]))
        return materialize(rows, name), touched

    def orders(self) -> DataFrame:
        return self.spark.read.schema(ddl({**F_ORDER, MONTH: "string"})).parquet(self.orders_path)

    def report(self) -> DataFrame | None:
        return self.store.read("customer_report")

    def load(self, sources: MarketSources | Market, run_ts: datetime) -> None:
        """Merge the sources and bring the report up to date.

        A :class:`Market` keeps lines and dimensions apart, so that its lines are never joined with all attributes.

        Several rows of one key in the sources are resolved to one: the last product type, the latest
        completion. A load that fails can be run again: dimensions and orders are upserted, and the
        report is published together with the log entry that says up to when it is current.
        """
        if isinstance(sources, Market):
            craftsmen, products, customers = sources.craftsmen, sources.products, sources.customers
            resolve = partial(resolve_lines, sources)
        else:
            craftsmen = products = customers = materialize(conform_sources(sources), "market")
            resolve = partial(resolve_order_keys, customers)
        changed = {
            "d_craftsman": self._merged("d_craftsman", merge_craftsmen, craftsmen, run_ts, "craftsman_address"),
            "d_product": self._merged("d_product", merge_products, products, run_ts, "product_type"),
            "d_customer": self._merged("d_customer", merge_customers, customers, run_ts, "customer_address"),
        }
        # Published before any order refers to them, so that ids once used are never given again.
        ids = with_last_ids(self.store, {name: (rows, IDS[name]) for name, (rows, _) in changed.items()})
        self.store.publish(
            {name: rows for name, (rows, _) in changed.items()} | {LAST_IDS: ids},
            touched={name: touched for name, (_, touched) in changed.items()},
        )
        # every key of the market is in a bucket that it has touched
        known = [self.dimensions[name].rows(changed[name][1]) for name in ("d_craftsman", "d_customer", "d_product")]
        self._merge_orders(resolve(*known), run_ts)

        orders = self.orders()
        dimensions = {name: table.rows() for name, table in self.dimensions.items()}
        craftsmen, customers, products = (dimensions[name] for name in ("d_craftsman", "d_customer", "d_product"))
        log = self.store.read("load_log", empty_table(self.spark, LOAD_LOG))
        report = customer_report(orders, craftsmen, customers, products, self.report(), log)
        entry = latest_load([orders, *dimensions.values()], run_ts)
        self.store.publish({"customer_report": report}, added={"load_log": entry})

    def _merge_orders(self, resolved: DataFrame, run_ts: datetime) -> None:
        batch = materialize(
            resolved.withColumn(MONTH, month_period("order_created_date")), "resolved_orders"
        )
        stored = self.orders()
        touched = touched_partitions(stored, batch, [MONTH], MONTH)
        affected = touched_rows(stored, batch, [MONTH], MONTH)
        merged = merge_orders(
            affected, batch.drop(MONTH), run_ts, numbered=stored, on_duplicate="latest", prefer=latest_order()
        )
        tables.replace_touched(
            merged.withColumn(MONTH, month_period("order_created_date")),
            self.orders_path, MONTH, touched, F_ORDER_RULES,
        )
