"""What a load shuffles, by its plans, and the results of the shorter ways."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom import bindings
from martloom.operators import clean
from martloom.plans import customer_report as report, sales, warehouse
from martloom.schemas import D_CRAFTSMAN, D_CUSTOMER, D_PRODUCT, F_ORDER, F_SALES, LOAD_LOG, ddl
from martloom.sources import tables
from martloom.sources.bucketed import KeyIndex
from martloom.sources.files import land, read_csv
from martloom.sources.releases import Releases

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_increment_by_order_needs_no_shuffle_after_its_joins(spark, shuffled_joins):
    raw = bindings.user_order_log(spark, "/root/testdata/sf0.001", order_id=True)
    first = sales.clean_increment(raw, [F.col(c) for c in bindings.FIRST_LINE], divided_by=["order_id"])
    assert exchanges(first) == exchanges(raw)
    assert "order_id" not in first.columns
    plain = sales.clean_increment(raw.drop("order_id"), [F.col(c) for c in bindings.FIRST_LINE])
    assert sorted(map(str, first.collect())) == sorted(map(str, plain.collect()))


def test_sparse_duplicates(spark):
    data = [("a", 2), ("a", 1), ("b", 5), (None, 4), (None, 3), ("c", None), ("c", 7)]
    df = spark.createDataFrame(data, "k string, v int").repartition(3)
    order = [F.col("v").asc_nulls_last()]
    for rows in (df, df.filter("k = 'b' or v in (2, 3)"), df.limit(0)):
        got = clean.keep_first_sparse(rows, ["k"], order)
        assert sorted(map(str, got.collect())) == sorted(map(str, clean.keep_first(rows, ["k"], order).collect()))
    assert exchanges(clean.keep_first_sparse(df.filter("k = 'b'"), ["k"], order)) == 0


def market_sources(spark, orders):
    """Sources in which the orders, with ids from 1 to 4, stand in the shape of that number; 0 is in each."""
    day = date(2024, 1, 1)
    data = [(i % 5, i, day, None, status, 1, "a", None, day, "a@x", 7, "p", "b", "t", Decimal(2), c, "c", "s", day, "c@x")
            for i, status, c in orders]
    kinds = {"id": "long", "date": "date", "birthday": "date", "price": "decimal(18,2)"}
    columns = ", ".join(f"{c} {kinds.get(c.rpartition('_')[2], 'string')}" for c in warehouse.MARKET_COLUMNS)
    df = spark.createDataFrame(data, f"shape int, {columns}")
    one, two, three, four = (df.filter(f"shape in (0, {i})") for i in range(1, 5))
    order, master, product, buyer = (getattr(warehouse, f"{n}_COLUMNS") for n in ("ORDER", "CRAFTSMAN", "PRODUCT", "CUSTOMER"))
    return df, warehouse.MarketSources(
        wide=one, masters_products=df.select(*master, *product).distinct(),
        orders_customers=two.select(*order, "product_id", "craftsman_id", *buyer),
        orders_products=three.select(*order, *product, "craftsman_id", "customer_id"),
        craftsmen=df.select(*master).distinct(), customers=df.select(*buyer).distinct(),
        craft_products_orders=four.select(*order, *master, *product, "customer_id"),
        external_customers=df.select(*buyer).distinct(),
    )


def test_conformed_rows_are_not_shuffled_again_unless_they_repeat(spark):
    for repeated in (True, False):
        orders = [(1, "done", 5), (2, "done", 5), (3, None, 6), (4, "done", None), (6, "created", 5), (7, "done", 6), (13, None, 5), (9, "x", 6)]
        orders += [(10, "done", 5), (3, None, 6), (7, "done", 6)] * repeated
        df, sources = market_sources(spark, orders)
        got = warehouse.conform_sources(sources)
        # joins drop the order without a customer, a wide row would stay
        expected = df.filter("shape = 1 or customer_id is not null").drop("shape").distinct()
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))
        assert repeated or exchanges(got) == 0


def lines(spark, rows):
    data = [(k, d, 1, 1, 1, "shipped", Decimal(1), Decimal(a), t) for k, d, a, t in rows]
    return spark.createDataFrame(data, ddl(F_SALES))


def test_upsert_beside_stored(spark):
    stored = lines(spark, [("a", 20240101, 1, T1), ("b", 20240101, 2, T1)])
    batch = lines(spark, [("b", 20240102, 5, T2), ("c", 20240102, 6, T2), (None, 20240102, 7, T2)])
    met = sales.beside_stored(stored, batch)
    shown = lambda df: sorted((r["uniq_id"] or "", r["date_id"], int(r["payment_amount"]), r["created_at"]) for r in df.collect())
    assert shown(sales.upserted_lines(met)) == [
        ("", 20240102, 7, T2), ("a", 20240101, 1, T1), ("b", 20240102, 5, T1), ("c", 20240102, 6, T2)]
    assert shown(sales.replaced_lines(met)) == [("b", 20240101, 2, T1)]
    assert sales.upserted_lines(met).schema.simpleString() == stored.schema.simpleString()
    assert exchanges(sales.beside_stored(stored.limit(0), batch)) == 0


def test_newest_entries_of_the_index_take_one_shuffle(spark, tmp_path):
    index = KeyIndex(Releases(spark, str(tmp_path)), "i", {"k": "string"}, ("p", "int"), buckets=4)
    rows = [("a", 1, 1), ("a", 2, 2), ("a", 3, 2), (None, 1, 1), (None, 2, 3), ("b", 9, 1)]
    entries = spark.createDataFrame(rows, "k string, p int, load bigint")
    assert sorted((r["k"] or "", r["p"]) for r in index._valid(entries).collect()) == [("", 2), ("a", 2), ("a", 3), ("b", 9)]
    assert exchanges(index._valid(entries)) == 1


def test_few_partitions_are_written_where_they_are(spark, tmp_path, monkeypatch):
    gathered = []
    write = tables.write_partitions
    monkeypatch.setattr(tables, "write_partitions", lambda df, path, by, gather=True: (gathered.append(gather), write(df, path, by, gather)))
    for n in (tables.FEW, tables.FEW + 1):
        path = f"{tmp_path}/{n}"
        df = spark.range(40).selectExpr("id", f"cast(nullif(id % {n}, 0) as int) p")
        for stored in (False, True):
            tables.replace_touched(df, path, "p", df.select("p").distinct(), stored=stored)
            assert sorted(map(str, spark.read.parquet(path).select("id", "p").collect())) == sorted(map(str, df.collect()))
    assert gathered == [False, False, True, True]


def test_landed_by_day_and_packed(spark, tmp_path):
    path = f"{tmp_path}/in"
    df = spark.createDataFrame([("a", 1, date(2024, 1, 5)), ("b", None, date(2024, 1, 6))], "k string, n int, d date")
    land(df, path, ["d"], compression="gzip")
    land(df.drop("d").filter("false"), f"{path}/d=2024-01-06")
    land(df.drop("d").filter("false"), f"{path}/d=2024-01-07")
    read = lambda day: [tuple(r) for r in read_csv(spark, f"{path}/d=2024-01-0{day}", {"n": "int"}).collect()]
    assert (read(5), read(6), read(7)) == ([("a", 1)], [("b", None)], [])


def test_only_orders_that_changed_meet_the_attributes(spark):
    def table(columns, rows):
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ddl(columns))

    names = ("craftsman", "customer", "product")
    old, new = dict(load_dttm=T1), dict(load_dttm=T2)
    dims = [
        table(columns, [{f"{n}_id": 1, **old}, {f"{n}_id": 2, **new}, {f"{n}_id": 2, **new}])
        for n, columns in zip(names, (D_CRAFTSMAN, D_CUSTOMER, D_PRODUCT))
    ]
    ids = [(1, 1, 1, T1), (2, 1, 1, T1), (1, 2, 1, T1), (1, 1, 2, T1), (1, 1, 1, T2), (None, 1, 1, T1), (None, 2, 1, T1)]
    orders = table(F_ORDER, [
        dict(order_id=i, craftsman_id=a, customer_id=b, product_id=c, load_dttm=t) for i, (a, b, c, t) in enumerate(ids)
    ])
    log = spark.createDataFrame([(T1,)], ddl(LOAD_LOG))
    found = report.changed_orders(orders, *dims, log)
    assert sorted(r[0] for r in found.select("order_id").collect()) == [1, 2, 3, 4, 6]
    assert found.columns == orders.columns
    assert report.changed_orders(orders, *dims, log.limit(0)).count() == len(ids)
    mart = spark.createDataFrame([(1, "2024-01")], "customer_id bigint, report_period string")
    delta = lambda of: sorted(map(str, report.report_delta(report.order_details(of, *dims), log, mart).collect()))
    assert delta(found) == delta(orders) != []
