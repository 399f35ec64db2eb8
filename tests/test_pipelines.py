from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.plans import customer_report as report, daily, documents, sales, warehouse
from martloom.plans.retention import WeeklyRetention
from martloom.schemas import (
    D_CRAFTSMAN, D_CUSTOMER, D_PRODUCT, F_CUSTOMER_RETENTION, F_ORDER, F_SALES, LOAD_LOG, ddl,
)
from martloom.sources.releases import Releases

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


# --- daily facts ---


def test_daily_sales_price_skips_zero_and_null_quantity(spark, rows):
    day = datetime(2024, 1, 1, 9)
    orders = spark.createDataFrame(
        [(day, 1, 7, "2", "10"), (day, 1, 7, "0", "5"), (day, 1, 7, None, "1"), (day, None, 7, "1", "1"),
         (datetime(2024, 1, 2), 1, 7, "1", "1")],
        "date_time timestamp_ntz, item_id int, customer_id int, quantity string, payment_amount string",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("quantity", "payment_amount")})
    calendar = daily.d_calendar([spark.createDataFrame([(date(2024, 1, 1),), (None,)], "d date")])
    got = rows(daily.f_daily_sales(orders, calendar))
    # the second day is not in the calendar
    assert got == [(20240101, 1, 7, 5.0, Decimal("2.00"), Decimal("16.00"))]


def test_calendar_names_months_in_full(spark, rows):
    days = spark.createDataFrame([(date(2021, 9, 30),), (date(2021, 9, 30),)], "d date")
    assert rows(daily.d_calendar([days, days])) == [(20210930, date(2021, 9, 30), 30, 9, "September", 2021)]


# --- sales mart, day by day ---

HEADER = "id,uniq_id,date_time,city_id,city_name,customer_id,first_name,last_name,item_id,item_name,quantity,payment_amount"


def increment(tmp_path, name, lines, status=True):
    path = tmp_path / name
    path.write_text("\n".join([HEADER + (",status" if status else ""), *lines]) + "\n")
    return str(path)


def line(i, uid, day, item, amount, status="shipped", customer=1, city=5):
    end = "" if status is None else f",{status}"
    return f"{i},{uid},2024-01-{day:02d} 10:00:00,{city},town{city},{customer},f,l,{item},i{item},1,{amount}{end}"


@pytest.fixture
def calendar(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-31'))")
    return daily.d_calendar([days])


def facts(spark, root):
    return spark.read.schema(ddl(F_SALES)).parquet(f"{root}/f_sales")


def test_sales_days(spark, rows, tmp_path, calendar):
    root = str(tmp_path / "wh")
    first = increment(tmp_path, "d1.csv", [
        line(1, "u1", 1, 1, "10.00", None), line(2, "u1", 1, 1, "10.00", None), line(3, "u2", 1, 2, "4.50", None),
    ], status=False)
    sales.run_sales_day(spark, first, root, calendar, date(2024, 1, 1), T1)
    loaded = rows(facts(spark, root), "uniq_id", "status", "payment_amount")
    assert loaded == [("u1", "shipped", Decimal("10.00")), ("u2", "shipped", Decimal("4.50"))]

    # The next day refunds u2 and brings a new city and item; u2 moves to the new day's partition.
    second = increment(tmp_path, "d2.csv", [
        line(4, "u2", 2, 2, "4.50", "refunded"), line(5, "u3", 2, 3, "7.00", "", customer=2, city=6),
    ])
    for _ in range(2):  # a rerun changes nothing
        sales.run_sales_day(spark, second, root, calendar, date(2024, 1, 2), T2)
        got = rows(facts(spark, root), "uniq_id", "date_id", "status", "payment_amount")
        assert got == [
            ("u1", 20240101, "shipped", Decimal("10.00")),
            ("u2", 20240102, "refunded", Decimal("-4.50")),
            ("u3", 20240102, "shipped", Decimal("7.00")),
        ]
    created = dict(rows(facts(spark, root), "uniq_id", "created_at"))
    assert created["u1"] == created["u2"] == T1 and created["u3"] == T2

    dims = Releases(spark, f"{root}/dimensions")
    assert rows(dims.read("d_city")) == [(5, "town5"), (6, "town6")]
    assert rows(dims.read("d_item"), "item_id") == [(1,), (2,), (3,)]
    assert rows(dims.read("d_customer"), "customer_id", "city_id") == [(1, 5), (2, 6)]

    weekly = spark.read.parquet(f"{root}/f_customer_retention")
    got = rows(weekly, "period_id", "item_id", "new_customers_count", "refunded_customers_count",
               "new_customers_revenue", "customers_refunded")
    assert got == [
        (202401, 1, 1, 0, Decimal("10.00"), 0), (202401, 2, 0, 1, Decimal("0.00"), 1),
        (202401, 3, 1, 0, Decimal("7.00"), 0),
    ]


def test_late_refunds_change_the_weeks_of_the_lines_they_replace(spark, rows, tmp_path, calendar, monkeypatch):
    root = str(tmp_path / "wh")

    def same():
        columns = [c for c in F_CUSTOMER_RETENTION if c != "period_name"]
        stored = spark.read.schema(ddl(F_CUSTOMER_RETENTION)).parquet(f"{root}/f_customer_retention")
        assert rows(stored, *columns) == rows(sales.customer_retention(facts(spark, root), calendar), *columns)
        return rows(stored, "period_id", "item_id", "new_customers_count", "returning_customers_count", "customers_refunded")

    def run(name, lines, day):
        sales.run_sales_day(spark, increment(tmp_path, name, lines), root, calendar, date(2024, 1, day), T1)

    run("a.csv", [line(1, "u1", 1, 1, "10.00"), line(2, "u2", 1, 1, "4.50"), line(3, "u3", 1, 2, "1.00")], 1)
    assert same() == [(202401, 1, 0, 1, 0), (202401, 2, 1, 0, 0)]
    # u2 and u3 are refunded a week later: the first week loses them, item 2 all its lines
    late = [line(4, "u2", 9, 1, "4.50", "refunded"), line(5, "u3", 9, 2, "1.00", "refunded"), line(6, "u4", 9, 1, "2.00")]
    expected = [(202401, 1, 1, 0, 0), (202402, 1, 1, 0, 1), (202402, 2, 0, 0, 1)]
    with monkeypatch.context() as broken:  # the load stops when the fact is written and the counts are not
        broken.setattr(WeeklyRetention, "finish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run("b.csv", late, 9)
    for _ in range(2):
        run("b.csv", late, 9)
        assert same() == expected


def test_empty_increment_clears_the_staged_day(spark, tmp_path, calendar):
    root = str(tmp_path / "wh")
    day = date(2024, 1, 1)
    sales.run_sales_day(spark, increment(tmp_path, "a.csv", [line(1, "u1", 1, 1, "1")]), root, calendar, day, T1)
    sales.run_sales_day(spark, increment(tmp_path, "b.csv", []), root, calendar, day, T2)
    assert spark.read.parquet(f"{root}/user_order_log").count() == 0
    assert facts(spark, root).count() == 1  # an upsert never deletes


def test_retention_across_years(spark, rows):
    """2021-01-01 is in week 53 of 2020; week numbers alone mix years."""
    days = [date(2021, 1, 1), date(2021, 1, 4), date(2020, 1, 1)]
    calendar = daily.d_calendar([spark.createDataFrame([(d,) for d in days], "d date")])
    data = [(str(i), d.year * 10000 + d.month * 100 + d.day, 1, 1, "shipped", Decimal(2)) for i, d in enumerate(days)]
    data.append(("r", 20210104, 1, None, "refunded", Decimal(-2)))
    f_sales = spark.createDataFrame(
        data, "uniq_id string, date_id int, item_id int, customer_id int, status string, payment_amount decimal(18,2)"
    )
    by_year = sales.customer_retention(f_sales, calendar)
    assert by_year.dtypes == list(F_CUSTOMER_RETENTION.items())
    columns = ("period_id", "new_customers_count", "returning_customers_count", "refunded_customers_count", "customers_refunded")
    # the refund has no customer, so it counts as a refund line and as no customer
    assert rows(by_year, *columns) == [(202001, 1, 0, 0, 0), (202053, 1, 0, 0, 0), (202101, 1, 0, 0, 1)]
    mixed = sales.customer_retention(f_sales, calendar, by_year=False)
    assert rows(mixed, *columns) == [(1, 0, 1, 0, 1), (53, 1, 0, 0, 0)]
    one = sales.customer_retention(f_sales, calendar, date(2021, 1, 8))
    assert rows(one, "period_id") == [(202101,)]


def test_unknown_status_breaks_the_constraints(spark, tmp_path, calendar):
    path = increment(tmp_path, "d.csv", [line(1, "u1", 1, 1, "1", "lost")])
    with pytest.raises(ValueError, match="one_of"):
        sales.run_sales_day(spark, path, str(tmp_path / "wh"), calendar, date(2024, 1, 1), T1)


# --- customer report ---


def warehouse_state(spark, orders, products):
    day = date(2024, 1, 1)
    craftsmen = spark.createDataFrame([(1, "m1", "a", day, "e1", T1), (2, "m2", "a", day, "e2", T1)], ddl(D_CRAFTSMAN))
    customers = spark.createDataFrame([(1, "c1", "a", day, "e", T1), (2, "c2", "a", day, "e", T1)], ddl(D_CUSTOMER))
    dim = spark.createDataFrame([(p, f"p{p}", "", kind, Decimal(price), t) for p, kind, price, t in products], ddl(D_PRODUCT))
    f_order = spark.createDataFrame(
        [(i, p, m, c, made, done, status, t) for i, (p, m, c, made, done, status, t) in enumerate(orders)], ddl(F_ORDER)
    )
    return f_order, craftsmen, customers, dim


JAN, FEB = date(2024, 1, 10), date(2024, 2, 10)
ORDERS = [(1, 1, 1, JAN, date(2024, 1, 12), "done", T1), (2, 2, 1, JAN, None, "created", T1), (1, 1, 2, JAN, JAN, None, T1)]
PRODUCTS = [(1, "toys", 10, T1), (2, "arts", 30, T1)]


def test_report_values(spark):
    got = report.customer_report(*warehouse_state(spark, ORDERS, PRODUCTS))
    by_customer = {r["customer_id"]: r for r in got.collect()}
    one, two = by_customer[1], by_customer[2]
    assert (one["customer_money"], one["platform_money"]) == (Decimal("40.00"), Decimal("4.000"))
    assert (one["count_order"], one["avg_price_order"], one["median_time_order_completed"]) == (2, 20.0, 2.0)
    assert (one["count_order_done"], one["count_order_not_done"], one["count_order_created"]) == (1, 1, 1)
    assert (one["top_product_category"], one["top_craftsman_id"], one["report_period"]) == ("arts", 1, "2024-01")
    # a status that is NULL is neither done nor not done
    assert (two["count_order_done"], two["count_order_not_done"]) == (0, 0)


def test_report_ties_all_repeats_rows(spark):
    got = report.customer_report(*warehouse_state(spark, ORDERS, PRODUCTS), ties="all")
    assert got.filter("customer_id = 1").count() == 4  # two categories times two craftsmen


@pytest.mark.parametrize("changed", ["order", "price", "nothing"])
def test_report_increment_equals_full_rebuild(spark, rows, changed):
    mart = report.customer_report(*warehouse_state(spark, ORDERS, PRODUCTS))
    orders, products = list(ORDERS), list(PRODUCTS)
    if changed == "order":
        orders.append((2, 2, 1, FEB, FEB, "done", T2))
    if changed == "price":
        products[0] = (1, "toys", 11, T2)
    state = warehouse_state(spark, orders, products)
    log = spark.createDataFrame([(T1,)], ddl(LOAD_LOG))
    after = report.customer_report(*state, mart=mart, load_log=log)
    columns = sorted(after.columns)
    assert rows(after, *columns) == rows(report.customer_report(*state), *columns)


def test_load_log_entry(spark):
    tables = warehouse_state(spark, [*ORDERS, (2, 2, 1, FEB, FEB, "done", T2)], PRODUCTS)
    assert report.latest_load(list(tables), T1).collect() == [(T2,)]
    assert report.latest_load([t.limit(0) for t in tables], T1).collect() == [(T1,)]


def test_report_delta_marks_reported_months(spark, rows):
    mart = report.customer_report(*warehouse_state(spark, ORDERS, PRODUCTS))
    state = warehouse_state(spark, [*ORDERS, (2, 2, 1, FEB, FEB, "done", T2), (2, 2, 1, JAN, JAN, "done", T2)], PRODUCTS)
    log = spark.createDataFrame([(T1,)], ddl(LOAD_LOG))
    delta = report.report_delta(report.order_details(*state), log, mart)
    assert rows(delta, "report_period", "is_reported") == [("2024-01", True), ("2024-02", False)]
    assert report.report_delta(report.order_details(*state), log.limit(0), mart).count() == 5


# --- market sources ---


def test_null_natural_keys_drop_out_of_the_fact(spark):
    day = date(2024, 1, 1)
    market = spark.createDataFrame(
        [(1, day, day, "done", 1, "m", "a", day, None, 1, "p", "d", "t", Decimal(1), 1, "c", "a", day, "e")],
        ", ".join(f"{c} {t}" for c, t in zip(warehouse.MARKET_COLUMNS, [
            "int", "date", "date", "string", "int", "string", "string", "date", "string", "int", "string", "string",
            "string", "decimal(18,2)", "int", "string", "string", "date", "string"])),
    )
    craftsmen = warehouse.merge_craftsmen(spark.createDataFrame([], ddl(D_CRAFTSMAN)), market, T1)
    customers = warehouse.merge_customers(spark.createDataFrame([], ddl(D_CUSTOMER)), market, T1)
    products = warehouse.merge_products(spark.createDataFrame([], ddl(D_PRODUCT)), market, T1)
    assert craftsmen.count() == customers.count() == products.count() == 1
    assert warehouse.resolve_order_keys(market, craftsmen, customers, products).count() == 0


# --- documents ---


def order_text(restaurant, items, status="CLOSED", user="u1", when="2024-01-01 10:00:00.700"):
    listed = "" if items is None else f',"order_items":[{",".join(items)}]'
    return (f'{{"date":"{when}","final_status":"{status}","restaurant":{{"id":"{restaurant}"}},'
            f'"user":{{"id":"{user}"}}{listed}}}')


def item(key, price, quantity, name="n"):
    return f'{{"id":"{key}","name":"{name}","price":{price},"quantity":{quantity}}}'


def build(spark, orders):
    staged = "object_id string, object_value string, update_ts timestamp_ntz"
    return documents.build_document_warehouse(
        spark.createDataFrame(orders, staged),
        spark.createDataFrame([("u1", '{"name":"N","login":"L"}')], "object_id string, object_value string"),
        spark.createDataFrame([("r1", '{"name":"R"}', T1)], staged),
    )


def test_document_warehouse(spark, rows):
    dw = build(spark, [
        ("o1", order_text("r1", [item("p1", "2.50", 3), item("p2", "1.99", '"2"')]), T1),
        ("o2", order_text("r1", [item("p1", "3.00", 1, "renamed")], "OPEN"), T2),
        ("o3", order_text("r1", [], "CANCELLED"), T1),
        ("o4", order_text("r1", None, "CANCELLED", when="2024-01-01 10:00:00.100"), T1),
        ("o5", order_text("r9", [item("p1", 1, 1)]), T2),  # unknown restaurant
    ])
    # an open order names the product last, although it makes no sale
    assert rows(dw.dm_products, "product_id", "product_name", "product_price") == [
        ("p1", "renamed", Decimal("3.00")), ("p2", "n", Decimal("1.99")),
    ]
    assert rows(dw.dm_timestamps, "ts", "time") == [(datetime(2024, 1, 1, 10), "10:00:00")]
    assert rows(dw.dm_orders, "order_key", "order_status") == [("o1", "CLOSED"), ("o3", "CANCELLED"), ("o4", "CANCELLED")]
    assert rows(dw.fct_product_sales, "count", "price", "total_sum", "bonus_grant") == [
        (2, Decimal("1.99000"), Decimal("3.98000"), Decimal("0.19900")),
        (3, Decimal("2.50000"), Decimal("7.50000"), Decimal("0.37500")),
    ]
    assert rows(dw.dm_restaurants, "active_to") == [(datetime(2099, 12, 31),)]


def test_fractional_quantity_is_an_error(spark):
    with pytest.raises(Exception, match="not a whole number"):
        build(spark, [("o1", order_text("r1", [item("p1", 1, "1.5")]), T1)]).fct_product_sales.collect()


def test_refresh_gives_the_same_ids(spark, rows):
    orders = [("o1", order_text("r1", [item("p1", 1, 1), item("p2", 1, 1)]), T1), ("o2", order_text("r1", []), T1)]
    a, b = build(spark, orders), build(spark, orders[::-1])
    assert rows(a.dm_orders) == rows(b.dm_orders) and rows(a.fct_product_sales) == rows(b.fct_product_sales)


# --- the market with lines and dimensions apart ---


@pytest.fixture
def apart(spark):
    """Lines with an equal copy, unknown and NULL ids; a customer id with two rows, one of them twice."""
    day = date(2024, 1, 1)
    lines = spark.createDataFrame(
        [(1, day, None, "created", 1, 7, 5), (1, day, None, "created", 1, 7, 5), (2, day, day, "done", 1, 7, 6),
         (3, day, day, "done", 9, 7, 6), (4, day, day, "done", None, 7, 6), (5, day, day, "done", 2, 7, 99)],
        "order_id long, order_created_date date, order_completion_date date, order_status string,"
        " craftsman_id long, product_id long, customer_id long")
    def people(role, *found):
        rows_ = [(i, name, street, day, f"{name}@x") for i, name, street in found]
        return spark.createDataFrame(rows_, f"{role}_id long, {role}_name string, {role}_address string, {role}_birthday date, {role}_email string")
    products = spark.createDataFrame(
        [(7, "p", "b", "t", Decimal("2.00")), (8, "q", "b", "t", Decimal("1.00"))],
        "product_id long, product_name string, product_description string, product_type string, product_price decimal(18,2)")
    return (lines, people("craftsman", (1, "a", "s"), (2, "b", "s")), products,
            people("customer", (5, "c", "s"), (6, "d", "s"), (6, "d", "s"), (6, "e", "s"), (8, "f", "s")))


def test_a_market_kept_apart_equals_the_joined_one(spark, rows, apart):
    lines, craftsmen, products, customers = apart
    market = warehouse.conform_tables(lines, craftsmen, products, customers)
    joined = lines.join(craftsmen, "craftsman_id").join(products, "product_id").join(customers, "customer_id").distinct()
    for dim, columns in ((market.craftsmen, warehouse.CRAFTSMAN_COLUMNS), (market.products, warehouse.PRODUCT_COLUMNS),
                         (market.customers, warehouse.CUSTOMER_COLUMNS)):
        assert rows(dim, *columns) == rows(joined.select(*columns).distinct())
    dims = (
        warehouse.merge_craftsmen(spark.createDataFrame([], ddl(D_CRAFTSMAN)), joined, T1),
        warehouse.merge_customers(spark.createDataFrame([], ddl(D_CUSTOMER)), joined, T1),
        warehouse.merge_products(spark.createDataFrame([], ddl(D_PRODUCT)), joined, T1),
    )
    resolved = warehouse.resolve_lines(market.only(market.lines.distinct()), *dims)
    assert rows(resolved) == rows(warehouse.resolve_order_keys(joined, *dims)) and resolved.count() == 3


def test_market_lines_are_resolved_without_names(spark, apart):
    market = warehouse.conform_tables(*apart)
    dims = [spark.createDataFrame([], ddl(d)) for d in (D_CRAFTSMAN, D_CUSTOMER, D_PRODUCT)]
    plan = warehouse.resolve_lines(market, *dims)._jdf.queryExecution().optimizedPlan().toString()
    assert "_name" not in plan and "_email" not in plan


def test_orders_of_other_days_stay_out_of_a_merge(spark, rows):
    def load(day, status):
        return spark.createDataFrame([(1, 1, 1, day, day, status)],
            "product_id long, craftsman_id long, customer_id long, order_created_date date, order_completion_date date, order_status string")
    first = warehouse.merge_orders(spark.createDataFrame([], ddl(F_ORDER)), load(date(2024, 1, 1), "done").unionByName(load(date(2024, 1, 3), "created")), T1)
    after = warehouse.merge_orders(first, load(date(2024, 1, 3), "done"), T2)
    assert rows(after, "order_created_date", "order_status", "load_dttm") == [
        (date(2024, 1, 1), "done", T1), (date(2024, 1, 3), "done", T2)]
    assert after.select("order_id").distinct().count() == 2
    assert rows(warehouse.merge_orders(first, load(None, "done").limit(0), T2)) == rows(first)


# --- orders of the document warehouse without their items ---


def test_order_tables_need_no_items(spark, rows):
    text = spark.createDataFrame([("o1", order_text("r1", [item("p1", "2.00", 3)]), T1)], "object_id string, object_value string, update_ts timestamp_ntz")
    users = spark.createDataFrame([("u1", '{"name": "n", "login": "l"}')], "object_id string, object_value string")
    restaurants = spark.createDataFrame([("r1", '{"_id": "r1", "name": "r"}', T1)], "object_id string, object_value string, update_ts timestamp_ntz")
    headers = documents.parse_orders(text).drop("items")
    whole = documents.build_document_warehouse(text, users, restaurants)
    for found, table in zip(documents.build_order_tables(headers, users, restaurants),
                            (whole.dm_users, whole.dm_restaurants, whole.dm_timestamps, whole.dm_orders)):
        assert rows(found) == rows(table) and found.count() == 1
