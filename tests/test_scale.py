"""Hot keys, checked against plain Python, and properties of the plans."""

from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom import catalogue
from martloom.operators import clean, keys, merge, quality, ranking
from martloom.plans import daily, sales

ROWS = 6000


@pytest.fixture(scope="module")
def hot(spark):
    """Rows of which a third share key 0 and many are exact copies."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(0)).otherwise(i % 500)
    return spark.range(ROWS).select(key.alias("k"), (i % 7).alias("v"), (i % 11).alias("w")).cache()


@pytest.fixture(scope="module")
def local(hot):
    return [tuple(r) for r in hot.collect()]


def test_first_row_of_a_hot_key(hot, local, rows):
    first = {}
    for k, v, w in local:
        first[k] = min(first.get(k, (99, 99)), (v, w))
    got = clean.keep_first(hot, ["k"], [F.col("v"), F.col("w")])
    assert rows(got) == sorted([(k, *p) for k, p in first.items()], key=repr)


@pytest.mark.parametrize("ties", ["all", "first"])
def test_most_frequent_value_of_a_hot_key(hot, local, rows, ties):
    counts = defaultdict(Counter)
    for k, v, _ in local:
        counts[k][v] += 1
    expected = []
    for k, c in counts.items():
        best = sorted(v for v, n in c.items() if n == max(c.values()))
        expected += [(k, v, c[v]) for v in (best if ties == "all" else best[:1])]
    assert rows(ranking.most_frequent(hot, ["k"], "v", ties)) == sorted(expected, key=repr)


def test_upsert_of_a_hot_batch(hot, local, rows):
    """The batch is reduced to one row per key, whatever the number of copies."""
    target = hot.sparkSession.range(250).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v"))
    batch = hot.select("k", "v")
    got = merge.upsert_on_key(target, batch, ["k"], on_duplicate="latest", prefer=[F.desc("v")])
    expected = {k: -1 for k in range(250)}
    for k in {k for k, _, _ in local}:
        expected[k] = max(v for key, v, _ in local if key == k)
    assert rows(got) == sorted(expected.items(), key=repr)


def test_unique_rule_counts_surplus_rows(hot, local):
    got = quality.violations(hot, quality.Constraints(unique=(("k",),))).first()["violations"]
    assert got == ROWS - len({k for k, _, _ in local})


def test_retention_with_a_hot_customer(spark, rows):
    calendar = daily.d_calendar([spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-28'))")])
    data = []
    for i in range(3000):
        customer = 0 if i % 3 == 0 else i % 400
        status = "refunded" if i % 10 == 0 else "shipped"
        data.append((20240101 + i % 28, i % 5, customer, status, (i % 13) * (-1 if status == "refunded" else 1)))
    f_sales = spark.createDataFrame(data, "date_id int, item_id int, customer_id int, status string, amount int")
    f_sales = f_sales.withColumn("payment_amount", F.col("amount").cast("decimal(18,2)"))

    groups = defaultdict(lambda: [0, 0, 0])
    for day, item, customer, status, amount in data:
        week = date(2024, 1, day % 100).isocalendar()
        group = groups[(week.year * 100 + week.week, item, customer)]
        group[0 if status == "shipped" else 1] += 1
        group[2] += amount if status == "shipped" else 0
    expected = defaultdict(lambda: [0, 0, 0, 0, 0, 0])
    for (week, item, _), (shipped, refunded, revenue) in groups.items():
        e = expected[(week, item)]
        e[0] += shipped == 1
        e[1] += shipped > 1
        e[2] += refunded > 0
        e[3] += revenue if shipped == 1 else 0
        e[4] += revenue if shipped > 1 else 0
        e[5] += refunded
    got = rows(sales.customer_retention(f_sales, calendar), *[c for c in catalogue.RETENTION if c != "period_name"])
    assert got == sorted([(*k, *v) for k, v in expected.items()], key=repr)


def test_bucketed_ids_of_many_rows(spark):
    df = spark.range(200000).select(F.col("id").cast("string").alias("n"), F.col("id").alias("id"))
    got = keys.assign_keys(df, ["n"]).agg(F.count_distinct("id").alias("d"), F.min("id").alias("lo")).first()
    assert (got["d"], got["lo"] >= 1) == (200000, True)


PLANS = [
    "d_calendar", "d_customer_max_city", "d_item", "f_activity", "f_daily_sales", "stage_orders_dedup",
    "d_customer_insert_new", "f_sales_signed", "conform_sources", "dm_users", "split_new_and_known",
]


@pytest.mark.parametrize("name", PLANS)
def test_plans_hold_for_large_tables(spark, sf_dir, name):
    """Without automatic broadcasts only the calendar is broadcast; no products of rows, no window in
    one partition, and no Python."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        assert not ("Window [" in line and "SinglePartition" in below)
        if "BroadcastHashJoin" in line:
            assert "_day" in line


def test_one_day_reaches_the_scan_as_a_time_range(spark, sf_dir):
    orders = catalogue.b.table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "date_time")
    one = orders.filter(catalogue.dates.as_day("date_time") == F.lit(date(1998, 6, 3)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-06-03T00:00" in plan


def test_daily_sales_reads_only_its_columns(spark, sf_dir):
    plan = catalogue.QUERIES["f_daily_sales"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in plan and "o_totalprice" not in plan and "customer.parquet" not in plan
