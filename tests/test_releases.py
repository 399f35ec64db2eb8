"""Bounded logs and folders, tables in buckets, and the index of keys to partitions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators import merge
from martloom.plans import sales
from martloom.schemas import F_SALES, USER_ORDER_INCREMENT, ddl
from martloom.session import materialize
from martloom.sources import bucketed, files, releases, tables
from martloom.sources.releases import Entry, Releases


def test_a_thousand_additions_leave_few_folders():
    state, rewritten = {}, 0
    for number in range(1, 1001):
        state = releases.follow(state, [Entry(number, "t", f"{number}", True, 0)])
        while found := releases.due(state["t"]):
            for (_, tier), group in found.items():
                rewritten += len(group) * releases.FANOUT**tier
                merged = Entry(number, "t", f"{number}-{tier + 1}", True, tier + 1, None, [e.folder for e in group])
                state = releases.follow(state, [merged])
    assert len(state["t"]) <= 4 * (releases.FANOUT - 1)
    assert sum(releases.FANOUT**e.tier for e in state["t"]) == 1000
    assert rewritten <= 3 * 1000  # each row once a tier


def test_folders_are_merged_and_old_ones_deleted(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(releases, "FANOUT", 2)
    monkeypatch.setattr(releases, "EVERY", 3)
    store = Releases(spark, str(tmp_path / "s"))
    for i in range(13):
        store.publish({"state": spark.range(i, i + 1)}, added={"t": spark.range(i, i + 1)})
        assert sorted(rows(store.read("t"))) == [(n,) for n in range(i + 1)] and rows(store.read("state")) == [(i,)]
    number, folders = store.current()
    assert number == 13 and len(folders["t"]) == 3  # 8 + 4 + 1
    assert store.additions("t") == 13
    logged = [n for n in store._names(store.log)]
    assert len(logged) <= 2 * 3 + 4
    kept = set(store._names(f"{store.root}/state"))
    assert len(kept) <= 3 * 3 and "00000001" not in kept
    assert sorted(rows(Releases(spark, store.root).read("t"))) == [(n,) for n in range(13)]


def test_an_unfinished_entry_is_no_release(spark, rows, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    store.publish({"t": spark.range(1)})
    (tmp_path / "s" / "release_log" / "00000002").mkdir()
    assert store.current()[0] == 1
    store.publish({"t": spark.range(2)})
    assert store.current()[0] == 2 and store.read("t").count() == 2


PEOPLE = {"id": "bigint", "name": "string", "town": "string", "city": "string"}


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, town string, city string")


def test_merge_rewrites_only_touched_buckets(spark, rows, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    table = bucketed.BucketedTable(store, "people", PEOPLE, ["name", "town"], buckets=16)

    def load(batch):
        content, touched = table.merge(batch, ["city"], id_column="id", insert_cols=["name", "town", "city"])
        before = store.current()[1].get("people", [])
        content = materialize(content, "people")
        ids = bucketed.with_last_ids(store, {"people": (content, "id")})
        store.publish({"people": content, bucketed.LAST_IDS: ids}, touched={"people": touched})
        return touched, set(before) - set(store.current()[1]["people"])

    first = [(f"n{i}", f"t{i % 7}", "old") for i in range(300)] + [(None, "t", "old")] * 3
    touched, _ = load(people(spark, *first))
    assert len(touched) == 16
    touched, replaced = load(people(spark, ("n5", "t5", "new"), ("x", "y", "new"), (None, "t", "new")))
    assert len(touched) <= 3 and len(replaced) == len(touched)
    expected = {r[:2]: r[2] for r in first if r[0]} | {("n5", "t5"): "new", ("x", "y"): "new"}
    found = table.rows().collect()
    assert {(r["name"], r["town"]): r["city"] for r in found if r["name"]} == expected
    assert len(found) == len(expected) + 4 and len({r["id"] for r in found}) == len(found)
    newest = next(r["id"] for r in found if r["name"] == "x")
    assert newest == max(r["id"] for r in found)
    plan_files = table.rows(touched).inputFiles()
    assert {f.split("_bucket=")[1].split("/")[0] for f in plan_files} == {str(b) for b in touched}


COLUMNS = "k string, v int, p int"


@pytest.fixture
def fact(spark, tmp_path):
    """A partitioned fact of 40 rows with its index."""
    path = str(tmp_path / "fact")
    tables.write_partitions(spark.range(40).selectExpr("concat('k', id) k", "1 v", "cast(id % 8 as int) p"), path, ["p"])
    index = bucketed.KeyIndex(Releases(spark, str(tmp_path / "index")), "where", {"k": "string"}, ("p", "int"), buckets=16)
    return path, index


def upsert(spark, path, index, batch, stop=None):
    table = spark.read.schema(COLUMNS).parquet(path)
    index.recover(table)
    touched = index.touched(batch).collect()
    touched = spark.createDataFrame(touched, "p int")
    index.begin(touched)
    if stop == "before":
        return touched
    changed = merge.upsert_on_key(merge.in_partitions(table, touched, "p"), batch, ["k"])
    tables.replace_touched(changed, path, "p", touched)
    if stop != "after":
        index.finish(batch)
    return touched


def test_index_finds_moved_rows(spark, rows, fact):
    path, index = fact
    batch = spark.createDataFrame([("k3", 9, 7), ("new", 9, None)], COLUMNS)
    touched = upsert(spark, path, index, batch)
    assert rows(touched) == sorted([(3,), (7,), (None,)], key=repr)
    batch = spark.createDataFrame([("k3", 10, 1), ("new", 10, 2)], COLUMNS)
    assert rows(upsert(spark, path, index, batch)) == sorted([(1,), (7,), (2,), (None,)], key=repr)
    found = rows(spark.read.schema(COLUMNS).parquet(path))
    assert len(found) == 41 and ("k3", 10, 1) in found and ("new", 10, 2) in found
    assert rows(index.valid().groupBy("k").count().filter("count > 1")) == []


def test_index_reads_only_the_buckets_of_the_batch(spark, fact):
    path, index = fact
    index.recover(spark.read.schema(COLUMNS).parquet(path))
    batch = spark.createDataFrame([("k3", 9, 7)], COLUMNS)
    own = index.table.touched(index.table.place(batch.select("k")))
    scanned = {f.split("_bucket=")[1].split("/")[0] for f in index.touched(batch).inputFiles() if "_bucket=" in f}
    assert scanned == {str(b) for b in own} and len(own) == 1
    assert not any(path in f for f in index.touched(batch).inputFiles())


@pytest.mark.parametrize("stop", ["before", "after"])
def test_index_after_a_failed_load(spark, rows, fact, stop):
    path, index = fact
    upsert(spark, path, index, spark.createDataFrame([("k3", 9, 7)], COLUMNS), stop)
    upsert(spark, path, index, spark.createDataFrame([("k3", 10, 5)], COLUMNS))
    found = rows(spark.read.schema(COLUMNS).parquet(path))
    assert len(found) == 40 and [r for r in found if r[0] == "k3"] == [("k3", 10, 5)]


def test_index_of_many_loads(spark, rows, fact, monkeypatch):
    """Merged entries keep the newest place of each key."""
    monkeypatch.setattr(releases, "FANOUT", 2)
    path, index = fact
    for i in range(5):
        upsert(spark, path, index, spark.createDataFrame([("k1", i, i), ("k2", i, 7 - i)], COLUMNS))
    found = rows(spark.read.schema(COLUMNS).parquet(path))
    assert len(found) == 40 and ("k1", 4, 4) in found and ("k2", 4, 3) in found
    assert rows(index.valid().filter("k in ('k1', 'k2')"), "k", "p") == [("k1", 4), ("k2", 3)]


def test_sales_day_opens_only_touched_partitions(spark, tmp_path):
    """A refund names no partition; of the fact only the refunded line's partition and the day's own are rewritten."""
    from martloom.plans import daily

    calendar = daily.d_calendar([spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-09'))")])
    root = str(tmp_path / "mart")

    def run(day, lines):
        at = datetime(2024, 1, day, 12)
        rows_ = [(at, 1, "c", 7, "a", "b", 3, "i", 1, 10, u, status) for u, status in lines]
        names = "date_time timestamp_ntz, city_id int, city_name string, customer_id int, first_name string, last_name string, item_id int, item_name string, quantity int, payment_amount int, uniq_id string, status string"
        frame = spark.createDataFrame(rows_, names).select(*USER_ORDER_INCREMENT)
        files.land(frame, f"{tmp_path}/in{day}")
        sales.run_sales_day(spark, f"{tmp_path}/in{day}", root, calendar, date(2024, 1, day), at)

    for day in (1, 2, 3):
        run(day, [(f"{day}-{i}", "shipped") for i in range(4)])
    written = lambda: {f for f in spark.read.parquet(f"{root}/f_sales").inputFiles()}
    before = written()
    run(4, [("2-1", "refunded"), ("4-1", "shipped")])
    assert {f.split("date_id=")[1].split("/")[0] for f in before - written()} == {"20240102"}
    facts = spark.read.schema(ddl(F_SALES)).parquet(f"{root}/f_sales")
    assert facts.count() == 13 and facts.filter("uniq_id = '2-1'").select("date_id").first()[0] == 20240104
    assert facts.filter(F.col("status") == "refunded").count() == 1


def test_order_is_told_from_what_was_written(spark, tmp_path):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k", "id % 3 AS v").withColumn("k", F.when(F.col("k") > 5, F.col("k")))
    tables.rebuild(df, str(tmp_path / "a"), order_by=["k", "v"])
    found = tables.order_violations(spark, str(tmp_path / "a"), ["k", "v"]).collect()
    assert sum(r["n_rows"] for r in found) == 1000 and not any(r["n_unsorted"] or r["n_overlaps"] for r in found)
    df.repartition(3).write.parquet(str(tmp_path / "b"))
    found = tables.order_violations(spark, str(tmp_path / "b"), ["k", "v"]).collect()
    assert len(found) == 3 and all(r["n_unsorted"] > 100 for r in found) and sum(r["n_overlaps"] for r in found) == 2


def test_types_of_one_pass(spark, tmp_path):
    lines = ["a,b,c,d,e,f,g,h,i", "1,1,1.5,true,x,3000000000,99999999999999999999,,1", "-2,,1e3,False,7,1,1,, 2", "+3,4,7,TRUE,,2,2,,3"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    kinds = [t for _, t in files.read_csv_inferred(spark, str(tmp_path / "t.csv")).dtypes]
    assert kinds == ["int", "double", "double", "boolean", "string", "bigint", "string", "string", "string"]
