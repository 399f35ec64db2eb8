from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators import merge, quality
from martloom.plans import checks, staging
from martloom.session import materialize, shared_root
from martloom.sources import files, tables
from martloom.sources.releases import Releases
from martloom.streaming.upserts import read_file_stream, upsert_stream

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_shared_root_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_root(spark) == (configured or spark.sparkContext.getCheckpointDir())


def test_materialize_keeps_rows_and_types(spark, rows):
    df = spark.createDataFrame([(1, "a", T1)], "x int, s string, t timestamp_ntz")
    copy = materialize(df, "test")
    assert copy.dtypes == df.dtypes and rows(copy) == rows(df)


# --- periods and partitions ---


def test_replace_period_touches_one_day_and_clears_on_empty(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, d string")
    for day in ("2024-01-01", "2024-01-02"):
        tables.replace_period(df.filter(F.col("d") == day), path, {"d": day})
    tables.replace_period(df.limit(0), path, {"d": "2024-01-01"})
    assert rows(spark.read.parquet(path), "v") == [(2,)]


def test_write_partitions_may_read_its_own_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20)], "v int, p int")
    tables.write_partitions(df, path, ["p"])
    current = spark.read.parquet(path)
    tables.write_partitions(current.filter("p = 10").withColumn("v", F.col("v") + 5), path, ["p"])
    assert rows(spark.read.parquet(path), "v", "p") == [(2, 20), (6, 10)]


def test_upsert_moves_a_key_between_partitions(spark, rows, tmp_path):
    path, columns = str(tmp_path / "t"), "k string, v int, p int"
    df = spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("c", 3, 30)], columns)
    tables.write_partitions(df, path, ["p"])
    table = spark.read.schema(columns).parquet(path)
    source = spark.createDataFrame([("a", 9, 20)], columns)  # leaves partition 10 empty
    touched = merge.touched_partitions(table, source, ["k"], "p")
    changed = merge.upsert_partitions(table, source, ["k"], "p")
    assert rows(changed) == [("a", 9, 20), ("b", 2, 20)]
    tables.replace_touched(changed, path, "p", touched)
    assert rows(spark.read.schema(columns).parquet(path)) == [("a", 9, 20), ("b", 2, 20), ("c", 3, 30)]


def test_rebuild_in_key_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the data is tiny
    try:
        tables.rebuild(spark.range(1000).orderBy(F.rand(1)), path, order_by=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = (
        spark.read.parquet(path).select("id", F.input_file_name().alias("f"))
        .groupBy("f").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    )
    assert len(per_file) > 1
    assert all(a["hi"] < b["lo"] for a, b in zip(per_file, per_file[1:]))


# --- releases ---


def test_release_changes_tables_together(spark, rows, tmp_path):
    store = Releases(spark, str(tmp_path / "store"))
    assert store.read("a") is None
    store.publish({"a": spark.range(1), "state": spark.range(10)})
    with pytest.raises(Exception):
        store.publish({"a": spark.range(5), "state": spark.range(3).select(F.raise_error(F.lit("stop")).alias("x"))})
    assert (store.read("a").count(), store.read("state").count()) == (1, 10)
    store.publish({"a": store.read("a").union(spark.range(1))})  # may read what it replaces
    assert (store.read("a").count(), store.read("state").count()) == (2, 10)
    assert Releases(spark, str(tmp_path / "store")).current()[0] == 2


# --- staging by cursor ---


def ranks(spark, n):
    return spark.range(n).select(
        F.col("id"), F.lit("r").alias("name"), F.lit(1).alias("bonus_percent"), F.lit(2).alias("min_payment_threshold")
    )


def test_ranks_one_by_one(spark, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    assert [staging.stage_ranks(ranks(spark, 2), store) for _ in range(4)] == [1, 1, 0, 0]
    assert store.read("bonussystem_ranks").count() == 2
    assert store.current()[0] == 2  # empty batches publish nothing


def test_documents_are_updated_and_ties_kept(spark, rows, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    old, new = datetime(2022, 2, 1), datetime(2022, 3, 1)
    docs = [("a", "x", old), ("b", "y", old), ("c", "z", old)]
    schema = "_id string, name string, update_ts timestamp_ntz"
    collection = spark.createDataFrame(docs, schema)
    assert staging.stage_documents(collection, store, "docs", limit=2) == 3
    changed = spark.createDataFrame([*docs, ("a", "x2", new)], schema)
    assert staging.stage_documents(changed, store, "docs", limit=2) == 1
    name = F.get_json_object("object_value", "$.name")
    expected = [("a", "x2"), ("b", "y"), ("c", "z")]
    assert rows(staging.staged_documents(store, "docs").select("object_id", name)) == expected
    assert store.read("docs").count() == 4
    staging.compact_documents(store, "docs")
    assert rows(store.read("docs").select("object_id", name)) == expected
    assert staging.stage_documents(changed, store, "docs") == 0  # the cursor survives compaction


def test_release_with_broken_constraints_is_not_published(spark, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    store.publish({"t": spark.range(1)})
    rules = {"t": quality.Constraints(unique=(("id",),))}
    with pytest.raises(ValueError, match="unique"):
        store.publish({"t": spark.range(1).union(spark.range(1))}, rules=rules)
    assert store.read("t").count() == 1


# --- streaming ---


def test_stream_upsert_continues_from_its_checkpoint(spark, rows, tmp_path):
    columns = {"k": "string", "day": "date", "ts": "timestamp_ntz", "v": "int"}
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    day = date(2024, 1, 1)

    def arrive(*data):
        frame = spark.createDataFrame(list(data), "k string, day date, ts timestamp_ntz, v int")
        frame.write.mode("append").parquet(source)
        stream = read_file_stream(spark, source, columns)
        upsert_stream(stream, target, columns, ["k", "day"], "day", mark, [F.desc("ts")]).awaitTermination()
        return rows(spark.read.parquet(target), "k", "v")

    assert arrive(("a", day, T1, 1), ("a", day, T2, 2), ("b", day, T1, 3)) == [("a", 2), ("b", 3)]
    assert arrive(("b", day, T2, 4), ("c", date(2024, 1, 2), T1, 5)) == [("a", 2), ("b", 4), ("c", 5)]
    # a late row does not undo a newer one
    assert arrive(("a", day, T1, 9)) == [("a", 2), ("b", 4), ("c", 5)]


# --- CSV ---


def csv(tmp_path, text):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "part.csv").write_text(text)
    return str(folder)


def test_inferred_types(spark, tmp_path):
    path = csv(
        tmp_path,
        "i,gap,x,flag,day,seen,s\n1,1,1.5,true,2024-01-01,2024-01-01 10:00:00,a\n2,,2,false,2024-01-02,2024-01-02 11:00:00,\n",
    )
    got = files.read_csv_inferred(spark, path, date_cols=["seen"])
    assert dict(got.dtypes) == {
        "i": "int", "gap": "double", "x": "double", "flag": "boolean", "day": "string",
        "seen": "timestamp_ntz", "s": "string",
    }
    assert [tuple(r) for r in got.orderBy("i").collect()][1] == (
        2, None, 2.0, False, "2024-01-02", datetime(2024, 1, 2, 11), None,
    )


def test_declared_types_leave_optional_columns_out(spark, tmp_path):
    path = csv(tmp_path, "uniq_id,quantity\nu1,2.5\n")
    got = files.read_csv(spark, path, {"uniq_id": "string", "quantity": "decimal(10,2)", "status": "string"})
    assert got.dtypes == [("uniq_id", "string"), ("quantity", "decimal(10,2)")]


# --- quality ---


def test_checks(spark, rows):
    log = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "customer_id int, action string")
    got = checks.log_checks({"log": log}, {"log": ["customer_id", "action"]}, date(2024, 1, 1))
    assert rows(got) == [
        ("log", "check_row_count_log", date(2024, 1, 1), 0), ("log", "log_isNull", date(2024, 1, 1), 1),
    ]


def test_checks_of_an_empty_table(spark, rows):
    log = spark.createDataFrame([], "customer_id int")
    got = checks.log_checks({"log": log}, {"log": ["customer_id"]}, date(2024, 1, 1))
    assert [r[3] for r in rows(got)] == [1, 0]


def test_file_arrival(spark, rows, tmp_path):
    (tmp_path / "2024-01-01orders.csv").write_text("x")
    expected = spark.createDataFrame(
        [("orders", "2024-01-01orders.csv"), ("prices", "2024-01-01prices.csv")], "table_name string, file_name string"
    )
    got = quality.file_arrival(files.list_files(spark, str(tmp_path)), expected, date(2024, 1, 1))
    assert rows(got, "table_name", "result") == [("orders", 0), ("prices", 1)]


def test_constraints(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", -1, "y"), (None, None, None)], "k string, v int, s string")
    rules = quality.Constraints(not_null=("k",), non_negative=("v",), one_of={"s": ("x",)}, unique=(("k",),))
    assert dict(rows(quality.violations(df, rules))) == {
        "not_null(k)": 1, "non_negative(v)": 1, "one_of(s)": 1, "unique(k)": 1,
    }
    with pytest.raises(ValueError, match="unique"):
        quality.enforce(df, quality.Constraints(unique=(("k",),)))
    assert quality.enforce(df.limit(0), rules).count() == 0
