"""Cases that once lost or changed rows: time zones, NULL partitions, headers, NaN, constraints, releases."""

import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.functions.dates import clock
from martloom.operators import clean, merge, quality
from martloom.plans import customer_report, documents, staging
from martloom.sources import files, tables
from martloom.sources.releases import Releases
from martloom.streaming.upserts import read_file_stream, upsert_stream

STAGE_ALL = """
import sys
from datetime import datetime
from martloom.operators.incremental import last_loaded
from martloom.functions.dates import clock
from martloom.plans import staging
from martloom.session import build_session
from martloom.sources.releases import Releases
spark = build_session("zone", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
store = Releases(spark, sys.argv[1])
for kind in ("timestamp_ntz", "timestamp"):
    hours = spark.sql(f"SELECT concat('d', id) AS _id, cast(timestamp_ntz'2022-02-01 00:00:00' + make_dt_interval(0, cast(id AS int)) AS {kind}) AS update_ts FROM range(10)")
    print("STAGED", [staging.stage_documents(hours, store, kind, limit=3) for _ in range(5)])
    print("FOUND", staging.staged_documents(store, kind).count())
print("CLOCK", spark.range(1).select(clock(datetime(2024, 1, 1)).cast("string")).first()[0])
"""


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_documents_are_all_staged_in_any_zone_of_the_driver(tmp_path, zone):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"TZ": zone, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", STAGE_ALL, str(tmp_path / "s")], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("STAGED [3, 3, 3, 1, 0]") == 2 and done.stdout.count("FOUND 10") == 2, done.stdout + done.stderr[-2000:]
    assert "CLOCK 2024-01-01 00:00:00" in done.stdout


def test_null_partition_is_kept_and_replaced(spark, rows, tmp_path):
    path, columns = str(tmp_path / "t"), "k int, v int, p string"
    tables.write_partitions(spark.createDataFrame([(1, 1, None), (2, 2, "a"), (3, 3, "b")], columns), path, ["p"])
    table = spark.read.schema(columns).parquet(path)
    source = spark.createDataFrame([(4, 4, None)], columns)
    touched = merge.touched_partitions(table, source, ["k"], "p")
    tables.replace_touched(merge.upsert_partitions(table, source, ["k"], "p"), path, "p", touched)
    assert rows(spark.read.schema(columns).parquet(path)) == [(1, 1, None), (2, 2, "a"), (3, 3, "b"), (4, 4, None)]
    table = spark.read.schema(columns).parquet(path)
    gone = spark.createDataFrame([(1, 9, "b"), (4, 9, "b")], columns)  # leaves the NULL partition empty
    touched = merge.touched_partitions(table, gone, ["k"], "p")
    tables.replace_touched(merge.upsert_partitions(table, gone, ["k"], "p"), path, "p", touched)
    assert rows(spark.read.schema(columns).parquet(path)) == [(1, 9, "b"), (2, 2, "a"), (3, 3, "b"), (4, 9, "b")]


def test_stream_keeps_rows_without_partition_value(spark, rows, tmp_path):
    columns = {"k": "int", "d": "date", "v": "int"}
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for k in (1, 2):
        spark.createDataFrame([(k, None, k)], "k int, d date, v int").write.mode("append").parquet(source)
        upsert_stream(read_file_stream(spark, source, columns), target, columns, ["k", "d"], "d", checkpoint, [F.desc("v")]).awaitTermination()
    assert rows(spark.read.parquet(target), "k", "v") == [(1, 1), (2, 2)]


def test_only_touched_partitions_are_scanned(spark, tmp_path):
    path, columns = str(tmp_path / "t"), "k int, v int, p int"
    tables.write_partitions(spark.range(100).selectExpr("cast(id as int) k", "1 v", "cast(id % 10 as int) p"), path, ["p"])
    table = spark.read.schema(columns).parquet(path)
    batch = spark.createDataFrame([(3, 9, 3), (14, 9, 4)], columns)
    found = merge.touched_rows(table, batch, ["k", "p"], "p")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p#" in plan and "IN (" in plan.split("PartitionFilters")[1]
    assert len(found.inputFiles()) >= 2 and found.count() == 20
    scanned = {f.split("p=")[1].split("/")[0] for f in [r[0] for r in found.select(F.input_file_name()).distinct().collect()]}
    assert scanned == {"3", "4"}


def test_files_with_other_headers_fail(spark, tmp_path):
    for name, text in (("a.csv", "a,b\n1,2\n"), ("b.csv", "b,a\n3,4\n")):
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), {"a": "int", "b": "int"}).collect()


def test_landed_times_keep_their_microseconds(spark, rows, tmp_path):
    moment = datetime(2024, 1, 1, 2, 3, 4, 567891)
    path = str(tmp_path / "c")
    files.land(spark.createDataFrame([(moment,)], "t timestamp_ntz"), path)
    assert rows(files.read_csv(spark, path, {"t": "timestamp_ntz"})) == [(moment,)]


def test_nan_is_a_value_and_null_is_not(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert clean.required(df, "x").count() == 2
    assert quality.violations(df, quality.Constraints(unique=(("x",),))).first()["violations"] == 0
    assert quality.violations(df, quality.Constraints()).count() == 0


def test_published_documents_are_checked(spark, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    values = "1 id, 1 product_id, 1 order_id, 2 count, -1 price, -2 total_sum, 0 bonus_payment, 0 bonus_grant"
    with pytest.raises(ValueError, match="non_negative"):
        store.publish({"fct_product_sales": spark.sql("SELECT " + values)}, rules=documents.RULES)
    assert store.read("fct_product_sales") is None


def test_release_log_grows_by_what_changes(spark, tmp_path):
    store = Releases(spark, str(tmp_path / "s"))
    for i in range(4):
        store.publish({"state": spark.range(i)}, added={"batches": spark.range(1)})
    log = spark.read.option("recursiveFileLookup", True).parquet(store.log)
    assert log.count() == 8
    number, folders = store.current()
    assert (number, len(folders["state"]), len(folders["batches"])) == (4, 1, 4)
    store.publish({"batches": store.read("batches")})
    assert len(store.current()[1]["batches"]) == 1 and store.read("batches").count() == 4


def test_staged_batches_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "COMPACT_AFTER", 2)
    store = Releases(spark, str(tmp_path / "s"))
    days = spark.sql("SELECT concat('d', id) AS _id, timestamp_ntz'2022-02-01' + make_dt_interval(cast(id AS int)) AS update_ts FROM range(5)")
    for _ in range(5):
        staging.stage_documents(days, store, "docs", limit=1)
    assert staging.staged_documents(store, "docs").count() == 5 and len(store.current()[1]["docs"]) <= 2


def test_report_drops_months_that_a_changed_customer_no_longer_has(spark, monkeypatch):
    mart = spark.createDataFrame([(1, "2024-01"), (1, "2024-02"), (2, "2024-01")], "customer_id bigint, report_period string")
    rows = spark.createDataFrame([(1, "2024-02")], mart.schema)
    changed = spark.createDataFrame([(1,)], "customer_id bigint")
    monkeypatch.setattr(customer_report, "changed_customers", lambda *a: changed)
    monkeypatch.setattr(customer_report, "report_lines", lambda orders, *a: orders)
    monkeypatch.setattr(customer_report, "report_rows", lambda *a: rows)
    log = spark.range(1).select(clock(datetime(2024, 1, 1)).alias("load_dttm"))
    got = customer_report.customer_report(mart, mart, mart, mart, mart, log)
    assert sorted(map(tuple, got.collect())) == [(1, "2024-02"), (2, "2024-01")]
