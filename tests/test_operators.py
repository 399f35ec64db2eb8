from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators import clean, incremental, joins, keys, merge, ranking

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


# --- cleaning ---


def test_drop_and_default_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert clean.drop_present(df, "id", "absent").columns == ["v"]
    assert clean.default_column(df, "v", "z").first()["v"] == "a"
    assert clean.default_column(df, "status", "shipped").first()["status"] == "shipped"


def test_keep_first_takes_total_order_and_keeps_null_key(spark, rows):
    df = spark.createDataFrame([("k", 2), ("k", 1), (None, 5), (None, 4)], "k string, v int")
    assert rows(clean.keep_first(df, ["k"], [F.col("v")])) == [("k", 1), (None, 4)]


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = clean.keep_first(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_nan_to_null(spark, rows):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x double, s string")
    assert rows(clean.nan_to_null(df)) == [(1.0, None), (None, "a")]


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("7", 1)], "a string, extra int")
    got = clean.conform(df, {"b": "date", "a": "int"})
    assert got.dtypes == [("b", "date"), ("a", "int")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.conform(spark.createDataFrame([("2.5",)], "a string"), {"a": "int"}).collect()


# --- joins ---


@pytest.mark.parametrize(
    "left, right, expected",
    [
        ([1, 2, None], [1], [2]),
        ([1, 2, None], [1, None], []),
        ([1, 2, None], [], [1, 2, None]),
        ([None], [1], []),
    ],
)
def test_not_in_follows_sql(spark, rows, left, right, expected):
    a = spark.createDataFrame([(v,) for v in left], "k int")
    b = spark.createDataFrame([(v,) for v in right], "x int")
    a.createOrReplaceTempView("left_side")
    b.createOrReplaceTempView("right_side")
    got = rows(joins.not_in(a, "k", b, "x"))
    assert got == sorted([(v,) for v in expected], key=repr)
    assert got == rows(spark.sql("SELECT k FROM left_side WHERE k NOT IN (SELECT x FROM right_side)"))


def test_not_in_needs_no_broadcast_of_the_subquery(spark):
    a = spark.createDataFrame([(1,)], "k int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.not_in(a, "k", a, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "LeftAnti" in plan


def test_lookup_drops_null_and_unknown_keys(spark, rows):
    facts = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "name string, v int")
    dim = spark.createDataFrame([("a", 10), (None, 11)], "name string, id int")
    assert rows(joins.lookup(facts, dim, ["name"], {"id": "dim_id"})) == [("a", 1, 10)]


def test_explode_skips_empty_and_missing_arrays(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None)], "id int, xs array<int>")
    assert joins.explode_items(df, F.col("xs")).count() == 2


# --- ranking ---


def test_top_of_group_ties(spark, rows):
    df = spark.createDataFrame([("c", "x"), ("c", "y"), ("c", "x"), ("c", "y"), ("c", "z")], "c string, v string")
    assert rows(ranking.most_frequent(df, ["c"], "v", "all")) == [("c", "x", 2), ("c", "y", 2)]
    assert rows(ranking.most_frequent(df, ["c"], "v", "first")) == [("c", "x", 2)]
    with pytest.raises(ValueError):
        ranking.most_frequent(df, ["c"], "v", "some")


# --- surrogate keys ---


def test_assigned_keys_are_unique_repeatable_and_above_existing(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"), F.lit(None).cast("bigint").alias("id"))
    existing = spark.createDataFrame([(70000,)], "id bigint")
    first = {r["name"]: r["id"] for r in keys.assign_keys(df, ["name"], existing=existing, buckets=8).collect()}
    again = keys.assign_keys(df.repartition(7), ["name"], existing=existing, buckets=8)
    assert len(set(first.values())) == 5000 and min(first.values()) > 70000
    assert {r["name"]: r["id"] for r in again.collect()} == first
    # eight buckets interleave, so the ids stay close to dense
    assert max(first.values()) < 70000 + 8 * 800


def test_keys_use_no_single_partition_window(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("name"), "id")
    plan = keys.assign_keys(df, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


# --- merge ---

DIM = "id bigint, name string, city string, load_dttm timestamp"


def dim(spark, *data):
    return spark.createDataFrame(list(data), DIM)


def batch(spark, *data):
    return spark.createDataFrame(list(data), "name string, city string")


def merged(target, source, **options):
    return merge.merge_upsert(
        target, source, ["name"], ["city"], stamp=("load_dttm", T2), id_column="id", **options
    )


def test_merge_updates_inserts_and_keeps(spark, rows):
    target = dim(spark, (1, "a", "old", T1), (2, "b", "kept", T1))
    got = rows(merged(target, batch(spark, ("a", None), ("c", "new"))), "name", "city", "load_dttm")
    # a NULL in the batch overwrites the stored value
    assert got == [("a", None, T2), ("b", "kept", T1), ("c", "new", T2)]


def test_merge_numbers_new_rows_past_the_largest_id(spark):
    target = dim(spark, (41, "a", "x", T1))
    got = {r["name"]: r["id"] for r in merged(target, batch(spark, ("a", "y"), ("b", "z"), ("c", "z"))).collect()}
    assert got["a"] == 41 and got["b"] > 41 and got["c"] > 41 and got["b"] != got["c"]


def test_null_key_matches_nothing_and_is_inserted_again(spark, rows):
    target = dim(spark, (1, None, "x", T1))
    assert rows(merged(target, batch(spark, (None, "x"), (None, "x"))), "name", "city") == [(None, "x")] * 3


def test_duplicate_key_fails_or_keeps_the_preferred_row(spark, rows):
    target, twice = dim(spark, (1, "a", "x", T1)), batch(spark, ("a", "p"), ("a", "q"))
    with pytest.raises(Exception, match="holds a key twice"):
        merged(target, twice).collect()
    got = merged(target, twice, on_duplicate="latest", prefer=[F.desc("city")])
    assert rows(got, "name", "city") == [("a", "q")]


def test_merge_twice_gives_the_same_table(spark, rows):
    source = batch(spark, ("a", "x"), ("b", "y"))
    once = merged(dim(spark), source)
    assert rows(merged(once, source), "id", "name", "city") == rows(once, "id", "name", "city")


def test_upsert_keeps_creation_time(spark, rows):
    target = spark.createDataFrame([("k", 1, T1)], "k string, v int, created_at timestamp")
    source = spark.createDataFrame([("k", 2, T2), ("n", 3, T2)], "k string, v int, created_at timestamp")
    got = merge.upsert_on_key(target, source, ["k"], keep=["created_at"])
    assert rows(got) == [("k", 2, T1), ("n", 3, T2)]


def test_insert_new_adds_a_null_key_only_to_an_empty_dimension(spark, rows):
    source = spark.createDataFrame([(1, "a"), (None, "n")], "city_id bigint, city_name string")
    empty = spark.createDataFrame([], "city_id bigint, city_name string")
    first = merge.insert_new(empty, source, "city_id")
    assert rows(first) == [(1, "a"), (None, "n")]
    # the NULL now stored makes NOT IN match nothing
    more = spark.createDataFrame([(2, "b")], "city_id bigint, city_name string")
    assert rows(merge.insert_new(first, more, "city_id")) == rows(first)


def test_split_batch(spark, rows):
    target = spark.createDataFrame([(1,), (1,)], "k int")
    new, known = merge.split_batch(spark.createDataFrame([(1,), (2,)], "k int"), target, ["k"])
    assert (rows(new), rows(known)) == ([(2,)], [(1,)])


def test_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(1, 2)], "k bigint, v int").write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    plan = merge.update_from(target, source, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


# --- incremental ---


def test_batches_by_id_equal_one_batch(spark, rows):
    source = spark.range(25).select(F.col("id"))
    last, seen = incremental.FIRST_ID, []
    while True:
        part = incremental.incremental_extract(source, "id", last, limit=7)
        if incremental.batch_cursor(part, "id") is None:
            break
        last = incremental.batch_cursor(part, "id")
        seen += rows(part)
    assert sorted(seen) == [(i,) for i in range(25)]


def test_equal_times_at_the_cut(spark):
    source = spark.createDataFrame([(1, T1), (2, T2), (3, T2), (4, T2)], "id int, ts timestamp_ntz")
    plain = incremental.incremental_extract(source, "ts", incremental.FIRST_TS, limit=2)
    assert plain.count() == 2
    assert incremental.incremental_extract(source, "ts", incremental.batch_cursor(plain, "ts"), 2).count() == 0
    tied = incremental.incremental_extract(source, "ts", incremental.FIRST_TS, limit=2, with_ties=True)
    assert tied.count() == 4


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "string"])
def test_batches_above_the_top_k_are_filters(spark, rows, monkeypatch, kind):
    days = F.lit(datetime(2024, 10, 1).isoformat()).cast("timestamp_ntz") + F.make_dt_interval(F.floor(F.col("id") / 3).cast("int"))
    cursor = days if kind == "timestamp" else F.lpad(F.floor(F.col("id") / 3).cast("string"), 5, "0")
    source = spark.range(3000).select("id", cursor.cast(kind).alias("c"))
    first = source.agg(F.min("c").cast("timestamp_ntz" if kind == "timestamp" else kind)).first()[0]
    limits = [100, 1500, 2**31 + 1]
    expected = {(k, t): rows(incremental.incremental_extract(source, "c", first, min(k, 10_000), t)) for k in limits for t in (False, True)}
    monkeypatch.setattr(incremental, "TOP_K", 6)
    monkeypatch.setattr(incremental, "RANGES", 4)
    for k in limits:
        for ties in (False, True):
            batch = incremental.incremental_extract(source, "c", first, k, ties)
            assert "TakeOrdered" not in batch._jdf.queryExecution().toString()
            got = rows(batch)
            assert sorted(c for _, c in got) == sorted(c for _, c in expected[k, ties]) and len(set(got)) == len(got)
            if ties or k != 100:
                assert got == expected[k, ties]


def test_load_state(spark):
    state = incremental.empty_state(spark)
    assert incremental.get_setting(state, "flow") is None
    state = incremental.save_setting(state, "flow", {"last_loaded_ts": T1})
    state = incremental.save_setting(state, "other", {"last_loaded_id": 3})
    state = incremental.save_setting(state, "flow", {"last_loaded_ts": T2})
    assert incremental.get_setting(state, "flow") == {"last_loaded_ts": T2.isoformat()}
    assert incremental.get_setting(state, "other") == {"last_loaded_id": "3"}
    assert state.count() == 2


def test_high_water_defaults(spark):
    df = spark.createDataFrame([(T1, None)], "a timestamp, b timestamp")
    assert df.agg(incremental.high_water(["a", "b"], T2).alias("x")).first()["x"] == T2
    assert df.limit(0).agg(incremental.high_water(["a", "b"], T1).alias("x")).first()["x"] == T1
