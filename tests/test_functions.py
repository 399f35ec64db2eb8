from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import dates, documents, numbers


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in TYPES(values)))
    return row.select(column.alias("x")).first()["x"]


def TYPES(values):
    kinds = {date: "date", datetime: "timestamp_ntz", int: "int", str: "string", Decimal: "decimal(19,5)", float: "double"}
    return [(k, kinds[type(v)]) for k, v in values.items()]


def test_iso_week_at_year_boundary(spark):
    assert one(spark, dates.iso_week_period("d"), d=date(2021, 1, 1)) == 202053
    assert one(spark, dates.iso_week_period("d"), d=date(2018, 12, 31)) == 201901
    assert one(spark, dates.iso_year("d"), d=date(2016, 1, 3)) == 2015


def test_month_period_is_month_not_minute(spark):
    assert one(spark, dates.month_period("d"), d=datetime(2021, 3, 4, 10, 59)) == "2021-03"


def test_date_key_and_back(spark):
    assert one(spark, dates.date_key("d"), d=date(987, 1, 9)) == 9870109
    assert one(spark, dates.day_from_key("k"), k=20240229) == date(2024, 2, 29)


def test_truncate_keeps_naive_time(spark):
    moment = datetime(2024, 3, 31, 2, 30, 5, 999999)
    assert one(spark, dates.truncate_to_second("t"), t=moment) == datetime(2024, 3, 31, 2, 30, 5)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # the hour does not exist there
    try:
        assert one(spark, dates.truncate_to_second("t"), t=moment) == datetime(2024, 3, 31, 2, 30, 5)
        assert one(spark, dates.clock_time("t"), t=moment) == "02:30:05"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_days_between_can_be_negative(spark):
    assert one(spark, dates.days_between("a", "b"), a=date(2024, 1, 10), b=date(2024, 1, 1)) == -9


def test_guarded_ratio(spark):
    assert one(spark, numbers.guarded_ratio("a", "b"), a=6.0, b=0.0) is None
    assert one(spark, numbers.guarded_ratio("a", "b"), a=6.0, b=4.0) == 1.5


def test_signed(spark):
    assert one(spark, numbers.signed("a", F.lit(True)), a=-3) == -3
    assert one(spark, numbers.signed("a", F.lit(True)), a=3) == -3
    assert one(spark, numbers.signed("a", F.lit(False)), a=-3) == 3


def test_whole_number(spark):
    assert one(spark, numbers.whole_number("q"), q=Decimal("2.00000")) == 2
    with pytest.raises(Exception, match="not a whole number"):
        one(spark, numbers.whole_number("q"), q=Decimal("2.50000"))


def test_exact_median_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 10, 20)], "v int")
    assert df.agg(numbers.exact_median("v").alias("m")).first()["m"] == 6.0


def test_conditional_aggregates_ignore_null_condition(spark):
    df = spark.createDataFrame([("done", 1), (None, 2), ("x", 3)], "s string, v int")
    got = df.agg(
        numbers.count_when(F.col("s") == "done"),
        numbers.count_when(F.col("s") != "done"),
        numbers.sum_when(F.col("s") == "absent", "v", "int"),
    ).first()
    assert tuple(got) == (1, 1, 0)


ITEM = {"id": "string", "price": "decimal(19,5)", "quantity": "decimal(19,5)"}


@pytest.mark.parametrize("text", ['{"id":"7","price":2.50,"quantity":3}', '{"id":"7","price":"2.50","quantity":"3"}'])
def test_numbers_in_documents_are_exact(spark, text):
    got = one(spark, documents.parse_document("t", ITEM), t=text)
    assert (got["id"], got["price"], got["quantity"]) == ("7", Decimal("2.50000"), Decimal("3.00000"))


def test_malformed_document(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        one(spark, documents.parse_document("t", ITEM), t='{"id":')
    kept = one(spark, documents.parse_document("t", ITEM, strict=False), t='{"id":')
    assert kept["_corrupt"] == '{"id":'


def test_iso_text_roundtrip(spark):
    moment = datetime(2022, 1, 1, 10, 0, 0, 120)
    assert one(spark, dates.from_iso_text(dates.iso_text("t")), t=moment) == moment
