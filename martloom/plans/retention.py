"""Weekly customer retention, computed from all lines or kept up to date by what a load adds and takes back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.functions.dates import iso_week, iso_week_period
from martloom.functions.numbers import count_when, sum_when
from martloom.operators.clean import conform
from martloom.operators.merge import in_partitions
from martloom.schemas import CUSTOMER_COUNTS, F_CUSTOMER_RETENTION, REFUNDED, SHIPPED, ddl, empty_table
from martloom.session import materialize
from martloom.sources import tables
from martloom.sources.releases import Releases

WEEKLY = "weekly"
MEASURES = ["n_lines", "shipped_cnt", "refunded_cnt", "shipped_revenue"]


def customer_counts(
    f_sales: DataFrame, calendar: DataFrame, business_date: date | None = None, by_year: bool = True
) -> DataFrame:
    """Lines, shipped and refunded ones and shipped revenue per period, customer and item."""
    period = iso_week_period if by_year else iso_week
    days = calendar.select("date_id", period("fact_date").cast("bigint").alias("period_id"))
    if business_date is not None:
        days = days.filter(F.col("period_id") == period(F.lit(business_date)))
    # Calendar rows are bounded by the span of dates, see with_calendar.
    return _summed(_line_counts(f_sales.join(F.broadcast(days), "date_id")))


def _line_counts(lines: DataFrame) -> DataFrame:
    """Each line as the counts of one line."""
    shipped, refunded = F.col("status") == SHIPPED, F.col("status") == REFUNDED
    return conform(lines.select(
        "period_id", "customer_id", "item_id", F.lit(1).alias("n_lines"),
        F.when(shipped, 1).otherwise(0).alias("shipped_cnt"), F.when(refunded, 1).otherwise(0).alias("refunded_cnt"),
        F.when(shipped, F.col("payment_amount")).otherwise(0).alias("shipped_revenue"),
    ), CUSTOMER_COUNTS)


def retention_of(counts: DataFrame) -> DataFrame:
    """Retention per period and item; a customer is one row of ``counts`` there, so nothing is counted DISTINCT."""
    new, returning = F.col("shipped_cnt") == 1, F.col("shipped_cnt") > 1
    known = F.col("customer_id").isNotNull()
    per_item = counts.groupBy("period_id", "item_id").agg(
        count_when(new & known).alias("new_customers_count"),
        count_when(returning & known).alias("returning_customers_count"),
        count_when((F.col("refunded_cnt") > 0) & known).alias("refunded_customers_count"),
        sum_when(new, "shipped_revenue", "decimal(10,2)").alias("new_customers_revenue"),
        sum_when(returning, "shipped_revenue", "decimal(10,2)").alias("returning_customers_revenue"),
        F.sum("refunded_cnt").alias("customers_refunded"),
    )
    return conform(per_item.withColumn("period_name", F.lit(WEEKLY)), F_CUSTOMER_RETENTION)


class WeeklyRetention:
    """The stored mart and the counts per week, customer and item that it is made of.

    A load adds the counts of its lines and takes back those of the lines they replace, so it reads the weeks that
    change and no sales line but its own, in whichever week the replaced ones were. The load notes its weeks before it
    changes the fact. Should it stop in between, the next one counts these weeks anew from the fact.
    """

    PENDING = "pending_weeks"

    def __init__(self, spark: SparkSession, root: str, calendar: DataFrame):
        root = root.rstrip("/")
        self.spark, self.calendar = spark, calendar
        self.counts, self.mart = f"{root}/f_customer_counts", f"{root}/f_customer_retention"
        self.notes = Releases(spark, f"{root}/f_customer_counts_state")
        empty_table(spark, CUSTOMER_COUNTS).write.mode("ignore").partitionBy("period_id").parquet(self.counts)
        empty_table(spark, F_CUSTOMER_RETENTION).write.mode("ignore").partitionBy("period_name", "period_id").parquet(self.mart)

    def stored(self) -> DataFrame:
        return self.spark.read.schema(ddl(CUSTOMER_COUNTS)).parquet(self.counts)

    def moved(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """Counts of each line of a load, and with the sign turned of each line that they replace.

        They are not added up here, as :meth:`finish` adds them to the stored ones by the same key. What is given must stay
        as it is while the fact changes.
        """
        days = self.calendar.select("date_id", iso_week_period("fact_date").cast("bigint").alias("period_id"))
        added, taken = (_line_counts(lines.join(F.broadcast(days), "date_id")) for lines in (after, before))
        taken = conform(taken.withColumns({c: -F.col(c) for c in MEASURES}), CUSTOMER_COUNTS)
        return added.unionByName(taken)

    def begin(self, moved: DataFrame) -> None:
        """Note the weeks whose lines are about to change."""
        self.notes.publish({self.PENDING: moved.select("period_id").distinct()})

    def finish(self, moved: DataFrame) -> None:
        """Add the signed counts to the stored ones and replace the weeks of the mart that they are of."""
        weeks = materialize(moved.select("period_id").distinct(), "changed-weeks")
        kept = in_partitions(self.stored(), weeks, "period_id")
        self._replace(_summed(kept.unionByName(moved)).filter("n_lines > 0"), weeks)

    def recover(self, facts: DataFrame) -> None:
        """Count all weeks if that was never done, or the weeks that a failed load may have changed."""
        weeks = self.notes.read(self.PENDING)
        if weeks is None:
            counts = materialize(conform(customer_counts(facts, self.calendar), CUSTOMER_COUNTS), "all-counts")
            weeks = counts.unionByName(self.stored()).select("period_id").distinct()
            self._replace(counts, materialize(weeks, "all-weeks"))
        elif not weeks.isEmpty():
            days = self.calendar.withColumn("period_id", iso_week_period("fact_date").cast("bigint")).join(weeks, "period_id")
            self._replace(customer_counts(in_partitions(facts, days, "date_id"), days), weeks)

    def _replace(self, counts: DataFrame, weeks: DataFrame) -> None:
        tables.replace_touched(conform(counts, CUSTOMER_COUNTS), self.counts, "period_id", weeks)
        mart = retention_of(in_partitions(self.stored(), weeks, "period_id")).drop("period_name")
        tables.replace_touched(mart, f"{self.mart}/period_name={WEEKLY}", "period_id", weeks)
        self.notes.publish({self.PENDING: weeks.limit(0)})


def _summed(counts: DataFrame) -> DataFrame:
    sums = counts.groupBy("period_id", "customer_id", "item_id").agg(*[F.sum(c).alias(c) for c in MEASURES])
    return conform(sums, CUSTOMER_COUNTS)
