"""Writing tables: append, rebuild, and replacement of single periods."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from martloom.operators.clean import conform
from martloom.operators.quality import Constraints, enforce
from martloom.schemas import ddl
from martloom.session import materialize, scratch_table

#: Fixed value: the folder name that Spark gives to a NULL partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Partitions that each task may write a file of, so that their rows need no shuffle to be gathered.
FEW = 4


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def rebuild(
    df: DataFrame, path: str, order_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> None:
    """Truncate and reload, optionally in key order.

    The order is by range partitions that are each sorted, so the files follow one another without a
    single sorting task. Give a key that is unique or nearly so; range bounds cannot split one value.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def order_violations(spark: SparkSession, path: str, order_by: Sequence[str]) -> DataFrame:
    """One row per file of a table that :func:`rebuild` wrote in order: file, n_rows, n_unsorted and n_overlaps.

    n_unsorted counts rows that are less than the row before them in the file, n_overlaps is 1 if the file begins below
    the end of the one before it. A file is a partition of the window, and of each one its
    ends reach the driver, which lists the files anyhow. Nulls come first.
    """
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), F.struct(*order_by).alias("key")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("before", before).groupBy("file").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("before") > F.col("key")).alias("n_unsorted"),
        F.min("key").alias("first"), F.max("key").alias("last"),
    )
    files = materialize(files, "file-ends")
    names = sorted(r["file"] for r in files.select("file").collect())
    following = spark.createDataFrame(list(zip(names, names[1:])), "earlier string, file string")
    ends = files.select(F.col("file").alias("earlier"), F.col("last").alias("end"))
    joined = files.join(following, "file", "left").join(ends, "earlier", "left")
    return joined.select("file", "n_rows", "n_unsorted", F.coalesce((F.col("end") > F.col("first")).cast("bigint"), F.lit(0)).alias("n_overlaps"))


def rebuild_typed(df: DataFrame, path: str, columns: dict[str, str], rules: Constraints) -> DataFrame:
    """Drop, create with declared types and constraints, reload. Nothing is written on a violation."""
    checked = enforce(materialize(conform(df, columns), "typed"), rules)
    checked.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(ddl(columns)).parquet(path)


def replace_period(df: DataFrame, path: str, period: dict[str, object]) -> None:
    """Replace the rows of one period (a day, a week) and nothing else.

    The rows go straight to the period's partition folder. An empty batch therefore clears the
    period, which a dynamic partition overwrite would not do.
    """
    shown = {name: NO_VALUE if value is None else value for name, value in period.items()}
    folder = "/".join([path.rstrip("/"), *[f"{name}={value}" for name, value in shown.items()]])
    df.drop(*period).write.mode("overwrite").option("compression", "zstd").parquet(folder)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], gather: bool = True) -> None:
    """Replace each partition that occurs in ``df``; others stay.

    The rebalance hint gathers a partition's rows into few files, and splits a partition that holds
    a large share of the rows over several tasks; without ``gather`` each task writes its own files. Spark stages the files and moves them at commit,
    so ``df`` may be computed from the table itself.
    """
    (
        (df.hint("rebalance", *partition_by) if gather else df)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_touched(
    df: DataFrame, path: str, partition_col: str, touched: DataFrame, rules: Constraints | None = None, stored: bool = False
) -> None:
    """Write the new content of touched partitions; those left without rows are emptied.

    The content is staged once in the shared folder, checked there, and then written; one that is ``stored`` already is
    read where it is. ``touched`` lists partition values, so what reaches the driver is bounded by the number of partitions.
    """
    with nullcontext(df) if stored else scratch_table(df, "touched") as staged:
        if rules:
            enforce(staged, rules)
        left = staged.select(F.col(partition_col).alias("_left")).distinct()
        gone = touched.join(left, F.col(partition_col).eqNullSafe(F.col("_left")), "left_anti").distinct().collect()
        write_partitions(staged, path, [partition_col], gather=len(left.take(FEW + 1)) > FEW)
        for row in gone:
            replace_period(staged.filter(F.lit(False)), path, {partition_col: row[0]})
