"""Raw inputs: CSV, JSON documents, Parquet and relational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from martloom.operators.incremental import incremental_extract


def read_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """CSV with a header row, its columns cast to the declared types.

    Declared columns that the file lacks stay absent, and undeclared ones stay text, so optional
    columns can be told from empty ones. A value that does not fit its type is an error, and so is a
    file whose header is not that of the others.
    """
    raw = _checked_header(spark, path)
    return raw.select(*[F.col(c).cast(columns.get(c, "string")).alias(c) for c in raw.columns])

#: Fixed value: text of a whole number.
WHOLE = r"^[+-]?[0-9]+$"


def read_csv_inferred(spark: SparkSession, path: str, date_cols: Sequence[str] = ()) -> DataFrame:
    """CSV whose types come from its values.

    Whole numbers become INT (BIGINT where they need it), or DOUBLE when the column has gaps, as a
    data frame library without nullable integers would load them; fractions DOUBLE; true/false
    BOOLEAN; ``date_cols`` TIMESTAMP; everything else, other date-like text and numbers beyond BIGINT included, STRING.
    One aggregate over counts per column, which combine map-side, decides all types.
    """
    raw = _checked_header(spark, path)
    flags = {
        "gap": lambda c: c.isNull(),
        "whole": lambda c: c.rlike(WHOLE),
        "int": lambda c: c.rlike(WHOLE) & c.try_cast("int").isNotNull(),
        "long": lambda c: c.rlike(WHOLE) & c.try_cast("bigint").isNotNull(),
        "double": lambda c: ~c.rlike(r"\s") & c.try_cast("double").isNotNull(),
        "boolean": lambda c: F.lower(c).isin("true", "false"),
    }
    counts = [F.count_if(test(F.col(f"`{c}`"))).alias(f"{i}_{kind}") for i, c in enumerate(raw.columns) for kind, test in flags.items()]
    found = raw.agg(F.count("*").alias("rows"), *counts).first()

    def final_type(i: int, name: str) -> T.DataType:
        count = {kind: found[f"{i}_{kind}"] for kind in flags}
        values = found["rows"] - count["gap"]
        if name in date_cols:
            return T.TimestampNTZType()
        if not values:
            return T.StringType()
        if count["long"] == values:
            return T.DoubleType() if count["gap"] else T.IntegerType() if count["int"] == values else T.LongType()
        if count["double"] == values and count["whole"] < values:
            return T.DoubleType()
        return T.BooleanType() if count["boolean"] == values else T.StringType()

    schema = T.StructType([T.StructField(c, final_type(i, c)) for i, c in enumerate(raw.columns)])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def _checked_header(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; each file's header is compared with the first one's when it is read."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def land(df: DataFrame, path: str, partition_by: Sequence[str] = (), **options: str) -> None:
    """Write the raw copy once, times to the microsecond; a path that is there already is left as it is."""
    times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    df.write.mode("ignore").partitionBy(*partition_by).options(header=True, **times, **options).csv(path)


def read_documents(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    after=None,
    limit: int | None = None,
    cursor: str = "update_ts",
    with_ties: bool = False,
) -> DataFrame:
    """JSON-lines documents changed after a time, oldest first."""
    documents = spark.read.schema(schema).json(path)
    return documents if after is None else incremental_extract(documents, cursor, after, limit, with_ties)


def read_jdbc(
    spark: SparkSession, url: str, table: str, cursor: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """Relational table read in parallel ranges of its id; the cursor filter is pushed to the database."""
    return spark.read.jdbc(
        url, table, column=cursor, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=options,
    )


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths and sizes below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length")
    )
