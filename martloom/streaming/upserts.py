"""File stream merged into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.clean import keep_first
from martloom.operators.merge import touched_rows
from martloom.schemas import ddl, empty_table
from martloom.session import scratch_table
from martloom.sources.tables import write_partitions


def read_file_stream(
    spark: SparkSession, path: str, columns: dict[str, str], files_per_batch: int = 1000, format: str = "parquet"
) -> DataFrame:
    """New files under a path as a stream; the checkpoint takes the place of the load state."""
    reader = spark.readStream.schema(ddl(columns)).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(format).load(path)


def upsert_stream(
    source: DataFrame,
    table_path: str,
    columns: dict[str, str],
    keys: Sequence[str],
    partition_col: str,
    checkpoint: str,
    prefer: Sequence[Column],
) -> StreamingQuery:
    """Merge every micro-batch into a Parquet table partitioned by ``partition_col``, a part of the key.

    Of all rows of a key, stored and new, the first in ``prefer`` order stays, so the table does not
    depend on how rows fall into batches, and a late file does not undo a newer row. Only partitions
    that the batch names are read and rewritten. A batch that runs again after a failure leaves the
    same table, so no batch number has to be kept. Takes what is there and stops.
    """
    if partition_col not in keys:
        raise ValueError("the partition column must be part of the key")
    spark = source.sparkSession
    empty_table(spark, columns).write.mode("ignore").partitionBy(partition_col).parquet(table_path)

    def merge_batch(batch: DataFrame, _: int) -> None:
        table = batch.sparkSession.read.schema(ddl(columns)).parquet(table_path)
        order = [*prefer, *[F.col(c) for c in columns if c not in keys]]
        with scratch_table(batch.select(*columns), "micro-batch") as rows:
            known = touched_rows(table, rows, keys, partition_col).select(*columns)
            write_partitions(keep_first(known.unionByName(rows), keys, order), table_path, [partition_col])

    return (
        source.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
