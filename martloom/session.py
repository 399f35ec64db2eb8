"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join whose result feeds another join on the same key is worth one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "martloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the pipelines are tuned for; ``extra`` uses ``__`` for dots.

    A local session without a ``spark.checkpoint.dir`` gets a new folder of this machine for it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}
    if master and master.startswith("local["):
        settings.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="martloom-"))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) may run without the setting; it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="martloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark).rstrip('/')}/martloom/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a costly result that several branches read: unlike a cache it outlives lost executors, and
    as Parquet each branch still reads only the columns, and the partitions, it needs.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    columns = df.columns
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*columns)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose last reader is done."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_table(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """A table like that of :func:`materialize`, removed when the block ends."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)
