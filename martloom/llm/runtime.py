"""What the operators share at run time: code on the executors, bounded batches, scratch tables."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martloom.session import scratch_path

#: Rows in one Arrow batch of texts, so that a task's Python memory does not depend on its partition.
ROWS_PER_BATCH = 512

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, and keep batches of texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    folder = tempfile.mkdtemp(prefix="martloom-code-")  # read by the driver alone, which serves it to the executors
    path = os.path.join(folder, "martloom_code.zip")
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, rows: int | None = None
) -> DataFrame:
    """Apply ``function`` to each Arrow batch, or to each ``rows`` of one; nothing is held between batches."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = rows or batch.num_rows
            for start in range(0, batch.num_rows, step or 1):
                out = function(batch.slice(start, step))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


class Scratch:
    """Tables written below the shared folder, each removable as soon as its last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; an older table of that name is removed afterwards."""
        path = scratch_path(self.spark, f"llm-{name}")
        df.write.parquet(path)
        old, self.paths[name] = self.paths.get(name), path
        if old:
            self._remove(old)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.paths.pop(name, None)
            if path:
                self._remove(path)

    def _remove(self, path: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
