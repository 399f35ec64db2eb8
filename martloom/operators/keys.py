"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# A table of a trillion rows still has only some 15 million rows in a bucket.
BUCKETS = 65536


def assign_keys(
    df: DataFrame,
    natural_key: Sequence[str],
    id_column: str = "id",
    existing: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Number rows with new ids above those in ``existing``.

    Each row falls in a bucket by the hash of its natural key and is counted inside the bucket; the
    ids of the buckets interleave. So no task sees more than one bucket, nothing is counted twice,
    and a rerun over the same keys gives the same ids. Like a database sequence, ids are unique and
    growing but may leave gaps. The natural key must be unique in ``df``.
    """
    key = [F.col(k) for k in natural_key]
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    last = F.lit(0).cast("bigint")
    if existing is not None:
        last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()
    numbered = df.drop(id_column).withColumn("_bucket", bucket).withColumn("_place", place)
    new_id = last + (F.col("_place").cast("bigint") - 1) * buckets + F.col("_bucket") + 1
    return numbered.select(new_id.alias(id_column), *[c for c in df.columns if c != id_column])
