"""Published tables split by the hash of their key, so that a batch reads and rewrites only the buckets it names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from martloom.operators.clean import conform
from martloom.operators.merge import in_partitions, merge_upsert
from martloom.operators.ranking import top_of_group
from martloom.schemas import empty_table
from martloom.sources.releases import BUCKET, Releases

#: Table of the last surrogate key given out in each table of a store.
LAST_IDS = "last_ids"
LAST_ID = {"name": "string", "last": "bigint"}


class BucketedTable:
    """A keyed table in a store.

    The number of buckets belongs to the table's layout and must not change; a bucket should hold some hundred MB. The
    bucket follows from the key alone, nulls included.
    """

    def __init__(self, store: Releases, name: str, columns: dict[str, str], keys: Sequence[str], buckets: int = 64):
        self.store, self.name, self.columns, self.keys, self.buckets = store, name, columns, list(keys), buckets

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` in the table's types, with the bucket of each row."""
        df = conform(df, {c: t for c, t in self.columns.items() if c in df.columns})
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def touched(self, placed: DataFrame) -> list[int]:
        """The buckets of some rows; at most as many numbers as there are buckets reach the driver."""
        return sorted(r[0] for r in placed.select(BUCKET).distinct().collect())

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        return self.store.read(self.name, empty_table(self.store.spark, self.columns), buckets).select(*self.columns)

    def changed(self, batch: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[int]]:
        """What ``merge`` makes of the buckets that the keys of ``batch`` name, for :meth:`Releases.publish`, and their numbers."""
        touched = self.touched(self.place(batch.select(*self.keys)))
        return self.place(merge(self.rows(touched))), touched

    def merge(self, batch: DataFrame, update_cols: Sequence[str], **options) -> tuple[DataFrame, list[int]]:
        """New content of the buckets that a MERGE of ``batch`` touches, and their numbers.

        With an ``id_column`` new rows are numbered above the last id of the store, see :func:`last_id`.
        """
        if options.get("id_column"):
            options["numbered"] = last_id(self.store, self.name, options["id_column"])
        return self.changed(batch, lambda rows: merge_upsert(rows, batch, self.keys, update_cols, **options))


def last_id(store: Releases, name: str, id_column: str = "id") -> DataFrame:
    """One row with the last id given out in a table, none before the first."""
    stored = store.read(LAST_IDS, empty_table(store.spark, LAST_ID))
    return stored.filter(F.col("name") == name).select(F.col("last").alias(id_column))


def with_last_ids(store: Releases, given: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The table of last ids after rows (and their id column) were written; publish it together with the rows."""
    stored = store.read(LAST_IDS, empty_table(store.spark, LAST_ID))
    rows = stored.select("name", "last")
    for name, (df, id_column) in given.items():
        rows = rows.unionByName(df.agg(F.lit(name).alias("name"), F.max(id_column).cast("bigint").alias("last")))
    return rows.filter("last is not null").groupBy("name").agg(F.max("last").alias("last"))


class KeyIndex:
    """Which partitions of a fact hold a key, when the partition is not part of the key.

    The entries of a load are added to the buckets of their keys, so a load costs its own size, and the entries of a
    key with the highest load number are the valid ones. A batch may hold a key several times unless ``unique``. A load looks its keys up in the buckets they name, tells
    which partitions it is about to change, changes them, and adds its entries. Should it stop in
    between, the next one takes the entries of those partitions' rows from the fact itself.
    """

    def __init__(
        self, store: Releases, name: str, keys: dict[str, str], partition: tuple[str, str], buckets: int = 64, unique: bool = False
    ):
        self.column, self.unique = partition[0], unique
        self.store, self.name, self.pending = store, name, f"{name}_pending"
        self.table = BucketedTable(store, name, {**keys, self.column: partition[1], "load": "bigint"}, list(keys), buckets)

    def valid(self, buckets: Sequence[int] | None = None) -> DataFrame:
        return self._valid(self.table.rows(buckets))

    def _valid(self, entries: DataFrame) -> DataFrame:
        """The newest entries of each key; after a failed load there can be several."""
        return top_of_group(entries, self.table.keys, F.desc("load"), "all")

    def touched(self, batch: DataFrame) -> DataFrame:
        """Partition values that an upsert of ``batch`` changes: its own and those that hold its keys."""
        placed = self.table.place(batch.select(*self.table.keys))
        wanted = placed.select(*self.table.keys).distinct()
        entries = self.table.rows(self.table.touched(placed)).join(wanted, self.table.keys, "left_semi")
        moved = self._valid(entries.select(*self.table.columns)).select(self.column)
        return batch.select(F.col(self.column).cast(self.table.columns[self.column])).unionByName(moved).distinct()

    def begin(self, touched: DataFrame) -> None:
        """Note the partitions that are about to change."""
        self.store.publish({self.pending: touched.select(self.column)})

    def finish(self, batch: DataFrame) -> None:
        """Add where the keys of ``batch`` are now."""
        load = self.store.current()[0] + 1
        places = batch.select(*self.table.keys, self.column)
        entries = self.table.place((places if self.unique else places.distinct()).withColumn("load", F.lit(load)))
        done = batch.select(F.col(self.column).cast(self.table.columns[self.column])).limit(0)
        self.store.publish({self.pending: done}, added={self.name: entries}, squash={self.name: self._valid})

    def recover(self, facts: DataFrame) -> None:
        """Index a fact that has no index yet, or the partitions that a failed load may have changed."""
        pending = self.store.read(self.pending)
        if pending is None:
            self.finish(facts)
        elif not pending.isEmpty():
            self.finish(in_partitions(facts, pending, self.column))
