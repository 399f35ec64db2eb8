"""Benchmark items inside documents: MinHash containment search with documents partitioned by size.

A short item inside a long document has a small Jaccard similarity, so a signature of one length for
all finds nothing. Documents fall into partitions by the size of their shingle set, and the signature
of a partition has twice as many bins as its smallest set has shingles; a bin holds the smallest hash
that falls into it. So 63 to 79 percent of a document's shingles are in its signature, whatever its
length, and an item that is contained must share a number of values with it that follows from the
containment. An item for which that number would be none is looked up by all its shingles instead.
What either way finds is verified by exact containment.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.runtime import Scratch, map_batches
from martloom.llm.words import Batch, shingle_sets

#: Distinct shingles of all items up to which they are broadcast as a filter: 8 MB.
FILTER_LIMIT = 1_000_000

#: Share of a document's shingles that its signature has at least: 1 - 1/e, with as many bins as shingles.
SIGNED = 0.632

#: Chance at which a contained item may have too few shingles in a signature; one beyond it is looked up.
MISSED = 1e-12

#: Bits of the table that is looked up before the filter.
_TABLE_BITS = 20


def in_signature(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which of the sorted (text, hash) rows are in the signature of their text.

    A text of 2^p to 2^(p+1) - 1 shingles has 2^(p+1) bins, told by the leading bits of the hash.
    """
    sizes = np.bincount(text)
    bits = np.frexp(sizes.astype(np.float64))[1][text]
    bins = value >> (np.uint64(64) - bits.astype(np.uint64))
    first = np.ones(len(value), bool)
    first[1:] = (text[1:] != text[:-1]) | (bins[1:] != bins[:-1])
    return first


def least_signed(shared: int, missed: float = MISSED) -> int:
    """Signature values that ``shared`` shingles have at least, but for a chance of ``missed``; 0 if there is no such number.

    By Chernoff's bound for a share of SIGNED: fewer than k with a chance of at most exp(-shared * divergence).
    """
    found = 0
    for k in range(1, int(shared * SIGNED) + 1):
        share = (k - 1) / shared
        divergence = (1 - share) * math.log((1 - share) / (1 - SIGNED)) + (share * math.log(share / SIGNED) if share else 0.0)
        if math.exp(-shared * divergence) > missed:
            break
        found = k
    return found


def item_shingles(items: DataFrame, size: int, contained: float, id_column: str, text_column: str) -> DataFrame:
    """Columns item, hash, n (distinct shingles of the item) and needed: signature values to share, 0 if all shingles are looked up."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Batch(batch.column(1), lower=True)
        text, value = shingle_sets(words, size)
        counts = np.bincount(text, minlength=batch.num_rows)
        # the long items need as many as one of a thousand shingles, which is soon found
        needed = np.array([least_signed(math.ceil(contained * min(n, 1000) - 1e-9)) for n in counts.tolist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(text)), pa.array(value.view(np.int64)), pa.array(counts[text], pa.int64()), pa.array(needed[text])],
            ["item", "hash", "n", "needed"],
        )

    rows = items.select(F.col(id_column).alias("item"), F.col(text_column).cast("binary").alias("text"))
    return map_batches(rows, run, f"item {rows.schema['item'].dataType.simpleString()}, hash bigint, n bigint, needed bigint")


class Known:
    """Shingles of the items, and which of them are looked up and not only compared with signatures; sorted by hash."""

    def __init__(self, hashes: np.ndarray, few: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.few = hashes[order], few[order]
        self.leading = _table(self.hashes)

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the values are known, as numbers, and whether each is looked up."""
        hits = np.flatnonzero(self.leading[value >> np.uint64(64 - _TABLE_BITS)])
        if len(hits):
            at = np.minimum(np.searchsorted(self.hashes, value[hits]), len(self.hashes) - 1)
            same = self.hashes[at] == value[hits]
            return hits[same], self.few[at[same]]
        return hits, np.zeros(0, bool)


def _known(shingles: DataFrame) -> Broadcast | None:
    """The items' shingles on every executor, if they are few."""
    rows = shingles.groupBy("hash").agg(F.min("needed").alias("needed")).limit(FILTER_LIMIT + 1).toArrow()
    if rows.num_rows > FILTER_LIMIT:
        return None
    known = Known(rows["hash"].to_numpy().view(np.uint64), rows["needed"].to_numpy() == 0)
    return shingles.sparkSession.sparkContext.broadcast(known)


def document_shingles(rows: DataFrame, size: int, known: Broadcast | None, signatures: bool) -> DataFrame:
    """Columns doc, hash and signed of the rows' (doc, text) shingles, of the known ones if they are given.

    With ``signatures`` a shingle outside the signature is there only if an item is looked up by it.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, value = shingle_sets(Batch(batch.column(1), lower=True), size)
        signed = in_signature(text, value)
        if known is not None:
            hits, few = known.value.find(value)
            if signatures:
                hits = hits[few | signed[hits]]
            text, value, signed = text[hits], value[hits], signed[hits]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(text)), pa.array(value.view(np.int64)), pa.array(signed)], ["doc", "hash", "signed"]
        )

    return map_batches(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, hash bigint, signed boolean")


def candidates(rows: DataFrame, shingles: DataFrame, size: int, contained: float, known: Broadcast | None) -> DataFrame:
    """Pairs (doc, item) that share enough signature values or, for items that are looked up, enough shingles; by_signature says which."""
    enough = F.when(F.col("needed") > 0, F.col("shared") >= F.col("needed")).otherwise(F.col("shared") >= contained * F.col("n"))
    return (
        document_shingles(rows, size, known, True)
        .join(shingles, "hash")
        .filter("signed or needed = 0")
        .groupBy("doc", "item")
        .agg(F.count_distinct("hash").alias("shared"), F.max("n").alias("n"), F.min("needed").alias("needed"))
        .filter(enough)
        .select("doc", "item", (F.col("needed") > 0).alias("by_signature"))
    )


def find(
    documents: DataFrame, items: DataFrame, size: int = 5, contained: float = 0.8, id_column: str = "doc_id",
    text_column: str = "text", item_id: str = "item_id", item_text: str = "text", scratch: Scratch | None = None,
) -> DataFrame:
    """Pairs of a document and an item of which it contains at least ``contained`` of the shingles.

    Columns: the document's id, the item's id, n_shared, n_shingles (both distinct shingles), containment
    and by_signature (whether signatures found the pair). Words are runs between ASCII white space with
    A-Z lowered. An item of fewer words than a shingle is one shingle, found in documents of the same few
    words only; items and documents without words are in no pair. Rows with an id twice count as one text
    with the shingles of both. Items are broadcast as a filter while their distinct shingles are at most
    FILTER_LIMIT; with more items the documents' shingles are joined instead, with the same result. The
    candidates are written, and only their documents are read again to be verified. A pair is missed with
    a chance of MISSED at most.
    """
    scratch = scratch or Scratch(documents.sparkSession)
    shingles = item_shingles(items, size, contained, item_id, item_text)
    known = _known(shingles)
    rows = documents.select(F.col(id_column).alias("doc"), F.col(text_column).cast("binary").alias("text"))
    pairs = scratch.keep(candidates(rows, shingles, size, contained, known), "leak-candidates")
    told = pairs.select(F.col("doc").alias("_doc"), F.col("item").alias("_item"), "by_signature")
    again = rows.join(told.select("_doc").distinct(), F.col("doc").eqNullSafe(F.col("_doc")), "left_semi")
    hits = document_shingles(again, size, known, False).join(shingles, "hash")
    return (
        hits.join(told, F.col("doc").eqNullSafe(F.col("_doc")) & F.col("item").eqNullSafe(F.col("_item")))
        .groupBy("doc", "item")
        .agg(F.count_distinct("hash").alias("n_shared"), F.max("n").alias("n_shingles"), F.max("by_signature").alias("by_signature"))
        .filter(F.col("n_shared") >= contained * F.col("n_shingles"))
        .select(
            F.col("doc").alias(id_column), F.col("item").alias(item_id), "n_shared", "n_shingles",
            (F.col("n_shared") / F.col("n_shingles")).alias("containment"), "by_signature",
        )
    )


def _table(values: np.ndarray) -> np.ndarray:
    """Which leading bits any of the values has."""
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[values >> np.uint64(64 - _TABLE_BITS)] = True
    return table


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
