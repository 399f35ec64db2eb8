"""Substring deduplication by relative Lempel-Ziv parsing of every text against the texts with smaller ids.

The index is made of blocks. Every text is cut where its content says: the smallest hash of a short run
of words inside each window is the window's anchor, and the windows in a row that share an anchor are a
block, so equal stretches of two texts fall into equal blocks but for their ends. Each distinct block is
indexed under its anchor with the place of its first occurrence, the reference. A block of a text that is
found whole is a seed. Where blocks share an anchor but not the whole, their windows are indexed one by
one, each with its first occurrence, and a window that is found is a seed.

A text is then parsed from left to right. Seeds that go on in the same reference text at the same distance
are one match, as long as it can be extended. At each word the factor is the match that goes on furthest
from there, a word that no match holds is a literal, and the next factor begins where the last one ends. A
factor that begins inside its match is checked over the boundary: the match is extended back, and from
there it has to be long enough. So the windows over a boundary of two factors count if, and only if, they
are found in a text with a smaller id.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.runtime import Scratch, map_batches
from martloom.llm.words import Batch

#: Words of the runs whose hashes are compared for the anchor.
ANCHOR = 16

_U = np.uint64
_HIGH, _LOW = _U(0xFFFFFFFF00000000), _U(0xFFFFFFFF)


def blocks_of(batch: Batch, window: int, anchor: int) -> dict[str, np.ndarray]:
    """Blocks of the batch: text, start (word of the text), windows, anchor hash, two hashes of the content."""
    anchor = min(anchor, window)
    starts = batch.run_starts(window)
    n = len(batch.hashes)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return {"text": empty, "start": empty, "windows": empty, "anchor": empty, "one": empty, "two": empty}
    first = np.arange(n - anchor + 1)
    grams = batch.run_hash(first, first + anchor)
    # hash above, place below: the smallest is the leftmost of the smallest hashes
    least = (grams & _HIGH) | first.astype(_U)
    have, width = 1, window - anchor + 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    place = (least[starts] & _LOW).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    windows = np.diff(np.append(at, len(starts)))
    begin = starts[at]
    end = begin + windows + window - 1
    text = batch.text_of[begin]
    return {
        "text": text, "start": begin - batch.starts[text], "windows": windows, "anchor": grams[place[at]].view(np.int64),
        "one": batch.run_hash(begin, end).view(np.int64), "two": batch.run_hash(begin, end, 1).view(np.int64),
    }


class Factor(NamedTuple):
    """Words ``start`` to ``end`` (excluded) of a text stand at ``place`` of the text ``source``; its match begins at ``origin``."""

    start: int
    end: int
    source: int
    place: int
    origin: int


def matches_of(text: np.ndarray, start: np.ndarray, length: np.ndarray, source: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Seeds joined to the longest stretches that go on in one source: text, start, end, source, place minus start."""
    shift = place - start
    order = np.lexsort((start, shift, source, text))
    text, start, source, shift = text[order], start[order], source[order], shift[order]
    end = start + length[order]
    if not len(text):
        return [text, start, end, source, shift]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (source[1:] != source[:-1]) | (shift[1:] != shift[:-1])
    above = np.cumsum(new) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(above + end) - above
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return [text[at], start[at], reach[np.append(at[1:], len(text)) - 1], source[at], shift[at]]


def parse(matches: list[tuple[int, int, int, int]]) -> list[Factor]:
    """Greedy factors of one text from its matches (start, end, source, place minus start).

    Of matches that go on equally far the one with the smallest source and place is taken. Words between
    factors are literals.
    """
    factors, at, i = [], 0, 0
    best = None
    matches = sorted(matches)
    while True:
        while i < len(matches) and matches[i][0] <= at:
            start, end, source, shift = matches[i]
            if best is None or (end, -source, -shift) > (best[1], -best[2], -best[3]):
                best = matches[i]
            i += 1
        if best and best[1] > at:
            factors.append(Factor(at, best[1], best[2], at + best[3], best[0]))
            at = best[1]
        elif i < len(matches):
            at = matches[i][0]
        else:
            return factors


def covered(n: int, factors: list[Factor], window: int) -> np.ndarray:
    """Which of the ``n`` words lie in a duplicate span: a factor, back over its boundary, of at least ``window`` words."""
    steps = np.zeros(n + 1, np.int64)
    for f in factors:
        if f.end - f.origin >= window:
            steps[f.origin] += 1
            steps[f.end] -= 1
    return np.cumsum(steps[:n]) > 0


def factors_of(seeds: pa.ListArray, counts: np.ndarray) -> list[list[Factor]]:
    """Factors of each text of a batch; seeds that go beyond its ``counts`` words belong to another row with its id."""
    flat = seeds.flatten()
    text = np.repeat(np.arange(len(seeds)), seeds.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start, length, source, place = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "length", "source", "place"))
    fits = start + length <= counts[text]
    of, *columns = matches_of(text[fits], start[fits], length[fits], source[fits], place[fits])
    found = list(zip(*(c.tolist() for c in columns)))
    ends = np.searchsorted(of, np.arange(len(seeds) + 1))
    return [parse(found[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def find_seeds(
    documents: DataFrame, scratch: Scratch, window: int = 50, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id and seeds (array of start, length, source, place) of the texts that have any.

    A seed says that the words of the text from start on also stand in the text source from place on; source is
    the smallest id that has them, and smaller than the text's own. The seeds hold every window whose words stand
    in a text with a smaller id. Texts shorter than a window, empty and null ones have none. Rows with an
    id twice count as one text; their seeds are those of either. A text without an id has none and is no source.
    """
    rows = documents.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).cast("binary").alias("text"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = blocks_of(Batch(batch.column(1)), window, ANCHOR)
        doc = batch.column(0).take(pa.array(found.pop("text")))
        arrays = [doc, pa.array(found["start"], pa.int32()), pa.array(found["windows"], pa.int32())]
        return pa.RecordBatch.from_arrays(
            arrays + [pa.array(found[c]) for c in ("anchor", "one", "two")], ["doc", "start", "windows", "anchor", "one", "two"]
        )

    schema = "doc bigint, start int, windows int, anchor bigint, one bigint, two bigint"
    blocks = scratch.keep(map_batches(rows, cut, schema), "blocks")
    # What is joined to many rows of one key is written first: then Spark can split such a key over tasks.
    shared = blocks.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    shared = scratch.keep(shared.select("anchor"), "shared-anchors")
    blocks = scratch.keep(blocks.join(shared, "anchor"), "shared-blocks")
    scratch.drop("blocks", "shared-anchors")
    # a text without an id is no reference
    reference = F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "start")))
    contents = blocks.groupBy("anchor", "one", "two").agg(reference.alias("first"))
    contents = scratch.keep(contents.select("anchor", "one", "two", F.col("first.doc").alias("source"), F.col("first.start").alias("place")), "contents")
    parted = contents.groupBy("anchor").agg(F.count("*").alias("contents")).filter("contents > 1").select("anchor")
    parted = scratch.keep(parted, "parted-anchors")
    told = scratch.keep(blocks.join(contents, ["anchor", "one", "two"]), "told-blocks")
    scratch.drop("shared-blocks", "contents")
    whole = told.filter("source < doc").select("doc", "start", (F.col("windows") + (window - 1)).alias("length"), "source", "place")
    # where blocks differ, one text for each content shows its windows
    open_ = told.filter("source = doc").join(parted, "anchor").groupBy("doc").agg(F.collect_set(F.struct("start", "windows")).alias("open"))

    def show(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Batch(batch.column("text"))
        parts, texts = [], []
        for i, spans in enumerate(batch.column("open").to_pylist()):
            for s in spans:
                # of rows with the same id only the one that has the block
                if s["start"] + s["windows"] + window - 1 <= words.counts[i]:
                    parts.append(np.arange(s["windows"]) + s["start"] + words.starts[i])
                    texts.append(np.full(s["windows"], i))
        first = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        text = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc").take(pa.array(text)), pa.array(first - words.starts[text], pa.int32()),
                pa.array(words.run_hash(first, first + window).view(np.int64)),
                pa.array(words.run_hash(first, first + window, 1).view(np.int64)),
            ],
            ["doc", "start", "one", "two"],
        )

    windows = scratch.keep(
        map_batches(rows.join(open_, "doc").select("doc", "text", "open"), show, "doc bigint, start int, one bigint, two bigint"),
        "windows",
    )
    firsts = windows.groupBy("one", "two").agg(reference.alias("first"), F.max("doc").alias("last")).filter("first.doc < last")
    firsts = scratch.keep(firsts.select("one", "two", F.col("first.doc").alias("source"), F.col("first.start").alias("place")), "first-windows")
    single = windows.join(firsts, ["one", "two"]).filter("source < doc").select("doc", "start", F.lit(window).alias("length"), "source", "place")
    seeds = F.collect_set(F.struct("start", "length", "source", "place")).alias("seeds")
    return whole.union(single).groupBy("doc").agg(seeds).withColumnRenamed("doc", id_column)


def factorize(
    documents: DataFrame, scratch: Scratch, window: int = 50, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per factor: the id, start, length, source, source_start and origin, all in words.

    The words of the factor stand in the text source, whose id is smaller, from source_start on. origin is where its match
    begins, before start if the factor before it reaches into the match. Texts without a factor have no row.
    """
    found = find_seeds(documents, scratch, window, id_column, text_column).withColumnsRenamed({id_column: "__doc", "seeds": "__seeds"})
    rows = documents.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = factors_of(batch.column("__seeds"), np.array([len((t or b"").split()) for t in batch.column("text").to_pylist()]))
        text = np.repeat(np.arange(len(listed)), [len(f) for f in listed])
        flat = np.array([(f.start, f.end - f.start, f.source, f.place, f.origin) for fs in listed for f in fs], np.int64).reshape(-1, 5)
        names = [id_column, "start", "length", "source", "source_start", "origin"]
        return pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(text)), *map(pa.array, flat.T)], names)

    joined = rows.join(found, F.col("doc") == F.col("__doc")).select("doc", "text", "__seeds")
    return map_batches(joined, run, f"`{id_column}` bigint, start bigint, length bigint, source bigint, source_start bigint, origin bigint")


def dedup(
    documents: DataFrame, scratch: Scratch, window: int = 50, id_column: str = "doc_id", text_column: str = "text",
    digest: bool = False, prefix: str = "",
) -> DataFrame:
    """Every row with n_words, n_removed, kept_text and n_factors; other columns as they are.

    With ``digest`` there is kept_sha256 in place of the text columns: that of the kept words, joined by a space.

    kept_text is the text itself where nothing goes, and else its words without the duplicate spans,
    each with the white space before it. Null and empty texts keep nothing and lose nothing. ``prefix``
    stands before the new names; an input column of a new name is replaced.
    """
    new = [prefix + c for c in ("n_words", "n_removed", "kept_sha256" if digest else "kept_text", "n_factors")]
    base = documents.drop(*new)
    seeds = find_seeds(documents, scratch, window, id_column, text_column).withColumnsRenamed({id_column: "__doc", "seeds": "__seeds"})
    joined = base.join(seeds, F.col(id_column).cast("bigint") == F.col("__doc"), "left").drop("__doc")
    rest = [f for f in base.schema.fields if not digest or f.name != text_column]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_column).to_pylist()
        split = [(t or "").encode().split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        factors = factors_of(batch.column("__seeds"), counts)
        removed, out = [], []
        for text, words, found in zip(texts, split, factors):
            kept = words
            if found:
                gone = covered(len(words), found, window)
                kept = [w for w, g in zip(words, gone) if not g]
            removed.append(len(words) - len(kept))
            if digest:
                out.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            else:
                out.append(text if len(kept) == len(words) else without(text.encode(), words, gone))
        arrays = [batch.column(f.name) for f in rest]
        arrays += [pa.array(counts), pa.array(removed, pa.int64()), pa.array(out, pa.string()), pa.array([len(f) for f in factors], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [*[f.name for f in rest], *new])

    return map_batches(joined, run, f"{schema}, {new[0]} bigint, {new[1]} bigint, {new[2]} string, {new[3]} bigint")


def without(raw: bytes, words: list[bytes], gone: np.ndarray) -> str:
    """The text without the words that go, and without the white space before each of them."""
    parts, at = [], 0
    for word, out in zip(words, gone):
        stop = raw.index(word, at) + len(word)
        if not out:
            parts.append(raw[at:stop])
        at = stop
    parts.append(raw[at:])
    return b"".join(parts).decode().strip(" \t\n\x0b\x0c\r")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup(documents, Scratch(spark), digest=True)
