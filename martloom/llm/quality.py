"""Quality rules on repetition, by the suffix array of a text's words.

The suffixes of each text are sorted by prefix doubling, all texts of a batch at once. The ranks of
each doubling step are kept, so the longest common prefix of neighbouring suffixes is found exactly,
from the longest step down. The longest prefix that a suffix shares with a neighbour is the longest
substring from there that occurs twice; the spans of those of some length are united.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.runtime import map_batches
from martloom.llm.words import Batch

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """A text is rejected when repeats of ``span`` or more words cover a larger share, or one is longer."""

    span: int = 5
    covered: float = 0.45
    longest: int = 60
    least_words: int = 50
    repeat_percent: int = 50


def repeat_lengths(batch: Batch) -> np.ndarray:
    """For each word, the length of the longest run from there that occurs again in the same text."""
    n = len(batch.hashes)
    if not n:
        return np.zeros(0, np.int64)
    _, word = np.unique(batch.hashes, return_inverse=True)
    text = batch.text_of
    ends = np.repeat(batch.starts[1:], batch.counts)
    # rank: place of the first suffix of the group that shares the prefix; -1 past the end of the text
    key = text * (int(word.max()) + 1) + word
    order = np.argsort(key, kind="stable")
    first = np.ones(n, bool)
    first[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, step = [rank], 1
    open_ = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(open_):
        after = open_ + step
        inside = after < ends[open_]
        second = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        place = np.lexsort((second, rank[open_]))
        at, one, two = open_[place], rank[open_][place], second[place]
        index = np.arange(len(at))
        new_one = np.ones(len(at), bool)
        new_one[1:] = one[1:] != one[:-1]
        new_two = new_one.copy()
        # suffixes that end here are never equal to others
        new_two[1:] |= (two[1:] != two[:-1]) | (two[1:] < 0)
        group, part = np.maximum.accumulate(np.where(new_one, index, 0)), np.maximum.accumulate(np.where(new_two, index, 0))
        rank = rank.copy()
        rank[at] = one + part - group
        levels.append(rank)
        step *= 2
        sizes = np.bincount(part, minlength=len(at))
        open_ = np.sort(at[sizes[part] > 1])
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    left, right = array[:-1].copy(), array[1:].copy()
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b, common = left[pairs], right[pairs], np.zeros(len(pairs), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        size = 1 << level
        ranks = levels[level]
        inside = (a < ends[left[pairs]]) & (b < ends[right[pairs]])
        same = inside & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
        a, b, common = a + size * same, b + size * same, common + size * same
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, left[pairs], common)
    np.maximum.at(longest, right[pairs], common)
    return longest


def covered_words(batch: Batch, lengths: np.ndarray, least: int) -> np.ndarray:
    """Number of words of each text inside repeats of at least ``least`` words."""
    n = len(lengths)
    starts = np.flatnonzero(lengths >= least)
    return _per_text(batch, _cover(n, starts, starts + lengths[starts]))


def _cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _per_text(batch: Batch, marked: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(marked)])
    return sums[batch.starts[1:]] - sums[batch.starts[:-1]]


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measures(texts: list[bytes | None], limits: Limits) -> dict[str, np.ndarray]:
    """Base counts and repetition of each text."""
    batch = Batch(texts)
    n = len(batch.hashes)
    lengths = repeat_lengths(batch)
    triples = np.flatnonzero(lengths >= 3)
    longest = np.zeros(len(texts), np.int64)
    if n:
        np.maximum.at(longest, batch.text_of, lengths)
    decoded = [(t or b"").decode() for t in texts]
    return {
        "n_words": batch.counts,
        "word_chars": np.array([len(t) - sum(map(t.count, SPACES)) for t in decoded], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in decoded], np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) if "\n" in t else 0 for t in decoded], np.int64),
        "n_repeat_words": _per_text(batch, _cover(n, triples, triples + 3)) if n else np.zeros(len(texts), np.int64),
        "n_covered": covered_words(batch, lengths, limits.span) if n else np.zeros(len(texts), np.int64),
        "longest_repeat": longest,
    }


def judge(documents: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and verdict of every row.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered (words in
    repeats of at least ``limits.span`` words), longest_repeat, base_failed and kept. A null or empty
    text has zeros and fails the base rules; repeated rows are judged one by one; other columns of
    the input do not matter.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measures(batch.column(1).to_pylist(), limits)
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, pa.int64()) for v in found.values()]], ["id", *found])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "n_covered bigint, longest_repeat bigint"
    )
    failed = (F.col("n_words") < limits.least_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    fine = (F.col("n_covered") <= limits.covered * F.col("n_words")) & (F.col("longest_repeat") <= limits.longest)
    return (
        map_batches(rows, run, schema)
        .withColumns({"base_failed": failed, "kept": ~failed & fine})
        .withColumnRenamed("id", id_column)
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
