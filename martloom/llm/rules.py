"""Quality classifier by a sparse ensemble of rules.

Shallow trees are fitted on statistics of a bounded sample of labelled texts. Every path of a tree is
a rule, a conjunction of comparisons; a logistic regression with a lasso penalty gives most rules no
weight. The rules that are left are compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.llm import logistic, tree
from martloom.llm.runtime import map_batches
from martloom.llm.words import Batch

#: Labelled texts the rules are fitted on, the first by a hash of their id.
SAMPLE = 10_000
TREES = 24
DEPTH = 3
LASSO = 1e-3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>=+{}[]\\^~@/_",
    "exclaim": b"!?",
    "stop": b".,;:",
}
STATISTICS = [
    "n_words", "word_length", "distinct_words", "top_word", "repeated_pairs", "line_words", "repeated_lines",
    *[f"{c}_share" for c in _CLASSES],
]


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """A row of STATISTICS for each text; shares of a text without words or bytes are 0."""
    texts = [t or b"" for t in texts]
    batch = Batch(texts)
    rows, n = len(texts), batch.counts
    some = np.maximum(n, 1)
    out = {"n_words": n, "word_length": np.array([sum(map(len, w)) for w in batch.words]) / some}
    text = batch.text_of
    order = np.lexsort((batch.hashes, text))
    t, h = text[order], batch.hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    places = np.flatnonzero(new)
    sizes = np.diff(np.append(places, len(t)))
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, t[places], sizes)
    out["distinct_words"] = np.bincount(t[places], minlength=rows) / some
    out["top_word"] = top / some
    first = batch.run_starts(2)
    pairs, of = batch.run_hash(first, first + 2), text[first] if len(first) else first
    order = np.lexsort((pairs, of))
    o, p = of[order], pairs[order]
    same = (o[1:] == o[:-1]) & (p[1:] == p[:-1])
    out["repeated_pairs"] = np.bincount(o[1:][same], minlength=rows) / some
    lines = [[line for line in t.split(b"\n") if line.strip()] for t in texts]
    n_lines = np.maximum(np.array([len(x) for x in lines]), 1)
    out["line_words"] = n / n_lines
    out["repeated_lines"] = np.array([len(x) - len(set(x)) for x in lines]) / n_lines
    lengths = np.array([len(t) for t in texts])
    stops = np.cumsum(lengths)
    letters = np.frombuffer(b"".join(texts), np.uint8)
    for name, members in _CLASSES.items():
        table = np.zeros(256, np.int64)
        table[list(members)] = 1
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(table[letters])])
        out[f"{name}_share"] = (sums[stops] - sums[stops - lengths]) / np.maximum(lengths, 1)
    return np.column_stack([out[s].astype(float) for s in STATISTICS])


Rule = tuple[float, tree.Path]


def holds(path: tree.Path, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for column, above, cut in path:
        out &= (x[:, column] > cut) == above
    return out


def fit_rules(x: np.ndarray, y: np.ndarray) -> tuple[float, list[Rule]]:
    """Intercept and the rules that the lasso keeps, from the paths of trees on parts of rows and columns."""
    random = np.random.default_rng(0)
    found: dict[tree.Path, None] = {}
    for _ in range(TREES if len(y) else 0):
        rows = random.choice(len(y), max(1, len(y) // 2), replace=False)
        columns = np.sort(random.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False))
        grown = tree.fit(x[rows], y[rows], DEPTH, max(5, len(rows) // 200), columns)
        found.update(dict.fromkeys(tree.paths(grown)))
    rules = list(found)
    table = np.column_stack([holds(r, x) for r in rules]).astype(float) if rules else np.zeros((len(y), 0))
    intercept, weights = logistic.fit(table, y, lasso=LASSO)
    return intercept, [(float(w), r) for w, r in zip(weights, rules) if w]


def compile_rules(intercept: float, rules: list[Rule]) -> Column:
    """Probability as a column over the statistics."""
    margin = F.lit(float(intercept))
    for weight, path in rules:
        parts = [F.col(STATISTICS[c]) > cut if above else F.col(STATISTICS[c]) <= cut for c, above, cut in path]
        margin = margin + F.when(reduce(Column.__and__, parts), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-margin))


def with_statistics(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and the statistics of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = statistics(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in table.T]], ["id", *STATISTICS])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{s} double" for s in STATISTICS)
    return map_batches(rows, run, schema).withColumnRenamed("id", id_column)


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text_column: str = "text",
    sample: int = SAMPLE,
) -> tuple[float, list[Rule]]:
    """Rules fitted on at most ``sample`` labelled texts, the first by a hash of their id.

    An id that is labelled twice counts with its smaller label. Without labels the score is one half.
    """
    labelled = labels.select(F.col(id_column).alias("id"), F.col(label).cast("double").alias("label")).na.drop()
    chosen = labelled.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(chosen.select("id")), "id")
    measured = with_statistics(texts, "id", "text").join(F.broadcast(chosen), "id")
    rows = sorted(measured.select("id", "label", *STATISTICS).collect(), key=tuple)
    table = np.array([r[1:] for r in rows], float).reshape(len(rows), len(STATISTICS) + 1)
    return fit_rules(table[:, 1:], table[:, 0])


def score(documents: DataFrame, model: tuple[float, list[Rule]], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and the score of every row.

    Null and empty texts are scored by their zero statistics, repeated rows one by one; other columns
    of the input do not matter.
    """
    return with_statistics(documents, id_column, text_column).select(id_column, compile_rules(*model).alias("score"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = train(documents, labels.filter(~held_out))
    return score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
