"""Toxicity by a classifier chain.

The categories are predicted one after the other, each by a linear model on the words of the text and
the probabilities of the categories before it. For training these probabilities are out of fold: each
labelled text gets them from models that have not seen it, as it will be for new texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import logistic
from martloom.llm.runtime import Scratch, map_batches

#: Labelled texts a model is fitted on, the first by a hash of their id.
SAMPLE = 8_000
#: Words that are features, those that tell the categories best.
FEATURES = 600
#: Texts that must have a word before it can be a feature.
LEAST_TEXTS = 8
FOLDS = 4
#: Letters of the word beginnings that count as words of their own.
BEGINNING = 5

_MARKS = b".,;:!?\"'()[]{}*_~"


def terms(text: bytes | None) -> set[bytes]:
    """Distinct words without marks around them, A-Z lowered, and the beginnings of longer words."""
    if not text:
        return set()
    words = {w.strip(_MARKS) for w in set(text.lower().split())}
    return words | {w[:BEGINNING] + b"-" for w in words if len(w) > BEGINNING}


@dataclass
class Chain:
    """For each category its name, the intercept, the weights of terms and of the categories before it, the threshold."""

    names: list[str]
    intercepts: list[float]
    weights: list[np.ndarray]
    thresholds: list[float]
    vocabulary: dict[bytes, int]

    def probabilities(self, texts: list[bytes | None]) -> np.ndarray:
        """A row for each text, a column for each category."""
        width = len(self.vocabulary)
        found = [[self.vocabulary[t] for t in terms(text) if t in self.vocabulary] for text in texts]
        out = np.zeros((len(texts), len(self.names)))
        for k, weights in enumerate(self.weights):
            margin = np.array([self.intercepts[k] + weights[f].sum() for f in found])
            out[:, k] = logistic.probability(margin + out[:, :k] @ weights[width:])
        return out


def fit_chain(x: np.ndarray, y: np.ndarray, names: list[str], vocabulary: dict[bytes, int], folds: np.ndarray) -> Chain:
    """Chain on a table of terms ``x`` (0 or 1) and categories ``y``."""
    chain = Chain(names, [], [], [], vocabulary)
    before = np.zeros((len(x), 0))
    for k in range(len(names)):
        table = np.hstack([x, before])
        out = np.zeros(len(x))
        for fold in range(FOLDS):
            held = folds == fold
            if held.any() and not held.all():
                a, w = logistic.fit(table[~held], y[~held, k], ridge=1e-4, lasso=2e-4)
                out[held] = logistic.probability(table[held] @ w + a)
        a, w = logistic.fit(table, y[:, k], ridge=1e-4, lasso=2e-4)
        chain.intercepts.append(a)
        chain.weights.append(w)
        chain.thresholds.append(threshold(out, y[:, k]))
        before = np.hstack([before, out[:, None]])
    return chain


def threshold(scores: np.ndarray, truth: np.ndarray) -> float:
    """Middle of the cuts with the fewest errors out of fold; 0.5 without both classes."""
    if not len(truth) or truth.min() == truth.max():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    values = np.concatenate([[1.0], scores[order], [0.0]])
    # errors when the first i are called positive
    errors = truth.sum() - np.concatenate([[0], np.cumsum(truth[order])]) + np.concatenate([[0], np.cumsum(1 - truth[order])])
    cut = (values[:-1] + values[1:]) / 2
    best = np.flatnonzero((errors == errors.min()) & (values[:-1] > values[1:]))
    return float(np.clip(cut[best].mean(), 0.05, 0.95)) if len(best) else 0.5


def train(
    documents: DataFrame, labels: DataFrame, categories: list[str], id_column: str = "doc_id", text_column: str = "text",
    sample: int = SAMPLE,
) -> Chain:
    """Fit a chain for the 0/1 columns ``categories`` of ``labels``, in that order.

    At most ``sample`` labelled texts are used, the first by a hash of their id; rows without a label
    in any of the categories are left out. Which words become features is counted in Spark. Without
    labelled texts every probability is about a half and nothing is rejected.
    """
    spark = documents.sparkSession
    labelled = labels.select(F.col(id_column).alias("id"), *[F.col(c).cast("int").alias(c) for c in categories]).na.drop()
    chosen = labelled.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    # the sample is bounded, so it is a broadcast
    joined = texts.join(F.broadcast(chosen), "id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(terms(t)) for t in batch.column("text").to_pylist()]
        columns = [batch.column("id"), *[batch.column(c) for c in categories], pa.array(found, pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["id", *categories, "terms"])

    id_kind = joined.schema["id"].dataType.simpleString()
    flags = ", ".join(f"{c} int" for c in categories)
    scratch = Scratch(spark)
    listed = map_batches(joined.select("id", *categories, "text"), run, f"id {id_kind}, {flags}, terms array<binary>")
    listed = scratch.keep(listed, "terms")
    totals = listed.agg(F.count("*"), *[F.sum(c) for c in categories]).first()
    n = totals[0]
    if not n:
        scratch.drop("terms")
        return Chain(list(categories), [0.0] * len(categories), [np.zeros(k) for k in range(len(categories))], [0.95] * len(categories), {})
    counts = listed.select(F.explode("terms").alias("term"), *categories).groupBy("term").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]
    )
    # how far a term's share of positives is from the whole share, in standard errors, in any category
    tells = F.greatest(
        F.lit(0.0),
        *[
            F.abs(F.col(c) - F.col("n") * (totals[k] / n)) / F.sqrt(F.col("n") * max(totals[k] / n * (1 - totals[k] / n), 1e-9))
            for k, c in enumerate(categories, 1)
        ],
    )
    best = counts.filter(F.col("n") >= LEAST_TEXTS).orderBy(F.desc(tells), "term").limit(FEATURES).select("term").collect()
    vocabulary = {bytes(r[0]): i for i, r in enumerate(best)}
    known = F.array_intersect("terms", F.lit([bytes(r[0]) for r in best])) if best else F.array().cast("array<binary>")
    rows = listed.select("id", *categories, known.alias("terms")).orderBy(F.xxhash64("id"), "id").collect()
    scratch.drop("terms")
    x, y = np.zeros((len(rows), len(vocabulary))), np.zeros((len(rows), len(categories)))
    for i, row in enumerate(rows):
        x[i, [vocabulary[bytes(t)] for t in row["terms"]]] = 1
        y[i] = [row[c] for c in categories]
    return fit_chain(x, y, list(categories), vocabulary, np.arange(len(rows)) % FOLDS)


def score(documents: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, p_<category> and is_<category> of every row.

    Null and empty texts have no terms and get the intercepts' probabilities; repeated rows are scored
    one by one; other columns of the input do not matter.
    """
    shared = documents.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES terms

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        p = model.probabilities(batch.column(1).to_pylist())
        columns = [batch.column(0)]
        for k, cut in enumerate(model.thresholds):
            columns += [pa.array(p[:, k]), pa.array(p[:, k] > cut)]
        return pa.RecordBatch.from_arrays(columns, ["id", *[f"{a}_{n}" for n in model.names for a in ("p", "is")]])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    columns = ", ".join(f"p_{n} double, is_{n} boolean" for n in chain.names)
    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, {columns}").withColumnRenamed("id", id_column)


def reject(documents: DataFrame, chain: Chain, category: str, text_column: str = "text") -> DataFrame:
    """The rows that are not in ``category``, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(chain)
    at = chain.names.index(category)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        texts = batch.column(batch.schema.get_field_index(text_column)).cast(pa.binary()).to_pylist()
        return batch.filter(pa.array(model.probabilities(texts)[:, at] <= model.thresholds[at]))

    return map_batches(documents, run, documents.schema)


def categories_of(labels: DataFrame) -> DataFrame:
    """The two categories that the labels table knows: junk, the opposite of quality, and toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = categories_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(documents, train(documents, labels, ["junk", "toxic"]))
