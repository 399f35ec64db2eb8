"""Whitening against numpy on exact integers."""

import numpy as np
import pytest

from martloom.llm import whitening
from martloom.llm.runtime import Scratch

KIND = "vec_id bigint, embedding array<float>, label int, component string, n string"


def expected(rows, k=8):
    """Integers, exact deviations, and whitened rows up to the sign of each component."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows])
    n, s = len(x), x.sum(axis=0)
    far = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return far, centred @ vectors / np.sqrt(values), values / (centred**2).sum() * n


def check(df, rows, k=8):
    far, white, explained = expected(rows, k)
    found = {}
    for r in df.collect():
        found.setdefault(r["vec_id"], []).append(r)
    assert sorted(found) == sorted(i for i, _ in rows)
    k = min(k, white.shape[1])
    got = np.array([[r["whitened"] for r in sorted(found[i], key=lambda r: r["component"])] for i, _ in rows])
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got * signs, white, atol=1e-8)
    for (i, _), deviation in zip(rows, far):
        assert {r["deviation"] for r in found[i]} == {deviation}
        assert [r["n"] for r in found[i]] == [len(rows)] * k
        assert np.allclose([r["explained"] for r in sorted(found[i], key=lambda r: r["component"])], explained, rtol=1e-9)
    assert {r["identity_error"] < 1e-9 for rs in found.values() for r in rs} == {True}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], KIND)


def test_supplied_embeddings(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(whitening.op11_embedding_whitening(spark, path), rows)


def test_many_blocks_and_left_out_vectors(spark, monkeypatch):
    """Several blocks of rows and of columns; nulls, non-finite entries and other lengths are left out."""
    monkeypatch.setattr(whitening, "ROWS", (7, 7))
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=12) * np.arange(1, 13))]) for i in range(101)]
    nothing = [None, [], [None] * 12, [float("nan")] * 12, [1.0] * 11 + [float("inf")], [1e30] * 12, [1.0] * 5]
    df = frame(spark, rows + [(1000 + i, v) for i, v in enumerate(nothing)]).repartition(5)
    check(whitening.whiten(df, Scratch(spark)), rows)


def test_repeated_rows_and_few_components(spark):
    rng = np.random.default_rng(4)
    vectors = [[float(c) for c in np.float32(rng.normal(size=3))] for _ in range(20)]
    df = frame(spark, [(1, v) for v in vectors] + [(None, vectors[0]), (None, vectors[0])])
    out = whitening.whiten(df, Scratch(spark)).collect()
    assert len(out) == 22 * 3 and sum(r["vec_id"] is None for r in out) == 6
    assert {r["n"] for r in out} == {22} and all(r["identity_error"] < 1e-9 for r in out)


@pytest.mark.parametrize("vectors, whitened", [([[1.0, 2.0]] * 3, 0), ([[0.0, 1.0], [1.0, 1.0]], 1)])
def test_without_variance(spark, vectors, whitened):
    out = whitening.whiten(frame(spark, list(enumerate(vectors))), Scratch(spark)).collect()
    assert len(out) == 2 * len(vectors)
    assert sum(r["whitened"] is not None for r in out) == whitened * len(vectors)
    assert all((r["explained"] is None) == (whitened == 0) for r in out)


def test_deviation_beyond_a_long(spark):
    rows = [(1, [4e12, 1.0]), (2, [-4e12, 2.0]), (3, [0.0, 3.0])]
    out = whitening.whiten(frame(spark, rows), Scratch(spark)).collect()
    assert {r["deviation"] for r in out if r["vec_id"] != 3} == {None}


def test_empty(spark):
    none = frame(spark, [(1, None)])
    assert whitening.whiten(none, Scratch(spark)).collect() == []
    assert whitening.whiten(none.limit(0), Scratch(spark)).columns == [c.split()[0] for c in whitening.SCHEMA.split(", ")]
