"""Scores against a plain dictionary model, and the properties of a probability."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm import language_model as lm
from martloom.llm.runtime import Scratch, map_batches

KIND = "doc_id bigint, text string, score string, held_out string, row int"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*lowered.encode().split(), b""]


def model(rows, prior):
    """(words, distinct, counts, root, step): step is the probability of a word after another."""
    count, context, pair = Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            before = None
            for word in tokens(text):
                count[word] += 1
                context[before] += 1
                pair[before, word] += 1
                before = word
    total, distinct = sum(count.values()), len(count)
    root = lambda w: (count[w] + 0.5) / (total + 0.5 * (distinct + 1))
    step = lambda v, w: (pair[v, w] + prior * root(w)) / (context[v] + prior)
    return total, count, root, step


def expected(rows, prior):
    total, count, root, step = model(rows, prior)
    out = []
    for doc_id, text in rows:
        words = tokens(text)
        score = sum(math.log10(step(v, w)) for v, w in zip([None, *words], words))
        base = sum(math.log10(root(w)) for w in words)
        out.append((doc_id, held_out(doc_id), len(words), sum(count[w] > 0 for w in words), total, base, score))
    return out


def agree(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    found, wanted = sorted((tuple(r) for r in found), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in wanted], rtol=1e-9)


def is_held():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(3)
    say = lambda n: " ".join(r.choice("the of a Cat dog SAT on mat and é ran".split()) for _ in range(n))
    texts = [None, "", " \n\t", "one", "ONE two three", say(2000), "the " * 1500, "x" * 40_000]
    texts += [say(r.randint(1, 60)) + f" w{r.randrange(30)}" for _ in range(120)]
    rows = list(enumerate(texts))
    return rows + rows[20:30] + [(None, "the cat"), (None, None)]


@pytest.mark.parametrize("block, bucket", [(lm.BLOCK, lm.BUCKET), (50, 300), (7, 40)])
def test_against_a_dictionary(spark, corpus, block, bucket):
    """One block, and texts that are cut over several blocks with many buckets."""
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in corpus], KIND).repartition(3)
    out = lm.score(df, Scratch(spark), is_held(), 2.5, block=block, bucket=bucket)
    assert out.columns == COLUMNS
    agree(out.collect(), expected(corpus, 2.5))


def test_probabilities_add_up_to_one(corpus):
    total, count, root, step = model(corpus, 2.5)
    for before in [None, b"the", b"cat", b"never seen"]:
        assert sum(step(before, w) for w in [*count, b"unknown"]) == pytest.approx(1)


def test_supplied_documents(spark):
    """The query, and that pairs tell more of held-out texts than words."""
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    found = lm.op12_lm_scoring(spark, path).collect()
    agree(found, expected(rows, lm.PRIOR))
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if held_out(i))
    df = spark.createDataFrame([(held, "a b", "", "", 1)], KIND)
    row = lm.score(df, Scratch(spark), is_held()).first()
    assert (row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (0, 0, 0.0, 0.0)
    assert lm.score(df.limit(0), Scratch(spark), is_held()).collect() == []


def test_packing():
    values = np.array([0, 1, 5, 2**63, 2**64 - 1], np.uint64)
    assert (lm.unpack_sorted(lm.pack_sorted(values)) == values).all()
    assert (lm.bucket_of(values, 7) == [0, 0, 0, 3, 6]).all()


def test_words_are_forgotten(monkeypatch):
    """A worker holds a bounded number of words while it cuts blocks, and none afterwards."""
    monkeypatch.setattr(lm, "_KEEP", 1000)
    most = []
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20), pa.int64())] * 2 + [pa.array([False] * 20), pa.array([t.encode() for t in texts], pa.binary())],
        names=["row", "id", "held", "text"])
    blocks = [b for b in lm._cut(iter([batch]), 0, 500) if most.append(len(lm._hashes)) is None]
    assert sum(sum(b.column("sizes")[0].as_py()) for b in blocks) == 20 * 401
    assert max(most) < 1000 + 402 and not lm._hashes


def test_blocks_go_through_one_by_one(spark):
    df = spark.range(10).coalesce(1)
    sizes = lambda **o: [r[0] for r in map_batches(df, lambda b: pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]), "n bigint", **o).collect()]
    assert (sizes(), sizes(rows=1), sizes(rows=4)) == ([10], [1] * 10, [4, 4, 2])
