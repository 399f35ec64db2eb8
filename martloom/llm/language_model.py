"""Language-model scores: a weighted automaton of word pairs with failure arcs, learnt from the corpus itself.

Each word is a state, reached when it was the last word; the state before the first word, and a root with no memory, are two
more. A pair of words seen in training is an arc of the first word's state with the log-probability

    p(w | v) = (count(v w) + m p(w)) / (count(v) + m),    p(w) = (count(w) + 0.5) / (words + 0.5 (distinct + 1)),

the second under the Dirichlet prior of the root with m as its weight. A state without an arc for the next word takes its failure arc, of weight
m / (count(v) + m), to the root, which has an arc for each word and one for all unknown ones. The weights of a state so
add up to one. A text is scored in one pass from left to right that carries the state.

The automaton of a large corpus fits no machine, and a block of texts needs few of its arcs. So texts are cut into blocks
of a bounded number of words. Each block sends the hashes of its words and pairs with its own counts to the
buckets of the key space, a bucket adds up what it gets and answers each block, and with the answers the block has that
part of the automaton that its texts can reach. A key costs a block one entry however often it occurs there, so
frequent words make no bucket large. What is sent grows with the corpus; nothing is broadcast but three numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.llm.runtime import Scratch, map_batches, ship
from martloom.llm.words import _KEEP, _hashes, mix, split

#: Words of a block; a longer text is cut, and its parts pass the last word on.
BLOCK = 1 << 18
#: Words of the corpus for one bucket of the key space; it gets at most as many keys.
BUCKET = 1 << 20
#: Blocks or answers in one Arrow batch; they are some MB each.
ROWS = 4
#: Weight of the root in the prior of a state.
PRIOR = 32.0

_U = np.uint64
#: No word is empty or holds white space.
END, BEGIN = b"", b" "
WORD, PAIR = 0, 1

BLOCKS = (
    "block bigint, rows array<bigint>, ids array<bigint>, held array<boolean>, parts array<int>, sizes array<int>, "
    "first array<int>, vocabulary binary, codes binary"
)
PART = "row bigint, doc_id bigint, held_out boolean, part int, n_tokens bigint, n_known bigint, base_score double, score double"


def pack(values: np.ndarray) -> bytes:
    """Integers as bytes, like ones of all values together, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.compress(raw.T.tobytes(), 3)


def unpack(packed: bytes, kind: np.dtype | type) -> np.ndarray:
    kind = np.dtype(kind)
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=_U(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, _U), dtype=_U)


class Cut:
    """Texts of a task, gathered into blocks."""

    def __init__(self, partition: int, most: int):
        self.number = partition << 33
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.about: list[tuple] = []
        self.words: list[np.ndarray] = []
        self.size = 0

    def add(self, row: int, doc_id: int | None, held: bool, text: bytes | None) -> Iterator[tuple]:
        words = split(text, lower=True)
        hashes = np.fromiter(map(_hashes.__getitem__, words), _U, len(words))
        hashes = np.concatenate([hashes, np.array([_hashes[END]], _U)])
        last = _hashes[BEGIN]
        for part, start in enumerate(range(0, len(hashes), self.most)):
            piece = hashes[start : start + self.most]
            self.about.append((row, doc_id, held, part, len(piece)))
            self.words += [np.array([last], _U), piece]
            last = int(piece[-1])
            self.size += len(piece)
            if self.size >= self.most:
                yield self.done()

    def done(self) -> tuple:
        """The block as a row of BLOCKS; each part's words follow the word before it."""
        vocabulary, codes = np.unique(np.concatenate(self.words), return_inverse=True)
        rows, ids, held, parts, sizes = map(list, zip(*self.about))
        first = (np.cumsum([0, *[s + 1 for s in sizes[:-1]]])).tolist()
        out = (self.number, rows, ids, held, parts, sizes, first, pack_sorted(vocabulary), pack(codes.astype(np.uint32)))
        self.number += 1
        self.clear()
        return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in ddl.split(", "))])


def blocks_of(documents: DataFrame, held_out: Column, id_column: str, text_column: str, most: int) -> DataFrame:
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_column).cast("binary").alias("text"),
    )
    ship(documents.sparkSession)

    return rows.mapInArrow(lambda batches: _cut(batches, TaskContext.get().partitionId(), most), BLOCKS)


def _cut(batches: Iterator[pa.RecordBatch], partition: int, most: int) -> Iterator[pa.RecordBatch]:
    """The texts of a task as blocks. The words met are forgotten in time, and at the end, as the worker lives on."""
    cut, schema = Cut(partition, most), _schema(BLOCKS)
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            for block in cut.add(*row):
                yield _batch([block], schema)
            if len(_hashes) > _KEEP:
                _hashes.clear()
    if cut.size:
        yield _batch([cut.done()], schema)
    _hashes.clear()


class Block:
    """A block's words and pairs by their places in it."""

    def __init__(self, row: dict):
        self.rows, self.ids, self.held, self.parts = row["rows"], row["ids"], row["held"], row["parts"]
        self.vocabulary = unpack_sorted(row["vocabulary"])
        codes = unpack(row["codes"], np.uint32).astype(np.int64)
        self.first = np.array(row["first"], np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        begins = np.zeros(len(codes), bool)
        begins[self.first] = True
        place = np.flatnonzero(~begins)
        self.words, self.before = codes[place], codes[place - 1]
        self.trained = np.repeat(~np.array(self.held, bool), self.sizes)
        # a pair by one number for this block, and the key that it has everywhere
        pairs, self.pair_of = np.unique(self.before * len(self.vocabulary) + self.words, return_inverse=True)
        v, w = np.divmod(pairs, len(self.vocabulary))
        keys = mix(mix(self.vocabulary[v]) * _U(3) + self.vocabulary[w])
        self.order = np.argsort(keys)
        self.pairs, self.keys = pairs, keys

    def questions(self) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """For words and for pairs: the sorted keys and the block's counts in training, for words also as contexts."""
        n = len(self.vocabulary)
        counts = np.bincount(self.words[self.trained], minlength=n)
        yield WORD, self.vocabulary, [counts, np.bincount(self.before[self.trained], minlength=n)]
        counts = np.bincount(self.pair_of[self.trained], minlength=len(self.pairs))
        yield PAIR, self.keys[self.order], [counts[self.order]]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the key space; sorted keys have sorted buckets."""
    return ((keys >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _questions(blocks: DataFrame, buckets: int) -> DataFrame:
    schema = _schema("block bigint, kind int, bucket int, keys binary, counts binary")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in batch.to_pylist():
            for kind, keys, counts in Block(row).questions():
                numbers, starts = np.unique(bucket_of(keys, buckets), return_index=True)
                for number, a, b in zip(numbers.tolist(), starts, [*starts[1:], len(keys)]):
                    own = np.concatenate([c[a:b] for c in counts]).astype(np.uint32)
                    out.append((row["block"], kind, number, pack_sorted(keys[a:b]), pack(own)))
        return _batch(out, schema)

    return map_batches(blocks, run, "block bigint, kind int, bucket int, keys binary, counts binary", rows=1)


ANSWERS = "block bigint, kind int, bucket int, counts binary, tokens bigint, known bigint"


def _answer(group: pa.Table) -> pa.Table:
    """Sums over all blocks for the keys of one bucket, in the order in which each block asked."""
    keys = [unpack_sorted(k) for k in group.column("keys").to_pylist()]
    kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
    values = 2 if kind == WORD else 1
    counts = [unpack(c, np.uint32).reshape(values, -1) for c in group.column("counts").to_pylist()]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    # sums in doubles are exact up to 2**53
    sums = [np.bincount(place, weights=np.concatenate([c[v] for c in counts]), minlength=len(distinct)).astype(np.int64) for v in range(values)]
    stops = np.cumsum([len(k) for k in keys])
    out = []
    for block, a, b in zip(group.column("block").to_pylist(), [0, *stops[:-1]], stops):
        out.append((block, kind, bucket, pack(np.concatenate([s[place[a:b]] for s in sums])), None, None))
    if kind == WORD:
        out.append((None, kind, bucket, None, int(sums[0].sum()), int((sums[0] > 0).sum())))
    return pa.Table.from_batches([_batch(out, _schema(ANSWERS))])


def _score(block: Block, answers: list[dict], tokens: int, known: int, prior: float) -> list[tuple]:
    """Rows of PART: the block's part of the automaton, and its texts through it."""
    size = len(block.vocabulary)
    word = [unpack(a["counts"], np.int64).reshape(2, -1) for a in answers if a["kind"] == WORD]
    count, context = np.concatenate(word, axis=1)
    pair = np.concatenate([unpack(a["counts"], np.int64) for a in answers if a["kind"] == PAIR])
    root = (count + 0.5) / (tokens + 0.5 * (known + 1))
    arc, fail = np.log10(root), np.log10(prior / (context + prior))
    # arcs of the other states, by state and word
    keys = block.pairs[block.order]
    seen = pair > 0
    v, w = np.divmod(keys[seen], size)
    weights = np.log10((pair[seen] + prior * root[w]) / (context[v] + prior))
    arcs = dict(zip(keys[seen].tolist(), weights.tolist()))
    arc_list, fail_list = arc.tolist(), fail.tolist()
    stops = np.cumsum(block.sizes)
    starts = stops - block.sizes
    out = []
    for i, (a, b) in enumerate(zip(starts.tolist(), stops.tolist())):
        words = block.words[a:b]
        state, total = int(block.before[a]), 0.0
        for w in words.tolist():
            weight = arcs.get(state * size + w)
            total += fail_list[state] + arc_list[w] if weight is None else weight
            state = w
        base = float(arc[words].sum())
        out.append((block.rows[i], block.ids[i], block.held[i], block.parts[i], b - a, int((count[words] > 0).sum()), base, total))
    return out


def score(
    documents: DataFrame, scratch: Scratch, held_out: Column, prior: float = PRIOR, id_column: str = "doc_id",
    text_column: str = "text", block: int = BLOCK, bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of ``documents``: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``held_out`` is a column that says which rows are not learnt from; null is no. Words are runs between ASCII
    white space with A-Z lowered, followed by one end; null and empty texts have the end alone. base_score is the log10
    probability by the words' own frequencies, score that of the automaton. Rows repeat as given and each is learnt
    from; a null id stays null, other columns do not matter. Words and pairs are told apart by 64-bit
    hashes. An empty table gives no rows; without rows to learn from every word is unknown and has probability one.
    """
    spark = documents.sparkSession
    blocks = scratch.keep(blocks_of(documents, held_out, id_column, text_column, block), "blocks")
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0
    buckets = max(1, -(-size // bucket))
    # few bytes are much work here, so Spark shall not gather buckets or blocks in few tasks
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = _questions(blocks, buckets).repartition(tasks, "kind", "bucket")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    answered = scratch.keep(asked.groupBy("kind", "bucket").applyInArrow(_answer, ANSWERS), "answers")
    totals = answered.filter("block is null").agg(F.sum("tokens"), F.sum("known")).first()
    tokens, known = totals[0] or 0, totals[1] or 0

    spread = answered.filter("block is not null").repartition(tasks, "block")
    told = spread.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("kind", "bucket", "counts"))).alias("answers"))
    joined = blocks.repartition(tasks, "block").join(told, "block")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in batch.to_pylist():
            out += _score(Block(row), row["answers"], tokens, known, prior)
        return _batch(out, _schema(PART))

    scored = map_batches(joined, run, PART, rows=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    parts = scratch.keep(scored, "parts")
    ship(spark)  # texts come in batches of the usual size again
    scratch.drop("blocks", "answers")
    total = lambda name: F.aggregate("p", F.lit(0.0), lambda a, x: a + x[name])
    texts = parts.groupBy("row").agg(
        F.first("doc_id").alias(id_column), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sort_array(F.collect_list(F.struct("part", "base_score", "score"))).alias("p"),
    )
    return texts.select(
        id_column, "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        total("base_score").alias("base_score"), total("score").alias("score"),
    )


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark), held_out)
