"""Quality classifier (operator 7): random-indexing word vectors, pooled per document, and a two-layer numpy network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import textscan as ts

#: Words share this many slots by hash, so the table of vectors has a fixed size (8 MB), whatever the corpus.
SLOTS = 1 << 15
DIMENSIONS = 48
#: Entries of an index vector that aren't zero.
ENTRIES = 4
#: Blocks of slots that are summed apart, and how many tables of a block are added at once.
BLOCKS = 16
FAN = 32
#: The network is fitted on a sample of at most about this many labelled rows; all else covers all documents.
SAMPLE_ROWS = 20_000

_UPPER, _LOWER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = True, True, True
_MARK = np.ones(256, bool)
_MARK[65:91] = _MARK[97:123] = _MARK[48:58] = _MARK[128:] = False
_MARK[ts.SPACE] = False


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Sparse random vectors, one for each slot: the places of their few entries, and the signs of these."""
    random = np.random.default_rng(7)
    at = random.random((SLOTS, DIMENSIONS)).argsort(axis=1)[:, :ENTRIES]
    return at.astype(np.int32), random.choice(np.array([-1, 1], np.float64), (SLOTS, ENTRIES))


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the terms of every row, two for each word, and the first term of each row.

    A word gives its letters, and its shape: capitals, digits, the marks behind it, its length, and whether the word repeats the one
    before. The shapes make a word that was never seen before known by its kind.
    """
    starts, ends, rows = ts.word_spans(data, offsets, ~ts.SPACE)
    if not len(starts):
        return np.zeros(0, np.int64), rows * 2
    hashes = ts.word_hashes(ts.LOWER[data], starts, ends)
    count = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask[data], dtype=np.int64)))[np.stack([starts, ends])], axis=0)[0]
    size = ends - starts
    upper, digit, mark = count(_UPPER), count(_DIGIT), count(_MARK)
    again = np.zeros(len(starts), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    first = rows[:-1][rows[:-1] < len(starts)]
    again[first] = False
    last = data[ends - 1].astype(np.uint64) * (mark > 0).astype(np.uint64)
    shape = np.zeros(len(starts), np.uint64)
    for part, most in ((np.minimum(upper, 2), 3), (np.minimum(digit, 2), 3), (np.minimum(mark, 4), 5), (mark == size, 2), (again, 2), (np.minimum(size // 4, 7), 8)):
        shape = shape * np.uint64(most) + part.astype(np.uint64)
    shape = ts.mix(shape * np.uint64(256) + last + np.uint64(1 << 40))
    both = np.empty(2 * len(starts), np.uint64)
    both[0::2], both[1::2] = hashes, shape
    return (both >> np.uint64(64 - 15)).astype(np.int64), rows * 2


def _sums(slots: np.ndarray, rows: np.ndarray, index: tuple[np.ndarray, np.ndarray], total: np.ndarray) -> None:
    """Adds to every slot's vector the index vectors of the terms one, two and four places away in the same row."""
    n = len(slots)
    if not n:
        return
    places, signs = index
    row = np.repeat(np.arange(len(rows) - 1, dtype=np.int32), np.diff(rows))
    slots = slots.astype(np.int32)
    for step in (1, 2, 4):
        if n <= step:
            continue
        same = row[step:] == row[:-step]
        left, right = slots[:-step][same], slots[step:][same]
        for to, of in ((left, right), (right, left)):
            at = (to * np.int32(DIMENSIONS))[:, None] + places[of]
            total += np.bincount(at.ravel(), weights=signs[of].ravel(), minlength=total.size)


def _adder(kind: type):
    """The sum of a group's tables of a whole-number type, as 64-bit numbers: exact, so the order of rows doesn't matter."""

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(SLOTS // BLOCKS * DIMENSIONS, np.int64)
        for b in table["sums"]:
            total += np.frombuffer(b.as_buffer(), kind)
        return pa.table([table["block"][:1], table["leaf"][:1], pa.array([total.tobytes()], pa.binary())], names=["block", "leaf", "sums"])

    return added


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The word vectors of the corpus: for every slot the sum of the index vectors around it, over all documents, to unit length.

    Each task sums its own documents into a table of fixed size, as 32-bit numbers, and starts another where one could overflow. The tables' blocks are added in
    Spark in a tree that takes FAN tables of a block at a time until one is left, however many tasks there are. The sum, SLOTS x DIMENSIONS numbers whatever
    the input, comes to the driver.
    """
    step = SLOTS // BLOCKS
    source = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        index = index_vectors()
        total, terms = np.zeros(SLOTS * DIMENSIONS), 0
        leaf = TaskContext.get().partitionId() // FAN

        def table():
            return pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([leaf] * BLOCKS, pa.int32()), pa.array([part.tobytes() for part in np.split(total.astype(np.int32), BLOCKS)], pa.binary())], names=["block", "leaf", "sums"])

        for batch in batches:
            data, offsets = ts.text_bytes(batch["text"])
            for a, b in ts.chunks(offsets):
                slots, rows = _terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                # a term adds at most six to an entry
                if 6 * (terms + len(slots)) >= 2**31:
                    yield table()
                    total[:], terms = 0, 0
                _sums(slots, rows, index, total)
                terms += len(slots)
        yield table()
        ts.give_back()

    schema = "block int, leaf int, sums binary"
    tables, leaves = source.mapInArrow(run, schema), -(-source.rdd.getNumPartitions() // FAN)
    added = tables.groupBy("block", "leaf").applyInArrow(_adder(np.int32), schema)
    while leaves > 1:
        added = added.withColumn("leaf", F.expr(f"leaf div {FAN}").cast("int")).groupBy("block", "leaf").applyInArrow(_adder(np.int64), schema)
        leaves = -(-leaves // FAN)
    out = np.zeros((SLOTS, DIMENSIONS), np.float64)
    for r in added.groupBy("block").applyInArrow(_adder(np.int64), schema).collect():
        out[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(r["sums"], np.int64).reshape(step, DIMENSIONS)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)).astype(np.float32)


def _pooled(column, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of the terms of each row, words and shapes apart; zeros for a row without words."""
    data, offsets = ts.text_bytes(column)
    out = np.zeros((len(offsets) - 1, 2 * DIMENSIONS), np.float32)
    for a, b in ts.chunks(offsets):
        slots, rows = _terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        size = np.diff(rows) // 2
        there = np.flatnonzero(size)
        for k in (0, 1):
            if len(there):
                out[a + there, k * DIMENSIONS : (k + 1) * DIMENSIONS] = np.add.reduceat(vectors[slots[k::2]], rows[:-1][there] // 2, axis=0) / size[there, None]
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of 2 * DIMENSIONS numbers as the rows of a matrix, without an object for each number."""
    return np.concatenate([np.zeros(0), *[c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]]).reshape(-1, 2 * DIMENSIONS)


class Network:
    """One hidden layer of rectified units and a logistic output, fitted by Adam; its temperature is set on rows it did not fit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 300, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        self.mean, self.scale, self.temperature, self.prior = x.mean(0) if len(x) else 0.0, x.std(0) + 1e-3 if len(x) else 1.0, 1.0, 0.5
        self.weights = None
        if len(set(y.tolist())) < 2:
            self.prior = float(y[0]) if len(y) else 0.5
            return
        x = (x - self.mean) / self.scale
        fit = random.random(len(x)) < 0.85
        if len(set(y[fit].tolist())) < 2 or (~fit).sum() < 2:
            fit[:] = True
        d = x.shape[1]
        w = [random.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), random.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        xs, ys = x[fit], y[fit].astype(float)
        step = 0
        for _ in range(max(10, min(epochs, 6_000_000 // (len(xs) + 1)))):
            order = random.permutation(len(xs))
            for k in range(0, len(xs), 256):
                at = order[k : k + 256]
                step += 1
                h = np.maximum(xs[at] @ w[0] + w[1], 0)
                p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -40, 40)))
                g = (p - ys[at]) / len(at)
                back = np.outer(g, w[2]) * (h > 0)
                grads = [xs[at].T @ back + 1e-3 * w[0], back.sum(0), h.T @ g + 1e-3 * w[2], g.sum(keepdims=True)]
                for i, q in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * q
                    v[i] = 0.999 * v[i] + 0.001 * q * q
                    w[i] -= 2e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = w
        held = ~fit if (~fit).any() else fit
        z, t = self._logits(x[held]), y[held]
        temperatures = np.geomspace(1, 16, 60)
        self.temperature = float(min(temperatures, key=lambda c: np.mean(np.logaddexp(0, np.where(t == 1, -z, z) / c))))

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logits((x - self.mean) / self.scale) / self.temperature, -40, 40)))


def held_out(id_col: str):
    """The rows that no label is learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, and the network from a sample of the labelled rows that are not held out.

    The sample is bounded by sample_rows: the rows of the least hash of the id, of equal hashes the least id. Null labels and null texts are not learned from; a document with
    several labels, or a repeated row, gives a row for each, and the network starts from a fixed seed and sees the rows in an order of their own, so the same tables give the same fit. Without labels of both classes every score is the share of the one class there is, or 0.5.
    """
    vectors = word_vectors(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("y")).filter(~held_out("id"))
    chosen = known.orderBy(F.xxhash64("id"), "id", "y").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull()).join(chosen, "id").select("y", "text")

    def run(batches):
        for batch in batches:
            pooled = _pooled(batch["text"], shared.value)
            yield pa.RecordBatch.from_arrays([batch["y"], pa.array(list(pooled), pa.list_(pa.float32()))], names=["y", "x"])

    table = rows.mapInArrow(run, "y int, x array<float>").toArrow()
    shared.destroy()
    x, y = _matrix(table["x"]), table["y"].to_numpy()
    del table
    order = np.lexsort((y, *x.T[::-1]))  # the same fit in whatever order the rows arrive
    network = Network(x[order], y[order])
    del x, y, order
    ts.give_back()  # the driver stays on, too
    return vectors, network


def score(docs: DataFrame, model: tuple[np.ndarray, Network], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row struct of the kept columns, score 0 to 1) for every row, repeated ones included; the text alone decides. Null and empty texts have the zero vector.

    An empty table gives no rows; a long text costs a task some fifty times its size. Columns can't clash, as all are inside `row`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns if keep is None else keep

    # only the text goes to Python and only the score comes back: the rows, which hold the text as well, wait in Spark.
    # a filter on the score would be pushed below and have it computed twice, so Spark may not move it
    @F.arrow_udf("double")
    def likely(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vectors, network = shared.value
        for text in texts:
            yield pa.array(network.score(_pooled(text, vectors).astype(np.float64)), pa.float64())
        ts.give_back()

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), likely.asNondeterministic()(text).alias("score"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """A score for every document, from labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), keep=["doc_id"])
    return scored.select(F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def brute_vectors(texts: list[str]) -> np.ndarray:
    """word_vectors with plain loops, for small fixtures."""
    at, sign = index_vectors()
    out = np.zeros((SLOTS, DIMENSIONS))
    for text in texts:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        slots = _terms(raw, np.array([0, len(raw)]))[0].tolist()
        for i, slot in enumerate(slots):
            for j in (i - 4, i - 2, i - 1, i + 1, i + 2, i + 4):
                if 0 <= j < len(slots):
                    for place, value in zip(at[slots[j]], sign[slots[j]]):
                        out[slot][place] += value
    return np.array([v / max(float(np.sqrt((v * v).sum())), 1e-6) for v in out])
