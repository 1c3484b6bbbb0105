"""Hard-negative mining (operator 13): Strassen products of anchor and candidate tiles, mergeable heaps of positives and of score windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.shards import SHARD_BYTES, by_length, number_of_shards, pass_by

#: Rows of a tile: anchors by candidates.
TILE = (512, 4096)
#: Strassen's recursion ends where a side is this short.
LEAF = 32
_LOW, _HIGH = -(2**63), 2**63 - 1


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b by seven products of halves a level; odd sides are padded with zeros.

    Sums wrap modulo 2**64 for int64, which a ring's products don't mind: the result is exact wherever it fits. Object arrays hold whole numbers of any size.
    """
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= LEAF:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, d % 2)))
    b = np.pad(b, ((0, d % 2), (0, n % 2)))
    h, k, w = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :k], a[:h, k:], a[h:, :k], a[h:, k:]
    b11, b12, b21, b22 = b[:k, :w], b[:k, w:], b[k:, :w], b[k:, w:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * h, 2 * w), p1.dtype)
    out[:h, :w] = p1 + p4 - p5 + p7
    out[:h, w:] = p3 + p5
    out[h:, :w] = p2 + p4
    out[h:, w:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of whole doubles, as int64; beyond 64 bits the nearest number inside."""
    far = lambda x: int(np.abs(x).max(initial=0))
    if far(a) * far(c) * a.shape[1] <= _HIGH and max(far(a), far(c)) <= _HIGH >> 1:
        return strassen(a.astype(np.int64), np.ascontiguousarray(c.T).astype(np.int64))
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(strassen(whole(a), whole(c.T)), _LOW, _HIGH).astype(np.int64)


def _leading(slot: np.ndarray, k: int) -> np.ndarray:
    """Marks the first k entries of every run of equal slots."""
    at = np.arange(len(slot))
    start = np.maximum.accumulate(np.where(np.append(True, slot[1:] != slot[:-1])[: len(slot)], at, 0))
    return at - start < k


class Heaps:
    """The k best (score, then smaller id) of each slot: kept flat by slot, so that two of them merge by one sort."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.n = k, n
        self.slot, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> np.ndarray:
        """The least score that still counts for each slot: the worst of a full heap."""
        out = np.full(self.n, _LOW)
        full = np.bincount(self.slot, minlength=self.n) == self.k
        last = np.flatnonzero(np.append(self.slot[1:] != self.slot[:-1], True)[: len(self.slot)])
        out[self.slot[last]] = self.scores[last]
        out[~full] = _LOW
        return out

    def merge(self, slot: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
        slot, ids, found = np.append(self.slot, slot), np.append(self.ids, ids), np.append(self.scores, found)
        # the complement turns the order without overflow
        by = np.lexsort((ids, ~found, slot))
        by = by[_leading(slot[by], self.k)]
        self.slot, self.ids, self.scores = slot[by], ids[by], found[by]

    def add(self, slots: np.ndarray, ids: np.ndarray, tile: np.ndarray, fit: np.ndarray) -> None:
        """Takes in the entries of a tile (slot by candidate) that fit."""
        fit = fit & (tile >= self.floor()[slots][:, None])
        if tile.shape[1] > self.k:
            kth = np.partition(np.where(fit, tile, _LOW), tile.shape[1] - self.k, axis=1)[:, tile.shape[1] - self.k]
            fit &= tile >= kth[:, None]
        r, c = np.nonzero(fit)
        self.merge(slots[r], ids[c], tile[r, c])


class Candidates:
    """The candidates of a shard by the length of their vectors: ids, label codes and whole components."""

    def __init__(self) -> None:
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.codes: dict[str, int] = {}

    def add(self, rows: pa.RecordBatch) -> None:
        for n, part, x in by_length(rows):
            labels = np.array([self.codes.setdefault(v, len(self.codes)) for v in part["label"].to_pylist()], np.int64)
            self.parts.setdefault(n, []).append((part["id"].to_numpy(), labels, x))

    def tiles(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if len(self.parts.get(n, ())) > 1:
            self.parts[n] = [tuple(np.concatenate(c) for c in zip(*self.parts[n]))]
        for ids, labels, x in self.parts.get(n, ()):
            for at in range(0, len(ids), TILE[1]):
                end = at + TILE[1]
                yield ids[at:end], labels[at:end], x[at:end]


Found = dict[str, np.ndarray]


def _positives(anchors: pa.RecordBatch, x: np.ndarray, codes: np.ndarray, tiles: Iterator, k: int) -> Found:
    own, heaps = anchors["id"].to_numpy(), Heaps(len(anchors), k)
    for ids, labels, c in tiles:
        heaps.add(np.arange(len(own)), ids, scores(x, c), (labels[None, :] == codes[:, None]) & (ids[None, :] != own[:, None]))
    return {"anchor_id": own[heaps.slot], "positive_id": heaps.ids, "positive_score": heaps.scores}


def _negatives(anchors: pa.RecordBatch, x: np.ndarray, codes: np.ndarray, tiles: Iterator, k: int, low: int, high: int) -> Found:
    """One heap for each window: an anchor with one of its positives."""
    offsets, windows = anchors["positives"].offsets.to_numpy(), anchors["positives"].flatten()
    offsets, row = offsets - offsets[0], np.repeat(np.arange(len(anchors)), np.diff(offsets))
    positive, reached = windows.field("id").to_numpy(), windows.field("score").to_numpy()
    inside = lambda v: min(_HIGH, max(_LOW, v))
    least = np.array([inside(-(-low * int(p) // 100)) for p in reached], np.int64)
    most = np.array([inside(high * int(p) // 100) for p in reached], np.int64)
    heaps = Heaps(len(row), k)
    deep = int(np.diff(offsets).max(initial=0))
    for ids, labels, c in tiles:
        tile, other = scores(x, c), labels[None, :] != codes[:, None]
        for j in range(deep):
            slots = offsets[:-1][np.diff(offsets) > j] + j
            at = row[slots]
            heaps.add(slots, ids, tile[at], other[at] & (tile[at] >= least[slots][:, None]) & (tile[at] <= most[slots][:, None]))
    s = heaps.slot
    return {"anchor_id": anchors["id"].to_numpy()[row[s]], "positive_id": positive[s], "positive_score": reached[s], "negative_id": heaps.ids, "negative_score": heaps.scores}


def _pass(candidates: DataFrame, anchors: DataFrame, shards: int, schema: str, find: Callable[..., Found]) -> DataFrame:
    """What `find` gives for every batch of anchors with every shard of candidates."""

    def ask(held: Candidates, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for n, some, x in by_length(part):
            for at in range(0, len(some), TILE[0]):
                here = some.slice(at, TILE[0])
                codes = np.array([held.codes.get(v, -1) for v in here["label"].to_pylist()], np.int64)
                yield pa.RecordBatch.from_pydict(find(here, x[at : at + TILE[0]], codes, held.tiles(n)))

    return pass_by(candidates, anchors, shards, schema, Candidates, ask)


def mine_hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor_every: int = 100,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its best rows of the same label, the best rows
    of other labels whose score is from low to high per cent of the positive's.

    Anchors are rows whose id is divisible by anchor_every. Components become floor(scale * x), scores are integer inner products, ties go to the smaller
    id. Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part; vectors meet only those of their length. Of
    rows that repeat an id the one with the least label and vector stands. A score outside 64 bits counts as the nearest number inside. An anchor without
    positives, or a positive with an empty window, gives no rows, and neither does an empty table. Other columns are ignored. A vector has to fit in a task.

    Two passes over the candidates: the first fills a heap of positives for each anchor, the second a heap for each window that these open. Every task sends the
    heaps of its shard only, and a ranking that cuts before its shuffle merges them (see `shards`).
    """
    x, label = F.col(f"`{vector_col}`").cast("array<double>"), F.col(f"`{label_col}`").cast("string")
    good = F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ready = vectors.filter(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(label.alias("label"), x.alias("x")).alias("row"))
    # floor() of a double is a long in SQL, so whole numbers are taken in the tasks
    one = ready.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", F.transform("row.x", lambda v: v * scale).alias("x"))
    return _mined(one, anchor_every, positives, negatives, low, high, shard_bytes)


def _mined(one: DataFrame, anchor_every: int, positives: int, negatives: int, low: int, high: int, shard_bytes: int) -> DataFrame:
    shards = number_of_shards(one, F.size("x") * 8 + 64, shard_bytes)
    anchors = one.filter(F.col("id") % anchor_every == 0)
    pairs = _pass(one, anchors, shards, "anchor_id long, positive_id long, positive_score long", lambda a, x, codes, tiles: _positives(a, x, codes, tiles, positives))
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = pairs.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= positives)
    lists = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _pass(one, anchors.join(lists, "id"), shards, schema, lambda a, x, codes, tiles: _negatives(a, x, codes, tiles, negatives, low, high))
    by = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector as an anchor among all, with the labels of every seventh row moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))


SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.id % 100 = 0 AND c.id <> a.id AND len(a.x) = len(c.x)
), p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5
"""
