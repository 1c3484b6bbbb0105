"""Exact top-k search (operator 5): no-random-access aggregation over sorted lists, with queries that pass by every shard of the rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessella.llm.shards import by_length, number_of_shards, pass_by

#: Rows whose lists are sorted together, and queries that read them together.
SHARD_ROWS = 4096
BLOCK_ROWS = 512
#: Share of the lists that is read first; every so many tiles so many queries try anew whether that is enough.
FIRST, AGAIN, TRIES = 1 / 16, 16, 16
#: Bytes of rows that a task holds, some four times that with their lists.
SHARD_BYTES = 32 << 20
#: Whole numbers below this are exact as doubles.
_EXACT = float(2**53)
_LOW, _HIGH = -(2**63), 2**63 - 1


class SortedLists:
    """Two ways to read each component's list of a shard: from its greatest entry down and from its least up.

    Rows are in the order of their ids. What a query has read is kept as a partial sum for every row: a query reads a list from the top where its
    weight is positive, else from the bottom.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray) -> None:
        by = np.argsort(ids, kind="stable")
        self.x, self.ids = x[by], ids[by]
        self.heads = np.flatnonzero(np.append(True, self.ids[1:] != self.ids[:-1]))
        self.order = np.argsort(self.x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.x, self.order, axis=0)
        self.rank = np.empty_like(self.order, dtype=np.int32)
        np.put_along_axis(self.rank, self.order, np.arange(len(x), dtype=np.int32)[:, None], axis=0)

    def read(self, sums: np.ndarray, up: np.ndarray, down: np.ndarray, start: int, stop: int, wanted: np.ndarray) -> None:
        """Adds the entries start..stop of all lists to the sums (row, query) of the rows that are still wanted."""
        n = len(self.x)
        for d in range(self.x.shape[1]):
            for rows, weights in ((self.order[n - stop : n - start, d], up[:, d]), (self.order[start:stop, d], down[:, d])):
                rows = rows[wanted[rows]]
                sums[rows] += self.x[rows, d][:, None] * weights[None, :]

    def read_all(self, up: np.ndarray, down: np.ndarray) -> np.ndarray:
        """The sums of all lists read to their ends."""
        return self.x @ (up + down).T

    def bounds(self, sums: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of every (row, query) after `depth` entries of each list.

        An unread component lies between the last one read and the other end of the list.
        """
        n = len(self.x)
        top, bottom = (self.rank < n - depth).astype(np.float64), (self.rank >= depth).astype(np.float64)
        least = sums + top @ (up * self.sorted[0]).T + bottom @ (down * self.sorted[-1]).T
        most = sums + top @ (up * self.sorted[n - depth]).T + bottom @ (down * self.sorted[depth - 1]).T
        return least, most


def no_random_access(lists: SortedLists, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int, first: float = FIRST):
    """Yields (query number, ids, scores, share of the lists read) of every row that can be among a query's k best ids; its own id is left out.

    All lists are read in step, the first time to the share `first`, then each time twice as far. A query stops when few rows are left whose greatest
    possible score reaches its floor, the k-th best least score of an id, here or in an earlier shard; their scores are then resolved from the components.
    """
    n = len(lists.x)
    active, wanted, depth = np.arange(len(queries)), np.ones(n, bool), 0
    sums = np.zeros((n, len(queries)))
    while len(active):
        step = min(n, max(1, 2 * depth or int(n * first)))
        up, down = np.maximum(queries[active], 0), np.minimum(queries[active], 0)
        if step == n and not depth:
            sums = lists.read_all(up, down)
        else:
            lists.read(sums, up, down, depth, step, wanted)
        depth = step
        # at the lists' ends scores are known
        least, most = lists.bounds(sums, up, down, depth) if depth < n else (sums.copy(), sums)
        own = lists.ids[:, None] == query_ids[active][None, :]
        least[own | ~wanted[:, None]] = -np.inf
        best = np.maximum.reduceat(least, lists.heads, axis=0)
        kth = np.partition(best, len(best) - k, axis=0)[len(best) - k] if len(best) >= k else np.full(len(active), -np.inf)
        floor[active] = np.maximum(floor[active], kth)
        open_ = (most >= floor[active][None, :]) & ~own & wanted[:, None]
        done = (open_.sum(axis=0) <= 4 * k) | (depth == n)
        for i in np.flatnonzero(done):
            rows = np.flatnonzero(open_[:, i])
            yield int(active[i]), lists.ids[rows], lists.x[rows] @ queries[active[i]], depth / n
        active, sums = active[~done], sums[:, ~done]
        wanted &= open_[:, ~done].any(axis=1)


class Best:
    """The k best ids of each query so far, ties to the smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.ids = [np.zeros(0, np.int64)] * n
        self.scores = [np.zeros(0, np.int64)] * n
        self.floor = np.full(n, -np.inf)

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[q], ids]), np.concatenate([self.scores[q], scores])
        # the complement turns the order without overflow
        by = np.lexsort((~scores, ids))
        by = by[np.append(True, ids[by][1:] != ids[by][:-1])[: len(by)]]
        ids, scores = ids[by], scores[by]
        by = np.lexsort((ids, ~scores))[: self.k]
        self.ids[q], self.scores[q] = ids[by], scores[by]
        if len(by) == self.k:
            self.floor[q] = float(self.scores[q][-1])


class Held:
    """The rows of a shard by the length of their vectors, in parts of SHARD_ROWS, each with its sorted lists; rows beyond exact doubles stand apart."""

    def __init__(self, scale: int) -> None:
        self.scale, self.share, self.tiles = scale, FIRST, 0
        self.rows: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.parts: dict[int, tuple[list[SortedLists], np.ndarray, list]] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        for n, part, x in by_length(batch, self.scale):
            self.rows.setdefault(n, []).append((part["id"].to_numpy(), x))

    def turns(self, asked: np.ndarray):
        """Queries that read a tile together, and how far at once: as far as most queries before needed, since a look at the bounds costs as much as several
        products, but for a few that try anew now and then."""
        cut = TRIES if self.tiles % AGAIN == 0 else 0
        self.tiles += 1
        for some, first in ((asked[:cut], FIRST), (asked[cut:], None)):
            if len(some):
                yield some, self.share if first is None else first

    def sorted(self, n: int) -> tuple[list[SortedLists], np.ndarray, list]:
        """Lists of the plain rows, and ids and whole components of the others."""
        if n in self.rows:
            ids, x = (np.concatenate(c) for c in zip(*self.rows.pop(n)))
            plain = np.abs(x).max(axis=1) <= _plain(n)
            at, far = np.flatnonzero(plain), np.flatnonzero(~plain)
            self.parts[n] = [SortedLists(x[p], ids[p]) for p in (at[a : a + SHARD_ROWS] for a in range(0, len(at), SHARD_ROWS))], ids[far], [[int(v) for v in x[i]] for i in far]
        return self.parts.get(n, ([], np.zeros(0, np.int64), []))


def _plain(n: int) -> float:
    """Whole numbers up to this have inner products of n of them that are exact as doubles."""
    return (_EXACT / n) ** 0.5


def _best(held: Held, ids: np.ndarray, queries: np.ndarray, k: int) -> Best:
    """The k best ids of a shard for each query."""
    best, (parts, far_ids, far) = Best(len(ids), k), held.sorted(queries.shape[1])
    asked = np.abs(queries).max(axis=1) <= _plain(queries.shape[1])
    at = np.flatnonzero(asked)
    for lists in parts:
        for some, first in held.turns(at):
            read, floor = [], best.floor[some]
            for i, found, scores, share in no_random_access(lists, queries[some], ids[some], floor, k, first):
                best.add(int(some[i]), found, scores.astype(np.int64))
                read.append(share)
            held.share = float(np.median(read))
    # beyond exact doubles, pairs are scored as whole numbers of any size
    for i in range(len(ids)):
        others = list(zip(far_ids.tolist(), far))
        if not asked[i]:
            others += [(int(j), [int(v) for v in x]) for lists in parts for j, x in zip(lists.ids, lists.x)]
        q = [int(v) for v in queries[i]] if others else []
        found = [(j, min(_HIGH, max(_LOW, sum(a * b for a, b in zip(q, x))))) for j, x in others if j != ids[i]]
        if found:
            best.add(i, np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64))
    return best


def exact_topk(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, query_every: int = 100, scale: int = 1024, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """For every query its k rows of the highest integer inner product: query_id, rank, vec_id, score.

    Components become floor(scale * x). Queries are the rows whose id is divisible by query_every, candidates all other rows. Vectors that
    are null, or hold null or non-finite components, and rows without an id take no part; vectors of different lengths are
    only compared with their like. Ties go to the smaller id. Of rows that repeat an id the best score counts, for queries and candidates alike, so an id is
    returned once to a query and repeated rows take no place from others. A score outside 64 bits counts as the nearest number inside. An empty table
    gives no rows; other columns are ignored. A vector has to fit in a task, however long.

    Rows lie in shards of bounded bytes, and queries pass by them in batches (see `shards`): neither goes through the driver. A shard's lists are sorted
    once, some thousand rows at a time, and a query's k-th best score so far cuts what it reads of the next ones. The k best ids a query and
    shard are all that tasks send, and a ranking that cuts before its shuffle merges them.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ready = vectors.filter(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("x")).distinct()
    shards = number_of_shards(ready, F.size("x") * 8 + 8, shard_bytes)

    def ask(held: Held, batch: pa.RecordBatch):
        for _, part, x in by_length(batch, scale):
            for at in range(0, len(part), BLOCK_ROWS):
                ids = part["id"].to_numpy()[at : at + BLOCK_ROWS]
                best = _best(held, ids, x[at : at + BLOCK_ROWS], k)
                owner = np.repeat(ids, [len(b) for b in best.ids])
                yield pa.RecordBatch.from_pydict({"query_id": owner, "vec_id": np.concatenate([np.zeros(0, np.int64), *best.ids]), "score": np.concatenate([np.zeros(0, np.int64), *best.scores])})

    found = pass_by(ready, ready.filter(F.col("id") % query_every == 0), shards, "query_id long, vec_id long, score long", lambda: Held(scale), ask)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all others, ten best."""
    return exact_topk(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
