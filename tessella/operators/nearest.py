"""The nearest neighbour within a tolerance: both sides meet in cogrouped blocks, where one is sorted and searched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side of a block, and pairs that are looked at together inside one.
EDGE = 1024
PAIRS = 1 << 22


def block_of(c: str, edge: float) -> Column:
    return F.floor(F.col(c) / edge)


def blocks_near(c: str, edge: float, reach: float, first: int = 0) -> Column:
    """The blocks that hold a place within reach, in one dimension: one row each. Coordinates begin at `first`."""
    return F.explode(F.sequence(F.floor((F.col(c) - first - reach) / edge), F.floor((F.col(c) - first + reach) / edge)))


def _codes(left: pa.Table, right: pa.Table, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers that are equal where all columns are; -1 where one is null."""
    out = np.zeros(len(left) + len(right), np.int64)
    null = np.zeros(len(out), bool)
    for c in columns:
        both = pa.chunked_array([*left[c].chunks, *right[c].cast(left[c].type).chunks], left[c].type).combine_chunks()
        index = pa.array(both).dictionary_encode().indices
        null |= index.is_null().to_numpy(zero_copy_only=False)
        out = np.unique(out * (len(out) + 1) + index.fill_null(0).to_numpy(), return_inverse=True)[1]
    out[null] = -1
    return out[: len(left)], out[len(left) :]


def _numbers(table: pa.Table, c: str) -> np.ndarray:
    return table[c].cast(pa.float64()).to_numpy()


def pairs_of(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left row, place in the sorted right side) of all ranges low..high (a few a row), some million pairs at a time."""
    n = (high - low).sum(axis=1)
    ends = np.cumsum(n)
    start = 0
    while start < len(n):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
        a, b = low[start:stop].ravel(), high[start:stop].ravel()
        size = b - a
        row = np.repeat(np.repeat(np.arange(start, stop), low.shape[1]), size)
        yield row, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
        start = stop


def nearest_rows(left: pa.Table, right: pa.Table, within: list[str], tolerance: float, order: list[str], strict: bool) -> np.ndarray:
    """For each row of the left table the nearest of the right one with equal columns `within`, the first in `order` on a tie; -1 without one."""
    best = np.full(len(left), -1, np.int64)
    if not len(left) or not len(right):
        return best
    lk, rk = _codes(left, right, within)
    lx, ly, rx, ry = _numbers(left, "x"), _numbers(left, "y"), _numbers(right, "x"), _numbers(right, "y")
    first = right.append_column("__at", pa.array(np.arange(len(right)))).select([*order, "__at"]).sort_by([(c, "ascending") for c in order])["__at"].to_numpy()
    rank = np.empty(len(right), np.int64)
    rank[first] = np.arange(len(right))
    asks, there = np.flatnonzero((lk >= 0) & np.isfinite(lx) & np.isfinite(ly)), np.flatnonzero((rk >= 0) & np.isfinite(rx) & np.isfinite(ry))
    if not len(asks) or not len(there):
        return best
    x0, y0 = rx[there].min(), ry[there].min()
    cell = lambda v, v0: np.floor((v - v0) / tolerance).astype(np.int64) + 2
    # rows and columns of cells are padded by two, so that what lies beside the last one is in none
    wide, high_ = int(cell(rx[there].max(), x0)) + 3, int(cell(ry[there].max(), y0)) + 3
    place = lambda k, cy, cx: (k * high_ + cy) * wide + cx
    codes = place(rk[there], cell(ry[there], y0), cell(rx[there], x0))
    by = np.argsort(codes, kind="stable")
    codes, there = codes[by], there[by]
    cx, cy = np.clip(cell(lx[asks], x0), 0, wide - 1), np.clip(cell(ly[asks], y0), 0, high_ - 1)
    rows = [place(lk[asks], np.clip(cy + d, 0, high_ - 1), 0) for d in (-1, 0, 1)]
    low = np.stack([np.searchsorted(codes, r + np.maximum(cx - 1, 0)) for r in rows], axis=1)
    high = np.stack([np.searchsorted(codes, r + np.minimum(cx + 1, wide - 1), "right") for r in rows], axis=1)
    for row, at in pairs_of(low, high):
        i, j = asks[row], there[at]
        d2 = (lx[i] - rx[j]) ** 2 + (ly[i] - ry[j]) ** 2
        near = d2 < tolerance**2 if strict else d2 <= tolerance**2
        i, j, d2 = i[near], j[near], d2[near]
        s = np.lexsort((rank[j], d2, i))
        i, j = i[s], j[s]
        lead = np.append(True, i[1:] != i[:-1])[: len(i)]
        best[i[lead]] = j[lead]
    return best


def nearest(left: DataFrame, right: DataFrame, keys: list[str], within: list[str], tolerance: float, take: list[str], order: list[str], strict: bool = True, edge: float = EDGE) -> DataFrame:
    """The left rows with the columns `take` of their nearest right row (x, y) of the same keys and of equal columns `within`, nearer than the tolerance (or as
    near, if not strict); the first in `order` on a tie, null without one.

    keys part the plane, as a field of view does: a group is one block of one field, so it is bounded by its area whatever the number of fields. A left row
    goes to its own block, a right one also to those it is within the tolerance of: none is copied to its neighbourhood. Null or non-finite places
    and null keys or columns meet nothing.
    """
    edge = max(edge, 4 * tolerance)
    keyed = lambda df: df.dropna(subset=keys) if keys else df
    asked = left.withColumns({"__bx": block_of("x", edge), "__by": block_of("y", edge)})
    # comparisons with null and NaN (which is greater than all numbers) don't hold
    finite = (F.abs(F.col("x").cast("double")) < float("inf")) & (F.abs(F.col("y").cast("double")) < float("inf"))
    names = list(dict.fromkeys([*keys, *within, "x", "y", *take, *order]))
    # new names for the right side's columns, in case both sides come from one table
    met = keyed(right.select(*[F.col(c).alias(c) for c in names])).filter(finite).withColumn("__bx", blocks_near("x", edge, tolerance)).withColumn("__by", blocks_near("y", edge, tolerance))
    groups = [*keys, "__by", "__bx"]
    columns = left.columns
    out = ", ".join(f"`{c}` {t}" for c, t in [*left.dtypes, *[(c, t) for c, t in right.select(*take).dtypes]])
    schema = left.sparkSession.createDataFrame([], out).schema

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        at = nearest_rows(a, b, within, tolerance, order, strict)
        index = pa.array(at, mask=at < 0)
        found = {c: b[c].combine_chunks().take(index) if len(b) else pa.nulls(len(a), b.schema.field(c).type) for c in take}
        return pa.table({c: a[c] for c in columns} | found)

    return asked.groupBy(*groups).cogroup(met.groupBy(*groups)).applyInArrow(run, schema)
