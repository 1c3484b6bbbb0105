"""Voxel neighbourhoods: voxels are dealt to blocks with a halo, and each block is one dense array in one task.

A voxel goes to the one block it lies in, and to those it borders on (some 15 % of copies for a halo of two), whatever the size of the
neighbourhood. A block spans BLOCK x BLOCK pixels and all slices, so its array is bounded by the depth of the image.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
PLACE = ["z", "y", "x"]


class Block:
    """A block's voxels: dense values and presence by [z, y, x] with `halo` places more on every side, and the place of its first inner voxel."""

    def __init__(self, table: pa.Table, halo: int, depth: tuple[int, int] | None = None) -> None:
        at = {c: table[c].to_numpy().astype(np.int64) for c in PLACE}
        self.halo = halo
        low, high = depth or (int(at["z"].min()), int(at["z"].max()))
        # nothing is farther than the halo from a voxel, so the block ends there
        start = {c: int(table[f"b{c}"][0].as_py()) * BLOCK + 1 for c in "yx"}
        first = {c: max(b, int(at[c].min()) - halo) for c, b in start.items()}
        last = {c: min(b + BLOCK - 1, int(at[c].max()) + halo) for c, b in start.items()}
        self.first = np.array([low, first["y"], first["x"]])
        shape = (high - low + 1 + 2 * halo, *[last[c] - first[c] + 1 + 2 * halo for c in "yx"])
        self.index = tuple(at[c] - f + halo for c, f in zip(PLACE, self.first))
        self.there = np.zeros(shape, bool)
        self.there[self.index] = True
        self.shape = shape

    def dense(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.shape, values.dtype)
        out[self.index] = values
        return out

    def inner(self) -> np.ndarray:
        """Marks the places that are no halo."""
        out = np.zeros(self.shape, bool)
        h = self.halo
        out[tuple(slice(h, n - h) for n in self.shape)] = True
        return out

    def around(self, array: np.ndarray, offset: tuple[int, int, int]) -> np.ndarray:
        """array[p + offset] at every place p that is no halo, without a copy. No offset goes beyond the halo."""
        h = self.halo
        return array[tuple(slice(h + o, n - h + o) for o, n in zip(offset, self.shape))]

    def places(self, index: tuple[np.ndarray, ...]) -> dict[str, np.ndarray]:
        return {c: (i + f - self.halo).astype(np.int32) for c, i, f in zip(PLACE, index, self.first)}


def by_block(voxels: DataFrame, keys: list[str], columns: list[str], halo: int, fn: Callable, out: dict[str, str]) -> DataFrame:
    """Rows (keys, columns of `out`) that fn(table of a block) -> arrays by name gives, over all blocks. fn gets the halo's voxels as well."""
    reach = lambda c: F.explode(F.sequence(F.floor((F.col(c) - 1 - halo) / BLOCK), F.floor((F.col(c) - 1 + halo) / BLOCK)))
    dealt = voxels.select(*keys, *PLACE, *columns).withColumn("bx", reach("x")).withColumn("by", reach("y"))
    kinds = dict(voxels.select(*keys).dtypes)
    ddl = ", ".join(f"`{n}` {t}" for n, t in (kinds | out).items())
    schema = voxels.sparkSession.createDataFrame([], ddl).schema

    def run(table: pa.Table) -> pa.Table:
        found = fn(table)
        n = len(next(iter(found.values())))
        own = {k: pa.repeat(table[k][0], n) for k in keys}
        return pa.table(own | {k: pa.array(v) for k, v in found.items()})

    return in_groups(dealt, [*keys, "by", "bx"], run, schema)


def _begins(before: pa.Table | None, table: pa.Table, keys: list[str]) -> np.ndarray:
    """Marks the rows whose keys aren't those of the row before; the first row comes after the last one of `before`."""
    rows = table.select(keys) if before is None else pa.concat_tables([before.select(keys).slice(len(before) - 1), table.select(keys)])
    new = np.zeros(max(len(rows) - 1, 0), bool)
    for k in keys:
        column = rows[k].combine_chunks()
        a, b = column.slice(0, len(rows) - 1), column.slice(1)
        new |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
    return new if before is not None else np.append(True, new)


def in_groups(rows: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    """fn of every group's table, as applyInArrow over groupBy, for many small groups: they pass a task one after the other in batches of rows, so a
    group costs what fn costs. A task holds one batch and one group."""

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            cuts, done, a = np.flatnonzero(_begins(held[-1] if held else None, table, keys)).tolist(), [], 0
            for b in [*cuts, len(table)]:
                if b > a:
                    held.append(table.slice(a, b - a))
                if b < len(table) and held:
                    done.append(fn(pa.concat_tables(held).combine_chunks()))
                    held = []
                a = b
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
        if held:
            yield from fn(pa.concat_tables(held).combine_chunks()).combine_chunks().to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
