"""Questions that every row has to see: rows lie in shards of bounded size, and the rows that ask pass by every shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of rows that a task holds.
SHARD_BYTES = 128 << 20


def number_of_shards(rows: DataFrame, bytes_: Column, shard_bytes: int) -> int:
    """As many shards as the rows fill, and no fewer than there are cores."""
    size = rows.agg(F.sum(bytes_)).first()[0] or 0
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // shard_bytes))


def pass_by(rows: DataFrame, askers: DataFrame, shards: int, schema: str, hold: Callable, ask: Callable[..., Iterator[pa.RecordBatch]]) -> DataFrame:
    """What ask(held, batch of askers) yields for every batch of askers with every shard; held is what hold() makes, given the shard's rows by add(batch).

    Rows (id, x, ...) are dealt by a hash of id and vector, so one shuffle moves each once, and rows that repeat an id part; every asker goes to all shards, behind the rows: a task holds
    one shard, and askers pass by in batches. Askers are copied as often as rows fill a shard, or as there are cores. Columns that only one side has are
    null for the other.
    """
    mine = rows.withColumns({"shard": F.pmod(F.xxhash64("id", "x"), F.lit(shards)).cast("int"), "asks": F.lit(False)})
    asked = askers.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "asks": F.lit(True)})
    dealt = mine.unionByName(asked, allowMissingColumns=True).repartitionById(shards, "shard").sortWithinPartitions("shard", "asks", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, hold()
        for batch in batches:
            key = batch["shard"].to_numpy() * 2 + batch["asks"].to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if key[start] // 2 != shard:
                    shard, held = key[start] // 2, hold()
                part = batch.slice(start, end - start)
                if key[start] % 2:
                    yield from ask(held, part)
                else:
                    held.add(part)

    return dealt.mapInArrow(run, schema)


def by_length(rows: pa.RecordBatch, scale: float = 1) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(n, rows, floor(scale * x)) of the rows whose vector x has n components; a product beyond doubles counts as the greatest."""
    lengths = np.diff(rows["x"].offsets.to_numpy())
    for n in np.unique(lengths).tolist():
        part = rows.filter(pa.array(lengths == n))
        with np.errstate(over="ignore"):
            whole = np.floor(part["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(part), n) * scale)
        yield n, part, np.nan_to_num(whole)
