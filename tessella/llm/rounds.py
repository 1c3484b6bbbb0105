"""Rounds of key questions between groups of documents and shards of a key space.

A group of documents (a bounded batch of rows) asks about 64-bit keys. Every key belongs to one shard,
so a shard sees all groups that ask about it; it answers with one number a key. A group sends each key once, however
often it holds it: a key held by a third of all rows costs a shard no more than one entry a group. Keys travel packed
(one row for each group and shard), sorted, so the group can match the answer to them by order alone.

The documents are dealt to groups by one exchange that all rounds of a plan share. A row's group depends on its place in its input
partition, so the input has to give the same rows in the same order when a lost task reads it again: a file or a checkpoint does.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.llm import textscan as ts

ASK = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary())])
ASK_DDL = "g int, kind int, shard int, keys binary"
ANSWER = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary())])
ANSWER_DDL = "g int, kind int, shard int, bits binary"
#: Rows looked at for each bound between groups: their sizes vary by a third.
LOOKS = 8


def _bytes_of(size: str) -> int:
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", size.strip().lower())
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[found[2]] if found else 1 << 30


def group_bytes(spark: SparkSession) -> int:
    """Bytes of text of a group: a share of what an executor has for each of its cores, 4 MB at least.

    Groups times shards is the number of packed rows, so on larger executors larger groups keep it down.
    """
    conf, master = spark.sparkContext.getConf(), spark.sparkContext.master
    local = re.match(r"local\[(\d+|\*)", master)
    memory = _bytes_of(conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g"))
    cores = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "2"))
    return min(256 << 20, max(4 << 20, memory // max(1, cores) // 225))


def extent(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Bytes of text and rows, by one aggregate."""
    row = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return int(row["b"] or 0), int(row["n"])


def sizes(docs: DataFrame, text_col: str, most: int | None) -> tuple[int, int]:
    """Number of groups and of shards; both grow with the bytes of text.

    A group and a shard exchange at most one row, and no more rows than the group has keys. Groups and shards are smaller
    than they may be only so far as the session's partitions need them.
    """
    size, _ = extent(docs, text_col)
    most = most or group_bytes(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tuple(max(1, -(-size // top), min(2 * partitions, -(-size // least))) for top, least in ((most, 1 << 20), (4 * most, 2 << 20)))


def _dealt(docs: DataFrame, g: Column, id_col: str, text_col: str, row: Column | None) -> DataFrame:
    """(g, doc_id, h, u, text, and row if it is given). h: hash of the text, u: the row's place in the input."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("u"), F.col(text_col).cast("string").alias("text"), *([row.alias("row")] if row is not None else []))
    return kept.select(g.cast("int").alias("g"), "*")


def by_hash(docs: DataFrame, id_col: str, text_col: str, groups: int, row: Column | None = None) -> DataFrame:
    """Rows dealt evenly, whatever their ids and texts: repeated rows and rows of one id go to all groups."""
    return _together(_dealt(docs, F.pmod(F.xxhash64("u"), F.lit(groups)), id_col, text_col, row), groups)


def _together(dealt: DataFrame, groups: int) -> DataFrame:
    """Each group's rows together, in as many partitions as there are groups, so that a partition's bytes don't grow with the input."""
    return dealt.repartition(max(groups, int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "g")


def _ordered_key() -> Column:
    """doc_id (null first), h and u as one text in the same order."""
    digits = lambda c: F.lpad(F.hex(F.col(c).bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(F.when(F.col("doc_id").isNull(), "0").otherwise("1"), F.when(F.col("doc_id").isNull(), "").otherwise(digits("doc_id")), digits("h"), digits("u"))


def by_range(docs: DataFrame, id_col: str, text_col: str, groups: int, row: Column | None = None) -> DataFrame:
    """Rows dealt to groups of about equal bytes in the order of doc_id (nulls first), hash of the text and place in the input.

    Rows of one id, and repeated rows, go on over as many groups as they fill. The bounds come from some LOOKS rows a group, drawn by
    hash in proportion to their bytes; any bounds give the same results. They are searched in two steps, so that a row
    costs about two square roots of the number of groups.
    """
    dealt = _dealt(docs, F.lit(0), id_col, text_col, row)
    if groups == 1:
        return dealt
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    keyed = dealt.select(_ordered_key().alias("key"), size.alias("size"))
    total = keyed.agg(F.sum("size")).first()[0] or 1
    weight = F.col("size") * (LOOKS * groups / total)
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30)
    seen = sorted((r["key"], r["w"]) for r in keyed.filter(chance < weight).select("key", F.greatest(F.lit(1.0), weight).alias("w")).collect())
    if not seen:
        return dealt
    upto = np.cumsum([w for _, w in seen])
    at = np.searchsorted(upto, np.arange(1, groups) * (upto[-1] / groups))
    bounds = sorted({seen[k][0] for k in np.minimum(at, len(seen) - 1)})
    step = max(1, int(len(bounds) ** 0.5))
    # one text each, split by constant folding: thousands of literals would be slow to build
    listed = lambda b: F.split(F.lit(",".join(b)), ",")
    before = F.size(F.filter(listed(bounds[::step]), lambda b: b <= F.col("key")))
    inner = F.slice(listed(bounds), (F.greatest(F.lit(1), F.col("before")) - 1) * step + 1, F.lit(step))
    g = F.when(F.col("before") == 0, 0).otherwise((F.col("before") - 1) * step + F.size(F.filter(inner, lambda b: b <= F.col("key"))))
    placed = dealt.withColumn("key", _ordered_key()).withColumn("before", before)
    return _together(placed.select(g.cast("int").alias("g"), *[c for c in dealt.columns if c != "g"]), groups)


def ordered(table: pa.Table) -> pa.Table:
    """A group's rows in the order of by_range: the same order in every round."""
    return table.take(pc.sort_indices(table.select(["doc_id", "h", "u"]), [("doc_id", "ascending"), ("h", "ascending"), ("u", "ascending")], null_placement="at_start"))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def packed(g: int, kind: int, keys: np.ndarray, shards: int, width: int) -> tuple[pa.Table, np.ndarray]:
    """Rows that ask about distinct keys, and the order in which the answers come.

    width: bytes of a key that are sent besides its shard: 8, or fewer where a false alarm does no harm.
    """
    shard = shard_of(keys, shards)
    order = np.lexsort((keys, shard))
    keys, shard = keys[order], shard[order]
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    there, first = np.unique(shard, return_index=True)
    last = np.append(first[1:], len(keys))
    return asked(g, kind, there, [raw[a * width : b * width] for a, b in zip(first, last)]), order


def asked(g: int, kind: int, shards: np.ndarray, blobs: list[bytes]) -> pa.Table:
    n = len(blobs)
    return pa.table([pa.array(np.full(n, g, np.int32)), pa.array(np.full(n, kind, np.int32)), pa.array(np.asarray(shards, np.int32)), pa.array(blobs, pa.binary())], schema=ASK)


def unpacked(blobs: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of several rows, and the number of each key's row."""
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return wide.view("<u8").reshape(-1).astype(np.uint64), np.repeat(np.arange(len(blobs)), [len(b) // width for b in blobs])


def _written(answers: np.ndarray) -> bytes:
    """Truth values as bits, other small numbers as bytes, behind their count."""
    head = len(answers).to_bytes(4, "little")
    return head + (b"\0" + np.packbits(answers).tobytes() if answers.dtype == bool else b"\1" + answers.astype(np.uint8).tobytes())


def read(blob: bytes) -> np.ndarray:
    """The answers of one row."""
    n, raw = int.from_bytes(blob[:4], "little"), np.frombuffer(blob, np.uint8)[5:]
    return raw if blob[4] else np.unpackbits(raw, count=n)


def answered(replies: pa.Table, kind: int, order: np.ndarray) -> np.ndarray:
    """The answer to every key, in the keys' own order."""
    out = np.zeros(len(order), np.uint8)
    if not len(order):
        return out
    mine = replies.filter(pc.equal(replies["kind"], kind)).sort_by("shard")
    found = np.concatenate([np.zeros(0, np.uint8), *(read(b) for b in mine["bits"].to_pylist())])
    if len(found) != len(order):
        raise RuntimeError(f"{len(found)} answers to {len(order)} keys")
    out[order] = found
    return out


def ask(groups: DataFrame, replies: DataFrame | None, mapper: Callable, ddl: str | StructType = ASK_DDL) -> DataFrame:
    """Runs mapper(g, ordered rows, replies) -> Arrow table on every group."""
    if replies is None:

        def alone(table: pa.Table) -> pa.Table:
            out = mapper(table["g"][0].as_py(), ordered(table), None)
            ts.give_back()
            return out

        return groups.groupBy("g").applyInArrow(alone, ddl)

    def both(table: pa.Table, right: pa.Table) -> pa.Table:
        out = mapper(table["g"][0].as_py(), ordered(table), right)
        ts.give_back()
        return out

    return groups.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(both, ddl)


def answer(questions: DataFrame, shard_fn: Callable) -> DataFrame:
    """Runs shard_fn(kind, blobs) -> one array of answers a blob, on every shard; blobs come in the order of their groups."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("g")
        kind, n = table["kind"][0].as_py(), table.num_rows
        bits = [_written(b) for b in shard_fn(kind, table["keys"].to_pylist())]
        ts.give_back()
        return pa.table([table["g"].combine_chunks(), pa.array([kind] * n, pa.int32()), table["shard"].combine_chunks(), pa.array(bits, pa.binary())], schema=ANSWER)

    return questions.groupBy("kind", "shard").applyInArrow(run, ANSWER_DDL)


def elsewhere(blobs: list[bytes], width: int) -> list[np.ndarray]:
    """For every key: does another blob hold it too?"""
    keys, _ = unpacked(blobs, width)
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.split((count > 1)[inverse], np.cumsum([len(b) // width for b in blobs])[:-1])


def earlier(blobs: list[bytes], width: int) -> list[np.ndarray]:
    """For every key: does an earlier blob hold it too?"""
    keys, owner = unpacked(blobs, width)
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return np.split(owner[first][inverse] < owner, np.cumsum([len(b) // width for b in blobs])[:-1])
