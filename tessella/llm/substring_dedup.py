"""Substring dedup (operator 6): repeated windows of words, found by Rabin-Karp hashes counted in Spark."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm import rounds
from tessella.llm import textscan as ts

OUT_DDL = "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", _SPANS), ("kept", pa.string())])

GRAM, WINDOW = 0, 1
KEY = pa.schema([("g", pa.int32()), ("key", pa.int64())])
KEY_DDL = "g int, key long"


def _scan(table: pa.Table, window: int, gram: int):
    """Per chunk of rows: bytes, offsets, word starts and ends, first word of each row, word hashes and super-windows."""
    data, offsets = ts.text_bytes(table["text"])
    for a, b in ts.chunks(offsets):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, rows = ts.word_spans(part, at, ~ts.SPACE)
        words = ts.word_hashes(part, starts, ends)
        yield part, at, starts, rows, words, ts.super_windows(words, rows, window, gram)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _keys(g: int, keys: np.ndarray) -> pa.Table:
    found = np.unique(keys).view(np.int64)
    return pa.table([pa.array(np.full(len(found), g, np.int32)), pa.array(found)], schema=KEY)


def _repeated(keys: np.ndarray, replies: pa.Table, kind: int) -> np.ndarray:
    """Which keys the group holds more than once, or another group holds too."""
    found, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    others = replies.filter(pc.equal(replies["kind"], kind))["key"].to_numpy().view(np.uint64)
    return ((count > 1) | np.isin(found, others))[inverse]


def _elsewhere(keys: DataFrame, kind: int) -> DataFrame:
    """(g, kind, key) of the keys that several groups hold, each counted once a group."""
    groups = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return keys.withColumn("n", groups).filter("n > 1").select("g", F.lit(kind).alias("kind"), "key")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = 12, group_bytes: int | None = None) -> DataFrame:
    """Removes every word that lies in a window of `window` words which also starts anywhere else.

    Words are the maximal runs of bytes other than ASCII white space. Every window has a Rabin-Karp hash; the hashes are
    counted by Spark, and repeated windows merge into maximal intervals of words. A group of documents sends each hash once, so a hash has
    as many rows as there are groups at most, however hot it is.
    To count only what can repeat, a first round counts each window's minimizer (the smallest hash of its `gram`-word
    runs): equal windows have equal minimizers, so a window whose minimizer stands at one place only is unique, and its hash
    isn't sent. Nothing else is left out.

    Returns one row for each input row: doc_id, n_words, removed (maximal word intervals, end exclusive), kept (the
    other words, joined by one space). Null and empty texts have no words: no interval, kept is "". A row that is repeated
    counts as another document, so both lose their windows. Null ids stay. An empty table gives no rows. Extra columns are ignored.
    Words and windows are compared by 64-bit hashes. A long text costs a task some forty times its size.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    groups, _ = rounds.sizes(docs, text_col, group_bytes)
    dealt = rounds.by_hash(docs, id_col, text_col, groups)

    def grams(g: int, table: pa.Table, _) -> pa.Table:
        return _keys(g, _joined([spans[2] for *_, spans in _scan(table, window, gram)]))

    def windows(table: pa.Table, replies: pa.Table):
        """Per chunk the starts of all windows that can repeat, their hashes, and what else the scan gave."""
        scan = list(_scan(table, window, gram))
        repeated = _repeated(_joined([s[5][2] for s in scan]), replies, GRAM)
        at = 0
        for part, offs, starts, rows, words, (lo, hi, key) in scan:
            keep = repeated[at : at + len(key)]
            at += len(key)
            first, _ = ts.spread(lo[keep], hi[keep])
            yield part, offs, starts, rows, first, ts.span_hashes(ts.prefix_sums(words), first, first + window)

    def count(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        return _keys(g, _joined([w[-1] for w in windows(table, replies)]))

    def cut(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        scan = list(windows(table, replies))
        repeated = _repeated(_joined([w[-1] for w in scan]), replies, WINDOW)
        at = 0
        counts, removed, kept = [], [], []
        for part, offs, starts, rows, first, key in scan:
            gone = ts.covered(first[repeated[at : at + len(key)]], window, len(starts))
            at += len(key)
            raw = part.tobytes()
            for i in range(len(offs) - 1):
                words = raw[offs[i] : offs[i + 1]].split()
                counts.append(len(words))
                inner = gone[rows[i] : rows[i + 1]]
                if inner.any():
                    ends_at = np.flatnonzero(np.diff(np.concatenate(([0], inner.view(np.int8), [0]))))
                    removed.append([{"start": int(s), "end": int(e)} for s, e in zip(ends_at[::2], ends_at[1::2])])
                    words = [words[j] for j in np.flatnonzero(~inner)]
                else:
                    removed.append([])
                kept.append(b" ".join(words))
        return pa.table([table["doc_id"].cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, _SPANS), pa.array(kept, pa.binary()).cast(pa.string())], schema=OUT)

    first = _elsewhere(rounds.ask(dealt, None, grams, KEY_DDL), GRAM)
    second = _elsewhere(rounds.ask(dealt, first, count, KEY_DDL), WINDOW)
    return rounds.ask(dealt, first.unionByName(second), cut, OUT_DDL)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 35 words."""
    return digest(substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), window=35))


def brute_force(rows: list[tuple], window: int = 35) -> list[tuple]:
    """The same digest in plain Python, for small fixtures."""
    from collections import Counter

    words = [[w for w in (t or "").encode().split()] for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
