"""Benchmark decontamination (operator 4): suffix arrays of shards of the corpus, searched with every suffix of the benchmark."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import textscan as ts

#: Bytes of benchmark text that one broadcast holds, as arrays of some sixty bytes a word; a larger benchmark is searched in several blocks.
BLOCK_BYTES = 8 << 20
#: Bytes of documents that meet one block after the other, where there are several.
HELD_BYTES = 16 << 20

WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_BEST = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])
_FOUND_DDL = "n_words long, hits array<struct<start:long,end:long>>, items array<string>, longest struct<item_id:string,item_word:long,doc_word:long,n_words:long>"


def _tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and the first word of each row."""
    data, offsets = ts.text_bytes(column)
    data = ts.LOWER[data]
    starts, ends, rows = ts.word_spans(data, offsets, WORD)
    return ts.word_hashes(data, starts, ends), rows


def _sums(number: np.ndarray) -> np.ndarray:
    return ts.prefix_sums(ts.mix(number.astype(np.int64).view(np.uint64) + np.uint64(2)))


def _refined(order: np.ndarray, group: np.ndarray, active: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Sorts the active places of `order` inside their groups by `word`, splits the groups, and returns the places that are still undecided."""
    by = np.lexsort((word, group[active]))
    order[active], word, old = order[active][by], word[by], group[active]
    new = np.ones(len(active), bool)
    new[1:] = (word[1:] != word[:-1]) | (old[1:] != old[:-1])
    heads = np.flatnonzero(new)
    group[active] = active[heads][np.cumsum(new) - 1]
    size = np.diff(np.append(heads, len(active)))
    return active[np.repeat(size > 1, size)]


def _suffix_array(number: np.ndarray, starts: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Places in `starts`, in the order of the word sequences that follow, compared up to `depth` words; room: words up to the end of each."""
    order, group, active = np.arange(len(starts)), np.zeros(len(starts), np.int64), np.arange(len(starts))
    for at in range(depth):
        if not len(active):
            break
        active = _refined(order, group, active, np.where(room[order[active]] > at, number[np.minimum(starts[order[active]] + at, len(number) - 1)], -1))
    return order


def _whole_suffix_array(number: np.ndarray, left: np.ndarray) -> np.ndarray:
    """All suffixes in the order of their words up to the end of their item, by doubling the length that is compared."""
    n = len(number)
    order = np.argsort(number, kind="stable")
    new = np.append(True, number[order][1:] != number[order][:-1])[:n]
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    active, k = np.arange(n), 1
    while len(active) and k < left.max(initial=0):
        rank = np.empty(n, np.int64)
        rank[order] = group
        at = order[active]
        active = _refined(order, group, active, np.where(left[at] > k, rank[np.minimum(at + k, n - 1)] + 1, 0))
        k *= 2
    return order


def _block(items: pa.Table, window: int) -> dict:
    """A block of the benchmark as arrays: the words, the suffix array, and the distinct windows with their items and suffixes."""
    words, rows = _tokens(items["text"])
    vocabulary, number = np.unique(words, return_inverse=True)
    size = np.diff(rows)
    item = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(words)) - rows[:-1][item]
    left = size[item] - place
    need = np.minimum(size[item], window)
    suffixes = _whole_suffix_array(number, left)
    rank = np.empty(len(words), np.int64)
    rank[suffixes] = np.arange(len(words))
    sums = _sums(number)
    start = np.flatnonzero(left >= need)
    _, first, kind = np.unique(ts.span_hashes(sums, start, start + need[start]), return_index=True, return_inverse=True)
    low, high = np.full(len(first), len(words)), np.zeros(len(first), np.int64)
    np.minimum.at(low, kind, rank[start])
    np.maximum.at(high, kind, rank[start] + 1)
    pairs = np.unique(kind * max(1, len(size)) + item[start])
    owner = pairs // max(1, len(size))
    narrow = lambda x: x.astype(np.int32)
    return {
        "vocabulary": vocabulary, "number": narrow(number), "item": narrow(item), "place": narrow(place), "left": narrow(left), "sums": sums, "suffixes": narrow(suffixes), "window": window,
        "first": start[first], "need": need[start[first]], "low": low, "high": high, "items_at": np.searchsorted(owner, np.arange(len(first) + 1)), "items": narrow(pairs % max(1, len(size))), "ids": items["item_id"].to_pylist(),
    }


def _bound(value: np.ndarray, array: np.ndarray, room: np.ndarray, depth: int, number: np.ndarray, lo: np.ndarray, hi: np.ndarray, right: bool) -> np.ndarray:
    """For every search the first place in lo..hi whose word at `depth` is not below (right: is above) its value."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = np.minimum((lo + hi) // 2, len(array) - 1)
        word = np.where(room[mid] > depth, number[np.minimum(array[mid] + depth, len(number) - 1)], -1)
        go = (word <= value if right else word < value) & open_
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)
    return lo


def _common(sums: np.ndarray, at: np.ndarray, other: np.ndarray, to: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The length of the common prefix, at most `most`, of a shard's suffixes and as many of the benchmark's, by bisection over hashes."""
    lo, hi = np.zeros(len(at), np.int64), most.astype(np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = ts.span_hashes(sums, at, at + mid) == ts.span_hashes(other, to, to + mid)
        lo, hi = np.where(open_ & same, mid, lo), np.where(open_ & ~same, mid - 1, hi)
    return lo


def _longest(number: np.ndarray, room: np.ndarray, at: np.ndarray, kind: np.ndarray, block: dict) -> tuple[np.ndarray, np.ndarray]:
    """For every hit of a window the longest match that begins there, and a benchmark suffix that has it.

    A bisection among the benchmark's suffixes with that window: the longest match is with a neighbour of the place it ends at, and both were looked at.
    """
    sums = _sums(number)
    lo, hi = block["low"][kind].copy(), block["high"][kind].copy()
    best, suffix = np.zeros(len(at), np.int64), block["first"][kind].copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        t, p = block["suffixes"][mid].astype(np.int64), at[open_]
        left = block["left"][t]
        common = _common(sums, p, block["sums"], t, np.minimum(left, room[open_]))
        better = common > best[open_]
        best[open_[better]], suffix[open_[better]] = common[better], t[better]
        ended = common >= left
        below = ended | ((common < room[open_]) & (block["number"][np.minimum(t + common, len(block["number"]) - 1)] < number[np.minimum(p + common, len(number) - 1)]))
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    return best, suffix


def _search(words: np.ndarray, rows: np.ndarray, block: dict) -> tuple[np.ndarray, dict, dict]:
    """Hit mark of every word; of the rows with hits the items found and the longest match, over one shard."""
    hit, items, longest = np.zeros(len(words), bool), {}, {}
    vocabulary = block["vocabulary"]
    if not len(vocabulary) or not len(words):
        return hit, items, longest
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    known = vocabulary[at] == words
    # a match is a run of known words inside one row, at least as long as the shortest window
    number = np.where(known, at, -1)
    stop = ~known
    last = np.zeros(len(words), bool)
    last[rows[1:][rows[1:] > rows[:-1]] - 1] = True
    ends = np.flatnonzero(stop | last) + ~stop[stop | last]
    nearest = ends[np.minimum(np.searchsorted(ends, np.arange(len(words)), side="right"), len(ends) - 1)]
    left = np.where(known, nearest - np.arange(len(words)), 0)
    starts = np.flatnonzero(left >= block["need"].min())
    if not len(starts):
        return hit, items, longest
    order = _suffix_array(number, starts, left[starts], block["window"])
    array, room = starts[order], left[starts[order]]
    # every window of the benchmark, a word at a time
    lo, hi = np.zeros(len(block["first"]), np.int64), np.full(len(block["first"]), len(array), np.int64)
    alive = np.arange(len(lo))
    for depth in range(block["window"]):
        alive = alive[(block["need"][alive] > depth) & (lo[alive] < hi[alive])]
        value = block["number"][block["first"][alive] + depth]
        a = _bound(value, array, room, depth, number, lo[alive], hi[alive], False)
        lo[alive], hi[alive] = a, _bound(value, array, room, depth, number, a, hi[alive], True)
    found = np.flatnonzero(lo < hi)
    if not len(found):
        return hit, items, longest
    where, which = ts.spread(lo[found], hi[found] - 1)
    start, kind, room = array[where], found[which], room[where]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + block["need"][kind], -1)
    hit = np.cumsum(edge[:-1]) > 0
    row = np.searchsorted(rows, start, side="right") - 1
    pairs = np.unique(row * len(block["first"]) + kind)
    of_row, of_kind = pairs // len(block["first"]), pairs % len(block["first"])
    k, owner = ts.spread(block["items_at"][of_kind], block["items_at"][of_kind + 1] - 1)
    for r, i in zip(of_row[owner].tolist(), block["items"][k].tolist()):
        items.setdefault(r, set()).add(block["ids"][i])
    size, suffix = _longest(number, room, start, kind, block)
    # the longest match of a row, the first of equal ones
    by = np.lexsort((start, -size, row))
    for i in by[np.append(True, row[by][1:] != row[by][:-1])].tolist():
        longest[int(row[i])] = (block["ids"][block["item"][suffix[i]]], int(block["place"][suffix[i]]), int(start[i] - rows[row[i]]), int(size[i]))
    return hit, items, longest


def _spans(marks: np.ndarray) -> list[dict]:
    ends = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(ends[::2], ends[1::2])]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Arrow tables (item_id, text) of at most about block_bytes each."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    for k in range(count):
        yield (items if count == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)).toArrow()


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds to every row of docs what it shares with the benchmark.

    A-Z is lower-cased; words are runs of 0-9, a-z and non-ASCII characters. A window is `window` consecutive words of an item; an
    item of fewer words, but not none, is one window. Each task takes bounded chunks of documents as shards,
    sorts their suffixes into a suffix array, and binary-searches every distinct window of the benchmark in it, a word at a time. From
    each hit a bisection in the benchmark's own suffix array gives the longest verbatim match that begins there.
    Only words of the benchmark can be in a match, so other suffixes aren't sorted. The work is in proportion to the words, their hits and a logarithm,
    also where one word repeats throughout.
    The benchmark is broadcast in blocks of at most about `block_bytes`, whatever its size; executors keep them on disk, and a task has one in memory at a time, in
    turn for every HELD_BYTES of documents, in one pass over them. The driver prepares one block at a time. One item has to fit in a block's memory.

    Returns (row struct of all columns of docs, n_words, hits (word intervals inside any occurrence of a window), items (ids with an
    occurring window, sorted as strings), longest (item_id, item_word, doc_word, n_words of the longest match, the first of equal ones; null without a window)).
    Null and empty texts have no words and no hits; an empty benchmark hits nothing; a null item id counts as "". An empty table gives no rows, equal rows
    each get their own result. Columns of docs keep their names in `row`, so none can clash. Words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:long,end:long>>").alias("hits"), F.array().cast("array<string>").alias("items"), F.lit(None).cast("struct<item_id:string,item_word:long,doc_word:long,n_words:long>").alias("longest"))
    shared = [spark.sparkContext.broadcast(_block(items, window)) for items in blocks(benchmark, item_id_col, item_text_col, block_bytes)]

    def run(batches):
        for chunks in _held(batches, HELD_BYTES if len(shared) > 1 else 0):
            for one in shared:
                block = _read(one) if len(shared) > 1 else one.value
                chunks = [_with_block(c, block) for c in chunks]
                del block
                ts.give_back()
            yield from chunks

    return out.mapInArrow(run, out.schema).drop("text")


def _read(shared) -> dict:
    """The value of a broadcast, read from the executor's copy on disk and not kept as `value` would be; where there is no such copy, as with encryption, its value."""
    path = getattr(shared, "_path", None)
    return shared.load_from_path(path) if path else shared.value


def _held(batches: Iterator[pa.RecordBatch], at_least: int) -> Iterator[list[pa.RecordBatch]]:
    """Chunks of documents in lists of some bytes, so that reading a block is worth its while."""
    out, size = [], 0
    for batch in batches:
        _, offsets = ts.text_bytes(batch["text"])
        for a, b in ts.chunks(offsets):
            out.append(batch.slice(a, b - a))
            size += int(offsets[b] - offsets[a])
            if size >= at_least:
                yield out
                out, size = [], 0
    if out:
        yield out


def _with_block(batch: pa.RecordBatch, block: dict) -> pa.RecordBatch:
    words, rows = _tokens(batch["text"])
    hit, items, longest = _search(words, rows, block)
    hits, found, best = batch["hits"].to_pylist(), batch["items"].to_pylist(), batch["longest"].to_pylist()
    for i in items:
        mine = hit[rows[i] : rows[i + 1]]
        for s in hits[i]:
            mine[s["start"] : s["end"]] = True
        hits[i] = _spans(mine)
        found[i] = sorted({*found[i], *items.get(i, ())})
        if i in longest and (best[i] is None or longest[i][3] > best[i]["n_words"]):
            best[i] = dict(zip(("item_id", "item_word", "doc_word", "n_words"), longest[i]))
    names = batch.schema.names
    new = {"n_words": pa.array(np.diff(rows)), "hits": pa.array(hits, pa.list_(_SPAN)), "items": pa.array(found, pa.list_(pa.string())), "longest": pa.array(best, _BEST)}
    return pa.RecordBatch.from_arrays([new[n] if n in new else batch[n] for n in names], names=names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that share no window with the benchmark, with their columns."""
    return find_overlaps(docs, benchmark, **options).filter(F.size("hits") == 0).select("row.*")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, windows of 10 words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def brute_force(rows: list[tuple], benchmark: list[tuple], window: int = 10) -> list[tuple]:
    """The same digest in plain Python, for small fixtures."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda t: word.findall((t or "").translate(lower))
    windows: dict[tuple, set[str]] = {}
    for item_id, text in benchmark:
        w = split(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item_id is None else str(item_id))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in rows:
        w, gone, items = split(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[i : i + size]))) is not None:
                    gone.update(range(i, i + size))
                    items |= found
        out.append((doc_id, len(w), len(gone), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(gone)))
    return out
