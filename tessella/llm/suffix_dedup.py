"""Suffix-array dedup (operator 8): later copies of long byte strings, by a logarithmic family of suffix arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import rounds
from tessella.llm import textscan as ts
from tessella.llm.line_dedup import in_order

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OUT_DDL = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", _SPANS), ("kept", pa.binary())])

ANCHOR, SPAN, VARIETY, SUFFIX, STATE = 0, 1, 2, 3, 4
#: Answers about a minimizer: it stands in one kind of span, in several, or in so many that their strings are dealt one by one.
MIXED, CROWDED = 1, 2
#: More spans than these of one minimizer don't go to one shard (a megabyte of text).
CROWD = 8192
#: Bytes of text scanned at once, some eighty bytes of numbers each: these stay in a core's cache.
SCAN_BYTES = 1 << 17
#: Bytes of pieces that a shard adds to its suffix arrays at once.
BATCH_BYTES = 1 << 20


class SuffixArray:
    """A text and the starts of its suffixes in the order of their first `length` bytes."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, length: int) -> None:
        self.text, self.starts, self.length = text, starts, length

    def strings(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, f"S{self.length}")
        return np.lib.stride_tricks.sliding_window_view(self.text, self.length)[self.starts].view(f"S{self.length}").reshape(-1)

    def holds(self, strings: np.ndarray) -> np.ndarray:
        """Merge-scan: which of the sorted strings are among the suffixes?"""
        mine = self.strings()
        at = np.minimum(np.searchsorted(mine, strings), len(mine) - 1)
        return mine[at] == strings

    def merged(self, other: SuffixArray) -> SuffixArray:
        both = SuffixArray(np.concatenate([self.text, other.text]), np.concatenate([self.starts, other.starts + len(self.text)]), self.length)
        # two sorted runs: a stable sort merges them
        both.starts = both.starts[np.argsort(both.strings(), kind="stable")]
        return both


class IndexFamily:
    """Suffix arrays whose sizes grow geometrically, the largest first.

    A new batch gets a suffix array, which is merge-scanned against every level; what no level holds becomes a new level, and
    neighbouring levels of like size merge. After n suffixes there are O(log n) levels, and a suffix has moved O(log n) times.
    """

    def __init__(self, length: int) -> None:
        self.length = length
        self.levels: list[SuffixArray] = []

    def add(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which of the batch's strings stand earlier, in an earlier batch or at an earlier one of the starts."""
        if not len(starts):
            return np.zeros(0, bool)
        batch = SuffixArray(text, starts, self.length)
        strings = batch.strings()
        order = np.argsort(strings, kind="stable")
        strings = strings[order]
        new = np.append(True, strings[1:] != strings[:-1])
        fresh = strings[new]
        known = np.zeros(len(fresh), bool)
        for level in self.levels:
            known |= level.holds(fresh)
        seen = np.ones(len(starts), bool)
        seen[order[new]] = known
        if not known.all():
            self.levels.append(SuffixArray(text, starts[order[new]][~known], self.length))
        while len(self.levels) > 1 and len(self.levels[-2].starts) < 2 * len(self.levels[-1].starts):
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(large.merged(small))
        return seen


def _blob(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Pieces of text: how many, their lengths, and their bytes."""
    at, _ = ts.spread(starts, ends - 1)
    return np.array([len(starts), *(ends - starts)], "<u4").tobytes() + data[at].tobytes()


def _pieces(blob: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of a blob and the starts of all its strings of `length` bytes, piece by piece."""
    n = int.from_bytes(blob[:4], "little")
    size = np.frombuffer(blob, "<u4", n, 4).astype(np.int64)
    end = np.cumsum(size)
    return np.frombuffer(blob, np.uint8, offset=4 + 4 * n), ts.spread(end - size, end - length)[0]


def strings_seen(blobs: list[bytes], length: int, batch_bytes: int = BATCH_BYTES) -> list[np.ndarray]:
    """For every string of every blob: does it stand earlier, in an earlier blob or at an earlier start?

    A batch costs a look at every level, so blobs come together in batches of bytes: their number follows the shard's text, not the groups that ask.
    """
    family, out = IndexFamily(length), []
    for a, b in ts.chunks(np.cumsum([0, *map(len, blobs)]), batch_bytes):
        texts, starts = zip(*(_pieces(x, length) for x in blobs[a:b]))
        first = np.cumsum([0, *map(len, texts)])
        seen = family.add(np.concatenate(texts), np.concatenate([s + at for s, at in zip(starts, first)]))
        out += np.split(seen, np.cumsum([len(s) for s in starts])[:-1])
    return out


def _state(lo: np.ndarray, hi: np.ndarray, rank: np.ndarray, place: np.ndarray, shard: np.ndarray) -> bytes:
    """A group's candidate spans as numbers of four bytes: steps of the first strings, further strings, ranks; of the first spans, places and shards."""
    return np.concatenate([[len(lo)], np.diff(lo, prepend=0), hi - lo, rank, place, shard]).astype("<u4").tobytes()


def _recalled(replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What _state wrote."""
    (blob,) = replies.filter(pc.equal(replies["kind"], STATE))["bits"].to_pylist()
    numbers = np.frombuffer(rounds.read(blob).tobytes(), "<u4").astype(np.int64)
    n, rest = numbers[0], numbers[1:]
    lo, more, rank = np.cumsum(rest[:n]), rest[n : 2 * n], rest[2 * n : 3 * n]
    place, shard = np.split(rest[3 * n :], 2)
    return lo, lo + more, rank, place, shard


def suffix_array(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at the given starts in the order of their first `depth` bytes, and the class of each sorted suffix.

    Suffixes with the same first `depth` bytes share a class. Eight bytes are compared at a time, and only among
    suffixes that are still equal. Every suffix must have `depth` bytes.
    """
    n = len(starts)
    order = np.arange(n)
    group = np.zeros(n, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))
    active = np.arange(n)  # places in `order` whose group is not yet decided
    for at in range(0, depth, 8):
        if not len(active):
            break
        word = eight[starts[order[active]] + at].astype(np.uint64)
        if depth - at < 8:
            word >>= np.uint64(8 * (8 - depth + at))
        by = np.lexsort((word, group[active]))
        order[active] = order[active][by]
        word, old = word[by], group[active]
        new = np.ones(len(active), bool)
        new[1:] = (word[1:] != word[:-1]) | (old[1:] != old[:-1])
        heads = np.flatnonzero(new)
        group[active] = active[heads][np.cumsum(new) - 1]
        size = np.diff(np.append(heads, len(active)))
        active = active[np.repeat(size > 1, size)]
    return order, group


def _firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of each key among them, and which keys stand at the first place that holds them."""
    found, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    is_first = np.zeros(len(keys), bool)
    is_first[first] = True
    return found, inverse, is_first


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 50, group_bytes: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Removes every byte that lies in a `length`-byte string which also starts earlier.

    Texts are UTF-8 bytes. Earlier means a smaller doc_id, or an earlier start in the same document; among rows of the same
    doc_id it is the smaller XXH64 of the text, and of equal rows all but one are later. Overlapping matches count.

    Batches of documents in that order get suffix arrays, and every shard keeps an `IndexFamily`, whose levels hold suffix arrays with
    their text: it merge-scans the batches in their order against the levels, byte by byte. Three questions narrow down what has to be sorted, without losing a match:
    (1) each string's minimizer (smallest hash of its `gram`-byte runs) has to stand elsewhere too; (2) a whole
    run of neighbouring strings with one minimizer (a span) that an earlier batch holds, by its 64-bit hash, is a long match as it is;
    (3) the strings of a first span are sorted only if its minimizer also stands in
    spans that differ. The text of such a span goes once to the shard of its minimizer; where more than `crowd` spans
    have one minimizer, their strings go one by one to the shards of their own hashes, so that no shard gets a crowd.
    The text is scanned for (1) and (2) only: a group's spans whose minimizer stands elsewhere come back to it with the answers of (2).

    Returns one row for each input row: doc_id, n_bytes, removed (maximal byte intervals, end exclusive), kept (the
    other bytes, joined, which may split a character). Null and empty texts have no bytes; an empty table gives no rows. Extra columns are ignored.
    A long text costs a task some forty times its size.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    groups, shards = rounds.sizes(docs, text_col, group_bytes)
    dealt = rounds.by_range(docs, id_col, text_col, groups)

    def scan(table: pa.Table):
        """The batch's bytes and row offsets; first and last string and minimizer of every span."""
        data, offsets = ts.text_bytes(table["text"])
        parts = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]]
        for a, b in ts.chunks(offsets, SCAN_BYTES):
            lo, hi, key = ts.super_windows(ts.BYTE_VALUES[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], length, gram)
            parts.append([lo + offsets[a], hi + offsets[a], key])
        return data, offsets, *(np.concatenate(x) for x in zip(*parts))

    def hashes(data: np.ndarray, offsets: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of each span, which are in order."""
        parts = [np.zeros(0, np.uint64)]
        for a, b in ts.chunks(offsets, SCAN_BYTES):
            here = slice(*np.searchsorted(lo, offsets[[a, b]]))
            if here.start < here.stop:
                begin, end = lo[here.start], hi[here.stop - 1] + length
                parts.append(ts.span_hashes(ts.prefix_sums(ts.BYTE_VALUES[data[begin:end]]), lo[here] - begin, hi[here] + length - begin))
        return np.concatenate(parts)

    def anchors(g: int, table: pa.Table, _) -> pa.Table:
        return rounds.packed(g, ANCHOR, np.unique(scan(table)[4]), shards, 5)[0]

    def candidates(table: pa.Table, replies: pa.Table):
        """First and last string, minimizer and hash of the spans whose minimizer stands at another place too."""
        data, offsets, lo, hi, key = scan(table)
        found, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        order = rounds.packed(0, ANCHOR, found, shards, 5)[1]
        keep = ((count > 1) | (rounds.answered(replies, ANCHOR, order) > 0))[inverse]
        lo, hi, key = lo[keep], hi[keep], key[keep]
        return lo, hi, key, hashes(data, offsets, lo, hi)

    def varieties(key: np.ndarray, span: np.ndarray):
        """Distinct minimizers, the place of each span's among them, and for each the least and greatest hash and the number of its spans."""
        found, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        least, most = np.full(len(found), 2**64 - 1, np.uint64), np.zeros(len(found), np.uint64)
        np.minimum.at(least, inverse, span)
        np.maximum.at(most, inverse, span)
        return found, inverse, np.stack([least, most, count.astype(np.uint64)], 1)

    def ranks(order: np.ndarray) -> np.ndarray:
        """The place of each key's answer among the answers."""
        out = np.empty(len(order), np.int64)
        out[order] = np.arange(len(order))
        return out

    def variety_rows(g: int, key: np.ndarray, span: np.ndarray) -> tuple[pa.Table, np.ndarray]:
        """One entry a minimizer: its key and a digest of the spans it is in; the place of each span's answer."""
        found, inverse, digest = varieties(key, span)
        table, order = rounds.packed(g, VARIETY, found, shards, 8)
        # behind the keys of a shard come the digests, in the same order
        rows, at, blobs = digest[order], 0, []
        for b in table["keys"].to_pylist():
            n = len(b) // 8
            blobs.append(b + rows[at : at + n].astype("<u8").tobytes())
            at += n
        return table.set_column(3, "keys", pa.array(blobs, pa.binary())), ranks(order)[inverse]

    def spans(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        lo, hi, key, span = candidates(table, replies)
        found, inverse, first = _firsts(span)
        asked, order = rounds.packed(g, SPAN, found, shards, 8)
        kinds, place = variety_rows(g, key[first], span[first])
        state = _state(lo, hi, ranks(order)[inverse], place, rounds.shard_of(key[first], shards))
        return pa.concat_tables([asked, kinds, rounds.asked(g, STATE, [g], [state])])

    def matches(table: pa.Table, replies: pa.Table):
        """Spans that are later copies, and the pieces of text to look up.

        pieces: first string, end, shard; those of crowded minimizers are single strings, one of each kind. strings: the starts
        that the pieces' answers are about, in the order of the answers.
        """
        data, offsets = ts.text_bytes(table["text"])
        lo, hi, rank, place, own_shard = _recalled(replies)
        first = _firsts(rank)[2]
        later = ~first | (rounds.answered(replies, SPAN, np.arange(len(place)))[rank] > 0)
        kind, home = np.zeros(len(lo), np.uint8), np.zeros(len(lo), np.int64)
        kind[first], home[first] = rounds.answered(replies, VARIETY, np.arange(place.max(initial=-1) + 1))[place], own_shard
        open_ = ~later & (kind == MIXED)
        piece_lo, piece_end, shard = lo[open_], hi[open_] + length, home[open_]
        crowded = ~later & (kind == CROWDED)
        alone, _ = ts.spread(lo[crowded], hi[crowded])
        order, group = suffix_array(data, alone, length)
        alone, heads = alone[order], np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
        single = np.minimum.reduceat(alone, heads) if len(heads) else alone
        if len(single):
            print_ = ts.span_hashes(ts.prefix_sums(ts.BYTE_VALUES[data]), single, single + length)
            piece_lo, piece_end, shard = np.concatenate([piece_lo, single]), np.concatenate([piece_end, single + length]), np.concatenate([shard, rounds.shard_of(print_, shards)])
        by = np.lexsort((piece_lo, shard))
        pieces = piece_lo[by], piece_end[by], shard[by]
        return data, offsets, lo, hi, later, pieces, ts.spread(pieces[0], pieces[1] - length)[0], alone, np.repeat(single, np.diff(np.append(heads, len(alone))))

    def suffixes(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        data, *_, (start, end, shard), _, _, _ = matches(table, replies)
        there, first = np.unique(shard, return_index=True)
        return rounds.asked(g, SUFFIX, there, [_blob(data, start[a:b], end[a:b]) for a, b in zip(first, np.append(first[1:], len(shard)))])

    def cut(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        data, offsets, lo, hi, later, _, strings, alone, single = matches(table, replies)
        copy = np.zeros(len(data) + 1, bool)
        copy[strings[rounds.answered(replies, SUFFIX, np.arange(len(strings))) > 0]] = True
        # of a crowd's strings one of each kind was looked up
        copy[alone[copy[single] | (alone != single)]] = True
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, lo[later], 1)
        np.add.at(edge, hi[later] + length, -1)
        suffix = np.flatnonzero(copy)
        np.add.at(edge, suffix, 1)
        np.add.at(edge, suffix + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        raw = data.tobytes()
        removed, kept = [], []
        for a, b in zip(offsets[:-1], offsets[1:]):
            mine = gone[a:b]
            if mine.any():
                ends = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
                removed.append([{"start": int(s), "end": int(e)} for s, e in zip(ends[::2], ends[1::2])])
                kept.append(data[a:b][~mine].tobytes())
            else:
                removed.append([])
                kept.append(raw[a:b])
        return pa.table([table["doc_id"].cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(removed, _SPANS), pa.array(kept, pa.binary())], schema=OUT)

    def shard(kind: int, blobs: list[bytes]) -> list[np.ndarray]:
        if kind == ANCHOR:
            return rounds.elsewhere(blobs, 5)
        if kind == SPAN:
            return rounds.earlier(blobs, 8)
        if kind == SUFFIX:
            return strings_seen(blobs, length)
        if kind == STATE:
            return [np.frombuffer(b, np.uint8) for b in blobs]
        sizes = [len(b) // 32 for b in blobs]
        key, _ = rounds.unpacked([b[: 8 * n] for b, n in zip(blobs, sizes)], 8)
        digest, _ = rounds.unpacked([b[8 * n :] for b, n in zip(blobs, sizes)], 8)
        _, inverse = np.unique(key, return_inverse=True)
        least, most = np.full(len(key), 2**64 - 1, np.uint64), np.zeros(len(key), np.uint64)
        np.minimum.at(least, inverse, digest[::3])
        np.maximum.at(most, inverse, digest[1::3])
        count = np.bincount(inverse, weights=digest[2::3].astype(np.float64), minlength=len(key))
        return np.split(np.where(least == most, 0, np.where(count <= crowd, MIXED, CROWDED))[inverse], np.cumsum(sizes)[:-1])

    one = rounds.answer(rounds.ask(dealt, None, anchors), shard)
    two = rounds.answer(rounds.ask(dealt, one, spans), shard)
    three = rounds.answer(rounds.ask(dealt, two, suffixes), shard)
    return rounds.ask(dealt, two.unionByName(three), cut, OUT_DDL)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, matches of 100 bytes."""
    return digest(suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), length=100))


def brute_force(rows: list[tuple], length: int = 100) -> list[tuple]:
    """The same digest in plain Python, for small fixtures."""
    seen: set[bytes] = set()
    out = []
    for doc_id, text in in_order(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(raw[i : i + length])
        spans = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
