"""Line dedup (operator 2): lines within one edit of an earlier line, by a deletion-neighbourhood join."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import rounds
from tessella.llm import textscan as ts

LINE, HALF, VARIANT = 0, 1, 2
#: Stands for the undeleted line in the place of a deletion; sorts behind all places.
WHOLE = np.uint32(2**32 - 1)
#: Stands for several lines in the place of one line's digest.
_MANY = np.uint32(2**32 - 1)
#: White space that leaves a line blank.
BLANK = "\t\x0b\x0c\r "


def _line_key(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode(), 1)


def half_keys(line: str) -> list[int]:
    """Four keys. Two lines within one edit share a half: the front or the back half, for the length of the shorter.

    With an edit behind the middle the front halves are equal, else the back halves; lines of n code points look for partners
    of n or n + 1 under the length n, and for partners of n - 1 under n - 1.
    """
    n, out = len(line), []
    for length in (n, n - 1):
        half = length // 2
        out += [xxhash.xxh64_intdigest(line[:half].encode(), 4 * length + 2), xxhash.xxh64_intdigest(line[n - (length - half) :].encode(), 4 * length + 3)]
    return out


def variants(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place and line number of every variant: each code point deleted once, and the line itself.

    Deleting any code point of a run of equal ones gives the same variant, but each place counts on its own.
    """
    size = np.array([len(x) for x in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    sums = ts.prefix_sums(ts.mix(points.astype(np.uint64) + np.uint64(1)))
    end = np.cumsum(size)
    at, owner = ts.spread(end - size, end - 1)
    spliced = ts.spliced_hashes(sums, (end - size)[owner], at, end[owner])
    return np.concatenate([spliced, ts.span_hashes(sums, end - size, end)]), np.concatenate([(at - (end - size)[owner]).astype(np.uint32), np.full(len(lines), WHOLE)]), np.concatenate([owner, np.arange(len(lines))])


def near_earlier(keys: np.ndarray, places: np.ndarray, when: np.ndarray) -> np.ndarray:
    """Which entries lie within one edit of an entry of an earlier time.

    Lines with a common variant are at most two edits apart. Verified here: with the same place deleted it is one substitution; a variant that
    is a whole line is one insertion or deletion; anything else is two edits and doesn't count.
    """
    if not len(keys):
        return np.zeros(0, bool)
    by = np.lexsort((when, places, keys))
    k, p, w = keys[by], places[by], when[by]
    new_key = np.append(True, k[1:] != k[:-1])
    new_pair = new_key | np.append(True, p[1:] != p[:-1])
    pair_first = w[np.flatnonzero(new_pair)][np.cumsum(new_pair) - 1]
    heads = np.flatnonzero(new_key)
    never = np.iinfo(np.int64).max
    first_whole = np.minimum.reduceat(np.where(p == WHOLE, w, never), heads)[np.cumsum(new_key) - 1]
    first_variant = np.minimum.reduceat(np.where(p == WHOLE, never, w), heads)[np.cumsum(new_key) - 1]
    out = np.empty(len(keys), bool)
    out[by] = (pair_first < w) | (np.where(p == WHOLE, first_variant, first_whole) < w)
    return out


def _with_tail(table: pa.Table, tail: np.ndarray) -> pa.Table:
    """Puts a 4-byte number for every key behind the keys of each shard; tail has the keys' packed order."""
    at, blobs = 0, []
    for b in table["keys"].to_pylist():
        n = len(b) // 8
        blobs.append(b + tail[at : at + n].astype("<u4").tobytes())
        at += n
    return table.set_column(3, "keys", pa.array(blobs, pa.binary()))


def _tails(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Keys, numbers and blob of every entry, and the entries of each blob."""
    sizes = [len(b) // 12 for b in blobs]
    keys, owner = rounds.unpacked([b[: 8 * n] for b, n in zip(blobs, sizes)], 8)
    return keys, np.frombuffer(b"".join(b[8 * n :] for b, n in zip(blobs, sizes)), "<u4"), owner, sizes


class _Lines:
    """The lines of a group: all of them by row, the distinct ones that aren't blank in the order of their first place, and these ones' keys."""

    def __init__(self, table: pa.Table) -> None:
        self.texts = [t or "" for t in table["text"].to_pylist()]
        self.rows, found = [], {}
        for t in self.texts:
            self.rows.append([found.setdefault(x, len(found)) if x.strip(BLANK) else -1 for x in t.split("\n")])
        self.distinct = list(found)
        self.keys = np.array([_line_key(x) for x in self.distinct], np.uint64)

    def halves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct half keys, the places among them of each line's four, and the digest of the one line with a key, or _MANY."""
        every = np.array([half_keys(x) for x in self.distinct], np.uint64).reshape(-1)
        found, inverse = np.unique(every, return_inverse=True)
        mark = np.repeat((self.keys % np.uint64(2**32 - 1)).astype(np.uint32), 4)
        least, most = np.full(len(found), 2**32 - 1, np.uint32), np.zeros(len(found), np.uint32)
        np.minimum.at(least, inverse, mark)
        np.maximum.at(most, inverse, mark)
        return found, inverse.reshape(-1, 4), np.where(least == most, least, _MANY)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 1, group_bytes: int | None = None) -> DataFrame:
    """Removes every line that is at most `edits` (1, or 0 for exact copies only) from an earlier line; an edit puts in, takes out or replaces a code point.

    Lines are parted by newlines. Earlier means a smaller doc_id, or a smaller line number in the document; nulls come first, among equal ids
    the smaller XXH64 of the text, and of equal rows all but one are later. Lines are judged on the input, not on what is left, whatever
    their length; blank lines always stay, and nothing is near them.

    A line's variants, itself and all its one-deletion strings, go as hashed keys with the place of the deletion; equal variants are
    joined, the edit distance is verified from the places, and the earliest line stays. Before that two rounds leave out
    what cannot matter: later exact copies, and lines that share no half with any other line (two lines within one edit share a
    half). Lines are compared by 64-bit hashes; a hot line or variant costs a shard one entry a group. A line of n code points makes n + 1
    variants, so long lines and texts cost no more than their length.

    Returns one row for each input row: row (struct of the columns of docs other than the text), n_lines, removed (line numbers
    from 0), kept (the other lines, joined by newlines). A null or empty text is one blank line, kept is "". An empty table gives no rows. No
    column can clash with these names, as all are inside `row`.
    """
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    groups, shards = rounds.sizes(docs, text_col, group_bytes)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    dealt = rounds.by_range(docs, id_col, text_col, groups, others)
    schema = docs.select(others.alias("row"), F.lit(0).cast("long").alias("n_lines"), F.array().cast("array<int>").alias("removed"), F.lit("").alias("kept")).schema

    def lines(g: int, table: pa.Table, _) -> pa.Table:
        mine = _Lines(table)
        exact = rounds.packed(g, LINE, np.unique(mine.keys), shards, 8)[0]
        if not edits:
            return exact
        found, _, digest = mine.halves()
        half, order = rounds.packed(g, HALF, found, shards, 8)
        return pa.concat_tables([exact, _with_tail(half, digest[order])])

    def firsts(table: pa.Table, replies: pa.Table) -> tuple[_Lines, np.ndarray, np.ndarray]:
        """The lines, which distinct ones are copies of earlier ones, and which others may have a partner within one edit."""
        mine = _Lines(table)
        found, inverse = np.unique(mine.keys, return_inverse=True)
        copy = rounds.answered(replies, LINE, rounds.packed(0, LINE, found, shards, 8)[1])[inverse] > 0
        if not edits:
            return mine, copy, np.zeros(len(copy), bool)
        halves, place, digest = mine.halves()
        shared = (digest == _MANY) | (rounds.answered(replies, HALF, rounds.packed(0, HALF, halves, shards, 8)[1]) > 0)
        return mine, copy, ~copy & shared[place].any(axis=1)

    def tried(table: pa.Table, replies: pa.Table):
        """All that firsts gives; distinct variants (hash, place), the place of each variant among them, and each one's line."""
        mine, copy, partner = firsts(table, replies)
        of = np.flatnonzero(partner)
        keys, places, owner = variants([mine.distinct[i] for i in of])
        by = np.lexsort((places, keys))
        new = np.append(True, (keys[by][1:] != keys[by][:-1]) | (places[by][1:] != places[by][:-1]))[: len(by)]
        return mine, copy, keys, places, of[owner], by, np.flatnonzero(new), np.cumsum(new) - 1

    def deleted(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        _, _, keys, places, _, by, heads, _ = tried(table, replies)
        ask, order = rounds.packed(g, VARIANT, keys[by[heads]], shards, 8)
        return _with_tail(ask, places[by[heads]][order])

    def cut(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        mine, copy, keys, places, owner, by, heads, place = tried(table, replies)
        near = near_earlier(keys, places, owner)
        near[by] |= rounds.answered(replies, VARIANT, rounds.packed(0, VARIANT, keys[by[heads]], shards, 8)[1])[place] > 0
        # at the first place here the others before it decide, at any later place the line itself is earlier
        gone = copy.copy()
        gone[owner[near]] = True
        seen = set()
        removed, kept = [], []
        for text, row in zip(mine.texts, mine.rows):
            lost = []
            for k, i in enumerate(row):
                if i >= 0:
                    if gone[i] or i in seen:
                        lost.append(k)
                    seen.add(i)
            removed.append(lost)
            out = set(lost)
            kept.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in out) if lost else text)
        return pa.table([table["row"], pa.array([len(r) for r in mine.rows], pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(kept, pa.string())], names=["row", "n_lines", "removed", "kept"])

    def shard(kind: int, blobs: list[bytes]) -> list[np.ndarray]:
        if kind == LINE:
            return rounds.earlier(blobs, 8)
        keys, tail, owner, sizes = _tails(blobs)
        if kind == HALF:
            _, inverse = np.unique(keys, return_inverse=True)
            least, most = np.full(len(keys), 2**32 - 1, np.uint32), np.zeros(len(keys), np.uint32)
            np.minimum.at(least, inverse, tail)
            np.maximum.at(most, inverse, tail)
            found = ((least != most) | (most == _MANY))[inverse]
        else:
            found = near_earlier(keys, tail, owner)
        return np.split(found, np.cumsum(sizes)[:-1])

    replies = rounds.answer(rounds.ask(dealt, None, lines), shard)
    if edits:
        replies = replies.unionByName(rounds.answer(rounds.ask(dealt, replies, deleted), shard))
    return rounds.ask(dealt, replies, cut, schema)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with the removed lines taken out of the text; a document that loses all its lines that aren't blank goes too."""
    found = line_dedup(docs, id_col, text_col, **options)
    left = found.filter((F.size("removed") == 0) | (F.trim(F.regexp_replace("kept", "[\\t-\\r]", " ")) != ""))
    return left.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; lines within one edit."""
    found = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def one_edit(a: str, b: str) -> bool:
    """Are two strings at most one edit apart? Plain comparison, for tests."""
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:])


def in_order(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, text, ...) by id, nulls first, then by the signed XXH64 of the text."""
    signed = lambda t: ((xxhash.xxh64_intdigest((t or "").encode(), 42) + 2**63) % 2**64) - 2**63
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))


def brute_force(rows: list[tuple], edits: int = 1) -> list[tuple]:
    """(doc_id, lines, lines removed, what is kept) in plain Python, for small fixtures."""
    before: set[str] = set()
    by_size: dict[int, set[str]] = {}
    out = []
    for doc_id, text in in_order(rows):
        split = (text or "").split("\n")
        kept = []
        for line in split:
            gone = False
            if line.strip(BLANK):
                gone = line in before or edits and any(one_edit(line, x) for n in (-1, 0, 1) for x in by_size.get(len(line) + n, ()))
                before.add(line)
                by_size.setdefault(len(line), set()).add(line)
            if not gone:
                kept.append(line)
        out.append((doc_id, len(split), len(split) - len(kept), "\n".join(kept)))
    return out


def digest(rows: list[tuple]) -> list[tuple]:
    return [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in rows]
