"""SimHash near-dedup (operator 9): fingerprints joined on a grid of segment bit counts, verified, and closed into components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import shingle_links
from tessella.llm import textscan as ts
from tessella.operators.graph import checkpointed, components, drop_folder, shared_folder

SEED = 42
#: Bits of a segment in the first grid; a segment's count is a digit of the cell's number.
WIDTH = 4
#: Cells of more fingerprints than these are split by the counts of finer segments.
CROWD = 64


def _shingles(column, shingle: int):
    """For bounded runs of rows: the rows that have words, where each one's shingles start, and the hashes of all shingles."""
    data, offsets = ts.text_bytes(column)
    for a, b in ts.chunks(offsets):
        low = ts.LOWER[data[offsets[a] : offsets[b]]]
        at = offsets[a : b + 1] - offsets[a]
        raw = low.tobytes()
        # one space between words, one behind each row
        flat = b" ".join(b" ".join(raw[x:y].split()) for x, y in zip(at[:-1], at[1:]))
        starts, ends, rows = ts.word_spans(low, at, ~ts.SPACE)
        size = ends - starts
        count = np.diff(rows)
        owner = np.repeat(np.arange(b - a), count)
        begin = np.cumsum(size + 1) - size - 1 + np.cumsum(count == 0)[owner]
        stop = begin + size
        per_row = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
        if not per_row.sum():
            continue
        row = np.repeat(np.arange(b - a), per_row)
        first = rows[:-1][row] + np.arange(len(row)) - (np.cumsum(per_row) - per_row)[row]
        last = np.minimum(first + shingle, rows[1:][row]) - 1
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(flat[x:y], SEED) for x, y in zip(begin[first].tolist(), stop[last].tolist())], np.uint64)
        there = np.flatnonzero(per_row)
        yield a + there, (np.cumsum(per_row) - per_row)[there], hashes


def _simhash(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of each run of hashes that begins at starts."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > np.diff(starts, append=len(hashes))[:, None], axis=1)
    return packed.reshape(-1).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3, keep: list[str] | None = None, minima: bool = False) -> DataFrame:
    """(row struct of the kept columns, mark, fingerprint) for every row; mark is a hash of the text.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; shingles are `shingle` words joined by one space,
    repeats included, hashed by XXH64 with seed 42. A text of fewer words is one shingle; without words, null
    included, the fingerprint is zero. A bit is set if more than half of the hashes have it.
    With `minima`, also node (a hash of the text's set of shingles), shingles (the set's sorted hashes of 32 bits) and the band keys of
    shingle_links, the last two null for a text without words.
    """
    kept = docs.columns if keep is None else keep
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.xxhash64(text).alias("mark"), text.alias("text"))
    schema = source.drop("text").withColumn("fingerprint", F.lit(0).cast("long"))
    if minima:
        schema = schema.withColumns({"node": F.lit(0).cast("long"), "shingles": F.lit(None).cast("binary"), "bands": F.lit(None).cast("array<long>")})
    schema = schema.schema

    def run(batches):
        for batch in batches:
            _, offsets = ts.text_bytes(batch["text"])
            for a, b in ts.chunks(offsets):
                yield one(batch.slice(a, b - a))
        ts.give_back()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.zeros(len(batch), np.uint64)
        nodes, sets, bands = np.zeros(len(batch), np.uint64), [None] * len(batch), [None] * len(batch)
        for rows, starts, hashes in _shingles(batch["text"], shingle):
            prints[rows] = _simhash(hashes, starts)
            if minima:
                for i, own, keys in zip(rows.tolist(), np.split(hashes, starts[1:]), shingle_links.minima(hashes, starts)):
                    distinct = np.unique(own)
                    nodes[i] = xxhash.xxh64_intdigest(distinct.tobytes(), SEED)
                    sets[i], bands[i] = np.unique((distinct >> np.uint64(32)).astype(np.uint32)).tobytes(), keys
        arrays = [batch["row"], batch["mark"], pa.array(prints.view(np.int64))]
        if minima:
            arrays += [pa.array(nodes.view(np.int64)), pa.array(sets, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def _cells(f: Column, width: int) -> Column:
    """The cell of a fingerprint, its bit counts in segments of `width` bits, and all cells at Manhattan distance one."""
    if width == 1:
        # a count of one bit is the bit itself: the cell is the fingerprint, its neighbours are one flip away
        return F.array(f, *[f.bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), k)) for k in range(64)])
    count = lambda s: F.bit_count(F.shiftrightunsigned(f, width * s).bitwiseAND(F.lit(2**width - 1)))
    base = F.lit(0).cast("long")
    for s in range(64 // width):
        base = base + count(s).cast("long") * F.lit((width + 1) ** s)
    near = [base]
    for s in range(64 // width):
        near += [F.when(count(s) > 0, base - F.lit((width + 1) ** s)), F.when(count(s) < width, base + F.lit((width + 1) ** s))]
    return F.array_compact(F.array(*near))


def links(prints: DataFrame, column: str = "fingerprint", crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints that differ in two bits or fewer.

    Two fingerprints within two bits have bit counts within Manhattan distance two, in segments of any width, so both are within one of a common
    cell of the grid: each is sent to its cell and the neighbours, and fingerprints that share a cell are verified exactly. Cells
    of more than `crowd` are split by the counts of segments of one bit. There sharing a cell is being within two
    bits, so each is linked to the least sharer, and a large group makes no more edges than 65 a member.
    """
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the few bytes of the fingerprints make many cells: they are dealt evenly before that
    distinct = checkpointed(prints.select(F.col(column).alias("f")).distinct().repartition(partitions, "f"))
    sent = distinct.select("f", F.explode(_cells(F.col("f"), WIDTH)).alias("cell"))
    sizes = sent.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = checkpointed(sent.join(sizes, "cell"))
    small = met.filter(F.col("n") <= crowd).select("cell", "f")
    pairs = small.select("cell", F.col("f").alias("a")).join(small.select("cell", F.col("f").alias("b")), "cell").filter("a < b and bit_count(a ^ b) <= 2").select("a", "b").distinct()
    fine = met.filter(F.col("n") > crowd).select("f").distinct().repartition(partitions, "f").select("f", F.explode(_cells(F.col("f"), 1)).alias("cell"))
    least = fine.groupBy("cell").agg(F.min("f").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = fine.join(least, "cell").filter("f <> a").select("a", F.col("f").alias("b")).distinct()
    return pairs.unionByName(stars)


def classes(prints: DataFrame, order: Column, edges: DataFrame | None = None, column: str = "fingerprint") -> DataFrame:
    """(column, least order value of its component). edges: (a, b) between values of the column; by default those of the fingerprints."""
    least = prints.groupBy(column).agg(F.min(order).alias("least"))
    label = components(links(prints) if edges is None else edges)
    joined = least.join(label.select(F.col("node").alias("__node"), "label"), F.col(column) == F.col("__node"), "left").select(column, "least", F.coalesce("label", column).alias("label"))
    best = joined.groupBy("label").agg(F.min("least").alias("least"))
    return joined.select(column, "label").join(best, "label").select(column, "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row for each input row: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links).

    Null ids take part, but are no one's component id unless the whole component has null ids only. Repeated rows have one
    fingerprint and one component. An empty table gives no rows. Extra columns are ignored.
    """
    prints = fingerprints(docs, text_col, shingle, [id_col]).select(F.col(f"row.{id_col}").cast("long").alias("doc_id"), "fingerprint")
    prints = checkpointed(prints)
    found = classes(prints, F.col("doc_id"))
    return prints.join(found, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """The rows of docs without near-duplicates of others: of each component the row of the least doc_id stays.

    Documents are linked if their fingerprints differ in two bits or fewer, or if their shingle sets share a band of minima and
    have a similarity of 0.8 or more (shingle_links). Each distinct set is a node, tied to the others with its fingerprint.
    Nulls come last; among equal ids the smaller hash of the text stays, and of rows equal in both any one, so one row of a component
    stays in any case. Texts without words count as copies of each other; an empty table gives no rows. All columns are returned; none of their
    names can clash, as they travel inside a struct.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    id_ = F.col(f"`{id_col}`")
    # an id as a key without nulls, so that rows meet it by plain equality
    key = F.when(id_.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), id_.cast("string")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_.alias("id"), key.alias("key"), F.xxhash64(text).alias("mark"), text.alias("text"))
    table = shared_folder(spark, "shingles")
    fingerprints(rows.select("id", "key", "text"), "text", shingle, ["id", "key"], minima=True).select("row.id", "row.key", "mark", "fingerprint", "node", "shingles", "bands").write.parquet(table)
    written = spark.read.parquet(table)
    prints = written.select("id", "key", "mark", "fingerprint", "node")
    # the least node of each fingerprint stands for it
    first = checkpointed(prints.groupBy("fingerprint").agg(F.min("node").alias("a")))
    ties = checkpointed(prints.select("fingerprint", "node").distinct()).join(first, "fingerprint").select("a", F.col("node").alias("b")).filter("a <> b")
    ends = [first.select(F.col("fingerprint").alias(x), F.col("a").alias(f"n{x}")) for x in "ab"]
    bits = links(prints).join(ends[0], "a").join(ends[1], "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    ties = checkpointed(ties.unionByName(bits))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"), F.col("mark"))
    found = classes(prints, order, ties.unionByName(shingle_links.links(written.select("node", "shingles", "bands"), ties)), "node")
    kept = checkpointed(found.select(F.col("least.key").alias("key"), F.col("least.mark").alias("mark")).distinct())
    drop_folder(spark, table)
    # repeated rows combine before the shuffle
    single = rows.groupBy("key", "mark").agg(F.first("row").alias("row"))
    return single.join(kept, ["key", "mark"], "left_semi").select("row.*")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shingles of three words, two bits."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3)


def brute_force(rows: list[tuple], shingle: int = 3, similarity: float | None = None) -> list[tuple]:
    """The same result in plain Python, for small fixtures; with `similarity`, sets of shingles of that similarity or more are linked too."""
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    prints, sets = [], []
    for _, text in rows:
        w = (text or "").encode().translate(lower).split()
        parts = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        sets.append(set(parts))
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints.append(sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)))
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    array = np.array(prints, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 2):
            parent[root(i)] = root(int(i + 1 + j))
        for j in range(i + 1, len(rows) if similarity else 0):
            if len(sets[i] & sets[j]) >= similarity * max(1, len(sets[i] | sets[j])):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, f"{p:016x}", least[root(i)]) for i, ((doc_id, _), p) in enumerate(zip(rows, prints))]
