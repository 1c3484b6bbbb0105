"""Links between texts whose shingle sets are similar: banded minima name the pairs, the sets themselves decide.

Fingerprints of 64 bits do not separate a similarity of 0.8 (some ten bits) from chance in a grid of bit counts, so the
near-duplicate stage of the pipeline takes these links besides those of the grid.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import textscan as ts
from tessella.operators.graph import checkpointed, components, drop_folder, shared_folder

#: Bands of four minima: two texts of similarity 0.8 share none of them with probability 3e-5.
BANDS, BAND = 20, 4
#: Two sets are similar if they have at least 4 / 5 of their union in common.
PART, WHOLE = 4, 5
#: Rows of one shingle that are held in a task while the others pass by.
BLOCK_ROWS = 4096

_rng = np.random.default_rng(512)
_XORS = _rng.integers(0, 2**63, BANDS * BAND, dtype=np.uint64)
_FACTORS = _rng.integers(0, 2**63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Band keys (signed) of each run of shingle hashes that begins at starts."""
    low = np.empty((len(starts), BANDS * BAND), np.uint64)
    for k in range(BANDS * BAND):
        low[:, k] = np.minimum.reduceat((hashes ^ _XORS[k]) * _FACTORS[k], starts)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(starts), BANDS))
    for k in range(BAND):
        keys = ts.mix(keys * np.uint64(0x9E3779B97F4A7C15) + low[:, k * BANDS : (k + 1) * BANDS])
    return keys.view(np.int64)


def _similar(common, left, right):
    """Exact test on the sizes of two sets and of what they share."""
    return WHOLE * common >= PART * (left + right - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def run(batches):
        for batch in batches:
            both = ((np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in zip(batch["left"].to_pylist(), batch["right"].to_pylist()))
            near = [bool(_similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))) for x, y in both]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(near, pa.bool_()))
        ts.give_back()

    return pairs.join(a, "a").join(b, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _words(sets: DataFrame) -> DataFrame:
    """(node, shingle): a row for each hash of each set."""

    def run(batches):
        for batch in batches:
            blobs = batch["shingles"]
            offsets = np.concatenate([[0], np.cumsum(pc.binary_length(blobs).to_numpy())])
            for low, high in ts.chunks(offsets):
                hashes = np.frombuffer(b"".join(blobs.slice(low, high - low).to_pylist()), np.int32)
                node = np.repeat(batch["node"].to_numpy()[low:high], np.diff(offsets[low : high + 1]) // 4)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(hashes)], names=["node", "shingle"])
        ts.give_back()

    return sets.select("node", "shingles").mapInArrow(run, "node long, shingle int")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(shingle, node, m, place, short): the rarest shingles of each set of m, as far as another set holds them too.

    Sets are put in one order, by how many sets hold a shingle. The first shingle that two similar sets share leaves all they share
    behind it: it is among the first fifth of both, and among the first ninth of the smaller set (short).
    """
    words = _words(sets)
    counts = words.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = words.join(counts, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    m = F.col("m")
    first = lambda part, whole: m - F.floor((m * part + whole - 1) / whole) + 1
    ranked = ranked.join(sets.select("node", (F.octet_length("shingles") / 4).cast("long").alias("m")), "node").withColumn("alone", m - F.size("ranked"))
    shown = F.slice("ranked", F.lit(1), F.greatest(F.lit(0), first(PART, WHOLE) - F.col("alone")).cast("int"))
    rows = ranked.select("node", "m", "alone", F.posexplode(shown).alias("pos", "s"))
    place = F.col("alone") + F.col("pos")
    return rows.select("s.shingle", "node", "m", place.alias("place"), (place < first(2 * PART, PART + WHOLE)).alias("short"))


def _may_link(x: str, y: str) -> Column:
    """Can the set of row x and the larger one of row y be similar, if they share what follows the places of the rows at most?"""
    left, right = F.col(f"{x}.m"), F.col(f"{y}.m")
    behind = F.least(left - F.col(f"{x}.place"), right - F.col(f"{y}.place"))
    larger = (left < right) | (left == right) & (F.col(f"{x}.node") < F.col(f"{y}.node"))
    return larger & (F.col(f"{x}.label") != F.col(f"{y}.label")) & (behind * (PART + WHOLE) >= (left + right) * PART)


def _mixed(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    """The keys whose rows have several labels."""
    return rows.groupBy(key).agg(F.min("label").alias("low"), F.max("label").alias("high"), *more).filter("low <> high").drop("low", "high")


def _ends(met: DataFrame, x: str, y: str) -> DataFrame:
    """Each pair (a, b) of nodes once, a the lesser."""
    return met.select(F.least(f"{x}.node", f"{y}.node").alias("a"), F.greatest(f"{x}.node", f"{y}.node").alias("b")).distinct()


def _rest(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """The similar pairs of nodes with different labels, but those that others make one component of. labelled: (node, label).

    Sets meet by the shingles of their prefixes. First all meet the least of a shingle, and labels are merged; then those of
    different labels still meet each other. Rows that are short stay in blocks of BLOCK_ROWS, the others pass by each block.
    """
    own = checkpointed(sets.join(labelled, "node"))
    rows = checkpointed(_prefixes(own).join(own.select("node", "label"), "node"))
    least = _mixed(rows, "shingle", F.min(F.struct("node", "label", "m", "place")).alias("head"))
    met = rows.select("shingle", F.struct("node", "label", "m", "place").alias("own")).join(least, "shingle").filter(_may_link("own", "head") | _may_link("head", "own"))
    near = checkpointed(_verified(_ends(met, "own", "head"), own))

    ends = [own.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab"]
    merged = components(near.join(ends[0], "a").join(ends[1], "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    rows = rows.join(merged.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left").withColumn("label", F.coalesce("new", "label")).drop("new")
    rows = checkpointed(rows)
    blocks = _mixed(rows, "shingle", F.ceil(F.count_if("short") / BLOCK_ROWS).cast("int").alias("blocks")).filter("blocks > 0")
    rows = checkpointed(rows.join(blocks, "shingle"))
    short = rows.filter("short").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).alias("x")
    passing = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("y")
    pairs = passing.join(short, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.block") == F.col("y.block")) & _may_link("x", "y"))
    return near.unionByName(checkpointed(_verified(checkpointed(_ends(pairs, "x", "y")), own)))


def links(written: DataFrame, ties: DataFrame) -> DataFrame:
    """Edges (a, b) which, together with `ties`, have the components of all similar pairs that share a band, and of the ties.

    written: (node, shingles, bands), any number of rows a node, all alike. shingles: the set's sorted hashes of 32 bits (in a set of m shingles two
    agree by chance with probability m² / 2**33, which moves a similarity by 1 / m).
    First each node of a band group is compared with the group's head, the one that shares most groups with others, and components are labelled.
    Nodes of groups that still hold several labels then meet by their rarest shingles (_rest), which finds all similar pairs among them: texts
    that share a passage, and with it bands, but little else, meet nowhere. Only pairs that are in one component already are left out.
    """
    banded = written.select("node", "bands").filter("bands is not null").dropDuplicates(["node"]).select("node", F.explode("bands").alias("key"))
    banded = checkpointed(banded)
    sizes = checkpointed(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    met = checkpointed(banded.join(sizes, "key"))
    degree = checkpointed(met.groupBy("node").agg(F.sum("n").alias("degree")))
    ranked = checkpointed(met.join(degree, "node"))
    heads = checkpointed(ranked.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("h")).select("key", F.col("h.node").alias("head")))
    met = checkpointed(met.join(heads, "key").filter("node <> head"))
    pairs = checkpointed(met.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())
    spark = written.sparkSession
    folder = shared_folder(spark, "sets")
    written.select("node", "shingles").join(degree.select("node"), "node", "left_semi").dropDuplicates(["node"]).write.parquet(folder)
    sets = spark.read.parquet(folder)
    near = checkpointed(_verified(pairs, sets))

    label = checkpointed(components(ties.unionByName(near)))
    # the head has met all others; of them, a group of one label is done
    rest = checkpointed(met.filter("n > 2").select("key", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    more = _rest(rest.join(_mixed(rest, "key"), "key", "left_semi").select("node", "label").distinct(), sets)
    drop_folder(spark, folder)
    return near.unionByName(more)
