"""Voxel tables: one row for each voxel that isn't zero. Absent voxels are zeros, so volumes come from a table of dimensions."""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.rounding import saturate
from tessella.operators.blocks import PLACE, Block, by_block
from tessella.operators.graph import checkpointed, components
from tessella.operators.nearest import nearest

CHANNEL = ["fov", "round_no", "channel"]
#: The greatest number of a pixel type.
TOP = {"uint8": 255, "uint16": 65535}
SKIPPED_ROUND = 11
#: Frequencies of a slice that go together to the transform along z.
FREQUENCIES = 4096


def level_counts(voxels: DataFrame, dims: DataFrame, keys: list[str] = CHANNEL) -> DataFrame:
    """(keys, value, n, upto): the histogram of every channel with its zeros, and how many voxels have at most that value.

    dims: fov, volume. There are at most 65 536 levels a channel, so the running sum is over a bounded list.
    """
    seen = voxels.filter("value > 0").groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    total = seen.groupBy(*keys).agg(F.sum("n").alias("n")).join(dims, "fov")
    zeros = total.select(*keys, F.lit(0).alias("value"), (F.col("volume") - F.col("n")).alias("n")).filter("n > 0")
    levels = seen.select(*keys, "value", "n").unionByName(zeros)
    return levels.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("value")))


def _at_rank(levels: DataFrame, keys: list[str], rank: Column, name: str) -> DataFrame:
    """The value at a (whole) rank, from 1, of every channel. levels carries the column that rank uses."""
    return levels.filter((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)).select(*keys, F.col("value").alias(name))


def percentile_bounds(levels: DataFrame, percent: float, name: str, keys: list[str] = CHANNEL, midpoint: bool = False) -> DataFrame:
    """The percentile of every channel, by exact ranks.

    Ranks lie at 100 (k - 0.5) / n with linear steps between and cut ends; with midpoint it is the mean of the two ranks around p (n - 1) / 100.
    """
    counted = levels.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    n = F.col("total")
    rank = F.lit(percent) * (n - 1) / 100 + 1 if midpoint else F.greatest(F.lit(1.0), F.least(n.cast("double"), F.lit(percent) * n / 100 + 0.5))
    both = _at_rank(counted.withColumn("r", F.floor(rank)), keys, F.col("r"), "low").join(_at_rank(counted.withColumn("r", F.ceil(rank)), keys, F.col("r"), "high"), keys)
    if midpoint:
        return both.select(*keys, ((F.col("low") + F.col("high")) / 2).alias(name))
    share = counted.select(*keys, (rank - F.floor(rank)).alias("share")).distinct()
    return both.join(share, keys).select(*keys, (F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias(name))


def percentile_normalize(voxels: DataFrame, dims: DataFrame, dtype: str = "uint8", low: float = 0, high: float = 100) -> DataFrame:
    """Values between two percentiles of their channel as 0..top; a flat channel becomes 0. Zeros count."""
    levels = level_counts(voxels, dims)
    ends = percentile_bounds(levels, low, "lo").join(percentile_bounds(levels, high, "hi"), CHANNEL)
    span = F.col("hi") - F.col("lo")
    share = F.when(span > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("value") - F.col("lo")) / span))).otherwise(0.0)
    return voxels.join(ends, CHANNEL).withColumn("value", saturate(share * TOP[dtype], 0, TOP[dtype])).drop("lo", "hi")


def percentile_normalize_mid(pixels: DataFrame, dims: DataFrame, low: float = 1, high: float = 99.8) -> DataFrame:
    """As percentile_normalize, with the midpoint rule, unclipped, as a double."""
    levels = level_counts(pixels, dims)
    ends = percentile_bounds(levels, low, "lo", midpoint=True).join(percentile_bounds(levels, high, "hi", midpoint=True), CHANNEL)
    return pixels.join(ends, CHANNEL).withColumn("value", F.when(F.col("hi") > F.col("lo"), (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)).drop("lo", "hi")


def minmax_normalize(voxels: DataFrame, dims: DataFrame, dtype: str = "uint8") -> DataFrame:
    """Least to greatest of a channel as 0..top; a flat channel is 0. The least is 0 if any voxel is absent."""
    ends = voxels.groupBy(*CHANNEL).agg(F.min("value").alias("least"), F.max("value").alias("hi"), F.count_if(F.col("value") >= 0).alias("n")).join(dims, "fov")
    ends = ends.select(*CHANNEL, "hi", F.when(F.col("n") < F.col("volume"), F.least(F.lit(0), F.col("least"))).otherwise(F.col("least")).alias("lo"))
    span = F.col("hi") - F.col("lo")
    return voxels.join(ends, CHANNEL).withColumn("value", F.when(span > 0, saturate((F.col("value") - F.col("lo")) / span * TOP[dtype], 0, TOP[dtype])).otherwise(0)).drop("lo", "hi")


def fixed_normalize(voxels: DataFrame, low: float, high: float, dtype: str = "uint8") -> DataFrame:
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("value") - F.lit(low)) / (high - low)))
    return voxels.withColumn("value", saturate(share * TOP[dtype], 0, TOP[dtype]))


def hist_match(voxels: DataFrame, dims: DataFrame, by: str = "intra_round", reference: int = 1) -> DataFrame:
    """Values mapped to the first level of the reference whose share of voxels at or below it is no smaller.

    'intra_round' matches the channels of a round to a reference channel, and leaves the last channel alone if there are four; 'inter_round' the rounds of a channel to a
    reference round. Round 11 stays. Matching is by discrete distribution functions; both histograms have at most 65 536 levels.
    """
    same, other = (["fov", "round_no"], "channel") if by == "intra_round" else (["fov", "channel"], "round_no")
    levels = checkpointed(level_counts(voxels, dims).join(dims, "fov").select(*CHANNEL, "value", (F.col("upto") / F.col("volume")).alias("share")))
    # both lists of a channel in falling order of shares, the reference's first where they are equal: the last reference level so far is the first that is no smaller
    target = levels.filter(F.col(other) == reference).select(*same, F.col("value").alias("level"), "share").join(levels.select(*CHANNEL).distinct(), same)
    both = levels.select(*CHANNEL, "share", "value", F.lit(None).cast("int").alias("level"), F.lit(1).alias("rank")).unionByName(target.select(*CHANNEL, "share", F.lit(None).cast("int").alias("value"), "level", F.lit(0).alias("rank")))
    before = Window.partitionBy(*CHANNEL).orderBy(F.desc("share"), "rank", F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    mapped = both.withColumn("new", F.last("level", ignorenulls=True).over(before)).filter("value is not null").select(*CHANNEL, "value", "new")
    fixed = F.col("round_no") == SKIPPED_ROUND
    if by == "intra_round":
        fixed = fixed | (F.col("channel") == 4)
    return voxels.join(mapped, [*CHANNEL, "value"], "left").withColumn("value", F.when(fixed | F.col("new").isNull(), F.col("value")).otherwise(F.col("new"))).drop("new")


def swap_channels(voxels: DataFrame, a: int, b: int) -> DataFrame:
    return voxels.withColumn("channel", F.when(F.col("channel") == a, b).when(F.col("channel") == b, a).otherwise(F.col("channel")).cast("int"))


def merge_channels(voxels: DataFrame, how: str = "max", n_channels: int = 3) -> DataFrame:
    """One value a voxel of a round: the greatest over the spot channels, or their sum over four, rounded down. Channel 4 is the nuclei's."""
    spots = voxels.filter("channel < 4") if n_channels == 4 else voxels
    value = F.max("value") if how == "max" else F.floor(F.sum("value") / 4).cast("int")
    return spots.groupBy("fov", "round_no", *PLACE).agg(value.alias("value"))


def max_project(voxels: DataFrame, keys: list[str] = CHANNEL) -> DataFrame:
    return voxels.groupBy(*keys, "y", "x").agg(F.max("value").alias("value"))


def middle_slice(voxels: DataFrame, depth: int) -> DataFrame:
    return voxels.filter(F.col("z") == depth // 2 + 1)


def binarize(voxels: DataFrame, threshold: float) -> DataFrame:
    return voxels.filter(F.col("value") > threshold)


def sample_grid_nearest(mask: DataFrame, spots: DataFrame, every: int, reach: int) -> DataFrame:
    """Mask pixels on a grid (coordinates from 0) with the value of the nearest spot within reach, the smaller spot_id on a tie; null without one."""
    grid = mask.filter((F.col("x") % every == 0) & (F.col("y") % every == 0)).select("fov", "x", "y").distinct()
    return nearest(grid, spots.select("fov", "spot_id", "x", "y", "value"), ["fov"], [], reach, ["value"], ["spot_id"], strict=False)


def estimate_shift(merged: DataFrame, reference: int, nx: int, ny: int, nz: int) -> DataFrame:
    """(fov, round_no, dx, dy, dz, score): the shift with the greatest circular cross-correlation with the reference round, over all shifts of the volume.

    Shifts beyond half the volume count backwards; ties go to the first in column-major order of (y, x, z). Sums are exact up to 2**50. A
    field without the reference round correlates with nothing: shift 0, score 0.

    The three-dimensional transform goes over two exchanges: slices are transformed in one group each and cut into blocks of frequencies; a block's slices of
    all rounds meet for the transform along z, the product and the way back; then each slice of the correlation is put together again, and has one
    best place. No group holds more than a slice, or a block of FREQUENCIES over all slices and rounds.
    """
    kinds = dict(merged.dtypes)
    keys = f"fov {kinds['fov']}, round_no {kinds['round_no']}"
    columns = ny // 2 + 1

    def cut(fov, round_no, z: int, plane: np.ndarray) -> pa.Table:
        parts = [plane[a : a + FREQUENCIES].tobytes() for a in range(0, len(plane), FREQUENCIES)]
        n = len(parts)
        return pa.table({"fov": pa.array([fov.as_py()] * n, fov.type), "round_no": pa.array([round_no.as_py()] * n, round_no.type), "z": pa.array([z] * n, pa.int32()), "block": pa.array(np.arange(n, dtype=np.int32)), "part": pa.array(parts, pa.binary())})

    def spectrum(table: pa.Table) -> pa.Table:
        plane = np.zeros((nx, ny))
        plane[table["x"].to_numpy() - 1, table["y"].to_numpy() - 1] = table["value"].to_numpy()
        return cut(table["fov"][0], table["round_no"][0], table["z"][0].as_py() - 1, np.fft.rfft2(plane).ravel())

    def product(table: pa.Table) -> pa.Table:
        numbers, z, parts = table["round_no"].to_numpy(), table["z"].to_numpy(), table["part"]
        size = len(parts[0].as_py()) // 16

        def along_z(number) -> np.ndarray:
            volume = np.zeros((nz, size), np.complex128)
            for i in np.flatnonzero(numbers == number):
                volume[z[i]] = np.frombuffer(parts[int(i)].as_buffer(), np.complex128)
            return np.fft.fft(volume, axis=0)

        fixed, others = along_z(reference), [k for k in np.unique(numbers) if k != reference]
        back = [np.fft.ifft(fixed * np.conj(along_z(k)), axis=0) for k in others]
        rounds = pa.array(np.repeat(np.array(others, numbers.dtype), nz)).cast(table.schema.field("round_no").type)
        n = len(rounds)
        return pa.table({"fov": pa.array([table["fov"][0].as_py()] * n, table.schema.field("fov").type), "round_no": rounds, "z": pa.array(np.tile(np.arange(nz, dtype=np.int32), len(others))), "block": pa.array([table["block"][0].as_py()] * n, pa.int32()), "part": pa.array([row.tobytes() for b in back for row in b], pa.binary())})

    def best(table: pa.Table) -> pa.Table:
        parts = table.sort_by("block")["part"]
        plane = np.concatenate([np.frombuffer(p.as_buffer(), np.complex128) for p in parts]).reshape(nx, columns)
        score = np.rint(np.fft.irfft2(plane, (nx, ny))).ravel()
        k = int(score.argmax())
        return pa.table({"fov": table["fov"][:1], "round_no": table["round_no"][:1], "z": table["z"][:1], "at": pa.array([k], pa.int64()), "score": pa.array([int(score[k])], pa.int64())})

    spectra = merged.select("fov", "round_no", *PLACE, "value").groupBy("fov", "round_no", "z").applyInArrow(spectrum, f"{keys}, z int, block int, part binary")
    correlated = spectra.groupBy("fov", "block").applyInArrow(product, f"{keys}, z int, block int, part binary")
    tops = correlated.groupBy("fov", "round_no", "z").applyInArrow(best, f"{keys}, z int, at long, score long")
    top = tops.groupBy("fov", "round_no").agg(F.max(F.struct("score", -F.col("z"), -F.col("at"))).alias("t")).select("fov", "round_no", "t.score", (-F.col("t.col2")).alias("z"), (-F.col("t.col3")).alias("at"))
    back = lambda c, n: F.when(c > n // 2, c - n).otherwise(c).cast("int")
    return top.select("fov", "round_no", back(F.floor(F.col("at") / ny), nx).alias("dx"), back(F.col("at") % ny, ny).alias("dy"), back(F.col("z"), nz).alias("dz"), "score")


def apply_shift(voxels: DataFrame, shifts: DataFrame, nx: int, ny: int, nz: int, flat: bool = False) -> DataFrame:
    """Voxels moved by their round's shift, without wrapping. A positive shift s blanks s lines, a negative one |s| + 1; with flat (2-D) also a zero shift blanks the last line."""
    moved = voxels.join(shifts.select("fov", "round_no", "dx", "dy", "dz"), ["fov", "round_no"])
    for c, n in (("x", nx), ("y", ny), ("z", nz)):
        d = F.col(f"d{c}")
        moved = moved.withColumn(c, F.col(c) + d)
        last = F.when(d < 0, n + d - 1).when((d == 0) & F.lit(flat and c != "z"), n - 1).otherwise(n)
        moved = moved.filter(F.col(c).between(F.greatest(F.lit(1), d + 1), last))
    return moved.drop("dx", "dy", "dz")


def _half_offsets(connectivity: int) -> list[tuple[int, int, int]]:
    """One of each pair of opposite neighbours (dz, dy, dx): 13 for 26 neighbours, 4 for the 8 of a plane."""
    zs = (-1, 0, 1) if connectivity == 26 else (0,)
    return [o for o in product(zs, (-1, 0, 1), (-1, 0, 1)) if o > (0, 0, 0)]


def neighbours(connectivity: int) -> list[tuple[int, int, int]]:
    """All neighbours (dz, dy, dx): 26, or the 8 of a plane."""
    half = _half_offsets(connectivity)
    return half + [tuple(-c for c in o) for o in half]


def number(z, y, x):
    """A place as one number of 63 bits."""
    return (z << 42) | (y << 21) | x


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of 0..n-1 that each one is joined to by the edges (a, b): lesser labels spread over edges and jump to their labels' labels."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for ends in (label[a], label[b]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _labelled(table: pa.Table, columns: list[str], connectivity: int, same: str | None) -> dict[str, object]:
    """The inner voxels of a block with `local`, the least voxel number of their object inside the block, and `far`, the touching voxels beyond it."""
    block = Block(table, 1)
    numbers = number(*(table[c].to_numpy().astype(np.int64) for c in PLACE))
    table, numbers = table.take(pa.array(by := np.argsort(numbers))), numbers[by]
    index = tuple(i[by] for i in block.index)
    alike = table[same].to_numpy() if same else None
    # rows from 1 by their place, in the order of their numbers
    row = np.zeros(block.shape, np.int64)
    row[index] = np.arange(1, len(table) + 1)
    inner = block.inner()[index]
    rows = np.flatnonzero(inner)
    at = tuple(i[rows] for i in index)
    own, next_ = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for o in neighbours(connectivity):
        near = row[tuple(i + c for i, c in zip(at, o))] - 1
        k = np.flatnonzero(near >= 0)
        if same:
            k = k[alike[rows[k]] == alike[near[k]]]
        own.append(k)
        next_.append(near[k])
    own, next_ = np.concatenate(own), np.concatenate(next_)
    # of each pair inside, one direction is enough
    inside = inner[next_]
    once = inside & (next_ > rows[own])
    label = _least(len(table), rows[own[once]], next_[once])[rows]
    owner, beyond = own[~inside], numbers[next_[~inside]]
    order = np.argsort(owner, kind="stable")
    far = pa.ListArray.from_arrays(np.searchsorted(owner[order], np.arange(len(rows) + 1)).astype(np.int32), beyond[order])
    mine = table.take(pa.array(rows))
    return {c: mine[c].combine_chunks() for c in columns} | {"local": numbers[label], "far": far}


def connected_components(voxels: DataFrame, keys: list[str], connectivity: int = 26, same: str | None = None) -> DataFrame:
    """Adds component, the keys and least voxel number of the object that a voxel belongs to; voxels with other keys, or another value of `same`, never touch.

    Objects are labelled inside blocks; only the parts that touch across blocks go through a graph. Parts go by their keys and least
    place, never by a hash.
    """
    columns = [c for c in voxels.columns if c not in keys]
    kinds = {c: t for c, t in voxels.dtypes if c in columns}
    found = by_block(voxels, keys, [c for c in columns if c not in PLACE], 1, lambda t: _labelled(t, columns, connectivity, same), kinds | {"local": "long", "far": "array<long>"})
    labelled = checkpointed(found)
    node = F.struct(*keys, F.col("local").alias("place"))
    cross = labelled.filter("size(far) > 0")
    if cross.isEmpty():
        return labelled.select(*voxels.columns, node.alias("component"))
    place = F.shiftleft(F.col("z").cast("long"), 42).bitwiseOR(F.shiftleft(F.col("y").cast("long"), 21)).bitwiseOR(F.col("x").cast("long"))
    ends = cross.select(*keys, node.alias("b"), place.alias("at"))
    edges = cross.select(*keys, node.alias("a"), F.explode("far").alias("at")).join(ends, [*keys, "at"]).select("a", "b")
    label = components(edges)
    joined = labelled.withColumn("node", node).join(label, "node", "left")
    return joined.select(*voxels.columns, F.coalesce("label", "node").alias("component"))


def filter_objects(voxels: DataFrame, keys: list[str], low: int, high: int, connectivity: int = 26) -> DataFrame:
    """Voxels of objects of low..high voxels, with their values."""
    labelled = checkpointed(connected_components(voxels, keys, connectivity))
    sizes = labelled.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(low, high))
    return labelled.join(sizes.select(*keys, "component"), [*keys, "component"], "left_semi")


def otsu(levels: DataFrame, keys: list[str] = CHANNEL) -> DataFrame:
    """(keys, threshold): the level that best parts a histogram in two, from level_counts; the first on a tie."""
    w = Window.partitionBy(*keys)
    run = levels.withColumns({"total": F.sum("n").over(w), "mass": F.sum(F.col("n") * F.col("value")).over(w), "below": F.sum(F.col("n") * F.col("value")).over(w.orderBy("value"))})
    p = F.col("upto") / F.col("total")
    between = (F.col("mass") / F.col("total") * p - F.col("below") / F.col("total")) ** 2 / (p * (1 - p))
    return run.filter("upto < total").groupBy(*keys).agg(F.max_by("value", F.struct(between, -F.col("value"))).alias("threshold"))


def log_kernel(size: tuple[int, ...], sigma: float) -> list[tuple[tuple[int, ...], float]]:
    """A Laplacian-of-Gaussian kernel: weights by offset, summing to zero. size and offsets are in the order (y, x) or (y, x, z)."""
    at = list(product(*[range(-(n // 2), n // 2 + 1) for n in size]))
    g = [math.exp(-sum(a * a for a in o) / (2 * sigma**2)) for o in at]
    total = sum(g)
    w = [v / total * (sum(a * a for a in o) - len(size) * sigma**2) / sigma**4 for v, o in zip(g, at)]
    mean = sum(w) / len(w)
    return [(o, v - mean) for o, v in zip(at, w)]


def gauss_kernel(size: tuple[int, ...], sigma: float) -> list[tuple[tuple[int, ...], float]]:
    at = list(product(*[range(-(n // 2), n // 2 + 1) for n in size]))
    g = [math.exp(-sum(a * a for a in o) / (2 * sigma**2)) for o in at]
    return [(o, v / sum(g)) for o, v in zip(at, g)]


def convolve(voxels: DataFrame, kernel: list[tuple[tuple[int, ...], float]], nx: int, ny: int, nz: int, edge: str = "replicate", keys: list[str] = CHANNEL) -> DataFrame:
    """Correlation with a small kernel, as rows (keys, z, y, x, response) wherever a voxel that isn't zero is in reach.

    Each block with a halo of the kernel's reach is convolved as an array; at a replicated edge a border voxel also stands for those beyond it.
    """
    full = [((o[2] if len(o) == 3 else 0, o[0], o[1]), w) for o, w in kernel]
    halo = max(abs(c) for o, _ in full for c in o)
    last = dict(zip(PLACE, (nz, ny, nx)))

    def filtered(table: pa.Table) -> dict[str, np.ndarray]:
        block = Block(table, halo, (1, nz))
        values, there = block.dense(table["value"].to_numpy().astype(np.float64)), block.there
        if edge == "replicate":
            for axis, c in enumerate(PLACE):
                at = np.arange(block.shape[axis]) + block.first[axis] - halo
                clamped = np.clip(np.clip(at, 1, last[c]) - block.first[axis] + halo, 0, block.shape[axis] - 1)
                values, there = np.take(values, clamped, axis), np.take(there, clamped, axis)
        inner = tuple(n - 2 * halo for n in block.shape)
        response, reached, part = np.zeros(inner), np.zeros(inner, bool), np.empty(inner)
        for o, w in full:
            response += np.multiply(block.around(values, o), w, out=part)
            reached |= block.around(there, o)
        at = np.nonzero(reached)
        places = block.places(tuple(i + halo for i in at))
        keep = np.all([(places[c] >= 1) & (places[c] <= last[c]) for c in PLACE], axis=0)
        return {c: p[keep] for c, p in places.items()} | {"response": response[at][keep]}

    return by_block(voxels, keys, ["value"], halo, filtered, {"z": "int", "y": "int", "x": "int", "response": "double"})


def label_stats(labels: DataFrame) -> DataFrame:
    return labels.filter("label > 0").groupBy("fov", "label").agg(F.count(F.lit(1)).alias("area"), F.avg("y").alias("cy"), F.avg("x").alias("cx"))


def filter_labels(labels: DataFrame, least: int) -> DataFrame:
    """Labels of at least so many pixels."""
    return labels.join(label_stats(labels).filter(F.col("area") >= least).select("fov", "label"), ["fov", "label"], "left_semi")


def reduction(labels: DataFrame, least: int) -> DataFrame:
    """Per fov: labels and area before and after filter_labels, and the per cent of area that goes."""
    s = label_stats(labels)
    big = F.col("area") >= least
    rows = s.groupBy("fov").agg(F.count(F.lit(1)).alias("raw_cells"), F.sum("area").alias("raw_area"), F.count_if(big).alias("cells"), F.coalesce(F.sum(F.when(big, F.col("area"))), F.lit(0)).alias("area"))
    return rows.withColumn("reduction", (1 - F.col("area") / F.col("raw_area")) * 100)
