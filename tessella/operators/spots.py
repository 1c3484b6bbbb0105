"""Spot finding and intensity extraction on voxel tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.rounding import saturate
from tessella.operators.blocks import Block, by_block, in_groups
from tessella.operators.graph import checkpointed
from tessella.operators.nearest import block_of, blocks_near, pairs_of
from tessella.operators.voxels import CHANNEL, PLACE, TOP, connected_components, convolve, log_kernel, neighbours

_LEAST = np.iinfo(np.int64).min


def _highest(block: Block, values: np.ndarray, connectivity: int) -> tuple[np.ndarray, np.ndarray]:
    """At the places of a block that are no halo: the greatest of the neighbours' values, and where there is a neighbour."""
    inner = tuple(n - 2 * block.halo for n in block.shape)
    most, near = np.full(inner, _LEAST), np.zeros(inner, bool)
    filled = np.where(block.there, values, _LEAST)
    for o in neighbours(connectivity):
        np.maximum(most, block.around(filled, o), out=most)
        near |= block.around(block.there, o)
    return most, near


def around_max(voxels: DataFrame, keys: list[str], connectivity: int = 26, value: str = "value") -> DataFrame:
    """The voxels (keys, z, y, x, value) with `around`, the greatest value next to each; null if it has no neighbour."""

    def highest(table: pa.Table) -> dict[str, np.ndarray]:
        block = Block(table, 1)
        values = block.dense(table[value].to_numpy().astype(np.int64))
        most, near = _highest(block, values, connectivity)
        at = np.nonzero(block.around(block.there, (0, 0, 0)))
        return block.places(tuple(i + 1 for i in at)) | {value: block.around(values, (0, 0, 0))[at], "around": np.ma.array(most[at], mask=~near[at])}

    return by_block(voxels, keys, [value], 1, highest, {"z": "int", "y": "int", "x": "int", value: "long", "around": "long"})


def _candidates(voxels: DataFrame, keys: list[str], connectivity: int) -> DataFrame:
    """The voxels (keys, z, y, x, value) that are alone with their value and have no greater neighbour (`flat` false), or have an equal neighbour (`flat` true), with
    `beaten`: is a neighbour greater? All others are no maxima, and part no plateau either."""

    def chosen(table: pa.Table) -> dict[str, np.ndarray]:
        block = Block(table, 1)
        values = block.dense(table["value"].to_numpy().astype(np.int64))
        most, near = _highest(block, values, connectivity)
        own, here = block.around(values, (0, 0, 0)), block.around(block.there, (0, 0, 0))
        flat = np.zeros(own.shape, bool)
        for o in neighbours(connectivity):
            flat |= (block.around(values, o) == own) & block.around(block.there, o)
        beaten = near & (most > own)
        at = np.nonzero(here & (flat | ~beaten))
        return block.places(tuple(i + 1 for i in at)) | {"value": own[at], "flat": flat[at], "beaten": beaten[at]}

    return by_block(voxels, keys, ["value"], 1, chosen, {"z": "int", "y": "int", "x": "int", "value": "long", "flat": "boolean", "beaten": "boolean"})


def regional_maxima(voxels: DataFrame, keys: list[str] = CHANNEL, connectivity: int = 26) -> DataFrame:
    """Voxels of plateaus without a greater neighbour, with the plateau's component. Only voxels that aren't zero can be one if any voxel is greater than zero."""
    cells = checkpointed(_candidates(voxels, keys, connectivity))
    # a plateau has several voxels only where a neighbour is as great; the others are decided alone
    alone = cells.filter("not flat").select(*keys, *PLACE, "value")
    joined = checkpointed(connected_components(cells.filter("flat").drop("flat"), keys, connectivity, "value"))
    good = joined.groupBy("component").agg(F.max("beaten").alias("lost")).filter("not lost").select("component")
    return joined.join(good, "component", "left_semi").select(*keys, *PLACE, "value").unionByName(alone)


def _centroids(members: DataFrame, keys: list[str]) -> DataFrame:
    """Rounded centroid and size of every component."""
    middle = lambda c: saturate(F.avg(c), -32768, 32767).alias(c)
    return members.groupBy(*keys, "component").agg(middle("x"), middle("y"), middle("z"), F.count(F.lit(1)).alias("volume"))


def find_spots_max3d(voxels: DataFrame, reference: int = 1, threshold: float = 0.1, dtype: str = "uint8") -> DataFrame:
    """Regional maxima of the reference round above the threshold, channels 1 to 3: fov, x, y, z, intensity (at the centroid), addition, channel.

    addition is threshold * 255 whatever the pixel type.
    """
    mine = voxels.filter((F.col("round_no") == reference) & (F.col("channel") <= 3))
    tops = regional_maxima(mine).filter(F.col("value") > threshold * TOP[dtype])
    spots = _centroids(connected_components(tops, CHANNEL), CHANNEL)
    at = spots.join(mine.select(*CHANNEL, *PLACE, "value"), [*CHANNEL, *PLACE], "left")
    return at.select("fov", "x", "y", "z", F.coalesce("value", F.lit(0)).alias("intensity"), F.lit(threshold * 255.0).alias("addition"), "channel")


def find_spots_log3d(voxels: DataFrame, dims: DataFrame, reference: int = 1, threshold: float = 0.1, dtype: str = "uint8", size: tuple = (5, 5, 3), sigma: float = 1.0) -> DataFrame:
    """Regional minima of the Laplacian-of-Gaussian response where the raw value is above the threshold. All volumes have the dimensions of dims' one kind."""
    d = dims.select("nx", "ny", "nz").distinct().first()
    mine = voxels.filter((F.col("round_no") == reference) & (F.col("channel") <= 3))
    response = convolve(mine, log_kernel(size, sigma), d["nx"], d["ny"], d["nz"])
    # minima as maxima of the negated response on a fixed grid of 1e-6; places out of reach of any voxel respond with 0
    level = response.select(*CHANNEL, *PLACE, F.round(-F.col("response") * 1e6).cast("long").alias("value"))
    tops = regional_maxima(level).join(mine.select(*CHANNEL, *PLACE, F.col("value").alias("raw")), [*CHANNEL, *PLACE]).filter(F.col("raw") > threshold * TOP[dtype])
    spots = _centroids(connected_components(tops.drop("value"), CHANNEL), CHANNEL)
    at = spots.join(mine.select(*CHANNEL, *PLACE, "value"), [*CHANNEL, *PLACE], "left")
    return at.select("fov", "x", "y", "z", F.coalesce("value", F.lit(0)).alias("intensity"), F.lit(threshold * float(TOP[dtype])).alias("addition"), "channel")


def find_spots_2dlog(voxels: DataFrame, nx: int, ny: int, nz: int, share: float = 0.2, size: tuple = (5, 5), sigma: float = 3.0) -> DataFrame:
    """Minima of the response of each slice of round 1 above a share of the channel's maximum, joined to objects over slices: fov, channel, x, y, z."""
    first = voxels.filter("round_no = 1")
    response = convolve(first, log_kernel(size, sigma), nx, ny, nz, edge="zero")
    level = response.select(*CHANNEL, *PLACE, F.round(-F.col("response") * 1e6).cast("long").alias("value"))
    # the minima of a slice: slices are keys, so that nothing touches across them
    flat = regional_maxima(level.withColumn("slice", F.col("z")), [*CHANNEL, "slice"], 8)
    most = first.groupBy("fov", "channel").agg((F.max("value") * share).alias("cut"))
    tops = flat.select(*CHANNEL, *PLACE).join(first.select(*CHANNEL, *PLACE, F.col("value").alias("raw")), [*CHANNEL, *PLACE]).join(most, ["fov", "channel"]).filter("raw > cut")
    return _centroids(connected_components(tops.drop("cut", "raw"), CHANNEL), CHANNEL).select("fov", "channel", "x", "y", "z")


def call_voxels(voxels: DataFrame, n_channels: int = 3, least: float = 0.0) -> DataFrame:
    """Per voxel and round: the channel with the only greatest value (0 on a tie or below the least quality) and its quality, 1 minus the distance of the normalised values from that channel's axis."""
    rows = voxels.filter(F.col("channel") <= n_channels).groupBy("fov", "round_no", *PLACE).agg(*[F.coalesce(F.max(F.when(F.col("channel") == c, F.col("value"))), F.lit(0)).alias(f"v{c}") for c in range(1, n_channels + 1)])
    values = F.array(*[F.col(f"v{c}") for c in range(1, n_channels + 1)])
    rows = rows.select("fov", "round_no", *PLACE, values.alias("v")).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).filter("norm > 0")
    top = F.array_max("v")
    # |c - e|^2 = 2 - 2 c_k for unit vectors
    quality = 1 - F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * top / F.col("norm")))
    single = F.size(F.filter("v", lambda x: x == top)) == 1
    return rows.select("fov", "round_no", *PLACE, F.when(single & (quality >= least), F.array_position("v", top).cast("int")).otherwise(0).alias("base"), quality.alias("quality"))


def assemble_codes(calls: DataFrame, rounds: int) -> DataFrame:
    """Voxels called in every round: their barcode as a decimal number, round 1 first, and the total quality."""
    code = F.sum(F.col("base") * F.pow(F.lit(10.0), F.lit(rounds) - F.col("round_no"))).cast("long")
    return calls.filter("base > 0").groupBy("fov", *PLACE).agg(code.alias("code"), F.sum("quality").alias("quality"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == rounds).drop("n")


def find_spots_barcode(codes: DataFrame, factor: float = 0.5, volume: int = 1) -> DataFrame:
    """Objects of one code of more than `volume` voxels, all better than factor times the best quality of the fov: fov, code, x, y, z, quality (mean)."""
    best = codes.groupBy("fov").agg((F.max("quality") * factor).alias("cut"))
    good = codes.join(best, "fov").filter("quality > cut").drop("cut")
    labelled = checkpointed(connected_components(good, ["fov"], same="code"))
    spots = _centroids(labelled, ["fov", "code"]).filter(F.col("volume") > volume)
    return spots.join(labelled.groupBy("component").agg(F.avg("quality").alias("quality")), "component").drop("component")


def find_reads_barcode(codes: DataFrame, rounds: int, factor: float = 0.5, volume: int = 1) -> DataFrame:
    """find_spots_barcode as reads: colorseq, and the mean quality a round as the score."""
    return find_spots_barcode(codes, factor, volume).select("fov", "x", "y", "z", F.col("code").cast("string").alias("colorseq"), (F.col("quality") / rounds).alias("score"))


def find_spots_image(codes: DataFrame, book: DataFrame, factor: float = 0.5, volume: int = 1) -> DataFrame:
    """Objects of codebook voxels after cutting, in each slice, voxels next to a greater code; holes are not filled."""
    best = codes.groupBy("fov").agg((F.max("quality") * factor).alias("cut"))
    good = codes.join(best, "fov").filter("quality > cut").join(book.select(F.col("barcode").cast("long").alias("code")), "code", "left_semi")
    good = checkpointed(good.select("fov", *PLACE, "code"))
    left = around_max(good, ["fov"], 8, "code").filter(F.col("around").isNull() | (F.col("around") <= F.col("code"))).drop("around")
    return _centroids(connected_components(left, ["fov"]), ["fov"]).filter(F.col("volume") > volume).select("fov", "x", "y", "z", "volume")


def spots_or_find(spark, path: str, find) -> DataFrame:
    """The spots under a path if they are there, else those that find() gives, written to it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        find().write.parquet(path)
    return spark.read.parquet(path)


def count_close_pairs(spots: DataFrame, distance: float, edge: int = 256) -> DataFrame:
    """(fov, n): pairs of two spots at a distance above 0 and below the given one.

    A pair is counted in the block of its last spot by (z, y, x). So a spot goes to its own block, and to those beside and behind it that it is within
    the distance of: some 13 % of copies at a distance of 8. A block spans edge pixels each way.
    """
    edge = max(edge, 4 * distance)
    finite = [F.abs(F.col(c).cast("double")) < float("inf") for c in "xyz"]
    dealt = spots.select("fov", "spot_id", "x", "y", "z").dropna().filter(finite[0] & finite[1] & finite[2])
    dealt = dealt.withColumn("bx", blocks_near("x", edge, distance)).withColumn("by", blocks_near("y", edge, distance)).withColumn("bz", F.explode(F.sequence(block_of("z", edge), F.floor((F.col("z") + distance) / edge))))
    own = (F.col("bx") == block_of("x", edge)) & (F.col("by") == block_of("y", edge)) & (F.col("bz") == block_of("z", edge))
    schema = spots.sparkSession.createDataFrame([], f"fov {dict(spots.dtypes)['fov']}, n long").schema

    def run(table: pa.Table) -> pa.Table:
        n = _close_pairs(*[table[c].to_numpy() for c in ("x", "y", "z", "spot_id", "own")], distance)
        return pa.table({"fov": table["fov"].slice(0, min(n, 1)), "n": pa.array([n] if n else [], pa.int64())})

    return in_groups(dealt.withColumn("own", own), ["fov", "bz", "by", "bx"], run, schema).groupBy("fov").agg(F.sum("n").alias("n"))


def _close_pairs(x: np.ndarray, y: np.ndarray, z: np.ndarray, ids: np.ndarray, own: np.ndarray, distance: float) -> int:
    """Pairs of an own spot and one before it by (z, y, x), of another number. Spots are sorted by cells as wide as the distance."""
    cx, cy, cz = (np.floor((v - v.min()) / distance).astype(np.int64) + 1 for v in (x, y, z))
    # rows and slices of cells are padded, so that what lies beside the last one is in none
    high, wide = int(cy.max()) + 2, int(cx.max()) + 2
    codes = (cz * high + cy) * wide + cx
    by = np.argsort(codes, kind="stable")
    codes, asks = codes[by], by[own[by]]
    rows = [((cz[asks] + a) * high + cy[asks] + b) * wide + cx[asks] for a in (-1, 0) for b in (-1, 0, 1)]
    low, top = (np.stack([np.searchsorted(codes, r + d, side) for r in rows], axis=1) for d, side in ((-1, "left"), (1, "right")))
    n = 0
    for row, at in pairs_of(low, top):
        i, j = asks[row], by[at]
        dx, dy, dz = x[j] - x[i], y[j] - y[i], z[j] - z[i]
        d2 = np.square(dx, dtype=np.float64) + np.square(dy, dtype=np.float64) + np.square(dz, dtype=np.float64)
        before = (dz < 0) | ((dz == 0) & ((dy < 0) | ((dy == 0) & (dx < 0))))
        n += int(np.count_nonzero(before & (d2 > 0) & (d2 < distance**2) & (ids[i] != ids[j])))
    return n


def extract_intensity(spots: DataFrame, voxels: DataFrame, box: tuple[int, int, int], rounds: int, channels: int = 3, edge: int = 32) -> DataFrame:
    """Per spot, round and channel the sum of the voxels of a box cut at the image, absent ones being 0: fov, spot_id, round_no, sums (array by channel), sum_max, center_max.

    Spots and voxels meet in cogrouped blocks: a spot goes to its own block once, a voxel also to those its box reaches. A block has a summed-volume table for
    each round and channel, so that a box costs eight look-ups whatever its size. A block spans edge x edge pixels, all slices, rounds and
    channels, which bounds a group by the depth of the image. A spot_id may stand in several rows: each has its own box.
    """
    bx, by, _ = box
    own = spots.select("fov", "spot_id", *[F.col(c).cast("long").alias(c) for c in "xyz"]).withColumns({"__bx": F.floor((F.col("x") - 1) / edge), "__by": F.floor((F.col("y") - 1) / edge)})
    mine = voxels.filter(F.col("round_no").between(1, rounds) & F.col("channel").between(1, channels)).select("fov", "round_no", "channel", *PLACE, "value")
    dealt = mine.withColumn("__bx", blocks_near("x", edge, bx, 1)).withColumn("__by", blocks_near("y", edge, by, 1))
    kinds, value = dict(own.dtypes), dict(voxels.dtypes)["value"]
    schema = f"fov {kinds['fov']}, spot_id {kinds['spot_id']}, round_no int, sums array<long>, sum_max long, center_max {value}"

    def run(asked: pa.Table, met: pa.Table) -> pa.Table:
        sums, centre = _box_sums({c: asked[c].to_numpy() for c in "xyz"}, {c: met[c].to_numpy() for c in (*PLACE, "round_no", "channel", "value")}, box, rounds, channels)
        row = pa.array(np.repeat(np.arange(len(asked)), rounds))
        lists = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, channels, dtype=np.int32), sums.ravel())
        number = pa.array(np.tile(np.arange(1, rounds + 1, dtype=np.int32), len(asked)))
        named = {"fov": asked["fov"].take(row), "spot_id": asked["spot_id"].take(row), "round_no": number, "sums": lists, "sum_max": sums.max(axis=2).ravel()}
        return pa.table(named | {"center_max": pa.array(centre.ravel()).cast(met.schema.field("value").type)})

    return own.groupBy("fov", "__by", "__bx").cogroup(dealt.groupBy("fov", "__by", "__bx")).applyInArrow(run, schema)


def _box_sums(spot: dict[str, np.ndarray], voxel: dict[str, np.ndarray], box: tuple[int, int, int], rounds: int, channels: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums by spot, round and channel; the greatest value over channels at each spot's place by spot and round)."""
    n = len(spot["x"])
    sums, centre = np.zeros((n, rounds, channels), np.int64), np.zeros((n, rounds), np.int64)
    if not len(voxel["x"]) or not n:
        return sums, centre
    reach = dict(zip("xyz", box))
    first = {c: int(voxel[c].min()) for c in PLACE}
    shape = tuple(int(voxel[c].max()) - first[c] + 1 for c in PLACE)
    at = {c: (voxel[c] - first[c]).astype(np.int64) for c in PLACE}
    low = [np.clip(spot[c] - reach[c] - first[c], 0, m) for c, m in zip(PLACE, shape)]
    high = [np.clip(spot[c] + reach[c] + 1 - first[c], 0, m) for c, m in zip(PLACE, shape)]
    here = [spot[c] - first[c] for c in PLACE]
    inside = np.flatnonzero(np.all([(h >= 0) & (h < m) for h, m in zip(here, shape)], axis=0))
    layer = (voxel["round_no"] - 1) * channels + voxel["channel"] - 1
    for k in np.unique(layer).tolist():
        of, (r, c) = layer == k, divmod(k, channels)
        places = tuple(at[p][of] for p in PLACE)
        top = np.zeros(shape, np.int64)
        np.maximum.at(top, places, voxel["value"][of])
        centre[inside, r] = np.maximum(centre[inside, r], top[tuple(h[inside] for h in here)])
        upto = np.zeros(tuple(m + 1 for m in shape), np.int64)
        np.add.at(upto, tuple(p + 1 for p in places), voxel["value"][of].astype(np.int64))
        for axis in range(3):
            np.cumsum(upto, axis=axis, out=upto)
        for z, sz in ((high[0], 1), (low[0], -1)):
            for y, sy in ((high[1], 1), (low[1], -1)):
                for x, sx in ((high[2], 1), (low[2], -1)):
                    sums[:, r, c] += sz * sy * sx * upto[z, y, x]
    return sums, centre
