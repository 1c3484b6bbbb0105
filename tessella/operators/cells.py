"""Reads and cells: label lookups, count matrices, windows, and the tables around outside segmenters."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.colours import clean_gene
from tessella.functions.rounding import half_even, half_up, truncate
from tessella.operators.blocks import in_groups
from tessella.operators.graph import checkpointed
from tessella.operators.nearest import nearest


def assign_labels(spots: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the label at each spot's voxel, 0 where there is none."""
    return spots.join(labels.select("fov", "x", "y", "z", "label"), ["fov", "x", "y", "z"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def baysor_input(spots: DataFrame, labels: DataFrame, width: int, height: int, scale_xy: float, scale_z: float) -> DataFrame:
    """Adds the label of the column of voxels at the rounded x, y (half to even; greatest over z; 0 outside), and coordinates in micrometres."""
    flat = labels.groupBy("fov", F.col("x").alias("px"), F.col("y").alias("py")).agg(F.max("label").alias("label"))
    at = spots.withColumns({"px": half_even(F.col("x")), "py": half_even(F.col("y"))})
    inside = (F.col("px") >= 0) & (F.col("px") < width) & (F.col("py") >= 0) & (F.col("py") < height)
    joined = at.join(flat, ["fov", "px", "py"], "left")
    return joined.withColumn("label", F.coalesce(F.when(inside, F.col("label")), F.lit(0))).withColumns({"x_um": F.col("x") * scale_xy, "y_um": F.col("y") * scale_xy, "z_um": F.col("z") * scale_z}).drop("px", "py")


def assigned_share(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fov").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("n_assigned")).withColumn("share", F.col("n_assigned") / F.col("n"))


def gene_by_cell(reads: DataFrame, book: DataFrame, cells: list[int]) -> DataFrame:
    """One row for each gene of the codebook and one column for each of the given cells; nothing counted is 0. For the few cells of a field of view."""
    counts = reads.groupBy("gene").pivot("cell_barcode", cells).agg(F.count(F.lit(1)))
    return book.select("gene").distinct().join(counts, "gene", "left").na.fill(0)


def count_matrix(reads: DataFrame) -> DataFrame:
    """Long counts (cell_barcode, gene, total, rb, nt) of reads in cells; the clean gene groups, the full name tells the layer."""
    inside = reads.filter("cell_barcode <> 0")
    gene = clean_gene(F.col("gene_name"))
    return inside.groupBy("cell_barcode", gene.alias("gene")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("gene_name").endswith("_rbRNA")).alias("rb"), F.count_if(F.col("gene_name").endswith("_ntRNA")).alias("nt"))


def wide_counts(counts: DataFrame, genes: list[str], value: str = "total") -> DataFrame:
    return counts.groupBy("cell_barcode").pivot("gene", genes).agg(F.sum(value)).na.fill(0)


def count_by_mask(reads: DataFrame, cells: DataFrame, nuclei: DataFrame, width: int, height: int) -> DataFrame:
    """Counts of each (label, nucleus, gene): reads (coordinates from 1) are moved into the image, each by its own axis."""
    clip = lambda c, n: F.greatest(F.lit(1), F.least(F.lit(n), F.col(c)))
    at = reads.withColumns({"x": clip("x", width), "y": clip("y", height)})
    named = lambda df, n: df.groupBy("fov", "x", "y").agg(F.max("label").alias(n))
    both = at.join(named(cells, "cell"), ["fov", "x", "y"], "left").join(named(nuclei, "nucleus"), ["fov", "x", "y"], "left")
    return both.filter("cell > 0").groupBy("fov", "cell", "gene").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("nucleus") > 0).alias("n_nucleus"))


def match_cells_nuclei(cells: DataFrame, nuclei: DataFrame) -> DataFrame:
    """(fov, cell, nucleus, id): nuclei all of whose pixels lie in one cell; a cell's first such nucleus wins; ids run from 1 in each fov."""
    both = nuclei.select("fov", "x", "y", F.col("label").alias("nucleus")).join(cells.select("fov", "x", "y", F.col("label").alias("cell")), ["fov", "x", "y"], "left")
    whole = both.groupBy("fov", "nucleus").agg(F.count(F.lit(1)).alias("n"), F.count("cell").alias("inside"), F.min("cell").alias("cell"), F.max("cell").alias("last")).filter("n = inside and cell = last")
    first = whole.groupBy("fov", "cell").agg(F.min("nucleus").alias("nucleus"))
    return first.withColumn("id", F.row_number().over(Window.partitionBy("fov").orderBy("cell")))


def gene_ids(spots: DataFrame, order: str = "read_id") -> DataFrame:
    """(gene, id): whole numbers from 1 in the order of first appearance, numbered by ranges."""
    first = numbered(spots.groupBy("gene").agg(F.min(order).alias("first")), ["first", "gene"], "at")
    return first.select("gene", (F.col("at") + 1).cast("int").alias("id"))


def rotate_points(points: DataFrame, degrees: float, width: int, height: int, variant: str = "clockwise") -> DataFrame:
    """x, y turned about the image's centre. 'clockwise' and 'counter' round by floor(v + 0.5), 'counter_trunc' by trunc(v + 0.5)."""
    a = math.radians(degrees) * (-1 if variant == "clockwise" else 1)
    cx, cy = int(width / 2 + 0.5), int(height / 2 + 0.5)
    # y grows downwards, so a counter-clockwise turn on the screen has the opposite sign in these axes
    dx, dy = F.col("x") - cx, F.col("y") - cy
    x = dx * math.cos(a) + dy * math.sin(a) + cx
    y = -dx * math.sin(a) + dy * math.cos(a) + cy
    whole = (lambda c: truncate(c + 0.5)) if variant == "counter_trunc" else half_up
    return points.withColumns({"x": whole(x), "y": whole(y)})


def prepare_spots(spots: DataFrame, depth: int | None = None) -> DataFrame:
    """Spots to a depth, under the names that the segmenters use."""
    kept = spots if depth is None else spots.filter(F.col("z") <= depth)
    return kept.withColumnsRenamed({"x": "spot_location_1", "y": "spot_location_2", "z": "spot_location_3"})


def restore_suffix(processed: DataFrame, raw: DataFrame, tolerance: float, order: str = "raw_order") -> DataFrame:
    """Adds gene_name: the full name of the nearest raw spot of the same field of view, clean gene and z, nearer than the tolerance; else the clean name.

    processed: fov, id, gene, x, y, z; raw: fov, gene_name, x, y, z and an order that settles ties.
    """
    named = raw.select("fov", clean_gene(F.col("gene_name")).alias("gene"), "z", "x", "y", F.col("gene_name").alias("full"), order)
    best = nearest(processed, named, ["fov"], ["gene", "z"], tolerance, ["full"], [order])
    return best.withColumn("gene_name", F.coalesce("full", "gene")).withColumn("matched", F.col("full").isNotNull()).drop("full")


def _held_by(c: str, width: Column | int, margin: Column | int) -> Column:
    """The windows of a width, wider by a margin on every side, that hold a coordinate."""
    return F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - margin) / width)).cast("int"), F.floor((F.col(c) + margin) / width).cast("int"))


def window_spots(spots: DataFrame, width: int, share: float) -> DataFrame:
    """Each spot with every window of `width` that holds it, windows being wider by ceil(width * share) on every side."""
    margin = math.ceil(width * share)
    return spots.withColumn("wx", F.explode(_held_by("x", width, margin))).withColumn("wy", F.explode(_held_by("y", width, margin)))


def filter_small_windows(rows: DataFrame, least: int, keys: tuple[str, ...] = ("fov",)) -> DataFrame:
    """Rows of windows with at least so many; a window belongs to one field of view. The counts are joined back, so a full window is no single task."""
    at = [*keys, "wx", "wy"]
    n = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return rows.join(n.select(*at), at, "left_semi")


def quad_windows(spots: DataFrame, width: int, most: int, depth: int = 4, keys: tuple[str, ...] = ("fov",)) -> DataFrame:
    """(keys, level, wx, wy, n): windows of width / 2**level that part every field: one with over `most` spots is split in four, down to `depth`.

    Spots are counted once, in the smallest windows; larger ones are sums of those.
    """
    cell = lambda c: F.floor(F.col(c) * 2**depth / width).cast("int")
    finest = spots.select(*keys, cell("x").alias("fx"), cell("y").alias("fy")).groupBy(*keys, "fx", "fy").agg(F.count(F.lit(1)).alias("n"))
    up = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.lit(depth) - F.col("level"))).cast("int")
    levels = finest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    counts = levels.groupBy(*keys, "level", up("fx").alias("wx"), up("fy").alias("wy")).agg(F.sum("n").alias("n"))
    split = counts.filter((F.col("n") > most) & (F.col("level") < depth))
    over = split.select(*keys, (F.col("level") + 1).alias("level"), F.col("wx").alias("px"), F.col("wy").alias("py"))
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    inside = counts.withColumns({"px": half("wx"), "py": half("wy")})
    # every window above a full one is fuller, so a window is there if the one above it is split
    there = inside.filter("level = 0").unionByName(inside.join(over, [*keys, "level", "px", "py"], "left_semi").select(*inside.columns))
    return there.filter((F.col("n") <= most) | (F.col("level") == depth)).select(*keys, "level", "wx", "wy", "n")


def split_windows(spots: DataFrame, width: int, share: float, most: int, depth: int = 4, keys: tuple[str, ...] = ("fov",)) -> DataFrame:
    """Each spot with every window of quad_windows that holds it (level, wx, wy), each window wider by ceil(its width * share) on every side.

    A window's own spots are bounded by `most` unless they lie within width / 2**depth of each other; its margins are the neighbours' spots.
    """
    sizes = [(k, width / 2**k, math.ceil(width / 2**k * share)) for k in range(depth + 1)]
    level = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.lit(float(w)).alias("w"), F.lit(m).alias("m")) for k, w, m in sizes]))
    at = spots.withColumn("__level", level).withColumn("wx", F.explode(_held_by("x", F.col("__level.w"), F.col("__level.m")))).withColumn("wy", F.explode(_held_by("y", F.col("__level.w"), F.col("__level.m"))))
    windows = quad_windows(spots, width, most, depth, keys).drop("n")
    return at.withColumn("level", F.col("__level.level")).drop("__level").join(windows, [*keys, "level", "wx", "wy"], "left_semi")


def ensure_ids(rows: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each whole-number id; rows without one go."""
    ready = rows.withColumn("id", F.col("id").try_cast("bigint")).filter("id is not null")
    return ready.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy(*order))).filter("k = 1").drop("k")


def union_windows(parts: list[DataFrame], order: str = "window") -> DataFrame:
    """Spots of all windows, the first of each id; missing clusters and centres are -1, missing noise marks 0."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    fill = {c: -1 for c in ("cluster", "center_x", "center_y", "center_z") if c in rows.columns} | ({"is_noise": 0} if "is_noise" in rows.columns else {})
    return rows.na.fill(fill).withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy(order))).filter("k = 1").drop("k")


def upsert_assignments(spots: DataFrame, parts: DataFrame) -> DataFrame:
    """Spots with the cluster of their last window, or the one they had."""
    last = parts.groupBy("id").agg(F.max_by("cluster", "window").alias("new"))
    return spots.join(last, "id", "left").withColumn("cluster", F.coalesce("new", "cluster")).drop("new")


def assigned_reads(reads: DataFrame, column: str = "cluster") -> DataFrame:
    return reads.filter(F.col(column) >= 0)


def soma_process(reads: DataFrame, column: str = "raw") -> DataFrame:
    """Adds kind: soma (in a cell), process (outside, no noise) or null."""
    quiet = F.col("is_noise") == 0 if "is_noise" in reads.columns else F.lit(True)
    return reads.withColumn("kind", F.when(F.col(column) >= 0, "soma").when((F.col(column) == -1) & quiet, "process"))


def cell_centroids(reads: DataFrame, cell: str = "cell_barcode") -> DataFrame:
    return reads.filter(F.col(cell) > 0).groupBy(cell).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"), F.count(F.lit(1)).alias("n"))


def standardise_spots(spots: DataFrame, needed: tuple[str, ...] = ("x", "y", "gene")) -> DataFrame:
    """Lower-case names, z = 0 where there is none; fails if a column is missing."""
    low = spots.toDF(*[c.lower() for c in spots.columns])
    if missing := [c for c in needed if c not in low.columns]:
        raise ValueError(f"missing columns: {missing}")
    return low if "z" in low.columns else low.withColumn("z", F.lit(0))


def _chains(cell: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower and upper hulls of many cells at once, as indices in the order of (cell, x, y).

    A point that doesn't turn left between those that are left beside it lies on or above the lower hull, so all such points go at once, until none does.
    """
    by = np.lexsort((y, x, cell))
    by = by[np.append(True, (np.diff(cell[by]) != 0) | (np.diff(x[by]) != 0) | (np.diff(y[by]) != 0))[: len(by)]]
    out = []
    for sign in (1, -1):
        left = by
        while len(left) > 2:
            a, b, c = left[:-2], left[1:-1], left[2:]
            turn = (x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])
            stay = np.ones(len(left), bool)
            stay[1:-1] = (cell[a] != cell[c]) | (sign * turn > 0)
            if stay.all():
                break
            left = left[stay]
        out.append(left)
    return out[0], out[1]


def _points(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return table["cell"].to_numpy(), table["x"].to_numpy(), table["y"].to_numpy()


def cell_hulls(reads: DataFrame, cell: str = "cell_barcode") -> DataFrame:
    """(cell, ring): the closed convex hull of each cell's points, from its least point and counter-clockwise; cells of fewer than three points, or on one line,
    are left out. Points with a null coordinate don't count.

    The hull of hulls is the hull: every batch of every map task sends the corners of its cells only, and a cell's corners meet in one group.
    """
    ready = reads.filter(F.col(cell) > 0).select(F.col(cell).cast("long").alias("cell"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).dropna()

    def corners(batches):
        for batch in batches:
            keep = np.unique(np.concatenate(_chains(*_points(batch))))
            yield batch.take(pa.array(keep))

    def ring(table: pa.Table) -> pa.Table:
        n, x, y = _points(table)
        lower, upper = _chains(n, x, y)
        around = np.concatenate([lower[:-1], upper[::-1]])
        if len(around) < 4:
            return pa.table({"cell": pa.array([], pa.int64()), "ring": pa.array([], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))})
        points = pa.StructArray.from_arrays([pa.array(x[around]), pa.array(y[around])], ["x", "y"])
        return pa.table({"cell": table["cell"][:1], "ring": pa.ListArray.from_arrays(np.array([0, len(around)], np.int32), points)})

    partial = ready.mapInArrow(corners, "cell long, x double, y double")
    return in_groups(partial, ["cell"], ring, "cell long, ring array<struct<x:double,y:double>>")


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds running numbers from 0 in the order of the columns: ranges of the order are numbered apart, and each range begins where those before it end.

    Only one row a range goes through a window without a partition. The ranges are checkpointed, so that a row's range doesn't change. Their number is
    that of the shuffle partitions, so that none are put together in one task, which sorts them.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(rows.repartitionByRange(partitions, *order).withColumn("range", F.spark_partition_id()))
    before = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return ranged.repartition(partitions, "range").withColumn("inner", inner).join(before, "range").withColumn(name, F.col("before") + F.col("inner") - 1).drop("range", "inner", "before")


def external_cells(rows: DataFrame, scale: float, order: str, every: int | None = None) -> DataFrame:
    """Another segmenter's points: noise from text, cell numbers by first appearance, micrometres as pixels; with `every`, each so many-th row only.

    Thinning is a sampling of what is shown, in the order of the rows; numbers are given before it.
    """
    codes = numbered(rows.groupBy("cell").agg(F.min(order).alias("first")), ["first", "cell"], "cell_no").drop("first")
    out = rows.join(codes, "cell").withColumns({"is_noise": F.lower(F.col("is_noise").cast("string")) == "true", "x": F.col("x") / scale, "y": F.col("y") / scale})
    return out if every is None else numbered(out, [order], "at").filter(F.col("at") % every == 0).drop("at")


def shift_noise(rows: DataFrame) -> DataFrame:
    """Noise marks moved so that the least is -1."""
    least = rows.agg(F.min("is_noise").alias("least"))
    return rows.join(F.broadcast(least)).withColumn("is_noise", F.col("is_noise") - F.col("least") - 1).drop("least")


