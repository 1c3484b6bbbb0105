"""Tiles: subtile grids, scan orders, layouts, stitching of points and voxels, and valid regions of a mosaic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.rounding import truncate
from tessella.operators.cells import numbered


def subtile_grid(spark: SparkSession, xy: int, n: int) -> DataFrame:
    """n x n subtiles of an xy-pixel tile, numbered down the columns: size floor(xy/n), overlap floor(0.1 size), cut at the edges."""
    size = xy // n
    overlap = size // 10
    i = spark.range(n * n).select((F.col("id") % n + 1).cast("int").alias("ind_y"), (F.floor(F.col("id") / n) + 1).cast("int").alias("ind_x"), (F.col("id") + 1).cast("int").alias("t"))
    at = lambda k: (F.col(k) - 1) * size
    start = lambda k: F.greatest(at(k) - overlap + 1, F.lit(1)).cast("int")
    stop = lambda k: F.when(F.col(k) == n, xy).otherwise(F.least(F.col(k) * size + overlap, F.lit(xy))).cast("int")
    g = i.select("t", (F.col("ind_x") - 1).alias("ind_x"), (F.col("ind_y") - 1).alias("ind_y"), start("ind_x").alias("scoords_x"), start("ind_y").alias("scoords_y"), stop("ind_x").alias("ecoords_x"), stop("ind_y").alias("ecoords_y"), at("ind_x").cast("int").alias("upperleft_x"), at("ind_y").cast("int").alias("upperleft_y"))
    return g.select("*", (F.col("ecoords_x") - F.col("scoords_x") + 1).alias("dim_x"), (F.col("ecoords_y") - F.col("scoords_y") + 1).alias("dim_y"))


def assign_subtiles(points: DataFrame, xy: int, n: int) -> DataFrame:
    """Each point with every subtile that holds it (up to four), by arithmetic on its own coordinates: adds t, and x and y inside the subtile."""
    size = xy // n
    overlap = size // 10

    def span(c: str) -> Column:
        low = F.greatest(F.lit(1), F.ceil((F.col(c) - overlap) / size)).cast("int")
        high = F.least(F.lit(n), F.floor((F.col(c) - 1 + overlap) / size) + 1).cast("int")
        return F.filter(F.sequence(F.greatest(F.lit(1), low - 1), F.least(F.lit(n), high + 1)), lambda k: (F.col(c) >= F.greatest((k - 1) * size - overlap + 1, F.lit(1))) & (F.col(c) <= F.when(k == n, xy).otherwise(F.least(k * size + overlap, F.lit(xy)))))

    out = points.withColumn("ix", F.explode(span("x"))).withColumn("iy", F.explode(span("y")))
    local = lambda c, k: (F.col(c) - F.greatest((F.col(k) - 1) * size - overlap + 1, F.lit(1)) + 1).cast("int")
    return out.withColumns({"t": ((F.col("ix") - 1) * n + F.col("iy")).cast("int"), "local_x": local("x", "ix"), "local_y": local("y", "iy")}).drop("ix", "iy")


def blocks(spark: SparkSession, x: int, y: int, size: int, overlap: int, least: int = 1) -> DataFrame:
    """Overlapping blocks (x0, x1, y0, y1) of an x by y image in steps of size - overlap; blocks smaller than `least` on a side are dropped."""
    step = size - overlap
    across, down = -(-x // step), -(-y // step)
    number = spark.range(across * down)
    side = lambda k, n: (k * step + 1, F.least(k * step + size, F.lit(n)))
    (x0, x1), (y0, y1) = side(F.floor(F.col("id") / down), x), side(F.col("id") % down, y)
    all_ = number.select(*[c.cast("int").alias(n) for c, n in ((x0, "x0"), (x1, "x1"), (y0, "y0"), (y1, "y1"))])
    return all_.filter((F.col("x1") - F.col("x0") + 1 >= least) & (F.col("y1") - F.col("y0") + 1 >= least))


def owner(x: Column, y: Column, xy: int, n: int) -> Column:
    """The subtile that has the last word on a pixel of the stitched image: the latest whose inner area reaches it."""
    size = xy // n
    pick = lambda c: F.least(F.lit(n), F.floor((c - 1) / size) + 1)
    return ((pick(x) - 1) * n + pick(y)).cast("int")


def stitch_points(points: DataFrame, xy: int, n: int) -> DataFrame:
    """Points of overlapping subtiles (t, x, y in tile coordinates), each kept from the one subtile that a sequential merge would leave it.

    A point of subtile t stays if it lies behind t's upper left corner on both axes, and no later subtile's corner lies before it: that is, if t is
    the last subtile whose corner lies before it.
    """
    size = xy // n
    corner = lambda c: F.least(F.lit(n), F.greatest(F.lit(0), F.ceil(F.col(c) / size))).cast("int")
    return points.filter((corner("x") > 0) & (corner("y") > 0) & (F.col("t") == (corner("x") - 1) * n + corner("y")))


def stitch_voxels(voxels: DataFrame, xy: int, n: int) -> DataFrame:
    """Voxels of overlapping subtiles (t, x, y in tile coordinates): the later subtile overwrites, also with an absent, that is zero, voxel."""
    return voxels.filter(F.col("t") == owner(F.col("x"), F.col("y"), xy, n)).drop("t")


def scan_grid(spark: SparkSession, rows: int, cols: int, start: int = 1, scan: str = "S", primary: str = "R", secondary: str = "D") -> DataFrame:
    """(row, col, position) of a raster (R) or snake (S) scan; a snake flips odd rows (or columns) by their own number, whatever the secondary direction."""
    i, j = F.col("row"), F.col("col")
    cells = spark.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    if primary in "LR":
        outer, line, at, length, back, last = i, i, j, cols, secondary == "U", rows
        forward = primary == "R"
    else:
        outer, line, at, length, back, last = j, j, i, rows, secondary == "L", cols
        forward = primary == "D"
    flipped = (line % 2 == 1) if scan == "S" else F.lit(False)
    order = F.lit(last - 1) - outer if back else outer
    inner = F.when(flipped == F.lit(forward), F.lit(length - 1) - at).otherwise(at)
    return cells.select("row", "col", (order * length + inner + start).cast("int").alias("position"))


def parse_overlap(text: str) -> float:
    """'0.1' or '10%' as a share in [0, 1)."""
    value = float(text.strip().rstrip("%")) / (100 if text.strip().endswith("%") else 1)
    if not 0 <= value < 1:
        raise ValueError("overlap must be in [0, 1)")
    return value


def grid_to_pixels(grid: DataFrame, fov_x: int, fov_y: int, overlap: str) -> DataFrame:
    share = 1 - parse_overlap(overlap)
    return grid.select("*", (F.col("col") * fov_x * F.lit(share)).alias("x"), (F.col("row") * fov_y * F.lit(share)).alias("y"))


def stage_to_pixels(stage: DataFrame, um: float, invert: bool = False) -> DataFrame:
    """Stage micrometres as pixels from the least; the ends come from one aggregate of one row."""
    ends = stage.agg(F.min("phys_x").alias("x0"), F.min("phys_y").alias("y0"), F.max("phys_y").alias("y1"))
    y = F.col("y1") - F.col("phys_y") if invert else F.col("phys_y") - F.col("y0")
    return stage.join(F.broadcast(ends)).select(*stage.columns, ((F.col("phys_x") - F.col("x0")) / um).alias("pos_x_px"), (y / um).alias("pos_y_px"))


def natural_key(name: Column) -> Column:
    """The number at the end of a name; 10**12 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"(\d+)$", 1), F.lit("")).try_cast("bigint"), F.lit(10**12).cast("bigint"))


def pair_by_rank(files: DataFrame, positions: DataFrame, offset: int = 0) -> DataFrame:
    """Files (name) and stage positions (pos_no) zipped in natural order, `offset` positions skipped, to the shorter. Both are numbered by ranges of their order."""
    f = numbered(files.withColumn("__key", natural_key(F.col("name"))), ["__key", "name"], "rank").drop("__key")
    p = numbered(positions, ["pos_no"], "rank").withColumn("rank", F.col("rank") - offset)
    return f.join(p, "rank").withColumn("rank", (F.col("rank") + 1).cast("int"))


def drop_position_range(rows: DataFrame, first: int, last: int, column: str = "name") -> DataFrame:
    """Rows but for those with a position number in first..last; rows without a number stay."""
    n = F.regexp_extract(column, r"Position(\d+)", 1)
    return rows.filter(~F.coalesce(n.try_cast("long").between(first, last), F.lit(False)))


def tile_summary(tiles: DataFrame, width: int, height: int) -> DataFrame:
    return tiles.select("tile", "x", "y", (F.col("x") + width / 2).alias("center_x_px"), (F.col("y") + height / 2).alias("center_y_px"), F.lit(width).alias("width_px"), F.lit(height).alias("height_px")).orderBy("tile")


def spacing_stats(tiles: DataFrame, size: int) -> DataFrame:
    """Per axis: tiles, least and greatest coordinate, mean step of the distinct sorted ones over half a tile, and the overlap in per cent."""
    axes = tiles.select(F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.col("x").alias("c")), F.struct(F.lit("y").alias("axis"), F.col("y").alias("c")))).alias("s")).select("s.*").distinct()
    steps = axes.withColumn("step", F.col("c") - F.lag("c").over(Window.partitionBy("axis").orderBy("c")))
    rows = steps.groupBy("axis").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"), F.avg(F.when(F.col("step") > size / 2, F.col("step"))).alias("mean_step"))
    return rows.withColumn("overlap_percent", (1 - F.col("mean_step") / size) * 100)


def group_centres(values: Column, tolerance: float) -> Column:
    """Sorted values as groups: a value joins the group while it is within the tolerance of its running mean. Returns the means."""
    zero = F.struct(F.array().cast("array<double>").alias("done"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def step(acc: Column, v: Column) -> Column:
        near = (acc["n"] == 0) | (v - acc["sum"] / acc["n"] <= tolerance)
        return F.struct(
            F.when(near, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["sum"] / acc["n"]))).alias("done"),
            F.when(near, acc["sum"] + v).otherwise(v).alias("sum"),
            F.when(near, acc["n"] + 1).otherwise(F.lit(1)).alias("n"),
        )

    return F.aggregate(values, zero, step, lambda acc: F.when(acc["n"] > 0, F.concat(acc["done"], F.array(acc["sum"] / acc["n"]))).otherwise(acc["done"]))


def logical_grid(tiles: DataFrame, tolerance: float = 300, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, tile, column_index, row_index) of tiles by their coordinates; null if no group's centre is within the tolerance.

    keys tell slides apart. A coordinate farther than the tolerance from the one before starts a group whatever the mean so far, so the sorted distinct
    coordinates of a slide fall into independent segments: groups are folded inside one, and numbered by a running sum over segments. An array holds
    one segment, never a slide.
    """
    axis = [*keys, "axis"]
    both = F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("c")) for c in "xy"]))
    places = tiles.select(*keys, both.alias("s")).select(*keys, "s.*").filter("c is not null").distinct()
    inorder = Window.partitionBy(*axis).orderBy("c")
    parted = places.withColumn("gap", F.when(F.col("c") - F.lag("c").over(inorder) > tolerance, 1).otherwise(0)).withColumn("segment", F.sum("gap").over(inorder)).drop("gap")
    folded = parted.groupBy(*axis, "segment").agg(group_centres(F.sort_array(F.collect_list("c")), tolerance).alias("centres"))
    before = Window.partitionBy(*axis).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    numbered = folded.withColumn("before", F.coalesce(F.sum(F.size("centres")).over(before), F.lit(0)))
    # a centre of another segment is farther away than the tolerance
    first = F.nullif(F.array_position(F.transform("centres", lambda m: F.abs(F.col("c") - m) <= tolerance), True), F.lit(0)) - 1
    found = parted.join(numbered, [*axis, "segment"]).select(*axis, "c", (F.col("before") + first).cast("int").alias("index"))

    def indexed(rows: DataFrame, c: str, name: str) -> DataFrame:
        at = found.filter(F.col("axis") == c).select(*keys, F.col("c").alias("__c"), F.col("index").alias(name))
        return rows.withColumn("__c", F.col(c).cast("double")).join(at, [*keys, "__c"], "left").drop("__c")

    return indexed(indexed(tiles.select(*keys, "tile", "x", "y"), "x", "column_index"), "y", "row_index").drop("x", "y")


def tune_coords(observed: DataFrame, expected: DataFrame, grid: DataFrame) -> DataFrame:
    """Observed and expected coordinates of the tiles in all three, shifted to the least observed of tiles that aren't blank (tile 0)."""
    o = observed.select("tile", F.col("x").alias("x_obs"), F.col("y").alias("y_obs"))
    e = expected.select("tile", F.col("x").alias("x_exp"), F.col("y").alias("y_exp"))
    rows = o.join(e, "tile").join(grid, "tile")
    ends = rows.filter("tile <> 0").agg(F.min("x_obs").alias("x0"), F.min("y_obs").alias("y0"))
    return rows.join(F.broadcast(ends)).withColumns({"x_obs": F.col("x_obs") - F.col("x0"), "y_obs": F.col("y_obs") - F.col("y0")}).drop("x0", "y0")


def mosaic_extent(tiles: DataFrame, size: int) -> DataFrame:
    step = 0.9 * size
    return tiles.agg((F.max("x") + size).alias("width"), (F.max("y") + size).alias("height"), F.count_distinct(F.floor(F.col("x") / step)).alias("n_columns"), F.count_distinct(F.floor(F.col("y") / step)).alias("n_rows"))


def grid_by_count(tiles: DataFrame, per_column: int = 11) -> DataFrame:
    return tiles.select("tile", F.floor((F.col("tile") - 1) / per_column).cast("int").alias("column_index"), ((F.col("tile") - 1) % per_column).cast("int").alias("row_index"))


def drop_misaligned(tiles: DataFrame, size: int, share: float = 0.5) -> DataFrame:
    """Tiles strictly within (1 + share) sizes of the median x of their column and the median y of their row."""
    reach = (1 + share) * size
    mx = F.expr("percentile(x, 0.5)").over(Window.partitionBy("column_index"))
    my = F.expr("percentile(y, 0.5)").over(Window.partitionBy("row_index"))
    return tiles.withColumns({"mx": mx, "my": my}).filter((F.abs(F.col("x") - F.col("mx")) < reach) & (F.abs(F.col("y") - F.col("my")) < reach)).drop("mx", "my")


def valid_regions(tiles: DataFrame, size: int) -> DataFrame:
    """The part of each tile that is its own, in its own coordinates: to the middle of the overlap with each of four neighbours, else to its edge.

    Of several tiles at one place of the grid the least tile number counts as the neighbour; tile 0 is blank.
    """
    one = tiles.groupBy("column_index", "row_index").agg(F.min_by(F.struct("tile", "x", "y"), "tile").alias("t"))

    def neighbour(dc: int, dr: int, name: str) -> DataFrame:
        return one.select((F.col("column_index") - dc).alias("column_index"), (F.col("row_index") - dr).alias("row_index"), F.when(F.col("t.tile") != 0, F.col("t")).alias(name))

    out = tiles
    for dc, dr, name in ((-1, 0, "left"), (1, 0, "right"), (0, -1, "top"), (0, 1, "bottom")):
        out = out.join(neighbour(dc, dr, name), ["column_index", "row_index"], "left")
    middle = lambda gap: truncate(gap / 2 + 0.5)
    return out.select(
        "tile", "column_index", "row_index", "x", "y",
        F.coalesce(middle(F.col("left.x") + size - F.col("x")), F.lit(0)).alias("x0"),
        F.coalesce(middle(F.col("x") + size - F.col("right.x")) + F.col("right.x") - F.col("x"), F.lit(size)).alias("x1"),
        F.coalesce(middle(F.col("top.y") + size - F.col("y")), F.lit(0)).alias("y0"),
        F.coalesce(middle(F.col("y") + size - F.col("bottom.y")) + F.col("bottom.y") - F.col("y"), F.lit(size)).alias("y1"),
    )


def to_global(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """Local coordinates as global ones."""
    return rows.join(tiles.select("tile", F.col("x").alias("tx"), F.col("y").alias("ty")), "tile").withColumns({"column": F.col("x") + F.col("tx"), "row": F.col("y") + F.col("ty")}).drop("tx", "ty")


def assign_cell_ids(cells: DataFrame, mode: str = "gap") -> DataFrame:
    """Adds cell_barcode, unique over tiles: raw + offset (+ 1 for 'gap'), the offset growing with the tiles before.

    'gap': by the greatest raw id + 2 of each tile with a cell; 'compat': by the greatest raw id, so raw id 0 has the number of the last cell of the tile before.
    The running sum is over one row a tile.
    """
    if mode not in ("gap", "compat"):
        raise ValueError(f"unknown mode {mode}")
    tops = cells.groupBy("tile").agg((F.max("raw") + (2 if mode == "gap" else 0)).alias("grow"))
    before = Window.orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tops.select("tile", F.coalesce(F.sum("grow").over(before), F.lit(0)).alias("offset"))
    return cells.join(offsets, "tile").withColumn("cell_barcode", (F.col("raw") + F.col("offset") + (1 if mode == "gap" else 0)).cast("long")).drop("offset")


def mark_process(reads: DataFrame) -> DataFrame:
    """cell_barcode 0 for reads outside cells; the raw id stays."""
    return reads.withColumn("cell_barcode", F.when(F.col("raw") < 0, 0).otherwise(F.col("cell_barcode")).cast("long"))


def _inside(regions: DataFrame) -> Column:
    return (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))


def clip_cells(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells inside their tile's region, upper ends left out."""
    return cells.join(regions.select("tile", "x0", "x1", "y0", "y1"), "tile").filter(_inside(regions)).select(*cells.columns)


def clip_reads(reads: DataFrame, kept: DataFrame, regions: DataFrame) -> DataFrame:
    """Reads that aren't noise: those of kept cells wherever they lie, and unassigned ones inside their tile's region."""
    clean = reads.filter("is_noise = 0")
    mine = clean.filter("raw >= 0").join(kept.select("tile", "raw"), ["tile", "raw"], "left_semi")
    loose = clean.filter("raw = -1").join(regions.select("tile", "x0", "x1", "y0", "y1"), "tile").filter(_inside(regions)).select(*clean.columns)
    return mine.select(*clean.columns).unionByName(loose)


def merge_fovs(reads: DataFrame, cells: DataFrame) -> DataFrame:
    """Reads of all tiles with unique cell numbers ('compat'), without geometry; noise goes if the column exists, repeated rows go."""
    clean = reads.filter("is_noise = 0") if "is_noise" in reads.columns else reads
    ids = assign_cell_ids(cells, "compat").select("tile", "raw", "cell_barcode").distinct()
    joined = clean.join(ids, ["tile", "raw"], "left").filter((F.col("raw") < 0) | F.col("cell_barcode").isNotNull())
    return mark_process(joined).distinct()


def finalize_reads(reads: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Distinct rows, the named columns without nulls and truncated to whole numbers."""
    return reads.withColumns({c: F.coalesce(truncate(F.col(c)), F.lit(0)) for c in columns}).dropDuplicates()


def resolve_multi_assign(reads: DataFrame, centres: DataFrame) -> DataFrame:
    """One row for each (x, y, z): the assigned cell with the nearest centre, the smaller number on a tie."""
    d = reads.join(centres.select("cell_barcode", F.col("x").alias("cx"), F.col("y").alias("cy"), F.col("z").alias("cz")), "cell_barcode")
    far = (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2 + (F.col("z") - F.col("cz")) ** 2
    return d.groupBy("x", "y", "z").agg(F.min_by("cell_barcode", F.struct(far, "cell_barcode")).alias("cell_barcode"))


def drop_twin_cells(old: DataFrame, new: DataFrame, low: float, high: float, size: int, axis: str = "x") -> tuple[DataFrame, DataFrame]:
    """(old, new) without twins: of two cells of the strip low..high nearer than 0.1 size, the one farther from the strip's middle goes, the new one on a tie.

    Cells meet through a grid of that width, so each is compared with its neighbourhood only.
    """
    reach, middle = 0.1 * size, (low + high) / 2
    box = lambda df, p: df.filter(F.col(axis).between(low, high)).select(F.col("cell_barcode").alias(f"{p}_id"), F.col("x").alias(f"{p}x"), F.col("y").alias(f"{p}y"), F.floor(F.col("x") / reach).alias("bx"), F.floor(F.col("y") / reach).alias("by"))
    step = F.array(*map(F.lit, (-1, 0, 1)))
    around = box(new, "n").withColumn("dx", F.explode(step)).withColumn("dy", F.explode(step)).withColumns({"bx": F.col("bx") + F.col("dx"), "by": F.col("by") + F.col("dy")})
    pairs = box(old, "o").join(around, ["bx", "by"]).filter((F.col("ox") - F.col("nx")) ** 2 + (F.col("oy") - F.col("ny")) ** 2 < reach**2)
    farther = F.abs(F.col(f"o{axis}") - middle) > F.abs(F.col(f"n{axis}") - middle)
    gone = pairs.select(F.when(farther, F.col("o_id")).alias("o"), F.when(~farther, F.col("n_id")).alias("n"))
    return old.join(gone.select(F.col("o").alias("cell_barcode")).dropna(), "cell_barcode", "left_anti"), new.join(gone.select(F.col("n").alias("cell_barcode")).dropna(), "cell_barcode", "left_anti")


def neighbour_strips(tiles: DataFrame, size: int) -> DataFrame:
    """(old, new, axis, low, high): for every tile of the grid its right and its lower neighbour, and the strip of global coordinates that both cover.

    Strips without width are left out; of several tiles at one place the least number counts, tile 0 is blank.
    """
    one = tiles.filter("tile <> 0").groupBy("column_index", "row_index").agg(F.min_by(F.struct("tile", "x", "y"), "tile").alias("t"))
    parts = []
    for axis, dc, dr in (("x", 1, 0), ("y", 0, 1)):
        after = one.select((F.col("column_index") - dc).alias("column_index"), (F.col("row_index") - dr).alias("row_index"), F.col("t").alias("u"))
        parts.append(one.join(after, ["column_index", "row_index"]).select(F.col("t.tile").alias("old"), F.col("u.tile").alias("new"), F.lit(axis).alias("axis"), F.col(f"u.{axis}").alias("low"), (F.col(f"t.{axis}") + size).alias("high")))
    return parts[0].unionByName(parts[1]).filter("low <= high")


def drop_twins(cells: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """Cells (tile, cell_barcode, global x and y) without twins across neighbouring tiles: of two cells of a strip nearer than 0.1 size, one of each tile, the one
    farther from the strip's middle goes, the later tile's on a tie.

    Tiles meet their neighbours in the grid first, and cells only those of the same strip, through boxes of the distance's width: pairs grow with the slide's
    length of seams, not with its tiles. A cell may lie in several strips; it goes if any of them drops it.
    """
    reach = 0.1 * size
    strips = neighbour_strips(tiles, size)
    at = F.when(F.col("axis") == "x", F.col("x")).otherwise(F.col("y"))

    def side(name: str) -> DataFrame:
        inside = cells.select(F.col("tile").alias(name), "cell_barcode", "x", "y").join(strips, name).filter(at.between(F.col("low"), F.col("high")))
        far = F.abs(at - (F.col("low") + F.col("high")) / 2)
        return inside.select("old", "new", "axis", F.col("cell_barcode").alias(f"{name}_cell"), F.col("x").alias(f"{name}_x"), F.col("y").alias(f"{name}_y"), far.alias(f"{name}_far"), F.floor(F.col("x") / reach).alias("bx"), F.floor(F.col("y") / reach).alias("by"))

    step = F.array(*map(F.lit, (-1, 0, 1)))
    around = side("new").withColumn("dx", F.explode(step)).withColumn("dy", F.explode(step)).withColumns({"bx": F.col("bx") + F.col("dx"), "by": F.col("by") + F.col("dy")}).drop("dx", "dy")
    d2 = (F.col("old_x") - F.col("new_x")) ** 2 + (F.col("old_y") - F.col("new_y")) ** 2
    pairs = side("old").join(around, ["old", "new", "axis", "bx", "by"]).filter(d2 < reach**2)
    farther = F.col("old_far") > F.col("new_far")
    gone = pairs.select(F.when(farther, F.col("old")).otherwise(F.col("new")).alias("tile"), F.when(farther, F.col("old_cell")).otherwise(F.col("new_cell")).alias("cell_barcode")).distinct()
    return cells.join(gone, ["tile", "cell_barcode"], "left_anti")


def cells_in_box(cells: DataFrame, x0: float, x1: float, y0: float, y1: float, inclusive: bool = True) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return cells.filter(x.between(x0, x1) & y.between(y0, y1)) if inclusive else cells.filter((x > x0) & (x < x1) & (y > y0) & (y < y1))
