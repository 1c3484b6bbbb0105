"""Queries over tiles, cells and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions.colours import clean_gene
from tessella.operators import cells as c
from tessella.operators import tiles as t
from tessella.operators.graph import shared_folder
from tessella.plans.catalog import query
from tessella.sources import readers, writers

SIZE = 2048
_GENE = "regexp_replace(gene_name, '(_rbRNA|_ntRNA)$', '')"
_REGIONS = """one AS (SELECT * FROM tiles QUALIFY row_number() OVER (PARTITION BY column_index, row_index ORDER BY tile) = 1), regions AS (
  SELECT t.tile, t.column_index, t.row_index, t.x, t.y, coalesce(trunc((l.x + 2048 - t.x) / 2 + 0.5), 0)::INT AS x0, coalesce(trunc((t.x + 2048 - r.x) / 2 + 0.5) + r.x - t.x, 2048)::INT AS x1,
    coalesce(trunc((u.y + 2048 - t.y) / 2 + 0.5), 0)::INT AS y0, coalesce(trunc((t.y + 2048 - d.y) / 2 + 0.5) + d.y - t.y, 2048)::INT AS y1
  FROM tiles t LEFT JOIN one l ON l.column_index = t.column_index - 1 AND l.row_index = t.row_index LEFT JOIN one r ON r.column_index = t.column_index + 1 AND r.row_index = t.row_index
    LEFT JOIN one u ON u.column_index = t.column_index AND u.row_index = t.row_index - 1 LEFT JOIN one d ON d.column_index = t.column_index AND d.row_index = t.row_index + 1
)"""
_KEPT = f"{_REGIONS}, kept AS (SELECT c.* FROM cells c JOIN regions g ON c.tile = g.tile AND c.x >= g.x0 AND c.x < g.x1 AND c.y >= g.y0 AND c.y < g.y1)"
_GAP = "grow AS (SELECT tile, max(raw) + 2 AS g FROM kept GROUP BY tile), offsets AS (SELECT tile, coalesce(sum(g) OVER (ORDER BY tile ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM grow)"
_COMPAT = "grow AS (SELECT tile, max(raw) AS g FROM cells GROUP BY tile), offsets AS (SELECT tile, coalesce(sum(g) OVER (ORDER BY tile ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM grow)"
_CLIPPED = f"{_KEPT}, clipped AS (SELECT r.* FROM reads r WHERE is_noise = 0 AND raw >= 0 AND EXISTS (SELECT 1 FROM kept k WHERE k.tile = r.tile AND k.raw = r.raw) UNION ALL SELECT r.* FROM reads r JOIN regions g ON r.tile = g.tile WHERE is_noise = 0 AND raw = -1 AND r.x >= g.x0 AND r.x < g.x1 AND r.y >= g.y0 AND r.y < g.y1)"
_ASSIGNED = f"assigned AS (SELECT r.*, CASE WHEN r.raw < 0 THEN 0 ELSE r.raw + o.o + 1 END::BIGINT AS cell_barcode FROM clipped r LEFT JOIN offsets o ON r.tile = o.tile)"


def _regions(tiles):
    return t.valid_regions(tiles, SIZE)


def _assigned(tiles, cells, reads):
    regions = _regions(tiles)
    kept = t.clip_cells(cells, regions)
    ids = t.assign_cell_ids(kept, "gap").select("tile", "raw", "cell_barcode")
    return t.mark_process(t.clip_reads(reads, kept, regions).join(ids, ["tile", "raw"], "left"))


@query("tiles", sql=f"WITH {_REGIONS} SELECT * FROM regions")
def valid_regions(tiles):
    """T17."""
    return _regions(tiles)


@query("tiles", "cells", sql=f"WITH {_KEPT} SELECT tile, raw, x, y, z FROM kept")
def clipped_cells(tiles, cells):
    """T22."""
    return t.clip_cells(cells, _regions(tiles))


@query("tiles", "cells", sql=f"WITH {_KEPT}, {_GAP} SELECT k.tile, k.raw, (k.raw + o + 1)::BIGINT AS cell_barcode, k.x + t.x AS \"column\", k.y + t.y AS \"row\" FROM kept k JOIN offsets USING (tile) JOIN tiles t USING (tile)")
def global_cells(tiles, cells):
    """T18, T19."""
    return t.to_global(t.assign_cell_ids(t.clip_cells(cells, _regions(tiles)), "gap"), tiles).select("tile", "raw", "cell_barcode", "column", "row")


@query("cells", sql=f"WITH {_COMPAT} SELECT c.tile, c.raw, (c.raw + o)::BIGINT AS cell_barcode FROM cells c JOIN offsets USING (tile)")
def compat_cell_ids(cells):
    """T20."""
    return t.assign_cell_ids(cells, "compat").select("tile", "raw", "cell_barcode")


@query("tiles", "cells", "reads", sql=f"WITH {_CLIPPED}, {_GAP}, {_ASSIGNED} SELECT read_id, tile, raw, gene_name, cell_barcode FROM assigned")
def global_reads(tiles, cells, reads):
    """T18, T19, T21, T23."""
    return _assigned(tiles, cells, reads).select("read_id", "tile", "raw", "gene_name", "cell_barcode")


@query("tiles", "cells", "reads", sql=f"WITH {_CLIPPED}, {_GAP}, {_ASSIGNED} SELECT cell_barcode, {_GENE} AS gene, count(*) AS total, count(*) FILTER (suffix(gene_name, '_rbRNA')) AS rb, count(*) FILTER (suffix(gene_name, '_ntRNA')) AS nt FROM assigned WHERE cell_barcode <> 0 GROUP BY 1, 2")
def count_matrix(tiles, cells, reads):
    """C4."""
    return c.count_matrix(_assigned(tiles, cells, reads))


_GENES = [f"gene{k}" for k in range(50)]


@query("reads", sql="SELECT raw AS cell_barcode, " + ", ".join(f"coalesce(sum(1) FILTER ({_GENE} = '{n}'), 0)::BIGINT AS {n}" for n in _GENES) + " FROM reads WHERE raw <> 0 GROUP BY raw")
def wide_counts(reads):
    """S14."""
    return c.wide_counts(c.count_matrix(reads.withColumnRenamed("raw", "cell_barcode")), _GENES)


@query("reads", sql="SELECT gene, " + ", ".join(f"coalesce(max(n) FILTER (raw = {k}), 0) AS \"{k}\"" for k in range(-1, 16)) + f" FROM (SELECT {_GENE} AS gene, raw, count(*) AS n FROM reads GROUP BY 1, 2) GROUP BY gene")
def gene_by_cell(reads):
    """All genes and all cells of a field of view."""
    r = reads.select(clean_gene(F.col("gene_name")).alias("gene"), F.col("raw").alias("cell_barcode"))
    return c.gene_by_cell(r, r.select("gene"), list(range(-1, 16)))


@query("cells", "reads", sql=f"WITH {_COMPAT}, ids AS (SELECT DISTINCT c.tile, c.raw, (c.raw + o)::BIGINT AS cell_barcode FROM cells c JOIN offsets USING (tile)) SELECT DISTINCT r.read_id, r.tile, r.raw, CASE WHEN r.raw < 0 THEN 0 ELSE cell_barcode END AS cell_barcode FROM reads r LEFT JOIN ids USING (tile, raw) WHERE is_noise = 0 AND (r.raw < 0 OR cell_barcode IS NOT NULL)")
def merged_fovs(cells, reads):
    """T24."""
    return t.merge_fovs(reads, cells).select("read_id", "tile", "raw", "cell_barcode").distinct()


@query("reads", sql="SELECT DISTINCT tile, gene_name, trunc(x / 3)::INT AS x, trunc(y / 7)::INT AS y FROM reads")
def final_reads(reads):
    """T25."""
    return t.finalize_reads(reads.select("tile", "gene_name", (F.col("x") / 3).alias("x"), (F.col("y") / 7).alias("y")), ("x", "y"))


@query("reads", "cells", sql="""WITH p AS (SELECT DISTINCT x, y, z, tile, raw + k AS raw FROM reads, range(-1, 2) t(k) WHERE raw >= 0), d AS (SELECT p.x, p.y, p.z, c.tile * 1000 + c.raw AS cell_barcode, power(p.x - c.x, 2) + power(p.y - c.y, 2) + power(p.z - c.z, 2) AS far FROM p JOIN cells c USING (tile, raw))
  SELECT x, y, z, arg_min(cell_barcode, (far, cell_barcode)) AS cell_barcode FROM d GROUP BY x, y, z""")
def nearest_cells(reads, cells):
    """Reads that windows have assigned to a cell, to the one before and to the one behind."""
    name = lambda raw: F.col("tile") * 1000 + raw
    assigned = reads.filter("raw >= 0").select("x", "y", "z", F.explode(F.array(*[name(F.col("raw") + k) for k in (-1, 0, 1)])).alias("cell_barcode")).distinct()
    return t.resolve_multi_assign(assigned.filter("cell_barcode % 1000 < 900"), cells.select(name(F.col("raw")).alias("cell_barcode"), "x", "y", "z"))


_TWINS = """strips AS (
  SELECT a.tile AS old, b.tile AS new, 'x' AS axis, b.x AS low, a.x + 2048 AS high FROM tiles a JOIN tiles b ON b.column_index = a.column_index + 1 AND b.row_index = a.row_index
  UNION ALL SELECT a.tile, b.tile, 'y', b.y, a.y + 2048 FROM tiles a JOIN tiles b ON b.column_index = a.column_index AND b.row_index = a.row_index + 1
), g AS (SELECT c.tile, c.raw, c.x + t.x AS x, c.y + t.y AS y FROM cells c JOIN tiles t USING (tile)),
sides AS (SELECT s.*, g.tile, g.raw, g.x, g.y, abs(CASE WHEN axis = 'x' THEN g.x ELSE g.y END - (low + high) / 2.0) AS far FROM strips s JOIN g ON g.tile IN (s.old, s.new) WHERE CASE WHEN axis = 'x' THEN g.x ELSE g.y END BETWEEN low AND high),
pairs AS (SELECT o.tile AS o_tile, o.raw AS o_raw, n.tile AS n_tile, n.raw AS n_raw, o.far > n.far AS older FROM sides o JOIN sides n ON o.old = n.old AND o.new = n.new AND o.axis = n.axis AND o.tile = o.old AND n.tile = n.new
  WHERE power(o.x - n.x, 2) + power(o.y - n.y, 2) < power(204.8, 2)),
gone AS (SELECT o_tile AS tile, o_raw AS raw FROM pairs WHERE older UNION SELECT n_tile, n_raw FROM pairs WHERE NOT older)"""


@query("cells", "tiles", sql=f"WITH {_TWINS} SELECT tile, raw, x, y FROM g WHERE (tile, raw) NOT IN (SELECT (tile, raw) FROM gone)")
def twin_cells(cells, tiles):
    """Over the seams of the whole mosaic."""
    at = t.to_global(cells.select("tile", F.col("raw").alias("cell_barcode"), "x", "y"), tiles)
    left = t.drop_twins(at.select("tile", "cell_barcode", F.col("column").alias("x"), F.col("row").alias("y")), tiles, SIZE)
    return left.withColumnRenamed("cell_barcode", "raw")


@query("cells", sql="WITH a AS (SELECT * FROM cells WHERE tile % 2 = 0 AND x BETWEEN 0 AND 400), b AS (SELECT * FROM cells WHERE tile % 2 = 1 AND x BETWEEN 0 AND 400), p AS (SELECT a.tile AS ot, a.raw AS o_raw, b.tile AS nt, b.raw AS n_raw, abs(a.x - 200) > abs(b.x - 200) AS far FROM a JOIN b ON a.tile + 1 = b.tile AND power(a.x - b.x, 2) + power(a.y - b.y, 2) < power(51.2, 2)) SELECT tile, raw FROM a WHERE (tile, raw) NOT IN (SELECT (ot, o_raw) FROM p WHERE far) UNION ALL SELECT tile, raw FROM b WHERE (tile, raw) NOT IN (SELECT (nt, n_raw) FROM p WHERE NOT far)")
def strip_twins(cells):
    """T27 for a strip that is the same in each pair of tiles: pairs lie far apart on the other axis."""
    low = cells.filter("x between 0 and 400").withColumn("pair", F.floor(F.col("tile") / 2))
    named = low.select((F.col("raw") + F.col("tile") * 1000).cast("long").alias("cell_barcode"), "x", (F.col("y") + F.col("pair") * 10000).alias("y"), "tile")
    old, new = t.drop_twin_cells(named.filter("tile % 2 = 0").drop("tile"), named.filter("tile % 2 = 1").drop("tile"), 0, 400, 512)
    return old.unionByName(new).select(F.floor(F.col("cell_barcode") / 1000).cast("int").alias("tile"), (F.col("cell_barcode") % 1000).cast("int").alias("raw"))


@query("cells", sql="SELECT tile, raw, x, y, z FROM cells WHERE x > 100 AND x < 900 AND y > 100 AND y < 900")
def boxed_cells(cells):
    """T28."""
    return t.cells_in_box(cells, 100, 900, 100, 900, inclusive=False)


@query("spots", sql="""WITH g AS (SELECT i * 4 + j + 1 AS t, CASE WHEN i = 0 THEN 1 ELSE i * 128 - 12 + 1 END AS sx, CASE WHEN i = 3 THEN 512 ELSE (i + 1) * 128 + 12 END AS ex, CASE WHEN j = 0 THEN 1 ELSE j * 128 - 12 + 1 END AS sy, CASE WHEN j = 3 THEN 512 ELSE (j + 1) * 128 + 12 END AS ey FROM range(4) a(i), range(4) b(j))
  SELECT spot_id, fov, t::INT AS t, (x - sx + 1)::INT AS local_x, (y - sy + 1)::INT AS local_y FROM spots JOIN g ON x BETWEEN sx AND ex AND y BETWEEN sy AND ey""")
def subtile_points(spots):
    """T1, T2."""
    return t.assign_subtiles(spots, 512, 4).select("spot_id", "fov", "t", "local_x", "local_y")


@query("spots", sql="SELECT spot_id, fov, x, y, ((least(4, floor((x - 1) / 128) + 1) - 1) * 4 + least(4, floor((y - 1) / 128) + 1))::INT AS t FROM spots")
def stitched_points(spots):
    """Split into subtiles, back to tile coordinates, and stitched to one copy each."""
    split = t.assign_subtiles(spots, 512, 4)
    grid = t.subtile_grid(spots.sparkSession, 512, 4)
    local = split.select("spot_id", "fov", "t", F.col("local_x").alias("x"), F.col("local_y").alias("y"))
    from tessella.operators.decode import to_tile_coords

    return t.stitch_points(to_tile_coords(local, grid), 512, 4).select("spot_id", "fov", "x", "y", "t")


@query("tiles", sql="WITH s AS (SELECT axis, c, c - lag(c) OVER (PARTITION BY axis ORDER BY c) AS step FROM (SELECT DISTINCT 'x' AS axis, x AS c FROM tiles UNION SELECT DISTINCT 'y', y FROM tiles)) SELECT axis, count(*) AS n, min(c) AS low, max(c) AS high, round(avg(step) FILTER (step > 1024), 6) AS mean_step, round((1 - avg(step) FILTER (step > 1024) / 2048) * 100, 6) AS overlap_percent FROM s GROUP BY axis")
def tile_spacing(tiles):
    """T12."""
    return t.spacing_stats(tiles, SIZE).withColumns({"mean_step": F.round("mean_step", 6), "overlap_percent": F.round("overlap_percent", 6)})


@query("tiles", sql="SELECT tile, column_index, row_index FROM tiles")
def tile_grid(tiles):
    """The grid that the view's coordinates came from is found again."""
    return t.logical_grid(tiles, 300)


@query("slides", sql="""WITH RECURSIVE places AS (SELECT DISTINCT slide, 'x' AS axis, x::DOUBLE AS c FROM slides UNION SELECT DISTINCT slide, 'y', y FROM slides), o AS (SELECT *, row_number() OVER (PARTITION BY slide, axis ORDER BY c) AS k FROM places),
  f AS (SELECT slide, axis, k, c AS total, 1 AS n, 0 AS g FROM o WHERE k = 1 UNION ALL
    SELECT o.slide, o.axis, o.k, CASE WHEN o.c - f.total / f.n <= 300 THEN f.total + o.c ELSE o.c END, CASE WHEN o.c - f.total / f.n <= 300 THEN f.n + 1 ELSE 1 END, CASE WHEN o.c - f.total / f.n <= 300 THEN f.g ELSE f.g + 1 END
    FROM f JOIN o ON o.slide = f.slide AND o.axis = f.axis AND o.k = f.k + 1),
  centres AS (SELECT slide, axis, g, arg_max(total / n, k) AS m FROM f GROUP BY slide, axis, g)
  SELECT s.slide, s.tile, (SELECT min(g) FROM centres c WHERE c.slide = s.slide AND c.axis = 'x' AND abs(s.x - c.m) <= 300) AS column_index, (SELECT min(g) FROM centres c WHERE c.slide = s.slide AND c.axis = 'y' AND abs(s.y - c.m) <= 300) AS row_index FROM slides s""")
def slide_grids(slides):
    """T13 over several slides whose coordinates drift, so that groups are told apart by their running means."""
    return t.logical_grid(slides, 300, ("slide",))


@query("tiles", sql="SELECT tile, x, y, x + 1024.0::DOUBLE AS center_x_px, y + 1024.0::DOUBLE AS center_y_px, 2048 AS width_px, 2048 AS height_px FROM tiles")
def tile_summaries(tiles):
    """T11."""
    return t.tile_summary(tiles, SIZE, SIZE)


@query("tiles", sql="SELECT tile, x - min(x) OVER () AS x_obs, y - min(y) OVER () AS y_obs, x + 3 AS x_exp, y + 5 AS y_exp, column_index, row_index FROM tiles")
def tuned_tiles(tiles):
    """T14."""
    return t.tune_coords(tiles, tiles.select("tile", (F.col("x") + 3).alias("x"), (F.col("y") + 5).alias("y")), tiles.select("tile", "column_index", "row_index"))


@query("tiles", sql="SELECT max(x) + 2048 AS width, max(y) + 2048 AS height, count(DISTINCT floor(x / 1843.2)) AS n_columns, count(DISTINCT floor(y / 1843.2)) AS n_rows FROM tiles")
def mosaic(tiles):
    """T14."""
    return t.mosaic_extent(tiles, SIZE)


@query("tiles", sql="SELECT tile, floor((tile - 1) / 11)::INT AS column_index, ((tile - 1) % 11)::INT AS row_index FROM tiles")
def counted_grid(tiles):
    """T15."""
    return t.grid_by_count(tiles, 11)


@query("tiles", sql="WITH moved AS (SELECT tile, column_index, row_index, CASE WHEN tile % 7 = 0 THEN x + 5000 ELSE x END AS x, y FROM tiles), m AS (SELECT *, median(x) OVER (PARTITION BY column_index) AS mx, median(y) OVER (PARTITION BY row_index) AS my FROM moved) SELECT tile, column_index, row_index, x, y FROM m WHERE abs(x - mx) < 3072 AND abs(y - my) < 3072")
def aligned_tiles(tiles):
    """T16."""
    return t.drop_misaligned(tiles.withColumn("x", F.when(F.col("tile") % 7 == 0, F.col("x") + 5000).otherwise(F.col("x"))), SIZE)


@query("supplier", sql="SELECT s_suppkey, 'Position' || (s_suppkey * 7 % 1009) AS name FROM supplier WHERE s_suppkey * 7 % 1009 NOT BETWEEN 5 AND 90")
def kept_positions(supplier):
    """T10."""
    return t.drop_position_range(supplier.select("s_suppkey", F.concat(F.lit("Position"), (F.col("s_suppkey") * 7 % 1009).cast("string")).alias("name")), 5, 90)


@query("supplier", sql="""WITH f AS (SELECT 'Position' || (s_suppkey * 7 % 1009) AS name, row_number() OVER (ORDER BY s_suppkey * 7 % 1009) AS rank FROM supplier), p AS (SELECT s_suppkey AS pos_no, row_number() OVER (ORDER BY s_suppkey) - 3 AS rank FROM supplier) SELECT name, pos_no, rank::INT AS rank FROM f JOIN p USING (rank)""")
def paired_files(supplier):
    """T9, L5."""
    files = supplier.select(F.concat(F.lit("Position"), (F.col("s_suppkey") * 7 % 1009).cast("string")).alias("name"))
    return t.pair_by_rank(files, supplier.select(F.col("s_suppkey").alias("pos_no")), 3).select("name", "pos_no", "rank")


@query("tiles", sql="SELECT tile, round((x * 0.65 - min(x * 0.65) OVER ()) / 0.65, 6) AS pos_x_px, round((max(y * 0.65) OVER () - y * 0.65) / 0.65, 6) AS pos_y_px FROM tiles")
def stage_pixels(tiles):
    """T8."""
    stage = tiles.select("tile", (F.col("x") * 0.65).alias("phys_x"), (F.col("y") * 0.65).alias("phys_y"))
    return t.stage_to_pixels(stage, 0.65, invert=True).select("tile", F.round("pos_x_px", 6).alias("pos_x_px"), F.round("pos_y_px", 6).alias("pos_y_px"))


_SCAN = """WITH n AS (SELECT max(column_index) + 1 AS c FROM tiles), g AS (SELECT row_index AS "row", column_index AS col, tile, {p} + 1 AS p FROM tiles, n)
  SELECT tile, "row", col, p::INT AS position, round(col * 2048 * 0.9::DOUBLE, 6) AS x, round("row" * 2048 * 0.9::DOUBLE, 6) AS y FROM g"""


def _scanned(tiles, scan: str, primary: str, secondary: str):
    columns = tiles.agg(F.max("column_index")).first()[0] + 1
    g = t.grid_to_pixels(t.scan_grid(tiles.sparkSession, 5, columns, 1, scan, primary, secondary), SIZE, SIZE, "10%")
    at = tiles.select("tile", F.col("row_index").alias("row"), F.col("column_index").alias("col"))
    return at.join(g, ["row", "col"]).select("tile", "row", "col", "position", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("tiles", sql=_SCAN.format(p="(4 - row_index) * c + CASE WHEN row_index % 2 = 1 THEN c - 1 - column_index ELSE column_index END"))
def scanned_tiles(tiles):
    """A snake by rows, from below."""
    return _scanned(tiles, "S", "R", "U")


@query("tiles", sql=_SCAN.format(p="column_index * 5 + row_index"))
def raster_tiles(tiles):
    """A raster by columns."""
    return _scanned(tiles, "R", "D", "R")


def _scan_sql(scan: str, primary: str, secondary: str) -> str:
    """A cell's position: the lines before its own, and its place in its line, turned in every other line of a snake."""
    outer, inner, lines, n = ("r", "k", 5, "c") if primary in "LR" else ("k", "r", "c", 5)
    line = f"({lines} - 1 - {outer})" if secondary in "UL" else outer
    back = primary in "LU"
    ahead, behind = (f"({n} - 1 - {inner})", inner) if back else (inner, f"({n} - 1 - {inner})")
    place = f"CASE WHEN {outer} % 2 = 1 THEN {behind} ELSE {ahead} END" if scan == "S" else ahead
    return f"SELECT '{scan}{primary}{secondary}' AS mode, tile, ({line} * {n} + {place} + 1)::INT AS position FROM g"


_MODES = [(s, p, q) for s in "SR" for p, q in (("R", "D"), ("R", "U"), ("L", "D"), ("L", "U"), ("D", "R"), ("D", "L"), ("U", "R"), ("U", "L"))]


@query("tiles", sql="WITH n AS (SELECT max(column_index) + 1 AS c FROM tiles), g AS (SELECT tile, row_index AS r, column_index AS k, c FROM tiles, n) " + " UNION ALL ".join(_scan_sql(*m) for m in _MODES))
def scan_modes(tiles):
    """All sixteen modes."""
    parts = [_scanned(tiles, *m).select(F.lit("".join(m)).alias("mode"), "tile", "position") for m in _MODES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("tiles", sql="SELECT tile, round((x * 0.65 - min(x * 0.65) OVER ()) / 0.65, 6) AS pos_x_px, round((y * 0.65 - min(y * 0.65) OVER ()) / 0.65, 6) AS pos_y_px FROM tiles")
def stage_pixels_down(tiles):
    """T8 with y as it is."""
    stage = tiles.select("tile", (F.col("x") * 0.65).alias("phys_x"), (F.col("y") * 0.65).alias("phys_y"))
    return t.stage_to_pixels(stage, 0.65).select("tile", F.round("pos_x_px", 6).alias("pos_x_px"), F.round("pos_y_px", 6).alias("pos_y_px"))


@query("spots", sql="""WITH b AS (SELECT a.i * 90 + 1 AS x0, least(512, a.i * 90 + 100) AS x1, b.i * 90 + 1 AS y0, least(512, b.i * 90 + 100) AS y1 FROM range(6) a(i), range(6) b(i)) SELECT x0, y0, count(*) AS n FROM spots JOIN b ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 WHERE x1 - x0 + 1 >= 70 AND y1 - y0 + 1 >= 70 GROUP BY x0, y0""")
def block_counts(spots):
    """Points of overlapping blocks, met through the block before and the block of each point."""
    blocks = t.blocks(spots.sparkSession, 512, 512, 100, 10, 70)
    of = lambda v: F.explode(F.array(F.floor((F.col(v) - 1) / 90) * 90 + 1, F.floor((F.col(v) - 1) / 90) * 90 - 89))
    at = spots.withColumn("x0", of("x")).withColumn("y0", of("y"))
    return at.join(blocks, ["x0", "y0"]).filter("x <= x1 and y <= y1").groupBy("x0", "y0").agg(F.count(F.lit(1)).alias("n")).select(F.col("x0").cast("long").alias("x0"), F.col("y0").cast("long").alias("y0"), "n")


@query("spots", "labels", sql="SELECT s.spot_id, s.fov, coalesce(l.label, 0) AS label FROM spots s LEFT JOIN labels l USING (fov, x, y, z)")
def spot_labels(spots, labels):
    """C1."""
    return c.assign_labels(spots, labels).select("spot_id", "fov", "label")


_BAYSOR = "flat AS (SELECT fov, x AS px, y AS py, max(label) AS label FROM labels GROUP BY 1, 2, 3), hit AS (SELECT s.spot_id, s.fov, s.x / 8.0 AS sx, coalesce(CASE WHEN round_even(s.x / 8.0, 0) BETWEEN 0 AND 63 AND round_even(s.y / 8.0, 0) BETWEEN 0 AND 63 THEN f.label END, 0) AS label FROM spots s LEFT JOIN flat f ON f.fov = s.fov AND f.px = round_even(s.x / 8.0, 0) AND f.py = round_even(s.y / 8.0, 0))"


@query("spots", "labels", sql=f"WITH {_BAYSOR} SELECT spot_id, fov, label, round(sx::DOUBLE * 0.2, 6) AS x_um FROM hit")
def baysor_table(spots, labels):
    """C2."""
    s = spots.select("spot_id", "fov", (F.col("x") / 8).alias("x"), (F.col("y") / 8).alias("y"), "z")
    return c.baysor_input(s, labels, 64, 64, 0.2, 0.4).select("spot_id", "fov", "label", F.round("x_um", 6).alias("x_um"))


@query("spots", "labels", sql=f"WITH {_BAYSOR} SELECT fov, count(*) AS n, count(*) FILTER (label > 0) AS n_assigned, round(count(*) FILTER (label > 0) / count(*), 9) AS share FROM hit GROUP BY fov")
def baysor_share(spots, labels):
    """C2."""
    s = spots.select("spot_id", "fov", (F.col("x") / 8).alias("x"), (F.col("y") / 8).alias("y"), "z")
    return c.assigned_share(c.baysor_input(s, labels, 64, 64, 0.2, 0.4)).withColumn("share", F.round("share", 9))


@query("spots", "labels", sql="""WITH cell AS (SELECT fov, x, y, max(label) AS cell FROM labels GROUP BY 1, 2, 3), nuc AS (SELECT fov, x, y, max(label) AS nucleus FROM labels WHERE x % 8 BETWEEN 2 AND 5 GROUP BY 1, 2, 3)
  SELECT s.fov, c.cell, s.part_no % 20 AS gene, count(*) AS n, count(*) FILTER (nucleus > 0) AS n_nucleus FROM spots s JOIN cell c ON c.fov = s.fov AND c.x = least(64, s.x) AND c.y = least(64, s.y) LEFT JOIN nuc n ON n.fov = s.fov AND n.x = least(64, s.x) AND n.y = least(64, s.y) GROUP BY 1, 2, 3""")
def mask_counts(spots, labels):
    """C5."""
    return c.count_by_mask(spots.withColumn("gene", F.col("part_no") % 20), labels, labels.filter("x % 8 between 2 and 5"), 64, 64)


@query("labels", sql="""WITH cell AS (SELECT fov, x, y, max(label) AS cell FROM labels GROUP BY 1, 2, 3), nuc AS (SELECT fov, x, y, max(label) * 10 + max(x) % 2 AS nucleus FROM labels WHERE x % 8 BETWEEN 2 AND 5 GROUP BY 1, 2, 3),
  w AS (SELECT n.fov, nucleus, min(cell) AS cell FROM nuc n LEFT JOIN cell c USING (fov, x, y) GROUP BY 1, 2 HAVING count(*) = count(cell) AND min(cell) = max(cell)), f AS (SELECT fov, cell, min(nucleus) AS nucleus FROM w GROUP BY 1, 2)
  SELECT fov, cell, nucleus, row_number() OVER (PARTITION BY fov ORDER BY cell)::INT AS id FROM f""")
def matched_nuclei(labels):
    """C6."""
    flat = labels.groupBy("fov", "x", "y").agg(F.max("label").alias("label"))
    nuclei = flat.filter("x % 8 between 2 and 5").withColumn("label", F.col("label") * 10 + F.col("x") % 2)
    return c.match_cells_nuclei(flat, nuclei)


@query("ordered_reads", sql=f"WITH f AS (SELECT {_GENE} AS gene, min(read_id) AS first FROM reads GROUP BY 1) SELECT gene, row_number() OVER (ORDER BY first, gene)::INT AS id FROM f")
def gene_numbers(reads):
    """C8."""
    return c.gene_ids(reads.select("row_order", clean_gene(F.col("gene_name")).alias("gene")), "row_order")


def _turned(sign: str, rule: str) -> str:
    a = f"{sign}0.3490658503988659"
    return f"{rule.format('(x - 1024) * cos(' + a + ') + (y - 1024) * sin(' + a + ') + 1024 + 0.5')}::INT AS x, {rule.format('-(x - 1024) * sin(' + a + ') + (y - 1024) * cos(' + a + ') + 1024 + 0.5')}::INT AS y"


@query("reads", sql=" UNION ALL ".join(f"SELECT '{name}' AS variant, read_id, {_turned(sign, rule)} FROM reads WHERE z <= 5" for name, sign, rule in (("clockwise", "-", "floor({})"), ("counter", "", "floor({})"), ("counter_trunc", "", "trunc({})"))))
def rotated_reads(reads):
    """All three rules."""
    out = None
    for variant in ("clockwise", "counter", "counter_trunc"):
        part = c.prepare_spots(c.rotate_points(reads.filter("z <= 5"), 20, SIZE, SIZE, variant), 5).select(F.lit(variant).alias("variant"), "read_id", F.col("spot_location_1").alias("x"), F.col("spot_location_2").alias("y"))
        out = part if out is None else out.unionByName(part)
    return out


@query("ordered_reads", sql=f"""WITH raw0 AS (SELECT read_id, tile, gene_name, {_GENE} AS gene, x, y, z FROM reads), p AS (SELECT read_id AS id, tile, gene, x + 2 AS x, y, z FROM raw0),
  m AS (SELECT p.id, arg_min(r.gene_name, (power(p.x - r.x, 2) + power(p.y - r.y, 2), r.read_id)) AS full_name FROM p JOIN raw0 r ON r.tile = p.tile AND r.gene = p.gene AND r.z = p.z AND power(p.x - r.x, 2) + power(p.y - r.y, 2) < 25 GROUP BY p.id)
  SELECT p.id, coalesce(full_name, p.gene) AS gene_name, full_name IS NOT NULL AS matched FROM p LEFT JOIN m USING (id)""")
def restored_suffixes(reads):
    """C11, every field of view by itself."""
    raw = reads.select(F.col("tile").alias("fov"), "gene_name", "x", "y", "z", F.col("row_order").alias("raw_order"))
    done = reads.select(F.col("tile").alias("fov"), F.col("read_id").alias("id"), clean_gene(F.col("gene_name")).alias("gene"), (F.col("x") + 2).alias("x"), "y", "z")
    return c.restore_suffix(done, raw, 5).select("id", "gene_name", "matched")


_WINDOWS = "win AS (SELECT read_id, tile, wx, wy FROM reads, range(0, 8) a(wx), range(0, 8) b(wy) WHERE wx BETWEEN greatest(0, floor((x - 30) / 300)) AND floor((x + 30) / 300) AND wy BETWEEN greatest(0, floor((y - 30) / 300)) AND floor((y + 30) / 300))"


@query("reads", sql=f"WITH {_WINDOWS} SELECT read_id, tile AS fov, wx::INT AS wx, wy::INT AS wy FROM win WHERE (tile, wx, wy) IN (SELECT (tile, wx, wy) FROM win GROUP BY tile, wx, wy HAVING count(*) >= 14)")
def full_windows(reads):
    """A field of view is a tile."""
    return c.filter_small_windows(c.window_spots(reads.withColumnRenamed("tile", "fov"), 300, 0.1), 14).select("read_id", "fov", "wx", "wy")


@query("reads", sql="""WITH counts AS (SELECT tile, l, floor(x * pow(2, l) / 600)::INT AS wx, floor(y * pow(2, l) / 600)::INT AS wy, count(*) AS n FROM reads, range(0, 4) t(l) GROUP BY ALL),
  leaves AS (SELECT a.*, 600 / pow(2, a.l) AS w, ceil(600 / pow(2, a.l) * 0.1) AS m FROM counts a LEFT JOIN counts p ON p.tile = a.tile AND p.l = a.l - 1 AND p.wx = a.wx // 2 AND p.wy = a.wy // 2 WHERE (a.l = 0 OR p.n > 12) AND (a.n <= 12 OR a.l = 3))
  SELECT read_id, r.tile AS fov, l::INT AS level, wx, wy FROM reads r JOIN leaves v ON v.tile = r.tile AND wx BETWEEN floor((x - m) / w) AND floor((x + m) / w) AND wy BETWEEN floor((y - m) / w) AND floor((y + m) / w)""")
def split_windows(reads):
    """Windows of at most twelve reads of their own, split in four where they hold more."""
    return c.split_windows(reads.select("read_id", F.col("tile").alias("fov"), "x", "y"), 600, 0.1, 12, 3).select("read_id", "fov", "level", "wx", "wy")


@query("reads", sql=f"WITH {_WINDOWS}, p AS (SELECT read_id AS id, wx * 100 + wy AS w, (wx * 100 + wy) % 7 - 1 AS cluster FROM win) SELECT id, arg_min(cluster, w) AS first_cluster, arg_max(cluster, w) AS last_cluster FROM p GROUP BY id")
def window_clusters(reads):
    """C14, C15, C16, C17."""
    p = c.window_spots(reads, 300, 0.1).select(F.col("read_id").alias("id"), (F.col("wx") * 100 + F.col("wy")).cast("long").alias("window")).withColumn("cluster", F.col("window") % 7 - 1)
    first = c.ensure_ids(c.union_windows([p.filter("window % 2 = 0"), p.filter("window % 2 = 1")]), ["window"])
    both = c.upsert_assignments(first.select("id", "cluster", F.col("cluster").alias("first_cluster")), p)
    return both.select("id", "first_cluster", F.col("cluster").alias("last_cluster"))


@query("reads", sql="SELECT tile, CASE WHEN raw >= 0 THEN 'soma' WHEN raw = -1 AND is_noise = 0 THEN 'process' END AS kind, count(*) AS n FROM reads GROUP BY 1, 2")
def soma_counts(reads):
    """C18."""
    return c.soma_process(reads).groupBy("tile", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("reads", sql="SELECT tile * 1000 + raw AS cell_barcode, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, count(*) AS n FROM reads WHERE raw >= 0 GROUP BY 1")
def centroids(reads):
    """C17, C19, C20."""
    r = c.standardise_spots(c.assigned_reads(reads, "raw").select((F.col("tile") * 1000 + F.col("raw")).alias("CELL_BARCODE"), "x", "y", "z", F.col("gene_name").alias("Gene")))
    return c.cell_centroids(r).select("cell_barcode", *[F.round(a, 6).alias(a) for a in "xyz"], "n")


#: A hull has an edge from a to b if every other point lies to its left, or on it between them.
_HULLS = """WITH p AS (SELECT DISTINCT tile * 1000 + raw + 1 AS cell, x::DOUBLE AS x, y::DOUBLE AS y FROM reads),
  e AS (SELECT a.cell, a.x, a.y FROM p a JOIN p b ON a.cell = b.cell AND (a.x <> b.x OR a.y <> b.y) JOIN p c ON c.cell = a.cell GROUP BY a.cell, a.x, a.y, b.x, b.y
    HAVING bool_and((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) > 0 OR ((b.x - a.x) * (c.y - a.y) = (b.y - a.y) * (c.x - a.x) AND c.x BETWEEN least(a.x, b.x) AND greatest(a.x, b.x) AND c.y BETWEEN least(a.y, b.y) AND greatest(a.y, b.y))))
  SELECT cell, x, y, count(*) OVER (PARTITION BY cell) AS corners FROM (SELECT DISTINCT * FROM e) QUALIFY corners > 2"""


def _corners(rings):
    open_ = rings.select("cell", F.slice("ring", 1, F.size("ring") - 1).alias("ring"))
    return open_.select("cell", F.explode("ring").alias("p"), F.size("ring").cast("long").alias("corners")).select("cell", "p.x", "p.y", "corners")


@query("reads", sql=_HULLS)
def hulls(reads):
    """The corners of every cell."""
    return _corners(c.cell_hulls(reads.withColumn("cell_barcode", F.col("tile") * 1000 + F.col("raw") + 1)))


@query("reads", sql=_HULLS)
def polygon_file(reads):
    """Polygons written as JSON and read again."""
    folder = shared_folder(reads.sparkSession, "polygons")
    writers.write_polygons(c.cell_hulls(reads.withColumn("cell_barcode", F.col("tile") * 1000 + F.col("raw") + 1)), folder)
    return _corners(readers.read_polygons(reads.sparkSession, folder))


_EXTERNAL = "WITH k AS (SELECT raw + tile * 1000 AS cell, min(read_id) AS first FROM reads GROUP BY 1), n AS (SELECT cell, row_number() OVER (ORDER BY first, cell) - 1 AS cell_no FROM k), r AS (SELECT read_id, cell_no::INT AS cell_no, is_noise < 0 AS is_noise, round(x / 0.65, 6) AS x FROM reads JOIN n ON raw + tile * 1000 = cell)"


def _external(reads):
    return reads.select("read_id", "row_order", (F.col("raw") + F.col("tile") * 1000).cast("string").alias("cell"), F.when(F.col("is_noise") < 0, "True").otherwise("false").alias("is_noise"), "x", "y")


def _shown(cells):
    return cells.select("read_id", F.col("cell_no").cast("int").alias("cell_no"), "is_noise", F.round("x", 6).alias("x"))


@query("ordered_reads", sql=f"{_EXTERNAL} SELECT * FROM r")
def external_table(reads):
    """C22."""
    return _shown(c.external_cells(_external(reads), 0.65, "row_order"))


@query("ordered_reads", sql=f"{_EXTERNAL} SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (ORDER BY read_id) AS k FROM r) WHERE k % 5 = 1")
def thinned_table(reads):
    """Every fifth row, as it is shown."""
    return _shown(c.external_cells(_external(reads), 0.65, "row_order", every=5))


@query("reads", sql="SELECT read_id, is_noise + 1 - 1 AS is_noise FROM reads")
def shifted_noise(reads):
    """C23."""
    return c.shift_noise(reads.withColumn("is_noise", F.col("is_noise") + 5)).select("read_id", F.col("is_noise"))
