"""Queries over voxel tables and spots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import spots as s
from tessella.operators import voxels as v
from tessella.plans.catalog import query

N = (32, 32, 4)
_KEY = "fov, round_no, channel"


def _components(name: str, nodes: str, keys: str, same: str = "true", plane: bool = False) -> str:
    """SQL: `{name}` are the nodes with `component`, the least id of their object; nodes touch inside one set of keys, where `same` (of a, b) holds.

    Ids carry fov, round, channel and place, so they are unique over all nodes.
    """
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    near = "true" if not plane else "dz = 0"
    return f"""{name}_n AS (SELECT *, (((fov * 8 + round_no) * 8 + channel) * 64 + z) * 4096 + y * 64 + x AS id FROM {nodes}),
      {name}_e AS (SELECT a.id AS a, b.id AS b FROM {name}_n a JOIN around ON {near} JOIN {name}_n b ON {on} AND b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx AND {same}),
      {name}_r AS (SELECT id AS n, id AS l FROM {name}_n UNION SELECT b, l FROM {name}_r JOIN {name}_e ON a = n WHERE l < b),
      {name} AS (SELECT v.*, c.component FROM {name}_n v JOIN (SELECT n, min(l) AS component FROM {name}_r GROUP BY n) c ON c.n = v.id)"""


_AROUND = "around AS (SELECT a.i AS dz, b.i AS dy, c.i AS dx FROM range(-1, 2) a(i), range(-1, 2) b(i), range(-1, 2) c(i) WHERE a.i <> 0 OR b.i <> 0 OR c.i <> 0)"


def _maxima(name: str, nodes: str, keys: str, plane: bool = False) -> str:
    """SQL: `{name}` are the nodes on plateaus of equal value without a greater neighbour."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    near = "true" if not plane else "dz = 0"
    return f"""{name}_m AS (SELECT a.fov, a.round_no, a.channel, a.z, a.y, a.x, a.value, coalesce(bool_or(b.value > a.value), false) AS beaten FROM {nodes} a JOIN around ON {near}
        LEFT JOIN {nodes} b ON {on} AND b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL),
      {_components(name + '_p', name + '_m', keys, 'a.value = b.value', plane)},
      {name} AS (SELECT fov, round_no, channel, z, y, x, value FROM {name}_p WHERE component NOT IN (SELECT component FROM {name}_p WHERE beaten))"""


def _dims(voxels):
    return voxels.select("fov").distinct().withColumn("volume", F.lit(N[0] * N[1] * N[2]))


_FULL = "ch AS (SELECT DISTINCT fov, round_no, channel FROM voxels), dense AS (SELECT fov, round_no, channel, value FROM voxels UNION ALL SELECT c.fov, c.round_no, c.channel, 0 FROM (SELECT fov, round_no, channel, 4096 - count(*) AS missing FROM voxels GROUP BY ALL) c, range(4096) r(i) WHERE i < missing), ranked AS (SELECT *, row_number() OVER (PARTITION BY fov, round_no, channel ORDER BY value) AS k FROM dense)"


def _bound(p: float, name: str) -> str:
    rank = f"greatest(1, least(4096, {p} * 4096 / 100.0 + 0.5))"
    return f"max(value) FILTER (k = floor({rank})) + (max(value) FILTER (k = ceil({rank})) - max(value) FILTER (k = floor({rank}))) * ({rank} - floor({rank})) AS {name}"


@query("voxels", sql=f"WITH {_FULL}, b AS (SELECT {_KEY}, {_bound(10, 'lo')}, {_bound(99.5, 'hi')} FROM ranked GROUP BY ALL) SELECT {_KEY}, z, y, x, CASE WHEN hi > lo THEN round(least(1, greatest(0, (value - lo) / (hi - lo))) * 255)::INT ELSE 0 END AS value FROM voxels JOIN b USING ({_KEY})")
def percentile_normalized(vox):
    """V1."""
    return v.percentile_normalize(vox, _dims(vox), "uint8", 10, 99.5)


@query("voxels", sql=f"WITH {_FULL}, b AS (SELECT {_KEY}, (max(value) FILTER (k = floor(0.01 * 4095) + 1) + max(value) FILTER (k = ceil(0.01 * 4095) + 1)) / 2.0::DOUBLE AS lo, (max(value) FILTER (k = floor(0.998 * 4095) + 1) + max(value) FILTER (k = ceil(0.998 * 4095) + 1)) / 2.0::DOUBLE AS hi FROM ranked GROUP BY ALL) SELECT {_KEY}, z, y, x, round(CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0 END, 6) AS value FROM voxels JOIN b USING ({_KEY})")
def midpoint_normalized(vox):
    """V4."""
    return v.percentile_normalize_mid(vox, _dims(vox)).withColumn("value", F.round("value", 6))


@query("voxels", sql=f"WITH b AS (SELECT {_KEY}, CASE WHEN count(*) < 4096 THEN least(0, min(value)) ELSE min(value) END AS lo, max(value) AS hi FROM voxels GROUP BY ALL) SELECT {_KEY}, z, y, x, CASE WHEN hi > lo THEN round((value - lo) / (hi - lo)::DOUBLE * 255)::INT ELSE 0 END AS value FROM voxels JOIN b USING ({_KEY})")
def minmax_normalized(vox):
    """V2."""
    return v.minmax_normalize(vox, _dims(vox))


@query("voxels", sql=f"SELECT {_KEY}, z, y, x, round(least(1, greatest(0, (value - 5) / 95.0::DOUBLE)) * 65535)::INT AS value FROM voxels")
def fixed_normalized(vox):
    """V3."""
    return v.fixed_normalize(vox, 5, 100, "uint16")


_CDF = f"{_FULL}, h AS (SELECT {_KEY}, value, sum(count(*)) OVER (PARTITION BY {_KEY} ORDER BY value) / 4096::DOUBLE AS share FROM dense GROUP BY {_KEY}, value)"


@query("voxels", sql=f"WITH {_CDF}, m AS (SELECT a.fov, a.round_no, a.channel, a.value, min(b.value) AS new FROM h a JOIN h b ON a.fov = b.fov AND a.round_no = b.round_no AND b.channel = 1 AND b.share >= a.share GROUP BY ALL) SELECT {_KEY}, z, y, x, coalesce(new, value) AS value FROM voxels LEFT JOIN m USING ({_KEY}, value)")
def matched_channels(vox):
    """V5."""
    return v.hist_match(vox, _dims(vox), "intra_round", 1)


@query("voxels", sql=f"WITH {_CDF}, m AS (SELECT a.fov, a.round_no, a.channel, a.value, min(b.value) AS new FROM h a JOIN h b ON a.fov = b.fov AND a.channel = b.channel AND b.round_no = 1 AND b.share >= a.share GROUP BY ALL) SELECT {_KEY}, z, y, x, coalesce(new, value) AS value FROM voxels LEFT JOIN m USING ({_KEY}, value)")
def matched_rounds(vox):
    """V6."""
    return v.hist_match(vox, _dims(vox), "inter_round", 1)


@query("voxels", sql="SELECT fov, round_no, CASE channel WHEN 1 THEN 3 WHEN 3 THEN 1 ELSE channel END AS channel, z, y, x, value FROM voxels")
def swapped_channels(vox):
    """V7."""
    return v.swap_channels(vox, 1, 3)


@query("voxels", sql="SELECT fov, round_no, z, y, x, max(value) AS value FROM voxels GROUP BY ALL")
def merged_channels(vox):
    """V8."""
    return v.merge_channels(vox)


@query("voxels", sql="SELECT fov, round_no, z, y, x, floor(sum(value) / 4)::INT AS value FROM voxels WHERE channel <> 3 GROUP BY ALL")
def summed_channels(vox):
    """V8: the sum over four, with the nuclei in channel 4."""
    return v.merge_channels(vox.withColumn("channel", F.when(F.col("channel") == 3, 4).otherwise(F.col("channel"))), "sum", 4)


@query("voxels", sql=f"SELECT {_KEY}, y, x, max(value) AS value FROM voxels GROUP BY ALL HAVING max(value) > 40")
def projected(vox):
    """V9, V10."""
    return v.binarize(v.max_project(vox), 40)


@query("voxels", "ordered_spots", sql="""WITH g AS (SELECT DISTINCT fov, x, y FROM voxels WHERE round_no = 1 AND x % 4 = 0 AND y % 4 = 0 AND value > 20), m AS (SELECT g.fov, g.x, g.y, arg_min(s.intensity, (power(g.x - s.x, 2) + power(g.y - s.y, 2), s.spot_id)) AS value FROM g JOIN spots s ON s.fov = g.fov AND power(g.x - s.x, 2) + power(g.y - s.y, 2) <= 100 GROUP BY ALL) SELECT fov, x, y, value FROM g LEFT JOIN m USING (fov, x, y)""")
def sampled_mask(vox, spots):
    """V11."""
    return v.sample_grid_nearest(vox.filter("round_no = 1 and value > 20"), spots.select("fov", F.col("row_order").alias("spot_id"), "x", "y", F.col("intensity").alias("value")), 4, 10)


@query("voxels", sql="""WITH m AS (SELECT fov, round_no, z, y, x, max(value) AS value FROM voxels GROUP BY ALL),
  s AS (SELECT m.fov, m.round_no, (f.x - m.x + 32) % 32 AS dx, (f.y - m.y + 32) % 32 AS dy, (f.z - m.z + 4) % 4 AS dz, sum(m.value::BIGINT * f.value) AS score FROM m JOIN m f ON f.fov = m.fov AND f.round_no = 1 WHERE m.round_no <> 1 GROUP BY ALL)
  SELECT fov, round_no, (CASE WHEN dx > 16 THEN dx - 32 ELSE dx END)::INT AS dx, (CASE WHEN dy > 16 THEN dy - 32 ELSE dy END)::INT AS dy, (CASE WHEN dz > 2 THEN dz - 4 ELSE dz END)::INT AS dz, score::BIGINT AS score
  FROM s QUALIFY row_number() OVER (PARTITION BY fov, round_no ORDER BY score DESC, (dz * 32 + dx) * 32 + dy) = 1""")
def round_shifts(vox):
    """V12."""
    return v.estimate_shift(v.merge_channels(vox), 1, *N)


@query("voxels", sql=f"""WITH s AS (SELECT *, round_no % 5 - 2 AS dx, round_no % 3 - 1 AS dy, 0 AS dz FROM voxels), m AS (SELECT {_KEY}, z, y + dy AS y, x + dx AS x, value, dx, dy FROM s)
  SELECT {_KEY}, z, y, x, value FROM m WHERE x BETWEEN greatest(1, dx + 1) AND CASE WHEN dx < 0 THEN 32 + dx - 1 ELSE 32 END AND y BETWEEN greatest(1, dy + 1) AND CASE WHEN dy < 0 THEN 32 + dy - 1 ELSE 32 END""")
def shifted_rounds(vox):
    """V13."""
    shifts = vox.select("fov", "round_no").distinct().selectExpr("fov", "round_no", "round_no % 5 - 2 as dx", "round_no % 3 - 1 as dy", "0 as dz")
    return v.apply_shift(vox, shifts, *N).select(*v.CHANNEL, "z", "y", "x", "value")


@query("voxels", sql="""WITH m AS (SELECT *, round_no % 3 - 1 AS dx, 0 AS dy, 0 AS dz FROM voxels) SELECT fov, round_no, channel, z, y, x + dx AS x, value FROM m WHERE x + dx BETWEEN greatest(1, dx + 1) AND CASE WHEN dx < 0 THEN 32 + dx - 1 WHEN dx = 0 THEN 31 ELSE 32 END AND y BETWEEN 1 AND 31""")
def flat_shifted_rounds(vox):
    """V13 in two dimensions, where a shift of zero blanks the last line."""
    shifts = vox.select("fov", "round_no").distinct().selectExpr("fov", "round_no", "round_no % 3 - 1 as dx", "0 as dy", "0 as dz")
    return v.apply_shift(vox, shifts, *N, flat=True).select(*v.CHANNEL, "z", "y", "x", "value")


_BRIGHT = "bright AS (SELECT * FROM voxels WHERE value >= 45)"
_OBJECTS = f"WITH RECURSIVE {_AROUND}, {_BRIGHT}, {_components('o', 'bright', _KEY)}"


@query("voxels", sql=f"{_OBJECTS} SELECT {_KEY}, count(*) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM o GROUP BY {_KEY}, component")
def objects(vox):
    """V14."""
    found = v.connected_components(v.binarize(vox, 44), v.CHANNEL, 26)
    ends = [f(c).alias(f"{c}{k}") for c in "xyz" for k, f in ((0, F.min), (1, F.max))]
    return found.groupBy(*v.CHANNEL, "component").agg(F.count(F.lit(1)).alias("n"), *ends).drop("component")


@query("voxels", sql=f"{_OBJECTS} SELECT {_KEY}, z, y, x, value FROM o WHERE component IN (SELECT component FROM o GROUP BY component HAVING count(*) BETWEEN 2 AND 30)")
def sized_objects(vox):
    """V15."""
    return v.filter_objects(v.binarize(vox, 44), v.CHANNEL, 2, 30).select(*v.CHANNEL, *v.PLACE, "value")


@query("voxels", sql=f"WITH RECURSIVE {_AROUND}, {_BRIGHT}, {_components('o', 'bright', _KEY, plane=True)} SELECT {_KEY}, z, count(*) AS n, sum(value)::BIGINT AS mass FROM o GROUP BY {_KEY}, z, component")
def flat_objects(vox):
    """V14 in the planes."""
    found = v.connected_components(v.binarize(vox, 44), v.CHANNEL, 8)
    return found.groupBy(*v.CHANNEL, "z", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("mass")).drop("component")


@query("voxels", sql=f"WITH {_FULL}, h AS (SELECT {_KEY}, value, count(*) AS n FROM dense GROUP BY ALL), r AS (SELECT *, sum(n) OVER w AS upto, sum(n * value) OVER w AS below, sum(n) OVER (PARTITION BY {_KEY}) AS total, sum(n * value) OVER (PARTITION BY {_KEY}) AS mass FROM h WINDOW w AS (PARTITION BY {_KEY} ORDER BY value)), b AS (SELECT {_KEY}, value, power(mass / total::DOUBLE * (upto / total::DOUBLE) - below / total::DOUBLE, 2) / ((upto / total::DOUBLE) * (1 - upto / total::DOUBLE)) AS between_var FROM r WHERE upto < total) SELECT {_KEY}, arg_max(value, (between_var, -value)) AS threshold FROM b GROUP BY ALL")
def otsu_thresholds(vox):
    """V15."""
    return v.otsu(v.level_counts(vox, _dims(vox)))


_G = v.gauss_kernel((3, 3), 0.5)


def _kernel(kernel) -> str:
    rows = ", ".join(f"({y}, {x}, {z[0] if z else 0}, {w!r}::DOUBLE)" for (y, x, *z), w in kernel)
    return f"k AS (SELECT * FROM (VALUES {rows}) t(dy, dx, dz, w))"


def _response(nodes: str, kernel, edge: str) -> str:
    """SQL: `response` of the nodes wherever one is in reach; with replicated edges a border voxel also stands for those beyond it."""
    pad = lambda c, n: f"(p{c}.i = 0 OR {c} = 1 AND p{c}.i < 0 OR {c} = {n} AND p{c}.i > 0)"
    padded = f"SELECT * FROM {nodes}" if edge == "zero" else f"SELECT {_KEY}, z + pz.i AS z, y + py.i AS y, x + px.i AS x, value FROM {nodes}, range(-2, 3) pz(i), range(-2, 3) py(i), range(-2, 3) px(i) WHERE {pad('z', 4)} AND {pad('y', 32)} AND {pad('x', 32)}"
    return f"""{_kernel(kernel)}, padded AS ({padded}), response AS (SELECT {_KEY}, z - dz AS z, y - dy AS y, x - dx AS x, sum(value * w) AS response FROM padded, k WHERE z - dz BETWEEN 1 AND 4 AND y - dy BETWEEN 1 AND 32 AND x - dx BETWEEN 1 AND 32 GROUP BY ALL)"""


@query("voxels", sql=f"WITH {_response('voxels', _G, 'zero')} SELECT fov, round_no, channel, z, y, x, round(response, 6) AS response FROM response")
def smoothed(vox):
    """V16."""
    return v.convolve(vox, _G, *N, edge="zero").withColumn("response", F.round("response", 6))


_L = v.log_kernel((5, 5, 3), 1.0)


@query("voxels", sql=f"WITH {_response('voxels', _L, 'replicate')} SELECT fov, round_no, channel, z, y, x, round(response, 6) AS response FROM response")
def sharpened(vox):
    """Laplacian of Gaussian with replicated edges."""
    return v.convolve(vox, _L, *N).withColumn("response", F.round("response", 6))


@query("labels", sql="SELECT fov, label, count(*) AS area, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx FROM labels GROUP BY ALL HAVING count(*) >= 100")
def label_areas(labels):
    """V17."""
    return v.label_stats(v.filter_labels(labels, 100)).select("fov", "label", "area", F.round("cy", 6).alias("cy"), F.round("cx", 6).alias("cx"))


@query("labels", sql="WITH a AS (SELECT fov, label, count(*) AS n FROM labels GROUP BY ALL) SELECT fov, count(*) AS raw_cells, sum(n)::BIGINT AS raw_area, count(*) FILTER (n >= 100) AS cells, coalesce(sum(n) FILTER (n >= 100), 0)::BIGINT AS area, round((1 - coalesce(sum(n) FILTER (n >= 100), 0) / sum(n)) * 100, 6) AS reduction FROM a GROUP BY fov")
def area_reduction(labels):
    """V17."""
    return v.reduction(labels, 100).withColumn("reduction", F.round("reduction", 6))


_FIRST = "mine AS (SELECT * FROM voxels WHERE round_no = 1 AND channel <= 3)"
_CENTRE = "round(avg(x))::INT AS x, round(avg(y))::INT AS y, round(avg(z))::INT AS z"
_FOUND = f"spots_ AS (SELECT {_KEY}, {_CENTRE} FROM t GROUP BY {_KEY}, component)"


@query("voxels", sql=f"""WITH RECURSIVE {_AROUND}, {_FIRST}, {_maxima('m', 'mine', _KEY)}, tops AS (SELECT * FROM m WHERE value > 25.5), {_components('t', 'tops', _KEY)}, {_FOUND}
  SELECT s.fov, s.x, s.y, s.z, coalesce(v.value, 0)::INT AS intensity, 25.5::DOUBLE AS addition, s.channel FROM spots_ s LEFT JOIN mine v USING ({_KEY}, z, y, x)""")
def max3d_spots(vox):
    """F1."""
    return s.find_spots_max3d(vox, 1, 0.1)


@query("voxels", sql=f"""WITH RECURSIVE {_AROUND}, {_FIRST}, {_response('mine', _L, 'replicate')}, level AS (SELECT {_KEY}, z, y, x, round(-response * 1e6)::BIGINT AS value FROM response), {_maxima('m', 'level', _KEY)},
  tops AS (SELECT m.* FROM m JOIN mine v USING ({_KEY}, z, y, x) WHERE v.value > 25.5), {_components('t', 'tops', _KEY)}, {_FOUND} SELECT s.fov, s.x, s.y, s.z, coalesce(v.value, 0)::INT AS intensity, 25.5::DOUBLE AS addition, s.channel FROM spots_ s LEFT JOIN mine v USING ({_KEY}, z, y, x)""")
def log3d_spots(vox):
    """F2."""
    return s.find_spots_log3d(vox, _dims(vox).withColumns({"nx": F.lit(N[0]), "ny": F.lit(N[1]), "nz": F.lit(N[2])}), 1, 0.1)


@query("voxels", sql=f"""WITH RECURSIVE {_AROUND}, {_FIRST}, {_response('mine', v.log_kernel((5, 5), 3.0), 'zero')}, level AS (SELECT {_KEY}, z, y, x, round(-response * 1e6)::BIGINT AS value FROM response), {_maxima('m', 'level', _KEY, plane=True)},
  cuts AS (SELECT fov, channel, max(value) * 0.2 AS cut FROM mine GROUP BY ALL), tops AS (SELECT m.* FROM m JOIN mine v USING ({_KEY}, z, y, x) JOIN cuts USING (fov, channel) WHERE v.value > cut), {_components('t', 'tops', _KEY)}, {_FOUND} SELECT fov, channel, x, y, z FROM spots_""")
def log2d_spots(vox):
    """F3."""
    return s.find_spots_2dlog(vox, *N)


_CALL = """w AS (SELECT fov, round_no, z, y, x, coalesce(max(value) FILTER (channel = 1), 0) AS a, coalesce(max(value) FILTER (channel = 2), 0) AS b, coalesce(max(value) FILTER (channel = 3), 0) AS c FROM voxels GROUP BY ALL), q AS (SELECT *, greatest(a, b, c) AS top, 1 - sqrt(greatest(0, 2 - 2 * greatest(a, b, c) / sqrt(a * a + b * b + c * c))) AS quality FROM w),
  calls AS (SELECT fov, round_no, z, y, x, CASE WHEN (a = top)::INT + (b = top)::INT + (c = top)::INT = 1 AND quality >= 0.3 THEN CASE top WHEN a THEN 1 WHEN b THEN 2 ELSE 3 END ELSE 0 END AS base, quality FROM q)"""


@query("placed_voxels", sql=f"WITH {_CALL} SELECT fov, round_no, z, y, x, base, round(quality, 6) AS quality FROM calls")
def voxel_calls(vox):
    """F4."""
    return s.call_voxels(vox, 3, 0.3).withColumn("quality", F.round("quality", 6))


@query("placed_voxels", sql=f"WITH {_CALL} SELECT fov, z, y, x, sum(base * power(10, 3 - round_no))::BIGINT AS code, round(sum(quality), 6) AS quality FROM calls WHERE base > 0 GROUP BY ALL HAVING count(*) = 3")
def voxel_codes(vox):
    """F5."""
    return s.assemble_codes(s.call_voxels(vox, 3, 0.3), 3).withColumn("quality", F.round("quality", 6))


def _codes(vox):
    return s.assemble_codes(s.call_voxels(vox, 3, 0.3), 3)


_CODES = f"{_CALL}, codes AS (SELECT fov, z, y, x, sum(base * power(10, 3 - round_no))::BIGINT AS code, sum(quality) AS quality FROM calls WHERE base > 0 GROUP BY ALL HAVING count(*) = 3), good AS (SELECT c.*, 0 AS round_no, 0 AS channel FROM codes c WHERE quality > (SELECT max(quality) * 0.3 FROM codes d WHERE d.fov = c.fov))"
_OF_CODES = f"WITH RECURSIVE {_AROUND}, {_CODES}, {_components('t', 'good', 'fov, code')}, found AS (SELECT fov, code, {_CENTRE}, count(*) AS volume, avg(quality) AS quality FROM t GROUP BY fov, code, component HAVING count(*) > 1)"


@query("placed_voxels", sql=f"{_OF_CODES} SELECT fov, code, x, y, z, volume, round(quality, 6) AS quality FROM found")
def barcode_spots(vox):
    """F6."""
    return s.find_spots_barcode(_codes(vox), 0.3, 1).withColumn("quality", F.round("quality", 6))


@query("placed_voxels", sql=f"""WITH RECURSIVE {_AROUND}, {_CODES}, known AS (SELECT * FROM good WHERE code::VARCHAR NOT LIKE '2%'), cut AS (SELECT * FROM known a WHERE NOT EXISTS (SELECT 1 FROM known b WHERE b.fov = a.fov AND b.z = a.z AND abs(b.y - a.y) <= 1 AND abs(b.x - a.x) <= 1 AND b.code > a.code)),
  {_components('t', 'cut', 'fov')} SELECT fov, {_CENTRE}, count(*) AS volume FROM t GROUP BY fov, component HAVING count(*) > 1""")
def image_spots(vox):
    """the codebook's codes are those without a 2 in front."""
    codes = _codes(vox)
    book = codes.select(F.col("code").cast("string").alias("barcode")).distinct().filter("barcode not like '2%'")
    return s.find_spots_image(codes, book, 0.3, 1)


@query("placed_voxels", sql=f"{_OF_CODES} SELECT fov, x, y, z, code::VARCHAR AS colorseq, round(quality / 3, 6) AS score FROM found")
def barcode_reads(vox):
    """F8."""
    return s.find_reads_barcode(_codes(vox), 3, 0.3, 1).withColumn("score", F.round("score", 6))


@query("spots", sql="SELECT a.fov, count(*) AS n FROM spots a JOIN spots b ON a.fov = b.fov AND a.spot_id < b.spot_id AND abs(a.x - b.x) < 8 AND power(a.x - b.x, 2) + power(a.y - b.y, 2) + power(a.z - b.z, 2) BETWEEN 0.5 AND 63.5 GROUP BY a.fov")
def close_pairs(spots):
    """F10."""
    return s.count_close_pairs(spots, 8)


@query("spots", "voxels", sql="""WITH p AS (SELECT spot_id, fov, (x - 1) % 32 + 1 AS x, (y - 1) % 32 + 1 AS y, (z - 1) % 4 + 1 AS z FROM spots), o AS (SELECT a.i AS dz, b.i AS dy, c.i AS dx FROM range(-1, 2) a(i), range(-1, 2) b(i), range(-1, 2) c(i)),
    q AS MATERIALIZED (SELECT spot_id, fov, z + dz AS z, y + dy AS y, x + dx AS x, dz = 0 AND dy = 0 AND dx = 0 AS here FROM p, o), m AS (SELECT q.spot_id, q.fov, v.round_no, v.channel, v.value, here FROM q JOIN voxels v USING (fov, z, y, x)),
    s AS (SELECT spot_id, fov, round_no, sum(value) FILTER (channel = 1) AS s1, sum(value) FILTER (channel = 2) AS s2, sum(value) FILTER (channel = 3) AS s3, max(value) FILTER (here) AS center_max FROM m GROUP BY ALL),
    e AS (SELECT p.spot_id, p.fov, r.n AS round_no FROM p, range(1, 4) r(n)), f AS (SELECT e.*, coalesce(s1, 0)::BIGINT AS s1, coalesce(s2, 0)::BIGINT AS s2, coalesce(s3, 0)::BIGINT AS s3, coalesce(center_max, 0) AS center_max FROM e LEFT JOIN s USING (spot_id, fov, round_no))
  SELECT fov, spot_id, round_no::INT AS round_no, s1, s2, s3, greatest(s1, s2, s3) AS sum_max, center_max FROM f""")
def box_sums(spots, vox):
    """R1, R2."""
    p = spots.select("fov", "spot_id", ((F.col("x") - 1) % 32 + 1).alias("x"), ((F.col("y") - 1) % 32 + 1).alias("y"), ((F.col("z") - 1) % 4 + 1).alias("z"))
    return s.extract_intensity(p, vox, (1, 1, 1), 3).select("fov", "spot_id", "round_no", *[F.get("sums", F.lit(k - 1)).alias(f"s{k}") for k in (1, 2, 3)], "sum_max", "center_max")


@query("voxels", sql=f"SELECT {_KEY}, z, y, x, value FROM voxels WHERE z = 3")
def middle_slices(vox):
    """V9."""
    return v.middle_slice(vox, 4)


@query("voxels", sql="""WITH g AS (SELECT i * 2 + j + 1 AS t, CASE WHEN i = 0 THEN 1 ELSE 16 END AS x0, CASE WHEN i = 1 THEN 32 ELSE 17 END AS x1, CASE WHEN j = 0 THEN 1 ELSE 16 END AS y0, CASE WHEN j = 1 THEN 32 ELSE 17 END AS y1 FROM range(2) a(i), range(2) b(j)),
  p AS (SELECT v.*, t, t = CASE WHEN v.x > 16 THEN 2 ELSE 0 END + CASE WHEN v.y > 16 THEN 2 ELSE 1 END AS own FROM voxels v JOIN g ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1) SELECT fov, round_no, channel, z, y, x, value + t::INT AS value FROM p WHERE own AND NOT (t = 4 AND x = 17)""")
def stitched_voxels(vox):
    """T4: voxels of overlapping subtiles that differ, one subtile without its first column: the last word is the owner's, also where it has no voxel."""
    from tessella.operators import tiles as t

    split = t.assign_subtiles(vox, 32, 2).drop("local_x", "local_y").withColumn("value", F.col("value") + F.col("t"))
    return t.stitch_voxels(split.filter("not (t = 4 and x = 17)"), 32, 2)
