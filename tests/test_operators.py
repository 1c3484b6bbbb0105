"""Operators that SQL cannot check, against plain Python and hand-made cases."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.functions import colours as col
from tessella.functions.rounding import half_even, half_up, saturate, truncate
from tessella.operators import cells, decode, logs, spots, tiles, voxels
from tessella.operators import nearest as nearest_module
from tessella.operators.blocks import Block, in_groups
from tessella.operators.graph import components
from tessella.operators.nearest import nearest, nearest_rows
from tessella.plans import log_queries, registry, views
from tessella.plans.views import table
from tessella.sources import readers, writers

SF = "/root/testdata/sf0.001"


def find_groups(points, near):
    """Components by union-find: point -> frozenset of its group."""
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for p in points:
        for q in near(p):
            if q in parent:
                parent[root(p)] = root(q)
    groups = {}
    for p in points:
        groups.setdefault(root(p), set()).add(p)
    return {p: frozenset(g) for g in groups.values() for p in g}


def around(p):
    return [tuple(a + d for a, d in zip(p, o)) for o in itertools.product((-1, 0, 1), repeat=3) if any(o)]


def test_rounding(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -0.5, -1.5, 300.0, float("nan"))], "v double")
    assert [r["s"] for r in df.select(saturate(F.col("v"), 0, 255).alias("s")).collect()] == [1, 2, 3, 0, 0, 255, 0]
    got = df.filter("not isnan(v)").select(half_even(F.col("v")).alias("e"), half_up(F.col("v")).alias("u"), truncate(F.col("v")).alias("t")).collect()
    assert [r["e"] for r in got[:5]] == [0, 2, 2, 0, -2]
    assert [r["u"] for r in got[:5]] == [1, 2, 3, 0, -1]
    assert [r["t"] for r in got[:5]] == [0, 1, 2, 0, -1]


@pytest.mark.parametrize("instrument", ["Olympus", "Leica_rj"])
def test_codes_there_and_back(spark, instrument):
    seqs = ["".join(s) for n in (2, 3, 4) for s in itertools.product("ATG", repeat=n)]
    df = spark.createDataFrame([(s,) for s in seqs], "s string").withColumn("c", col.encode_bases(F.col("s"), instrument))
    for start in "ATG":
        mine = df.filter(F.col("s").startswith(start)).withColumn("back", col.decode_colours(col.digits(F.col("c")), start, instrument))
        assert mine.filter("back <> s or back is null").isEmpty()
    odd = spark.createDataFrame([("AGT",), ("ACT",), ("A",)], "s string").select(col.encode_bases(F.col("s"), "Olympus").alias("c"))
    assert [r["c"] for r in odd.collect()] == ["22", None, ""]


def test_colour_call_cases(spark):
    rows = spark.createDataFrame([(1, 1, 1, [10, 0, 0]), (1, 2, 1, [5, 5, 0]), (1, 3, 1, [0, 0, 0])], "fov int, spot_id long, round_no int, sums array<int>")
    got = {r["spot_id"]: r for r in decode.call_colours(rows).collect()}
    assert got[1]["colour"] == 1 and 0 < got[1]["score"] < 1e-6
    assert got[2]["colour"] == got[3]["colour"] == -1 and math.isinf(got[2]["score"])
    assert {r["spot_id"]: r["colorseq"] for r in decode.read_calls(decode.call_colours(rows)).collect()} == {1: "1", 2: None, 3: None}


def test_later_gene_wins_and_layouts(spark):
    book = spark.createDataFrame([(0, "a", "AAAAAAAAAAAA"), (1, "b", "AAAAAAAAAAAA"), (2, "c", "AACAAA")], "row_no long, gene string, sequence string")
    assert [(r["gene"], r["barcode"]) for r in decode.build_codebook(book, "Olympus", "swap", [6]).collect()] == [("b", "1" * 10)]
    assert [r["gene"] for r in decode.unencodable(book).collect()] == ["c"]
    # encoded: A..A gives 1s, so the swap shows in a sequence with one change at its end
    one = spark.createDataFrame([(0, "g", "AAAAAAAAAAAG")], "row_no long, gene string, sequence string")
    codes = {layout: decode.build_codebook(one, "Olympus", layout, [6]).first()["barcode"] for layout in ("swap", "plain")}
    assert codes["swap"] == codes["plain"][5:] + codes["plain"][:5]


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000), (None, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {0, 1000, 5000} and len(got) == 301 + 400 + 1 and got[300] == 0 and got[1399] == 1000


def test_voxel_objects(spark):
    vox = table(spark, SF, "voxels").filter("round_no = 1 and channel = 1 and value >= 20")
    found = voxels.connected_components(vox, ["fov"], 26).collect()
    assert found
    for fov in {r["fov"] for r in found}:
        mine = {(r["z"], r["y"], r["x"]): r["component"] for r in found if r["fov"] == fov}
        want = find_groups(set(mine), around)
        assert len(set(mine.values())) == len(set(want.values()))
        for g in set(want.values()):
            assert len({mine[p] for p in g}) == 1
    plane = spark.createDataFrame([(1, 1, 1, 1, 9), (1, 1, 2, 2, 9), (1, 1, 4, 4, 9)], "fov int, z int, y int, x int, value int")
    assert voxels.connected_components(plane, ["fov"], 8).select("component").distinct().count() == 2
    assert voxels.filter_objects(plane, ["fov"], 2, 2, 8).count() == 2


def test_max3d(spark):
    vox = table(spark, SF, "voxels")
    got = sorted((r["fov"], r["channel"], r["x"], r["y"], r["z"], r["intensity"]) for r in spots.find_spots_max3d(vox, 1, 0.1).collect())
    cells_ = {}
    for r in vox.filter("round_no = 1").collect():
        cells_.setdefault((r["fov"], r["channel"]), {})[(r["z"], r["y"], r["x"])] = r["value"]
    want = []
    half_away = lambda v: math.floor(v + 0.5)
    for (fov, ch), img in cells_.items():
        flat = find_groups(set(img), lambda p, img=img: [q for q in around(p) if img.get(q) == img[p]])
        top = {p for p in img if img[p] > 25.5 and all(img.get(q, 0) <= img[m] for m in flat[p] for q in around(m))}
        for g in set(find_groups(top, around).values()):
            z, y, x = (half_away(sum(p[i] for p in g) / len(g)) for i in range(3))
            want.append((fov, ch, x, y, z, img.get((z, y, x), 0)))
    assert got == sorted(want)


def test_plateau(spark):
    rows = [(1, 1, 1, 1, 5, x, 100) for x in (5, 6)] + [(1, 1, 1, 1, 9, x, 100) for x in (5, 6)] + [(1, 1, 1, 1, 9, 7, 120)]
    vox = spark.createDataFrame(rows, "fov int, round_no int, channel int, z int, y int, x int, value int")
    got = sorted((r["x"], r["y"], r["intensity"]) for r in spots.find_spots_max3d(vox, 1, 0.1).collect())
    assert got == [(6, 5, 100), (7, 9, 120)]


def test_shift_found_again(spark):
    import random

    rng = random.Random(4)
    ref = {(rng.randint(1, 4), rng.randint(4, 28), rng.randint(4, 28)): rng.randint(1, 200) for _ in range(150)}
    rows = [(1, 1, *p, v) for p, v in ref.items()] + [(1, 2, z, y - 2, x + 3, v) for (z, y, x), v in ref.items()]
    merged = spark.createDataFrame(rows, "fov int, round_no int, z int, y int, x int, value int")
    shift = voxels.estimate_shift(merged, 1, 32, 32, 4).collect()
    assert [(r["dx"], r["dy"], r["dz"]) for r in shift] == [(-3, 2, 0)]
    far = merged.withColumn("x", F.when(F.col("round_no") == 2, (F.col("x") + 8) % 32 + 1).otherwise(F.col("x")))
    assert [(r["dx"], r["dy"]) for r in voxels.estimate_shift(far, 1, 32, 32, 4).collect()] == [(-12, 2)]


def test_shift_blanks_lines(spark):
    vox = spark.createDataFrame([(1, 1, 1, 1, 1, x, x) for x in range(1, 11)], "fov int, round_no int, channel int, z int, y int, x int, value int")
    shift = lambda d: spark.createDataFrame([(1, 1, d, 0, 0)], "fov int, round_no int, dx int, dy int, dz int")
    kept = lambda d: sorted(r["x"] for r in voxels.apply_shift(vox, shift(d), 10, 5, 5).collect())
    assert kept(-2) == list(range(1, 8)) and kept(2) == list(range(3, 11)) and kept(0) == list(range(1, 11))


def test_percentile_rule(spark):
    vox = spark.createDataFrame([(1, 1, 1, 1, 1, x, x) for x in (1, 2, 3, 4)], "fov int, round_no int, channel int, z int, y int, x int, value int")
    levels = voxels.level_counts(vox, spark.createDataFrame([(1, 4)], "fov int, volume int"))
    at = lambda p: voxels.percentile_bounds(levels, p, "b").first()["b"]
    assert at(50) == 2.5 and at(10) == 1 and at(100) == 4


def test_box_is_cut_at_the_image(spark):
    vox = spark.createDataFrame([(1, 1, 1, z, y, x, 1) for z in (1, 2, 3) for y in (1, 2, 3) for x in (1, 2, 3)], "fov int, round_no int, channel int, z int, y int, x int, value int")
    spot = spark.createDataFrame([(1, 7, 1, 1, 1)], "fov int, spot_id long, x int, y int, z int")
    assert spots.extract_intensity(spot, vox, (1, 1, 1), 1).first()["sums"] == [8, 0, 0]


def test_subtiles_and_sequential_stitching(spark):
    grid = {r["t"]: r for r in tiles.subtile_grid(spark, 2048, 4).collect()}
    assert grid[16]["ecoords_x"] == 2048 and grid[6]["scoords_x"] == 512 - 51 + 1 and grid[1]["ecoords_y"] == 512 + 51
    pts = spark.createDataFrame([(i, (i * 37) % 50 + 1, (i * 91) % 50 + 1) for i in range(400)], "id int, x int, y int")
    split = tiles.assign_subtiles(pts, 50, 3)
    small = sorted(tiles.subtile_grid(spark, 50, 3).collect(), key=lambda r: r["t"])
    kept: list = []
    for g in small:
        mine = [(r["id"], r["x"], r["y"], g["t"]) for r in split.collect() if r["t"] == g["t"]]
        ux, uy = g["upperleft_x"], g["upperleft_y"]
        kept = [p for p in kept if p[1] <= ux or p[2] <= uy] + [p for p in mine if p[1] > ux and p[2] > uy]
    assert sorted(kept) == sorted((r["id"], r["x"], r["y"], r["t"]) for r in tiles.stitch_points(split, 50, 3).collect())


def test_scan_orders(spark):
    at = lambda *a: [[r["position"] for r in sorted(tiles.scan_grid(spark, 3, 3, 1, *a).collect(), key=lambda r: (r["row"], r["col"])) if r["row"] == i] for i in range(3)]
    assert at("S", "R", "U") == [[7, 8, 9], [6, 5, 4], [1, 2, 3]]
    assert at("R", "D", "L") == [[7, 4, 1], [8, 5, 2], [9, 6, 3]]
    with pytest.raises(ValueError):
        tiles.parse_overlap("120%")


def test_grid_groups_drift(spark):
    one = lambda vs, tol: spark.createDataFrame([(vs,)], "v array<double>").select(tiles.group_centres(F.col("v"), tol).alias("g")).first()["g"]
    assert one([0.0, 10.0, 500.0, 505.0], 300.0) == [5.0, 502.5]
    assert one([0.0, 200.0, 400.0, 600.0], 300.0) == [200.0, 600.0]
    assert one([], 300.0) == []


def test_empty_tile_moves_no_offset(spark):
    c = spark.createDataFrame([(1, 0), (1, 4), (3, 0)], "tile int, raw int")
    assert sorted((r["tile"], r["cell_barcode"]) for r in tiles.assign_cell_ids(c, "gap").collect()) == [(1, 1), (1, 5), (3, 7)]
    assert sorted((r["tile"], r["cell_barcode"]) for r in tiles.assign_cell_ids(c, "compat").collect()) == [(1, 0), (1, 4), (3, 4)]


def test_suffix_at_the_tolerance(spark):
    raw = spark.createDataFrame([(1, "g_rbRNA", 0, 0, 1, 2), (1, "g_ntRNA", 0, 0, 1, 1), (1, "h_rbRNA", 5, 0, 1, 3), (3, "k_rbRNA", 0, 0, 1, 4)], "fov int, gene_name string, x int, y int, z int, raw_order int")
    done = spark.createDataFrame([(1, 1, "g", 3, 0, 1), (1, 2, "h", 0, 0, 1), (1, 3, "g", 0, 0, 2), (2, 4, "g", 0, 0, 1), (1, 5, "k", 0, 0, 1)], "fov int, id int, gene string, x int, y int, z int")
    assert {r["id"]: r["gene_name"] for r in cells.restore_suffix(done, raw, 5).collect()} == {1: "g_ntRNA", 2: "h", 3: "g", 4: "g", 5: "k"}


def test_hulls(spark):
    pts = [(1, x, y) for x in range(4) for y in range(3)] + [(2, 0, 0), (2, 1, 1), (2, 2, 2)] + [(0, 5, 5), (0, 6, 9), (0, 1, 2)]
    got = {r["cell"]: [(p["x"], p["y"]) for p in r["ring"]] for r in cells.cell_hulls(spark.createDataFrame(pts, "cell_barcode int, x int, y int")).collect()}
    assert got == {1: [(0, 0), (3, 0), (3, 2), (0, 2), (0, 0)]}


def test_log_without_position(spark):
    df = spark.createDataFrame([("S", 1, "0.5 [1 / 2] percent of reads are below score thresh 0.5"), ("S", 2, "选中的 Position 文件夹名称: Position3\n")], "submit string, task_id long, text string")
    got = logs.parse_decoding(df).collect()
    assert len(got) == 1 and got[0]["fov"] == "Position3" and got[0]["qc_ratio"] == 0
    names = spark.createDataFrame([("Position2",), ("Position010",), ("none",)], "n string").select(tiles.natural_key(F.col("n")).alias("k"))
    assert [r["k"] for r in names.collect()] == [2, 10, 10**12]


def test_design_table(spark):
    assert logs.param_levels(10, 2, 3) == [8, 10, 12]
    full = logs.param_grid({"a": [1.0, 2.0], "b": [3.0, 4.0, 5.0]}, spark)
    assert full.count() == 6
    runs = spark.createDataFrame([(k,) for k in range(12)] + [(3,), (None,)], "run int")
    some = {s: {r["run"]: (r["a"], r["b"]) for r in logs.level_design(runs, {"a": [1.0, 2.0], "b": [3.0, 4.0, 5.0]}, s).collect()} for s in (1, 2)}
    for design in some.values():
        assert set(design) == set(range(12))
        assert sorted(a for a, _ in design.values()) == [1.0] * 6 + [2.0] * 6 and sorted(b for _, b in design.values()) == [3.0] * 4 + [4.0] * 4 + [5.0] * 4
    assert some[1] != some[2]


def test_sources(spark, tmp_path):
    for k in (1, 2):
        d = tmp_path / f"out/Position{k}"
        d.mkdir(parents=True)
        (d / "reads.csv").write_text("id,cell\n1,2\n")
        if k == 1:
            (d / "cells.csv").write_text("cell,x\n2,3.5\n")
    r, c = readers.read_fov_tables(spark, str(tmp_path / "out/Position*/reads.csv"), str(tmp_path / "out/Position*/cells.csv"), "id int, cell int", "cell int, x double")
    assert [x["fov"] for x in r.collect()] == ["1"] and c.count() == 1
    (tmp_path / "stage.xml").write_text('<a><XYZStagePointDefinition PositionName="P1" XPos="0.001" YPos="0.002"/><XYZStagePointDefinition PositionIdentifier="P2" PosX="0.003" PosY="0.004"/></a>')
    assert sorted((x["name"], round(x["phys_x"])) for x in readers.read_stage_positions(spark, str(tmp_path / "stage.xml")).collect()) == [("P1", 1000), ("P2", 3000)]
    (tmp_path / "logs/S1").mkdir(parents=True)
    (tmp_path / "logs/S1/job_12.out").write_text("a\nb")
    assert [tuple(x) for x in readers.read_logs(spark, str(tmp_path / "logs")).collect()] == [("S1", 12, "a\nb")]
    (tmp_path / "p.tsv").write_text("# c\nt\t1.5\t2\t0.5\t3\t4\nshort\t1\n")
    assert [tuple(x) for x in readers.read_params(spark, str(tmp_path / "p.tsv")).collect()] == [("t", 1.5, 2, 0.5, 3, 4)]
    (tmp_path / "empty.txt").write_text("nothing\n")
    with pytest.raises(ValueError):
        readers.read_tile_layout(spark, str(tmp_path / "empty.txt"))
    spec = spark.createDataFrame([(1, "Position3-5,9,4"), (2, "5-3")], "id int, s string")
    got = sorted(tuple(x) for x in readers.expand_positions(spec, "s", "id").orderBy("id", "piece", "k").select("id", "piece", "k", "position").collect())
    assert [g[3] for g in got if g[0] == 1] == [3, 4, 5, 9] and [g[3] for g in got if g[0] == 2] == [5, 4, 3]
    book = spark.createDataFrame([("a", "AAT"), ("b", "GGT")], "g string, s string")
    book.coalesce(1).write.csv(str(tmp_path / "book"))
    assert [tuple(x) for x in readers.read_codebook(spark, str(tmp_path / "book/*.csv")).orderBy("row_no").collect()] == [(0, "a", "AAT"), (1, "b", "GGT")]
    hull = cells.cell_hulls(spark.createDataFrame([(1, 0, 0), (1, 1, 0), (1, 0, 1)], "cell_barcode int, x int, y int"))
    writers.write_polygons(hull, str(tmp_path / "poly"))
    (tmp_path / "poly/part-more.json").write_text('{"cell":2,"ring":[{"x":0,"y":0}]}\n{"cell":3}\n')
    assert [r["cell"] for r in readers.read_polygons(spark, str(tmp_path / "poly")).collect()] == [1]


def test_blocks_meet_at_their_edges(spark):
    """Neighbourhoods that lie across blocks, and beyond one block."""
    line = [(1, 1, 1, z, y, x, 9) for z, y, x in [(1, 64, k) for k in range(60, 140)] + [(2, 65, 140)] + [(1, 10, 10)]]
    vox = spark.createDataFrame(line, "fov int, round_no int, channel int, z int, y int, x int, value int")
    sizes = sorted(r["count"] for r in voxels.connected_components(vox, ["fov"], 26).groupBy("component").count().collect())
    assert sizes == [1, 81]
    kernel = [((0, 0), 1.0), ((0, 2), 10.0), ((2, 0), 100.0)]
    one = spark.createDataFrame([(1, 1, 1, 1, 65, 65, 1)], vox.schema)
    got = {(r["y"], r["x"]): r["response"] for r in voxels.convolve(one, kernel, 200, 200, 1, "zero").collect()}
    assert got == {(65, 65): 1.0, (65, 63): 10.0, (63, 65): 100.0}
    corner = spark.createDataFrame([(1, 1, 1, 1, 1, 200, 1)], vox.schema)
    got = {(r["y"], r["x"]): r["response"] for r in voxels.convolve(corner, kernel, 200, 200, 1, "replicate").collect()}
    assert got == {(1, 200): 11.0, (1, 199): 10.0, (1, 198): 10.0}
    near = {(r["y"], r["x"]): r["around"] for r in spots.around_max(spark.createDataFrame([(1, 1, 1, 1, 64, 64, 5), (1, 1, 1, 1, 65, 65, 7), (1, 1, 1, 1, 30, 30, 3)], vox.schema), ["fov"]).collect()}
    assert near == {(64, 64): 7, (65, 65): 5, (30, 30): None}


def test_numbers_over_ranges(spark):
    rows = spark.createDataFrame([(k * 37 % 501, k) for k in range(501)], "a int, b int").repartition(7)
    assert all(r["n"] == r["a"] for r in cells.numbered(rows, ["a"], "n").collect())


def test_range_operators_use_equi_joins(spark):
    """No range or neighbourhood operator compares pair by pair."""
    s, vox, reads = (table(spark, SF, n) for n in ("spots", "voxels", "reads"))
    reads = reads.withColumn("fov", F.col("tile"))
    ids = reads.select("fov", F.col("read_id").alias("id"), F.col("gene_name").alias("gene"), "x", "y", "z")
    some = tiles.cells_in_box(table(spark, SF, "cells").withColumnRenamed("raw", "cell_barcode"), 0, 2000, 0, 2000)
    plans = [
        spots.count_close_pairs(s, 8), spots.extract_intensity(s, vox, (1, 1, 1), 3), cells.restore_suffix(ids, reads.withColumnRenamed("read_id", "raw_order"), 5), cells.window_spots(reads, 300, 0.1),
        voxels.sample_grid_nearest(vox, s.withColumn("value", F.lit(1)), 4, 10), tiles.assign_subtiles(s, 512, 4), tiles.drop_twin_cells(some, some, 0, 1000, 512)[0], voxels.convolve(vox, voxels.log_kernel((5, 5, 3), 1.0), 32, 32, 4),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_against_all_pairs(spark):
    """Ties, bounds, blocks, negative and broken coordinates; fields and genes never meet others."""
    rng = random.Random(8)
    number = lambda: rng.choice([rng.randint(-15, 25), rng.randint(-15, 25) + 0.5])
    left = [(i, rng.choice([1, 1, 2, None]), rng.choice(["g", "h", None]), float(number()), float(number())) for i in range(250)] + [(900, 1, "g", None, 1.0), (901, 1, "g", float("nan"), 1.0), (903, 1, "g", float("inf"), 1.0), (902, 3, "g", 1.0, 1.0)]
    right = [(rng.choice([1, 1, 2, None]), rng.choice(["g", "h", None]), float(number()), float(number()), rng.randint(0, 40), f"n{i}") for i in range(300)] + [(1, "g", None, 1.0, 0, "broken"), (1, "g", float("inf"), 1.0, 0, "far")]
    a = spark.createDataFrame(left, "id int, fov int, gene string, x double, y double")
    b = spark.createDataFrame(right, "fov int, gene string, x double, y double, o int, name string")
    for tolerance, strict, edge in ((5, True, 16), (5, False, 1024), (2.5, False, 10)):
        got = {r["id"]: r["name"] for r in nearest(a, b, ["fov"], ["gene"], tolerance, ["name"], ["o", "name"], strict, edge).collect()}
        want = {}
        for i, fov, gene, x, y in left:
            fit = []
            for f, g, u, v, o, name in right:
                if None in (fov, gene, x) or f != fov or g != gene or u is None or not math.isfinite(x):
                    continue
                d = (x - u) ** 2 + (y - v) ** 2
                if d < tolerance**2 or (not strict and d == tolerance**2):
                    fit.append((d, o, name))
            want[i] = min(fit)[2] if fit else None
        assert got == want and len({v for v in want.values()}) > 20


def test_nearest_among_many_in_one_place(spark, monkeypatch):
    """Pairs are looked at in parts; a pile of spots doesn't pass as one array."""
    monkeypatch.setattr(nearest_module, "PAIRS", 50)
    left = pa.table({"x": [0.0] * 30, "y": [0.0] * 30})
    right = pa.table({"x": [1.0] * 40, "y": [0.0] * 40, "o": list(range(40, 0, -1))})
    assert (nearest_rows(left, right, [], 5, ["o"], True) == 39).all()


def test_box_sums_against_loops(spark):
    rng = random.Random(9)
    vox = {(f, r, c, rng.randint(1, 5), rng.randint(1, 90), rng.randint(1, 90)): rng.randint(1, 99) for f in (1, 2) for r in (1, 2) for c in (1, 2) for _ in range(400)}
    at = [(f, i, rng.randint(-3, 95), rng.randint(-3, 95), rng.randint(0, 6)) for i, f in enumerate([1, 2, 3] * 40)] + [(1, 0, 40, 40, 3)]
    df = spark.createDataFrame([(*k, v) for k, v in vox.items()], "fov int, round_no int, channel int, z int, y int, x int, value int")
    s = spark.createDataFrame(at, "fov int, spot_id int, x int, y int, z int")
    for box in ((1, 1, 1), (3, 3, 1), (0, 5, 2)):
        got = sorted(tuple(r) for r in spots.extract_intensity(s, df, box, 2, 2).select("fov", "spot_id", "round_no", "sums", "sum_max", "center_max").collect())
        want = []
        for f, i, x, y, z in at:
            for r in (1, 2):
                sums = [sum(v for (g, n, k, w, q, p), v in vox.items() if (g, n, k) == (f, r, c) and abs(p - x) <= box[0] and abs(q - y) <= box[1] and abs(w - z) <= box[2]) for c in (1, 2)]
                want.append((f, i, r, sums, max(sums), max(vox.get((f, r, c, z, y, x), 0) for c in (1, 2))))
        assert got == sorted(want)


def test_shift_by_slices_and_blocks(spark, monkeypatch):
    """The transform over two exchanges against the transform of the whole volume, with ties, a missing reference and blocks of any size."""
    rng = np.random.default_rng(5)
    nx, ny, nz = 12, 9, 5
    volumes = {(f, r): np.where(rng.random((nz, nx, ny)) < 0.1, rng.integers(1, 200, (nz, nx, ny)), 0) for f in (1, 2) for r in (1, 2, 3)}
    volumes[1, 3] = np.roll(volumes[1, 1], (2, -3, 4), (0, 1, 2))
    volumes[2, 1][:] = 0
    volumes[2, 1][1, 2, 3] = volumes[2, 1][1, 2, 5] = 7
    rows = [(f, r, int(z) + 1, int(y) + 1, int(x) + 1, int(v[z, x, y])) for (f, r), v in volumes.items() for z, x, y in zip(*np.nonzero(v))] + [(9, 2, 1, 1, 1, 5)]
    merged = spark.createDataFrame(rows, "fov int, round_no int, z int, y int, x int, value int")
    want = {(9, 2): (0, 0, 0, 0)}
    for (f, r), v in volumes.items():
        if r > 1:
            score = np.rint(np.fft.irfftn(np.fft.rfftn(volumes[f, 1]) * np.conj(np.fft.rfftn(v)), v.shape))
            z, x, y = np.unravel_index(int(score.argmax()), v.shape)
            want[f, r] = tuple(int(d - n if d > n // 2 else d) for d, n in ((x, nx), (y, ny), (z, nz))) + (int(score.max()),)
    for size in (7, 4096):
        monkeypatch.setattr(voxels, "FREQUENCIES", size)
        got = {(r["fov"], r["round_no"]): (r["dx"], r["dy"], r["dz"], r["score"]) for r in voxels.estimate_shift(merged, 1, nx, ny, nz).collect()}
        assert got == want
    assert want[1, 3][:3] == (3, -4, -2)


def test_hulls_of_many_cells(spark):
    rng = random.Random(10)
    rows = [(c, rng.randint(0, 12), rng.randint(0, 12)) for c in range(1, 40) for _ in range(rng.choice((1, 2, 3, 9, 60)))]
    rows += [(50, k, k * k) for k in range(-40, 40)] + [(51, k, 3) for k in range(9)] + [(52, None, 1), (52, 1, 1)] + [(53, k, abs(k % 7 - 3)) for k in range(200)]
    df = spark.createDataFrame(rows, "cell_barcode int, x int, y int").repartition(5)
    got = {r["cell"]: [(p["x"], p["y"]) for p in r["ring"]] for r in cells.cell_hulls(df).collect()}
    for c in {r[0] for r in rows}:
        points = {(x, y) for k, x, y in rows if k == c and x is not None}
        cross = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        edge = {a: b for a in points for b in points if a != b and all(cross(a, b, p) > 0 or (cross(a, b, p) == 0 and min(a, b) <= p <= max(a, b)) for p in points)}
        if len(edge) < 3:
            assert c not in got
            continue
        ring = [min(points)]
        while len(ring) == 1 or ring[-1] != ring[0]:
            ring.append(edge[ring[-1]])
        assert got[c] == ring


def test_split_windows(spark):
    """Own spots are bounded however dense a place is, every spot is in one window as an own one, and fields are apart."""
    rng = random.Random(11)
    rows = [(f, i * 10 + f, rng.choice([rng.randint(0, 999), rng.randint(100, 140)]), rng.choice([rng.randint(0, 999), rng.randint(100, 140)])) for f in (1, 2) for i in range(600)] + [(3, 7, 5, 5)]
    df = spark.createDataFrame(rows, "fov int, id int, x int, y int")
    windows = {(r["fov"], r["level"], r["wx"], r["wy"]): r["n"] for r in cells.quad_windows(df, 256, 20, 5).collect()}
    assert sum(windows.values()) == len(rows)
    own = {}
    for f, i, x, y in rows:
        mine = [w for w in windows if w[0] == f and x // (256 / 2 ** w[1]) == w[2] and y // (256 / 2 ** w[1]) == w[3]]
        assert len(mine) == 1
        own[mine[0]] = own.get(mine[0], 0) + 1
    assert own == windows and all(n <= 20 or k[1] == 5 for k, n in own.items()) and max(k[1] for k in own) > 1
    held = {(r["id"], r["level"], r["wx"], r["wy"]) for r in cells.split_windows(df, 256, 0.1, 20, 5).collect()}
    want = set()
    for f, i, x, y in rows:
        for g, k, wx, wy in windows:
            w = 256 / 2**k
            m = math.ceil(w * 0.1)
            if g == f and math.floor((x - m) / w) <= wx <= math.floor((x + m) / w) and math.floor((y - m) / w) <= wy <= math.floor((y + m) / w):
                want.add((i, k, wx, wy))
    assert held == want


def test_full_windows_of_fields(spark):
    rows = spark.createDataFrame([(1, 1, 0, 0), (1, 2, 0, 0), (2, 3, 0, 0)], "fov int, id int, wx int, wy int")
    assert {r["id"] for r in cells.filter_small_windows(rows, 2).collect()} == {1, 2}


def test_twins_across_seams(spark):
    """Only neighbours in the grid meet; a corner cell may fall in two strips; a tie drops the later tile's cell."""
    at = spark.createDataFrame([(1, 0, 0, 0, 0), (2, 1, 0, 90, 0), (3, 0, 1, 0, 90), (4, 2, 0, 180, 0), (0, 5, 5, 0, 0)], "tile int, column_index int, row_index int, x int, y int")
    strips = {(r["old"], r["new"], r["axis"]): (r["low"], r["high"]) for r in tiles.neighbour_strips(at, 100).collect()}
    assert strips == {(1, 2, "x"): (90, 100), (2, 4, "x"): (180, 190), (1, 3, "y"): (90, 100)}
    some = [(1, 1, 95, 50), (2, 1, 95, 52), (1, 2, 91, 20), (2, 2, 96, 20), (1, 3, 99, 99), (3, 3, 97, 96), (2, 4, 95, 95), (1, 5, 50, 50), (2, 5, 50, 50), (4, 6, 95, 50)]
    left = {(r["tile"], r["cell_barcode"]) for r in tiles.drop_twins(spark.createDataFrame(some, "tile int, cell_barcode int, x int, y int"), at, 100).collect()}
    assert left == {(1, 1), (2, 2), (3, 3), (2, 4), (1, 5), (2, 5), (4, 6)}


def test_grids_of_slides(spark):
    rows = [(1, 1, 0, 0), (1, 2, 290, 0), (1, 3, 580, 0), (1, 4, 5000, 700), (2, 1, 290, 10), (2, 2, None, 10)]
    got = {(r["slide"], r["tile"]): (r["column_index"], r["row_index"]) for r in tiles.logical_grid(spark.createDataFrame(rows, "slide int, tile int, x int, y int"), 300, ("slide",)).collect()}
    # 580 is farther from the mean of 0 and 290 than 300, so it starts a group
    assert got == {(1, 1): (0, 0), (1, 2): (0, 0), (1, 3): (1, 0), (1, 4): (2, 1), (2, 1): (0, 0), (2, 2): (None, 0)}


def test_bucketed_tables_join_in_place(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = registry.queries()["bucketed_files"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_numbers_of_rows_beyond_64_bits(spark, tmp_path):
    """Order keys up to 2^40: numbers are those of the SQL as far as it has any, and of one row each beyond."""
    keys = [1, 1_048_574, 1_048_575, 1_048_576, 9_000_000, 9_000_000 + 2**21, 2**40]
    rows = [(k, p, 1, n, 1.0, 900.25 + n) for k in keys for p in (0, 65_535, 65_536, 1_200_000) for n in (1, 7)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    exact = [(k * 8 + n) * 2**40 + p * 2**24 + round(price * 100) for k, p, _, n, _, price in rows]
    got = [r["spot_id"] for r in table(spark, str(tmp_path), "spots").collect()]
    assert len(set(got)) == len(rows) and all(g < 0 for g in got if g not in exact)
    assert {g for g in got if g >= 0} == {e for e in exact if e < 2**63}
    for name in ("clean_genes", "colour_vectors", "read_strings"):
        assert registry.queries()[name](spark, str(tmp_path)).count() == len(rows) * (5 if name == "colour_vectors" else 1)


def test_log_files_are_bounded(spark, monkeypatch):
    """A file is one value when it is read whole, so it holds so many logs at most; all logs are counted."""
    monkeypatch.setattr(log_queries, "LOGS_A_FILE", 3)
    read, seen = readers.read_logs, []
    monkeypatch.setattr(readers, "read_logs", lambda *a: seen.append(read(*a)) or seen[0])
    rows = registry.queries()["whole_logs"](spark, SF).collect()
    given = table(spark, SF, "logs").groupBy("submit", (F.col("task_id") % 20).alias("task_id")).agg(F.count(F.lit(1)).alias("logs"), F.sum(F.length("text")).alias("n_chars"))
    assert {(r["submit"], r["task_id"], r["logs"], r["n_chars"]) for r in rows} == {tuple(r) for r in given.collect()}
    assert max(r["text"].count("Method:") for r in seen[0].collect()) == 3


def test_groups_in_batches(spark):
    """Groups that go on over batches, null keys and keys of two columns come whole and apart, as in groupBy; blocks are cut to what is near a voxel."""
    rows = spark.range(3000).selectExpr("if(id % 7 = 0, null, cast(id % 7 as string)) as a", "cast(id * id % 11 as int) as b", "id as v")

    def added(g):
        return pa.table({"a": g["a"][:1], "n": pa.array([len(g)], pa.int64()), "s": pa.array([sum(g["v"].to_pylist())], pa.int64())})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        got = in_groups(rows, ["a", "b"], added, "a string, n long, s long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).select("a", "n", "s").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    one = pa.table({"z": [1, 1], "y": [70, 71], "x": [3, 3], "by": [1, 1], "bx": [0, 0]})
    assert Block(one, 2).shape == (5, 10, 9)


def test_a_position_is_one_file(spark, tmp_path):
    rows = spark.range(0, 400, 1, 8).selectExpr("id", "concat('Position', id % 5) as at")
    writers.write_by_position(rows, f"{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("at=*/*.csv"))) == 5
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == 400


def test_small_positions_share_files(spark, tmp_path, monkeypatch):
    """Files of `fov_tables` don't grow in number with the fields of view, and a position lies in one of them."""
    rows = spark.range(0, 4000, 1, 8).selectExpr("concat('Position', id % 1000) as at", "cast(id as int) as x")
    writers.write_together(rows, f"{tmp_path}/reads")
    writers.write_together(rows.filter("x % 3 = 0 and x < 500"), f"{tmp_path}/cells")
    files = [f.read_text().split()[1:] for f in (tmp_path / "reads").glob("*.csv")]
    assert len(files) <= 4 and sum(map(len, files)) == 4000 and sum(len({line.split(",")[0] for line in f}) for f in files) == 1000
    r, c = readers.read_fov_tables(spark, f"{tmp_path}/reads", f"{tmp_path}/cells", "at string, x int", "at string, x int")
    both = {str(x) for x in range(0, 500, 3)}
    assert r.columns == c.columns == ["fov", "x"] and {x["fov"] for x in r.collect()} == both and r.count() == 4 * len(both) and c.count() == len(both)
    monkeypatch.setattr("tessella.plans.log_queries.shared_folder", lambda _, name: f"{tmp_path}/{name}")
    assert registry.queries()["fov_tables"](spark, SF).count()
    assert all(len(list((tmp_path / m / t).rglob("*.csv"))) <= 4 for m in ("clustermap", "comseg", "baysor") for t in ("reads", "cells"))


def test_a_field_of_view_is_one_file_a_table(spark, tmp_path):
    """Rows that come in many tasks don't leave a file from each of them in every field of view."""
    spots = spark.range(0, 400, 1, 8).selectExpr("id as spot_id", "cast(id % 5 as int) as fov")
    reads = spots.selectExpr("fov", "spot_id", "array(0.5D, 0.25D) as scores", "'12' as colorseq")
    sums = spots.selectExpr("fov", "spot_id", "explode(array(1, 2)) as round_no", "array(1, 2, 3) as sums", "3 as sum_max", "0 as center_max")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_decoding(spots, reads, reads, sums, f"{tmp_path}/out", 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("goodPoints", "scores", "reads", "intensity"):
        assert len(list((tmp_path / "out" / name).glob("fov=*/*.parquet"))) == 5
        assert spark.read.parquet(f"{tmp_path}/out/{name}").count() == 400


def test_sequences_are_encoded_once(spark):
    """Codes are made of distinct sequences: nothing is encoded below the first shuffle, whatever is filtered or joined later."""
    book = spark.createDataFrame([(k, f"g{k}", ("CGATGAT", "TGAATGG", "CCC")[k % 3]) for k in range(30)], "row_no long, gene string, sequence string")
    for layout, remove in (("swap", None), ("plain", [3]), ("segments", [2, 4])):
        coded = decode.build_codebook(book, "Olympus", layout, remove)
        plan = coded.join(coded.select(F.col("barcode").alias("other")), F.col("barcode") == F.col("other"))._jdf.queryExecution().optimizedPlan().toString()
        encoding = [line for line in plan.splitlines() if "lambda" in line]
        assert encoding and all("same#" in line and "sequence#" not in line for line in encoding)
    assert sorted(tuple(r) for r in decode.build_codebook(book).select("row_no", "gene").collect()) == [(28, "g28")]


def test_maxima_keep_few_voxels(spark):
    """Of a slope only the top goes on; of a plateau, with a greater neighbour or without, all of it."""
    rows = [(1, 1, 1, 1, 1, x, x) for x in range(1, 101)] + [(1, 1, 1, 1, 9, x, 5) for x in (1, 2, 3)] + [(1, 1, 1, 1, 20, x, v) for x, v in ((1, 5), (2, 5), (3, 6))]
    vox = spark.createDataFrame(rows, "fov int, round_no int, channel int, z int, y int, x int, value int")
    kept = sorted((r["y"], r["x"], r["flat"], r["beaten"]) for r in spots._candidates(vox, ["fov", "round_no", "channel"], 26).collect())
    assert kept == [(1, 100, False, False), *[(9, x, True, False) for x in (1, 2, 3)], (20, 1, True, False), (20, 2, True, True), (20, 3, False, False)]
    assert sorted((r["y"], r["x"]) for r in spots.regional_maxima(vox).collect()) == [(1, 100), (9, 1), (9, 2), (9, 3), (20, 3)]


def test_numbers_and_designs_use_all_partitions(spark):
    """Small ranges are not put together in one task, and runs are dealt before they are made distinct."""
    runs = spark.range(1000).select(F.col("id").alias("run"))
    plan = logs.level_design(runs, {"a": [1.0, 2.0]}, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [run" in plan and "RepartitionByExpression [range" in plan


def test_close_pairs_in_blocks(spark):
    """Each pair once, across blocks and next to their edges too, and a spot goes to few blocks instead of to its 27 cells."""
    rng = random.Random(5)
    edges = [(f, x + dx, 250, 3) for f in (1, 2) for x in (0, 256, 512) for dx in (-8, -7, -1, 0, 1, 7)]
    places = edges + [(1, 40, y, z) for y in (249, 255, 256, 263) for z in (249, 255, 256, 263)] + [(1 + k % 2, rng.randint(-20, 300), rng.randint(-20, 300), rng.choice([1, 2, 9, 255, 257])) for k in range(700)]
    rows = [(f, k // 2 * 2 if k < 40 else k, x, y, z) for k, (f, x, y, z) in enumerate(places)]
    want = {}
    for a, b in itertools.combinations(rows, 2):
        if a[0] == b[0] and a[1] != b[1] and 0 < math.dist(a[2:], b[2:]) < 8:
            want[a[0]] = want.get(a[0], 0) + 1
    empty = [(None, 1, 1, 1, 1), (None, 2, 2, 2, 2), (1, None, 0, 250, 3), (1, 9000, None, 250, 3), (3, 1, 1, 1, 1)]
    for kind in ("int", "double"):
        df = spark.createDataFrame(rows + empty, "fov int, spot_id long, x int, y int, z int").withColumns({c: F.col(c).cast(kind) for c in "xyz"})
        counted = spots.count_close_pairs(df, 8)
        assert {r["fov"]: r["n"] for r in counted.collect()} == want
    wild = spark.createDataFrame([(1, 1, float("nan"), 0.0, 0.0), (1, 2, float("inf"), 0.0, 0.0), (1, 3, float("inf"), 1.0, 0.0)], df.schema)
    assert {r["fov"]: r["n"] for r in spots.count_close_pairs(df.union(wild), 8).collect()} == want
    assert "Join" not in counted._jdf.queryExecution().executedPlan().toString()


def test_codes_take_one_shuffle(spark, monkeypatch):
    """All sums over a place happen behind one shuffle, in as many tasks as the rows need: none holds its whole split."""
    monkeypatch.setattr(views, "PLACED_ROWS", 500)
    assert sorted(table(spark, SF, "placed_voxels").collect()) == sorted(table(spark, SF, "voxels").collect())
    parts = -(-table(spark, SF, "lineitem").count() // 500)
    assert parts > 4
    for name in ("voxel_calls", "voxel_codes"):
        df = registry.queries()[name](spark, SF)
        above, exchange, below = df._jdf.queryExecution().executedPlan().toString().partition("Exchange hashpartitioning")
        assert exchange and "Exchange" not in above + below and "Aggregate" in above and "Aggregate" not in below
        assert df.rdd.getNumPartitions() == parts
