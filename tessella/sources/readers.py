"""Readers of the files around a run. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POSITION = r"Position(\d+)"
#: What each segmentation method calls its columns, and the common names.
METHOD_COLUMNS = {
    "clustermap": {"spot_location_1": "column", "spot_location_2": "row", "spot_location_3": "z", "clustermap": "raw_cell_barcode"},
    "comseg": {"x": "column", "y": "row", "cell": "raw_cell_barcode"},
    "baysor": {"x": "column", "y": "row", "cell": "raw_cell_barcode"},
}
SPOT_SCHEMAS = {
    "own": "x int, y int, z int, intensity double, addition double, channel int",
    "external": "x int, y int, z int, intensity double, probability double, channel int",
}


def _fov() -> Column:
    return F.regexp_extract("_metadata.file_path", POSITION, 1)


def read_codebook(spark: SparkSession, path: str, parts: int = 1) -> DataFrame:
    """(row_no, gene, sequence) of a headerless file, rows numbered in file order; with parts=2, sequence1 and sequence2.

    A codebook is one small file: it is read as one text, so that its order is sure.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("row_no", "line")).filter(F.trim("line") != "")
    cells = F.split("line", ",")
    names = ["sequence"] if parts == 1 else [f"sequence{k + 1}" for k in range(parts)]
    return lines.select(F.col("row_no").cast("long").alias("row_no"), F.trim(F.get(cells, F.lit(0))).alias("gene"), *[F.trim(F.get(cells, F.lit(k + 1))).alias(n) for k, n in enumerate(names)])


def read_spots(spark: SparkSession, path: str, kind: str = "own") -> DataFrame:
    """Spot files with a header; fov from the path. Column 5 is a probability for an outside finder."""
    return spark.read.csv(path, schema=SPOT_SCHEMAS[kind], header=True).withColumn("fov", _fov())


def read_fov_tables(spark: SparkSession, reads_path: str, cells_path: str, reads_schema: str, cells_schema: str) -> tuple[DataFrame, DataFrame]:
    """Reads and cell centres of every field of view that has both. fov comes from the path, by globs over the Position folders, or from
    a column `at` where the schema has one and files hold many positions."""

    def one(path: str, schema: str) -> DataFrame:
        rows = spark.read.csv(path, schema=schema, header=True)
        return rows.withColumn("fov", F.regexp_extract("at", POSITION, 1)).drop("at") if "at" in rows.columns else rows.withColumn("fov", _fov())

    reads, cells = one(reads_path, reads_schema), one(cells_path, cells_schema)
    fovs = lambda df: df.select("fov").distinct()
    return reads.join(fovs(cells), "fov", "left_semi"), cells.join(fovs(reads), "fov", "left_semi")


def normalise_columns(df: DataFrame, method: str) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in METHOD_COLUMNS[method].items() if k in df.columns})


def read_tile_layout(spark: SparkSession, path: str) -> DataFrame:
    """(tile, x, y) of lines 'Position007.tif; ; (x, y, z)'. Fails if no line is one."""
    line = r"^\s*\D*(\d+)\.\w+\s*;[^;]*;\s*\(\s*([-+0-9.eE]+)\s*,\s*([-+0-9.eE]+)"
    g = lambda k: F.regexp_extract("value", line, k)
    out = spark.read.text(path).select(g(1).alias("t"), g(2).alias("x"), g(3).alias("y")).filter("t <> ''").select(F.col("t").cast("int").alias("tile"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    if out.isEmpty():
        raise ValueError(f"no tile lines in {path}")
    return out


def read_stage_positions(spark: SparkSession, path: str) -> DataFrame:
    """(name, phys_x, phys_y) in micrometres from the XML attributes, which are in metres and have one of two names."""
    schema = "_PositionIdentifier string, _PositionName string, _XPos double, _YPos double, _PosX double, _PosY double"
    raw = spark.read.format("xml").option("rowTag", "XYZStagePointDefinition").schema(schema).load(path)
    um = lambda a, b: (F.coalesce(a, b) * 1e6)
    return raw.select(F.coalesce("_PositionName", "_PositionIdentifier").alias("name"), um("_XPos", "_PosX").alias("phys_x"), um("_YPos", "_PosY").alias("phys_y")).dropna(subset=["phys_x", "phys_y"])


def read_logs(spark: SparkSession, root: str, files: str = "*/*.out", submit: str = r"([^/]+)/[^/]+$", task: str = r"_(\d+)\.out$") -> DataFrame:
    """(submit, task_id, text), one row for each log file below root; submit and task are found in its path, a task without a number is 10**12."""
    text = spark.read.text(f"{root}/{files}", wholetext=True)
    at = F.col("_metadata.file_path")
    return text.select(F.regexp_extract(at, submit, 1).alias("submit"), F.coalesce(F.nullif(F.regexp_extract(at, task, 1), F.lit("")).try_cast("bigint"), F.lit(10**12)).alias("task_id"), F.col("value").alias("text"))


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(cell, ring) as write_polygons leaves them: a closed ring of at least three corners; others are skipped."""
    rings = spark.read.json(path, schema="cell long, ring array<struct<x:double,y:double>>")
    return rings.filter((F.size("ring") > 3) & (F.get("ring", F.lit(0)) == F.element_at("ring", -1)))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("fov string, z int, y int, x int, label int").parquet(path)


def read_voxels(spark: SparkSession, path: str) -> DataFrame:
    """Voxels that aren't zero; absent ones are zeros, so missing slices need no filling."""
    return spark.read.schema("fov string, round_no int, channel int, z int, y int, x int, value int").parquet(path).filter("value <> 0")


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """Parameter sets of a tab-separated file: comments go, and lines of fewer than six fields."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("#")).filter(F.size(cells) >= 6)
    kinds = {"tag": "string", "ic": "double", "id": "int", "ipf": "double", "icr_xy": "int", "icr_z": "int"}
    return rows.select(*[F.trim(F.get(cells, F.lit(k))).cast(t).alias(n) for k, (n, t) in enumerate(kinds.items())])


def expand_positions(specs: DataFrame, column: str, key: str) -> DataFrame:
    """(key, at, position): 'Position3-7,9' as numbers in order, ranges also downwards, each at its first place."""
    pieces = specs.select(key, F.posexplode(F.split(F.regexp_replace(column, r"Position|\s", ""), ",")).alias("piece", "text")).filter("text <> ''")
    a = F.regexp_extract("text", r"^(\d+)", 1).cast("int")
    b = F.coalesce(F.nullif(F.regexp_extract("text", r"-(\d+)$", 1), F.lit("")).cast("int"), a)
    one = pieces.select(key, "piece", F.posexplode(F.sequence(a, b)).alias("k", "position"))
    first = one.groupBy(key, "position").agg(F.min(F.struct("piece", "k")).alias("at"))
    return first.select(key, "position", "at.piece", "at.k")
