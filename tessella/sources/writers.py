"""Writers of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tile_layout_lines(tiles: DataFrame) -> DataFrame:
    """Lines of a layout file, in tile order."""
    return tiles.orderBy("tile").select(F.format_string("Position%03d.tif; ; (%.1f, %.1f, 0.0)", "tile", F.col("x").cast("double"), F.col("y").cast("double")).alias("value"))


def wide_scores(reads: DataFrame, rounds: int) -> DataFrame:
    """Scores as columns round001, round002, ..."""
    return reads.select("fov", "spot_id", *[F.get("scores", F.lit(k)).alias(f"round{k + 1:03d}") for k in range(rounds)])


def wide_intensity(intensity: DataFrame, rounds: int, channels: int = 3) -> DataFrame:
    """Five columns a round: the centre's maximum, each channel's box sum, and the greatest of these."""
    columns = []
    for r in range(1, rounds + 1):
        pick = lambda c, r=r: F.max(F.when(F.col("round_no") == r, c))
        columns.append(pick(F.col("center_max")).alias(f"round{r:03d}_centerMax"))
        columns += [pick(F.get("sums", F.lit(c))).alias(f"round{r:03d}_NeighborSum_ch{c + 1}") for c in range(channels)]
        columns.append(pick(F.col("sum_max")).alias(f"round{r:03d}_NeighborSum_chMax"))
    return intensity.groupBy("fov", "spot_id").agg(*columns)


def write_decoding(points: DataFrame, scores: DataFrame, reads: DataFrame, intensity: DataFrame, path: str, rounds: int, fmt: str = "parquet") -> None:
    """Good points, raw scores, raw reads and intensities, each partitioned by fov. Rows are dealt by fov first, so a fov has one file a table instead of one from every task."""
    for name, df in (("goodPoints", points), ("scores", wide_scores(scores, rounds)), ("reads", reads.select("fov", "spot_id", "colorseq")), ("intensity", wide_intensity(intensity, rounds))):
        df.repartition("fov").write.partitionBy("fov").format(fmt).option("header", True).save(f"{path}/{name}")


def bucketed_decoding(scores: DataFrame, reads: DataFrame, intensity: DataFrame, path: str, rounds: int, table: str, buckets: int) -> dict[str, str]:
    """Raw scores, raw reads and intensities as tables `{table}_...` of the catalogue, bucketed and sorted by (fov, spot_id), so that later joins over a spot
    need no exchange; the names by what they hold.

    A task would write to every bucket, so rows are dealt by bucket first: a table has one file a bucket.
    """
    keys, names = ["fov", "spot_id"], {}
    for name, df in (("scores", wide_scores(scores, rounds)), ("reads", reads.select("fov", "spot_id", "colorseq")), ("intensity", wide_intensity(intensity, rounds))):
        names[name] = f"{table}_{name}"
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path}/{name}").saveAsTable(names[name])
    return names


def write_by_position(rows: DataFrame, path: str, column: str = "at") -> None:
    """CSV files with a header in a folder of each position. Rows are dealt by position first, so a position has one file instead of one from every task."""
    rows.repartition(column).write.partitionBy(column).option("header", True).csv(path)


def write_together(rows: DataFrame, path: str, column: str = "at") -> None:
    """CSV files with a header that hold many positions each, the position's name in a column: for positions of few rows, of which each would cost a file.

    A position lies in one file, and there are no more files than tasks.
    """
    rows.repartition(column).write.option("header", True).csv(path)


def write_counts(counts: DataFrame, path: str) -> None:
    counts.write.parquet(path)


def write_polygons(hulls: DataFrame, path: str) -> None:
    """One JSON object a cell: its number and closed ring."""
    hulls.write.json(path)


def write_tile_layout(tiles: DataFrame, path: str) -> None:
    """One file: a layout has a line a tile."""
    tile_layout_lines(tiles).coalesce(1).write.text(path)
