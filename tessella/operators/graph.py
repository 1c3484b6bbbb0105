"""Connected components by alternating stars."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which all executors share."""
    return f"{_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. One is set only where there is none and executors live on this machine, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts lineage by a reliable checkpoint in the session's folder."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _stars(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (v, least neighbour of u or u) and (u, that). pairs: u and a neighbour v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, label): for every node of an edge (a, b) the least node of its component.

    Large and small stars in turn, O(log^2 n) rounds: no step forms more rows than there are edges, and a hub's edges are
    aggregated and joined by keys that the adaptive plan may split. Null ends are ignored; loops give a node of its own.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).dropna()
    nodes = e.select("u").union(e.select("v")).distinct()
    e = checkpointed(e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.isEmpty():
        return nodes.select(F.col("u").alias("node"), F.col("u").alias("label"))
    mark = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _stars(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        e = checkpointed(small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("s")).select(F.col("s.v").alias("u"), F.col("s.m").alias("v")).filter("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(e.groupBy("u").agg(F.min("v").alias("v")), "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("label"))
