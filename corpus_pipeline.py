"""A cleaning pipeline over documents: each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontamination, line_dedup, quality, simhash_dedup, source_mix
from tessella.operators.graph import drop_folder, shared_folder

#: A document stays if its quality score is at least this.
QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; word vectors come from these documents, labels from the table.

    Null and empty texts have a score like any other; repeated rows have one score; an empty table stays empty.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter(F.col("score") >= QUALITY).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines within one edit of an earlier line; n_chars is counted anew.

    Documents without lines, that is null, empty and blank texts, stay as they are; of repeated rows only the first keeps its lines.
    """
    left = line_dedup.cleaned(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least doc_id, nulls last; texts without words are one group."""
    return simhash_dedup.keep_one(docs, shingle=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with the benchmark; texts without words share none."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights and shuffled; a null source is a source."""
    return source_mix.mixed(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mix", mixed_sources),
]

#: A trained network, edit distances and fingerprints are beyond SQL; tests/llm/ holds run() and every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents; every stage's rows are written to the shared folder and read again, and go when the next one's are there."""
    folder, before = shared_folder(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        if before:
            drop_folder(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
