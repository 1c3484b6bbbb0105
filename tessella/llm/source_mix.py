"""Mixing sources to target weights (operator 10): Poisson replication by hash-seeded inversion, then a global shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Weights of the mixture in the registered query; sources that are not named share `other` in proportion to nothing but
#: their number, that is, equally.
WEIGHTS = {"src0": 0.15, "src1": 0.10, "src2": 0.10}
OTHER = 1.0


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts joined by '|': 52 bits, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, other: float = OTHER, total: float = 1.0) -> DataFrame:
    """(source, size, rate): how often a source's documents must repeat on average.

    size is the source's bytes of text. A named source has its weight; the others divide the weight `other` minus the named ones'
    sum equally. The mixture has `total` times the input's bytes. A source without any bytes repeats as often as it stands (rate = total).
    """
    weights = WEIGHTS if weights is None else weights
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0)).alias("size"))
    named = F.coalesce(*[F.when(F.col("source") == s, F.lit(float(w))) for s, w in weights.items()], F.lit(None).cast("double")) if weights else F.lit(None).cast("double")
    marked = sizes.select("source", "size", named.alias("named"))
    all_ = marked.agg(F.sum("size").alias("bytes"), F.count_if(F.col("named").isNull()).alias("free"), F.coalesce(F.sum("named"), F.lit(0.0)).alias("taken"))
    # one row: its size is proven
    joined = marked.join(F.broadcast(all_))
    share = F.coalesce(F.col("named"), F.greatest(F.lit(0.0), F.lit(float(other)) - F.col("taken")) / F.col("free"))
    return joined.select("source", "size", F.when(F.col("size") > 0, share * F.lit(float(total)) * F.col("bytes") / F.col("size")).otherwise(F.lit(float(total))).alias("rate"))


def thresholds(rates_: DataFrame) -> DataFrame:
    """(source, rate, cdf): the Poisson distribution function at 0, 1, 2, ... until nothing that a double can tell is left above it.

    Terms are formed in logarithms, so a large rate doesn't underflow. A source has about as many terms as its rate; they are summed by a window of that size.
    """
    top = F.when(F.col("rate") > 0, F.ceil(F.col("rate") + F.lit(12.0) * F.sqrt("rate") + F.lit(30.0))).otherwise(0).cast("int")
    terms = rates_.select("source", "rate", F.explode(F.sequence(F.lit(0), top)).alias("k"))
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_k = F.when(F.col("k") > 0, F.log(F.col("k").cast("double"))).otherwise(0.0)
    p = F.when(F.col("rate") > 0, F.exp(-F.col("rate") + F.col("k") * F.log("rate") - F.sum(log_k).over(upto))).otherwise(1.0)
    summed = terms.withColumn("p", p).withColumn("c", F.sum("p").over(upto))
    by_k = F.array_sort(F.collect_list(F.struct("k", "c")))
    return summed.groupBy("source").agg(F.first("rate").alias("rate"), F.transform(by_k, lambda x: x["c"]).alias("cdf"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, other: float = OTHER, total: float = 1.0, seed: str = "mix") -> DataFrame:
    """(row struct of all columns of docs, copy from 0, copies, rate, shuffle_key): each row as often as its Poisson number says.

    The number inverts the Poisson distribution with the mean rate of the row's source at a uniform number from the hash
    of seed, id and text, so it doesn't depend on how rows are dealt to tasks, and a lost task gives the same rows again. Copies are spread by the
    hash of (id, text, copy): rows go to partitions by it and are sorted by it within each, so neighbours in the output have nothing in common.
    Null sources are a source; null ids and texts count as empty in the hash; rows that repeat others in id and text have
    their number; an empty table gives no rows. No column of docs can clash: they are all inside `row`.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    id_ = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    print_ = F.md5(text.cast("binary"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source_col).cast("string").alias("__source"), id_.alias("__id"), print_.alias("__print"))
    rate = thresholds(rates(docs, source_col, text_col, weights, other, total)).select(F.col("source").alias("__s"), "rate", F.col("cdf").alias("__cdf"))
    joined = marked.join(rate, F.col("__source").eqNullSafe(F.col("__s")))
    copies = F.size(F.filter(F.col("__cdf"), lambda c: c <= _uniform(F.lit(seed), F.col("__id"), F.col("__print"))))
    counted = joined.withColumn("copies", copies).filter("copies > 0").select("row", "rate", "copies", "__id", "__print")
    spread = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    keyed = spread.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.lit("place"), "__id", "__print", F.col("copy").cast("string")).cast("binary")))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(partitions, "shuffle_key").sortWithinPartitions("shuffle_key").select("row", "copy", "copies", "rate", "shuffle_key")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, as often as mix_sources says, in shuffled order."""
    return mix_sources(docs, **options).select("row.*")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to WEIGHTS."""
    found = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "copy", "copies", F.round("rate", 6).alias("rate"), "shuffle_key")


_NAMED = " ".join(f"WHEN source = '{s}' THEN {w!r}::DOUBLE" for s, w in WEIGHTS.items())

#: `mixed_docs` is what has to stand before: a query named `docs` with doc_id, source, text.
SQL_OVER_DOCS = f"""
sizes AS (SELECT source, coalesce(sum(strlen(text)), 0) AS size, CASE {_NAMED} END AS named FROM docs GROUP BY source),
totals AS (SELECT sum(size) AS bytes, count(*) FILTER (named IS NULL) AS free, coalesce(sum(named), 0) AS taken FROM sizes),
rates AS (
  SELECT source, CASE WHEN size > 0 THEN coalesce(named, greatest(0.0::DOUBLE, {OTHER!r}::DOUBLE - taken) / free) * 1.0::DOUBLE * bytes::DOUBLE / size::DOUBLE ELSE 1.0::DOUBLE END AS rate
  FROM sizes, totals
),
terms AS (SELECT source, rate, k, CASE WHEN rate > 0 THEN exp(-rate + k * ln(rate) - lgamma(k + 1.0)) ELSE 1.0 END AS p
  FROM rates, LATERAL (SELECT unnest(range(0, CASE WHEN rate > 0 THEN CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1 ELSE 1 END)) AS k)),
cdf AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
seeded AS (SELECT docs.*, CAST('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u FROM docs),
counted AS (
  SELECT s.*, r.rate, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM s.source AND cdf.c <= s.u) AS copies
  FROM seeded s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
),
copied AS (SELECT *, unnest(range(0, copies)) AS copy FROM counted WHERE copies > 0)
"""

SQL = f"""
WITH docs AS (SELECT doc_id, source, text FROM documents),
{SQL_OVER_DOCS}
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, CAST(copies AS INTEGER) AS copies, round(rate, 6) AS rate,
  md5('mix|place|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || copy::VARCHAR) AS shuffle_key
FROM copied
"""
