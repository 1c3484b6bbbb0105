"""Filter interaction audit (operator 12): the removal game of a set of filters, its Hart-Mas-Colell potential, and every order's steps."""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The filters of the registered query, in the order of their bits.
FILTERS = "ABCDE"
_SETS = 1 << len(FILTERS)
_SPACE = r"[\x20\x09-\x0D]+"


def _bit(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(flags)])


def text_failures(text: Column) -> list[Column]:
    """A to D of one text: under 200 words; distinct words below half of them; capitals above 2 % of the code points; a mark out of #$%&*|."""
    return [
        F.size("words") < 200,
        F.size(F.array_distinct("words")) * 2 < F.size("words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 50 > F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part by the set of filters they fail, how many of them are labelled good, and toxic.

    mask has a bit for each filter, A the lowest. Null texts are empty, null parts the empty part. A document fails E if a smaller id has the same text
    anywhere in the table: a null id is neither smaller nor greater than another. Rows that repeat an id each count; of several labels of an id
    one suffices. Texts are judged where they are read; only a 32-byte hash of each goes on, and groups of equal texts, whatever
    their size, are counts by (text, part, mask, label) before they meet.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.array_remove(F.split(text, _SPACE), "").alias("words"))
    own = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("print"), _bit(text_failures(F.col("text"))).alias("own"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    judged = own.join(marks, "id", "left").na.fill(0, ["good", "toxic"])
    kind = ["print", "part", "own", "good", "toxic"]
    # equal rows of an id first, where the join has put them, so that the number of rows at the least id is known
    same = judged.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("n"))
    met = same.groupBy(*kind).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnumbered"), F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"))
    first = met.groupBy("print").agg(F.min("least").alias("first"))
    both = met.join(first, "print")
    clear = F.col("unnumbered") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    e = 1 << FILTERS.index("E")
    split = both.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("own").alias("mask"), clear.alias("n")), F.struct((F.col("own") + e).alias("mask"), (F.col("n") - clear).alias("n")))).alias("s"))
    return split.select("part", "good", "toxic", "s.mask", "s.n").groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("good") * F.col("n")).alias("good"), F.sum(F.col("toxic") * F.col("n")).alias("toxic"))


def games(failed: DataFrame) -> DataFrame:
    """(part, n, v, good, toxic, potential): arrays over the 32 coalitions of filters, by their bits: documents, good and toxic ones that a coalition
    removes, and its potential.

    The potential of nobody is 0, and P(S) = (v(S) + the sum of P(S without i) over i in S) / |S|. It is kept as whole numbers |S|! P(S), and built
    up by one fold in the order of the bits, in which every subset comes before its set.
    """
    sets = F.explode(F.sequence(F.lit(0), F.lit(_SETS - 1)))
    met = failed.withColumn("coalition", sets).withColumn("hit", F.col("mask").bitwiseAND(F.col("coalition")) != 0)
    hit = lambda c: F.coalesce(F.sum(F.when(F.col("hit"), F.col(c))), F.lit(0)).alias(c)
    values = met.groupBy("part", "coalition").agg(F.sum("n").alias("all"), hit("n"), hit("good"), hit("toxic"))
    wide = values.groupBy("part").agg(F.max("all").alias("n"), F.array_sort(F.collect_list(F.struct("coalition", F.col("n").alias("v"), "good", "toxic"))).alias("g"))
    potential = F.aggregate(F.sequence(F.lit(1), F.lit(_SETS - 1)), F.array(F.lit(0).cast("long")), lambda p, s: F.concat(p, F.array(_grown(p, s))))
    by_set = wide.select("part", "n", F.col("g.v").alias("v"), F.col("g.good").alias("good"), F.col("g.toxic").alias("toxic"))
    return by_set.withColumn("potential", potential)


def _grown(p: Column, s: Column) -> Column:
    """|S|! P(S) from the potentials of the sets before S."""
    below = F.lit(0).cast("long")
    for i in range(len(FILTERS)):
        below = below + F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(p, s - (1 << i))).otherwise(0)
    return F.factorial(F.bit_count(s) - 1) * F.get(F.col("v"), s) + below


def audit(failed: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A step's figures are differences between the coalitions after and before it. shapley is 5! times the filter's Shapley value, that is, what it
    removes in all orders: the potential of all filters less the potential without it. Both tables of orders and of coalitions have a fixed size, so
    beyond `failed` the work grows with the number of parts only. No documents give no rows.
    """
    orders = F.explode(F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)]))
    steps = games(failed).withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = F.create_map(*[F.lit(x) for i, f in enumerate(FILTERS) for x in (f, 1 << i)])
    bit = lambda letter: F.element_at(bits, letter)
    before = F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), F.lit(0), lambda a, k: a + F.when(k < F.col("step"), bit(F.substring(F.col("filter_order"), k, F.lit(1)))).otherwise(0))
    at = steps.withColumn("before", before).withColumn("own", bit(F.substring("filter_order", F.col("step"), F.lit(1)))).withColumn("after", F.col("before") + F.col("own"))
    grown = lambda c: F.get(F.col(c), F.col("after")) - F.get(F.col(c), F.col("before"))
    rest = F.lit(_SETS - 1) - F.col("own")
    everyone = lambda c: F.get(F.col(c), F.lit(_SETS - 1))
    return at.select(
        "part", "filter_order", "step", (F.col("n") - F.get("v", F.col("after"))).alias("kept"), grown("v").alias("removed"),
        (F.get("v", F.col("own")) - grown("v")).alias("redundant"), (everyone("v") - F.get("v", rest)).alias("unique_fails"),
        grown("good").alias("good_lost"), grown("toxic").alias("toxic_lost"), (everyone("potential") - len(FILTERS) * F.get("potential", rest)).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by source."""
    return audit(failures(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")))


#: Another way: every document goes to the first filter of an order that it fails.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
  SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic FROM labels GROUP BY doc_id
), firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
fails AS (
  SELECT d.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN d.doc_id > f.least THEN 'E' ELSE '' END) AS failed
  FROM d JOIN firsts f ON d.t = f.t LEFT JOIN marks m ON m.doc_id = d.doc_id
), kinds AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
placed AS (
  SELECT k.*, s.filter_order, s.step, contains(k.failed, substr(s.filter_order, s.step, 1)) AS here, s.step > 1 AND len(list_filter(range(1, s.step), lambda j: contains(k.failed, substr(s.filter_order, j, 1)))) > 0 AS gone
  FROM kinds k, steps s
), out AS (
  SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (here AND gone), 0) AS redundant, coalesce(sum(n) FILTER (here AND length(failed) = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (here AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley
FROM out
"""
