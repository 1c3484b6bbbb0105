"""Document fingerprints by winnowing (operator 11), in SQL functions only: the least k-gram hash of every window, with its place.

A gram's hash is a Rabin fingerprint, the rolling hash over two elements, taken by Spark's CRC-32 of each gram: a fold that carries the hash from gram to gram
can't be written with array functions in linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Code points of a gram and grams of a window: any SPAN code points that two texts share are a whole window in both, so they share its minimum.
GRAM, WINDOW = 16, 32
SPAN = GRAM + WINDOW - 1
#: Windows that are formed as one array; longer texts are cut into overlapping pieces.
PIECE = 2048
#: Documents are dealt to this many ranges of ids for each shuffle partition, to have neighbours side by side.
RANGES = 4
_LOW = (1 << 32) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hash(bytes_: Column) -> Column:
    """31 bits of a gram's Rabin fingerprint: CRC-32 is the remainder of the gram, in UTF-32, as a polynomial over two elements."""
    return F.shiftright(F.crc32(bytes_), 1)


def _least(values: Column, width: int) -> Column:
    """The least of each run of `width` entries, a power of two, from runs of 1, 2, 4, ... and those behind them; runs that the end cuts are the shorter."""

    def twice(m: int) -> Callable[[Column], Column]:
        return lambda v: F.zip_with(v, F.slice(v, m + 1, F.size(v)), lambda a, b: F.least(a, b))

    m = 1
    while m < width:
        values = _let(values, twice(m))
        m *= 2
    return values


def _minima(b: Column, start: Column, n: Column) -> Column:
    """The minima of up to PIECE windows from `start` in a text of n code points, at least GRAM, given in UTF-32; a text shorter than SPAN is one window.

    A gram is hash << 32 | complement of its place, so that the least number is the rightmost of the least hashes.
    """
    last = F.least(n - GRAM, start + (PIECE + WINDOW - 2))
    grams = F.transform(F.sequence(start, last), lambda i: F.shiftleft(_hash(F.substring(b, i * 4 + 1, F.lit(4 * GRAM))), 32) + (F.lit(_LOW) - i))
    return _let(_least(grams, WINDOW), lambda v: F.slice(v, 1, F.greatest(F.size(v) - (WINDOW - 1), F.lit(1))))


def winnow(text: Column) -> Column:
    """The fingerprint of a text: for each window of WINDOW grams the least hash, the rightmost of equal ones, each place once, in order.

    Entries are hash << 32 | place, the place being the gram's first code point. Null and empty texts have none; a text shorter than a gram is one
    gram, one shorter than SPAN one window. Long texts are cut into pieces that share SPAN - 1 code points, found by their offset in UTF-32, so that
    time is linear and no array is longer than a piece, but for the text itself.
    """

    def pieces(b: Column) -> Column:
        n = (F.length(b) / 4).cast("int")
        starts = F.sequence(F.lit(0), F.greatest(n - SPAN, F.lit(0)), F.lit(PIECE))
        windows = F.array_distinct(F.flatten(F.transform(starts, lambda s: _minima(b, s, n))))
        short = F.array(F.shiftleft(_hash(b), 32) + _LOW)
        some = F.when(n == 0, F.array().cast("array<bigint>")).when(n < GRAM, short).otherwise(windows)
        return F.transform(some, lambda v: v.bitwiseXOR(F.lit(_LOW)))

    return _let(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-32"), pieces)


def hashes(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda v: F.shiftright(v, 32))


def places(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda v: v % (_LOW + 1))


def entries(fingerprint: Column) -> Column:
    """A fingerprint as structs of hash and place."""
    return F.transform(fingerprint, lambda v: F.struct(F.shiftright(v, 32).alias("hash"), (v % (_LOW + 1)).alias("place")))


def digest(fingerprint: Column) -> Column:
    """The hashes in order, eight hexadecimal digits each."""
    return F.array_join(F.transform(hashes(fingerprint), lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of common hashes, 2 |A and B| / (|A| + |B|), each hash once; 1 for two fingerprints without entries."""
    x, y = F.array_distinct(hashes(a)), F.array_distinct(hashes(b))
    both = _let(F.struct(x.alias("x"), y.alias("y")), lambda s: F.when(F.size(s["x"]) + F.size(s["y"]) == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(s["x"], s["y"])) / (F.size(s["x"]) + F.size(s["y"]))))
    return both


def _started(fingerprint: Column, windows: Column) -> Column:
    """The entries of the first so many windows. An entry's first window follows from the entry before it: where that one leaves, or where it comes in if its hash
    is no greater."""

    def first(v: Column, i: Column) -> Column:
        before = F.get(fingerprint, i - 1)
        come = v % (_LOW + 1) - (WINDOW - 1)
        return F.when(i == 0, F.lit(0).cast("long")).when(F.shiftright(v, 32) <= F.shiftright(before, 32), come).otherwise(before % (_LOW + 1) + 1)

    return F.filter(fingerprint, lambda v, i: first(v, i) < windows)


def spliced(head: Column, head_print: Column, tail: Column, tail_print: Column, cut: Column, taken: Column) -> Column:
    """The fingerprint of the first `cut` code points of one text and the first `taken` of another, equal to winnow() of that text.

    A window inside either part is a window of its text, so only those across the seam are formed anew.
    """
    before, behind = F.greatest(cut - (SPAN - 1), F.lit(0)), F.least(taken, F.lit(SPAN - 1))
    numbers = F.struct(cut.alias("cut"), taken.alias("taken"), before.alias("low"), F.concat(F.substring(head, before + 1, cut - before), F.substring(tail, F.lit(1), behind)).alias("seam"))

    def joined(s: Column) -> Column:
        whole = (F.length(s["seam"]) >= SPAN) | (s["cut"] + s["taken"] < SPAN)
        across = F.when(whole, F.transform(winnow(s["seam"]), lambda v: v + s["low"])).otherwise(F.array().cast("array<bigint>"))
        left = _started(head_print, s["cut"] - (SPAN - 1))
        right = F.transform(_started(tail_print, s["taken"] - (SPAN - 1)), lambda v: v + s["cut"])
        return F.array_distinct(F.concat(left, across, right))

    return _let(numbers, joined)


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row struct of all columns of docs, fingerprint: array of (hash, place)): every text by itself, where it is read."""
    print_ = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), winnow(F.col(f"`{text_col}`")).alias("print"))
    return print_.select("row", entries(F.col("print")).alias("fingerprint"))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, text, print, next_text, next_print): every document beside the one with the next greater doc_id, the first one behind the last.

    Null ids count as least, rows of one id go by their texts, null texts are empty; the only document follows itself. Documents are shuffled once, by
    ranges of ids that are cut at estimated quantiles; the first document of a range is sent to the range before it as well. What the driver holds is one
    number a range.
    """
    least = -(2**63)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(least))
    ranges = ranges or RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(key.alias("key"))
    cuts = sorted(set(ids.agg(F.percentile_approx("key", [k / ranges for k in range(1, ranges)] or [0.5], max(10000, 10 * ranges))).first()[0] or []))
    step = 64
    heads, all_ = F.array(*[F.lit(c) for c in cuts[::step]]).cast("array<bigint>"), F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    below = F.size(F.filter(heads, lambda c: c <= F.col("key")))
    start = F.greatest(below - 1, F.lit(0)) * step
    number = F.when(below == 0, 0).otherwise(start + F.size(F.filter(F.slice(all_, start + 1, F.lit(step)), lambda c: c <= F.col("key"))))
    spark = docs.sparkSession
    firsts = [tuple(r) for r in ids.withColumn("range", number).groupBy("range").agg(F.min("key").alias("key")).orderBy("range").collect()]
    moved = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), text.alias("text"))
    # as many rows as there are ranges
    guests = rows.join(F.broadcast(spark.createDataFrame(moved, "key long, range int")), "key").groupBy("range", "key").agg(F.min("text").alias("text"))
    mine = rows.withColumn("range", number).withColumn("guest", F.lit(False))
    dealt = mine.unionByName(guests.select(F.lit(None).cast("long").alias("doc_id"), "key", "text", "range", F.lit(True).alias("guest"))).repartition("range")
    at = Window.partitionBy("range").orderBy("guest", "key", "text")
    printed = dealt.withColumn("print", winnow(F.col("text")))
    both = printed.withColumns({"next_text": F.lead("text").over(at), "next_print": F.lead("print").over(at)})
    return both.filter("not guest").select("doc_id", "text", "print", "next_text", "next_print")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, each with its latter half replaced by the next one's beginning."""
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).withColumn("n_chars", F.length("text")).withColumn("half", half)
    cut, taken = F.col("n_chars") - F.col("half"), F.least("half", F.length("next_text"))
    edited = F.concat(F.substring("text", F.lit(1), cut), F.substring("next_text", F.lit(1), F.col("half")))
    both = rows.withColumn("edited_print", spliced(F.col("text"), F.col("print"), F.col("next_text"), F.col("next_print"), cut, taken))
    return both.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), digest(F.col("print")).alias("fingerprint"), digest(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def _terms() -> tuple[list[int], list[int]]:
    """CRC-32 is linear but for a constant that depends on the length: what each of the 21 bits of a code point adds at each place of a gram, and the constants of
    texts of up to GRAM code points. Places count from a gram's end, so these hold for shorter texts as well."""
    zero = crc32(bytes(4 * GRAM))
    adds = [crc32((1 << (bit + 32 * (GRAM - 1 - j))).to_bytes(4 * GRAM, "big")) ^ zero for j in range(GRAM) for bit in range(21)]
    return adds, [crc32(bytes(4 * n)) for n in range(GRAM + 1)]


_ADDS, _EMPTY = _terms()
_XOR = reduce(lambda a, j: f"xor({a}, lead(adds[{j + 1}], {j}) OVER w)", range(1, GRAM), "adds[1]")

#: Every gram by the bits of its code points, every window by a frame, edited texts like any other.
SQL = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS r, doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT *, length(t) AS n, coalesce(lead(t) OVER (ORDER BY r), first_value(t) OVER (ORDER BY r)) AS follower FROM d),
e AS (SELECT *, substr(t, 1, n - n // 2) || substr(follower, 1, n // 2) AS edited FROM n),
texts AS (SELECT r, 0 AS side, t AS s FROM e UNION ALL SELECT r, 1, edited FROM e),
points AS (SELECT r, side, length(s) AS n, unnest(list_transform(string_split(s, ''), lambda c: unicode(c)::BIGINT)) AS c, unnest(range(0, length(s))) AS i FROM texts WHERE s <> ''),
bits AS (SELECT c, j, bit_xor(CASE WHEN (c >> bit) & 1 = 1 THEN {_ADDS!r}[j * 21 + bit + 1] ELSE 0 END)::BIGINT AS adds FROM (SELECT DISTINCT c FROM points), range(0, {GRAM}) a(j), range(0, 21) b(bit) GROUP BY c, j),
codes AS (SELECT c, list(adds ORDER BY j) AS adds FROM bits GROUP BY c),
coded AS (SELECT p.*, adds FROM points p JOIN codes USING (c)),
long_grams AS (SELECT r, side, n, i, xor({_XOR}, {_EMPTY[GRAM]}) >> 1 AS h FROM coded WHERE n >= {GRAM} WINDOW w AS (PARTITION BY r, side ORDER BY i)),
short_grams AS (SELECT r, side, n, 0 AS i, xor(bit_xor(adds[{GRAM} - n + i + 1]), {_EMPTY!r}[n + 1]) >> 1 AS h FROM coded WHERE n < {GRAM} GROUP BY r, side, n),
grams AS (SELECT r, side, n, i, h * 4294967296 + 4294967295 - i AS v FROM long_grams WHERE i <= n - {GRAM} UNION ALL SELECT r, side, n, i, h * 4294967296 + 4294967295 FROM short_grams),
minima AS (SELECT r, side, n, i, min(v) OVER (PARTITION BY r, side ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS v FROM grams),
kept AS (SELECT DISTINCT r, side, v // 4294967296 AS h, 4294967295 - v % 4294967296 AS place FROM minima WHERE i <= greatest(n - {SPAN}, 0)),
prints AS (SELECT r, side, string_agg(lpad(lower(to_hex(h)), 8, '0'), '' ORDER BY place) AS f, list_distinct(list(h)) AS hs FROM kept GROUP BY r, side),
full_prints AS (SELECT x.r, x.side, coalesce(p.f, '') AS f, coalesce(p.hs, []) AS hs FROM texts x LEFT JOIN prints p ON p.r = x.r AND p.side = x.side),
likeness AS (
  SELECT a.r, a.f, b.f AS g, CASE WHEN len(a.hs) + len(b.hs) = 0 THEN 1.0 ELSE 2.0 * len(list_intersect(a.hs, b.hs)) / (len(a.hs) + len(b.hs)) END AS near_edited,
    CASE WHEN len(a.hs) + len(c.hs) = 0 THEN 1.0 ELSE 2.0 * len(list_intersect(a.hs, c.hs)) / (len(a.hs) + len(c.hs)) END AS near_next
  FROM full_prints a JOIN full_prints b ON a.r = b.r AND a.side = 0 AND b.side = 1 JOIN full_prints c ON c.side = 0 AND c.r = a.r % (SELECT count(*) FROM d) + 1
)
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, l.f AS fingerprint, l.g AS edited_fingerprint, l.near_edited::DOUBLE AS near_edited, l.near_next::DOUBLE AS near_next
FROM e JOIN likeness l ON e.r = l.r
"""
