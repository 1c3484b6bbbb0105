"""From colours to genes: calls, quality, codebooks and matching. Every frame is keyed by spot_id and fov."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.colours import decode_colours, decode_omics, digits, encode_bases

#: Run presets (mode, end bases, split or removed positions).
DECODE_PRESETS = {
    "seqD": ("regular", "GA", None),
    "seqF": ("regular", "AA", None),
    "seqF_real": ("regular", "AA", None),
    "seqDF": ("double", "GAAA", [6]),
    "normal": ("tri", "GGAAA", [6, 12]),
    "seqD_nc": ("single_nc", "GA", [2]),
}


def colour_vectors(sums: DataFrame) -> DataFrame:
    """Adds `vector`: the channel sums over their Euclidean norm plus 1e-6."""
    norm = F.sqrt(F.aggregate("sums", F.lit(0.0), lambda a, s: a + s.cast("double") * s)) + F.lit(1e-6)
    return sums.withColumn("vector", F.transform("sums", lambda s: s / norm))


def call_colours(sums: DataFrame, channels: int = 3) -> DataFrame:
    """Adds colour (1..channels of the only largest sum; -1 on a tie or without signal) and score (-ln of its share of the norm; infinite on a tie).

    Ties are judged on the sums, which are whole numbers, not on the shares.
    """
    s = [F.get("sums", F.lit(k)) for k in range(channels)]
    top = F.greatest(*s) if channels > 1 else s[0]
    norm = F.sqrt(sum((c.cast("double") * c for c in s), F.lit(0.0))) + F.lit(1e-6)
    single = sum(((c == top).cast("int") for c in s), F.lit(0)) == 1
    which = F.coalesce(*[F.when(c == top, k + 1) for k, c in enumerate(s)])
    return sums.select("*", F.when(single, which).otherwise(-1).alias("colour"), F.when(single, -F.log(top / norm)).otherwise(F.lit(float("inf"))).alias("score"))


def read_calls(calls: DataFrame, rounds: int = 5) -> DataFrame:
    """One row a spot: colours and scores by round 1..rounds, colorseq (null if any round has no colour), n_ties.

    One maximum a round, so calls combine before the shuffle; a round without a call is left out of the arrays.
    """
    pick = lambda c, r: F.max(F.when(F.col("round_no") == r, F.col(c)))
    rows = calls.groupBy("fov", "spot_id").agg(*[pick(c, r).alias(f"{c}{r}") for r in range(1, rounds + 1) for c in ("colour", "score")])
    colours = [F.col(f"colour{r}") for r in range(1, rounds + 1)]
    ties = sum((F.coalesce((c < 0).cast("int"), F.lit(0)) for c in colours), F.lit(0))
    every = lambda c: F.array_compact(F.array(*[F.col(f"{c}{r}") for r in range(1, rounds + 1)]))
    return rows.select("fov", "spot_id", every("colour").alias("colours"), every("score").alias("scores"), F.when(ties == 0, F.concat_ws("", *[c.cast("string") for c in colours])).alias("colorseq"), ties.alias("n_ties"))


def count_crosstalk(reads: DataFrame) -> DataFrame:
    """Per fov: spots, and spots with a tie in any round."""
    return reads.groupBy("fov").agg(F.count(F.lit(1)).alias("n_spots"), F.count_if(F.col("n_ties") > 0).alias("n_crosstalk"))


def mean_score() -> Column:
    return F.aggregate("scores", F.lit(0.0), lambda a, s: a + s) / F.size("scores")


def filter_quality(reads: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Reads whose rounds all have a colour and whose mean score is below the threshold."""
    return reads.filter(F.col("colorseq").isNotNull() & (mean_score() < threshold))


def quality_stats(reads: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per fov: spots, spots with all colours, passing reads, and their share of either."""
    good = F.col("colorseq").isNotNull() & (mean_score() < threshold)
    rows = reads.groupBy("fov").agg(F.count(F.lit(1)).alias("n_all"), F.count("colorseq").alias("n_valid"), F.count_if(good).alias("n_pass"))
    return rows.select("*", (F.col("n_pass") / F.nullif("n_all", F.lit(0))).alias("share_all"), (F.col("n_pass") / F.nullif("n_valid", F.lit(0))).alias("share_valid"))


def filter_intensity(reads: DataFrame, intensity: DataFrame, reference_round: int = 1, threshold: float = 270) -> DataFrame:
    """Reads whose box maximum in the reference round is at least the threshold. intensity: fov, spot_id, round_no, sum_max."""
    bright = intensity.filter((F.col("round_no") == reference_round) & (F.col("sum_max") >= threshold))
    return reads.join(bright.select("fov", "spot_id"), ["fov", "spot_id"], "left_semi")


def _code(sequence: Column, instrument: str, layout: str, remove: list[int] | None) -> Column:
    encoded = encode_bases(F.reverse(sequence), instrument, last_pair=layout == "segments")
    if not remove:
        return encoded
    n = F.length(encoded)
    if layout == "segments":
        # the pieces between removed positions: the second, then the first, then the rest
        cuts = [0, *sorted(remove), None]
        pieces = [F.substring(encoded, F.lit(a + 1), F.lit(b - a - 1) if b else n - a) for a, b in zip(cuts, cuts[1:])]
        pieces[0], pieces[1] = pieces[1], pieces[0]
        return F.concat(*pieces)
    front, back = F.substring(encoded, 1, remove[0] - 1), F.substring(encoded, F.lit(remove[0] + 1), n)
    return F.concat(front, back) if layout == "plain" else F.concat(back, front)


def build_codebook(book: DataFrame, instrument: str = "Olympus", layout: str = "swap", remove: list[int] | None = None) -> DataFrame:
    """(row_no, gene, barcode) from (row_no, gene, sequence): the sequence reversed and encoded, removed positions (from 1) cut out.

    layout: 'swap' puts what is behind the removed position first, 'plain' doesn't, 'segments' swaps the first two of the pieces and codes the last pair on its own. Of genes
    with one barcode the later row wins; sequences that can't be encoded are left out. Each distinct sequence is encoded once, after the shuffle.
    """
    last = [F.max("row_no").alias("row_no"), F.max_by("gene", "row_no").alias("gene")]
    # a maximum, not the key itself: filters on the code would be moved below the shuffle, and encode every row
    one = book.groupBy("sequence").agg(F.max("sequence").alias("same"), *last)
    coded = one.select("row_no", "gene", _code(F.col("same"), instrument, layout, remove).alias("barcode")).filter(F.col("barcode").isNotNull())
    return coded.groupBy("barcode").agg(*last).select("row_no", "gene", "barcode")


def build_codebook_duo(book: DataFrame, instrument: str = "Olympus") -> DataFrame:
    """(row_no, gene, barcode1, barcode2) from two sequences a gene."""
    code = lambda c: encode_bases(F.reverse(c), instrument)
    return book.select("row_no", "gene", code(F.col("sequence1")).alias("barcode1"), code(F.col("sequence2")).alias("barcode2"))


def unencodable(book: DataFrame, instrument: str = "Olympus") -> DataFrame:
    """Genes whose sequence has a pair without a colour."""
    return book.filter(encode_bases(F.reverse("sequence"), instrument).isNull()).select("row_no", "gene", "sequence")


def check_ends(reads: DataFrame, mode: str, ends: str, instrument: str = "Olympus") -> DataFrame:
    """Adds front_ok, back_ok, omics_ok and ends_ok: do the walks begin and end with the preset's bases?

    The part that a mode doesn't look at counts as fine. The check is a statistic; it filters nothing. Each distinct colour string is decoded once.
    """
    distinct = reads.select("colorseq").distinct()
    c = digits(F.col("colorseq"))
    true = F.lit(True)

    def walk(first: int, length: int | None, a: str, b: str) -> Column:
        part = c if length is None else F.slice(c, first, length)
        bases = decode_colours(part, a, instrument)
        return F.coalesce((F.left(bases, F.lit(1)) == a) & (F.right(bases, F.lit(1)) == b), F.lit(False))

    back, omics = true, true
    if mode == "nc" or mode == "single_nc":
        front = true
    elif mode == "regular":
        front = walk(1, None, ends[0], ends[1])
    elif mode == "double":
        front, back = walk(1, 5, ends[0], ends[2]), walk(6, 5, ends[1], ends[3])
    elif mode == "duo":
        front = walk(1, 5, ends[0], ends[2])
    elif mode in ("tri", "tri_noend", "tri_221"):
        size = 2 if mode == "tri_221" else 5
        front = walk(1, size, ends[1], ends[3])
        if mode != "tri_noend":
            back = walk(size + 1, size, ends[2], ends[4])
        last = F.get(c, F.lit(2 * size) if mode != "tri_noend" else F.lit(9))
        omics = F.coalesce(F.left(decode_omics(last, instrument), F.lit(1)) == ends[0], F.lit(False))
    else:
        raise ValueError(f"unknown mode {mode}")
    checked = distinct.select("colorseq", front.alias("front_ok"), back.alias("back_ok"), omics.alias("omics_ok")).withColumn("ends_ok", F.col("front_ok") & F.col("back_ok") & F.col("omics_ok"))
    return reads.join(checked, reads["colorseq"].eqNullSafe(checked["colorseq"])).select(reads["*"], "front_ok", "back_ok", "omics_ok", "ends_ok")


def string_counts(reads: DataFrame) -> DataFrame:
    """(fov, colorseq, n): how many reads have each colour string, for statistics that look at strings only."""
    return reads.groupBy("fov", "colorseq").agg(F.count(F.lit(1)).alias("n"))


def match_codebook(reads: DataFrame, book: DataFrame) -> DataFrame:
    """Reads whose colours are in the codebook, with the gene. The adaptive plan broadcasts the codebook if it is small."""
    return reads.join(book.select(F.col("barcode").alias("colorseq"), "gene"), "colorseq")


def filter_stats(checked: DataFrame, book: DataFrame) -> DataFrame:
    """Per fov: reads, reads with the right ends, reads in the codebook, and the five shares; null without a denominator. Rows with an n count n times."""
    known = book.select(F.col("barcode").alias("colorseq"), F.lit(True).alias("known"))
    n = F.col("n") if "n" in checked.columns else F.lit(1)
    count = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0)).cast("long")
    inside = F.col("known").isNotNull()
    rows = checked.join(known, "colorseq", "left").groupBy("fov").agg(
        F.sum(n).cast("long").alias("n_all"), count(F.col("ends_ok")).alias("n_form"), count(inside).alias("n_book"), count(inside & F.col("ends_ok")).alias("n_both"), count(F.col("front_ok")).alias("n_front"), count(F.col("back_ok")).alias("n_back")
    )
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return rows.select("*", share("n_form", "n_all").alias("form_all"), share("n_book", "n_all").alias("book_all"), share("n_both", "n_form").alias("book_form"), share("n_front", "n_all").alias("front_all"), share("n_back", "n_all").alias("back_all"))


def correct_hamming1(reads: DataFrame, book: DataFrame, colours: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Reads outside the codebook with exactly one barcode at one changed colour: adds barcode and gene.

    The codebook's barcodes are sent to their one-change neighbours, so a read is met once, by its own string; nothing is compared pair by pair.
    """
    known = book.select(F.col("barcode").alias("colorseq"))
    n = F.length("barcode")
    swap = lambda i: F.array(*[F.concat(F.substring(F.col("barcode"), F.lit(1), i - 1), F.lit(str(c)), F.substring(F.col("barcode"), i + 1, n)) for c in colours])
    near = book.select("barcode", "gene", F.explode(F.array_except(F.flatten(F.transform(F.sequence(F.lit(1), n), swap)), F.array("barcode"))).alias("colorseq"))
    single = near.groupBy("colorseq").agg(F.count(F.lit(1)).alias("n"), F.first("barcode").alias("barcode"), F.first("gene").alias("gene")).filter("n = 1").join(known, "colorseq", "left_anti")
    return reads.join(single, "colorseq").select("fov", "spot_id", "barcode", "gene")


def gene_counts(good: DataFrame, book: DataFrame) -> DataFrame:
    """(gene, barcode, n) for every gene of the codebook, zero without reads."""
    n = good.groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
    return book.join(n, "gene", "left").select("gene", "barcode", F.coalesce("n", F.lit(0)).alias("n"))


def to_tile_coords(spots: DataFrame, grid: DataFrame) -> DataFrame:
    """Spots of subtiles in the coordinates of the whole tile."""
    return spots.join(grid.select("t", "scoords_x", "scoords_y"), "t").withColumns({"x": F.col("x") + F.col("scoords_x") - 1, "y": F.col("y") + F.col("scoords_y") - 1}).drop("scoords_x", "scoords_y")


def good_points(good: DataFrame, spots: DataFrame) -> DataFrame:
    """The table of decoded points: x, y, z, intensity, channel, gene."""
    return spots.join(good.select("fov", "spot_id", "gene"), ["fov", "spot_id"]).select("fov", "x", "y", "z", "intensity", "channel", "gene")


def decode(reads: DataFrame, book: DataFrame, preset: str, instrument: str = "Olympus") -> tuple[DataFrame, DataFrame]:
    """(reads in the codebook with their gene, filter statistics) by one of DECODE_PRESETS: it names the end check and the positions that the codebook leaves out.

    reads: fov, spot_id, colorseq of as many rounds as the preset's codes have; book: row_no, gene, sequence.
    """
    mode, ends, cut = DECODE_PRESETS[preset]
    coded = build_codebook(book, instrument, "segments" if mode == "tri" else "plain" if mode == "single_nc" else "swap", cut)
    good = reads.filter("colorseq is not null")
    return match_codebook(good, coded), filter_stats(check_ends(string_counts(good), mode, ends, instrument), coded)
