"""Queries over colour calls and codebooks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.colours import PAIR_COLOURS, clean_gene, decode_colours, decode_omics, digits, encode_bases
from tessella.operators import decode as d
from tessella.plans.catalog import query


def _sums(c: DataFrame) -> DataFrame:
    return c.select("fov", "spot_id", "round_no", F.array("c1", "c2", "c3").alias("sums"))


def _reads(c: DataFrame) -> DataFrame:
    return d.read_calls(d.call_colours(_sums(c)))


_CALLS = """calls AS (
  SELECT fov, spot_id, round_no, CASE WHEN ties = 1 THEN CASE top WHEN c1 THEN 1 WHEN c2 THEN 2 ELSE 3 END ELSE -1 END AS colour,
    CASE WHEN ties = 1 THEN -ln(top / (sqrt(c1 * c1 + c2 * c2 + c3 * c3) + 1e-6)) ELSE 'Infinity'::DOUBLE END AS score
  FROM (SELECT *, greatest(c1, c2, c3) AS top, (c1 = greatest(c1, c2, c3))::INT + (c2 = greatest(c1, c2, c3))::INT + (c3 = greatest(c1, c2, c3))::INT AS ties FROM colour_sums)
)"""
_READS = f"""{_CALLS}, called AS (
  SELECT fov, spot_id, count(*) FILTER (colour < 0) AS n_ties, CASE WHEN min(colour) > 0 THEN string_agg(colour::VARCHAR, '' ORDER BY round_no) END AS colorseq, avg(score) AS mean_score
  FROM calls GROUP BY fov, spot_id
)"""
_PAIR = "CASE {p} WHEN 'AA' THEN '1' WHEN 'TT' THEN '1' WHEN 'GG' THEN '1' WHEN 'AG' THEN '2' WHEN 'TA' THEN '2' WHEN 'GT' THEN '2' WHEN 'AT' THEN '3' WHEN 'TG' THEN '3' WHEN 'GA' THEN '3' END"
_CODE = " || ".join(_PAIR.format(p=f"substr(reverse(sequence), {i}, 2)") for i in range(1, 6))
_BOOK = f"""coded AS (SELECT row_no, gene, {_CODE} AS code FROM codebook), book AS (
  SELECT row_no, gene, code AS barcode FROM coded WHERE code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY row_no DESC) = 1
)"""
_STEP = {(a, c): b for pair, c in PAIR_COLOURS["Olympus"].items() for a, b in [pair]}


@query("colour_sums", sql=f"WITH {_CALLS} SELECT fov, spot_id, round_no, colour, round(CASE WHEN isinf(score) THEN -1 ELSE score END, 6) AS score FROM calls")
def colour_calls(c):
    """R3, R4."""
    score = F.when(F.col("score") == float("inf"), -1.0).otherwise(F.col("score"))
    called = d.call_colours(_sums(c))
    return called.select("fov", "spot_id", "round_no", "colour", F.round(score, 6).alias("score"))


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, colorseq, n_ties FROM called")
def read_strings(c):
    """R4, R8."""
    return _reads(c).select("fov", "spot_id", "colorseq", F.col("n_ties").cast("long").alias("n_ties"))


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, count(*) AS n_spots, count(*) FILTER (n_ties > 0) AS n_crosstalk FROM called GROUP BY fov")
def crosstalk(c):
    """R5."""
    return d.count_crosstalk(_reads(c))


@query("colour_sums", sql=f"""WITH {_READS} SELECT fov, count(*) AS n_all, count(colorseq) AS n_valid, count(*) FILTER (colorseq IS NOT NULL AND mean_score < 0.5) AS n_pass,
  round(count(*) FILTER (colorseq IS NOT NULL AND mean_score < 0.5) / nullif(count(*), 0), 9) AS share_all, round(count(*) FILTER (colorseq IS NOT NULL AND mean_score < 0.5) / nullif(count(colorseq), 0), 9) AS share_valid
  FROM called GROUP BY fov""")
def quality_stats(c):
    """R6."""
    return d.quality_stats(_reads(c)).select("fov", "n_all", "n_valid", "n_pass", F.round("share_all", 9).alias("share_all"), F.round("share_valid", 9).alias("share_valid"))


@query("colour_sums", sql=f"WITH {_READS} SELECT r.fov, r.spot_id, r.colorseq FROM called r JOIN colour_sums s ON r.spot_id = s.spot_id AND r.fov = s.fov AND s.round_no = 1 WHERE r.colorseq IS NOT NULL AND r.mean_score < 0.5 AND greatest(s.c1, s.c2, s.c3) >= 60")
def bright_reads(c):
    """R6, R7."""
    top = c.select("fov", "spot_id", "round_no", F.greatest("c1", "c2", "c3").alias("sum_max"))
    return d.filter_intensity(d.filter_quality(_reads(c)), top, 1, 60).select("fov", "spot_id", "colorseq")


@query("colour_sums", sql="SELECT fov, spot_id, round_no, round(c1 / n, 9) AS v1, round(c2 / n, 9) AS v2, round(c3 / n, 9) AS v3 FROM (SELECT *, sqrt((c1 * c1 + c2 * c2 + c3 * c3)::DOUBLE) + 0.000001::DOUBLE AS n FROM colour_sums)")
def colour_vectors(c):
    """R3."""
    v = d.colour_vectors(c.select("fov", "spot_id", "round_no", F.array("c1", "c2", "c3").alias("sums")))
    return v.select("fov", "spot_id", "round_no", *[F.round(F.get("vector", F.lit(k)), 9).alias(f"v{k + 1}") for k in range(3)])


_LEICA = "string_agg(coalesce(CASE substr(sequence, i, 2) " + " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in PAIR_COLOURS["Leica_rj"].items()) + " END, '-'), '' ORDER BY i)"


@query("codebook", sql=f"SELECT row_no, nullif(CASE WHEN contains({_LEICA}, '-') THEN '' ELSE {_LEICA} END, '') AS code FROM (SELECT row_no, sequence, unnest(range(1, length(sequence)))::INT AS i FROM codebook) GROUP BY row_no")
def leica_codes(b):
    """R9 by the other instrument's colours."""
    return b.select("row_no", encode_bases(F.col("sequence"), "Leica_rj").alias("code"))


@query("codebook", sql=f"WITH {_BOOK} SELECT row_no, gene, barcode FROM book")
def codebook_plain(b):
    """R9, R13."""
    return d.build_codebook(b, "Olympus", "swap")


@query("codebook", sql=f"""WITH coded AS (SELECT row_no, gene, {_CODE} AS code FROM codebook), cut AS (SELECT row_no, gene, substr(code, 4) || substr(code, 1, 2) AS barcode FROM coded WHERE code IS NOT NULL)
  SELECT max(row_no) AS row_no, arg_max(gene, row_no) AS gene, barcode FROM cut GROUP BY barcode""")
def codebook_swapped(b):
    """R11."""
    return d.build_codebook(b, "Olympus", "swap", [3])


@query("codebook", sql=f"""WITH coded AS (SELECT row_no, gene, {_CODE} AS code FROM codebook), cut AS (SELECT row_no, gene, substr(code, 1, 2) || substr(code, 4) AS barcode FROM coded WHERE code IS NOT NULL)
  SELECT max(row_no) AS row_no, arg_max(gene, row_no) AS gene, barcode FROM cut GROUP BY barcode""")
def codebook_cut(b):
    """R13."""
    return d.build_codebook(b, "Olympus", "plain", [3])


_CODE_TRI = " || ".join(_PAIR.format(p=f"substr(s, {i}, 2)") for i in range(1, 6)) + " || CASE substr(s, 6, 2) WHEN 'GC' THEN '1' WHEN 'GT' THEN '2' END"


@query("codebook", sql=f"""WITH ends AS (SELECT row_no, gene, reverse(sequence[2:]) || 'G' || CASE row_no % 2 WHEN 0 THEN 'C' ELSE 'T' END AS s FROM codebook), coded AS (SELECT row_no, gene, {_CODE_TRI} AS code FROM ends),
  cut AS (SELECT row_no, gene, substr(code, 3, 1) || substr(code, 1, 1) || substr(code, 5) AS barcode FROM coded WHERE code IS NOT NULL) SELECT max(row_no) AS row_no, arg_max(gene, row_no) AS gene, barcode FROM cut GROUP BY barcode""")
def codebook_segments(b):
    """R10, R12."""
    tail = F.when(F.col("row_no") % 2 == 0, "C").otherwise("T")
    return d.build_codebook(b.withColumn("sequence", F.concat(tail, F.lit("G"), F.expr("substring(sequence, 2)"))), "Olympus", "segments", [2, 4])


@query("codebook", sql=f"WITH coded AS (SELECT row_no, gene, {_CODE} AS barcode1, {_CODE.replace('reverse(sequence)', 'sequence')} AS barcode2 FROM codebook) SELECT * FROM coded")
def codebook_duo(b):
    """R14."""
    return d.build_codebook_duo(b.select("row_no", "gene", F.col("sequence").alias("sequence1"), F.reverse("sequence").alias("sequence2")))


def _walk(n: int, start: str) -> str:
    """SQL of the base walk over the first n digits of colorseq."""
    cases = " ".join(f"WHEN '{a}{c}' THEN '{b}'" for (a, c), b in _STEP.items())
    return f"list_reduce(list_prepend('{start}', string_split(substr(colorseq, 1, {n}), '')), lambda a, c: (CASE a || c {cases} END))"


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, colorseq, {_walk(5, 'G')} = 'A' AS ends_ok FROM called WHERE colorseq IS NOT NULL")
def end_check(c):
    """R15, R17."""
    return d.check_ends(_reads(c).filter("colorseq is not null"), "regular", "GA").select("fov", "spot_id", "colorseq", "ends_ok")


@query("colour_sums", sql=f"WITH {_READS}, two AS (SELECT fov, spot_id, colorseq || reverse(colorseq) AS both, colorseq FROM called WHERE colorseq IS NOT NULL) SELECT fov, spot_id, {_walk(5, 'G')} = 'A' AS front_ok, {_walk(5, 'A').replace('substr(colorseq', 'substr(reverse(colorseq)')} = 'A' AS back_ok FROM two")
def end_check_double(c):
    """R18."""
    r = _reads(c).filter("colorseq is not null").withColumn("colorseq", F.concat("colorseq", F.reverse("colorseq")))
    return d.check_ends(r, "double", "GAAA").select("fov", "spot_id", "front_ok", "back_ok")


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, {_walk(5, 'G')} = 'A' AS front_ok, {_walk(5, 'A').replace('substr(colorseq', 'substr(reverse(colorseq)')} = 'A' AS back_ok, true AS omics_ok FROM called WHERE colorseq IS NOT NULL")
def end_check_tri(c):
    """R16, R19."""
    r = _reads(c).filter("colorseq is not null").withColumn("colorseq", F.concat("colorseq", F.reverse("colorseq"), F.left("colorseq", F.lit(1))))
    return d.check_ends(r, "tri", "GGAAA").select("fov", "spot_id", "front_ok", "back_ok", "omics_ok")


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, {_walk(2, 'G')} = 'A' AS front_ok, {_walk(2, 'A').replace('substr(colorseq', 'substr(substr(colorseq, 3)')} = 'A' AS back_ok FROM called WHERE colorseq IS NOT NULL")
def end_check_short(c):
    """R21."""
    return d.check_ends(_reads(c).filter("colorseq is not null"), "tri_221", "GGAAA").select("fov", "spot_id", "front_ok", "back_ok")


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, {_walk(5, 'G')} = 'A' AS front_ok, true AS back_ok FROM called WHERE colorseq IS NOT NULL")
def end_check_duo(c):
    """R20."""
    return d.check_ends(_reads(c).filter("colorseq is not null"), "duo", "GGAA").select("fov", "spot_id", "front_ok", "back_ok")


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, {_walk(5, 'G')} = 'A' AS front_ok, true AS back_ok, substr(colorseq, 5, 1) IN ('1', '2', '3') AS omics_ok, {_walk(5, 'G')} = 'A' AS ends_ok FROM called WHERE colorseq IS NOT NULL")
def end_check_noend(c):
    """Three parts without the back one; the tenth colour is the omics one."""
    r = _reads(c).filter("colorseq is not null").withColumn("colorseq", F.concat("colorseq", "colorseq"))
    return d.check_ends(r, "tri_noend", "GGAAA").select("fov", "spot_id", "front_ok", "back_ok", "omics_ok", "ends_ok")


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, colorseq, true AS ends_ok FROM called")
def end_check_nc(c):
    """No ends to check, so every read passes, one without a string too."""
    checked = [d.check_ends(_reads(c), mode, "GA") for mode in ("nc", "single_nc")]
    return checked[0].join(checked[1].select("fov", "spot_id", F.col("ends_ok").alias("same")), ["fov", "spot_id"]).select("fov", "spot_id", "colorseq", (F.col("ends_ok") & F.col("same")).alias("ends_ok"))


@query("colour_sums", sql=f"WITH {_READS} SELECT fov, spot_id, 'G' || " + " || ".join(_walk(i, "G") for i in range(1, 6)) + " AS bases, 'G' || CASE substr(colorseq, 1, 1) WHEN '1' THEN 'C' WHEN '2' THEN 'T' ELSE 'N' END AS omics FROM called WHERE colorseq IS NOT NULL")
def decoded_bases(c):
    """R15, R16."""
    r = _reads(c).filter("colorseq is not null")
    return r.select("fov", "spot_id", decode_colours(digits(F.col("colorseq")), "G", "Olympus").alias("bases"), decode_omics(F.get(digits(F.col("colorseq")), F.lit(0)), "Olympus").alias("omics"))


@query("colour_sums", "codebook", sql=f"WITH {_READS}, {_BOOK} SELECT fov, spot_id, colorseq, gene FROM called JOIN book ON colorseq = barcode")
def matched_reads(c, b):
    """R23."""
    return d.match_codebook(_reads(c), d.build_codebook(b)).select("fov", "spot_id", "colorseq", "gene")


_RATE = lambda a, b, n: f"round(count(*) FILTER ({a}) / nullif(count(*) FILTER ({b}), 0), 9) AS {n}"
_STATS = f"count(*) AS n_all, count(*) FILTER (ok) AS n_form, count(*) FILTER (known) AS n_book, count(*) FILTER (ok AND known) AS n_both, count(*) FILTER (front) AS n_front, count(*) FILTER (back) AS n_back, {_RATE('ok', 'true', 'form_all')}, {_RATE('known', 'true', 'book_all')}, {_RATE('ok AND known', 'ok', 'book_form')}, {_RATE('front', 'true', 'front_all')}, {_RATE('back', 'true', 'back_all')}"
_SHARES = ("form_all", "book_all", "book_form", "front_all", "back_all")


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({x: F.round(x, 9) for x in _SHARES})


@query("colour_sums", "codebook", sql=f"WITH {_READS}, {_BOOK}, checked AS (SELECT fov, {_walk(5, 'G')} = 'A' AS ok, ok AS front, true AS back, barcode IS NOT NULL AS known FROM called LEFT JOIN book ON colorseq = barcode WHERE colorseq IS NOT NULL) SELECT fov, {_STATS} FROM checked GROUP BY fov")
def filter_stats(c, b):
    """R24."""
    counts = d.string_counts(_reads(c).filter("colorseq is not null"))
    return _rounded(d.filter_stats(d.check_ends(counts, "regular", "GA"), d.build_codebook(b)))


# what a read and a barcode are under each preset: the plain five colours, twice, twice and one more, or without the second
_ONE_GA, _ONE_AA = f"{_walk(5, 'G')} = 'A'", f"{_walk(5, 'A')} = 'A'"
_PRESETS = {
    "seqD": ("colorseq", "code", _ONE_GA, "true"),
    "seqF": ("colorseq", "code", _ONE_AA, "true"),
    "seqF_real": ("colorseq", "code", _ONE_AA, "true"),
    "seqDF": ("colorseq || colorseq", "code || code", _ONE_GA, _ONE_AA),
    "normal": ("colorseq || colorseq || substr(colorseq, 1, 1)", "code || code || (row_no % 2 + 1)::VARCHAR", _ONE_GA, _ONE_AA),
    "seqD_nc": ("substr(colorseq, 1, 1) || substr(colorseq, 3)", "substr(code, 1, 1) || substr(code, 3)", "true", "true"),
}
_BY_PRESET = " UNION ALL ".join(
    f"SELECT '{name}' AS preset, fov, {_STATS} FROM (SELECT fov, coalesce({front}, false) AS front, coalesce({back}, false) AS back, front AND back AS ok, {read} IN (SELECT {code} FROM coded WHERE code IS NOT NULL) AS known FROM called WHERE colorseq IS NOT NULL) GROUP BY fov"
    for name, (read, code, front, back) in _PRESETS.items()
)


def _preset_inputs(reads: DataFrame, book: DataFrame, preset: str) -> tuple[DataFrame, DataFrame]:
    """Reads and sequences as long as the preset's codes, made of the five-colour ones."""
    one, seq = F.col("colorseq"), F.col("sequence")
    tail = F.when(F.col("row_no") % 2 == 0, "C").otherwise("T")
    made = {"seqDF": (F.concat(one, one), F.concat(seq, seq)), "normal": (F.concat(one, one, F.left(one, F.lit(1))), F.concat(tail, F.lit("G"), seq, seq)), "seqD_nc": (F.concat(F.left(one, F.lit(1)), F.substring(one, 3, 9)), seq)}
    read, sequence = made.get(preset, (one, seq))
    return reads.withColumn("colorseq", read), book.withColumn("sequence", sequence)


@query("colour_sums", "codebook", sql=f"WITH {_READS}, coded AS (SELECT row_no, gene, {_CODE} AS code FROM codebook) {_BY_PRESET}")
def preset_stats(c, b):
    """All presets, each by its own end check and codebook layout."""
    out = None
    reads = _reads(c)
    for preset in d.DECODE_PRESETS:
        _, stats = d.decode(*_preset_inputs(reads, b, preset), preset)
        rows = _rounded(stats).select(F.lit(preset).alias("preset"), *stats.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


_SWAPS = " UNION ALL ".join(f"SELECT fov, spot_id, substr(colorseq, 1, {i - 1}) || '{k}' || substr(colorseq, {i + 1}) AS barcode FROM lost WHERE substr(colorseq, {i}, 1) <> '{k}'" for i in range(1, 6) for k in (1, 2, 3))


@query("colour_sums", "codebook", sql=f"""WITH {_READS}, {_BOOK}, lost AS (SELECT * FROM called WHERE colorseq IS NOT NULL AND colorseq NOT IN (SELECT barcode FROM book)), tried AS ({_SWAPS})
  SELECT fov, spot_id, min(barcode) AS barcode, min(gene) AS gene FROM tried JOIN book USING (barcode) GROUP BY fov, spot_id HAVING count(*) = 1""")
def corrected_reads(c, b):
    """R25."""
    return d.correct_hamming1(_reads(c), d.build_codebook(b))


@query("colour_sums", "codebook", sql=f"WITH {_READS}, {_BOOK} SELECT gene, barcode, count(spot_id) AS n FROM book LEFT JOIN called ON colorseq = barcode GROUP BY gene, barcode")
def gene_counts(c, b):
    """The flagship query, from colour sums to reads of each gene."""
    book = d.build_codebook(b)
    return d.gene_counts(d.match_codebook(_reads(c), book), book)


@query("colour_sums", "codebook", "spots", sql=f"WITH {_READS}, {_BOOK} SELECT s.fov, s.x, s.y, s.z, s.intensity, s.channel, gene FROM called JOIN book ON colorseq = barcode JOIN spots s ON s.spot_id = called.spot_id AND s.fov = called.fov WHERE mean_score < 0.5")
def good_points(c, b, s):
    """R6, R23, S13."""
    return d.good_points(d.match_codebook(d.filter_quality(_reads(c)), d.build_codebook(b)), s)


@query("reads", sql="SELECT read_id, gene_name, regexp_replace(gene_name, '(_rbRNA|_ntRNA)$', '') AS gene, regexp_replace(gene_name, '(_rbRNA|_ntRNA)$', '') || '_' || z AS anywhere FROM reads")
def clean_genes(r):
    """C7, at the end of a name and anywhere in it."""
    anywhere = clean_gene(F.concat("gene_name", F.lit("_"), F.col("z").cast("string")), anchored=False)
    return r.select("read_id", "gene_name", clean_gene(F.col("gene_name")).alias("gene"), anywhere.alias("anywhere"))
