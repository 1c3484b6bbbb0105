"""Run logs: one row a log file (submit, task_id, text) to records and matrices."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.cells import numbered
from tessella.operators.tiles import natural_key

# The phrases of the logs.
FOLDER = "文件夹名称"
PERCENT = " percent of "
BELOW = "reads are below score thresh "
OF_VALID = "of all valid spots"
ABOVE = "reads have intensity above "
SEQ_D = "reads match seqD barcode pattern"
SEQ_F = "reads match seqF barcode pattern"
SEQ_END = "good reads match barcode pattern"
IN_BOOK = "good reads are in codebook"
MAX_COLOUR = "Geting max color..."
METHOD, REFERENCE, THRESHOLD, FOUND = "Method:", "Reference round:", "Intensity threshold:", "Number of spots found by "
STACK, RAW_CELLS, RAW_AREA, LEFT_AREA, AREA_SHARE, LEFT_CELLS = "Loading 3D DAPI stack:", "Raw detected cells:", "Overall area of raw dapi:", "Overall area of filtered dapi:", "Area reduction ratio:", "Filtered detected cells:"
FINISHED, SHIFTED = " finished", "Shifted by"

NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"


def _lines(logs: DataFrame) -> DataFrame:
    """Adds `lines`: the lines that aren't blank, trimmed."""
    blank = lambda text, c: F.replace(text, F.lit(c), F.lit(" "))
    return logs.withColumn("lines", F.filter(F.transform(F.split(blank(blank(F.col("text"), "\r"), "\t"), "\n"), lambda x: F.trim(x)), lambda x: x != ""))


def _holds(*phrases: str) -> Callable[[Column], Column]:
    return lambda line: reduce(lambda a, b: a & b, [F.contains(line, F.lit(p)) for p in phrases])


def _named(logs: DataFrame, kinds: dict[str, Callable[[Column], Column]], gates: list[str]) -> DataFrame:
    """Adds `lines`, and `named`: (kind, line) of the lines that have a kind, the first whose condition holds. Only lines with one of the gates' phrases can have one."""

    def kind(line: Column) -> Column:
        return F.coalesce(*[F.when(fits(line), F.lit(k)) for k, fits in kinds.items()])

    some = F.filter("lines", lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(g)) for g in gates]))
    return _lines(logs).withColumn("named", F.transform(some, lambda x: F.struct(kind(x).alias("kind"), x.alias("line"))))


def _with_position(rows: DataFrame, fov: Column, *columns: Column) -> DataFrame:
    """submit, fov and the columns of the logs that name a position. A row is made once and then dropped: a filter behind would be taken to the scan, and everything
    it needs would be computed twice."""
    one = F.struct(F.col("submit"), fov.alias("fov"), *columns)
    return rows.select(F.inline(F.filter(F.array(one), lambda r: r["fov"] != "")))


def _line(kind: str) -> Column:
    """The first line of a kind; null without one."""
    return F.get(F.filter("named", lambda m: m["kind"] == kind), F.lit(0))["line"]


def _behind(line: Column, phrase: str) -> Column:
    """What stands behind the phrase, trimmed."""
    return F.trim(F.substring_index(line, phrase, -1))


def _numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))


def _whole(text: Column, k: int = 0) -> Column:
    """The k-th number of a text as a whole number; commas go, and nothing is 0."""
    return F.coalesce(F.get(_numbers(F.replace(text, F.lit(","), F.lit(""))), F.lit(k)).try_cast("bigint"), F.lit(0).cast("bigint"))


def _double(text: Column) -> Column:
    """The first word of a text as a number; nothing is 0."""
    return F.coalesce(F.regexp_extract(text, r"^\S*[0-9]", 0).try_cast("double"), F.lit(0.0))


def _share(line: Column) -> dict[str, Column]:
    """share, part and whole of a line 'share [part / whole] percent of ...'; nothing is 0."""
    head = F.substring_index(line, PERCENT, 1)
    inside = F.substring_index(F.substring_index(head, "[", -1), "]", 1)
    number = lambda text, t: F.coalesce(F.trim(text).try_cast(t), F.lit(0).cast(t))
    before = F.substring_index(F.trim(F.substring_index(head, "[", 1)), " ", -1)
    return {"share": number(before, "double"), "part": number(F.substring_index(inside, "/", 1), "bigint"), "whole": number(F.substring_index(inside, "/", -1), "bigint")}


def _folder() -> Column:
    """The name behind the colon, of either width, of the line that names the folder; '' without one."""
    return F.coalesce(F.regexp_extract(_line("folder"), r"[:：]\s*(\S+)", 1), F.lit(""))


def _position(name: Column) -> Column:
    return F.coalesce(F.regexp_extract(name, r"^Position[0-9]+", 0), F.lit(""))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) != 0, F.col(a) / F.col(b)).otherwise(0.0)


def parse_decoding(logs: DataFrame) -> DataFrame:
    """One record a decoding log, ratios included (0 without a denominator); a log without a position gives none."""
    shares = {"valid": (BELOW, OF_VALID), "below": (BELOW,), "above": (ABOVE,), "d": (SEQ_D,), "f": (SEQ_F,), "end": (SEQ_END,), "book": (IN_BOOK,)}
    kinds = {k: _holds(*v) for k, v in shares.items()} | {"folder": _holds(FOLDER)}
    place = F.array_position("lines", MAX_COLOUR)
    crosstalk = F.when(place > 0, F.get("lines", place.cast("int")))
    r = _with_position(_named(logs, kinds, [PERCENT, FOLDER]), _position(_folder()), F.when(crosstalk.rlike("^[0-9]+$"), crosstalk).alias("x"), *[_line(k).alias(k) for k in shares])
    of = {k: _share(F.col(k)) for k in shares}
    r = r.select(
        "submit", "fov", of["below"]["whole"].alias("spots"), F.coalesce(F.col("x").try_cast("bigint"), F.lit(0).cast("bigint")).alias("crosstalk"), of["below"]["part"].alias("qc"), of["valid"]["part"].alias("valid_qc"), of["valid"]["whole"].alias("valid_spots"),
        of["above"]["part"].alias("intensity_qc"), of["above"]["share"].alias("intensity_ratio"), of["d"]["part"].alias("seqd"), of["f"]["part"].alias("seqf"), of["d"]["share"].alias("seqd_share"), of["f"]["share"].alias("seqf_share"),
        of["end"]["part"].alias("seq_end"), of["book"]["part"].alias("strict"),
    )
    return r.select(
        "*", _ratio("crosstalk", "spots").alias("crosstalk_ratio"), _ratio("qc", "spots").alias("qc_ratio"), _ratio("valid_qc", "valid_spots").alias("valid_qc_ratio"),
        _ratio("seq_end", "valid_spots").alias("seq_end_ratio"), _ratio("strict", "valid_spots").alias("strict_ratio"), _ratio("strict", "seq_end").alias("strict_vs_end"),
    )


def parse_spot_finding(logs: DataFrame) -> DataFrame:
    phrases = {"folder": FOLDER, "method": METHOD, "reference": REFERENCE, "threshold": THRESHOLD, "found": FOUND}
    r = _with_position(_named(logs, {k: _holds(p) for k, p in phrases.items()}, list(phrases.values())), _folder(), *[_line(k).alias(k) for k in phrases if k != "folder"])
    method = F.coalesce(F.regexp_extract(_behind(F.col("method"), METHOD), r"^\S+", 0), F.lit(""))
    return r.select("submit", "fov", method.alias("method"), _whole(_behind(F.col("reference"), REFERENCE)).alias("reference_round"), _double(_behind(F.col("threshold"), THRESHOLD)).alias("threshold"), _whole(_behind(F.col("found"), ":")).alias("spots"))


def parse_segmentation(logs: DataFrame) -> DataFrame:
    phrases = {"stack": STACK, "raw_cells": RAW_CELLS, "raw_area": RAW_AREA, "left_area": LEFT_AREA, "share": AREA_SHARE, "left": LEFT_CELLS}
    folders = F.filter(F.split(_behind(_line("stack"), STACK), "/"), lambda p: p.rlike("^Position[0-9]+$"))
    fov = F.coalesce(F.element_at(F.nullif(folders, F.array().cast("array<string>")), -1), F.lit(""))
    r = _with_position(_named(logs, {k: _holds(p) for k, p in phrases.items()}, list(phrases.values())), fov, *[_behind(_line(k), p).alias(k) for k, p in phrases.items() if k != "stack"])
    return r.select(
        "submit", "fov", _whole(F.col("raw_cells")).alias("raw_cells"), _whole(F.col("raw_area")).alias("raw_area"), _whole(F.col("left_area")).alias("filtered_area"),
        _double(F.col("share")).alias("reduction"), _whole(F.col("left")).alias("cells"), _whole(F.col("left"), 1).alias("removed"),
    )


def parse_shifts(logs: DataFrame) -> DataFrame:
    """One record for each round that a registration log reports: a line with the rounds and the time, and the next line with the shift."""
    lined = _with_position(_named(logs, {"folder": _holds(FOLDER)}, [FOLDER]), _position(_folder()), F.col("lines"))
    pairs = lined.select("submit", "fov", F.explode(F.arrays_zip(F.col("lines").alias("line"), F.expr("slice(lines, 2, size(lines))").alias("next"))).alias("p"))
    mine = pairs.filter(F.startswith("p.line", F.lit("Round")) & F.contains("p.line", F.lit(FINISHED)) & F.startswith("p.next", F.lit(SHIFTED)))
    r = mine.select("submit", "fov", _numbers(F.col("p.line")).alias("a"), _numbers(F.col("p.next")).alias("b")).filter("size(a) = 3 and size(b) = 3")
    whole = lambda k, n: F.get("b", F.lit(k)).cast("int").alias(n)
    return r.select("submit", "fov", natural_key(F.col("fov")).alias("position_number"), F.concat(F.lit("Round"), F.get("a", F.lit(0))).alias("round_name"), F.concat(F.lit("Round"), F.get("a", F.lit(1))).alias("reference_round"), F.get("a", F.lit(2)).cast("double").alias("time"), whole(0, "dx"), whole(1, "dy"), whole(2, "dz"))


def summarise_metric(records: DataFrame, metric: str, submits: list[str], order: str = "seq") -> DataFrame:
    """A row for each fov in natural order, a column for each submission: the last value that isn't null."""
    rows = records.filter(F.col(metric).isNotNull()).groupBy("fov").pivot("submit", submits).agg(F.max_by(metric, order))
    return rows.orderBy(natural_key(F.col("fov")), "fov")


def summarise_shift(shifts: DataFrame, value: str, columns: list[str]) -> DataFrame:
    """A row for each fov, a column for each submission and round ('submit__Round2'), in the order given."""
    named = shifts.withColumn("column", F.concat_ws("__", "submit", "round_name"))
    return named.groupBy("fov").pivot("column", columns).agg(F.max_by(value, F.struct("time", value)))


def shift_columns(shifts: DataFrame) -> DataFrame:
    """The columns of summarise_shift in order: submission, then round number."""
    return shifts.select("submit", "round_name").distinct().select(F.concat_ws("__", "submit", "round_name").alias("column"), "submit", natural_key(F.col("round_name")).alias("n")).orderBy("submit", "n")


def combined_summary(records: DataFrame, metrics: list[str]) -> DataFrame:
    """All metrics as one long table: submit, fov, metric, value."""
    return records.select("submit", "fov", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(["submit", "fov"], metrics, "metric", "value")


def task_grid(params: DataFrame, fovs: DataFrame) -> DataFrame:
    """Every parameter set with every fov. Both are run configuration: the grid is the result itself."""
    return params.crossJoin(fovs)


def missing_tasks(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.join(done, keys, "left_anti")


def param_levels(center: float, step: float, n: int) -> list[float]:
    return [center + (i - n // 2) * step for i in range(n)]


def param_grid(levels: dict[str, list[float]], spark) -> DataFrame:
    """All combinations of levels."""
    out = spark.range(1).select()
    for name, values in levels.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return out


def level_design(runs: DataFrame, levels: dict[str, list[float]], seed: int = 0) -> DataFrame:
    """The runs (run) with one level of every parameter each: a parameter's levels are dealt in turn along the order of a seeded hash of the run, so each stands
    as often as the others but for one, and parameters are dealt independently.

    Orders of all parameters are numbered at once by ranges of the hash (see `numbered`), whatever the number of runs. A null run has no level.
    """
    names = list(levels)
    each = F.explode(F.array(*[F.lit(k) for k in range(len(names))]))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.element_at(F.array(*map(F.lit, names)), F.col("k") + 1), F.col("run").cast("string")).cast("binary"))
    # runs are dealt before they meet: they hardly repeat, so a task would hold all those of its input and combine nothing
    partitions = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = runs.filter("run is not null").select("run").repartition(partitions, "run").distinct()
    at = numbered(one.withColumn("k", each).withColumn("key", key), ["k", "key", "run"], "at")
    n = one.count()
    rank = F.col("at") - F.col("k") * n
    values = [F.max(F.when(F.col("k") == k, F.element_at(F.array(*[F.lit(float(v)) for v in levels[name]]), (rank % len(levels[name]) + 1).cast("int")))).alias(name) for k, name in enumerate(names)]
    return at.repartition(partitions, "run").groupBy("run").agg(*values)
