"""Colour codes: encoding base sequences as colours, and decoding colours as bases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour of each pair of bases, by instrument.
PAIR_COLOURS = {
    "Leica_rj": {"AT": 3, "GT": 1, "TT": 2, "AG": 1, "GG": 2, "TG": 3, "AA": 2, "GA": 3, "TA": 1},
    "Olympus": {"AA": 1, "TT": 1, "GG": 1, "AG": 2, "TA": 2, "GT": 2, "AT": 3, "TG": 3, "GA": 3},
}
# Colour of the last pair in three-part codes, and the reverse (3 stands for any base).
LAST_PAIR_COLOURS = {"Leica_rj": {"GT": 1, "GC": 2}, "Olympus": {"GC": 1, "GT": 2}}
OMICS_BASES = {"Leica_rj": {1: "T", 2: "C", 3: "N"}, "Olympus": {1: "C", 2: "T", 3: "N"}}


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(v) for kv in entries.items() for v in kv])


def encode_bases(sequence: Column, instrument: str, last_pair: bool = False) -> Column:
    """Colours of the neighbouring pairs of a sequence; with last_pair, the last pair has its own code.

    A pair without a colour makes the whole code null; fewer than two bases give an empty code.
    """
    pairs = _literal_map({k: str(v) for k, v in PAIR_COLOURS[instrument].items()})
    ends = _literal_map({k: str(v) for k, v in LAST_PAIR_COLOURS[instrument].items()})
    n = F.length(sequence) - 1
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    pick = lambda i: F.when(i == n, ends[F.substring(sequence, i, 2)]).otherwise(pairs[F.substring(sequence, i, 2)]) if last_pair else pairs[F.substring(sequence, i, 2)]
    codes = F.transform(at, pick)
    return F.when(F.exists(codes, lambda c: c.isNull()), None).otherwise(F.array_join(codes, ""))


def decode_colours(colours: Column, start: str, instrument: str) -> Column:
    """The base walk from a start base: each colour and base have one next base. Null if a colour has none."""
    step = _literal_map({f"{pair[0]}{c}": pair[1] for pair, c in PAIR_COLOURS[instrument].items()})
    return F.aggregate(colours, F.lit(start), lambda acc, c: F.concat(acc, step[F.concat(F.right(acc, F.lit(1)), c.cast("string"))]))


def decode_omics(colour: Column, instrument: str) -> Column:
    """One colour after a G: GC, GT or GN."""
    return F.concat(F.lit("G"), _literal_map(OMICS_BASES[instrument])[colour])


def digits(code: Column) -> Column:
    """'213' -> [2, 1, 3]."""
    return F.transform(F.filter(F.split(code, ""), lambda c: c != ""), lambda c: c.cast("int"))


def clean_gene(name: Column, anchored: bool = True) -> Column:
    """A gene's name without _rbRNA or _ntRNA, at the end only or anywhere."""
    return F.regexp_replace(name, "(_rbRNA|_ntRNA)$" if anchored else "_rbRNA|_ntRNA", "")
