"""Microscopy tables derived from the TPC-H-like ones, as one SQL text for Spark and DuckDB (whole numbers only)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: A number of its own for every row; a field of view is a range of orders, so their number grows with the input.
_ID = "(l_orderkey * 8 + l_linenumber) * 1099511627776 + l_partkey * 16777216 + cast(round(l_extendedprice * 100) as bigint)"
#: Its value in Spark: the same up to 2^63, where the SQL above fails in both engines; a row beyond has a negative number, a hash of all that makes it a row of its own.
_ANY_ID = f"""CASE WHEN l_orderkey * 8 + l_linenumber + (l_partkey * 16777216 + cast(round(l_extendedprice * 100) as bigint)) div 1099511627776 < 8388608 THEN {_ID}
          ELSE xxhash64(l_orderkey, l_linenumber, l_partkey, l_extendedprice) | (-9223372036854775807 - 1) END"""
#: The SQL's number in full, for queries that go by the order of rows: hashes have none.
_ORDER = "cast(l_orderkey * 8 + l_linenumber as decimal(38, 0)) * 1099511627776 + (l_partkey * 16777216 + cast(round(l_extendedprice * 100) as bigint))"
_FOV = "cast(floor(l_orderkey / 2500) as int) + 1"
_K = "(p_partkey % 61 * 12)"

VIEWS = {
    "spots": f"""
        SELECT {_ID} AS spot_id, {_FOV} AS fov, cast(l_orderkey % 512 + 1 as int) AS x, cast(l_partkey % 512 + 1 as int) AS y,
          cast(l_linenumber as int) AS z, cast(l_quantity as int) AS intensity, cast(l_suppkey % 3 + 1 as int) AS channel, l_partkey AS part_no
        FROM lineitem""",
    "colour_sums": f"""
        SELECT {_ID} AS spot_id, {_FOV} AS fov, cast(n as int) AS round_no,
          cast((l_orderkey * 7 + l_partkey * n * 3 + l_linenumber * 11 + n) % 97 as int) AS c1,
          cast((l_orderkey * 7 + l_partkey * n * 3 + l_linenumber * 22 + n * 4) % 97 as int) AS c2,
          cast((l_orderkey * 7 + l_partkey * n * 3 + l_linenumber * 33 + n * 9) % 97 as int) AS c3
        FROM lineitem CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS r(n)""",
    "codebook": f"""
        SELECT p_partkey AS row_no, p_name || '_' || cast(p_partkey as varchar(20)) AS gene,
          substr('ATG', cast(floor({_K} / 243) as int) % 3 + 1, 1) || substr('ATG', cast(floor({_K} / 81) as int) % 3 + 1, 1)
          || substr('ATG', cast(floor({_K} / 27) as int) % 3 + 1, 1) || substr('ATG', cast(floor({_K} / 9) as int) % 3 + 1, 1)
          || substr('ATG', cast(floor({_K} / 3) as int) % 3 + 1, 1) || substr('ATG', cast({_K} % 3 as int) + 1, 1) AS sequence
        FROM part""",
    "voxels": f"""
        SELECT {_FOV} AS fov, cast(l_linenumber % 3 + 1 as int) AS round_no, cast(floor(l_suppkey / 4) as int) % 3 + 1 AS channel,
          cast(l_suppkey % 4 + 1 as int) AS z, cast(l_partkey % 32 + 1 as int) AS y, cast(l_orderkey % 32 + 1 as int) AS x,
          cast(least(255, sum(cast(l_quantity as int))) as int) AS value
        FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6""",
    "tiles": """
        SELECT cast(s_suppkey + 1 as int) AS tile, cast(floor(s_suppkey / 5) as int) AS column_index, cast(s_suppkey % 5 as int) AS row_index,
          cast(floor(s_suppkey / 5) * 1843 + s_suppkey * 37 % 40 as int) AS x, cast(s_suppkey % 5 * 1843 + s_suppkey * 53 % 40 as int) AS y
        FROM supplier""",
    "slides": """
        SELECT cast(floor(c_custkey / 60) as int) + 1 AS slide, cast(c_custkey % 60 as int) + 1 AS tile, cast(floor(c_custkey % 60 / 6) * 520 + c_custkey * 37 % 450 as int) AS x,
          cast(c_custkey % 6 * 520 + c_custkey * 53 % 450 as int) AS y
        FROM customer""",
    "cells": """
        SELECT cast(floor(c_custkey / 15) as int) + 1 AS tile, cast(c_custkey % 15 as int) AS raw, cast(c_custkey * 811 % 2048 as int) AS x,
          cast(c_custkey * 577 % 2048 as int) AS y, cast(c_custkey % 30 as int) AS z
        FROM customer""",
    "reads": f"""
        SELECT {_ID} AS read_id, cast(l_suppkey + 1 as int) AS tile, cast(l_orderkey * 811 % 2048 as int) AS x, cast(l_partkey * 577 % 2048 as int) AS y,
          cast(l_linenumber as int) AS z, 'gene' || cast(l_partkey % 50 as varchar(20)) || CASE l_linenumber % 3 WHEN 0 THEN '_rbRNA' WHEN 1 THEN '_ntRNA' ELSE '' END AS gene_name,
          CASE WHEN l_linenumber % 5 = 0 THEN -1 ELSE 0 END AS is_noise, cast(l_orderkey % 17 - 1 as int) AS raw
        FROM lineitem""",
    "labels": f"""
        SELECT {_FOV} AS fov, cast(l_suppkey % 4 + 1 as int) AS z, cast(l_partkey % 64 + 1 as int) AS y, cast(l_orderkey % 64 + 1 as int) AS x,
          cast(max(floor(l_orderkey % 64 / 8) * 8 + floor(l_partkey % 64 / 8) + 1) as int) AS label
        FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1, 2, 3, 4""",
    "logs": """
        SELECT 'S' || cast(o_custkey % 3 as varchar(20)) AS submit, o_orderkey AS task_id,
          CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '选中的 Position 文件夹名称: Position' || cast(o_orderkey % 40 + 1 as varchar(20)) || chr(10) END
          || '0.25 [' || cast(o_orderkey % 97 as varchar(20)) || ' / ' || cast(o_orderkey % 5 * 100 as varchar(20)) || '] percent of reads are below score thresh 0.5' || chr(10)
          || '0.5 [' || cast(o_custkey % 89 as varchar(20)) || ' / ' || cast(o_custkey % 4 * 90 as varchar(20)) || '] percent of reads are below score thresh 0.5 of all valid spots' || chr(10)
          || '0.125 [' || cast(o_custkey % 61 as varchar(20)) || ' / 400] percent of reads have intensity above 2.7e2 in Reference Round (Round 1)' || chr(10)
          || 'Geting max color...' || chr(10) || cast(o_orderkey % 13 as varchar(20)) || chr(10) || 'Decoding...' || chr(10)
          || '0.75 [' || cast(o_orderkey % 53 as varchar(20)) || ' / 90] percent of reads match seqD barcode pattern' || chr(10)
          || '0.625 [' || cast(o_orderkey % 43 as varchar(20)) || ' / 90] percent of reads match seqF barcode pattern' || chr(10)
          || '0.5 [' || cast(o_orderkey % 41 as varchar(20)) || ' / 90] percent of good reads match barcode pattern' || chr(10)
          || '0.375 [' || cast(o_custkey % 37 as varchar(20)) || ' / 90] percent of good reads are in codebook' || chr(10)
          || 'Method: max3d' || chr(10) || 'Reference round: 1' || chr(10) || 'Intensity threshold: 0.2' || chr(10)
          || 'Number of spots found by max3d: ' || cast(o_orderkey * 7 % 1000 as varchar(20)) || chr(10)
          || 'Loading 3D DAPI stack: /data/Position' || cast(o_orderkey % 40 + 1 as varchar(20)) || '/stack.tif' || chr(10)
          || 'Raw detected cells: ' || cast(o_orderkey % 300 as varchar(20)) || chr(10) || 'Overall area of raw dapi: ' || cast(o_orderkey % 9 + 1 as varchar(20)) || ',234,567' || chr(10)
          || 'Overall area of filtered dapi: ' || cast(o_orderkey % 9 + 1 as varchar(20)) || ',000,000' || chr(10) || 'Area reduction ratio: 12.5%' || chr(10)
          || 'Filtered detected cells: ' || cast(o_orderkey % 280 as varchar(20)) || ' (Removed ' || cast(o_orderkey % 20 as varchar(20)) || ')' || chr(10)
          || 'Round 2 vs. Round 1 finished [time=1.5]' || chr(10) || 'Shifted by ' || cast(o_orderkey % 7 - 3 as varchar(20)) || ' 2 -1' || chr(10)
          || 'Round 3 vs. Round 1 finished [time=2.25]' || chr(10) || 'Shifted by -4 ' || cast(o_custkey % 7 - 3 as varchar(20)) || ' 0' || chr(10) AS text
        FROM orders""",
}

#: `placed_voxels` is the view `voxels` for queries that sum over rounds and channels of a place: rows of lineitem are dealt by the view's fov, z, y and x before
#: all sums, some PLACED_ROWS a task. They hardly repeat, so a task that summed its split first would hold all of it and combine next to nothing.
_PLACE = [_FOV, *[f"cast({c} as int)" for c in ("l_suppkey % 4 + 1", "l_partkey % 32 + 1", "l_orderkey % 32 + 1")]]
PLACED_ROWS = 1 << 18


def _names(text: str, known: tuple[str, ...]) -> list[str]:
    return [n for n in known if re.search(rf"\b{n}\b", text)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view derived from it; `ordered_spots` and `ordered_reads` also have `row_order`, the order of the SQL's numbers."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name.removeprefix("placed_").removeprefix("ordered_")]
    if name.startswith("ordered_"):
        text = text.replace(f"SELECT {_ID} AS", f"SELECT {_ORDER} AS row_order, {_ID} AS")
    text = text.replace(_ID, _ANY_ID)
    given = {n: table(spark, sf_dir, n) for n in _names(text, TABLES)}
    if name == "placed_voxels":
        rows = given["lineitem"]
        parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // PLACED_ROWS))
        given["lineitem"] = rows.repartition(parts, *map(F.expr, _PLACE))
    for n in _names(text, TABLES):
        text = re.sub(rf"\b{n}\b", "{" + n + "}", text)
    return spark.sql(text, **given)


def with_views(body: str) -> str:
    """DuckDB SQL: the body behind the views that it names."""
    used = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if re.search(rf"\b{n}\b", body)]
    body = body.strip()
    head = "WITH RECURSIVE " if body[:15].upper() == "WITH RECURSIVE " else "WITH "
    rest = body[len(head) :] if body.upper().startswith(head) else None
    if not used:
        return body
    return head + ",\n".join(used) + (",\n" + rest if rest is not None else "\n" + body)
