"""Inputs of the registered queries, derived from the given tables.

A view is a table and a list of SQL expressions that both Spark and DuckDB read,
so both sides of a check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigrid.bands import BANDS
from verdigrid.operators.spatial import ring_edges

GRID_WIDTH = 50
IMAGE_ROWS = 10
CELL_EXPRS = ["CAST(floor({id}/50) AS BIGINT) AS grid_row", "{id} % 50 AS grid_col"]


def _cells(name: str) -> list[str]:
    return [f"{name} AS pixel_id"] + [e.format(id=name) for e in CELL_EXPRS]


# whole numbers over powers of two: exact in both engines, so medians and fills are equal to the last bit
_DISC, _TAX, _PRICE = "CAST(floor(l_discount*100 + 0.5) AS DOUBLE)", "CAST(floor(l_tax*100 + 0.5) AS DOUBLE)", "CAST(floor(l_extendedprice) AS DOUBLE)"
CODES = {
    "B1": f"({_TAX} + 1)/64", "B2": f"({_DISC} + 2)/128", "B3": f"(l_quantity + {_DISC})/64", "B4": "l_quantity/64",
    "B5": f"(l_quantity + {_TAX})/128", "B6": f"({_PRICE} + {_TAX}*1000)/262144", "B7": f"{_PRICE}/131072",
    "B8": f"{_PRICE}/131072 + l_quantity/1024", "B8A": f"{_PRICE}/131072 - {_DISC}/1024", "B9": f"{_TAX}/32",
    "B11": f"({_DISC}*4 + l_quantity)/256", "B12": f"({_DISC} + {_TAX})/32",
}
BANDS_SQL = dict(zip(BANDS, CODES.values()))
QA = "CASE WHEN l_linenumber=1 THEN 1024 WHEN l_linenumber=2 THEN 2048 WHEN l_linenumber=3 THEN 4096 ELSE 0 END"
RASTER_ID = "CAST(floor(p_partkey/500) AS INT)"
SEASONS = (1994, 2001)

VIEWS: dict[str, tuple[str, list[str]]] = {
    # optical observations with band codes
    "v_s2": ("lineitem", _cells("l_partkey") + [
        "CAST(l_shipdate AS DATE) AS ts", "CAST(round(l_discount*100) AS INT) + CASE WHEN l_tax > 0.06 THEN 3 ELSE 0 END AS cloud_pct",
        f"{QA} AS qa60"] + [f"{e} AS {c}" for c, e in CODES.items()]),
    # radar observations in dB; pols is VV+VH or VV
    "v_s1": ("lineitem", _cells("l_partkey") + [
        "CAST(l_shipdate AS DATE) AS ts", "CASE WHEN l_returnflag='R' THEN 'EW' ELSE 'IW' END AS instrument_mode",
        "CASE WHEN l_linestatus='F' THEN 'VV,VH' ELSE 'VV' END AS pol_list",
        "CASE WHEN l_linenumber <= 5 THEN 10 ELSE 25 END AS resolution_m",
        "-l_quantity/2 AS vv_db", "-l_quantity/2 - l_tax*100 AS vh_db"]),
    # values with NaN and infinities
    "v_raw": ("lineitem", _cells("l_partkey") + [
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_linenumber=7 THEN CAST('NaN' AS DOUBLE) WHEN l_linenumber=6 THEN CAST('Infinity' AS DOUBLE) "
        "ELSE l_extendedprice/100000 END AS nir",
        "CASE WHEN l_quantity > 45 THEN CAST('-Infinity' AS DOUBLE) WHEN l_quantity < 3 THEN NULL ELSE l_quantity/50 END AS red"]),
    # pixels with land-cover class 0..5
    "v_mask": ("part", _cells("p_partkey") + ["p_size % 6 AS cls"]),
    # images of ten grid rows
    "v_cells": ("part", [f"concat('roi_', CAST({RASTER_ID} % 3 AS VARCHAR(9))) AS roi", f"{RASTER_ID} AS idx",
                         "CAST(floor(p_partkey/50) AS BIGINT) % 10 AS grid_row", "p_partkey % 50 AS grid_col",
                         "p_partkey AS pixel_id", "p_size % 6 AS cls"]),
    # polygon anchors and sizes
    "v_poly": ("customer", ["c_custkey AS poly", "CAST((c_custkey*7)%40 AS DOUBLE) AS px",
                            "floor(c_custkey/38.0)*1.0 AS py", "CAST(6+c_custkey%5 AS DOUBLE) AS w",
                            "CAST(5+c_custkey%4 AS DOUBLE) AS h"]),
    # land-cover raster headers
    "v_tiles": ("supplier", ["s_suppkey AS raster_id", "concat('/lc/tile_', CAST(100000 - s_suppkey AS VARCHAR(9)), '.tif') AS path",
                             "8 AS width", "6 AS height", "CAST(1 AS DOUBLE) AS a", "CAST(0 AS DOUBLE) AS b",
                             "CAST((s_suppkey*11)%45 AS DOUBLE) AS c", "CAST(0 AS DOUBLE) AS d", "CAST(1 AS DOUBLE) AS e",
                             "floor(s_suppkey*2/5.0)*1.0 AS f", "CAST(0 AS DOUBLE) AS nodata"]),
    "v_scored": ("embeddings", ["vec_id", "label", "CAST(CASE WHEN vec_id % 3 = 0 THEN (label+vec_id) % 10 ELSE label END AS INT) AS pred"]),
    "v_inputs": ("customer", ["concat('/data/', lower(c_mktsegment), '/season', CAST(1995+c_custkey%3 AS VARCHAR(8)), "
                              "'_feat', CAST(c_custkey AS VARCHAR(12)), '.tif') AS path"]),
    "v_masks": ("supplier", ["concat('/lulc/poly_', CAST(s_suppkey*2 AS VARCHAR(12)), '.TIFF') AS path"]),
    # files per segment with repeated indices
    "v_repeats": ("customer", ["lower(c_mktsegment) AS roi", "concat('/data/', CAST(c_custkey AS VARCHAR(12)), '_feat', "
                               "CAST(c_custkey % 500 AS VARCHAR(12)), '.tif') AS path"]),
    "v_seg_masks": ("customer", ["CASE WHEN c_mktsegment='BUILDING' THEN 'none' ELSE lower(c_mktsegment) END AS roi",
                                 "concat('/lulc/poly_', CAST(c_custkey % 300 AS VARCHAR(12)), '.tif') AS path"]),
    # stacked band names, some malformed
    "v_names": ("lineitem", [
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_linenumber=7 THEN concat('B', CAST(l_suppkey AS VARCHAR(9))) ELSE concat('M', "
        "lpad(CAST(l_quantity % 15 AS VARCHAR(2)), 2, '0'), '_', CASE WHEN l_suppkey % 5 = 0 THEN 'red' "
        "WHEN l_suppkey % 5 = 1 THEN 'red_edge4' WHEN l_suppkey % 5 = 2 THEN 'vh' WHEN l_suppkey % 5 = 3 THEN 'srtm' "
        "ELSE 'coastal' END) END AS name"]),
}
VIEWS["v_names"][1][2] = VIEWS["v_names"][1][2].replace("CAST(l_quantity % 15 AS VARCHAR(2))", "CAST(CAST(l_quantity AS INT) % 15 AS VARCHAR(2))")

LC_SQL = """SELECT s_suppkey AS raster_id, CAST(r AS BIGINT) AS grid_row, CAST(k AS BIGINT) AS grid_col,
 CAST((s_suppkey*7 + r*3 + k*5) % 6 AS BIGINT) AS value FROM supplier, range(6) t(r), range(8) u(k)"""
EDGES_SQL = """SELECT poly, CAST(ord AS INT) AS ord,
 CASE ord WHEN 0 THEN px WHEN 1 THEN px+w WHEN 2 THEN px+w/2 ELSE px+w*CAST(0.35 AS DOUBLE) END AS x0,
 CASE ord WHEN 0 THEN py WHEN 1 THEN py+CAST(1.5 AS DOUBLE) WHEN 2 THEN py+h ELSE py+h/2 END AS y0,
 CASE ord WHEN 3 THEN px WHEN 0 THEN px+w WHEN 1 THEN px+w/2 ELSE px+w*CAST(0.35 AS DOUBLE) END AS x1,
 CASE ord WHEN 3 THEN py WHEN 0 THEN py+CAST(1.5 AS DOUBLE) WHEN 1 THEN py+h ELSE py+h/2 END AS y1
 FROM v_poly, range(4) o(ord)"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, exprs = VIEWS[name]
    return table(spark, sf, source).selectExpr(*exprs)


def s1(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_s1").withColumn("pols", F.split("pol_list", ",")).drop("pol_list")


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    """One ring of four points per polygon."""
    points = ["struct(px AS x, py AS y)", "struct(px + w AS x, py + 1.5D AS y)", "struct(px + w/2 AS x, py + h AS y)",
              "struct(px + w*0.35D AS x, py + h/2 AS y)"]
    return view(spark, sf, "v_poly").selectExpr("poly", f"array(array({', '.join(points)})) AS rings")


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return ring_edges(polygons(spark, sf), ["poly"]).drop("ring")


def land_cover(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("raster_id"))
    return (ids.withColumn("grid_row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(5).cast("bigint"))))
            .withColumn("grid_col", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(7).cast("bigint"))))
            .withColumn("value", F.expr("(raster_id*7 + grid_row*3 + grid_col*5) % 6")))


def duck(body: str, *names: str, **extra: str) -> str:
    """DuckDB text of a query over views; ``extra`` are further common table expressions, in order."""
    ctes = []
    for n in names:
        if n == "v_edges":
            ctes.append(f"v_edges AS ({EDGES_SQL})")
        elif n == "v_lc":
            ctes.append(f"v_lc AS ({LC_SQL})")
        else:
            source, exprs = VIEWS[n]
            ctes.append(f"{n} AS (SELECT {', '.join(exprs)} FROM {source})")
    ctes += [f"{k} AS ({v})" for k, v in extra.items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
