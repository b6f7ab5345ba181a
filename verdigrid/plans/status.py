"""What is wrong with the inputs of single images, as rows, so that a run goes on without them.

Problems are looked up in header-sized tables and in one pre-aggregated pass over polygon edges; no value is an error of the job.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from verdigrid.functions import crs, geometry as geo
from verdigrid.functions.spectral import is_finite
from verdigrid.operators.spatial import EDGE


def _any_missing(columns: list[str]) -> Column:
    return reduce(or_, [~F.coalesce(is_finite(F.col(c).cast("double")), F.lit(False)) for c in columns])


def header_problems(headers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, error) of rasters whose header gives no grid: no key, several headers, no size, no steps, or an unknown coordinate system."""
    a, b, d, e = [F.col(c) for c in ("a", "b", "d", "e")]
    sizes = F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    problem = (F.when(reduce(or_, [F.col(k).isNull() for k in keys]), "header without key")
               .when(~sizes, "broken header: no size").when(_any_missing(geo.AFFINE), "broken header: a missing coefficient")
               .when(a * e - b * d == 0, "broken header: steps of no area")
               .when(~F.coalesce(crs.is_supported(F.col("epsg")), F.lit(False)), F.concat(F.lit("unsupported EPSG code "), F.coalesce(F.col("epsg").cast("string"), F.lit("NULL")))))
    found = headers.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(problem).alias("_p"))
    error = F.coalesce("_p", F.when(F.col("_n") > 1, "several headers"))
    return found.select(*keys, error.alias("error")).filter("error IS NOT NULL")


def polygon_problems(edges: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, error) of images without a usable polygon: no edges, an end without position, or an unknown coordinate system."""
    unknown = F.when(~F.coalesce(crs.is_supported(F.col("epsg")), F.lit(False)), F.coalesce(F.col("epsg").cast("string"), F.lit("NULL")))
    found = edges.groupBy(*keys).agg(F.bool_or(_any_missing(EDGE)).alias("_open"), F.min(unknown).alias("_epsg"))
    error = (F.when(F.col("_open").isNull(), "polygon without edges").when(F.col("_open"), "broken polygon: an edge without position")
             .when(F.col("_epsg").isNotNull(), F.concat(F.lit("unsupported EPSG code of the polygon: "), "_epsg")))
    return images.select(*keys).distinct().join(found, keys, "left").select(*keys, error.alias("error")).filter("error IS NOT NULL")


def image_problems(headers: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, error) of the images that cannot be built, each once: what is wrong with the header, else with the polygon."""
    of_header = header_problems(headers, keys)
    return of_header.unionByName(polygon_problems(edges, usable(headers, of_header, keys), keys))


def usable(rows: DataFrame, problems: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with keys that have no problem."""
    return rows.dropna(subset=keys).join(problems.select(*keys), keys, "left_anti")
