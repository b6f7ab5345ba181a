"""Polygons against rasters, without a geometry library.

Polygons are tables of directed edges (polygon keys, ord, x0, y0, x1, y1); inner
rings run the other way round than outer ones. Boxes have x0, y0, x1, y1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from verdigrid.functions import crs, geometry as geo
from verdigrid.session import materialise
from verdigrid.skew import HOT_ROWS, row_numbers

EDGE = ["x0", "y0", "x1", "y1"]
# Levels of boxes that the overlap join tells apart.
LEVELS = 12
EDGES_PER_CHUNK = 10_000


def ring_edges(rings: DataFrame, keys: list[str], orient: bool = True) -> DataFrame:
    """Edges of ``rings`` (ARRAY of rings of points x, y); open and closed rings alike.

    With ``orient`` outer rings (the first) run counter-clockwise and others clockwise.
    """
    ring = F.col("_pts")
    signed = F.aggregate(F.col("_seg"), F.lit(0.0), lambda acc, s: acc + geo.shoelace_term(
        s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"]))
    flip = (F.col("_area") > 0) != (F.col("ring") == 0)
    opened = F.when((F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1)),
                    F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)
    following = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
                         F.slice(ring, F.lit(1), F.lit(1)))
    one = (rings.select(*keys, F.posexplode("rings").alias("ring", "_pts")).withColumn("_pts", opened)
           .withColumn("_seg", F.zip_with(ring, following, lambda p, q: F.struct(p.alias("p"), q.alias("q"))))
           .withColumn("_area", signed))
    edges = one.select(*keys, "ring", "_area", F.posexplode("_seg").alias("ord", "_s"))
    swap = flip if orient else F.lit(False)
    ends = {n: F.when(swap, F.col(f"_s.{'q' if n[1] == '0' else 'p'}.{n[0]}"))
            .otherwise(F.col(f"_s.{'p' if n[1] == '0' else 'q'}.{n[0]}")) for n in EDGE}
    return edges.select(*keys, "ring", "ord", *[c.alias(n) for n, c in ends.items()])


def polygon_area(edges: DataFrame, keys: list[str]) -> DataFrame:
    area = F.abs(F.sum(geo.shoelace_term(*[F.col(c) for c in EDGE])))
    return edges.groupBy(*keys).agg(area.alias("area"))


def polygon_bounds(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Box, area and number of edges of each polygon."""
    return edges.groupBy(*keys).agg(
        F.min("x0").alias("px0"), F.min("y0").alias("py0"), F.max("x0").alias("px1"), F.max("y0").alias("py1"),
        F.abs(F.sum(geo.shoelace_term(*[F.col(c) for c in EDGE]))).alias("poly_area"),
        F.count(F.lit(1)).alias("n_edges"))


def raster_bounds(headers: DataFrame, keys: list[str]) -> DataFrame:
    """Footprint boxes from headers."""
    box = geo.bounds(F.col("width"), F.col("height"), geo.affine())
    return headers.select(*keys, *[b.alias(n) for n, b in zip(("bx0", "by0", "bx1", "by1"), box)])


def pixel_bounds(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Cell range taken up by the pixel rows, for rasters without a header size."""
    return pixels.groupBy(*keys).agg(F.min("grid_row").alias("row0"), F.min("grid_col").alias("col0"),
                                     F.max("grid_row").alias("row1"), F.max("grid_col").alias("col1"))


def reproject_edges(edges: DataFrame, target: Column, source: str = "epsg") -> DataFrame:
    """Edges with both ends in another coordinate system."""
    return crs.reprojected(edges, [("x0", "y0"), ("x1", "y1")], F.col(source), target).withColumn(source, target)


def settled(iou: Column) -> Column:
    """Rounded, so that the order of summation decides neither a threshold nor a tie."""
    return F.round(iou, 12)


def box_levels(df: DataFrame, box: list[str], top: int) -> DataFrame:
    """Add ``_level``: the level whose cells, of side 2 ** level, are the smallest that hold a box of this size.

    Small boxes share the level ``LEVELS`` below the largest box's. A box covers four cells of its level at most.
    """
    x0, y0, x1, y1 = [F.col(c) for c in box]
    size = F.greatest(x1 - x0, y1 - y0, F.lit(2.0 ** (top - LEVELS)))
    return df.withColumn("_level", F.least(F.ceil(F.log2(size)).cast("int"), F.lit(top)))


def box_cells(df: DataFrame, box: list[str]) -> DataFrame:
    """A row for each cell of ``_level`` that a box touches."""
    side = F.pow(F.lit(2.0), F.col("_level"))
    lo_x, lo_y, hi_x, hi_y = [F.floor(F.col(c) / side) for c in box]
    return (df.withColumn("_cx", F.explode(F.sequence(lo_x, hi_x)))
            .withColumn("_cy", F.explode(F.sequence(lo_y, hi_y))))


def box_overlap_join(left: DataFrame, left_box: list[str], right: DataFrame, right_box: list[str],
                     on: list[str] | None = None) -> DataFrame:
    """Pairs of rows whose boxes meet (shared borders count), in any unit and of any mix of sizes.

    Each box lies in the cells of the level of its own size, and looks for larger ones in the cells that it
    touches on the levels above: an equi-join on level and cell. A pair is kept only in the cell that holds the
    lower corner of the common box. A box has 4 * (LEVELS + 1) copies at most.
    """
    on = on or []
    sizes = [df.select(F.greatest(F.col(x1) - F.col(x0), F.col(y1) - F.col(y0)).alias("_size")) for df, (x0, y0, x1, y1) in ((left, left_box), (right, right_box))]
    largest = sizes[0].union(sizes[1]).agg(F.max("_size")).first()[0]
    top = math.ceil(math.log2(largest)) if largest and math.isfinite(largest) else 0

    lx0, ly0, lx1, ly1 = [F.col(c) for c in left_box]
    rx0, ry0, rx1, ry1 = [F.col(c) for c in right_box]
    meet = (lx0 <= rx1) & (rx0 <= lx1) & (ly0 <= ry1) & (ry0 <= ly1)
    side = F.pow(F.lit(2.0), F.col("_level"))
    home = ((F.floor(F.greatest(lx0, rx0) / side) == F.col("_cx"))
            & (F.floor(F.greatest(ly0, ry0) / side) == F.col("_cy")))

    def up(df: DataFrame, box: list[str], first: int) -> DataFrame:
        """The box on its own level or the next (``first`` 0 or 1), and on all above."""
        levelled = box_levels(df, box, top).filter(F.col("_level") + first <= top)
        return box_cells(levelled.withColumn("_level", F.explode(F.sequence(F.col("_level") + first, F.lit(top)))), box)

    def own(df: DataFrame, box: list[str]) -> DataFrame:
        return box_cells(box_levels(df, box, top), box)

    keys = [*on, "_level", "_cx", "_cy"]
    # a box's cells are many rows made of few bytes, which the planner takes for a table small enough to send: shuffled on both sides instead
    not_smaller = up(left, left_box, 0).join(own(right, right_box).hint("merge"), keys).filter(meet & home)
    smaller = up(right, right_box, 1).join(own(left, left_box).hint("merge"), keys).filter(meet & home)
    return not_smaller.unionByName(smaller).drop("_level", "_cx", "_cy")


def scenes_meeting_rois(scenes: DataFrame, scene_box: list[str], rois: DataFrame, roi_box: list[str]) -> DataFrame:
    """Scenes whose footprint meets the box of any region.

    Footprints repeat from visit to visit, so each different one is looked up once.
    """
    met = box_overlap_join(scenes.select(*scene_box).distinct(), scene_box, rois.select(*roi_box).distinct(), roi_box)
    return scenes.join(met.select(*scene_box).distinct(), scene_box, "left_semi")


def iou_join(edges: DataFrame, poly_keys: list[str], footprints: DataFrame, raster_keys: list[str],
             threshold: float = 1e-4, on: list[str] | None = None) -> DataFrame:
    """(polygon, raster, iou) with iou >= threshold, for boxes ``bx0 by0 bx1 by1``.

    Only polygons and rasters whose boxes meet are looked at. At a threshold of 0 or
    less every pair would qualify, so that is an error.
    Edges are joined in chunks of bounded size, so a polygon with very many
    vertices is spread over tasks; the sum per pair is pre-aggregated.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0: at 0 every polygon qualifies with every raster")
    on = on or []
    box = ["bx0", "by0", "bx1", "by1"]
    bounds = materialise(polygon_bounds(edges, poly_keys))
    pairs = box_overlap_join(bounds, ["px0", "py0", "px1", "py1"], footprints, box, on)
    n_chunks = F.ceil(F.col("n_edges") / EDGES_PER_CHUNK)
    split = bounds.filter(F.col("n_edges") > EDGES_PER_CHUNK).select(*poly_keys, n_chunks.alias("_chunks"))
    chunk = F.coalesce(F.pmod(F.xxhash64(*EDGE), F.col("_chunks")), F.lit(0).cast("bigint"))
    chunked = edges.select(*poly_keys, *EDGE).join(split, poly_keys, "left").withColumn("_chunk", chunk)
    common = (pairs.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks.cast("bigint") - 1)))
              .join(chunked.drop("_chunks").hint("merge"), [*poly_keys, "_chunk"]))  # edges never pass the driver
    box_area = (F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))
    shared = (geo.clipped_area_terms(common, EDGE, box, "_term").groupBy(*poly_keys, *[k for k in raster_keys if k not in poly_keys])
              .agg(F.abs(F.coalesce(F.sum("_term"), F.lit(0.0))).alias("inter_area"),
                   F.first("poly_area").alias("poly_area"), F.first(box_area).alias("box_area")))
    union = F.col("poly_area") + F.col("box_area") - F.col("inter_area")
    iou = F.coalesce(F.try_divide(F.col("inter_area"), union), F.lit(0.0))
    return shared.withColumn("iou", iou).drop("box_area").filter(settled(F.col("iou")) >= threshold)


def rank_candidates(candidates: DataFrame, poly_keys: list[str], path: str = "path",
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """1-based ``rank`` of the rasters of a polygon, best iou first, ties in path order."""
    return row_numbers(candidates, poly_keys, [settled(F.col("iou")).desc(), F.col(path)], "rank", hot_rows)


def polygon_spans(edges: DataFrame, poly_keys: list[str], t: dict[str, Column] | None = None,
                  hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(polygon keys, grid_row, first_col, last_col): the cells of a row whose centres are inside a polygon (even-odd rule), as disjoint spans.

    Every edge yields its crossing with the centre line of each row it passes. In a row, sorted crossings pair up to spans.
    Rows and work grow with the polygon's outline, not with its area.
    """
    ends = edges.select(*poly_keys, *EDGE)
    if t is not None:
        r0, c0 = geo.to_pixel_space(F.col("x0"), F.col("y0"), t)
        r1, c1 = geo.to_pixel_space(F.col("x1"), F.col("y1"), t)
        ends = edges.select(*poly_keys, c0.alias("x0"), r0.alias("y0"), c1.alias("x1"), r1.alias("y1"))
    # rows whose centre y + 0.5 lies in [lowest, highest) of the edge
    first = F.ceil(F.least("y0", "y1") - 0.5)
    last = F.ceil(F.greatest("y0", "y1") - 0.5) - 1
    rows = (ends.withColumns({"_r0": first.cast("bigint"), "_r1": last.cast("bigint")})
            .filter(F.col("_r0") <= F.col("_r1"))
            .withColumn("grid_row", F.explode(F.sequence("_r0", "_r1"))))
    slope = (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    crossings = rows.select(*poly_keys, "grid_row",
                            (F.col("x0") + (F.col("grid_row") + 0.5 - F.col("y0")) * slope).alias("_x"))
    numbered = row_numbers(crossings, [*poly_keys, "grid_row"], [F.col("_x")], "_no", hot_rows)
    return (numbered.withColumn("_pair", F.floor((F.col("_no") - 1) / 2))
            .groupBy(*poly_keys, "grid_row", "_pair").agg(F.min("_x").alias("_from"), F.max("_x").alias("_to"))
            .select(*poly_keys, "grid_row", F.ceil(F.col("_from") - 0.5).cast("bigint").alias("first_col"),
                    (F.ceil(F.col("_to") - 0.5) - 1).cast("bigint").alias("last_col"))
            .filter("first_col <= last_col"))


def polygon_cells(edges: DataFrame, poly_keys: list[str], t: dict[str, Column] | None = None,
                  hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Grid cells whose centre is inside a polygon, one row each. Joins take ``polygon_spans`` instead and list no cells."""
    spans = polygon_spans(edges, poly_keys, t, hot_rows)
    return spans.select(*poly_keys, "grid_row", F.explode(F.sequence("first_col", "last_col")).alias("grid_col"))


def within_spans(cells: DataFrame, spans: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Cells that lie in a span with the same ``on`` and row: a join on these keys with a test of the column.

    A cell meets the few spans of its row only, and no cell is listed on the other side.
    """
    keys = [*on, "grid_row"]
    renamed = spans.withColumnsRenamed({k: f"_span_{k}" for k in keys})
    same = [F.col(k) == F.col(f"_span_{k}") for k in keys]
    joined = cells.join(renamed, [*same, F.col("grid_col").between(F.col("first_col"), F.col("last_col"))], how)
    return joined.drop(*[f"_span_{k}" for k in keys], "first_col", "last_col")


def pixels_in_polygons(pixels: DataFrame, edges: DataFrame, poly_keys: list[str],
                       t: dict[str, Column] | None = None, on: list[str] | None = None) -> DataFrame:
    """Pixel rows with the polygons they lie in, one row per pair. ``on`` are keys of a raster that both sides share."""
    on = on or []
    every = list(dict.fromkeys([*on, *poly_keys]))
    return within_spans(pixels, polygon_spans(edges, every, t), on)


def clip_to_rois(pixels: DataFrame, edges: DataFrame, poly_keys: list[str],
                 t: dict[str, Column] | None = None, on: list[str] | None = None) -> DataFrame:
    """Pixels inside of any polygon. ``on`` are keys of a raster that both sides share."""
    on = on or []
    every = list(dict.fromkeys([*on, *poly_keys]))
    return within_spans(pixels, polygon_spans(edges, every, t).select(*on, "grid_row", "first_col", "last_col"), on, "left_semi")


def edges_of_images(edges: DataFrame, headers: DataFrame, keys: list[str], poly_keys: list[str]) -> DataFrame:
    """Polygon edges in the system of each raster that they belong to: one that shares the keys that both have.

    ``edges`` and ``headers`` carry ``epsg``. Write the table before work that filters it.
    """
    own = headers.select(*keys, F.col("epsg").alias("_epsg"))
    return reproject_edges(edges.hint("merge").join(own, [k for k in keys if k in poly_keys]), F.col("_epsg")).drop("_epsg")


def clip_images(cells: DataFrame, headers: DataFrame, edges: DataFrame, keys: list[str], poly_keys: list[str]) -> DataFrame:
    """Cells of each raster inside of any of its polygons, every raster on a grid of its own; ``edges`` as of ``edges_of_images``.

    Edges and spans grow with the outlines, and are shuffled whatever size the planner guesses.
    """
    every = list(dict.fromkeys([*keys, *poly_keys]))
    placed = edges.select(*every, *EDGE).hint("merge").join(headers.select(*keys, *geo.AFFINE), keys)
    inside = polygon_spans(placed, every, geo.affine()).select(*keys, "grid_row", "first_col", "last_col")
    return within_spans(cells, inside.hint("merge"), keys, "left_semi")


def mosaic_first(pixels: DataFrame, keys: list[str], rank: Column, nodata: Column) -> DataFrame:
    """Value of the best-ranked raster with data per polygon cell; cells without any are left out."""
    valid = pixels.filter(F.col("value").isNotNull() & (F.col("value") != nodata))
    return valid.groupBy(*keys, "grid_row", "grid_col").agg(F.min_by("value", rank).alias("value"))
