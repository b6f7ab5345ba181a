"""Pairing and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.scalars import STEM_SQL, files, r9, affine_literals
from checks.views import SEASONS, duck, edges, land_cover, polygons, view
from verdigrid.functions import names
from verdigrid.operators import pairing, spatial
from verdigrid.plans.crop import crop_by_polygons
from verdigrid.sources import sinks

IDX = f"CAST(regexp_extract({STEM_SQL}, '(\\d+)$', 1) AS BIGINT)"
UNIT = dict(a=1.0, b=0.0, c=0.0, d=0.0, e=1.0, f=0.0)


@check("latest_per_idx", duck(f"SELECT roi, {IDX} AS idx, max(path) AS path FROM v_repeats GROUP BY ALL", "v_repeats"))
def _(spark, sf):
    return pairing.latest_per_idx(view(spark, sf, "v_repeats"), ["roi"])


@check("pair_by_idx", duck(f"""SELECT i.idx, i.path AS input_path, m.path AS mask_path FROM (SELECT {IDX} AS idx, max(path) AS path FROM v_inputs GROUP BY ALL) i
 JOIN (SELECT {IDX} AS idx, max(path) AS path FROM v_masks GROUP BY ALL) m ON i.idx = m.idx""", "v_inputs", "v_masks"))
def _(spark, sf):
    return pairing.pair_by_idx(view(spark, sf, "v_inputs"), view(spark, sf, "v_masks"), [])


_SIDES = dict(i=f"SELECT roi, {IDX} AS idx, max(path) AS input_path FROM v_repeats GROUP BY ALL",
              m=f"SELECT roi, {IDX} AS idx, max(path) AS mask_path FROM v_seg_masks GROUP BY ALL",
              j="SELECT i.*, mask_path, bool_or(mask_path IS NOT NULL) OVER (PARTITION BY i.roi) AS any_mask FROM i LEFT JOIN m ON i.roi = m.roi AND i.idx = m.idx")


@check("pair_or_synthetic", duck("SELECT roi, idx, input_path, mask_path, CASE WHEN any_mask THEN 'esri_cropped' ELSE 'synthetic_all4' END AS mask_mode FROM j WHERE mask_path IS NOT NULL OR NOT any_mask",
                                 "v_repeats", "v_seg_masks", **_SIDES))
def _(spark, sf):
    return pairing.pair_or_synthetic(view(spark, sf, "v_repeats"), view(spark, sf, "v_seg_masks"), ["roi"])


@check("unpaired_inputs", duck("SELECT roi, idx, input_path FROM j WHERE mask_path IS NULL", "v_repeats", "v_seg_masks", **_SIDES))
def _(spark, sf):
    return pairing.unpaired_inputs(view(spark, sf, "v_repeats"), view(spark, sf, "v_seg_masks"), ["roi"])


@check("roi_edges", duck("SELECT poly, ord, round(x0, 9) AS x0, round(y0, 9) AS y0, round(x1, 9) AS x1, round(y1, 9) AS y1 FROM v_edges", "v_poly", "v_edges"))
def _(spark, sf):
    return r9(edges(spark, sf), spatial.EDGE)


_BOUNDS = """SELECT poly, min(x0) AS px0, min(y0) AS py0, max(x0) AS px1, max(y0) AS py1, abs(sum(x0*y1 - x1*y0)/2) AS area FROM v_edges GROUP BY poly"""
_BOXES = "SELECT raster_id, path, nodata, c AS bx0, f AS by0, c + width AS bx1, f + height AS by1 FROM v_tiles"


@check("polygon_area", duck("SELECT poly, round(area, 9) AS area FROM b", "v_poly", "v_edges", b=_BOUNDS))
def _(spark, sf):
    return r9(spatial.polygon_area(edges(spark, sf), ["poly"]), ["area"])


@check("raster_bounds", duck("SELECT raster_id, CAST(bx0 AS DOUBLE) AS bx0, CAST(by0 AS DOUBLE) AS by0, CAST(bx1 AS DOUBLE) AS bx1, CAST(by1 AS DOUBLE) AS by1 FROM x", "v_tiles", x=_BOXES))
def _(spark, sf):
    return spatial.raster_bounds(view(spark, sf, "v_tiles"), ["raster_id"])


@check("pixel_bounds", duck("SELECT raster_id, min(grid_row) AS row0, min(grid_col) AS col0, max(grid_row) AS row1, max(grid_col) AS col1 FROM v_lc GROUP BY raster_id", "v_lc"))
def _(spark, sf):
    return spatial.pixel_bounds(land_cover(spark, sf), ["raster_id"])


def footprints(spark, sf):
    return spatial.raster_bounds(view(spark, sf, "v_tiles"), ["raster_id", "path", "nodata"])


def polygon_boxes(spark, sf):
    return spatial.polygon_bounds(edges(spark, sf), ["poly"])


@check("roi_scene_bounds_join", duck("""SELECT raster_id, path FROM x WHERE EXISTS (SELECT 1 FROM b WHERE px0 <= bx1 AND bx0 <= px1 AND py0 <= by1 AND by0 <= py1)""",
                                     "v_tiles", "v_poly", "v_edges", b=_BOUNDS, x=_BOXES))
def _(spark, sf):
    met = spatial.scenes_meeting_rois(footprints(spark, sf), ["bx0", "by0", "bx1", "by1"], polygon_boxes(spark, sf),
                                      ["px0", "py0", "px1", "py1"])
    return met.select("raster_id", "path")


# common area of polygon and box as a sum over edges, and the iou
_H = "(CASE WHEN {y} <= by0 THEN by0*({y}-by0) WHEN {y} <= by1 THEN ({y}*{y}-by0*by0)/2 ELSE (by1*by1-by0*by0)/2 + by1*({y}-by1) END)"
_TERM = f"""CASE WHEN lo < hi THEN sign(x1-x0) * CASE WHEN abs(m) < 1e-12 THEN least(greatest((ya+yb)/2, by0), by1)*(hi-lo)
 ELSE ({_H.format(y='yb')} - {_H.format(y='ya')})/m END END"""
IOU = f"""SELECT poly, raster_id, path, nodata, inter, inter/(area + (bx1-bx0)*(by1-by0) - inter) AS iou FROM
 (SELECT poly, raster_id, path, nodata, area, bx0, by0, bx1, by1, abs(coalesce(sum({_TERM}), 0)) AS inter FROM
  (SELECT *, y0 + m*(lo-x0) AS ya, y0 + m*(hi-x0) AS yb FROM
   (SELECT e.*, x.*, area, greatest(least(x0, x1), bx0) AS lo, least(greatest(x0, x1), bx1) AS hi, (y1-y0)/nullif(x1-x0, 0) AS m
    FROM b JOIN x ON px0 <= bx1 AND bx0 <= px1 AND py0 <= by1 AND by0 <= py1 JOIN v_edges e ON e.poly = b.poly)) GROUP BY ALL)"""
_SPATIAL = ("v_tiles", "v_poly", "v_edges")


@check("polygon_box_iou", duck("SELECT poly, raster_id, round(inter, 9) AS inter_area, round(iou, 9) AS iou FROM i WHERE iou >= 1e-6", *_SPATIAL, b=_BOUNDS, x=_BOXES, i=IOU))
def _(spark, sf):
    pairs = spatial.iou_join(edges(spark, sf), ["poly"], footprints(spark, sf), ["raster_id"], threshold=1e-6)
    return pairs.select("poly", "raster_id", F.round("inter_area", 9).alias("inter_area"), F.round("iou", 9).alias("iou"))


@check("iou_join", duck("SELECT poly, raster_id, round(iou, 9) AS iou FROM i WHERE iou >= 0.05", *_SPATIAL, b=_BOUNDS, x=_BOXES, i=IOU))
def _(spark, sf):
    pairs = spatial.iou_join(edges(spark, sf), ["poly"], footprints(spark, sf), ["raster_id"], threshold=0.05)
    return pairs.select("poly", "raster_id", F.round("iou", 9).alias("iou"))


@check("rank_candidates", duck("SELECT poly, raster_id, row_number() OVER (PARTITION BY poly ORDER BY round(iou, 9) DESC, path) AS rank FROM i WHERE iou >= 1e-4", *_SPATIAL, b=_BOUNDS, x=_BOXES, i=IOU))
def _(spark, sf):
    pairs = spatial.iou_join(edges(spark, sf), ["poly"], footprints(spark, sf), ["raster_id"])
    named = pairs.withColumn("iou", F.round("iou", 9)).join(view(spark, sf, "v_tiles").select("raster_id", "path"), "raster_id")
    return spatial.rank_candidates(named, ["poly"]).select("poly", "raster_id", "rank")


# crossings of the centre line of a pixel row to the right of the pixel centre
INSIDE = """SELECT poly, grid_row, grid_col, {cols} FROM {cells} c JOIN v_edges e ON (y0 <= c.grid_row + 0.5) <> (y1 <= c.grid_row + 0.5)
 AND c.grid_col + 0.5 < x0 + (c.grid_row + 0.5 - y0)*((x1-x0)/(y1-y0)) GROUP BY ALL HAVING count(*) % 2 = 1"""


@check("pixel_in_polygon", duck("SELECT poly, pixel_id FROM (" + INSIDE.format(cols="pixel_id", cells="v_mask") + ")", "v_poly", "v_edges", "v_mask"))
def _(spark, sf):
    return spatial.pixels_in_polygons(view(spark, sf, "v_mask"), edges(spark, sf), ["poly"]).select("poly", "pixel_id")


@check("clip_to_roi", duck("SELECT DISTINCT pixel_id, cls FROM (" + INSIDE.format(cols="pixel_id, cls", cells="v_mask") + ")", "v_poly", "v_edges", "v_mask"))
def _(spark, sf):
    return spatial.clip_to_rois(view(spark, sf, "v_mask"), edges(spark, sf), ["poly"]).select("pixel_id", "cls")


_PLACED = """SELECT raster_id, path, nodata, value, CAST(f AS BIGINT) + grid_row AS grid_row, CAST(c AS BIGINT) + grid_col AS grid_col FROM v_lc JOIN v_tiles USING (raster_id)"""


@check("mosaic_first", duck("SELECT grid_row, grid_col, arg_min(value, path) AS value FROM p WHERE value <> nodata GROUP BY ALL", "v_lc", "v_tiles", p=_PLACED))
def _(spark, sf):
    headers = view(spark, sf, "v_tiles")
    placed = land_cover(spark, sf).join(headers.select("raster_id", "path", "nodata", "c", "f"), "raster_id").select(
        "path", "nodata", "value", (F.col("grid_row") + F.col("f").cast("bigint")).alias("grid_row"),
        (F.col("grid_col") + F.col("c").cast("bigint")).alias("grid_col"))
    return spatial.mosaic_first(placed, [], F.col("path"), F.col("nodata"))


_CELL = "SELECT poly, grid_row, grid_col, arg_min(value, struct_pack(k := -round(iou, 9), p := path)) AS value FROM s WHERE value <> nodata GROUP BY ALL"


@check("crop_by_polygons", duck("SELECT CAST(poly AS VARCHAR) AS poly_id, grid_row, grid_col, value FROM cell", *_SPATIAL, "v_lc", b=_BOUNDS, x=_BOXES, i=IOU, p=_PLACED,
                                q="SELECT p.*, i.poly, iou FROM p JOIN i USING (raster_id) WHERE iou >= 1e-4",
                                s="""SELECT q.poly, grid_row, grid_col, value, q.path, q.nodata, iou FROM q JOIN v_edges e ON e.poly = q.poly
 AND (y0 <= q.grid_row + 0.5) <> (y1 <= q.grid_row + 0.5) AND q.grid_col + 0.5 < x0 + (q.grid_row + 0.5 - y0)*((x1-x0)/(y1-y0))
 GROUP BY ALL HAVING count(*) % 2 = 1""", cell=_CELL))
def _(spark, sf):
    props = polygons(spark, sf).select("poly", F.create_map(F.lit("name"), F.lit("x")).alias("props"))
    cropped = crop_by_polygons(edges(spark, sf), ["poly"], view(spark, sf, "v_tiles"), land_cover(spark, sf),
                               affine_literals(UNIT), props=props, id_field="id")
    return cropped.select("poly_id", "grid_row", "grid_col", "value")


@check("feature_season_cross", f"""SELECT CAST(c_custkey AS BIGINT) AS poly, CAST(y AS INT) AS season_year, concat('wetlands_1_season', CAST(y AS VARCHAR), '_feat', CAST(c_custkey AS VARCHAR)) AS name
 FROM customer, range({SEASONS[0]}, {SEASONS[1] + 1}) t(y)""")
def _(spark, sf):
    crossed = sinks.feature_seasons(view(spark, sf, "v_poly").select("poly"), *SEASONS)
    name = sinks.stack_name(F.lit("projects/demo/assets/wetlands:1"), F.col("season_year"), F.col("poly"))
    return crossed.withColumn("name", name)


@check("list_rasters", duck(f"SELECT path, {IDX} AS idx FROM (SELECT path FROM v_inputs UNION ALL SELECT path FROM v_masks UNION ALL SELECT replace(path, '.tif', '.tfw') FROM v_inputs) WHERE regexp_matches(lower(path), '\\.tiff?$')",
                            "v_inputs", "v_masks"))
def _(spark, sf):
    from verdigrid.sources.tables import raster_paths
    others = view(spark, sf, "v_inputs").select(F.replace("path", F.lit(".tif"), F.lit(".tfw")).alias("path"))
    listed = raster_paths(files(spark, sf).unionByName(others))
    return listed.select("path", names.extract_idx(F.col("path")).alias("idx"))
