"""The whole run: scenes, polygons and class rasters to labels and audit rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.scalars import MONTH_SQL, YEAR_SQL, affine_literals
from checks.scoring import S1_OK, S2_OK
from checks.tiling import HEADERS, IMAGE, headers
from checks.views import RASTER_ID, duck, s1, view
from verdigrid.functions import crs
from verdigrid.plans import inference, pipeline
from verdigrid.scoring.weights import sine_weights
from verdigrid.session import scratch_path
from verdigrid.sources import tables

# the seasons of the data count as later ones, so that two have a land-cover product and two have none
FIRST, LAST, SHIFT = 2015, 2018, 21
COVER_GRID = dict(a=0.02, b=0.0, c=20.0, d=0.0, e=-0.02, f=50.0)
_PIXEL = RASTER_ID.replace("p_partkey", "pixel_id")

# polygons are left of the line from column 40.5 at the top to 30.5 at the bottom; class cells are 2 x 2 pixels
_SQL = f"""SELECT i.roi, i.season_year AS year, CAST(i.idx AS INT) AS idx, concat('stack/', i.roi, '/season', CAST(i.season_year AS VARCHAR), '_feat', CAST(i.idx AS VARCHAR)) AS input_path,
 CASE WHEN ok THEN concat('cover/', i.roi, '/poly_', CAST(i.idx AS VARCHAR)) END AS mask_path, NOT ok AS landuse_failed,
 CASE WHEN ok THEN 'esri_cropped' ELSE 'synthetic_all4' END AS mask_mode,
 CASE WHEN i.season_year < 2017 THEN concat('no land cover for ', CAST(i.season_year AS VARCHAR)) WHEN NOT ok THEN 'no matching indices of inputs and masks' END AS error,
 round(100.0*(12*(12*sum(CAST(inside AS INT)) - sum(coalesce(n2, 0))) + 2*(12*sum(CAST(inside AS INT)) - sum(coalesce(n1, 0))))/(168*sum(CAST(inside AS INT))), 9) AS nonfinite_pct,
 CAST(sum(CAST(inside AND (NOT ok OR coalesce(cls, 0) = 4) AND coalesce(n2, 0) > 0 AND coalesce(n1, 0) > 0 AS INT)) AS BIGINT) AS n_labelled, count(*) AS n_cells
 FROM i JOIN grid USING (roi, idx) LEFT JOIN lc ON lc.roi = i.roi AND lc.idx = i.idx AND r2 = grid_row - grid_row % 2 AND c2 = grid_col - grid_col % 2
 LEFT JOIN seen s ON inside AND s.roi = i.roi AND s.idx = i.idx AND s.grid_row = grid.grid_row AND s.grid_col = grid.grid_col AND s.season_year = i.season_year
 WHERE NOT ok OR has_mask GROUP BY ALL"""
_TABLES = dict(
    h=HEADERS,
    grid="SELECT roi, idx, r AS grid_row, k AS grid_col, k + 0.5 < 40 - r AS inside FROM h, range(10) t(r), range(50) u(k) WHERE r < height AND k < width",
    lc="SELECT roi, idx, grid_row AS r2, grid_col AS c2, cls FROM v_cells WHERE grid_row % 2 = 0 AND grid_col % 2 = 0 AND cls <> 0 AND grid_col + 1 < 39.5 - grid_row",
    n=f"SELECT h.roi, h.idx, CAST(y AS INT) AS season_year, (h.roi, h.idx) IN (SELECT (roi, idx) FROM lc) AS has_mask FROM h, range({FIRST}, {LAST + 1}) t(y)",
    i="SELECT *, season_year >= 2017 AND bool_or(has_mask) OVER (PARTITION BY roi, season_year) AS ok FROM n",
    o=" UNION ALL ".join(f"SELECT pixel_id, {sensor} AS sensor, {YEAR_SQL.format(d='ts')} + {SHIFT} AS season_year, {MONTH_SQL.format(d='ts')} AS month FROM {name} WHERE {ok}"
                         for sensor, name, ok in ((2, "v_s2", S2_OK), (1, "v_s1", S1_OK))),
    seen="""SELECT roi, idx, grid_row, grid_col, season_year, count(DISTINCT CASE WHEN sensor = 2 THEN month END) AS n2, count(DISTINCT CASE WHEN sensor = 1 THEN month END) AS n1
 FROM o JOIN v_cells USING (pixel_id) GROUP BY ALL""")


def image_scenes(scenes):
    """Observations keyed by image and cell, in the later seasons."""
    keyed = scenes.withColumns({"roi": F.expr(f"concat('roi_', CAST({_PIXEL} % 3 AS STRING))"), "idx": F.expr(_PIXEL), "grid_row": F.col("grid_row") % 10})
    return keyed.withColumn("ts", F.add_months("ts", 12 * SHIFT)).withColumn("year", F.year("ts"))


def image_polygons(images):
    """One polygon per image, in web mercator."""
    corners = [(0.0, 0.0), (40.5, 0.0), (30.5, 10.0), (0.0, 10.0)]
    ends = [crs.from_lonlat(F.col("c") + F.col("a") * col, F.col("f") + F.col("e") * row, F.lit(3857)) for col, row in corners]
    sides = [F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")) for (x0, y0), (x1, y1) in zip(ends, ends[1:] + ends[:1])]
    return images.select(*IMAGE, F.lit(3857).alias("epsg"), F.inline(F.array(*sides)))


# of five images one has no size, one no polygon, one a class raster of other steps, one an unknown coordinate system
_FAULTS = """CASE idx % 5 WHEN 0 THEN 'broken header: no size' WHEN 1 THEN 'polygon without edges' WHEN 2 THEN concat('steps differ from the grid: raster ', CAST(idx AS VARCHAR))
 WHEN 4 THEN 'unsupported EPSG code 9999' END"""
_FAULTS_SQL = f"""SELECT i.roi, CAST(i.season_year AS INT) AS year, CAST(i.idx AS INT) AS idx, concat('stack/', i.roi, '/season', CAST(i.season_year AS VARCHAR), '_feat', CAST(i.idx AS VARCHAR)) AS input_path,
 CASE WHEN aside THEN NULL WHEN ok THEN 'esri_cropped' ELSE 'synthetic_all4' END AS mask_mode, CASE WHEN aside THEN NULL ELSE NOT ok END AS landuse_failed,
 CASE WHEN fault IS NOT NULL THEN fault WHEN NOT ok THEN 'no matching indices of inputs and masks' END AS error,
 CAST(CASE WHEN NOT aside THEN sum(CAST(inside AND (NOT ok OR coalesce(cls, 0) = 4) AND coalesce(n2, 0) > 0 AND coalesce(n1, 0) > 0 AS INT)) END AS BIGINT) AS n_labelled,
 CASE WHEN NOT aside THEN count(*) END AS n_cells
 FROM i JOIN grid USING (roi, idx) LEFT JOIN lc ON lc.roi = i.roi AND lc.idx = i.idx AND r2 = grid_row - grid_row % 2 AND c2 = grid_col - grid_col % 2
 LEFT JOIN seen s ON inside AND s.roi = i.roi AND s.idx = i.idx AND s.grid_row = grid.grid_row AND s.grid_col = grid.grid_col AND s.season_year = i.season_year
 WHERE aside OR NOT ok OR has_mask GROUP BY i.roi, i.season_year, i.idx, aside, ok, fault"""
_FAULT_TABLES = {**_TABLES,
                 "lc": _TABLES["lc"] + " AND idx % 5 = 3",
                 "n": f"SELECT h.roi, h.idx, {LAST} AS season_year, (h.roi, h.idx) IN (SELECT (roi, idx) FROM lc) AS has_mask, {_FAULTS} AS fault FROM h",
                 "i": """SELECT *, coalesce(idx % 5 <> 2 AND fault IS NOT NULL, false) AS aside,
 idx % 5 <> 2 AND bool_or(has_mask) OVER (PARTITION BY roi, season_year) AS ok FROM n"""}


def cover_tables(spark, sf, images):
    """Class rasters of 2 x 2 pixels a cell, one for each image: (headers, cells)."""
    coarse = view(spark, sf, "v_cells").filter("grid_row % 2 = 0 AND grid_col % 2 = 0").selectExpr(
        "idx AS raster_id", "CAST(grid_row/2 AS BIGINT) AS grid_row", "CAST(grid_col/2 AS BIGINT) AS grid_col", "cls AS value")
    placed = images.select(F.col("idx").alias("raster_id"), F.concat(F.lit("/lc/"), F.col("idx").cast("string")).alias("path"), F.lit(25).alias("width"),
                           F.lit(5).alias("height"), *[F.lit(v).alias(k) for k, v in COVER_GRID.items() if k != "f"], "f", F.lit(0.0).alias("nodata"))
    return placed, coarse


@check("run_with_faults", duck(_FAULTS_SQL, "v_cells", "v_s2", "v_s1", **_FAULT_TABLES))
def _(spark, sf):
    """Audit rows and counts of labelled cells of a run of one season in which most images are faulty."""
    images = headers(spark, sf)
    kind = F.col("idx") % 5
    faulty = images.withColumns({"width": F.when(kind != 0, F.col("width")), "epsg": F.when(kind == 4, 9999).otherwise(F.col("epsg"))})
    cover_headers, coarse = cover_tables(spark, sf, images)
    foreign = cover_headers.withColumn("e", F.when(F.col("raster_id") % 5 == 2, F.col("e") * 0.75).otherwise(F.col("e")))
    labels, audit = pipeline.run_pipeline(
        tables.rename_bands(image_scenes(view(spark, sf, "v_s2"))), image_scenes(s1(spark, sf)), faulty, image_polygons(images).filter("idx % 5 <> 1"), foreign, coarse,
        affine_literals(COVER_GRID), 4326, sine_weights(inference.model_shapes(2)), 2, LAST, LAST, scratch_path(spark, "faults"), year="year")
    counts = labels.groupBy("roi", F.col("season_year").alias("year"), "idx").agg(
        F.sum((F.col("label") > 0).cast("bigint")).alias("n_labelled"), F.count(F.lit(1)).alias("n_cells"))
    return audit.join(counts, ["roi", "year", "idx"], "left").select("roi", "year", "idx", "input_path", "mask_mode", "landuse_failed", "error", "n_labelled", "n_cells")


@check("run_pipeline", duck(_SQL, "v_cells", "v_s2", "v_s1", **_TABLES))
def _(spark, sf):
    """Audit rows and counts of labelled cells per image and season of a whole run."""
    images = headers(spark, sf)
    out = scratch_path(spark, "run")
    image_scenes(view(spark, sf, "v_s2")).write.partitionBy("year").parquet(f"{out}-s2")
    image_scenes(s1(spark, sf)).write.partitionBy("year").parquet(f"{out}-s1")
    cover_headers, coarse = cover_tables(spark, sf, images)
    labels, audit = pipeline.run_pipeline(
        tables.scan_s2_scenes(spark, f"{out}-s2"), spark.read.parquet(f"{out}-s1"), images, image_polygons(images), cover_headers, coarse,
        affine_literals(COVER_GRID), 4326, sine_weights(inference.model_shapes(2)), 2, FIRST, LAST, out, tile_size=16, year="year")
    counts = labels.groupBy("roi", F.col("season_year").alias("year"), "idx").agg(
        F.sum((F.col("label") > 0).cast("bigint")).alias("n_labelled"), F.count(F.lit(1)).alias("n_cells"))
    return audit.join(counts, ["roi", "year", "idx"], "left").select(
        "roi", "year", "idx", "input_path", "mask_path", "landuse_failed", "mask_mode", "error", F.round("nonfinite_pct", 9).alias("nonfinite_pct"), "n_labelled", "n_cells")
