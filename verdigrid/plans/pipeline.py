"""From scenes, regions and class rasters to written labels and an audit log, in one call."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from verdigrid.bands import BANDS
from verdigrid.functions import geometry as geo
from verdigrid.operators import grid, spatial
from verdigrid.plans import status
from verdigrid.plans.crop import DEFAULT_IOU, crop_by_polygons, crop_candidates, crop_problems
from verdigrid.plans.runs import RUN, run_images
from verdigrid.plans.stack import build_months
from verdigrid.sources import sinks

IMAGE = ["roi", "idx"]


def _kept(df: DataFrame, path: str, *by: str) -> DataFrame:
    """A step as a table of the run's folder: computed once, whatever reads it."""
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def image_names(images: DataFrame, *more: str) -> DataFrame:
    """(roi, season_year, path) of the stacks, relative to the run's folder, and further columns."""
    text = [F.col(c).cast("string") for c in ("season_year", "idx")]
    return images.select(*RUN, *more, F.concat(F.lit("stack/"), "roi", F.lit("/season"), text[0], F.lit("_feat"), text[1]).alias("path"))


def cover_names(images: DataFrame) -> DataFrame:
    """(roi, season_year, path) of the class rasters cropped to the images' polygons."""
    return images.select(*RUN, F.concat(F.lit("cover/"), "roi", F.lit("/poly_"), F.col("idx").cast("string")).alias("path"))


def run_pipeline(s2: DataFrame, s1: DataFrame, headers: DataFrame, edges: DataFrame, cover_headers: DataFrame,
                 cover_pixels: DataFrame, cover_grid: dict[str, Column], cover_epsg: int, weights: dict[str, np.ndarray],
                 n_classes: int, first_year: int, last_year: int, out: str, tile_size: int | None = None,
                 threshold: float = DEFAULT_IOU, fitted: PipelineModel | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(labels, audit rows), read back from the folder ``out``.

    ``headers`` has one row per image (roi, idx, width, height, affine, epsg), ``edges`` its polygon (roi, idx, edge ends,
    epsg) in any system, the scenes are keyed by roi, idx, grid_row, grid_col, and ``cover_*`` are class rasters as for
    ``crop_by_polygons``. For every image and season: cells inside of its polygon, monthly medians of both sensors, classes
    cropped to the polygon and aligned to the image, pairing, scoring, full label grids and an audit row with the image's
    status. Medians, cells with their classes, labels and audit rows are each written once and read from there. ``options`` go to ``build_months``.

    One image's fault does not end the run. An image with a broken header or polygon is set aside (the table ``rejected`` of the folder) and
    has an audit row with the reason for every season; one whose class rasters cannot be cropped is scored on a synthetic mask, and
    a class raster with a broken header has an audit row of its own, without an image.
    """
    spark = s2.sparkSession
    keys = [*IMAGE, *grid.CELL]
    wanted, all_cover = headers, cover_headers
    edges = _kept(edges, f"{out}/polygons")
    rejected = _kept(status.image_problems(headers, edges, IMAGE), f"{out}/rejected")
    broken_cover = _kept(status.header_problems(cover_headers.withColumn("epsg", F.lit(cover_epsg)), ["raster_id"]), f"{out}/rejected_cover")
    headers, cover_headers = status.usable(headers, rejected, IMAGE), status.usable(cover_headers, broken_cover, ["raster_id"])
    edges = edges.join(headers.select(*IMAGE), IMAGE, "left_semi")
    listed = grid.grid_cells(headers, IMAGE)
    own_edges = _kept(spatial.edges_of_images(edges, headers, IMAGE, IMAGE), f"{out}/edges")
    inside = spatial.clip_images(listed, headers, own_edges, IMAGE, IMAGE)
    cube = _kept(build_months(s2, s1, inside, keys, first_year, last_year, **options), f"{out}/cube", "season_year")

    shapes = _kept(spatial.reproject_edges(edges, F.lit(cover_epsg)), f"{out}/cover_edges")
    candidates = crop_candidates(shapes, IMAGE, cover_headers, cover_grid, threshold)
    cover = _kept(crop_by_polygons(shapes, IMAGE, cover_headers, cover_pixels, cover_grid, threshold, candidates=candidates)
                  .select(*keys, F.col("value").alias("cls")), f"{out}/cover")
    placed = grid.attach_header(grid.scan_raster(listed, headers, IMAGE), headers.select(*IMAGE, *geo.AFFINE, "epsg"), IMAGE)
    aligned = grid.align_nearest(placed, geo.affine(), cover, cover_grid, F.col("epsg"), F.lit(cover_epsg), IMAGE)
    cells = _kept(aligned.select(*keys, "lat", "lon", "cls"), f"{out}/cells")

    def by_season(df: DataFrame) -> DataFrame:
        return sinks.feature_seasons(df, first_year, last_year)

    images = by_season(headers.select(*IMAGE, "width", "height"))
    masks = cover_names(by_season(cover.select(*IMAGE).distinct()))
    aside = by_season(rejected)
    aside = image_names(aside, "idx", "error").withColumnsRenamed({"path": "input_path"}).withColumn("mask_path", F.lit(None).cast("string"))
    predictions, audit = run_images(by_season(wanted.select(*IMAGE).dropna()).select(*RUN).distinct(), image_names(images), masks, by_season(cells.drop("cls")), cube,
                                    by_season(cells.select(*keys, "cls")), weights, n_classes, options.get("bands", BANDS),
                                    tile_size=tile_size, fitted=fitted, crop_errors=by_season(crop_problems(candidates, IMAGE)), rejected=aside)
    no_image = {"timestamp": F.current_timestamp(), "mask_path": F.coalesce("path", F.col("raster_id").cast("string")), "error": F.col("error")}
    of_cover = broken_cover.join(all_cover.select("raster_id", "path").dropDuplicates(["raster_id"]), "raster_id", "left")
    sinks.append_audit(audit.unionByName(of_cover.select(*[no_image.get(n, F.lit(None)).cast(t).alias(n) for n, t in sinks.AUDIT_FIELDS])), f"{out}/audit", "run")
    written = sinks.read_audit(spark, f"{out}/audit")
    scored = written.filter("nonfinite_pct IS NOT NULL").select("roi", F.col("year").alias("season_year"), "idx")
    sinks.write_predictions(predictions, images.join(scored, [*RUN, "idx"], "left_semi"), f"{out}/predictions")
    return spark.read.schema(predictions.schema).parquet(f"{out}/predictions/labels"), written
