"""Readers: scene tables, region polygons, raster files and raster tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigrid.bands import S1_CODES, S2_BANDS, S2_CODES
from verdigrid.functions import names
from verdigrid.skew import running_total

# The fields of a GeoJSON feature that are read, and the coordinates of the geometries that have rings.
FEATURE = [("type", "string"), ("properties", "map<string, string>"),
           ("geometry", "struct<type: string, coordinates: string>")]
COORDINATES = {"Polygon": "array<array<array<double>>>", "MultiPolygon": "array<array<array<array<double>>>>"}
FEATURE_COLUMNS = ", ".join(f"{name} {kind}" for name, kind in FEATURE)
FEATURE_STRUCT = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in FEATURE) + ">"


def rename_bands(scenes: DataFrame, codes: list[str] = S2_CODES, bands: list[str] = S2_BANDS) -> DataFrame:
    """Band codes replaced by names; other columns stay."""
    return scenes.withColumnsRenamed(dict(zip(codes, bands)))


def scan_s2_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Optical observations from Parquet. Filters on a partition column skip folders, those on the date skip row groups."""
    return rename_bands(spark.read.parquet(path))


def scan_s1_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Radar observations from Parquet, values in dB."""
    return rename_bands(spark.read.parquet(path), S1_CODES, ["vv_db", "vh_db"])


def load_rois(spark: SparkSession, path: str, per_line: bool = True) -> DataFrame:
    """Region polygons (feat_idx, props, rings) of GeoJSON.

    ``per_line``: one feature per line, which Spark splits; feat_idx is the order by
    file and position. Otherwise each file is one FeatureCollection, read by one task.
    Polygons carry their rings and multipolygons those of all parts; a feature without either has NULL rings. A line that
    is no feature and coordinates that do not fit their geometry are errors.
    """
    if per_line:
        read = spark.read.schema(FEATURE_COLUMNS).option("mode", "FAILFAST").json(path)
        features = read.select("*", F.col("_metadata.file_path").alias("_file"),
                               F.col("_metadata.file_block_start").alias("_block"),
                               F.monotonically_increasing_id().alias("_pos"))
        order = [F.col("_file"), F.col("_block"), F.col("_pos")]
        numbered = running_total(features.withColumn("_all", F.lit(0)), ["_all"], order,
                                 F.lit(1).cast("bigint"), "_no")
        return _rings(numbered.withColumn("feat_idx", (F.col("_no") - 1).cast("int")))
    read = spark.read.schema(f"features array<{FEATURE_STRUCT}>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return _rings(read.select(F.posexplode("features").alias("feat_idx", "_f"))
                  .select("feat_idx", "_f.type", "_f.properties", "_f.geometry"))


def _rings(features: DataFrame) -> DataFrame:
    kind, raw = F.col("geometry.type"), F.col("geometry.coordinates")
    parts = {k: F.from_json(F.concat(F.lit('{"c":'), raw, F.lit("}")), f"c {schema}")["c"] for k, schema in COORDINATES.items()}
    rings = F.when(kind == "Polygon", parts["Polygon"]).when(kind == "MultiPolygon", F.flatten(parts["MultiPolygon"]))
    wrong = F.raise_error(F.concat(F.lit("coordinates do not fit their geometry in feature "), F.col("feat_idx").cast("string")))
    points = F.transform(F.coalesce(rings, wrong.cast("array<array<array<double>>>")), lambda ring: F.transform(
        ring, lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y"))))
    return features.select("feat_idx", F.col("properties").alias("props"), F.when(kind.isin(list(COORDINATES)), points).alias("rings"))


def list_rasters(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all .tif and .tiff files below a folder, sorted; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return raster_paths(files)


def raster_paths(files: DataFrame) -> DataFrame:
    return files.select("path").filter(names.is_raster(F.col("path"))).orderBy("path")
