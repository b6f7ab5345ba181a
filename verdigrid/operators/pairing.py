"""Pairing of image and mask files by index, and the choice of a mask mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigrid.functions import names

SYNTHETIC = "synthetic_all4"
CROPPED = "esri_cropped"
NO_LANDUSE = "no_landuse"


def latest_per_idx(files: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """One path per index; of duplicates the last in path order.

    A file whose name has no index is an error; with ``strict=False`` it is left out (``nameless_files`` lists it).
    """
    return (files.withColumn("idx", names.extract_idx(F.col("path"), strict)).filter(F.col("idx").isNotNull())
            .groupBy(*keys, "idx").agg(F.max("path").alias("path")))


def nameless_files(files: DataFrame) -> DataFrame:
    """Files without a usable index, for the audit."""
    return files.filter(names.extract_idx(F.col("path")).isNull())


def pair_by_idx(inputs: DataFrame, masks: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """Images and masks with the same index, in index order."""
    left = latest_per_idx(inputs, keys, strict).withColumnRenamed("path", "input_path")
    right = latest_per_idx(masks, keys, strict).withColumnRenamed("path", "mask_path")
    return left.join(right, [*keys, "idx"]).orderBy(*keys, "idx")


def common_indices(inputs: DataFrame, masks: DataFrame, strict: bool = True) -> DataFrame:
    def index(files: DataFrame) -> DataFrame:
        return files.select(names.extract_idx(F.col("path"), strict).alias("idx")).filter("idx IS NOT NULL")
    return index(inputs).intersect(index(masks))


def unpaired_inputs(inputs: DataFrame, masks: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """Inputs (latest per index) without a mask."""
    left = latest_per_idx(inputs, keys, strict).withColumnRenamed("path", "input_path")
    right = latest_per_idx(masks, keys, strict).select(*keys, "idx")
    return left.join(right, [*keys, "idx"], "left_anti")


def pair_or_synthetic(inputs: DataFrame, masks: DataFrame, keys: list[str],
                      failed: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Pairs per run (``keys``), or every input with a synthetic mask.

    A run falls back when none of its inputs has a mask, or when it is listed in
    ``failed``. In other runs inputs without a mask are left out.
    """
    left = latest_per_idx(inputs, keys, strict).withColumnRenamed("path", "input_path")
    right = latest_per_idx(masks, keys, strict).withColumnRenamed("path", "mask_path")
    if failed is not None:
        right = right.join(failed.select(*keys), keys, "left_anti")
    joined = left.join(right, [*keys, "idx"], "left")
    # one row per run, pre-aggregated and then sent to the files, so no run is gathered in one task
    runs = joined.groupBy(*keys).agg(F.bool_or(F.col("mask_path").isNotNull()).alias("_any"))
    return (joined.join(runs, keys).filter(F.col("mask_path").isNotNull() | ~F.col("_any"))
            .withColumn("mask_mode", F.when(F.col("_any"), CROPPED).otherwise(SYNTHETIC)).drop("_any"))


def natural_sort(files: DataFrame, path: str = "path") -> DataFrame:
    """By the first integer of the stem (0 if there is none), then by path; digits of any length."""
    digits = names.natural_digits(F.col(path))
    return files.orderBy(F.length(digits), digits, path)


def union_tiles(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All tile predictions in one table."""
    for other in others:
        first = first.unionByName(other)
    return first
