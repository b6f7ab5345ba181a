"""Raster grids as tables: scanning, alignment, tiling, rebuilding and merging.

A raster is one header row (size, affine ``a..f``, epsg) plus pixel rows
(raster keys, grid_row, grid_col, values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from verdigrid.bands import CROPLAND_CLASS, NODATA_LABEL
from verdigrid.functions import crs, geometry as geo

CELL = ["grid_row", "grid_col"]


def attach_header(pixels: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """Pixel rows with their raster's header columns; small header tables are broadcast by the planner or at run time."""
    return pixels.join(headers, keys)


def grid_cells(headers: DataFrame, keys: list[str]) -> DataFrame:
    """Every cell (keys, grid_row, grid_col) of every raster; a row of a raster is listed at a time, rows are spread over tasks."""
    filled = headers.filter((F.col("width") > 0) & (F.col("height") > 0))
    rows = (filled.select(*keys, "width", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("height").cast("bigint") - 1)).alias("grid_row"))
            .repartition(*keys, "grid_row"))
    return rows.select(*keys, "grid_row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("width").cast("bigint") - 1)).alias("grid_col"))


def scan_raster(pixels: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels with flat index and the longitude and latitude of their centres."""
    t = geo.affine()
    x, y = geo.pixel_center(F.col("grid_row"), F.col("grid_col"), t)
    lon, lat = crs.to_lonlat(F.col("_x"), F.col("_y"), F.col("epsg"))
    wide = attach_header(pixels, headers, keys).withColumns({"_x": x, "_y": y})
    flat = geo.flat_index(F.col("grid_row"), F.col("grid_col"), F.col("width"))
    return wide.select(*pixels.columns, flat.alias("flat_idx"), lon.alias("lon"), lat.alias("lat"))


def constant_mask(pixels: DataFrame, keys: list[str], value: int = CROPLAND_CLASS) -> DataFrame:
    """A mask of one class on the grid of the input."""
    return pixels.select(*keys, *CELL, F.lit(value).cast("int").alias("cls"))


def shifted_label(pred: Column) -> Column:
    """The label of a predicted class: labels start at 1, as 0 is nodata."""
    return pred + 1


def filter_class(pixels: DataFrame, mask: DataFrame, keys: list[str], cls: int = CROPLAND_CLASS) -> DataFrame:
    """Pixels whose aligned class is the given one."""
    return pixels.join(mask.filter(F.col("cls") == cls).select(*keys), keys, "left_semi")


def align_nearest(target: DataFrame, target_t: dict[str, Column], mask: DataFrame, mask_t: dict[str, Column],
                  target_epsg: Column | None = None, mask_epsg: Column | None = None,
                  keys: list[str] | None = None) -> DataFrame:
    """Class of the mask cell that holds each target pixel centre, 0 outside of the mask.

    The affine columns are literals or header columns on ``target``, whose
    ``keys`` name the mask raster that belongs to a pixel.
    """
    keys = keys or []
    x, y = geo.pixel_center(F.col("grid_row"), F.col("grid_col"), target_t)
    located = target.withColumns({"_x": x, "_y": y})
    if target_epsg is not None:
        located = crs.reprojected(located, [("_x", "_y")], target_epsg, mask_epsg)
    row, col = geo.cell_of(F.col("_x"), F.col("_y"), mask_t)
    located = located.withColumns({"_src_row": row, "_src_col": col})
    # class cells take few bytes for many rows, which the planner takes for a table small enough to send: shuffled instead
    source = mask.select(*keys, F.col("grid_row").alias("_src_row"), F.col("grid_col").alias("_src_col"), "cls").hint("merge")
    return (located.join(source, [*keys, "_src_row", "_src_col"], "left")
            .select(*target.columns, F.coalesce("cls", F.lit(0)).alias("cls")))


def compare_grids(pairs: DataFrame, left: str = "img_", right: str = "mask_") -> DataFrame:
    """Add ``alignment``: 'equal', 'minor' (same steps, sizes differ by up to 2 in all) or 'misaligned'."""
    def col(prefix: str, name: str) -> Column:
        return F.col(prefix + name)

    def near(name: str) -> Column:
        return geo.close(col(left, name), col(right, name))

    same_crs = col(left, "epsg") == col(right, "epsg")
    dw = F.abs(col(left, "width") - col(right, "width"))
    dh = F.abs(col(left, "height") - col(right, "height"))
    equal = same_crs & (dw == 0) & (dh == 0) & near("a") & near("e") & near("c") & near("f")
    minor = same_crs & (dw + dh <= 2) & near("a") & near("e")
    return pairs.withColumn("alignment", F.when(equal, "equal").when(minor, "minor").otherwise("misaligned"))


def tile_of_pixel(pixels: DataFrame, tile_size: int) -> DataFrame:
    return pixels.withColumns({"tile_row": geo.tile_index(F.col("grid_row"), tile_size),
                               "tile_col": geo.tile_index(F.col("grid_col"), tile_size)})


def tile_windows(headers: DataFrame, keys: list[str], tile_size: int) -> DataFrame:
    """One row per tile: offsets, size (smaller at the far edges) and the shifted affine."""
    last = {n: F.ceil(F.col(n) / tile_size).cast("bigint") - 1 for n in ("width", "height")}
    tiles = (headers.filter((F.col("width") > 0) & (F.col("height") > 0))
             .withColumn("tile_row", F.explode(F.sequence(F.lit(0).cast("bigint"), last["height"])))
             .withColumn("tile_col", F.explode(F.sequence(F.lit(0).cast("bigint"), last["width"])))
             .withColumns({"row_off": F.col("tile_row") * tile_size, "col_off": F.col("tile_col") * tile_size}))
    t = geo.affine()
    return tiles.select(
        *keys, "tile_row", "tile_col", "row_off", "col_off",
        F.least(F.lit(tile_size), F.col("width") - F.col("col_off")).cast("bigint").alias("tile_width"),
        F.least(F.lit(tile_size), F.col("height") - F.col("row_off")).cast("bigint").alias("tile_height"),
        (t["c"] + t["a"] * F.col("col_off") + t["b"] * F.col("row_off")).alias("c"),
        (t["f"] + t["d"] * F.col("col_off") + t["e"] * F.col("row_off")).alias("f"))


def tiles_with_mask(mask: DataFrame, keys: list[str], tile_size: int) -> DataFrame:
    """Tiles in which any class is above 0."""
    return (tile_of_pixel(mask, tile_size).groupBy(*keys, "tile_row", "tile_col")
            .agg(F.bool_or(F.col("cls") > 0).alias("_any")).filter("_any").drop("_any"))


def number_tiles(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Dense 0-based ``tile_no`` in (row, column) order over the given tiles of a raster.

    Two levels: position within a tile row, and the number of tiles in the rows before.
    """
    in_row = Window.partitionBy(*keys, "tile_row").orderBy("tile_col")
    before = Window.partitionBy(*keys).orderBy("tile_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = (tiles.groupBy(*keys, "tile_row").agg(F.count(F.lit(1)).alias("_n"))
            .select(*keys, "tile_row", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (tiles.withColumn("_in_row", F.row_number().over(in_row) - 1).join(rows, [*keys, "tile_row"])
            .withColumn("tile_no", (F.col("_before") + F.col("_in_row")).cast("bigint"))
            .drop("_before", "_in_row"))


def tile_with_mask(pixels: DataFrame, mask: DataFrame, keys: list[str], tile_size: int) -> DataFrame:
    """Pixels of the tiles that hold any class, with the aligned class and the tile number.

    The wide pixel rows are not shuffled for the tile filter where the table of
    kept tiles is small.
    """
    kept = number_tiles(tiles_with_mask(mask, keys, tile_size), keys)
    tiled = tile_of_pixel(pixels, tile_size).join(kept, [*keys, "tile_row", "tile_col"])
    return tiled.join(mask.select(*keys, *CELL, "cls"), [*keys, *CELL], "left") \
        .withColumn("cls", F.coalesce("cls", F.lit(0)))


def tile_image_only(pixels: DataFrame, headers: DataFrame, keys: list[str], tile_size: int) -> DataFrame:
    """All pixels with tile and tile number; the number follows from the header, without a sort."""
    across = F.ceil(F.col("width") / tile_size).cast("bigint")
    numbered = tile_of_pixel(pixels, tile_size).join(
        headers.select(*keys, across.alias("_across")), keys)
    return numbered.withColumn("tile_no", F.col("tile_row") * F.col("_across") + F.col("tile_col")).drop("_across")


def rebuild_grid(grid: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Label of every grid cell, nodata where there is no prediction."""
    label = F.coalesce("label", F.lit(NODATA_LABEL)).cast("smallint").alias("label")
    return grid.select(*keys).join(predictions.select(*keys, "label"), keys, "left").select(*keys, label)


def merge_tiles(grid: DataFrame, tiles: DataFrame, keys: list[str], order: str = "tile_no") -> DataFrame:
    """Place tile pixels (row_off + row, col_off + col); the later tile wins, uncovered cells are nodata."""
    placed = tiles.select(*keys, (F.col("row_off") + F.col("grid_row")).alias("grid_row"),
                          (F.col("col_off") + F.col("grid_col")).alias("grid_col"), order, "label")
    last = placed.groupBy(*keys, *CELL).agg(F.max_by("label", order).alias("label"))
    return rebuild_grid(grid, last, [*keys, *CELL])


def tile_offsets(tiles: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-pixel offsets of tiles from their origins and the reference header."""
    ref = headers.select(*keys, *[F.col(k).alias(f"_{k}") for k in ("a", "c", "e", "f")])
    return (tiles.join(ref, keys)
            .withColumns({"col_off": geo.pixel_offset(F.col("c"), F.col("_c"), F.col("_a")),
                          "row_off": geo.pixel_offset(F.col("f"), F.col("_f"), F.col("_e"))})
            .drop("_a", "_c", "_e", "_f"))
