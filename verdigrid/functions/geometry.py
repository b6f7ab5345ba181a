"""Affine grids, boxes and polygon edges as column expressions.

An affine header is six columns ``a b c d e f``:
``x = a*col + b*row + c`` and ``y = d*col + e*row + f``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

AFFINE = ["a", "b", "c", "d", "e", "f"]


def affine(prefix: str = "") -> dict[str, Column]:
    return {k: F.col(f"{prefix}{k}") for k in AFFINE}


def pixel_center(row: Column, col: Column, t: dict[str, Column]) -> tuple[Column, Column]:
    x = t["c"] + t["a"] * (col + 0.5) + t["b"] * (row + 0.5)
    y = t["f"] + t["d"] * (col + 0.5) + t["e"] * (row + 0.5)
    return x, y


def to_pixel_space(x: Column, y: Column, t: dict[str, Column]) -> tuple[Column, Column]:
    """Inverse affine: fractional (row, col) of a position."""
    det = t["a"] * t["e"] - t["b"] * t["d"]
    dx, dy = x - t["c"], y - t["f"]
    return (t["a"] * dy - t["d"] * dx) / det, (t["e"] * dx - t["b"] * dy) / det


def cell_of(x: Column, y: Column, t: dict[str, Column]) -> tuple[Column, Column]:
    """Integer (row, col) of the pixel that holds a position."""
    row, col = to_pixel_space(x, y, t)
    return F.floor(row).cast("bigint"), F.floor(col).cast("bigint")


def pixel_offset(tile_origin: Column, ref_origin: Column, step: Column) -> Column:
    """Whole-pixel offset, halves rounded to even."""
    return F.rint((tile_origin - ref_origin) / step).cast("bigint")


def flat_index(row: Column, col: Column, width: Column) -> Column:
    return (row * width + col).cast("bigint")


def row_of_flat(flat: Column, width: Column) -> Column:
    return F.floor(flat / width).cast("bigint")


def col_of_flat(flat: Column, width: Column) -> Column:
    return (flat % width).cast("bigint")


def tile_index(cell: Column, tile_size: int) -> Column:
    return F.floor(cell / tile_size).cast("bigint")


def bounds(width: Column, height: Column, t: dict[str, Column]) -> list[Column]:
    """Footprint box (x0, y0, x1, y1) of a raster."""
    xs = [t["c"] + t["a"] * w + t["b"] * h for w in (F.lit(0), width) for h in (F.lit(0), height)]
    ys = [t["f"] + t["d"] * w + t["e"] * h for w in (F.lit(0), width) for h in (F.lit(0), height)]
    return [F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)]


def close(a: Column, b: Column) -> Column:
    """Equal within absolute 1e-8 plus relative 1e-5 of ``b``."""
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)


def shoelace_term(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Sums over the edges of a ring to its signed area."""
    return (x0 * y1 - x1 * y0) / 2.0


def clipped_area_terms(df: DataFrame, edge: list[str], box: list[str], name: str) -> DataFrame:
    """Add the part of a directed edge in the area of its polygon inside a box.

    The area under the edge, above the lower side of the box and clamped to the
    box; summed over the edges of a polygon its absolute value is the area of
    polygon and box in common. NULL when the edge does not pass over the box.
    Computed in steps, so that no single generated method becomes too large to compile.
    """
    ax, ay, bx, by = [F.col(c) for c in edge]
    x0, y0, x1, y1 = [F.col(c) for c in box]
    height = y1 - y0
    lo, hi, slope, ha, hb = [F.col(f"_{c}") for c in ("lo", "hi", "slope", "ha", "hb")]

    def clamp(h: Column) -> Column:
        return F.least(F.greatest(h, F.lit(0.0)), height)

    def under(h: Column) -> Column:
        return clamp(h) * clamp(h) / 2.0 + height * F.greatest(h - height, F.lit(0.0))

    flat = F.abs(slope) < 1e-12
    area = F.when(flat, clamp((ha + hb) / 2.0) * (hi - lo)).otherwise(
        (under(hb) - under(ha)) / F.when(flat, 1.0).otherwise(slope))
    steps = (df.withColumns({"_lo": F.greatest(F.least(ax, bx), x0), "_hi": F.least(F.greatest(ax, bx), x1),
                             "_slope": (by - ay) / F.nullif(bx - ax, F.lit(0.0))})
             # heights over the lower box side, so that small slopes keep their digits
             .withColumns({"_ha": ay - y0 + slope * (lo - ax), "_hb": ay - y0 + slope * (hi - ax)}))
    return (steps.withColumn(name, F.when((lo < hi) & (ax != bx), F.when(bx > ax, area).otherwise(-area)))
            .drop("_lo", "_hi", "_slope", "_ha", "_hb"))
