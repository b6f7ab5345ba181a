"""File, band and index names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from verdigrid.bands import BANDS, FILL_BAND


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def path_stem(path: Column) -> Column:
    """File name without folder and last suffix."""
    return F.regexp_replace(file_name(path), r"^(.+)\.[^.]+$", "$1")


def asset_name(asset: Column) -> Column:
    """Last part of a remote asset id, with ``:`` made safe for a file name."""
    return F.replace(file_name(asset), F.lit(":"), F.lit("_"))


def is_raster(path: Column) -> Column:
    return F.lower(path).rlike(r"\.tiff?$")


def extract_idx(path: Column, strict: bool = False) -> Column:
    """Integer at the end of the stem; without one, or if it is too long for a 64-bit integer, NULL, or an error when ``strict``."""
    idx = F.nullif(F.regexp_extract(path_stem(path), r"(\d+)$", 1), F.lit("")).try_cast("bigint")
    if not strict:
        return idx
    return F.when(idx.isNotNull(), idx).otherwise(
        F.raise_error(F.concat(F.lit("no index in file name: "), path)).cast("bigint"))


def natural_digits(path: Column) -> Column:
    """First run of digits in the stem without leading zeros, '' for 0 or none."""
    return F.regexp_replace(F.regexp_extract(path_stem(path), r"(\d+)", 1), "^0+", "")


def tag_band(month: Column, band: Column) -> Column:
    return F.format_string("M%02d_%s", month, band)


def strip_index_prefix(name: Column) -> Column:
    """Drop the first ``_`` token."""
    return F.regexp_replace(name, r"^[^_]*_?", "")


def band_month(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^M(\d{2})_(.+)$", 1), F.lit("")).cast("int")


def band_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^M(\d{2})_(.+)$", 2), F.lit(""))


def band_status(name: Column) -> Column:
    """'ok', or why a stacked band name cannot be placed in the (month, band) cube."""
    return (F.when(~name.rlike(r"^M\d{2}_.+$"), "bad_format")
            .when(~name.rlike(r"^M(0[1-9]|1[0-2])_"), "bad_month_range")
            .when(~name.rlike(f"^M.._({'|'.join(BANDS)})$"), "unknown_band")
            .otherwise("ok"))


def default_band_name(position: Column, all_missing: Column) -> Column:
    """Name of an unnamed band from its 0-based position.

    The 169th band is the fill mask when no band of the file has a name; other
    positions past the cube get ``B<n>``.
    """
    width = len(BANDS)
    month = F.floor(position / width).cast("int") + 1
    band = F.element_at(F.array(*[F.lit(b) for b in BANDS]), (position % width + 1).cast("int"))
    return (F.when(position < 12 * width, tag_band(month, band))
            .when(all_missing & (position == 12 * width), F.lit(FILL_BAND))
            .otherwise(F.concat(F.lit("B"), (position + 1).cast("string"))))
