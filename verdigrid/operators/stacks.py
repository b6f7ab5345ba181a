"""Stacked rasters whose bands are named per raster: names in the header tables, values as one array per pixel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigrid.bands import BANDS, FILL_BAND, MONTHS, WIDE_BANDS
from verdigrid.functions import names as band_names


def resolved_names(names: Column, width: Column) -> Column:
    """The names of a raster's ``width`` bands: those given, and the one of the position where a name or the whole list is missing."""
    unnamed = F.coalesce(~F.exists(names, lambda n: n.isNotNull()), F.lit(True))
    places = F.when(width > 0, F.sequence(F.lit(0), width.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.coalesce(F.get(names, p), band_names.default_band_name(p, unnamed)))


def listed_problems(names: Column, width: Column) -> Column:
    """Array of (position, name, problem): bands without a place in the cube; position and name are NULL for the whole raster.

    The fill band is no problem. A raster without any name is one unless it has as many bands as the stack, with or without fill band.
    """
    of_band = F.transform(resolved_names(names, width), lambda n, p: F.struct(
        p.alias("position"), n.alias("name"), F.when(n == FILL_BAND, "ok").otherwise(band_names.band_status(n)).alias("problem")))
    given = F.exists(names, lambda n: n.isNotNull())
    whole = (F.when(width.isNull(), "no band count")
             .when(~F.coalesce(given, F.lit(False)), F.when(~width.isin(len(WIDE_BANDS), len(WIDE_BANDS) + 1), "no names"))
             .when(F.size(names) != width, "names and bands differ in number"))
    of_raster = F.struct(F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("name"), whole.alias("problem"))
    return F.concat(F.filter(F.array(of_raster), lambda x: x["problem"].isNotNull()),
                    F.coalesce(F.filter(of_band, lambda x: x["problem"] != "ok"), F.array()))


def raster_name_problems(headers: DataFrame, keys: list[str], names: str = "band_names", width: str = "n_bands") -> DataFrame:
    """(keys, position, name, problem) of every band that cannot be placed, and of rasters whose list of names does not fit."""
    return headers.select(*keys, F.inline(listed_problems(F.col(names), F.col(width))))


def stack_problems(headers: DataFrame, keys: list[str], names: str = "band_names", width: str = "n_bands") -> DataFrame:
    """(keys, error) of the rasters that a strict reading refuses, each with its first problem; for ``plans.status.usable``."""
    # listed by an outer generator: a filter on the list itself would be pushed below, and the names placed a second time
    found = headers.select(*keys, F.posexplode_outer(listed_problems(F.col(names), F.col(width))).alias("_at", "_found")).filter("_at = 0")
    return found.select(*keys, F.concat_ws(": ", F.col("_found.problem"), F.col("_found.name")).alias("error"))


def band_places(resolved: Column) -> Column:
    """For each of the 168 stacked bands, month by month, the 0-based position of its value among the ``resolved`` names, NULL if the raster has none.

    Of several bands of one name the last counts. Every name is looked up among the stacked ones once, and the bands among the numbers found.
    """
    wanted = F.array(*[F.lit(n) for n in WIDE_BANDS])
    backwards = F.transform(F.reverse(resolved), lambda n: F.array_position(wanted, n))
    bands = F.sequence(F.lit(1).cast("bigint"), F.lit(len(WIDE_BANDS)).cast("bigint"))

    def placed(of: Column) -> Column:
        return F.transform(bands, lambda k: F.when(F.array_contains(of, k), (F.size(of) - F.array_position(of, k)).cast("int")))

    return F.transform(F.array(backwards), placed)[0]  # a lambda's variable: the numbers are found once, not once a band


def _located(pixels: DataFrame, headers: DataFrame, keys: list[str], strict: bool, values: str, names: str, width: str) -> DataFrame:
    """``pixels`` with ``_places`` of their raster's header; in a strict call, of a pixel without fault only."""
    # the names and what is wrong with them are columns of their own, used more than once and so reckoned once
    named = headers.select(*keys, F.col(width).alias("_width"), resolved_names(F.col(names), F.col(width)).alias("_names"),
                           listed_problems(F.col(names), F.col(width)).alias("_found"))
    placed = named.select(*keys, band_places(F.col("_names")).alias("_places"), "_width",
                          F.when(F.size("_found") > 0, F.concat_ws(": ", F.col("_found")[0]["problem"], F.col("_found")[0]["name"])).alias("_problem"))
    joined = pixels.join(placed, keys, "left")
    places = F.col("_places")
    if strict:
        wrong = (F.when(places.isNull(), "raster without header").when(F.col("_problem").isNotNull(), F.col("_problem"))
                 .when(F.coalesce(F.size(values), F.lit(-1)) != F.col("_width"), "a pixel's values and the bands differ in number"))
        places = F.when(wrong.isNull(), places).otherwise(F.raise_error(wrong).cast("array<int>"))
    return joined.select(*pixels.columns, places.alias("_places"))


def raster_months(pixels: DataFrame, headers: DataFrame, keys: list[str], strict: bool = True, values: str = "values",
                  names: str = "band_names", width: str = "n_bands") -> DataFrame:
    """``pixels`` with ``months``, twelve structs of the 14 bands, in place of the array ``values``.

    ``headers`` has one row per raster (``keys``) with the names of its bands, in any order. Names are placed once per
    raster; a pixel picks its values by position. A band that its raster lacks is NULL. A strict call fails on a raster with
    a problem or without a header, and on a pixel with another number of values; a lenient one leaves out what it cannot place.
    """
    located = _located(pixels, headers, keys, strict, values, names, width)
    months = F.transform(F.array(*[F.lit((m - 1) * len(BANDS)) for m in MONTHS]), lambda at: F.struct(*[
        F.get(F.col(values), F.get(F.col("_places"), at + i)).cast("double").alias(b) for i, b in enumerate(BANDS)]))
    return located.select(*[c for c in pixels.columns if c != values], months.alias("months"))


def unstack_rasters(pixels: DataFrame, headers: DataFrame, keys: list[str], strict: bool = True, values: str = "values",
                    names: str = "band_names", width: str = "n_bands") -> DataFrame:
    """The long form of ``raster_months``: one row per pixel and month with the 14 bands.

    A pixel's row is repeated by month first and each picks its bands, in compiled code: no nested months are built.
    """
    located = _located(pixels, headers, keys, strict, values, names, width)
    others = [c for c in pixels.columns if c != values]
    by_month = located.select(*others, F.col(values).alias("_values"), "_places", F.explode(F.array(*[F.lit(m) for m in MONTHS])).alias("month"))
    first = (F.col("month") - 1) * len(BANDS)
    return by_month.select(*others, "month", *[F.get("_values", F.get("_places", first + i)).cast("double").alias(b) for i, b in enumerate(BANDS)])
