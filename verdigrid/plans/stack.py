"""From scene tables to the monthly cube and the 168-band stack."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigrid.bands import BANDS, MAX_CLOUD_PCT, S1_BANDS, S2_BANDS, SEASON_START_MONTH
from verdigrid.functions.calendar import season_bounds
from verdigrid.operators import composite, scenes
from verdigrid.skew import HOT_ROWS, bounded_median, median_of_hot, split_hot
from verdigrid.sources.blocks import in_region


def clear_optical(s2: DataFrame, max_cloud: float = MAX_CLOUD_PCT, bands: list[str] = S2_BANDS) -> DataFrame:
    """Optical observations up to the cloud limit, cloudy pixels and non-finite values as NULL."""
    return scenes.clean_nonfinite(scenes.mask_qa(scenes.filter_cloud_pct(s2, max_cloud), bands), bands)


def linear_radar(s1: DataFrame) -> DataFrame:
    """Radar observations of the wanted mode in linear power."""
    return scenes.clean_nonfinite(scenes.radar_to_linear(scenes.filter_s1_mode(s1)), S1_BANDS)


def optical_composite(s2: DataFrame, keys: list[str], max_cloud: float = MAX_CLOUD_PCT,
                      bands: list[str] = S2_BANDS, start_month: int = SEASON_START_MONTH, start_day: int = 1,
                      hot_rows: int | None = HOT_ROWS) -> DataFrame:
    return composite.monthly_median(clear_optical(s2, max_cloud, bands), keys, bands, "ts", start_month, start_day, hot_rows)


def radar_composite(s1: DataFrame, keys: list[str], start_month: int = SEASON_START_MONTH, start_day: int = 1,
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    return composite.monthly_median(linear_radar(s1), keys, S1_BANDS, "ts", start_month, start_day, hot_rows)


def season_medians(s2: DataFrame, s1: DataFrame, pixels: DataFrame, keys: list[str], first_year: int, last_year: int,
                   bands: list[str] = BANDS, max_cloud: float = MAX_CLOUD_PCT, start_month: int = SEASON_START_MONTH,
                   start_day: int = 1, hot_rows: int | None = HOT_ROWS, year: str | None = None, region: DataFrame | None = None) -> DataFrame:
    """A row with the given bands for every pixel, season of the range, and month with an observation; a NULL month where there is none.

    A median gathers the observations of a pixel, season and month. The rows of every pixel are counted first, and those of
    pixels above ``hot_rows`` take another way, so no list grows without bound; ``hot_rows=None`` saves that pass over the
    data where the sensors' revisit is known to bound a group. ``year`` names a partition column of both tables with the calendar year of ``ts``.
    ``region`` lists the values of further partition columns of both tables that the cells need (``sources.blocks``): other folders are not read.
    ``pixels`` are the cells to build (inside of a region, or of the scored class),
    each once. Both sensors are shuffled together, by pixel and season, to the join
    with the cells; medians, month spine and all later work per pixel stay in place.
    """
    start = season_bounds(first_year, start_month, start_day)[0]
    end = season_bounds(last_year, start_month, start_day)[1]
    if region is not None:
        s2, s1 = in_region(s2, region), in_region(s1, region)
    optical = clear_optical(scenes.filter_dates(s2, start, end, year=year), max_cloud, [b for b in S2_BANDS if b in bands])
    radar = linear_radar(scenes.filter_dates(s1, start, end, year=year))
    seen = composite.union_sensors(composite.with_season(optical, "ts", start_month, start_day),
                                   composite.with_season(radar, "ts", start_month, start_day), keys, bands)
    on = [*keys, "season_year"]
    cold, hot = split_hot(seen, keys, hot_rows)
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    cells = pixels.select(*keys).withColumn("season_year", F.explode(years))
    medians = bounded_median(cells.join(cold, on, "left"), [*on, "month"], bands)
    if hot is not None:
        places = hot.select(*on).distinct().join(cells, on, "left_semi")
        medians = medians.unionByName(median_of_hot(hot.join(places, on, "left_semi"), [*on, "month"], bands))
    return medians


def build_cube(s2: DataFrame, s1: DataFrame, pixels: DataFrame, keys: list[str], first_year: int, last_year: int,
               bands: list[str] = BANDS, **options) -> DataFrame:
    """Twelve rows with the given bands for every pixel and season of the range; ``options`` go to ``season_medians``."""
    medians = season_medians(s2, s1, pixels, keys, first_year, last_year, bands, **options)
    return composite.spread_months(medians, [*keys, "season_year"], bands)


def build_months(s2: DataFrame, s1: DataFrame, pixels: DataFrame, keys: list[str], first_year: int, last_year: int,
                 bands: list[str] = BANDS, **options) -> DataFrame:
    """The cube with one row per pixel and season: ``months`` holds the twelve months, from which features follow without a shuffle."""
    medians = season_medians(s2, s1, pixels, keys, first_year, last_year, bands, **options)
    return composite.month_arrays(medians, [*keys, "season_year"], bands)


def build_stack(s2: DataFrame, s1: DataFrame, pixels: DataFrame, keys: list[str], first_year: int, last_year: int,
                **options) -> DataFrame:
    """168 columns per pixel and season."""
    cube = build_cube(s2, s1, pixels, keys, first_year, last_year, **options)
    return composite.stack_wide(cube, [*keys, "season_year"])
