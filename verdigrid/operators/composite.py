"""Monthly medians, the month spine, and the 168-column stack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigrid.bands import BANDS, FILL_BAND, MONTHS, SEASON_START_MONTH, wide_name
from verdigrid.functions import calendar, names
from verdigrid.skew import HOT_ROWS, exact_median


def with_season(obs: DataFrame, ts: str = "ts", start_month: int = SEASON_START_MONTH,
                start_day: int = 1) -> DataFrame:
    return obs.withColumns({"season_year": calendar.season_year(F.col(ts), start_month, start_day),
                            "month": calendar.season_month(F.col(ts), start_month, start_day)})


def monthly_median(obs: DataFrame, keys: list[str], bands: list[str], ts: str = "ts",
                   start_month: int = SEASON_START_MONTH, start_day: int = 1,
                   hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Per pixel, season and month the median of the valid values of each band.

    Rows are placed by pixel, so later steps per pixel need no shuffle. Pixels above ``hot_rows`` rows are counted, not gathered.
    """
    binned = with_season(obs, ts, start_month, start_day).select(*keys, "season_year", "month", *bands)
    return exact_median(binned, [*keys, "season_year", "month"], bands, hot_rows, keys)


def month_spine(pixels: DataFrame) -> DataFrame:
    """Twelve rows per pixel, so that months without a scene exist with missing bands."""
    return pixels.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))


def spread_months(rows: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """All twelve months of every pixel that has a row, missing ones with NULL bands.

    Rows with a NULL month say that the pixel exists; others are one per month.
    """
    entry = F.struct(F.col("month"), *bands)
    kinds = {c: rows.schema[c].dataType for c in ["month", *bands]}
    bit = F.when(F.col("month").between(MONTHS[0], MONTHS[-1]), F.call_function("shiftleft", F.lit(1), F.col("month").cast("int")))
    grouped = rows.groupBy(*keys).agg(F.collect_list(F.when(F.col("month").isNotNull(), entry)).alias("_seen"), F.coalesce(F.bit_or(bit), F.lit(0)).alias("_have"))
    # twelve constant rows, of which those of months with a bit are left out
    empty = F.array(*[F.struct(F.lit(m).cast(kinds["month"]).alias("month"), *[F.lit(None).cast(kinds[b]).alias(b) for b in bands]) for m in MONTHS])
    absent = F.filter(empty, lambda e: F.call_function("shiftright", F.col("_have"), e["month"].cast("int")).bitwiseAND(F.lit(1)) == 0)
    return grouped.select(*keys, F.inline(F.concat("_seen", absent)))


def month_arrays(rows: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """One row per pixel with ``months``: its twelve months in order, each a struct of the bands, NULL where a month has no row.

    Rows with a NULL month say that the pixel exists; others are one per month.
    """
    entry = F.struct(F.col("month"), F.struct(*bands))
    seen = F.map_from_entries(F.collect_list(F.when(F.col("month").isNotNull(), entry)))
    return rows.groupBy(*keys).agg(seen.alias("_seen")).select(*keys, F.array(*[F.try_element_at("_seen", F.lit(m)) for m in MONTHS]).alias("months"))


def on_spine(pixels: DataFrame, composite: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Twelve rows for every pixel and season in ``pixels``; a month without observation has NULL bands.

    Joined on pixel and season, not on the month, so the spine itself is never shuffled.
    """
    on = [*keys, "season_year"]
    return spread_months(pixels.select(*on).join(composite, on, "left"), on, bands)


def union_sensors(s2: DataFrame, s1: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Observations of both sensors in one table (keys, season_year, month, bands); the other sensor's bands are NULL."""
    def shaped(obs: DataFrame) -> DataFrame:
        have = set(obs.columns)
        return obs.selectExpr(*[f"`{k}`" for k in keys], "season_year", "month", *[
            f"CAST({f'`{b}`' if b in have else 'NULL'} AS DOUBLE) AS `{b}`" for b in bands])
    return shaped(s2).unionByName(shaped(s1))


def stack_wide(cube: DataFrame, keys: list[str], bands: list[str] = BANDS) -> DataFrame:
    """Month-major wide form ``M01_<band> ... M12_<band>``, one row per pixel."""
    entries = F.collect_list(F.struct(F.col("month"), F.struct(*bands)))
    grouped = cube.groupBy(*keys).agg(F.map_from_entries(entries).alias("_months"))
    return grouped.select(*keys, *[F.try_element_at("_months", F.lit(m)).getField(b).alias(wide_name(m, b))
                                   for m in MONTHS for b in bands])


def drop_fill_mask(stack: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the fill band by name and require the 168 others."""
    bare = stack.drop(FILL_BAND)
    n = len([c for c in bare.columns if c not in keys])
    if n != len(MONTHS) * len(BANDS):
        raise ValueError(f"expected {len(MONTHS) * len(BANDS)} bands, got {n}")
    return bare


def name_problems(band_names: DataFrame, name: str = "name") -> DataFrame:
    """Rows whose name cannot be placed in the cube, with the reason."""
    return band_names.withColumn("problem", names.band_status(F.col(name))).filter(F.col("problem") != "ok")


def unstack(stack: DataFrame, keys: list[str], strict: bool = True, by_name: bool = True) -> DataFrame:
    """Wide to long: one row per pixel and month with the 14 bands, missing columns as NULL.

    By name, a strict call fails on a column that is not ``M##_<band>`` and a
    lenient one leaves it out. Otherwise the columns are taken in canonical order.
    """
    wide = [c for c in stack.columns if c not in keys]
    if by_name:
        known = {wide_name(m, b) for m in MONTHS for b in BANDS}
        unknown = [c for c in wide if c not in known]
        if strict and unknown:
            raise ValueError(f"not a stacked band name: {unknown}")
        source = {c: c for c in wide if c in known}
    else:
        order = [wide_name(m, b) for m in MONTHS for b in BANDS]
        if strict and len(wide) != len(order):
            raise ValueError(f"expected {len(order)} bands without names, got {len(wide)}")
        source = dict(zip(order, wide))
    columns = [F.col(source[wide_name(m, b)]).cast("double").alias(wide_name(m, b)) if wide_name(m, b) in source
               else F.lit(None).cast("double").alias(wide_name(m, b)) for m in MONTHS for b in BANDS]
    # one projection of the row for each month, instead of an array of twelve structs
    months = ", ".join(f"({', '.join(wide_name(m, b) for b in BANDS)}) AS `{m}`" for m in MONTHS)
    long = stack.sparkSession.sql(f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS (({', '.join(BANDS)}) FOR _month IN ({months}))",
                                  wide=stack.select(*keys, *columns))
    return long.selectExpr(*[f"`{k}`" for k in keys], "CAST(_month AS INT) AS month", *BANDS)


def nonfinite_pct(df: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Share of missing, NaN and infinite values over all bands, in percent; 0 for no values.

    ``df`` has a row per pixel and month, or a row per pixel with ``months``.
    """
    inf = F.lit(float("inf"))
    arrays = "months" in df.columns

    def missing(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == inf)

    def bad(c: str) -> Column:
        return F.size(F.filter(F.col(f"months.{c}"), missing)) if arrays else F.when(missing(F.col(c)), 1).otherwise(0)

    n_bad = sum((bad(c) for c in bands[1:]), bad(bands[0]))
    pct = F.try_divide(100.0 * F.sum(n_bad), F.count(F.lit(1)) * len(bands) * (len(MONTHS) if arrays else 1))
    agg = F.coalesce(pct, F.lit(0.0)).alias("nonfinite_pct")
    return df.groupBy(*keys).agg(agg)
