"""Season calendar: month 1..12 of a season that starts at a given month and day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from verdigrid.bands import SEASON_START_MONTH


def _shifted(ts: Column, start_day: int) -> Column:
    if not 1 <= start_day <= 28:
        raise ValueError("start_day must be 1..28, so that every month has that day")
    day = ts.cast("date")
    return F.date_sub(day, start_day - 1) if start_day > 1 else day


def season_month(ts: Column, start_month: int = SEASON_START_MONTH, start_day: int = 1) -> Column:
    """Month bin 1..12 an observation falls in."""
    return (F.pmod(F.month(_shifted(ts, start_day)) - start_month, F.lit(12)) + 1).cast("int")


def season_year(ts: Column, start_month: int = SEASON_START_MONTH, start_day: int = 1) -> Column:
    """Year in which the season of an observation begins."""
    day = _shifted(ts, start_day)
    return (F.year(day) - F.when(F.month(day) < start_month, 1).otherwise(0)).cast("int")


def calendar_month(month: Column, start_month: int = SEASON_START_MONTH) -> Column:
    return (F.pmod(F.lit(start_month - 2) + month, F.lit(12)) + 1).cast("int")


def calendar_year(year: Column, month: Column, start_month: int = SEASON_START_MONTH) -> Column:
    return (year + F.when(calendar_month(month, start_month) < start_month, 1).otherwise(0)).cast("int")


def bin_start(year: Column, month: Column, start_month: int = SEASON_START_MONTH, start_day: int = 1) -> Column:
    return F.make_date(calendar_year(year, month, start_month), calendar_month(month, start_month), F.lit(start_day))


def bin_end(year: Column, month: Column, start_month: int = SEASON_START_MONTH, start_day: int = 1) -> Column:
    """First day after the bin."""
    return F.add_months(bin_start(year, month, start_month, start_day), 1)


def in_bin(ts: Column, year: Column, month: Column, start_month: int = SEASON_START_MONTH, start_day: int = 1) -> Column:
    """Half-open test ``start <= ts < end``."""
    return (ts >= bin_start(year, month, start_month, start_day)) & (ts < bin_end(year, month, start_month, start_day))


def season_bounds(year: int, start_month: int = SEASON_START_MONTH, start_day: int = 1) -> tuple[str, str]:
    """ISO dates [start, end) of a whole season: literals that reach the Parquet scan as a filter."""
    return f"{year:04d}-{start_month:02d}-{start_day:02d}", f"{year + 1:04d}-{start_month:02d}-{start_day:02d}"
