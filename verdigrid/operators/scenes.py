"""Scene filters: which observations enter a composite."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigrid.bands import MAX_CLOUD_PCT, S1_BANDS, S2_BANDS
from verdigrid.functions import spectral


def filter_cloud_pct(scenes: DataFrame, limit: float = MAX_CLOUD_PCT) -> DataFrame:
    """Scenes up to the cloud limit, the limit included."""
    return scenes.filter(F.col("cloud_pct") <= limit)


def mask_qa(scenes: DataFrame, bands: list[str] = S2_BANDS, qa: str = "qa60") -> DataFrame:
    """NULL the bands of cloudy and cirrus pixels; the rows stay."""
    ok = spectral.qa_clear(F.col(qa))
    return scenes.withColumns({b: F.when(ok, F.col(b)) for b in bands})


def filter_dates(scenes: DataFrame, start: str, end: str, ts: str = "ts", year: str | None = None) -> DataFrame:
    """Half-open range of literal dates, which the scan can use to skip row groups.

    ``year`` names a partition column that holds the calendar year of ``ts``: folders of other years are not opened.
    """
    kind = scenes.schema[ts].dataType.simpleString()
    inside = scenes.filter((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind)))
    return inside if year is None else inside.filter(F.col(year).between(int(start[:4]), int(end[:4])))


def filter_s1_mode(scenes: DataFrame, mode: str = "IW", resolution: int = 10) -> DataFrame:
    """Radar scenes of one mode and resolution that carry both polarisations."""
    return scenes.filter((F.col("instrument_mode") == mode)
                         & F.array_contains("pols", "VV") & F.array_contains("pols", "VH")
                         & (F.col("resolution_m") == resolution))


def radar_to_linear(scenes: DataFrame, bands: list[str] = S1_BANDS) -> DataFrame:
    """Linear radar power ``vv``, ``vh`` in place of ``vv_db``, ``vh_db``."""
    kept = [c for c in scenes.columns if c not in {f"{b}_db" for b in bands}]
    return scenes.select(*kept, *[spectral.db_to_linear(F.col(f"{b}_db")).alias(b) for b in bands])


def clean_nonfinite(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: spectral.clean(F.col(c)) for c in cols})
