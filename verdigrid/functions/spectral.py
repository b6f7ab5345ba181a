"""Per-value expressions on band columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from verdigrid.bands import CIRRUS_BIT, CLOUD_BIT, NODATA_BY_DTYPE, NODATA_FLOAT


def is_finite(x: Column) -> Column:
    """False for NaN and the infinities, NULL for NULL."""
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def clean(x: Column) -> Column:
    """NaN and the infinities become NULL, the only missing value used downstream."""
    return F.when(is_finite(x), x)


def qa_clear(qa: Column) -> Column:
    """Neither the cloud nor the cirrus bit is set."""
    return (qa.bitwiseAND(F.lit(1 << CLOUD_BIT)) == 0) & (qa.bitwiseAND(F.lit(1 << CIRRUS_BIT)) == 0)


def db_to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10.0)


def ndvi(nir: Column, red: Column, eps: float = 1e-6) -> Column:
    """Normalised difference in [-1, 1]; NULL where the sum of the bands is about 0."""
    total = nir + red
    ratio = (nir - red) / (total + eps)
    return F.when(F.abs(total) >= eps, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))


def cast_checked(x: Column, dtype: str) -> Column:
    """Cast to a raster dtype; NULL instead of an overflow error for values out of its range."""
    # Integer ranges and the Spark type that holds them.
    ranges = {"uint8": (0, 255, "smallint"), "int8": (-128, 127, "tinyint"),
              "uint16": (0, 65535, "int"), "int16": (-32768, 32767, "smallint"),
              "uint32": (0, 4294967295, "bigint"), "int32": (-2147483648, 2147483647, "int")}
    if dtype == "float32":
        return x.cast("float")
    low, high, spark_type = ranges[dtype]
    whole = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x))
    return F.when(whole.between(low, high), whole.cast(spark_type))


def nodata_for_dtype(dtype: Column) -> Column:
    chosen = F.when(dtype.isNull(), F.lit(None).cast("bigint"))
    for name, code in NODATA_BY_DTYPE.items():
        chosen = chosen.when(dtype == name, F.lit(code).cast("bigint"))
    return chosen.otherwise(F.lit(NODATA_FLOAT).cast("bigint"))
