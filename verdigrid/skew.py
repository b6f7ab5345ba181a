"""Work on groups that may hold a large share of all rows.

Spark's ``median`` and ``row_number`` keep or order a whole group in one task. The
functions here use them for groups of a bounded size only. Larger groups are
pre-aggregated, ordered over all tasks by a range partitioning of the full sort
key, and joined up through per-partition totals, with the same exact result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from verdigrid.session import materialise

HOT_ROWS = 200_000
BROADCAST_ROWS = 100_000


def split_hot(df: DataFrame, keys: list[str], hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups up to ``hot_rows``, rows of larger groups or None); keys must not be NULL.

    The count is pre-aggregated on the map side and reads the key columns only.
    ``hot_rows=None`` skips it, for callers whose groups are bounded by nature.
    """
    if hot_rows is None:
        return df, None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = counts.filter(F.col("_n") > hot_rows).select(*keys)
    found = large.limit(BROADCAST_ROWS + 1).collect()
    if not found:
        return df, None
    if len(found) <= BROADCAST_ROWS:
        hot = F.broadcast(df.sparkSession.createDataFrame(found, large.schema))
    else:
        hot = materialise(large)
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")


def running_total(df: DataFrame, keys: list[str], order: list[Column], weight: Column, name: str) -> DataFrame:
    """Add the inclusive running sum of ``weight`` within ``keys``; no group is held by one task.

    ``order`` must be a total order within a group.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(k) for k in keys]
    # the partition number is stored with the rows, so a recomputed task cannot change it
    placed = materialise(df.repartitionByRange(parts, *columns, *order)
                         .withColumn("_weight", weight).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(*keys, "_part").agg(F.sum("_weight").alias("_total"))
               .select(*keys, "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (placed.withColumn(name, F.sum("_weight").over(within))
            .join(offsets, [*keys, "_part"])
            .withColumn(name, F.col(name) + F.col("_offset"))
            .drop("_weight", "_part", "_offset"))


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], name: str,
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``row_number`` within ``keys`` by a total order."""
    cold, hot = split_hot(df, keys, hot_rows)
    numbered = cold.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    if hot is None:
        return numbered
    return numbered.unionByName(running_total(hot, keys, order, F.lit(1).cast("bigint"), name))


def bounded_median(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Exact interpolated median per key, for groups of a bounded size.

    One list of rows per group is several times faster than one median buffer per
    column, and holds no more than the group's rows.
    """
    counts = [F.expr(f"count(`{c}`) AS `_n_{c}`") for c in cols]
    groups = df.groupBy(*keys).agg(F.collect_list(F.struct(*cols)).alias("_rows"), *counts)

    def median(c: str) -> str:
        # descending order puts NULL last; without any value the positions give NULL
        ordered = f"sort_array(_rows.`{c}`, false)"
        middle = [f"get({ordered}, CAST(floor((`_n_{c}` - {k}) / 2) AS INT)) * 0.5D" for k in (1, 0)]
        return f"{middle[0]} + {middle[1]} AS `{c}`"

    return groups.selectExpr(*[f"`{k}`" for k in keys], *[median(c) for c in cols])


def exact_median(df: DataFrame, keys: list[str], cols: list[str], hot_rows: int | None = HOT_ROWS,
                 place_by: list[str] | None = None) -> DataFrame:
    """Exact interpolated median of the non-NULL values of every column, one row per key.

    The rows are shuffled once, by ``place_by`` (some of the keys, such as the pixel),
    and later steps on those columns reuse that; ``hot_rows`` bounds the rows per
    place. Medians gain nothing from map-side buffers.
    """
    place_by = place_by or keys
    cold, hot = split_hot(df, place_by, hot_rows)
    medians = bounded_median(cold.repartition(*place_by), keys, cols)
    return medians if hot is None else medians.unionByName(median_of_hot(hot, keys, cols))


def median_of_hot(hot: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The same for groups of any size: equal values are counted, and the running count finds the middle."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    counts = (hot.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.name", "cell.value")
              .filter(F.col("value").isNotNull())
              .groupBy(*keys, "name", "value").agg(F.count(F.lit(1)).alias("n")))
    group = [*keys, "name"]
    ranked = running_total(counts, group, [F.col("value")], F.col("n"), "upto")
    sizes = ranked.groupBy(*group).agg(F.max("upto").alias("size"))
    reached = [F.min(F.when(F.col("upto") >= F.floor((F.col("size") + k) / 2), F.col("value"))) for k in (1, 2)]
    # one row per group and column, never shuffled to meet all rows of a hot group
    medians = (ranked.join(sizes, group).groupBy(*group)
               .agg((reached[0] * 0.5 + reached[1] * 0.5).alias("median")))
    wide = medians.groupBy(*keys).pivot("name", cols).agg(F.first("median"))
    return hot.select(*keys).distinct().join(wide, keys, "left").select(*keys, *cols)
