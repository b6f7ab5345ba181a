"""Sharding by extendible hashing: a directory indexed by hash-prefix bits, in which only oversized buckets split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from verdigrid.llm.common import written
from verdigrid.skew import running_total

#: Bits of the hash that the directory can use: 15 hexadecimal digits of an MD5.
HASH_BITS = 60
#: Bits that each further look at the directory adds.
STEP = 4
#: Rows of a lookup table for each bucket, at most.
LISTED = 4


def hash_of(key: Column) -> Column:
    """60 well-mixed bits of a key; a null key hashes as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def _prefix(depth: int) -> Column:
    return F.shiftright(F.col("_hash"), HASH_BITS - depth)


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, n_bytes) of every bucket of ``sizes`` (_hash, _size): each fits or cannot split.

    A look sums the leaves of some bits, pre-aggregated, and sums these upwards, so that one pass settles all buckets down
    to that depth; the first goes as deep as an even spread needs, and a little deeper. Only rows of leaves that are
    still too large are read again for the next bits.
    """
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    done, open_rows, depth = None, sizes, 0
    deep = min(HASH_BITS, max(1, math.ceil(math.log2(max(1.0, total / limit)))) + STEP)
    while True:
        leaves = written(open_rows.groupBy(_prefix(deep).alias("leaf")).agg(F.sum("_size").alias("n_bytes")), "leaves")
        # every leaf's total at each depth above it, of a table with a few rows for each shard
        above = (leaves.select("leaf", "n_bytes", F.explode(F.sequence(F.lit(depth), F.lit(deep))).alias("depth"))
                 .withColumn("prefix", F.expr(f"shiftright(leaf, {deep} - depth)"))
                 .groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("n_bytes")))
        parent = above.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("n_bytes").alias("parent_bytes"))
        buckets = above.withColumn("up", F.shiftright("prefix", 1)).join(parent, ["depth", "up"], "left")
        # totals only fall on the way down: a bucket exists if its parent had to split
        exists = (F.col("depth") == depth) | (F.col("parent_bytes") > limit)
        settled = (F.col("n_bytes") <= limit) | (F.col("depth") == HASH_BITS)
        found = written(buckets.filter(exists & settled).select("depth", "prefix", "n_bytes"), "buckets")
        done = found if done is None else done.unionByName(found)
        large = leaves.filter(F.col("n_bytes") > limit)
        if deep == HASH_BITS or large.isEmpty():
            return done
        open_rows = open_rows.withColumn("leaf", _prefix(deep)).join(large.select("leaf"), "leaf", "left_semi").drop("leaf")
        depth, deep = deep, min(HASH_BITS, deep + STEP)


def lookup_depth(counts: dict[int, int]) -> int:
    """The deepest depth of a bucket down to which all can be listed, leaf by leaf, in at most ``LISTED`` rows for each bucket of ``counts``."""
    first = min(counts)
    return max(t for t in counts if t == first or sum(n << (t - d) for d, n in counts.items() if d <= t) <= LISTED * sum(counts.values()))


def extendible_shards(rows: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Add shard_depth, shard_prefix, shard_page and shard_bytes to ``rows``: shards of at most ``limit`` bytes.

    A shard is a bucket (depth, prefix). Rows with one and the same hash (a repeated or null key) cannot split: their
    bucket grows pages of at most ``limit`` bytes, or of a single row that is larger. ``size`` gives a row's bytes;
    null counts as 0. An empty table gives no rows. Columns of ``rows`` must not start with an underscore or ``shard_``.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1 byte")
    sized = rows.withColumns({"_hash": hash_of(F.col(key)), "_size": F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))})
    found = written(directory(written(sized.select("_hash", "_size"), "sizes"), limit), "directory")
    counts = {r["depth"]: r["n"] for r in found.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 61 rows
    bucket = [F.col("depth").cast("int").alias("shard_depth"), F.col("prefix").alias("shard_prefix"), F.col("n_bytes").alias("shard_bytes")]
    placed, rest = None, sized
    while counts:
        top = lookup_depth(counts)
        counts = {d: n for d, n in counts.items() if d > top}
        spread = F.explode(F.expr(f"sequence(shiftleft(prefix, {top} - depth), shiftleft(prefix + 1, {top} - depth) - 1)"))
        here = found.filter(F.col("depth").between(F.lit(0) if placed is None else F.lit(low), F.lit(top))).select(*bucket, spread.alias("_leaf"))
        leaves = rest.withColumn("_leaf", _prefix(top))
        hit = leaves.join(here, "_leaf").drop("_leaf")
        placed, low = hit if placed is None else placed.unionByName(hit), top + 1
        if counts:  # rows of deeper buckets only go on
            rest = written(leaves.join(here.select("_leaf"), "_leaf", "left_anti").drop("_leaf"), "deeper")
    if placed is None:
        placed = sized.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("shard_depth", "int"), ("shard_prefix", "bigint"), ("shard_bytes", "bigint"))])
    out = placed.withColumn("shard_page", F.lit(0).cast("bigint"))
    if not found.filter(F.col("n_bytes") > limit).isEmpty():
        out = out.filter(F.col("shard_bytes") <= limit).unionByName(_paged(out.filter(F.col("shard_bytes") > limit), rows.columns, limit))
    return out.select(*rows.columns, "shard_depth", "shard_prefix", "shard_page", "shard_bytes")


def _paged(over: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """Pages for rows that share all bits: numbered over all tasks by a range partitioning, none gathered in one."""
    over = over.withColumns({"_text": F.xxhash64(*[F.col(c).cast("string") for c in columns]), "_at": F.monotonically_increasing_id()})
    ranked = running_total(over, ["shard_prefix"], [F.col("_size"), F.col("_text"), F.col("_at")], F.lit(1).cast("bigint"), "_nth")
    ranked = written(ranked, "ranked")
    largest = ranked.groupBy("shard_prefix").agg(F.max("_size").alias("_most"))
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("_most"), F.lit(1))))
    paged = ranked.join(largest, "shard_prefix").withColumn("shard_page", F.floor((F.col("_nth") - 1) / per_page).cast("bigint"))
    sums = paged.groupBy("shard_prefix", "shard_page").agg(F.sum("_size").alias("shard_bytes"))
    return paged.drop("shard_bytes", "_nth", "_most", "_text", "_at").join(sums, ["shard_prefix", "shard_page"])
