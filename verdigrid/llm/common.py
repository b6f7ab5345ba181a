"""Shared helpers: batch functions, tables written between steps, bounded samples, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from verdigrid.session import scratch_path

#: One fifth of the documents is never used for fitting: crc32 of the id as text, modulo this, is 0.
FOLDS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[dict], dict], schema: str, rows: int = 1024) -> DataFrame:
    """Apply ``fn`` (columns as lists in, columns out) to slices of ``rows`` rows; one pass, no shuffle."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield pa.RecordBatch.from_pydict(fn(batch.slice(at, rows).to_pydict()), schema=arrow)

    return df.mapInArrow(run, kind)


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a step to the shared folder and read it back: later steps survive lost executors and compute it once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled_ids(table: DataFrame, rows: int, *keep: str) -> DataFrame:
    """At most ``rows`` documents of ``table`` outside the held-out fold: those whose ids hash lowest.

    Ids are chosen from the id column alone; a null id is never chosen and a repeated id once.
    """
    ids = (table.filter(F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0))
           .groupBy("doc_id").agg(*[F.max(c).alias(c) for c in keep], F.lit(1).alias("_one")).drop("_one"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _grown(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.filter(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _shrunk(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them; edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    moved = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): the smallest node reachable.

    Alternates two star contractions; each round pre-aggregates, joins on the node (adaptive execution
    splits large nodes) and is written to the shared folder. Nothing is collected but two numbers a round.
    """
    now = written(edges.filter(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if found["n"] == 0 or (found["n"], found["h"]) == seen:
            break
        seen = (found["n"], found["h"])
        now = written(_shrunk(_grown(now)), "edges")
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
