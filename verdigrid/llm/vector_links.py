"""Near-duplicate vectors by an inverted multi-index: codebooks on vector halves form a product grid of cells."""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from verdigrid.llm.common import components, map_batches, written

COSINE = 0.93
#: Share of pairs at exactly the wanted cosine whose cell must be visited; closer pairs are found more surely.
RECALL = 0.995
#: Vectors that the codebooks are fitted on, at most; vectors for each cell that sizes the codebooks; entries of one, at most.
SAMPLE_ROWS, PER_CELL, MOST_CODES = 20_000, 64, 1024
#: Vectors of a cell, and visiting vectors, that one task compares at a time.
BLOCK = 1024


class Grid(NamedTuple):
    """Codebooks of both halves, and how much farther than its own cell a vector visits (squared distance)."""
    first: np.ndarray
    second: np.ndarray
    reach: float


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x ** 2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(axis=1)


def fit_grid(vectors: np.ndarray, total: int, cosine: float = COSINE, recall: float = RECALL) -> Grid:
    """Codebooks from a sample of unit vectors, for ``total`` vectors in all.

    The reach is measured: sample vectors are turned by exactly the wanted angle in random directions, and the reach is
    the excess over the own cell's distance within which ``recall`` of the turned vectors' cells lie.
    """
    rng = np.random.default_rng(0)
    half = vectors.shape[1] // 2
    k = int(min(MOST_CODES, len(vectors), max(1, math.sqrt(total / PER_CELL))))
    first, second = (_kmeans(v, k, rng) for v in (vectors[:, :half], vectors[:, half:]))
    some = vectors[rng.integers(0, len(vectors), max(8000, 2 * k))]
    away = rng.normal(size=some.shape)
    away -= (away * some).sum(axis=1, keepdims=True) * some
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    turned = cosine * some + math.sqrt(max(0.0, 1 - cosine ** 2)) * away
    excess = np.zeros(len(some))
    for part, book in ((slice(0, half), first), (slice(half, None), second)):
        d = _distances(some[:, part], book)
        cell = _distances(turned[:, part], book).argmin(axis=1)
        excess += d[np.arange(len(d)), cell] - d.min(axis=1)
    return Grid(first, second, float(np.quantile(excess, recall)) + 1e-9)


def visited(grid: Grid, x: np.ndarray) -> list[np.ndarray]:
    """For each unit vector the cells to visit, nearest first: the multi-sequence walk over both sorted distance lists.

    Cell (i, j) is numbered i * K2 + j. The walk ends where the sum of both distances passes the own cell's by the reach.
    """
    half = grid.first.shape[1]
    d1, d2 = _distances(x[:, :half], grid.first), _distances(x[:, half:], grid.second)
    order1, order2 = d1.argsort(axis=1, kind="stable"), d2.argsort(axis=1, kind="stable")
    out = []
    for a, b, i, j in zip(np.take_along_axis(d1, order1, 1), np.take_along_axis(d2, order2, 1), order1, order2):
        limit = a[0] + b[0] + grid.reach
        n1, n2 = np.searchsorted(a, limit - b[0], "right"), np.searchsorted(b, limit - a[0], "right")
        sums = a[:max(n1, 1), None] + b[None, :max(n2, 1)]
        inside = np.argwhere(sums <= limit)
        inside = inside[np.argsort(sums[tuple(inside.T)], kind="stable")] if len(inside) else np.zeros((1, 2), int)
        out.append(i[inside[:, 0]] * len(grid.second) + j[inside[:, 1]])
    return out


def _spanning(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node reached) that join what the links of a block join: one for each node at most."""
    a, b = left.copy(), right.copy()
    big = np.iinfo(np.int64).max
    while True:
        new_b = np.minimum(b, np.where(links, a[:, None], big).min(axis=0)) if len(a) else b
        new_a = np.minimum(a, np.where(links, new_b[None, :], big).min(axis=1)) if len(b) else a
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    nodes, least = np.concatenate([left, right]), np.concatenate([a, b])
    return nodes[nodes != least], least[nodes != least]


def _calls(cells: list[np.ndarray], own: np.ndarray) -> np.ndarray:
    """(stored, visitor) booleans: does the stored vector's walk come to the visitor's own cell as well."""
    known, code = np.unique(own, return_inverse=True)
    called = np.concatenate(cells).astype(np.int64)
    of = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    at = np.minimum(np.searchsorted(known, called), len(known) - 1)
    hit = known[at] == called
    comes = np.zeros((len(cells), len(known)), bool)
    comes[of[hit], at[hit]] = True
    return comes[:, code]


def unit(rows: list[np.ndarray]) -> np.ndarray:
    """Rows as unit vectors in double precision; neither very large nor very small components lose their norm."""
    x = np.array(rows, float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Vectors that can link: vec_id, label, class (a digest of the unit vector), raw (its components as given, 4 or 8 bytes each).

    Null, zero and broken vectors and null labels cannot. The label is joined with the vector's length.
    """
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"

    def run(batch: dict) -> dict:
        out = {"vec_id": [], "label": [], "class": [], "raw": []}
        for i, label_, v in zip(batch["vec_id"], batch["label"], batch["vector"]):
            if i is None or label_ is None or not v or any(c is None for c in v):
                continue
            x = np.array(v, float)
            if not np.isfinite(x).all() or not x.any():
                continue
            out["vec_id"].append(i)
            out["label"].append(f"{label_}:{len(x)}")
            out["class"].append(hashlib.sha256(unit([x])[0].tobytes()).hexdigest()[:40])
            out["raw"].append(x.astype(kind).tobytes())
        return out

    return map_batches(vectors.select("vec_id", F.col(label).alias("label"), F.col(vector).alias("vector")), run, "vec_id bigint, label string, class string, raw binary")


def link_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Vectors link if their labels are equal and not null and their cosine in double precision is at least ``cosine``.
    Equal unit vectors of a label are one class, compared once; n_links counts all members. A vector that cannot link, and
    a null vec_id, has no links and its own id as component. Rows that repeat a vec_id count as one vector if they are
    equal; else each row links on its own and the id's links add up. An empty table gives no rows.

    Every class is stored in its cell (label, first code, second code) and visits the cells within reach. Stored classes
    and visits of a cell are dealt into blocks of about ``BLOCK``; pairs of blocks are compared, never a whole cell. A pair that
    only one side's visits meet counts for both.
    Lengths must agree within a label; vectors of another length link among themselves.
    """
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    units = written(usable(vectors), "units")
    members = units.select("vec_id", "label", "class").distinct()
    classes = written(units.groupBy("label", "class").agg(F.min("vec_id").alias("rep"), F.min("raw").alias("raw"))
                      .join(members.groupBy("label", "class").agg(F.count(F.lit(1)).alias("n")), ["label", "class"]), "classes")
    sizes = [r[0] for r in classes.select(F.length("raw")).distinct().orderBy(F.length("raw")).collect()]  # the lengths of vectors in use
    found, edges = None, None
    for size in sizes:
        own = classes.filter(F.length("raw") == size)
        total = own.count()
        sample = own.orderBy("class").select("raw").limit(SAMPLE_ROWS).collect()  # digests are as good as random
        grid = spark.sparkContext.broadcast(tuple(fit_grid(unit([np.frombuffer(r[0], kind) for r in sample]), total, cosine)))  # plain arrays, 2 x 1024 half vectors at most
        a, b = _compared(own, grid, cosine, kind)
        found, edges = (a, b) if found is None else (found.unionByName(a), edges.unionByName(b))
    ids = vectors.select("vec_id")
    if found is None:
        return ids.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                          F.col("vec_id").isNotNull().alias("kept"))
    links = found.groupBy("label", "class").agg(F.sum("links").alias("links"))
    same = members.join(classes.select("label", "class", "rep"), ["label", "class"]).select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    parts = components(edges.unionByName(same))
    per_id = (members.join(links, ["label", "class"]).groupBy("vec_id").agg(F.sum("links").alias("n_links"))
              .join(parts.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    component = F.coalesce("component", "vec_id")
    return (ids.join(per_id, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                    (F.col("vec_id") == component).alias("kept"))
            .withColumn("kept", F.coalesce("kept", F.lit(False))))


def _compared(classes: DataFrame, grid, cosine: float, kind: str) -> tuple[DataFrame, DataFrame]:
    """(label, class, links) summed later, and edges (a, b) between representatives."""
    def place(batch: dict) -> dict:
        x = unit([np.frombuffer(u, kind) for u in batch["raw"]])
        cells = visited(Grid(*grid.value), x)
        return {**batch, "cells": [c.tolist() for c in cells]}

    placed = written(map_batches(classes.select("label", "class", "rep", "n", "raw"), place, "label string, class string, rep bigint, n bigint, raw binary, cells array<int>", rows=512), "placed")
    own = F.col("cells")[0]
    stored = placed.select("label", "class", "rep", "n", "raw", "cells", own.alias("own"), own.alias("cell"))
    visits = placed.select("label", "class", "rep", "n", "raw", F.lit(None).cast("array<int>").alias("cells"), own.alias("own"), F.explode("cells").alias("cell"))
    # blocks a cell is dealt into: counted with a map-side combine, joined back on the cell
    parts = lambda d, name: d.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    plan = parts(stored, "nb").join(parts(visits, "nq"), ["label", "cell"])
    deal = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    keys = ["label", "cell", "b", "q"]
    left = (stored.join(plan, ["label", "cell"]).withColumn("b", deal("nb"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).drop("nb", "nq"))
    right = (visits.join(plan, ["label", "cell"]).withColumn("q", deal("nq"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).drop("nb", "nq"))

    def compare(both: pd.DataFrame) -> pd.DataFrame:
        stored_, visits_ = both[both["role"] == 0], both[both["role"] == 1]
        if not len(stored_) or not len(visits_):
            return pd.DataFrame({"label": [], "class": [], "links": [], "a": [], "b": []})
        y, x = (unit([np.frombuffer(u, kind) for u in d["raw"]]) for d in (stored_, visits_))
        linked = np.clip(x @ y.T, -1, 1) >= cosine
        same = visits_["class"].to_numpy()[:, None] == stored_["class"].to_numpy()[None, :]
        linked |= same
        n = linked @ stored_["n"].to_numpy() - same.any(axis=1)
        one_way = linked & ~same & ~_calls(stored_["cells"].tolist(), visits_["own"].to_numpy(np.int64)).T
        back = visits_["n"].to_numpy() @ one_way
        a, b = _spanning(linked, visits_["rep"].to_numpy(np.int64), stored_["rep"].to_numpy(np.int64))
        label = both["label"].iloc[0]
        counts = pd.DataFrame({"label": label, "class": np.concatenate([visits_["class"].to_numpy(), stored_["class"].to_numpy()]),
                               "links": np.concatenate([n, back]).astype("int64"), "a": pd.NA, "b": pd.NA})
        pairs = pd.DataFrame({"label": label, "class": None, "links": 0, "a": a, "b": b})
        return pd.concat([counts[counts["links"] > 0], pairs], ignore_index=True)

    joined = left.withColumn("role", F.lit(0)).unionByName(right.withColumn("role", F.lit(1)))
    out = written(joined.groupBy(*keys).applyInPandas(compare, "label string, class string, links bigint, a bigint, b bigint"), "compared")
    return out.filter(F.col("class").isNotNull()).select("label", "class", "links"), out.filter(F.col("a").isNotNull()).select("a", "b").distinct()
