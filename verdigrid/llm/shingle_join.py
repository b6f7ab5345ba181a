"""N-gram Jaccard join with a count-vector R-tree: shingles hashed into groups, group counts as points, overlap bounded by summed minima.

Two documents that link differ by few shingles, so of more groups than that some hold the very same shingles in both. Equal
groups bring documents together; among those that meet, group counts are points of a packed tree whose boxes, and then
whose points, bound the overlap by the sum of coordinate minima. Pairs that survive are verified on their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from verdigrid.llm.common import components, map_batches, written

SHINGLE = 5
PERCENT = 80
#: Coordinates of a point, points of a leaf box, and documents of a meeting place that one task compares with as many others.
COORDINATES, LEAF, BLOCK = 32, 16, 512
#: Keys that a document shares at least with the pivot of its family; all others come up in the second look.
FIRST = 3
#: Words remembered at a time by one task.
MEMORY = 500_000

_MIX = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, hashes: Hashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a whole text's shingles: five words each, or all words if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both on ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    own = np.array([hashes[w] for w in words], np.uint64)
    width = min(SHINGLE, len(own))
    out = np.full(len(own) - width + 1, np.uint64(width))
    for k in range(width):
        out = _stirred((out ^ own[k:len(own) - width + 1 + k]) * _MIX[0] + _MIX[2])
    return np.unique(out)


def boundaries() -> list[int]:
    """Set sizes at which a new size class begins: 4, 8, 12, 16, then half as much again each time."""
    out = [4, 8, 12, 16]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 3 // 2)
    return out


SIZES = np.array(boundaries())


def groups_of(size_class: int) -> tuple[int, int]:
    """(groups, largest number of differing shingles) of a class. The class is that of the smaller document of a pair.

    At 80 % a pair differs by a quarter of the smaller set at most. A few groups more make up for empty ones.
    """
    differ = (int(SIZES[size_class + 1]) - 1) // 4
    return differ + 3 + differ // 8, differ


def classes_of(n: int) -> list[int]:
    """The size classes of the pairs that a set of ``n`` may be in: its own, and the one below if a smaller partner may be there."""
    if n < 4:
        return []  # such sets link with equal ones only
    top = int(np.searchsorted(SIZES, n, "right")) - 1
    return [top, top - 1] if top and 4 * n <= 5 * (int(SIZES[top]) - 1) else [top]


def group_keys(own: np.ndarray) -> np.ndarray:
    """Keys under which a document meets all that it may link with and that are not equal to it.

    For its size class, and the one below if its partners may be there: a key for each group, made of class, group and the
    group's shingles. Of at least ``groups - differ`` groups that a pair shares unchanged, one is not empty unless the
    document has that many empty groups; only then its empty groups are keys too.
    """
    out = []
    for k in classes_of(len(own)):
        groups, differ = groups_of(k)
        place = ((own >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
        sums = np.zeros(groups, np.uint64)
        np.add.at(sums, place, _stirred(own * _MIX[3]))  # a sum over a set: no order needed
        filled = np.bincount(place, minlength=groups) > 0
        tags = np.arange(groups, dtype=np.uint64) * _MIX[4] + np.full(1, k + 1, np.uint64) * _MIX[2]
        keys = _stirred(_stirred(sums ^ tags) * _MIX[0] + tags)
        out.append(keys if groups - filled.sum() >= groups - differ else keys[filled])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def needed(own: np.ndarray, smaller: bool = False) -> int:
    """Keys that a document shares at least with each larger one that it links with and is not equal to: its unchanged, filled groups.

    With ``smaller``, with each that it links with, also of the class below: there it has other groups, and often fewer.
    """
    shared = []
    for k in classes_of(len(own))[:None if smaller else 1]:
        groups, differ = groups_of(k)
        shared.append(len(np.unique((own >> np.uint64(20)) % np.uint64(groups))) - differ)
    return max(1, min(shared, default=1))


def counts_of(own: np.ndarray) -> bytes:
    """A set's point: a byte a coordinate, or four where a count needs them."""
    counts = np.bincount((own % np.uint64(COORDINATES)).astype(np.int64), minlength=COORDINATES)
    return counts.astype("u1" if counts.max() < 256 else "<i4").tobytes()


def points_of(counts: list[bytes]) -> np.ndarray:
    if all(len(c) == COORDINATES for c in counts):
        return np.frombuffer(b"".join(counts), "u1").reshape(-1, COORDINATES).astype(np.int32)
    return np.array([np.frombuffer(c, "u1" if len(c) == COORDINATES else "<i4") for c in counts], np.int32).reshape(-1, COORDINATES)


def may_link(overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``a`` and ``b`` that share at most ``overlap`` may reach the similarity."""
    overlap = np.minimum(overlap, np.minimum(a, b))
    return 100 * overlap >= PERCENT * (a + b - overlap)


class Tree:
    """Points packed into leaf boxes by size and first coordinates; a box holds the largest counts and the sizes' range."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray) -> None:
        self.order = np.lexsort((points[:, 1], points[:, 0] // 4, sizes))
        self.sizes, self.points = sizes[self.order], points[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        self.starts = starts
        self.most = np.maximum.reduceat(self.points, starts, axis=0)
        self.low, self.high = np.minimum.reduceat(self.sizes, starts), np.maximum.reduceat(self.sizes, starts)

    def pairs(self, other: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of pairs that may link, after the bounds of boxes and of points."""
        for i, start in enumerate(self.starts):
            overlap = np.minimum(self.most[i], other.most).sum(axis=1)
            overlap = np.minimum(overlap, np.minimum(self.high[i], other.high))
            near = 100 * overlap >= PERCENT * (np.maximum(self.low[i], other.low))  # the union has at least the larger set
            near &= (100 * self.high[i] >= PERCENT * other.low) & (100 * other.high >= PERCENT * self.low[i])
            hit = np.flatnonzero(near)
            if not len(hit):
                continue
            rows = np.arange(start, min(start + LEAF, len(self.sizes)))
            cols = np.concatenate([np.arange(s, min(s + LEAF, len(other.sizes))) for s in other.starts[hit]])
            overlap = np.minimum(self.points[rows][:, None, :], other.points[cols][None, :, :]).sum(axis=2)
            r, c = np.nonzero(may_link(overlap, self.sizes[rows][:, None], other.sizes[cols][None, :]))
            yield self.order[rows[r]], other.order[cols[c]]


def profiles(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, n, sig, keys, need, least, counts) of every row: the set's size, digest, meeting keys, how many a link
    with a larger set and any link shares, and group counts."""
    def run(batch: dict, hashes: Hashes = Hashes()) -> dict:
        if len(hashes) > MEMORY:
            hashes.clear()
        sets = [shingles(t, hashes) for t in batch["text"]]
        return {"doc_id": batch["doc_id"], "n": list(map(len, sets)), "sig": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "keys": [group_keys(s) for s in sets], "need": list(map(needed, sets)), "least": [needed(s, smaller=True) for s in sets], "counts": [counts_of(s) for s in sets]}

    return map_batches(docs.select("doc_id", F.col(text).alias("text")), run, "doc_id bigint, n bigint, sig binary, keys array<bigint>, need bigint, least bigint, counts binary", rows=512)


MEETING = "key bigint, rep bigint, pivot bigint"


def meetings(reps: DataFrame) -> DataFrame:
    """(key, rep, pivot) of documents that share a key: the pivot is the smallest of them.

    One shuffle by key; a task reads its sorted rows as a stream and holds one batch. A document has a row for each of its
    many groups, so that even a group of copies with a third of all documents gives each key a small share of the rows.
    """
    arrow = to_arrow_schema(StructType.fromDDL(MEETING))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, False)  # key, its smallest document, whether it has been written
        held = None  # the first document of the last key, not yet known to be met
        for batch in batches:
            key, rep = (np.asarray(batch.column(i)) for i in (0, 1))
            if not len(key):
                continue
            begins = np.append(True, key[1:] != key[:-1])
            carried = last[0] is not None and key[0] == last[0]
            at = np.flatnonzero(begins)
            pivot = rep[at][np.cumsum(begins) - 1].copy()
            size = np.diff(np.append(at, len(key)))
            if carried:
                pivot[:size[0]] = last[1]
            met = np.repeat(size > 1, size)
            if carried:
                met[:size[0]] = True
            keep = met.copy()
            out_key, out_rep, out_pivot = key[keep], rep[keep], pivot[keep]
            if carried and held is not None:
                out_key, out_rep, out_pivot = (np.append(np.int64(v), x) for v, x in ((last[0], out_key), (held, out_rep), (last[1], out_pivot)))
            single = size[-1] == 1 and not (carried and len(at) == 1)
            held = rep[-1] if single else None
            last = (key[-1], pivot[-1], True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (out_key, out_rep, out_pivot)], schema=arrow)

    keys = reps.select(F.explode("keys").alias("key"), "rep")
    return keys.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(run, StructType.fromDDL(MEETING))


def fine_counts(own: np.ndarray) -> bytes:
    """A set's point with as many coordinates as it has members, rounded up to a power of two; a byte each, or four."""
    size = 1 << min(16, max(5, (len(own) - 1).bit_length()))
    counts = np.bincount((own % np.uint64(size)).astype(np.int64), minlength=size)
    wide = bool(counts.max() > 255)
    return bytes([wide]) + counts.astype("<i4" if wide else "u1").tobytes()


def _fine(point: bytes) -> np.ndarray:
    return np.frombuffer(point, "<i4" if point[0] else "u1", offset=1).astype(np.int32)


def _folded(point: np.ndarray, size: int) -> np.ndarray:
    """The point with fewer coordinates, each the sum of several."""
    return point if len(point) == size else point.reshape(-1, size).sum(axis=0)


def fine_overlap(a: bytes, b: bytes) -> int:
    """Sum of coordinate minima at the shorter point's length."""
    x, y = _fine(a), _fine(b)
    size = min(len(x), len(y))
    return int(np.minimum(_folded(x, size), _folded(y, size)).sum())


def close(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose fine points leave room for a link: a tenth of the bytes that the texts of all pairs would move."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("fine").alias(f"fine_{c}"))

    def run(batch: dict) -> dict:
        overlap = np.array([fine_overlap(x, y) for x, y in zip(batch["fine_a"], batch["fine_b"])], np.int64)
        near = may_link(overlap, np.array(batch["n_a"], np.int64), np.array(batch["n_b"], np.int64))
        return {c: np.array(batch[c], np.int64)[near] for c in ("a", "b")}

    return map_batches(pairs.join(side("a"), "a").join(side("b"), "b"), run, "a bigint, b bigint", rows=4096)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``texts`` (doc_id, text) link; a document listed with several texts links by any of them."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))

    def run(batch: dict) -> dict:
        hashes, known, out = Hashes(), {}, {"a": [], "b": []}
        for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
            for t in (x, y):
                if t not in known:
                    known[t] = shingles(t, hashes)
            left, right = known[x], known[y]
            common = len(np.intersect1d(left, right, assume_unique=True))
            if len(left) and 100 * common >= PERCENT * (len(left) + len(right) - common):
                out["a"].append(a)
                out["b"].append(b)
        return out

    near = close(pairs, texts).distinct()
    return map_batches(near.join(side("a"), "a").join(side("b"), "b"), run, "a bigint, b bigint", rows=256).distinct()


def with_points(docs: DataFrame) -> DataFrame:
    """Add the set's size ``n`` and its fine point to (doc_id, text)."""
    def run(batch: dict, hashes: Hashes = Hashes()) -> dict:
        if len(hashes) > MEMORY:
            hashes.clear()
        sets = [shingles(t, hashes) for t in batch["text"]]
        return {**batch, "n": list(map(len, sets)), "fine": list(map(fine_counts, sets))}

    return map_batches(docs, run, "doc_id bigint, text string, n bigint, fine binary", rows=512)


def _between(met: DataFrame, families: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of documents of different families that the tree's bounds let through and that share as many keys as a link must."""
    placed = met.select("key", "rep").join(families.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
             .filter(F.col("low") != F.col("high")).select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    rows = (placed.join(mixed, "key").withColumn("x", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
            .join(reps, "rep"))
    # a place with more than one block is compared block by block, each pair of blocks in a task of its own
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("y", other).select("key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "rep", "component", "n", "need", "counts")

    placed = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "x")
    shared = placed.mapInArrow(_bounded, "a bigint, b bigint, need bigint, m bigint").groupBy("a", "b").agg(F.min("need").alias("need"), F.sum("m").alias("m"))
    return shared.filter(F.col("m") >= F.col("need")).select("a", "b")


def _within(texts: DataFrame, families: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of documents of one family and different components that the bounds let through: of the tree's boxes and points, then of fine points.

    A family is dealt into blocks, and each pair of blocks is a task's: all its pairs are bounded there and only survivors leave.
    """
    part = parts.select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    rows = (texts.select("doc_id", "n", "fine").join(families.select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "doc_id")
            .join(part, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id")))
    mixed = (rows.groupBy("family").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("of"))
             .filter(F.col("low") != F.col("high")).select("family", F.ceil(F.col("of") / BLOCK).cast("int").alias("blocks")))
    dealt = (rows.join(mixed, "family").withColumn("x", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
             .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("family", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "doc_id", "part", "n", "fine"))

    def compare(here: pd.DataFrame) -> pd.DataFrame:
        sides = [here[here["x"] == here[c].iloc[0]] for c in ("i", "j")]
        out = []
        if all(map(len, sides)):
            n, own, group = ([s[c].to_numpy() for s in sides] for c in ("n", "doc_id", "part"))
            fine = [[_fine(f) for f in s["fine"]] for s in sides]
            trees = [Tree(n[k], np.array([_folded(f, COORDINATES) for f in fine[k]])) for k in (0, 1)]
            for r, c in trees[0].pairs(trees[1]):
                apart = group[0][r] != group[1][c]
                r, c = r[apart], c[apart]
                sizes = np.minimum(np.array([len(f) for f in fine[0]])[r], np.array([len(f) for f in fine[1]])[c])
                for size in np.unique(sizes):
                    a, b = r[sizes == size], c[sizes == size]
                    rows_a, at_a = np.unique(a, return_inverse=True)
                    rows_b, at_b = np.unique(b, return_inverse=True)
                    left, right = np.array([_folded(fine[0][k], size) for k in rows_a]), np.array([_folded(fine[1][k], size) for k in rows_b])
                    step = max(1, 4_000_000 // size)
                    overlap = np.concatenate([np.minimum(left[at_a[k:k + step]], right[at_b[k:k + step]]).sum(axis=1) for k in range(0, len(a), step)])
                    near = may_link(overlap, n[0][a], n[1][b])
                    out.append(np.column_stack([own[0][a[near]], own[1][b[near]]]))
        pairs = np.concatenate(out or [np.zeros((0, 2), np.int64)])
        return pd.DataFrame({"a": pairs.max(axis=1), "b": pairs.min(axis=1)}, dtype="int64") if len(pairs) else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return dealt.groupBy("family", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct()


def _small(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within groups of one small size."""
    rows = starts[:, None] + np.arange(size)
    left, right = np.triu_indices(size, 1)
    return rows[:, left].ravel(), rows[:, right].ravel()


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sorted groups (key, i, j) whose bounds reach the similarity. Groups hold two blocks at most; a group that a
    batch cuts waits for the next. Small groups are paired together, larger ones through their trees."""
    held: list[pa.RecordBatch] = []

    def solve(table: pa.Table) -> pa.RecordBatch:
        key, i, j, x, rep, part, n, need = (table.column(c).to_numpy() for c in ("key", "i", "j", "x", "rep", "component", "n", "need"))
        points = points_of(table.column("counts").to_pylist())
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        plain = (sizes <= LEAF) & (i[starts] == j[starts])
        found = [_small(starts[plain & (sizes == s)], s) for s in np.unique(sizes[plain])]
        for at, size in zip(starts[~plain].tolist(), sizes[~plain].tolist()):
            rows = np.arange(at, at + size)
            sides = [rows[x[rows] == b] for b in (i[at], j[at])]
            if all(map(len, sides)):
                trees = [Tree(n[r], points[r]) for r in sides]
                found += [(sides[0][r], sides[1][c]) for r, c in trees[0].pairs(trees[1])]
        out = []
        for r, c in found:
            for cut in range(0, len(r), 100_000):
                a, b = r[cut:cut + 100_000], c[cut:cut + 100_000]
                near = (part[a] != part[b]) & may_link(np.minimum(n[a], n[b]), n[a], n[b])
                a, b = a[near], b[near]
                near = may_link(np.minimum(points[a], points[b]).sum(axis=1), n[a], n[b])
                a, b = a[near], b[near]
                least = np.minimum(np.where(n[a] <= n[b], need[a], need[b]), np.where(n[b] <= n[a], need[b], need[a]))
                out.append(np.column_stack([np.maximum(rep[a], rep[b]), np.minimum(rep[a], rep[b]), least]))
        pairs, times = np.unique(np.concatenate(out or [np.zeros((0, 3), np.int64)]), axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64), pa.int64()) for c in (*pairs.T, times)], names=["a", "b", "need", "m"])

    for batch in batches:
        if not batch.num_rows:
            continue
        group = [np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("key", "i", "j")]
        last = np.flatnonzero((group[0] != group[0][-1]) | (group[1] != group[1][-1]) | (group[2] != group[2][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield solve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = [batch.slice(cut)]
        elif held and any(np.asarray(held[-1].column(held[-1].schema.get_field_index(c)))[-1] != g[0] for c, g in zip(("key", "i", "j"), group)):
            yield solve(pa.Table.from_batches(held))
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield solve(pa.Table.from_batches(held))


def near_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``: documents link whose sets of five-word shingles have a Jaccard similarity of 80 % or more.

    ``component_id`` is the smallest doc_id reachable by links. A text without words has no shingles and links with nothing;
    nor does a null doc_id, whose component is null. Rows that repeat a doc_id are one document that links by any of its
    texts. Extra columns are ignored; no rows give no rows.

    Documents with equal sets are one class from the start. Each class first meets the pivot with which it shares most
    keys; classes joined by such pairs are a family. Verified, these pairs settle most groups of copies with one look a
    document. Then documents of different components of a family are bounded by the tree, each pair once; so are those of
    different families that share enough keys. Survivors are verified, so that no link between components is lost, and no
    pair within a component is looked at.
    """
    own = written(profiles(docs, text), "profiles")
    linkable = own.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    one = lambda *of: linkable.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct(*of), "doc_id").alias("of")).select("rep", "of.*")
    reps = written(one("n", "need", "least", "counts"), "classes")
    met = written(meetings(one("keys")), "meetings")
    # a document that shares fewer keys than a link must, also one with a smaller class, with all others together, has none
    enough = (met.groupBy("rep").agg(F.count(F.lit(1)).alias("m")).join(reps.select("rep", "least"), "rep").filter(F.col("m") >= F.col("least"))
              .select("rep").distinct())
    met = written(met.join(enough, "rep", "left_semi"), "meetings")
    texts = docs.select("doc_id", F.col(text).alias("text")).join(met.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = written(with_points(texts.dropDuplicates(["doc_id", "text"])), "texts")
    need = reps.groupBy("rep").agg(F.min("need").alias("need"))
    first = (met.filter(F.col("rep") != F.col("pivot")).groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("m")).join(need, "rep")
             .filter((F.col("m") >= FIRST) & (2 * F.col("m") >= F.col("need"))).groupBy("rep")
             .agg(F.max_by("pivot", F.struct("m", -F.col("pivot"))).alias("pivot")).select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
    first = written(first, "pairs")
    families = components(first)
    links = written(verified(first, texts), "links")
    more = written(_within(texts, families, components(links)).unionByName(_between(met, families, reps)), "pairs")
    if not more.isEmpty():
        links = links.unionByName(verified(more, texts))
    same = linkable.join(linkable.groupBy("sig").agg(F.min("doc_id").alias("rep")), "sig").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    parts = components(links.unionByName(same.filter(F.col("a") != F.col("b"))))
    return (own.select("doc_id", F.col("n").alias("n_shingles")).join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
