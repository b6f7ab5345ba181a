"""Quality classifier: neighbours among broadcast, labelled latent-semantic vectors vote on every document."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from verdigrid.llm.common import map_batches, sampled_ids

#: Labelled documents that vote, at most; with the ranks below this bounds what is broadcast to about 2 MB.
SAMPLE_ROWS = 3000
RANKS = 48
NEIGHBOURS = 15
#: Similarities are raised to this power, so that the nearest of the neighbours count most.
SHARPNESS = 8
#: The part of a document that is known weighs its votes by this power.
KNOWN_POWER = 2
#: A vote of this weight for the share of good labels: a document that is like no labelled one gets about that.
PRIOR = 0.05
#: A document whose terms the projection keeps less of than of this share of labelled ones is less like them than its cosines say.
KEPT_BY = 0.9
#: Documents are predicted good from this score on.
GOOD_FROM = 0.3
#: Hashed terms: words, pairs of neighbouring words, word shapes, pairs of shapes, and distances at which a word comes again.
WORDS, WORD_PAIRS, SHAPES, PAIRS, LAGS = 2048, 2048, 512, 512, 8
#: Where each kind begins.
AT_PAIRS, AT_SHAPES, AT_SHAPE_PAIRS, AT_LAGS = np.cumsum([WORDS, WORD_PAIRS, SHAPES, PAIRS]).tolist()
TERMS = AT_LAGS + LAGS + 1
#: Words remembered at a time by one task.
MEMORY = 300_000

_KINDS = bytes.maketrans(bytes(range(256)), bytes(
    97 if 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 117 if c >= 128 else c for c in range(256)))


class Neighbours(NamedTuple):
    """What is broadcast: term weights, the projection (terms, ranks), unit vectors (rows, ranks), their labels, and the part of
    its length that a labelled document usually keeps in the projection."""
    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    kept: float


class Shapes(dict):
    """word -> (number, shape term, hash); a shape keeps the kinds of characters, each run of a kind once. The hash ignores case."""

    def __missing__(self, word: bytes) -> tuple[int, int, int]:
        kinds = word.translate(_KINDS)
        shape = bytes(c for i, c in enumerate(kinds) if not i or c != kinds[i - 1])
        self[word] = found = (len(self), xxhash.xxh32_intdigest(shape) % SHAPES, xxhash.xxh32_intdigest(word.lower()))
        return found


def term_counts(text: str | None, shapes: Shapes) -> np.ndarray:
    """Square roots of the shares of a whole text's terms; a text without words gives zeros."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    out = np.zeros(TERMS)
    if not words:
        return out
    found = np.array([shapes[w] for w in words], np.int64)
    number, shape, word = found.T
    out[:AT_PAIRS] = np.bincount(word % WORDS, minlength=WORDS)
    out[AT_PAIRS:AT_SHAPES] = np.bincount((word[:-1] * 31 + word[1:] * 17) % WORD_PAIRS, minlength=WORD_PAIRS)
    out[AT_SHAPES:AT_SHAPE_PAIRS] = np.bincount(shape, minlength=SHAPES)
    out[AT_SHAPE_PAIRS:AT_LAGS] = np.bincount((shape[:-1] * 31 + shape[1:] * 17) % PAIRS, minlength=PAIRS)
    for lag in range(1, LAGS + 1):
        out[AT_LAGS + lag - 1] = (number[lag:] == number[:-lag]).sum()
    out[-1] = len(words) - len(np.unique(number))
    return np.sqrt(out / len(words))


def fit_neighbours(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, ranks: int = RANKS) -> Neighbours:
    """Latent vectors of at most ``rows`` labelled documents outside the held-out fold.

    Only texts and ``quality`` are looked at. A repeated document counts once; an empty sample gives no neighbours.
    """
    chosen = sampled_ids(labels.filter(F.col("quality").isNotNull()), rows, "quality")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids

    def count(batch: dict) -> dict:
        shapes = Shapes()
        return {"doc_id": [str(d) for d in batch["doc_id"]], "quality": batch["quality"],
                "terms": [_sparse(term_counts(t, shapes)) for t in batch["text"]]}

    found = (map_batches(sample, count, "doc_id string, quality int, terms binary")
             .groupBy("doc_id").agg(F.min(F.struct("quality", "terms")).alias("one")).orderBy("doc_id").collect())
    counts = np.array([_dense(r["one"]["terms"]) for r in found], np.float32).reshape(len(found), TERMS)
    seen = (counts > 0).sum(axis=0)
    weights = np.log1p(len(found) / (1 + seen)).astype(np.float32)
    weighted = counts * weights
    projection = _leading(weighted, ranks)
    latent = weighted @ projection
    kept = float(np.quantile(_kept(weighted, latent), 1 - KEPT_BY)) if len(found) else 1.0
    return Neighbours(weights, projection.astype(np.float32), _unit(latent).astype(np.float32),
                      np.array([r["one"]["quality"] for r in found], np.float32), kept)


def _sparse(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return at.astype("<f4").tobytes() + counts[at].astype("<f4").tobytes()


def _dense(packed: bytes) -> np.ndarray:
    at, values = np.frombuffer(packed, "<f4").reshape(2, -1)
    out = np.zeros(TERMS, np.float32)
    out[at.astype(int)] = values
    return out


def _leading(x: np.ndarray, ranks: int, extra: int = 16, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors of ``x`` (columns) by subspace iteration from a fixed start."""
    ranks = min(ranks, x.shape[1])
    basis = np.random.default_rng(0).normal(size=(x.shape[1], min(x.shape[1], ranks + extra)))
    for _ in range(rounds):
        basis, _ = np.linalg.qr(x.T @ (x @ basis) + 1e-9 * basis)
    inner = x @ basis
    _, turn = np.linalg.eigh(inner.T @ inner)
    return basis @ turn[:, ::-1][:, :ranks]


def _kept(weighted: np.ndarray, latent: np.ndarray) -> np.ndarray:
    return np.linalg.norm(latent, axis=1) / np.maximum(np.linalg.norm(weighted, axis=1), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vote(model: Neighbours, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block of documents: exact cosines with all labelled vectors, then the nearest ones vote.

    The share of good labels votes with weight ``PRIOR``, so the less like its neighbours a document is, the nearer its
    score is to that share; words that no labelled document has make it less like them. A zero vector and an empty sample get the share itself (0.5 without any label).
    """
    mean = float(model.labels.mean()) if len(model.labels) else 0.5
    if not len(model.labels):
        return np.full(len(counts), mean)
    weighted = counts * model.weights
    latent = weighted @ model.projection
    known = np.minimum(_kept(weighted, latent) / max(model.kept, 1e-12), 1)
    cosine = np.maximum(_unit(latent) @ model.vectors.T, 0)
    k = min(neighbours, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.take_along_axis(cosine, near, 1).astype(float) ** SHARPNESS * known[:, None] ** KNOWN_POWER
    score = ((weight * model.labels[near]).sum(axis=1) + PRIOR * mean) / (weight.sum(axis=1) + PRIOR)
    return np.clip(score, 0, 1)


def score_quality(docs: DataFrame, model: Neighbours, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``GOOD_FROM`` on) to ``docs``.

    Null and empty texts get the share of good labels. Columns of these names are replaced; repeated rows score alike.
    Documents never meet: one pass, no shuffle, blocks of 256 documents against the broadcast vectors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # plain arrays: executors need no copy of the library
    others = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema.fields)

    def run(batch: dict, shapes: Shapes = Shapes()) -> dict:
        if len(shapes) > MEMORY:
            shapes.clear()
        counts = np.array([term_counts(t, shapes) for t in batch[text]]).reshape(-1, TERMS)
        score = vote(Neighbours(*shared.value), counts)
        return {**batch, "score": score.tolist(), "predicted": (score >= GOOD_FROM).astype(int).tolist()}

    return map_batches(others, run, f"{fields}, score double, predicted int", rows=256)
