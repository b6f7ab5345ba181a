"""Quality rules: gradient-boosted trees over statistics of whole documents, with a plain base rule."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from verdigrid.llm import boosting
from verdigrid.llm.common import map_batches, sampled_ids

#: The base rule's limits.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
#: Labelled documents that the trees are fitted on, at most.
SAMPLE_ROWS = 4000
#: Documents stay if the trees give them at least this probability of good quality.
KEEP_FROM = 0.3
#: Features of the trees, and the direction in which quality may go with each; none tells a document's length.
FEATURES = {"word_length": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "adjacent_share": -1,
            "distinct_share": 0, "upper_share": 0, "digit_share": 0, "bang_share": 0}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows of eight that occur twice or more, the first included. ``ids`` numbers equal words alike."""
    n = len(ids)
    if n <= window:
        return 0
    size = 1
    while size < window:  # windows of twice the size are pairs of windows, numbered anew: no hash, so no collision
        pairs = ids[:-size] * n + ids[size:]
        found, ids, times = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(found) == len(pairs):
            return 0
        size *= 2
    starts = np.flatnonzero(times[ids] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((cover.cumsum() > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of the base rule and the features of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # splits at exactly the six ASCII white-space characters
    n = len(words)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(text or "") - int(of[list(SPACES)].sum())
    symbols = int(of[list(SYMBOLS)].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    repeat = repeat_words(ids)
    many = max(n, 1)
    adjacent = int((ids[1:] == ids[:-1]).sum())
    letters = max(int(of[65:91].sum() + of[97:123].sum()), 1)
    features = [chars / many, symbols / many, dup / max(len(lines), 1), repeat / many, adjacent / many, len(number) / many,
                of[65:91].sum() / letters, of[48:58].sum() / max(chars, 1), of[33] / many]
    return [n, chars, symbols, dup, repeat], [float(v) for v in features]


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> boosting.Forest:
    """Fit the trees on at most ``rows`` labelled documents outside the held-out fold; the rest of the work covers all.

    A repeated document counts once, a null label not at all; without labels of both kinds the trees pass everything.
    """
    chosen = sampled_ids(labels.filter(F.col("quality").isNotNull()), rows, "quality")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids

    def measure(batch: dict) -> dict:
        return {"doc_id": [str(d) for d in batch["doc_id"]], "quality": batch["quality"], "features": [statistics(t)[1] for t in batch["text"]]}

    found = (map_batches(sample, measure, "doc_id string, quality int, features array<double>")
             .groupBy("doc_id").agg(F.min(F.struct("quality", "features")).alias("one")).orderBy("doc_id").collect())
    x = np.array([r["one"]["features"] for r in found], float).reshape(len(found), len(FEATURES))
    y = np.array([r["one"]["quality"] for r in found], float)
    if len(np.unique(y)) < 2:
        y = np.ones(len(y))
    return boosting.fit(x, y, np.array(list(FEATURES.values())))


def quality_rules(docs: DataFrame, forest: boosting.Forest, text: str = "text") -> DataFrame:
    """Add to ``docs``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, tree_score, kept.

    A null text has no words and fails the base rule; every row is judged on its own, repeated rows alike. Columns of
    ``docs`` with these names are replaced. Rows pass through one batch function; nothing is shuffled.
    """
    schema = ", ".join([*(f"{c} bigint" for c in COUNTS), "base_failed boolean", "tree_score double", "kept boolean"])
    names = [*COUNTS, "base_failed", "tree_score", "kept"]
    others = [c for c in docs.columns if c not in names]
    source = docs.select(*others) if text in others else docs.select(*others, F.col(text).alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)

    def judge(batch: dict) -> dict:
        found = [statistics(t) for t in batch[text]]
        counts = np.array([c for c, _ in found], np.int64).reshape(len(found), len(COUNTS))
        p = boosting.score(forest, np.array([f for _, f in found], float).reshape(len(found), len(FEATURES)))
        n, repeat = counts[:, 0], counts[:, 4]
        failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
        return {**batch, **dict(zip(COUNTS, counts.T.tolist())), "base_failed": failed.tolist(), "tree_score": p.tolist(),
                "kept": (~failed & (p >= KEEP_FROM)).tolist()}

    return map_batches(source, judge, f"{fields}, {schema}")
