"""Runs of repeated word sequences, found through a dictionary of basic factors.

All stretches of 1, 2, 4, ... words get names, equal ones the same. A stretch that comes again within twice its length, and
again at the same distance, proposes that distance as a period; the names then tell how far the period holds both ways.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from verdigrid.llm.common import map_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words that a run has at least, and how often its period fits in it at least.
LEAST, EXPONENT = 6, 4


def basic_factors(ids: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For 1, 2, 4, ... words: the name of the stretch that begins at each word, and the distance to where it comes next (0: nowhere).

    The last level is the one without equal names, or more than half as long as the text: no two stretches
    agree further than one step on each level tells.
    """
    names, gaps, keys, size = [], [], ids.astype(np.int64), 1
    while True:
        order = np.argsort(keys, kind="stable")
        again = keys[order][1:] == keys[order][:-1]
        named = np.empty(len(keys), np.int32)
        named[order] = np.append(0, np.cumsum(~again))
        gap = np.zeros(len(keys), np.int32)
        gap[order[:-1][again]] = np.diff(order)[again]
        names.append(named)
        gaps.append(gap)
        if not again.any() or 2 * size > len(ids):
            return names, gaps
        keys = named[:-size].astype(np.int64) * (int(named.max()) + 1) + named[size:]
        size *= 2


def proposals(gaps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) where a stretch and its next two occurrences are equally far apart, by at most twice its length.

    Of neighbouring positions with one period the first is given. A run of four periods or more is proposed on the level
    whose length is the first not below the period: there a stretch of the run cannot come again earlier than a period on.
    """
    at_all, period_all = [], []
    for level, gap in enumerate(gaps):
        near = np.where(gap <= 2 << level, gap, 0)
        at = np.flatnonzero(near)
        at = at[near[at + near[at]] == near[at]]
        held = np.zeros(len(gap) + 1, np.int32)  # the place after the last stands before the first
        held[at] = near[at]
        first = at[held[at - 1] != held[at]]
        at_all.append(first)
        period_all.append(held[first])
    return np.concatenate(at_all), np.concatenate(period_all).astype(np.int64)


def extended(names: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest stretches around ``at`` in which words a period apart are equal."""
    n = len(names[0])
    left, right = at.copy(), at + period
    for level in range(len(names) - 1, -1, -1):
        size, named = 1 << level, names[level]
        last = len(named) - 1
        right += size * ((right <= last) & (named[np.minimum(right, last)] == named[np.minimum(right - period, last)]))
        back = left - size
        same = named[np.clip(back, 0, last)] == named[np.clip(back + period, 0, last)]
        left = np.where((back >= 0) & same, back, left)
    return left, np.minimum(right, n)


def runs_of(ids: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence, by start, then period."""
    if len(ids) < max(least, exponent):
        return np.empty((0, 3), np.int64)
    names, gaps = basic_factors(ids)
    at, period = proposals(gaps)
    if not len(at):
        return np.empty((0, 3), np.int64)
    start, end = extended(names, at, period)
    rows = np.stack([start, period, end - start], 1)
    rows = rows[rows[:, 2] >= np.maximum(least, exponent * period)]
    return np.unique(rows, axis=0)[:, [0, 2, 1]]


def collapsed(words: list[str], runs: np.ndarray) -> list[str]:
    """The words outside of runs and each run's first period, but for what lies in the rest of another run."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text of ``docs`` (doc_id, text).

    ``runs`` has start, length and period, counted in words, of every stretch of at least ``least`` words and ``exponent`` of its
    smallest period that neither neighbour extends, by start, then period; ``collapsed`` is the text with each run
    reduced to its first period, words joined by a space. A null or blank text has no words, no runs and an empty
    ``collapsed``. Rows are judged each, also repeated ones and those with a null doc_id; other columns are ignored.
    One pass, no shuffle; work and memory are proportional to a text's words times their logarithm.
    """
    if exponent < 4:
        raise ValueError("periods are proposed for runs of at least 4 of them")

    def run(batch: dict) -> dict:
        out = {"doc_id": batch["doc_id"], "n_words": [], "runs": [], "collapsed": []}
        for text in batch["text"]:
            words = WORD.findall(text or "")
            code: dict[str, int] = {}
            found = runs_of(np.array([code.setdefault(w, len(code)) for w in words], np.int64), least, exponent)
            out["n_words"].append(len(words))
            out["runs"].append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
            out["collapsed"].append(" ".join(collapsed(words, found)))
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_words bigint, "
                       "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string", rows=256)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which a tenth of the texts, by the hash of the id, repeats a stretch of its words to its end.

    With h the crc32 of the decimal id and g = floor(h / 10): where h ends in 0, the words from a = g % n on become repetitions of
    the p = 1 + floor((n - a) / (3 + g % 8)) words there. A null id or a text without words stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (docs.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
              .withColumns({"_g": F.floor(F.col("_h") / 10), "_n": F.size("_w")})
              .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
              .withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int")))
    left = F.col("_n") - F.col("_a")
    tail = F.flatten(F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), F.ceil(left / F.col("_p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), F.slice(tail, F.lit(1), left)), " ")
    return chosen.select("doc_id", F.when(F.col("_a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (nulls where there is none) and digests of runs and collapsed words."""
    def sha(text: Column) -> Column:
        return F.sha2(F.coalesce(text, F.lit("")), 256)

    # ties go to the smallest start, then period
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    top = found.withColumn("_top", longest)
    length, period = -F.col("_top.less"), F.col("_top.period")
    return top.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("_top.start").alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
                      sha(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n")))).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
