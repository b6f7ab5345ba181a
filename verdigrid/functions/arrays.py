"""Expressions over logits, coordinates and month indices."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def sigmoid(x: Column) -> Column:
    """Logistic function, written so that exp never overflows."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def log_sum_exp(logits: Column) -> Column:
    top = F.array_max(logits)
    return top + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z - top)))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z - top))
    return F.transform(logits, lambda z: F.exp(z - top) / total)


def argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def binary_probabilities(logit: Column) -> Column:
    p = sigmoid(logit)
    return F.array(1.0 - p, p)


def binary_label(logit: Column) -> Column:
    return (sigmoid(logit) >= 0.5).cast("int")


def linear(x: Column, weights: list[list[float]], bias: list[float] | None = None) -> Column:
    """Array of ``w . x + b``, one entry per weight row."""
    def dot(row: list[float]) -> Column:
        products = F.zip_with(x, F.array(*[F.lit(float(w)) for w in row]),
                              lambda a, b: a.cast("double") * b)
        return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)
    bias = bias or [0.0] * len(weights)
    return F.array(*[dot(row) + F.lit(float(b)) for row, b in zip(weights, bias)])


def unit_vector(lat: Column, lon: Column) -> Column:
    """(x, y, z) on the unit sphere of a position in degrees."""
    la, lo = F.radians(lat), F.radians(lon)
    return F.array(F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))


def month_sequence(start: Column, steps: int) -> Column:
    """Calendar months 0..11 of ``steps`` consecutive months; an error for a start above 11."""
    months = F.transform(F.sequence(start, start + (steps - 1)), lambda m: (m % 12).cast("int"))
    return F.when(start < 12, months).otherwise(
        F.raise_error(F.lit("month must be below 12")).cast("array<int>"))


def month_encoding(month: Column, size: int) -> Column:
    """``size/2`` equal sine entries, then ``size/2`` equal cosine entries."""
    if size % 2:
        raise ValueError("size must be even")
    angle = month * (2.0 * math.pi / 12.0)
    return F.concat(F.array_repeat(F.sin(angle), size // 2), F.array_repeat(F.cos(angle), size // 2))
