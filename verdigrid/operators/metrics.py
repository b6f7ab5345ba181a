"""Classification metrics from scored rows (label, pred).

All but the losses come from the confusion counts, so the rows are read once and
pre-aggregated to at most one row per label pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from verdigrid.bands import CHANNEL_GROUPS, CHANNELS, STATIC_GROUP
from verdigrid.functions.arrays import log_sum_exp
from verdigrid.session import materialise


def _label_pairs(df: DataFrame, labels: list[int]) -> DataFrame:
    listed = F.array(*[F.lit(v) for v in labels])
    return (df.sparkSession.range(1).select(F.explode(listed).alias("label"))
            .withColumn("pred", F.explode(listed)))


def pair_counts(scored: DataFrame) -> DataFrame:
    """Rows per (label, pred): all that the metrics need."""
    return scored.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy(scored: DataFrame) -> DataFrame:
    return accuracy_of_counts(pair_counts(scored))


def accuracy_of_counts(counts: DataFrame) -> DataFrame:
    hits = F.sum(F.when(F.col("pred") == F.col("label"), F.col("n")).otherwise(0)).cast("double")
    return counts.agg(F.coalesce(F.try_divide(hits, F.sum("n")), F.lit(0.0)).alias("accuracy"))


def confusion_matrix(scored: DataFrame, labels: list[int]) -> DataFrame:
    """Count of every (label, pred) cell of the label list, zeros included."""
    return matrix_of_counts(pair_counts(scored), labels)


def matrix_of_counts(counts: DataFrame, labels: list[int]) -> DataFrame:
    return (_label_pairs(counts, labels).join(counts, ["label", "pred"], "left")
            .select("label", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def confusion_percent(matrix: DataFrame) -> DataFrame:
    """Row-normalised matrix in percent, 0 for labels that do not occur."""
    row = F.sum("n").over(Window.partitionBy("label"))
    return matrix.select("label", "pred", F.coalesce(F.try_divide(100.0 * F.col("n"), row), F.lit(0.0)).alias("pct"))


def classification_report(matrix: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Per class, macro and weighted precision, recall, f1 and support, and the accuracy over the label list."""
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    cell = F.col("n")
    by_label = matrix.groupBy(F.col("label").alias("cls")).agg(
        F.sum(cell).alias("support"), F.sum(F.when(F.col("label") == F.col("pred"), cell).otherwise(0)).alias("tp"))
    by_pred = matrix.groupBy(F.col("pred").alias("cls")).agg(F.sum(cell).alias("predicted"))
    classes = (by_label.join(by_pred, "cls")
               .withColumns({"precision": ratio(F.col("tp").cast("double"), F.col("predicted")),
                             "recall": ratio(F.col("tp").cast("double"), F.col("support"))})
               .withColumn("f1", ratio(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    scores = ["precision", "recall", "f1"]
    title = F.col("cls").cast("string")
    for value, text in (names or {}).items():
        title = F.when(F.col("cls") == value, text).otherwise(title)
    per_class = classes.select(title.alias("class"), *scores, F.col("support").cast("bigint").alias("support"))
    # the class table has one row per label of the list: a fixed, small size
    summary = classes.agg(
        F.struct(*[F.avg(s).alias(s) for s in scores]).alias("macro avg"),
        F.struct(*[ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores]).alias("weighted avg"),
        ratio(F.sum("tp").cast("double"), F.sum("support")).alias("_acc"), F.sum("support").cast("bigint").alias("support"))
    averages = F.array(*[F.struct(F.lit(k).alias("class"), *[F.col(k)[s].alias(s) for s in scores], F.col("support"))
                         for k in ("macro avg", "weighted avg")],
                       F.struct(F.lit("accuracy").alias("class"), *[F.col("_acc").alias(s) for s in scores], F.col("support")))
    return per_class.unionByName(summary.select(F.inline(averages)))


def evaluate(scored: DataFrame, labels: list[int], names: dict[int, str] | None = None) -> dict[str, DataFrame]:
    """Accuracy, report and confusion matrix as three tables, from one pass over the scored rows.

    The accuracy is over all rows, the other two over the labels of the list.
    """
    counts = materialise(pair_counts(scored))
    matrix = matrix_of_counts(counts, labels)
    return {"accuracy": accuracy_of_counts(counts), "report": classification_report(matrix, names), "confusion": matrix}


def class_weights(rows: DataFrame, weight: str | dict[int, float], label: str = "label") -> DataFrame:
    """(label, weight) per class: given weights, or 'balanced' as n / (classes * n_class)."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    if weight == "balanced":
        # one row per class; the counts are summed in one row, never the data
        total = counts.agg(F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_classes"))
        joined = counts.withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one")
        value = F.col("_total") / (F.col("_classes") * F.col("n"))
        return joined.select(label, value.cast("double").alias("weight"))
    value = F.lit(0.0)
    for k, v in weight.items():
        value = F.when(F.col(label) == int(k), F.lit(float(v))).otherwise(value)
    return counts.select(label, value.alias("weight"))


def pos_weight(w_neg: float, w_pos: float) -> float:
    return w_pos / max(w_neg, 1e-8)


def weighted_cross_entropy(scored: DataFrame, weights: list[float] | None = None, batch: str = "batch_id") -> DataFrame:
    """Mean over batches of sum(w * nll) / sum(w), the nll taken from the logits array."""
    nll = log_sum_exp(F.col("logits")) - F.element_at("logits", F.col("label") + 1)
    w = F.lit(1.0) if weights is None else F.element_at(F.array(*[F.lit(float(v)) for v in weights]), F.col("label") + 1)
    by_batch = scored.groupBy(batch).agg(F.try_divide(F.sum(w * nll), F.sum(w)).alias("loss"))
    return by_batch.agg(F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"))


def binary_cross_entropy(scored: DataFrame, weight: float = 1.0, batch: str = "batch_id") -> DataFrame:
    """Mean over batches of the logistic loss of ``logit``, positives weighted."""
    z, y = F.col("logit"), F.col("label")
    softplus = F.log1p(F.exp(-F.abs(z)))
    loss = weight * y * (softplus + F.greatest(-z, F.lit(0.0))) + (1 - y) * (softplus + F.greatest(z, F.lit(0.0)))
    by_batch = scored.groupBy(batch).agg(F.avg(loss).alias("loss"))
    return by_batch.agg(F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"))


def masked_token_range(features: DataFrame, mask: str = "mask", land_cover: str = "land_cover_mask") -> DataFrame:
    """Smallest and largest number of masked tokens of a row; the model needs them equal.

    ``mask`` has the channels of month after month, ``land_cover`` (optional) a flag per month. A group has one token a
    month, masked if any of its channels is; the elevation group has one token in all, as it does not change.
    """
    width, n = len(CHANNELS), F.lit(0)
    months = F.size(mask) / width
    for group, names, _ in CHANNEL_GROUPS:
        at = [CHANNELS.index(c) for c in names]
        first = F.greatest(*[F.get(mask, F.lit(i)) for i in at]) if len(at) > 1 else F.get(mask, F.lit(at[0]))
        by_month = lambda acc, m: acc + F.greatest(*[F.get(mask, m * width + i) for i in at], F.lit(0))  # noqa: B023, E731
        n = n + (first if group == STATIC_GROUP else F.aggregate(F.sequence(F.lit(0), months.cast("int") - 1), F.lit(0), by_month))
    if land_cover in features.columns:
        n = n + F.aggregate(land_cover, F.lit(0), lambda acc, v: acc + v)
    return features.agg(F.min(n).alias("min_masked"), F.max(n).alias("max_masked"),
                        (F.min(n) == F.max(n)).alias("equal"))
