"""Scoring jobs: embeddings, logits, labels and probabilities for pixel tables, and head fitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import AtomicType

import verdigrid
from verdigrid.bands import CHANNELS
from verdigrid.functions import arrays
from verdigrid.scoring.encoder import apply_head, in_chunks
from verdigrid.scoring.weights import check_weights, encoder_shapes

# the batch functions travel with the job, so workers need no installed copy of this package
cloudpickle.register_pickle_by_value(verdigrid)

BatchFn = Callable[[np.ndarray], np.ndarray]


def _matrix(column: pa.ChunkedArray | pa.Array, *shape: int) -> np.ndarray:
    """Numeric array of a (nested) list column with fixed inner lengths; NULL values become NaN."""
    values = column
    while pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        values = values.flatten()
    flat = values.cast(pa.float32()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), *shape)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def _append_lists(df: DataFrame, kept: list[str], name: str, fn: Callable[[pa.RecordBatch], np.ndarray], kind: str = "float") -> DataFrame:
    """Add an array column computed from whole Arrow batches."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept) + f", {name} array<{kind}>"
    real = np.float32 if kind == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, _lists(fn(batch).astype(real))], [*kept, name])

    return df.mapInArrow(run, schema)


def _spread(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """``pixels`` dealt by ``keys`` to a fixed number of tasks: scoring costs by the row, while adaptive execution makes tasks by bytes, of a few megabytes few."""
    spark = pixels.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    plain = [k for k in keys if isinstance(pixels.schema[k].dataType, AtomicType)]
    return pixels.repartition(tasks, *plain)


def encode_pixels(features: DataFrame, weights: dict[str, np.ndarray], start_month: int = 0) -> DataFrame:
    """Replace ``x`` (12 x 17), ``lat``, ``lon`` by ``embedding`` and ``nan_input``.

    A pixel with a missing value in a supplied channel gets a NaN embedding and
    ``nan_input`` true.
    """
    shapes = encoder_shapes()
    check_weights(weights, shapes)
    # the model has a fixed size of about 0.4 million values, sent once per executor
    shared = features.sparkSession.sparkContext.broadcast({n: weights[n] for n in shapes})
    kept = [c for c in features.columns if c not in ("x", "lat", "lon")]

    def embed(batch: pa.RecordBatch) -> np.ndarray:
        def column(name: str) -> pa.Array:
            return batch.column(batch.schema.get_field_index(name))
        lists = column("x")
        steps = len(lists.flatten()) // max(len(lists), 1)
        x = _matrix(lists, steps, len(CHANNELS))
        lat, lon = (column(c).to_numpy(zero_copy_only=False) for c in ("lat", "lon"))
        return in_chunks(x, lat, lon, shared.value, start_month)

    embedded = _append_lists(_spread(features, kept), kept, "embedding", embed)
    return embedded.withColumn("nan_input", F.isnan(F.element_at("embedding", 1)))


def score_batches(df: DataFrame, fn: BatchFn, source: str = "embedding", name: str = "logits", kind: str = "float") -> DataFrame:
    """Apply a model that maps a batch of rows to a batch of output rows, of ``float`` or ``double`` values."""
    kept = [c for c in df.columns if c != source]

    def run(batch: pa.RecordBatch) -> np.ndarray:
        lists = batch.column(batch.schema.get_field_index(source))
        return fn(_matrix(lists, len(lists.flatten()) // max(len(lists), 1)))

    return _append_lists(df, kept, name, run, kind)


def score_head(df: DataFrame, weights: dict[str, np.ndarray], source: str = "embedding") -> DataFrame:
    """Logits of an MLP head."""
    shared = df.sparkSession.sparkContext.broadcast({n: w for n, w in weights.items() if n.startswith("head")})
    return score_batches(df, lambda z: apply_head(z, shared.value), source, kind="double")


def score_linear(df: DataFrame, weights: list[list[float]], bias: list[float] | None = None,
                 source: str = "embedding") -> DataFrame:
    """Logits of a single linear layer as a column expression."""
    return df.withColumn("logits", arrays.linear(F.col(source), weights, bias))


def predict(scored: DataFrame, classes: int) -> DataFrame:
    """Label from logits: threshold 0.5 for a single logit, else the first maximum."""
    label = (arrays.binary_label(F.element_at("logits", 1).cast("double")) if classes == 1
             else arrays.argmax(F.col("logits")))
    return scored.withColumn("pred", label)


def predict_proba(scored: DataFrame, classes: int) -> DataFrame:
    logits = F.col("logits").cast("array<double>")
    proba = arrays.binary_probabilities(F.element_at(logits, 1)) if classes == 1 else arrays.softmax(logits)
    return scored.withColumn("proba", proba)


def fit_head(embedded: DataFrame, label: str = "label", hidden: tuple[int, ...] = (), classes: int | None = None,
             weight: str | None = None, iterations: int = 50, penalty: float = 1e-4, seed: int = 7) -> PipelineModel:
    """Train a head on frozen embeddings with Spark ML.

    Without hidden sizes a logistic regression, which takes class weights from the column ``weight``; otherwise a
    multilayer perceptron, which is given rows as many times as their weight says (``weighted_copies``).
    """
    rows = embedded.withColumns({"_features": array_to_vector(F.col("embedding").cast("array<double>")),
                                 "_label": F.col(label).cast("double")})
    if not hidden:
        options = {"weightCol": weight} if weight else {}
        head = LogisticRegression(featuresCol="_features", labelCol="_label", predictionCol="_pred",
                                  probabilityCol="_proba", rawPredictionCol="_raw", maxIter=iterations,
                                  regParam=penalty, family="multinomial", **options)
    else:
        if classes is None:
            classes = int(rows.agg(F.max("_label")).first()[0]) + 1
        if weight:
            rows = weighted_copies(rows, weight, ["embedding", "_label"])
        inputs = rows.select(F.size("embedding")).first()[0]
        head = MultilayerPerceptronClassifier(featuresCol="_features", labelCol="_label", predictionCol="_pred",
                                              probabilityCol="_proba", rawPredictionCol="_raw", maxIter=iterations,
                                              layers=[inputs, *hidden, classes], seed=seed)
    return Pipeline(stages=[head]).fit(rows)


def weighted_copies(rows: DataFrame, weight: str, key: list[str]) -> DataFrame:
    """Rows repeated in proportion to ``weight``: a row of the least weight above 0 stands there once, one without weight not at all.

    Of a fraction of a copy the hash of ``key`` decides, so that a rerun gives the same rows and a class the right total.
    With balanced weights no class gets more rows than the largest has.
    """
    least = rows.filter(F.col(weight) > 0).agg(F.min(weight)).first()[0]
    if least is None:
        return rows.limit(0)
    copies = F.col(weight) / F.lit(float(least))
    chance = F.pmod(F.xxhash64(*key), F.lit(1 << 20)) / F.lit(float(1 << 20))
    n = F.floor(copies) + (chance < copies - F.floor(copies)).cast("bigint")
    wanted = rows.withColumn("_copies", n.cast("int")).filter("_copies > 0")
    return wanted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def apply_fitted(model: Model, embedded: DataFrame) -> DataFrame:
    """Add ``pred`` and ``proba`` of a fitted head."""
    rows = embedded.withColumn("_features", array_to_vector(F.col("embedding").cast("array<double>")))
    scored = model.transform(rows)
    return scored.select(*embedded.columns, F.col("_pred").cast("int").alias("pred"),
                         vector_to_array("_proba").alias("proba"))


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
