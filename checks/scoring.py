"""Scoring: heads, labels, the encoder, and whole runs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks.registry import check
from checks.sources import AUDIT_SQL, RUN_SQL, RUNS, run_tables
from checks.tiling import IMAGE, cells, headers
from checks.views import SEASONS, duck, s1, table, view
from verdigrid.bands import BANDS
from verdigrid.operators import grid, metrics
from verdigrid.plans import inference, runs as season_runs, stack
from verdigrid.scoring import model
from verdigrid.scoring.encoder import ERF_A, ERF_P
from verdigrid.scoring.weights import HIDDEN, head_shapes, load_weights, save_weights, sine_weights
from verdigrid.session import materialise, scratch_path
from verdigrid.sources import sinks, tables

CLASSES, SIZE = 10, 64
LINEAR = [[math.sin(1 + c * SIZE + j) for j in range(SIZE)] for c in range(CLASSES)]
LOGITS_SQL = "SELECT vec_id, label, " + ", ".join(
    f"list_sum(list_transform(range({SIZE}), lambda j: CAST(list_extract(embedding, j+1) AS DOUBLE)*sin(1 + {c * SIZE} + j))) AS z{c}" for c in range(CLASSES)) + " FROM embeddings"
_Z = [f"z{c}" for c in range(CLASSES)]
_MAX = f"greatest({', '.join(_Z)})"
_SUM = " + ".join(f"exp({z} - {_MAX})" for z in _Z)


def logits(spark, sf):
    return model.score_linear(table(spark, sf, "embeddings"), LINEAR)


def columns(name: str, prefix: str, n: int, digits: int = 9):
    return [F.round(F.element_at(name, i + 1), digits).alias(f"{prefix}{i}") for i in range(n)]


@check("score_head", duck("SELECT vec_id, " + ", ".join(f"round({z}, 9) AS {z}" for z in _Z) + " FROM l", l=LOGITS_SQL))
def _(spark, sf):
    return logits(spark, sf).select("vec_id", *columns("logits", "z", CLASSES))


@check("predict", duck(f"SELECT vec_id, CAST(list_position([{', '.join(_Z)}], {_MAX}) - 1 AS INT) AS pred, CAST(1/(1+exp(-z0)) >= 0.5 AS INT) AS binary FROM l", l=LOGITS_SQL))
def _(spark, sf):
    scored = model.predict(logits(spark, sf), CLASSES)
    return scored.select("vec_id", "pred", model.arrays.binary_label(F.element_at("logits", 1)).alias("binary"))


@check("predict_proba", duck("SELECT vec_id, " + ", ".join(f"round(exp({z} - {_MAX})/({_SUM}), 9) AS p{c}" for c, z in enumerate(_Z)) + " FROM l", l=LOGITS_SQL))
def _(spark, sf):
    return model.predict_proba(logits(spark, sf), CLASSES).select("vec_id", *columns("proba", "p", CLASSES))


def positions(spark, sf):
    """Cells of the whole grid with a position in degrees."""
    return view(spark, sf, "v_mask").withColumns({"lat": 50 - F.col("grid_row") * 0.01, "lon": 20 + F.col("grid_col") * 0.01})


# pixels with a valid observation of both sensors in any month: their series have no gap after the fill
S2_OK = "cloud_pct <= 10 AND (qa60 & 1024) = 0 AND (qa60 & 2048) = 0"
S1_OK = "instrument_mode = 'IW' AND pol_list = 'VV,VH' AND resolution_m = 10"
FULL_SQL = f"SELECT DISTINCT pixel_id AS full_id FROM v_s2 WHERE {S2_OK} INTERSECT SELECT pixel_id FROM v_s1 WHERE {S1_OK}"


@check("encode_pixels", duck("""SELECT pixel_id, full_id IS NULL AS nan_input, 128 AS n_values, CASE WHEN full_id IS NOT NULL THEN true END AS centred,
 CASE WHEN full_id IS NOT NULL THEN true END AS of_unit_variance FROM v_mask LEFT JOIN f ON pixel_id = full_id""", "v_mask", "v_s2", "v_s1", f=FULL_SQL))
def _(spark, sf):
    """Whether the embedding of every pixel, its months being the medians over all seasons, is normalised, or missing with its input."""
    weights = sine_weights(inference.model_shapes(2))
    features = pixel_features(spark, sf).join(positions(spark, sf).select("pixel_id", "lat", "lon"), "pixel_id")
    embedded = model.encode_pixels(features, weights)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    squares = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    given = ~F.col("nan_input")
    return embedded.select("pixel_id", "nan_input", F.size("embedding").alias("n_values"), F.when(given, F.abs(total) < 1e-2).alias("centred"),
                           F.when(given, F.abs(squares / 128 - 1) < 1e-2).alias("of_unit_variance"))


def one_season(spark, sf):
    """Monthly rows per pixel with the observations of all seasons in the first one."""
    one = lambda df: df.withColumn("ts", F.add_months("ts", -12 * (stack.composite.calendar.season_year(F.col("ts")) - SEASONS[0])))
    pixels = view(spark, sf, "v_mask")
    return stack.build_cube(tables.rename_bands(one(view(spark, sf, "v_s2"))), one(s1(spark, sf)), pixels, ["pixel_id"], SEASONS[0], SEASONS[0])


def all_seasons(spark, sf):
    """Monthly rows per pixel with the observations of all seasons in one."""
    return one_season(spark, sf).drop("season_year")


def pixel_features(spark, sf):
    from verdigrid.operators.features import build_features
    return build_features(all_seasons(spark, sf), ["pixel_id"])


def _layer_sql(start: int, n_in: int, n_out: int) -> tuple[str, str]:
    """Rows of weights, and biases, of one layer of ``sine_weights``, as lists; ``start`` is the index of its first value."""
    def value(index: str, fan_in: int) -> str:
        return f"CAST(CAST(sin({index})/sqrt({fan_in}) AS FLOAT) AS DOUBLE)"
    return (f"list_transform(range({n_out}), lambda j: list_transform(range({n_in}), lambda i: {value(f'{start} + j*{n_in} + i', n_in)}))",
            f"list_transform(range({n_out}), lambda j: {value(f'{start + n_in * n_out} + j', n_out)})")


_W0, _B0 = _layer_sql(1, SIZE, HIDDEN)
_W1, _B1 = _layer_sql(1 + SIZE * HIDDEN + HIDDEN, HIDDEN, CLASSES)
_T = f"(1/(1 + {ERF_P}*abs(x)*sqrt(0.5)))"
_TAIL = "0"
for _a in reversed(ERF_A):
    _TAIL = f"(({_TAIL} + {_a})*{_T})"
_TAIL = f"({_TAIL}*exp(-x*x/2)/2)"
MLP_SQL = f"""WITH w AS MATERIALIZED (SELECT {_W0} AS w0, {_B0} AS b0, {_W1} AS w1, {_B1} AS b1),
 e AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings),
 h AS (SELECT vec_id, w1, b1, list_transform(range({HIDDEN}), lambda j: list_inner_product(e, w0[j+1]) + b0[j+1]) AS h FROM e, w),
 g AS (SELECT vec_id, w1, b1, list_transform(h, lambda x: x*CASE WHEN x >= 0 THEN 1 - {_TAIL} ELSE {_TAIL} END) AS g FROM h)
 SELECT vec_id, {', '.join(f'round(list_inner_product(g, w1[{c + 1}]) + b1[{c + 1}], 6) AS z{c}' for c in range(CLASSES))} FROM g"""


@check("score_mlp_head", MLP_SQL)
def _(spark, sf):
    """Logits of a two-layer head on the given embeddings."""
    weights = sine_weights(head_shapes(CLASSES, inputs=SIZE))
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return model.score_head(rows, weights).select("vec_id", *columns("logits", "z", CLASSES, 6))


@check("fit_head", """SELECT label, count(*) AS support, true AS above_chance FROM embeddings GROUP BY label""")
def _(spark, sf):
    """Rows per class, and whether a head trained with balanced class weights is right more often than chance."""
    rows = table(spark, sf, "embeddings")
    weighted = rows.join(F.broadcast(metrics.class_weights(rows, "balanced")), "label")
    fitted = model.fit_head(weighted, weight="weight", iterations=30)
    hits = F.sum((F.col("pred") == F.col("label")).cast("int"))
    counts = model.apply_fitted(fitted, rows).groupBy("label").agg(F.count(F.lit(1)).alias("support"), hits.alias("hits"))
    every = Window.partitionBy()  # one row a class
    return counts.select("label", "support", (F.sum("hits").over(every) * CLASSES > F.sum("support").over(every)).alias("above_chance"))


# a class of nine in ten vectors against one of one in ten
_RARE = "CAST(label = 3 AS INT)"


@check("fit_weighted_head", f"""SELECT {_RARE} AS label, count(*) AS support, true AS copies_balanced, true AS recalled FROM embeddings WHERE label IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    """Rows of an uneven label; whether balanced weights give both classes like numbers of copies, and a weighted head with a hidden layer finds half of each."""
    rows = table(spark, sf, "embeddings").filter("label IS NOT NULL").selectExpr("vec_id", "embedding", f"{_RARE} AS label")
    weighted = rows.join(F.broadcast(metrics.class_weights(rows, "balanced")), "label")  # two rows
    copies = model.weighted_copies(weighted, "weight", ["embedding", "label"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    fitted = model.fit_head(weighted, hidden=(16,), classes=2, weight="weight", iterations=60)
    found = model.apply_fitted(fitted, rows).groupBy("label").agg(F.count(F.lit(1)).alias("support"), F.avg((F.col("pred") == F.col("label")).cast("int")).alias("_recall"))
    most = Window.partitionBy()  # two rows
    return found.join(copies, "label").select("label", "support", (F.col("n") > 0.8 * F.max("n").over(most)).alias("copies_balanced"), (F.col("_recall") >= 0.5).alias("recalled"))


@check("save_load_model", "SELECT vec_id, true AS same, true AS known FROM embeddings")
def _(spark, sf):
    """Whether a perceptron head gives the same labels after a round trip through files, and a weight table's head known classes."""
    rows = table(spark, sf, "embeddings")
    fitted = model.fit_head(rows, hidden=(16,), classes=CLASSES, iterations=20)
    path = scratch_path(spark, "head")
    model.save_model(fitted, path)
    shapes = head_shapes(CLASSES, inputs=SIZE)
    save_weights(spark, sine_weights(shapes), f"{path}-weights")
    restored = load_weights(spark.read.parquet(f"{path}-weights"), shapes)
    again = model.apply_fitted(model.load_model(path), rows).select("vec_id", F.col("pred").alias("pred_loaded"))
    mlp = model.predict(model.score_head(rows.select("vec_id", "embedding"), restored), CLASSES).select("vec_id", F.col("pred").alias("pred_mlp"))
    joined = model.apply_fitted(fitted, rows).select("vec_id", "pred").join(again, "vec_id").join(mlp, "vec_id")
    return joined.select("vec_id", (F.col("pred") == F.col("pred_loaded")).alias("same"), F.col("pred_mlp").between(0, CLASSES - 1).alias("known"))


@check("save_model", "SELECT CAST(count(DISTINCT label) AS INTEGER) AS numClasses, CAST(max(len(embedding)) AS INTEGER) AS numFeatures FROM embeddings")
def _(spark, sf):
    """Stages of a logistic head as written to files, and the number of its coefficients."""
    rows = table(spark, sf, "embeddings")
    path = scratch_path(spark, "head")
    model.save_model(model.fit_head(rows, iterations=20), path)
    stage = spark.read.parquet(f"{path}/stages/0_*/data")
    return stage.select("numClasses", "numFeatures")


@check("load_model", "SELECT vec_id, true AS same, true AS sums_to_one FROM embeddings")
def _(spark, sf):
    """Whether a head read back from files gives the same labels, and probabilities that sum to one."""
    rows = table(spark, sf, "embeddings")
    path = scratch_path(spark, "head")
    fitted = model.fit_head(rows, iterations=20)
    model.save_model(fitted, path)
    scored = model.apply_fitted(model.load_model(path), rows)
    before = model.apply_fitted(fitted, rows).select("vec_id", F.col("pred").alias("pred_before"))
    total = F.aggregate("proba", F.lit(0.0), lambda acc, p: acc + p)
    return scored.join(before, "vec_id").select("vec_id", (F.col("pred") == F.col("pred_before")).alias("same"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


def image_cells(spark, sf):
    return grid.scan_raster(cells(spark, sf), headers(spark, sf), IMAGE)


def image_cube(spark, sf):
    """Monthly rows keyed by image and cell."""
    keyed = cells(spark, sf).select(*IMAGE, *grid.CELL, "pixel_id")
    return all_seasons(spark, sf).join(keyed, "pixel_id").drop("pixel_id")


def image_months(spark, sf):
    """The same cube with one row per image and cell, which holds its twelve months: gathered where a pixel's rows lie, before copies for every run are made."""
    keyed = cells(spark, sf).select(*IMAGE, *grid.CELL, "pixel_id").hint("merge")
    place = ["pixel_id", "season_year"]
    return stack.composite.month_arrays(one_season(spark, sf).join(keyed, "pixel_id"), [*place, *IMAGE, *grid.CELL], BANDS).drop(*place)


@check("infer_image", duck("""SELECT roi, idx, grid_row, grid_col, CAST(floor(grid_row/16) AS BIGINT) AS tile_row, CAST(floor(grid_col/16) AS BIGINT) AS tile_col,
 cls = 4 AND full_id IS NOT NULL AS has_label, true AS in_range, cls = 4 AND full_id IS NULL AS nan_input FROM v_cells LEFT JOIN f ON pixel_id = full_id""",
                           "v_cells", "v_s2", "v_s1", f=FULL_SQL))
def _(spark, sf):
    """Which cells of all images get a label; pixels of class 4 are scored."""
    weights = sine_weights(inference.model_shapes(2))
    labels = inference.infer_image(image_cube(spark, sf), image_cells(spark, sf), IMAGE, weights, 2, cells(spark, sf), tile_size=16)
    return labels.select(*IMAGE, *grid.CELL, "tile_row", "tile_col", (F.col("label") > 0).alias("has_label"), F.col("label").between(0, 2).alias("in_range"), "nan_input")


# an image of every run is scored on its pixels of class 4 where it has a mask, else on all of them
_SEASON_IMAGES = """SELECT a.roi, a.year, a.idx, a.input_path, a.mask_path, a.landuse_method, a.landuse_failed, a.mask_mode, a.inference_on_full_input, a.error,
 CAST(sum(CAST(complete AND (cls = 4 OR a.landuse_failed) AS INT)) AS BIGINT) AS n_labelled, nullif(count(complete), 0) AS n_cells
 FROM audit a LEFT JOIN cell c ON a.roi = c.roi AND a.idx = c.idx GROUP BY ALL"""
_CELL = "SELECT roi, idx, cls, full_id IS NOT NULL AS complete FROM v_cells LEFT JOIN f ON pixel_id = full_id"


@check("run_season_images", duck(_SEASON_IMAGES, "v_cells", "v_s2", "v_s1", **RUN_SQL, audit=AUDIT_SQL, f=FULL_SQL, cell=_CELL))
def _(spark, sf):
    """Audit and counts of labelled cells per image of all runs, from pairing to the audit."""
    runs, inputs, masks = run_tables(spark, sf)
    weights = sine_weights(inference.model_shapes(2))
    season_cells = sinks.feature_seasons(image_cells(spark, sf), *RUNS)
    season_cube = sinks.feature_seasons(materialise(image_months(spark, sf)), *RUNS)
    predictions, rows = season_runs.run_images(runs, inputs, masks, season_cells, season_cube, sinks.feature_seasons(cells(spark, sf), *RUNS),
                                               weights, 2, BANDS)
    counts = predictions.groupBy("roi", F.col("season_year").alias("year"), "idx").agg(
        F.sum((F.col("label") > 0).cast("bigint")).alias("n_labelled"), F.count(F.lit(1)).alias("n_cells"))
    return rows.drop("timestamp", "nonfinite_pct").join(counts, ["roi", "year", "idx"], "left")
