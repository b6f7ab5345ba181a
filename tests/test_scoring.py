import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigrid.bands import CHANNEL_GROUPS
from verdigrid.operators import metrics
from verdigrid.scoring import encoder, model
from verdigrid.scoring.weights import encoder_shapes, head_shapes, load_weights, save_weights, sine_weights

WEIGHTS = sine_weights({**encoder_shapes(), **head_shapes(3)})


def slow_norm(v, name):
    mean = sum(v) / len(v)
    var = sum((a - mean) ** 2 for a in v) / len(v)
    return (v - mean) / math.sqrt(var + 1e-5) * WEIGHTS[f"{name}.weight"].astype(float) + WEIGHTS[f"{name}.bias"].astype(float)


def slow_linear(v, name):
    return WEIGHTS[f"{name}.weight"].astype(float) @ v + WEIGHTS[f"{name}.bias"].astype(float)


def slow_encode(x, lat, lon, start=0):
    """One pixel, token by token, with all tokens built and the masked ones left out."""
    tokens = []
    channel = 0
    for g, (group, names, given) in enumerate(CHANNEL_GROUPS):
        for t in range(12):
            place = np.zeros(128)
            angle = 2 * math.pi * ((start + t) % 12) / 12
            place[:16], place[16:32] = math.sin(angle), math.cos(angle)
            place[32:64] = WEIGHTS["embed.channel"][g]
            for j in range(64):
                a = t / 1000 ** (2 * (j // 2) / 64)
                place[64 + j] = math.cos(a) if j % 2 else math.sin(a)
            if given:
                tokens.append(slow_linear(np.array(x[t][channel:channel + len(names)]), f"embed.{group}") + place)
        channel += len(names)
    la, lo = math.radians(lat), math.radians(lon)
    unit = np.array([math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)])
    z = [slow_linear(unit, "embed.latlon"), *tokens]
    assert len(z) == 85
    for b in range(2):
        normed = [slow_norm(v, f"block{b}.norm1") for v in z]
        qkv = [slow_linear(v, f"block{b}.qkv") for v in normed]
        mixed = [np.zeros(128) for _ in z]
        for h in range(8):
            part = slice(16 * h, 16 * h + 16)
            for i, row in enumerate(qkv):
                scores = np.array([row[:128][part] @ other[128:256][part] / 4 for other in qkv])
                share = np.exp(scores - scores.max())
                share /= share.sum()
                mixed[i][part] = sum(s * other[256:][part] for s, other in zip(share, qkv))
        z = [v + slow_linear(m, f"block{b}.proj") for v, m in zip(z, mixed)]
        for i, v in enumerate(z):
            up = slow_linear(slow_norm(v, f"block{b}.norm2"), f"block{b}.up")
            z[i] = v + slow_linear(np.array([u * 0.5 * (1 + math.erf(u / math.sqrt(2))) for u in up]), f"block{b}.down")
    return slow_norm(sum(z) / len(z), "norm")


@pytest.fixture(scope="module")
def pixels(spark):
    rng = random.Random(2)
    rows = [(i, [[rng.random() if c not in range(12, 16) else 0.0 for c in range(17)] for _ in range(12)],
             rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(70)]
    return rows, spark.createDataFrame(rows, "id INT, x ARRAY<ARRAY<DOUBLE>>, lat DOUBLE, lon DOUBLE")


def embeddings(df):
    return {r["id"]: np.array(r["embedding"]) for r in model.encode_pixels(df, WEIGHTS).collect()}


def test_against_slow_forward_pass(pixels):
    rows, df = pixels
    got = embeddings(df.filter("id < 4"))
    for i, x, lat, lon in rows[:4]:
        assert got[i] == pytest.approx(slow_encode(x, lat, lon), abs=2e-4)


def test_partitions_batches_and_masked_channels_do_not_matter(spark, pixels, monkeypatch):
    _, df = pixels
    want = embeddings(df.coalesce(1))
    other = df.withColumn("x", F.transform("x", lambda m: F.transform(m, lambda v, i: F.when(i.between(12, 15), 77.0).otherwise(v))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = embeddings(other.repartition(5))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-4)
        assert abs(v.mean()) < 1e-4 and abs(v.var() - 1) < 1e-2


def test_missing_input_is_reported(pixels):
    _, df = pixels
    holed = df.withColumn("x", F.when(F.col("id") == 3, F.transform("x", lambda m: F.transform(m, lambda v, i: F.when(i != 8, v)))).otherwise(F.col("x")))
    done = model.predict(model.score_head(model.encode_pixels(holed, WEIGHTS), WEIGHTS), 3)
    flags = {r["id"]: r["nan_input"] for r in done.collect()}
    assert flags[3] and not any(v for k, v in flags.items() if k != 3)


def test_head_and_proba(spark, pixels):
    _, df = pixels
    scored = model.score_head(model.encode_pixels(df, WEIGHTS).withColumn("keep", F.col("embedding")), WEIGHTS)
    for r in model.predict_proba(model.predict(scored, 3), 3).collect():
        z = np.array(r["keep"], dtype=float)
        up = slow_linear(z, "head0")
        want = slow_linear(np.array([u * 0.5 * (1 + math.erf(u / math.sqrt(2))) for u in up]), "head1")
        assert r["logits"] == pytest.approx(want, abs=1e-3)
        assert sum(r["proba"]) == pytest.approx(1) and r["pred"] == int(np.argmax(r["logits"]))


def test_binary_head(spark):
    df = spark.createDataFrame([([-2.0],), ([0.0],), ([800.0],), ([-800.0],)], "logits ARRAY<DOUBLE>")
    rows = model.predict_proba(model.predict(df, 1), 1).collect()
    assert [r["pred"] for r in rows] == [0, 1, 1, 0]
    assert rows[0]["proba"] == pytest.approx([0.8807970779778823, 0.11920292202211755])
    assert rows[2]["proba"] == [0.0, 1.0] and rows[3]["proba"] == [1.0, 0.0]


def test_empty_input(spark, pixels):
    _, df = pixels
    assert model.score_head(model.encode_pixels(df.filter("id < 0"), WEIGHTS), WEIGHTS).count() == 0


def test_weight_table(spark, tmp_path):
    shapes = head_shapes(3)
    save_weights(spark, sine_weights(shapes), str(tmp_path / "w"))
    table = spark.read.parquet(str(tmp_path / "w"))
    again = load_weights(table, shapes)
    assert all((again[n] == w).all() for n, w in sine_weights(shapes).items())
    with pytest.raises(ValueError):
        load_weights(table, head_shapes(4))


def test_fit_head(spark, sf, tmp_path):
    rng = random.Random(4)
    rows = [(i, c := i % 3, [rng.gauss(3.0 if j == c else 0.0, 1.0) for j in range(6)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id INT, label INT, embedding ARRAY<FLOAT>")
    weighted = df.join(metrics.class_weights(df, "balanced"), "label")
    for fitted in (model.fit_head(weighted, weight="weight"), model.fit_head(df, hidden=(8,), classes=3)):
        scored = model.apply_fitted(fitted, df)
        assert metrics.accuracy(scored).first()["accuracy"] > 0.9
        path = str(tmp_path / f"m{len(list(tmp_path.iterdir()))}")
        model.save_model(fitted, path)
        again = model.apply_fitted(model.load_model(path), df)
        assert scored.select("id", "pred").exceptAll(again.select("id", "pred")).count() == 0


def test_month_encoding_rejects_bad_start():
    with pytest.raises(ValueError):
        encoder.month_table(12, 12)


def test_tensors_listed_twice(spark):
    shapes = head_shapes(2, sizes=(), inputs=3)
    rows = [(n, list(s), [0.0] * int(np.prod(s))) for n, s in shapes.items()]
    once = spark.createDataFrame(rows, "name STRING, shape ARRAY<INT>, data ARRAY<FLOAT>")
    assert set(load_weights(once, shapes)) == set(shapes)
    with pytest.raises(ValueError, match="more than once"):
        load_weights(once.unionByName(once.limit(1)), shapes)


def test_weighted_copies(spark):
    rows = spark.range(4000).selectExpr("id", "CASE id % 4 WHEN 0 THEN 2.0 WHEN 1 THEN 5.0 WHEN 2 THEN 0.0 ELSE 3.0 END AS w")
    counts = {r["w"]: r["n"] for r in model.weighted_copies(rows, "w", ["id"]).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(counts) == {2.0, 3.0, 5.0} and counts[2.0] == 1000
    assert abs(counts[5.0] - 2500) < 80 and abs(counts[3.0] - 1500) < 80
    again = model.weighted_copies(rows.repartition(3), "w", ["id"]).groupBy("id").count()
    assert again.exceptAll(model.weighted_copies(rows, "w", ["id"]).groupBy("id").count()).count() == 0
    assert model.weighted_copies(rows.filter("w = 0"), "w", ["id"]).count() == 0


def test_scoring_is_dealt_to_many_tasks(spark):
    x = F.array(*[F.array(*[F.lit(0.1)] * 17)] * 12)
    pixels = spark.range(200).coalesce(1).select("id", x.alias("x"), F.lit(50.0).alias("lat"), F.lit(20.0).alias("lon"))
    tasks = model.encode_pixels(pixels, WEIGHTS).select("id", F.spark_partition_id().alias("p")).collect()
    assert len(tasks) == 200 and len({r["p"] for r in tasks}) >= 16  # few bytes, but costly rows: not one task


def test_gelu_in_blocks():
    x = np.linspace(-9, 9, 3 * encoder.GELU_BLOCK + 5)
    want = np.array([v * 0.5 * (1 + math.erf(v / math.sqrt(2))) for v in x[::997]])
    assert np.abs(encoder.gelu(x)[::997] - want).max() < 2e-6 and encoder.gelu(x.astype(np.float32).reshape(-1, 1)).dtype == np.float32


def test_pixels_with_missing_values_are_not_encoded(monkeypatch):
    rng = np.random.default_rng(3)
    x, lat, lon = rng.random((21, 12, 17)), rng.random(21) * 50, rng.random(21) * 20
    want = encoder.in_chunks(x, lat, lon, WEIGHTS, 0)
    assert np.isfinite(want).all()
    gaps, at = x.copy(), lat.copy()
    gaps[2, 5, encoder.CHANNELS.index("vv")], gaps[9, 0, encoder.CHANNELS.index("ndvi")], at[20] = np.nan, np.inf, np.nan
    gaps[4, 1, encoder.CHANNELS.index("era5_0")] = np.nan  # a channel that nobody supplies is not looked at
    seen = []
    monkeypatch.setattr(encoder, "encode", lambda part, *a, f=encoder.encode: seen.append(len(part)) or f(part, *a))
    got = encoder.in_chunks(gaps, at, lon, WEIGHTS, 0)
    missing = [2, 9, 20]
    assert sum(seen) == 18 and np.isnan(got[missing]).all()
    assert np.delete(got, missing, 0) == pytest.approx(np.delete(want, missing, 0), abs=1e-5)


def test_attention_looks_up_maxima_where_sums_are_not_safe(monkeypatch):
    rng = np.random.default_rng(4)
    x, lat, lon = rng.random((9, 12, 17)), rng.random(9) * 50, rng.random(9) * 20
    want = encoder.in_chunks(x, lat, lon, WEIGHTS, 0)
    monkeypatch.setattr(encoder, "SAFE_SUM", np.float32(1))
    assert encoder.in_chunks(x, lat, lon, WEIGHTS, 0) == pytest.approx(want, abs=1e-5)
    monkeypatch.undo()
    large = {n: w * np.float32(40 if n.endswith("qkv.weight") else 1) for n, w in WEIGHTS.items()}
    assert np.isfinite(encoder.in_chunks(x, lat, lon, large, 0)).all()  # logits far beyond the range of exp()


def test_months_of_images_are_one_row_a_pixel(spark, tmp_path):
    from checks import scoring

    spark.sql("SELECT id AS p_partkey, CAST(id % 50 AS INT) AS p_size FROM range(60)").write.parquet(str(tmp_path / "part.parquet"))
    spark.sql("""SELECT id AS l_orderkey, id % 60 AS l_partkey, CAST(id % 7 + 1 AS INT) AS l_linenumber, CAST(id % 50 + 1 AS DOUBLE) AS l_quantity, CAST(900 + id * 7 AS DOUBLE) AS l_extendedprice,
     (id % 9) / 100.0D AS l_discount, (id % 6) / 100.0D AS l_tax, 'N' AS l_returnflag, 'F' AS l_linestatus, CAST(date_add(DATE'1995-01-02', CAST(id * 3 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate
     FROM range(700)""").write.parquet(str(tmp_path / "lineitem.parquet"))
    keys = ["roi", "idx", "grid_row", "grid_col"]
    months = scoring.image_months(spark, str(tmp_path))
    assert months.count() == 60
    flat = months.select(*keys, F.posexplode("months").alias("month", "_m")).select(*keys, (F.col("month") + 1).alias("month"), "_m.*")
    long = scoring.image_cube(spark, str(tmp_path)).select(*flat.columns)
    assert long.count() == 720 and flat.exceptAll(long).count() == 0 and long.filter("nir IS NOT NULL").count() > 0
