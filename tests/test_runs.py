import json

import pytest
from pyspark.sql import functions as F

from verdigrid.bands import BANDS
from verdigrid.operators import pairing
from verdigrid.plans import inference, runs as season_runs
from verdigrid.scoring.weights import sine_weights
from verdigrid.sources import sinks, tables

KEYS = ["roi", "season_year", "idx"]


def files(spark, rows):
    return spark.createDataFrame(rows, "roi STRING, season_year INT, path STRING")


@pytest.fixture(scope="module")
def run(spark):
    runs = spark.createDataFrame([("a", 2018), ("a", 2016), ("b", 2018), ("empty", 2018)], "roi STRING, season_year INT")
    inputs = files(spark, [(r, y, f"/in/{r}/season{y}_feat{i}.tif") for r, y in (("a", 2018), ("a", 2016), ("b", 2018)) for i in (0, 1)]
                   + [("a", 2018, "/in/a/old_feat1.tif"), ("b", 2018, "/in/b/season2018_feat7.tif")])
    masks = files(spark, [("a", 2018, "/m/poly_1.tif"), ("a", 2016, "/m/poly_1.tif"), ("b", 2018, "/m/poly_5.tif")])
    images = [(r, y, i) for r, y in (("a", 2018), ("a", 2016), ("b", 2018)) for i in (0, 1)]
    cells = spark.createDataFrame([(*k, row, col, 50.0 - row, 20.0 + col) for k in images for row in range(2) for col in range(3)],
                                  "roi STRING, season_year INT, idx BIGINT, grid_row BIGINT, grid_col BIGINT, lat DOUBLE, lon DOUBLE")
    cube = (cells.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).select(
        *KEYS, "grid_row", "grid_col", "month", *[(F.col("month") * (i + 1) / 100 + F.col("grid_col") / 7).alias(b) for i, b in enumerate(BANDS)])
        .withColumn("vv", F.when(F.col("month") % 3 > 0, F.col("vv"))))
    classes = cells.select(*KEYS, "grid_row", "grid_col", F.when(F.col("grid_col") == 1, 4).otherwise(2).alias("cls"))
    weights = sine_weights(inference.model_shapes(2))
    return season_runs.run_images(runs, inputs, masks, cells, cube, classes, weights, 2, BANDS)


def test_audit(run):
    rows = {(r["roi"], r["year"], r["idx"]): r for r in run[1].collect()}
    assert set(rows) == {("a", 2018, 1), ("a", 2016, 0), ("a", 2016, 1), ("b", 2018, 0), ("b", 2018, 1), ("b", 2018, 7), ("empty", 2018, -1)}
    cropped = rows[("a", 2018, 1)]
    assert cropped["mask_mode"] == pairing.CROPPED and not cropped["inference_on_full_input"] and cropped["error"] is None
    assert cropped["input_path"] == "/in/a/season2018_feat1.tif" and cropped["nonfinite_pct"] == pytest.approx(100 / 3 / 14)
    early = rows[("a", 2016, 0)]
    assert early["mask_mode"] == pairing.SYNTHETIC and early["landuse_failed"] and "2016" in early["error"]
    assert "no matching" in rows[("b", 2018, 0)]["error"]
    assert rows[("b", 2018, 7)]["error"] == "no pixel rows for input" and rows[("b", 2018, 7)]["nonfinite_pct"] is None
    assert rows[("empty", 2018, -1)]["landuse_failed"] and rows[("empty", 2018, -1)]["mask_mode"] is None


def test_labels(run):
    got = {(r["roi"], r["season_year"], r["idx"], r["grid_row"], r["grid_col"]): r["label"] for r in run[0].collect()}
    assert len(got) == 5 * 6
    for (roi, year, _, _, col), label in got.items():
        scored = (roi, year) != ("a", 2018) or col == 1
        assert label in (1, 2) if scored else label == 0


def test_sinks(spark, run, tmp_path):
    predictions = run[0].drop("nan_input")
    headers = predictions.select(*KEYS).distinct().withColumns({"width": F.lit(3), "height": F.lit(2)})
    sinks.write_predictions(predictions, headers, str(tmp_path / "out"))
    again = spark.read.parquet(str(tmp_path / "out" / "labels"))
    assert again.count() == 30 and set(KEYS) <= set(again.columns)
    for wrong in (headers.withColumn("width", F.lit(4)), headers.withColumns({"width": F.lit(2), "height": F.lit(3)})):
        with pytest.raises(ValueError, match="does not fit"):
            sinks.write_predictions(predictions, wrong, str(tmp_path / "bad"))
    for _ in range(2):
        sinks.append_audit(run[1], str(tmp_path / "audit"))
    assert sinks.read_audit(spark, str(tmp_path / "audit")).count() == 14


def test_no_common_index_gives_synthetic_masks(spark):
    inputs = spark.createDataFrame([("/a_1.tif",), ("/a_2.tif",)], "path STRING")
    masks = spark.createDataFrame([("/m_3.tif",)], "path STRING")
    assert {r["mask_mode"] for r in pairing.pair_or_synthetic(inputs.withColumn("run", F.lit(1)), masks.withColumn("run", F.lit(1)), ["run"]).collect()} == {pairing.SYNTHETIC}
    assert pairing.pair_by_idx(inputs, masks, []).count() == 0
    assert pairing.common_indices(inputs, masks).count() == 0


FEATURES = [{"type": "Feature", "properties": {"name": f"f{i}"}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]}}
            for i in range(40)] + [{"type": "Feature", "properties": {"name": "none"}, "geometry": None}]


def test_rois_per_line(spark, tmp_path):
    folder = tmp_path / "rois"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join(json.dumps(f) for f in FEATURES[:15]))
    (folder / "b.jsonl").write_text("\n".join(json.dumps(f) for f in FEATURES[15:]))
    rows = tables.load_rois(spark, str(folder)).orderBy("feat_idx").collect()
    assert [r["feat_idx"] for r in rows] == list(range(41))
    assert [r["props"]["name"] for r in rows] == [f["properties"]["name"] for f in FEATURES]
    assert rows[3]["rings"][0][1]["x"] == 4.0 and rows[40]["rings"] is None


def test_rois_of_a_collection(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}))
    rows = tables.load_rois(spark, str(tmp_path / "c.json"), per_line=False).collect()
    assert {(r["feat_idx"], r["props"]["name"]) for r in rows} == {(i, f["properties"]["name"]) for i, f in enumerate(FEATURES)}


def test_list_rasters(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("b.tif", "a.TIFF", "c.txt", "sub/d.Tif"):
        (tmp_path / name).write_bytes(b"x")
    listed = [r["path"] for r in tables.list_rasters(spark, str(tmp_path)).collect()]
    assert [p.rsplit("/", 1)[1] for p in listed] == ["a.TIFF", "b.tif", "d.Tif"]


def test_multipolygons_and_broken_lines(spark, tmp_path):
    square = lambda x: [[[x, 0], [x + 1, 0], [x + 1, 1], [x, 0]]]
    feature = {"type": "Feature", "properties": {"name": "two"}, "geometry": {"type": "MultiPolygon", "coordinates": [square(0), square(5)]}}
    good, bad, odd = (tmp_path / n for n in ("good.jsonl", "bad.jsonl", "odd.jsonl"))
    good.write_text(json.dumps(feature))
    rings = tables.load_rois(spark, str(good)).first()["rings"]
    assert [r[0]["x"] for r in rings] == [0.0, 5.0]
    bad.write_text(json.dumps(feature) + "\n{broken")
    odd.write_text(json.dumps({**feature, "geometry": {"type": "Polygon", "coordinates": [["x"]]}}))
    for path in (bad, odd):
        with pytest.raises(Exception):
            tables.load_rois(spark, str(path)).collect()


def test_files_without_index_are_errors(spark):
    inputs = spark.createDataFrame([("/a_1.tif",), ("/noindex.tif",), (f"/b_{'9' * 30}.tif",)], "path STRING")
    masks = spark.createDataFrame([("/m_1.tif",)], "path STRING")
    with pytest.raises(Exception, match="no index"):
        pairing.pair_by_idx(inputs, masks, []).collect()
    assert pairing.pair_by_idx(inputs, masks, [], strict=False).count() == 1
    assert {r["path"][:3] for r in pairing.nameless_files(inputs).collect()} == {"/no", "/b_"}


def test_grids_are_compared_cell_by_cell(spark):
    cells = [("a", 0, 0), ("a", 0, 1), ("a", 1, 0), ("a", 1, 1)]
    frame = lambda rows: spark.createDataFrame(rows, "roi STRING, grid_row INT, grid_col INT")
    headers = spark.createDataFrame([("a", 2, 2)], "roi STRING, width INT, height INT")
    wrong = lambda rows: [r["roi"] for r in sinks.incomplete_grids(frame(rows), headers, ["roi"]).collect()]
    assert wrong(cells) == []
    assert wrong([*cells[:3], cells[0]]) == ["a"] and wrong([*cells, cells[0]]) == ["a"] and wrong([*cells, ("b", 0, 0)]) == ["b"]


def test_trained_head_and_missing_input(spark):
    from verdigrid.scoring import model

    cells = spark.createDataFrame([("a", 2018, 0, 0, c, 50.0, 20.0 + c) for c in range(6)],
                                  "roi STRING, season_year INT, idx BIGINT, grid_row BIGINT, grid_col BIGINT, lat DOUBLE, lon DOUBLE")
    cube = (cells.drop("lat", "lon").withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).select(
        *KEYS, "grid_row", "grid_col", "month", *[(F.col("month") * (i + 1) / 100 + F.col("grid_col") / 7).alias(b) for i, b in enumerate(BANDS)])
        .withColumn("vv", F.when(F.col("grid_col") != 5, F.col("vv"))))
    weights = sine_weights(inference.model_shapes(2))
    embedded = spark.createDataFrame([(i % 2, [float(i % 2)] * 128) for i in range(20)], "label INT, embedding ARRAY<FLOAT>")
    fitted = model.fit_head(embedded)
    own, trained = ({r["grid_col"]: (r["label"], r["nan_input"]) for r in inference.infer_image(cube, cells, KEYS, weights, 2, fitted=f).collect()}
                    for f in (None, fitted))
    for got in (own, trained):
        assert len(got) == 6 and got[5] == (0, True) and all(got[c][0] in (1, 2) and not got[c][1] for c in range(5))


def test_failed_check_publishes_nothing(spark, tmp_path):
    cells = spark.createDataFrame([("a", 2018, 0, r, c, 1) for r in range(2) for c in range(3)], "roi STRING, season_year INT, idx INT, grid_row BIGINT, grid_col BIGINT, label SMALLINT")
    headers = spark.createDataFrame([("a", 2018, 0, 3, 2)], "roi STRING, season_year INT, idx INT, width INT, height INT")
    path = tmp_path / "out"
    with pytest.raises(ValueError, match="does not fit"):
        sinks.write_predictions(cells, headers.withColumn("width", F.lit(4)), str(path))
    assert not any(p.is_file() for p in path.rglob("*.parquet"))
    sinks.write_predictions(cells, headers, str(path))
    assert spark.read.parquet(f"{path}/labels").count() == 6 and sorted(p.name for p in path.iterdir()) == ["headers", "labels"]
    with pytest.raises(FileExistsError):
        sinks.write_predictions(cells, headers, str(path))
    with pytest.raises(ValueError, match="does not fit"):
        sinks.write_predictions(cells.limit(5), headers, str(path), mode="overwrite")
    assert spark.read.parquet(f"{path}/labels").count() == 6
    sinks.write_predictions(cells.withColumn("label", F.lit(2).cast("smallint")), headers, str(path), mode="overwrite")
    assert spark.read.parquet(f"{path}/labels").filter("label = 2").count() == 6


def test_batches_of_the_audit(spark, run, tmp_path):
    path = str(tmp_path / "audit")
    for batch in ("one", "two", "one", None):
        sinks.append_audit(run[1], path, batch)
    read = sinks.read_audit(spark, path)
    assert read.count() == 21 and [f.name for f in read.schema] == [n for n, _ in sinks.AUDIT_FIELDS]
    sinks.append_audit(run[1].limit(2), path, "two")
    assert sinks.read_audit(spark, path).count() == 16
    with pytest.raises(ValueError):
        sinks.append_audit(run[1], path, "a/b")
