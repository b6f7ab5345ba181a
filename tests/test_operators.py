"""Small hand-computed tables for edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from verdigrid.bands import BANDS, FILL_BAND, WIDE_BANDS
from verdigrid.functions import arrays, calendar, geometry as geo, names, spectral
from verdigrid.operators import composite, features, grid, metrics, pairing, scenes, stacks


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_season_bins(spark):
    df = spark.createDataFrame([("2017-09-01",), ("2017-12-31",), ("2018-01-01",), ("2018-08-31",)], "d STRING")
    ts = F.col("d").cast("date")
    assert values(df, calendar.season_year(ts)) == [2017] * 4
    assert values(df, calendar.season_month(ts)) == [1, 4, 5, 12]


@pytest.mark.parametrize("month,day", [(9, 1), (1, 1), (4, 15), (12, 28)])
def test_bins_cover_each_day_once(spark, month, day):
    days = spark.createDataFrame([(dt.date(2015, 12, 25) + dt.timedelta(n),) for n in range(800)], "d DATE")
    y, m = calendar.season_year(F.col("d"), month, day), calendar.season_month(F.col("d"), month, day)
    rows = days.select("d", calendar.in_bin(F.col("d"), y, m, month, day).alias("in"), calendar.bin_start(y, m, month, day).alias("s")).collect()
    assert all(r["in"] for r in rows) and all(r["s"].day == day for r in rows)


def test_start_day_must_exist_in_every_month():
    with pytest.raises(ValueError):
        calendar.season_month(None, 9, 31)


def test_ndvi_of_dark_pixels(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.6, 0.2), (1.0, -0.4), (None, 0.2), (0.2, 0.9)], "nir DOUBLE, red DOUBLE")
    got = values(df, spectral.ndvi(F.col("nir"), F.col("red")))
    assert got[0] is None and got[3] is None
    assert got[1] == pytest.approx(0.4 / 0.800001) and got[2] == 1.0 and got[4] == pytest.approx(-0.7 / 1.100001)


def test_radar_median_is_linear(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 10, 1), -10.0, -10.0), (1, dt.date(2020, 10, 9), -20.0, -20.0)],
                               "pixel INT, ts DATE, vv_db DOUBLE, vh_db DOUBLE")
    row = composite.monthly_median(scenes.radar_to_linear(df), ["pixel"], ["vv", "vh"]).first()
    assert row["vv"] == pytest.approx(0.055) and (row["season_year"], row["month"]) == (2020, 2)


def test_masked_months_stay_missing(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 9, 1), 1024, 5.0), (1, dt.date(2020, 10, 1), 0, float("nan")), (1, dt.date(2020, 11, 1), 0, 2.0)],
                               "pixel INT, ts DATE, qa60 INT, red DOUBLE")
    clear = scenes.clean_nonfinite(scenes.mask_qa(df, ["red"]), ["red"])
    medians = composite.monthly_median(clear, ["pixel"], ["red"])
    pixels = spark.createDataFrame([(1, 2020), (2, 2020)], "pixel INT, season_year INT")
    rows = composite.on_spine(pixels, medians, ["pixel"], ["red"]).collect()
    assert len(rows) == 24
    assert [(r["pixel"], r["month"], r["red"]) for r in rows if r["red"] is not None] == [(1, 3, 2.0)]


def test_stack_round_trip(spark):
    rows = [(1, m, *[None if (m + i) % 5 == 0 else m + i / 100 for i in range(14)]) for m in range(1, 13)]
    cube = spark.createDataFrame(rows, "pixel INT, month INT, " + ", ".join(f"{b} DOUBLE" for b in BANDS))
    wide = composite.stack_wide(cube, ["pixel"])
    assert wide.columns == ["pixel", *WIDE_BANDS]
    assert composite.unstack(wide, ["pixel"]).exceptAll(cube).count() == 0
    filled = composite.drop_fill_mask(wide.withColumn(FILL_BAND, F.lit(1.0)), ["pixel"])
    assert filled.columns == wide.columns
    with pytest.raises(ValueError):
        composite.drop_fill_mask(wide.drop("M01_red"), ["pixel"])
    with pytest.raises(ValueError):
        composite.unstack(wide.withColumn("M13_red", F.lit(0.0)), ["pixel"])
    lenient = composite.unstack(wide.drop("M01_blue").withColumn("M13_red", F.lit(0.0)), ["pixel"], strict=False)
    assert lenient.filter("month = 1").first()["blue"] is None and lenient.count() == 12
    unnamed = wide.toDF("pixel", *[f"B{i}" for i in range(1, 169)])
    assert composite.unstack(unnamed, ["pixel"], by_name=False).exceptAll(cube).count() == 0


def test_names(spark):
    paths = ["/a/season2024_feat10.tif", "/a/poly_0.TIFF", "/a/x.tar.gz", "/a/.tif", "/a/roi_007.shp", "plain"]
    df = spark.createDataFrame([(p,) for p in paths], "path STRING")
    assert values(df, names.path_stem(F.col("path"))) == ["season2024_feat10", "poly_0", "x.tar", ".tif", "roi_007", "plain"]
    assert values(df, names.extract_idx(F.col("path"))) == [10, 0, None, None, 7, None]
    with pytest.raises(Exception, match="no index in file name"):
        df.select(names.extract_idx(F.col("path"), strict=True)).collect()
    mixed = spark.createDataFrame([("r10.shp",), ("r9.shp",), ("none.shp",), ("r010.shp",), ("r123456789012345678901.shp",)], "path STRING")
    assert values(pairing.natural_sort(mixed), "path") == ["none.shp", "r9.shp", "r010.shp", "r10.shp", "r123456789012345678901.shp"]
    assert features.missing_bands(["red", "nir"])[:2] == ["vv", "vh"]


def test_bands_required(spark):
    with pytest.raises(ValueError, match="missing bands"):
        features.select_channels(spark.createDataFrame([(1, 1, 0.1)], "pixel INT, month INT, red DOUBLE"), ["pixel"])


def test_offsets_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x DOUBLE")
    assert values(df, geo.pixel_offset(F.col("x"), F.lit(0.0), F.lit(1.0))) == [0, 2, 2, 0]


def test_tiles_without_class(spark):
    mask = spark.createDataFrame([(1, r, c, 2 if (r, c) == (0, 0) else 0) for r in range(4) for c in range(6)],
                                 "img INT, grid_row BIGINT, grid_col BIGINT, cls INT")
    kept = grid.tiles_with_mask(mask, ["img"], 3)
    assert [(r["tile_row"], r["tile_col"]) for r in kept.collect()] == [(0, 0)]
    tiled = grid.tile_with_mask(mask.drop("cls"), mask, ["img"], 3)
    assert tiled.count() == 9
    scored = grid.filter_class(tiled, mask, ["img", "grid_row", "grid_col"])
    assert scored.count() == 0
    labels = grid.rebuild_grid(mask, scored.withColumn("label", F.lit(1)), ["img", "grid_row", "grid_col"])
    assert labels.count() == 24 and labels.filter("label <> 0").count() == 0


def test_tile_windows_at_the_edge(spark):
    header = spark.createDataFrame([(1, 5, 4, 10.0, 0.0, 100.0, 0.0, -10.0, 500.0)],
                                   "img INT, width INT, height INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE, f DOUBLE")
    rows = grid.tile_windows(header, ["img"], 3).orderBy("tile_row", "tile_col").collect()
    assert [(r["tile_width"], r["tile_height"], r["c"], r["f"]) for r in rows] == [
        (3, 3, 100.0, 500.0), (2, 3, 130.0, 500.0), (3, 1, 100.0, 470.0), (2, 1, 130.0, 470.0)]


def test_align_between_systems(spark):
    """A class raster in degrees under an image in web mercator."""
    pixels = spark.createDataFrame([(r, c) for r in range(3) for c in range(3)], "grid_row BIGINT, grid_col BIGINT")
    mask = spark.createDataFrame([(r, c, 10 * r + c) for r in range(2) for c in range(2)], "grid_row BIGINT, grid_col BIGINT, cls INT")
    step = 111319.49079327358
    image = {k: F.lit(v) for k, v in dict(a=step, b=0.0, c=0.0, d=0.0, e=-step, f=0.0).items()}
    degrees = {k: F.lit(v) for k, v in dict(a=1.0, b=0.0, c=0.0, d=0.0, e=-1.0, f=0.0).items()}
    got = grid.align_nearest(pixels, image, mask, degrees, F.lit(3857), F.lit(4326))
    assert {(r["grid_row"], r["grid_col"]): r["cls"] for r in got.collect()} == {
        (r, c): 10 * r + c if r < 2 and c < 2 else 0 for r in range(3) for c in range(3)}


def test_report_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "label INT, pred INT")
    done = metrics.evaluate(df, [0, 1, 2, 3], {0: "dry", 1: "wet"})
    report = {r["class"]: r for r in done["report"].collect()}
    assert report["dry"]["precision"] == pytest.approx(2 / 3) and report["dry"]["recall"] == 1.0
    assert report["wet"]["precision"] == 0.0 and report["wet"]["f1"] == 0.0 and report["3"]["support"] == 0
    assert report["macro avg"]["recall"] == pytest.approx(0.5) and report["accuracy"]["f1"] == pytest.approx(0.75)
    assert done["accuracy"].first()[0] == 0.75 and done["confusion"].count() == 16
    pct = {(r["label"], r["pred"]): r["pct"] for r in metrics.confusion_percent(done["confusion"]).collect()}
    assert pct[(1, 0)] == 100.0 and pct[(3, 3)] == 0.0


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "label INT, pred INT")
    assert metrics.accuracy(empty).first()[0] == 0.0
    assert metrics.confusion_matrix(empty, [0, 1]).agg(F.sum("n")).first()[0] == 0


def test_losses(spark):
    df = spark.createDataFrame([(0, 0, [800.0, 0.0]), (0, 1, [800.0, 0.0]), (1, 1, [0.0, 0.0])], "batch_id INT, label INT, logits ARRAY<DOUBLE>")
    assert metrics.weighted_cross_entropy(df, [1.0, 3.0]).first()[0] == pytest.approx((600.0 + 0.6931471805599453) / 2)
    assert metrics.pos_weight(0.0, 2.0) == pytest.approx(2e8)
    weights = {r["label"]: r["weight"] for r in metrics.class_weights(df, {0: 2.0}).collect()}
    assert weights == {0: 2.0, 1: 0.0}


def test_nonfinite_share(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, float("nan"), float("-inf"))], "img INT, a DOUBLE, b DOUBLE")
    assert composite.nonfinite_pct(df, ["img"], ["a", "b"]).first()["nonfinite_pct"] == 75.0
    assert composite.nonfinite_pct(df.filter("img < 0"), [], ["a", "b"]).first()["nonfinite_pct"] == 0.0


def test_month_sequence_wraps_and_checks(spark):
    assert spark.range(1).select(arrays.month_sequence(F.lit(8), 6)).first()[0] == [8, 9, 10, 11, 0, 1]
    with pytest.raises(Exception, match="month must be below 12"):
        spark.range(1).select(arrays.month_sequence(F.lit(12), 2)).collect()


def named_rasters(spark):
    shuffled = [*reversed(WIDE_BANDS)]
    headers = [("plain", WIDE_BANDS, 168), ("turned", shuffled, 168), ("unnamed", None, 168), ("blank", [None] * 169, 169),
               ("odd", ["M01_red", "M13_red", "M02_purple", "red", FILL_BAND, None, "M01_red"], 7), ("short", WIDE_BANDS[:4], 6), ("nothing", [None] * 5, 5),
               ("empty", [], 0), ("unknown", None, None)]
    pixels = [(r, 1, [float(v) for v in range(n or 0)]) for r, _, n in headers] + [("lost", 1, [1.0]), ("plain", 2, None), ("turned", 2, [5.0])]
    return (spark.createDataFrame(pixels, "raster STRING, pixel INT, values ARRAY<DOUBLE>"),
            spark.createDataFrame(headers, "raster STRING, band_names ARRAY<STRING>, n_bands INT"))


def test_band_names_of_each_raster(spark):
    pixels, headers = named_rasters(spark)
    rows = {(r["raster"], r["pixel"]): r["months"] for r in stacks.raster_months(pixels, headers, ["raster"], strict=False).collect()}
    assert len(rows) == pixels.count() and all(len(m) == 12 for m in rows.values())
    flat = {k: [v for m in months for v in m] for k, months in rows.items()}
    assert flat["plain", 1] == flat["unnamed", 1] == flat["blank", 1] == [float(i) for i in range(168)]
    assert flat["turned", 1] == [float(167 - i) for i in range(168)]
    assert flat["turned", 2] == [None] * 167 + [5.0]
    # the sixth band has no name and gets its position's, which the raster does not have otherwise; of two bands of one name the last counts
    assert {i: v for i, v in enumerate(flat["odd", 1]) if v is not None} == {3: 6.0, 5: 5.0}
    assert flat["short", 1][:7] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, None] and flat["nothing", 1][:6] == [0.0, 1.0, 2.0, 3.0, 4.0, None]
    assert all(set(flat[k]) == {None} for k in [("lost", 1), ("plain", 2), ("empty", 1), ("unknown", 1)])


def test_band_name_problems_of_each_raster(spark):
    pixels, headers = named_rasters(spark)
    listed = {(r["raster"], r["position"], r["name"], r["problem"]) for r in stacks.raster_name_problems(headers, ["raster"]).collect()}
    assert listed == {("odd", 1, "M13_red", "bad_month_range"), ("odd", 2, "M02_purple", "unknown_band"), ("odd", 3, "red", "bad_format"),
                      ("short", None, None, "names and bands differ in number"), ("nothing", None, None, "no names"), ("empty", None, None, "no names"),
                      ("unknown", None, None, "no band count")}
    errors = {r["raster"]: r["error"] for r in stacks.stack_problems(headers, ["raster"]).collect()}
    assert errors == {"odd": "bad_month_range: M13_red", "short": "names and bands differ in number", "nothing": "no names", "empty": "no names", "unknown": "no band count"}
    good = pixels.filter("raster IN ('plain', 'turned', 'unnamed', 'blank') AND pixel = 1")
    assert stacks.unstack_rasters(good, headers, ["raster"]).count() == 4 * 12
    for raster, pixel, error in [("odd", 1, "M13_red"), ("short", 1, "differ in number"), ("lost", 1, "without header"), ("turned", 2, "values and the bands")]:
        with pytest.raises(Exception, match=error):
            stacks.raster_months(pixels.filter(f"raster = '{raster}' AND pixel = {pixel}"), headers, ["raster"]).collect()
    assert stacks.unstack_rasters(pixels.limit(0), headers, ["raster"]).count() == 0


def test_names_are_placed_once_a_raster_and_months_without_structs(spark):
    pixels, headers = named_rasters(spark)
    names = headers.select(stacks.band_places(F.col("band_names")).alias("places"))
    assert names._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1  # the names are not gone through for each of the bands
    plan = stacks.unstack_rasters(pixels, headers, ["raster"], strict=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct(coastal" not in plan
    long = {(r["raster"], r["pixel"], r["month"]): [r[b] for b in BANDS] for r in stacks.unstack_rasters(pixels, headers, ["raster"], strict=False).collect()}
    months = stacks.raster_months(pixels, headers, ["raster"], strict=False).collect()
    assert len(long) == 12 * len(months) and all(long[r["raster"], r["pixel"], m] == list(r["months"][m - 1]) for r in months for m in range(1, 13))
    many = spark.range(3000).select(F.col("id").alias("raster"), F.lit(168).alias("n_bands"), F.array(*[F.lit(b) for b in reversed(WIDE_BANDS)]).alias("band_names"))
    placed = many.repartition(8).select(stacks.band_places(stacks.resolved_names(F.col("band_names"), F.col("n_bands"))).alias("p"))
    assert placed.filter(F.col("p") == F.sequence(F.lit(167), F.lit(0))).count() == 3000


def test_unstack_projects_each_month_of_a_row(spark):
    wide = spark.range(3).select(F.col("id").alias("a b"), *[(F.col("id") * 1000 + i).alias(n) for i, n in enumerate(WIDE_BANDS) if i != 5])
    long = composite.unstack(wide, ["a b"])
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan  # no array of twelve structs
    got = {(r["a b"], r["month"]): [r[b] for b in BANDS] for r in long.collect()}
    assert long.columns == ["a b", "month", *BANDS] and len(got) == 36
    assert got == {(i, m): [None if (m, k) == (1, 5) else i * 1000.0 + 14 * (m - 1) + k for k in range(14)] for i in range(3) for m in range(1, 13)}
