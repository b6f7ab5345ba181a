"""What plans look like: lazy operators, pruned folders, clips on grids of their own."""

from pyspark.sql import functions as F

from verdigrid.bands import BANDS
from verdigrid.operators import grid, pairing, scenes, spatial
from verdigrid.plans import inference, runs
from verdigrid.scoring.weights import sine_weights

HEADER = "roi STRING, idx INT, width INT, height INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE, f DOUBLE, epsg INT"
HEADERS = [("a", 0, 6, 4, 1.0, 0.0, 10.0, 0.0, -1.0, 50.0, 4326), ("a", 1, 4, 4, 0.5, 0.0, 30.0, 0.0, -0.5, 20.0, 4326)]


def test_building_starts_no_job(spark):
    headers = spark.createDataFrame(HEADERS, HEADER)
    cells = spark.createDataFrame([("a", 0, 0, 0, 1)], "roi STRING, idx INT, grid_row BIGINT, grid_col BIGINT, cls INT")
    files = spark.createDataFrame([("a", "/x/f_1.tif")], "roi STRING, path STRING")
    spark.sparkContext.setJobGroup("lazy", "building plans")
    try:
        grid.scan_raster(cells, headers, ["roi", "idx"])
        grid.tile_with_mask(cells.drop("cls"), cells, ["roi", "idx"], 4)
        grid.tile_image_only(cells, headers, ["roi", "idx"], 4)
        pairing.pair_or_synthetic(files, files, ["roi"])
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
        grid.grid_cells(headers, ["roi", "idx"]).count()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) != []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_folders_of_other_years_are_not_opened(spark, tmp_path):
    rows = spark.sql("SELECT id, make_date(2015 + CAST(id AS INT), 10, 1) AS ts FROM range(6)")
    rows.withColumn("year", F.year("ts")).write.partitionBy("year").parquet(str(tmp_path / "s2"))
    read = scenes.filter_dates(spark.read.parquet(str(tmp_path / "s2")), "2016-09-01", "2018-09-01", year="year")
    assert {r["id"] for r in read.collect()} == {1, 2}
    assert len(read.inputFiles()) >= 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_clip_of_images_with_their_own_grids(spark):
    headers = spark.createDataFrame(HEADERS, HEADER)
    boxes = {("a", 0): (11.0, 47.0, 13.0, 49.0), ("a", 1): (30.0, 19.0, 31.0, 20.0)}
    rows = [(*k, 4326, *side) for k, (x0, y0, x1, y1) in boxes.items()
            for side in ((x0, y0, x1, y0), (x1, y0, x1, y1), (x1, y1, x0, y1), (x0, y1, x0, y0))]
    edges = spatial.edges_of_images(spark.createDataFrame(rows, "roi STRING, idx INT, epsg INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE"),
                                    headers, ["roi", "idx"], ["roi", "idx"])
    clipped = spatial.clip_images(grid.grid_cells(headers, ["roi", "idx"]), headers, edges, ["roi", "idx"], ["roi", "idx"])
    got = {(r["roi"], r["idx"], r["grid_row"], r["grid_col"]) for r in clipped.collect()}
    want = {(roi, idx, row, col) for roi, idx, w, h, a, _, c, _, e, f, _ in HEADERS for row in range(h) for col in range(w)
            if boxes[roi, idx][0] < c + a * (col + 0.5) < boxes[roi, idx][2] and boxes[roi, idx][1] < f + e * (row + 0.5) < boxes[roi, idx][3]}
    assert got == want and len(got) == 8


def sent(df):
    """The parts of a plan that are sent through the driver."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().split("\n"), []
    depths = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((k for k in range(i + 1, len(lines)) if depths[k] <= depths[i]), len(lines))
            found.append("\n".join(lines[i:end]))
    return found


def test_cells_of_few_bytes_are_not_sent_through_the_driver(spark, tmp_path):
    def kept(df, name):
        df.write.option("compression", "zstd").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    place = [F.lit("a").alias("roi"), F.lit(2018).alias("season_year"), F.lit(0).alias("idx"), F.col("id").alias("grid_row"), F.lit(0).cast("bigint").alias("grid_col")]
    cells = kept(spark.range(50_000).select(*place, F.lit(50.0).alias("lat"), F.lit(20.0).alias("lon"), F.lit(4).alias("cls")), "cells")
    months = F.array(*[F.struct(*[F.lit(0.5).alias(b) for b in BANDS])] * 12).alias("months")
    cube = kept(spark.range(3).select(*place, months), "cube")
    files = cells.select("roi", "season_year").distinct()
    inputs, masks = (files.withColumn("path", F.lit(p)) for p in ("stack/a/season2018_feat0", "cover/a/poly_0"))
    predictions, _ = runs.run_images(files, inputs, masks, cells.drop("cls"), cube, cells.drop("lat", "lon"), sine_weights(inference.model_shapes(2)), 2, BANDS)
    assert not [part for part in sent(predictions) if "grid_row" in part]
    assert predictions.groupBy(F.col("label") > 0).count().orderBy("count").collect() == [(True, 3), (False, 49_997)]

    headers = kept(spark.createDataFrame(HEADERS, HEADER), "headers")
    sides = [("a", i, 4326, *p, *q) for i, x, y, w, h in ((0, 10.0, 46.0, 6.0, 4.0), (1, 30.0, 18.0, 2.0, 2.0))
             for p, q in (((x, y), (x + w, y)), ((x + w, y), (x + w, y + h)), ((x + w, y + h), (x, y + h)), ((x, y + h), (x, y)))]
    edges = kept(spark.createDataFrame(sides, "roi STRING, idx INT, epsg INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE"), "edges")
    clipped = spatial.clip_images(grid.grid_cells(headers, ["roi", "idx"]), headers, spatial.edges_of_images(edges, headers, ["roi", "idx"], ["roi", "idx"]), ["roi", "idx"], ["roi", "idx"])
    assert not [part for part in sent(clipped) if "x0" in part or "first_col" in part] and clipped.count() == 40

    north_up = {k: F.lit(v) for k, v in dict(a=1.0, b=0.0, c=20.0, d=0.0, e=-1.0, f=50.0).items()}
    aligned = grid.align_nearest(cells.drop("cls"), north_up, cells, north_up, keys=["roi", "season_year", "idx"])
    assert not sent(aligned) and aligned.filter("cls = 4").count() == 50_000
