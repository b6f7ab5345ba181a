import math
import random

import pytest
from pyspark.sql import functions as F

from verdigrid.functions import crs
from verdigrid.operators import spatial
from verdigrid.plans.crop import check_landcover_year, crop_by_polygons

RINGS = "poly INT, rings ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"


def star(rng, cx, cy):
    n = rng.randrange(3, 12)
    return [(cx + (r := rng.uniform(1, 6)) * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)) for i in range(n)]


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(3)
    out = {i: [star(rng, rng.uniform(0, 40), rng.uniform(0, 20))] for i in range(25)}
    # a square with a hole, closed rings, both in the same direction
    out[99] = [[(2, 2), (12, 2), (12, 12), (2, 12), (2, 2)], [(5, 5), (9, 5), (9, 9), (5, 9), (5, 5)]]
    return out


@pytest.fixture(scope="module")
def edges(spark, shapes):
    rows = [(k, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for k, rings in shapes.items()]
    return spatial.ring_edges(spark.createDataFrame(rows, RINGS), ["poly"]).cache()


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
            if (y0 <= y) != (y1 <= y) and x < x0 + (y - y0) * ((x1 - x0) / (y1 - y0)):
                odd = not odd
    return odd


def test_cells(edges, shapes):
    got = {(r["poly"], r["grid_row"], r["grid_col"]) for r in spatial.polygon_cells(edges, ["poly"]).collect()}
    want = {(k, r, c) for k, rings in shapes.items() for r in range(-10, 35) for c in range(-10, 55) if inside(rings, c + 0.5, r + 0.5)}
    assert got == want


def test_cells_of_a_north_up_grid(edges, shapes):
    t = {k: F.lit(v) for k, v in dict(a=0.5, b=0.0, c=-10.0, d=0.0, e=-0.5, f=30.0).items()}
    got = {(r["poly"], r["grid_row"], r["grid_col"]) for r in spatial.polygon_cells(edges, ["poly"], t).collect()}
    want = {(k, r, c) for k, rings in shapes.items() for r in range(0, 90) for c in range(0, 130)
            if inside(rings, -10 + 0.5 * (c + 0.5), 30 - 0.5 * (r + 0.5))}
    assert got == want


def test_areas(edges):
    areas = {r["poly"]: r["area"] for r in spatial.polygon_area(edges, ["poly"]).collect()}
    assert areas[99] == pytest.approx(100 - 16)


def clip(ring, box):
    """Polygon clipped to a box, one side after the other."""
    x0, y0, x1, y1 = box
    for axis, limit, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            a, b = keep * (p[axis] - limit), keep * (q[axis] - limit)
            if a >= 0:
                out.append(p)
            if a * b < 0:
                s = a / (a - b)
                out.append((p[0] + s * (q[0] - p[0]), p[1] + s * (q[1] - p[1])))
        ring = out
    return ring


def area(ring):
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))) / 2 if ring else 0.0


def test_iou(spark, edges, shapes):
    boxes = [(i, f"/r{i}", float(i % 7 * 6), float(i // 7 * 5), float(i % 7 * 6 + 8), float(i // 7 * 5 + 6)) for i in range(35)]
    footprints = spark.createDataFrame(boxes, "raster_id INT, path STRING, bx0 DOUBLE, by0 DOUBLE, bx1 DOUBLE, by1 DOUBLE")
    got = {(r["poly"], r["raster_id"]): r["iou"] for r in spatial.iou_join(edges, ["poly"], footprints, ["raster_id"]).collect()}
    want = {}
    for k, rings in shapes.items():
        for i, _, *box in boxes:
            common = area(clip(rings[0], box)) - (area(clip(rings[1], box)) if len(rings) > 1 else 0)
            own = area(rings[0]) - (area(rings[1]) if len(rings) > 1 else 0)
            iou = common / (own + 48 - common)
            if iou >= 1e-4:
                want[(k, i)] = iou
    assert got == pytest.approx(want, abs=1e-9)


def test_ranking_ties_take_the_lower_path(spark):
    rows = [(1, "/b", 0.5), (1, "/a", 0.5), (1, "/c", 0.7)]
    ranked = spatial.rank_candidates(spark.createDataFrame(rows, "poly INT, path STRING, iou DOUBLE"), ["poly"])
    assert [r["path"] for r in ranked.orderBy("rank").collect()] == ["/c", "/a", "/b"]


def test_crop_prefers_the_best_raster_and_skips_nodata(spark):
    square = [(1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])]
    edges = spatial.ring_edges(spark.createDataFrame(square, RINGS), ["poly"])
    head = "raster_id INT, path STRING, width INT, height INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE, f DOUBLE, nodata DOUBLE"
    headers = spark.createDataFrame([(1, "/a", 4, 4, 1.0, 0.0, 0.0, 0.0, -1.0, 4.0, 0.0), (2, "/b", 8, 4, 1.0, 0.0, 0.0, 0.0, -1.0, 4.0, 0.0)], head)
    pixels = spark.createDataFrame([(i, r, c, 0 if i == 1 and c == 0 else i) for i, w in ((1, 4), (2, 8)) for r in range(4) for c in range(w)],
                                   "raster_id INT, grid_row BIGINT, grid_col BIGINT, value INT")
    grid = {k: F.lit(v) for k, v in dict(a=1.0, b=0.0, c=0.0, d=0.0, e=-1.0, f=4.0).items()}
    props = spark.createDataFrame([(1, {"name": "field"})], "poly INT, props MAP<STRING, STRING>")
    got = crop_by_polygons(edges, ["poly"], headers, pixels, grid, props=props, id_field="name").collect()
    assert {(r["poly_id"], r["grid_row"], r["grid_col"], r["value"]) for r in got} == {
        ("field", r, c, 2 if c == 0 else 1) for r in range(4) for c in range(4)}


def test_crop_refuses_rasters_of_another_step(spark):
    edges = spatial.ring_edges(spark.createDataFrame([(1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])], RINGS), ["poly"])
    head = "raster_id INT, path STRING, width INT, height INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE, f DOUBLE, nodata DOUBLE"
    headers = spark.createDataFrame([(1, "/a", 2, 2, 2.0, 0.0, 0.0, 0.0, -2.0, 4.0, 0.0)], head)
    pixels = spark.createDataFrame([(1, r, c, 1) for r in range(2) for c in range(2)], "raster_id INT, grid_row BIGINT, grid_col BIGINT, value INT")
    grid = {k: F.lit(v) for k, v in dict(a=1.0, b=0.0, c=0.0, d=0.0, e=-1.0, f=4.0).items()}
    with pytest.raises(Exception, match="steps differ"):
        crop_by_polygons(edges, ["poly"], headers, pixels, grid).collect()


def test_landcover_years():
    check_landcover_year(2017)
    with pytest.raises(ValueError):
        check_landcover_year(2025)


def test_projections(spark):
    rows = [(lon, lat, epsg) for lat in (-70.0, -33.3, -0.1, 0.0, 12.5, 51.2, 79.0)
            for lon, epsg in ((13.0, 32633), (17.9, 32633), (-69.0, 32719), (15.0, 3857), (15.0, 4326))]
    df = spark.createDataFrame(rows, "lon DOUBLE, lat DOUBLE, epsg INT")
    x, y = crs.from_lonlat(F.col("lon"), F.col("lat"), F.col("epsg"))
    there = df.withColumns({"x": x, "y": y})
    lon, lat = crs.to_lonlat(F.col("x"), F.col("y"), F.col("epsg"))
    for r in there.withColumns({"lon2": lon, "lat2": lat}).collect():
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9) and r["lat2"] == pytest.approx(r["lat"], abs=1e-9)
        if r["epsg"] == 32633 and r["lon"] == 15.0:
            assert r["x"] == pytest.approx(500000.0)


def test_utm_arc_length(spark):
    """On the central meridian the northing is the scaled meridian arc."""
    df = spark.createDataFrame([(15.0, 51.2, 32633)], "lon DOUBLE, lat DOUBLE, epsg INT")
    _, y = crs.from_lonlat(F.col("lon"), F.col("lat"), F.col("epsg"))
    e2 = crs.ECCENTRICITY ** 2
    n = 20000
    step = math.radians(51.2) / n
    radius = lambda phi: crs.SEMI_MAJOR * (1 - e2) / (1 - e2 * math.sin(phi) ** 2) ** 1.5
    arc = sum(radius((i + 0.5) * step) for i in range(n)) * step
    assert df.select(y.alias("y")).first()["y"] == pytest.approx(0.9996 * arc, abs=1e-3)
    assert df.select(crs.to_lonlat(F.lit(1.0), F.lit(1.0), F.lit(4326))[0].alias("x")).first()["x"] == 1.0


def test_unknown_system_fails(spark):
    with pytest.raises(Exception, match="unsupported EPSG"):
        spark.range(1).select(crs.to_lonlat(F.lit(1.0), F.lit(1.0), F.lit(2154))[0]).collect()


def test_threshold_zero_is_an_error():
    with pytest.raises(ValueError, match="above 0"):
        spatial.iou_join(None, ["poly"], None, ["raster_id"], threshold=0.0)


BOX = ["x0", "y0", "x1", "y1"]


@pytest.mark.parametrize("scale", [1.0, 1e-5, 1e5])
def test_box_join_in_any_unit(spark, scale):
    rng = random.Random(11)
    boxes = []
    for i in range(120):
        w, h = (rng.choice([0.0, 0.01, 1.0, 8.0, 300.0]) * rng.random() for _ in range(2))
        x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
        boxes.append((i, x * scale, y * scale, (x + w) * scale, (y + h) * scale))
    left = spark.createDataFrame(boxes[:70], "l INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    right = spark.createDataFrame(boxes[70:], "r INT, a0 DOUBLE, b0 DOUBLE, a1 DOUBLE, b1 DOUBLE")
    got = [(r["l"], r["r"]) for r in spatial.box_overlap_join(left, BOX, right, ["a0", "b0", "a1", "b1"]).collect()]
    want = {(p[0], q[0]) for p in boxes[:70] for q in boxes[70:] if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(got) == len(set(got)) and set(got) == want
    top = math.ceil(math.log2(max(max(b[3] - b[1], b[4] - b[2]) for b in boxes)))
    copies = spatial.box_cells(spatial.box_levels(left, BOX, top), BOX).groupBy("l").count()
    assert copies.agg(F.max("count")).first()[0] <= 4


def test_cover_grows_with_the_outline(spark):
    """A polygon twice as wide and high has twice the spans and four times the cells; the join lists no cell."""
    counts = []
    for size in (100, 200):
        ring = [[(0.0, 0.0), (1.0 * size, size * 0.3), (size * 0.9, 1.0 * size), (size * 0.1, size * 0.8)]]
        rings = spark.createDataFrame([("a", 1, ring)], "roi STRING, poly INT, rings ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>")
        edges = spatial.ring_edges(rings, ["roi", "poly"])
        counts.append((spatial.polygon_spans(edges, ["roi", "poly"]).count(), spatial.polygon_cells(edges, ["roi", "poly"]).count()))
    assert counts[1][0] <= 2.1 * counts[0][0] and counts[1][1] > 3.9 * counts[0][1]
    pixels = spark.range(250 * 250).selectExpr("CASE WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS roi", "CAST(floor(id/250) AS BIGINT) AS grid_row", "id % 250 AS grid_col")
    inside = {(r["grid_row"], r["grid_col"]) for r in spatial.polygon_cells(edges, ["roi", "poly"]).collect()}
    wanted = sorted((r["roi"], r["grid_row"], r["grid_col"]) for r in pixels.collect() if r["roi"] == "a" and (r["grid_row"], r["grid_col"]) in inside)
    clipped = spatial.clip_to_rois(pixels, edges, ["poly"], on=["roi"])
    assert sorted(map(tuple, clipped.collect())) == wanted and clipped.columns == pixels.columns
    paired = spatial.pixels_in_polygons(pixels, edges, ["poly"], on=["roi"])
    assert sorted((r["roi"], r["grid_row"], r["grid_col"]) for r in paired.collect()) == wanted and "poly" in paired.columns
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "explode(sequence(first_col" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_crop_sends_no_spans_or_pixels_through_the_driver(spark):
    from verdigrid.plans import crop

    edges = spark.createDataFrame([(1, 0.0, 0.0, 6.0, 0.0), (1, 6.0, 0.0, 6.0, 5.0), (1, 6.0, 5.0, 0.0, 0.0)], "poly INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    headers = spark.createDataFrame([(7, "/a", 8, 6, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0)], "raster_id INT, path STRING, width INT, height INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, "
                                    "e DOUBLE, f DOUBLE, nodata DOUBLE")
    pixels = spark.range(48).selectExpr("7 AS raster_id", "id DIV 8 AS grid_row", "id % 8 AS grid_col", "1L AS value")
    unit = {k: F.lit(v) for k, v in dict(a=1.0, b=0.0, c=0.0, d=0.0, e=1.0, f=0.0).items()}
    props = spark.createDataFrame([(1, {"id": "x"})], "poly INT, props MAP<STRING, STRING>")
    cropped = crop.crop_by_polygons(edges, ["poly"], headers, pixels, unit, props=props, id_field="id")
    plan = cropped._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.split("\n") if "BroadcastHashJoin" in line]
    assert not any(k in line for line in sent for k in ("[poly", "first_col", "grid_row"))  # only rasters' headers may be sent
    assert {(r["poly_id"], r["grid_row"], r["grid_col"]) for r in cropped.collect()} == {("x", r, c) for r in range(5) for c in range(6) if r + 0.5 < (c + 0.5) * 5 / 6}
