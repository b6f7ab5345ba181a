"""Groups above the row limit give the same results as small ones."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from verdigrid import skew
from verdigrid.operators import spatial
from verdigrid.plans import stack

ROWS = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(ROWS):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 60)
        rows.append((key, rng.choice([None, float(rng.randrange(50)), rng.random()]), rng.random() if key != 3 else None))
    return rows, spark.createDataFrame(rows, "k INT, a DOUBLE, b DOUBLE")


@pytest.mark.parametrize("limit", [None, 10, 100, 10_000])
def test_median(skewed, limit):
    rows, df = skewed
    got = {r["k"]: (r["a"], r["b"]) for r in skew.exact_median(df, ["k"], ["a", "b"], limit).collect()}
    for k in {r[0] for r in rows}:
        for i in (0, 1):
            values = [r[i + 1] for r in rows if r[0] == k and r[i + 1] is not None]
            want = statistics.median(values) if values else None
            assert got[k][i] == (pytest.approx(want) if values else None)


def test_median_without_broadcast(skewed, monkeypatch):
    rows, df = skewed
    want = {tuple(r) for r in skew.exact_median(df, ["k"], ["a"], None).collect()}
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in skew.exact_median(df, ["k"], ["a"], 20).collect()} == want


@pytest.mark.parametrize("limit", [None, 10, 10_000])
def test_row_numbers(skewed, limit):
    rows, df = skewed
    numbered = df.withColumn("id", F.monotonically_increasing_id()).fillna(-1.0, ["a"])
    got = skew.row_numbers(numbered, ["k"], [F.col("a").desc(), F.col("id")], "no", limit).collect()
    assert len(got) == ROWS
    for k in {r[0] for r in rows}:
        group = sorted((r for r in got if r["k"] == k), key=lambda r: (-r["a"], r["id"]))
        assert [r["no"] for r in group] == list(range(1, len(group) + 1))


def test_cube_with_hot_pixel(spark, sf):
    from checks.aggregates import KEY
    from checks.views import SEASONS, s1, table, view
    from verdigrid.sources.tables import rename_bands

    def cube(limit):
        optical = rename_bands(view(spark, sf, "v_s2")).withColumn("pixel_id", F.expr("CASE WHEN cloud_pct < 5 THEN 7 ELSE pixel_id END"))
        radar = s1(spark, sf).withColumn("pixel_id", F.expr("CASE WHEN vv_db < -12 THEN 7 ELSE pixel_id END"))
        built = stack.build_cube(optical, radar, view(spark, sf, "v_mask"), KEY, *SEASONS, hot_rows=limit)
        return {tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in built.collect()}

    whole = cube(None)
    assert len(whole) == table(spark, sf, "part").count() * 8 * 12
    assert cube(200) == whole


def test_medians_look_for_hot_pixels_by_default(spark, monkeypatch):
    """A pixel-month above the limit is not gathered into one list by a caller that gives no limit."""
    one = spark.range(skew.HOT_ROWS + 1000).selectExpr("1L AS pixel_id", "TIMESTAMP '2019-10-03' AS ts", "0D AS cloud_pct", "0 AS qa60", "CAST(id % 1000 AS DOUBLE) AS red",
                                                    "'IW' AS instrument_mode", "array('VV', 'VH') AS pols", "10 AS resolution_m", "0D AS vv_db", "0D AS vh_db")
    seen = []
    plain = skew.median_of_hot
    for module in (skew, stack):
        monkeypatch.setattr(module, "median_of_hot", lambda *a: seen.append(1) or plain(*a))
    assert [r.red for r in stack.optical_composite(one, ["pixel_id"], bands=["red"]).collect()] == [499.5]
    empty = one.limit(0)
    cube = stack.build_cube(one, empty, one.select("pixel_id").limit(1), ["pixel_id"], 2019, 2019, bands=["red"])
    assert [r.red for r in cube.collect() if r.red is not None] == [499.5]
    assert len(seen) == 2


def test_polygon_cells_of_hot_rows(spark, sf):
    from checks.views import edges
    plain = {tuple(r) for r in spatial.polygon_cells(edges(spark, sf), ["poly"], hot_rows=None).collect()}
    assert {tuple(r) for r in spatial.polygon_cells(edges(spark, sf), ["poly"], hot_rows=2).collect()} == plain


def test_iou_with_chunked_edges(spark, sf, monkeypatch):
    from checks.joins import footprints
    from checks.views import edges

    def pairs():
        found = spatial.iou_join(edges(spark, sf), ["poly"], footprints(spark, sf), ["raster_id"], 1e-6)
        return {(r["poly"], r["raster_id"]): r["iou"] for r in found.collect()}

    whole = pairs()
    monkeypatch.setattr(spatial, "EDGES_PER_CHUNK", 1)
    assert pairs() == pytest.approx(whole, abs=1e-12)
