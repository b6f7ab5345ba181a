"""Composites, gap filling, metrics."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.registry import check
from checks.scalars import MONTH_SQL, NDVI_SQL, YEAR_SQL, r9
from checks.views import CODES, SEASONS, duck, s1, table, view
from verdigrid.bands import BANDS, FILL_BAND, MONTHS, S1_BANDS, S2_BANDS, wide_name
from verdigrid.operators import composite, features, gapfill, metrics, pairing, stacks
from verdigrid.plans import stack, status
from verdigrid.sources import tables

def sql32(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


def f32(df, cols):
    """Single precision: the last bits of the engines' arithmetic do not matter, and whole binary fractions stay as they are."""
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in cols})


KEY = ["pixel_id"]
MONTH, YEAR = MONTH_SQL.format(d="ts"), YEAR_SQL.format(d="ts")
CLEAR = "(qa60 & 1024) = 0 AND (qa60 & 2048) = 0"
S2_CLEAR = ", ".join(f"CASE WHEN {CLEAR} THEN {c} END AS {n}" for c, n in zip(CODES, S2_BANDS))
# medians of both sensors, and the spine of all pixels, seasons and months
S2_MED = f"""SELECT pixel_id, season_year, month, {', '.join(f'median({b}) AS {b}' for b in S2_BANDS)} FROM
 (SELECT pixel_id, {YEAR} AS season_year, {MONTH} AS month, {S2_CLEAR} FROM v_s2 WHERE cloud_pct <= 10) GROUP BY ALL"""
S1_MED = f"""SELECT pixel_id, season_year, month, median(pow(10.0, vv_db/10)) AS vv, median(pow(10.0, vh_db/10)) AS vh FROM
 (SELECT pixel_id, {YEAR} AS season_year, {MONTH} AS month, vv_db, vh_db FROM v_s1 WHERE instrument_mode='IW'
  AND list_contains(string_split(pol_list, ','), 'VV') AND list_contains(string_split(pol_list, ','), 'VH') AND resolution_m = 10) GROUP BY ALL"""
SPINE = f"""SELECT pixel_id, CAST(y AS INT) AS season_year, CAST(m AS INT) AS month FROM v_mask, range({SEASONS[0]}, {SEASONS[1] + 1}) t(y), range(1, 13) u(m)"""
CUBE = f"""SELECT s.pixel_id, s.season_year, s.month, {', '.join(BANDS)} FROM spine s LEFT JOIN s2m USING (pixel_id, season_year, month)
 LEFT JOIN s1m USING (pixel_id, season_year, month)"""


def duck_cube(body: str, **extra: str) -> str:
    return duck(body, "v_s2", "v_s1", "v_mask", s2m=S2_MED, s1m=S1_MED, spine=SPINE, cube=CUBE, **extra)


def cube(spark, sf, **options):
    pixels = view(spark, sf, "v_mask")
    return stack.build_cube(tables.rename_bands(view(spark, sf, "v_s2")), s1(spark, sf), pixels, KEY, *SEASONS, **options)


@check("monthly_median_s2", duck(f"SELECT pixel_id, season_year, month, {', '.join(S2_BANDS)} FROM s2m", "v_s2", s2m=S2_MED))
def _(spark, sf):
    return stack.optical_composite(tables.rename_bands(view(spark, sf, "v_s2")), KEY)


@check("monthly_median_s1", duck("SELECT pixel_id, season_year, month, " + ", ".join(f"{sql32(b)} AS {b}" for b in S1_BANDS) + " FROM s1m", "v_s1", s1m=S1_MED))
def _(spark, sf):
    return f32(stack.radar_composite(s1(spark, sf), KEY), S1_BANDS)


@check("month_spine", duck(f"SELECT s.pixel_id, s.season_year, s.month, red, nir FROM spine s LEFT JOIN s2m USING (pixel_id, season_year, month)",
                           "v_s2", "v_mask", s2m=S2_MED, spine=SPINE))
def _(spark, sf):
    seen = stack.optical_composite(tables.rename_bands(view(spark, sf, "v_s2")), KEY, bands=["red", "nir"])
    pixels = view(spark, sf, "v_mask").withColumn("season_year", F.explode(F.sequence(*[F.lit(y) for y in SEASONS])))
    return composite.on_spine(pixels, seen, KEY, ["red", "nir"])


@check("stack_168", duck_cube("SELECT pixel_id, season_year, " + ", ".join(
    f"max(CASE WHEN month={m} THEN {b if b in S2_BANDS else sql32(b)} END) AS {wide_name(m, b)}" for m in MONTHS for b in BANDS)
    + " FROM cube GROUP BY pixel_id, season_year"))
def _(spark, sf):
    return composite.stack_wide(f32(cube(spark, sf), S1_BANDS), [*KEY, "season_year"])


@check("build_stack", duck_cube("SELECT pixel_id, season_year, month, band, " + sql32("value") + " AS value FROM (UNPIVOT cube ON "
                                + ", ".join(BANDS) + " INTO NAME band VALUE value)"))
def _(spark, sf):
    pixels = view(spark, sf, "v_mask")
    wide = stack.build_stack(tables.rename_bands(view(spark, sf, "v_s2")), s1(spark, sf), pixels, KEY, *SEASONS)
    long = composite.unstack(wide, [*KEY, "season_year"])
    return f32(long.unpivot([*KEY, "season_year", "month"], BANDS, "band", "value").filter("value IS NOT NULL"), ["value"])


def wide_lineitem(spark, sf):
    """A wide raster with a few bands of each month and the fill band, from item rows."""
    cols = {wide_name(m, b): f"l_quantity * {m} / {2 ** i}" for m in MONTHS for i, b in enumerate(BANDS)}
    return table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", *[f"{e} AS {n}" for n, e in cols.items()],
                                                  f"l_tax AS {FILL_BAND}")


_WIDE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@check("unstack_to_cube", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(m AS INT) AS month, " + ", ".join(
    f"l_quantity * m / {2 ** i} AS {b}" for i, b in enumerate(BANDS)) + " FROM lineitem, range(1, 13) t(m)")
def _(spark, sf):
    wide = composite.drop_fill_mask(wide_lineitem(spark, sf), _WIDE_KEYS)
    return composite.unstack(wide, _WIDE_KEYS)


@check("drop_fill_mask", "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
    f"l_quantity * {m} / {2 ** i} AS {wide_name(m, b)}" for m in MONTHS for i, b in enumerate(BANDS)) + " FROM lineitem")
def _(spark, sf):
    return composite.drop_fill_mask(wide_lineitem(spark, sf), _WIDE_KEYS)


@check("name_problems", duck("""SELECT l_orderkey, l_linenumber, name, CASE WHEN NOT regexp_matches(name, '^M(\\d{2})_(.+)$') THEN 'bad_format'
 WHEN CAST(substr(name, 2, 2) AS INT) NOT BETWEEN 1 AND 12 THEN 'bad_month_range' ELSE 'unknown_band' END AS problem FROM v_names
 WHERE NOT regexp_matches(name, '^M(0[1-9]|1[0-2])_(""" + "|".join(BANDS) + ")$')", "v_names"))
def _(spark, sf):
    return composite.name_problems(view(spark, sf, "v_names"))


# band names of each supplier's raster: rotated, some missing, misspelt, doubled by their default, too few or none at all
def _stacked(k: str) -> str:
    return f"concat('M', lpad(CAST(CAST(floor(({k}) / 14) AS INT) + 1 AS VARCHAR(3)), 2, '0'), '_', split_part('{','.join(BANDS)}', ',', CAST(({k}) % 14 AS INT) + 1))"


_N_BANDS = "CASE WHEN s_suppkey % 11 = 10 THEN 150 WHEN s_suppkey % 3 = 0 THEN 169 ELSE 168 END"
_RAW_NAME = f"""CASE WHEN s_suppkey % 7 = 3 OR s_suppkey % 13 = 5 AND p = n_bands - 1 OR s_suppkey % 2 = 0 AND (p + s_suppkey) % 50 = 7 THEN NULL
 WHEN p = 168 THEN '{FILL_BAND}' WHEN s_suppkey % 5 = 0 AND p = 9 THEN 'M13_red' WHEN s_suppkey % 5 = 0 AND p = 10 THEN 'M02_purple'
 WHEN s_suppkey % 5 = 0 AND p = 11 THEN 'red' ELSE {_stacked('(p + 13 * s_suppkey) % 168')} END"""
_NAMED = dict(
    h=f"SELECT s_suppkey, {_N_BANDS} AS n_bands FROM supplier",
    r=f"SELECT s_suppkey, n_bands, CAST(p AS INT) AS p, {_RAW_NAME} AS raw FROM h, range(169) t(p) WHERE p < n_bands",
    b=f"""SELECT *, coalesce(raw, CASE WHEN p < 168 THEN {_stacked('p')} WHEN s_suppkey % 7 = 3 THEN '{FILL_BAND}' ELSE concat('B', CAST(p + 1 AS VARCHAR)) END) AS name FROM r""",
    q=f"""SELECT s_suppkey, p AS position, name, CASE WHEN NOT regexp_matches(name, '^M[0-9]{{2}}_.+$') THEN 'bad_format'
 WHEN CAST(substr(name, 2, 2) AS INT) NOT BETWEEN 1 AND 12 THEN 'bad_month_range' ELSE 'unknown_band' END AS problem FROM b
 WHERE name <> '{FILL_BAND}' AND NOT regexp_matches(name, '^M(0[1-9]|1[0-2])_({'|'.join(BANDS)})$')
 UNION ALL SELECT s_suppkey, NULL, NULL, CASE WHEN s_suppkey % 7 = 3 THEN 'no names' ELSE 'names and bands differ in number' END
 FROM h WHERE CASE WHEN s_suppkey % 7 = 3 THEN n_bands = 150 ELSE s_suppkey % 13 = 5 END""",
    w="SELECT s_suppkey, CAST(m AS INT) AS month, " + ", ".join(
        f"max(CASE WHEN name = concat('M', lpad(CAST(m AS VARCHAR), 2, '0'), '_{b}') THEN p END) AS {b}" for b in BANDS)
    + " FROM b, range(1, 13) t(m) GROUP BY ALL")
_UNSTACKED = "SELECT l_orderkey, l_linenumber, l_suppkey AS s_suppkey, month, " + ", ".join(f"l_quantity * 1000 + {b} AS {b}" for b in BANDS) + " FROM lineitem JOIN w ON l_suppkey = s_suppkey"


def named_rasters(spark, sf):
    """(pixels with value arrays, headers with band names), a raster for each supplier."""
    # the names are made of a few bytes a supplier, so they are spread before
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = table(spark, sf, "supplier").repartition(tasks, "s_suppkey").selectExpr("s_suppkey", f"{_N_BANDS} AS n_bands")
    n_names = "n_bands - CASE WHEN s_suppkey % 13 = 5 THEN 1 ELSE 0 END"
    headers = counted.selectExpr("s_suppkey", "n_bands", f"CASE WHEN s_suppkey % 7 <> 3 THEN transform(sequence(0, {n_names} - 1), p -> {_RAW_NAME}) END AS band_names")
    items = table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    return items.selectExpr("l_orderkey", "l_linenumber", "s_suppkey", f"transform(sequence(0, {_N_BANDS} - 1), p -> l_quantity * 1000 + p) AS values"), headers


@check("raster_name_problems", duck("SELECT * FROM q", **_NAMED))
def _(spark, sf):
    return stacks.raster_name_problems(named_rasters(spark, sf)[1], ["s_suppkey"])


@check("unstack_rasters", duck(_UNSTACKED, **_NAMED))
def _(spark, sf):
    return stacks.unstack_rasters(*named_rasters(spark, sf), ["s_suppkey"], strict=False)


@check("unstack_rasters_strict", duck(f"{_UNSTACKED} WHERE s_suppkey NOT IN (SELECT s_suppkey FROM q)", **_NAMED))
def _(spark, sf):
    pixels, headers = named_rasters(spark, sf)
    problems = stacks.stack_problems(headers, ["s_suppkey"])
    return stacks.unstack_rasters(status.usable(pixels, problems, ["s_suppkey"]), status.usable(headers, problems, ["s_suppkey"]), ["s_suppkey"])


_BAD = "CASE WHEN {c} IS NULL OR NOT isfinite({c}) THEN 1 ELSE 0 END"


@check("nonfinite_pct", duck(f"SELECT grid_row, round(100.0*sum({_BAD.format(c='nir')} + {_BAD.format(c='red')})/(count(*)*2), 9) AS nonfinite_pct FROM v_raw GROUP BY grid_row", "v_raw"))
def _(spark, sf):
    return r9(composite.nonfinite_pct(view(spark, sf, "v_raw"), ["grid_row"], ["nir", "red"]), ["nonfinite_pct"])


_FILL = ["red", "nir", "vv"]


def duck_fill(select: str) -> str:
    return duck_cube(f"SELECT pixel_id, season_year, month, {select} FROM cube")


@check("ffill", duck_fill(", ".join(f"{sql32(f'last_value({b} IGNORE NULLS) OVER (PARTITION BY pixel_id, season_year ORDER BY month ROWS UNBOUNDED PRECEDING)')} AS {b}" for b in _FILL)))
def _(spark, sf):
    rows = cube(spark, sf).select("pixel_id", "season_year", "month", *_FILL)
    return f32(gapfill.ffill(rows, ["pixel_id", "season_year"], _FILL), _FILL)


@check("bfill", duck_fill(", ".join(f"{sql32(f'first_value({b} IGNORE NULLS) OVER (PARTITION BY pixel_id, season_year ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)')} AS {b}" for b in _FILL)))
def _(spark, sf):
    rows = cube(spark, sf).select("pixel_id", "season_year", "month", *_FILL)
    return f32(gapfill.bfill(rows, ["pixel_id", "season_year"], _FILL), _FILL)


def fill_sql(b: str) -> str:
    before = "OVER (PARTITION BY pixel_id, season_year ORDER BY month ROWS UNBOUNDED PRECEDING)"
    after = "OVER (PARTITION BY pixel_id, season_year ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    t = f"CASE WHEN {b} IS NOT NULL THEN month END"
    return (f"{b}, last_value({b} IGNORE NULLS) {before} AS {b}_lv, last_value({t} IGNORE NULLS) {before} AS {b}_lt, "
            f"first_value({b} IGNORE NULLS) {after} AS {b}_rv, first_value({t} IGNORE NULLS) {after} AS {b}_rt")


def filled_sql(b: str) -> str:
    return (f"CASE WHEN {b} IS NOT NULL THEN {b} WHEN {b}_lt IS NULL THEN {b}_rv WHEN {b}_rt IS NULL THEN {b}_lv "
            f"ELSE {b}_lv + (month - {b}_lt)/({b}_rt - {b}_lt)*({b}_rv - {b}_lv) END")


@check("interpolate_temporal", duck_cube(f"SELECT pixel_id, season_year, month, {', '.join(f'{sql32(filled_sql(b))} AS {b}' for b in _FILL)} FROM w",
                                         w=f"SELECT pixel_id, season_year, month, {', '.join(fill_sql(b) for b in _FILL)} FROM cube"))
def _(spark, sf):
    rows = cube(spark, sf).select("pixel_id", "season_year", "month", *_FILL)
    done = gapfill.interpolate_temporal(rows, ["pixel_id", "season_year"], _FILL)
    return f32(done, _FILL)


@check("valid_span", duck_cube("SELECT pixel_id, season_year, min(CASE WHEN red IS NOT NULL THEN month END) AS first_valid, max(CASE WHEN red IS NOT NULL THEN month END) AS last_valid FROM cube GROUP BY ALL"))
def _(spark, sf):
    return gapfill.valid_span(cube(spark, sf), ["pixel_id", "season_year"], "red")


_SERIES = [*[b for b in BANDS if b not in ("coastal", "water_vapor")], "ndvi"]


@check("build_features", duck_cube(f"SELECT pixel_id, season_year, month, CAST(0 AS DOUBLE) AS era5_0, {', '.join(f'{sql32(filled_sql(b))} AS {b}' for b in _SERIES)} FROM w",
                                   c2=f"SELECT *, {NDVI_SQL.format(n='nir', r='red')} AS ndvi FROM cube",
                                   w=f"SELECT pixel_id, season_year, month, {', '.join(fill_sql(b) for b in _SERIES)} FROM c2"))
def _(spark, sf):
    months = stack.build_months(tables.rename_bands(view(spark, sf, "v_s2")), s1(spark, sf), view(spark, sf, "v_mask"), KEY, *SEASONS)
    arrays = features.build_features(months, ["pixel_id", "season_year"])
    rows = arrays.select("pixel_id", "season_year", F.posexplode_outer("x").alias("_m", "_v"))  # the other form reckons x twice, for a filter on its size
    series = [*_SERIES, "era5_0"]
    at = [F.element_at("_v", features.CHANNELS.index(c) + 1).alias(c) for c in series]
    return f32(rows.select("pixel_id", "season_year", (F.col("_m") + 1).alias("month"), *at), series)


LABELS = list(range(10))


@check("accuracy", duck("SELECT round(avg(CAST(label = pred AS INT)), 12) AS accuracy FROM v_scored", "v_scored"))
def _(spark, sf):
    return metrics.accuracy(view(spark, sf, "v_scored")).select(F.round("accuracy", 12).alias("accuracy"))


_CM = "SELECT CAST(l AS INT) AS label, CAST(p AS INT) AS pred, CAST(count(vec_id) AS BIGINT) AS n FROM range(10) t(l) CROSS JOIN range(10) u(p) LEFT JOIN v_scored ON label = l AND pred = p GROUP BY ALL"


@check("confusion_matrix", duck("SELECT * FROM cm", "v_scored", cm=_CM))
def _(spark, sf):
    return metrics.confusion_matrix(view(spark, sf, "v_scored"), LABELS)


@check("confusion_matrix_pct", duck("SELECT label, pred, round(coalesce(100.0*n/nullif(sum(n) OVER (PARTITION BY label), 0), 0), 9) AS pct FROM cm", "v_scored", cm=_CM))
def _(spark, sf):
    return r9(metrics.confusion_percent(metrics.confusion_matrix(view(spark, sf, "v_scored"), LABELS)), ["pct"])


_CLS = """SELECT c.k AS k, coalesce(tp/nullif(predicted, 0), 0) AS precision, coalesce(tp/nullif(support, 0), 0) AS recall, support, tp
 FROM (SELECT label AS k, sum(n) AS support, CAST(sum(CASE WHEN label=pred THEN n ELSE 0 END) AS DOUBLE) AS tp FROM cm GROUP BY label) c
 JOIN (SELECT pred AS k, sum(n) AS predicted FROM cm GROUP BY pred) p ON c.k = p.k"""
_CLS2 = "SELECT *, coalesce(2*precision*recall/nullif(precision+recall, 0), 0) AS f1 FROM cls"
REPORT_SQL = """SELECT CAST(k AS VARCHAR) AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM c2
 UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM c2
 UNION ALL SELECT 'weighted avg', round(sum(precision*support)/sum(support), 9), round(sum(recall*support)/sum(support), 9), round(sum(f1*support)/sum(support), 9), CAST(sum(support) AS BIGINT) FROM c2
 UNION ALL SELECT 'accuracy', round(sum(tp)/sum(support), 9), round(sum(tp)/sum(support), 9), round(sum(tp)/sum(support), 9), CAST(sum(support) AS BIGINT) FROM c2"""


@check("classification_report", duck(REPORT_SQL, "v_scored", cm=_CM, cls=_CLS, c2=_CLS2))
def _(spark, sf):
    matrix = metrics.confusion_matrix(view(spark, sf, "v_scored"), LABELS)
    return r9(metrics.classification_report(matrix), ["precision", "recall", "f1"])


@check("evaluate", duck(f"""SELECT 'accuracy' AS part, 'all' AS name, round(avg(CAST(label = pred AS INT)), 9) AS value FROM v_scored
 UNION ALL SELECT 'f1', class, f1 FROM (SELECT * FROM ({REPORT_SQL}))
 UNION ALL SELECT 'cell', concat(CAST(label AS VARCHAR), '/', CAST(pred AS VARCHAR)), n FROM cm""", "v_scored", cm=_CM, cls=_CLS, c2=_CLS2))
def _(spark, sf):
    done = metrics.evaluate(view(spark, sf, "v_scored"), LABELS)
    parts = [done["accuracy"].select(F.lit("accuracy").alias("part"), F.lit("all").alias("name"), F.round("accuracy", 9).alias("value")),
             done["report"].select(F.lit("f1").alias("part"), F.col("class").alias("name"), F.round("f1", 9).alias("value")),
             done["confusion"].select(F.lit("cell").alias("part"), F.concat_ws("/", F.col("label").cast("string"), F.col("pred").cast("string")).alias("name"),
                                      F.col("n").cast("double").alias("value"))]
    return pairing.union_tiles(*parts)


_LOGITS = ", ".join(f"CAST(list_extract(embedding, {i}) AS DOUBLE)*5 AS z{i - 1}" for i in range(1, 11))
_LSE = "ln(" + " + ".join(f"exp(z{i})" for i in range(10)) + ")"
_OWN = f"list_extract([{', '.join(f'z{i}' for i in range(10))}], label + 1)"
_SOFT = "ln(1 + exp(-abs(z0)))"


@check("weighted_losses", f"""WITH z AS (SELECT vec_id, label, vec_id % 7 AS batch_id, {_LOGITS} FROM embeddings)
 SELECT 'cross_entropy' AS kind, round(avg(loss), 9) AS loss FROM (SELECT batch_id, sum((1 + label*0.25)*({_LSE} - {_OWN}))/sum(1 + label*0.25) AS loss FROM z GROUP BY batch_id)
 UNION ALL SELECT 'binary', round(avg(loss), 9) FROM (SELECT batch_id, avg(CASE WHEN label >= 5 THEN 3.0*({_SOFT} + greatest(-z0, 0)) ELSE {_SOFT} + greatest(z0, 0) END) AS loss FROM z GROUP BY batch_id)""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings").select("label", (F.col("vec_id") % 7).alias("batch_id"),
                                                 F.transform(F.slice("embedding", 1, 10), lambda v: v.cast("double") * 5).alias("logits"))
    ce = metrics.weighted_cross_entropy(rows, [1 + k * 0.25 for k in range(10)]).withColumn("kind", F.lit("cross_entropy"))
    binary = rows.select("batch_id", F.element_at("logits", 1).alias("logit"), (F.col("label") >= 5).cast("int").alias("label"))
    bce = metrics.binary_cross_entropy(binary, metrics.pos_weight(0.5, 1.5)).withColumn("kind", F.lit("binary"))
    return ce.unionByName(bce).select("kind", F.round("loss", 9).alias("loss"))


@check("class_weights", "SELECT label, round((SELECT count(*) FROM embeddings)/CAST((SELECT count(DISTINCT label) FROM embeddings)*count(*) AS DOUBLE), 9) AS weight FROM embeddings GROUP BY label")
def _(spark, sf):
    return r9(metrics.class_weights(table(spark, sf, "embeddings"), "balanced"), ["weight"])


# channel positions of the groups; elevation (14, 15) has a token for the first month only; channels and land cover are masked by pixel and month
_GROUPS = ", ".join(f"({c}, {g})" for g, cs in enumerate([(0, 1), (2, 3, 4), (5, 6, 7), (8,), (9,), (10, 11), (12, 13), (14, 15), (16,)]) for c in cs)


@check("quality_token_counts", f"""SELECT CAST(min(n) AS INT) AS min_masked, CAST(max(n) AS INT) AS max_masked, min(n) = max(n) AS equal FROM
 (SELECT p_partkey, sum(k) AS n FROM (SELECT p_partkey, g, m, max(CASE WHEN c BETWEEN 12 AND 15 OR (p_partkey + 7*c + m) % 11 = 0 THEN 1 ELSE 0 END) AS k
   FROM part, (VALUES {_GROUPS}) t(c, g), range(12) u(m) WHERE g <> 7 OR m = 0 GROUP BY ALL
  UNION ALL SELECT p_partkey, 99, m, CASE WHEN (p_partkey + m) % 5 = 0 THEN 1 ELSE 0 END FROM part, range(12) u(m)) GROUP BY p_partkey)""")
def _(spark, sf):
    masked = lambda m: F.transform(F.sequence(F.lit(0), F.lit(16)), lambda c: F.greatest(
        F.get(features.channel_mask(), c), ((F.col("pixel_id") + 7 * c + m) % 11 == 0).cast("int")))
    months = F.sequence(F.lit(0), F.lit(11))
    rows = view(spark, sf, "v_mask").select("pixel_id", F.flatten(F.transform(months, masked)).alias("mask"),
                                            F.transform(months, lambda m: ((F.col("pixel_id") + m) % 5 == 0).cast("int")).alias("land_cover_mask"))
    return metrics.masked_token_range(rows)
