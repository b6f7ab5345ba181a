"""Scalar functions, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import BANDS_SQL, CODES, duck, s1, table, view
from verdigrid.bands import BANDS, CHANNELS, NODATA_BY_DTYPE, S2_BANDS
from verdigrid.functions import arrays, calendar, crs, geometry as geo, names, spectral
from verdigrid.operators import features, grid, pairing, scenes
from verdigrid.sources import tables

MONTH_SQL = "CAST((month({d})-9+12) % 12 + 1 AS INT)"
YEAR_SQL = "CAST(year({d}) - CASE WHEN month({d}) < 9 THEN 1 ELSE 0 END AS INT)"


def r9(df, cols):
    """Round doubles, so that the last bits of the engines' arithmetic do not matter."""
    return df.withColumns({c: F.round(c, 9) for c in cols})


@check("filter_cloud_pct", duck("SELECT pixel_id, ts, cloud_pct FROM (SELECT pixel_id, CAST(ts AS VARCHAR) AS ts, cloud_pct FROM v_s2) WHERE cloud_pct <= 10", "v_s2"))
def _(spark, sf):
    return scenes.filter_cloud_pct(view(spark, sf, "v_s2")).select("pixel_id", F.col("ts").cast("string"), "cloud_pct")


@check("mask_qa60", duck("SELECT pixel_id, qa60, " + ", ".join(
    f"CASE WHEN (qa60 & 1024) = 0 AND (qa60 & 2048) = 0 THEN {c} END AS {n}" for c, n in zip(CODES, S2_BANDS)) + " FROM v_s2", "v_s2"))
def _(spark, sf):
    named = tables.rename_bands(view(spark, sf, "v_s2"))
    return scenes.mask_qa(named).select("pixel_id", "qa60", *S2_BANDS)


@check("filter_date_bin", duck("""SELECT pixel_id, CAST(ts AS VARCHAR) AS ts FROM v_s2 WHERE ts >= DATE '1996-11-01' AND ts < DATE '1996-12-01'""", "v_s2"))
def _(spark, sf):
    obs = view(spark, sf, "v_s2")
    in_bin = calendar.in_bin(F.col("ts"), F.lit(1996), F.lit(3))
    return obs.filter(in_bin).select("pixel_id", F.col("ts").cast("string"))


@check("filter_s1_mode", duck("""SELECT pixel_id, vv_db, round(vh_db, 9) AS vh_db FROM v_s1
 WHERE instrument_mode='IW' AND list_contains(string_split(pol_list, ','), 'VV') AND list_contains(string_split(pol_list, ','), 'VH')
 AND resolution_m = 10""", "v_s1"))
def _(spark, sf):
    return r9(scenes.filter_s1_mode(s1(spark, sf)).select("pixel_id", "vv_db", "vh_db"), ["vh_db"])


@check("db_to_linear", duck("SELECT pixel_id, round(pow(10.0, vv_db/10), 9) AS vv, round(pow(10.0, vh_db/10), 9) AS vh FROM v_s1", "v_s1"))
def _(spark, sf):
    return r9(scenes.radar_to_linear(s1(spark, sf)).select("pixel_id", "vv", "vh"), ["vv", "vh"])


@check("rename_bands", duck("SELECT pixel_id, concat('M', lpad(CAST(" + MONTH_SQL.format(d="ts") + " AS VARCHAR), 2, '0'), '_red') AS red_name, "
                            + ", ".join(f"{c} AS {n}" for c, n in zip(CODES, S2_BANDS)) + " FROM v_s2", "v_s2"))
def _(spark, sf):
    named = tables.rename_bands(view(spark, sf, "v_s2"))
    tag = names.tag_band(calendar.season_month(F.col("ts")), F.lit("red")).alias("red_name")
    return named.select("pixel_id", tag, *S2_BANDS)


@check("strip_index_prefix", duck("""SELECT l_orderkey, l_linenumber, CASE WHEN contains(full_name, '_') THEN substr(full_name, strpos(full_name, '_') + 1) ELSE '' END AS name
 FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN 'plain' ELSE concat(CAST(l_linenumber AS VARCHAR(3)), '_', name) END AS full_name FROM v_names)""", "v_names"))
def _(spark, sf):
    full = F.expr("CASE WHEN l_linenumber = 3 THEN 'plain' ELSE concat(cast(l_linenumber AS string), '_', name) END")
    return view(spark, sf, "v_names").select("l_orderkey", "l_linenumber", names.strip_index_prefix(full).alias("name"))


@check("clean_nonfinite", duck("""SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(nir) THEN nir END AS nir, CASE WHEN isfinite(red) THEN red END AS red FROM v_raw""", "v_raw"))
def _(spark, sf):
    return scenes.clean_nonfinite(view(spark, sf, "v_raw"), ["nir", "red"]).select("l_orderkey", "l_linenumber", "nir", "red")


@check("cast_band_type", """SELECT l_orderkey, l_linenumber,
 CASE WHEN trunc(l_extendedprice/100) BETWEEN 0 AND 255 THEN CAST(trunc(l_extendedprice/100) AS SMALLINT) END AS as_uint8,
 CASE WHEN trunc(l_extendedprice) BETWEEN -32768 AND 32767 THEN CAST(trunc(l_extendedprice) AS SMALLINT) END AS as_int16,
 CASE WHEN trunc(-l_quantity*3.5) BETWEEN -128 AND 127 THEN CAST(trunc(-l_quantity*3.5) AS TINYINT) END AS as_int8,
 CAST(CAST(l_quantity/8 AS FLOAT) AS DOUBLE) AS as_float FROM lineitem""")
def _(spark, sf):
    cast = spectral.cast_checked
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", cast(F.col("l_extendedprice") / 100, "uint8").alias("as_uint8"),
        cast(F.col("l_extendedprice"), "int16").alias("as_int16"), cast(-F.col("l_quantity") * 3.5, "int8").alias("as_int8"),
        cast(F.col("l_quantity") / 8, "float32").cast("double").alias("as_float"))


@check("label_shift", duck("SELECT vec_id, CAST(pred + 1 AS INT) AS label FROM v_scored", "v_scored"))
def _(spark, sf):
    return view(spark, sf, "v_scored").select("vec_id", grid.shifted_label(F.col("pred")).alias("label"))


NDVI_SQL = "CASE WHEN abs({n}+{r}) >= 1e-6 THEN greatest(-1.0, least(1.0, ({n}-{r})/({n}+{r}+1e-6))) END"
CHANNEL_SQL = ", ".join(
    f"round({NDVI_SQL.format(n=BANDS_SQL['nir'], r=BANDS_SQL['red'])}, 9) AS ndvi" if c == "ndvi"
    else f"CAST(0 AS DOUBLE) AS {c}" if c not in BANDS
    else f"{dict(vv='-l_quantity/2', vh='-l_quantity/2 - l_tax*100', **BANDS_SQL).get(c)} AS {c}" for c in CHANNELS)


@check("select_channels", "SELECT l_partkey AS pixel_id, l_linenumber AS month, " + CHANNEL_SQL + " FROM lineitem")
def _(spark, sf):
    named = {n: F.expr(e) for n, e in {**BANDS_SQL, "vv": "-l_quantity/2", "vh": "-l_quantity/2 - l_tax*100"}.items()}
    cube = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("pixel_id"), F.col("l_linenumber").alias("month"),
                                               *[e.alias(n) for n, e in named.items()])
    return r9(features.select_channels(cube, ["pixel_id"]), ["ndvi"])


@check("static_channel_mask", """SELECT p_partkey AS pixel_id, CAST(c AS INT) AS channel, CAST(c BETWEEN 12 AND 15 AS INT) AS mask,
 9 AS dynamic_world FROM part, range(17) t(c)""")
def _(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("pixel_id"),
                                           F.element_at(features.dynamic_world(), 1).alias("dynamic_world"),
                                           F.posexplode(features.channel_mask()).alias("channel", "mask"))
    return rows.select("pixel_id", "channel", "mask", "dynamic_world")


@check("season_month", "SELECT l_orderkey, l_linenumber, " + MONTH_SQL.format(d="l_shipdate") + " AS month, "
       + YEAR_SQL.format(d="l_shipdate") + " AS season_year, "
       "CAST((month(CAST(l_shipdate AS DATE) - 14)-4+12) % 12 + 1 AS INT) AS month_15apr, "
       "CAST(year(CAST(l_shipdate AS DATE) - 14) - CASE WHEN month(CAST(l_shipdate AS DATE) - 14) < 4 THEN 1 ELSE 0 END AS INT) AS year_15apr FROM lineitem")
def _(spark, sf):
    ts = F.col("l_shipdate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", calendar.season_month(ts).alias("month"), calendar.season_year(ts).alias("season_year"),
        calendar.season_month(ts, 4, 15).alias("month_15apr"), calendar.season_year(ts, 4, 15).alias("year_15apr"))


_FIRST = "make_date(CAST(year(o_orderdate) AS BIGINT) + CASE WHEN (o_custkey % 12 + 8) % 12 + 1 < 9 THEN 1 ELSE 0 END, (o_custkey % 12 + 8) % 12 + 1, 1)"


@check("bin_start_end", f"""SELECT o_orderkey, CAST(o_custkey % 12 + 1 AS INT) AS month, CAST((o_custkey % 12 + 8) % 12 + 1 AS INT) AS cal_month,
 CAST({_FIRST} AS VARCHAR) AS bin_start, CAST(CAST({_FIRST} + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS bin_end FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"),
                                             (F.col("o_custkey") % 12 + 1).cast("int").alias("month"))
    y, m = F.col("y"), F.col("month")
    return rows.select("o_orderkey", "month", calendar.calendar_month(m).alias("cal_month"),
                       calendar.bin_start(y, m).cast("string").alias("bin_start"), calendar.bin_end(y, m).cast("string").alias("bin_end"))


@check("bin_start", f"SELECT o_orderkey, CAST({_FIRST} AS VARCHAR) AS bin_start FROM orders")
def _(spark, sf):
    first = calendar.bin_start(F.year("o_orderdate"), (F.col("o_custkey") % 12 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", first.cast("string").alias("bin_start"))


@check("bin_end", f"SELECT o_orderkey, CAST(CAST({_FIRST} + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS bin_end FROM orders")
def _(spark, sf):
    last = calendar.bin_end(F.year("o_orderdate"), (F.col("o_custkey") % 12 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", last.cast("string").alias("bin_end"))


@check("ndvi", duck("SELECT l_orderkey, l_linenumber, round(" + NDVI_SQL.format(n="n", r="r") + """, 9) AS ndvi FROM
 (SELECT *, CASE WHEN l_linenumber=2 THEN CAST(0 AS DOUBLE) WHEN isfinite(nir) THEN nir END AS n,
  CASE WHEN l_linenumber=2 THEN CAST(0 AS DOUBLE) WHEN isfinite(red) THEN red END AS r FROM v_raw)""", "v_raw"))
def _(spark, sf):
    clean = scenes.clean_nonfinite(view(spark, sf, "v_raw"), ["nir", "red"])
    zero = clean.withColumns({b: F.when(F.col("l_linenumber") == 2, 0.0).otherwise(F.col(b)) for b in ("nir", "red")})
    return r9(zero.select("l_orderkey", "l_linenumber", spectral.ndvi(F.col("nir"), F.col("red")).alias("ndvi")), ["ndvi"])


_KNOWN = ", ".join(f"'{b}'" for b in BANDS)


@check("parse_band_name", duck(f"""SELECT l_orderkey, l_linenumber, name, CAST(nullif(regexp_extract(name, '^M(\\d{{2}})_(.+)$', 1), '') AS INT) AS month,
 nullif(regexp_extract(name, '^M(\\d{{2}})_(.+)$', 2), '') AS band,
 CASE WHEN NOT regexp_matches(name, '^M(\\d{{2}})_(.+)$') THEN 'bad_format'
  WHEN CAST(substr(name, 2, 2) AS INT) NOT BETWEEN 1 AND 12 THEN 'bad_month_range'
  WHEN substr(name, 5) NOT IN ({_KNOWN}) THEN 'unknown_band' ELSE 'ok' END AS status FROM v_names""", "v_names"))
def _(spark, sf):
    name = F.col("name")
    return view(spark, sf, "v_names").select("l_orderkey", "l_linenumber", "name", names.band_month(name).alias("month"),
                                             names.band_of(name).alias("band"), names.band_status(name).alias("status"))


@check("default_band_names", f"""SELECT l_orderkey, l_linenumber, pos, CASE
 WHEN pos < 168 THEN concat('M', lpad(CAST(pos // 14 + 1 AS VARCHAR), 2, '0'), '_', list_extract([{_KNOWN}], CAST(pos % 14 + 1 AS INT)))
 WHEN pos = 168 AND l_linenumber < 4 THEN 'FILL_MASK' ELSE concat('B', CAST(pos + 1 AS VARCHAR)) END AS name
 FROM (SELECT *, CAST(l_orderkey % 171 AS INT) AS pos FROM lineitem)""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("pos", (F.col("l_orderkey") % 171).cast("int"))
    return rows.select("l_orderkey", "l_linenumber", "pos",
                       names.default_band_name(F.col("pos"), F.col("l_linenumber") < 4).alias("name"))


FILES = "SELECT path FROM v_inputs UNION ALL SELECT path FROM v_masks"
STEM_SQL = "regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(.+)\\.[^.]+$', '\\1')"


def files(spark, sf):
    return view(spark, sf, "v_inputs").unionByName(view(spark, sf, "v_masks"))


@check("extract_idx", duck(f"SELECT path, CAST(regexp_extract({STEM_SQL}, '(\\d+)$', 1) AS BIGINT) AS idx FROM ({FILES})", "v_inputs", "v_masks"))
def _(spark, sf):
    return files(spark, sf).select("path", names.extract_idx(F.col("path"), strict=True).alias("idx"))


@check("path_stem", duck(f"SELECT path, {STEM_SQL} AS stem, replace(concat('a:', {STEM_SQL}), ':', '_') AS asset FROM ({FILES})", "v_inputs", "v_masks"))
def _(spark, sf):
    path = F.col("path")
    asset = F.concat(F.lit("projects/p/a:"), names.path_stem(path))
    return files(spark, sf).select("path", names.path_stem(path).alias("stem"), names.asset_name(asset).alias("asset"))


@check("natural_sort", duck(f"""SELECT path, row_number() OVER (ORDER BY coalesce(try_cast(regexp_extract({STEM_SQL}, '(\\d+)', 1) AS BIGINT), 0), path) AS pos
 FROM ({FILES})""", "v_inputs", "v_masks"))
def _(spark, sf):
    # the ids follow the operator's own order; the running total only numbers them
    from verdigrid.skew import running_total
    rows = pairing.natural_sort(files(spark, sf)).withColumns({"_at": F.monotonically_increasing_id(), "_all": F.lit(0)})
    return running_total(rows, ["_all"], [F.col("_at")], F.lit(1).cast("bigint"), "pos").select("path", "pos")


@check("common_indices", duck(f"""SELECT CAST(regexp_extract({STEM_SQL}, '(\\d+)$', 1) AS BIGINT) AS idx FROM v_inputs
 INTERSECT SELECT CAST(regexp_extract({STEM_SQL}, '(\\d+)$', 1) AS BIGINT) FROM v_masks""", "v_inputs", "v_masks"))
def _(spark, sf):
    return pairing.common_indices(view(spark, sf, "v_inputs"), view(spark, sf, "v_masks"))


@check("missing_bands", duck("""SELECT orderkey, band FROM (SELECT DISTINCT l_orderkey AS orderkey FROM v_names), (VALUES ('red'), ('red_edge4'), ('vh'), ('vv'), ('nir')) t(band)
 EXCEPT SELECT l_orderkey, regexp_extract(name, '^M(\\d{2})_(.+)$', 2) FROM v_names""", "v_names"))
def _(spark, sf):
    named = view(spark, sf, "v_names").withColumnRenamed("l_orderkey", "orderkey")
    return features.missing_bands_of(named, "orderkey", ["red", "red_edge4", "vh", "vv", "nir"])


GRID = {"a": 10.0, "b": 0.5, "c": 300000.0, "d": -0.25, "e": -10.0, "f": 4500000.0}


def affine_literals(grid=GRID):
    return {k: F.lit(float(v)) for k, v in grid.items()}


_X = "300000.0 + 10.0*(grid_col+0.5) + 0.5*(grid_row+0.5)"
_Y = "4500000.0 + -0.25*(grid_col+0.5) + -10.0*(grid_row+0.5)"


@check("pixel_center", duck(f"SELECT pixel_id, CAST({_X} AS DOUBLE) AS x, CAST({_Y} AS DOUBLE) AS y FROM v_mask", "v_mask"))
def _(spark, sf):
    x, y = geo.pixel_center(F.col("grid_row"), F.col("grid_col"), affine_literals())
    return view(spark, sf, "v_mask").select("pixel_id", x.alias("x"), y.alias("y"))


def _lonlat_sql() -> str:
    k = crs.UTM_SCALE * crs.RECTIFYING
    inverse, latitude = crs.series(crs.INVERSE), crs.series(crs.LATITUDE)
    xi1 = "xi" + "".join(f" - ({b!r})*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, b in enumerate(inverse, 1))
    eta1 = "eta" + "".join(f" - ({b!r})*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, b in enumerate(inverse, 1))
    lat = "chi" + "".join(f" + ({d!r})*sin({2 * j}*chi)" for j, d in enumerate(latitude, 1))
    return duck(f"""SELECT pixel_id, epsg,
 round(CASE epsg WHEN 4326 THEN x/100000 WHEN 3857 THEN degrees(x/6378137.0) ELSE (epsg % 100)*6.0 - 183.0 + degrees(atan2(sinh(eta1), cos(xi1))) END, 9) AS lon,
 round(CASE epsg WHEN 4326 THEN y/100000 WHEN 3857 THEN degrees(2*atan(exp(y/6378137.0)) - pi()/2) ELSE degrees({lat}) END, 9) AS lat
 FROM (SELECT *, asin(sin(xi1)/cosh(eta1)) AS chi FROM (SELECT *, {xi1} AS xi1, {eta1} AS eta1 FROM
 (SELECT *, (y - CASE WHEN epsg >= 32700 THEN 10000000.0 ELSE 0.0 END)/{k!r} AS xi, (x - 500000.0)/{k!r} AS eta FROM
 (SELECT pixel_id, CASE pixel_id % 4 WHEN 0 THEN 4326 WHEN 1 THEN 3857 WHEN 2 THEN 32633 ELSE 32719 END AS epsg,
  CAST({_X} AS DOUBLE) AS x, CAST({_Y} AS DOUBLE) AS y FROM v_mask))))""", "v_mask")


@check("to_lonlat", _lonlat_sql())
def _(spark, sf):
    x, y = geo.pixel_center(F.col("grid_row"), F.col("grid_col"), affine_literals())
    epsg = F.expr("CASE pixel_id % 4 WHEN 0 THEN 4326 WHEN 1 THEN 3857 WHEN 2 THEN 32633 ELSE 32719 END")
    rows = view(spark, sf, "v_mask").select("pixel_id", epsg.alias("epsg"), x.alias("x"), y.alias("y"))
    scale = F.when(F.col("epsg") == 4326, 100000.0).otherwise(1.0)
    lon, lat = crs.to_lonlat(F.col("x") / scale, F.col("y") / scale, F.col("epsg"))
    return rows.select("pixel_id", "epsg", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@check("pixel_offset", "SELECT l_orderkey, l_linenumber, CAST(round_even((l_quantity*5 - 2.5)/5, 0) AS BIGINT) AS off FROM lineitem")
def _(spark, sf):
    off = geo.pixel_offset(F.col("l_quantity") * 5, F.lit(2.5), F.lit(5.0))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", off.alias("off"))


@check("flat_index", duck("SELECT pixel_id, grid_row, grid_col, CAST(grid_row*50+grid_col AS BIGINT) AS flat, CAST(floor(pixel_id/50) AS BIGINT) AS back_row, CAST(pixel_id%50 AS BIGINT) AS back_col FROM v_mask", "v_mask"))
def _(spark, sf):
    width = F.lit(50)
    rows = view(spark, sf, "v_mask").withColumn("flat", geo.flat_index(F.col("grid_row"), F.col("grid_col"), width))
    return rows.select("pixel_id", "grid_row", "grid_col", "flat", geo.row_of_flat(F.col("flat"), width).alias("back_row"),
                       geo.col_of_flat(F.col("flat"), width).alias("back_col"))


_KINDS = [*NODATA_BY_DTYPE, "float32", "float64"]
_TYPES = f"list_extract({_KINDS}, CAST(p_partkey % 8 + 1 AS INT))"


@check("nodata_for_dtype", f"""SELECT p_partkey, {_TYPES} AS dtype, CAST(list_extract([0,-128,0,-32768,0,-2147483648,-9999,-9999], CAST(p_partkey % 8 + 1 AS INT)) AS BIGINT) AS nodata FROM part""")
def _(spark, sf):
    kinds = F.array(*[F.lit(t) for t in _KINDS])
    dtype = F.element_at(kinds, (F.col("p_partkey") % 8 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", dtype.alias("dtype"), spectral.nodata_for_dtype(dtype).alias("nodata"))


@check("cartesian", duck("""SELECT pixel_id, round(cos(radians(lat))*cos(radians(lon)), 9) AS x, round(cos(radians(lat))*sin(radians(lon)), 9) AS y, round(sin(radians(lat)), 9) AS z
 FROM (SELECT pixel_id, grid_row*0.7+10.3 AS lat, grid_col*1.9-40.1 AS lon FROM v_mask)""", "v_mask"))
def _(spark, sf):
    v = arrays.unit_vector(F.col("grid_row") * 0.7 + 10.3, F.col("grid_col") * 1.9 - 40.1)
    rows = view(spark, sf, "v_mask").withColumn("v", v)
    return rows.select("pixel_id", *[F.round(F.element_at("v", i + 1), 9).alias(n) for i, n in enumerate("xyz")])


@check("month_sequence", """SELECT o_orderkey, CAST(k AS INT) AS step, CAST((month(o_orderdate) - 1 + k) % 12 AS INT) AS month FROM orders, range(12) t(k)""")
def _(spark, sf):
    months = arrays.month_sequence(F.month("o_orderdate") - 1, 12)
    return table(spark, sf, "orders").select("o_orderkey", F.posexplode(months).alias("step", "month"))


@check("month_encoding", """SELECT o_orderkey, CAST(k AS INT) AS dim, round(CASE WHEN k < 4 THEN sin((month(o_orderdate)-1)*(2*pi()/12)) ELSE cos((month(o_orderdate)-1)*(2*pi()/12)) END, 9) AS value FROM orders, range(8) t(k)""")
def _(spark, sf):
    code = arrays.month_encoding(F.month("o_orderdate") - 1, 8)
    return r9(table(spark, sf, "orders").select("o_orderkey", F.posexplode(code).alias("dim", "value")), ["value"])


_Z = [f"CAST(list_extract(embedding, {i}) AS DOUBLE)" for i in range(1, 6)]
_MAX = f"greatest({', '.join(_Z)})"
_SUM = " + ".join(f"exp({z} - {_MAX})" for z in _Z)


@check("sigmoid_softmax_argmax", f"""SELECT vec_id, round(1/(1+exp(-{_Z[0]})), 9) AS sig, CAST(1/(1+exp(-{_Z[0]})) >= 0.5 AS INT) AS binary_label,
 round(1 - 1/(1+exp(-{_Z[0]})), 9) AS p_neg, {', '.join(f"round(exp({z} - {_MAX})/({_SUM}), 9) AS p{i}" for i, z in enumerate(_Z))},
 CAST(list_position([{', '.join(_Z)}], {_MAX}) - 1 AS INT) AS top FROM embeddings""")
def _(spark, sf):
    z = F.slice(F.col("embedding").cast("array<double>"), 1, 5)
    first = F.element_at(z, 1)
    p = arrays.softmax(z)
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(arrays.sigmoid(first), 9).alias("sig"), arrays.binary_label(first).alias("binary_label"),
        F.round(F.element_at(arrays.binary_probabilities(first), 1), 9).alias("p_neg"),
        *[F.round(F.element_at(p, i + 1), 9).alias(f"p{i}") for i in range(5)], arrays.argmax(z).alias("top"))


@check("sigmoid", f"SELECT vec_id, round(1/(1+exp(-{_Z[0]})), 9) AS p, CAST(1/(1+exp(-{_Z[0]})) >= 0.5 AS INT) AS label FROM embeddings")
def _(spark, sf):
    first = F.element_at("embedding", 1).cast("double")
    return table(spark, sf, "embeddings").select("vec_id", F.round(arrays.sigmoid(first), 9).alias("p"), arrays.binary_label(first).alias("label"))


@check("softmax", f"SELECT vec_id, {', '.join(f'round(exp({z} - {_MAX})/({_SUM}), 9) AS p{i}' for i, z in enumerate(_Z))} FROM embeddings")
def _(spark, sf):
    p = arrays.softmax(F.slice(F.col("embedding").cast("array<double>"), 1, 5))
    return table(spark, sf, "embeddings").select("vec_id", *[F.round(F.element_at(p, i + 1), 9).alias(f"p{i}") for i in range(5)])


@check("argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS top FROM embeddings")
def _(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", arrays.argmax(F.col("embedding")).alias("top"))


_GROUP_SQL = "SELECT * FROM (VALUES (2, 'red', 'S2_RGB', true), (9, 'red_edge4', 'S2_NIR_20m', true), (1, 'vh', 'S1', true)) t(channel, band, band_group, available)"


@check("band_group_lookup", duck("""SELECT l_orderkey, l_linenumber, g.band, CAST(channel AS INT) AS channel, band_group, available
 FROM v_names JOIN g ON regexp_extract(name, '^M(\\d{2})_(.+)$', 2) = g.band""", "v_names", g=_GROUP_SQL))
def _(spark, sf):
    rows = view(spark, sf, "v_names").select("l_orderkey", "l_linenumber", names.band_of(F.col("name")).alias("band"))
    joined = features.band_group_lookup(rows, "band")
    return joined.select("l_orderkey", "l_linenumber", "band", "channel", "band_group", "available")
