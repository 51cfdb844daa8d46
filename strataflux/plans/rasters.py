"""Queries on images: bands, focusing, moving windows, interpolation and crops.

Vectors stand for pixels of one image of 20 columns, whose 32 complex values are those of the dates; customers, in order of their keys, for pixels with places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflux.operators import imaging
from strataflux.plans.queries import query, table

WIDTH, DATES, PATCH = 20, 32, (4, 4)


def pixels(spark, sf_dir) -> DataFrame:
    k = F.col("vec_id")
    part = lambda a: F.transform(F.slice("embedding", a, DATES), lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)))
    e = table(spark, sf_dir, "embeddings").where(k.isNotNull() & F.col("embedding").isNotNull())
    return e.select(F.lit(0).alias("image"), F.floor(k / WIDTH).alias("row"), (k % WIDTH).alias("col"), part(1).alias("re"), part(DATES + 1).alias("im"))


_DATE_STEP = 7
SPECTRUM_SQL = f"""(WITH e AS (SELECT vec_id // {WIDTH} AS r, vec_id % {WIDTH} AS c, embedding FROM embeddings), n AS (SELECT max(r) + 1 AS rows, max(c) + 1 AS cols FROM e),
  p AS (SELECT r // 4 AS pi, c // 4 AS pj, r % 4 AS y, c % 4 AS x, d, embedding[d + 1]::DOUBLE AS re, embedding[d + 33]::DOUBLE AS im FROM e, n, range(0, {DATES}, {_DATE_STEP}) AS t(d) WHERE r // 4 * 4 + 4 <= rows AND c // 4 * 4 + 4 <= cols),
  f AS (SELECT pi, pj, d, u, v, sum(re * cos(a) + im * sin(a)) AS a, sum(im * cos(a) - re * sin(a)) AS b FROM (SELECT *, 2 * pi() * (u * y + v * x) / 4 AS a FROM p, range(-2, 2) AS s(u), range(-2, 2) AS q(v)) GROUP BY ALL),
  w AS (SELECT u, v, a * a + b * b AS power FROM f)
  SELECT 0 AS image, 'row' AS axis, u AS k, sum(power) AS power FROM w GROUP BY u UNION ALL SELECT 0, 'col', v, sum(power) FROM w GROUP BY v)"""


@query(f"SELECT image, axis, k, round(power, 6) AS power FROM {SPECTRUM_SQL}")
def image_spectrum(spark, sf_dir):
    """Power of each frequency along and across, over whole patches and every seventh date."""
    return imaging.spectrum(pixels(spark, sf_dir), PATCH, _DATE_STEP).select("image", "axis", "k", F.round("power", 6).alias("power"))


_BINS = "SELECT l_returnflag AS image, CASE WHEN l_linestatus = 'F' THEN 'row' ELSE 'col' END AS axis, l_suppkey % 40 - 20 AS k, sum(CASE WHEN l_quantity * (l_suppkey % 7) > 250 THEN l_quantity ELSE 0 END) AS power FROM lineitem GROUP BY ALL"


@query(
    f"""WITH s AS ({_BINS}), a AS (SELECT *, min(k) OVER w AS lowest FROM s WINDOW w AS (PARTITION BY image, axis)), m AS (SELECT image, axis, max(power) AS top FROM s GROUP BY ALL),
  r AS (SELECT image, axis, lowest, k - row_number() OVER (PARTITION BY image, axis ORDER BY k) AS run, k FROM a JOIN m USING (image, axis) WHERE power > 0.15 * top),
  g AS (SELECT image, axis, any_value(lowest) AS lowest, min(k) AS first, max(k) AS last FROM r GROUP BY image, axis, run),
  o AS (SELECT *, row_number() OVER (PARTITION BY image, axis ORDER BY last - first DESC, first) AS n FROM g)
SELECT image, axis, CASE WHEN last > first THEN first ELSE lowest END AS first, CASE WHEN last > first THEN last ELSE lowest END AS last FROM o WHERE n = 1"""
)
def occupied_band(spark, sf_dir):
    """The longest run of frequencies above a share of the greatest power."""
    li, k = table(spark, sf_dir, "lineitem"), F.col("l_suppkey")
    power = F.sum(F.when(F.col("l_quantity") * (k % 7) > 250, F.col("l_quantity")).otherwise(0.0))
    s = li.groupBy(F.col("l_returnflag").alias("image"), F.when(F.col("l_linestatus") == "F", "row").otherwise("col").alias("axis"), (k % 40 - 20).alias("k")).agg(power.alias("power"))
    return imaging.band(s)


@query()
def refocus_image(spark, sf_dir):
    """Minimum-variance and amplitude-and-phase images on a grid twice as fine, from the band that the image itself occupies."""
    p = pixels(spark, sf_dir)
    size, least = (8, 8), (2, 2)
    out = imaging.refocused(p, imaging.band(imaging.spectrum(p, size, _DATE_STEP)), size, least=least)
    mean = lambda a, b: F.round(F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x) / DATES), 6)
    return out.select("image", "row", "col", mean("capon_re", "capon_im").alias("capon"), mean("apes_re", "apes_im").alias("apes"))


@query()
def linked_pixels(spark, sf_dir):
    """Phases of every pixel from the pixels like it in the window around it."""
    out = imaging.linked(pixels(spark, sf_dir), half=(2, 3), tile=(16, 8), least=5)
    return out.select("image", "row", "col", "n_shp", F.round("gamma", 6).alias("gamma"), F.transform("phases", lambda x: F.round(x, 5)).alias("phases"), "ds")


_EVENTS = "(SELECT event_id // 100 AS r, event_id % 100 AS c, value AS v FROM events)"


@query(
    f"""WITH g AS {_EVENTS}, z AS (SELECT max(r) + 1 AS n, max(c) + 1 AS m FROM g),
  y AS (SELECT i, least(floor(p)::BIGINT, n - 2) AS y0, p - least(floor(p)::BIGINT, n - 2) AS fy FROM (SELECT i, n, i * (n - 1) / (2 * n - 1) AS p FROM z, range(0, 2 * n) AS t(i))),
  x AS (SELECT j, least(floor(p)::BIGINT, m - 2) AS x0, p - least(floor(p)::BIGINT, m - 2) AS fx FROM (SELECT j, m, j * (m - 1) / (2 * m - 1) AS p FROM z, range(0, 2 * m) AS t(j)))
SELECT 0 AS image, i AS row, j AS col, round((a.v * (1 - fx) + b.v * fx) * (1 - fy) + (c.v * (1 - fx) + d.v * fx) * fy, 6) AS value FROM y, x JOIN g a ON a.r = y0 AND a.c = x0 JOIN g b ON b.r = y0 AND b.c = x0 + 1 JOIN g c ON c.r = y0 + 1 AND c.c = x0 JOIN g d ON d.r = y0 + 1 AND d.c = x0 + 1"""
)
def zoomed_raster(spark, sf_dir):
    """A raster of 100 columns, read at twice as many places in both directions."""
    k = F.col("event_id")
    g = table(spark, sf_dir, "events").select(F.lit(0).alias("image"), F.floor(k / 100).alias("row"), (k % 100).alias("col"), "value")
    shape = imaging.sizes(g).select("image", (F.col("rows") * 2).alias("to_rows"), (F.col("cols") * 2).alias("to_cols"))
    return imaging.zoomed(g, shape, (16, 16)).withColumn("value", F.round("value", 6))


@query(
    """WITH p AS (SELECT c_custkey // 25 AS r, c_custkey % 25 AS c, 37.0 + c_custkey // 25 * 0.0004 + c_custkey % 25 * 0.00001 AS lat, 128.0 + c_custkey % 25 * 0.0005 AS lon FROM customer), z AS (SELECT max(r) + 1 AS n, max(c) + 1 AS m FROM p),
  v AS (SELECT n_nationkey AS key, 37.0 + n_nationkey * 0.0008 + e * 0.0016 AS lat, 128.0 + n_nationkey % 5 * 0.002 + e * 0.004 AS lon FROM nation, (VALUES (0), (1)) AS t(e)),
  b AS (SELECT key, min(lat) - 30.0 / 111320 AS s, max(lat) + 30.0 / 111320 AS n, min(lon) - 30.0 / (111320 * cos(radians(37.0))) AS w, max(lon) + 30.0 / (111320 * cos(radians(37.0))) AS e FROM v GROUP BY key),
  f AS (SELECT key, (min(r) + max(r)) // 2 AS cy, (min(c) + max(c)) // 2 AS cx, greatest((max(r) - min(r)) // 2 + 1, 2) AS hy, greatest((max(c) - min(c)) // 2 + 1, 4) AS hx FROM p JOIN b ON lat BETWEEN s AND b.n AND lon BETWEEN w AND e GROUP BY key HAVING count(*) >= 10),
  o AS (SELECT key, greatest(cy - hy, 0) AS row0, least(cy + hy, n) AS row1, greatest(cx - hx, 0) AS col0, least(cx + hx, m) AS col1 FROM f, z)
SELECT * FROM o WHERE row1 - row0 >= 2 AND col1 - col0 >= 5"""
)
def crop_windows(spark, sf_dir):
    """The rows and columns around each structure that a second pass works on."""
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    row, col = F.floor(k / 25), k % 25
    p = table(spark, sf_dir, "customer").select(F.lit(0).alias("image"), row.alias("row"), col.alias("col"), (37.0 + row * 0.0004 + col * 0.00001).alias("lat"), (128.0 + col * 0.0005).alias("lon"))
    v = table(spark, sf_dir, "nation").select(n.cast("long").alias("key"), F.lit(0).alias("image"), F.lit(37.0).alias("lat0"), F.explode(F.array(F.lit(0), F.lit(1))).alias("e"))
    v = v.withColumns({"lat": 37.0 + F.col("key") * 0.0008 + F.col("e") * 0.0016, "lon": 128.0 + F.col("key") % 5 * 0.002 + F.col("e") * 0.004})
    return imaging.crops(p, imaging.boxes(v, 30.0), least=(4, 8), patch=(2, 5), least_pixels=10).drop("image")


@query("SELECT event_id // 100 AS row, count(*) AS n, round(sum(CAST(value AS FLOAT)::DOUBLE), 4) AS total, CAST(CAST(event_id // 100 AS BIGINT) % 3 AS INT) AS part FROM events GROUP BY event_id // 100")
def raster_round_trip(spark, sf_dir):
    """A raster of 100 columns written in order by many tasks, three rasters in all, and read back by byte ranges."""
    from strataflux.sources import rasters
    from strataflux.streaming.cycle import shared

    k = F.col("event_id")
    # Each row's values in order of its columns: a row has 100.
    g = table(spark, sf_dir, "events").groupBy(F.floor(k / 100).alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), F.col("value").alias("v")))), lambda x: x["v"]).alias("re"))
    path = f"{shared(spark)}/raster"
    rasters.write_ordered(g.withColumn("part_of", F.concat(F.lit("b"), (F.col("row") % 3).cast("string"))), ["row"], path)
    back = rasters.read_raster(spark, path, 100, split=4000)
    part = F.regexp_extract("file", "b([0-2])$", 1).cast("int")
    return back.select((F.col("row") * 3 + part).alias("row"), F.size("re").cast("long").alias("n"), F.round(F.aggregate("re", F.lit(0.0), lambda s, x: s + x), 4).alias("total"), part.alias("part"))


@query(
    """WITH p AS (SELECT p_partkey AS k, p_partkey % 17 AS r, p_partkey AS c, p_retailprice AS h FROM part WHERE p_size > 10) SELECT row_number() OVER (ORDER BY r, c) AS id, r AS row, c AS col, round(h, 3) AS height FROM p"""
)
def numbered_candidates(spark, sf_dir):
    """Candidates numbered in order of row and column, as the inputs of a scatterer run have them."""
    from strataflux.sources import rasters

    k = F.col("p_partkey")
    c = table(spark, sf_dir, "part").where("p_size > 10").select((k % 17).alias("row"), k.alias("col"), F.col("p_retailprice").alias("height"))
    return rasters.numbered(c, ["row", "col"]).select("id", "row", "col", F.round("height", 3).alias("height"))


@query("WITH d AS (SELECT event_type AS tile, count(DISTINCT CAST(ts AS DATE)) AS n FROM events GROUP BY 1), i AS (SELECT event_type AS tile, avg(value - 20) AS m FROM events WHERE value - 20 > 0 GROUP BY 1) SELECT tile, n AS n_dates, round(m, 6) AS inc_mean, n >= 29 AS done FROM d LEFT JOIN i USING (tile)")
def window_meta(spark, sf_dir):
    """What is known of each window, and whether it has dates enough."""
    from strataflux.sources import rasters

    e = table(spark, sf_dir, "events")
    out = rasters.window_meta(e.select(F.col("event_type").alias("tile"), F.to_date("ts").alias("date")), e.select(F.col("event_type").alias("tile"), F.array(F.col("value") - 20).alias("re")), 29)
    return out.select("tile", "n_dates", F.round("inc_mean", 6).alias("inc_mean"), "done")
