"""Queries on the smaller operators: weather at the pass, dates, offsets, phases, axes, the register, lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflux.functions import expr
from strataflux.operators import deck, history, kernels, qc, registry, results, spatial, structures, timeline, windows
from strataflux.plans.composed import JUDGED, decks, points, series
from strataflux.plans.queries import observations, obs_sql, query, table
from strataflux.sources import search


@query(
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS temp, max(value) FILTER (event_id % 3 > 0) AS rh FROM events GROUP BY ALL) SELECT event_type, strftime(hour, '%Y%m%d') AS date, round(temp, 6) AS temp, round(rh, 6) AS rh FROM h WHERE hour(hour) = 9 AND temp IS NOT NULL AND rh IS NOT NULL"""
)
def at_pass(spark, sf_dir):
    """The hour of the pass on days on which all its values are known."""
    e = table(spark, sf_dir, "events")
    h = e.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.avg("value").alias("temp"), F.max(F.when(F.col("event_id") % 3 > 0, F.col("value"))).alias("rh"))
    return timeline.at_pass(h, "hour", 9, ["temp", "rh"]).select("event_type", F.date_format("hour", "yyyyMMdd").alias("date"), F.round("temp", 6).alias("temp"), F.round("rh", 6).alias("rh"))


_DATES = "(SELECT o_custkey % 9 AS track, CAST(o_orderdate AS DATE) AS date, min(o_orderkey * 37 % 460) - 230 AS bperp, 0.9 + min(o_orderkey % 11) / 100 AS gamma FROM orders GROUP BY ALL)"


@query(
    f"""WITH d AS {_DATES}, k AS (SELECT * FROM d WHERE (abs(bperp) <= 200 AND gamma >= 0.95) OR date = DATE '1995-06-01'), m AS (SELECT track, coalesce(max(date) FILTER (date = DATE '1995-06-01'), min(date)) AS master FROM k GROUP BY track)
SELECT track, CAST(date AS VARCHAR) AS date, CAST(master AS VARCHAR) AS master FROM k JOIN m USING (track)"""
)
def kept_dates(spark, sf_dir):
    """Dates that hold, with the master or, without one, the first of them in its place."""
    o = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 9).alias("track"), F.to_date("o_orderdate").alias("date")).agg((F.min(F.col("o_orderkey") * 37 % 460) - 230).alias("bperp"), (0.9 + F.min(F.col("o_orderkey") % 11) / 100).alias("gamma"))
    return qc.keep_dates(o, ["track"], F.lit("1995-06-01").cast("date")).select("track", F.col("date").cast("string").alias("date"), F.col("master").cast("string").alias("master"))


@query(
    """WITH c AS (SELECT event_type, event_id % 3 AS attempt, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY ALL), b AS (SELECT event_type, date, max(n) AS n FROM c GROUP BY ALL)
SELECT event_type, CAST(date AS VARCHAR) AS date, n FROM (SELECT *, max(n) OVER (PARTITION BY event_type) AS m FROM b) WHERE n >= 0.8 * m"""
)
def available_dates(spark, sf_dir):
    """Dates that nearly all bursts cover, from three searches of which none lowers a count."""
    e = table(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 3).alias("attempt"), F.to_date("ts").alias("date"))
    return search.available_dates(e, ["event_type"]).withColumn("date", F.col("date").cast("string"))


@query(
    """WITH k AS (SELECT o_custkey % 50 AS track, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderkey % 4 = 0), l AS (SELECT o_custkey % 50 AS track, max(CAST(o_orderdate AS DATE)) AS date FROM orders GROUP BY 1),
  u AS (SELECT * FROM k UNION SELECT * FROM l) SELECT track, CAST(date AS VARCHAR) AS date, 'known' AS set FROM u UNION ALL SELECT track, CAST(date AS VARCHAR), 'needed' FROM (SELECT * FROM k UNION SELECT track, DATE '1996-01-01' FROM k)"""
)
def known_and_needed(spark, sf_dir):
    """Dates that are there as scenes or results, and those that interferograms need."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("track"), F.to_date("o_orderdate").alias("date"), "o_orderkey")
    some = o.where("o_orderkey % 4 = 0")
    known = timeline.known_dates(some, o, ["track"]).withColumn("set", F.lit("known"))
    needed = timeline.needed_dates(some, F.lit("1996-01-01").cast("date"), ["track"]).withColumn("set", F.lit("needed"))
    return known.unionByName(needed).withColumn("date", F.col("date").cast("string"))


@query(
    """WITH p AS (SELECT l_suppkey AS k, median(l_extendedprice - l_quantity) AS m, count(*) AS n FROM lineitem WHERE l_partkey % 23 = 0 GROUP BY 1), s AS (SELECT l_suppkey AS k, median(l_quantity) AS m, count(*) AS n FROM lineitem WHERE l_partkey % 19 = 0 GROUP BY 1),
  f AS (SELECT l_suppkey AS k, median(l_discount) AS m, count(*) AS n FROM lineitem WHERE l_partkey % 97 = 0 GROUP BY 1)
SELECT coalesce(s.k, p.k) AS k, round(CASE WHEN p.n >= 5 THEN p.m WHEN s.n >= 5 THEN s.m - CASE WHEN f.n >= 3 THEN f.m ELSE 0 END END, 6) AS "offset", CASE WHEN p.n >= 5 THEN 'pairs' WHEN s.n >= 5 THEN 'ground' END AS how FROM s FULL JOIN p ON s.k = p.k LEFT JOIN f ON f.k = coalesce(s.k, p.k)"""
)
def aligned_offset(spark, sf_dir):
    """Offsets of a second pass by pairs, or by the ground where pairs are few."""
    li = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_suppkey"))
    pairs = li.where("l_partkey % 23 = 0").select("k", (F.col("l_extendedprice") - F.col("l_quantity")).alias("diff"))
    second, first = li.where("l_partkey % 19 = 0").select("k", F.col("l_quantity").alias("value")), li.where("l_partkey % 97 = 0").select("k", F.col("l_discount").alias("value"))
    return spatial.aligned_offset(pairs, second, first, ["k"]).withColumn("offset", F.round("offset", 6))


@query("SELECT p_size AS tile, p_partkey AS point, p_retailprice AS da FROM (SELECT *, rank() OVER (PARTITION BY p_size ORDER BY floor(p_retailprice / 20)) AS r FROM part) WHERE r <= 4")
def top_with_ties(spark, sf_dir):
    """The points of least dispersion in each tile, with all that tie."""
    p = table(spark, sf_dir, "part").withColumn("by", F.floor(F.col("p_retailprice") / 20))
    return spatial.top_with_ties(p, ["p_size"], "by", 4).select(F.col("p_size").alias("tile"), F.col("p_partkey").alias("point"), F.col("p_retailprice").alias("da"))


@query("SELECT l_shipdate::DATE::VARCHAR AS date, round(avg(l_quantity - 5) FILTER (l_quantity > 5) / avg(l_tax * 100) FILTER (l_tax > 0), 6) AS calamp FROM lineitem GROUP BY 1")
def amplitude_ratios(spark, sf_dir):
    """Mean slave amplitude of each date over that of the master."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").cast("string").alias("date"), (F.col("l_quantity") - 5).alias("s"), (F.col("l_tax") * 100).alias("m"))
    return kernels.amplitude_ratio(li, ["date"], "s", "m").select("date", F.round("calamp", 6).alias("calamp"))


@query("SELECT bridge FROM (SELECT c_custkey AS bridge, CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 5 - 1 END AS level, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 11 / 10 END AS r_now, c_name AS name, c_mktsegment AS city FROM customer) WHERE name LIKE '%1%' AND city = 'BUILDING' ORDER BY coalesce(level, -2) DESC, coalesce(r_now, 0) DESC, bridge LIMIT 400")
def list_view(spark, sf_dir):
    """The first rows of the list, worst first, of one city and names that hold a text."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k.alias("bridge"), F.when(k % 7 > 0, k % 5 - 1).alias("level"), F.when(k % 3 > 0, k % 11 / 10).alias("r_now"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"))
    return results.listing(c, "bridge", city="BUILDING", name="1").select("bridge")


@query(
    f"""WITH o AS (SELECT bridge, d, y FROM {obs_sql()} WHERE (bridge + month(d)) % 4 > 0), a AS (SELECT DISTINCT d FROM o), b AS (SELECT DISTINCT bridge FROM o)
SELECT bridge, string_agg(coalesce(CAST(CAST(y AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY d) AS v FROM b CROSS JOIN a LEFT JOIN o USING (bridge, d) GROUP BY bridge"""
)
def date_axis(spark, sf_dir):
    """Series on the axis of all dates."""
    o = observations(spark, sf_dir).where((F.col("bridge") + F.month("d")) % 4 > 0)
    v = results.fill_axis(o, ["bridge"], "d", "y")
    return v.select("bridge", F.array_join(F.transform("values", lambda x: F.coalesce(x.cast("long").cast("string"), F.lit("-"))), ",").alias("v"))


@query("WITH a AS (SELECT DISTINCT o_custkey % 40 AS track, date_trunc('month', o_orderdate) AS date FROM orders), b AS (SELECT DISTINCT o_custkey % 40 AS track, date_trunc('month', o_orderdate) AS date FROM orders WHERE o_orderkey % 9 > 0) SELECT a.track, count(*) FILTER (b.date IS NULL) AS missing FROM a LEFT JOIN b ON a.track = b.track AND a.date = b.date GROUP BY a.track")
def axes_alignment(spark, sf_dir):
    """How many dates of one pass the other lacks."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("track"), F.trunc("o_orderdate", "month").alias("date"), "o_orderkey")
    return qc.align_axes(o, o.where("o_orderkey % 9 > 0"), ["track"])


@query("WITH c AS (SELECT round_even((c_custkey * 7 % 400) / 100 * 4, 0) / 4 AS lat, round_even((c_custkey * 13 % 300) / 100 * 4, 0) / 4 AS lon, c_acctbal FROM customer), w AS (SELECT n_nationkey % 5 AS lat, n_nationkey % 4 * 0.75 AS lon, max(n_nationkey) AS temp FROM nation GROUP BY ALL) SELECT c.lat, c.lon, count(*) AS n, max(temp) AS temp FROM c LEFT JOIN w ON w.lat = c.lat AND w.lon = c.lon GROUP BY ALL")
def weather_cells(spark, sf_dir):
    """Points joined with the weather of their quarter-degree cell."""
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    lat, lon = search.weather_cell((k * 7 % 400) / 100, (k * 13 % 300) / 100)
    c = table(spark, sf_dir, "customer").select(lat.alias("lat"), lon.alias("lon"))
    w = table(spark, sf_dir, "nation").groupBy((n % 5).cast("double").alias("lat"), (n % 4 * 0.75).alias("lon")).agg(F.max("n_nationkey").alias("temp"))
    return c.join(w, ["lat", "lon"], "left").groupBy("lat", "lon").agg(F.count("*").alias("n"), F.max("temp").alias("temp"))


@query(
    """WITH v AS (SELECT c_nationkey AS k, c_custkey * 6151 % 300 + c_custkey % 7 * 40.0 AS x, c_custkey * 3571 % 300 + c_custkey % 7 * 65.0 AS y FROM customer), m AS (SELECT k, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy FROM v GROUP BY k),
  a AS (SELECT k, atan2(2 * xy, xx - yy) / 2 AS t FROM m), u AS (SELECT k, cos(t) * CASE WHEN sin(t) < 0 THEN -1 ELSE 1 END AS ax, sin(t) * CASE WHEN sin(t) < 0 THEN -1 ELSE 1 END AS ay FROM a),
  e AS (SELECT k, ax, ay, max(x * ax + y * ay) - min(x * ax + y * ay) AS es, max(y * ax - x * ay) - min(y * ax - x * ay) AS ec FROM v JOIN u USING (k) GROUP BY ALL)
SELECT k, round(ax, 6) AS ax, round(ay, 6) AS ay, round(es, 4) AS extent_s, round(ec, 4) AS extent_c, round(greatest(es, k * 20), 4) AS len, round(least(greatest(CASE WHEN k % 2 = 0 THEN ec ELSE CASE WHEN k % 3 = 0 THEN 10 ELSE k % 3 END + ec END, 6), 40), 4) AS width,
  round((degrees(atan2(ax, ay)) % 180 + 180) % 180, 4) AS bearing FROM e"""
)
def deck_axes(spark, sf_dir):
    """Axes, extents and sizes of decks from their vertices."""
    c = F.col("c_custkey")
    v = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), (c * 6151 % 300 + c % 7 * 40.0).alias("x"), (c * 3571 % 300 + c % 7 * 65.0).alias("y"))
    a = deck.axes(v, ["k"])
    k = F.col("k")
    length, width = deck.deck_size(F.col("extent_s"), F.col("extent_c"), (k * 20).cast("double"), (k % 3).cast("double"), k % 2 == 0)
    r = lambda x, n, to=None: F.round(x, n).alias(to or x)
    return a.select("k", r("ax", 6), r("ay", 6), r("extent_s", 4), r("extent_c", 4), r(length, 4, "len"), r(width, 4, "width"), r("bearing", 4))


@query(
    """SELECT o_orderkey AS k, round((o_totalprice % 360 - 128) * 111320 * cos(radians(37.5)) / 1000, 5) AS x, round((o_totalprice % 90 - 37.5) * 111320 / 1000, 5) AS y, round(o_totalprice / 1000 / cos(radians(38.7)), 6) AS vert, round(-(o_totalprice % 7) * 0.05546576 / (4 * pi()) * 1000, 6) + 0.0 AS mm,
  round(o_totalprice % 7 - coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 0.5 END, 0) - coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 0.25 END, 0), 6) AS corrected, round(o_totalprice % 30 * 4 * pi() / 55.46576, 5) AS phase, round(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 365.25, 8) AS t,
  CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'd' END || o_custkey % 150 || CASE WHEN o_orderkey % 5 = 0 THEN '_2018' ELSE '' END AS key FROM orders"""
)
def phase_chain(spark, sf_dir):
    """Coordinates, projections, phases, times and keys of tracks."""
    o = table(spark, sf_dir, "orders")
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    r = lambda x, n, name: F.round(x, n).alias(name)
    return o.select(
        k.alias("k"), r(expr.local_x(p % 360, F.lit(128.0), F.lit(37.5)) / 1000, 5, "x"), r(expr.local_y(p % 90, F.lit(37.5)) / 1000, 5, "y"), r(expr.vertical(p / 1000, F.lit(38.7)), 6, "vert"), (F.round(expr.phase_to_mm(p % 7), 6) + 0.0).alias("mm"),
        r(expr.corrected_phase(p % 7, F.when(k % 2 == 0, 0.5), F.when(k % 3 == 0, 0.25)), 6, "corrected"), r(expr.mm_to_phase(p % 30), 5, "phase"), r(expr.decimal_years(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")), 8, "t"),
        expr.track_key(F.when(k % 2 == 0, "ASCENDING").otherwise("DESCENDING"), F.col("o_custkey") % 150, F.when(k % 5 == 0, "_2018")).alias("key"),
    )


@query(
    JUDGED
    + """, mn AS (SELECT bridge, date, avg(y) AS v, avg(yc) AS c FROM nc GROUP BY ALL) SELECT bridge, CAST(date AS VARCHAR) AS date, round((v - coalesce(g, 0)) * cos(radians(38.7)), 5) AS los, round(v - coalesce(g, 0), 5) AS vert, round(c - coalesce(g, 0), 5) AS vert_tc FROM mn LEFT JOIN gts USING (bridge, date)"""
)
def structure_series(spark, sf_dir):
    """The series of a structure against the ring: line of sight, vertical, and without the thermal part."""
    parts = structures.deck_parts(decks(spark, sf_dir), points(spark, sf_dir), series(spark, sf_dir))
    out = structures.structure_series(parts.nodes, parts.ring_series, F.lit(38.7))
    return out.select("bridge", F.col("date").cast("string").alias("date"), *(F.round(c, 5).alias(c) for c in ("los", "vert", "vert_tc")))


@query(
    """WITH s AS (SELECT s_suppkey AS bridge, s_name AS name, round(s_suppkey % 50 / 7, 4) AS lat, round(s_suppkey % 30 / 9, 4) AS lon FROM supplier), r AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE -c_custkey - 1 END AS bridge, 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS name, c_custkey % 50 / 7 AS lat, c_custkey % 30 / 9 AS lon, c_acctbal FROM customer),
  n AS (SELECT name, lat, lon, max(bridge) AS bridge FROM s GROUP BY ALL)
SELECT bridge, c_acctbal AS value FROM r WHERE bridge IN (SELECT bridge FROM s) UNION ALL SELECT n.bridge, c_acctbal FROM r JOIN n ON n.name = r.name AND n.lat = round(r.lat, 4) AND n.lon = round(r.lon, 4) WHERE r.bridge NOT IN (SELECT bridge FROM s)"""
)
def known_structures(spark, sf_dir):
    """Results of structures that are still in the register, by id or by name and place."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    reg = table(spark, sf_dir, "supplier").select(s.alias("bridge"), F.col("s_name").alias("name"), (s % 50 / 7).alias("lat"), (s % 30 / 9).alias("lon"))
    res = table(spark, sf_dir, "customer").select(F.when(c % 3 == 0, c).otherwise(-c - 1).alias("bridge"), F.concat(F.lit("Supplier#"), F.lpad(c.cast("string"), 9, "0")).alias("name"), (c % 50 / 7).alias("lat"), (c % 30 / 9).alias("lon"), F.col("c_acctbal").alias("value"))
    return history.known_structures(res, reg).select("bridge", "value")


@query("SELECT l_partkey AS tile FROM lineitem GROUP BY 1 HAVING avg(CASE WHEN l_tax <> 0 THEN 1 ELSE 0 END) >= 0.9 * max(0.95)")
def valid_cuts(spark, sf_dir):
    """Windows whose cut is whole."""
    return windows.valid_cuts(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("tile"), "l_tax"), ["tile"], "l_tax", F.lit(0.95))


def register(spark, sf_dir) -> DataFrame:
    """Customers as rows of the register, under its own column names."""
    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    cols = {
        "name": F.col("c_name"), "class_code": F.when(k % 9 > 0, text(k % 5)), "province": F.when(k % 4 == 0, "강원도").when(k % 4 == 1, "강원특별자치도").otherwise("경기도"), "district": F.when(k % 3 == 0, "강릉시").otherwise("영월군"),
        "lat1": F.when(k % 11 > 0, text(37 + k % 100 / 128)), "lon1": text(128 + k % 64 / 128), "lat2": F.when(k % 5 > 0, text(37 + k % 100 / 128 + 0.0078125)), "lon2": text(128 + k % 64 / 128 + 0.0078125), "length": F.when(k % 7 > 0, text(k % 300)), "width": F.when(k % 6 > 0, text(k % 30)),
        "height": F.lit(None).cast("string"), "kind": F.when(k % 3 > 0, "RC슬래브교"), "year": F.when(k % 8 > 0, text(1950 + k % 70)), "inspected": F.lit("2020"), "grade": F.lit("B"), "road": F.lit("r"), "route": F.lit("7"), "load": F.lit("DB"), "organisation": F.lit("o"), "phone": F.lit("1"),
    }
    return table(spark, sf_dir, "customer").select(k.alias("ordinal"), *(c.alias(registry.COLUMNS[n]) for n, c in cols.items()))


_REGISTER = """(SELECT format('r{:05d}', c_custkey) AS id, c_name AS name, ['1종', '2종', '3종'][CASE WHEN c_custkey % 9 > 0 AND c_custkey % 5 BETWEEN 1 AND 3 THEN c_custkey % 5 END] AS class, 37 + c_custkey % 100 / 128 AS lat1, 128 + c_custkey % 64 / 128 AS lon1,
  37 + c_custkey % 100 / 128 + CASE WHEN c_custkey % 5 > 0 THEN 0.0078125::DOUBLE ELSE 0 END AS lat2, 128 + c_custkey % 64 / 128 + CASE WHEN c_custkey % 5 > 0 THEN 0.0078125::DOUBLE ELSE 0 END AS lon2, CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 300 ELSE 0 END::DOUBLE AS length,
  CASE WHEN c_custkey % 6 > 0 THEN c_custkey % 30 END::DOUBLE AS width, CASE WHEN c_custkey % 8 > 0 THEN 1950 + c_custkey % 70 END AS year FROM customer WHERE c_custkey % 4 < 2 AND c_custkey % 3 = 0 AND c_custkey % 11 > 0)"""


@query(f"SELECT id, name, coalesce(class, '기타') AS class, round((lat1 + lat2) / 2, 5) AS lat, round((lon1 + lon2) / 2, 5) AS lon, length, width, year FROM {_REGISTER} WHERE length >= 20")
def register_rows(spark, sf_dir):
    """Structures of a province and district of the register, with their derived columns."""
    out = registry.structures(register(spark, sf_dir), "강원", ["강릉시"], 20.0)
    return out.select("id", "name", "class", F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), "length", "width", "year")


@query(
    f"""WITH s AS (SELECT id, round((lat1 + lat2) / 2, 6) AS lat, round((lon1 + lon2) / 2, 6) AS lon, lat1, lat2, lon1, lon2 FROM {_REGISTER}), k AS (SELECT 111320 * cos(radians(avg(lat))) AS ke FROM s),
  g AS (SELECT floor((lon - 120) * ke / 1500)::BIGINT AS cx, floor((lat - 30) * 111320 / 1500)::BIGINT AS cy, count(*) AS n, min(least(lat1, lat2)) - 300 / 111320 AS s, max(greatest(lat1, lat2)) + 300 / 111320 AS n_, min(least(lon1, lon2)) - 300 / max(ke) AS w, max(greatest(lon1, lon2)) + 300 / max(ke) AS e, max(ke) AS ke FROM s, k GROUP BY 1, 2)
SELECT 't' || cx || '_' || cy AS tile, n AS n_structures, round((s + n_) / 2 - greatest((n_ - s) / 2, 800 / 111320), 6) AS "S", round((s + n_) / 2 + greatest((n_ - s) / 2, 800 / 111320), 6) AS "N", round((w + e) / 2 - greatest((e - w) / 2, 800 / ke), 6) AS "W", round((w + e) / 2 + greatest((e - w) / 2, 800 / ke), 6) AS "E" FROM g"""
)
def register_tiles(spark, sf_dir):
    """Processing tiles of the structures of a district."""
    tiles, _ = registry.tiles(registry.structures(register(spark, sf_dir), "강원", "강릉시"))
    return tiles.select("tile", "n_structures", *(F.round(c, 6).alias(c) for c in "SNWE"))


@query(
    """WITH o AS (SELECT DISTINCT o_custkey % 3 AS path, CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'D' END AS direction, CAST(o_orderdate AS DATE) AS date FROM orders), j AS (SELECT *, coalesce(CAST(date_diff('day', lag(date) OVER w, date) > 3 AS INT), 0) AS jump FROM o WINDOW w AS (PARTITION BY direction, path ORDER BY date)),
  p AS (SELECT *, CAST(sum(jump) OVER (PARTITION BY direction, path ORDER BY date) AS INT) AS period FROM j), g AS (SELECT direction, path, period, count(*) AS n_dates, min(date) AS first, max(date) AS last FROM p GROUP BY ALL),
  r AS (SELECT direction, path, period, date, row_number() OVER (PARTITION BY direction, path, period ORDER BY abs(2 * date_diff('day', first, date) - date_diff('day', first, last)), date) AS k FROM p JOIN g USING (direction, path, period))
SELECT direction, path, period, n_dates, CAST(first AS VARCHAR) AS first, CAST(last AS VARCHAR) AS last, CAST(date AS VARCHAR) AS reference_date FROM g JOIN r USING (direction, path, period) WHERE k = 1 AND n_dates >= 4"""
)
def found_tracks(spark, sf_dir):
    """Tracks and their periods in a catalogue of scenes, with their reference dates."""
    c = F.col("o_custkey")
    o = table(spark, sf_dir, "orders").select(F.when(c % 2 == 0, "A").otherwise("D").alias("direction"), (c % 3).alias("path"), F.col("o_orderdate").cast("timestamp").alias("start_time"))
    out = search.tracks(o, 4, 3)
    return out.select("direction", "path", "period", "n_dates", *(F.col(d).cast("string").alias(d) for d in ("first", "last", "reference_date")))


@query(
    """WITH c AS (SELECT DISTINCT CAST(ts AS DATE) AS run FROM events), n AS (SELECT run, row_number() OVER (ORDER BY run) AS cycle FROM c) SELECT s_suppkey AS bridge, (SELECT max(cycle) + 1 FROM n) AS cycle, CAST(s_suppkey % 5 AS INT) - 1 AS level, CASE WHEN s_suppkey % 5 = 0 THEN '판정 불가' ELSE ['정상', '관심', '주의', '경고'][s_suppkey % 5] END AS status FROM supplier"""
)
def cycle_log(spark, sf_dir):
    """The judgements that a new cycle appends to the log."""
    cycles = history.cycle_numbers(table(spark, sf_dir, "events").select(F.to_date("ts").alias("run")), "run")
    k = F.col("s_suppkey")
    best = table(spark, sf_dir, "supplier").select(k.alias("bridge"), ((k % 5).cast("int") - 1).alias("level"), F.lit(0).alias("cycle"))
    _, rows = history.append_cycle(cycles, best, F.lit("2024-04-01"), best)
    return rows.select("bridge", F.col("cycle").cast("long").alias("cycle"), "level", "status")


@query(
    """WITH s AS (SELECT 'r' || c_custkey AS bridge, c_custkey % 40 AS tile, c_custkey % 7 * 0.01 AS a FROM customer), t AS (SELECT tile, min(37 + tile / 50 + a) AS s, max(37 + tile / 50 + a) AS n, min(128 + tile / 30 - a) AS w, max(128 + tile / 30 + a) AS e FROM s GROUP BY tile)
SELECT tile, round(s - 0.01, 6) AS "S", round(n + 0.01, 6) AS "N", round(w - 0.01, 6) AS "W", round(e + 0.01, 6) AS "E" FROM t"""
)
def area_boxes(spark, sf_dir):
    """The padded boxes of the area of interest."""
    k = F.col("c_custkey")
    a, t = k % 7 * 0.01, k % 40
    boxes = table(spark, sf_dir, "customer").groupBy(t.alias("tile")).agg(F.min(37 + t / 50 + a).alias("S"), F.max(37 + t / 50 + a).alias("N"), F.min(128 + t / 30 - a).alias("W"), F.max(128 + t / 30 + a).alias("E"))
    return registry.area(boxes).select("tile", *(F.round(c, 6).alias(c) for c in "SNWE"))


_BOXES = "(SELECT s_nationkey % 4 AS g, (s_suppkey * 7919 % 900)::DOUBLE AS w, (s_suppkey * 104729 % 900)::DOUBLE AS s, (s_suppkey * 7919 % 900 + 60 + s_suppkey % 90)::DOUBLE AS e, (s_suppkey * 104729 % 900 + 40 + s_suppkey % 70)::DOUBLE AS n FROM supplier)"


@query(
    f"""WITH b AS {_BOXES}, x AS (SELECT g, x AS x0, lead(x) OVER (PARTITION BY g ORDER BY x) AS x1 FROM (SELECT DISTINCT g, w AS x FROM b UNION SELECT g, e FROM b)), y AS (SELECT g, y AS y0, lead(y) OVER (PARTITION BY g ORDER BY y) AS y1 FROM (SELECT DISTINCT g, s AS y FROM b UNION SELECT g, n FROM b)),
  c AS (SELECT DISTINCT g, x0, x1, y0, y1 FROM x JOIN y USING (g) JOIN b USING (g) WHERE w <= x0 AND e >= x1 AND s <= y0 AND n >= y1)
SELECT g AS "group", round(sum((x1 - x0) * (y1 - y0)), 3) AS area, round(sum((x1 - x0) * (y1 - y0)), 3) AS within_outline FROM c GROUP BY g"""
)
def area_union(spark, sf_dir):
    """The area that a group's boxes cover together, by strips and by their outline."""
    from strataflux.operators import regions

    k = F.col("s_suppkey")
    w, s = k * 7919 % 900, k * 104729 % 900
    boxes = table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 4).alias("group"), w.alias("W"), s.alias("S"), (w + 60 + k % 90).alias("E"), (s + 40 + k % 70).alias("N"))
    inside = regions.outline(boxes, 250.0).groupBy("group").agg(F.round(F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")) / 2, 3).alias("within_outline"))
    return regions.areas(boxes, 250.0).withColumn("area", F.round("area", 3)).join(inside, "group")
