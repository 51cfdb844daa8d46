"""The operators over the driver's tables, each with its SQL for another engine.

There is no radar data among these tables. A supplier stands for a structure, its monthly quantities for displacement,
a nation for a tile, a return flag for a track, an event day for an acquisition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strataflux.functions import regress
from strataflux.functions.expr import grade, level, status_label
from strataflux.operators import deck, judge, qc, results, spatial, timeline, windows

MASTER = "1998-07-01"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """bridge, d (month), t (years from the master), y."""
    d = F.trunc("l_shipdate", "month")
    out = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("bridge"), *more, d.alias("d")).agg(F.sum("l_quantity").alias("y"))
    return out.withColumn("t", F.datediff("d", F.lit(MASTER)) / 365.25)


def obs_sql(more: str = "") -> str:
    return (
        f"(SELECT bridge{more}, d, y, date_diff('day', DATE '{MASTER}', d) / 365.25 AS t FROM (SELECT l_suppkey AS bridge{more}, "
        f"CAST(date_trunc('month', l_shipdate) AS DATE) AS d, sum(l_quantity) AS y FROM lineitem GROUP BY ALL))"
    )


SEASONAL_SQL = ["1.0", "sin(t * 6.283185307179586)", "cos(t * 6.283185307179586)", "t"]
FIT_SQL = regress.ols_sql(obs_sql(), "bridge", "y", SEASONAL_SQL)
VELOCITY_SQL = f"""SELECT bridge, n, c_3 AS v, sqrt(greatest(yy - c_0 * r_0 - c_1 * r_1 - c_2 * r_2 - c_3 * r_3, 0) / greatest(n - 4, 1) / last_g) AS se,
  sqrt(c_1 * c_1 + c_2 * c_2) AS amplitude, sqrt(greatest(yy - c_0 * r_0 - c_1 * r_1 - c_2 * r_2 - c_3 * r_3, 0) / n) AS rms FROM ({FIT_SQL}) WHERE n >= 12"""


@query(f"SELECT bridge, n, round(v, 4) AS v, round(se, 4) AS se, round(amplitude, 4) AS amplitude, round(rms, 4) AS rms FROM ({VELOCITY_SQL})")
def point_metrics(spark, sf_dir):
    fit = regress.velocity(observations(spark, sf_dir), ["bridge"], "y").where("n >= 12")
    return fit.select("bridge", "n", *(F.round(c, 4).alias(c) for c in ("v", "se", "amplitude", "rms")))


def ground(spark, sf_dir) -> DataFrame:
    """Series less the median of all structures of the nation on each date, velocities, and the scale of the nation's velocities."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("bridge"), F.col("s_nationkey").alias("tile"))
    # Windows instead of joins back: the table is read and summed once.
    obs = observations(spark, sf_dir).join(s, "bridge")
    rel = obs.withColumn("y", F.col("y") - F.median("y").over(Window.partitionBy("tile", "d")))
    w = Window.partitionBy("tile", "bridge")
    rel = rel.withColumn("years", F.max("t").over(w) - F.min("t").over(w))
    v = regress.velocity(rel, ["tile", "bridge", "years"], "y").where("n >= 12")
    tile = Window.partitionBy("tile")
    v = v.withColumn("mid", F.median("v").over(tile))
    return v.withColumn("sigma", F.median(F.abs(F.col("v") - F.col("mid"))).over(tile) * 1.4826)


REL_SQL = f"""(SELECT o.bridge, s_nationkey AS tile, o.d, o.t, o.y - median(o.y) OVER (PARTITION BY s_nationkey, o.d) AS y
  FROM {obs_sql()} o JOIN supplier ON s_suppkey = o.bridge)"""
GROUND_SQL = f"""(WITH fit AS ({regress.ols_sql(REL_SQL, "tile, bridge", "y", SEASONAL_SQL)}), vel AS (
  SELECT tile, bridge, n, c_3 AS v, sqrt(greatest(yy - c_0 * r_0 - c_1 * r_1 - c_2 * r_2 - c_3 * r_3, 0) / greatest(n - 4, 1) / last_g) AS se FROM fit WHERE n >= 12),
  sc AS (SELECT tile, median(v) AS mid, mad(v) * 1.4826 AS sigma FROM vel GROUP BY tile),
  yr AS (SELECT bridge, max(t) - min(t) AS years FROM {obs_sql()} GROUP BY bridge)
  SELECT vel.*, mid, sigma, years, greatest(2 * sigma, 2 * se) AS thr, abs(v) > greatest(2 * sigma, 2 * se) AS sig FROM vel JOIN sc USING (tile) JOIN yr USING (bridge))"""
JUDGED_SQL = f"""(SELECT *, CASE WHEN sig THEN abs(v) * years ELSE 0 END AS D, CASE WHEN sig THEN abs(v) * (years + 10) ELSE 0 END AS D10 FROM {GROUND_SQL})"""
LEVEL = "CASE WHEN {0} >= 0.7 THEN 3 WHEN {0} >= 0.5 THEN 2 WHEN {0} >= 0.3 THEN 1 ELSE 0 END"


def judged(spark, sf_dir) -> DataFrame:
    z = judge.significant(ground(spark, sf_dir))
    z = judge.displacement(z, F.col("years"))
    r, r10 = F.col("D") / 2500, F.col("D10") / 2500
    return z.withColumns({"r_now": r, "r_10y": r10, "level": level(r, r10, (0.3, 0.5, 0.7))})


LEVELS_SQL = f"""(SELECT *, D / 2500 AS r_now, D10 / 2500 AS r_10y, greatest({LEVEL.format("(D / 2500)")}, least({LEVEL.format("(D10 / 2500)")}, {LEVEL.format("(D / 2500)")} + 1)) AS level FROM {JUDGED_SQL})"""


@query(f"SELECT bridge, tile, round(v, 4) AS v, round(se, 4) AS se, round(sigma, 4) AS sigma, sig, round(D, 3) AS d_now, round(r_now, 5) AS r_now, round(r_10y, 5) AS r_10y, level FROM {LEVELS_SQL}")
def judge_ratio(spark, sf_dir):
    """The flagship: displacement of each structure against its surroundings, graded, worst first."""
    out = judged(spark, sf_dir).select("bridge", "tile", F.round("v", 4).alias("v"), F.round("se", 4).alias("se"), F.round("sigma", 4).alias("sigma"), "sig", F.round("D", 3).alias("d_now"), F.round("r_now", 5).alias("r_now"), F.round("r_10y", 5).alias("r_10y"), "level")
    return out.orderBy(F.desc("level"), F.desc("r_now"), "bridge")


@query(
    "SELECT p_partkey AS part, format('r{:05d}', p_partkey) AS id, CASE p_size % 5 WHEN 1 THEN '1종' WHEN 2 THEN '2종' WHEN 3 THEN '3종' ELSE '기타' END AS class, p_retailprice AS length FROM part WHERE regexp_matches(p_name, 'red|blue') AND p_type IN ('ECONOMY', 'SMALL') AND p_retailprice >= 950"
)
def registry_filter(spark, sf_dir):
    from strataflux.functions.expr import class_label

    p = table(spark, sf_dir, "part").where(F.col("p_name").rlike("red|blue") & F.col("p_type").isin("ECONOMY", "SMALL") & (F.col("p_retailprice") >= 950))
    return p.select(F.col("p_partkey").alias("part"), F.format_string("r%05d", "p_partkey").alias("id"), class_label(F.col("p_size") % 5).alias("class"), F.col("p_retailprice").alias("length"))


def places(spark, sf_dir) -> DataFrame:
    """Suppliers at places made of their numbers, in metres."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("tile"), (F.col("s_suppkey") * 7919 % 3000).cast("double").alias("x"), (F.col("s_suppkey") * 104729 % 3000).cast("double").alias("y"), ((F.col("s_suppkey") * 31 % 100) / 100).alias("coh"))


PLACES_SQL = "(SELECT s_suppkey AS id, s_nationkey AS tile, CAST(s_suppkey * 7919 % 3000 AS DOUBLE) AS x, CAST(s_suppkey * 104729 % 3000 AS DOUBLE) AS y, (s_suppkey * 31 % 100) / 100 AS coh FROM supplier)"


@query(f"SELECT CAST(floor(x / 1500) AS BIGINT) AS cx, CAST(floor(y / 1500) AS BIGINT) AS cy, count(*) AS n, min(y) - 300 AS s, max(y) + 300 AS n_edge, greatest((max(x) - min(x)) / 2 + 300, 800) AS half_x FROM {PLACES_SQL} GROUP BY 1, 2")
def tile_grid(spark, sf_dir):
    p = places(spark, sf_dir)
    return p.groupBy(F.floor(F.col("x") / 1500).alias("cx"), F.floor(F.col("y") / 1500).alias("cy")).agg(F.count("*").alias("n"), (F.min("y") - 300).alias("s"), (F.max("y") + 300).alias("n_edge"), F.greatest((F.max("x") - F.min("x")) / 2 + 300, F.lit(800)).alias("half_x"))


@query(
    """WITH d AS (SELECT DISTINCT o_custkey AS customer, CAST(o_orderdate AS DATE) AS date FROM orders),
  j AS (SELECT *, coalesce(CAST(date_diff('day', lag(date) OVER w, date) > 120 AS INT), 0) AS jump FROM d WINDOW w AS (PARTITION BY customer ORDER BY date)),
  p AS (SELECT *, CAST(sum(jump) OVER (PARTITION BY customer ORDER BY date) AS INT) AS period FROM j),
  g AS (SELECT customer, period, count(*) AS n_dates, min(date) AS first, max(date) AS last FROM p GROUP BY ALL),
  t AS (SELECT *, CASE WHEN period = 0 AND last = max(last) OVER (PARTITION BY customer) THEN '' ELSE '_' || year(first) END AS tag FROM g)
SELECT customer, period, n_dates, CAST(first AS VARCHAR) AS first, CAST(last AS VARCHAR) AS last, tag FROM t WHERE n_dates >= 3"""
)
def tracks_periods(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("date"))
    return timeline.tracks(o, ["customer"], gap_days=120, least=3).select("customer", "period", "n_dates", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), "tag")


@query(
    """WITH d AS (SELECT DISTINCT o_custkey AS customer, CAST(o_orderdate AS DATE) AS date FROM orders), s AS (SELECT customer, min(date) AS a, max(date) AS b FROM d GROUP BY 1),
  r AS (SELECT customer, date, row_number() OVER (PARTITION BY customer ORDER BY abs(2 * date_diff('day', a, date) - date_diff('day', a, b)), date) AS k FROM d JOIN s USING (customer))
SELECT customer, CAST(date AS VARCHAR) AS reference_date FROM r WHERE k = 1"""
)
def reference_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("date")).distinct()
    return timeline.reference_date(o, ["customer"]).select("customer", F.col("reference_date").cast("string").alias("reference_date"))


@query("WITH n AS (SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY ALL) SELECT event_type, CAST(date AS VARCHAR) AS date, n FROM (SELECT *, max(n) OVER (PARTITION BY event_type) AS m FROM n) WHERE n >= 0.8 * m")
def calendar_80pct(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    return timeline.covered_dates(e, ["event_type"], "date").withColumn("date", F.col("date").cast("string"))


@query(
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS temp, sum(value) AS rain FROM events GROUP BY ALL),
  w AS (SELECT *, temp * 0.7 + lead(temp) OVER x * 0.3 AS at_pass, sum(coalesce(rain, 0)) OVER (x ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS p24 FROM h WINDOW x AS (PARTITION BY event_type ORDER BY hour))
SELECT event_type, strftime(hour, '%Y%m%d') AS date, round(at_pass, 8) AS temp, round(p24, 4) AS p24 FROM w WHERE hour(hour) = 9 AND at_pass IS NOT NULL"""
)
def weather_interp(spark, sf_dir):
    h = table(spark, sf_dir, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.avg("value").alias("temp"), F.sum("value").alias("rain"))
    h = timeline.trailing_sum(timeline.interpolate_pass(h, ["event_type"], "hour", "temp", F.lit(0.3)), ["event_type"], "hour", "rain")
    return h.where((F.hour("hour") == 9) & F.col("at_pass").isNotNull()).select("event_type", F.date_format("hour", "yyyyMMdd").alias("date"), F.round("at_pass", 8).alias("temp"), F.round("trailing", 4).alias("p24"))


def with_temperature(spark, sf_dir) -> DataFrame:
    w = table(spark, sf_dir, "orders").where(F.month("o_orderdate") != 7).groupBy(F.trunc("o_orderdate", "month").alias("d")).agg(F.avg("o_totalprice").alias("temp"))
    return timeline.fill_temperature(observations(spark, sf_dir), w, ["bridge"], ["d"])


WEATHER_SQL = f"""(SELECT *, temp - avg(temp) OVER (PARTITION BY bridge) AS dtemp FROM (SELECT o.bridge, o.d, o.t, o.y, coalesce(w.temp, avg(w.temp) OVER (PARTITION BY o.bridge)) AS temp
  FROM {obs_sql()} o LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, avg(o_totalprice) AS temp FROM orders WHERE month(o_orderdate) <> 7 GROUP BY 1) w USING (d)))"""


@query(f"SELECT bridge, CAST(d AS VARCHAR) AS d, round(temp, 2) AS temp, round(dtemp, 2) + 0.0 AS dtemp FROM {WEATHER_SQL}")
def weather_join_fill(spark, sf_dir):
    return with_temperature(spark, sf_dir).select("bridge", F.col("d").cast("string").alias("d"), F.round("temp", 2).alias("temp"), (F.round("dtemp", 2) + 0.0).alias("dtemp"))


@query(f"SELECT bridge, round(c_2 * 1000, 4) AS k FROM ({regress.ols_sql(WEATHER_SQL, 'bridge', 'y', ['1.0', 't', 'dtemp / 1000'])})")
def thermal_correction(spark, sf_dir):
    scaled = with_temperature(spark, sf_dir).withColumn("dtemp", F.col("dtemp") / 1000)
    return regress.thermal(scaled, ["bridge"], "y").select("bridge", F.round(F.col("k") * 1000, 4).alias("k"))


@query(
    """WITH p AS (SELECT o_custkey % 40 AS track, 'd' || (o_orderkey % 17) AS ref, 'd' || (o_custkey % 17) AS sec, (o_orderkey * 37 % 401) - 200 AS bperp FROM orders),
  c AS (SELECT track, max({'n': n, 'ref': ref}).ref AS common FROM (SELECT track, ref, count(*) AS n FROM p GROUP BY ALL) GROUP BY track),
  e AS (SELECT p.track, sec AS date, bperp AS b, true AS straight FROM p JOIN c ON p.track = c.track AND ref = common UNION ALL SELECT p.track, ref, -bperp, false FROM p JOIN c ON p.track = c.track AND sec = common
    UNION ALL SELECT track, common, 0, true FROM c),
  m AS (SELECT track, date, CASE WHEN date = common THEN 0 ELSE coalesce(min(b) FILTER (straight), min(b)) END AS b FROM e JOIN c USING (track) GROUP BY track, date, common)
SELECT track, date, CAST(b - coalesce(max(b) FILTER (date = 'd3') OVER (PARTITION BY track), 0) AS BIGINT) AS bperp FROM m"""
)
def baseline_rereference(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    day = lambda c: F.concat(F.lit("d"), (F.col(c) % 17).cast("string"))
    p = o.select((F.col("o_custkey") % 40).alias("track"), day("o_orderkey").alias("ref"), day("o_custkey").alias("sec"), (F.col("o_orderkey") * 37 % 401 - 200).alias("bperp"))
    return qc.rereference_baselines(p, ["track"], F.lit("d3")).withColumn("bperp", F.col("bperp").cast("long"))


@query(f"WITH v AS ({VELOCITY_SQL}), t AS (SELECT s_nationkey AS tile, v FROM v JOIN supplier ON s_suppkey = bridge) SELECT tile, round(median(v), 4) AS mid, round(mad(v) * 1.4826, 4) AS scale FROM t GROUP BY tile")
def mad_noise(spark, sf_dir):
    v = regress.velocity(observations(spark, sf_dir), ["bridge"], "y").where("n >= 12")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("bridge"), F.col("s_nationkey").alias("tile"))
    return regress.robust_scale(v.join(s, "bridge"), ["tile"], "v").select("tile", F.round("mid", 4).alias("mid"), F.round("scale", 4).alias("scale"))


HALF_SQL = f"(SELECT *, t >= max(t) OVER (PARTITION BY bridge) - 2 AS recent FROM {obs_sql()})"


@query(
    f"""WITH f AS ({regress.ols_sql(HALF_SQL, "bridge, recent", "y", SEASONAL_SQL)}), v AS (SELECT bridge, recent, c_3 AS v, sqrt(greatest(yy - c_0 * r_0 - c_1 * r_1 - c_2 * r_2 - c_3 * r_3, 0) / greatest(n - 4, 1) / last_g) AS se FROM f WHERE n >= 12)
SELECT bridge, round(max(v) FILTER (recent) - max(v) FILTER (NOT recent), 3) AS acc, round(sqrt(max(se) FILTER (recent) ** 2 + max(se) FILTER (NOT recent) ** 2), 3) AS se FROM v GROUP BY bridge HAVING count(*) = 2"""
)
def acceleration(spark, sf_dir):
    o = observations(spark, sf_dir).withColumn("recent", F.col("t") >= F.max("t").over(Window.partitionBy("bridge")) - 2)
    v = regress.velocity(o, ["bridge", "recent"], "y").where("n >= 12")
    of = lambda c, r: F.max(F.when(F.col("recent") == r, F.col(c)))
    return v.groupBy("bridge").agg(F.count("*").alias("k"), F.round(of("v", True) - of("v", False), 3).alias("acc"), F.round(F.hypot(of("se", True), of("se", False)), 3).alias("se")).where("k = 2").drop("k")


@query("WITH g AS (SELECT l_returnflag AS track, strftime(l_shipdate, '%Y%m') AS date, count(*) AS n, sqrt(avg(cos(l_quantity / 40)) ** 2 + avg(sin(l_quantity / 40)) ** 2) AS gamma FROM lineitem GROUP BY ALL) SELECT track, date, n, round(gamma, 6) AS gamma, gamma >= 0.9 AS kept FROM g")
def refcoh_dates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("track"), F.date_format("l_shipdate", "yyyyMM").alias("date"), (F.col("l_quantity") / 40).alias("phase"))
    return qc.date_coherence(li, ["track", "date"], "phase").select("track", "date", "n", F.round("gamma", 6).alias("gamma"), (F.col("gamma") >= 0.9).alias("kept"))


@query(
    f"""WITH p AS {PLACES_SQL}, e AS (SELECT a.tile, a.id, count(*) AS n, avg(b.coh) AS coh FROM p a JOIN p b ON a.tile = b.tile AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 900 GROUP BY ALL)
SELECT tile, id AS centre, n AS n_cluster, round(coh, 6) AS coh_mean FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY n DESC, round(coh, 9) DESC, id) AS k FROM e) WHERE k = 1"""
)
def ref_cluster(spark, sf_dir):
    return spatial.densest_cluster(places(spark, sf_dir), 900.0, "id", "coh", ["tile"]).select("tile", "centre", "n_cluster", F.round("coh_mean", 6).alias("coh_mean"))


@query(f"SELECT id FROM {PLACES_SQL} p WHERE NOT EXISTS (SELECT 1 FROM customer WHERE sqrt((p.x - c_custkey * 6151 % 3000) ** 2 + (p.y - c_custkey * 3571 % 3000) ** 2) < 30)")
def avoid_anti(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 6151 % 3000).cast("double").alias("x"), (F.col("c_custkey") * 3571 % 3000).cast("double").alias("y"))
    return spatial.avoid(places(spark, sf_dir), c, 30.0).select("id")


CUSTOMER_PLACES_SQL = "(SELECT c_custkey AS id, CAST(c_custkey * 6151 % 3000 AS DOUBLE) AS x, CAST(c_custkey * 3571 % 3000 AS DOUBLE) AS y, c_nationkey AS nation, c_acctbal AS bal FROM customer)"


@query(
    f"""WITH p AS {PLACES_SQL}, c AS {CUSTOMER_PLACES_SQL}, j AS (SELECT p.tile, p.id, c.id AS near, c.bal, row_number() OVER (PARTITION BY p.id ORDER BY sqrt((p.x - c.x) ** 2 + (p.y - c.y) ** 2), c.id) AS k
  FROM p JOIN c ON abs(p.x - c.x) <= 120 AND abs(p.y - c.y) <= 120 AND sqrt((p.x - c.x) ** 2 + (p.y - c.y) ** 2) <= 120)
SELECT tile, count(*) AS n_pairs, round(CASE WHEN count(*) >= 3 THEN median(bal - s_acctbal) END, 3) AS "offset" FROM j JOIN supplier ON s_suppkey = id WHERE k = 1 GROUP BY tile"""
)
def nn_pair_offset(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 6151 % 3000).cast("double").alias("x"), (F.col("c_custkey") * 3571 % 3000).cast("double").alias("y"))
    near = spatial.nearest_within(places(spark, sf_dir), c, 120.0, "id", "id")
    pairs = near.join(places(spark, sf_dir), "id").join(table(spark, sf_dir, "supplier"), F.col("id") == F.col("s_suppkey")).join(table(spark, sf_dir, "customer"), F.col("near_id") == F.col("c_custkey"))
    out = spatial.pair_offset(pairs.withColumn("diff", F.col("c_acctbal") - F.col("s_acctbal")), ["tile"], "diff", 3)
    return out.select("tile", "n_pairs", F.round("offset", 3).alias("offset"))


PARTS_SQL = "(SELECT p_partkey AS id, p_partkey * 7919 % 400 AS x, p_partkey * 104729 % 4000 AS y, CASE p_size % 4 WHEN 0 THEN 'APES' WHEN 1 THEN 'Capon' WHEN 2 THEN 'PS' ELSE 'DS' END AS src FROM part)"
_NEAR = "NOT EXISTS (SELECT 1 FROM {0} k WHERE abs(k.x - p.x) <= 12 AND abs(k.y - p.y) <= 12 AND sqrt((k.x - p.x) ** 2 + (k.y - p.y) ** 2) <= 12)"


@query(
    f"""WITH p AS {PARTS_SQL}, k1 AS (SELECT * FROM p WHERE src = 'APES'), k2 AS (SELECT * FROM k1 UNION ALL SELECT * FROM p WHERE src = 'Capon' AND {_NEAR.format("k1")}),
  k3 AS (SELECT * FROM k2 UNION ALL SELECT * FROM p WHERE src = 'PS' AND {_NEAR.format("k2")}), k4 AS (SELECT * FROM k3 UNION ALL SELECT * FROM p WHERE src = 'DS' AND {_NEAR.format("k3")}) SELECT id, src FROM k4"""
)
def priority_merge(spark, sf_dir):
    src = F.element_at(F.array(*map(F.lit, ("APES", "Capon", "PS", "DS"))), F.col("p_size") % 4 + 1)
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 7919 % 400).cast("double").alias("x"), (F.col("p_partkey") * 104729 % 4000).cast("double").alias("y"), src.alias("src"))
    return spatial.priority_merge(p, "src", ["APES", "Capon", "PS", "DS"], 12.0).select("id", "src")


NODES_SQL = """(WITH p AS (SELECT l_suppkey AS bridge, (l_partkey % 61) - 30.0 AS s, CAST(date_trunc('year', l_shipdate) AS DATE) AS d, l_quantity AS y FROM lineitem)
  SELECT bridge, node, d, median(y) AS y, count(*) AS n_points FROM (SELECT *, unnest(range(CAST(greatest(ceil((s + 30 - 3) / 3), 0) AS BIGINT), CAST(least(floor((s + 30 + 3) / 3), 20) AS BIGINT) + 1)) AS node FROM p) GROUP BY bridge, node, d)"""


def deck_nodes(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("bridge"), (F.col("l_partkey") % 61 - 30.0).alias("s"), F.trunc("l_shipdate", "year").alias("d"), F.col("l_quantity").alias("y"))
    return deck.node_series(deck.nodes_of(p, "s", F.lit(30.0)), ["bridge"], "node", "d", "y")


@query(f"SELECT bridge, node, CAST(d AS VARCHAR) AS d, y, n_points FROM {NODES_SQL}")
def node_series(spark, sf_dir):
    return deck_nodes(spark, sf_dir).select("bridge", "node", F.col("d").cast("string").alias("d"), "y", "n_points")


@query(f"SELECT bridge, CAST(floor(node * 3.0 / 15) AS INT) AS segment, CAST(d AS VARCHAR) AS d, round(avg(y), 4) AS y, count(*) AS n_nodes FROM {NODES_SQL} WHERE -30 + floor(node * 3.0 / 15) * 15 < 30 GROUP BY ALL")
def zone_series(spark, sf_dir):
    n = deck_nodes(spark, sf_dir).withColumn("segment", deck.segment_of(F.col("node") * 3.0 - 30, F.lit(30.0))).where("segment is not null")
    return deck.zone_series(n, ["bridge"], "segment", "d").select("bridge", "segment", F.col("d").cast("string").alias("d"), F.round("y", 4).alias("y"), "n_nodes")


ZONES_SQL = "(SELECT s_nationkey AS tile, row_number() OVER (PARTITION BY s_nationkey ORDER BY bridge) AS zone, g.* EXCLUDE (tile) FROM " + GROUND_SQL + " g JOIN supplier ON s_suppkey = bridge)"


def zones(spark, sf_dir) -> DataFrame:
    z = judge.significant(ground(spark, sf_dir))
    return z.withColumn("zone", F.row_number().over(Window.partitionBy("tile").orderBy("bridge")))


@query(
    f"""WITH z AS {ZONES_SQL}, b AS (SELECT *, CASE WHEN lead(zone) OVER w = zone + 1 THEN CASE WHEN sig OR lead(sig) OVER w THEN abs(lead(v) OVER w - v) * years / 1000 / 25 ELSE 0 END END AS beta FROM z WINDOW w AS (PARTITION BY tile ORDER BY zone))
SELECT tile, zone, bridge, round(beta, 6) AS beta FROM b"""
)
def adjacent_distortion(spark, sf_dir):
    return judge.distortion(zones(spark, sf_dir), ["tile"], "zone", F.col("years"), F.lit(25.0)).select("tile", "zone", "bridge", F.round("beta", 6).alias("beta"))


@query(
    f"""WITH z AS (SELECT *, sqrt(se ** 2 + sigma ** 2 / 8) AS sv FROM {ZONES_SQL}), w AS (SELECT *, abs(lead(v) OVER x - v) AS dv, 2 * sqrt(sv ** 2 + lead(sv) OVER x ** 2) AS two FROM z WINDOW x AS (PARTITION BY tile ORDER BY zone))
SELECT tile, round(greatest(max(greatest(abs(v) * years - 2 * sv * years, 0)) / 25, coalesce(max(greatest(dv - two, 0) * years / 1000 / 25 / 0.002), 0)), 3) AS r_lo,
  round(greatest(max(abs(v) * years + 2 * sv * years) / 25, coalesce(max((dv + two) * years / 1000 / 25 / 0.002), 0)), 3) AS r_hi FROM w GROUP BY tile"""
)
def uncertainty_band(spark, sf_dir):
    z = zones(spark, sf_dir).withColumn("sv", judge.uncertainty(F.col("se"), F.col("sigma"), F.lit(8), F.lit(1.0))).withColumn("dT", F.lit(0.0))
    return judge.band(z, ["tile"], "zone", F.col("years"), F.lit(25.0), F.lit(0.002)).select("tile", F.round("r_lo", 3).alias("r_lo"), F.round("r_hi", 3).alias("r_hi"))


def track_results(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("bridge"), F.col("l_returnflag").alias("track")).agg(F.count("*").alias("n_ps"), F.sum("l_quantity").alias("q"))
    return li.select("bridge", "track", F.ascii("track").alias("ord"), "n_ps", (F.col("n_ps") % 100 / 100).alias("cover"), (F.col("n_ps") % 7 == 0).alias("proxy"), F.when(F.col("n_ps") % 11 == 0, -1).otherwise((F.col("q") % 4).cast("int")).alias("level"), F.element_at(F.array(*map(F.lit, ("높음", "보통", "낮음"))), (F.col("n_ps") % 3 + 1).cast("int")).alias("conf"))


TRACKS_SQL = "(SELECT l_suppkey AS bridge, l_returnflag AS track, count(*) AS n_ps, count(*) % 100 / 100 AS cover, count(*) % 7 = 0 AS proxy, CASE WHEN count(*) % 11 = 0 THEN -1 ELSE CAST(sum(l_quantity) % 4 AS INT) END AS level, count(*) % 3 AS c FROM lineitem GROUP BY ALL)"


@query(
    f"""WITH r AS {TRACKS_SQL}, b AS (SELECT *, row_number() OVER (PARTITION BY bridge ORDER BY level >= 0 DESC, (level >= 0 AND NOT proxy) DESC, c, n_ps DESC, cover DESC, track) AS k FROM r),
  a AS (SELECT bridge, count(*) AS n_tracks, count(DISTINCT level) AS l FROM r WHERE level >= 0 GROUP BY bridge)
SELECT b.bridge, b.track, b.level, b.n_ps, n_tracks, CASE WHEN n_tracks >= 2 THEN l <= 1 END AS agree FROM b LEFT JOIN a USING (bridge) WHERE k = 1"""
)
def best_track(spark, sf_dir):
    r = track_results(spark, sf_dir)
    return results.best_track(r, "bridge", "ord").join(results.agreement(r, "bridge"), "bridge", "left").select("bridge", "track", "level", "n_ps", "n_tracks", "agree")


@query(
    """WITH l AS (SELECT c_custkey AS id, c_nationkey AS nation FROM customer), r AS (SELECT n_nationkey * 50 AS id, n_nationkey AS nation, n_name AS name FROM nation)
SELECT l.id, coalesce(a.name, b.name) AS name, CASE WHEN a.id IS NOT NULL THEN 'key' WHEN b.id IS NOT NULL THEN 'fallback' END AS matched_by FROM l LEFT JOIN r a ON a.id = l.id LEFT JOIN r b ON a.id IS NULL AND b.nation = l.nation"""
)
def fallback_key_join(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    right = table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 50).cast("long").alias("id"), F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))
    return results.with_fallback(left, right, "id", ["nation"]).select("id", F.col("r_name").alias("name"), "matched_by")


@query(
    """WITH e AS (SELECT user_id AS bridge, event_type AS kind, CAST(ts AS DATE) AS date, max_by(value, event_id) AS value, max(event_id) AS version FROM events GROUP BY ALL)
SELECT bridge, kind, CAST(date AS VARCHAR) AS date, value, version FROM e"""
)
def history_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("bridge"), F.col("event_type").alias("kind"), F.to_date("ts").cast("string").alias("date"), "value", F.col("event_id").alias("version"))
    early = F.col("date") < "2024-01-15"
    return results.upsert(e.where(early), e.where(~early), ["bridge", "kind", "date"], "version")


WEEK_SQL = """(SELECT user_id AS bridge, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT) AS cycle, CAST(count(*) % 4 AS INT) AS level, round(max(value), 2) AS r_now, count(*) % 5 = 0 AS review FROM events GROUP BY ALL)"""


def weekly(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("bridge"), F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01")) / 7).alias("cycle")).agg((F.count("*") % 4).cast("int").alias("level"), F.round(F.max("value"), 2).alias("r_now"), (F.count("*") % 5 == 0).alias("review"))


@query(
    f"""WITH l AS (SELECT * FROM {WEEK_SQL}), c AS (SELECT cycle, (SELECT max(x.cycle) FROM l x WHERE x.cycle < l.cycle) AS before FROM l GROUP BY cycle),
  h AS (SELECT l.*, p.level AS prev FROM l JOIN c USING (cycle) LEFT JOIN l p ON p.bridge = l.bridge AND p.cycle = c.before)
SELECT bridge, cycle, level, prev, CASE WHEN review THEN '확인 필요' WHEN prev IS NULL OR prev < 2 THEN '신규 경보' WHEN level > prev THEN '등급 상승' ELSE '지속' END AS kind FROM h WHERE level >= 2"""
)
def alerts(spark, sf_dir):
    return results.alerts(results.previous(weekly(spark, sf_dir), "bridge", "cycle", "level"), "bridge").select("bridge", "cycle", "level", "prev", "kind")


@query(
    """WITH d AS (SELECT DISTINCT o_custkey % 120 AS track, CAST(o_orderdate AS DATE) AS date FROM orders), g AS (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY track ORDER BY date), date) AS gap FROM d),
  s AS (SELECT track, count(*) AS n_used, CAST(coalesce(max(gap), 0) AS INT) AS max_gap_days, CAST(date_diff('day', max(date), DATE '1998-08-20') AS INT) AS stale_days,
    date_diff('day', min(date), max(date)) / 365.25 * 365.25 / 12 + 1 AS expected FROM g GROUP BY track)
SELECT * EXCLUDE (expected), CAST(round_even(expected, 0) AS BIGINT) AS n_expected, round(n_used / expected, 6) AS coverage, n_used / expected < 0.6 OR max_gap_days > 365 OR stale_days > 60 AS flag FROM s"""
)
def gap_info(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 120).alias("track"), F.to_date("o_orderdate").alias("date"))
    g = timeline.gaps(d, ["track"], "date", F.lit("1998-08-20").cast("date"))
    return g.select("track", "n_used", "max_gap_days", "stale_days", "n_expected", F.round("coverage", 6).alias("coverage"), "flag")


@query(
    """WITH d AS (SELECT event_type AS track, CAST(max(ts) AS DATE) AS last FROM events GROUP BY 1), l AS (SELECT event_type AS track, sum(CASE WHEN regexp_matches(props, '"k": 7') THEN 1 ELSE 0 END) AS n FROM events GROUP BY 1)
SELECT '경고' AS level, 'data' AS kind, track, date_diff('day', last, DATE '2024-03-31') || ' days without a new date' AS msg FROM d WHERE date_diff('day', last, DATE '2024-03-31') > 24
UNION ALL SELECT '주의', 'log', track, n || ' errors' FROM l WHERE n > 0"""
)
def health_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.groupBy(F.col("event_type").alias("track")).agg(F.max(F.to_date("ts")).alias("last_date")).withColumn("end", F.lit(None).cast("date"))
    logs = e.groupBy(F.col("event_type").alias("track")).agg(F.sum(F.regexp_count("props", F.lit('"k": 7'))).cast("long").alias("n"))
    found = logs.where("n > 0").select(F.lit("주의").alias("level"), F.lit("log").alias("kind"), "track", F.format_string("%d errors", "n").alias("msg"))
    return results.stale_tracks(last, "track", F.lit("2024-03-31").cast("date")).unionByName(found)


@query(f"SELECT CASE level WHEN 0 THEN '정상' WHEN 1 THEN '관심' WHEN 2 THEN '주의' ELSE '경고' END AS status, count(*) AS n FROM {LEVELS_SQL} GROUP BY 1")
def status_counts(spark, sf_dir):
    return results.summary(judged(spark, sf_dir))


@query(f"SELECT bridge AS structure, track, string_agg(strftime(d, '%Y%m') || '=' || CAST(y AS BIGINT), ',' ORDER BY d) AS points FROM (SELECT l_suppkey AS bridge, l_returnflag AS track, CAST(date_trunc('month', l_shipdate) AS DATE) AS d, sum(l_quantity) AS y FROM lineitem GROUP BY ALL) GROUP BY ALL")
def api_series(spark, sf_dir):
    o = observations(spark, sf_dir, "l_returnflag").select(F.col("bridge").alias("structure"), F.col("l_returnflag").alias("track"), F.lit("los").alias("kind"), F.date_format("d", "yyyyMM").alias("date"), F.col("y").cast("long").alias("value"))
    v = results.series_view(o, "structure")
    return v.select("structure", "track", F.array_join(F.transform("points", lambda p: F.concat(p["date"], F.lit("="), p["value"].cast("string"))), ",").alias("points"))


AMP_SQL = "(SELECT l_partkey AS pixel, count(*) AS n, avg(l_quantity) AS mean, stddev_samp(l_quantity) / avg(l_quantity) AS da FROM lineitem WHERE month(l_shipdate) BETWEEN 3 AND 11 GROUP BY 1)"


@query(f"SELECT pixel, n, round(mean, 6) AS mean, round(da, 6) AS da FROM {AMP_SQL} WHERE n > 1")
def amp_dispersion(spark, sf_dir):
    from strataflux.operators import kernels

    li = table(spark, sf_dir, "lineitem").where(F.month("l_shipdate").between(3, 11)).select(F.col("l_partkey").alias("pixel"), F.col("l_quantity").alias("amp"))
    return kernels.amplitude_dispersion(li, ["pixel"], "amp").where("n > 1").select("pixel", "n", F.round("mean", 6).alias("mean"), F.round("da", 6).alias("da"))


@query(
    f"""WITH a AS (SELECT * FROM {AMP_SQL} WHERE n > 1), g AS (SELECT * FROM a WHERE n >= floor(0.8 * (SELECT max(n) FROM a)) AND pixel * 37 % 9700 - 200 > -100 AND pixel * 37 % 9700 - 200 < 9000 AND pixel % 50 <> 0 AND da > 0),
  t AS (SELECT CASE WHEN count(*) FILTER (da < 0.4) < 1500 THEN least(0.70, quantile_cont(da, 0.12)) ELSE 0.4 END AS thr FROM g) SELECT pixel, round(da, 6) AS da FROM g, t WHERE da < thr"""
)
def adaptive_da(spark, sf_dir):
    from strataflux.operators import kernels

    li = table(spark, sf_dir, "lineitem").where(F.month("l_shipdate").between(3, 11)).select(F.col("l_partkey").alias("pixel"), F.col("l_quantity").alias("amp"))
    a = kernels.amplitude_dispersion(li, ["pixel"], "amp").where("n > 1")
    most = a.agg(F.max("n")).head()[0] or 0
    p = F.col("pixel")
    ok = kernels.usable(F.col("n"), F.lit(most), p * 37 % 9700 - 200, p % 50, F.lit(128.0), F.col("da"))
    return kernels.candidates(a, "da", 0.4, 1500, ok=ok).select("pixel", F.round("da", 6).alias("da"))


@query(
    """WITH r AS (SELECT s_suppkey AS bridge, s_nationkey AS tile, s_suppkey % 9 AS n_ps, s_suppkey % 10 / 10 AS cover, s_acctbal AS length, CASE s_suppkey % 4 WHEN 1 THEN '1종' WHEN 2 THEN '2종' WHEN 3 THEN '3종' ELSE '기타' END AS class FROM supplier)
SELECT bridge, tile, CAST(CASE class WHEN '1종' THEN 0 WHEN '2종' THEN 1 WHEN '3종' THEN 2 ELSE 3 END AS INT) AS rank FROM r WHERE (n_ps < 5 OR cover < 0.25) AND tile % 5 <> 0 AND bridge % 13 <> 0"""
)
def weak_queue(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("bridge"), F.col("s_nationkey").alias("tile"), (k % 9).alias("n_ps"), (k % 10 / 10).alias("cover"), F.lit(False).alias("proxy"), F.col("s_acctbal").alias("length"), F.when(k % 4 == 1, "1종").when(k % 4 == 2, "2종").when(k % 4 == 3, "3종").otherwise("기타").alias("class"))
    tiles = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("tile"), F.when(F.col("n_nationkey") % 5 != 0, "OK").otherwise("NO_REF").alias("status"))
    return results.weak_structures(s, tiles, s.where("bridge % 13 = 0"), "bridge", "tile").select("bridge", "tile", "rank")


@query(
    f"""WITH s AS (SELECT bridge, d, y, row_number() OVER (PARTITION BY bridge ORDER BY d) AS k FROM {obs_sql()}), r AS (SELECT count(DISTINCT bridge) >= 3 AS enough FROM s WHERE bridge % 10 = 0), c AS (SELECT *, y - avg(y) FILTER (bridge % 10 = 0) OVER (PARTITION BY d) AS z FROM s)
SELECT bridge, CAST(d AS VARCHAR) AS d, round(CASE WHEN enough THEN z - max(z) FILTER (d = DATE '{MASTER}') OVER (PARTITION BY bridge) ELSE y END, 4) AS y FROM c, r"""
)
def rereference_series(spark, sf_dir):
    o = observations(spark, sf_dir).withColumn("near", F.col("bridge") % 10 == 0)
    return qc.rereference(o, [], "bridge", "d", "y", "near", F.lit(MASTER).cast("date")).select("bridge", F.col("d").cast("string").alias("d"), F.round("y", 4).alias("y"))


@query(f"SELECT bridge, CASE WHEN v IS NULL THEN NULL ELSE {LEVEL.format('abs(v) / 100')} END AS level, round(v, 4) AS v FROM ({VELOCITY_SQL}) ORDER BY bridge")
def velocity_grade(spark, sf_dir):
    v = regress.velocity(observations(spark, sf_dir), ["bridge"], "y").where("n >= 12")
    return v.select("bridge", grade(F.abs("v") / 100, (0.3, 0.5, 0.7)).alias("level"), F.round("v", 4).alias("v"))


@query("WITH s AS (SELECT user_id, ts, coalesce(CAST(ts - lag(ts) OVER w >= INTERVAL 6 HOUR AS INT), 0) AS jump FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), p AS (SELECT *, sum(jump) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, count(*) AS n FROM p GROUP BY user_id, k")
def session_gap_stream(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.min("ts").alias("first"), F.count("*").alias("n"))
    return s.select("user_id", F.date_format("first", "yyyy-MM-dd HH:mm:ss").alias("first"), "n")


@query("SELECT user_id AS bridge, event_type AS kind, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, max_by(value, event_id) AS value, max(event_id) AS version FROM events GROUP BY ALL")
def late_replay(spark, sf_dir):
    """The history as a stream of the table's files leaves it; equal to the batch form whatever came late."""
    from strataflux.streaming import cycle

    return cycle.replay(spark, f"{sf_dir}/events.parquet")


@query(
    f"""WITH t AS (SELECT n_nationkey AS tile, (n_nationkey % 5) * 600.0 AS w, (n_nationkey % 5) * 600.0 + 700 AS e, (n_nationkey // 5) * 600.0 AS s, (n_nationkey // 5) * 600.0 + 500 AS n FROM nation),
  p AS (SELECT nation % 4 AS burst, x, y, bal > 0 AS valid FROM {CUSTOMER_PLACES_SQL}),
  c AS (SELECT tile, burst, least(count(*) * 20000.0 / ((max(e) - max(w)) * (max(n) - max(s))), 1) * avg(CAST(valid AS INT)) AS score FROM p JOIN t ON x >= w AND x < e AND y >= s AND y < n GROUP BY ALL)
SELECT tile, burst, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY score DESC, burst) AS k FROM c) WHERE k = 1 AND score >= 0.3"""
)
def window_coverage(spark, sf_dir):
    k = F.col("n_nationkey")
    w, s = (k % 5) * 600.0, F.floor(k / 5) * 600.0
    t = table(spark, sf_dir, "nation").select(k.alias("tile"), w.alias("W"), (w + 700).alias("E"), s.alias("S"), (s + 500).alias("N"))
    p = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 4).alias("burst"), (F.col("c_custkey") * 6151 % 3000).cast("double").alias("x"), (F.col("c_custkey") * 3571 % 3000).cast("double").alias("y"), (F.col("c_acctbal") > 0).alias("valid"))
    return windows.best_burst(windows.coverage(p, t, 100.0, 20000.0), 0.3).select("tile", "burst", F.round("score", 6).alias("score"))


@query("SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS track FROM events WHERE (CAST(ts AS DATE), event_type) NOT IN (SELECT CAST(ts AS DATE), event_type FROM events WHERE event_id % 97 = 0) AND day(ts) % 7 <> 0")
def missing_dates(spark, sf_dir):
    from strataflux.streaming import cycle

    e = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("date"), F.col("event_type").alias("track"), "event_id", F.dayofmonth("ts").alias("day"))
    return cycle.missing_dates(e.select("date", "track").distinct(), e.where("event_id % 97 = 0"), e.where("day % 7 = 0"), ["date", "track"])


@query("WITH m AS (SELECT CAST(l_shipdate AS DATE) AS d, median(l_quantity) AS m FROM lineitem WHERE l_quantity > 0 GROUP BY 1) SELECT l_returnflag AS track, round(avg(l_quantity / m), 6) AS calamp, count(*) AS n FROM lineitem JOIN m ON d = CAST(l_shipdate AS DATE) GROUP BY 1")
def calibrated_amplitude(spark, sf_dir):
    from strataflux.operators import kernels

    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("track"), F.to_date("l_shipdate").alias("d"), F.col("l_quantity").alias("amp"))
    return kernels.calibrated(li, "d", "amp").groupBy("track").agg(F.round(F.avg("amp"), 6).alias("calamp"), F.count("*").alias("n"))


@query("SELECT s_suppkey AS id, zone, CASE WHEN floor(l / sp) >= 1 THEN zone * sp - l / 2 WHEN zone = 0 THEN -l / 2 ELSE l / 2 END AS zone_s FROM (SELECT *, unnest(range(0, greatest(CAST(floor(l / sp) AS BIGINT), 1) + 1)) AS zone FROM (SELECT s_suppkey, s_suppkey % 90 + 10.0 AS l, CASE s_suppkey % 3 WHEN 0 THEN 30.0 WHEN 1 THEN 15.0 ELSE 50.0 END AS sp FROM supplier))")
def support_zones(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("id"), (k % 90 + 10.0).alias("len"), F.when(k % 3 == 0, 30.0).when(k % 3 == 1, 15.0).otherwise(50.0).alias("span"))
    return deck.supports(s, F.col("len") / 2, F.col("span")).select("id", F.col("zone").cast("long").alias("zone"), "zone_s")


@query()
def emi_kernel(spark, sf_dir):
    from strataflux.operators import kernels

    # A window is 64 neighbouring pixels of a label; 32 dates of complex values.
    window = F.concat_ws("-", "label", F.floor(F.col("vec_id") / 64))
    e = table(spark, sf_dir, "embeddings").select(window.alias("window"), F.col("vec_id").alias("pixel"), F.slice("embedding", 1, 32).alias("re"), F.slice("embedding", 33, 32).alias("im"))
    return kernels.phase_link(e, "window", "pixel", least=3)


@query()
def refocus_kernel(spark, sf_dir):
    from strataflux.operators import kernels

    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("window"), F.col("vec_id").alias("pixel"), F.slice("embedding", 1, 32).alias("re"), F.slice("embedding", 33, 32).alias("im"))
    return kernels.refocus(e, "pixel", 8)
