"""Queries that compose operators: the whole judgement of structures, its history and the views of its results.

Nations stand for decks, suppliers for scatterers of two tiles, their monthly quantities for displacement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflux.functions import regress
from strataflux.functions.expr import status_label
from strataflux.operators import history, judge, qc, results, spatial, structures, timeline
from strataflux.plans.queries import SEASONAL_SQL, observations, obs_sql, query, table
from strataflux.sources import search

AS_OF = "1998-08-20"
KINDS = ["APES", "Capon", "PS", "DS"]


def decks(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    pick = lambda n, *x: F.element_at(F.array(*map(F.lit, x)), (k % n + 1).cast("int"))
    far = F.when(k == 23, 9000.0).otherwise(0.0)
    return table(spark, sf_dir, "nation").select(
        (k % 2).alias("tile"), k.alias("bridge"), F.when(k != 24, (k * 7919 % 400).cast("double") + far).alias("x0"), (k * 104729 % 200).cast("double").alias("y0"),
        pick(3, 0.0, 0.6, -0.6).alias("ax"), pick(3, 1.0, 0.8, 0.8).alias("ay"), F.when(k == 5, 15.0).otherwise((k % 5 * 40 + 60).cast("double")).alias("len"), (k % 4 * 8 + 14).cast("double").alias("width"),
        pick(3, "1종", "2종", "기타").alias("cls"), pick(4, "PSCI거더교", "강박스거더교", "RC슬래브교", None).alias("type"),
    )


def points(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select((k % 2).cast("int").alias("tile"), k.alias("point"), (k * 7919 % 400).cast("double").alias("x"), (k * 104729 % 200).cast("double").alias("y"), F.element_at(F.array(*map(F.lit, KINDS)), (k % 4 + 1).cast("int")).alias("src"))


def series(spark, sf_dir) -> DataFrame:
    """tile, point, date, t, y (mm) and dtemp, the temperature of the month's orders less its mean."""
    o = observations(spark, sf_dir).select((F.col("bridge") % 2).cast("int").alias("tile"), F.col("bridge").alias("point"), F.col("d").alias("date"), "t", (F.col("y") / 20).alias("y"))
    w = table(spark, sf_dir, "orders").where(F.month("o_orderdate") != 7).groupBy(F.trunc("o_orderdate", "month").alias("date")).agg((F.avg("o_totalprice") / 10000).alias("temp"))
    days = timeline.fill_temperature(o.select("tile", "date").distinct(), w, ["tile"], ["date"])
    return o.join(days.select("tile", "date", "dtemp"), ["tile", "date"])


_TABLES = f"""decks AS (SELECT n_nationkey % 2 AS tile, n_nationkey AS bridge, CASE WHEN n_nationkey <> 24 THEN n_nationkey * 7919 % 400 + CASE WHEN n_nationkey = 23 THEN 9000.0::DOUBLE ELSE 0 END END AS x0,
    (n_nationkey * 104729 % 200)::DOUBLE AS y0, [0.0, 0.6, -0.6][n_nationkey % 3 + 1]::DOUBLE AS ax, [1.0, 0.8, 0.8][n_nationkey % 3 + 1]::DOUBLE AS ay,
    (CASE WHEN n_nationkey = 5 THEN 15 ELSE n_nationkey % 5 * 40 + 60 END)::DOUBLE AS len, (n_nationkey % 4 * 8 + 14)::DOUBLE AS width,
    ['1종', '2종', '기타'][n_nationkey % 3 + 1] AS cls, ['PSCI거더교', '강박스거더교', 'RC슬래브교', NULL][n_nationkey % 4 + 1] AS type FROM nation),
  facts AS (SELECT *, least(CASE type WHEN 'PSCI거더교' THEN 30 WHEN '강박스거더교' THEN 45 WHEN 'RC슬래브교' THEN 10 ELSE 25 END, greatest(len, 1))::DOUBLE AS span FROM decks),
  pts AS (SELECT s_suppkey % 2 AS tile, s_suppkey AS point, (s_suppkey * 7919 % 400)::DOUBLE AS x, (s_suppkey * 104729 % 200)::DOUBLE AS y, ['APES', 'Capon', 'PS', 'DS'][s_suppkey % 4 + 1] AS src FROM supplier),
  ob0 AS (SELECT bridge % 2 AS tile, bridge AS point, d AS date, t, y / 20 AS y FROM {obs_sql()}),
  wx AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) / 10000 AS temp FROM orders WHERE month(o_orderdate) <> 7 GROUP BY 1),
  dy AS (SELECT tile, date, coalesce(temp, avg(temp) OVER (PARTITION BY tile)) AS temp FROM (SELECT DISTINCT tile, date FROM ob0) LEFT JOIN wx USING (date)),
  dz AS (SELECT tile, date, temp - avg(temp) OVER (PARTITION BY tile) AS dtemp FROM dy),
  axis AS (SELECT tile, count(DISTINCT date) AS n_dates, max(t) AS t_end, max(t) - min(t) AS years, min(date) AS d0, max(date) AS d1 FROM ob0 GROUP BY tile),
  gap AS (SELECT axis.tile, n_dates / (date_diff('day', d0, d1) / 12 + 1) AS date_cover, mg > 365 OR n_dates / (date_diff('day', d0, d1) / 12 + 1) < 0.6 OR date_diff('day', d1, DATE '{AS_OF}') > 60 AS flag
    FROM axis JOIN (SELECT tile, max(g) AS mg FROM (SELECT tile, date_diff('day', lag(date) OVER (PARTITION BY tile ORDER BY date), date) AS g FROM dz) GROUP BY tile) USING (tile)),
  ob AS (SELECT o.*, dtemp, t >= t_end - 2 AS recent FROM ob0 o JOIN axis USING (tile) JOIN dz USING (tile, date)),
  whole AS (SELECT tile, point FROM ob0 JOIN axis USING (tile) GROUP BY tile, point, n_dates HAVING count(y) = n_dates),
  sc AS (SELECT p.tile, p.point, p.src, d.bridge, d.len, d.width, (p.x - x0) * ax + (p.y - y0) * ay AS s, (p.y - y0) * ax - (p.x - x0) * ay AS c FROM pts p JOIN whole USING (tile, point) JOIN decks d USING (tile) WHERE x0 IS NOT NULL),
  placed AS (SELECT *, abs(c) <= width / 2 + 6 AND abs(s) <= len / 2 + 3 AS "on", dg BETWEEN 30 AND 300 AS ring, dg BETWEEN 100 AND 500 AS far,
    CASE WHEN abs(c) <= 50 AND abs(s) BETWEEN len / 2 + 10 AND len / 2 + 200 THEN sign(s)::INT END AS "end"
    FROM (SELECT *, sqrt(greatest(abs(s) - len / 2, 0) ** 2 + greatest(abs(c) - width / 2, 0) ** 2) AS dg FROM sc))"""


def _fit(name: str, source: str, keys: str) -> str:
    """CTE ``name`` (keys, v, se): the velocity of the y of ``source``, null under 12 values."""
    sse = "greatest(yy - c_0 * r_0 - c_1 * r_1 - c_2 * r_2 - c_3 * r_3, 0)"
    return f"{name} AS (SELECT {keys}, CASE WHEN n >= 12 THEN c_3 END AS v, CASE WHEN n >= 12 THEN sqrt({sse} / greatest(n - 4, 1) / last_g) END AS se FROM ({regress.ols_sql(source, keys, 'y', SEASONAL_SQL)}))"


def _halves(name: str, source: str, keys: str) -> str:
    of = lambda c, r: f"max({c}) FILTER ({r})"
    return f"{_fit(name + '_h', source, keys + ', recent')}, {name} AS (SELECT {keys}, {of('v', 'recent')} - {of('v', 'NOT recent')} AS acc, sqrt({of('se', 'recent')} ** 2 + {of('se', 'NOT recent')} ** 2) AS acc_se FROM {name}_h GROUP BY {keys})"


_RLEV = "CASE WHEN {0} >= th[3] THEN 3 WHEN {0} >= th[2] THEN 2 WHEN {0} >= th[1] THEN 1 ELSE 0 END"
_GRADE = "CASE WHEN {0} IS NULL THEN -1 WHEN NOT {1} THEN 0 WHEN {0} >= {4} THEN 3 WHEN {0} >= {3} THEN 2 WHEN {0} >= {2} THEN 1 ELSE 0 END"
_THRESHOLDS = "CASE cls WHEN '1종' THEN [0.3, 0.5, 0.7] WHEN '2종' THEN [0.4, 0.6, 0.8] ELSE [0.5, 0.7, 0.9] END"
JUDGED = (
    f"WITH {_TABLES}, nring AS (SELECT bridge, count(*) AS n_ring FROM placed WHERE ring GROUP BY bridge HAVING count(*) >= 8), "
    "ring AS (SELECT bridge, point, date, t, recent, ob.y, n_ring FROM ob JOIN placed USING (tile, point) JOIN nring USING (bridge) WHERE ring), "
    f"{_fit('rv', 'ring', 'bridge, point')}, {_halves('ra', 'ring', 'bridge, point')}, "
    "g AS (SELECT * FROM (SELECT bridge, median(v) AS v_med, mad(v) * 1.4826 AS v_sig FROM rv GROUP BY bridge) JOIN (SELECT bridge, median(acc) AS a_med, mad(acc) * 1.4826 AS a_sig FROM ra GROUP BY bridge) USING (bridge) JOIN nring USING (bridge)), "
    "gts AS (SELECT bridge, date, median(y) AS g FROM ring GROUP BY ALL), "
    "nd0 AS (SELECT bridge, node, node * 3.0 - len / 2 AS node_s, len, tile, point FROM (SELECT *, unnest(range(0, floor(len / 3 + 1e-9)::INT + 1)) AS node FROM placed WHERE \"on\") WHERE abs(s - (node * 3.0 - len / 2)) <= 3), "
    "nd AS (SELECT bridge, node, node_s, len, date, t, dtemp, recent, median(y) AS y FROM ob JOIN nd0 USING (tile, point) GROUP BY ALL), "
    f"kt AS (SELECT bridge, node, c_2 AS k FROM ({regress.ols_sql('nd', 'bridge, node', 'y', ['1.0', 't', 'dtemp'])})), "
    "nc AS (SELECT nd.*, y - coalesce(k * dtemp, 0) AS yc FROM nd JOIN kt USING (bridge, node)), "
    "sg AS (SELECT bridge, floor((node_s + len / 2) / 15)::INT AS segment, date, t, recent, avg(yc) AS y FROM nc WHERE floor((node_s + len / 2) / 15) * 15 - len / 2 < len / 2 GROUP BY ALL), "
    f"{_fit('sv', 'sg', 'bridge, segment')}, {_halves('sa', 'sg', 'bridge, segment')}, "
    "sr AS (SELECT bridge, segment, years, v_sig, round(v - coalesce(v_med, 0), 2) AS v, round(acc - coalesce(a_med, 0), 2) AS acc, round(greatest(2 * coalesce(v_sig, 0), 2 * se), 2) AS v_thr, abs(v - coalesce(v_med, 0)) > greatest(2 * coalesce(v_sig, 0), 2 * se) AS is_v, abs(acc - coalesce(a_med, 0)) > greatest(2 * coalesce(a_sig, 0), 2 * acc_se) AS is_a "
    "  FROM sv JOIN sa USING (bridge, segment) LEFT JOIN g USING (bridge) JOIN decks USING (bridge) JOIN axis USING (tile)), "
    "s2 AS (SELECT *, CASE WHEN lead(segment) OVER w = segment + 1 THEN abs(lead(v) OVER w - v) END AS diff, coalesce(2 * sqrt(2) * v_sig, sqrt(2) * max(v_thr) OVER (PARTITION BY bridge)) AS d_thr FROM sr WINDOW w AS (PARTITION BY bridge ORDER BY segment)), "
    "ri AS (SELECT bridge, coalesce(max(abs(v)) FILTER (is_v), max(abs(v))) AS V, count(*) FILTER (is_v) > 0 AS sV, coalesce(max(abs(acc)) FILTER (is_a), max(abs(acc))) AS ACC, "
    "  count(*) FILTER (is_a) > 0 AS sA, CASE WHEN count(*) > 1 THEN coalesce(max(diff), 0) END AS DIFF, coalesce(max(diff) > max(d_thr), false) AS sD, max(years) AS y FROM s2 GROUP BY bridge), "
    "sup AS (SELECT tile, bridge, span, zone, CASE WHEN floor(len / span + 1e-9) >= 1 THEN zone * span - len / 2 WHEN zone = 0 THEN -len / 2 ELSE len / 2 END AS zone_s FROM (SELECT *, unnest(range(0, greatest(floor(len / span + 1e-9)::INT, 1) + 1)) AS zone FROM facts)), "
    "zs AS (SELECT bridge, zone, date, t, avg(yc) - coalesce(any_value(g), 0) AS yc, avg(y) - coalesce(any_value(g), 0) AS yr FROM nc JOIN sup USING (bridge) LEFT JOIN gts USING (bridge, date) WHERE abs(node_s - zone_s) <= greatest(4.5, span / 4) GROUP BY bridge, zone, date, t), "
    f"{_fit('zv', '(SELECT bridge, zone, t, yc AS y FROM zs)', 'bridge, zone')}, {_fit('zr', '(SELECT bridge, zone, t, yr AS y FROM zs)', 'bridge, zone')}, "
    f"z AS (SELECT zv.bridge, zone, years, span, {_THRESHOLDS} AS th, 0.002 AS ba, round(zv.v, 2) AS v, abs(zv.v) > greatest(2 * coalesce(v_sig, 0), 2 * zv.se) AS sig, abs(zv.v) AS av, "
    "  round(sqrt(zv.se ** 2 + coalesce(v_sig / sqrt(n_ring), 0) ** 2) * sqrt(greatest(1, 1 / greatest(date_cover, 0.05))), 3) AS sv, coalesce(round(abs(zv.v - zr.v) * years, 1), 0) AS dT "
    "  FROM zv JOIN zr USING (bridge, zone) JOIN facts USING (bridge) JOIN axis USING (tile) JOIN gap USING (tile) LEFT JOIN g USING (bridge) WHERE zv.v IS NOT NULL), "
    "z2 AS (SELECT *, CASE WHEN sig THEN round(av * years, 1) ELSE 0 END AS D, CASE WHEN sig THEN round(av * (years + 10), 1) ELSE 0 END AS D10, lead(zone) OVER w = zone + 1 AS adj, abs(lead(v) OVER w - v) AS dv, sig OR lead(sig) OVER w AS either, 2 * sqrt(sv ** 2 + lead(sv) OVER w ** 2) AS two FROM z WINDOW w AS (PARTITION BY bridge ORDER BY zone)), "
    "zj AS (SELECT bridge, any_value(th) AS th, max(D) AS d_now, max(D10) AS d_10y, coalesce(max(dv * years / 1000 / span) FILTER (adj AND either), 0) AS b_now, coalesce(max(dv * (years + 10) / 1000 / span) FILTER (adj AND either), 0) AS b_10y, "
    "  greatest(max(greatest(abs(v) * years - 2 * sv * years - dT, 0)) / 25, coalesce(max(greatest(dv - two, 0) * years / 1000 / span) FILTER (adj), 0) / any_value(ba)) AS r_lo, "
    "  greatest(max(abs(v) * years + 2 * sv * years + dT) / 25, coalesce(max((dv + two) * years / 1000 / span) FILTER (adj), 0) / any_value(ba)) AS r_hi, max(dT) AS thermal_mm FROM z2 GROUP BY bridge), "
    "nfar AS (SELECT bridge, count(*) AS n_far FROM placed WHERE far GROUP BY bridge HAVING count(*) >= 5), "
    "fr AS (SELECT bridge, point, date, t, ob.y FROM ob JOIN placed USING (tile, point) JOIN nfar USING (bridge) WHERE far), "
    f"{_fit('fv', 'fr', 'bridge, point')}, fs AS (SELECT bridge, mad(v) * 1.4826 AS sigma FROM fv GROUP BY bridge), fm AS (SELECT bridge, date, median(y) AS g FROM fr GROUP BY ALL), "
    "en AS (SELECT bridge, \"end\", t, m - g AS y FROM (SELECT bridge, \"end\", date, t, median(ob.y) AS m FROM ob JOIN placed USING (tile, point) WHERE \"end\" IS NOT NULL GROUP BY ALL) JOIN fm USING (bridge, date)), "
    f"{_fit('ev', 'en', 'bridge, \"end\"')}, "
    "e2 AS (SELECT bridge, round(v, 2) AS v, abs(v) > greatest(2 * sigma, 2 * se) AS sig, years, len, cls FROM ev JOIN fs USING (bridge) JOIN decks USING (bridge) JOIN axis USING (tile) WHERE v IS NOT NULL), "
    f"px AS (SELECT bridge, any_value({_THRESHOLDS}) AS th, max(CASE WHEN sig THEN abs(v) * years ELSE 0 END) AS d_now, max(CASE WHEN sig THEN abs(v) * (years + 10) ELSE 0 END) AS d_10y, "
    "  CASE WHEN count(*) = 2 AND bool_or(sig) THEN (max(v) - min(v)) * max(years) / 1000 / greatest(max(len), 1) ELSE 0 END AS b_now, CASE WHEN count(*) = 2 AND bool_or(sig) THEN (max(v) - min(v)) * (max(years) + 10) / 1000 / greatest(max(len), 1) ELSE 0 END AS b_10y FROM e2 GROUP BY bridge), "
    "al AS (SELECT bridge, th, d_now, d_10y, b_now, b_10y, r_lo, r_hi, thermal_mm, false AS proxy FROM zj UNION ALL SELECT bridge, th, d_now, d_10y, b_now, b_10y, NULL, NULL, NULL, true FROM px ANTI JOIN zj USING (bridge)), "
    "lv AS (SELECT *, greatest(d_now / 25, b_now / 0.002) AS r_now, greatest(d_10y / 25, b_10y / 0.002) AS r_10y FROM al), "
    f"l2 AS (SELECT *, greatest({_RLEV.format('r_now')}, least({_RLEV.format('r_10y')}, {_RLEV.format('r_now')} + 1)) AS level, {_RLEV.format('r_lo')} <> {_RLEV.format('r_hi')} AS uncertain FROM lv), "
    "np AS (SELECT bridge, count(*) FILTER (\"on\") AS n_ps FROM placed GROUP BY bridge), cv AS (SELECT bridge, count(DISTINCT node) AS k FROM nd GROUP BY bridge), "
    "fin AS (SELECT d.tile, d.bridge, d.len, d.x0, coalesce(l2.level, -1) AS level, coalesce(proxy, false) AS proxy, coalesce(n_ps, 0) AS n_ps, coalesce(k, 0) / (floor(d.len / 3 + 1e-6) + 1) AS cover, g.n_ring IS NOT NULL AND NOT coalesce(proxy, true) AS has_ring, coalesce(flag, false) AS gap, "
    "  d_now, d_10y, b_now, b_10y, r_now, r_10y, r_lo, r_hi, thermal_mm, CASE WHEN NOT proxy THEN uncertain END AS uncertain, ri.* EXCLUDE (bridge) "
    "  FROM decks d LEFT JOIN l2 USING (bridge) LEFT JOIN np USING (bridge) LEFT JOIN cv USING (bridge) LEFT JOIN g USING (bridge) LEFT JOIN gap USING (tile) LEFT JOIN ri USING (bridge)) "
)


@query(
    JUDGED
    + """SELECT bridge, level, proxy, n_ps, round(cover, 4) AS cover, has_ring, round(d_now, 1) AS d_now, round(d_10y, 1) AS d_10y, round(b_now, 6) AS beta_now, round(b_10y, 6) AS beta_10y, round(r_now, 3) AS r_now, round(r_10y, 3) AS r_10y,
  round(r_lo, 3) AS r_lo, round(r_hi, 3) AS r_hi, thermal_mm, uncertain, CASE WHEN level < 0 THEN NULL WHEN proxy OR NOT has_ring THEN '낮음' WHEN cover >= 0.5 THEN '높음' WHEN cover >= 0.25 THEN '보통' ELSE '낮음' END AS conf,
  CASE WHEN proxy THEN true WHEN level < 0 THEN NULL ELSE level >= 2 AND (n_ps < 5 OR cover < 0.25 OR NOT has_ring OR uncertain OR gap) END AS review,
  CASE WHEN level < 0 THEN CASE WHEN x0 IS NULL THEN 'OSM 형상 없음' WHEN n_ps = 0 THEN '교량 위·교대부 모두 산란체 없음' ELSE '지점부·교대부 산란체 없음' END END AS reason,
  CASE WHEN level >= 0 AND NOT proxy AND len < 20 THEN '연장 20 m 미만: Sentinel-1 해상도 한계 (참고)' END AS note FROM fin"""
)
def judge_bridges(spark, sf_dir):
    """A judged record for each deck, from points and series."""
    out = structures.judge_structures(decks(spark, sf_dir), points(spark, sf_dir), series(spark, sf_dir), F.lit(AS_OF).cast("date"))
    r = lambda c, n, to=None: F.round(c, n).alias(to or c)
    return out.select(
        "bridge", "level", "proxy", "n_ps", r("cover", 4), (F.col("has_ring") & ~F.col("proxy") & (F.col("level") >= 0)).alias("has_ring"), r("D_now", 1, "d_now"), r("D_10y", 1, "d_10y"), r("beta_now", 6), r("beta_10y", 6), r("r_now", 3), r("r_10y", 3),
        r("r_lo", 3), r("r_hi", 3), "thermal_mm", "uncertain", "conf", F.when(F.col("level") >= 0, F.col("review")).alias("review"), "reason", "note",
    )


@query(
    JUDGED
    + """SELECT bridge, round(V, 2) AS v, """
    + _GRADE.format("V", "sV", 1, 2, 4)
    + " AS lv_v, round(ACC, 2) AS acc, "
    + _GRADE.format("ACC", "sA", 1, 2, 3)
    + " AS lv_acc, round(DIFF, 2) AS diff, "
    + _GRADE.format("DIFF", "sD", 1, 2, 3)
    + " AS lv_diff, round(V * y, 2) AS cum, "
    + _GRADE.format("(V * y)", "sV", 10, 20, 30)
    + " AS lv_cum FROM ri"
)
def risk_indicators(spark, sf_dir):
    """The four indicators of each deck with points."""
    d, p, o = decks(spark, sf_dir), points(spark, sf_dir), series(spark, sf_dir)
    parts = structures.deck_parts(d, p, o)
    risk = judge.indicators(structures.segments(parts.nodes, parts.surroundings, parts.years), ["bridge"], "segment")
    r = lambda c: [F.round(c, 2).alias(c.lower()), F.col(f"lv_{c}").alias(f"lv_{c.lower()}")]
    return risk.select("bridge", *r("V"), *r("ACC"), *r("DIFF"), *r("CUM"))


@query(
    JUDGED.replace("SELECT bridge, node, c_2 AS k FROM", "SELECT bridge, node, c_1, c_2 AS k FROM")
    + """, rs AS (SELECT bridge, node, stddev_pop(y - c_1 * t) AS raw FROM nd JOIN kt USING (bridge, node) GROUP BY ALL), cs AS (SELECT bridge, node, stddev_pop(yc - b * t) AS corr FROM nc JOIN (SELECT bridge, node, regr_slope(yc, t) AS b FROM nc GROUP BY ALL) USING (bridge, node) GROUP BY ALL)
SELECT bridge, round(median(raw), 4) AS std_raw, round(median(corr), 4) AS std_corr FROM rs JOIN cs USING (bridge, node) GROUP BY bridge"""
)
def residual_scale(spark, sf_dir):
    """Deviation of a deck's nodes about their trend, before and after the thermal correction."""
    parts = structures.deck_parts(decks(spark, sf_dir), points(spark, sf_dir), series(spark, sf_dir))
    return structures.residual_scale(parts.nodes).select("bridge", F.round("std_raw", 4).alias("std_raw"), F.round("std_corr", 4).alias("std_corr"))


def series_kinds(spark, sf_dir) -> DataFrame:
    """bridge, date, los, vert and vert_tc of suppliers; every seventh month lacks the corrected value."""
    o = observations(spark, sf_dir).select("bridge", F.date_format("d", "yyyyMMdd").alias("date"), (F.col("y") * 0.0517).alias("vert"))
    return o.select("bridge", "date", (F.col("vert") * 0.777).alias("los"), "vert", F.when(F.substring("date", 5, 2) != "07", F.col("vert") - 1).alias("vert_tc"))


@query(
    f"""WITH o AS (SELECT bridge, strftime(d, '%Y%m%d') AS date, y * 0.0517 AS vert FROM {obs_sql()}), k AS (SELECT bridge, date, 'los' AS kind, vert * 0.777 AS v FROM o UNION ALL SELECT bridge, date, 'vert', vert FROM o
  UNION ALL SELECT bridge, date, 'vert_tc', vert - 1 FROM o WHERE substr(date, 5, 2) <> '07') SELECT bridge, date, kind, round(v, 1) AS disp_mm FROM k"""
)
def series_unpivot(spark, sf_dir):
    return structures.unpivot_series(series_kinds(spark, sf_dir), ["bridge"])


_CYCLES = "c AS (SELECT user_id AS bridge, CAST(ts AS DATE) AS run, CAST(count(*) % 4 AS INT) AS level, max(value) AS r_now FROM events GROUP BY ALL), n AS (SELECT run, row_number() OVER (ORDER BY run) AS cycle FROM (SELECT DISTINCT run FROM c)), j AS (SELECT * FROM c JOIN n USING (run))"


def judgements(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Cycles and judgements: event days stand for runs, users for structures."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("bridge"), F.to_date("ts").alias("run")).agg((F.count("*") % 4).cast("int").alias("level"), F.max("value").alias("r_now"))
    cycles = history.cycle_numbers(e, "run")
    return cycles, e.join(cycles, "run")


@query(
    f"""WITH {_CYCLES}, p AS (SELECT bridge, level AS prev FROM j WHERE cycle = (SELECT max(cycle) - 1 FROM n))
SELECT bridge, CAST(cycle AS INT) AS cycle, j.level, prev, CASE WHEN j.level < 2 THEN NULL WHEN prev IS NULL OR prev < 2 THEN '신규 경보' WHEN j.level > prev THEN '등급 상승' ELSE '지속' END AS kind
FROM j LEFT JOIN p USING (bridge) WHERE cycle = (SELECT max(cycle) FROM n)"""
)
def history_cycle(spark, sf_dir):
    """The last cycle against the one before."""
    cycles, rows = judgements(spark, sf_dir)
    out = history.changes(rows, cycles)
    kind = F.when(F.col("level") >= 2, results.alert_kind(F.col("level"), F.col("prev"), F.lit(False)))
    return out.select("bridge", "cycle", "level", "prev", kind.alias("kind"))


@query(
    """WITH r AS (SELECT s.s_suppkey AS bridge, t.level FROM supplier s LEFT JOIN (SELECT l_suppkey AS bridge, CAST(sum(l_quantity) % 5 AS INT) - 1 AS level FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 HAVING count(*) % 7 > 0) t ON t.bridge = s.s_suppkey),
  c AS (SELECT CASE WHEN level IS NULL THEN '미처리' WHEN level < 0 THEN '판정 불가' ELSE ['정상', '관심', '주의', '경고'][level + 1] END AS status, count(*) AS k, count(*) FILTER (level >= 0) AS j FROM r GROUP BY 1)
SELECT CAST(sum(k) AS BIGINT) AS n, CAST(sum(j) AS BIGINT) AS n_judged, string_agg(status || '=' || k, ',' ORDER BY status) AS counts, (SELECT count(*) FROM r WHERE level >= 2) AS n_alerts, (SELECT count(*) FROM events WHERE event_type = 'error') AS n_errors FROM c"""
)
def summary_view(spark, sf_dir):
    res = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").groupBy(F.col("l_suppkey").alias("bridge")).agg(F.count("*").alias("k"), F.sum("l_quantity").alias("q")).where("k % 7 > 0").select("bridge", ((F.col("q") % 5).cast("int") - 1).alias("level"))
    rows = history.state(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("bridge")), res)
    events = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "경고").otherwise("정보").alias("level"))
    out = history.summary(rows, rows.where("level >= 2"), events)
    text = F.array_join(F.transform(F.map_entries("counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")
    return out.withColumn("counts", text)


_LIST = """CASE WHEN level < 0 THEN '판정 불가' ELSE ['정상', '관심', '주의', '경고'][level + 1] END || '/' || n_ps"""


@query(
    f"""WITH r AS (SELECT l_suppkey AS bridge, l_returnflag AS track, count(*) AS n_ps, CAST(sum(l_quantity) % 5 AS INT) - 1 AS level FROM lineitem GROUP BY ALL)
SELECT s_suppkey AS bridge, s_name AS name, n_name AS city, string_agg(track || ':' || {_LIST}, ' ' ORDER BY track) AS tracks,
  '교축 ' || CASE WHEN s_suppkey % 90 < 45 THEN '-' ELSE '+' END || CAST(abs(s_suppkey % 90 - 45) AS BIGINT) || '~' || CASE WHEN s_suppkey % 90 < 30 THEN '-' ELSE '+' END || CAST(abs(s_suppkey % 90 - 30) AS BIGINT) || ' m 구간' AS place
FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN r ON r.bridge = s_suppkey GROUP BY ALL"""
)
def bridge_view(spark, sf_dir):
    """Each structure with its place and the results of all its tracks."""
    res = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("bridge"), F.col("l_returnflag").alias("track")).agg(F.count("*").alias("n_ps"), ((F.sum("l_quantity") % 5).cast("int") - 1).alias("level"))
    by = history.by_tracks(res.withColumns({"proxy": F.lit(False), "r_now": F.lit(None).cast("double")}))
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    text = F.array_join(F.transform("tracks", lambda t: F.concat(t["track"], F.lit(":"), status_label(t["level"]), F.lit("/"), t["n_ps"].cast("string"))), " ")
    return s.select(F.col("s_suppkey").alias("bridge"), F.col("s_name").alias("name"), F.col("n_name").alias("city"), history.segment_label((F.col("s_suppkey") % 90 - 45).cast("double")).alias("place")).join(by.select("bridge", text.alias("tracks")), "bridge", "left")


@query(
    f"""WITH c AS (SELECT o_orderkey AS scene, CAST(c_custkey * 6151 % 3000 AS DOUBLE) AS x, CAST(c_custkey * 3571 % 3000 AS DOUBLE) AS y, o_orderdate FROM orders JOIN customer ON c_custkey = o_custkey),
  a AS (SELECT n_nationkey % 5 * 600.0 AS W, n_nationkey % 5 * 600.0 + 100 AS E, n_nationkey // 5 * 600.0 AS S, n_nationkey // 5 * 600.0 + 80 AS N FROM nation)
SELECT scene, strftime(o_orderdate, '%Y%m%d') AS date FROM c WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1996-07-01' AND EXISTS (SELECT 1 FROM a WHERE x <= E AND x + 50 >= W AND y <= N AND y + 50 >= S)"""
)
def scene_search(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scene"), "o_custkey", F.col("o_orderdate").alias("start_time"))
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 6151 % 3000).cast("double").alias("W"), (F.col("c_custkey") * 3571 % 3000).cast("double").alias("S"))
    catalogue = o.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumns({"E": F.col("W") + 50, "N": F.col("S") + 50})
    k = F.col("n_nationkey")
    w, s = (k % 5) * 600.0, F.floor(k / 5) * 600.0
    area = table(spark, sf_dir, "nation").select(w.alias("W"), (w + 100).alias("E"), s.alias("S"), (s + 80).alias("N"))
    return search.scenes(catalogue, area, "1996-01-01", "1996-06-30", cell=200.0).select("scene", F.date_format("start_time", "yyyyMMdd").alias("date"))


@query("SELECT DISTINCT n_name AS city FROM supplier JOIN nation ON n_nationkey = s_nationkey ORDER BY 1")
def city_list(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.col("n_name").alias("city")).distinct().orderBy("city")


@query(f"WITH {_TABLES} SELECT bridge, count(*) FILTER (\"on\" AND src = 'APES') AS n_apes, count(*) FILTER (\"on\" AND src = 'Capon') AS n_capon, count(*) FILTER (\"on\" AND src = 'PS') AS n_ps, count(*) FILTER (\"on\" AND src = 'DS') AS n_ds FROM placed WHERE \"on\" OR ring OR far OR \"end\" IS NOT NULL GROUP BY bridge")
def deck_sources(spark, sf_dir):
    """Points of each source on each deck."""
    parts = structures.deck_parts(decks(spark, sf_dir), points(spark, sf_dir), series(spark, sf_dir))
    return structures.sources(parts.placed, KINDS).select("bridge", *(F.col(f"n_{k}").alias(f"n_{k.lower()}") for k in KINDS))


@query(
    f"WITH f AS ({regress.ols_sql(obs_sql(), 'bridge', 'y', SEASONAL_SQL)}), d AS (SELECT bridge, o.y - c_3 * o.t AS r FROM {obs_sql()} o JOIN f USING (bridge)) SELECT bridge, round(stddev_pop(r), 4) AS stability FROM d GROUP BY bridge"
)
def point_stability(spark, sf_dir):
    """Deviation of each series about its trend."""
    return regress.stability(observations(spark, sf_dir), ["bridge"], "y").select("bridge", F.round("stability", 4).alias("stability"))


_LADDER = "[0.95, 0.92, 0.90, 0.85, 0.80]"


@query(
    f"""WITH p AS (SELECT s_suppkey AS id, s_nationkey % 5 AS tile, s_suppkey * 7919 % 3000 - 1500.0 AS x, s_suppkey * 104729 % 3000 - 1500.0 AS y, (s_suppkey * 31 % 100) / 100 AS coh FROM supplier),
  v AS (SELECT c_custkey * 6151 % 3000 - 1500.0 AS x, c_custkey * 3571 % 3000 - 1500.0 AS y FROM customer),
  f AS (SELECT *, CASE WHEN coh >= 0.95 THEN 0 WHEN coh >= 0.92 THEN 1 WHEN coh >= 0.90 THEN 2 WHEN coh >= 0.85 THEN 3 ELSE 4 END AS r FROM p WHERE coh >= 0.8 AND sqrt(x * x + y * y) <= 1500 AND NOT EXISTS (SELECT 1 FROM v WHERE sqrt((p.x - v.x) ** 2 + (p.y - v.y) ** 2) < 20)),
  g AS (SELECT tile, min(r) AS rung, {_LADDER}[min(r) + 1]::DOUBLE AS cmin FROM f GROUP BY tile), c AS (SELECT f.* FROM f JOIN g USING (tile) WHERE coh >= cmin),
  e AS (SELECT a.tile, a.id, count(*) AS n, avg(b.coh) AS m FROM c a JOIN c b ON a.tile = b.tile AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 900 GROUP BY ALL),
  best AS (SELECT tile, id AS centre, n AS n_cluster, m FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY n DESC, round(m, 9) DESC, id) AS k FROM e) WHERE k = 1),
  d AS (SELECT s_nationkey % 5 AS tile, date_trunc('month', l_shipdate) AS d, sqrt(avg(cos(l_quantity / 60)) ** 2 + avg(sin(l_quantity / 60)) ** 2) + 0.02 AS gamma FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
  b AS (SELECT d.*, (year(d) * 37 + month(d) * 101) % 460 - 230 AS bperp, cmin FROM d JOIN g USING (tile))
SELECT tile, g.rung, centre, n_cluster, round(m, 6) AS coh_mean, n_dates, n_kept, drop_bperp, drop_refcoh, round(refcoh_median, 6) AS refcoh_median FROM best JOIN g USING (tile) JOIN (SELECT tile, count(*) AS n_dates,
  count(*) FILTER (abs(bperp) <= 200 AND gamma >= cmin) AS n_kept, count(*) FILTER (abs(bperp) > 200) AS drop_bperp, count(*) FILTER (gamma < cmin) AS drop_refcoh, median(gamma) AS refcoh_median FROM b GROUP BY tile) USING (tile)"""
)
def qc_ladder(spark, sf_dir):
    """The reference cluster of each tile at the first rung that has one, and the dates that this rung keeps."""
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    s = table(spark, sf_dir, "supplier")
    p = s.select(k.alias("id"), (F.col("s_nationkey") % 5).alias("tile"), (k * 7919 % 3000 - 1500.0).alias("x"), (k * 104729 % 3000 - 1500.0).alias("y"), (k * 31 % 100 / 100).alias("coh"))
    v = table(spark, sf_dir, "customer").select((c * 6151 % 3000 - 1500.0).alias("x"), (c * 3571 % 3000 - 1500.0).alias("y"))
    cluster = qc.reference_cluster(p, v, ["tile"], "id", "coh", (0.0, 1500.0), away=20.0, radius=900.0)
    phases = table(spark, sf_dir, "lineitem").join(s, F.col("l_suppkey") == k).select((F.col("s_nationkey") % 5).alias("tile"), F.trunc("l_shipdate", "month").alias("d"), (F.col("l_quantity") / 60).alias("phase"))
    dates = qc.date_coherence(phases, ["tile", "d"], "phase").withColumns({"gamma": F.col("gamma") + 0.02, "bperp": (F.year("d") * 37 + F.month("d") * 101) % 460 - 230})
    dates = dates.join(cluster.select("tile", qc.rung_value(F.col("rung")).alias("cmin")), "tile")
    out = cluster.join(qc.date_summary(dates, ["tile"], gmin=F.col("cmin")), "tile")
    return out.select("tile", "rung", "centre", "n_cluster", F.round("coh_mean", 6).alias("coh_mean"), "n_dates", "n_kept", "drop_bperp", "drop_refcoh", F.round("refcoh_median", 6).alias("refcoh_median"))


@query(
    f"""WITH p AS (SELECT s_suppkey AS id, s_nationkey % 5 AS tile, s_suppkey * 7919 % 3000 - 1500.0 AS x, s_suppkey * 104729 % 3000 - 1500.0 AS y, (s_suppkey * 31 % 100) / 100 AS coh FROM supplier),
  v AS (SELECT c_custkey * 6151 % 3000 - 1500.0 AS x, c_custkey * 3571 % 3000 - 1500.0 AS y FROM customer),
  f AS (SELECT *, CASE WHEN coh >= 0.95 THEN 0 WHEN coh >= 0.92 THEN 1 WHEN coh >= 0.90 THEN 2 WHEN coh >= 0.85 THEN 3 ELSE 4 END AS r FROM p WHERE coh >= 0.8 AND sqrt(x * x + y * y) <= 1500 AND NOT EXISTS (SELECT 1 FROM v WHERE sqrt((p.x - v.x) ** 2 + (p.y - v.y) ** 2) < 20)),
  g AS (SELECT tile, {_LADDER}[min(r) + 1]::DOUBLE AS cmin FROM f GROUP BY tile), c AS (SELECT f.* FROM f JOIN g USING (tile) WHERE coh >= cmin),
  e AS (SELECT a.tile, a.id, count(*) AS n, avg(b.coh) AS m FROM c a JOIN c b ON a.tile = b.tile AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 1800 GROUP BY ALL),
  best AS (SELECT tile, id AS centre FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY n DESC, round(m, 9) DESC, id) AS k FROM e) WHERE k = 1),
  mem AS (SELECT c.tile, c.id FROM best JOIN c z ON z.tile = best.tile AND z.id = centre JOIN c ON c.tile = z.tile AND sqrt((c.x - z.x) ** 2 + (c.y - z.y) ** 2) <= 1800),
  o AS (SELECT tile, id, d, t, y / 50 AS y FROM {obs_sql()} JOIN mem ON id = bridge), w AS ({regress.ols_sql("o", "tile, id", "y", SEASONAL_SQL)}),
  h AS (SELECT tile, d, (y - c_0 - c_1 * sin(t * 6.283185307179586) - c_2 * cos(t * 6.283185307179586) - c_3 * t) * 4 * pi() / 55.46576 AS phi FROM o JOIN w USING (tile, id)),
  q AS (SELECT tile, d, count(*) AS n, sqrt(avg(cos(phi)) ** 2 + avg(sin(phi)) ** 2) AS gamma FROM h GROUP BY ALL)
SELECT tile, CAST(d AS VARCHAR) AS date, n, round(gamma, 5) AS gamma, gamma >= cmin AS kept FROM q JOIN g USING (tile)"""
)
def reference_gamma(spark, sf_dir):
    """How well the members of each tile's reference cluster agree on each date, and whether the cluster's rung keeps the date."""
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    s = table(spark, sf_dir, "supplier")
    p = s.select(k.alias("id"), (F.col("s_nationkey") % 5).alias("tile"), (k * 7919 % 3000 - 1500.0).alias("x"), (k * 104729 % 3000 - 1500.0).alias("y"), (k * 31 % 100 / 100).alias("coh"))
    v = table(spark, sf_dir, "customer").select((c * 6151 % 3000 - 1500.0).alias("x"), (c * 3571 % 3000 - 1500.0).alias("y"))
    chosen, first = qc.reference_candidates(p, v, ["tile"], "coh", (0.0, 1500.0), away=20.0)
    cluster = spatial.densest_cluster(chosen, 1800.0, "id", "coh", ["tile"])
    members = qc.cluster_members(chosen, cluster, ["tile"], "id", 1800.0)
    o = observations(spark, sf_dir).join(s, F.col("bridge") == k).select((F.col("s_nationkey") % 5).alias("tile"), F.col("bridge").alias("id"), F.col("d").alias("date"), "t", (F.col("y") / 50).alias("y"))
    out = qc.reference_coherence(o, members, ["tile"], "id", "date").join(first, "tile")
    return out.select("tile", F.col("date").cast("string").alias("date"), "n", F.round("gamma", 5).alias("gamma"), (F.col("gamma") >= qc.rung_value(F.col("rung"))).alias("kept"))
