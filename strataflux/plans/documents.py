"""Queries on the documents and views of a cycle. Suppliers stand for structures, return flags for tracks, users of events for stacks and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strataflux.functions import regress
from strataflux.operators import documents
from strataflux.plans.queries import VELOCITY_SQL, observations, obs_sql, query, table

CHECKED = "2024-03-31"


def structures(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    pick = lambda n, *x: F.element_at(F.array(*map(F.lit, x)), (k % n + 1).cast("int"))
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(
        k.alias("bridge"), F.col("s_name").alias("name"), F.col("n_name").alias("city"), (k % 97 / 8 + 37).alias("lat"), (k % 89 / 4 + 128).alias("lon"), pick(4, "기타", "1종", "2종", "3종").alias("cls"),
        pick(3, None, "RC슬래브교", "PSCI거더교").alias("type"), (k % 300 + 0.25).alias("length"), (k % 40 + 1980).alias("year"), pick(5, "A", "B", "C", "D", "E").alias("grade"), F.concat(F.lit("org"), (k % 7).cast("string")).alias("org"),
        F.when(k % 6 > 0, F.concat(F.lit("033-"), (k % 9000).cast("string"))).alias("tel"),
    )


_STRUCTURES = """(SELECT s_suppkey AS bridge, s_name AS name, n_name AS city, s_suppkey % 97 / 8 + 37 AS lat, s_suppkey % 89 / 4 + 128 AS lon, ['기타', '1종', '2종', '3종'][s_suppkey % 4 + 1] AS cls, [NULL, 'RC슬래브교', 'PSCI거더교'][s_suppkey % 3 + 1] AS type,
  s_suppkey % 300 + 0.25::DOUBLE AS length, s_suppkey % 40 + 1980 AS year, ['A', 'B', 'C', 'D', 'E'][s_suppkey % 5 + 1] AS grade, 'org' || s_suppkey % 7 AS org, CASE WHEN s_suppkey % 6 > 0 THEN '033-' || s_suppkey % 9000 END AS tel FROM supplier JOIN nation ON n_nationkey = s_nationkey)"""


def by_track(spark, sf_dir) -> DataFrame:
    """A judgement of each structure on each track."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("bridge"), F.col("l_returnflag").alias("track")).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("q")).where("n % 7 > 0")
    n, q = F.col("n"), F.col("q")
    return li.select(
        "bridge", "track", "n", ((q % 5) - 1).cast("int").alias("level"), (q % 97 / 8).alias("d_now"), (q % 89 / 4).alias("d_10y"), (n % 16 / 8).alias("r_now"), (n % 32 / 8).alias("r_10y"), F.when(n % 3 > 0, n % 8 / 16).alias("r_lo"), (n % 64 / 16).alias("r_hi"),
        F.lit(0.0).alias("d_lo"), F.lit(1.0).alias("d_hi"), (q % 3 / 2).alias("thermal_mm"), (n % 4 == 0).alias("uncertain"), (q % 6 == 0).alias("review"), (n % 5 == 0).alias("proxy"), (n % 11).alias("n_ps"), F.lit("19980801").alias("last_date"),
        (n % 30).alias("n_used"), F.lit(40).alias("n_expected"), F.lit(24).alias("max_gap_days"), (n % 70).alias("stale_days"), (n % 70 > 60).alias("gap"), (n % 4 / 4).alias("cover"), F.lit("높음").alias("conf"), F.lit("OSM 형상 없음").alias("reason"),
    )


_TRACKS = """(SELECT bridge, track, n, CAST(q % 5 AS INT) - 1 AS level, q % 97 / 8 AS d_now, q % 89 / 4 AS d_10y, n % 16 / 8 AS r_now, n % 32 / 8 AS r_10y, CASE WHEN n % 3 > 0 THEN n % 8 / 16 END AS r_lo, n % 64 / 16 AS r_hi, q % 3 / 2 AS thermal_mm, n % 4 = 0 AS uncertain, q % 6 = 0 AS review,
  n % 5 = 0 AS proxy, n % 11 AS n_ps, n % 30 AS n_used, n % 70 AS stale_days, n % 70 > 60 AS gap, n % 4 / 4 AS cover FROM (SELECT l_suppkey AS bridge, l_returnflag AS track, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL) WHERE n % 7 > 0)"""
_BEST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bridge ORDER BY n DESC, track DESC) AS k FROM {_TRACKS}) WHERE k = 1)"
_LABEL = "['정상', '관심', '주의', '경고'][{0} + 1]"


def best(spark, sf_dir) -> DataFrame:
    rows = by_track(spark, sf_dir)
    rest = [c for c in rows.columns if c not in ("bridge", "n", "track")]
    return rows.groupBy("bridge").agg(F.max(F.struct("n", "track", *rest)).alias("m")).select("bridge", "m.track", *(f"m.{c}" for c in rest))


def before(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_suppkey % 4 > 0").select(F.col("s_suppkey").alias("bridge"), (F.col("s_suppkey") % 5 - 1).cast("int").alias("level"))


_RECORDS = f"""(SELECT b.*, name, city, lat, lon, cls, type, length, year, grade, org, tel, {_LABEL.format("b.level")} AS status, CASE WHEN p.level >= 0 THEN {_LABEL.format("p.level")} END AS prev_status,
  CASE WHEN review THEN '확인 필요' WHEN p.level IS NULL OR p.level < 2 THEN '신규 경보' WHEN b.level > p.level THEN '등급 상승' ELSE '지속' END AS kind
  FROM {_BEST} b JOIN {_STRUCTURES} s USING (bridge) LEFT JOIN (SELECT s_suppkey AS bridge, CAST(s_suppkey % 5 AS INT) - 1 AS level FROM supplier WHERE s_suppkey % 4 > 0) p USING (bridge) WHERE b.level >= 2)"""
_SHARE = "CAST(round_even(100 * coalesce({0}, 0), 0) AS INT)"


def records(spark, sf_dir) -> DataFrame:
    return documents.alert_records(best(spark, sf_dir), structures(spark, sf_dir), before(spark, sf_dir))


@query(
    f"""WITH r AS {_RECORDS}, d AS (SELECT *, concat_ws(' · ', CASE WHEN uncertain THEN '오차 범위가 등급 경계를 넘음' END, CASE WHEN gap THEN '자료 공백: 사용 ' || n_used || '/40장, 최장 공백 24일, 최근 영상 ' || stale_days || '일 전' END, CASE WHEN thermal_mm <> 0 THEN '온도 보정 영향 ' || thermal_mm || ' mm (ERA5 기온)' END) AS doubts FROM r)
SELECT bridge, kind, city, cls, type, length, year, grade, org, tel, status, prev_status, proxy, n_ps,
  '- **[' || kind || '] ' || name || '** (' || city || ', ' || cls || ' ' || coalesce(type, 'None') || ', 연장 ' || CAST(round_even(length, 0) AS BIGINT) || ' m, ' || year || '년 준공, 안전점검 ' || grade || ') — ' || status || CASE WHEN prev_status IS NOT NULL THEN ' (이전 ' || prev_status || ')' ELSE '' END
  || chr(10) || '  누적 수직변위 ' || d_now || ' mm, 허용변위 대비 ' || {_SHARE.format("r_now")} || ' %' || CASE WHEN r_lo IS NOT NULL THEN ' (범위 ' || {_SHARE.format("r_lo")} || '–' || {_SHARE.format("r_hi")} || ' %)' ELSE '' END
  || ' (10년 예측 ' || {_SHARE.format("r_10y")} || ' %), 관리기관 ' || org || ' ' || coalesce(tel, 'None') || CASE WHEN proxy THEN ' · 교대부 대체 판정' ELSE '' END || CASE WHEN doubts <> '' THEN chr(10) || '  불확실성: ' || doubts ELSE '' END AS text FROM d"""
)
def alert_report(spark, sf_dir):
    """A record and a paragraph for each structure that needs attention."""
    out = documents.alert_paragraphs(records(spark, sf_dir))
    return out.select("bridge", "kind", "city", "cls", "type", "length", "year", "grade", "org", "tel", "status", "prev_status", "proxy", "n_ps", "text")


@query(
    f"""WITH r AS {_RECORDS} SELECT '{CHECKED}' AS made, (SELECT count(*) FROM supplier) AS n_bridges, (SELECT count(*) FROM {_BEST} WHERE level >= 0) AS n_judged,
  (SELECT string_agg(bridge || kind || status, ',' ORDER BY list_position(['신규 경보', '등급 상승', '확인 필요', '지속'], kind), -r_now, bridge) FROM r) AS alerts"""
)
def alerts_document(spark, sf_dir):
    """The document of all alerts, most urgent first."""
    n = table(spark, sf_dir, "supplier").count()
    judged = best(spark, sf_dir).where("level >= 0").count()
    out = documents.alert_view(records(spark, sf_dir), F.lit(n), F.lit(judged), F.lit(CHECKED))
    text = F.array_join(F.transform("alerts", lambda a: F.concat(a["bridge"].cast("string"), a["kind"], a["status"])), ",")
    return out.select("made", F.col("n_bridges").cast("long").alias("n_bridges"), F.col("n_judged").cast("long").alias("n_judged"), F.when(text != "", text).alias("alerts"))


_HEALTH = f"""(WITH e AS (SELECT 'u' || user_id AS track, user_id, event_type, CAST(ts AS DATE) AS d FROM events), t AS (SELECT track, user_id, max(d) FILTER (user_id % 5 > 0) AS last, count(*) FILTER (event_type = 'error') AS errors FROM e GROUP BY ALL)
  SELECT '경고' AS level, '자료' AS kind, track, '마지막 영상 ' || strftime(last, '%Y%m%d') || ' 이후 ' || date_diff('day', last, DATE '{CHECKED}') || '일 동안 새 영상 없음 (재방문 12일)' AS msg FROM t WHERE date_diff('day', last, DATE '{CHECKED}') > 24 AND user_id % 4 > 0
  UNION ALL SELECT '주의', '자료', track, '내려받은 영상 없음' FROM t WHERE last IS NULL
  UNION ALL SELECT '주의', '자료', track, '다운로드 로그 오류 ' || errors || '건 (재시도 대상)' FROM t WHERE errors > 0
  UNION ALL SELECT '주의', '정합', track, 'stack_' || user_id % 3 || ': 정합 실패 날짜 ' || user_id % 6 || '개 (해당 날짜 제외됨)' FROM t WHERE user_id % 6 > 0
  UNION ALL SELECT '경고', '정합', track, 'stack_' || user_id % 3 || ': FATAL no orbit of ' || track FROM t WHERE user_id % 7 = 0
  UNION ALL SELECT '주의', '구역', track, CASE status WHEN 'FAIL_stamps' THEN 'StaMPS 실패' WHEN 'FAIL_no_reference_coh080' THEN '기준점 결맞음 미달' ELSE status END || ' 구역 ' || count(*) || '개 (' || status || ')'
    FROM (SELECT 't' || user_id % 3 AS track, ['OK', 'FAIL_stamps', 'FAIL_no_reference_coh080', ''][user_id % 4 + 1] AS status FROM t) WHERE status <> 'OK' GROUP BY track, status
  UNION ALL SELECT '정보', '보강', track, '2차 처리(Capon·APES·DS) 실패 교량 ' || count(*) || '개' FROM (SELECT 't' || user_id % 3 AS track FROM t WHERE errors > 12) GROUP BY track
  UNION ALL SELECT '경고', '저장공간', '', r_name || ' 여유 ' || (r_regionkey * 10 + 5) || ' GB' FROM region WHERE r_regionkey * 10 + 5 < 30)"""


def health(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    t = e.groupBy("user_id").agg(F.max(F.when(u % 5 > 0, F.to_date("ts"))).alias("last_date"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count("*").alias("n")).withColumn("text", F.concat(F.lit("begin\n"), F.expr("repeat('ERROR\n', int(errors))"), F.lit("end")))
    t = t.select("*", F.concat(F.lit("u"), u.cast("string")).alias("track"), F.concat(F.lit("t"), (u % 3).cast("string")).alias("group"), F.concat(F.lit("stack_"), (u % 3).cast("string")).alias("stack"))
    stacks = t.withColumn("text", F.concat(F.lit("begin\ndates failed coreg: "), (u % 6).cast("string"), F.lit(" of 9"), F.when(u % 7 == 0, F.concat(F.lit("\n   FATAL no orbit of "), "track", F.lit("  \nend"))).otherwise("")))
    status = F.element_at(F.array(*map(F.lit, ("OK", "FAIL_stamps", "FAIL_no_reference_coh080", None))), (u % 4 + 1).cast("int"))
    disks = table(spark, sf_dir, "region").select(F.col("r_name").alias("disk"), (F.col("r_regionkey") * 10.0 + 5).alias("gb"))
    events = [
        documents.scene_events(t.withColumn("end", F.when(u % 4 == 0, "20240101")), F.lit(CHECKED).cast("date")), documents.download_events(t), documents.stack_events(stacks), documents.tile_events(t.select(F.col("group").alias("track"), status.alias("status"))),
        documents.second_pass_events(t.select(F.col("group").alias("track"), (F.col("errors") > 12).alias("failed"))), documents.disk_events(disks),
    ]
    out = events[0]
    for x in events[1:]:
        out = out.unionByName(x)
    return out


@query(f"SELECT * FROM {_HEALTH}")
def health_check(spark, sf_dir):
    """All events of a health check: scenes, downloads, stacks, tiles, second passes, disks."""
    return health(spark, sf_dir)


@query(f"SELECT '{CHECKED}' AS checked, count(*) AS n, string_agg(track || '|' || msg, ';' ORDER BY level, kind, track, msg) AS events FROM {_HEALTH}")
def health_latest(spark, sf_dir):
    """The latest health document."""
    out = documents.health_document(health(spark, sf_dir), F.lit(CHECKED))
    return out.select("checked", F.size("events").cast("long").alias("n"), F.array_join(F.transform("events", lambda x: F.concat(x["track"], F.lit("|"), x["msg"])), ";").alias("events"))


def state(spark, sf_dir) -> DataFrame:
    tracks = by_track(spark, sf_dir).groupBy("bridge").agg(F.array_sort(F.collect_list(F.struct("track", "level", "n_ps", "proxy", "r_now"))).alias("tracks"))
    return documents.state(structures(spark, sf_dir), best(spark, sf_dir), tracks)


@query(f"SELECT bridge AS id, name AS n, city AS c, lat, lon, type AS t, cls, length AS len, year AS yr, grade AS gr, level AS lv, CASE WHEN level >= 0 THEN r_now END AS rn, CASE WHEN level >= 0 THEN review END AS rv FROM {_STRUCTURES} LEFT JOIN {_BEST} USING (bridge)")
def api_bridges(spark, sf_dir):
    """The list that the map reads."""
    return documents.api_bridges(state(spark, sf_dir))


@query(
    f"""SELECT id, CASE WHEN s.bridge IS NULL THEN 404 ELSE 200 END AS code, CASE WHEN s.bridge IS NULL THEN 'not found' END AS error, name, CAST(level AS VARCHAR) AS lv, CASE WHEN level < 0 THEN 'OSM 형상 없음' END AS why FROM (SELECT c_custkey * 3 AS id FROM customer) r LEFT JOIN {_STRUCTURES} s ON s.bridge = id LEFT JOIN {_BEST} b ON b.bridge = id"""
)
def api_bridge(spark, sf_dir):
    """Structures looked up by id: the whole record, or that there is none."""
    out = documents.responses(table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("id")), state(spark, sf_dir))
    read = lambda p: F.get_json_object("body", p)
    return out.select("id", "code", read("$.error").alias("error"), read("$.name").alias("name"), read("$.r.lv").alias("lv"), read("$.r.why").alias("why"))


@query(
    f"""WITH s AS (SELECT CASE WHEN level IS NULL THEN '미처리' WHEN level < 0 THEN '판정 불가' ELSE {_LABEL.format("level")} END AS status FROM {_STRUCTURES} LEFT JOIN {_BEST} USING (bridge)), c AS (SELECT status, count(*) AS k FROM s GROUP BY 1)
SELECT CAST(sum(k) AS BIGINT) AS n, string_agg(status || '=' || k, ',' ORDER BY status) AS counts, (SELECT count(*) FROM {_RECORDS}) AS n_alerts, (SELECT count(*) FROM {_HEALTH} WHERE level IN ('경고', '주의')) AS n_errors,
  (SELECT string_agg(track || ':' || n, ',' ORDER BY track) FROM (SELECT l_returnflag AS track, count(DISTINCT l_shipdate) AS n FROM lineitem GROUP BY 1)) AS tracks FROM c"""
)
def summary_document(spark, sf_dir):
    """The summary of a cycle, with its tracks."""
    tracks = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("track")).agg(F.count_distinct("l_shipdate").alias("n_dates"))
    out = documents.summary_document(state(spark, sf_dir), records(spark, sf_dir), health(spark, sf_dir), tracks)
    counts = F.array_join(F.transform(F.map_entries("counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")
    return out.select("n", counts.alias("counts"), "n_alerts", "n_errors", F.array_join(F.transform("tracks", lambda x: F.concat(x["track"], F.lit(":"), x["n_dates"].cast("string"))), ",").alias("tracks"))


@query(
    """SELECT o_orderkey AS bridge, CASE WHEN o_orderkey % 5 = 1 THEN 'StaMPS 처리 실패 (PS 부족)' WHEN o_orderkey % 5 = 2 THEN '기준점 결맞음 0.95 이상 PS 없음' WHEN o_orderkey % 3 = 0 THEN 'OSM 형상 없음' WHEN o_orderkey % 4 = 0 AND o_custkey % 2 > 0 THEN '교량 위·교대부 모두 산란체 없음'
  WHEN o_custkey % 3 > 0 AND o_custkey % 2 > 0 THEN '지점부·교대부 산란체 없음' END AS reason FROM orders"""
)
def failure_reasons(spark, sf_dir):
    """Why a structure is not judged, of all causes that hold the first."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    status = F.when(k % 5 == 1, "FAIL_stamps").when(k % 5 == 2, "FAIL_no_reference_coh080").otherwise("OK")
    return table(spark, sf_dir, "orders").select(k.alias("bridge"), documents.failure_reason(status, k % 3 > 0, k % 4, c % 3 == 0, c % 2 == 0).alias("reason"))


@query(
    f"""WITH v AS ({VELOCITY_SQL}), f AS ({regress.ols_sql(obs_sql(), "bridge", "y", ["1.0", "sin(t * 6.283185307179586)", "cos(t * 6.283185307179586)", "t"])}), s AS (SELECT bridge, stddev_pop(o.y - c_3 * o.t) AS stability FROM {obs_sql()} o JOIN f USING (bridge) GROUP BY bridge),
  p AS (SELECT s_suppkey AS bridge, s_nationkey AS tile, s_suppkey * 31 % 100 / 100 AS coh FROM supplier WHERE sqrt((s_suppkey * 7919 % 3000 - 1500) ** 2 + (s_suppkey * 104729 % 3000 - 1500) ** 2) <= 1200)
SELECT tile, count(*) AS n_points, round(median(coh), 4) AS coh_median, round(median(v), 4) AS vel_median, round(stddev_pop(v), 4) AS vel_std, round(median(stability), 4) AS stability_median FROM p JOIN v USING (bridge) JOIN s USING (bridge) GROUP BY tile"""
)
def chain_summary(spark, sf_dir):
    """Medians of each chain's points within a radius."""
    k = F.col("s_suppkey")
    p = table(spark, sf_dir, "supplier").select(k.alias("bridge"), F.col("s_nationkey").alias("tile"), (k * 7919 % 3000 - 1500).alias("x"), (k * 104729 % 3000 - 1500).alias("y"), (k * 31 % 100 / 100).alias("coh"))
    o = observations(spark, sf_dir)
    v = regress.velocity(o, ["bridge"], "y").where("n >= 12").select("bridge", "v").join(regress.stability(o, ["bridge"], "y"), "bridge")
    out = documents.chain_summary(documents.within(p, 1200.0).join(v, "bridge"), ["tile"])
    return out.select("tile", "n_points", *(F.round(c, 4).alias(c) for c in ("coh_median", "vel_median", "vel_std", "stability_median")))


@query(
    """WITH d AS (SELECT l_returnflag AS track, strftime(l_shipdate, '%Y%m') AS date, sqrt(avg(cos(l_quantity / 60)) ** 2 + avg(sin(l_quantity / 60)) ** 2) + 0.02 AS gamma FROM lineitem GROUP BY ALL), b AS (SELECT *, (CAST(date AS BIGINT) * 37) % 460 - 230 AS bperp FROM d)
SELECT track, coalesce(string_agg(date, ',' ORDER BY date) FILTER (abs(bperp) > 200), '') AS dropped_baseline, count(*) FILTER (gamma < 0.97) AS n_refcoh, coalesce(string_agg(date, ',' ORDER BY date) FILTER (gamma < 0.97), '') AS dropped_refcoh FROM b GROUP BY track"""
)
def qc_dropped_dates(spark, sf_dir):
    """Which dates of a stack go, and why."""
    from strataflux.operators import qc

    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("track"), F.date_format("l_shipdate", "yyyyMM").alias("date"), (F.col("l_quantity") / 60).alias("phase"))
    d = qc.date_coherence(li, ["track", "date"], "phase").withColumns({"gamma": F.col("gamma") + 0.02, "bperp": F.col("date").cast("long") * 37 % 460 - 230})
    out = documents.dropped_dates(d, ["track"], gmin=0.97)
    return out.select("track", F.array_join("dropped_baseline", ",").alias("dropped_baseline"), F.size("dropped_refcoh").cast("long").alias("n_refcoh"), F.array_join("dropped_refcoh.date", ",").alias("dropped_refcoh"))


_ZONES = "(SELECT s_nationkey AS tile, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS zone, s_suppkey % 90 - 45.0 AS zone_s, s_suppkey * 37 % 100 / 8 AS v FROM supplier)"


@query(
    f"""WITH b AS (SELECT *, abs(lead(v) OVER w - v) AS beta, lead(zone_s) OVER w AS to_s FROM {_ZONES} WINDOW w AS (PARTITION BY tile ORDER BY zone)), k AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY beta DESC, zone) AS k FROM b WHERE beta > 0)
SELECT t.tile, beta, zone_s AS from_s, to_s FROM (SELECT DISTINCT s_nationkey AS tile FROM supplier) t LEFT JOIN k ON k.tile = t.tile AND k.k = 1"""
)
def distortion_place(spark, sf_dir):
    """Between which zones the largest distortion is."""
    k, w = F.col("s_suppkey"), Window.partitionBy("tile").orderBy("zone")
    z = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("tile"), F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")).alias("zone"), (k % 90 - 45.0).alias("zone_s"), (k * 37 % 100 / 8).alias("v"))
    return documents.distortion_place(z.withColumn("beta", F.abs(F.lead("v").over(w) - F.col("v"))), ["tile"], "zone", "zone_s")


@query(
    f"""WITH f AS (SELECT bridge, n_ps, cover, level FROM {_BEST}), s AS (SELECT bridge, n_ps + 7 AS n_ps, 0.5 AS cover, CAST((level + 2) % 4 AS INT) AS level, 'APES ' || n_ps AS info FROM f WHERE bridge % 3 = 0)
SELECT f.bridge, coalesce(s.n_ps, f.n_ps) AS n_ps, coalesce(s.level, f.level) AS level, CASE WHEN s.bridge IS NOT NULL THEN f.n_ps END AS was_n_ps, CASE WHEN s.bridge IS NOT NULL THEN CASE WHEN f.level < 0 THEN '판정 불가' ELSE {_LABEL.format("f.level")} END END AS was_st, info FROM f LEFT JOIN s USING (bridge)"""
)
def merged_passes(spark, sf_dir):
    """Results of the first pass with those of the second in their places, and what the first said."""
    first = best(spark, sf_dir).select("bridge", "n_ps", "cover", "level")
    second = first.where("bridge % 3 = 0").select("bridge", (F.col("n_ps") + 7).alias("n_ps"), F.lit(0.5).alias("cover"), ((F.col("level") + 2) % 4).cast("int").alias("level"), F.concat(F.lit("APES "), F.col("n_ps").cast("string")).alias("info"))
    out = documents.merge_passes(first, second, ["bridge"])
    return out.select("bridge", "n_ps", "level", F.col("pass1.n_ps").alias("was_n_ps"), F.col("pass1.st").alias("was_st"), F.col("pass2.info").alias("info"))
