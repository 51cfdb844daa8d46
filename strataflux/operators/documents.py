"""Documents and views of a cycle's results: alerts, health, state, look-ups, summaries.

The Korean texts are fixed output of the monitoring reports; they stand here together, as the reports must read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataflux.functions.expr import status_label
from strataflux.operators.history import gap_text
from strataflux.operators.results import alert_kind

# Texts of reports.
STATUS = ("정상", "관심", "주의", "경고")
KIND_ORDER = ("신규 경보", "등급 상승", "확인 필요", "지속")
STALE = "마지막 영상 %s 이후 %d일 동안 새 영상 없음 (재방문 12일)"
NO_SCENES = "내려받은 영상 없음"
LOG_ERRORS = "다운로드 로그 오류 %d건 (재시도 대상)"
FAILED_DATES = "%s: 정합 실패 날짜 %d개 (해당 날짜 제외됨)"
FATAL = "%s: %s"
FAILED_TILES = "%s 구역 %d개 (%s)"
STAMPS, REFERENCE = "StaMPS 실패", "기준점 결맞음 미달"
SECOND_PASS = "2차 처리(Capon·APES·DS) 실패 교량 %d개"
LOW_DISK = "%s 여유 %.0f GB"
REASONS = {"stamps": "StaMPS 처리 실패 (PS 부족)", "reference": "기준점 결맞음 0.95 이상 PS 없음", "shape": "OSM 형상 없음", "points": "교량 위·교대부 모두 산란체 없음", "zones": "지점부·교대부 산란체 없음"}
METHOD = "Capon·APES 재초점 (2배 오버샘플링) + DS 위상연결"
UNCERTAIN, THERMAL, PROXY, NOTHING = "오차 범위가 등급 경계를 넘음", "온도 보정 영향 %s mm (ERA5 기온)", " · 교대부 대체 판정", "이번 주기에 확인이 필요한 교량은 없습니다."

JUDGED = ["level", "track", "d_now", "d_10y", "r_now", "r_10y", "r_lo", "r_hi", "d_lo", "d_hi", "thermal_mm", "uncertain", "review", "proxy", "n_ps", "last_date", "n_used", "n_expected", "max_gap_days", "stale_days", "gap"]


def alert_records(best: DataFrame, structures: DataFrame, before: DataFrame) -> DataFrame:
    """A record for each structure of level 2 or more: its kind, what the register says of it, its judgement and the status before.

    best: bridge and :data:`JUDGED`; structures: bridge, name, city, lat, lon, cls, type, length, year, grade, org, tel; before: bridge, level.
    ``ord`` is the place of the kind; ties by falling ratio.
    """
    now = best.where(F.col("level") >= 2).join(before.select("bridge", F.col("level").alias("prev")), "bridge", "left").join(structures, "bridge")
    kind = alert_kind(F.col("level"), F.col("prev"), F.coalesce("review", F.lit(False)))
    out = now.withColumns({"kind": kind, "status": status_label(F.col("level")), "prev_status": F.when(F.col("prev") >= 0, status_label(F.col("prev")))})
    return out.withColumn("ord", F.array_position(F.array(*map(F.lit, KIND_ORDER)), F.col("kind")) - 1).drop("prev")


def alert_paragraphs(records: DataFrame) -> DataFrame:
    """Alert records with ``text``: what a paragraph of the report says, its doubts on a line of their own."""
    share = lambda c: F.bround(100 * F.coalesce(F.col(c), F.lit(0.0))).cast("int").cast("string")
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    band = F.when(F.col("r_lo").isNotNull(), F.concat(F.lit(" (범위 "), share("r_lo"), F.lit("–"), share("r_hi"), F.lit(" %)"))).otherwise("")
    doubts = F.concat_ws(
        " · ", F.when(F.col("uncertain"), UNCERTAIN), F.when(F.col("gap"), gap_text(F.col("n_used"), F.col("n_expected"), F.col("max_gap_days"), F.col("stale_days"))),
        F.when(F.col("thermal_mm") != 0, F.format_string(THERMAL, F.col("thermal_mm").cast("string"))),
    )
    facts = F.concat(
        F.lit("- **["), "kind", F.lit("] "), "name", F.lit("** ("), said("city"), F.lit(", "), said("cls"), F.lit(" "), said("type"), F.lit(", 연장 "), F.format_string("%.0f", F.bround("length")), F.lit(" m, "), said("year"),
        F.lit("년 준공, 안전점검 "), said("grade"), F.lit(") — "), "status", F.when(F.col("prev_status").isNotNull(), F.concat(F.lit(" (이전 "), "prev_status", F.lit(")"))).otherwise(""),
    )
    moved = F.concat(
        F.lit("\n  누적 수직변위 "), said("d_now"), F.lit(" mm, 허용변위 대비 "), share("r_now"), F.lit(" %"), band, F.lit(" (10년 예측 "), share("r_10y"), F.lit(" %), 관리기관 "), said("org"), F.lit(" "), said("tel"),
        F.when(F.col("proxy"), PROXY).otherwise(""),
    )
    return records.withColumn("text", F.concat(facts, moved, F.when(doubts != "", F.concat(F.lit("\n  불확실성: "), doubts)).otherwise("")))


def failure_reason(qc: Column, has_shape: Column, n_points: Column, has_zone: Column, has_ends: Column) -> Column:
    """Why a structure is not judged, the first cause that holds; null if it can be."""
    unjudged = ~has_zone & ~has_ends
    return (
        F.when(qc == "FAIL_stamps", REASONS["stamps"]).when(qc != "OK", REASONS["reference"]).when(~has_shape, REASONS["shape"])
        .when((n_points == 0) & ~has_ends, REASONS["points"]).when(unjudged, REASONS["zones"])
    )


def _event(df: DataFrame, level: str, kind: str, msg: Column, track: Column | None = None) -> DataFrame:
    return df.select(F.lit(level).alias("level"), F.lit(kind).alias("kind"), (F.col("track") if track is None else track).alias("track"), msg.alias("msg"))


def scene_events(tracks: DataFrame, as_of: Column, days: int = 24) -> DataFrame:
    """Tracks (track, last_date, end) without a scene, or without a new one for more than ``days``; one with an end expects none."""
    age = F.datediff(as_of, F.col("last_date"))
    late = tracks.where((age > days) & F.col("end").isNull())
    msg = F.format_string(STALE, F.date_format("last_date", "yyyyMMdd"), age)
    return _event(late, "경고", "자료", msg).unionByName(_event(tracks.where("last_date is null"), "주의", "자료", F.lit(NO_SCENES)))


def download_events(logs: DataFrame, tail: int = 200_000) -> DataFrame:
    """Errors in the tails of download logs (track, text)."""
    n = F.regexp_count(F.substring("text", -tail, tail), F.lit("Traceback|ERROR"))
    return _event(logs.withColumn("n", n).where("n > 0"), "주의", "자료", F.format_string(LOG_ERRORS, "n"))


def stack_events(logs: DataFrame) -> DataFrame:
    """What the logs of stacks (track, stack, text) say of dates that failed and of fatal ends: an event for each such line."""
    line = logs.select("track", "stack", F.explode(F.split("text", r"\r\n|[\n\r]")).alias("line"))
    n = F.regexp_extract("line", r"^dates failed coreg:\s*(\d+)", 1).try_cast("int")
    failed = line.withColumn("n", n).where("n > 0")
    fatal = line.where(F.col("line").contains("FATAL"))
    return _event(failed, "주의", "정합", F.format_string(FAILED_DATES, "stack", "n")).unionByName(_event(fatal, "경고", "정합", F.format_string(FATAL, "stack", F.substring(F.trim("line"), 1, 120))))


def tile_events(tiles: DataFrame) -> DataFrame:
    """Tiles (track, status) that failed, by status."""
    status = F.coalesce("status", F.lit(""))
    bad = tiles.where(status != "OK").groupBy("track", status.alias("status")).agg(F.count("*").alias("n"))
    name = F.when(F.col("status") == "FAIL_stamps", STAMPS).when(F.col("status").contains("reference"), REFERENCE).otherwise(F.col("status"))
    return _event(bad, "주의", "구역", F.format_string(FAILED_TILES, name, "n", "status"))


def second_pass_events(outcomes: DataFrame) -> DataFrame:
    """Structures whose second pass failed, by track, of (track, failed)."""
    bad = outcomes.where("failed").groupBy("track").agg(F.count("*").alias("n"))
    return _event(bad, "정보", "보강", F.format_string(SECOND_PASS, "n"))


def disk_events(disks: DataFrame, least_gb: float = 30.0) -> DataFrame:
    """Disks (disk, gb free) that are nearly full."""
    return _event(disks.where(F.col("gb") < least_gb), "경고", "저장공간", F.format_string(LOW_DISK, "disk", "gb"), F.lit(""))


def health_document(events: DataFrame, checked: Column) -> DataFrame:
    """One row: checked and the events of one check, in order. A check has an event for each track, stack and kind at most."""
    return events.agg(F.array_sort(F.collect_list(F.struct("level", "kind", "track", "msg"))).alias("events")).select(checked.alias("checked"), "events")


def state(structures: DataFrame, best: DataFrame, tracks: DataFrame) -> DataFrame:
    """A row for each structure with ``r``, the short form of its judgement, or null, and its tracks."""
    seen = F.col("level").isNotNull()
    sound = F.col("level") >= 0
    short = F.struct(
        F.col("level").alias("lv"), F.col("n_ps").alias("nps"), F.col("cover").alias("cov"), F.col("track").alias("trk"), F.when(~sound, F.col("reason")).alias("why"),
        *(F.when(sound, F.col(c)).alias(a) for c, a in (("conf", "conf"), ("r_now", "rn"), ("r_10y", "r10"), ("d_now", "dn"), ("d_10y", "d10"), ("review", "rv"))),
    )
    rows = structures.join(best, "bridge", "left").withColumn("r", F.when(seen, short))
    return rows.select(*structures.columns, "r").join(tracks, "bridge", "left")


def api_bridges(state: DataFrame) -> DataFrame:
    """The list that the map reads: place and kind of every structure, and lv, rn, rv of its judgement."""
    names = {"bridge": "id", "name": "n", "city": "c", "lat": "lat", "lon": "lon", "type": "t", "cls": "cls", "length": "len", "year": "yr", "grade": "gr"}
    return state.select(*(F.col(k).alias(v) for k, v in names.items()), F.col("r.lv").alias("lv"), F.col("r.rn").alias("rn"), F.col("r.rv").alias("rv"))


def responses(requests: DataFrame, state: DataFrame) -> DataFrame:
    """For each requested id: code 200 and the structure as JSON, or 404 and the error."""
    body = state.select("bridge", F.to_json(F.struct(*state.columns)).alias("body"))
    out = requests.select("id").join(body, F.col("id") == F.col("bridge"), "left")
    return out.select("id", F.when(F.col("body").isNull(), 404).otherwise(200).alias("code"), F.coalesce("body", F.lit('{"error":"not found"}')).alias("body"))


def alert_view(records: DataFrame, n_bridges: Column, n_judged: Column, made: Column) -> DataFrame:
    """One row: made, the counts, and the alerts in order. Alerts are what people read: few."""
    cols = [c for c in records.columns if c not in ("ord", "text")]
    order = F.struct("ord", (-F.coalesce("r_now", F.lit(0.0))).alias("r"), "bridge", F.struct(*cols).alias("a"))
    return records.agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["a"]).alias("alerts")).select(made.alias("made"), n_bridges.alias("n_bridges"), n_judged.alias("n_judged"), "alerts")


def summary_document(state: DataFrame, alerts: DataFrame, events: DataFrame, tracks: DataFrame) -> DataFrame:
    """One row: n, counts by status, n_alerts, n_errors (events of the two upper levels) and the tracks in order."""
    by = state.groupBy(status_label(F.col("r.lv")).alias("status")).agg(F.count("*").alias("k"))
    counts = by.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "k")))).alias("counts"))  # a row for each status
    named = tracks.agg(F.array_sort(F.collect_list(F.struct(*tracks.columns))).alias("tracks"))  # a row for each track
    return counts.crossJoin(alerts.agg(F.count("*").alias("n_alerts"))).crossJoin(events.agg(F.count_if(F.col("level").isin("경고", "주의")).alias("n_errors"))).crossJoin(named)  # one row each


def within(points: DataFrame, radius_m: float) -> DataFrame:
    """Points at most so far from the origin of their frame."""
    return points.where(F.hypot("x", "y") <= radius_m)


def chain_summary(points: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_points, and medians of coherence, velocity and stability, and the velocities' deviation."""
    return points.groupBy(*keys).agg(
        F.count("*").alias("n_points"), F.median("coh").alias("coh_median"), F.median("v").alias("vel_median"), F.stddev_pop("v").alias("vel_std"), F.median("stability").alias("stability_median"),
    )


def dropped_dates(dates: DataFrame, keys: list[str], bmax: float = 200.0, gmin: float | Column = 0.95) -> DataFrame:
    """keys, dropped_baseline and dropped_refcoh: in order, the dates beyond the baseline limit, and those (with gamma) below the coherence limit. A stack has some hundred dates."""
    far, loose = F.abs(F.coalesce(F.col("bperp"), F.lit(0.0))) > bmax, F.col("gamma") < gmin
    return dates.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(far, F.col("date")))).alias("dropped_baseline"), F.array_sort(F.collect_list(F.when(loose, F.struct("date", F.round("gamma", 3).alias("gamma"))))).alias("dropped_refcoh")
    )


def distortion_place(zones: DataFrame, keys: list[str], zone: str, place: str, beta: str = "beta") -> DataFrame:
    """keys and where the largest distortion is: it, and the places of its two zones (nulls if there is none above 0); the first of equal ones."""
    # beta stands at the lower zone; the next one is joined by its number.
    top = zones.where(F.col(beta) > 0).groupBy(*keys).agg(F.max(F.struct(F.col(beta).alias("b"), (-F.col(zone)).alias("z"), F.col(place).alias("s"))).alias("m"))
    top = top.select(*keys, F.col("m.b").alias("beta"), F.col("m.s").alias("from_s"), (1 - F.col("m.z")).alias(zone))
    found = top.join(zones.select(*keys, zone, F.col(place).alias("to_s")), [*keys, zone], "left").drop(zone)
    return zones.select(*keys).distinct().join(found, keys, "left")


def merge_passes(first: DataFrame, second: DataFrame, keys: list[str], audit: tuple[str, ...] = ("n_ps", "cover", "level")) -> DataFrame:
    """Records of the first pass in which those of the second take the place of their own, with pass1 (what the first said) and pass2 (how the second was made); others have neither."""
    was = F.struct(*(F.col(c) for c in audit), status_label(F.col("level")).alias("st"))
    before = first.select(*keys, was.alias("pass1"))
    anew = second.join(before, keys).withColumn("pass2", F.struct(F.lit(METHOD).alias("method"), F.col("info").alias("info"))).drop("info")
    rest = first.join(second.select(*keys), keys, "left_anti")
    return rest.unionByName(anew, allowMissingColumns=True)
