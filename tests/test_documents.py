"""Documents and views in cases that the tables do not have."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from strataflux.operators import documents, structures
from test_structures import day


def test_stack_logs_give_an_event_a_line(spark):
    text = "begin\ndates failed coreg: 3 of 90\nx dates failed coreg: 5\ndates failed coreg: 0\n  FATAL " + "y" * 200 + "  \nFATAL b"
    got = sorted((r["level"], r["msg"]) for r in documents.stack_events(spark.createDataFrame([("a", "s", text), ("a", "q", None)], "track string, stack string, text string")).collect())
    assert got == [("경고", "s: FATAL b"), ("경고", "s: FATAL " + "y" * 114), ("주의", "s: 정합 실패 날짜 3개 (해당 날짜 제외됨)")]


def test_scenes_late_missing_and_ended(spark):
    rows = [("a", datetime.date(2024, 1, 1), None), ("b", datetime.date(2024, 1, 1), "20240101"), ("c", None, None), ("d", datetime.date(2024, 1, 8), None)]
    got = {r["track"]: r["msg"] for r in documents.scene_events(spark.createDataFrame(rows, "track string, last_date date, end string"), F.lit("2024-02-01").cast("date")).collect()}
    assert got == {"a": "마지막 영상 20240101 이후 31일 동안 새 영상 없음 (재방문 12일)", "c": "내려받은 영상 없음"}


def test_reasons_in_order(spark):
    rows = [("FAIL_stamps", False, 0, False, False), ("FAIL_x", True, 3, True, True), ("OK", False, 0, False, True), ("OK", True, 0, False, False), ("OK", True, 2, False, False), ("OK", True, 0, False, True), ("OK", True, 2, True, False)]
    df = spark.createDataFrame(rows, "qc string, shape boolean, n int, zone boolean, ends boolean")
    got = [r[0] for r in df.select(documents.failure_reason(F.col("qc"), F.col("shape"), F.col("n"), F.col("zone"), F.col("ends"))).collect()]
    r = documents.REASONS
    assert got == [r["stamps"], r["reference"], r["shape"], r["points"], r["zones"], None, None]


def test_empty_views(spark):
    s = spark.createDataFrame([("a", "A", "c", 1.0, 2.0, "1종", None, 5.0, 1990, "A", "o", "t")], "bridge string, name string, city string, lat double, lon double, cls string, type string, length double, year int, grade string, org string, tel string")
    best = spark.createDataFrame([], "bridge string, track string, level int, n_ps int, cover double, reason string, conf string, r_now double, r_10y double, d_now double, review boolean, d_10y double")
    tracks = spark.createDataFrame([], "bridge string, tracks array<string>")
    state = documents.state(s, best, tracks)
    row = documents.api_bridges(state).head()
    assert (row["id"], row["lv"], row["rn"], row["rv"]) == ("a", None, None, None)
    got = {r["id"]: (r["code"], r["body"]) for r in documents.responses(spark.createDataFrame([("a",), ("z",), (None,)], "id string"), state).collect()}
    assert got["a"][0] == 200 and '"name":"A"' in got["a"][1] and got["z"] == (404, '{"error":"not found"}') and got[None][0] == 404
    events = spark.createDataFrame([], "level string, kind string, track string, msg string")
    assert documents.health_document(events, F.lit("x")).head()["events"] == []
    out = documents.summary_document(state, best, events, spark.createDataFrame([], "track string")).head()
    assert (out["n"], out["counts"], out["n_alerts"], out["n_errors"], out["tracks"]) == (1, {"미처리": 1}, 0, 0, [])


def test_failed_tiles_are_not_judged(spark):
    decks = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0, 1.0, 60.0, 10.0, "1종", None), (2, 2, 0.0, 0.0, 0.0, 1.0, 60.0, 10.0, "1종", None)], "tile int, bridge int, x0 double, y0 double, ax double, ay double, len double, width double, cls string, type string")
    points = spark.createDataFrame([(1, 1, 900.0, 900.0, "PS")], "tile int, point int, x double, y double, src string")
    obs = spark.createDataFrame([(1, 1, day(12 * k), k / 30.0, 0.0, 0.0) for k in range(20)], "tile int, point int, date date, t double, y double, dtemp double")
    qc = spark.createDataFrame([(1, "OK"), (2, "FAIL_no_reference_coh080")], "tile int, status string")
    got = {r["bridge"]: (r["level"], r["reason"]) for r in structures.judge_structures(decks, points, obs, F.lit(day(400)).cast("date"), qc=qc).collect()}
    assert got == {1: (-1, documents.REASONS["points"]), 2: (-1, documents.REASONS["reference"])}


def test_second_pass_keeps_what_the_first_said(spark):
    first = spark.createDataFrame([(1, 3, 0.1, 2), (2, 9, 0.9, 0)], "bridge int, n_ps int, cover double, level int")
    second = spark.createDataFrame([(1, 12, 0.6, 1, "ok"), (3, 1, 0.1, 0, "not there")], "bridge int, n_ps int, cover double, level int, info string")
    got = {r["bridge"]: r for r in documents.merge_passes(first, second, ["bridge"]).collect()}
    assert got.keys() == {1, 2} and (got[1]["n_ps"], got[1]["pass1"]["n_ps"], got[1]["pass1"]["st"], got[1]["pass2"]["info"]) == (12, 3, "주의", "ok") and got[2]["pass1"] is None
