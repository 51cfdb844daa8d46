"""The composed judgement against numpy, and cases in which operators once differed from what they stand for."""

from __future__ import annotations

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflux import criteria
from strataflux.functions import regress
from strataflux.operators import deck, history, judge, kernels, qc, results, spatial, structures, timeline
from strataflux.sources import readers, search, sinks


def day(k: int) -> datetime.date:
    return datetime.date(2018, 1, 1) + datetime.timedelta(days=k)


def test_gaps_expect_a_scene_every_twelve_days(spark):
    df = spark.createDataFrame([("a", day(24 * k)) for k in range(40)] + [("b", day(12 * k)) for k in range(40)] + [("c", day(0))], "track string, date date")
    got = {r["track"]: r for r in timeline.gaps(df, ["track"], "date", F.lit("2020-01-01").cast("date")).collect()}
    assert got["a"]["coverage"] == pytest.approx(40 / (39 * 2 + 1)) and got["a"]["flag"] and got["a"]["n_expected"] == 79
    assert got["b"]["coverage"] == 1 and got["c"]["coverage"] == 1 and got["c"]["n_expected"] == 1


def test_previous_level_is_that_of_the_cycle_before(spark):
    h = spark.createDataFrame([("x", 1, 3), ("y", 1, 2), ("y", 2, 2), ("x", 3, 3), ("y", 3, 3)], "bridge string, cycle int, level int")
    got = {(r["bridge"], r["cycle"]): r["prev"] for r in results.previous(h, "bridge", "cycle", "level").collect()}
    assert got == {("x", 1): None, ("y", 1): None, ("y", 2): 2, ("x", 3): None, ("y", 3): 2}
    cycles = h.select("cycle").distinct()
    assert {r["bridge"]: r["prev"] for r in history.changes(h, cycles).collect()} == {"x": None, "y": 2}
    first, rows = history.append_cycle(cycles, h, F.lit("2026-01-01"), h.where("cycle = 3"))
    assert first.head()["cycle"] == 4 and {r["cycle"] for r in rows.collect()} == {4}


def test_baselines_keep_the_reference_and_prefer_straight_pairs(spark):
    pairs = spark.createDataFrame([("r", "m", 10.0), ("r", "s", 4.0), ("s", "r", 7.0), ("q", "r", 3.0)], "ref string, sec string, bperp double")
    keyed = pairs.withColumn("track", F.lit(1))
    got = {r["date"]: r["bperp"] for r in qc.rereference_baselines(keyed, ["track"], F.lit("m")).collect()}
    assert got == {"r": -10.0, "m": 0.0, "s": -6.0, "q": -13.0}


def test_indicators_take_significant_segments_first(spark):
    rows = [(1, 0, 5.0, None, 9.0, None, 4.0, 1.0), (1, 1, 3.0, None, 1.0, None, 4.0, 1.0), (2, 0, 3.0, 1.0, 1.0, 2.0, 4.0, None), (3, 0, 1.0, 1.0, 0.5, 0.5, 4.0, 1.0), (3, 2, 9.0, 5.0, 20.0, 9.0, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "bridge int, segment int, v double, acc double, v_thr double, acc_thr double, years double, sigma double")
    df = df.withColumns({"v_is_sig": F.abs("v") > F.col("v_thr"), "acc_is_sig": F.abs("acc") > F.col("acc_thr")})
    got = {r["bridge"]: r for r in judge.indicators(df, ["bridge"], "segment").collect()}
    assert (got[1]["V"], got[1]["lv_V"], got[1]["CUM"], got[1]["lv_CUM"]) == (3.0, 2, 12.0, 1)
    assert (got[1]["lv_ACC"], got[1]["DIFF"], got[1]["lv_DIFF"]) == (-1, 2.0, 0)
    assert (got[2]["DIFF"], got[2]["lv_DIFF"], got[2]["lv_ACC"]) == (None, -1, 0)
    assert (got[3]["DIFF"], got[3]["lv_DIFF"], got[3]["ACC"], got[3]["lv_ACC"]) == (0.0, 0, 1.0, 1)


def test_proxy_projects_the_distortion(spark):
    ends = spark.createDataFrame([(1, -1, 0.0, 0.1), (1, 1, 4.0, 0.1)], "bridge int, end int, v double, se double")
    ring = spark.createDataFrame([(1, 6, 0.2)], "bridge int, n_ring int, sigma double")
    r = judge.proxy(ends, ring, ["bridge"], F.lit(5.0), F.lit(0.5), (0.3, 0.5, 0.7)).head()
    assert r["r_now"] == pytest.approx(4 * 5 / 1000 / 0.002) and r["r_10y"] == pytest.approx(4 * 15 / 1000 / 0.002)


def test_deck_centre_is_mid_range(spark):
    v = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 10.0), (1, 0.0, 11.0), (1, 0.0, 100.0)], "bridge int, x double, y double")
    r = deck.axes(v, ["bridge"]).head()
    assert (r["y0"], r["extent_s"], round(r["ay"], 9)) == (50.0, 100.0, 1.0) and abs(r["x0"]) < 1e-9


def test_residuals_survive_a_large_offset(spark):
    r = np.random.default_rng(1)
    t = np.arange(60) / 12.0
    y = 1e8 + 3 * t + r.normal(size=60)
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(t, y)], "k int, t double, y double")
    got = regress.velocity(df, ["k"], "y").head()
    a = np.column_stack([np.ones(60), np.sin(2 * np.pi * t), np.cos(2 * np.pi * t), t])
    c = np.linalg.lstsq(a, y - 1e8, rcond=None)[0]
    res = y - 1e8 - a @ c
    assert got["v"] == pytest.approx(c[3], rel=1e-6) and got["se"] == pytest.approx(math.sqrt(res @ res / 56 * np.linalg.inv(a.T @ a)[3, 3]), rel=1e-6)
    assert regress.stability(df, ["k"], "y").head()["stability"] == pytest.approx(np.std(y - c[3] * t), rel=1e-6)


def fit(t: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a = np.column_stack([np.ones(len(t)), t, np.sin(2 * np.pi * t), np.cos(2 * np.pi * t)])
    c = np.linalg.lstsq(a, y, rcond=None)[0]
    return c[1], math.sqrt(np.sum((y - a @ c) ** 2) / (len(t) - 4) * np.linalg.inv(a.T @ a)[1, 1])


def test_judgement_equals_numpy(spark):
    """One deck of 60 m whose one half sinks, with a ring and temperatures, and one without a shape."""
    r = np.random.default_rng(3)
    n = 80
    t = np.arange(n) * 24 / 365.25
    dtemp = np.sin(2 * np.pi * t + 1) * 10 + r.normal(size=n)
    dtemp -= dtemp.mean()
    on = [(k, 0.0, float(s)) for k, s in enumerate(range(-30, 31, 5))]
    ring = [(100 + k, 80.0, float(s)) for k, s in enumerate(range(-40, 41, 8))]
    y = {k: -max(s, 0) / 10 * t + 0.2 * dtemp + r.normal(scale=0.3, size=n) for k, _, s in on} | {k: 0.1 * t + r.normal(scale=0.3, size=n) for k, _, _ in ring}
    obs = spark.createDataFrame([(1, k, day(24 * i), float(t[i]), float(v[i]), float(dtemp[i])) for k, v in y.items() for i in range(n)], "tile int, point int, date date, t double, y double, dtemp double")
    pts = spark.createDataFrame([(1, k, x, s, "PS") for k, x, s in on + ring], "tile int, point int, x double, y double, src string")
    decks = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0, 1.0, 60.0, 10.0, "1종", "PSCI거더교"), (1, 2, None, None, None, None, 60.0, 10.0, "1종", None)], "tile int, bridge int, x0 double, y0 double, ax double, ay double, len double, width double, cls string, type string")
    got = {x["bridge"]: x for x in structures.judge_structures(decks, pts, obs, F.lit(day(24 * n)).cast("date")).collect()}
    assert (got[2]["level"], got[2]["reason"]) == (-1, structures.NO_SHAPE)
    years = t[-1] - t[0]
    g = np.median([y[k] for k, _, _ in ring], axis=0)
    v = np.array([fit(t, y[k])[0] for k, _, _ in ring])
    sigma = 1.4826 * np.median(np.abs(v - np.median(v)))
    nodes = {}
    for s in np.arange(-30, 30.001, 3):
        near = [y[k] for k, _, p in on if abs(p - s) <= 3]
        if near:
            m = np.median(near, axis=0)
            c = np.linalg.lstsq(np.column_stack([np.ones(n), t, dtemp]), m, rcond=None)[0]
            nodes[s] = m - c[2] * dtemp
    zones = []
    for x in (-30, 0, 30):
        m = np.mean([z for s, z in nodes.items() if abs(s - x) <= 7.5], axis=0) - g
        vz, se = fit(t, m)
        zones.append((round(vz, 2), abs(vz) > max(2 * sigma, 2 * se), abs(vz) * years))
    d_now = max(round(d, 1) if sig else 0.0 for _, sig, d in zones)
    beta = max(abs(a[0] - b[0]) * years / 1000 / 30 for a, b in zip(zones, zones[1:]) if a[1] or b[1])
    assert got[1]["D_now"] == pytest.approx(d_now) and got[1]["beta_now"] == pytest.approx(beta)
    assert got[1]["r_now"] == pytest.approx(max(d_now / 25, beta / 0.002)) and got[1]["n_ps"] == len(on) and got[1]["n_ring"] == len(ring)
    assert 0.5 <= got[1]["r_now"] < 0.7 and got[1]["level"] == 3 and got[1]["conf"] == "높음" and got[1]["cover"] == len(nodes) / 21


def test_search_and_cells(spark):
    rows = [(k, 10.0 * k, 0.0, 10.0 * k + 5, 5.0, datetime.datetime(2020, 1, 1) + datetime.timedelta(days=12 * k), "ASCENDING", 54) for k in range(8)]
    cat = spark.createDataFrame(rows, "scene int, W double, S double, E double, N double, start_time timestamp, direction string, path int")
    area = spark.createDataFrame([(12.0, 1.0, 31.0, 2.0), (24.0, 1.0, 31.0, 2.0)], "W double, S double, E double, N double")
    assert sorted(r["scene"] for r in search.scenes(cat, area, "2020-01-01", "2020-01-25").collect()) == [1, 2]
    assert sorted(r["scene"] for r in search.scenes(cat, area, "2020-01-14").collect()) == [2, 3]
    t = search.tracks(cat, 3).head()
    assert (t["n_dates"], t["utc"], t["tag"]) == (8, "00:00", "")
    tries = spark.createDataFrame([(1, a, d) for a, d, n in [(0, "a", 5), (0, "b", 1), (1, "a", 2), (1, "b", 5), (1, "c", 1)] for _ in range(n)], "track int, attempt int, date string")
    assert sorted(r["date"] for r in search.available_dates(tries, ["track"]).collect()) == ["a", "b"]
    lat, lon = search.weather_cell(F.lit(37.125), F.lit(128.38))
    assert tuple(spark.range(1).select(lat, lon).head()) == (37.0, 128.5)


def test_sinks_replace_whole_tiles(spark, tmp_path):
    path, schema = f"{tmp_path}/res", "track string, tile string, bridge string, level int, r_now double"
    first = spark.createDataFrame([("a", "t1", "x", 1, 0.1), ("a", "t1", "y", 2, 0.5), ("a", "t2", "z", None, None)], schema)
    sinks.write_tile_results(first, path)
    sinks.write_tile_results(spark.createDataFrame([("a", "t1", "x", 3, 0.9)], schema), path)
    got = {(r["tile"], r["bridge"]): r["level"] for r in sinks.read_tile_results(spark, path, schema).collect()}
    assert got == {("t1", "x"): 3, ("t2", "z"): None}
    again = sinks.replace_structures(spark, path, schema, spark.createDataFrame([("a", "t2", "z", 0, 0.0)], schema))
    assert {(r["bridge"], r["level"], r["pass"]) for r in again.collect()} == {("x", 3, 1), ("z", 0, 2)}
    sinks.write_points(first.select("track", "tile", F.col("bridge").alias("point")), f"{tmp_path}/pts")
    assert sinks.read_points(spark, f"{tmp_path}/pts", "a", ["t1"]).count() == 2
    assert sinks.read_json(spark, f"{tmp_path}/none", "a int").count() == 0
    for _ in range(2):
        sinks.append_events(spark.createDataFrame([("경고", "disk")], "level string, kind string"), f"{tmp_path}/ev", "2026-01-01")
    assert spark.read.parquet(f"{tmp_path}/ev").count() == 1


def test_known_structures_and_labels(spark):
    reg = spark.createDataFrame([("r1", "A", 37.12341, 128.5), ("r2", "B", 37.2, 128.6)], "bridge string, name string, lat double, lon double")
    res = spark.createDataFrame([("r1", "A", 0.0, 0.0, 1), ("old", "B", 37.200004, 128.6, 2), ("gone", "C", 1.0, 1.0, 3)], "bridge string, name string, lat double, lon double, level int")
    assert {(r["bridge"], r["level"]) for r in history.known_structures(res, reg).collect()} == {("r1", 1), ("r2", 2)}
    assert spark.range(1).select(history.segment_label(F.lit(-30.0))).head()[0] == "교축 -30~-15 m 구간"
    a = spark.createDataFrame([("신규 경보", "A", 2, 10.5, 0.5, 0.7, 0.3, 0.8, True, True, 10, 20, 30, 40, 1.5)], "kind string, name string, level int, d_now double, r_now double, r_10y double, r_lo double, r_hi double, uncertain boolean, gap boolean, n_used int, n_expected int, max_gap_days int, stale_days int, thermal_mm double")
    line = history.alert_lines(a).head()["line"]
    assert "범위 30–80 %" in line and "최장 공백 30일" in line and "10년 예측 70 %" in line


def test_quantile_is_exact(spark):
    r = np.random.default_rng(5)
    for x in (r.normal(size=3000), np.repeat([1.0, 2.0], [900, 2100]), np.full(50, 3.0), r.integers(0, 5, 2000).astype(float)):
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        for share in (0.0, 0.12, 0.3, 0.5, 1.0):
            assert kernels.quantile(df, "x", share, hold=40, bins=8) == pytest.approx(np.quantile(x, share))
    assert kernels.quantile(df.limit(0), "x", 0.5) is None


def test_offset_falls_back_to_the_ground(spark):
    pairs = spark.createDataFrame([("a", float(k)) for k in range(5)] + [("b", 9.0)], "k string, diff double")
    second = spark.createDataFrame([(k, 4.0) for k in "abc" for _ in range(6)] + [("d", 1.0)], "k string, value double")
    first = spark.createDataFrame([("b", 1.0)] * 3 + [("c", 1.0)], "k string, value double")
    got = {r["k"]: (r["offset"], r["how"]) for r in spatial.aligned_offset(pairs, second, first, ["k"]).collect()}
    assert got == {"a": (2.0, "pairs"), "b": (3.0, "ground"), "c": (4.0, "ground"), "d": (None, None)}


def test_criteria_documents():
    c = criteria.from_document({"allowable": {"typical_span_m": {"x": 12, "default": 20}, "total_settlement_mm": 30}, "ratio_thresholds": {"1종": [1, 2, 3]}, "projection_years": 5}, {"projection_years": 7, "ground_ring_m": [10, 90]})
    assert (c.spans_m, c.span_default_m, c.settlement_mm, c.thresholds, c.projection_years, c.ring_m, c.min_cover) == ({"x": 12}, 20.0, 30, {"1종": (1, 2, 3)}, 7, (10, 90), 0.25)


def test_metadata_readers(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<i><property name="WIDTH"><value>120</value></property><property name="width">\n <value> 7 </value></property><property name="data_type"><doc>x</doc><value>FLOAT</value></property></i>')
    (tmp_path / "b.xml").write_text("<r><heading>-12.5</heading></r>")
    assert {r["name"]: r["value"] for r in readers.raster_properties(spark, f"{tmp_path}/a.xml").collect()} == {"width": "7", "data_type": "FLOAT"}
    assert {r["file"][-5:]: r["heading"] for r in readers.headings(spark, f"{tmp_path}/*.xml").collect()} == {"a.xml": -13.0, "b.xml": -12.5}


def test_linked_windows_equal_numpy(spark):
    r = np.random.default_rng(8)
    z = r.normal(size=(12, 10)) + 1j * r.normal(size=(12, 10))
    df = spark.createDataFrame([("w", k, [float(x) for x in v.real], [float(x) for x in v.imag]) for k, v in enumerate(z)], "window string, pixel int, re array<double>, im array<double>")
    got = {x["pixel"]: x for x in kernels.phase_link(df, "window", "pixel", least=3).collect()}
    amp, limit = np.abs(z), 1.36 * np.sqrt(2 / 10)
    for k in range(12):
        grid = np.unique(amp)
        cdf = np.array([[(a <= g).mean() for g in grid] for a in amp])
        like = np.abs(cdf - cdf[k]).max(1) <= limit
        assert (k in got) == (like.sum() >= 3)
        if k in got:
            phases, gamma = kernels.linked_phases(z[like])
            assert got[k]["n_shp"] == like.sum() and np.allclose(got[k]["phases"], phases, atol=1e-5) and got[k]["ds"] == (gamma >= 0.6)


def test_segments_end_before_the_deck_does(spark):
    """A deck of 60 m has four segments; the node at its very end belongs to none."""
    at = spark.createDataFrame([(float(s), 30.0) for s in range(-30, 31, 3)] + [(30.0, 31.0), (31.0, 31.0)], "s double, half double")
    got = [r[0] for r in at.select(deck.segment_of(F.col("s"), F.col("half"))).collect()]
    assert got[:20] == [k // 5 for k in range(20)] and got[20] is None and got[21:] == [4, 4]


def test_few_reference_points_change_nothing(spark):
    df = spark.createDataFrame([(p, d, v, p < 2) for p, d, v in [(0, 1, 5.0), (0, 2, 7.0), (1, 1, 1.0), (1, 2, 2.0), (3, 1, 3.0), (3, 2, None)]], "p int, d int, y double, near boolean")
    same = qc.rereference(df, [], "p", "d", "y", "near", F.lit(1))
    assert sorted(map(str, same.collect())) == sorted(map(str, df.collect()))
    got = {(r["p"], r["d"]): r["y"] for r in qc.rereference(df, [], "p", "d", "y", "near", F.lit(1), least=2).collect()}
    assert got == {(0, 1): 0.0, (0, 2): 0.5, (1, 1): 0.0, (1, 2): -0.5, (3, 1): 0.0, (3, 2): None}


def test_significance_is_told_before_rounding(spark):
    """A velocity that rounds to the limit but lies below it does not count."""
    ends = spark.createDataFrame([(1, -1, 0.3965, 0.199), (1, 1, 0.0, 0.199)], "bridge int, end int, v double, se double")
    ring = spark.createDataFrame([(1, 6, 0.1)], "bridge int, n_ring int, sigma double")
    assert judge.proxy(ends, ring, ["bridge"], F.lit(5.0), F.lit(30.0), (0.3, 0.5, 0.7)).head()["D_now"] == 0.0


def test_residual_scale_keeps_the_trend_of_the_thermal_fit(spark):
    r = np.random.default_rng(2)
    n = 40
    t = np.arange(n) / 12.0
    dtemp = np.cos(2 * np.pi * t) * 9 + r.normal(size=n)
    rows, raw, corr = [], [], []
    for node in range(5):
        y = r.normal(size=n) + 0.4 * t + 0.3 * dtemp
        c = np.linalg.lstsq(np.column_stack([np.ones(n), t, dtemp]), y, rcond=None)[0]
        yc = y - c[2] * dtemp
        raw.append(np.std(y - np.column_stack([np.ones(n), t]) @ c[:2]))
        two = np.column_stack([np.ones(n), t])
        corr.append(np.std(yc - two @ np.linalg.lstsq(two, yc, rcond=None)[0]))
        rows += [(1, node, float(a), float(b), float(d)) for a, b, d in zip(t, y, yc)]
    got = structures.residual_scale(spark.createDataFrame(rows, "bridge int, node int, t double, y double, yc double")).head()
    assert got["std_raw"] == pytest.approx(np.median(raw)) and got["std_corr"] == pytest.approx(np.median(corr))


def test_equal_names_take_the_last_id(spark):
    reg = spark.createDataFrame([("r1", "A", 37.1, 128.5), ("r3", "A", 37.1, 128.5), ("r2", "A", 37.1, 128.5)], "bridge string, name string, lat double, lon double")
    res = spark.createDataFrame([("old", "A", 37.1, 128.5, 1)], "bridge string, name string, lat double, lon double, level int")
    assert [r["bridge"] for r in history.known_structures(res, reg).collect()] == ["r3"]


def test_a_point_is_fitted_once_and_medians_meet_places(spark):
    """Three decks share 30 ring points at two places and 3 points on the decks: rows grow neither with decks nor with points that say the same."""
    n = 60
    r = np.random.default_rng(5)
    t = np.arange(n) * 24 / 365.25
    kinds = [np.round(a * t + r.normal(size=n), 3) for a in (1.0, -2.0, 0.5)]
    pts = [(1, k, 90.0 if k < 20 else 95.0, 0.0, "PS") for k in range(30)] + [(1, 100 + k, 0.0, 1.0, "PS") for k in range(3)]
    y = {p: kinds[p % 2 if p < 100 else p - 100] for _, p, *_ in pts}
    obs = spark.createDataFrame([(1, p, day(24 * i), float(t[i]), float(v[i]), 0.0) for p, v in y.items() for i in range(n)], "tile int, point int, date date, t double, y double, dtemp double")
    points = spark.createDataFrame(pts, "tile int, point int, x double, y double, src string")
    decks = spark.createDataFrame([(1, b, float(b), 0.0, 0.0, 1.0, 60.0, 10.0, "1종", None) for b in range(3)], "tile int, bridge int, x0 double, y0 double, ax double, ay double, len double, width double, cls string, type string")
    parts = structures.deck_parts(decks, points, obs)
    assert parts.fits.count() == len(pts)
    assert parts.values.count() == (2 * 2 + 3) * n and parts.values.agg(F.sum("n")).head()[0] == len(pts) * n
    ring = np.median([y[p] for p in range(30)], axis=0)
    got = {(x["bridge"], x["date"]): x["g"] for x in parts.ring_series.collect()}
    assert len(got) == 3 * n and all(got[b, day(24 * i)] == pytest.approx(ring[i]) for b in range(3) for i in range(n))
    node = np.median(kinds, axis=0)
    rows = parts.nodes.collect()
    assert {x["bridge"] for x in rows} == {0, 1, 2} and all(x["y"] == pytest.approx(node[round(x["t"] * 365.25 / 24)]) for x in rows)
    v = [fit(t, y[p])[0] for p in range(30)]
    for x in parts.surroundings.collect():
        assert x["n_ring"] == 30 and x["v_med"] == pytest.approx(np.median(v)) and x["v_sig"] == pytest.approx(1.4826 * np.median(np.abs(v - np.median(v))))
