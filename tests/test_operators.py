from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflux.functions import expr, regress
from strataflux.operators import deck, judge, kernels, qc, registry, results, spatial, timeline


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def structures(spark, tmp_path_factory):
    from strataflux.sources.readers import registry_csv

    path = tmp_path_factory.mktemp("r") / "r.csv"
    names = list(registry.COLUMNS.values())
    lines = [
        {"교량명": "내곡교", "시설물종별등급구분": "2", "시도명": "강원특별자치도", "시군구명": "강릉시", "교량시작점위도": "37.7467", "교량시작점경도": "128.8878", "교량종료점위도": "37.7481", "교량종료점경도": "128.8873", "교량연장": "162", "교량폭": "25", "상부구조형식": "RC슬래브교"},
        {"교량명": "각동교", "시설물종별등급구분": "3", "시도명": "강원특별자치도", "시군구명": "영월군", "교량시작점위도": "37.121", "교량시작점경도": "128.539", "교량종료점위도": "37.1215", "교량종료점경도": "128.541", "교량연장": "210"},
    ]
    path.write_text("﻿" + "\n".join([",".join(names), *(",".join(x.get(n, "") for n in names) for x in lines)]), encoding="utf-8")
    return registry_csv(spark, str(path))


def test_registry_and_tiles(structures):
    one = registry.structures(structures, "강원", "강릉시").collect()
    assert len(one) == 1 and one[0]["class"] == "2종" and one[0]["kind"] == "RC슬래브교" and one[0]["id"] == "r00000"
    tiles, of = registry.tiles(registry.structures(structures, "강원"))
    assert tiles.count() == 2 and of.count() == 2
    assert all(t["N"] - t["S"] >= 1600 / 111320 * 0.99 for t in tiles.collect())


def test_reference_date_and_periods(spark):
    d = spark.createDataFrame([(x,) for x in ("20180101", "20200101", "20220101", "20240101", "20260101")], "s string").select(F.to_date("s", "yyyyMMdd").alias("date"))
    assert str(timeline.reference_date(d, []).head()[0]) == "2022-01-01"
    p = spark.createDataFrame([(1, x) for x in ("20180601", "20190101", "20211201", "20220909", "20250301", "20260101")], "k int, s string").select("k", F.to_date("s", "yyyyMMdd").alias("date"))
    starts = timeline.periods(p, ["k"]).groupBy("period").agg(F.min("date").alias("d"))
    assert [str(r[1]) for r in rows(starts, "period", "d")] == ["2018-06-01", "2021-12-01", "2025-03-01"]


def test_velocity_is_least_squares(spark):
    rng = np.random.default_rng(1)
    t = np.sort(rng.uniform(-3, 3, 60))
    y = 2 + 1.5 * t + 3 * np.sin(2 * np.pi * t) + rng.normal(0, 0.3, 60)
    a = np.c_[np.ones(60), t, np.sin(2 * np.pi * t), np.cos(2 * np.pi * t)]
    c, r, *_ = np.linalg.lstsq(a, y, rcond=None)
    df = spark.createDataFrame([(1, float(p), float(q)) for p, q in zip(t, y)] + [(1, 0.5, None), (2, 0.0, 1.0)], "k int, t double, y double")
    got = {x["k"]: x for x in regress.velocity(df, ["k"], "y").collect()}
    assert got[1]["v"] == pytest.approx(c[1], abs=1e-9) and got[2]["v"] is None
    assert got[1]["se"] == pytest.approx(np.sqrt(r[0] / 56 * np.linalg.inv(a.T @ a)[1, 1]), rel=1e-6)
    assert got[1]["amplitude"] == pytest.approx(np.hypot(c[2], c[3]), abs=1e-9)


def test_radius_joins_equal_theta_joins(spark):
    rng = np.random.default_rng(2)
    a, b = rng.uniform(0, 500, (120, 2)), rng.uniform(0, 500, (90, 2))
    d = np.hypot(*(a[:, None] - b[None]).transpose(2, 0, 1))
    make = lambda x: spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(x)], "id int, x double, y double")
    assert rows(spatial.radius_join(make(a), make(b), 50.0), "id", "id_b") == sorted(zip(*map(list, np.nonzero(d <= 50)), strict=True))
    assert [r[0] for r in rows(spatial.avoid(make(a), make(b), 50.0), "id")] == list(np.flatnonzero((d >= 50).all(1)))
    near = {r["id"]: r["near_id"] for r in spatial.nearest_within(make(a), make(b), 40.0, "id", "id").collect()}
    assert near == {i: int(d[i].argmin()) for i in range(120) if d[i].min() <= 40}


def test_radius_join_plans_no_nested_loop(spark):
    p = spark.range(10).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    plan = spatial.radius_join(p, p, 2.0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan.split("== Physical Plan ==")[1]


def test_equal_means_tie_whatever_the_order_of_their_sums(spark):
    """Two clusters of the same coherences in opposite orders, whose sums differ in the last digit: the smaller id is the centre."""
    for order in ((0.1, 0.2, 0.3), (0.3, 0.2, 0.1)):
        coh = order + order[::-1]
        p = spark.createDataFrame([(1, i, 1000.0 * (i // 3) + i, 0.0, c) for i, c in enumerate(coh)], "tile int, id int, x double, y double, coh double").coalesce(1)
        got = spatial.densest_cluster(p, 50.0, "id", "coh", ["tile"]).head()
        assert (got["centre"], got["n_cluster"]) == (0, 3) and got["coh_mean"] == pytest.approx(0.2)


def test_copies_at_one_place_make_no_pairs(spark, monkeypatch):
    """300 rows at each of two places: joins by distance work on the places, and results count every row."""
    p = spark.range(600).select(F.lit(1).alias("tile"), F.col("id"), (F.col("id") % 2 * 30.0).alias("x"), F.lit(0.0).alias("y"), (F.col("id") % 10 / 10).alias("coh"))
    made, join = [], spatial.radius_join
    monkeypatch.setattr(spatial, "radius_join", lambda *a, **k: made.append(join(*a, **k)) or made[-1])
    best = spatial.densest_cluster(p, 50.0, "id", "coh", ["tile"]).head()
    assert (best["centre"], best["n_cluster"]) == (0, 600) and best["coh_mean"] == pytest.approx(0.45)
    near = spatial.nearest_within(p, p.withColumn("id", F.col("id") + 7), 10.0, "id", "id").collect()
    assert sorted((r["id"], r["near_id"]) for r in near) == [(k, 7 + k % 2) for k in range(600)]
    assert [df.count() for df in made] == [4, 600]
    assert spatial.avoid(p, p, 10.0).count() == 0 and "Aggregate" in made[-1]._jdf.queryExecution().optimizedPlan().toString()


def test_level_rises_one_step_at_most(spark):
    df = spark.createDataFrame([(a / 10, b / 10) for a in range(12) for b in range(12)], "a double, b double")
    th = (0.3, 0.5, 0.7)
    for r in df.select(expr.grade(F.col("a"), th).alias("n"), expr.level(F.col("a"), F.col("b"), th).alias("l")).collect():
        assert r["n"] <= r["l"] <= r["n"] + 1


def test_band_is_ordered_and_distortion_needs_neighbours(spark):
    z = spark.createDataFrame([(1, 0, 2.0, 0.2, True), (1, 1, -1.0, 0.2, False), (1, 3, 5.0, 0.1, True)], "k int, zone int, v double, sv double, sig boolean").withColumn("dT", F.lit(0.0))
    b = judge.band(z, ["k"], "zone", F.lit(5.0), F.lit(20.0), F.lit(0.002)).head()
    assert b["r_lo"] <= b["r_hi"]
    beta = {r["zone"]: r["beta"] for r in judge.distortion(z, ["k"], "zone", F.lit(5.0), F.lit(20.0)).collect()}
    assert beta[0] == pytest.approx(3 * 5 / 1000 / 20) and beta[1] is None and beta[3] is None


def test_nodes_and_supports(spark):
    p = spark.createDataFrame([(0.0,), (-30.0,), (31.0,)], "s double")
    n = rows(deck.nodes_of(p, "s", F.lit(30.0)), "s", "node")
    assert [k for s, k in n if s == 0.0] == [9, 10, 11] and [k for s, k in n if s == -30.0] == [0, 1] and [k for s, k in n if s == 31.0] == [20]
    z = deck.supports(spark.createDataFrame([(10.0, 25.0), (30.0, 20.0)], "half double, span double"), F.col("half"), F.col("span"))
    assert rows(z, "half", "zone_s") == [(10.0, -10.0), (10.0, 10.0), (30.0, -30.0), (30.0, -10.0), (30.0, 10.0), (30.0, 30.0)]


def test_axis_points_north(spark):
    v = spark.createDataFrame([(1, 0.0, 0.0), (1, 10.0, -10.0)], "k int, x double, y double")
    a = deck.axes(v, ["k"]).head()
    assert a["ay"] == pytest.approx(2**-0.5) and a["ax"] == pytest.approx(-(2**-0.5)) and a["bearing"] == pytest.approx(135.0)


def test_keep_dates_and_rereference(spark):
    d = spark.createDataFrame([(1, "a", 250.0, 0.99), (1, "b", None, 0.96), (1, "c", 10.0, 0.5)], "k int, date string, bperp double, gamma double")
    kept = qc.keep_dates(d, ["k"], F.lit("c"))
    assert rows(kept, "date", "master") == [("b", "c"), ("c", "c")]
    assert rows(qc.keep_dates(d, ["k"], F.lit("x")), "date", "master") == [("b", "b")]


def test_alert_kinds_and_history(spark):
    df = spark.createDataFrame([(2, None, False), (2, 1, False), (3, 2, False), (2, 3, False), (2, 2, True)], "l int, p int, r boolean")
    kinds = [r[0] for r in df.select(results.alert_kind(F.col("l"), F.col("p"), F.col("r"))).collect()]
    assert kinds == ["신규 경보", "신규 경보", "등급 상승", "지속", "확인 필요"]
    old = spark.createDataFrame([(1, "d", 1.0, 1), (2, "d", 5.0, 1)], "b int, date string, v double, cycle int")
    new = spark.createDataFrame([(1, "d", 2.0, 2)], old.schema)
    assert rows(results.upsert(old, new, ["b", "date"], "cycle"), "b", "v") == [(1, 2.0), (2, 5.0)]
    assert rows(results.replace_keys(old, new, ["b"]), "b", "v") == [(1, 2.0), (2, 5.0)]
    assert results.fill_axis(old, ["b"], "date", "v").count() == 2


def test_kernels():
    x = np.exp(2j * np.pi * np.arange(32) * 5 / 32)
    assert np.abs(kernels.capon(x, 10, 64)).argmax() == 10
    rng = np.random.default_rng(0)
    truth = np.angle(np.exp(1j * rng.uniform(-3, 3, 8)))
    z = np.exp(1j * truth) * np.exp(1j * rng.uniform(-3, 3, (60, 1))) * rng.uniform(0.5, 1, (60, 1)) + 0.01 * rng.normal(size=(60, 8))
    phase, gamma = kernels.linked_phases(z)
    assert gamma > 0.99 and np.abs(np.angle(np.exp(1j * (phase - (truth - truth[0]))))).max() < 0.05
    assert kernels.longest_run(np.array([1, 1, 0, 1, 1, 1, 0], bool)) == (3, 3)
    assert kernels.bilinear(np.array([[0.0, 2], [4, 6]]), 3, 3)[1, 1] == 3
