"""The functions of an operator of the monitoring, end to end on small tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from strataflux import monitor
from strataflux.operators import documents, registry
from test_streaming import OBS, monitor as store_of


def test_setup_finds_tiles_and_tracks(spark):
    cols = registry.COLUMNS
    row = lambda name, district, lat: {cols["name"]: name, cols["class_code"]: "2", cols["province"]: "강원도", cols["district"]: district, cols["lat1"]: str(lat), cols["lon1"]: "128.9", cols["lat2"]: None, cols["lon2"]: None, cols["length"]: "50"}
    names = [c for k, c in cols.items() if k in ("name", "class_code", "province", "district", "lat1", "lon1", "lat2", "lon2", "length")]
    rows = [row("A", "강릉시", 37.7), row("B", "강릉시", 37.701), row("C", "영월군", 37.1), row("D", "강릉시", 37.9)]
    extra = [c for c in cols.values() if c not in names]
    df = spark.createDataFrame([(k, *(r[c] for c in names), *(None for _ in extra)) for k, r in enumerate(rows)], "ordinal int, " + ", ".join(f"`{c}` string" for c in names + extra))
    day = lambda k: datetime.datetime(2020, 1, 1, 9, 30) + datetime.timedelta(days=12 * k)
    scenes = [(k, 128.0, 37.0, 129.5, 38.5, day(k), "ASCENDING", 54) for k in range(31)] + [(100 + k, 10.0, 10.0, 11.0, 11.0, day(k), "DESCENDING", 32) for k in range(40)]
    cat = spark.createDataFrame(scenes, "scene int, W double, S double, E double, N double, start_time timestamp, direction string, path int")
    got = monitor.setup(df, cat, "강원", "강릉시")
    assert {r["name"]: r["tile"] for r in got.structures.collect()}.keys() == {"A", "B", "D"} and got.tiles.count() == 2 and got.area.count() == 2
    tracks = got.tracks.collect()
    assert [(t["direction"], t["path"], t["n_dates"], str(t["reference_date"])) for t in tracks] == [("ASCENDING", 54, 31, str(day(15).date()))]


def test_update_report_and_status(spark, tmp_path):
    store = store_of(spark, f"{tmp_path}/m")
    spark.createDataFrame([("k", "t", 1, 1, 3.0, 1), ("k", "t", 2, 1, 1.0, 1)], OBS).coalesce(1).write.parquet(f"{tmp_path}/in/a")
    stream = lambda: spark.readStream.schema(OBS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    assert monitor.update(store, stream()) == {"cycles": 1, "last": 0} and monitor.update(store, stream()) == {"cycles": 0, "last": 0}
    structures = spark.createDataFrame([(k, f"N{k}", "c", 1.0, 2.0, "1종", "x", 50.0, 1990, "A", "o", "t") for k in (1, 2, 3)], "bridge int, name string, city string, lat double, lon double, cls string, type string, length double, year int, grade string, org string, tel string")
    best = store.judgements(0).select("bridge", "level", "track", *(F.lit(0.5).alias(c) for c in ("d_now", "d_10y", "r_now", "r_10y", "r_lo", "r_hi", "d_lo", "d_hi", "thermal_mm")), *(F.lit(False).alias(c) for c in ("uncertain", "review", "proxy", "gap")), *(F.lit(3).alias(c) for c in ("n_ps", "n_used", "n_expected", "max_gap_days", "stale_days")), F.lit("20200101").alias("last_date"))
    before = spark.createDataFrame([(1, 2)], "bridge int, level int")
    doc, lines = monitor.report(best, structures, before, F.lit("2020-01-01"))
    row = doc.head()
    assert (row["n_bridges"], row["n_judged"]) == (3, 2) and [(a["bridge"], a["kind"], a["prev_status"]) for a in row["alerts"]] == [(1, "등급 상승", "주의")]
    assert ["[등급 상승] N1" in r["text"] for r in lines.collect()] == [True]
    _, none = monitor.report(best.where("bridge = 2"), structures, before, F.lit("2020-01-01"))
    assert [r["text"] for r in none.collect()] == [documents.NOTHING]
    assert {r["status"]: (r["n"], r["worst"]) for r in monitor.status(structures, best).collect()} == {"경고": (1, 0.5), "관심": (1, 0.5), "미처리": (1, None)}
    disks = spark.createDataFrame([("d", 5.0), ("e", 50.0)], "disk string, gb double")
    events, latest = monitor.check(F.lit("2020-01-01"), documents.disk_events(disks), documents.disk_events(disks.limit(0)))
    assert events.count() == 1 and latest.head()["events"][0]["msg"] == "d 여유 5 GB"
