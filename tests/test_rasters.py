"""Binary rasters read by ranges and written in order, against numpy's own files."""

from __future__ import annotations

import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflux.sources import rasters, readers


def grid(rows, width, dtype="<f4"):
    z = np.zeros((rows[-1]["row"] + 1, width), complex)
    for r in rows:
        z[r["row"]] = np.array(r["re"]) + (1j * np.array(r["im"]) if r["im"] is not None else 0)
    return z if np.dtype(dtype).kind == "c" else z.real


@pytest.mark.parametrize("interleave", ["pixel", "line", "band"])
def test_byte_ranges_of_one_file(spark, tmp_path, interleave):
    r = np.random.default_rng(1)
    cube = r.normal(size=(37, 5, 3)).astype("<f8")  # rows, columns, bands
    shaped = {"pixel": cube, "line": cube.transpose(0, 2, 1), "band": cube.transpose(2, 0, 1)}[interleave]
    shaped.tofile(f"{tmp_path}/a.rdr")
    df = rasters.read_raster(spark, f"{tmp_path}/a.rdr", 5, "<f8", 3, interleave, split=5 * 8 * 3 * 4)
    assert df.rdd.getNumPartitions() >= 9  # many tasks read one file
    for b in range(3):
        got = grid(df.where(F.col("band") == b).orderBy("row").collect(), 5)
        assert np.array_equal(got, cube[:, :, b])


def test_ragged_files_are_an_error(spark, tmp_path):
    np.zeros(7, "<f4").tofile(f"{tmp_path}/a.rdr")
    with pytest.raises(Exception, match="whole rows"):
        rasters.read_raster(spark, f"{tmp_path}/a.rdr", 3).count()


def joined(path):
    """The bytes of each raster of a folder, by its manifest."""
    (m,) = glob.glob(f"{path}/_raster-*.json")
    out = {}
    for of, name, size in json.load(open(m))["parts"]:
        data = open(f"{path}/{name}", "rb").read()
        assert len(data) == size
        out[of] = out.get(of, b"") + data
    return out


def test_ordered_rows_are_the_bytes_of_one_writer(spark, tmp_path):
    r = np.random.default_rng(2)
    z = (r.normal(size=(2, 50, 7)) + 1j * r.normal(size=(2, 50, 7))).astype("<c8")
    rows = [(f"d{k}", y, [float(v) for v in z[k, y].real], [float(v) for v in z[k, y].imag]) for k in range(2) for y in range(50)]
    r.shuffle(rows)
    df = spark.createDataFrame([tuple(x) for x in rows], "part_of string, row int, re array<double>, im array<double>").withColumn("row", F.col("row").cast("int")).repartition(5)
    path = f"{tmp_path}/out"
    for _ in range(2):  # the second replaces the first
        rasters.write_ordered(df, ["row"], path, "<c8")
        assert joined(path) == {f"d{k}": z[k].tobytes() for k in range(2)}
    back = rasters.read_raster(spark, path, 7, "<c8", split=200)
    for k in range(2):
        assert np.array_equal(grid(back.where(F.col("file").endswith(f"d{k}")).orderBy("row").collect(), 7, "<c8").astype("<c8"), z[k])
    real = spark.createDataFrame([(k, [float(k), -1.0]) for k in range(31)], "k int, re array<double>").repartition(3)
    rasters.write_ordered(real, ["k"], f"{tmp_path}/real")
    assert joined(f"{tmp_path}/real")[""] == np.array([[k, -1] for k in range(31)], "<f4").tobytes()


def test_failed_jobs_leave_nothing(spark, tmp_path):
    fail = F.udf(lambda k: [1.0 / (k - 20)], "array<double>")
    df = spark.range(0, 40, 1, 4).select(fail("id").alias("re"))
    spark.dataSource.register(rasters.RasterSource)
    with pytest.raises(Exception, match="division"):
        df.write.format("flat_raster").mode("overwrite").save(f"{tmp_path}/out")
    assert not [n for n in os.listdir(f"{tmp_path}/out") if not n.startswith("_part-")]
    assert rasters.read_raster(spark, f"{tmp_path}/out", 1).count() == 0


def test_layout_and_incidence(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<i>" + "".join(f'<property name="{k}"><value>{v}</value></property>' for k, v in (("width", 4), ("length", 3), ("data_type", "double"), ("number_bands", 2))) + "</i>")
    (tmp_path / "y.xml").write_text('<i><property name="width"><value>9</value></property></i>')
    got = {r["file"][-5:]: (r["width"], r["length"], r["dtype"], r["bands"]) for r in rasters.layout(readers.raster_properties(spark, f"{tmp_path}/*.xml")).collect()}
    assert got == {"x.xml": (4, 3, "<f8", 2), "y.xml": (9, 0, "<f4", 1)}
    inc, az = np.full((6, 5), 38.5, "<f4"), np.full((6, 5), -100.0, "<f4")
    np.stack([inc, az], axis=2).tofile(f"{tmp_path}/bip")
    np.stack([inc, az]).tofile(f"{tmp_path}/bsq")
    inc.astype("<f8").tofile(f"{tmp_path}/one")
    np.zeros(7, "<f4").tofile(f"{tmp_path}/odd")
    for name, dtype, value in (("bip", None, 38.5), ("bsq", None, 38.5), ("one", "<f8", 38.5), ("odd", None, 39.0)):
        rows = rasters.incidence(spark, f"{tmp_path}/{name}", 5, 6, dtype, split=40).collect()
        assert len(rows) == 6 and {x for r in rows for x in r["re"]} == {value}, name


def test_candidate_inputs(spark, tmp_path):
    r = np.random.default_rng(3)
    n, d = 40, 3

    ph = (r.normal(size=(n, d)) + 1j * r.normal(size=(n, d))).astype("<c8")
    order = [int(k) for k in r.permutation(n)]
    rows = [(k // 8, k % 8, 128 + k / 7, 37 + k / 9, float(k), k / 100, [float(v) for v in ph[k].real], [float(v) for v in ph[k].imag]) for k in order]
    df = spark.createDataFrame(rows, "row int, col int, lon double, lat double, height double, da double, re array<double>, im array<double>").repartition(3)
    rasters.candidate_inputs(df, f"{tmp_path}/p")
    text = lambda name: "".join(open(f).read() for f in sorted(glob.glob(f"{tmp_path}/p/{name}/part-*"))).split("\n")[:-1]
    assert text("pscands.1.ij") == [f"{k + 1} {k // 8} {k % 8}" for k in range(n)] and text("pscands.1.da") == [f"{k / 100:.6f}" for k in range(n)]
    assert joined(f"{tmp_path}/p/pscands.1.ll")[""] == np.array([[128 + k / 7, 37 + k / 9] for k in range(n)], "<f4").tobytes()
    assert joined(f"{tmp_path}/p/pscands.1.hgt")[""] == np.arange(n, dtype="<f4").tobytes()
    assert joined(f"{tmp_path}/p/pscands.1.ph")[""] == ph.T.tobytes()


def test_numbers_do_not_depend_on_drawn_bounds(spark):
    """Ranges of more rows than their bounds are drawn from; the height, which a count does not need, keeps the plans of count and rows apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 17).alias("row"), F.col("id").alias("col"), (F.col("id") * 37 % 1000).alias("height"))
        got = rasters.numbered(df, ["row", "col"]).agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"), F.min("id").alias("a"), F.max("id").alias("z"), F.max("height").alias("h")).head()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tuple(got) == (200_000, 200_000, 1, 200_000, 999)


def test_windows_need_dates_enough(spark):
    dates = spark.createDataFrame([("a", k) for k in range(60)] + [("b", k % 59) for k in range(80)], "tile string, date int")
    inc = spark.createDataFrame([("a", [30.0, -1.0, 40.0]), ("a", [35.0])], "tile string, re array<double>")
    got = {r["tile"]: (r["n_dates"], r["inc_mean"], r["done"]) for r in rasters.window_meta(dates, inc).collect()}
    assert got == {"a": (60, 35.0, True), "b": (59, None, False)}
