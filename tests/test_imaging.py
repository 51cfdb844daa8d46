"""Image operators against numpy on whole images."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflux.operators import imaging


def table(spark, z, image=1):
    """Dates x rows x columns as rows of pixels."""
    d, n, m = z.shape
    rows = [(image, y, x, [float(v) for v in z[:, y, x].real], [float(v) for v in z[:, y, x].imag]) for y in range(n) for x in range(m)]
    return spark.createDataFrame(rows, "image int, row int, col int, re array<double>, im array<double>").repartition(3)


def scene(seed, d, n, m):
    r = np.random.default_rng(seed)
    y, x = np.indices((n, m))
    z = 0.3 * (r.normal(size=(d, n, m)) + 1j * r.normal(size=(d, n, m)))
    for py, px, k in ((3.0, 4.5, 2.0), (7.5, 9.0, 3.0), (10.0, 2.0, 1.5)):  # band-limited points, moving in phase over the dates
        z += k * np.sinc((y - py) / 1.6) * np.sinc((x - px) / 1.4) * np.exp(1j * r.uniform(-3, 3, d))[:, None, None]
    return z


def starts(n, size, step):
    out = list(range(0, n - size + 1, step))
    return out + [n - size] if out[-1] != n - size else out


def test_patches_cover_as_stated(spark):
    for n, m, size in ((12, 12, (8, 4)), (13, 9, (8, 4)), (8, 4, (8, 4)), (7, 30, (8, 4))):
        p = spark.createDataFrame([(1, y, x) for y in range(n) for x in range(m)], "image int, row int, col int")
        got = {(r["top"], r["left"]): r["n"] for r in imaging.patches(p, size, (4, 2)).groupBy("top", "left").agg(F.count("*").alias("n")).collect()}
        want = {(i, j): size[0] * size[1] for i in starts(n, size[0], 4) for j in starts(m, size[1], 2)} if n >= size[0] else {}
        assert got == want


def test_spectrum_and_band(spark):
    z = scene(1, 9, 19, 21)
    got = {(r["axis"], r["k"]): r["power"] for r in imaging.spectrum(table(spark, z), (4, 8), 3).collect()}
    want = {}
    for i in range(0, 16, 4):
        for j in range(0, 16, 8):
            p = (np.abs(np.fft.fft2(z[::3, i : i + 4, j : j + 8])) ** 2).sum(0)
            for axis, n, s in (("row", 4, p.sum(1)), ("col", 8, p.sum(0))):
                for k, v in zip(np.fft.fftfreq(n, 1 / n), s):
                    want[axis, int(k)] = want.get((axis, int(k)), 0) + v
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    for power, band in (([9, 1, 9, 9, 1, 9, 9], (-1, 0)), ([9, 1, 9, 1, 9, 1, 9], (-3, -3)), ([1, 1, 9, 9, 9, 9, 9], (-1, 3)), ([1, 1, 1, 1, 1, 1, 9], (-3, -3))):
        s = spark.createDataFrame([(1, "row", k - 3, float(p)) for k, p in enumerate(power)], "image int, axis string, k long, power double")
        r = imaging.band(s).head()
        assert (r["first"], r["last"]) == band, power


def plain_focus(cube, rows, cols, places, loading, least):
    """The same estimates from their definitions, place by place."""
    d, pa, pr = cube.shape
    ma, mr = max(len(rows) // 3, least[0]), max(len(cols) // 3, least[1])
    y = np.fft.fft2(cube)[:, rows % pa][:, :, cols % pr]
    shifts = [(i, j) for i in range(len(rows) - ma + 1) for j in range(len(cols) - mr + 1)]
    snap = {(k, s): y[k, s[0] : s[0] + ma, s[1] : s[1] + mr].ravel() for k in range(d) for s in shifts}
    r = sum(np.outer(x, x.conj()) for x in snap.values()) / len(snap)
    r = r + loading * np.trace(r).real / len(r) * np.eye(len(r))
    out = []
    for u, v in places:
        a = np.array([np.exp(-2j * np.pi * (i * u / pa + j * v / pr)) for i in range(ma) for j in range(mr)])
        back = {s: np.exp(2j * np.pi * (rows[s[0]] * u / pa + cols[s[1]] * v / pr)) for s in shifts}
        g = np.array([sum(back[s] * snap[k, s] for s in shifts) / len(shifts) for k in range(d)])
        both = []
        for q in (r, r - sum(np.outer(x, x.conj()) for x in g) / d):
            w = np.linalg.solve(q, a)
            both.append(g @ (w / (a.conj() @ w).real).conj())
        out.append(both)
    return np.array(out)


def test_focus_by_definition():
    z = scene(2, 5, 8, 10)
    rows, cols = np.arange(-3, 3), np.arange(-4, 4)
    capon, apes = imaging.focus(z, rows, cols, 0.1, (2, 3))
    places = [(0, 0), (1.5, 2), (3, 4.5), (7.5, 9.5), (4, 0.5)]
    want = plain_focus(z, rows, cols, places, 0.1, (2, 3))
    for (u, v), (c, a) in zip(places, want):
        at = np.s_[:, int(2 * u), int(2 * v)]
        assert np.allclose(capon[at], c) and np.allclose(apes[at], a)


def test_points_keep_their_phases():
    """A bright point's estimate at its place follows its phase over the dates."""
    r = np.random.default_rng(4)
    phase = r.uniform(-3, 3, 12)
    y, x = np.indices((16, 16))
    point = np.sinc((y - 8) / 1.5) * np.sinc((x - 7) / 1.5)
    z = 5 * point * np.exp(1j * phase)[:, None, None] + 0.05 * (r.normal(size=(12, 16, 16)) + 1j * r.normal(size=(12, 16, 16)))
    for image in imaging.focus(z, np.arange(-4, 5), np.arange(-4, 5)):
        at = np.unravel_index(np.abs(image).mean(0).argmax(), image.shape[1:])
        assert at == (16, 14)
        assert np.abs(np.angle(image[:, 16, 14] * np.exp(-1j * phase) * np.exp(-1j * np.angle(image[0, 16, 14] * np.exp(-1j * phase[0]))))).max() < 0.05


def test_refocused_equals_the_whole_image(spark):
    """Three by three patches and a rest, seams included."""
    z, size, least = scene(3, 4, 17, 18), (8, 8), (2, 2)
    p = table(spark, z)
    bands = spark.createDataFrame([(1, "row", -3, 2), (1, "col", -2, 3)], "image int, axis string, first long, last long")
    got = np.zeros((2, 4, 34, 36), complex)
    seen = 0
    for r in imaging.refocused(p, bands, size, least=least).collect():
        got[0, :, r["row"], r["col"]] = np.array(r["capon_re"]) + 1j * np.array(r["capon_im"])
        got[1, :, r["row"], r["col"]] = np.array(r["apes_re"]) + 1j * np.array(r["apes_im"])
        seen += 1
    total, weight = np.zeros_like(got), np.zeros((34, 36))
    w = np.hanning(18)[1:-1][:, None] * np.hanning(18)[1:-1][None]
    for i in starts(17, 8, 4):
        for j in starts(18, 8, 4):
            at = np.s_[2 * i : 2 * i + 16, 2 * j : 2 * j + 16]
            for k, image in enumerate(imaging.focus(z[:, i : i + 8, j : j + 8], np.arange(-3, 3), np.arange(-2, 4), 0.1, least)):
                total[k, :, *at] += image * w
            weight[at] += w
    assert seen == 34 * 36 and np.allclose(got, total / np.maximum(weight, 1e-6))


def test_small_images_and_empty_tables(spark):
    p = table(spark, scene(5, 2, 6, 6))
    bands = spark.createDataFrame([(1, "row", -3, 2), (1, "col", -2, 3)], "image int, axis string, first long, last long")
    assert imaging.refocused(p, bands, (8, 8)).count() == 0 and imaging.spectrum(p, (8, 8)).count() == 0
    assert imaging.linked(p.limit(0)).count() == 0 and imaging.band(imaging.spectrum(p.limit(0))).count() == 0


def test_windows_see_their_neighbours(spark):
    """Every pixel, those at the edges of tiles too, equals the one from the whole image."""
    r = np.random.default_rng(6)
    z = scene(6, 16, 11, 13) * r.uniform(0.5, 3, (1, 11, 13))
    half, least = (2, 3), 6
    got = {(x["row"], x["col"]): x for x in imaging.linked(table(spark, z), half, (4, 5), least).collect()}
    assert len(got) == 11 * 13
    amp = np.abs(z)
    shares = np.arange(1, 32) / 32
    q = np.quantile(amp, shares, axis=0)
    for y in range(11):
        for x in range(13):
            near = [(i, j) for i in range(max(0, y - 2), min(11, y + 3)) for j in range(max(0, x - 3), min(13, x + 4))]
            like = [(i, j) for i, j in near if max(abs(np.mean(q[:, i, j] <= c) - s) for c, s in zip(q[:, y, x], shares)) <= 1.36 * np.sqrt(2 / 16)]
            row = got[y, x]
            assert row["n_shp"] == len(like)
            if len(like) < least:
                assert row["phases"] is None and not row["ds"]
                continue
            s = np.array([z[:, i, j] for i, j in like]).T
            c = s @ s.conj().T / s.shape[1]
            c /= np.sqrt(np.outer(np.diag(c).real, np.diag(c).real))
            _, v = np.linalg.eigh(np.linalg.inv(np.abs(c) + 1e-3 * np.eye(16)) * c)
            th = np.angle(v[:, 0] * np.conj(v[0, 0]))
            i, j = np.triu_indices(16, 1)
            gamma = np.abs(np.exp(1j * (np.angle(c) - (th[:, None] - th[None]))[i, j]).mean())
            assert row["gamma"] == pytest.approx(gamma, abs=1e-6) and np.allclose(np.exp(1j * np.array(row["phases"])), np.exp(1j * th), atol=1e-5)
            assert row["amplitude"] == pytest.approx(np.mean([amp[:, i, j].mean() for i, j in like])) and row["ds"] == (gamma >= 0.6)


def test_zoom_equals_the_untiled_raster(spark):
    from strataflux.operators.kernels import bilinear

    r = np.random.default_rng(7)
    for n, m, to in ((13, 9, (26, 18)), (8, 8, (16, 16)), (1, 5, (2, 10)), (9, 4, (5, 3)), (5, 5, (1, 7))):
        g = r.normal(size=(n, m))
        df = spark.createDataFrame([(1, y, x, float(g[y, x])) for y in range(n) for x in range(m)], "image int, row int, col int, value double")
        shape = spark.createDataFrame([(1, *to)], "image int, to_rows int, to_cols int")
        got = np.full(to, np.nan)
        rows = imaging.zoomed(df, shape, (4, 3)).collect()
        for x in rows:
            got[x["row"], x["col"]] = x["value"]
        assert len(rows) == to[0] * to[1] and np.allclose(got, bilinear(g, *to)), (n, m, to)
