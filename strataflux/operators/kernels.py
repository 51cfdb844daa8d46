"""Array kernels on pixels: amplitude statistics in expressions; spectra and phase linking in grouped pandas functions.

A group is one processing window, whose size is fixed by the window, not by the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def amplitude_dispersion(amplitudes: DataFrame, keys: list[str], amp: str) -> DataFrame:
    """keys, n, mean and da: the sample deviation of valid amplitudes over their mean."""
    valid = F.when(F.col(amp) > 0, F.col(amp))
    return amplitudes.groupBy(*keys).agg(F.count(valid).alias("n"), F.avg(valid).alias("mean"), (F.stddev_samp(valid) / F.nullif(F.avg(valid), F.lit(0.0))).alias("da"))


def calibrated(amplitudes: DataFrame, date: str, amp: str) -> DataFrame:
    """Amplitudes over the median of their date."""
    mid = amplitudes.where(F.col(amp) > 0).groupBy(date).agg(F.median(amp).alias("_m"))
    return amplitudes.join(mid, date).withColumn(amp, F.col(amp) / F.col("_m")).drop("_m")


def amplitude_ratio(pairs: DataFrame, keys: list[str], slave: str, master: str) -> DataFrame:
    """keys and calamp: mean slave amplitude over mean master amplitude, of valid ones."""
    valid = lambda c: F.avg(F.when(F.col(c) > 0, F.col(c)))
    return pairs.groupBy(*keys).agg((valid(slave) / F.nullif(valid(master), F.lit(0.0))).alias("calamp"))


def quantile(df: DataFrame, column: str, share: float, hold: int = 100_000, bins: int = 1024) -> float | None:
    """The exact quantile (linear between neighbours) of a column of any length; nulls do not count.

    Counts of equal bins between the least and the largest value narrow the range that holds the wanted ranks, until it has
    few enough values to be sorted. The driver holds a count for each bin.
    """
    df = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    n, lo, hi = df.agg(F.count("*"), F.min("x"), F.max("x")).head()
    if not n:
        return None
    rank = share * (n - 1)
    first, last = int(np.floor(rank)), int(np.ceil(rank))
    before, within = 0, n  # values below lo, and in [lo, hi]
    while within > hold and lo < hi:
        width = (hi - lo) / bins
        at = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("int")
        found = df.where(F.col("x").between(lo, hi)).groupBy(at.alias("bin")).agg(F.count("*").alias("k"), F.min("x").alias("a"), F.max("x").alias("b")).orderBy("bin").collect()
        total, kept = before, []
        for r in found:
            if total + r["k"] > first and total <= last:
                kept.append((total, r))
            total += r["k"]
        if sum(r["k"] for _, r in kept) == within:
            break
        before, lo, hi = kept[0][0], kept[0][1]["a"], kept[-1][1]["b"]
        within = sum(r["k"] for _, r in kept)
    if lo == hi:
        return float(lo)
    values = df.where(F.col("x").between(lo, hi)).groupBy("x").count().orderBy("x").collect()
    ends = np.cumsum([r["count"] for r in values])
    value = lambda k: values[int(np.searchsorted(ends, k - before, "right"))]["x"]
    return float(value(first) + (value(last) - value(first)) * (rank - first))


def usable(count: Column, most: Column, height: Column, lat: Column, lon: Column, da: Column) -> Column:
    """Pixels with a value on most dates, a plausible height and a place."""
    return (count >= F.floor(most * 0.8)) & (height > -100) & (height < 9000) & (F.abs(lat) > 0.001) & (F.abs(lon) > 0.001) & (da > 0)


def candidates(pixels: DataFrame, da: str, standard: float = 0.4, least: int = 1500, percent: float = 0.12, most: float = 0.70, ok: Column | None = None) -> DataFrame:
    """Pixels below the standard dispersion; if these are too few, the best share of all, up to ``most``. Only pixels that are ``ok`` (see :func:`usable`) count."""
    pixels = pixels.where((F.col(da) > 0) & (F.lit(True) if ok is None else ok))
    limit = standard
    if pixels.where(F.col(da) < standard).count() < least:
        limit = min(most, quantile(pixels, da, percent) or most)
    return pixels.where(F.col(da) < limit)


def interferogram(slave_re: Column, slave_im: Column, master_re: Column, master_im: Column) -> Column:
    """slave * conj(master)."""
    return F.struct((slave_re * master_re + slave_im * master_im).alias("re"), (slave_im * master_re - slave_re * master_im).alias("im"))


def longest_run(mask: np.ndarray) -> tuple[int, int]:
    """Start and length of the longest run of true values; the first of equal ones."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
    if not len(edge):
        return 0, 0
    lengths = edge[1::2] - edge[::2]
    k = int(lengths.argmax())
    return int(edge[2 * k]), int(lengths[k])


def occupied_band(spectrum: np.ndarray, share: float = 0.15) -> tuple[int, int]:
    """The longest run of bins above a share of the greatest."""
    return longest_run(spectrum > share * spectrum.max())


def capon(signal: np.ndarray, size: int, points: int, loading: float = 0.1) -> np.ndarray:
    """Minimum-variance amplitudes of a one-dimensional spectrum at ``points`` frequencies, from sub-apertures of ``size`` samples."""
    sub = np.lib.stride_tricks.sliding_window_view(signal, size)
    r = sub.T @ sub.conj() / len(sub)
    inverse = np.linalg.inv(r + loading * np.trace(r).real / size * np.eye(size) + 1e-12 * np.eye(size))
    steer = np.exp(2j * np.pi * np.outer(np.arange(size), np.arange(points) / points))
    w = inverse @ steer
    w /= np.einsum("ij,ij->j", steer.conj(), w)[None, :]
    shift = np.exp(-2j * np.pi * np.outer(np.arange(len(sub)), np.arange(points) / points))
    return np.einsum("kj,kj->j", sub @ w.conj(), shift) / len(sub)


def refocus(pixels: DataFrame, key: str, size: int, oversample: int = 2, re: str = "re", im: str = "im") -> DataFrame:
    """key, peak, amplitude: the strongest scatterer of each line of samples after minimum-variance focusing."""

    def run(batches):
        for b in batches:
            rows = []
            for k, x, y in zip(b[key], b[re], b[im]):
                a = np.abs(capon(np.asarray(x, float) + 1j * np.asarray(y, float), size, oversample * len(x)))
                rows.append((k, int(a.argmax()), round(float(a.max()), 6)))
            yield pd.DataFrame(rows, columns=[key, "peak", "amplitude"])

    kind = pixels.schema[key].dataType.simpleString()
    return pixels.select(key, re, im).mapInPandas(run, f"{key} {kind}, peak int, amplitude double")


def similar(amplitudes: np.ndarray, k: int, limit: float) -> np.ndarray:
    """Pixels whose amplitude distribution differs from that of pixel ``k`` by no more than ``limit`` (largest distance of the distribution functions)."""
    own = np.sort(amplitudes[k])
    grid = np.sort(np.concatenate([amplitudes, np.broadcast_to(own, amplitudes.shape)], 1), axis=1)
    at = lambda rows: np.stack([np.searchsorted(np.sort(r), g, "right") for r, g in zip(rows, grid)]) / amplitudes.shape[1]
    return np.abs(at(amplitudes) - at(np.broadcast_to(own, amplitudes.shape))).max(1) <= limit


def linked_phases(z: np.ndarray) -> tuple[np.ndarray, float]:
    """Phases of one scatterer over the dates, that of the first 0, and how coherent the residuals are. z: pixels x dates."""
    c = z.T @ z.conj()
    power = np.sqrt(np.real(np.diag(c)))
    c = c / np.maximum(np.outer(power, power), 1e-12)
    _, vectors = np.linalg.eigh(np.linalg.inv(np.abs(c) + 1e-3 * np.eye(len(c))) * c)
    phase = np.angle(vectors[:, 0])
    phase = np.angle(np.exp(1j * (phase - phase[0])))
    a, b = np.triu_indices(len(c), 1)
    return phase, float(np.abs(np.exp(1j * (np.angle(c[a, b]) - (phase[a] - phase[b]))).mean()))


def phase_link(pixels: DataFrame, window: str, key: str, re: str = "re", im: str = "im", least: int = 10, least_gamma: float = 0.6) -> DataFrame:
    """window, key, n_shp, gamma, phases and ds of pixels with ``least`` like ones in their window; ds marks those coherent enough to be used.

    A window is a place of bounded size: its pixels are compared with each other in one task.
    """

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(key)
        z = np.stack(own[re].to_numpy()).astype(float) + 1j * np.stack(own[im].to_numpy()).astype(float)
        amp = np.abs(z)
        limit = 1.36 * np.sqrt(2 / z.shape[1])
        rows = []
        for k, name in enumerate(own[key]):
            like = similar(amp, k, limit)
            if like.sum() >= least:
                phase, gamma = linked_phases(z[like])
                rows.append((own[window].iloc[0], name, int(like.sum()), round(gamma, 6), [round(float(p), 6) for p in phase], gamma >= least_gamma))
        return pd.DataFrame(rows, columns=[window, key, "n_shp", "gamma", "phases", "ds"])

    kinds = {c: pixels.schema[c].dataType.simpleString() for c in (window, key)}
    return pixels.select(window, key, re, im).groupBy(window).applyInPandas(run, f"{window} {kinds[window]}, {key} {kinds[key]}, n_shp int, gamma double, phases array<double>, ds boolean")


def bilinear(grid: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """A grid read at ``rows`` x ``cols`` places spread evenly over it."""
    y, x = np.linspace(0, grid.shape[0] - 1, rows), np.linspace(0, grid.shape[1] - 1, cols)
    y0, x0 = np.minimum(y.astype(int), max(grid.shape[0] - 2, 0)), np.minimum(x.astype(int), max(grid.shape[1] - 2, 0))
    y1, x1 = np.minimum(y0 + 1, grid.shape[0] - 1), np.minimum(x0 + 1, grid.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    top = grid[np.ix_(y0, x0)] * (1 - fx) + grid[np.ix_(y0, x1)] * fx
    return top * (1 - fy) + (grid[np.ix_(y1, x0)] * (1 - fx) + grid[np.ix_(y1, x1)] * fx) * fy
