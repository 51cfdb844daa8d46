"""Image operators on rows of pixels: overlapping patches, moving windows with a halo, interpolation, crops.

A pixel is a row (image, row, col, ...), with its values over the dates as arrays ``re`` and ``im``. An image of any size is dealt into patches
or tiles of fixed size: each pixel goes to every patch, or tile with its halo, that needs it (one shuffle by patch), so a task
holds a patch at a time and results do not depend on the tiling. What patches give is summed up again as rows.
Each pixel is there once, without nulls in its arrays; a missing pixel counts as 0 where patches are made, and as no value where a raster is read between pixels.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.operators.kernels import linked_phases
from strataflux.session import staged

#: Rows of a table of images up to which it is sent to every task; longer ones are shuffled.
IMAGES = 1_000_000


def sizes(pixels: DataFrame) -> DataFrame:
    """image, rows and cols."""
    return pixels.groupBy("image").agg((F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"))


def _with_facts(pixels: DataFrame, facts: DataFrame) -> DataFrame:
    """Pixels with what is known of their image: a table of a row an image, whose length is checked."""
    facts = staged(facts)
    return pixels.join(F.broadcast(facts) if facts.count() <= IMAGES else facts, "image")


def _starts(at: Column, total: Column, size: int, step: int) -> Column:
    """The starts of all patches that hold a place: every ``step`` from 0, and one that ends where the image does."""
    last = F.floor((total - size) / step) * step
    lo = F.greatest(F.ceil((at - size + 1) / step), F.lit(0)) * step
    hi = F.least(F.floor(at / step) * step, last)
    regular = F.when(lo <= hi, F.sequence(lo, hi, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    end = (total - size).cast("long")
    return F.when(total < size, F.array().cast("array<bigint>")).when((end > last) & (at >= end), F.concat(regular, F.array(end))).otherwise(regular)


def patches(pixels: DataFrame, size: tuple[int, int], step: tuple[int, int]) -> DataFrame:
    """Pixels once for each patch (top, left) that holds them; images smaller than a patch have none."""
    both = _with_facts(pixels, sizes(pixels))
    both = both.withColumn("top", F.explode(_starts(F.col("row"), F.col("rows"), size[0], step[0])))
    return both.withColumn("left", F.explode(_starts(F.col("col"), F.col("cols"), size[1], step[1])))


def with_halo(pixels: DataFrame, tile: tuple[int, int], before: tuple[int, int], after: tuple[int, int]) -> DataFrame:
    """Pixels once for each tile (tile_row, tile_col) whose rows and columns, with so many before and after them, hold them; ``core`` marks the tile's own."""
    df = pixels
    for name, n, b, a in (("row", tile[0], before[0], after[0]), ("col", tile[1], before[1], after[1])):
        first = F.greatest(F.floor((F.col(name) - a) / n), F.lit(0))
        df = df.withColumn(f"tile_{name}", F.explode(F.sequence(first, F.floor((F.col(name) + b) / n))))
    return df.withColumn("core", (F.floor(F.col("row") / tile[0]) == F.col("tile_row")) & (F.floor(F.col("col") / tile[1]) == F.col("tile_col")))


def _cube(own: pd.DataFrame, top: int, left: int, shape: tuple[int, int]) -> np.ndarray:
    """Dates x rows x columns of a patch from its rows."""
    z = np.stack(own["re"].to_numpy()).astype(float) + 1j * np.stack(own["im"].to_numpy()).astype(float)
    out = np.zeros((z.shape[1], *shape), complex)
    out[:, own["row"].to_numpy() - top, own["col"].to_numpy() - left] = z.T
    return out


# The occupied band


def spectrum(pixels: DataFrame, size: tuple[int, int] = (32, 64), every: int = 7) -> DataFrame:
    """image, axis (row or col), k (frequency in cycles a patch) and power: the spectra of whole patches side by side, of every so manyth date, summed over the other axis."""
    tiled = _with_facts(pixels, sizes(pixels)).withColumns({"top": F.floor(F.col("row") / size[0]) * size[0], "left": F.floor(F.col("col") / size[1]) * size[1]})
    whole = tiled.where((F.col("top") + size[0] <= F.col("rows")) & (F.col("left") + size[1] <= F.col("cols")))

    def run(own: pd.DataFrame) -> pd.DataFrame:
        cube = _cube(own, own["top"].iloc[0], own["left"].iloc[0], size)[::every]
        p = (np.abs(np.fft.fft2(cube)) ** 2).sum(axis=0)
        image = own["image"].iloc[0]
        parts = [pd.DataFrame({"image": image, "axis": a, "k": np.fft.fftfreq(n, 1 / n).astype(int), "power": p.sum(axis=1 - i)}) for i, (a, n) in enumerate(zip(("row", "col"), size))]
        return pd.concat(parts)

    kind = pixels.schema["image"].dataType.simpleString()
    each = whole.select("image", "top", "left", "row", "col", "re", "im").groupBy("image", "top", "left").applyInPandas(run, f"image {kind}, axis string, k long, power double")
    return each.groupBy("image", "axis", "k").agg(F.sum("power").alias("power"))


def band(spectra: DataFrame, share: float = 0.15) -> DataFrame:
    """image, axis, first and last: the longest run of frequencies above a share of the greatest power, the lowest of equal ones.

    Where no two such frequencies are adjacent, the band is the lowest frequency alone. A spectrum has a row for each
    frequency of a patch, however large the image.
    """
    own = Window.partitionBy("image", "axis")
    marked = spectra.withColumns({"above": F.col("power") > share * F.max("power").over(own), "lowest": F.min("k").over(own)})
    runs = marked.where("above").withColumn("run", F.col("k") - F.row_number().over(own.orderBy("k"))).groupBy("image", "axis", "run", "lowest").agg(F.min("k").alias("a"), F.max("k").alias("b"))
    best = runs.groupBy("image", "axis").agg(F.max(F.struct((F.col("b") - F.col("a")).alias("n"), (-F.col("a")).alias("o"), F.col("lowest").alias("l"))).alias("m"))
    first = F.when(F.col("m.n") > 0, -F.col("m.o")).otherwise(F.col("m.l"))
    return best.select("image", "axis", first.alias("first"), (first + F.col("m.n")).alias("last"))


# Focusing in two dimensions


def sub_apertures(n: int, least: int) -> int:
    """Samples of a sub-aperture in a band of ``n``: a third of it."""
    return max(n // 3, least)


def focus(cube: np.ndarray, rows: np.ndarray, cols: np.ndarray, loading: float = 0.1, least: tuple[int, int] = (3, 4)) -> tuple[np.ndarray, np.ndarray]:
    """Minimum-variance and amplitude-and-phase estimates of a patch (dates x rows x columns), at twice its samples in both directions.

    ``rows`` and ``cols`` are the frequencies of the occupied band. All sub-apertures of all dates have one covariance. For
    a place, each element of the sub-aperture sees the mean of the band's samples that it may take, turned back to the place; these means are products with
    two small matrices. The second estimate takes the signal's own part (that mean over the dates) out of the covariance, by the matrix inversion lemma
    in the space of the dates.
    """
    d, pa, pr = cube.shape
    ma, mr = sub_apertures(len(rows), least[0]), sub_apertures(len(cols), least[1])
    na, nr = len(rows) - ma + 1, len(cols) - mr + 1
    if na < 1 or nr < 1:
        raise ValueError("the band is narrower than a sub-aperture")
    y = np.fft.fft2(cube)[:, rows % pa][:, :, cols % pr]
    shots = np.lib.stride_tricks.sliding_window_view(y, (ma, mr), axis=(1, 2)).reshape(d * na * nr, ma * mr)
    r = shots.T @ shots.conj() / len(shots)
    inverse = np.linalg.inv(r + loading * np.trace(r).real / (ma * mr) * np.eye(ma * mr))

    at_a, at_r = np.arange(2 * pa) / (2 * pa), np.arange(2 * pr) / (2 * pr)
    turn_a, turn_r = np.exp(2j * np.pi * np.outer(at_a, rows)), np.exp(2j * np.pi * np.outer(cols, at_r))
    steer_a, steer_r = np.exp(-2j * np.pi * np.outer(np.arange(ma), at_a)), np.exp(-2j * np.pi * np.outer(np.arange(mr), at_r))
    steer = (steer_a[:, None, :, None] * steer_r[None, :, None, :]).reshape(ma * mr, -1)
    seen = np.empty((ma * mr, d, 4 * pa * pr), complex)  # what an element sees at a place, with the element's own phase
    for i in range(ma):
        half = turn_a[:, i : i + na] @ y[:, i : i + na]
        for j in range(mr):
            seen[i * mr + j] = ((half[:, :, j : j + nr] @ turn_r[j : j + nr]) / (na * nr)).reshape(d, -1) * steer[i * mr + j]
    weighted = inverse @ steer
    power = np.einsum("mu,mu->u", steer.conj(), weighted).real
    capon = np.einsum("mu,mdu->du", weighted.conj(), seen) / power

    apes = np.empty_like(capon)
    for lo in range(0, capon.shape[1], 512):
        part = slice(lo, lo + 512)
        g = seen[:, :, part].transpose(2, 0, 1)
        own = d * np.eye(d) - g.conj().transpose(0, 2, 1) @ (inverse @ g)
        c = np.einsum("mu,umd->ud", weighted[:, part].conj(), g)
        x = np.linalg.solve(own.transpose(0, 2, 1), c[:, :, None])[:, :, 0]  # c times the inverse of ``own``
        apes[:, part] = (d * x / (power[part] + np.einsum("ud,ud->u", x, c.conj()).real)[:, None]).T
    return capon.reshape(d, 2 * pa, 2 * pr), apes.reshape(d, 2 * pa, 2 * pr)


def refocused(pixels: DataFrame, bands: DataFrame, size: tuple[int, int] = (32, 64), loading: float = 0.1, least: tuple[int, int] = (3, 4)) -> DataFrame:
    """image, row, col on a grid twice as fine, and over the dates capon_re, capon_im, apes_re and apes_im: patches that overlap by half, focused each and summed up under Hann weights.

    ``bands`` is a table as of :func:`band`. Images smaller than a patch have no rows.
    """
    wide = bands.groupBy("image").agg(*(F.max(F.when(F.col("axis") == a, F.col(c))).alias(f"{a}_{c}") for a in ("row", "col") for c in ("first", "last")))
    dealt = _with_facts(patches(pixels, size, (size[0] // 2, size[1] // 2)), wide)
    window = np.outer(np.hanning(2 * size[0] + 2)[1:-1], np.hanning(2 * size[1] + 2)[1:-1])

    def run(own: pd.DataFrame) -> pd.DataFrame:
        one = own.iloc[0]
        cube = _cube(own, one["top"], one["left"], size)
        found = focus(cube, np.arange(one["row_first"], one["row_last"] + 1), np.arange(one["col_first"], one["col_last"] + 1), loading, least)
        i, j = (x.ravel() for x in np.indices(window.shape))
        out = {"image": one["image"], "row": 2 * one["top"] + i, "col": 2 * one["left"] + j, "w": window.ravel()}
        for name, z in zip(("capon", "apes"), found):
            z = (z * window).reshape(len(z), -1).T
            out |= {f"{name}_re": list(z.real), f"{name}_im": list(z.imag)}
        return pd.DataFrame(out)

    kind, values = pixels.schema["image"].dataType.simpleString(), ["capon_re", "capon_im", "apes_re", "apes_im"]
    schema = f"image {kind}, row long, col long, w double, " + ", ".join(f"{v} array<double>" for v in values)
    cols = ["image", "top", "left", "row", "col", "re", "im", "row_first", "row_last", "col_first", "col_last"]
    each = dealt.select(*cols).groupBy("image", "top", "left").applyInPandas(run, schema)
    # A place lies in nine patches at most; their values are added up element by element.
    met = each.groupBy("image", "row", "col").agg(F.sum("w").alias("w"), *(F.collect_list(v).alias(v) for v in values))
    scale = F.greatest(F.col("w"), F.lit(1e-6))
    total = lambda v: F.transform(F.aggregate(F.slice(v, 2, 9), F.element_at(v, 1), lambda a, x: F.zip_with(a, x, lambda p, q: p + q)), lambda x: x / scale)
    return met.select("image", "row", "col", *(total(v).alias(v) for v in values))


# Distributed scatterers in moving windows


def quantiles(amplitudes: np.ndarray, levels: int = 31) -> np.ndarray:
    """Amplitude quantiles over the dates (the first axis) at ``levels`` even shares between 0 and 1."""
    return np.quantile(amplitudes, np.arange(1, levels + 1) / (levels + 1), axis=0)


def alike(own: np.ndarray, others: np.ndarray, limit: float) -> np.ndarray:
    """Which of ``others`` (levels x pixels) are distributed like ``own`` (levels): their shares of quantiles up to each of its quantiles differ from its own shares by ``limit`` at most."""
    shares = np.arange(1, len(own) + 1) / (len(own) + 1)
    found = (others[None] <= own[:, None, None]).mean(axis=1)
    return np.abs(found - shares[:, None]).max(axis=0) <= limit


def linked(pixels: DataFrame, half: tuple[int, int] = (3, 10), tile: tuple[int, int] = (32, 64), least: int = 10, least_gamma: float = 0.6) -> DataFrame:
    """image, row, col, n_shp, gamma, amplitude, phases and ds of every pixel, from the pixels like it in the window around it.

    Tiles are read with the window's reach around them, so a window sees the pixels of neighbouring tiles. Under ``least``
    like pixels gamma is 0 and phases are null; ds marks pixels that are coherent enough to be used.
    """

    def run(own: pd.DataFrame) -> pd.DataFrame:
        top, left = int(own["row"].min()), int(own["col"].min())
        shape = (int(own["row"].max()) - top + 1, int(own["col"].max()) - left + 1)
        z = _cube(own, top, left, shape)
        amp = np.abs(z)
        q, limit, rows = quantiles(amp), 1.36 * math.sqrt(2 / len(z)), []
        core = own[own["core"]]
        for y, x in zip((core["row"] - top).tolist(), (core["col"] - left).tolist()):
            near = np.s_[:, max(0, y - half[0]) : y + half[0] + 1, max(0, x - half[1]) : x + half[1] + 1]
            like = alike(q[:, y, x], q[near].reshape(len(q), -1), limit)
            n, phases, gamma, size = int(like.sum()), None, 0.0, None
            if n >= least:
                phase, gamma = linked_phases(z[near].reshape(len(z), -1)[:, like].T)
                phases, size = phase.tolist(), float(amp[near].reshape(len(z), -1)[:, like].mean())
            rows.append((own["image"].iloc[0], y + top, x + left, n, gamma, size, phases, bool(n >= least and gamma >= least_gamma)))
        return pd.DataFrame(rows, columns=["image", "row", "col", "n_shp", "gamma", "amplitude", "phases", "ds"])

    kind = pixels.schema["image"].dataType.simpleString()
    dealt = with_halo(pixels.select("image", "row", "col", "re", "im"), tile, half, half)
    return dealt.groupBy("image", "tile_row", "tile_col").applyInPandas(run, f"image {kind}, row long, col long, n_shp int, gamma double, amplitude double, phases array<double>, ds boolean")


# Interpolation and crops


def zoomed(raster: DataFrame, shape: DataFrame, tile: tuple[int, int] = (256, 256)) -> DataFrame:
    """A raster (image, row, col, value) read bilinearly at ``to_rows`` x ``to_cols`` places (table ``shape``: image, to_rows, to_cols) spread evenly over it, ends included.

    A tile is read with the next row and column of its neighbours.
    """

    def run(own: pd.DataFrame) -> pd.DataFrame:
        one = own.iloc[0]
        top, left = one["tile_row"] * tile[0], one["tile_col"] * tile[1]
        grid = np.full((tile[0] + 1, tile[1] + 1), np.nan)
        grid[own["row"] - top, own["col"] - left] = own["value"]
        places = []
        for first, n, size, to in ((top, tile[0], one["rows"], one["to_rows"]), (left, tile[1], one["cols"], one["to_cols"])):
            scale = (size - 1) / (to - 1) if to > 1 else 0.0
            # The last source place belongs to the cell before it.
            mine = np.arange(max(0, math.floor(first / scale) - 1) if scale else 0, min(to, math.ceil((first + n) / scale) + 2) if scale else to)
            cell = np.minimum(np.floor(mine * scale).astype(int), max(size - 2, 0))
            keep = (cell >= first) & (cell < first + n)
            mine, cell = mine[keep], cell[keep]
            places.append((mine, cell - first, mine * scale - cell, np.minimum(cell + 1, size - 1) - first))
        (i, y0, fy, y1), (j, x0, fx, x1) = places
        fy, fx = fy[:, None], fx[None, :]
        across = lambda y: grid[np.ix_(y, x0)] * (1 - fx) + np.where(fx > 0, grid[np.ix_(y, x1)], 0.0) * fx
        values = across(y0) * (1 - fy) + np.where(fy > 0, across(y1), 0.0) * fy
        return pd.DataFrame({"image": one["image"], "row": np.repeat(i, len(j)), "col": np.tile(j, len(i)), "value": values.ravel()})

    kind = raster.schema["image"].dataType.simpleString()
    dealt = with_halo(raster.select("image", "row", "col", F.col("value").cast("double").alias("value")), tile, (0, 0), (1, 1))
    dealt = _with_facts(dealt, sizes(raster).join(shape, "image"))
    return dealt.groupBy("image", "tile_row", "tile_col").applyInPandas(run, f"image {kind}, row long, col long, value double")


def boxes(vertices: DataFrame, margin: float = 150.0) -> DataFrame:
    """key, image, S, N, W and E of vertices (key, image, lat, lon, lat0, the structure's own latitude), with a margin in metres."""
    dy, dx = F.lit(margin / 111320), margin / (111320 * F.cos(F.radians(F.first("lat0"))))
    return vertices.groupBy("key", "image").agg((F.min("lat") - dy).alias("S"), (F.max("lat") + dy).alias("N"), (F.min("lon") - dx).alias("W"), (F.max("lon") + dx).alias("E"))


def crops(pixels: DataFrame, boxes: DataFrame, least: tuple[int, int] = (64, 192), patch: tuple[int, int] = (32, 64), least_pixels: int = 50) -> DataFrame:
    """key, image, row0, row1, col0, col1: for each box (key, image, S, N, W, E) the rows and columns of its pixels (image, row, col, lat, lon), widened to ``least`` and cut where the image ends.

    Boxes with fewer than ``least_pixels`` pixels, and crops that a patch does not fit in, go. A pixel meets the boxes of its image by an equi join.
    """
    lat, lon = F.col("lat"), F.col("lon")
    inside = pixels.join(boxes, "image").where(lat.between(F.col("S"), F.col("N")) & lon.between(F.col("W"), F.col("E")))
    found = inside.groupBy("key", "image").agg(F.count("*").alias("n"), *(f(c).alias(f"{c}_{k}") for c in ("row", "col") for k, f in (("a", F.min), ("b", F.max)))).where(F.col("n") >= least_pixels)
    found = found.join(sizes(pixels), "image")
    out = {}
    for c, total, n in (("row", "rows", least[0]), ("col", "cols", least[1])):
        middle = F.floor((F.col(f"{c}_a") + F.col(f"{c}_b")) / 2)
        reach = F.greatest(F.floor((F.col(f"{c}_b") - F.col(f"{c}_a")) / 2) + 1, F.lit(n // 2))
        out |= {f"{c}0": F.greatest(middle - reach, F.lit(0)), f"{c}1": F.least(middle + reach, F.col(total))}
    cut = found.withColumns(out).where((F.col("row1") - F.col("row0") >= patch[0]) & (F.col("col1") - F.col("col0") >= patch[1]))
    return cut.select("key", "image", "row0", "row1", "col0", "col1")
