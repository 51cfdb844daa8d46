"""Which burst covers a processing window best, and whether its cut is whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def coverage(pixels: DataFrame, tiles: DataFrame, cell: float, pixel_area: float) -> DataFrame:
    """tile, burst, share (of the window's area, 1 at most), valid (share of valid pixels) and score.

    Pixels (burst, x, y, valid) meet windows (tile, W, E, S, N) by cells of the window, an equi join with the bounds as a residual.
    """
    steps = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    boxes = tiles.withColumn("_i", F.explode(steps("W", "E"))).withColumn("_j", F.explode(steps("S", "N")))
    px = pixels.withColumn("_i", F.floor(F.col("x") / cell)).withColumn("_j", F.floor(F.col("y") / cell))
    inside = px.join(boxes, ["_i", "_j"]).where((F.col("x") >= F.col("W")) & (F.col("x") < F.col("E")) & (F.col("y") >= F.col("S")) & (F.col("y") < F.col("N")))
    area = F.first((F.col("E") - F.col("W")) * (F.col("N") - F.col("S")))
    out = inside.groupBy("tile", "burst").agg(F.least(F.count("*") * pixel_area / area, F.lit(1.0)).alias("share"), F.avg(F.col("valid").cast("int")).alias("valid"))
    return out.withColumn("score", F.col("share") * F.col("valid"))


def best_burst(scores: DataFrame, least: float = 0.75) -> DataFrame:
    """tile, burst and score of the best burst of each window that is covered well enough; the first of equal ones."""
    best = scores.groupBy("tile").agg(F.max(F.struct("score", (-F.col("burst")).alias("b"))).alias("m"))
    return best.select("tile", (-F.col("m.b")).alias("burst"), F.col("m.score").alias("score")).where(F.col("score") >= least)


def valid_cuts(cuts: DataFrame, keys: list[str], value: str, valid: Column, share: float = 0.9) -> DataFrame:
    """keys whose non-zero values are at least ``share`` of the valid share of their window."""
    return cuts.groupBy(*keys).agg(F.avg((F.col(value) != 0).cast("int")).alias("_s"), F.max(valid).alias("_v")).where(F.col("_s") >= share * F.col("_v")).select(*keys)


def complete_windows(cuts: DataFrame, tile: str, date: str, least: int = 60) -> DataFrame:
    """tile, n_dates and complete: windows with fewer dates wait, with that as their status."""
    return cuts.groupBy(tile).agg(F.count_distinct(date).alias("n_dates")).withColumn("complete", F.col("n_dates") >= least)
