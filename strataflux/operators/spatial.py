"""Joins by distance as equi joins on grid cells.

One side is repeated into the nine cells around its own, so that a hash join finds every pair within a radius and
no theta join is planned. Skewed cells are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.session import staged


def _cell(x: Column, size: float) -> Column:
    return F.floor(x / size)


def radius_join(a: DataFrame, b: DataFrame, radius: float, ax: str = "x", ay: str = "y", bx: str = "x", by: str = "y", how: str = "inner", on: list[str] | None = None, nearer: bool = False) -> DataFrame:
    """Pairs of a row of ``a`` and a row of ``b`` (renamed with suffix ``_b``) within ``radius`` (or ``nearer``), with ``dist``; or semi and anti joins of ``a``, which need each place of ``b`` once."""
    b = b if how == "inner" else b.select(*{bx, by, *(on or [])}).distinct()
    right = b.select(*(F.col(c).alias(f"{c}_b") for c in b.columns))
    around = F.sequence(F.lit(-1), F.lit(1))
    right = right.withColumn("_i", F.explode(F.transform(around, lambda k: _cell(F.col(f"{bx}_b"), radius) + k))).withColumn("_j", F.explode(F.transform(around, lambda k: _cell(F.col(f"{by}_b"), radius) + k)))
    left = a.withColumn("_ci", _cell(F.col(ax), radius)).withColumn("_cj", _cell(F.col(ay), radius))
    near = F.hypot(left[ax] - right[f"{bx}_b"], left[ay] - right[f"{by}_b"])
    condition = (left["_ci"] == right["_i"]) & (left["_cj"] == right["_j"]) & (near < radius if nearer else near <= radius)
    for k in on or []:
        condition = condition & (left[k] == right[f"{k}_b"])
    out = left.join(right, condition, how)
    if how != "inner":
        return out.drop("_ci", "_cj")
    return out.withColumn("dist", F.hypot(F.col(ax) - F.col(f"{bx}_b"), F.col(ay) - F.col(f"{by}_b"))).drop("_ci", "_cj", "_i", "_j")


def avoid(points: DataFrame, vertices: DataFrame, radius: float, on: list[str] | None = None) -> DataFrame:
    """Points with no vertex nearer than ``radius``; those at the radius stay."""
    return radius_join(points, vertices, radius, how="left_anti", on=on, nearer=True)


def nearest_within(a: DataFrame, b: DataFrame, radius: float, key: str, other: str) -> DataFrame:
    """Each row of ``a`` (by ``key``) with the nearest row of ``b`` within ``radius``; the smaller ``other`` of two equally near.

    Of rows of ``b`` at one place only the smallest can be the nearest, so pairs grow with the places of ``b`` around a row.
    """
    pairs = radius_join(a.select(key, "x", "y"), b.groupBy("x", "y").agg(F.min(other).alias(other)), radius)
    return pairs.groupBy(key).agg(F.min(F.struct("dist", F.col(f"{other}_b").alias("id"))).alias("m")).select(key, F.col("m.id").alias("near_id"), F.col("m.dist").alias("dist"))


def densest_cluster(points: DataFrame, radius: float, key: str, coherence: str, keys: list[str]) -> DataFrame:
    """keys, centre, n_cluster and coherence mean of the point with most neighbours (itself included); then the most coherent, then the smaller id."""
    # Points at one place have the same neighbours, so the smallest stands for them with their counts and sums.
    places = points.groupBy(*keys, "x", "y").agg(F.min(key).alias(key), F.count("*").alias("_n"), F.count(coherence).alias("_m"), F.sum(coherence).alias("_c"))
    near = radius_join(places, places, radius, on=keys)
    each = near.groupBy(*keys, key).agg(F.sum("_n_b").alias("n_cluster"), F.try_divide(F.sum("_c_b"), F.sum("_m_b")).alias("coh_mean"))
    # Means of equal neighbourhoods differ in their last digits by the order of their sums.
    best = F.max(F.struct("n_cluster", F.round("coh_mean", 9).alias("_r"), (-F.col(key)).alias("m"), "coh_mean")).alias("best")
    return each.groupBy(*keys).agg(best).select(*keys, (-F.col("best.m")).alias("centre"), F.col("best.n_cluster").alias("n_cluster"), F.col("best.coh_mean").alias("coh_mean"))


def priority_merge(points: DataFrame, source: str, order: list[str], radius: float, on: list[str] | None = None) -> DataFrame:
    """Points of the first source, then of each next one those farther than ``radius`` from all kept so far; what a step keeps is stored for the next."""
    kept = [points.where(F.col(source) == order[0])]
    for k, name in enumerate(order[1:]):
        so_far = kept[0]
        for more in kept[1:]:
            so_far = so_far.unionByName(more)
        new = radius_join(points.where(F.col(source) == name), so_far, radius, how="left_anti", on=on)
        kept.append(staged(new) if k < len(order) - 2 else new)
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def pair_offset(pairs: DataFrame, keys: list[str], difference: str, least: int = 5) -> DataFrame:
    """keys and the median difference of at least ``least`` pairs, else null."""
    return pairs.groupBy(*keys).agg(F.count(difference).alias("n_pairs"), F.median(difference).alias("_m")).withColumn("offset", F.when(F.col("n_pairs") >= least, F.col("_m"))).drop("_m")


def aligned_offset(pairs: DataFrame, second: DataFrame, first: DataFrame, keys: list[str], least: int = 5, least_first: int = 3) -> DataFrame:
    """keys, offset and how: the median difference of pairs; with too few, the median of the second pass's ground less that of the first's nearby
    (0 if that has too few points); null where the second has too few as well. pairs: diff; second, first: value, a row for each point."""
    p = pairs.groupBy(*keys).agg(F.count("diff").alias("_p"), F.median("diff").alias("_pm"))
    s = second.groupBy(*keys).agg(F.count("value").alias("_s"), F.median("value").alias("_sm"))
    f = first.groupBy(*keys).agg(F.count("value").alias("_f"), F.median("value").alias("_fm"))
    j = s.join(p, keys, "full").join(f, keys, "left")
    local = F.col("_sm") - F.when(F.col("_f") >= least_first, F.col("_fm")).otherwise(0.0)
    by_pairs, by_ground = F.col("_p") >= least, F.col("_s") >= least
    return j.select(*keys, F.when(by_pairs, F.col("_pm")).when(by_ground, local).alias("offset"), F.when(by_pairs, "pairs").when(by_ground, "ground").alias("how"))


def top_with_ties(df: DataFrame, keys: list[str], by: str, k: int) -> DataFrame:
    return df.withColumn("_r", F.rank().over(Window.partitionBy(*keys).orderBy(by))).where(F.col("_r") <= k).drop("_r")
