"""Judgement of zones and decks: displacement and distortion against what is allowed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.criteria import INDICATORS, Criteria
from strataflux.functions.expr import confidence, grade, level


def significant(zones: DataFrame) -> DataFrame:
    """Add thr and sig: beyond twice the ground's scale and twice the standard error (the latter alone without a ring)."""
    thr = F.greatest(2 * F.coalesce("sigma", F.lit(0.0)), 2 * F.col("se"))
    return zones.withColumn("thr", thr).withColumn("sig", F.coalesce(F.abs("v") > F.col("thr"), F.lit(False)))


def displacement(zones: DataFrame, years: Column, criteria: Criteria = Criteria()) -> DataFrame:
    """Add D now and D10 at the end of the projection, 0 where the velocity is not significant."""
    ahead = years + criteria.projection_years
    return zones.withColumns({"D": F.when(F.col("sig"), F.abs("v") * years).otherwise(0.0), "D10": F.when(F.col("sig"), F.abs("v") * ahead).otherwise(0.0)})


def uncertainty(se: Column, sigma: Column, n_ring: Column, coverage: Column) -> Column:
    """One sigma of a zone's velocity, wider where dates are missing."""
    return F.hypot(se, F.coalesce(sigma / F.sqrt(n_ring), F.lit(0.0))) * F.sqrt(F.greatest(F.lit(1.0), 1 / F.greatest(coverage, F.lit(0.05))))


def distortion(zones: DataFrame, keys: list[str], zone: str, years: Column, span: Column, criteria: Criteria = Criteria()) -> DataFrame:
    """Add beta and beta10 between each zone and the next one, null where that is missing."""
    w = Window.partitionBy(*keys).orderBy(zone)
    there = F.lead(zone).over(w) == F.col(zone) + 1
    dv = F.abs(F.lead("v").over(w) - F.col("v"))
    counts = F.col("sig") | F.lead("sig").over(w)
    beta = lambda t: F.when(there, F.when(counts, dv * t / 1000 / span).otherwise(0.0))
    return zones.withColumns({"beta": beta(years), "beta10": beta(years + criteria.projection_years)})


def band(zones: DataFrame, keys: list[str], zone: str, years: Column, span: Column, beta_allow: Column, criteria: Criteria = Criteria()) -> DataFrame:
    """keys, r_lo and r_hi: the ratio now if all zones lie two sigma (column sv) and the thermal part (dT) nearer to or farther from 0."""
    w = Window.partitionBy(*keys).orderBy(zone)
    dv = F.when(F.lead(zone).over(w) == F.col(zone) + 1, F.abs(F.lead("v").over(w) - F.col("v")))
    two = 2 * F.hypot(F.col("sv"), F.lead("sv").over(w))
    one = 2 * F.col("sv") * years + F.coalesce("dT", F.lit(0.0))
    df = zones
    for name, sign in (("lo", -1), ("hi", 1)):
        df = df.withColumn(f"_d_{name}", F.greatest(F.abs("v") * years + sign * one, F.lit(0.0))).withColumn(f"_b_{name}", F.when(dv.isNotNull(), F.greatest(dv + sign * two, F.lit(0.0)) * years / 1000 / span))
    ratio = lambda n: F.greatest(F.max(f"_d_{n}") / criteria.settlement_mm, F.coalesce(F.max(F.col(f"_b_{n}") / beta_allow), F.lit(0.0)))
    return df.groupBy(*keys).agg(ratio("lo").alias("r_lo"), ratio("hi").alias("r_hi"))


def judge(zones: DataFrame, keys: list[str], thresholds: tuple[float, float, float] | Column, beta_allow: float | Column = 0.002, criteria: Criteria = Criteria()) -> DataFrame:
    """keys, n_zones, D_now, D_10y, beta_now, beta_10y, r_now, r_10y and level."""
    out = zones.groupBy(*keys).agg(F.count("*").alias("n_zones"), F.max("D").alias("D_now"), F.max("D10").alias("D_10y"), F.coalesce(F.max("beta"), F.lit(0.0)).alias("beta_now"), F.coalesce(F.max("beta10"), F.lit(0.0)).alias("beta_10y"))
    out = out.withColumns({"r_now": F.greatest(F.col("D_now") / criteria.settlement_mm, F.col("beta_now") / beta_allow), "r_10y": F.greatest(F.col("D_10y") / criteria.settlement_mm, F.col("beta_10y") / beta_allow)})
    return out.withColumn("level", level(F.col("r_now"), F.col("r_10y"), thresholds))


def review(level: Column, n_points: Column, cover: Column, has_ring: Column, uncertain: Column, gap: Column, criteria: Criteria = Criteria()) -> Column:
    return (level >= 2) & ((n_points < criteria.min_deck_points) | (cover < criteria.min_cover) | ~has_ring | uncertain | gap)


def indicators(segments: DataFrame, keys: list[str], segment: str) -> DataFrame:
    """keys and for V, ACC, DIFF, CUM a value and its grade: -1 without a value, 0 if not significant. Segments have v, acc, v_thr, years, sigma, and
    v_is_sig and acc_is_sig, which were told from values not yet rounded.

    The value is the largest of the significant segments, and of all where none is; the first segment of equal ones. DIFF, which has
    one limit for a structure, is 0 where no two segments are adjacent and null for a single one.
    """
    w = Window.partitionBy(*keys).orderBy(segment)
    adjacent = F.lead(segment).over(w) == F.col(segment) + 1
    limit = F.coalesce(2 * 2**0.5 * F.col("sigma"), 2 * 2**0.5 * F.max("v_thr").over(Window.partitionBy(*keys)) / 2)
    df = segments.withColumns({"DIFF": F.when(adjacent, F.abs(F.lead("v").over(w) - F.col("v"))), "_d_thr": limit, "V": F.abs("v"), "ACC": F.abs("acc"), "CUM": F.abs("v") * F.col("years")})
    tests = {"V": F.col("v_is_sig"), "ACC": F.col("acc_is_sig"), "DIFF": F.col("DIFF") > F.col("_d_thr"), "CUM": F.col("v_is_sig")}
    best = df.groupBy(*keys).agg(*(F.max(F.when(F.col(k).isNotNull(), F.struct(F.coalesce(t, F.lit(False)).alias("sig"), F.col(k).alias("x"), (-F.col(segment)).alias("o")))).alias(k) for k, t in tests.items()), F.count("*").alias("_n"))
    none = F.struct(F.lit(False).alias("sig"), F.lit(0.0).alias("x"), F.lit(0).cast(df.schema[segment].dataType).alias("o"))
    best = best.withColumn("DIFF", F.coalesce("DIFF", F.when(F.col("_n") > 1, none)))
    cols = []
    for k, limits in INDICATORS.items():
        x = F.col(f"{k}.x")
        cols += [x.alias(k), F.when(x.isNull(), -1).when(~F.coalesce(F.col(f"{k}.sig"), F.lit(False)), 0).otherwise(grade(x, limits)).alias(f"lv_{k}")]
    return best.select(*keys, *cols)


def unjudged(structures: DataFrame, reason: Column) -> DataFrame:
    """Records for structures that could not be judged."""
    return structures.select("*", F.lit(-1).alias("level"), F.lit("판정불가").alias("st"), reason.alias("reason"))


def proxy(ends: DataFrame, ring: DataFrame, keys: list[str], years: Column, length: Column, thresholds: tuple[float, float, float] | Column, criteria: Criteria = Criteria(), beta_allow: float | Column = 0.002) -> DataFrame:
    """Judgement from the ground at both ends (keys, end, v, se) against the ring (keys, n_ring, sigma) where the deck has no points."""
    j = ends.join(ring.where(F.col("n_ring") >= 5), keys)
    z = significant(j).withColumn("v", F.round("v", 2))  # significance is told before rounding
    z = displacement(z, years, criteria)
    both = F.count("*") == 2
    tilt = lambda t: F.when(both & F.bool_or("sig"), (F.max("v") - F.min("v")) * F.max(t) / 1000 / F.greatest(F.max(length), F.lit(1.0))).otherwise(0.0)
    out = z.groupBy(*keys).agg(F.max("D").alias("D_now"), F.max("D10").alias("D_10y"), tilt(years).alias("beta_now"), tilt(years + criteria.projection_years).alias("beta_10y"))
    ratio = lambda k: F.greatest(F.col(f"D_{k}") / criteria.settlement_mm, F.col(f"beta_{k}") / beta_allow)
    out = out.withColumns({"r_now": ratio("now"), "r_10y": ratio("10y")})
    return out.withColumns({"level": level(F.col("r_now"), F.col("r_10y"), thresholds), "conf": F.lit("낮음"), "review": F.lit(True), "proxy": F.lit(True)})


def confident(df: DataFrame) -> DataFrame:
    return df.withColumn("conf", confidence(F.col("cover"), F.col("has_ring")))
