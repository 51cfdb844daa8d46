"""Quality control of series: reference cluster, dates to keep, re-referencing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.functions import regress
from strataflux.functions.expr import mm_to_phase
from strataflux.operators.spatial import avoid, densest_cluster, radius_join

LADDER = (0.95, 0.92, 0.90, 0.85, 0.80)


def reference_candidates(points: DataFrame, vertices: DataFrame, keys: list[str], coherence: str, ring: tuple[float, float], away: float = 100.0, ladder: tuple[float, ...] = LADDER) -> tuple[DataFrame, DataFrame]:
    """Points that may be of the reference, and keys with the rung: the first of the coherence ladder that has candidates.

    All rungs are found in one pass: a candidate counts for each rung it reaches.
    """
    r = F.hypot("x", "y")
    free = avoid(points.where((r >= ring[0]) & (r <= ring[1]) & (F.col(coherence) >= min(ladder))), vertices, away)
    rung = F.lit(len(ladder))
    for k, least in reversed(list(enumerate(ladder))):
        rung = F.when(F.col(coherence) >= least, k).otherwise(rung)
    first = free.withColumn("rung", rung).groupBy(*keys).agg(F.min("rung").alias("rung"))
    return free.join(first, keys).where(F.col(coherence) >= F.element_at(F.array(*map(F.lit, ladder)), F.col("rung") + 1)), first


def reference_cluster(points: DataFrame, vertices: DataFrame, keys: list[str], key: str, coherence: str, ring: tuple[float, float], away: float = 100.0, radius: float = 50.0, ladder: tuple[float, ...] = LADDER) -> DataFrame:
    """keys, rung and the densest cluster at the first rung of the coherence ladder that has candidates."""
    chosen, first = reference_candidates(points, vertices, keys, coherence, ring, away, ladder)
    return densest_cluster(chosen, radius, key, coherence, keys).join(first, keys)


def cluster_members(candidates: DataFrame, cluster: DataFrame, keys: list[str], key: str, radius: float = 50.0) -> DataFrame:
    """keys and ``key`` of the candidates within ``radius`` of their cluster's centre, itself included."""
    centre = cluster.join(candidates.select(*keys, F.col(key).alias("centre"), "x", "y"), [*keys, "centre"]).select(*keys, "x", "y")
    return radius_join(candidates.select(*keys, key, "x", "y"), centre, radius, how="left_semi", on=keys).select(*keys, key)


def reference_coherence(series: DataFrame, members: DataFrame, keys: list[str], key: str, date: str, value: str = "y", t: str = "t") -> DataFrame:
    """keys, date, n and gamma: how well the cluster's members agree on a date, as the length of the mean phasor of their residuals about trend and season.

    What all members share cancels in the length, so gamma measures agreement within the cluster.
    """
    own = series.join(members, [*keys, key], "left_semi").where(F.col(value).isNotNull())
    fit = regress.least_squares(own, [*keys, key], value, regress.seasonal(t)).select(*keys, key, *(f"c_{k}" for k in range(4)))
    model = sum((F.col(f"c_{k}") * x for k, x in enumerate(regress.seasonal(t))), F.lit(0.0))
    residual = own.join(fit, [*keys, key]).withColumn("_phase", mm_to_phase(F.col(value) - model))
    return date_coherence(residual, [*keys, date], "_phase")


def date_coherence(phases: DataFrame, keys: list[str], phase: str) -> DataFrame:
    """keys (with the date), n and gamma, the length of the mean phasor."""
    return phases.groupBy(*keys).agg(F.count("*").alias("n"), F.hypot(F.avg(F.cos(phase)), F.avg(F.sin(phase))).alias("gamma"))


def keep_dates(dates: DataFrame, keys: list[str], master: Column, bmax: float = 200.0, gmin: float | Column = 0.95) -> DataFrame:
    """Dates whose baseline and coherence hold, and the master; adds the master of each key, the first kept date if the master is missing."""
    ok = (F.abs(F.coalesce(F.col("bperp"), F.lit(0.0))) <= bmax) & (F.col("gamma") >= gmin)
    kept = dates.where(ok | (F.col("date") == master))
    w = Window.partitionBy(*keys)
    return kept.withColumn("master", F.coalesce(F.max(F.when(F.col("date") == master, F.col("date"))).over(w), F.min("date").over(w)))


def rung_value(rung: Column, ladder: tuple[float, ...] = LADDER) -> Column:
    """The coherence that a rung of the ladder asks of points, and of dates."""
    return F.element_at(F.array(*map(F.lit, ladder)), rung + 1)


def date_summary(dates: DataFrame, keys: list[str], bmax: float = 200.0, gmin: float | Column = 0.95) -> DataFrame:
    """keys, n_dates, n_kept, drop_bperp, drop_refcoh and refcoh_median of dates with bperp (missing is 0) and gamma."""
    far, loose = F.abs(F.coalesce(F.col("bperp"), F.lit(0.0))) > bmax, F.col("gamma") < gmin
    return dates.groupBy(*keys).agg(F.count("*").alias("n_dates"), F.count_if(~far & ~loose).alias("n_kept"), F.count_if(far).alias("drop_bperp"), F.count_if(loose).alias("drop_refcoh"), F.median("gamma").alias("refcoh_median"))


def rereference(series: DataFrame, keys: list[str], point: str, date: str, value: str, near: str, master: Column, least: int = 3) -> DataFrame:
    """Series less the mean of the reference points of each date, then less their own value at the master; a chain with fewer than ``least`` reference points stays as it is.

    Sums of the reference points by date are joined back, so no date or chain is gathered.
    """
    ref = series.where(F.col(near))
    enough = ref.select(*keys, point).distinct().groupBy(*keys).agg((F.count("*") >= least).alias("_enough"))
    middle = ref.groupBy(*keys, date).agg(F.avg(value).alias("_m"))
    out = series.join(enough, keys, "left") if keys else series.crossJoin(F.broadcast(enough))  # without keys a row
    out = out.join(middle, [*keys, date], "left").withColumn("_c", F.col(value) - F.col("_m"))
    at_master = out.where(F.col(date) == master).groupBy(*keys, point).agg(F.max("_c").alias("_at"))
    out = out.join(at_master, [*keys, point], "left")
    return out.select(*(F.when(F.col("_enough"), F.col("_c") - F.col("_at")).otherwise(F.col(value)).alias(c) if c == value else c for c in series.columns))


def rereference_baselines(pairs: DataFrame, keys: list[str], master: Column, ref: str = "ref", sec: str = "sec", b: str = "bperp") -> DataFrame:
    """keys, date, bperp against ``master``, of the dates that the commonest reference is paired with, and of itself.

    A pair stored reversed has the other sign and counts where the straight one is missing; a master without a pair counts as 0.
    """
    common = pairs.groupBy(*keys, ref).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max(F.struct("n", F.col(ref).alias("r")))["r"].alias("common"))
    tagged = pairs.join(common, keys)
    straight = tagged.where(F.col(ref) == F.col("common")).select(*keys, F.col(sec).alias("date"), F.col(b).alias("b"), F.lit(None).alias("turned"), "common")
    turned = tagged.where(F.col(sec) == F.col("common")).select(*keys, F.col(ref).alias("date"), F.lit(None).alias("b"), (-F.col(b)).alias("turned"), "common")
    itself = common.select(*keys, F.col("common").alias("date"), F.lit(0.0).alias("b"), F.lit(None).alias("turned"), "common")
    each = straight.unionByName(turned).unionByName(itself).groupBy(*keys, "date", "common").agg(F.min("b").alias("b"), F.min("turned").alias("turned"))
    each = each.select(*keys, "date", F.when(F.col("date") == F.col("common"), 0.0).otherwise(F.coalesce("b", "turned")).alias("b"))
    at_master = F.coalesce(F.max(F.when(F.col("date") == master, F.col("b"))).over(Window.partitionBy(*keys)), F.lit(0.0))
    return each.select(*keys, "date", (F.coalesce("b", F.lit(0.0)) - at_master).alias("bperp"))


def align_axes(a: DataFrame, b: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """keys and ``missing``: dates of ``a`` that ``b`` lacks; series may be merged where it is 0."""
    return a.select(*keys, date).distinct().join(b.select(*keys, date).distinct().withColumn("_has", F.lit(1)), [*keys, date], "left").groupBy(*keys).agg(F.count_if(F.col("_has").isNull()).alias("missing"))
