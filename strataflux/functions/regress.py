"""Least squares by moments: one aggregation, then elimination in expressions.

Moments of partial aggregates add up, so a regression of any length needs a single shuffle by its keys and never
gathers a series. The last regressor's pivot gives the variance of its coefficient.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def elimination(k: int) -> list[dict[str, str]]:
    """Stages of SQL expressions from moments g_ij (i <= j), r_i to coefficients c_i; ``last_g`` belongs to the last one.

    A singular system has null coefficients.
    """
    g = {(i, j): f"g_{i}_{j}" for i in range(k) for j in range(i, k)}
    r = {i: f"r_{i}" for i in range(k)}
    stages = []
    for p in range(k - 1):
        stage, ng, nr = {}, dict(g), dict(r)
        for i in range(p + 1, k):
            factor = f"{g[p, i]} / nullif({g[p, p]}, 0)"
            for j in range(i, k):
                ng[i, j] = f"g{p}_{i}_{j}"
                stage[ng[i, j]] = f"{g[i, j]} - {factor} * {g[p, j]}"
            nr[i] = f"r{p}_{i}"
            stage[nr[i]] = f"{r[i]} - {factor} * {r[p]}"
        g, r = ng, nr
        stages.append(stage)
    stages.append({"last_g": g[k - 1, k - 1]})
    for i in reversed(range(k)):
        known = "".join(f" - {g[i, j]} * c_{j}" for j in range(i + 1, k))
        stages.append({f"c_{i}": f"({r[i]}{known}) / nullif({g[i, i]}, 0)"})
    return stages


def least_squares(df: DataFrame, keys: list[str], y: str, regressors: list[Column]) -> DataFrame:
    """keys, n, yy, c_0.., last_g, sse and rms: coefficients of ``regressors``, the first of which is the constant 1; rows with a null value do not count.

    What involves y is summed about its mean (Spark's covariances merge without cancellation), so that a large offset of y
    costs no digits of the residuals; yy is the sum of squares about the mean.
    """
    k = len(regressors) - 1
    rows = df.select(*keys, F.col(y).cast("double").alias("y"), *(x.cast("double").alias(f"x_{i}") for i, x in enumerate(regressors))).dropna(subset=["y", *(f"x_{i}" for i in range(k))])
    n = F.col("n")
    aggs = [F.count("*").alias("n"), F.avg("y").alias("_y"), F.var_pop("y").alias("yy")]
    aggs += [F.sum(f"x_{i}").alias(f"_s_{i}") for i in range(1, k + 1)] + [F.covar_pop(f"x_{i}", "y").alias(f"r_{i - 1}") for i in range(1, k + 1)]
    aggs += [F.sum(F.col(f"x_{i}") * F.col(f"x_{j}")).alias(f"g_{i - 1}_{j - 1}") for i in range(1, k + 1) for j in range(i, k + 1)]
    out = rows.groupBy(*keys).agg(*aggs)
    centred = {f"g_{i}_{j}": F.col(f"g_{i}_{j}") - F.col(f"_s_{i + 1}") * F.col(f"_s_{j + 1}") / n for i in range(k) for j in range(i, k)}
    out = out.withColumns(centred | {f"r_{i}": F.col(f"r_{i}") * n for i in range(k)} | {"yy": F.col("yy") * n})
    for stage in elimination(k):
        out = out.withColumns({name: F.expr(e) for name, e in stage.items()})
    fitted = sum((F.col(f"c_{i}") * F.col(f"r_{i}") for i in range(1, k)), F.col("c_0") * F.col("r_0"))
    constant = F.col("_y") - sum((F.col(f"c_{i}") * F.col(f"_s_{i + 1}") for i in range(1, k)), F.col("c_0") * F.col("_s_1")) / n
    out = out.withColumn("sse", F.greatest(F.col("yy") - fitted, F.lit(0.0)))
    return out.select(*keys, "n", "yy", constant.alias("c_0"), *(F.col(f"c_{i}").alias(f"c_{i + 1}") for i in range(k)), "last_g", "sse", F.sqrt(F.col("sse") / n).alias("rms"))


def seasonal(t: str = "t") -> list[Column]:
    """Constant, annual sine and cosine, and last the trend."""
    year = F.col(t) * (2 * math.pi)
    return [F.lit(1.0), F.sin(year), F.cos(year), F.col(t)]


def velocity(df: DataFrame, keys: list[str], y: str, t: str = "t", least: int = 12) -> DataFrame:
    """keys, n, v and se (per year), amplitude of the annual term, and rms; null below ``least`` observations."""
    fit = least_squares(df, keys, y, seasonal(t))
    ok = F.col("n") >= least
    variance = F.col("sse") / F.greatest(F.col("n") - 4, F.lit(1))
    return fit.select(
        *keys, "n",
        F.when(ok, F.col("c_3")).alias("v"),
        F.when(ok, F.sqrt(variance / F.nullif(F.col("last_g"), F.lit(0.0)))).alias("se"),
        F.when(ok, F.hypot("c_1", "c_2")).alias("amplitude"),
        F.when(ok, F.col("rms")).alias("rms"),
    )


def stability(df: DataFrame, keys: list[str], y: str, t: str = "t") -> DataFrame:
    """keys and the deviation of the values about their seasonal fit's trend: by moments, as the spread of y - v t needs no second pass."""
    v = least_squares(df, keys, y, seasonal(t)).select(*keys, F.col("c_3").alias("_v"))
    m = df.groupBy(*keys).agg(F.var_pop(y).alias("_yy"), F.covar_pop(t, y).alias("_ty"), F.var_pop(t).alias("_tt")).join(v, keys)
    spread = F.col("_yy") - 2 * F.col("_v") * F.col("_ty") + F.col("_v") * F.col("_v") * F.col("_tt")
    return m.select(*keys, F.sqrt(F.greatest(spread, F.lit(0.0))).alias("stability"))


def thermal(df: DataFrame, keys: list[str], y: str, t: str = "t", dtemp: str = "dtemp") -> DataFrame:
    """keys and k, the change per degree, from constant, trend and temperature."""
    return least_squares(df, keys, y, [F.lit(1.0), F.col(t), F.col(dtemp)]).select(*keys, F.col("c_2").alias("k"))


def robust_scale(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, mid and scale: the median and 1.4826 times the median distance from it."""
    mid = df.groupBy(*keys).agg(F.median(value).alias("mid"))
    return df.join(mid, keys).groupBy(*keys).agg(F.first("mid").alias("mid"), (F.median(F.abs(F.col(value) - F.col("mid"))) * 1.4826).alias("scale"))


def ols_sql(table: str, keys: str, y: str, regressors: list[str]) -> str:
    """The same regression as SQL text for another engine: keys, n, yy, r_i, c_i, last_g."""
    k = len(regressors)
    moments = [f"sum(({regressors[i]}) * ({regressors[j]})) AS g_{i}_{j}" for i in range(k) for j in range(i, k)] + [f"sum(({x}) * ({y})) AS r_{i}" for i, x in enumerate(regressors)]
    out = f"SELECT {keys}, count(*) AS n, sum(({y}) * ({y})) AS yy, {', '.join(moments)} FROM {table} GROUP BY {keys}"
    for stage in elimination(k):
        out = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in stage.items())} FROM ({out})"
    return out
