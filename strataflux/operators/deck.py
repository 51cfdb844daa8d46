"""Deck geometry and series along a deck."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataflux.functions.expr import bearing, local_x, local_y


def axes(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """keys, centre, unit axis (ax, ay), bearing and extents of the vertices (x, y): the first principal axis in closed form, turned north.

    The centre is in the middle of the vertices' range along and across the axis; extent_s and extent_c are these ranges.
    """
    m = vertices.groupBy(*keys).agg(F.var_pop("x").alias("_xx"), F.var_pop("y").alias("_yy"), F.covar_pop("x", "y").alias("_xy"))
    angle = F.atan2(2 * F.col("_xy"), F.col("_xx") - F.col("_yy")) / 2
    turn = F.when(F.sin(angle) < 0, -1.0).otherwise(1.0)
    m = m.select(*keys, (F.cos(angle) * turn).alias("ax"), (F.sin(angle) * turn).alias("ay"))
    s, c = F.col("x") * F.col("ax") + F.col("y") * F.col("ay"), F.col("y") * F.col("ax") - F.col("x") * F.col("ay")
    ends = vertices.join(m, keys).groupBy(*keys, "ax", "ay").agg(*(f(x).alias(n) for n, f, x in (("_s0", F.min, s), ("_s1", F.max, s), ("_c0", F.min, c), ("_c1", F.max, c))))
    mid_s, mid_c = (F.col("_s0") + F.col("_s1")) / 2, (F.col("_c0") + F.col("_c1")) / 2
    out = ends.select(*keys, (mid_s * F.col("ax") - mid_c * F.col("ay")).alias("x0"), (mid_s * F.col("ay") + mid_c * F.col("ax")).alias("y0"), "ax", "ay", (F.col("_s1") - F.col("_s0")).alias("extent_s"), (F.col("_c1") - F.col("_c0")).alias("extent_c"))
    return out.withColumn("bearing", bearing(F.col("ax"), F.col("ay")))


def to_local(points: DataFrame, lon0: Column, lat0: Column) -> DataFrame:
    return points.withColumns({"x": local_x(F.col("lon"), lon0, lat0), "y": local_y(F.col("lat"), lat0)})


def along_across(points: DataFrame) -> DataFrame:
    """Add s along and c across the axis of the joined deck."""
    dx, dy = F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    return points.withColumns({"s": dx * F.col("ax") + dy * F.col("ay"), "c": -dx * F.col("ay") + dy * F.col("ax")})


def deck_size(extent_s: Column, extent_c: Column, length: Column, width: Column, polygon: Column | None = None) -> tuple[Column, Column]:
    """Length and width: a registry width that is missing or 0 is 10 m; polygons have the width of their vertices; 6 to 40 m in all."""
    wide = F.coalesce(F.nullif(width, F.lit(0.0)), F.lit(10.0)) + extent_c
    if polygon is not None:
        wide = F.when(polygon, extent_c).otherwise(wide)
    return F.greatest(extent_s, length), F.least(F.greatest(wide, F.lit(6.0)), F.lit(40.0))


def on_deck(s: Column, c: Column, length: Column, width: Column) -> Column:
    return (F.abs(c) <= width / 2 + 6) & (F.abs(s) <= length / 2 + 3)


def nodes_of(points: DataFrame, s: str, half: Column, step: float = 3.0, reach: float = 3.0) -> DataFrame:
    """A row for each node (at -half, -half + step, ...) within ``reach`` of the point: an equi join on the node's number takes the place of a band join."""
    last = F.floor(2 * half / step + 1e-9)
    lo = F.greatest(F.ceil((F.col(s) + half - reach) / step), F.lit(0))
    hi = F.least(F.floor((F.col(s) + half + reach) / step), last)
    return points.withColumn("node", F.explode(F.when(lo <= hi, F.sequence(lo, hi)))).withColumn("node_s", F.col("node") * step - half)


def node_series(points: DataFrame, keys: list[str], node: str, date: str, value: str) -> DataFrame:
    return points.groupBy(*keys, node, date).agg(F.median(value).alias("y"), F.count(value).alias("n_points"))


def zone_series(nodes: DataFrame, keys: list[str], zone: str, date: str, value: str = "y") -> DataFrame:
    return nodes.groupBy(*keys, zone, date).agg(F.avg(value).alias("y"), F.count(value).alias("n_nodes"))


def segment_of(s: Column, half: Column, length: float = 15.0) -> Column:
    """Number of the segment, from 0; null at the very end of a deck of whole segments, as segments begin before it only."""
    k = F.floor((s + half) / length)
    return F.when(k * length < 2 * half, k).cast("int")


def supports(decks: DataFrame, half: Column, span: Column) -> DataFrame:
    """A row for each support (number and place): every span from one end; both ends of a deck shorter than a span."""
    n = F.floor(2 * half / span + 1e-9)
    places = F.when(n >= 1, F.transform(F.sequence(F.lit(0), n), lambda k: k * span - half)).otherwise(F.array(-half, half))
    return decks.select("*", F.posexplode(places).alias("zone", "zone_s"))


def complete(series: DataFrame, keys: list[str], value: str, n_dates: Column) -> DataFrame:
    """keys whose series has a value on every date."""
    return series.groupBy(*keys).agg(F.count(value).alias("_n"), F.max(n_dates).alias("_d")).where(F.col("_n") == F.col("_d")).select(*keys)
