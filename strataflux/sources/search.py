"""Searches over catalogues of scenes and bursts: an area, a time and a track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataflux.operators import timeline


def meets(W: Column, S: Column, E: Column, N: Column, area: DataFrame) -> list[Column]:
    """Conditions of two boxes that meet; touching counts."""
    return [W <= area["E"], E >= area["W"], S <= area["N"], N >= area["S"]]


def scenes(catalogue: DataFrame, area: DataFrame, start: str, end: str | None = None, cell: float = 1.0) -> DataFrame:
    """Rows of ``catalogue`` (W, S, E, N, start_time, ...) that meet a box of ``area`` and began in [start, end].

    The time is a plain comparison that reaches the scan. The place is an equi semi join: a scene stands in the cell of its south-west corner, and a box
    of the area in all cells from which a scene of the catalogue's largest extents can reach it, so a scene meets every box it may
    overlap in one cell and no nested loop is planned. A row comes once, however many boxes it meets.
    """
    found = catalogue.where(F.col("start_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        found = found.where(F.col("start_time") < F.date_add(F.lit(end).cast("date"), 1))
    most = found.agg(F.max(F.col("E") - F.col("W")).alias("_dx"), F.max(F.col("N") - F.col("S")).alias("_dy"))
    boxes = area.select(*(F.col(c).alias(c) for c in ("W", "S", "E", "N"))).crossJoin(F.broadcast(most)).where("_dx is not null")  # one row
    steps = lambda lo, hi: F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell)))
    boxes = boxes.withColumn("_i", steps(F.col("W") - F.col("_dx"), F.col("E"))).withColumn("_j", steps(F.col("S") - F.col("_dy"), F.col("N")))
    placed = found.withColumns({"_ci": F.floor(F.col("W") / cell), "_cj": F.floor(F.col("S") / cell)})
    near = [placed["_ci"] == boxes["_i"], placed["_cj"] == boxes["_j"]]
    return placed.join(boxes, near + meets(placed["W"], placed["S"], placed["E"], placed["N"], boxes), "left_semi").drop("_ci", "_cj")


def tracks(found: DataFrame, least: int = 30, gap_days: int = 365) -> DataFrame:
    """direction, path, period, n_dates, first, last, tag, utc (time of the first pass) and reference_date of each period of a track."""
    keys = ["direction", "path"]
    dates = found.select(*keys, F.to_date("start_time").alias("date"))
    utc = found.groupBy(*keys).agg(F.date_format(F.min("start_time"), "HH:mm").alias("utc"))
    split = timeline.periods(dates.distinct(), keys, "date", gap_days)
    reference = timeline.reference_date(split, [*keys, "period"])
    return timeline.tracks(dates, keys, "date", gap_days, least).join(reference, [*keys, "period"]).join(utc, keys)


def bursts(catalogue: DataFrame, area: DataFrame, path: int, date: str) -> DataFrame:
    """Bursts of one path and day over an area."""
    return scenes(catalogue.where(F.col("path") == path), area, date, date)


def available_dates(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Dates that nearly all bursts cover, from repeated searches (attempt, date, keys): an incomplete answer never lowers a count."""
    counts = attempts.groupBy(*keys, "attempt", "date").agg(F.count("*").alias("n"))
    n = timeline.merge_snapshots(counts, [*keys, "date"])
    most = n.groupBy(*keys).agg(F.max("n").alias("most"))
    return n.join(most, keys).where(F.col("n") >= 0.8 * F.col("most")).select(*keys, "date", "n")


def weather_cell(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The quarter-degree cell of a place; halves go to the even cell."""
    return F.bround(lat * 4) / 4, F.bround(lon * 4) / 4
