"""Acquisition dates: periods, reference dates, calendars, weather at the pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def periods(dates: DataFrame, keys: list[str], date: str = "date", gap_days: int = 365) -> DataFrame:
    """Add ``period`` (from 0): a new one starts after a gap of more than ``gap_days``."""
    w = Window.partitionBy(*keys).orderBy(date)
    jump = F.coalesce((F.datediff(F.col(date), F.lag(date).over(w)) > gap_days).cast("int"), F.lit(0))
    return dates.withColumn("_jump", jump).withColumn("period", F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_jump")


def tracks(dates: DataFrame, keys: list[str], date: str = "date", gap_days: int = 365, least: int = 30) -> DataFrame:
    """keys, period, n_dates, first, last and tag of the periods with enough dates; the tag is empty for a track never split."""
    each = periods(dates.select(*keys, date).distinct(), keys, date, gap_days).groupBy(*keys, "period").agg(F.count("*").alias("n_dates"), F.min(date).alias("first"), F.max(date).alias("last"))
    w = Window.partitionBy(*keys)
    whole = (F.col("period") == 0) & (F.col("last") == F.max("last").over(w))
    return each.withColumn("tag", F.when(whole, "").otherwise(F.concat(F.lit("_"), F.year("first").cast("string")))).where(F.col("n_dates") >= least)


def reference_date(dates: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """keys and the date nearest to the middle of the time span; the first of two equally near."""
    span = dates.groupBy(*keys).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    distance = F.abs(2 * F.datediff(F.col(date), F.col("_a")) - F.datediff(F.col("_b"), F.col("_a")))
    joined = dates.join(span, keys) if keys else dates.crossJoin(F.broadcast(span))  # one row without keys
    return joined.groupBy(*keys).agg(F.min(F.struct(distance.alias("d"), F.col(date).alias("date")))["date"].alias("reference_date"))


def covered_dates(bursts: DataFrame, keys: list[str], date: str, share: float = 0.8) -> DataFrame:
    """keys, date and n of the dates that hold at least ``share`` of the most bursts of any date."""
    n = bursts.groupBy(*keys, date).agg(F.count("*").alias("n"))
    most = n.groupBy(*keys).agg(F.max("n").alias("most"))
    joined = n.join(most, keys) if keys else n.crossJoin(F.broadcast(most))  # one row without keys
    return joined.where(F.col("n") >= share * F.col("most")).drop("most")


def merge_snapshots(snapshots: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Counts of repeated searches merged: the largest seen of each key."""
    return snapshots.groupBy(*keys).agg(F.max(n).alias(n))


def known_dates(scenes: DataFrame, last_results: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Dates that are there as a scene or as the last of a result."""
    return scenes.select(*keys, date).union(last_results.groupBy(*keys).agg(F.max(date).alias(date)).select(*keys, date)).distinct()


def needed_dates(slaves: DataFrame, master: Column, keys: list[str], date: str = "date") -> DataFrame:
    """The slaves' dates and the master's."""
    return slaves.select(*keys, date).union(slaves.select(*keys, master.alias(date))).distinct()


def at_pass(hourly: DataFrame, hour: str, pass_hour: int, values: list[str]) -> DataFrame:
    """The hour of the pass of each day on which all values are known."""
    known = F.lit(True)
    for v in values:
        known = known & F.col(v).isNotNull()
    return hourly.where((F.hour(hour) == pass_hour) & (F.minute(hour) == 0) & known)


def interpolate_pass(hourly: DataFrame, keys: list[str], hour: str, value: str, weight: Column) -> DataFrame:
    """Add ``at_pass``: the value between this hour and the next; null in the last hour."""
    nxt = F.lead(value).over(Window.partitionBy(*keys).orderBy(hour))
    return hourly.withColumn("at_pass", F.col(value) * (1 - weight) + nxt * weight)


def trailing_sum(hourly: DataFrame, keys: list[str], hour: str, value: str, back: int = 24) -> DataFrame:
    """Add ``trailing``: the sum of this hour and ``back`` before it, nulls as 0."""
    w = Window.partitionBy(*keys).orderBy(hour).rowsBetween(-back, 0)
    return hourly.withColumn("trailing", F.sum(F.coalesce(F.col(value), F.lit(0.0))).over(w))


def fill_temperature(dates: DataFrame, weather: DataFrame, keys: list[str], on: list[str], value: str = "temp") -> DataFrame:
    """Left join by ``on``; a missing value becomes the mean of those present for ``keys``. Adds ``dtemp``, the distance from the filled mean."""
    w = Window.partitionBy(*keys)
    out = dates.join(weather, on, "left").withColumn(value, F.coalesce(F.col(value), F.avg(value).over(w)))
    return out.withColumn("dtemp", F.col(value) - F.avg(value).over(w))


def gaps(dates: DataFrame, keys: list[str], date: str, as_of: Column, revisit_days: float = 12.0) -> DataFrame:
    """keys, n_used, n_expected, coverage, max_gap_days, last_date, stale_days and flag. n_expected is rounded for display only."""
    w = Window.partitionBy(*keys).orderBy(date)
    steps = dates.select(*keys, date).distinct().withColumn("_gap", F.datediff(F.col(date), F.lag(date).over(w)))
    out = steps.groupBy(*keys).agg(F.count("*").alias("n_used"), F.coalesce(F.max("_gap"), F.lit(0)).alias("max_gap_days"), F.min(date).alias("_first"), F.max(date).alias("last_date"))
    expected = F.datediff(F.col("last_date"), F.col("_first")) / F.lit(revisit_days) + 1
    out = out.withColumns({"n_expected": F.bround(expected).cast("long"), "coverage": F.col("n_used") / expected, "stale_days": F.datediff(as_of, F.col("last_date"))})
    return out.withColumn("flag", (F.col("coverage") < 0.6) | (F.col("max_gap_days") > 365) | (F.col("stale_days") > 60)).drop("_first")
