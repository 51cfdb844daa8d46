"""Results of a cycle: best track, history, alerts, health and the views of the read API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.functions.expr import status_label


def with_fallback(left: DataFrame, right: DataFrame, key: str, fallback: list[str]) -> DataFrame:
    """Rows of ``left`` with ``right`` by ``key``; those without a match by ``fallback``. Adds ``matched_by``."""
    r = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    first = left.join(r, left[key] == r[f"r_{key}"], "inner").withColumn("matched_by", F.lit("key"))
    rest = left.join(right.select(key), key, "left_anti")
    on = [F.col(k) == F.col(f"r_{k}") for k in fallback]
    second = rest.join(r, on, "left").withColumn("matched_by", F.when(F.col(f"r_{key}").isNotNull(), "fallback"))
    return first.unionByName(second)


def best_track(results: DataFrame, structure: str, track_order: str) -> DataFrame:
    """One row a structure: judged over not, own points over proxies, then confidence, points, coverage; then the first track."""
    rank = F.when(F.col("conf") == "높음", 2).when(F.col("conf") == "보통", 1).otherwise(0)
    judged = F.col("level") >= 0
    score = F.struct(judged.alias("j"), (judged & ~F.col("proxy")).alias("p"), rank.alias("c"), F.col("n_ps").alias("n"), F.col("cover").alias("k"), (-F.col(track_order)).alias("o"))
    w = Window.partitionBy(structure).orderBy(score.desc())
    return results.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def agreement(results: DataFrame, structure: str) -> DataFrame:
    """structure, n_tracks and agree: whether all judged tracks have one level; null below two."""
    j = results.where(F.col("level") >= 0).groupBy(structure).agg(F.count("*").alias("n_tracks"), F.count_distinct("level").alias("_l"))
    return j.select(structure, "n_tracks", F.when(F.col("n_tracks") >= 2, F.col("_l") <= 1).alias("agree"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The last version of each key."""
    both = old.unionByName(new)
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(version)))).where("_r = 1").drop("_r")


def replace_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Whole keys replaced by what ``new`` has for them."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def previous(history: DataFrame, structure: str, cycle: str, level: str) -> DataFrame:
    """History with the level in the run's cycle before; null for what that cycle lacks. There is a row for each cycle to order, however many structures."""
    cycles = history.select(cycle).distinct().withColumn("_before", F.lag(cycle).over(Window.orderBy(cycle)))
    before = history.select(structure, F.col(cycle).alias("_before"), F.col(level).alias("prev"))
    return history.join(F.broadcast(cycles), cycle, "left").join(before, [structure, "_before"], "left").drop("_before")


def alert_kind(level: Column, prev: Column, review: Column) -> Column:
    return F.when(review, "확인 필요").when(prev.isNull() | (prev < 2), "신규 경보").when(level > prev, "등급 상승").otherwise("지속")


def alerts(current: DataFrame, structure: str) -> DataFrame:
    """Rows of level 2 or more with their kind, most urgent first."""
    out = current.where(F.col("level") >= 2).withColumn("kind", alert_kind(F.col("level"), F.col("prev"), F.col("review")))
    order = F.when(F.col("kind") == "신규 경보", 0).when(F.col("kind") == "등급 상승", 1).when(F.col("kind") == "확인 필요", 2).otherwise(3)
    return out.withColumn("ord", order).orderBy("ord", F.desc(F.coalesce("r_now", F.lit(0.0))), structure)


def alert_text(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("line", F.concat_ws(" ", F.lit("-"), F.concat(F.lit("["), F.col("kind"), F.lit("]")), F.col("name"), status_label(F.col("level")), F.format_string("(%.2f)", F.coalesce("r_now", F.lit(0.0)))))


def stale_tracks(last_dates: DataFrame, track: str, as_of: Column, days: int = 24) -> DataFrame:
    """Health events of tracks without a recent date; those with an end are not expected to have one."""
    age = F.datediff(as_of, F.col("last_date"))
    out = last_dates.withColumn("age", age).where(F.col("last_date").isNull() | ((F.col("age") > days) & F.col("end").isNull()))
    return out.select(F.when(F.col("last_date").isNull(), "주의").otherwise("경고").alias("level"), F.lit("data").alias("kind"), F.col(track).alias("track"), F.coalesce(F.format_string("%d days without a new date", F.col("age")), F.lit("no data")).alias("msg"))


def log_errors(logs: DataFrame, track: str, text: str = "text", tail: int = 200_000) -> DataFrame:
    """Health events from the tails of logs: errors, and fatal ends."""
    t = F.substring(F.col(text), -tail, tail)
    n = F.regexp_count(t, F.lit("Traceback|ERROR"))
    fatal = t.contains("FATAL")
    return logs.withColumn("n", n).withColumn("fatal", fatal).where((F.col("n") > 0) | F.col("fatal")).select(F.when(F.col("fatal"), "경고").otherwise("주의").alias("level"), F.lit("log").alias("kind"), F.col(track).alias("track"), F.format_string("%d errors", F.col("n")).alias("msg"))


def failed_tiles(tiles: DataFrame, track: str) -> DataFrame:
    bad = tiles.where(F.col("status") != "OK").groupBy(track, "status").agg(F.count("*").alias("n"))
    return bad.select(F.lit("주의").alias("level"), F.lit("tiles").alias("kind"), F.col(track).alias("track"), F.format_string("%s: %d", F.col("status"), F.col("n")).alias("msg"))


def low_disk(free_gb: DataFrame, least_gb: float) -> DataFrame:
    return free_gb.where(F.col("gb") < least_gb).select(F.lit("경고").alias("level"), F.lit("disk").alias("kind"), F.lit(None).cast("string").alias("track"), F.format_string("%s %.0f GB", F.col("disk"), F.col("gb")).alias("msg"))


def weak_structures(results: DataFrame, tiles: DataFrame, done: DataFrame, structure: str, tile: str) -> DataFrame:
    """Structures for a second pass, in its order: weak results of sound tiles that have had none."""
    weak = (F.col("n_ps") < 5) | (F.col("cover") < 0.25) | F.col("proxy")
    out = results.where(weak).join(tiles.where(F.col("status") == "OK").select(tile), tile, "left_semi").join(done.select(structure), structure, "left_anti")
    rank = F.when(F.col("class") == "1종", 0).when(F.col("class") == "2종", 1).when(F.col("class") == "3종", 2).otherwise(3)
    return out.withColumn("rank", rank).orderBy("rank", F.desc("length"), tile, structure)


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy(status_label(F.col("level")).alias("status")).agg(F.count("*").alias("n"))


def listing(results: DataFrame, structure: str, city: str | None = None, grade: int | None = None, name: str | None = None, limit: int = 400) -> DataFrame:
    """The first rows of the list view, worst first, under optional filters."""
    df = results
    if city:
        df = df.where(F.col("city") == city)
    if grade is not None:
        df = df.where(F.col("level") == grade)
    if name:
        df = df.where(F.col("name").contains(name))
    return df.orderBy(F.desc(F.coalesce("level", F.lit(-2))), F.desc(F.coalesce("r_now", F.lit(0.0))), structure).limit(limit)


def series_view(series: DataFrame, structure: str, wanted: str | int | None = None) -> DataFrame:
    """structure, track, kind and the ordered series of (date, value)."""
    df = series if wanted is None else series.where(F.col(structure) == wanted)
    return df.groupBy(structure, "track", "kind").agg(F.sort_array(F.collect_list(F.struct("date", "value"))).alias("points"))


def fill_axis(series: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """keys and the values on the axis of all dates, nulls where one has none. The axis is one row, as long as there are dates."""
    axis = series.agg(F.array_sort(F.collect_set(date)).alias("_axis"))
    each = series.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(date, value))).alias("_m"))
    return each.crossJoin(F.broadcast(axis)).select(*keys, F.transform("_axis", lambda d: F.try_element_at("_m", d)).alias("values"))
