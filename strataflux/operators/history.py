"""The log of cycles, judgements and series, and the state that views read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.functions.expr import status_label

JUDGEMENT = ["cycle", "bridge", "name", "track", "level", "status", "r_now", "r_10y", "d_now_mm", "n_ps", "conf", "review", "proxy", "last_date"]


def cycle_numbers(runs: DataFrame, run_time: str) -> DataFrame:
    """run_time and cycle, from 1 in order of time: a row for each run, so one task orders them."""
    return runs.select(run_time).distinct().withColumn("cycle", F.row_number().over(Window.orderBy(run_time)))


def append_cycle(cycles: DataFrame, judgements: DataFrame, run_time: Column, best: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cycle's row and its judgements (with the columns of :data:`JUDGEMENT`) to append; what is logged is never changed."""
    number = cycles.agg((F.coalesce(F.max("cycle"), F.lit(0)) + 1).alias("cycle"))
    rows = best.drop("cycle").crossJoin(F.broadcast(number)).withColumn("status", status_label(F.col("level")))  # one row
    return number.withColumn("run_time", run_time), rows.select(*(c for c in JUDGEMENT if c in rows.columns))


def latest(cycles: DataFrame, n: int = 2) -> DataFrame:
    """The last ``n`` cycles, newest first."""
    return cycles.orderBy(F.desc("cycle")).limit(n)


def changes(judgements: DataFrame, cycles: DataFrame) -> DataFrame:
    """Judgements of the last cycle with ``prev``, the level in the one before; all nulls in a first cycle."""
    last = latest(cycles).agg(F.max("cycle").alias("_now"), F.when(F.count("*") == 2, F.min("cycle")).alias("_before"))
    both = judgements.crossJoin(F.broadcast(last))  # one row
    before = both.where(F.col("cycle") == F.col("_before")).select("bridge", F.col("level").alias("prev"))
    return both.where(F.col("cycle") == F.col("_now")).drop("_now", "_before").join(before, "bridge", "left")


def known_structures(results: DataFrame, structures: DataFrame) -> DataFrame:
    """Results of structures that are still registered: by id, else by name and place to four decimals, of equal ones the last id. Adds the registered id."""
    place = lambda df: [F.round(df[c], 4) for c in ("lat", "lon")]
    named = structures.groupBy(F.col("name").alias("_n"), *(c.alias(k) for c, k in zip(place(structures), ("_lat", "_lon")))).agg(F.max("bridge").alias("_id"))
    own = results.join(structures.select("bridge"), "bridge", "left_semi")
    rest = results.join(structures.select("bridge"), "bridge", "left_anti")
    lat, lon = place(rest)
    found = rest.join(named, (rest["name"] == F.col("_n")) & (lat == F.col("_lat")) & (lon == F.col("_lon")))
    return own.unionByName(found.withColumn("bridge", F.col("_id")).drop("_id", "_n", "_lat", "_lon"))


def state(structures: DataFrame, results: DataFrame) -> DataFrame:
    """Every registered structure, with its result where it has one."""
    return structures.join(results, "bridge", "left").withColumn("status", status_label(F.col("level")))


def summary(rows: DataFrame, alerts: DataFrame, events: DataFrame) -> DataFrame:
    """One row: n, n_judged, counts by status (a map), n_alerts and n_errors."""
    by = rows.groupBy("status").agg(F.count("*").alias("k"), F.count_if(F.col("level") >= 0).alias("j"))
    counts = by.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.coalesce(F.sum("j"), F.lit(0)).alias("n_judged"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "k")))).alias("counts"))  # a row for each status
    errors = events.agg(F.count_if(F.col("level").isin("경고", "주의")).alias("n_errors"))
    return counts.crossJoin(alerts.agg(F.count("*").alias("n_alerts"))).crossJoin(errors)  # one row each


def by_tracks(results: DataFrame) -> DataFrame:
    """bridge and its tracks in order: an array of (track, level, n_ps, proxy, r_now)."""
    return results.groupBy("bridge").agg(F.array_sort(F.collect_list(F.struct("track", "level", "n_ps", "proxy", "r_now"))).alias("tracks"))


# The Korean texts below are those of the reports.


def segment_label(start: Column, length: float = 15.0) -> Column:
    """Text of a segment on the deck's axis."""
    metres = lambda x: F.format_string("%+.0f", F.bround(x))
    return F.concat(F.lit("교축 "), metres(start), F.lit("~"), metres(start + length), F.lit(" m 구간"))


def gap_text(used: Column, expected: Column, longest: Column, stale: Column) -> Column:
    return F.format_string("자료 공백: 사용 %s/%s장, 최장 공백 %s일, 최근 영상 %s일 전", used, expected, longest, stale)


def alert_lines(alerts: DataFrame) -> DataFrame:
    """Alerts with ``line``: kind, name, status, displacement, share of what is allowed with its band, and what makes it uncertain."""
    share = lambda c: F.format_string("%d", F.bround(100 * F.coalesce(F.col(c), F.lit(0.0))).cast("int"))
    band = F.when(F.col("r_lo").isNotNull(), F.concat(F.lit(" (범위 "), share("r_lo"), F.lit("–"), share("r_hi"), F.lit(" %)"))).otherwise("")
    doubts = F.concat_ws(
        " · ", F.when(F.col("uncertain"), "오차 범위가 등급 경계를 넘음"), F.when(F.col("gap"), gap_text(F.col("n_used"), F.col("n_expected"), F.col("max_gap_days"), F.col("stale_days"))),
        F.when(F.col("thermal_mm") != 0, F.concat(F.lit("온도 보정 영향 "), F.col("thermal_mm").cast("string"), F.lit(" mm (ERA5 기온)"))),
    )
    head = F.concat(F.lit("- **["), F.col("kind"), F.lit("] "), F.col("name"), F.lit("** — "), status_label(F.col("level")), F.lit("\n  누적 수직변위 "), F.col("d_now").cast("string"), F.lit(" mm, 허용변위 대비 "), share("r_now"), F.lit(" %"), band, F.lit(" (10년 예측 "), share("r_10y"), F.lit(" %)"))
    return alerts.withColumn("line", F.concat(head, F.when(doubts != "", F.concat(F.lit("\n  불확실성: "), doubts)).otherwise("")))
