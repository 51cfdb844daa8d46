"""What an operator of the monitoring does, as functions over tables: set up, update, report, check, status.

Each is made of the operators; none starts a process or holds state. Tables of a set-up are small (structures, tiles, tracks); series stay in
the incremental store (:class:`~strataflux.streaming.increment.Increments`).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from strataflux.functions.expr import status_label
from strataflux.operators import documents, registry, results
from strataflux.sources import search
from strataflux.streaming.increment import Increments


@dataclass(frozen=True)
class Setup:
    structures: DataFrame  # rows of the register, with their tile
    tiles: DataFrame  # tile, n_structures, clat, clon, S, N, W, E
    area: DataFrame  # tile, S, N, W, E, padded
    tracks: DataFrame  # direction, path, period, n_dates, first, last, tag, utc, reference_date


def setup(register: DataFrame, catalogue: DataFrame, province: str, districts: list[str] | str | None = None, least_length: float = 0.0, start: str = "2018-06-01", least_dates: int = 30) -> Setup:
    """Structures of a district, their tiles and area, and the tracks whose scenes meet the area since ``start``, each with its reference date."""
    rows = registry.structures(register, province, districts, least_length)
    tiles, of = registry.tiles(rows)
    area = registry.area(tiles)
    found = search.scenes(catalogue, area, start)
    return Setup(rows.join(of, "id"), tiles, area, search.tracks(found, least_dates))


def update(store: Increments, landed: DataFrame) -> dict[str, object]:
    """Run the cycles that a stream of landed observations asks for; says how many ran and which is the last."""
    before = store.commits()
    store.run(landed)
    after = store.commits()
    return {"cycles": len(after) - len(before), "last": after[-1] if after else None}


def report(best: DataFrame, structures: DataFrame, before: DataFrame, made: Column) -> tuple[DataFrame, DataFrame]:
    """The alert document (one row) and its paragraphs (ord, r_now, text), most urgent first; one paragraph says so if there is nothing to report."""
    records = documents.alert_records(best, structures, before)
    counts = structures.agg(F.count("*").alias("n")).head()["n"], best.where("level >= 0").count()
    text = documents.alert_paragraphs(records).select("ord", "r_now", "bridge", "text")
    nothing = records.agg(F.count("*").alias("k")).where("k = 0").select(F.lit(0).alias("ord"), F.lit(None).cast("double").alias("r_now"), F.lit(documents.NOTHING).alias("text"))
    lines = text.orderBy("ord", F.desc(F.coalesce("r_now", F.lit(0.0))), "bridge").drop("bridge").unionByName(nothing)
    return documents.alert_view(records, F.lit(counts[0]), F.lit(counts[1]), made), lines


def check(checked: Column, *events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All events of a health check (to be appended), and the latest document (to be replaced)."""
    found = reduce(DataFrame.unionByName, events)
    return found.withColumn("checked", checked), documents.health_document(found, checked)


def status(structures: DataFrame, best: DataFrame) -> DataFrame:
    """status, n and the worst ratio of each status, structures that were never judged among them."""
    rows = structures.select("bridge").join(best.select("bridge", "level", "r_now"), "bridge", "left")
    return rows.groupBy(status_label(F.col("level")).alias("status")).agg(F.count("*").alias("n"), F.max("r_now").alias("worst"))


def second_pass(best: DataFrame, tiles: DataFrame, done: DataFrame) -> DataFrame:
    """Structures to be worked on again, in their order: weak results in sound tiles (tile, status) that have had no second pass."""
    return results.weak_structures(best, tiles, done, "bridge", "tile")
