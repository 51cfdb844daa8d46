"""Stateful watching: changes of level against the cycle before, and tracks that fall silent.

Both hold a little state for each key in the state store and stand late, repeated and corrected rows: what they emit carries
what it was told from, so the last word on a key is the largest, whatever order batches came in. The session needs a RocksDB state store (:func:`store`).
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAYS = 24


def store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def alert_kind(level: int, prev: int | None, review: bool | None) -> str | None:
    """The kind of an alert as results.alert_kind has it; none under level 2."""
    if level is None or level < 2:
        return None
    if review:
        return "확인 필요"
    if prev is None or prev < 2:
        return "신규 경보"
    return "등급 상승" if level > prev else "지속"


class Changes(StatefulProcessor):
    """A structure's levels by cycle. A row tells its own cycle's change, and anew that of the next cycle if that came before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "cycle long", "version long, level int, review boolean")

    def _change(self, key: str, cycle: int) -> Row:
        version, level, review = self.levels.getValue((cycle,))
        before = self.levels.getValue((cycle - 1,)) if self.levels.containsKey((cycle - 1,)) else None
        prev = before[1] if before else None
        return Row(structure=key, cycle=cycle, level=level, prev=prev, kind=alert_kind(level, prev, review), version=version, prev_version=before[0] if before else -1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        touched = set()
        for r in rows:
            old = self.levels.getValue((r["cycle"],)) if self.levels.containsKey((r["cycle"],)) else None
            new = (r["version"], r["level"], r["review"])
            if old is None or tuple(old)[0] < new[0]:
                self.levels.updateValue((r["cycle"],), new)
                touched.add(r["cycle"])
        for cycle in sorted(touched | {c + 1 for c in touched if self.levels.containsKey((c + 1,))}):
            yield self._change(key[0], cycle)

    def close(self) -> None:
        pass


class Silence(StatefulProcessor):
    """A track's last date, and a timer for the day it is missed on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "ms long")

    def _event(self, key: str, ms: int, stale: bool) -> Row:
        return Row(track=key, last_date=datetime.date(1970, 1, 1) + datetime.timedelta(milliseconds=ms), stale=stale)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max(int(r["day"]) * 86_400_000 for r in rows)
        old = self.last.get()[0] if self.last.exists() else None
        if old is None or newest > old:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.last.update((newest,))
            # Missed when more than DAYS days have passed.
            self.handle.registerTimer(newest + (DAYS + 1) * 86_400_000)
            yield self._event(key[0], newest, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self._event(key[0], self.last.get()[0], True)

    def close(self) -> None:
        pass


def changes(levels: DataFrame) -> DataFrame:
    """A stream (structure, cycle, level, review, version) to words on changes (structure, cycle, level, prev, kind, version, prev_version); see :func:`last_changes`."""
    kind = levels.schema["structure"].dataType.simpleString()
    out = f"structure {kind}, cycle long, level int, prev int, kind string, version long, prev_version long"
    rows = levels.select("structure", F.col("cycle").cast("long").alias("cycle"), F.col("level").cast("int").alias("level"), "review", F.col("version").cast("long").alias("version"))
    return rows.groupBy("structure").transformWithState(Changes(), out, "Update", "None")


def last_changes(words: DataFrame) -> DataFrame:
    """The last word on each structure and cycle."""
    return words.groupBy("structure", "cycle").agg(F.max(F.struct("version", "prev_version", "level", "prev", "kind")).alias("m")).select("structure", "cycle", "m.level", "m.prev", "m.kind")


def silences(arrivals: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """A stream (track, ts) to words on silence (track, last_date, stale): told once the watermark, the newest time less ``delay``, is more than 24 days past a track's last date."""
    kind = arrivals.schema["track"].dataType.simpleString()
    rows = arrivals.select("track", "ts", F.unix_date(F.to_date("ts")).alias("day")).withWatermark("ts", delay)
    return rows.groupBy("track").transformWithState(Silence(), f"track {kind}, last_date date, stale boolean", "Update", "EventTime")


def last_silences(words: DataFrame) -> DataFrame:
    """The last word on each track."""
    return words.groupBy("track").agg(F.max(F.struct("last_date", "stale")).alias("m")).select("track", "m.last_date", "m.stale")
