"""Queries on running cycles: increments, stateful streams, and the views and documents of what they leave.

Events stand for observations: users for structures, their types for tracks, and the last digit of a user's number for a tile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflux.operators import results
from strataflux.plans.queries import query, table
from strataflux.streaming import cycle, watch
from strataflux.streaming.increment import Increments
from strataflux.streaming.log import Files

#: Bytes of a landed file that a task reads.
ROW_GROUP = 4 << 20


def _landing(df: DataFrame, by) -> str:
    """The rows of a table as files that landed one after the other, in the shared folder. They are dealt to the files in one pass over the table; a file has many row groups, which many tasks read."""
    spark, base = df.sparkSession, cycle.shared(df.sparkSession)
    rows = df.withColumn("_landing", by)
    rows.write.partitionBy("_landing").parquet(f"{base}/dealt")
    dealt = spark.read.schema(rows.schema).parquet(f"{base}/dealt")
    for k in sorted(r[0] for r in dealt.select("_landing").distinct().collect()):  # a few files
        dealt.where(F.col("_landing") == k).drop("_landing").coalesce(1).write.option("parquet.block.size", ROW_GROUP).parquet(f"{base}/in/{k:03d}")
    Files(spark, base).delete("dealt")
    return base


_WEEK = "CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INT)"
_HALF = _WEEK.replace("/ 7)", "/ 14)")
_JUDGED = "SELECT track, bridge, level, n FROM (SELECT *, row_number() OVER (PARTITION BY bridge ORDER BY n DESC, level DESC, track DESC) AS k FROM (SELECT event_type AS track, user_id AS bridge, CAST(sum(floor(value)) AS BIGINT) % 4 AS level, count(*) AS n FROM (SELECT event_type, user_id, CAST(ts AS DATE), max_by(value, event_id) AS value FROM events WHERE {0} GROUP BY ALL) GROUP BY ALL)) WHERE k = 1"


@query(
    f"""WITH w AS (SELECT max({_HALF}) AS last FROM events), now AS ({_JUDGED.format("true")}), old AS ({_JUDGED.format(f"{_HALF} < (SELECT last FROM w)")})
SELECT now.bridge, now.track, CAST(now.level AS INT) AS level, now.n, CAST(old.level AS INT) AS prev, CASE WHEN now.level < 2 THEN NULL WHEN old.level IS NULL OR old.level < 2 THEN '신규 경보' WHEN now.level > old.level THEN '등급 상승' ELSE '지속' END AS kind FROM now LEFT JOIN old USING (bridge)"""
)
def incremental_cycle(spark, sf_dir):
    """Events land in fortnights; each cycle judges only the tiles that its fortnight changes. The last cycle's judgements and their alerts."""
    e = table(spark, sf_dir, "events").where(F.col("ts").isNotNull())
    rows = e.select(F.col("event_type").alias("track"), (F.col("user_id") % 10).cast("string").alias("tile"), F.col("user_id").alias("bridge"), F.to_date("ts").alias("date"), "value", F.col("event_id").alias("version"))
    base = _landing(rows, F.floor(F.datediff("date", F.lit("2024-01-01")) / 14).cast("int"))

    def judge(series: DataFrame) -> DataFrame:
        return series.groupBy("track", "tile", "bridge").agg((F.sum(F.floor("value")) % 4).cast("int").alias("level"), F.count("*").alias("n"))

    def best(found: DataFrame) -> DataFrame:
        return found.groupBy("bridge").agg(F.max(F.struct("n", "level", "track")).alias("m")).select("bridge", "m.level", "m.n", "m.track")

    def alerts(now: DataFrame, before: DataFrame) -> DataFrame:
        both = now.join(before.select("bridge", F.col("level").alias("prev")), "bridge", "left")
        return both.withColumn("kind", F.when(F.col("level") >= 2, results.alert_kind(F.col("level"), F.col("prev"), F.lit(False))))

    monitor = Increments(spark, f"{base}/monitor", rows.schema.toDDL().replace(" NOT NULL", ""), ["track", "tile", "bridge", "date"], "version", "track string, tile string, bridge bigint, level int, n bigint", judge, best, alerts)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    monitor.run(stream)
    return monitor.latest_alerts().select("bridge", "track", "level", "n", "prev", "kind")


_CYCLES = f"(SELECT user_id AS structure, {_WEEK} AS cycle, CAST(count(*) % 4 AS INT) AS level, count(*) % 5 = 0 AS review FROM events GROUP BY ALL)"


@query(
    f"""WITH c AS {_CYCLES} SELECT c.structure, CAST(c.cycle AS BIGINT) AS cycle, c.level, p.level AS prev, CASE WHEN c.level < 2 THEN NULL WHEN c.review THEN '확인 필요' WHEN p.level IS NULL OR p.level < 2 THEN '신규 경보' WHEN c.level > p.level THEN '등급 상승' ELSE '지속' END AS kind
FROM c LEFT JOIN c p ON p.structure = c.structure AND p.cycle = c.cycle - 1"""
)
def change_stream(spark, sf_dir):
    """Levels of weeks, which land latest first, streamed against the state of their structure."""
    watch.store(spark)
    e = table(spark, sf_dir, "events")
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01")) / 7)
    rows = e.groupBy(F.col("user_id").alias("structure"), week.alias("cycle")).agg((F.count("*") % 4).cast("int").alias("level"), (F.count("*") % 5 == 0).alias("review")).withColumn("version", F.lit(1).cast("long"))
    base = _landing(rows, (99 - F.col("cycle")).cast("int"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    return watch.last_changes(cycle.words_of(watch.changes(stream), base))


@query("WITH d AS (SELECT user_id AS track, CAST(max(ts) AS DATE) AS last_date FROM events WHERE user_id % 3 > 0 OR day(ts) < 4 GROUP BY 1), m AS (SELECT max(ts) AS now FROM events) SELECT track, CAST(last_date AS VARCHAR) AS last_date, now >= last_date + INTERVAL 25 DAY AS stale FROM d, m")
def silence_stream(spark, sf_dir):
    """Users without an event for more than 24 days, told by timers; every third user stops early."""
    watch.store(spark)
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    stop = (F.col("user_id") % 3 > 0) | (F.dayofmonth("ts") < 4)
    rows = e.where(stop).select(F.col("user_id").alias("track"), "ts").unionByName(e.select(F.lit(-1).cast("long").alias("track"), "ts").groupBy("track").agg(F.max("ts").alias("ts")))
    base = _landing(rows, F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01")) / 7).cast("int"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    out = watch.last_silences(cycle.words_of(watch.silences(stream), base)).where("track >= 0")
    return out.select("track", F.col("last_date").cast("string").alias("last_date"), "stale")
