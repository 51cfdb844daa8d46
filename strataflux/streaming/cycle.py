"""Incremental cycles as streams of landed files.

A cycle takes all files that landed since the last one (``availableNow``), and writes each micro-batch through
``foreachBatch`` keyed by batch, so that a batch that runs twice leaves the same table. Late rows replace what
they supersede; nothing is dropped for lateness. The history is a log whose runs are merged in levels.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from strataflux.session import checkpoint_dir
from strataflux.streaming.log import KeyedLog


def shared(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; a local session without one gets a temporary folder."""
    return f"{checkpoint_dir(spark)}/cycle-{uuid.uuid4().hex}"


def run_cycle(source: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all that is new since the checkpoint, then stop; nothing new starts no batch."""
    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def landed(spark: SparkSession, path: str, schema, files_per_batch: int = 100, delete: bool = False) -> DataFrame:
    """Files of a folder as a stream; the number a batch takes is what holds producers back."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if delete:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(path)


def words_of(stream: DataFrame, base: str) -> DataFrame:
    """All that a stateful stream says until it has read what there is: each batch in a folder of its own, which a rerun replaces."""
    spark, schema = stream.sparkSession, stream.schema

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{base}/words/batch={batch_id}")

    stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/words")


def history(spark: SparkSession, path: str, keys: list[str], version: str, schema: StructType) -> KeyedLog:
    """A keyed history that batches of a stream are appended to; see :class:`~strataflux.streaming.log.KeyedLog`."""
    return KeyedLog(spark, path, keys, version, schema)


def replay(spark: SparkSession, path: str) -> DataFrame:
    """The history of an events table, streamed file by file."""
    base = shared(spark)
    schema = spark.read.parquet(path).schema
    # A pattern, as a stream reads folders or patterns and the table may be one file.
    shaped = landed(spark, f"{path[:-1]}[{path[-1]}]", schema).select(F.col("user_id").alias("bridge"), F.col("event_type").alias("kind"), F.to_date("ts").cast("string").alias("date"), "value", F.col("event_id").alias("version"))
    log = history(spark, f"{base}/history", ["bridge", "kind", "date"], "version", shaped.schema)
    run_cycle(shaped, lambda df, batch: log.append(df, batch) and None, f"{base}/checkpoint")
    return log.read()


def changed(results: DataFrame, previous: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Keys whose newest date is later than before, to be computed anew as a whole."""
    new = results.groupBy(*keys).agg(F.max(date).alias("_new"))
    old = previous.groupBy(*keys).agg(F.max(date).alias("_old"))
    return new.join(old, keys, "left").where(F.col("_old").isNull() | (F.col("_new") > F.col("_old"))).select(*keys)


def missing_dates(wanted: DataFrame, have: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Dates to fetch: wanted, not there, not excluded."""
    return wanted.join(have.select(*keys), keys, "left_anti").join(excluded.select(*keys), keys, "left_anti")
