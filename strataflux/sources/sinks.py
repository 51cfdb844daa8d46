"""Writers of results, and readers of what they wrote.

Tables go out as Parquet or JSON by tile, so that a tile's result is replaced as a whole and a rerun leaves the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _by(df: DataFrame, path: str, kind: str, *keys: str) -> None:
    """Only the partitions that ``df`` has are replaced."""
    df.write.format(kind).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).save(path)


def write_points(points: DataFrame, path: str) -> None:
    """Point series (point, lon, lat, ..., date, disp_mm), a folder for each track and tile."""
    _by(points, path, "parquet", "track", "tile")


def read_points(spark: SparkSession, path: str, track: str | None = None, tiles: list[str] | None = None) -> DataFrame:
    """Point series; a track and tiles are found by folder, so that no other is read."""
    df = spark.read.parquet(path)
    if track is not None:
        df = df.where(F.col("track") == track)
    return df if tiles is None else df.where(F.col("tile").isin(tiles))


def write_tile_results(records: DataFrame, path: str) -> None:
    """Judged records as JSON, a folder for each track and tile."""
    _by(records, path, "json", "track", "tile")


def read_tile_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Judged records of all tiles. A file that is no JSON gives rows of nulls, which go; null levels stay."""
    return spark.read.schema(schema).json(path).where(F.col("bridge").isNotNull())


def replace_structures(spark: SparkSession, path: str, schema: str, again: DataFrame) -> DataFrame:
    """Tile results in which the structures of ``again`` (a second pass) take the place of the first; ``pass`` says which it is."""
    old = read_tile_results(spark, path, schema).join(again.select("track", "tile", "bridge"), ["track", "tile", "bridge"], "left_anti").withColumn("pass", F.lit(1))
    return old.unionByName(again.withColumn("pass", F.lit(2)), allowMissingColumns=True)


def append_events(events: DataFrame, path: str, checked: str) -> None:
    """Health events of one check; a check that runs again replaces its own."""
    _by(events.withColumn("checked", F.lit(checked)), path, "parquet", "checked")


def write_json(df: DataFrame, path: str) -> None:
    """A small document set (state, set-up, area, tiles, alerts) as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON document, none where it is missing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).json(path) if there else spark.createDataFrame([], schema)


def write_lines(alerts: DataFrame, path: str) -> None:
    """The text of alerts (column ``line``), most urgent first: sorted, so one file after the other is the whole text."""
    alerts.orderBy("ord", F.desc(F.coalesce("r_now", F.lit(0.0)))).select("line").write.mode("overwrite").text(path)
