"""Readers of the formats that a screening starts from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def registry_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The registry as text columns and an ``ordinal`` by the row's place in the file, from 0; a mark at the file's start is dropped.

    A file is read by one task, so that its rows keep their order; a registry has some ten thousand rows.
    """
    raw = spark.read.csv(path, header=True, encoding=encoding, multiLine=True)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    place = F.monotonically_increasing_id()
    return raw.withColumn("_m", place).withColumn("ordinal", F.row_number().over(Window.orderBy("_m")) - 1).drop("_m")


def weather_hourly(spark: SparkSession, path: str) -> DataFrame:
    """cell_lat, cell_lon, hour, temp, rh, rain from answers with parallel hourly arrays."""
    schema = "latitude double, longitude double, hourly struct<time:array<string>,temperature_2m:array<double>,relative_humidity_2m:array<double>,precipitation:array<double>>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    rows = raw.select(F.col("latitude").alias("cell_lat"), F.col("longitude").alias("cell_lon"), F.explode(F.arrays_zip("hourly.time", "hourly.temperature_2m", "hourly.relative_humidity_2m", "hourly.precipitation")).alias("h"))
    return rows.select("cell_lat", "cell_lon", F.to_timestamp("h.time").alias("hour"), F.col("h.temperature_2m").alias("temp"), F.col("h.relative_humidity_2m").alias("rh"), F.col("h.precipitation").alias("rain"))


def weather_cells(spark: SparkSession, path: str) -> DataFrame:
    """lat, lon, date, T, RH, P24 from reduced cells."""
    raw = spark.read.schema("lat double, lon double, utc string, acq map<string, struct<T:double,RH:double,P24:double>>").json(path, multiLine=True)
    return raw.select("lat", "lon", F.explode("acq").alias("date", "w")).select("lat", "lon", "date", "w.*")


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """code, name and rings of a GeoJSON collection of polygons."""
    schema = "features array<struct<properties:struct<code:string,name:string,name_eng:string,base_year:string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return f.select("f.properties.*", F.col("f.geometry.coordinates").alias("rings"))


def baselines(spark: SparkSession, path: str) -> DataFrame:
    """ref, sec, bperp: the mean of the average baselines that each pair's file states."""
    t = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    values = F.transform(F.regexp_extract_all("value", F.lit(r"Bperp[^\n]*average[^\n]*?(-?\d+(?:\.\d+)?)\s*(?:\n|$)"), 1), lambda x: x.cast("double"))
    pair = F.regexp_extract("file", r"(\d{8})_(\d{8})\.txt$", 1), F.regexp_extract("file", r"(\d{8})_(\d{8})\.txt$", 2)
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(values), F.lit(0))
    return t.select(pair[0].alias("ref"), pair[1].alias("sec"), mean.alias("bperp"))


def logs(spark: SparkSession, path: str) -> DataFrame:
    """file and text of whole logs."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def scene_dates(spark: SparkSession, path: str) -> DataFrame:
    """file and date of scenes, by their names: the sixth part begins with the date."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    return files.withColumn("date", F.substring(F.element_at(F.split("file", "_"), 6), 1, 8))


def raster_rows(spark: SparkSession, path: str, width: int, dtype: str = "<f4") -> DataFrame:
    """file, row, values of flat binary rasters; a file is read by one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"]):
                a = np.frombuffer(content, dtype).reshape(-1, width)
                for lo in range(0, len(a), 1024):
                    part = a[lo : lo + 1024].astype(np.float64)
                    yield pd.DataFrame({"file": file, "row": np.arange(lo, lo + len(part)), "values": list(part)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, row long, values array<double>")


def incidence_layout(samples: DataFrame, values: str) -> DataFrame:
    """Which of two interleavings of incidence and heading a raster has: that with more plausible incidences (10 to 70 degrees)."""
    good = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.when((x > 10) & (x < 70), 1).otherwise(0))
    by_pixel = F.filter(values, lambda x, i: i % 2 == 0)
    by_band = F.slice(values, 1, (F.size(values) / 2).cast("int"))
    return samples.groupBy("file").agg(F.sum(good(by_pixel)).alias("pixel"), F.sum(good(by_band)).alias("band")).withColumn("layout", F.when(F.col("pixel") >= F.col("band"), "pixel").otherwise("band"))


def raster_properties(spark: SparkSession, path: str) -> DataFrame:
    """file, name and value of each property that the XML beside a raster states (width, length, data type, ...); the last of a name counts."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    pattern = r"(?is)<property\s+name\s*=\s*[\"']([^\"']+)[\"']\s*>.*?<value>\s*(.*?)\s*</value>"
    pairs = F.arrays_zip(F.regexp_extract_all("value", F.lit(pattern), 1).alias("name"), F.regexp_extract_all("value", F.lit(pattern), 2).alias("value"))
    each = t.select("file", F.posexplode(pairs).alias("k", "p")).select("file", F.lower("p.name").alias("name"), "k", "p.value")
    return each.groupBy("file", "name").agg(F.max_by("value", "k").alias("value"))


def headings(spark: SparkSession, path: str, default: float = -13.0) -> DataFrame:
    """file and heading in degrees from metadata that has an element or property of that name; else the default."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    found = F.regexp_extract("value", r"(?is)heading[^>]*>(?:\s*<value>)?\s*(-?\d+(?:\.\d+)?)", 1)
    return t.select("file", F.coalesce(found.try_cast("double"), F.lit(default)).alias("heading"))
