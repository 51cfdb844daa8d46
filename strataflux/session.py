"""Session settings that the operators expect."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "strataflux", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` takes precedence (dots as double underscores)."""
    builder = SparkSession.builder.appName(app)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for k, v in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session, from ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-strataflux-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: what several branches read is computed once, and survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
