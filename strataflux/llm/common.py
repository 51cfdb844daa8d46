"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Characters that separate words: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"

#: Rows of an id list up to which it may be broadcast (8 bytes each); longer lists are shuffled.
BROADCAST_IDS = 500_000


#: Spark's limit of an Arrow batch and its default, and the one that the operators set in its place: whole texts cross to Python in such batches.
BATCH_LIMIT, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4194304b"


def bounded_batches(df: DataFrame) -> DataFrame:
    """The same table; from now on its session sends rows to Python in smaller batches, unless it has a limit of its own."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT) == BATCH_DEFAULT:
        conf.set(BATCH_LIMIT, BATCH_BYTES)
    return df


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that, when they end, gives freed memory back to the system: a worker waits for its next task beside those that run."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder of the session.

    The folder comes from ``spark.checkpoint.dir``. Only a local session, as in tests, gets
    a temporary folder where the setting is missing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-strataflux-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/strataflux-{uuid.uuid4().hex}"


#: Spark's setting to delete the shuffle files of a job once it is done.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block delete their shuffle files when they end; without it they stay until the driver collects garbage."""
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def materialise(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again, which cuts its lineage.

    Files in the shared folder survive the loss of any executor, so the shuffle files of the job that wrote them go at once.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    with tidy(spark):
        df.write.options(compression="zstd", **options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.strataflux_path = path
    return out


def materialise_bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Like :func:`materialise`, but as a table bucketed by ``key``, which later grouping by that key need not shuffle."""
    name = f"strataflux_{uuid.uuid4().hex}"
    path = shared_dir(df.sparkSession)
    df.write.options(compression="zstd", path=path).bucketBy(buckets, key).saveAsTable(name)
    out = df.sparkSession.table(name)
    out.strataflux_path, out.strataflux_table = path, name
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete the files, and names, of tables from :func:`materialise` and :func:`materialise_bucketed` that nothing will read again."""
    for df in frames:
        path = getattr(df, "strataflux_path", None)
        if path:
            spark = df.sparkSession
            if name := getattr(df, "strataflux_table", None):
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; bytes.split() cuts at exactly these characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Stable 64-bit hashes of words."""
    if not words:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows_of(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive entries of ``h``; one hash of all entries if there are fewer."""
    size = min(size, len(h))
    if not size:
        return h
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out + np.uint64(0x9E3779B97F4A7C15)) + h[k : len(h) - size + 1 + k]
    return mix(out)
