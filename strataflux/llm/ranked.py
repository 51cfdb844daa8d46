"""Places of rows within a key without a task that holds all rows of the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strataflux.llm.common import materialise


def ranked(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``at`` (long, from 0: the place of a row within its key in ascending order, nulls first) and ``of`` (long, rows of the key).

    Rows are dealt by ranges of key and order, so a key with a third of the rows spans many ranges; a place is the
    count of the key's rows in earlier ranges plus the place in the own one. ``order`` must tell apart rows whose
    places matter. The columns ``_mid`` and ``_part`` of the caller would be lost. Materialises: read the result, then
    :func:`~strataflux.llm.common.discard` the frame in its ``ranked_rows``.
    """
    rows = materialise(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_mid", 33)
    counts = rows.groupBy(*keys, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A row for each key and range: small, and the window's partitions are no longer than the number of ranges.
    counts = counts.select(*(F.col(k).alias(f"_{k}") for k in keys), "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("of"))
    same = F.col("_part") == part
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = rows.join(counts, same).withColumn("at", F.col("_mid") + F.col("_shift")).drop("_mid", "_part", "_shift", *(f"_{k}" for k in keys))
    out.ranked_rows = rows
    return out
