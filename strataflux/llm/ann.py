"""Approximate nearest neighbours by cross-polytope hashing.

Equal vectors become one. In each table a vector is given random signs and a fast Hadamard transform,
three times over, which acts as a random rotation; its bucket is the nearest of the signed axes of the
first coordinates. Each query also looks into the next-nearest buckets of each table. The number of axes is fitted: of a
bounded sample of queries the exact neighbours are found among all rows, and the most axes with which enough of these share a bucket with their
query are taken. As neighbours are nearer in a larger table, buckets become more and the share of pairs that is scored falls. Buckets are dealt in blocks of bounded size, so that a bucket of any size is spread over tasks; each
task scores its queries against its block exactly, in double precision, and the best of all blocks are merged.

Inner products rank vectors of any length: a coordinate is added that gives all vectors the length of the
longest, while queries get 0 there. Vectors that are null, zero, of another length than most, or that hold null or
non-finite numbers take no part; nor do rows with a null id. Ties go to the smaller id. Rows of one id count each,
and a query never finds its own id. With fewer candidates than asked for, all found are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflux.llm.common import materialise

#: Tables, buckets that a query looks into in each, and vectors in a block.
TABLES, PROBES, BLOCK = 12, 12, 4096
#: Numbers of coordinates whose axes may be buckets, most first; queries on which they are compared, at most; share of their neighbours to be found.
AXES, SAMPLE, TARGET = (1024, 512, 256, 128, 64, 32, 16), 64, 0.94
SEED = 77


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, table: int, least: int = 2) -> np.ndarray:
    """Pseudo-rotation number ``table`` of vectors, padded to a power of two, ``least`` or more."""
    d = 1 << int(np.ceil(np.log2(max(x.shape[1], least, 2))))
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    signs = np.random.default_rng((SEED, table, d)).choice([-1.0, 1.0], (3, d))
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(x: np.ndarray, table: int, axes: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first."""
    y = rotated(x, table, axes)[:, :axes]
    both = np.concatenate([y, -y], axis=1)
    probes = min(probes, both.shape[1])
    if probes == 1:
        return both.argmax(1)[:, None]
    top = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(both, top, 1), axis=1, kind="stable"), 1)


def lengthened(x: np.ndarray, longest: float | None) -> np.ndarray:
    """Unit vectors with a coordinate more, which brings all stored vectors to the length ``longest``; it is 0 for queries."""
    rest = np.zeros(len(x)) if longest is None else np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0))
    x = np.column_stack([x, rest])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fitted_axes(base: DataFrame, queries: DataFrame, k: int, tables: int, probes: int, longest: float) -> int:
    """The most axes with which ``TARGET`` of the ``k`` nearest of the sampled queries (id, v) among all rows of ``base`` (id, v) share a bucket with their query."""
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return AXES[-1]
    asked, x = np.array([r["id"] for r in sample]), np.array([r["v"] for r in sample], np.float64)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 4096):
                part = b.iloc[lo : lo + 4096]
                s = np.stack(part["v"].to_numpy()).astype(np.float64) @ x.T
                s[part["id"].to_numpy()[:, None] == asked] = -np.inf
                top = np.argsort(-s, axis=0, kind="stable")[:k]
                yield pd.DataFrame({"query": np.tile(np.arange(len(asked)), len(top)), "score": np.take_along_axis(s, top, 0).ravel(), "v": list(part["v"].iloc[top.ravel()])})

    kind = base.schema["v"].dataType.simpleString()
    near = base.select("id", "v").mapInPandas(best, f"query int, score double, v {kind}").where(F.col("score") > float("-inf"))
    near = near.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("_n") <= k).select("query", "v").collect()  # SAMPLE * k rows
    if not near:
        return AXES[-1]
    of = np.array([r["query"] for r in near])
    theirs, own = lengthened(np.array([r["v"] for r in near], np.float64), longest), lengthened(x, None)
    for axes in AXES:
        found = np.zeros(len(of), bool)
        for t in range(tables):
            found |= (buckets(own, t, axes, probes)[of] == buckets(theirs, t, axes, 1)).any(1)
        if found.mean() >= TARGET:
            return axes
    return AXES[-1]


def _hashed(tables: int, probes: int, axes: int, longest: float | None):
    """Rows with a table and bucket each. With ``longest`` all vectors are brought to that length first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 2048):
                part = b.iloc[lo : lo + 2048].reset_index(drop=True)
                x = lengthened(np.stack(part["v"].to_numpy()).astype(np.float64), longest)
                for t in range(tables):
                    at = buckets(x, t, axes, probes)
                    yield part.loc[np.repeat(part.index, at.shape[1])].assign(bucket=(t * 2 * axes + at).ravel())

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, probes: int = PROBES, axes: int | None = None, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``is_query`` holds, the ``k`` of largest inner product found among all other rows. Axes are fitted where they are not given."""
    v = F.col(vector_col)
    kind = vectors.schema[vector_col].dataType.simpleString()
    good = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), is_query.alias("is_query")).where(good)
    shape = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if shape is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == shape["d"])
    # Of equal vectors, an answer needs the k + 1 smallest ids at most: one may be the query's own.
    few = rows.withColumn("_n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    base = materialise(few.groupBy("v").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = materialise(rows.where("is_query").select("vec_id", "v"))
    queries = asked.groupBy("v").agg(F.min("vec_id").alias("id"))
    longest = base.agg(F.max(F.sqrt(F.aggregate(F.transform("v", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x * x)))).head()[0]

    axes = axes or fitted_axes(base, queries, k, tables, probes, longest)
    stored = materialise(base.select("id", "v").mapInPandas(_hashed(tables, 1, axes, longest), f"id long, v {kind}, bucket int"))
    probed = materialise(queries.select("id", "v").mapInPandas(_hashed(tables, probes, axes, None), f"id long, v {kind}, bucket int"))
    count = lambda df, n: df.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias(n))
    blocks = count(stored, "n_stored").join(count(probed, "n_probed"), "bucket")  # at most a row for each bucket
    own = F.pmod(F.xxhash64("id"), F.col("n_own")).cast("int")
    dealt = lambda df, mine, other, a, b: df.join(blocks.withColumnRenamed(mine, "n_own"), "bucket").select("id", "v", "bucket", own.alias(a), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(b))
    left = dealt(probed, "n_probed", "n_stored", "pb", "sb")
    right = dealt(stored, "n_stored", "n_probed", "sb", "pb")

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})
        if not len(q) or not len(c):
            return none
        x, y = (np.stack(z["v"].to_numpy()).astype(np.float64) for z in (q, c))
        most = min(k + 1, len(y))
        out = [none]
        for lo in range(0, len(x), 512):
            part = x[lo : lo + 512]
            s = part @ y.T
            top = np.argpartition(-s, most - 1, axis=1)[:, :most]
            # Each score once more in a fixed order of adding, so that every table finds the same.
            exact = (part[:, None, :] * y[top]).sum(2)
            out.append(pd.DataFrame({"query": np.repeat(q["id"].to_numpy()[lo : lo + 512], most), "id": c["id"].to_numpy()[top].ravel(), "score": exact.ravel()}))
        return pd.concat(out, ignore_index=True)

    keys = ("bucket", "pb", "sb")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, "query long, id long, score double")
    found = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    best = found.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("_n") <= k + 1)
    # Back from distinct vectors to rows.
    answers = best.join(base.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("vec_id"))
    answers = answers.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("_n") <= k + 1)
    listed = answers.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("near"), "vec_id"))).alias("found"))
    each = asked.join(queries.join(listed, queries["id"] == listed["query"]).select("v", "found"), "v")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("vec_id")), 1, k)
    out = each.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "hit"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.near")).alias("score"))
