"""A Merkle manifest of a dataset, checked by a recursive query that climbs from the leaves.

1. A leaf is the SHA-256 of a row's fields. Leaves of a source stand in order of id; every 16 consecutive ones (the last run may
   be shorter) give a node of the next level, until one is left, the source's subroot; subroots in order of source give the root
   in the same way. Levels are built by one grouping each, of a sixteenth of the rows before.
2. Every node but the root is stored as a row linked to its parent, with the digests of its siblings to the left and right.
3. A recursive query starts at the leaves, which a row carries by runs of 16, and joins node rows until the root: it appends
   the siblings of each level to the proof, which leaves of a run share, and folds every leaf's given digest with them. Digests travel as bytes.

Nodes high up are met by many runs; their rows are stored in copies, one for some thousand leaves, and runs are dealt over them.

Null ids and null sources come first; a source of null is another than one of the empty string. Rows of one source and id stand in order
of their leaves, so repeated rows are leaves of their own next to each other. An empty table has no rows and no root. Other
columns take no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strataflux.llm.common import discard, materialise
from strataflux.llm.ranked import ranked

#: Nodes in a run, and leaves below a stored copy of a node row.
ARITY, COPY_LEAVES = 16, 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Spark ends a recursion after so many rows; the climb needs one for each run and level.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(columns: list[Column]) -> Column:
    """SHA-256 of columns, each as its count of UTF-8 bytes, a colon and the value, or a dash for null."""

    def shown(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(shown, columns)), 256)


@contextmanager
def unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)


def _joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def _edges(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that link the nodes of a level to their parents, and the parents.

    Nodes have tree, level, idx (their identity), up_tree and at (where they stand among the nodes that share parents),
    size (of those), hash and leaves.
    """
    up = nodes.groupBy("up_tree", F.expr(f"at div {ARITY}").alias("p_idx"), "size").agg(
        F.sort_array(F.collect_list(F.struct("at", "tree", "level", "idx", "hash", "leaves"))).alias("kids"), F.max("up_level").alias("p_level"), F.min("source").alias("source")
    )  # at most 16 to a group
    up = up.withColumn("p_hash", F.sha2(_joined(F.col("kids.hash")), 256)).withColumn("p_leaves", F.aggregate("kids.leaves", F.lit(0).cast("long"), lambda a, x: a + x))
    kid = up.select("*", F.posexplode("kids").alias("k", "kid"))
    edges = kid.select(
        "kid.tree", "kid.level", "kid.idx", "kid.leaves", F.col("up_tree").alias("p_tree"), "p_level", "p_idx", "p_hash", "p_leaves",
        F.unhex(_joined(F.slice("kids.hash", 1, F.col("k")))).alias("before"), F.unhex(_joined(F.slice("kids.hash", F.col("k") + 2, F.lit(ARITY)))).alias("after"),
    )
    parents = up.select(
        F.col("up_tree").alias("tree"), F.col("p_level").alias("level"), F.col("p_idx").alias("idx"), "up_tree", (F.col("p_level") + 1).alias("up_level"), F.col("p_idx").alias("at"),
        F.ceil(F.col("size") / ARITY).alias("size"), F.col("p_hash").alias("hash"), F.col("p_leaves").alias("leaves"), "source",
    )
    return edges, parents


def _raise(nodes: DataFrame, edges: list[DataFrame], done: list[DataFrame], made: list[DataFrame]) -> None:
    """Build levels until each tree has one node; linked rows go to ``edges``, last nodes to ``done``, written tables to ``made``."""
    while True:
        done.append(nodes.where("size = 1"))
        nodes = nodes.where("size > 1")
        if nodes.isEmpty():
            return
        found, parents = _edges(nodes)
        edges.append(materialise(found))
        nodes = materialise(parents)
        made += [edges[-1], nodes]


def manifest(docs: DataFrame, given: Column, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``given`` is the digest that someone holds for the row (null: the leaf itself): folded with the stored siblings it gives
    folded_root, which equals the root if the row is as it was.
    """
    spark = docs.sparkSession
    leaves = docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("doc_id"), digest([F.col(c) for c in fields]).alias("leaf"), given.alias("given"))
    leaves = leaves.withColumn("given", F.coalesce("given", "leaf"))
    placed = ranked(leaves, ["source"], ["doc_id", "leaf"])
    tree = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("tree")
    runs = placed.groupBy("source", F.expr(f"at div {ARITY}").alias("run"), "of").agg(F.sort_array(F.collect_list(F.struct("at", "doc_id", "leaf", "given"))).alias("kids"))
    lone, hashes = F.col("of") == 1, F.col("kids.leaf")

    def fold(k: Column, i: Column) -> Column:
        value = F.when(lone, k["given"]).otherwise(F.sha2(F.concat(_joined(F.slice(hashes, 1, i)), k["given"], _joined(F.slice(hashes, i + 2, F.lit(ARITY)))), 256))
        return F.struct(k["doc_id"].alias("doc_id"), F.unhex(k["leaf"]).alias("leaf"), F.unhex(value).alias("folded"))

    runs = materialise(
        runs.select(
            "source", tree, "run", F.when(lone, 0).otherwise(1).alias("level"), F.when(lone, hashes[0]).otherwise(F.sha2(_joined(hashes), 256)).alias("hash"),
            F.ceil(F.col("of") / ARITY).alias("size"), F.transform("kids", fold).alias("folds"),
        )
    )
    discard(placed.ranked_rows)
    if runs.isEmpty():
        discard(runs)
        return spark.createDataFrame([], f"doc_id {docs.schema[id_col].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    made, links, subroots, roots = [runs], [], [], []
    first = runs.select("tree", "level", F.col("run").alias("idx"), F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.col("run").alias("at"), "size", "hash", F.size("folds").cast("long").alias("leaves"), "source")
    _raise(first, links, subroots, made)
    over = ranked(reduce(DataFrame.unionByName, subroots).select("tree", "level", "idx", "hash", "leaves", "source"), [], ["source"])
    top = over.select("tree", "level", "idx", F.lit("").alias("up_tree"), F.lit(1).alias("up_level"), "at", F.col("of").alias("size"), "hash", "leaves", "source")
    top = materialise(top)
    made += [over.ranked_rows, top]
    _raise(top, links, roots, made)
    root = reduce(DataFrame.unionByName, roots).select("tree", "level", "idx", "hash").head()  # one row

    copies = lambda leaves: F.ceil(F.col(leaves) / COPY_LEAVES)
    if links:
        edges = reduce(DataFrame.unionByName, links).select("*", copies("p_leaves").alias("p_copies"), F.explode(F.sequence(F.lit(0).cast("long"), copies("leaves") - 1)).alias("copy"))
    else:
        edges = spark.createDataFrame([], "tree string, level int, idx long, p_tree string, p_level int, p_idx long, p_hash string, p_copies long, before binary, after binary, copy long")
    names = {k: f"strataflux_{k}_{uuid.uuid4().hex}" for k in ("runs", "edges")}
    runs.withColumn("copies", F.ceil(F.size("folds") / COPY_LEAVES)).createOrReplaceTempView(names["runs"])
    edges.createOrReplaceTempView(names["edges"])
    climbed = spark.sql(f"""
        WITH RECURSIVE climb AS (
          SELECT tree, level, run AS idx, copies, run, hash, CAST(NULL AS STRING) AS subroot, X'' AS proof, folds FROM {names["runs"]}
          UNION ALL
          SELECT e.p_tree, e.p_level, e.p_idx, e.p_copies, c.run, e.p_hash, CASE WHEN e.p_tree = '' AND c.tree <> '' THEN c.hash ELSE c.subroot END,
            concat(c.proof, e.before, e.after), transform(c.folds, f -> named_struct('doc_id', f.doc_id, 'leaf', f.leaf, 'folded', unhex(sha2(lower(concat(hex(e.before), hex(f.folded), hex(e.after))), 256))))
          FROM climb c JOIN {names["edges"]} e ON c.tree = e.tree AND c.level = e.level AND c.idx = e.idx AND pmod(c.run, c.copies) = e.copy
        )
        SELECT coalesce(subroot, hash) AS subroot, proof, folds FROM climb WHERE tree = '{{0}}' AND level = {root["level"]} AND idx = {root["idx"]}
    """.replace("'{0}'", ":tree"), args={"tree": root["tree"]})  # fmt: skip
    each = climbed.select("subroot", "proof", F.col("folds.leaf").alias("leaves"), F.posexplode("folds").alias("k", "fold"))
    shown = lambda c: F.lower(F.hex(c))
    others = F.transform(F.concat(F.slice("leaves", 1, F.col("k")), F.slice("leaves", F.col("k") + 2, F.lit(ARITY))), shown)
    with unlimited_recursion(spark):
        out = materialise(
            each.select(
                "fold.doc_id", shown("fold.leaf").alias("leaf"), "subroot", F.lit(root["hash"]).alias("root"), F.sha2(F.concat(_joined(others), shown("proof")), 256).alias("proof_sha256"),
                shown("fold.folded").alias("folded_root"), (shown("fold.folded") == root["hash"]).alias("verified"),
            )
        )
    for name in names.values():
        spark.catalog.dropTempView(name)
    discard(*made)
    return out
