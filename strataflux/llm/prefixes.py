"""A trie of the conversations' prefixes, built from its deepest level by truncation.

A node is a distinct sequence of first turns. A prefix is named by two 64-bit numbers, each the exclusive or of hashes of (place, turn), so names of
all prefixes come from running sums over chunks of a conversation, and a last turn is stripped by taking its hash out again.

1. Equal conversations are one row with their count. Of them only the smallest id's path is followed.
2. The depths at which paths meet (a node with two children, or with a child and an ended conversation) are found by
   one count. Between two such depths nothing can merge, so a surviving node is stripped of all these turns at once; the nodes that it
   passes differ from it in closed form, by sums of code points along the path.
3. From the deepest such depth upwards, a round merges nodes that survived with conversations that end there or since, sums members, children,
   leaves and saved tokens, and strips the result down to the next depth. The root is the last round.

Turns are hashed where they are read; no text is shuffled. A conversation of any length is spread over ranges and chunks. The
list of depths goes to the driver: as each needs a path of that length, it has at most the square root of twice the count of turns.
The ids of equal conversations are hashed as one list: blocks of the list are made in ranges, and a task reads the blocks in order and holds one.

Null roles and texts are empty. Rows without conv_id are left out. Turns of equal number stand in the order of their
hashes; repeated rows are turns of their own. An empty table has no node. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from strataflux.llm.common import discard, materialise
from strataflux.llm.ranked import ranked

#: Turns of a conversation whose names are made in one window, and ids in a block of a list.
CHUNK, BLOCK = 1024, 4096
NONE = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, at (place, from 0), of (turns of the conversation), s1 and s2 (names of role and text), chars (code points of text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", name.alias("name"), F.length(text).cast("long").alias("chars"))
    rows = rows.select("conv_id", "turn", F.xxhash64("name").alias("s1"), F.xxhash64(F.lit(1), "name").alias("s2"), "chars")
    return ranked(rows, ["conv_id"], ["turn", "s1", "s2"])


def with_heads(rows: DataFrame, share: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another, as templates and forks make them.

    The first ``h`` turns of conversation c become those of c - c % ``share``, where h = crc32(c) % ``most``. Gives the turns
    (conv_id, pos, last, s1, s2, chars) and the conversations (conv_id, turns).
    """
    c = F.col("conv_id")
    ids = rows.groupBy("conv_id").agg(F.max("of").alias("n"))
    ids = ids.select("conv_id", "n", (F.crc32(c.cast("string")) % most).alias("h"), (c - c % share).alias("base"))
    heads = ids.where(c == F.col("base")).select(c.alias("base"), F.col("n").alias("n_base"))
    ids = ids.join(heads, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    ids = materialise(ids.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")))
    own = rows.join(ids.select("conv_id", "h", "m", "turns"), "conv_id").where("at >= h").withColumn("pos", F.col("at") - F.col("h") + F.col("m"))
    # A conversation of at most ``most`` first turns meets at most 2 * share - 1 others.
    first = rows.where((c % share == 0) & (F.col("at") < most)).withColumnRenamed("conv_id", "base").join(ids, "base").where("at < m").withColumn("pos", F.col("at"))
    cols = ["conv_id", F.col("pos").cast("long").alias("pos"), (F.col("pos") + 1 == F.col("turns")).alias("last"), "s1", "s2", "chars"]
    return own.select(*cols).unionByName(first.select(*cols)), ids


def _paths(turns: DataFrame) -> DataFrame:
    """A row for each prefix of each conversation: depth, its name k1 and k2, its parent's p1 and p2, code points before its last turn and with it."""
    x = turns.select("conv_id", "pos", "last", "chars", F.floor(F.col("pos") / CHUNK).alias("chunk"), F.xxhash64("pos", "s1", "s2").alias("x1"), F.xxhash64("s2", "pos", "s1", F.lit(7)).alias("x2"))
    w = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = x.select("*", F.bit_xor("x1").over(w).alias("l1"), F.bit_xor("x2").over(w).alias("l2"), F.sum("chars").over(w).alias("l_chars"))
    # The last row of a full chunk has the chunk's sums; chunks before are few for any conversation.
    full = local.where(F.col("pos") % CHUNK == CHUNK - 1).select("conv_id", (F.col("chunk") + 1).alias("chunk"), "l1", "l2", "l_chars")
    past = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = full.select("conv_id", "chunk", F.bit_xor("l1").over(past).alias("o1"), F.bit_xor("l2").over(past).alias("o2"), F.sum("l_chars").over(past).alias("o_chars"))
    both = local.join(before, ["conv_id", "chunk"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    k1, k2 = F.col("l1").bitwiseXOR(zero("o1")), F.col("l2").bitwiseXOR(zero("o2"))
    cum = F.col("l_chars") + zero("o_chars")
    return both.select("conv_id", (F.col("pos") + 1).alias("depth"), "last", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("x1")).alias("p1"), k2.bitwiseXOR(F.col("x2")).alias("p2"), (cum - F.col("chars")).alias("before"), cum.alias("cum"))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of name and id to blocks of a name's ids."""
    for b in batches:
        key = b[["depth", "k1", "k2"]].to_numpy()
        new = np.append(True, (key[1:] != key[:-1]).any(axis=1)) if len(b) else np.empty(0, bool)
        first = np.flatnonzero(new).tolist()
        starts = [x for lo, hi in zip(first, [*first[1:], len(b)]) for x in range(lo, hi, BLOCK)]
        ids = b["conv_id"].tolist()
        ends = [*starts[1:], len(b)]
        yield b.iloc[starts].assign(n=[e - s for s, e in zip(starts, ends)], ids=[",".join(map(str, ids[s:e])) for s, e in zip(starts, ends)])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks in order of name and first id to one row a name."""
    cols = ["depth", "k1", "k2", "cum", "conv_id", "n", "ends"]
    key, head, n, h = None, None, 0, None
    for b in batches:
        rows = []
        for depth, k1, k2, cum, conv, count, ids in zip(*(b[c].tolist() for c in ("depth", "k1", "k2", "cum", "conv_id", "n", "ids"))):
            if (depth, k1, k2) != key:
                if key is not None:
                    rows.append((*key, *head, n, h.hexdigest()))
                key, head, n, h = (depth, k1, k2), (cum, conv), 0, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
            n += count
        yield pd.DataFrame(rows, columns=cols)
    if key is not None:
        yield pd.DataFrame([(*key, *head, n, h.hexdigest())], columns=cols)


def _ended(rows: DataFrame) -> DataFrame:
    """Equal conversations: depth, k1, k2, cum, the smallest conv_id, n of them, and the hash of their ids."""
    kinds = "depth long, k1 long, k2 long, cum long, conv_id long, n long"
    name = ["depth", "k1", "k2"]
    blocks = rows.repartitionByRange(*name, "conv_id").sortWithinPartitions(*name, "conv_id").mapInPandas(_blocks, f"{kinds}, ids string")
    return blocks.repartition(*name).sortWithinPartitions(*name, "conv_id").mapInPandas(_digests, f"{kinds}, ends string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes, with the columns of :data:`NODE`, of conversations given as (conv_id, pos, last, s1, s2, chars) and (conv_id, turns)."""
    made = [paths := materialise(_paths(turns))]
    zero = F.lit(0).cast("long")
    turnless = convs.where("turns = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("cum"), "conv_id")
    made.append(ended := materialise(_ended(paths.where("last").select("depth", "k1", "k2", "cum", "conv_id").unionByName(turnless))))
    made.append(kept := materialise(paths.join(ended.where("depth > 0").select("conv_id"), "conv_id", "left_semi")))
    edges = kept.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("k1").alias("c1"), F.col("k2").alias("c2")).distinct()
    kids = edges.groupBy("depth", "k1", "k2").agg(F.count("*").alias("kids"))
    meet = kids.where("kids > 1").select("depth").unionByName(kids.join(ended.select("depth", "k1", "k2"), ["depth", "k1", "k2"], "left_semi").select("depth")).distinct()
    floors = sorted({0} | {d for d, in meet.collect()})

    depths = F.array(*(F.lit(d).cast("long") for d in floors))
    band = (F.size(F.filter(depths, lambda m: m < F.col("depth"))) - 1).alias("band")
    kept = kept.select("*", band, F.array_contains(depths, F.col("depth") - 1).alias("is_floor"))
    lowest = kept.where("is_floor").select("band", "conv_id", "p1", "p2", F.col("before").alias("low"))
    made.append(lowest := materialise(lowest.repartitionByRange("band", "conv_id").sortWithinPartitions("band")))  # a round reads its band only
    ended = ended.select("*", band, F.lit(0).cast("long").alias("kid"), zero.alias("leaves"), zero.alias("saved"))
    value = ["depth", "k1", "k2", "cum", "conv_id", "n", "ends", "kid", "leaves", "saved"]

    def merged(rows: DataFrame) -> DataFrame:
        out = rows.groupBy("depth", "k1", "k2").agg(F.min("cum").alias("cum"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.max("ends").alias("ends"), F.sum("kid").alias("kid"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        return out.withColumn("leaves", F.greatest("leaves", F.lit(1)))

    stripped, rounds = None, []
    for j in reversed(range(len(floors))):
        new = ended.where(F.col("band") == j).select(*value)
        front = merged(new if stripped is None else new.unionByName(stripped))
        made.append(step := materialise(front.join(lowest.where(F.col("band") == j).drop("band"), "conv_id").withColumn("band", F.lit(j))))
        rounds.append(step)
        stripped = step.select(
            F.lit(floors[j]).cast("long").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("low").alias("cum"), "conv_id", "n", F.lit(None).cast("string").alias("ends"),
            F.lit(1).cast("long").alias("kid"), "leaves", (F.col("saved") + (F.col("n") - 1) * (F.col("cum") - F.col("low"))).alias("saved"),
        )
    made.append(root := materialise(merged(ended.where("depth = 0").select(*value).unionByName(stripped))))

    top = rounds[0]
    for r in rounds[1:]:
        top = top.unionByName(r)
    # A node just below a meeting depth has the node there as parent; it may have very many such children, which adaptive execution splits.
    tops = top.select(F.col("depth").alias("at"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("up")).unionByName(root.select(F.col("depth").alias("at"), zero.alias("p1"), zero.alias("p2"), F.col("conv_id").alias("up")))
    segments = top.withColumn("at", F.element_at(depths, F.col("band") + 1)).join(tops, ["at", "p1", "p2"])
    segments = segments.select("conv_id", "band", F.col("depth").alias("top"), F.col("cum").alias("top_cum"), "n", "kid", "leaves", "saved", "ends", "up")
    node = kept.select("conv_id", "band", "depth", "before", "is_floor").join(segments, ["conv_id", "band"])
    at_top = F.col("depth") == F.col("top")
    nodes = node.select(
        "conv_id", "depth", F.when(F.col("is_floor"), F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"), F.when(at_top, F.col("kid")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") + (F.col("n") - 1) * (F.col("top_cum") - F.col("before"))).alias("saved_tokens"), F.when(at_top, F.coalesce("ends", F.lit(NONE))).otherwise(F.lit(NONE)).alias("ends_sha256"),
    )
    roots = root.select("conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kid").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))
    out = materialise(nodes.unionByName(roots))
    discard(*made)
    return out


def prefix_trie(turns: DataFrame, heads: bool = False) -> DataFrame:
    """The trie of a table (conv_id, turn, role, text); with ``heads``, of conversations whose first turns are those of another (:func:`with_heads`)."""
    rows = numbered(turns)
    if heads:
        path, convs = with_heads(rows)
    else:
        convs = materialise(rows.groupBy("conv_id").agg(F.max("of").alias("turns")))
        path = rows.select("conv_id", F.col("at").alias("pos"), (F.col("at") + 1 == F.col("of")).alias("last"), "s1", "s2", "chars")
    out = trie(path, convs)
    discard(rows.ranked_rows, convs)
    return out
