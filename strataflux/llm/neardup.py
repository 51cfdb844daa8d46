"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles; equal sets are one class from the start. Every tree
branches the classes by minwise tokens: a root takes the classes that agree on one coordinate
of the minhash signature, and a node that is too large chooses two more, each with a child for the
classes that agree on it. At the similarity threshold a pair misses all roots with a chance of 1e-10, and
follows a branch in most of the nodes that it shares.

Each node has a pivot, its class of least hash, which many nodes share. Classes whose sketches are near
that of a pivot form the pivot's star. A star is compared exhaustively on full sets, in blocks of bounded size, and gives the
links of a spanning forest, never all pairs: groups of near copies, of any size, are dealt with here. The
other classes of a node that is small enough are held against every class of it that shares no star with them:
candidates whose sketches of 64 coordinates differ too much are dropped (a pair at the threshold is lost with a chance of
about 1e-6), the others are confirmed on full sets. Larger nodes branch; after the last
level every node is compared exhaustively, whatever its size. The comparisons within one
star grow with the square of its size, rows and memory do not.

Null and empty texts, and texts without words, have the empty set and no links. Rows with a
null id, and rows with the id of another row, are documents of their own. Other columns are
left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strataflux.llm.common import BROADCAST_IDS, bounded_batches, discard, lean, materialise, text_words, windows_of, word_hashes
from strataflux.llm.components import components

#: Coordinates of a signature; those used by the roots of the trees.
COORDINATES, ROOTS = 64, 12
#: Classes outside the pivot's star up to which a root does not branch, so that groups of near copies meet a pivot of their own in the children of crowded roots.
FEW = 128
#: Comparisons of sketches (classes outside the pivot's star, times all classes) up to which another node does not branch; levels of branching.
SMALL, LEVELS = 1 << 25, 6
#: Classes outside the star up to which a node gets no further pivot; further pivots of a node on a level.
CROWD, PEELS = 16, 3
#: Shingles in a block of a star.
BLOCK_SHINGLES = 200_000
_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct hashes of the ``size``-word shingles; A-Z count as a-z."""
    words = text_words(text)
    return np.unique(windows_of(word_hashes([w.lower() for w in words]), size))


def signature(s: np.ndarray) -> np.ndarray:
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for lo in range(0, len(s), 4096):
        out = np.minimum(out, ((s[None, lo : lo + 4096] * _MULT[:, None] + _ADD[:, None]) >> np.uint64(32)).min(1))
    return out


_NIBBLES = (np.arange(16, dtype=np.uint64) * np.uint64(4))[None, :]
_SKETCH = "n_shingles long, cls long, mh array<int>, k0 long, k1 long, k2 long, k3 long"


def _sketches(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 1000):
                part = b.iloc[lo : lo + 1000]
                sets = [shingle_set(x, size) for x in part["text"]]
                mh = np.array([signature(s) for s in sets], np.uint64).reshape(-1, COORDINATES)
                bits = ((mh & np.uint64(15)).reshape(-1, 4, 16) << _NIBBLES).sum(2, dtype=np.uint64).view(np.int64)
                out = pd.DataFrame({"doc_id": part["doc_id"].array, "n_shingles": [len(s) for s in sets], "cls": [class_of(s) for s in sets], "mh": list(mh.astype(np.uint32).view(np.int32))})
                yield out.assign(**{f"k{k}": bits[:, k] for k in range(4)})

    return run


def class_of(s: np.ndarray) -> int:
    """An id that equal sets share."""
    return int(windows_of(np.array([len(s), s.sum(dtype=np.uint64), np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15) + (s >> np.uint64(29))) if len(s) else 0], np.uint64), 3).view(np.int64)[0])


def _agree() -> Column:
    """Coordinates in which the 4-bit sketches of two candidates agree."""
    differ = F.lit(0)
    for k in range(4):
        x = F.col(f"a.k{k}").bitwiseXOR(F.col(f"b.k{k}"))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        differ = differ + F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(COORDINATES) - differ


def forest(cls: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the classes whose sets are similar enough; all pairs are compared."""
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(at) > 1
    row, col = np.repeat(np.arange(len(sets)), sizes)[shared[at]], (shared.cumsum() - 1)[at[shared[at]]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(shared.sum()), 2048):
        own = slice(*np.searchsorted(col, [lo, lo + 2048]))
        part = np.zeros((len(sets), 2048), np.float32)
        part[row[own], col[own] - lo] = 1
        common += part @ part.T
    linked = common * (100 + percent) >= (sizes[:, None] + sizes[None]) * percent
    root, out = np.arange(len(sets)), []
    for k in range(1, len(sets)):
        near = np.flatnonzero(linked[k, :k])
        roots, first = np.unique(root[near], return_index=True)
        out += [(int(cls[k]), int(cls[j])) for j in near[first]]
        if len(roots):
            root[np.isin(root, roots)] = root[k] = roots[0]
    return out


def crowd_pivots(outside: DataFrame, salt: Column) -> DataFrame:
    """(node, pivot) of nodes with more than :data:`CROWD` classes: the class of least hash of those that agree on the commonest sixteen coordinates, if these are two or more."""
    alike = outside.groupBy("node", "k0").agg(F.count("*").alias("n"), F.min(F.col("cls").bitwiseXOR(salt)).bitwiseXOR(salt).alias("pivot"))
    most = alike.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "pivot")).alias("m"))
    return most.where(f"n > {CROWD} and m.n > 1").select("node", "m.pivot")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", few: int = FEW, small: int = SMALL, block: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row; linked are sets whose Jaccard similarity is ``percent`` / 100 or more."""
    return _grouped(docs, size, percent, id_col, text_col, few, small, block).drop("cls", "label")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest id, of its rows the one whose set has the least hash.

    Rows are told apart by id and set, so that another text of the same id is a document of its own; of equal rows one
    stays. Rows with a null id or without words stay.
    """
    every = _grouped(docs, size, percent, id_col, text_col, FEW, SMALL, BLOCK_SHINGLES)
    found = every.where("doc_id is not null and n_shingles > 0").select("doc_id", "cls", "label")
    groups = found.groupBy("label").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "cls")).alias("stays")).where("n > 1")
    rows = found.distinct().join(groups.hint("merge"), "label").select("doc_id", "cls", (F.struct("doc_id", "cls") == F.col("stays")).alias("stays"))
    rows = materialise(rows)
    discard(every)
    ids = materialise(rows.select("doc_id").distinct())
    few = (F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids).withColumnRenamed("doc_id", id_col)

    @F.pandas_udf("long")
    def cls(texts: pd.Series) -> pd.Series:
        sets = [shingle_set(x, size) for x in texts]
        return pd.Series([class_of(s) if len(s) else None for s in sets], dtype="Int64")

    hit = docs.join(few, id_col, "left_semi").withColumn("_cls", cls(text_col))
    keyed = rows.select(F.col("doc_id").alias(id_col), F.col("cls").alias("_cls"), "stays")
    stay = hit.join(keyed.where("stays").drop("stays"), [id_col, "_cls"], "left_semi").dropDuplicates([id_col, "_cls"])
    other = hit.join(keyed.select(id_col, "_cls"), [id_col, "_cls"], "left_anti")
    return docs.join(few, id_col, "left_anti").unionByName(stay.drop("_cls")).unionByName(other.drop("_cls"))


def _grouped(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, few: int, small: int, block: int) -> DataFrame:
    """Rows as of :func:`near_duplicates` with their class and its label, which near duplicates share."""
    docs = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(docs.mapInPandas(lean(_sketches(size)), f"doc_id long, {_SKETCH}"))
    sketch = ["n_shingles", "k0", "k1", "k2", "k3"]
    classes = materialise(rows.where("n_shingles > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("first"), *(F.any_value(c).alias(c) for c in (*sketch, "mh"))))
    least = int(COORDINATES * (p := percent / 100 + (1 - percent / 100) / 16) - 5.4 * (COORDINATES * p * (1 - p)) ** 0.5)
    sizes_fit = F.least("a.n_shingles", "b.n_shingles") * 100 >= F.greatest("a.n_shingles", "b.n_shingles") * percent
    used: list[DataFrame] = []

    def kept_for_now(df: DataFrame) -> DataFrame:
        used.append(materialise(df))
        return used[-1]

    def sets_of(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in rows:
            for lo in range(0, len(b), 500):
                sets = [shingle_set(x, size) for x in b["text"].iloc[lo : lo + 500]]
                yield pd.DataFrame({"cls": [class_of(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    def full_sets(wanted: DataFrame) -> DataFrame:
        """(cls, shingles) of the wanted classes, and of a few more; only their texts are read out of the table. A class may come twice, where an id does."""
        ids = kept_for_now(wanted.distinct().join(classes.select("cls", "first"), "cls").select(F.col("first").alias("doc_id")).distinct())
        few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        return docs.join(few, "doc_id", "left_semi").mapInPandas(lean(sets_of), "cls long, shingles array<long>")

    def confirm(pairs: DataFrame) -> DataFrame:
        """The pairs that are links, by their full sets."""
        pairs = kept_for_now(pairs)
        sets = kept_for_now(full_sets(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))))
        both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")).hint("merge"), "a").join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")).hint("merge"), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        return materialise(both.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select("a", "b"))

    def within_stars(members: DataFrame) -> DataFrame:
        """Links of a spanning forest of each star, from (star, cls, n_shingles)."""
        blocks = members.groupBy("star").agg(F.ceil(F.sum("n_shingles") / block).cast("int").alias("n_blocks"))
        own = F.pmod(F.xxhash64("cls"), F.col("n_blocks")).cast("int")
        dealt = members.join(blocks.hint("merge"), "star").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        dealt = dealt.select("star", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "cls")

        def compare(of: pd.DataFrame) -> pd.DataFrame:
            of = of.drop_duplicates("cls")
            links = forest(of["cls"].to_numpy(), list(of["shingles"]), percent)
            return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

        sets = full_sets(members.select("cls"))
        return materialise(dealt.join(sets.hint("merge"), "cls").groupBy("star", "low", "high").applyInPandas(compare, "a long, b long"))

    def star_of(nodes: DataFrame, pivots: DataFrame) -> DataFrame:
        """The classes of nodes with their node's pivot, and whether they are near it."""
        pivots = pivots.join(classes.select(F.col("cls").alias("pivot"), *sketch).hint("merge"), "pivot")
        near = sizes_fit & (_agree() >= least)
        return kept_for_now(nodes.alias("a").join(pivots.alias("b").hint("merge"), F.col("a.node") == F.col("b.node")).select("a.*", F.col("b.pivot").alias("star"), near.alias("near")))

    def branch(nodes: DataFrame, level: int) -> DataFrame:
        """Children of nodes: a row for each of the coordinates that the node chooses."""
        half = (COORDINATES - ROOTS) // 2
        if not level:
            keys = [F.xxhash64(F.lit(c), F.get("mh", F.lit(c))) for c in range(ROOTS)]
        else:
            chosen = [F.pmod(F.xxhash64("node", F.lit(level), F.lit(j)), F.lit(half)).cast("int") + ROOTS + half * j for j in range(2)]
            keys = [F.xxhash64("node", c, F.get("mh", c)) for c in chosen]
        return nodes.select(F.explode(F.array(*keys)).alias("node"), "cls", *sketch)

    links, stars = [], None
    nodes = branch(classes, 0)
    for level in range(LEVELS):
        salt = F.xxhash64(F.lit(level))
        pivots = nodes.groupBy("node").agg(F.count("*").alias("n"), F.min(F.col("cls").bitwiseXOR(salt)).bitwiseXOR(salt).alias("pivot")).where("n > 1")
        members = star_of(nodes, pivots)
        new = members.where("near").select("star", "cls", "n_shingles")
        # Groups of near copies that a node's pivot is not of get pivots of their own, so that they are not compared in pairs.
        outside = members.where("not near").drop("star", "near")
        for _ in range(PEELS):
            pivots = kept_for_now(crowd_pivots(outside, salt))
            if pivots.isEmpty():
                break
            left = star_of(outside, pivots)
            new = new.unionByName(left.where("near").select("star", "cls", "n_shingles"))
            outside = left.where("not near").drop("star", "near")
        new = new.distinct()
        new = kept_for_now(new.join(new.where("cls <> star").select("star").distinct().hint("merge"), "star"))
        links.append(within_stars(new))
        stars = new if stars is None else stars.unionByName(new)
        # What is not in the star of its node is held against the whole node.
        rest = members.groupBy("node").agg(F.count_if(~F.col("near")).alias("outside"), F.count("*").alias("n")).where("outside > 0").select("node", (F.col("outside") * F.col("n") <= small if level else F.col("outside") <= few).alias("easy"))
        of_class = stars.groupBy("cls").agg(F.collect_set("star").alias("stars"))
        open_ = kept_for_now(members.join(rest.hint("merge"), "node").join(of_class.hint("merge"), "cls", "left"))
        easy = open_.where("easy") if level < LEVELS - 1 else open_
        apart = F.when(F.col("b.near"), F.lit(True)).otherwise(F.col("a.cls") < F.col("b.cls")) & ~F.coalesce(F.arrays_overlap("a.stars", "b.stars"), F.lit(False))
        pairs = easy.where(~F.col("near")).alias("a").join(easy.alias("b").hint("merge"), (F.col("a.node") == F.col("b.node")) & (F.col("a.cls") != F.col("b.cls")) & sizes_fit & (_agree() >= least) & apart)
        links.append(confirm(pairs.select(F.least("a.cls", "b.cls").alias("a"), F.greatest("a.cls", "b.cls").alias("b")).distinct()))
        large = open_.where("not easy")
        if level == LEVELS - 1 or large.isEmpty():
            break
        nodes = branch(large.select("node", "cls").join(classes.hint("merge"), "cls"), level + 1)

    found = links[0]
    for more in links[1:]:
        found = found.union(more)
    grouped = components(found)
    labels = materialise(grouped.select(F.col("node").alias("cls"), F.col("root").alias("label")))
    discard(*used, *links, grouped)

    out = rows.select("doc_id", "n_shingles", "cls")
    of_class = classes.select("cls", "first").join(labels, "cls", "left")
    smallest = of_class.where("label is not null").groupBy("label").agg(F.min("first").alias("least"))
    of_class = of_class.join(smallest, "label", "left").select("cls", F.coalesce("label", "cls").alias("label"), F.coalesce("least", "first").alias("component_id"))
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    out = out.join(of_class.hint("merge"), "cls", "left").select("doc_id", "n_shingles", "cls", "label", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = materialise(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    discard(rows, classes, labels)
    return out
