"""Line deduplication by pairwise alignment.

A block is a run of adjacent lines with enough words. The shortest blocks from and up to each line are keyed by hash,
and a key leads from each later document to the first that has it, however many have it. Every line of a block that
two documents share lies in a keyed block that they share, so each such line has a partner; there are never more pairs than
keys, of which there are at most two a line. Patience diff aligns the lines of each pair, and aligned blocks, and no others, are deleted from
the later document. One alignment keeps the order of lines; keyed blocks that it does not hold, as their order differs or they repeat, are aligned again, each
with its own place in the partner. So a line with words goes if and only if it lies in a block that an earlier document has. Lines are judged on the input.

Null text has no lines; a null id is never searched nor changed. Repeated rows of an id are changed alike and
are not earlier than each other. Columns of the caller stay, but for ``n_lines``, ``n_removed_lines``, ``_cut`` and ``_found``, which are replaced. Blank lines count as part of a block that surrounds them. Only hashes of lines
are shuffled until the texts that lose lines are rewritten. Tables that grow with the corpus meet by sort-merge joins at
every size.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strataflux.llm.common import BROADCAST_IDS, bounded_batches, discard, lean, materialise, mix

#: Words in a block that is deleted.
BLOCK_WORDS = 10
#: Keys of blocks are polynomials of their lines' hashes in this number, modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.int64(0)


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each line, 0 for lines without words, and the lines' counts of words. White space at the ends does not count."""
    if text is None:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    lines = [x.strip(b" \t\x0b\x0c\r") for x in text.encode("utf-8", "surrogatepass").split(b"\n")]
    h = pd.util.hash_array(np.array(lines, object), categorize=False).view(np.int64).copy()
    n = np.array([len(x.split()) for x in lines], np.int32)
    h[n == 0] = _BLANK
    return h, n


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned equal lines of two documents: lines unique in both, in the longest order they share, then their equal neighbours and what lies between, by the same rule."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        at: dict[int, int] = {}
        for k in range(a0, a1):
            at[a[k]] = -1 if a[k] in at else k
        once: dict[int, int] = {}
        for k in range(b0, b1):
            once[b[k]] = -1 if b[k] in once else k
        both = [(at[x], k) for x, k in sorted(once.items(), key=lambda p: p[1]) if k >= 0 and x and at.get(x, -1) >= 0]
        tails: list[int] = []
        ends: list[int] = []
        back: list[int] = []
        for i, (p, _) in enumerate(both):
            k = bisect_left(tails, p)
            back.append(ends[k - 1] if k else -1)
            tails[k:k + 1], ends[k:k + 1] = [p], [i]
        chain, i = [], ends[-1] if ends else -1
        while i >= 0:
            chain.append(both[i])
            i = back[i]
        lo_a, lo_b = a0, b0
        for p, q in reversed(chain):
            # The anchor itself is the last line of the piece that ends with it.
            stack.append((lo_a, p + 1, lo_b, q + 1))
            lo_a, lo_b = p + 1, q + 1
        if chain:
            stack.append((lo_a, a1, lo_b, b1))
    return out


def blocks(pairs: list[tuple[int, int]], words: np.ndarray, least: int) -> list[int]:
    """Lines of the second document in aligned blocks (neighbours in both) of at least ``least`` words."""
    out: list[int] = []
    run: list[int] = []
    last = (-2, -2)
    for p, q in sorted(pairs) + [(-2, -2)]:
        if (p, q) != (last[0] + 1, last[1] + 1):
            if run and words[run].sum() >= least:
                out += run
            run = []
        run.append(q)
        last = (p, q)
    return out


def keyed_blocks(lines: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the shortest blocks from each line with words and up to each, and where they begin and end (exclusive)."""
    upto = np.append(0, words.cumsum(dtype=np.int64))
    at = np.flatnonzero(words)
    till = np.searchsorted(upto, upto[at] + least)
    since = np.searchsorted(upto, upto[at + 1] - least, "right") - 1
    begin, end = np.append(at[till < len(upto)], since[since >= 0]), np.append(till[till < len(upto)], at[since >= 0] + 1)
    power = np.cumprod(np.append(np.uint64(1), np.full(len(lines), _BASE, np.uint64)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(len(lines), pow(_BASE, -1, 1 << 64), np.uint64)))
    total = np.append(np.uint64(0), np.cumsum(lines.view(np.uint64) * power[:-1], dtype=np.uint64))
    return mix((total[end] - total[begin]) * inverse[begin]).view(np.int64), begin, end


def text_key(lines: np.ndarray) -> int:
    """Tells rows of one id apart by their lines and the order of these."""
    return int.from_bytes(hashlib.blake2b(lines.tobytes(), digest_size=8).digest(), "little", signed=True)


def repeated_lines(docs: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, gone): the indexes, from 0, of the lines to delete from each document that loses any."""
    docs = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [line_hashes(x) for x in b["text"]]
            keys = [np.unique(keyed_blocks(h, n, block_words)[0]) for h, n in found]
            yield pd.DataFrame({"doc_id": b["doc_id"].array, "key": [text_key(h) for h, _ in found], "lines": [h for h, _ in found], "words": [n for _, n in found], "blocks": keys})

    kept = materialise(docs.mapInPandas(lean(split), "doc_id long, key long, lines array<long>, words array<int>, blocks array<long>"))
    lines = kept.drop("blocks")
    # Rows of one id: the first in order of their lines stands for the id as a partner.
    each = kept.select("doc_id", F.explode("blocks").alias("block"))
    known = materialise(each.groupBy("block").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("most")).where("first < most").select("block", "first"))
    meets = each.join(known.hint("merge"), "block").where("doc_id > first")
    pairs = materialise(meets.groupBy("doc_id", "first").agg(F.collect_set("block").alias("shared")))
    one = lines.groupBy("doc_id").agg(F.min(F.struct("lines", "words")).alias("own"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            gone = []
            for a, m, own, n, shared in zip(b["before"], b["before_words"], b["lines"], b["words"], b["shared"]):
                out = np.zeros(len(own), bool)
                out[blocks(patience(a.tolist(), own.tolist()), n, block_words)] = True
                keys, begin, end = keyed_blocks(own, n, block_words)
                at = np.flatnonzero(np.isin(keys, shared))
                if len(at) and not out[np.concatenate([np.arange(begin[k], end[k]) for k in at])].all():
                    # Blocks that the partner has in another order or more than once: each is aligned with its own place there.
                    theirs = {}
                    for key, lo, hi in zip(*(x.tolist() for x in keyed_blocks(a, m, block_words))):
                        theirs.setdefault(key, []).append((lo, hi))
                    for k in at.tolist():
                        block = slice(begin[k], end[k])
                        for lo, hi in theirs.get(int(keys[k]), []):
                            if out[block].all():
                                break
                            out[begin[k] + np.array(blocks(patience(a[lo:hi].tolist(), own[block].tolist()), n[block], block_words), int)] = True
                gone.append(np.flatnonzero(out))
            yield pd.DataFrame({"doc_id": b["doc_id"], "key": b["key"], "gone": gone})

    later = pairs.join(lines.hint("merge"), "doc_id")
    aligned = later.join(one.select(F.col("doc_id").alias("first"), F.col("own.lines").alias("before"), F.col("own.words").alias("before_words")).hint("merge"), "first").select("doc_id", "key", "shared", "before", "before_words", "lines", "words").mapInPandas(lean(align), "doc_id long, key long, gone array<int>")
    found = aligned.select("doc_id", "key", F.explode("gone").alias("line")).distinct().groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("line")).alias("gone"))
    out = materialise(found.groupBy("doc_id").agg(F.collect_list(F.struct("key", "gone")).alias("found")))
    discard(kept, known, pairs)
    return out


def apply(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text without its deleted lines, and n_lines and n_removed_lines (long)."""
    docs, text = docs.drop("_found", "_cut"), F.col(text_col)
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long")
    ids = found.select(F.col("doc_id").alias(id_col))
    few = ids.count() <= BROADCAST_IDS
    wanted = F.broadcast(ids) if few else ids

    @F.pandas_udf("text string, n_removed_lines long")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for x, f in zip(texts, found):
            gone: set[int] = set()
            if x is not None:
                key = text_key(line_hashes(x)[0])
                for g in f:
                    if g["key"] == key:
                        gone.update(g["gone"])
            out.append(("\n".join(y for k, y in enumerate(x.split("\n")) if k not in gone) if gone else x, len(gone)))
        return pd.DataFrame(out, columns=["text", "n_removed_lines"])

    hit = docs.join(wanted, id_col, "left_semi").join(found.select(F.col("doc_id").alias(id_col), F.col("found").alias("_found")).hint("merge"), id_col).withColumn("n_lines", n_lines).withColumn("_cut", cut(text, "_found"))
    hit = hit.withColumns({text_col: F.col("_cut.text"), "n_removed_lines": F.col("_cut.n_removed_lines")}).drop("_cut", "_found")
    rest = docs.join(wanted, id_col, "left_anti").withColumns({"n_lines": n_lines, "n_removed_lines": F.lit(0).cast("long")})
    return rest.unionByName(hit)
