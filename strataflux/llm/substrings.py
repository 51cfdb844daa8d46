"""Repeated passages found by recompression of the corpus.

Words are the first symbols. In each round, runs of a symbol and then pairs of unlike symbols
get new names. A name is a hash of what it stands for, so equal runs and pairs get the same
name in every task and round without a table of names being shuffled. Whether two symbols
pair depends on them and their neighbours only: equal passages are named alike, but for
symbols near their ends. With each symbol goes the span of words that decided it.

After the last round, each symbol that is least among its neighbours, with these neighbours, is a
landmark. A window of words that holds the span of a landmark has this landmark wherever it occurs; a
window that holds none is its own landmark. So a window that occurs in two texts has all its landmarks
in both, and no repeat is missed. The name of a whole text tells copies.

Landmarks shared by different texts reveal candidate windows; two independent 64-bit names of each
window verify them, and two of a whole text its copies. Neither is a polynomial, which ordered words could make collide.

Null text has no words. Rows with a null id are neither searched nor changed. Rows with the same id do
not count as earlier for each other. An empty table gives an empty result. Only ids and texts are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strataflux.llm.common import BROADCAST_IDS, bounded_batches, discard, lean, materialise, mix, text_words, word_hashes

#: Words in a window, rounds, and words that a task holds at once.
WINDOW, ROUNDS, BATCH_WORDS = 50, 4, 150_000
_P = np.uint64(0x9E3779B97F4A7C15)
#: Seed of the second name of windows and texts.
CHECK = 1


def window_names(h: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A name for every ``size`` consecutive entries of ``h``, by names of 1, 2, 4, ... entries. Different seeds give independent names."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    n = len(h) - size + 1
    part, at, out = mix(h ^ np.uint64(seed)), 0, np.full(n, seed, np.uint64)
    for k in range(size.bit_length()):
        if size >> k & 1:
            out = mix(out * _P + part[at : at + n])
            at += 1 << k
        if size >> (k + 1):
            part = mix(part[: -(1 << k)] * _P + part[1 << k :])
    return out


def text_name(h: np.ndarray, seed: int = 0) -> int:
    """The name of a whole text."""
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8, salt=bytes([seed])).digest(), "little", signed=True) if len(h) else 0


def _round(name: np.ndarray, lo: np.ndarray, hi: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round. name: symbols in their order; lo, hi: the words that decided each."""
    first = np.append(True, name[1:] != name[:-1])
    at = np.flatnonzero(first)
    n = np.diff(np.append(at, len(name))).astype(np.uint64)
    run, run_lo, run_hi = name[at], lo[at], np.append(hi[at[1:] - 1], hi[-1:])
    run = np.where(n > 1, mix(run + n * _P), run)
    left = (mix(run ^ np.uint64(turn + 1)) & np.uint64(1)).astype(bool)
    pair = np.append(left[:-1] & ~left[1:], False)  # left and right never overlap
    head = np.append(True, ~pair[:-1])
    at = np.flatnonzero(head)
    both = pair[at]
    last = at + both
    out = run[at]
    out[both] = mix(mix(out[both] * _P + np.uint64(1)) + run[last[both]])
    # The neighbours on both sides decided as well, where runs ended and what paired.
    return out, run_lo[np.maximum(at - 1, 0)], run_hi[np.minimum(last + 1, len(run) - 1)]


def landmarks(h: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, first words, ends) of the landmarks of a sequence of word hashes; [first, end) decided each."""
    name, lo = h, np.arange(len(h))
    hi = lo + 1
    for turn in range(rounds):
        name, lo, hi = _round(name, lo, hi, turn)
    if len(name) < 3:
        return name[:0], lo[:0], hi[:0]
    order = mix(name)
    a, b, c = order[:-2], order[1:-1], order[2:]
    at = np.flatnonzero((b <= a) & (b <= c))
    return mix(mix(a[at] * _P + b[at]) * _P + c[at]), lo[at], hi[at + 2]


def _inside(starts: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int, flags: np.ndarray | None = None) -> np.ndarray:
    """How many of the spans [lo, hi) (for which ``flags`` holds) lie in the window from each start."""
    fits = hi - lo <= size
    if flags is not None:
        fits = fits & flags
    # A span lies in the windows that start from hi - size to lo.
    change = np.zeros(len(starts) + size + 2, np.int64)
    np.add.at(change, np.maximum(hi[fits] - size, 0), 1)
    np.add.at(change, lo[fits] + 1, -1)
    return change.cumsum()[: len(starts)]


def _joined(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one sequence, a symbol of its own before, between and after them; the start of each; and which windows lie in one text.

    What such a symbol decided has it in its span, and so lies in no window of a text.
    """
    sizes = np.array([len(x) for x in texts])
    starts = 1 + np.append(0, (sizes + 1).cumsum()[:-1])
    h = mix(np.arange(sizes.sum() + len(texts) + 1, dtype=np.uint64) ^ np.uint64(0xD1B54A32D192ED03))
    cut = np.zeros(len(h) + size + 1, np.int64)
    cut[np.append(0, starts + sizes)] = 1
    for s, x in zip(starts, texts):
        h[s : s + len(x)] = x
    seen = np.append(0, cut.cumsum())
    return h, starts, seen[size : size + len(h)] == seen[: len(h)]


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    for b in frames:
        lo, total, words = 0, 0, []
        for k, text in enumerate(b["text"]):
            words.append(word_hashes(text_words(text)))
            total += len(words[-1])
            if total >= BATCH_WORDS or k == len(b) - 1:
                yield b.iloc[lo : k + 1], words
                lo, total, words = k + 1, 0, []


def _marks(size: int) -> Callable:
    """(name, root, doc_id): the landmarks of each text once; and each text, with its second name, and its id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, words in _batches(frames):
            roots = np.array([text_name(w) for w in words], np.int64)
            long = np.array([len(w) >= size for w in words])
            checks = np.array([text_name(w, CHECK) for w, n in zip(words, long) if n], np.int64)
            yield pd.DataFrame({"name": checks, "root": roots[long], "doc_id": b["doc_id"].to_numpy()[long]})
            own = {r: w for r, w, n in zip(roots, words, long) if n}
            if not own:
                continue
            h, starts, whole = _joined(list(own.values()), size)
            name, lo, hi = landmarks(h)
            use = (hi - lo <= size) & (np.searchsorted(starts, lo, "right") == np.searchsorted(starts, hi - 1, "right"))
            bare = np.flatnonzero(whole & (_inside(h, lo, hi, size) == 0))
            out = pd.DataFrame({"name": np.concatenate([name[use], window_names(h, size)[bare]]).view(np.int64), "root": np.array(list(own))[np.searchsorted(starts, np.concatenate([lo[use], bare]), "right") - 1]})
            yield out.drop_duplicates().assign(doc_id=None).astype({"name": "Int64", "doc_id": "Int64"})

    return run


def _windows(size: int) -> Callable:
    """(window, check, root, start) for the windows all of whose landmarks are among ``names``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, words in _batches(frames):
            names = list(b["names"])
            rows = [(r, w, n) for r, w, n in zip(b["root"], words, names) if len(w) >= size and text_name(w) == r]
            if not rows:
                continue
            h, starts, whole = _joined([w for _, w, _ in rows], size)
            name, lo, hi = landmarks(h)
            of = np.searchsorted(starts, lo, "right") - 1
            window = window_names(h, size)
            # A name counts for its own text: both in one number, then a search among those of all texts.
            salt = mix(np.arange(len(rows), dtype=np.uint64))
            shared = np.sort(np.concatenate([np.asarray(n, np.int64).view(np.uint64) ^ salt[k] for k, (_, _, n) in enumerate(rows)]))
            has = lambda x: shared[np.minimum(np.searchsorted(shared, x), len(shared) - 1)] == x
            known = has(name ^ salt[np.maximum(of, 0)])
            every, those = _inside(h, lo, hi, size), _inside(h, lo, hi, size, known)
            at = np.flatnonzero(whole & (every == those))
            bare = every[at] == 0
            text = np.searchsorted(starts, at, "right") - 1
            ok = ~bare | has(window[at] ^ salt[text])
            at, text = at[ok], text[ok]
            yield pd.DataFrame({"window": window[at].view(np.int64), "check": window_names(h, size, CHECK)[at].view(np.int64), "root": np.array([r for r, _, _ in rows], np.int64)[text], "start": (at - starts[text]).astype(np.int32)})

    return run


def of_ids(docs: DataFrame, ids: DataFrame, n: int, how: str) -> DataFrame:
    """Semi or anti join by doc_id with a table of ``n`` ids; short tables are broadcast."""
    return docs.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "doc_id", how)


def repeats(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found) for texts with words to remove; found: array of (root, starts), starts null if the whole text goes.

    A window of ``size`` words goes if it also starts in a text with a smaller id.
    """
    docs = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marks = materialise(docs.where("doc_id is not null").mapInPandas(lean(_marks(size)), "name long, root long, doc_id long"))
    texts = marks.where("doc_id is not null").withColumnRenamed("name", "check")
    roots = materialise(texts.groupBy("root").agg(F.min("doc_id").alias("first")))
    shared = marks.where("doc_id is null").groupBy("name").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("name")
    named = materialise(marks.where("doc_id is null").select("name", "root").join(shared, "name").groupBy("root").agg(F.collect_set("name").alias("names")).join(roots, "root"))
    ids = materialise(named.select(F.col("first").alias("doc_id")).distinct())
    wanted = of_ids(docs, ids, ids.count(), "left_semi").join(named.withColumnRenamed("first", "doc_id"), "doc_id").select("root", "names", "text")
    windows = materialise(wanted.mapInPandas(lean(_windows(size)), "window long, check long, root long, start int").join(roots, "root"))
    earliest = windows.groupBy("window", "check").agg(F.min("first").alias("least"), F.max("first").alias("most")).where("least < most").select("window", "check", "least")
    starts = windows.join(earliest, ["window", "check"]).where("least < first").groupBy("root", "first").agg(F.collect_set("start").alias("starts"))
    earlier = texts.groupBy("root", "check").agg(F.min("doc_id").alias("before"))
    copies = texts.join(earlier, ["root", "check"]).where("doc_id > before").select("doc_id", "root").distinct()
    found = starts.select(F.col("first").alias("doc_id"), "root", "starts").unionByName(copies.withColumn("starts", F.lit(None).cast("array<int>")))
    out = materialise(found.groupBy("doc_id").agg(F.collect_list(F.struct("root", "starts")).alias("found")))
    discard(marks, roots, named, ids, windows)
    return out


def removed(h: np.ndarray, found: list | None, size: int) -> np.ndarray:
    """Which words of a text go, by the row that :func:`repeats` found for its id."""
    gone = np.zeros(len(h) + size + 1, np.int64)
    if found is not None and len(found) and len(h) >= size:
        root = text_name(h)
        for f in found:
            if f["root"] == root:
                if f["starts"] is None:
                    return np.ones(len(h), bool)
                at = np.asarray(f["starts"], np.int64)
                gone[at] += 1
                gone[at + size] -= 1
    return gone.cumsum()[: len(h)] > 0


def without(text: str | None, words: list[bytes], gone: np.ndarray) -> tuple[str | None]:
    """For :func:`apply`: the text without the words that go and the white space after each."""
    if text is None or not gone.any():
        return (text,)
    parts = re.findall(rb"[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text.encode("utf-8", "surrogatepass"))
    out, k, last = [], -1, False
    for p in parts:
        if p[:1].isspace():
            if not last:
                out.append(p)
        else:
            k += 1
            last = bool(gone[k])
            if not last:
                out.append(p)
    return (b"".join(out).decode("utf-8", "surrogatepass"),)


def apply(docs: DataFrame, found: DataFrame, finish: Callable[[str | None, list[bytes], np.ndarray], tuple], schema: str, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``result`` of ``finish(text, words, which go)``, which replaces a column of that name. Where few texts lose words, only these are shuffled."""

    def result(texts: pd.Series, rows: list) -> pd.DataFrame:
        out = []
        for text, f in zip(texts, rows):
            words = text_words(text)
            gone = removed(word_hashes(words), f, size) if f is not None else np.zeros(len(words), bool)
            out.append(finish(text, words, gone))
        return pd.DataFrame(out, columns=[x.split()[0] for x in schema.split(", ")])

    @F.pandas_udf(schema)
    def changed(texts: pd.Series, rows: pd.Series) -> pd.DataFrame:
        return result(texts, [None if r is None else [{"root": x["root"], "starts": x["starts"]} for x in r] for r in rows])

    @F.pandas_udf(schema)
    def same(texts: pd.Series) -> pd.DataFrame:
        return result(texts, [None] * len(texts))

    docs = docs.drop("_found", "result")
    own = found.select(F.col("doc_id").alias(id_col), F.col("found").alias("_found"))
    ids = own.select(id_col)
    if ids.count() > BROADCAST_IDS:
        return docs.join(own, id_col, "left").withColumn("result", changed(F.col(text_col), "_found")).drop("_found")
    hit = docs.join(F.broadcast(ids), id_col, "left_semi").join(own, id_col)
    rest = docs.join(F.broadcast(ids), id_col, "left_anti")
    return hit.withColumn("result", changed(F.col(text_col), "_found")).drop("_found").unionByName(rest.withColumn("result", same(F.col(text_col))))
