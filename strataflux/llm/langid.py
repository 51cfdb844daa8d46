"""Language identification by multilingual mixture inference.

Letter n-grams give the likelihood of each word in each language. Expectation-maximisation
over the words of a whole text estimates the share of every language; languages leave the
set, the weakest first, while the likelihood penalised by the number of languages does not
fall.

Null text, and text without a letter, is ``und`` with score 0. A null id passes through. With
no labelled row every text is ``und``. Other columns are kept, columns of the same name as a
result are replaced. Equal shares go to the language first in order of its name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataflux.llm.common import bounded_batches, lean

#: Rows that a model is fitted on, at most; their ids are drawn by hash.
MAX_TRAIN_ROWS = 20_000
#: n-grams are counted in 2**16 classes, which bounds the model whatever the corpus.
CLASSES = 1 << 16
#: Words whose likelihoods a task remembers.
MEMORY = 200_000
ROUNDS, PENALTY = 8, 2.0
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]{0,23}")


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The class of each n-gram (three characters, word ends marked) of some words, and where each word's begin."""
    a = np.frombuffer(f"^{'$^'.join(words)}$".encode("utf-32-le", "surrogatepass"), np.uint32)
    h = a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA77) ^ a[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    whole = (a[:-2] != ord("$")) & (a[1:-1] != ord("$"))
    return (h[whole] >> np.uint32(16)).astype(np.int64), whole.cumsum()[np.flatnonzero(a[:-2] == ord("^"))] - 1


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # classes x languages


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Count the n-grams of labelled rows for which ``train`` holds; beyond ``max_rows`` of them, of a share drawn by hash."""
    rows = bounded_batches(docs).where(train & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                c = total.setdefault(lang, np.zeros(CLASSES, np.int64))
                words = Counter(LETTERS.findall(text.lower()))
                if words:
                    grams, starts = _grams(list(words))
                    times = np.repeat(list(words.values()), np.diff(np.append(starts, len(grams))))
                    c += np.bincount(grams, times, CLASSES).astype(np.int64)
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "gram": at, "n": c[at]})

    counts = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(lean(count), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = counts.toPandas()  # at most CLASSES rows for each language
    langs = sorted(got["lang"].unique())
    table = np.full((CLASSES, len(langs)), 0.5)
    for k, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        table[own["gram"].to_numpy(), k] += own["n"].to_numpy()
    return Model(langs, np.log(table / table.sum(0, keepdims=True)) if langs else table)


def _shares(like: np.ndarray, n: np.ndarray, starts: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for all texts of a batch. like: word x language; n: counts; starts: first word of each text; on: text x language. Shares and log likelihoods."""
    sizes = np.diff(np.append(starts, len(n)))
    of = np.repeat(np.arange(len(starts)), sizes)
    pi = (on / on.sum(1, keepdims=True)).astype(np.float32)
    total = np.add.reduceat(n, starts)[:, None]
    for _ in range(ROUNDS if (on.sum(1) > 1).any() else 0):
        r = like * pi[of]
        r *= (n / np.maximum(r.sum(1), 1e-30))[:, None]
        pi = np.add.reduceat(r, starts, axis=0) / total
    return pi, np.add.reduceat(n * np.log(np.maximum((like * pi[of]).sum(1), 1e-30)), starts)


def _of_texts(starts: np.ndarray, count: int, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of some texts, and where each starts among them."""
    ends = np.append(starts, count)
    sizes = ends[texts + 1] - ends[texts]
    own = np.append(0, sizes.cumsum())[:-1]
    return np.repeat(ends[texts] - own, sizes) + np.arange(sizes.sum()), own


def infer(like: np.ndarray, n: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Shares of each language in each text, 0 for those outside its set.

    Languages leave one by one. Where the strongest alone is within the cost of one language of the present set, every set on the way
    to it is, as it holds the strongest, so that those steps are skipped.
    """
    texts, langs = len(starts), like.shape[1]
    on = np.ones((texts, langs), np.float32)
    pi, best = _shares(like, n, starts, on)
    cost = PENALTY * np.log(np.maximum(np.add.reduceat(n, starts), 2))
    single = np.add.reduceat(n[:, None] * np.log(np.maximum(like, 1e-30)), starts, axis=0)
    live = np.arange(texts)
    for left in range(langs, 0, -1):
        top = pi[live].argmax(1)
        alone = single[live, top] >= best[live] - cost[live]
        pi[live[alone]] = np.eye(langs, dtype=np.float32)[top[alone]]
        live = live[~alone]
        if left <= 2 or not len(live):
            break
        fewer = on[live].copy()
        fewer[np.arange(len(live)), np.where(fewer > 0, pi[live], np.inf).argmin(1)] = 0
        rows, own = _of_texts(starts, len(n), live)
        p, ll = _shares(like[rows], n[rows], own, fewer)
        better = ll >= best[live] - cost[live]
        live = live[better]
        on[live], pi[live], best[live] = fewer[better], p[better], ll[better]
    return pi


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add lang_pred, score (the share of that language) and lang_shares (a map of all in the set)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logp.astype(np.float32)))

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_shares", T.MapType(T.StringType(), T.DoubleType()))])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, logp = shared.value
        memory: dict[str, int] = {}
        table = np.zeros((1024, len(langs)), np.float32)
        for texts in batches:
            pred, score, shares = np.full(len(texts), "und", object), np.zeros(len(texts)), [{} for _ in range(len(texts))]
            for lo in range(0, len(texts), 256):
                if len(memory) > MEMORY:
                    memory.clear()
                found = [Counter(LETTERS.findall(text.lower())) if text and langs else {} for text in texts.iloc[lo : lo + 256]]
                new = list(set().union(*found) - memory.keys())
                if new:
                    first = len(memory)
                    memory.update(zip(new, range(first, first + len(new))))
                    while len(memory) > len(table):
                        table = np.concatenate([table, np.zeros_like(table)])
                    grams, starts = _grams(new)
                    s = np.add.reduceat(logp[grams], starts, axis=0)
                    table[first : len(memory)] = np.exp(np.maximum(s - s.max(1, keepdims=True), -12))
                ids = [k for c in found for k in map(memory.__getitem__, c)]
                counts = [k for c in found for k in c.values()]
                sizes = [len(c) for c in found]
                full = np.flatnonzero(sizes)
                if len(full):
                    starts = np.append(0, np.cumsum(np.array(sizes)[full]))[:-1]
                    pi = infer(table[ids], np.array(counts, np.float32), starts)
                    for at, k, p in zip(full + lo, pi.argmax(1), pi):
                        pred[at], score[at] = langs[k], min(1.0, float(p[k]))
                        shares[at] = {langs[j]: float(p[j]) for j in np.flatnonzero(p)}
            yield pd.DataFrame({"lang_pred": pred, "score": score, "lang_shares": shares})

    @F.pandas_udf(kind)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return lean(run)(batches)

    return bounded_batches(docs).withColumn("_lang", udf(F.col(text_col))).withColumns({k: F.col(f"_lang.{k}") for k in ("lang_pred", "score", "lang_shares")}).drop("_lang")
