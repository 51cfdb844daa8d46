"""Best-fit packing with certified repacking.

Documents are dealt to partitions, each packed by best-fit decreasing. Dual-feasible
functions bound from below the bins that the documents of a partition, and of all together, need. While
bins and bound differ, the documents of bins with room left, in partitions with a gap, or with much room left, in any, are
dealt out anew and packed again, as long as that saves bins.

Null text counts as empty; each document ends with an end token, so none is empty. Repeated
rows are packed each for itself. Null ids are kept. Other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from strataflux.llm.bpe import byte_characters, tokenizer
from strataflux.llm.common import bounded_batches, discard, lean, materialise

#: Tokens in a sequence; documents in a partition; rounds of exchange, at most.
CAPACITY, PARTITION, ROUNDS = 4096, 50_000, 4
#: Cuts of words whose ids a task remembers.
MEMORY = 300_000
_plain = re.compile("(?!.*<\\|)[\0-\u012f\u0131-\u024f]*\\Z", re.S).match
#: Python splits at these as well, the tokenizer does not.
_splits = re.compile("[\x1c-\x1f]").search
#: The pre-tokenizer's pattern, a fixed value of the vocabulary file, for lower-cased plain text, whose letters may lie above U+024F.
_LOWERED = sorted(set(map(chr, range(0x250))).union(*(chr(c).lower() for c in range(0x250))))
_LETTERS, _NUMBERS = ("".join(c for c in _LOWERED if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}"))
_cuts = re.compile(rf"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+").findall
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Ids:
    """Ids of texts as bytes; what was encoded before is remembered within bounds.

    Below U+0250 Python and the tokenizer's normaliser lower alike (but for U+0130) and nothing is composed, so such
    text is cut by the pre-tokenizer's pattern, and the cuts that are new are encoded together by the tokenizer's model. The last
    token of a cut, and no other, ends a word. Any other word goes to the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known = tokenizer(path), {}
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.shown = {b: ord(c) for b, c in byte_characters().items()} | {32: 32}
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        self.ends[[i for token, i in self.model.get_vocab().items() if token.endswith("</w>")]] = True

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _encode(self, cuts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(cuts), 50_000):
            lines = " ".join(cuts[lo : lo + 50_000]).encode().decode("latin-1").translate(self.shown)
            ids = np.array(self.model.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            yield from (raw[a:b] for a, b in zip([0, *ends], ends))

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        if len(self.known) > MEMORY:
            self.known.clear()
        cuts, odd = [], set()
        for x in texts:
            if not x:
                cuts.append([])
            elif _plain(x):
                cuts.append(_cuts(x.lower()))
            elif _splits(x):
                cuts.append([x])
                odd.add(x)
            else:
                own = []
                for w in x.split():
                    if _plain(w):
                        own += _cuts(w.lower())
                    else:
                        own.append(w)
                        odd.add(w)
                cuts.append(own)
        self.known.update((w, self._whole(w)) for w in odd.difference(self.known))
        new = list(set().union(*cuts).difference(self.known))
        self.known.update(zip(new, self._encode(new), strict=True))
        known = self.known.__getitem__
        return (b"".join(map(known, x)) for x in cuts)


def pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every document, cut every ``capacity`` tokens.

    The tokenizer drops white space and no token crosses it, so words between white space have their ids for
    themselves.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Ids(path)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.iloc[lo : lo + 256]
                rows = []
                for i, ids in zip(part["id"].array, known.of(part["text"].tolist())):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((i, k, at // 4, len(own) // 4, zlib.crc32(own)))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(lean(run), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing of these lengths needs."""
    return bound(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound(n: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, from the count of each length: the best of two families of dual-feasible functions over all sizes."""
    size = np.arange(capacity + 1)
    best = -(-int((n * size).sum()) // capacity)
    # Sizes over capacity - a count as a whole bin, those under a as nothing.
    count, total = np.append(0, n.cumsum()), np.append(0, (n * size).cumsum())
    a = np.arange(capacity // 2 + 1)
    large = count[-1] - count[capacity - a + 1]
    middle = total[capacity - a + 1] - total[a]
    best = max(best, int((large + -(-middle // capacity)).max()))
    # A size is worth the whole parts of 1 / (k + 1) of the bin in it, over k; exact multiples keep their worth.
    for k in range(1, 33):
        q, r = np.divmod((k + 1) * size, capacity)
        worth = np.where(r == 0, size * k, q * capacity)  # in 1 / (k * capacity) of a bin
        best = max(best, -(-int((n * worth).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, largest first into the fullest bin with room; and the count of bins."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins = 0, 0
    of, at = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        fits = open_rooms >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, b = capacity, bins
            bins += 1
        of[k], at[k] = b, capacity - left
        if left > n:
            room[left - n].append(b)
            open_rooms |= 1 << (left - n)
    return of, at, bins


def pack(items: DataFrame, capacity: int = CAPACITY, partition: int = PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """Add sequence_id and offset to a table with the columns of :data:`PIECES`."""
    items = materialise(items)
    schema = f"{PIECES}, sequence_id long, offset long, gap long, fill long"

    def deal(rows: DataFrame, turn: int, count: int) -> DataFrame:
        groups = max(1, -(-count // partition))

        def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable")
            lengths = own["length"].to_numpy()
            of, at, bins = best_fit(lengths, capacity)
            fill = np.bincount(of, weights=lengths, minlength=bins)
            return own.drop(columns="_part").assign(sequence_id=(turn << 56) + (int(key[0]) << 32) + of, offset=at, gap=bins - lower_bound(lengths, capacity), fill=fill[of].astype(np.int64))

        part = F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(groups)).cast("int")
        return materialise(rows.select(*(x.split()[0] for x in PIECES.split(", "))).withColumn("_part", part).groupBy("_part").applyInPandas(run, schema))

    done: list[DataFrame] = []
    last = deal(items, 0, items.count())
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in items.groupBy("length").count().collect():  # a row for each length
        counts[length] = n
    total, needed = last.select("sequence_id").distinct().count(), bound(counts, capacity)
    for turn in range(1, rounds + 1):
        # Each partition may be certified and the whole still not: what bins with much room hold is exchanged as well.
        open_ = (F.col("fill") < capacity) & ((F.col("gap") > 0) | (F.col("fill") * 20 < capacity * 19))
        n, bins = last.where(open_).agg(F.count("*"), F.count_distinct("sequence_id")).head()
        if total <= needed or not n:
            break
        new = deal(last.where(open_), turn, n)
        saved = bins - new.select("sequence_id").distinct().count()
        if saved <= 0:
            discard(new)
            break
        total -= saved
        done.append(last.where(~open_))
        last = new
    for d in done:
        last = last.unionByName(d)
    return last.drop("gap", "fill")
