"""BPE encoding and decoding by a table of distinct words.

1. Texts are cut where a space follows a character that is no white space. No token of a
   byte-level BPE crosses such a place, so each word has its ids whatever stands around it.
   A task numbers the words of a chunk of texts, commonest first, and writes the numbers of
   each text, and the words of the chunk dealt into parts by their hash.
2. Each part meets in one task, which encodes every distinct word of the corpus once.
3. Each chunk meets the ids of its own words again and puts them in the places of its words;
   pieces found by id give the decoded text.

Only words that differ within a chunk are shuffled, and their ids back; numbers wait in buckets by chunk.
Null and empty texts have no ids and decode to the empty text. Null ids and repeated rows
give a row each. Other columns are left out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strataflux.llm.common import bounded_batches, discard, materialise, materialise_bucketed

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words in a chunk, and texts in a row of numbers.
CHUNK_WORDS, BLOCK_TEXTS = 6_000_000, 256
_odd = re.compile(r"\s ").search
_cut = re.compile(r"(?<=\S)(?= )").split


@lru_cache(4)
def tokenizer(path: str):
    """The tokenizer of a file; each Python worker reads it once."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_characters() -> dict[int, str]:
    """How byte-level vocabularies show a byte: as its own character if that is printable, else as the next one from U+0100 on."""
    out: dict[int, str] = {}
    for b in range(256):
        printable = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
        out[b] = chr(b) if printable else chr(256 + sum(ord(c) > 255 for c in out.values()))
    return out


@lru_cache(4)
def pieces(path: str) -> list[bytes]:
    """The bytes of each id."""
    to_byte = {c: b for b, c in byte_characters().items()}
    vocab = tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
    return out


def split_words(text: str) -> list[str]:
    """Words whose concatenation is the text; each but the first begins with a space."""
    if _odd(text):
        return _cut(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [f" {x}" for x in rest]


def _pack(a: np.ndarray) -> bytes:
    """int32 numbers, lowest bytes first, which compresses well as most numbers are small."""
    return zstandard.compress(np.ascontiguousarray(a.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _gather(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``at`` of ragged ``values``, one after the other, and their lengths."""
    n = np.diff(ends, prepend=0)[at]
    if not n.sum():
        return values[:0], n
    shift = np.repeat(ends[at] - n.cumsum(), n)
    return values[np.arange(len(shift)) + shift], n


_CHUNKS = "chunk long, part int, ids binary, nulls binary, sizes binary, codes binary, words binary"


def _number(parts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, k = TaskContext.get().partitionId() << 32, 0
        known: defaultdict[str, int] = defaultdict()
        known.default_factory = known.__len__
        held: list[tuple[int | None, np.ndarray]] = []
        total = 0

        def flush() -> Iterator[pd.DataFrame]:
            codes = np.concatenate([c for _, c in held])
            seen = np.bincount(codes, minlength=len(known))
            order = np.argsort(-seen, kind="stable")
            rank = np.empty(len(known), np.int32)
            rank[order] = np.arange(len(known))
            rows = []
            for lo in range(0, len(held), BLOCK_TEXTS):
                block = held[lo : lo + BLOCK_TEXTS]
                ids = np.array([i or 0 for i, _ in block], "<i8")
                rows.append((base + k, None, ids.tobytes(), bytes(i is None for i, _ in block), _pack(np.array([len(c) for _, c in block])), _pack(rank[np.concatenate([c for _, c in block])]), None))
            words = [w.encode("utf-8", "surrogatepass") for w in known]
            part = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % parts
            part = part[order]
            by_part = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[by_part], np.arange(parts + 1))
            for p in range(parts):
                own = by_part[bounds[p] : bounds[p + 1]]
                if len(own):
                    mine = [words[j] for j in order[own]]
                    rows.append((base + k, p, None, None, _pack(np.array([len(w) for w in mine])), _pack(np.diff(own, prepend=0)), zstandard.compress(b"".join(mine), 1)))
            for lo in range(0, len(rows), 64):
                yield pd.DataFrame(rows[lo : lo + 64], columns=[x.split()[0] for x in _CHUNKS.split(", ")]).astype({"part": "Int32"})

        for b in batches:
            for i, text in zip(b["id"].array, b["text"]):
                words = split_words(text) if text else []
                held.append((None if pd.isna(i) else int(i), np.fromiter(map(known.__getitem__, words), np.int32, len(words))))
                total += len(words)
                if total >= CHUNK_WORDS:
                    yield from flush()
                    k, total = k + 1, 0
                    known.clear()
                    held.clear()
        if held:
            yield from flush()

    return run


def _encode(path: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        words = []
        for sizes, blob in zip(rows["sizes"], rows["words"]):
            raw, ends = zstandard.decompress(blob), _unpack(sizes).cumsum()
            words.append([raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends[:-1]], ends)])
        known = dict.fromkeys(w for own in words for w in own)
        for w, e in zip(known, tokenizer(path).encode_batch(list(known), add_special_tokens=False)):
            known[w] = e.ids
        out = [[known[w] for w in own] for own in words]
        return pd.DataFrame({"chunk": rows["chunk"], "sizes": [_pack(np.array([len(x) for x in own])) for own in out], "codes": rows["codes"], "tokens": [_pack(np.array([i for x in own for i in x], np.int32)) for own in out]})

    return run


def encode(docs: DataFrame, path: str, finish: Callable[[np.ndarray, bytes], tuple], schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its id, then ``finish(ids as uint32, decoded text as UTF-8)``, which has the columns of ``schema``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = materialise_bucketed(bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(_number(parts), _CHUNKS), "chunk", parts)
    tokens = chunks.where("part is not null").select("chunk", "part", "sizes", "codes", "words").groupBy("part").applyInPandas(_encode(path), "chunk long, sizes binary, codes binary, tokens binary")
    names = ["doc_id", *(x.split()[0] for x in schema.split(", "))]

    def assemble(blocks: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        at, sizes, ids = [], [], []
        for row in parts.itertuples():
            at.append(_unpack(row.codes).cumsum())
            sizes.append(_unpack(row.sizes))
            ids.append(_unpack(row.tokens))
        at, sizes, ids = (np.concatenate(x) if x else np.empty(0, np.int32) for x in (at, sizes, ids))
        order = np.argsort(at)
        flat, n = _gather(ids, sizes.cumsum(), order)  # ids of each word, by the word's number
        ends, piece, out = n.cumsum(), pieces(path), []
        for row in blocks.itertuples():
            doc, null, texts = np.frombuffer(row.ids, "<i8"), row.nulls, _unpack(row.sizes)
            values, lengths = _gather(flat, ends, _unpack(row.codes))
            bounds = np.append(0, lengths.cumsum())[np.append(0, texts.cumsum())]
            for k in range(len(doc)):
                own = values[bounds[k] : bounds[k + 1]].astype("<u4")
                out.append((None if null[k] else int(doc[k]), *finish(own, b"".join([piece[i] for i in own.tolist()]))))
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    blocks = chunks.where("part is null").select("chunk", "ids", "nulls", "sizes", "codes")
    out = materialise(blocks.groupBy("chunk").cogroup(tokens.groupBy("chunk")).applyInPandas(assemble, f"doc_id long, {schema}"))
    discard(chunks)
    return out
