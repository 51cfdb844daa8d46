"""The prefix trie against one built in Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("strataflux.llm")
from strataflux.llm import prefixes, queries  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, depth int, kid string"


def brute(rows, heads=True) -> list[tuple]:
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if heads else 0
        base = c - c % 100 if c >= 0 else c + (-c) % 100
        convs[c] = (own.get(base, [])[:h] if heads else []) + v[h:]
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = defaultdict(list)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved, out = {}, {}, []
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = sum(saved[k] for k in kids[n]) + (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
        ends = hashlib.sha256(",".join(map(str, sorted(c for c in members[n] if len(convs[c]) == len(n)))).encode()).hexdigest()
        out.append((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(kids[n]), leaves[n], saved[n], ends))
    return out


def rows_of(seed: int) -> list[tuple]:
    r = random.Random(seed)
    out = []
    stock = [(r.choice(["user", "assistant", None, ""]), r.choice(["", None, "a", "é" * r.randint(1, 9), f"t{k}"])) for k in range(6)]
    for c in [*range(0, 40), *range(95, 130), 200, 203, 305, 306, 307, 2**40 + 7, -3, -100, -101]:
        for t in range(r.choice([1, 1, 2, 3, 5, 7, 9])):
            out.append((c, r.choice([t, t, t, t + 20, None]) if c % 7 == 0 else t, *r.choice(stock[: r.randint(1, 6)]), None, "x"))
    for c in range(400, 470):  # copies of a long one, and others that leave it late
        for t in range(60 if c % 3 else 40 + c % 20):
            out.append((c, t, "user", f"same {t}" if t < 58 or c % 2 else f"own {c}", None, None))
    out += [(None, 1, "user", "lost", None, None), (500, 0, "u", "x" * 200_000, 1, "k")]
    # Repeated rows; equal numbers only where the rows are equal, as other ties have an order of their own.
    seen = {}
    out = [x for x in out if seen.setdefault((x[0], x[1]), x) is x]
    return out + [out[3], out[3], out[50]]


@pytest.mark.parametrize("seed", [1])
def test_trie(spark, tmp_path, seed):
    rows = rows_of(seed)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_prefix_trie(spark, str(tmp_path))
    assert got.columns == prefixes.NODE
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_without_heads_small_chunks_and_blocks(spark, monkeypatch):
    """Conversations over many chunks, and lists of ids over many blocks."""
    monkeypatch.setattr(prefixes, "CHUNK", 7)
    rows = rows_of(3) + [(c, 0, "u", "hello", None, None) for c in range(10_000, 19_000)]
    got = prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, False), key=str)


def test_equal_numbers_have_one_order(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "b"), (2, 0, "u", "b"), (2, 0, "u", "a")]
    got = prefixes.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert got.where("depth = 2").select("conv_id", "n_convs").collect() == [(1, 2)]
    assert got.agg(F.sum("n_leaves")).head()[0] == 3
