"""The manifest against one built in Python."""

from __future__ import annotations

import hashlib
import random
import string
import zlib

import pytest

pytest.importorskip("strataflux.llm")
from strataflux.llm import queries  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, level int, kids string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def H(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False) -> str:
    i, text, lang, source, n = row[:5]
    if lower and text is not None:
        text = text.translate(LOWER)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def raised(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The last node, and for each first node the siblings level by level."""
    at, proofs, below = list(nodes), [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(at) > 1:
        up, ups = [], []
        for lo in range(0, len(at), 16):
            run = at[lo : lo + 16]
            for k in range(len(run)):
                for leaf in below[lo + k]:
                    proofs[leaf].append((run[:k], run[k + 1 :]))
            up.append(H(*run))
            ups.append([x for b in below[lo : lo + 16] for x in b])
        at, below = up, ups
    return at[0], proofs


def brute(rows) -> list[tuple]:
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = (own, *raised([leaf_of(r) for r in own]))
    root, above = raised([trees[s][1] for s in sources])
    out = []
    for s, up in zip(sources, above):
        own, subroot, proofs = trees[s]
        for r, p in zip(own, proofs):
            steps = p + up
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            x = leaf_of(r, tampered)
            for a, b in steps:
                x = H(*a, x, *b)
            out.append((r[0], leaf_of(r), subroot, root, H(*(h for a, b in steps for h in a + b)), x, x == root))
    return out


def rows_of(kind: str) -> list[tuple]:
    r = random.Random(4)
    word = lambda: r.choice(["Ab", "ç É", "x", "", "ÜB\n", "a" * 50])
    if kind == "one":
        return [(7, "One", "en", "s", 3, 1, "k")]
    if kind == "one source":
        return [(k, word(), "en", None, 3, 1, "k") for k in range(300)]
    rows = [(k, word() + word(), r.choice(["en", None]), f"s{r.randrange(20)}", r.choice([k, None]), 1, "k") for k in range(300)]
    rows += [(k + 1000, word(), "de", "hot", 2, 1, "k") for k in range(257)]
    rows += [(5, "Same", "en", "", 4, 1, "k"), (5, "Same", "en", "", 4, 1, "k"), (5, "Other", "en", "", 4, 1, "k"), (None, None, None, None, None, None, None), (None, "N", "x", "hot", 1, 1, "k"), (3, "a" * 300_000 + "B", "en", "Lone é", 1, 1, "k")]
    return rows


@pytest.mark.parametrize("kind", ["one", "one source", "many"])
def test_manifest(spark, tmp_path, kind):
    rows = rows_of(kind)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda t: (t[0] is not None, t[0] or 0, *map(str, t[1:]))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_copies_of_high_nodes(spark, tmp_path, monkeypatch):
    """Node rows stored in many copies, over which runs are dealt, give the same."""
    from strataflux.llm import merkle

    monkeypatch.setattr(merkle, "COPY_LEAVES", 20)
    test_manifest(spark, tmp_path, "many")
