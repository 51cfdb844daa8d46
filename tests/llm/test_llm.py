"""The operators of the language-model subpackage against brute force on small tables with odd rows."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

pytest.importorskip("strataflux.llm")
from strataflux.llm import ann, bpe, html, langid, licenses, linededup, neardup, packing, quality, queries, substrings  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node int"
ODD = ["", " ", None, "a", "  a  b\n\n c \n d", "<|endoftext|> x<|endoftext|>y", "a\x1cb \x1c c", "İΣ ΑΣ. ñ ñ   x　y", "it's we'LL 've 12345 ½ ² 日本語テキスト!!", "\t\ta\r\n  b   ", "x   y", "👩‍👩‍👧 é ́x"]


def texts() -> list[tuple]:
    r = random.Random(3)
    base = [" ".join(r.choices("a b c d e f g h".split(), k=400)) for _ in range(5)]
    long = [" ".join(r.choices([f"w{k}" for k in range(3000)], k=200)) for _ in range(4)]
    out: list[str | None] = list(ODD)
    for _ in range(60):
        parts = []
        for _ in range(r.randint(0, 5)):
            x = r.random()
            if x < 0.3:
                parts.append(" ".join([r.choice("xyz")] * r.randint(1, 120)))
            elif x < 0.6:
                s = r.randint(0, 300)
                parts.append(" ".join(r.choice(base).split()[s : s + r.randint(40, 70)]))
            else:
                parts.append(" ".join(r.choices([str(k) for k in range(50)], k=r.randint(1, 90))))
        out.append("\n".join(parts))
    for x in long:
        for _ in range(25):
            w = x.split()
            for _ in range(r.randint(0, 9)):
                w[r.randrange(len(w))] = f"e{r.randint(0, 40)}"
            out.append(" ".join(w))
    out += [out[20], out[20], out[90], " ".join(["x"] * 3000)]
    rows = [(k, x, "en", "s", len(x or ""), 7) for k, x in enumerate(out)]
    return [*rows, (5, out[30], None, None, None, None), (20, out[20], "en", "s", 0, 1)]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("llm")
    spark.createDataFrame(texts(), DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    return str(d)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("none")
    spark.createDataFrame([], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return str(d)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, empty, name):
    assert queries.queries()[name](spark, empty).count() == 0


def test_language(spark, table):
    r = random.Random(1)
    words = {"xx": ["lorem", "ipsum", "dolor", "sita"], "yy": ["qwerk", "zuupf", "plaxx", "grubz"]}
    rows = [(k, " ".join(r.choices(words[x], k=30)), x) for k in range(40) for x in [("xx", "yy")[k % 2]]]
    rows += [(100, " ".join(words["xx"] * 9 + words["yy"] * 3), None), (101, None, "xx"), (102, "12 !!", "yy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x for x in langid.identify(df, langid.fit(df, F.col("doc_id") < 20)).collect()}
    assert all(got[k]["lang_pred"] == ("xx", "yy")[k % 2] for k in range(40))
    assert set(got[100]["lang_shares"]) == {"xx", "yy"} and got[100]["score"] == pytest.approx(0.75, abs=0.05)
    assert got[101]["lang_pred"] == got[102]["lang_pred"] == "und" and got[102]["score"] == 0


def plain_shares(model, text: str | None) -> dict[str, float]:
    """Shares of the languages of a text, word by word and language by language."""
    counts = Counter(regex.findall(r"\p{L}[\p{L}\p{M}]{0,23}", (text or "").lower()))
    like = []
    for w in counts:
        padded, total = f"^{w}$", np.zeros(len(model.langs))
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            h = (ord(a) * 0x9E3779B1 ^ ord(b) * 0x85EBCA77 ^ ord(c) * 0xC2B2AE3D) & 0xFFFFFFFF
            h = (h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
            total += model.logp[h >> 16]
        like.append(np.exp(np.maximum(total - total.max(), -12)))

    def em(on: list[int]) -> tuple[dict[int, float], float]:
        pi = {k: 1 / len(on) for k in on}
        for _ in range(langid.ROUNDS):
            new = dict.fromkeys(on, 0.0)
            for n, x in zip(counts.values(), like):
                whole = sum(pi[k] * x[k] for k in on)
                for k in on:
                    new[k] += n * pi[k] * x[k] / whole
            pi = {k: v / counts.total() for k, v in new.items()}
        return pi, sum(n * np.log(sum(pi[k] * x[k] for k in on)) for n, x in zip(counts.values(), like))

    if not counts or not model.langs:
        return {}
    on = list(range(len(model.langs)))
    pi, best = em(on)
    while len(on) > 1:
        fewer = [k for k in on if k != min(on, key=lambda j: pi[j])]
        p, ll = em(fewer)
        if ll < best - langid.PENALTY * np.log(max(counts.total(), 2)):
            break
        on, pi, best = fewer, p, ll
    return {model.langs[k]: v for k, v in pi.items()}


def test_language_equals_brute_force(spark):
    """Odd, long, repeated and mixed texts, with columns named like the results."""
    r = random.Random(11)
    words = {x: ["".join(r.choices(letters, k=r.randint(2, 7))) for _ in range(60)] for x, letters in {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "opqrstuü"}.items()}
    mixed = [(x, " ".join(r.choices(words[x], k=r.randint(1, 60)) + r.choices(words[r.choice("abc") * 2], k=r.choice([0, 0, 1, 4, 30])))) for x in r.choices(list(words), k=120)]
    rows = [(k, t, x, 1, "c") for k, (x, t) in enumerate(mixed)] + [(500, None, "aa", 1, "c"), (501, "", "aa", 1, "c"), (502, "12 \u0301 !", "aa", 1, "c"), (503, " ".join(words["bb"]) * 300, None, 1, "c"), (0, mixed[0][1], None, 1, "c"), (None, mixed[1][1], None, 1, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, lang_pred string")
    model = langid.fit(df, F.col("doc_id") < 100)
    assert model.langs == ["aa", "bb", "cc"]
    out = langid.identify(df, model)
    assert out.columns == ["doc_id", "text", "lang", "score", "lang_pred", "lang_shares"]
    got = out.collect()
    assert len(got) == len(rows)
    for x in got:
        want = plain_shares(model, x["text"])
        top = max(want.values(), default=0)
        assert (x["lang_pred"] == "und") == (not want) and x["score"] == pytest.approx(top, abs=2e-3)
        assert not want or want[x["lang_pred"]] == pytest.approx(top, abs=2e-3)
    none = langid.identify(df, langid.fit(df, F.lit(False)))
    assert {x["lang_pred"] for x in none.collect()} == {"und"}


def test_language_sets_equal_plain_elimination():
    """Few words of a second language, worth more than its cost but less than the costs of all other languages; and random texts."""
    few = np.full((195, 4), 1e-3, np.float32)
    few[:190, 0], few[190:, 1], few[190:, 0] = 1, 1, np.exp(-8)
    r = np.random.default_rng(2)
    texts = [few] + [np.exp(-r.uniform(0, 9, (r.integers(3, 200), 4)) * (np.arange(4) != r.choice(4, p=[0.9, 0.06, 0.03, 0.01]))).astype(np.float32) for _ in range(20)]
    for k in range(30):  # mixtures with a share of foreign words
        x = np.exp(-r.uniform(2, 9, (120, 4))).astype(np.float32)
        x[np.arange(120), np.where(np.arange(120) < k, 1 + k % 3, 0)] = 1
        texts.append(x)
    starts = np.append(0, np.cumsum([len(x) for x in texts]))[:-1]
    got = langid.infer(np.concatenate(texts), np.ones(sum(map(len, texts)), np.float32), starts)
    for x, p in zip(texts, got):
        n, at, on = np.ones(len(x), np.float32), np.array([0]), np.ones((1, 4), np.float32)
        want, best = langid._shares(x, n, at, on)
        while on.sum() > 1:
            fewer = on.copy()
            fewer[0, np.where(on[0] > 0, want[0], np.inf).argmin()] = 0
            pi, ll = langid._shares(x, n, at, fewer)
            if ll[0] < best[0] - langid.PENALTY * np.log(len(x)):
                break
            on, want, best = fewer, pi, ll
        assert (p > 0).tolist() == (want[0] > 0).tolist() and np.allclose(p, want[0], atol=1e-3)
    assert got[0, 1] > 0


def test_quality(spark, table):
    got = sorted(queries.op2_quality_cascade(spark, table).select("doc_id", "n_words", "n_repeat_words", "n_dup_lines", "word_chars").collect())
    want = []
    for i, x, *_ in texts():
        w = (x or "").encode().split()
        at = defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        lines = [y for y in (x or "").split("\n") if y.encode().split()]
        want.append((i, len(w), len({k + j for v in at.values() if len(v) > 1 for k in v for j in range(5)}), len(lines) - len(set(lines)), sum(len(y.decode()) for y in w)))
    assert [tuple(g) for g in got] == sorted(want)


def test_cascade_order_changes_no_verdict(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    rules = [quality.Rule("base", quality.base_failed(), ("n_words", "n_repeat_words")), *quality.default_rules()]
    lazy, turned = (quality.cascade(docs, r) for r in (rules, rules[::-1]))
    assert lazy.columns == [*docs.columns, "rejected_by", "passed"]
    full = quality.cascade(quality.features(docs), rules, given=quality.FEATURES)
    a, b, c = (sorted(map(str, x.select("doc_id", "text", "passed").collect())) for x in (lazy, turned, full))
    assert a == b == c and 0 < full.where("passed").count() < full.count()


def test_rules_are_ordered_by_rejection_per_cost(spark):
    """Costs are of features computed from text: windows of words cost more than a count of symbols."""
    r = random.Random(2)
    rows = [(k, " ".join(r.choices([f"w{j}" for j in range(999)], k=400)) + " #" * (200 * (k % 4 == 0))) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    dear = quality.Rule("dear", F.col("n_repeat_words") > F.col("n_words") / 4, ("n_repeat_words", "n_words"))
    cheap = quality.Rule("cheap", F.col("n_symbols") > 100, ("n_symbols",))
    never = quality.Rule("never", F.col("n_symbols") < 0, ("n_symbols",))
    found = quality.order_rules(docs, [never, dear, cheap])
    cost = {x.name: seconds for x, seconds, _ in found}
    assert cost["dear"] > 2 * cost["cheap"] and {x.name: share for x, _, share in found} == {"never": 0, "dear": 0.25, "cheap": 0.25}
    assert [x.name for x, _, _ in found] == ["cheap", "dear", "never"]


def test_html():
    page = "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav>menu</nav><div class='sidebar'>s</div><article><h1>Head</h1><p>One &amp; <b>two</b>x<br>y<p>Three<div class='comments'>no</div></article><footer>f</footer>"
    assert html.main_text(html.Page(page), []) == "Head One & twox y Three"
    assert html.main_text(html.Page("<body><div id=menu>m</div><div><p>Long text here</p><p>more</p></div><!-- x"), []) == "Long text here more"
    assert html.main_text(html.Page(""), []) == ""


def test_html_odd_quotes_and_columns(spark):
    """Odd quotes end soon, whatever follows; quoted elements are text of no block; repeated rows and columns named like intermediate ones."""
    assert html.main_text(html.Page("<a " + 'x="1" ' * 40), []) == "<a " + ('x="1" ' * 40).strip()
    assert html.main_text(html.Page('<p class="a>' * 5000 + "</p>"), []) == ""
    assert html.main_text(html.Page("<p title='x<b>y'>text</p><img src=\"data:" + "A" * 9000 + '"><p>after</p>'), []) == "text after"
    rows = [(1, "http://h/", "<p>" + "word " * 200000 + "</p>", "x", 2, "y")] * 2 + [(None, None, "", None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, template int, text string")
    out = html.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and sorted(r["n_chars"] for r in out.collect()) == [0, 999999, 999999]


def test_html_keeps_all_slots():
    """Pages without an article element: mostly lists, mostly a table, a longer nested section."""
    for inner, want in [
        ("<p>One</p><ul><li>A long item of the list</li><li>And another long item</li></ul><p>Two</p>", "One A long item of the list And another long item Two"),
        ("<p>One</p><table><tr><td>A long cell of the table<td>and another</table><p>Two</p>", "One A long cell of the table and another Two"),
        ("<p>One</p><section><p>A much longer paragraph of the section</p></section>", "One A much longer paragraph of the section"),
    ]:
        assert html.main_text(html.Page(f"<body><div id=menu>m</div><div>{inner}</div><footer>f</footer>"), []) == want


def test_html_template(spark):
    pages = [(k, "http://h.example/x", f"<body><div><p>Fixed line</p><p>Text {k} of its own</p><p>Bottom line</p></div></body>") for k in range(8)] + [(9, None, None)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Text {k} of its own" for k in range(8)} | {9: ""}


def test_html_copies_and_nesting(spark):
    """Edited copies of one article keep their text, with and without an article element; fixed text outside the article's slot goes."""
    paragraphs = [f"Paragraph {k} of the one article" for k in range(12)]
    edited = [[f"Edited {p} in page {k}" if p == k else x for p, x in enumerate(paragraphs)] for k in range(10)]
    body = lambda x: "".join(f"<p>{y}</p>" for y in x)
    rows, want = [], {}
    for k, x in enumerate(edited):
        rows += [(k, "http://a.example/", f"<body><article>{body(x)}</article></body>"), (100 + k, "http://b.example/", f"<body><div>{body(x)}</div></body>")]
        want |= {k: " ".join(x), 100 + k: " ".join(x)}
    for k in range(16):
        # Ten copies among other articles; a side note on most pages lies outside the article's slot.
        x = edited[k] if k < 10 else [f"Other {k} {p} words" for p in range(12)]
        side = "<p>Side note</p>" if k % 5 else ""
        rows.append((200 + k, "http://c.example/", f"<body><p>Top</p>{side}<h1>Head</h1><div>{body(x)}</div><p>Bottom</p></body>"))
        want[200 + k] = " ".join(x)
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want
    # Class 3 lies in two slots of class 2, which is on more pages.
    assert html.fixed_text([1, 5, 6, 5, 6, 7, 9], [1, 2, 3, 4, 5, 6], [1] * 5 + [9], [(1, 1, 0.0, True), (7, 1, 0.5, True), (5, 2, 0.1, False), (6, 3, 0.2, False)]) == {1, 7, 5}


def components(sets: list, percent: int) -> list[int]:
    par = list(range(len(sets)))

    def find(k):
        while par[k] != k:
            k = par[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                p, q = find(a), find(b)
                par[max(p, q)] = min(p, q)
    return [find(k) for k in range(len(sets))]


def test_near_duplicates(spark, table):
    rows = sorted(texts(), key=lambda r: r[0])
    shingles = []
    for _, x, *_ in rows:
        w = (x or "").encode().lower().split()
        shingles.append({tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set())
    roots = components(shingles, 85)
    least = defaultdict(lambda: 1 << 60)
    for k, r in enumerate(roots):
        least[r] = min(least[r], rows[k][0])
    want = sorted((rows[k][0], len(shingles[k]), least[r]) for k, r in enumerate(roots))
    docs = spark.read.parquet(f"{table}/documents.parquet")
    for sizes in ({}, {"few": 1, "small": 1, "block": 500}):  # the second branches at every level and cuts stars into blocks
        got = neardup.near_duplicates(docs, 3, 85, **sizes)
        assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == want


def test_crowded_nodes_get_a_further_pivot(spark):
    """Node 1 holds twenty alike classes among others, node 2 only classes that differ, node 3 few."""
    rows = [(1, k, 99) for k in range(20, 40)] + [(1, k, k) for k in range(10)] + [(2, k, k) for k in range(30)] + [(3, k, 7) for k in range(5)]
    got = neardup.crowd_pivots(spark.createDataFrame(rows, "node long, cls long, k0 long"), F.lit(0).cast("long")).collect()
    assert [tuple(r) for r in got] == [(1, 20)]


def test_forest_spans_the_links():
    r = np.random.default_rng(6)
    for n in (1, 2, 30):
        sets = [np.unique(r.choice(40, 30)) for _ in range(n)]
        links = neardup.forest(np.arange(n), sets, 60)
        roots, want = list(range(n)), components([set(x.tolist()) for x in sets], 60)
        for _ in range(n):
            for a, b in links:
                roots[a] = roots[b] = min(roots[a], roots[b])
        assert roots == want and len(links) == n - len(set(want))


def test_bpe_and_packing(spark, table):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    want = []
    for i, x, *_ in texts():
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r) for r in queries.op5_bpe(spark, table).collect()) == sorted(want)
    t = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    want = []
    for i, x, *_ in texts():
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want += [(i, k, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    got = queries.op8_packing(spark, table).toPandas()
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == np.append(0, own["length"].cumsum())[:-1].tolist() and own["length"].sum() <= 4096


def test_letters_whose_lower_case_lies_above_the_plain_range():
    """Every character below U+0250 beside others, and random strings of them, have the library's ids."""
    own = packing.Ids(queries.vocabulary("word_bpe_49k.json"))
    chars, r = [chr(c) for c in range(0x250)], random.Random(1)
    pool = chars + [" "] * 60 + list("abcdefghij'") * 6 + ["\u65e5", "\u00e9", "\u0301"]
    texts = [x for c in chars for x in (c + "a", "a" + c, c + "\u018f", "\u018f" + c, "1" + c, "'" + c)]
    texts += ["".join(r.choices(pool, k=r.randint(1, 12))) for _ in range(20_000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(own.of(texts)) == want


def test_bounds_never_exceed_packings():
    r = np.random.default_rng(4)
    for _ in range(60):
        x = r.integers(1, 101, r.integers(1, 80))
        of, at, bins = packing.best_fit(x, 100)
        assert packing.lower_bound(x, 100) <= bins and np.bincount(of, weights=x).max() <= 100
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3


def test_exchange_saves_bins(spark):
    rows = [(k, 0, 0, 60 if k % 2 else 40, 0) for k in range(400)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES), capacity=100, partition=40)
    assert got.count() == 400 and got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 100").count() == 0
    assert got.select("sequence_id").distinct().count() <= 204


def test_repeated_passages(spark, table):
    rows = texts()
    first: dict = {}
    for i, x, *_ in rows:
        w = (x or "").encode().split()
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, i), i)
    want = []
    for i, x, *_ in rows:
        w = (x or "").encode().split()
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = True
        want.append((i, len(w), int(gone.sum()), hashlib.sha256(b" ".join(y for y, g in zip(w, gone) if not g)).hexdigest()))
    assert sorted(tuple(r) for r in queries.op9_substring_dedup(spark, table).collect()) == sorted(want)
    assert substrings.without("a b\nc  d", [b"a", b"b", b"c", b"d"], np.array([0, 1, 0, 1], bool)) == ("a c  ",)


def test_neighbours(spark):
    r = np.random.default_rng(5)
    v = r.normal(size=(300, 16))
    v[50:90] = v[3]
    rows = [(k, [float(x) for x in y]) for k, y in enumerate(v)] + [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [1.0]), (None, [1.0] * 16)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).toPandas()
    s = v @ v.T
    hits = 0
    for q in range(0, 300, 20):
        order = sorted((k for k in range(300) if k != q), key=lambda k: (-round(s[q, k], 9), k))[:20]
        own = got[got.query_id == q].sort_values("rank")
        hits += len(set(order) & set(own.vec_id))
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own.score, s[q, own.vec_id.to_numpy()])
    assert hits >= 0.9 * 20 * 15 and set(got.query_id) == set(range(0, 300, 20))


def test_recall_and_axes(spark):
    """On the tables of test data: recall against brute force, and more axes where neighbours are nearer."""
    path = "/root/testdata/sf0.1/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no tables")
    rows = spark.read.parquet(path).select("vec_id", "embedding").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float)
    got = queries.op7_nearest_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    hits = asked = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(ids[np.argsort(-s, kind="stable")[:20]]) & set(got.vec_id[got.query_id == ids[q]]))
        asked += 20
    assert hits >= 0.9 * asked
    r = np.random.default_rng(2)
    for spread, least, most in ((30.0, 16, 128), (0.05, 256, 1024)):
        v = np.repeat(r.normal(size=(60, 64)), 25, axis=0) + spread * r.normal(size=(1500, 64))
        v /= np.sqrt((v * v).sum(1, keepdims=True))
        df = spark.createDataFrame([(k, [float(c) for c in y]) for k, y in enumerate(v)], "id long, v array<double>")
        assert least <= ann.fitted_axes(df, df.where("id % 20 = 0"), 20, ann.TABLES, ann.PROBES, 1.0) <= most


def test_licenses(spark):
    notice = licenses.TEMPLATES["GPL-3.0-notice"]
    rows = [(1, f"é words before. {notice} And after."), (2, "This work is licensed to no one under the sun"), (3, None), (4, "Intro. This work is licensed under the GNU General Publik License, version 3 too")]
    got = {(r["doc_id"], r["template"]): r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {(1, "GPL-3.0-notice"), (4, "GPL-3.0-notice")}
    assert got[1, "GPL-3.0-notice"]["text"] == notice.rstrip(".") and got[1, "GPL-3.0-notice"]["coverage"] == 1.0 and got[4, "GPL-3.0-notice"]["coverage"] < 1


def subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


def test_whole_licenses_equal_brute_force(spark):
    """Licenses with a title, a copyright line, changed words and lines cut anew, between other words: those found are those of which a text holds enough."""
    r = random.Random(4)
    rows = []
    for name in licenses.LICENSES:
        for share in (0.0, 0.05, 0.6):
            words = [w if r.random() >= share else f"x{r.randint(0, 99)}" for w in licenses.LICENSES[name].split()]
            text = "".join(w + (" " if r.random() < 0.9 else "\n") for w in words)
            other = " ".join(r.choices("lorem ipsum the software is provided of a copy".split(), k=60))
            rows.append((len(rows), f"{other}. Copyright (c) 2020 A B\n{text} {other}", name, share))
    rows += [(90, rows[0][1], None, None), (91, None, None, None), (92, "", None, None), (93, "the software " * 20000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, template string, coverage double")
    got = {(x["doc_id"], x["template"]): x for x in licenses.scan(df).collect()}
    for i, text, name, share in rows[:15] + rows[-3:]:
        own = licenses.tokens(text or "")[0]
        for k, v in licenses.LICENSES.items():
            body = licenses.tokens(v)[0]
            held = subsequence(body, own[:1500]) / len(body)
            if k == name and share < 0.5 or held < licenses.LEAST:
                assert ((i, k) in got) == (held >= licenses.LEAST), (i, k, held)
            if (i, k) in got:
                assert got[i, k]["coverage"] <= held + 1e-9 and text[got[i, k]["start"] : got[i, k]["end"]] == got[i, k]["text"]
    assert all(got[k, rows[k][2]]["coverage"] == 1 for k in range(0, 15, 3)) and {t for i, t in got if i == 90} == {t for i, t in got if i == 0}


def test_licenses_next_to_each_other(spark):
    mit, cc = licenses.TEMPLATES["MIT-notice"], licenses.TEMPLATES["CC-BY-NC-4.0-notice"]
    damaged = mit.replace("MIT", "MYT")
    texts = [f"{mit}\n{mit}", f"{cc} {cc}", f"x\n{mit}\n{mit}\ny {mit}", f"{damaged}\n{mit}", f"{mit}\n{damaged}", f"released so {mit} released"]
    want = [(k, x.rstrip(".")) for k, found in enumerate([[mit] * 2, [cc] * 2, [mit] * 3, [damaged, mit], [mit, damaged], [mit]]) for x in found]
    out = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id", "start").collect()
    assert [(r["doc_id"], r["text"]) for r in out] == want
    assert all(texts[r["doc_id"]][r["start"] : r["end"]] == r["text"] for r in out) and len({(r["doc_id"], r["start"]) for r in out}) == len(want)


def test_lines(spark):
    a = "one two three four five six seven eight nine ten eleven\nshort\nalpha beta gamma delta epsilon zeta eta theta iota kappa lamda"
    rows = [(1, a), (2, "new line of its own\n" + a.split("\n")[2]), (3, a), (4, "short"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in linededup.apply(df, linededup.repeated_lines(df)).collect()}
    assert got == {1: (a, 0), 2: ("new line of its own", 1), 3: ("", 3), 4: ("short", 0), 5: (None, 0), 6: ("", 0)}


def test_lines_equal_brute_force(spark):
    """Blocks in more than 50 documents, blocks whose lines first stand in different documents, and blocks in another order."""
    r = random.Random(5)
    words = lambda n: " ".join(r.choices([f"v{k}" for k in range(5000)], k=n))
    common, five, twelve = words(15), [words(5) for _ in range(6)], [words(12) for _ in range(6)]
    rows = [(1, f"{five[0]}\n{words(9)}"), (2, f"{words(9)}\n{five[1]}"), (3, f"{five[0]}\n{five[1]}"), (4, f"{words(20)}\n{five[0]}\n{five[1]}")]
    for k in range(5, 90):
        x = [common] * (k % 4 > 0) + [y for _ in range(r.randint(0, 4)) for y in r.choice([five[:2], five[2:5], [r.choice(five)], [r.choice(twelve)], ["", r.choice(twelve)], [twelve[0], "tail"], [words(r.randint(1, 9))]])]
        if k % 7 == 0:
            r.shuffle(x)
        rows.append((k, "\n".join(x)))
    # A document with one line of one other document, besides the block of many.
    rows += [(90, f"{common}\n{five[0]}"), (91, f"{words(3)} only here\n{common}"), (30, "\n".join([twelve[5], words(11)])), (92, f"{twelve[3]}\nonce\n{twelve[2]}"), (93, f"{twelve[2]}\nonce more\n{twelve[3]}")]
    rows.append((94, rows[-2][1].split("\n")[0] + f"\n{common}"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    runs = [{tuple(x[a:b]) for a in range(len(x)) for b in range(a + 1, len(x) + 1)} for x in (t.split("\n") for _, t in rows)]
    want = []
    for i, t in rows:
        x, gone = t.split("\n"), set()
        for a in range(len(x)):
            for b in range(a + 1, len(x) + 1):
                if sum(len(y.split()) for y in x[a:b]) >= 10 and any(j < i and tuple(x[a:b]) in own for (j, _), own in zip(rows, runs)):
                    gone.update(range(a, b))
        want.append((i, [y for k, y in enumerate(x) if y and k not in gone]))
    got = [(d["doc_id"], [y for y in d["text"].split("\n") if y]) for d in linededup.apply(df, linededup.repeated_lines(df)).collect()]
    assert sorted(got) == sorted(want)


def test_lines_of_repeated_ids(spark):
    """Rows of one id whose lines are the same in another order lose only what each of them shares with an earlier document; other columns stay."""
    a = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"{a}\nlast", 1), (5, f"{a}\nx y z\nq r s", 2), (5, f"q r s\nx y z\n{a}", 3), (6, "", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found int")
    got = {r["found"]: r["text"] for r in linededup.apply(df, linededup.repeated_lines(df)).collect()}
    assert got == {1: f"{a}\nlast", 2: "x y z\nq r s", 3: "q r s\nx y z", 4: ""}


def test_passages_of_two_words(spark):
    """Complementary sequences of two words, which polynomial names take for equal."""
    order = [bin(k).count("1") % 2 for k in range(1024)]
    head = " ".join(f"u{k}" for k in range(10))
    rows = [(1, f"{head} {' '.join('ab'[k] for k in order)}", 0), (2, f"{head} {' '.join('ba'[k] for k in order)}", 0), (3, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, result int")
    first, want = {}, {3: 0}
    for i, x, _ in rows[:2]:
        w, gone = x.split(), set()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) < i:
                gone.update(range(k, k + 50))
        want[i] = len(gone)
    out = substrings.apply(df, substrings.repeats(df), lambda text, words, gone: (int(gone.sum()),), "n long")
    assert {r["doc_id"]: r["result"]["n"] for r in out.collect()} == want


def test_one_of_each_group_stays(spark):
    r = random.Random(9)
    a, b = (" ".join(r.choices([f"w{k}" for k in range(500)], k=80)) for _ in range(2))
    rows = [(2, a), (5, a), (5, b), (7, b), (8, f"{a} tail"), (9, "all on its own here"), (9, "all on its own here"), (None, a), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in neardup.one_of_each(df).collect()]
    assert sorted(got, key=str) == sorted([(2, a), (5, b), (9, "all on its own here"), (None, a), (3, None), (4, "")], key=str)


def test_patience_is_an_alignment():
    r = random.Random(1)
    for _ in range(500):
        a, b = ([r.randint(1, 9) for _ in range(r.randint(0, 14))] for _ in range(2))
        pairs = sorted(linededup.patience(a, b))
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_pipeline(spark, table):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{table}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, table)
        assert out.columns == pipeline.COLUMNS, name
        assert out.count() <= docs.count()
        docs = pipeline.materialise(out)
    packed = pipeline.STAGES[-1][1](spark, docs, table)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").distinct().collect()}


def test_words_rejoin():
    for x in ODD:
        if x:
            assert "".join(bpe.split_words(x)) == x


def test_no_line_goes_without_an_alignment(spark):
    """Blocks in another order go by alignments of their own; nothing goes where nothing is aligned."""
    one, two, three = (" ".join(f"{c}{k}" for k in range(12)) for c in "xyz")
    df = spark.createDataFrame([(1, f"{one}\n{two}\nm\n{one}"), (2, f"{two}\nown\n{one}\n{three}")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.apply(df, linededup.repeated_lines(df)).collect()}
    assert got[2] == f"own\n{three}"
    before = linededup.patience
    try:
        linededup.patience = lambda a, b: []
        assert linededup.repeated_lines(df.withColumn("text", F.col("text"))).count() == 0
    finally:
        linededup.patience = before
