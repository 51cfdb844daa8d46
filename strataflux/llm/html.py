"""Main text of web pages by template deduction.

A page is a sequence of tokens: its elements, named by their path, and its blocks of text. Tokens that occur equally
often on the same pages of a host have equal occurrence vectors and form an equivalence class. Pages with equal bodies count
once, so copies of an article make no template; a host whose pages share most of their text holds near copies of one page
and has none either. A class is large if most pages of the host have it, and valid on a page if its tokens come in the class's
order. The root is the class of tokens that are once on every page. Valid classes are nested: a class is dropped unless all of its
tokens lie in one slot, between neighbouring tokens, of each larger class. The slot of the root with most text is the
article's. Text of the root, and text of nested classes outside the article's slot, is template, except inside ``article`` and
``main``, which are slots by name. What is not template is kept where it belongs to the article: inside ``article`` or
``main``, else anywhere. Elements that no article consists of (menus, forms,
asides, ...) are left out by name, role, class or id on every page, so that hosts with few pages need no template.

Null html counts as empty and gives empty text. A null url makes a host of its own. Null ids and repeated rows give a row each.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from strataflux.llm.common import BROADCAST_IDS, bounded_batches, materialise

#: Pages that a host needs for a template, and the share of them that a large class is on.
LEAST_PAGES, LARGE = 4, 0.6
#: Mean share of a page's text in large classes from which pages of a host are near copies.
COPIES = 2 / 3
#: Stands for the page itself among its tokens.
_PAGE = 0
#: Parts into which the pages of a host are dealt where its template is too large to be sent to all tasks.
SALT = 16
#: A quoted value ends before the next element or within 4,096 characters, so that an odd quote costs no search to the page's end.
_TOKENS = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title|select|object|canvas)\b(?:[^>\"']|\"[^\"<]*(?:\"|<[^\"]{0,4096}\")|'[^'<]*(?:'|<[^']{0,4096}'))*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"<]*(?:\"|<[^\"]{0,4096}\")|'[^'<]*(?:'|<[^']{0,4096}'))*)>|<[!?][^>]*>|[^<]+|<", re.S | re.I)
_ATTRIBUTES = re.compile(r"(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr".split())
_OUT = frozenset("head nav footer aside form button menu dialog input datalist fieldset".split())
_OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banners?|sponsor(?:ed|s)?|promos?|promotions?|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footers?|headers?|masthead|cookies?|consent|notices?|gdpr|"
    r"comments?|replies|discussion|disqus|share|sharing|social|related|recommend(?:ed|ations)?|subscribe|subscription|newsletter|signup|popups?|modal|overlay|widgets?|login|search|toolbar|pagination|pager|skip|"
    r"topbar|sitemap|copyright|tags?|rail)(?:$|[\s_-]|\d)",
    re.I,
)
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())


class Page:
    """Blocks of text of a page: (text, path, in article, left out), and its elements with the number of blocks before each, in page order."""

    __slots__ = ("blocks", "elements")

    def __init__(self, html: str):
        self.blocks: list[tuple[str, str, bool, bool]] = []
        self.elements: list[tuple[str, int]] = []
        stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # name, path, in article, left out
        run: list[str] = []
        state = stack[0]

        def flush() -> None:
            if run:
                text = " ".join("".join(run).split())
                if text:
                    self.blocks.append((text, *state[1:]))
                run.clear()

        for m in _TOKENS.finditer(html):
            if m.group(3) is None:
                if m.group()[0] != "<" or m.group() == "<":
                    if not run:
                        state = stack[-1]
                    run.append(unescape(m.group()))
                continue
            name = m.group(3).lower()
            if name not in _INLINE:
                if name == "br":
                    run.append(" ")
                    continue
                flush()
            if m.group(2):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        if name not in _INLINE or all(x[0] in _INLINE for x in stack[k:]):
                            del stack[k:]
                        break
                continue
            if name in _VOID:
                continue
            if name not in _INLINE:
                # A new block ends an open paragraph; a new item or cell ends the one before.
                for k in range(len(stack) - 1, 0, -1):
                    open_ = stack[k][0]
                    if open_ == "p" or open_ == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                        del stack[k:]
                        break
                    if open_ not in _INLINE:
                        break
            _, path, inside, out = stack[-1]
            article = inside or name in ("article", "main")
            if not out:
                out = name in _OUT or name == "header" and not inside
                if not out and m.group(4) and name not in ("html", "body", "article", "main"):
                    for a in _ATTRIBUTES.finditer(m.group(4)):
                        key, value = a.group(1).lower(), (a.group(2) or a.group(3) or a.group(4) or "")
                        out |= key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.lower() in _OUT_ROLES or key in ("class", "id") and bool(_OUT_NAMES.search(value))
                if m.group(4) and "role" in m.group(4) and re.search(r"role\s*=\s*[\"']?(main|article)\b", m.group(4), re.I):
                    article = True
            if name not in _INLINE:
                path = f"{path}/{name}"
                self.elements.append((path, len(self.blocks)))
            stack.append((name, path, article, out))
        flush()


def _key(kind: str, *parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join((kind, *parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


def tokens(page: Page) -> tuple[list[int], list[int]]:
    """Tokens in page order of their kinds, elements by path and blocks of text by path, and the places of the blocks among them."""
    own: list[int] = []
    places: list[int] = []
    k = 0
    for path, before in [*page.elements, ("", len(page.blocks))]:
        for b in page.blocks[k:before]:
            places.append(len(own))
            own.append(_key("t", b[1], b[0]))
        k = before
        own.append(_key("e", path))
    return own[:-1], places


def fixed_text(own: list[int], places: list[int], sizes: list[int], template: list[tuple[int, int, float, bool]]) -> set[int]:
    """Tokens of a page that are template. sizes: characters of each block; template: (token, class, order, on all pages) of the host's large classes, those on most pages first."""
    at: defaultdict[int, list[int]] = defaultdict(list)
    for k, t in enumerate(own):
        at[t].append(k)
    classes: defaultdict[int, list[tuple[float, int, bool]]] = defaultdict(list)
    for t, c, order, everywhere in template:
        if t in at:
            classes[c].append((order, t, everywhere))
    root: list[int] = []
    nested: list[list[int]] = []
    for members in classes.values():
        first = [at[t][0] for _, t, _ in sorted(members)]
        if first != sorted(first):
            continue
        if members[0][2] and len(at[members[0][1]]) == 1:
            root = first
        else:
            nested.append(sorted(k for _, t, _ in members for k in at[t]))
    slots = [0] * (len(root) + 1)
    fixed = {own[k] for k in root}
    for k, n in zip(places, sizes):
        if own[k] not in fixed:
            slots[bisect(root, k)] += n
    article = slots.index(max(slots))
    valid = [root]
    for own_places in nested:
        if all(bisect(x, own_places[0]) == bisect(x, own_places[-1]) for x in valid):
            valid.append(own_places)
            if bisect(root, own_places[0]) != article:
                fixed.update(own[k] for k in own_places)
    return fixed


def main_text(page: Page, template: list[tuple[int, int, float, bool]]) -> str:
    """The text left in the article. template: as for :func:`fixed_text`."""
    kept = [b for b in page.blocks if not b[3]]
    if any(b[2] for b in kept):
        return " ".join(b[0] for b in kept if b[2])
    if not template:
        return " ".join(b[0] for b in kept)
    own, places = tokens(page)
    fixed = fixed_text(own, places, [0 if b[3] else len(b[0]) for b in page.blocks], template)
    return " ".join(b[0] for b, k in zip(page.blocks, places) if not b[3] and own[k] not in fixed)


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, body, token, n, place, size): how often each token is on a page, where first, from 0 to 1, and its characters of text that is not left out. The page's own token has all of these as its place."""
    for b in batches:
        for lo in range(0, len(b), 200):
            hosts, bodies, keys, counts, places, sizes = [], [], [], [], [], []
            for host, html in zip(b["host"].iloc[lo : lo + 200], b["html"].iloc[lo : lo + 200]):
                page = Page(html or "")
                own, at = tokens(page)
                body = _key("b", *(x[0] for x in page.blocks if x[2]), *(x[0] for x in page.blocks if not x[3]))
                seen = Counter(own)
                first: dict[int, int] = {}
                for k, t in enumerate(own):
                    first.setdefault(t, k)
                size: Counter[int] = Counter()
                for k, x in zip(at, page.blocks):
                    size[own[k]] += 0 if x[3] else len(x[0])
                hosts += [host] * (len(seen) + 1)
                bodies += [body] * (len(seen) + 1)
                keys += [_PAGE, *seen]
                counts += [1, *seen.values()]
                places += [float(size.total()), *(first[t] / len(own) for t in seen)]
                sizes += [0, *(size[t] for t in seen)]
            yield pd.DataFrame({"host": hosts, "body": np.array(bodies, np.int64), "token": np.array(keys, np.int64), "n": np.array(counts, np.int32), "place": np.array(places, float), "size": np.array(sizes, np.int32)})


def templates(pages: DataFrame) -> DataFrame:
    """(host, template) from (host, html): the text tokens and elements of the large classes of each host that has enough pages."""
    each = pages.mapInPandas(_occurrences, "host string, body long, token long, n int, place double, size int")
    once = each.groupBy("host", "body", "token").agg(F.max("n").alias("n"), F.min("place").alias("place"), F.max("size").alias("size"))
    vector = once.groupBy("host", "token").agg(F.count("*").alias("pages"), F.bit_xor(F.xxhash64("body", "n")).alias("class"), F.avg("place").alias("order"), F.sum("size").alias("size"))
    vector = materialise(vector.where(F.col("pages") >= LEAST_PAGES))
    total = vector.where(F.col("token") == _PAGE).select("host", F.col("pages").alias("all"), (F.col("order") * F.col("pages")).alias("text"))
    large = vector.where(F.col("token") != _PAGE).join(total, "host").where(F.col("pages") >= F.col("all") * LARGE)
    own = F.sort_array(F.collect_list(F.struct("pages", "class", "token", "order", (F.col("pages") == F.col("all")).alias("everywhere"))), asc=False)
    found = large.groupBy("host").agg(own.alias("template"), F.sum("size").alias("size"), F.max("text").alias("text"))
    return materialise(found.where(F.col("size") < F.col("text") * COPIES).select("host", "template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = bounded_batches(pages).select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    found = templates(rows.select("host", "html"))

    @F.pandas_udf("string")
    def text(htmls: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for html, t in zip(htmls, found):
            out.append(main_text(Page(html or ""), [(x["token"], x["class"], x["order"], x["everywhere"]) for x in t] if t is not None else []))
        return pd.Series(out, dtype=object)

    size = found.agg(F.sum(F.size("template"))).head()[0] or 0
    if size <= BROADCAST_IDS:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int")).join(salted, ["host", "salt"], "left")
    out = joined.select("page_id", "url", text("html", "template").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
