"""Main text of web pages by nearest-URL page differencing.

A page becomes a list of text lines, one per block, each with its zone: inside
the article, in page furniture (menus, headers, footers, sidebars, adverts,
notices, forms, comments: told by element, role, class or id), or open. Pages
of a host are ranked by URL path; every page is paired with the neighbour of
the nearest path that is not a copy of it, the two lists are aligned by their
longest common subsequence, and open lines that both have are deleted.

A page with an article keeps the article's lines, shared ones too: articles
of one host quote the same sentences, and deleting those loses text. A page
without one keeps the open lines that its neighbour does not have.

A host of any size is cut into chunks of neighbouring paths; a chunk's first
and last pages are company for the chunks beside it. The alignment works on
hashes of the lines, so a page's text moves once, to meet its deletions.
"""

from __future__ import annotations

import html
import re
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import tokens as T
from featurelens.llm.tables import ready, stage
from featurelens.operators.ranking import running_total

CHUNK = 64
REACH = 4
COPY = 0.8

# Elements by what they hold.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "svg", "math", "title", "object", "select", "canvas", "audio", "video"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head"}
ARTICLE = {"article", "main"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
         "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody",
         "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
NAMES = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
         "cookie", "cookies", "disclaimer", "disqus", "footer", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "search", "share", "sharing",
         "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
ROLES = {"alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "navigation", "search", "toolbar"}
OPEN, MAIN, OFF = 0, 1, 2

_TAG = re.compile(r"""(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")


def _zone(tag: str, attrs: str, outer: int) -> int:
    if outer == OFF:
        return OFF
    if tag in FURNITURE or (tag == "header" and outer != MAIN):
        return OFF
    if attrs and tag not in ("html", "body"):
        at = {k.lower(): v.strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
        if at.get("role") in ROLES or at.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs.lower()):
            return OFF
        if tag not in ARTICLE and NAMES & set(re.split(r"[\s_-]+", f"{at.get('class', '')} {at.get('id', '')}")):
            return OFF
        if at.get("role") == "main":
            return MAIN
    return MAIN if tag in ARTICLE else outer


def page_lines(page: str) -> list[tuple[str, int]]:
    """(text, zone) of the page's blocks in order; blank blocks are left out."""
    out, text, stack, at = [], [], [("", OPEN)], 0

    def end_block():
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            out.append((line, stack[-1][1]))
        text.clear()

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            lt = len(page)
        if lt > at:
            text.append(page[at:lt])
        if lt == len(page):
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page[lt + 1:lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = len(page) if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt + 1)
        if m is None:
            text.append("<")
            at = lt + 1
            continue
        close, tag, attrs = m[1], m[2].lower(), m[3]
        at = m.end()
        if tag in RAW and not close:
            if not attrs.endswith("/"):
                found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = found.end() if found else len(page)
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
        if tag in BLOCK:
            end_block()
        if tag in VOID or tag == "p" or tag not in BLOCK and not attrs:
            continue
        if close:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if tag not in BLOCK and stack[i][1] != stack[-1][1]:
                        end_block()
                    del stack[i:]
                    break
        elif not attrs.endswith("/"):
            zone = _zone(tag, attrs, stack[-1][1])
            if tag in BLOCK or zone != stack[-1][1]:
                if tag not in BLOCK:
                    end_block()
                stack.append((tag, zone))
    end_block()
    return out


def shared_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``
    (bit-parallel: one word operation per line of ``b``)."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s, rows = full, []
    for y in b:
        u = s & places.get(y, 0)
        s = ((s + u) | (s - u)) & full
        rows.append(s)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        if j and not rows[j - 1] >> (i - 1) & 1:
            continue
        i -= 1
        out.append(i)
    return out[::-1]


def _kept(page: str | None) -> tuple[list[tuple[str, int]], int]:
    """The page's lines outside its furniture, and how many lines it has."""
    lines = page_lines(page or "")
    return [x for x in lines if x[1] != OFF], len(lines)


def _sign(batches):
    """Line hashes of a page, and whether it has an article."""
    for b in batches:
        out = []
        for page in b["html"].to_pylist():
            lines, _ = _kept(page)
            words = pa.array([x for x, _ in lines], pa.string())
            data, offs = T.text_buffer(words)
            out.append((T.word_hashes(data, offs[:-1], offs[1:], False).tobytes(), any(z == MAIN for _, z in lines)))
        yield pa.RecordBatch.from_arrays(
            [b["rk"], b["host"], b["path"], pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.bool_())],
            ["rk", "host", "path", "signs", "has_article"])


def _lines(batches):
    """The lines a page may keep: its article's, or without one the open ones."""
    for b in batches:
        out = []
        for page in b["html"].to_pylist():
            lines, n = _kept(page)
            keep = MAIN if any(z == MAIN for _, z in lines) else OPEN
            out.append(([x for x, z in lines if z == keep], n))
        yield pa.RecordBatch.from_arrays(
            [b["rk"], b["id"], b["url"], pa.array([x for x, _ in out], pa.list_(pa.string())), pa.array([n for _, n in out], pa.int64())],
            ["rk", "id", "url", "lines", "n_lines"])


def _differences(table: pa.Table) -> pa.Table:
    """(rk, gone, n_shared, partner) of a chunk's own pages: ``gone`` are the
    lines to delete, all shared ones of a page without an article."""
    table = table.sort_by("idx")
    rk, own, paths, article = (table[c].to_pylist() for c in ("rk", "own", "path", "has_article"))
    signs = [np.frombuffer(x.as_buffer(), np.uint64).tolist() for x in table["signs"]]
    rows = []
    for i in range(len(rk)):
        if not own[i]:
            continue
        near = sorted((k for k in range(max(0, i - REACH), min(len(rk), i + REACH + 1)) if k != i),
                      key=lambda k: (-len(commonprefix([paths[i], paths[k]])), abs(k - i), k))
        partner, shared = None, []
        for k in near:
            shared = shared_lines(signs[i], signs[k])
            if not signs[i] or len(shared) <= COPY * len(signs[i]):
                partner = rk[k]
                break
            shared = []
        rows.append((rk[i], [] if article[i] else shared, len(shared), partner))
    kinds = (pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64())
    return pa.table([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["rk", "gone", "n_shared", "partner"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: (id_col, url_col, text, n_chars, n_lines, n_shared).

    ``text`` is the main text, blocks joined by newlines; ``n_lines`` counts
    the page's lines, ``n_shared`` those aligned with its partner's. Null html
    is an empty page; a null url belongs to a host of its own; equal rows are
    one page and get the same text; an empty table gives no rows.
    """
    ready(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
            .withColumn("rk", F.xxhash64("id", "url", "html")))
    keyed = rows.select("rk", host.alias("host"), F.regexp_replace(path, r"(?:\.[A-Za-z]+|/)$", "").alias("path"), "html")
    signed = stage(keyed.mapInArrow(_sign, "rk long, host string, path string, signs binary, has_article boolean")
                   .dropDuplicates(["rk"]), "page-signs")
    ranked = running_total(signed, ["path", "rk"], ["host"], None, "nth").withColumn("idx", F.col("nth") - 1)
    chunk = F.floor(F.col("idx") / CHUNK)
    company = F.array(chunk, F.when(F.col("idx") % CHUNK < REACH, chunk - 1), F.when(F.col("idx") % CHUNK >= CHUNK - REACH, chunk + 1))
    placed = (ranked.withColumn("home", chunk).withColumn("chunk", F.explode(F.array_compact(company)))
              .select("rk", "host", "path", "idx", "chunk", "signs", "has_article", (F.col("home") == F.col("chunk")).alias("own")))
    found = stage(placed.groupBy("host", "chunk").applyInArrow(_differences, "rk long, gone array<int>, n_shared long, partner long"),
                  "page-differences")
    kind = dict(rows.dtypes)
    texts = rows.select("rk", "id", "url", "html").mapInArrow(
        _lines, f"rk long, id {kind['id']}, url {kind['url']}, lines array<string>, n_lines long").join(found, "rk")
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i)))
    return (texts.withColumn("text", F.array_join(kept, "\n"))
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"),
                    "n_lines", "n_shared"))
