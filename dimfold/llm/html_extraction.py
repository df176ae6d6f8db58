"""Main text of HTML pages, with the template of each site removed.

A page is parsed into a light tree, and every element subtree is hashed by tag and
text. Spark counts, per host and per section of the host (the first of two or more parts of a
URL's path), on how many different pages a subtree recurs. Subtrees on ``min_pages`` pages
and ``min_share`` of the host's or section's, or on ``many_pages`` pages and
``small_share`` of them, are the site's template and are deleted. So a box that only one
section of a host repeats goes too.

Pages of equal main text count once, so a copied article is no template. Plain
prose (paragraphs, headings, list items) inside an explicit article is part of
it though it recurs, unless ``prose_share`` of the host's pages have it.

What remains for tags and names: the elements of ``DROP_TAGS`` and ``DROP_ROLES`` and hidden
ones go. Class and id words go by whole tokens (``comments``, ``share``) inside an
article, headings and anything called ``ROLES_OF_TEXT`` excepted; outside one also by a
token's first or last part (``cookie-notice``), unless another token says content
(``post``) or the token is a denial (``ad-free``). The main region is the
article, else the main element, else the richest content container, else the body.

Scale: both passes parse inside the scan. What is shuffled between them is
(host or section, hash, page hash), combined before the shuffle, so a host with a third of
all pages is no hot task. With S subtrees a page, a host or section has at most
S / ``small_share`` template subtrees. All of them are broadcast if they are at
most ``broadcast_hashes`` numbers of 8 bytes, and joined by host and section otherwise.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import durable, pick, read

MIN_PAGES, MIN_SHARE, MANY_PAGES, SMALL_SHARE, PROSE_SHARE = 5, 0.3, 20, 0.05, 0.9
BROADCAST_HASHES = 1_000_000

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title|iframe|noscript|template|xmp|svg|math)\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>{_ATTRS})>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)[^>]*>", re.S | re.I)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt".split())
#: An open element of the value ends where one of the key begins.
ENDS = {"li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option"}
DROP_TAGS = set("nav aside footer form head menu dialog button select datalist".split())
#: Open elements that the end of a block around them ends, and that no block can be in.
CONTROLS = {"button", "select", "datalist"}
DROP_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar".split())
DROP_WORDS = set(
    "ad ads adsbygoogle adsense advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs byline captcha comment comments consent cookie cookies "
    "copyright disclaimer discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination paywall popup promo promoted promotion recommended related replies respond search share sharing sidebar signup sitemap social "
    "sponsor sponsored subscribe subscription teaser toolbar topbar widget".split())
CONTENT_WORDS = set("article content entry main post story text body".split())
#: Inside an article these words name parts of the text, outside they are names of boxes.
ROLES_OF_TEXT = set("discussion alert alerts notice notices related replies respond search social disclaimer copyright byline banner overlay notification "
                    "header footer navigation pagination promotion subscription widget".split())
DENIALS = set("free no without non less".split())


def box_words(value: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(whole tokens, first and last parts) of a class or id; a denial (ad-free, no-sidebar) has no parts."""
    whole, parts = [], []
    for token in value.split():
        some = [x for x in re.split(r"[^a-z0-9]+", token) if x]
        whole += some if len(some) == 1 else []
        if len(some) > 1 and not DENIALS & set(some):
            parts += [some[0], some[-1]]
    return tuple(whole), tuple(parts)


class Page:
    """A parsed page. Nodes are numbered in page order, a parent before its children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.first, self.last, self.words = ["#"], [-1], [0], [0], [((), ())]
        self.drop, self.text, self.owner, self.block = [False], [], [], []
        self._parse(source)
        self._choose()

    def _parse(self, source: str) -> None:
        stack, open_tags, block, at = [0], {}, 0, 0

        def close(tag: str) -> None:
            while True:
                node = stack.pop()
                self.last[node] = len(self.text)
                open_tags[self.tag[node]] -= 1
                if self.tag[node] == tag:
                    return

        def say(words: str) -> None:
            self.text.append(words)
            self.owner.append(stack[-1])
            self.block.append(block)

        for m in TOKEN.finditer(source):
            if m.start() > at:
                words = source[at:m.start()]
                say(entities.unescape(words) if "&" in words else words)
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCK:
                block += 1
            elif tag in ("br", "td", "th"):
                say(" ")
            if m["end"] or m["end2"]:
                if open_tags.get(tag):
                    close(tag)
                continue
            if tag in BLOCK or tag in CONTROLS:  # nothing of that kind is in a control
                for control in CONTROLS:
                    if open_tags.get(control):
                        close(control)
            if tag in BLOCK and tag not in ("html", "body") and open_tags.get("p"):
                close("p")
            if (before := ENDS.get(tag)) and open_tags.get(before) and self.tag[stack[-1]] in (before, "p", "b", "i", "a", "span"):
                close(before)
            if tag in VOID:
                continue
            node = len(self.tag)
            words, drop = self._attributes(tag, m["attrs"] or "")
            for column, value in ((self.tag, tag), (self.parent, stack[-1]), (self.first, len(self.text)), (self.last, -1), (self.words, words), (self.drop, drop)):
                column.append(value)
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
        if at < len(source):
            say(entities.unescape(source[at:]))
        for node in stack:
            self.last[node] = len(self.text)

    @staticmethod
    def _attributes(tag: str, attrs: str) -> tuple[tuple, bool]:
        if len(attrs) < 3:
            return ((), ()), tag in DROP_TAGS
        whole, parts, drop = (), (), tag in DROP_TAGS
        for name, *values in ATTR.findall(attrs):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                some = box_words(value)
                whole, parts = whole + some[0], parts + some[1]
            elif name == "role":
                drop |= value in DROP_ROLES
                whole += ("main",) if value == "main" else ()
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                drop = True
        return (whole, parts), drop

    def _is_box(self, node: int, inside: bool) -> bool:
        """Do the names of the node call it menu, advert, share box, comments ..?"""
        tag, (whole, parts) = self.tag[node], self.words[node]
        if tag in ("html", "body", "main"):
            return False
        if tag == "article":
            return any(w.startswith(("comment", "teaser", "related")) for w in whole + parts)
        if inside:
            return tag not in HEADINGS and any(w in DROP_WORDS and w not in ROLES_OF_TEXT for w in whole)
        if any(w in DROP_WORDS for w in whole):
            return True
        return not CONTENT_WORDS & set(whole) and any(w in DROP_WORDS for w in parts)

    def _choose(self) -> None:
        """Which nodes go, and which are roots of the main region."""
        n = len(self.tag)
        size = [0]
        for t in self.text:
            size.append(size[-1] + len(t))
        weight = [size[b] - size[a] for a, b in zip(self.first, self.last)]
        holds = [False] * n  # an article or main element below
        for i in range(n - 1, 0, -1):
            if holds[i] or self.tag[i] in ("article", "main"):
                holds[self.parent[i]] = True
        whole = max(1, weight[0])
        inside, article = [False] * n, [False] * n
        for i in range(1, n):
            up = self.parent[i]
            inside[i] = inside[up] or self.drop[up]
            article[i] = article[up] or self.tag[up] in ("article", "main")
            if not self.drop[i]:
                self.drop[i] = self._is_box(i, article[i]) or self.tag[i] == "header" and not article[i]
            if self.drop[i] and (holds[i] or self.tag[i] == "form" and weight[i] > 0.7 * whole):
                self.drop[i] = False
        gone = [False] * n
        for i in range(1, n):
            gone[i] = gone[self.parent[i]] or self.drop[i]
        left = [i for i in range(1, n) if not gone[i]]
        roots = [i for i in left if self.tag[i] == "article"] or [i for i in left if self.tag[i] == "main" or "main" in self.words[i][0] and self.tag[i] in ("div", "section")]
        self.explicit = bool(roots)
        if not roots:
            some = [i for i in left if self.tag[i] in ("div", "section", "td") and any(w in CONTENT_WORDS for w in self.words[i][0] + self.words[i][1])]
            rich = max(some, key=lambda i: (weight[i], -i), default=None)
            roots = [rich] if rich is not None and weight[rich] > 0.4 * whole else [i for i in left if self.tag[i] == "body"][:1] or [0]
        self.gone, self.main = gone, [False] * n
        for i in roots:
            self.main[i] = True
        for i in range(1, n):
            self.main[i] = self.main[i] or self.main[self.parent[i]]
        self.roots = set(roots)

    def subtrees(self) -> Iterator[tuple[int, int, bool]]:
        """(node, hash, prose) of the element subtrees of the main region."""
        for i in range(1, len(self.tag)):
            if self.main[i] and not self.gone[i] and i not in self.roots and self.last[i] > self.first[i]:
                words = " ".join("".join(self.text[self.first[i]:self.last[i]]).split())
                if words:
                    key = f"{self.tag[i]}\0{words}".encode("utf-8", "replace")
                    yield i, int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True), self.explicit and self.tag[i] in PROSE

    def main_text(self, templates: Iterable = ()) -> str:
        """The main text without the subtrees whose hashes are in one of the sorted ``templates``."""
        gone = self.gone
        if templates:
            gone = list(gone)
            found = [(i, key) for i, key, _ in self.subtrees()]
            keys = np.array([key for _, key in found], np.int64)
            hit = np.zeros(len(keys), bool)
            for template in templates:
                hit |= np.isin(keys, template)
            for (i, _), here in zip(found, hit.tolist()):
                gone[i] = gone[i] or here
            for i in range(1, len(gone)):
                gone[i] = gone[i] or gone[self.parent[i]]
        blocks: dict[int, list[str]] = {}
        links: dict[int, int] = {}
        for text, node, block in zip(self.text, self.owner, self.block):
            if self.main[node] and not gone[node]:
                blocks.setdefault(block, []).append(text)
                if not self.explicit and self._linked(node):
                    links[block] = links.get(block, 0) + len(text)
        out = []
        for block, parts in blocks.items():
            whole = "".join(parts)
            if (words := " ".join(whole.split())) and 2 * links.get(block, 0) <= len(whole):
                out.append(words)
        return "\n\n".join(out)

    def _linked(self, node: int) -> bool:
        while node > 0 and self.tag[node] not in BLOCK:
            if self.tag[node] == "a":
                return True
            node = self.parent[node]
        return False


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def section_of(url: Column, host: Column) -> Column:
    """Host and first part of the path, if the path has more than that; else null."""
    first = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/[^/?#]", 1)
    return F.when(first != "", F.concat(host, F.lit("/"), first))


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(scope, hash, prose, page) of each page's subtrees for its host and its section, and hash null for the page itself."""
    for batch in batches:
        rows = []
        for host, section, source in zip(batch["host"].tolist(), batch["section"].tolist(), batch["html"].tolist()):
            page = Page(source)
            text = page.main_text()
            sign = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)
            found = [(key, prose, sign) for key, prose in {(key, prose) for _, key, prose in page.subtrees()}] + [(None, False, sign)]
            for scope in (host, section) if isinstance(section, str) else (host,):
                rows += [(scope, *x) for x in found]
        scope, key, prose, sign = zip(*rows) if rows else [()] * 4
        yield pd.DataFrame({"scope": scope, "hash": pd.array(key, dtype="Int64"), "prose": prose, "page": pd.array(sign, dtype="int64")})


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES,
                   small_share: float = SMALL_SHARE, prose_share: float = PROSE_SHARE) -> DataFrame:
    """(scope, template): the hashes of the subtrees that recur across the pages (host, section, html) of a host or section."""
    counted = durable(
        pages.select("host", "section", "html").mapInPandas(_hashes, "scope string, hash long, prose boolean, page long")
        .groupBy("scope", "hash", "prose", "page").agg(F.lit(1).alias("one"))
        .groupBy("scope", "hash", "prose").agg(F.count("*").alias("pages")).where((F.col("pages") >= min_pages) | F.col("hash").isNull()))
    whole = counted.where("hash IS NULL").select(F.col("scope").alias("name"), F.col("pages").alias("whole"))
    share = F.when(F.col("prose"), prose_share).when(F.col("pages") >= many_pages, min(small_share, min_share)).otherwise(min_share)
    often = counted.where("hash IS NOT NULL").join(whole, F.col("scope") == F.col("name")).where(F.col("pages") >= F.col("whole") * share)
    return often.groupBy("scope").agg(F.sort_array(F.collect_set("hash")).alias("template"))


def extract(pages: DataFrame, broadcast_hashes: int = BROADCAST_HASHES, **limits) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null or empty html, and a page without main text, give an empty text. Null
    URLs and URLs without a host share one nameless host. Repeated rows get
    equal results and count once in the template. Broken markup is read as far
    as it goes; long pages are read whole. Extra columns are ignored; an empty
    table gives an empty result.
    """
    host = host_of(F.col("url"))
    plain = pick(pages, page_id="long", url="string", html="string").select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"), section_of(F.col("url"), host).alias("section"))
    templates = durable(site_templates(plain, **limits))
    small = (templates.agg(F.sum(F.size("template") + 1)).first()[0] or 0) <= broadcast_hashes

    def of(scope: str, name: str) -> DataFrame:
        named = templates.select(F.col("scope").alias(f"{scope}_name"), F.col("template").alias(name))
        return F.broadcast(named) if small else named

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, of_host, of_section in batches:
            yield pd.Series([Page(s).main_text([t for t in some if t is not None])
                             for s, *some in zip(sources.tolist(), of_host.tolist(), of_section.tolist())], dtype=object)

    found = plain.join(of("host", "t1"), F.col("host") == F.col("host_name"), "left").join(of("section", "t2"), F.col("section") == F.col("section_name"), "left")
    found = found.withColumn("text", text_of.asNondeterministic()("html", "t1", "t2"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
