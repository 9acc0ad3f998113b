"""Main text of web pages by consensus host paths.

Each page's containers are scored by the running text that they hold. A container's path is its chain of
tags and classes, generalised (numbers and long hashes in a class become one sign). Pages of one host
vote for the path of their best container, with its size; in Spark this is one partial aggregation, so
a hot host never meets in a task. Each page is then extracted again from the containers on its host's
winning path. A page without that path goes by its own best container; where the path misses some of
that, both are extracted, unless the own one is apart and no other page of the host has it as its best.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from html import unescape
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.llm._shared import bound_batches, saved

#: Winning paths are broadcast up to so many hosts; beyond that they are joined by host.
BROADCAST_HOSTS = 50_000
#: A page keeps to its host's path if that covers at least this share of its own best container's text.
NEARLY_ALL = 0.95
#: Or has at least this share of it elsewhere, and the page's own container is no other page's best.
LEAST_SHARE = 0.2
#: A page's path is backed by its host from so many votes on.
BACKED = 2

#: A tag from its `<` on. A quote only opens a value after `=`, and only if it is closed; no part is tried twice.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+)>""")
_COMMENT_END = re.compile(r"--!?>")
#: Elements whose content is no markup, or is not shown.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>?", re.I) for t in "script style textarea title noscript template iframe noembed noframes xmp".split()}
_CLASS = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+|[0-9a-f]{8,}")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never article text.
_NEVER = frozenset("nav footer aside button select option input label svg math object audio video canvas map head menu dialog".split())
#: A marked element or form with at least this share of the page's running text is a wrapper, and stays.
WRAPPER_SHARE = 0.9
#: Words that mark what is not article text, in a class, id or role that has no others but _NEUTRAL ones.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu sidebar aside "
    "footer header masthead topbar breadcrumb breadcrumbs comment comments respond reply replies disqus cookie cookies consent gdpr notice "
    "notices alert popup modal overlay subscribe subscription newsletter signup login share sharing social related recommended recommendations "
    "widget toolbar pagination pager skip copyright legal disclaimer search contentinfo complementary form paywall".split()
)
_NEUTRAL = frozenset("site top bottom left right list item items box block bar area section links link button buttons posts stories inner outer primary secondary global slot unit main".split())
#: Their ids name places in the text, not what they are.
_ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 section p li dt dd a span tr td blockquote pre".split())
#: An open element of the first kind ends when one of the second begins.
_ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "p": _BLOCK - frozenset(["html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"]),
}
#: Parts and wholes of lists and tables, which are parts of what is around them.
_PARTS = frozenset("li ul ol dl dt dd tr tbody thead tfoot table".split())
_EXEMPT = ("html", "body", "main", "article")
_STOPS = {"li": ("ul", "ol", "menu", "dir"), "td": ("table",), "th": ("table",), "tr": ("table",), "dt": ("dl",), "dd": ("dl",)}


def _marked(value: str) -> bool:
    """Whether a class, id or role has a name made of marks alone, besides neutral words."""
    for name in value.split():
        words = _WORDS.findall(_CAMEL.sub(" ", name).lower())
        if not _MARKS.isdisjoint(words) and all(w in _MARKS or w in _NEUTRAL for w in words):
            return True
    return False


def _markup(html: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """Markup in order: start, end, whether it closes, the tag in lower case (None: nothing to open or close), attributes.

    One pass, in time linear in the page: what is still open at the page's end takes the rest with it.
    """
    at, end = html.find("<"), len(html)
    while at >= 0:
        m = _TAG.match(html, at)
        if m:
            tag, to = m[2].lower(), m.end()
            if not m[1] and tag in _RAW:
                close = _RAW[tag].search(html, to)
                to = close.end() if close else end
                yield at, to, False, None, ""
            else:
                yield at, to, bool(m[1]), tag, m[3]
        else:
            after = html[at + 1 : at + 2]
            if html.startswith("<!--", at):
                close = _COMMENT_END.search(html, at + 2)
                to = close.end() if close else end
            elif after == "!" or after == "?" or after == "/" and at + 2 < end:
                close = html.find(">", at)
                to = close + 1 if close >= 0 else end
            elif after.isascii() and after.isalpha():  # a tag that never ends
                to = end
            else:  # a sign in the text
                at = html.find("<", at + 1)
                continue
            yield at, to, False, None, ""
        at = html.find("<", to)


class Page:
    """A page as flat lists: elements with parent, tag, path and kind; texts with their element and block."""

    def __init__(self, html: str):
        self.tags, self.parents, self.names, self.links = [""], [-1], [""], [False]
        #: per element: the checksum of its path, the nearest block-level element, whether an article or main is around
        self.marks_of_path, self.blocks, self.within = [0], [0], [False]
        #: per element, of itself: whether its tag is dropped, and whether it is only marked or a form
        self.never, self.marked = [False], [False]
        self.texts: list[tuple[int, int, str]] = []
        self.ends = [0]  # per element: the number of texts when it closed
        self.begins = [0]
        stack, block, at = [0], 0, 0
        # places in the stack: of each tag, and of block-level elements
        places: dict[str, list[int]] = {}
        levels: list[int] = []

        def close(k: int) -> None:
            """Closes the stack's elements from place k on."""
            for e in reversed(stack[k:]):
                self.ends[e] = len(self.texts)
                tag = self.tags[e]
                places[tag].pop()
                if tag in _BLOCK:
                    levels.pop()
            del stack[k:]

        for start, end, closes, tag, attributes in _markup(html):
            if start > at:
                self._text(stack[-1], block, html[at:start])
            at = end
            if tag is None:
                continue
            if closes:
                here = places.get(tag)
                if tag == "p" and not here:
                    block += 1
                # an inline end tag does not close a block around it
                if here and (tag in _BLOCK or not levels or here[-1] > levels[-1]):
                    close(here[-1])
                block += tag in _BLOCK
                continue
            for k in reversed(levels):
                opened = self.tags[stack[k]]
                if opened in _ENDS and tag in _ENDS[opened]:
                    close(k)
                    break
                if opened not in _ENDS or opened in _STOPS.get(tag, ()):
                    break
            if tag == "option" and places.get("option") and places["option"][-1] == len(stack) - 1:
                close(len(stack) - 1)
            block += tag in _BLOCK
            if tag in _VOID:
                if tag == "br":
                    self._text(stack[-1], block, " ")
                continue
            places.setdefault(tag, []).append(len(stack))
            if tag in _BLOCK:
                levels.append(len(stack))
            stack.append(self._open(stack[-1], tag, attributes))
        if at < len(html):
            self._text(stack[-1], block, html[at:])
        for e in stack:
            self.ends[e] = len(self.texts)
        self.drop()

    def path(self, e: int) -> str:
        """The names from the root down to an element."""
        names = []
        while e > 0:
            names.append(self.names[e])
            e = self.parents[e]
        return "".join("/" + x for x in reversed(names))

    def on_path(self, path: str) -> list[int]:
        """The elements with that path; checksums tell nearly all others apart without building theirs."""
        mark = crc32(path.encode(errors="replace"))
        return [e for e in range(1, len(self.tags)) if self.marks_of_path[e] == mark and self.path(e) == path]

    def drop(self, marks: bool = True) -> None:
        """Settles what is dropped, and the letters of running text (not dropped, no links) before each text."""
        self.dropped, self.letters = self._drops(marks), [0]
        for element, _, raw in self.texts:
            self.letters.append(self.letters[-1] + (0 if self.dropped[element] or self.links[element] else len("".join(raw.split()))))

    def _drops(self, marks: bool = True) -> list[bool]:
        """The elements that are dropped, with all that they hold; without `marks` only those of certain tags.

        A marked element or form stays if it holds nearly all the running text, a main, or the only articles.
        """
        n = len(self.tags)
        never, inside = self.never[:], [False] * n
        for e in range(1, n):
            never[e] = never[e] or never[self.parents[e]]
            inside[e] = inside[self.parents[e]] or self.marked[e]
        if not marks or not any(self.marked):
            return never
        size, holds, mains = [0] * n, [False] * n, [False] * n
        for element, _, raw in self.texts:
            if not never[element] and not self.links[element]:
                size[element] += len("".join(raw.split()))
        apart = any(t in ("article", "main") and not i for t, i in zip(self.tags, inside))
        for e in range(n - 1, 0, -1):
            up, tag = self.parents[e], self.tags[e]
            size[up] += size[e]
            mains[up] = mains[up] or mains[e] or tag == "main" and not never[e]
            holds[up] = holds[up] or holds[e] or tag == "article" and not never[e]
        out = [False] * n
        for e in range(1, n):
            wraps = mains[e] or holds[e] and not apart or size[e] > 0 and size[e] >= WRAPPER_SHARE * size[0]
            out[e] = out[self.parents[e]] or self.never[e] or self.marked[e] and not wraps
        return out

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        marks, name = False, tag
        if "=" in attributes:
            for kind, a, b, c in _CLASS.findall(attributes):
                value = a or b or c
                marks = marks or (tag not in _EXEMPT and not (kind.lower() == "id" and tag in _ANCHORED) and _marked(value))
                if kind.lower() == "class":
                    name += "".join(sorted("." + _NUMBER.sub("#", x) for x in value.lower().split()))
        never = tag in _NEVER or (tag == "header" and not self.within[parent])
        e = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(name)
        self.marks_of_path.append(crc32(f"/{name}".encode(errors="replace"), self.marks_of_path[parent]))
        self.blocks.append(e if tag in _BLOCK else self.blocks[parent])
        self.within.append(self.within[parent] or tag in ("article", "main"))
        self.never.append(never)
        self.marked.append(marks or tag == "form")
        self.links.append(self.links[parent] or tag == "a")
        self.begins.append(len(self.texts))
        self.ends.append(len(self.texts))
        return e

    def _text(self, element: int, block: int, raw: str) -> None:
        self.texts.append((element, block, raw))

    def scores(self) -> dict[int, float]:
        """Containers by running text: a block's counts for the element around it, and half for the next.

        The block's own element is the innermost block-level one; links and dropped parts count nothing.
        """
        out: dict[int, float] = {}
        for element, _, raw in self.texts:
            if self.dropped[element] or self.links[element] or raw.isspace():
                continue
            n, e = len(raw), self.blocks[element]
            around = self.parents[e] if self.tags[e] in ("p", "pre", "li", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "td", "dd", "dt") else e
            around = max(around, 0)
            out[around] = out.get(around, 0) + n
            if around > 0:
                next_ = self.parents[around]
                out[next_] = out.get(next_, 0) + n / 2
        return out

    def size(self, e: int) -> int:
        """Letters of running text in an element."""
        return self.letters[self.ends[e]] - self.letters[self.begins[e]]

    def best(self) -> int:
        """The container of the highest score (the later and so inner one of equals), or what is around it; 0 if none has text.

        It is widened to the nearest article or main that has more; outside of those, to the nearest element
        that has more. Body, root and table cells must hold a block of their own for that.
        """
        scored = self.scores()
        if not scored:
            return 0
        e = max(scored, key=lambda e: (scored[e], e))
        while self.tags[e] in _PARTS and self.parents[e] > 0:
            e = self.parents[e]
        around, up = [], e
        while up > 0:
            up = self.parents[up]
            around.append(up)
        n = self.size(e)
        named = [a for a in around if self.tags[a] in ("article", "main")]
        for a in named:
            if self.size(a) > n:
                return a
        if named or self.tags[e] in ("article", "main"):
            return e
        for a in around:
            if self.size(a) > n:
                return e if self.tags[a] in ("", "html", "body", "td", "th") and not self._own_block(a) else a
        return e

    def _own_block(self, e: int) -> bool:
        """Whether running text is in the element itself, or in a paragraph or heading that is its child."""
        for element, _, raw in self.texts[self.begins[e] : self.ends[e]]:
            if not self.dropped[element] and not self.links[element] and not raw.isspace():
                element = max(self.blocks[element], e)
                if element == e or self.parents[element] == e and self.tags[element] in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"):
                    return True
        return False

    def text(self, elements: list[int]) -> str:
        """The blocks within `elements`, in page order, without the dropped parts."""
        blocks: list[str] = []
        parts: list[str] = []
        last = None
        done = 0
        for e in elements:
            for element, block, raw in self.texts[max(self.begins[e], done) : self.ends[e]]:
                if self.dropped[element] and not self.dropped[e]:
                    continue
                if block != last and parts:
                    blocks.append("".join(parts))
                    parts = []
                last = block
                parts.append(unescape(raw) if "&" in raw else raw)
            done = max(done, self.ends[e])
        blocks.append("".join(parts))
        return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def vote(html: str | None) -> tuple[str, float]:
    """The path of a page's best container, and its size."""
    page = Page(html or "")
    e = page.best()
    return page.path(e), float(page.size(e))


def extract(html: str | None, path: str | None, backed: Collection[str] = ()) -> str:
    """A page's main text, from the containers on `path` or, failing that, from its own best one.

    A page whose text is all in marked elements or forms has that text.
    """
    page = Page(html or "")
    text = _extract(page, path, backed)
    if not text and any(page.marked):
        page.drop(marks=False)
        text = _extract(page, path, backed)
    return text


def _extract(page: Page, path: str | None, backed: Collection[str]) -> str:
    own = page.best()
    text = page.text([own])
    if path is None:
        return text
    on_path = page.on_path(path)
    if on_path == [own]:
        return text
    on_path = [e for e in on_path if not page.dropped[e]]
    if not on_path:
        return text
    agreed = page.text(on_path)
    covered, done = 0, page.begins[own]
    for e in on_path:
        lo, hi = max(done, page.begins[e]), min(page.ends[own], page.ends[e])
        covered += page.letters[hi] - page.letters[lo] if lo < hi else 0
        done = max(done, hi)
    if covered >= NEARLY_ALL * page.size(own):
        return agreed
    if not covered and page.path(own) not in backed and len(agreed) >= LEAST_SHARE * len(text):
        return agreed
    return page.text(sorted({own, *on_path}))


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [vote(h) for h in batch["html"]]
        yield pd.DataFrame({"host": batch["host"], "path": [p for p, _ in found], "score": [s for _, s in found]})


def _extracts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [extract(h, p, () if b is None else frozenset(b)) for h, p, b in zip(batch["html"], batch["path"], batch["backed"])]
        yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "path": batch["path"]})


def with_host(pages: DataFrame) -> DataFrame:
    """Adds `host` from `url`, in lower case; a null or odd url has the empty host."""
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1)
    return pages.withColumn("host", host)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, backed): each host's winning path, by votes' summed logarithmic sizes, then by name; all its paths of more than one vote.

    Pages without a host have nothing in common, so they have no vote but go by their own best container.
    """
    ballots = with_host(pages).where("host <> ''").select("host", "html").mapInPandas(_votes, "host string, path string, score double")
    counted = ballots.where("score > 0").groupBy("host", "path").agg(F.sum(F.log1p("score").cast("decimal(18,6)")).alias("v"), F.count(F.lit(1)).alias("k"))
    won = counted.groupBy("host").agg(F.max(F.struct("v", "path")).alias("w"), F.collect_list(F.when(F.col("k") >= BACKED, F.col("path"))).alias("backed"))
    return won.select("host", F.col("w.path").alias("path"), "backed")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars, path.

    Null and empty pages, and pages without text, give the empty text. Repeated rows give repeated
    results, and one vote each. Equal votes go to the path that is last by name. A page's time and memory are
    linear in its length, however it is nested or broken. An empty table gives an empty result.
    """
    bound_batches(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    winners = saved(host_paths(pages), "host-paths")
    hosts = winners.count()
    winners = F.broadcast(winners) if hosts <= BROADCAST_HOSTS else winners
    joined = with_host(pages).join(winners, "host", "left").select("page_id", "url", "html", "path", "backed")
    out = joined.mapInPandas(_extracts, "page_id long, url string, text string, path string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
