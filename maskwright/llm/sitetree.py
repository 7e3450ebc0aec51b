"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: nodes are paths of elements with their classes, and each node gathers the
child sequences (presentation) and texts (content) that its pages give it. The entropy of either over the pages makes a node's
importance: what looks and reads alike on all pages of a site has little. A branch's importance is composed from that of its nodes, and branches
of low importance are taken from each page. Elements whose tag, class or role says that they are menus, adverts, forms, comments and the
like go on any page, as a site may have too few pages to tell.

The trees are built by two sums over (host, node, feature) and (host, node), so no task holds a host, and a page gets its host's nodes
by a join that is a broadcast only where their number has been counted and is small.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut_lineage

#: Elements that begin and end a block of text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, or none that is read.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements that are never part of the article.
NOISE_TAGS = frozenset("nav aside footer form dialog menu search template svg canvas object audio video select button datalist head map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Parts of class names and ids that name what is not the article.
NOISE_WORDS = frozenset(
    "nav navbar navigation menu submenu sidebar sidenav footer masthead ad ads adv advert adverts advertisement advertising adsense adbox adunit banner sponsor sponsored sponsors promo promoted promotion"
    " cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay lightbox subscribe subscription newsletter signup login signin share sharing social sociallinks related recommended recommendations"
    " teaser teasers comment comments commentlist disqus reply replies respond breadcrumb breadcrumbs pagination pager widget widgets toolbar topbar skiplink copyright disclaimer".split()
)
#: The same, outside of an article only: an article may have a header of its own.
OUTER_NOISE_WORDS = frozenset("header head top bottom".split())
CONTENT_WORDS = frozenset("content main article post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the first kind ends when one of the second begins, unless one of the third stands between.
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"})}
SCOPE = frozenset("table td th caption html template".split())

_MARKUP = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]{0,65536}+\"|'[^']{0,65536}+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_TOLD = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

PLAIN, NOISE, ROOT = 0, 1, 2


@dataclass(frozen=True)
class SiteRule:
    """Branches less important than `least` go, where at least `pages` pages of the host have them; the bound falls to 0 for branches of fewer pages, down to one."""

    least: float = 0.4
    pages: int = 12
    #: What counts less and less with each further child sequence: the children's importance.
    damping: float = 0.9
    #: Hosts' nodes that are broadcast at most, some 30 bytes each; more are joined by a shuffle.
    broadcast_nodes: int = 500_000
    #: Whether tags, classes and roles count that name the article or what is none of it. Without, the tree alone decides.
    markup: bool = True


    def bound(self, pages: int) -> float:
        """Importance below which what so many pages have goes."""
        return self.least * min(1.0, math.log(max(1, pages)) / math.log(self.pages))


class Page:
    """The blocks of a page, and the elements that they stand in."""

    __slots__ = ("blocks", "key", "kind", "markup", "named", "parent", "tag")

    def __init__(self, text: str, markup: bool = True):
        self.markup = markup
        self.parent, self.tag, self.kind, self.named = [-1], ["#"], [PLAIN], [False]
        self.key = [0]
        self.blocks: list[tuple[int, str]] = []
        self._read(text)

    def _read(self, text: str) -> None:
        stack: list[tuple[str, int]] = [("#", 0)]
        parts: list[str] = []
        at, end, find, last = 0, len(text), _MARKUP.search, text.rfind(">") + 1

        def flush() -> None:
            if parts:
                block = " ".join("".join(parts).split())
                parts.clear()
                if block:
                    self.blocks.append((stack[-1][1], block))

        def close(place: int) -> None:
            flush()
            del stack[place:]

        def nearest(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> int:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in tags:
                    return i
                if stack[i][0] in stop:
                    return 0
            return 0

        while at < end:
            m = find(text, at, last) if at < last else None
            if m is None:
                break
            if m.start() > at:
                chunk = text[at : m.start()]
                parts.append(entities.unescape(chunk) if "&" in chunk else chunk)
            at = m.end()
            if m[1]:  # a comment; one that doesn't end takes the rest, <!--> and <!---> are whole
                if text.startswith((">", "->"), at):
                    at = text.index(">", at) + 1
                else:
                    stop = _COMMENT_END.search(text, at)
                    at = stop.end() if stop else end
                continue
            tag, attrs, closing = (m[3], m[4], m[2]) if m[3] else (m[6], m[7], m[5])
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if tag in BLOCKS:
                    flush()
                    place = nearest(HEADINGS if tag in HEADINGS else {tag}, SCOPE - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else {"html"})
                    if place and tag not in ("html", "body"):
                        close(place)
                elif any(t == tag for t, _ in stack[1:]):
                    place = nearest({tag}, SCOPE)
                    if place:
                        close(place)
                continue
            if tag == "br":
                parts.append(" ")
                continue
            if tag in RAW:
                stop = _RAW_END[tag].search(text, at)
                at = stop.end() if stop else end
                continue
            block = tag in BLOCKS
            if block:
                flush()
                if tag != "option" and (i := next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in BLOCKS), 0)) and stack[i][0] == "p":
                    close(i)
                elif tag in HEADINGS and stack[-1][0] in HEADINGS:
                    close(len(stack) - 1)
                if tag in ENDED_BY and (i := nearest(*ENDED_BY[tag])):
                    close(i)
            words: frozenset[str] = frozenset()
            noise = self.markup and tag in NOISE_TAGS
            root = self.markup and tag in ("article", "main")
            if attrs and _TOLD.search(attrs):
                words, said = self._said(attrs)
                noise = noise or said == NOISE
                root = self.markup and (root or said == ROOT)
            noise = (noise or self.markup and bool(words & NOISE_WORDS)) and tag not in ("body", "html")
            if tag in VOID or (attrs.endswith("/") and tag in ("svg", "template", "object")) or not (block or noise):
                continue
            up = stack[-1][1]
            if self.markup and block and not noise and not root and tag not in ("body", "html") and (tag == "header" or words & OUTER_NOISE_WORDS):
                noise = not self._within(up)
            self.parent.append(up)
            self.tag.append(tag)
            self.kind.append(NOISE if noise or self.kind[up] == NOISE else ROOT if root else PLAIN)
            self.named.append(bool(words))
            self.key.append(xxhash.xxh64_intdigest(f"{self.key[up]} {tag} {' '.join(sorted(re.sub('[0-9]+', '0', w) for w in words))}"))
            stack.append((tag, len(self.parent) - 1))
        if at < end:
            chunk = text[at:]
            if "<" in chunk:
                chunk = chunk[: cut.start()] if (cut := re.search(r"<[a-zA-Z/!?]", chunk)) else chunk  # a tag that the page's end cuts off
            parts.append(entities.unescape(chunk))
        flush()

    def _within(self, node: int) -> bool:
        while node > 0:
            if self.kind[node] == ROOT:
                return True
            node = self.parent[node]
        return False

    @staticmethod
    def _said(attrs: str) -> tuple[frozenset[str], int]:
        """Words of class and id, and what the other attributes say."""
        words: set[str] = set()
        said = PLAIN
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                words.update(_WORD.findall(_CAMEL.sub("-", value).lower()))
            elif name == "role":
                said = NOISE if value.lower() in NOISE_ROLES else ROOT if value.lower() in ("main", "article") else said
            elif name == "itemprop" and value.lower() == "articlebody":
                said = ROOT
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                said = NOISE
        return frozenset(words), said

    def features(self) -> dict[tuple[int, int, int], int]:
        """(node, kind, feature) -> occurrences. Kind 0: the node itself, 1: its child sequence, 2: a text of its own."""
        out: dict[tuple[int, int, int], int] = {}
        style = [0] * len(self.key)
        last = [0] * len(self.key)
        for i in range(1, len(self.key)):
            up = self.parent[i]
            if last[up] != self.key[i]:  # neighbours of one kind count as one
                style[up] = xxhash.xxh64_intdigest(f"{style[up]} {self.key[i]}")
                last[up] = self.key[i]
        for i in range(1, len(self.key)):
            out[self.key[i], 0, 0] = 1
            if style[i]:
                at = self.key[i], 1, style[i]
                out[at] = out.get(at, 0) + 1
        for node, text in self.blocks:
            at = self.key[node], 2, xxhash.xxh64_intdigest(text)
            out[at] = out.get(at, 0) + 1
        return out

    def main_text(self, site: dict[int, tuple[int, float, float, int]], rule: SiteRule) -> list[str]:
        n = len(self.key)
        root = [False] * n  # in an article, or what else is read
        levels: list[list[bool]] = []
        kinds = {self.tag[i] for i in range(n) if self.kind[i] == ROOT}
        wanted = [("article",)] if "article" in kinds else []
        wanted += [("*",)] if kinds else []
        for tags in wanted:
            inside = [False] * n
            for i in range(1, n):
                inside[i] = self.kind[i] != NOISE and (inside[self.parent[i]] or (self.kind[i] == ROOT and (tags == ("*",) or self.tag[i] in tags)))
            levels.append(inside)
        levels.append([k != NOISE for k in self.kind])
        blocks: list[tuple[int, str]] = []
        for root in levels:
            blocks = [(node, text) for node, text in self.blocks if root[node]]
            if blocks:
                break
        if not blocks or not site:
            return [text for _, text in blocks]
        gone, content = self._unimportant(root, site, rule)
        left = [text for node, text in blocks if not gone[node]]
        if left:
            return left
        best = max(content[node] for node, _ in blocks)  # the page is as its site
        return [text for node, text in blocks if content[node] == best]

    def _unimportant(self, root: list[bool], site: dict[int, tuple[int, float, float, int]], rule: SiteRule) -> tuple[list[bool], list[float]]:
        """Whether each element's own text goes, and the importance of that text."""
        n = len(self.key)
        total, count = [0.0] * n, [0] * n
        own_text = [False] * n
        for node, _ in self.blocks:
            own_text[node] = True
        importance, contents, bound = [1.0] * n, [1.0] * n, [0.0] * n
        holds = [False] * n  # a text that matters, so the branch stays, though it be mostly the site's
        for i in range(n - 1, 0, -1):
            pages, presentation, content, styles = site.get(self.key[i], (0, 1.0, 1.0, 1))
            contents[i], bound[i] = content, rule.bound(pages)
            if own_text[i]:
                holds[i] = holds[i] or content >= bound[i]
                total[i] += content
                count[i] += 1
            if count[i]:
                weight = rule.damping ** max(1, styles)
                below = total[i] / count[i]
                importance[i] = below if own_text[i] and count[i] == 1 else (1 - weight) * presentation + weight * below
            else:
                importance[i] = 0.0
            total[self.parent[i]] += importance[i]
            count[self.parent[i]] += 1
            holds[self.parent[i]] = holds[self.parent[i]] or holds[i]
        gone = [False] * n
        safe = [False] * n  # the article itself, and its plain elements
        for i in range(1, n):
            up = self.parent[i]
            safe[i] = root[i] and (self.kind[i] == ROOT or self.tag[i] in ("html", "body") or (safe[up] and not self.named[i] and self._within(i)))
            gone[i] = gone[up] or (not safe[i] and not holds[i] and importance[i] < bound[i])
        return [g or (own_text[i] and not safe[i] and i > 0 and contents[i] < bound[i]) for i, g in enumerate(gone)], contents


def host_of(url: Column) -> Column:
    """Lower-case host of a URL with a scheme; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def site_nodes(pages: DataFrame, html: str, rule: SiteRule) -> DataFrame:
    """host, node, pages (that have it), presentation, content (importance, 0 to 1), styles (different child sequences).

    pages has columns host and html.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int, int, int], list[float]] = {}
        for batch in batches:
            for host, text in zip(batch["host"].to_pylist(), batch[html], strict=True):
                for at, n in Page(text.as_py() or "", rule.markup).features().items():
                    sums = total.setdefault((host, *at), [0, 0.0])
                    sums[0] += n
                    sums[1] += n * math.log(n)
            if len(total) > 200_000:
                yield made(total)
                total = {}
        yield made(total)

    def made(total: dict) -> pa.RecordBatch:
        signed = lambda c: pa.array(np.array([k[c] for k in total], np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), signed(1), pa.array([k[2] for k in total], pa.int32()), signed(3), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.float64())],
            names=["host", "node", "kind", "feature", "n", "s"],
        )

    found = pages.filter("host is not null").select("host", html).mapInArrow(run, "host string, node long, kind int, feature long, n long, s double")
    by_feature = found.groupBy("host", "node", "kind", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    spread = F.log("n") - F.col("s") / F.col("n")  # entropy over pages of one feature, before the division by log(pages)
    nodes = by_feature.groupBy("host", "node").agg(
        of(0, F.col("n")).alias("pages"), of(1, F.col("n")).alias("_t"), of(1, F.col("n") * F.log("n")).alias("_tlog"), of(1, F.lit(1)).alias("_styles"), of(2, F.lit(1)).alias("_features"), of(2, spread).alias("_spread")
    )
    bounded = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
    log_pages = F.log("pages")
    return nodes.filter("pages > 1").select(
        "host",
        "node",
        "pages",
        F.coalesce(bounded((F.log("_t") - F.col("_tlog") / F.col("_t")) / log_pages), F.lit(0.0)).alias("presentation"),
        F.coalesce(bounded(1 - F.col("_spread") / F.col("_features") / log_pages), F.lit(0.0)).alias("content"),
        F.coalesce("_styles", F.lit(1)).cast("long").alias("styles"),
    )


def main_texts(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rule: SiteRule = SiteRule()) -> DataFrame:
    """Main text of each page: page_id, url, text (blocks joined by a line end, empty if none), n_chars (code points).

    The article, or else the element that is named as the main part, or else the body is read; what else it holds is dropped only where its markup or its site's
    tree says so. A page of any length is read whole; the value of an attribute that is longer than 65,536 characters ends its tag at the first `>`, so that hostile pages are read in
    bounded time. A null or empty html gives an empty text; a page without a URL has no site and is read by its markup
    alone; repeated rows are read each, and count each as a page of their site; an empty table gives no rows; other columns are ignored.
    """
    pages = df.select(F.col(page_id), F.col(url), host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    nodes = cut_lineage(site_nodes(pages, "html", rule))
    by_host = nodes.groupBy("host").agg(F.collect_list(F.struct("node", "pages", "presentation", "content", "styles")).alias("site")).withColumnRenamed("host", "_host")
    if nodes.count() <= rule.broadcast_nodes:
        by_host = F.broadcast(by_host)
    joined = pages.join(by_host, F.col("host") == F.col("_host"), "left").select(page_id, url, "html", "host", "site")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sites: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for host, site, text in zip(batch["host"].to_pylist(), batch["site"], batch["html"], strict=True):
                if host not in sites:
                    if len(sites) >= 1024:
                        sites.clear()
                    sites[host] = {s["node"] & (2**64 - 1): (s["pages"], s["presentation"], s["content"], s["styles"]) for s in site.as_py() or []}
                texts.append("\n".join(Page(text.as_py() or "", rule.markup).main_text(sites[host], rule)))
            yield pa.RecordBatch.from_arrays([batch[page_id], batch[url], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[page_id, url, "text", "n_chars"])

    schema = T.StructType([df.schema[page_id], df.schema[url], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(run, schema)
