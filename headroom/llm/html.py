"""Main text of web pages by consensus of the host's pages.

Each page's elements are scored by the running text below them (text in links and in parts that are
never article, such as menus, forms or adverts, counts nothing). A page votes for the path of tags
and classes (numbers generalised) of its deepest element that holds most of that text. Votes are
summed per host in Spark, and every page is read again with the path that most of its host's pages
chose among all those that hold some of its running text (every voted path counts, however few votes
it has); a page without running text gives all its text.

Defined cases: null and empty html, and pages without running text, give an empty text; a null url
or one without a host votes with all of its kind; cut-off pages are read as far as they go (an
unfinished tag at the end is dropped); lists of links inside the main element are text, unless an
element is navigation by its own name, role, class or id; attributes count by their exact names; repeated rows each vote and each get their row; ties go to
the deeper, then to the smaller path; an empty table gives no rows. Only the named columns are read,
the others pass.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.llm.text import slices, table, written

#: An element that holds this share of a page's running text may be its main one.
MOST = 0.6
#: Parts into which a host's pages are dealt to meet its paths.
SALTS = 64

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|textarea|svg|math|select|title|head|noembed|noframes|xmp|object|canvas|video|audio)\b[^>]*+>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>|<[!?][^>]*+>|<[/!?a-zA-Z][^<]*+\Z""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr keygen frame".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img nobr".split())
_NEVER = frozenset("nav footer aside form button input menu dialog fieldset optgroup option datalist legend".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login register sidebar side sidenav widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar "
    "comment comments commentlist respond reply replies disqus share sharing social related recommended recommendations pagination pager tags tagcloud hidden skip".split())
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_NO_P = frozenset("address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


#: Parts of texts, never a main element.
_PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li td tr tbody pre blockquote ul ol".split())


class Element:
    __slots__ = ("tag", "path", "never", "link", "depth", "parent", "score")

    def __init__(self, tag: str, path: str, never: bool, link: bool, depth: int, parent: Element | None):
        self.tag, self.path, self.never, self.link, self.depth, self.parent, self.score = tag, path, never, link, depth, parent, 0


def _named(tag: str, attributes: str, parent: Element) -> tuple[str, bool]:
    """An element's step in paths, and whether it is never article."""
    never = tag in _NEVER
    if tag == "header":
        above = parent
        while above.parent is not None and above.tag not in ("article", "main"):
            above = above.parent
        never = above.parent is None
    if not attributes or attributes.isspace():
        return tag, never
    step = tag
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if tag not in ("html", "body", "article", "main") and not _WORDS.isdisjoint(_SPLIT.split(value)):
                never = True
            if name == "class" and value:
                step = f"{step}.{'.'.join(sorted(re.sub('[0-9]+', '#', c) for c in value.split()))}"
        elif name == "role":
            never = never or value in _ROLES
        elif name == "hidden":
            never = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            never = True
    return step, never


def read(html: str) -> tuple[list[Element], list[tuple[Element, str, int]]]:
    """All elements, and the blocks outside of parts that are never article: (element, text, characters in links)."""
    root = Element("", "", False, False, 0, None)
    elements, blocks, stack = [root], [], [root]
    held: list[str] = []
    home = root
    links = 0

    def end_block() -> None:
        nonlocal held, links
        if held:
            text = "".join(held)
            text = " ".join((references.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((home, text, min(links, len(text))))
        held, links = [], 0

    at = 0
    for token in _TOKEN.finditer(html):
        top = stack[-1]
        if token.start() > at and not top.never:
            text = html[at:token.start()]
            if not held:
                home = top
            held.append(text)
            if top.link:
                links += len(text)
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if token[2]:
            if any(e.tag == tag for e in stack[1:]):
                if tag not in _INLINE:
                    end_block()
                while stack.pop().tag != tag:
                    pass
            continue
        if tag not in _INLINE:
            end_block()
            closes = ("p",) if tag in _NO_P else _CLOSED_BY.get(tag)
            if closes:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in closes:
                        del stack[k:]
                        break
                    if stack[k].tag not in _INLINE and (tag in _NO_P or stack[k].tag in ("ul", "ol", "table", "dl", "select")):
                        break
        if tag in _VOID:
            if tag == "br" and held:
                held.append(" ")
            continue
        top = stack[-1]
        step, never = _named(tag, token[4], top)
        path = top.path if tag in ("html", "body") else f"{top.path}>{step}" if top.path else step
        new = Element(tag, path, never or top.never, tag == "a" or top.link, top.depth + 1, top)
        stack.append(new)
        if tag not in _INLINE:
            elements.append(new)
    if at < len(html) and not stack[-1].never:
        if not held:
            home = stack[-1]
        held.append(html[at:])
    end_block()
    return elements, blocks


def _block_of(element: Element) -> Element:
    while element.tag in _INLINE:
        element = element.parent
    return element


def _score(elements: list[Element], blocks: list) -> Element:
    """Running text below each element; returns the deepest that holds most of it (its block itself never, unless it is all there is)."""
    for home, text, links in blocks:
        if links * 2 > len(text):
            continue
        above = _block_of(home)
        while above is not None:
            above.score += len(text)
            above = above.parent
    total = elements[0].score
    best = elements[0]
    for e in elements[1:]:
        if total and e.score >= MOST * total and e.depth > best.depth and e.tag not in _PARTS:
            best = e
    return best


def offers(html: str) -> tuple[str, int, list[str]]:
    """The path of a page's main element, the characters of running text under it, and all paths of elements that hold some."""
    elements, blocks = read(html)
    best = _score(elements, blocks)
    return best.path, best.score, sorted({e.path for e in elements if e.score and e.tag not in _PARTS})


def extract(html: str, paths: list[str]) -> str:
    """The blocks under the first of ``paths`` that the page has, else under its own main element."""
    elements, blocks = read(html)
    own = _score(elements, blocks).path
    there = {e.path for e in elements}
    path = next((p for p in paths if p in there), own)
    out = []
    for home, text, _ in blocks:
        above = home
        while above is not None and above.path != path:
            above = above.parent
        if above is not None:
            out.append(text)
    return "\n\n".join(out)


def host(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _page(url: str, html: str) -> list[Column]:
    """A page's host and a 128-bit key of it; pages with the same are read alike."""
    own = host(url)
    return [own, F.xxhash64(own, F.col(html)), F.xxhash64(F.lit("page"), F.col(html), own)]


def page_paths(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``key, key2, path``: for each page with running text, its host's most voted path among those that hold some of it."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                own = [offers(h or "") for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("host", "key", "key2")], pa.array([v[0] for v in own], pa.string()), pa.array([v[1] for v in own], pa.int64()),
                                                  pa.array([v[2] for v in own], pa.list_(pa.string()))], names=["host", "key", "key2", "path", "score", "has"])

    names = ("host", "key", "key2")
    small = pages.select(*[c.alias(n) for c, n in zip(_page(url, html), names, strict=True)], F.col(html).alias("html"))
    read_ = written(small.mapInArrow(scan, "host string, key bigint, key2 bigint, path string, score bigint, has array<string>").filter("score > 0"), "page-paths")
    votes = read_.groupBy("host", "path").agg(F.sum(F.log1p("score")).alias("weight"))
    votes = votes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    has = read_.dropDuplicates(["key", "key2"]).select("host", "key", "key2", F.pmod("key", F.lit(SALTS)).cast("int").alias("salt"), F.explode("has").alias("path"))
    rank = F.struct((-F.round("weight", 6)).alias("w"), (-F.size(F.split("path", ">"))).alias("d"), "path")
    return has.join(votes, ["host", "path", "salt"]).groupBy("key", "key2").agg(F.min(rank).alias("best")).select("key", "key2", F.col("best.path").alias("path"))


def main_text(pages: DataFrame, *, url: str = "url", html: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with a struct of text and n_chars, and that struct's name."""
    name = "main"
    while name.lower() in {c.lower() for c in pages.columns}:
        name += "_"
    path, keys = f"{name}_path", [f"{name}_key", f"{name}_key2"]
    known = page_paths(pages, url, html).select(F.col("key").alias(f"{name}_k"), F.col("key2").alias(f"{name}_k2"), F.col("path").alias(path))
    own = pages.withColumns(dict(zip(keys, _page(url, html)[1:], strict=True)))
    own = own.join(known, (F.col(keys[0]) == F.col(f"{name}_k")) & (F.col(keys[1]) == F.col(f"{name}_k2")), "left").select(*pages.columns, path)

    columns = pages.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html):
                text = [extract(h or "", [] if p is None else [p]) for h, p in zip(part.column(html).to_pylist(), part.column(path).to_pylist(), strict=True)]
                found = pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["text", "n_chars"])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], found], names=[*columns, name])

    fields = [*pages.schema.fields, T.StructField(name, T.StructType.fromDDL("text string, n_chars bigint"))]
    return own.mapInArrow(scan, T.StructType(fields)), name


def op5_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found, name = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", f"{name}.text", f"{name}.n_chars")
