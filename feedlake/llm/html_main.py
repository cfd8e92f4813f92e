"""Main text of web pages by site template removal (operator 6).

Every element's subtree outside the article is hashed (its tag, attributes and
normalised content), and every box of up to ``MOST_CHARS`` characters in it (tag
and content).  Spark counts, per host, the distinct pages that hold each
hash.  A subtree that recurs is that site's template and is deleted: one of
some length from ``MIN_PAGES`` distinct pages on, a number that grows with the
logarithm of the host's pages (``MIN_PAGES`` for each power of ten); a short
one, such as a number in a cell, and one of more than ``MOST_CHARS`` characters
on ``MIN_PAGES`` and ``SHARE`` of the pages.  Deleted are, too,
elements whose tag, role or whole class names mark them as menu, header,
footer, sidebar, notice, advert, form, script, style or comments, unless they
wrap the page's only article.  What is left of the article (of the body, for a
page that marks no article) is the main text.

Lines inside ``<article>`` or ``<main>`` (paragraphs, headings, items, cells)
are not deleted for recurring by themselves: a line that many articles of a
host share is still part of each.  Boxes there are, unless nothing of the
article would be left.

Distinct contents meet their host's template hashes by host and hash, pages
their own list by host and digest, both by shuffle: no list grows with a host.

Defined results: null and empty html, and pages without main text, give the
empty text; a page without a host in its URL has no template; repeated pages
each give a row, and pages of a host with the same text count as one page;
empty input gives empty output.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import staged

MIN_PAGES, SHARE = 4, 0.1
#: The number of pages decides, not the share, from so many characters of a box or a line up to MOST_CHARS:
#: less may be in any text, more may be an article that many pages show.
LONG_BOX, LONG_LINE, MOST_CHARS = 12, 30, 1_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:[\"'][^>]*+)?+)(?:>|\Z)",
    re.DOTALL,
)
#: One attribute: its name and its value, which is read over as a whole.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Elements by their part in a page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = RAW | {
    "head", "nav", "footer", "aside", "form", "noscript", "template", "svg", "button", "select", "menu", "dialog",
    "object", "canvas", "audio", "video", "map", "datalist", "fieldset",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol",
    "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | DROPPED
MAIN = {"article", "main"}
WHOLE = MAIN | RAW | {"html", "head", "body"}  # never a template
BOXES = {
    "div", "section", "ul", "ol", "dl", "table", "header", "center", "details", "figure", "address", "hgroup", "footer",
    "nav", "aside", "form", "menu", "fieldset", "dialog",
}
#: An element that starts closes an open one of these, up to a container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}, "body": {"head"},
}
CONTAINERS = {"ul", "ol", "dl", "table", "article", "main", "section", "body", "html", "blockquote", "div", "aside", "nav", "td", "th"}
#: Whole class names.  A name that merely contains one of them is left to the host's counts.
NAMES = {
    "nav", "navbar", "navigation", "menu", "menubar", "footer", "sidebar", "ad", "ads", "advert",
    "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies", "consent", "notice",
    "popup", "modal", "newsletter", "subscribe", "share", "sharing", "social", "related", "breadcrumb", "breadcrumbs",
    "comment", "comments", "disqus", "toolbar", "pagination", "widget", "login", "signup",
    "cookie-notice", "cookie-banner", "cookie-consent", "cookie-bar", "site-nav", "main-nav", "nav-menu", "site-footer",
    "page-footer", "share-buttons", "social-share", "social-links", "related-posts", "newsletter-signup", "ad-slot",
    "ad-container", "comment-list", "comments-area",
}
HEADERS = {"header", "masthead", "site-header", "page-header"}  # of the page; an article's own header is text
#: Whole ids of boxes; other ids are often slugs of a heading.
IDS = {"comments", "disqus_thread", "sidebar", "footer", "nav", "navbar", "menu", "breadcrumbs"}
#: A box is of reader comments, too, if a part of a class name says so and none says that it only tells of them.
COMMENTS, NOT_COMMENTS = {"comment", "comments"}, {"has", "no", "with", "without", "show", "hide", "open", "closed", "count", "code", "doc"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"}
#: How an element is named: not at all, in a way that a wrapper of the article may be, or for certain.
TEXT, WRAPPER, CERTAIN = 0, 1, 2


def _of_comments(names: list[str]) -> bool:
    parts = [set(re.split("[-_]+", name)) for name in names]
    return any(not COMMENTS.isdisjoint(p) and NOT_COMMENTS.isdisjoint(p) for p in parts)


def _named_boilerplate(tag: str, attributes: str, in_main: bool) -> int:
    """Whether the tag or its attributes mark the element as not main text."""
    if tag in ("html", "body"):
        return TEXT
    if tag in DROPPED or (tag == "header" and not in_main):
        return WRAPPER if tag in ("form", "fieldset") else CERTAIN
    found = TEXT
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if tag in MAIN:
            if name == "class" and not {"comment", "comments"}.isdisjoint(value.split()):
                return CERTAIN
        elif name == "hidden":
            if value != "until-found":
                return CERTAIN
        elif name == "role":
            if value in ROLES:
                return CERTAIN
        elif name == "class":
            names = value.split()
            if not NAMES.isdisjoint(names) or not (in_main or HEADERS.isdisjoint(names)) or (tag in BOXES and _of_comments(names)):
                found = WRAPPER
        elif name == "id" and value in IDS and tag in ("div", "section", "ul", "ol"):
            found = WRAPPER
    return found


class _Open:
    """An element that has been opened: where its content starts."""

    __slots__ = ("tag", "attributes", "blocks", "chars", "skip", "main", "hash")

    def __init__(self, tag: str, attributes: str, blocks: int, chars: int, skip: int, main: bool):
        self.chars = chars
        self.tag, self.attributes, self.blocks, self.skip, self.main = tag, attributes, blocks, skip, main
        self.hash = xxhash.xxh64(f"<{tag} {attributes.strip()}>")


def read_page(source: str, template: frozenset[int] = frozenset(), wrapped: bool = False) -> tuple[str, set[int], int]:
    """(main text, hashes of the subtrees that hold text, digest of all text).

    An article in an element named as boilerplate counts if the page has no
    other one (``wrapped``): then that element is a wrapper, whatever its name.
    """
    body: list[str | None] = []  # blocks of the page, None in named boilerplate
    inside: list[bool] = []  # whether a block lies in the article
    text: list[str] = []
    stack: list[_Open] = [_Open("", "", 0, 0, TEXT, False)]
    places: defaultdict[str, list[int]] = defaultdict(list)  # where each tag's open elements are in the stack
    hashes: set[int] = set()
    spans: list[tuple[int, int, bool]] = []  # blocks of template subtrees, and whether in the article
    has_main = has_wrapped = False
    chars = 0  # of the blocks so far
    digest = xxhash.xxh3_64()

    def flush() -> None:
        nonlocal chars
        if text:
            block = " ".join("".join(text).split())
            text.clear()
            if block:
                body.append(None if stack[-1].skip else block)
                inside.append(stack[-1].main)
                chars += len(block)
                stack[-1].hash.update(block)
                if stack[-1].tag not in RAW:
                    digest.update(block + "\n")

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag in BLOCKS:
                flush()
            top = stack.pop()
            places[top.tag].pop()
            filled = len(body) > top.blocks
            least = LONG_BOX if top.tag in BOXES else LONG_LINE
            value = (top.hash.intdigest() - (1 << 63)) & ~1 | (least <= chars - top.chars <= MOST_CHARS)  # the last bit: by number
            # in the article, boxes only; never the article, nor it by what is around it
            if filled and top.tag not in WHOLE and (not top.main or (top.tag in BOXES and chars - top.chars <= MOST_CHARS)):
                hashes.add(value)
                if value in template:
                    spans.append((top.blocks, len(body), top.main))
            stack[-1].hash.update(value.to_bytes(8, "little", signed=True))

    def last(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close_open(tags: set[str], limits: set[str]) -> None:
        depth = last(tags)
        if depth > last(limits - tags):
            close(depth)

    at, size = 0, len(source)
    while at < size:
        found = _TAG.search(source, at)
        if found is None:
            text.append(html.unescape(source[at:]))
            break
        if found.start() > at:
            text.append(html.unescape(source[at : found.start()]))
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            depth = last({tag})
            if depth:
                close(depth)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            flush()
            close_open({"p"}, CONTAINERS - {"li"})
        if tag in CLOSES:
            close_open(CLOSES[tag], CONTAINERS - CLOSES[tag])
        if tag in VOID:
            continue
        top = stack[-1]
        attributes = found[3].rstrip("/")
        skip = max(top.skip, _named_boilerplate(tag, attributes, top.main))
        if tag in MAIN and skip == WRAPPER and not top.main:
            has_wrapped = True
            skip = TEXT if wrapped else skip
        main = top.main or (tag in MAIN and not skip)
        has_main |= main
        places[tag].append(len(stack))
        stack.append(_Open(tag, attributes if not main else "", len(body), chars, skip, main))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(source, at)
            at = end.start() if end else size
    flush()
    close(1)
    if has_wrapped and not has_main:
        return read_page(source, template, True)
    left = [b is not None and (m or not has_main) for b, m in zip(body, inside, strict=True)]
    article = any(left) and has_main
    steps = [[0] * (len(body) + 1), [0] * (len(body) + 1)]  # spans around the article or in it that start less those that end
    for start, stop, of_main in spans:
        steps[of_main][start] += 1
        steps[of_main][stop] -= 1
    around, within = accumulate(steps[0]), accumulate(steps[1])
    cut = [b and not w and (m or not a) for b, m, a, w in zip(left, inside, around, within, strict=False)]
    if article and not any(cut):
        cut = left  # boxes that are all of an article are its text
    kept = [b for b, c in zip(body, cut, strict=True) if c]
    return "\n".join(kept), hashes, digest.intdigest() - (1 << 63)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_hashes(pages: DataFrame) -> DataFrame:
    """(host, digest, hashes, content): the subtrees of each distinct html of
    a host, and a digest of its text; ``pages`` has (host, digest, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for source in batch.column(2).to_pylist():
                _, mine, text = read_page(source or "")
                found.append(sorted(mine))
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64())), pa.array(texts, pa.int64())],
                names=["host", "digest", "hashes", "content"],
            )

    found = pages.where("host IS NOT NULL").select("host", "digest", "html")
    found = found.mapInArrow(run, "host string, digest binary, hashes array<long>, content long")
    # equal pages have equal hashes
    return found.groupBy("host", "digest").agg(F.first("hashes").alias("hashes"), F.first("content").alias("content"))


def templates(contents: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(host, hash): the recurring subtrees of each host; ``contents`` is of
    ``page_hashes``."""
    count = F.count(F.lit(1))
    sizes = contents.select(F.col("host").alias("h"), "content").distinct().groupBy("h").agg(count.alias("pages"))
    each = contents.select("host", F.explode("hashes").alias("hash"), "content").distinct()
    counts = each.groupBy("host", "hash").agg(count.alias("n")).where(F.col("n") >= min_pages)
    # both sides from tables, so that Spark can split a host with very many subtrees
    sizes, counts = staged(sizes, "host-pages"), staged(counts, "subtree-counts")
    by_share = F.col("pages") * F.lit(share)
    by_number = F.least(by_share, F.lit(min_pages) * F.log10("pages"))
    least = F.when(F.col("hash").bitwiseAND(F.lit(1)) == 1, by_number).otherwise(by_share)
    return counts.join(sizes, F.col("host") == F.col("h")).where(F.col("n") >= least).select("host", "hash")


def page_templates(contents: DataFrame, known: DataFrame) -> DataFrame:
    """(host, digest, hashes): the template subtrees of each content that has some."""
    mine = contents.select("host", "digest", F.explode("hashes").alias("hash"))
    known = known.select(F.col("host").alias("k_host"), F.col("hash").alias("k_hash"))
    found = mine.join(known, (F.col("host") == F.col("k_host")) & (F.col("hash") == F.col("k_hash")))
    return found.groupBy("host", "digest").agg(F.collect_list("hash").alias("hashes"))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, share: float = SHARE,
) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    rows = rows.withColumn("digest", F.unhex(F.md5(F.coalesce("html", F.lit("")).cast("binary"))))
    contents = staged(page_hashes(rows), "page-hashes")
    known = page_templates(contents, staged(templates(contents, min_pages, share), "site-templates"))
    known = staged(known, "page-templates").select(F.col("host").alias("t_host"), F.col("digest").alias("t_digest"), "hashes")
    same = (F.col("host") == F.col("t_host")) & (F.col("digest") == F.col("t_digest"))
    joined = rows.join(known, same, "left").select("page_id", "url", "html", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                read_page(source or "", frozenset(hashes or ()))[0]
                for source, hashes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    schema = joined.select("page_id", "url", F.lit("").alias("text")).schema
    return joined.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))


