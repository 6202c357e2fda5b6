"""Main text of web pages by site template removal.

Every page is read into its elements, and each element subtree (tag, classes,
text, children) gets a hash. Spark counts, per host, the different contents that hold each
subtree; a container found in ``MIN_PAGES`` of them is a template, however large
the host is, and every page of that host loses it. A single block, such as a
paragraph, must stand in more than half of the host's contents too, since a
passage may be quoted; a heading goes with a container only. The content is the article
that a subtree lies in, or else the blocks of its page, less those that the
rules below drop: copies of an article or of a page count once. Elements that say
what they are by tag, role, class or id (menus, forms, adverts, comments ...)
go as well. The blocks of an article among what is left, or else those of a
main element, or else all, are the main text: white space inside a block
becomes one space, blocks are joined by an empty line.

Paragraphs and headings of a marked article are content even when copies of
the page or a common passage make them recur; inside an article only
containers with less than half of its text can be templates.

Defined cases: a null or empty html gives the empty text; a null url belongs
to the empty host; unclosed, stray and unknown tags are read as a browser
does for text (an unclosed comment, script or style swallows the rest); rows
that repeat give one result each; other columns are ignored. Counts are
aggregated before they are shuffled, so a hot host is no hot task.
"""

from __future__ import annotations

import re
from html import unescape

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.common import map_rows, written

MIN_PAGES = 5

# Elements by what HTML says of them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp".split())
BLOCKS = set("""address article aside blockquote body br caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol option p pre section summary table tbody td tfoot th thead title tr ul""".split()) - {"br"}
CONTAINERS = set("div section ul ol dl table aside nav footer header form figure menu".split())
ENDS_P = BLOCKS - set("body caption head html legend li dd dt option tbody td tfoot th thead title tr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"},
         "td": {"tr", "table"}, "th": {"tr", "table"}}
# What is not main text, by tag, role, class and id.
DROP_TAGS = set("""head script style title textarea noscript iframe template xmp nav footer aside form button
select input dialog menu svg canvas object audio video""".split())
DROP_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
DROP_NAMES = set("""ad ads advert adverts advertisement adsbox banner sponsor sponsored promo promotion
cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup sidebar side
menu menus nav navbar navigation breadcrumb breadcrumbs toolbar topbar masthead footer site-footer
page-footer site-header page-header top-header comment comments comment-list comments-area reader-comments
user-comments responses disqus discussion share sharing social related recommended widget widgets
pagination pager login search skip-link""".split())
DROP_PREFIXES = ("ad-", "ads-", "advert", "banner-", "sponsor", "promo-", "cookie", "comment-", "comments-",
                 "sidebar", "newsletter", "social-", "share-", "related-", "breadcrumb", "nav-", "navbar",
                 "menu-", "popup", "modal", "footer-", "consent", "notice-")
HEADER_NAMES = {"header", "site-header", "page-header"}
# Inside an article an id names a section more often than a kind of box: only these count there.
COMMENT_IDS = set("comment comments comment-list comments-area reader-comments user-comments responses disqus".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!--|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)


class Element:
    __slots__ = ("tag", "dropped", "article", "signature", "parts", "size", "hash", "parent", "first", "last", "in_main")

    def __init__(self, tag: str, parent: "Element | None", attributes: dict[str, str], first: int = 0):
        self.tag, self.parent, self.parts, self.size, self.hash = tag, parent, [], 0, 0
        #: Numbers of its first block and of the first block after it.
        self.first = self.last = first
        self.in_main = tag == "main" or bool(parent and parent.in_main)
        inside = parent.article if parent else None
        self.signature = f"{tag} {attributes.get('class', '')}"
        self.dropped = bool(parent and parent.dropped) or not_main(tag, attributes, inside is not None)
        is_article = tag == "article" and not self.dropped
        self.article = self if inside is None and is_article else inside


def not_main(tag: str, attributes: dict[str, str], in_article: bool, inline: bool = False) -> bool:
    """Whether an element says that it is no part of the main text.

    Inside an article headings stay whatever they are called, and an id drops
    an element only if it names reader comments.
    """
    classes, ids = (attributes.get(a, "").lower().split() for a in ("class", "id"))
    if tag in ("html", "body"):
        return False
    if tag in DROP_TAGS or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in DROP_ROLES or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    names = classes if in_article else classes + ids
    if not (in_article or inline) and (tag == "header" or not HEADER_NAMES.isdisjoint(names)):
        return True
    if in_article and tag in HEADINGS:
        return False
    if in_article and not COMMENT_IDS.isdisjoint(ids):
        return True
    return any(n in DROP_NAMES or n.startswith(DROP_PREFIXES) for n in names) and tag != "main"


def attributes_of(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(source)}


def parse(html: str) -> tuple[list[tuple[str, list[Element]]], list[Element]]:
    """Blocks (text, enclosing elements) in page order, and all elements."""
    root = Element("html", None, {})
    current, elements, blocks, pending = root, [], [], []

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            blocks.append((text, current))
            current.parts.append(text)
            current.size += len(text)

    def close(element: Element) -> None:
        element.last = len(blocks)
        element.hash = xxhash.xxh3_64_intdigest("\0".join([element.signature, *map(str, element.parts)])) >> 1
        if element.parent is not None:
            if element.parts:
                element.parent.parts.append(element.hash)
            element.parent.size += element.size

    def pop_to(tags: set[str], limit: set[str]) -> None:
        """Close the nearest open element of ``tags`` and all inside it, unless ``limit`` stands between."""
        nonlocal current
        at = current
        while at is not root and at.tag not in tags:
            if at.tag in limit:
                return
            at = at.parent
        if at is root:
            return
        flush()
        while True:
            done, current = current, current.parent
            close(done)
            if done is at:
                return

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            pending.append(unescape(html[at:]))
            break
        if m.start() > at:
            pending.append(unescape(html[at:m.start()]))
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        tag, ends, source = name.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if ends:
            if tag in BLOCKS:
                flush()
                pop_to({tag}, {"article", "main", "body"} - {tag} if tag == "p" else {"body"} - {tag})
            continue
        if tag == "br":
            pending.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag not in BLOCKS and tag not in DROP_TAGS:
            if not source or not (found := attributes_of(source)) or not not_main(
                    tag, found, current.article is not None, inline=True):
                continue                                    # inline: its text belongs to the block
        flush()
        if tag in ("html", "body") and current.tag in ("html", "body"):
            if tag == "body":
                current = Element("body", current, {}, len(blocks))
            continue
        if tag in CLOSES:
            pop_to(CLOSES[tag], HOLDS[tag])
        elif tag in ENDS_P:
            pop_to({"p"}, {"article", "main", "body", "div", "section", "li", "td", "th", "blockquote"})
        if current.tag == "head" and tag not in ("title", "style", "script", "meta", "link", "noscript", "template"):
            pop_to({"head"}, set())
        current = Element(tag, current, attributes_of(source), len(blocks))
        elements.append(current)
    flush()
    while current is not None:
        close(current)
        current = current.parent
    return blocks, elements


def _removable(element: Element) -> bool:
    """Whether a recurring subtree may go: see the module's rule for articles."""
    if element.tag in ("html", "body", "main", "article", "head") or element.tag in HEADINGS:
        return False
    if element.article is None:
        return True
    return element.tag in CONTAINERS and 2 * element.size < element.article.size


def page(page_id, url: str | None, html: str | None) -> tuple:
    """(page_id, url, host, texts, places, ranks, subtrees, seen): blocks with their numbers, removable subtrees with
    the numbers of their blocks, and all removable subtrees with their content.

    Ranks: 2 in an article, 1 in a main element, 0 elsewhere. A block in no
    removable subtree stays, so blocks of a lower rank than its own are left
    out. A subtree is told by its first and last block, so what a page gives
    grows with its elements, however deep they lie.
    """
    blocks, elements = parse(html or "")
    content = xxhash.xxh3_64_intdigest("\0".join([text for text, at in blocks if not at.dropped]).encode(
        "utf-8", "surrogatepass")) >> 1
    removable = [e for e in elements if e.parts and _removable(e)]
    opens = [0] * (len(blocks) + 1)
    for e in removable:
        opens[e.first] += 1
        opens[e.last] -= 1
    kept, depth, least = [], 0, 0
    for k, (text, at) in enumerate(blocks):
        depth += opens[k]
        if not at.dropped:
            rank = 2 if at.article is not None else int(at.in_main)
            kept.append((text, k, rank))
            if not depth:
                least = max(least, rank)
    kept = [k for k in kept if k[2] >= least]
    texts, places, ranks = ([k[i] for k in kept] for i in range(3))
    before = [0]
    stay = set(places)
    for k in range(len(blocks)):
        before.append(before[-1] + (k in stay))
    subtrees = [(e.hash, e.first, e.last) for e in removable if before[e.last] > before[e.first]]
    seen = {(e.hash, e.tag in CONTAINERS, e.article.hash if e.article is not None else content) for e in removable}
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#]*)", url or "")
    return page_id, url, m.group(1).lower() if m else "", texts, places, ranks, subtrees, sorted(seen)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text of every row of ``pages``."""
    kind = dict(pages.dtypes)["page_id"]
    read = map_rows(pages.select("page_id", "url", "html"), page,
                    f"page_id {kind}, url string, host string, texts array<string>, places array<int>, ranks array<int>, "
                    "subtrees array<struct<subtree: long, first: int, last: int>>, "
                    "seen array<struct<subtree: long, box: boolean, content: long>>")
    read = written(read.withColumn("row", F.xxhash64("page_id", "url", "texts", "seen")), "pages")
    stands = read.select("host", F.inline("seen"))
    held = stands.distinct().groupBy("host", "subtree", "box").agg(F.count(F.lit(1)).alias("n"))
    contents = stands.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    templates = held.where(F.col("n") >= min_pages).join(contents, "host").where(
        F.col("box") | (2 * F.col("n") > F.col("all"))).select("host", "subtree")
    inside = read.select("row", "host", F.inline("subtrees")).distinct()
    # Of templates inside one another the outermost is enough.
    outer = Window.partitionBy("row").orderBy("first", F.desc("last")).rowsBetween(Window.unboundedPreceding, -1)
    gone = inside.join(templates, ["host", "subtree"]).withColumn("covered", F.max("last").over(outer)).where(
        F.col("covered").isNull() | (F.col("last") > F.col("covered"))).groupBy("row").agg(
        F.collect_set(F.struct("first", "last")).alias("gone"))
    left = F.filter(F.arrays_zip("texts", "places", "ranks"), lambda b: F.col("gone").isNull() | ~F.exists(
        "gone", lambda g: (b["places"] >= g["first"]) & (b["places"] < g["last"])))
    top = F.array_max(F.col("left")["ranks"])
    main = F.filter("left", lambda b: b["ranks"] == top)
    # Blocks that all lie in no removable subtree, as in most marked articles, lose none: they meet no join.
    may_lose = F.size("subtrees") > 0
    whole = read.where(~may_lose).select("page_id", "url", F.array_join("texts", "\n\n").alias("text"))
    return whole.unionByName(read.where(may_lose).join(gone, "row", "left").withColumn("left", left).select(
        "page_id", "url", F.array_join(main["texts"], "\n\n").alias("text")))


def main_texts(pages: DataFrame) -> DataFrame:
    """``extract`` and the text's length in code points."""
    return extract(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "text",
                                 F.length("text").cast("long").alias("n_chars"))
