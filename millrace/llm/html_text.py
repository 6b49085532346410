"""Main text of web pages: site templates by subtrees that recur on a host, and a few rules of structure.

A page is parsed into a tree. The hash of each subtree that is or holds a block, whatever its tag or class,
goes to Spark, which counts on how many distinct pages of its host each stands; a subtree on LEAST_PAGES of
them, whatever the host's size, is a template and is deleted. That comes first. Then rules take what does not
recur: elements that are never content by tag, role or the words of their class and id.
Within an article, paragraphs and headings are never templates: a passage that articles share is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches
from millrace.session import cut, drop, table

#: A template stands on this many distinct pages of its host.
LEAST_PAGES = 8
#: Templates that are broadcast at most (32 bytes each), and those of one host that each of its rows carries at
#: most; with more of either, each page gets its own templates by a join.
BROADCAST_TEMPLATES, HOST_TEMPLATES = 200_000, 2_000

# fixed values: HTML's element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
NO_TEXT = frozenset("head script style noscript template iframe svg canvas audio video noembed noframes title xmp annotation annotation-xml".split())
SKIPPED = frozenset("nav footer aside form button select textarea input dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot dd dt li summary figcaption".split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
KEPT_IN_ARTICLE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr figcaption table tbody thead article main body html".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement adsense adbox adslot banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer header masthead"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended trending comment comments"
    " disqus respond reply replies widget toolbar pagination pager skip".split()
)

# what stays in an article whatever the words of its class say, and the words that count there all the same
TEXT_IN_ARTICLE = frozenset("p h1 h2 h3 h4 h5 h6 header hgroup blockquote pre figcaption math".split())
ADVERT = frozenset("ad ads advert adverts advertisement sponsored".split())

ARTICLES = ("article", "main")

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*+(?:>|$)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))*+)(?:>|$)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
#: A class or id that names a reader's comment, and not that an article has or lacks them.
_COMMENT = re.compile(r"(?!(?:has|no|with|allow)[-_])(?:.*[-_])?(?:comments?|reply|replies)(?:[-_]+(?:body|item|entry|content|text|list|thread|section|area|\d+))*")


@dataclass
class Node:
    tag: str
    cut: bool  # holds no text at all, or is deleted
    parent: Node | None = None
    in_article: bool = False
    rule: bool = False  # never content, by the rules of structure
    children: list = field(default_factory=list)  # nodes and strings
    hash: int = 0
    empty: bool = True


def _comment(name: str, value: str) -> bool:
    """Whether an attribute says that its element is a reader's comment."""
    if name in ("class", "id"):
        return any(_COMMENT.fullmatch(word) for word in value.split())
    return name == "itemprop" and value in ("comment", "comments") or name == "itemtype" and value.rstrip("/").endswith("/comment")


def _boilerplate(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in SKIPPED or (tag == "header" and not in_article):
        return True
    if not attrs or "=" not in attrs or tag in ("html", "body"):
        return False
    text = in_article and tag in TEXT_IN_ARTICLE
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if _comment(name, value):
            return True
        if tag in ARTICLES:
            continue
        if name == "role" and value in ROLES and not (text and tag == "header") or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id"):
            if text:
                named = not ADVERT.isdisjoint(value.split())
            else:
                named = not BOILERPLATE.isdisjoint(w for w in _NAME.findall(value) if not (in_article and w == "header"))
            if named:
                return True
    return False


def _close(here: Node, tag: str) -> Node:
    """Where a new element goes once it has ended what it implies the end of: an open paragraph, item or cell."""
    ends, scope, up = SELF_CLOSING.get(tag, ("p",)), SCOPES.get(tag, ()), here
    while up.parent and up.tag not in ends and up.tag not in scope and (scope or up.tag not in BLOCKS):
        up = up.parent
    return up.parent if up.parent and up.tag in ends else here


def parse(html: str | None) -> Node:
    """The tree of a page; ends that are missing are implied, and a page that breaks off ends there."""
    html = html or ""
    root = here = Node("#root", False)
    pos, articles = 0, 0
    while pos < len(html):
        lt = html.find("<", pos)
        m = _TAG.match(html, lt) if lt >= 0 else None
        end = lt if m else lt + 1 if lt >= 0 else len(html)  # a "<" that begins no tag is text
        if end > pos:
            here.children.append(html[pos:end])
        pos = m.end() if m else end
        if not m:
            continue
        if m[1] is not None:
            here.children.append(m[1].replace("&", "&amp;"))
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            up = here
            while up.parent and up.tag != tag:
                up = up.parent
            if up.parent:
                while here is not up.parent:
                    articles -= here.tag in ARTICLES
                    here = here.parent
            continue
        if tag in CLOSES_P or tag in SELF_CLOSING:
            to = _close(here, tag)
            while here is not to:
                articles -= here.tag in ARTICLES
                here = here.parent
        node = Node(tag, tag in NO_TEXT, here, articles > 0, _boilerplate(tag, m[4], articles > 0))
        here.children.append(node)
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}[\s>/]", re.I).search(html, pos)
            pos = over.start() if over else len(html)
        if tag not in VOID and not m[4].endswith("/"):
            here = node
            articles += tag in ARTICLES
    return root


BREAK = Node("hr", False)  # stands where a block was cut


def _walk(top: Node) -> Iterator[tuple[Node | str, bool]]:
    """Nodes (and strings) that are not cut, in page order; a node comes again, with True, when it ends."""
    stack: list = [(top, False)]
    while stack:
        x, done = stack.pop()
        yield x, done
        if isinstance(x, Node) and not done and not x.cut:
            stack.append((x, True))
            stack += [(BREAK if isinstance(c, Node) and c.cut else c, False) for c in reversed(x.children) if isinstance(c, str) or not c.cut or c.tag in BLOCKS]


def subtree_hashes(root: Node) -> int:
    """Set .hash of every node that is not cut, from its tag and what it holds; returns that of the page."""
    open_: list[list[bytes]] = [[]]
    for x, done in _walk(root):
        if isinstance(x, str):
            if t := _SPACE.sub(" ", unescape(x)).strip():
                open_[-1].append(t.encode("utf-8", "replace"))
        elif not done:
            open_.append([x.tag.encode()])
        else:
            parts = open_.pop()
            x.hash = xxhash.xxh3_64_intdigest(b"\0".join(parts)) - (1 << 63)
            x.empty = len(parts) == 1
            if not x.empty:
                open_[-1].append(x.hash.to_bytes(8, "little", signed=True))
    return root.hash


def candidates(root: Node) -> set[int]:
    """Hashes of the subtrees that may be templates."""
    return {x.hash for x, done in _walk(root) if done and isinstance(x, Node) and _may_be_template(x)}


def _may_be_template(x: Node) -> bool:
    return x.tag in BLOCKS and not x.empty and x.tag not in ("html", "body", "article", "main") and not (x.in_article and x.tag in KEPT_IN_ARTICLE)


def delete(root: Node, templates: frozenset[int] | set[int], rules: bool = True) -> tuple[int, int]:
    """Cut the templates, then of the rest what the rules name; returns how many subtrees went by either."""
    def cut_where(named) -> int:
        n = 0
        for x, done in _walk(root):
            if not done and isinstance(x, Node) and named(x):
                x.cut, n = True, n + 1
        return n

    recurring = cut_where(lambda x: x.hash in templates and _may_be_template(x)) if templates else 0
    return recurring, cut_where(lambda x: x.rule) if rules else 0


def main_text(root: Node, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the article (of <main>, of the page, if there is none), without templates."""
    delete(root, templates)
    nodes = [x for x, done in _walk(root) if not done and isinstance(x, Node)]
    tops = [x for x in nodes if x.tag == "article" and not x.in_article] or [x for x in nodes if x.tag == "article"] or [x for x in nodes if x.tag == "main"] or [root]
    blocks: list[str] = []
    part: list[str] = []

    def end() -> None:
        if t := _SPACE.sub(" ", "".join(part)).strip():
            blocks.append(t)
        part.clear()

    for top in tops:
        for x, _ in _walk(top):
            if isinstance(x, str):
                part.append(unescape(x))
            elif x.tag in BLOCKS or x.tag == "hr":
                end()
            elif x.tag == "br":
                part.append(" ")
        end()
    return "\n\n".join(blocks)


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url and text (the main text, empty if none) of each row of pages (page_id, url, html).

    A null html counts as empty. Pages without a host (a null url, a relative one) share the host "". Rows
    that repeat count as one page in the search for templates and each give a row. An empty table gives none.
    """
    bounded_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host.alias("host"))

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, own, page = [], [], []
            for h, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = parse(html)
                whole = subtree_hashes(root)
                found = {0} | candidates(root)  # 0 stands for the page itself
                hosts += [h] * len(found)
                own += found
                page += [whole] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(own, pa.int64()), pa.array(page, pa.int64())], ["host", "subtree", "page"])

    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_ = pa.array([subtree_hashes(parse(html)) for html in batch.column("html").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pages_], [*batch.schema.names, "page"])

    seen = rows.select("host", "html").mapInArrow(subtrees, "host string, subtree long, page long").distinct()
    counts = cut(seen.groupBy("host", "subtree").agg(F.count("*").alias("n")), "html-counts")
    common = cut(counts.where((F.col("subtree") != 0) & (F.col("n") >= least_pages)).select("host", "subtree"), "html-templates")
    drop(counts)
    total, most = common.groupBy("host").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    listed = F.sort_array(F.collect_list("subtree")).alias("templates")
    if (total or 0) <= BROADCAST_TEMPLATES and (most or 0) <= HOST_TEMPLATES:
        joined = rows.join(F.broadcast(common.groupBy("host").agg(listed)), "host", "left")
    else:
        own = cut(seen.join(common, ["host", "subtree"]).groupBy("host", "page").agg(listed), "html-own")
        joined = rows.mapInArrow(paged, rows.schema.simpleString()[7:-1] + ",page:bigint").join(own, ["host", "page"], "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, found in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True):
                root = parse(html)
                if found:
                    subtree_hashes(root)
                out.append(main_text(root, set(found or ())))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "templates").mapInArrow(texts, f"page_id {kind}, url string, text string")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"op7_html_text": op7_html_text}
