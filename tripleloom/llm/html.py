"""Main text of HTML pages: structural rules, and removal of subtrees that a host repeats.

A page is read once into a tree of elements with tolerant rules for tags that are left open. Parts
that are never main text go by their element or by the words of their class, id and role. Of the
other subtrees, in a marked article or not, those of which the hash recurs on many pages of the host
are its template, and go too. Hashes are counted by host in Spark.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stage

#: A subtree is template if it is on so many pages of a host, or on all pages of a host that has SMALL_HOST at least.
LEAST_PAGES, SMALL_HOST = 5, 3

# fixed values: elements by their role in a page
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
DROPPED = set("script style textarea title noscript iframe xmp noembed noframes template head nav footer aside form button select svg canvas object audio video dialog menu".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag ends these if they are still open within the nearest element of SCOPE.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": {"tbody"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = set("ul ol dl table select menu article section main div body td th".split())
#: Words of class, id and role that mark what is not main text.
BOILERPLATE = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead toolbar comment comments reply replies disqus respond related recommended share sharing social newsletter subscribe signup login search widget pagination pager skip tags contentinfo complementary dialog".split())
#: Headers of the page; one inside an article belongs to it.
HEADERS = {"header", "banner"}
#: Of these words, those that may mark an article's own text inside of one.
OWN = set("tags search widget toolbar skip header banner notice dialog aside footer reply related".split())
#: Elements beside an article, or beside what holds it, that belong to it.
LEADS = set("h1 h2 h3 h4 h5 h6 hgroup p blockquote figure".split())
#: Elements that may recur in the text of different articles: paragraphs, quotations, entries of lists, headings, cells.
PARTS = set("p blockquote pre li dt dd h1 h2 h3 h4 h5 h6 td th tr caption figcaption".split())
MAIN = {"article", "main"}

# a value is quoted if a quote follows the equals sign; other quotes are characters like any
_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|))*+"
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)", re.S)
_MARK = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


@dataclass(slots=True)
class Node:
    tag: str
    attrs: str = ""
    children: list = field(default_factory=list)


def parse(page: str) -> Node:
    """The page's tree. Children are nodes and pieces of raw text; unknown end tags are skipped.

    A block's start tag ends an open paragraph; an end tag ends all that was opened inside.
    """
    root = Node("")
    open_: list[Node] = [root]
    names: Counter = Counter()
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            open_[-1].children.append(page[at:])
            break
        if m.start() > at:
            open_[-1].children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                open_[-1].children.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if m[1]:
            if names[tag]:
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == tag:
                        _end(open_, names, i)
                        break
                    if open_[i].tag in ("article", "main", "body", "td") and tag in ("p", "b", "i", "span", "li", "a", "em", "strong"):
                        break
            continue
        if tag in BLOCK and names["p"]:
            _close(open_, names, {"p"})
        if tag in CLOSES and any(names[x] for x in CLOSES[tag]):
            _close(open_, names, CLOSES[tag])
        node = Node(tag, m[3])
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else size
            node.children.append(page[at:stop])
            at = stop
            if end:
                close = page.find(">", stop)
                at = size if close < 0 else close + 1
        elif tag not in VOID and not (tag in ("svg", "path") and m[3].endswith("/")):
            open_.append(node)  # a slash closes only void and foreign elements
            names[tag] += 1
    return root


def _end(open_: list[Node], names: Counter, i: int) -> None:
    for x in open_[i:]:
        names[x.tag] -= 1
    del open_[i:]


def _close(open_: list[Node], names: Counter, tags: set[str]) -> None:
    """End the innermost elements down to the outermost of ``tags`` in scope, with what they hold."""
    cut = None
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag in tags:
            cut = i
        elif open_[i].tag in SCOPE:
            break
    if cut is not None:
        _end(open_, names, cut)


def is_boilerplate(node: Node, inside: bool) -> bool:
    """Whether an element is never main text; ``inside`` an article a header belongs to it."""
    tag = node.tag
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not node.attrs or tag in ("html", "body") or tag in MAIN and not inside:
        return False
    if _HIDDEN.search(node.attrs):
        return True
    for m in _MARK.finditer(node.attrs):
        words = set(_WORD.findall((m[1] or m[2] or m[3] or "").lower()))
        if words & (BOILERPLATE - OWN if inside else BOILERPLATE):
            return True
    return False


@dataclass(slots=True)
class Subtree:
    """Hash and letters of an element with all it holds; ``size`` is the length of its text outside boilerplate."""

    hash: int
    lettered: bool
    size: int


def _signed(data: bytes) -> int:
    h = xxhash.xxh64_intdigest(data)
    return h - (1 << 64) if h >> 63 else h


def subtrees(root: Node, inside: bool) -> dict[int, Subtree]:
    """By id(): every element under ``root``, hashed from its children's hashes; white space and digits alike."""
    out: dict[int, Subtree] = {}
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        x, leaving = stack.pop()
        if not leaving:
            stack.append((x, True))
            stack += [(c, False) for c in x.children if isinstance(c, Node)]
            continue
        parts, lettered, size = [f"<{x.tag}>".encode()], False, 0
        for c in x.children:
            if isinstance(c, str):
                if text := _SPACE.sub(" ", entities.unescape(c)).strip():
                    parts.append(_DIGITS.sub("0", text).encode("utf-8", "replace"))
                    lettered = lettered or any(map(str.isalpha, text))
                    size += len(text)
            else:
                sub = out[id(c)]
                parts.append(b"\1" + sub.hash.to_bytes(8, "big", signed=True))
                lettered, size = lettered or sub.lettered, size + sub.size
        out[id(x)] = Subtree(_signed(b"\0".join(parts)), lettered, 0 if x is not root and is_boilerplate(x, inside) else size)
    return out


def may_be_template(node: Node, sub: Subtree, whole: Subtree, inside: bool) -> bool:
    """Whether a subtree goes if it recurs. In a marked article, half of its text or more never does,
    nor what has no letters, nor one of PARTS by itself: authors repeat sentences, templates repeat boxes.
    """
    if node.tag not in BLOCK or node.tag in ("html", "body"):
        return False
    return not inside or (sub.lettered and 2 * sub.size < whole.size and node.tag not in PARTS)


def _roots(page: str) -> list[Node]:
    """Where main text is looked for: the outermost articles and the LEADS beside them, else the whole page."""
    root = parse(page)
    over: dict[int, Node] = {}
    articles, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.tag in MAIN:
            articles.append(x)
        else:
            for c in reversed(x.children):
                if isinstance(c, Node):
                    over[id(c)] = x
                    stack.append(c)
    if not articles:
        return [root]
    holds = set()
    for x in articles:
        while (x := over.get(id(x))) is not None and id(x) not in holds:
            holds.add(id(x))
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.tag in MAIN:
            out.append(x)
        elif is_boilerplate(x, False):
            continue
        elif id(x) in holds:
            stack += [c for c in reversed(x.children) if isinstance(c, Node)]
        elif x.tag in LEADS:
            out.append(Node("", "", [x]))
    # an article that stands inside boilerplate is none, unless there is no other
    return out if any(x.tag in MAIN for x in out) else articles


def template_hashes(page: str) -> tuple[int, list[int]]:
    """A hash of the page's text, and those of the block subtrees that may be template, inside marked articles too."""
    out, texts = set(), []
    for root in _roots(page):
        inside = root.tag in MAIN
        known = subtrees(root, inside)
        whole, stack = known[id(root)], [root]
        while stack:
            for c in stack.pop().children:
                if isinstance(c, str):
                    texts.append(_DIGITS.sub("0", _SPACE.sub(" ", c).strip()))
                elif not is_boilerplate(c, inside):
                    if may_be_template(c, known[id(c)], whole, inside):
                        out.add(known[id(c)].hash)
                    stack.append(c)
    return _signed("\0".join(filter(None, texts)).encode("utf-8", "replace")), sorted(out)


def extract(page: str | None, template: set[int] | frozenset[int] = frozenset()) -> str:
    """The main text: blocks in page order joined by a blank line, white space in them made one space."""
    if not page:
        return ""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(line))).strip()
        if text:
            blocks.append(text)
        line.clear()

    for root in _roots(page):
        inside = root.tag in MAIN
        known = subtrees(root, inside) if template else {}
        stack: list = [(root, False)]
        while stack:
            x, leaving = stack.pop()
            if isinstance(x, str):
                line.append(x)
                continue
            block = x.tag in BLOCK
            if leaving:
                if block:
                    flush()
                continue
            if x is not root and is_boilerplate(x, inside):
                flush() if block else line.append(" ")
                continue
            if template and x is not root and known[id(x)].hash in template and may_be_template(x, known[id(x)], known[id(root)], inside):
                flush()
                continue
            if block:
                flush()
            elif x.tag == "br":
                line.append(" ")
            stack.append((x, True))
            stack += [(c, False) for c in reversed(x.children)]
        flush()
    return "\n\n".join(blocks)


def _host() -> Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, host, hashes): for pages with template subtrees, the hashes to delete.

    A subtree counts once a page, pages of the same text count once, and pages of a host are
    counted by (host, hash) with map-side sums.
    """
    rows = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [template_hashes(x) if x else (0, []) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.list_(pa.int64()))], ["page_id", "url", "body", "hashes"])

    kind = rows.schema["page_id"].dataType.simpleString()
    seen = rows.mapInArrow(run, f"page_id {kind}, url string, body long, hashes array<long>")
    seen = stage(seen.select("page_id", _host().alias("host"), "body", "hashes"), "subtrees")
    # copies of one text say nothing of the host's template
    different = seen.dropDuplicates(["host", "body"])
    size = different.groupBy("host").agg(F.count("*").alias("pages"))
    counted = different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    often = counted.join(size, "host").filter((F.col("n") >= least_pages) | ((F.col("n") >= SMALL_HOST) & (F.col("n") == F.col("pages"))))
    each = seen.select("page_id", "host", F.explode("hashes").alias("hash"))
    return each.join(often.select("host", "hash"), ["host", "hash"]).groupBy("page_id", "host").agg(F.collect_set("hash").alias("hashes"))


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages(page_id, url, html)``.

    A null or empty html, and a page without main text, give an empty text. Addresses that are null
    or have no host share one host. Repeated page ids of a host share the hashes to delete, which only
    ever match their own subtrees. An empty table gives an empty result; other columns are ignored.
    """
    prepare(pages.sparkSession)
    rows = pages.select("page_id", "url", "html")
    cut = templates(pages, least_pages).withColumnsRenamed({"page_id": "__page", "host": "__host"})
    both = rows.join(cut, F.col("page_id").eqNullSafe(F.col("__page")) & (_host() == F.col("__host")), "left").select("page_id", "url", "html", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x, frozenset(h or ())) for x, h in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return both.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
