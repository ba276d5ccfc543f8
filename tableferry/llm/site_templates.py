"""Main text of web pages: site templates are found by counting element subtrees over the pages of a host.

Every element subtree outside the article is hashed, by its content and, where all its text lies in links, also by its
shape, since menus differ in their links from page to page. A subtree that recurs on many pages of its host is a
template and is deleted. What markup itself names as no part of the article (menus, footers, asides, forms, adverts,
notices, comments) is deleted too. An element that is marked as the article bounds what is kept, and paragraphs inside
it stay even if many pages share them.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm import common
from tableferry.llm.host_reputation import host_of

#: A subtree is a template from this share of the pages of its host, and from so many pages.
SHARE = 0.5
LEAST_PAGES = 10

#: Element names of HTML, by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style title noscript template iframe object svg canvas audio video nav footer aside form button select textarea dialog menu".split()
)
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 header hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address center details summary fieldset hr".split()
)
CONTAINERS = frozenset(["article", "main"])
CLOSED_BY = {
    "p": BLOCKS - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "summary"} | DROPPED - {"script", "style", "template", "noscript", "iframe", "object", "svg", "button", "select", "textarea"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option"]),
    "head": frozenset(["body"]),
}
#: The other way round: the open elements that a tag closes.
CLOSES = {tag: [k for k, closing in CLOSED_BY.items() if tag in closing] for tag in frozenset().union(*CLOSED_BY.values())}
#: Words in a class, id or role that name something beside the article, and those that hold only outside it.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus respond reply replies share "
    "sharing social related newsletter subscribe subscription signup login widget toolbar pagination pager copyright complementary contentinfo search dialog".split()
)
OUTSIDE = frozenset(["header", "hero", "topbar", "side", "legal", "top", "bottom"])

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
#: What is dropped to the end of a page that has no more ``>``.
_UNENDED = re.compile(r"<[!?].*\Z", re.S)
_RAW_END = {tag: re.compile(f"</{tag}[\\s/>]", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


class Element:
    __slots__ = ("tag", "attributes", "items", "inside")

    def __init__(self, tag: str, attributes: str, inside: bool):
        self.tag, self.attributes, self.items, self.inside = tag, attributes, [], inside

    def names(self) -> tuple[set[str], bool]:
        """Words of class, id and role; whether the element is hidden."""
        words, hidden = set(), False
        for m in _ATTRIBUTE.finditer(self.attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role", "itemprop"):
                words |= {x.lower() for x in _NAME.findall(value)}
            elif key == "hidden":
                hidden = True
            elif key == "aria-hidden":
                hidden |= value.lower() == "true"
            else:
                hidden |= re.search(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        return words, hidden

    def dropped(self) -> bool:
        if self.tag in DROPPED:
            return True
        if self.tag in ("html", "body", "main"):
            return False
        if self.tag == "header":
            return not self.inside
        if not self.attributes:
            return False
        words, hidden = self.names()
        if hidden:
            return True
        if self.tag == "article":
            return bool(words & {"comment", "comments", "reply", "related", "teaser"})
        return bool(words & NAMED) or not self.inside and bool(words & OUTSIDE)


def parse(text: str) -> Element:
    """The tree of a page; tolerant of elements that are left open, closed twice or misnested.

    Time grows in proportion to the text: open elements are counted by tag, the places of those that others may close
    and of the blocks that shield them are kept, and behind the last ``>`` no tag is looked for.
    """
    root = Element("#root", "", False)
    stack, at, last = [root], 0, text.rfind(">")
    opened: Counter[str] = Counter()
    closable: dict[str, list[int]] = {k: [] for k in CLOSED_BY}  # places in the stack
    shields: list[int] = [0]
    containers = 0

    def close(depth: int) -> None:
        nonlocal containers
        for element in reversed(stack[depth:]):
            opened[element.tag] -= 1
            containers -= element.tag in CONTAINERS
            if element.tag in CLOSED_BY:
                closable[element.tag].pop()
            elif element.tag in BLOCKS:
                shields.pop()
        del stack[depth:]

    while True:
        m = _TAG.search(text, at, last + 1) or _UNENDED.search(text, max(at, last + 1))
        if m is None:
            stack[-1].items.append(text[at:])
            return root
        if m.start() > at:
            stack[-1].items.append(text[at : m.start()])
        at = m.end()
        name = m[2] or m[5] if m.re is _TAG else None
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith(("-->", "--!>")):
                at = len(text)
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if opened[tag] > 0:
                close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag))
            continue
        near = max((closable[k][-1] for k in CLOSES.get(tag, ()) if closable[k]), default=0)
        if near > shields[-1]:
            close(near)
        attributes = m[3] or m[6] or ""
        element = Element(tag, attributes, containers > 0)
        stack[-1].items.append(element)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(text, at)
            element.items.append(text[at : end.start()] if end else text[at:])
            at = (text.find(">", end.start()) + 1 or len(text)) if end else len(text)
            continue
        stack.append(element)
        opened[tag] += 1
        containers += tag in CONTAINERS
        if tag in CLOSED_BY:
            closable[tag].append(len(stack) - 1)
        elif tag in BLOCKS:
            shields.append(len(stack) - 1)


def _walk(root: Element) -> list[Element]:
    """All elements, each before its descendants; without recursion, as pages may be nested deeply."""
    out, todo = [], [root]
    while todo:
        element = todo.pop()
        out.append(element)
        todo += [x for x in reversed(element.items) if isinstance(x, Element)]
    return out


def hashes(root: Element) -> dict[int, tuple[int, ...]]:
    """Hashes (content, and shape where all text lies in links) of the subtrees with text outside containers, by id()."""
    found: dict[int, tuple[int, ...]] = {}
    parts: dict[int, tuple[str, str, bool, bool]] = {}  # content, shape, has text, has text outside links
    for element in reversed(_walk(root)):
        named = [m[0] for m in _ATTRIBUTE.finditer(element.attributes) if m[1].lower() in ("class", "id", "role")]
        content, shape, text, free = [element.tag, element.attributes.strip()], [element.tag, *named], False, False
        for item in element.items:
            if isinstance(item, str):
                bare = " ".join(item.split())
                if bare:
                    content.append(bare)
                    text = True
                    free |= element.tag != "a"
            else:
                c, s, t, f = parts.pop(id(item))
                content.append(c)
                shape.append(s)
                text |= t
                free |= f and element.tag != "a"
        c = xxhash.xxh64_hexdigest("\x00".join(content))
        s = xxhash.xxh64_hexdigest("\x00".join(shape))
        parts[id(element)] = c, s, text, free
        if text and not element.inside and element.tag not in ("#root", "html", "body", *CONTAINERS):
            signed = lambda x: int(x, 16) - (1 << 63)
            found[id(element)] = (signed(c),) if free or element.tag == "a" else (signed(c), signed(s))
    return found


def extract(text: str | None, templates: frozenset[int] = frozenset()) -> str:
    """Blocks of the main text in page order, joined by one line feed; empty for null or no text."""
    if not text:
        return ""
    root = parse(text)
    marks = hashes(root) if templates else {}
    everything = _walk(root)
    bounded = any(x.tag in CONTAINERS and not x.dropped() for x in everything)
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        block = " ".join(markup.unescape("".join(run)).split())
        run.clear()
        if block:
            blocks.append(block)

    todo: list[tuple[Element, int]] = [(root, 0)]
    while todo:
        element, position = todo.pop()
        if position == 0:
            if element.tag == "br":
                run.append(" ")
                continue
            if element is not root and (element.dropped() or not templates.isdisjoint(marks.get(id(element), ()))):
                if element.tag in BLOCKS or element.tag in DROPPED:
                    flush()
                continue
            if element.tag in BLOCKS:
                flush()
        kept = not bounded or element.inside or element.tag in CONTAINERS
        while position < len(element.items):
            item = element.items[position]
            position += 1
            if isinstance(item, str):
                if kept:
                    run.append(item)
            else:
                todo += [(element, position), (item, 0)]
                break
        else:
            if element.tag in BLOCKS:
                flush()
    flush()
    return "\n".join(blocks)


def templates(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, pages, hashes``: the subtrees that are templates of a host; hosts without any have no row.

    A page counts once for each of its subtrees. A host has at most ``1 / share`` times as many templates as its pages
    have subtrees on average, so a row is bounded by the length of pages.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, marks = [], []
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {x for pair in hashes(parse(text or "")).values() for x in pair}
                hosts += [host] * (len(own) + 1)
                marks += [None, *own]
            if hosts:
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(marks, pa.int64())], names=["host", "mark"])

    marked = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(mark, "host string, mark long")
    counts = common.stored(marked.groupBy("host", "mark").agg(F.count("*").alias("n")), "subtrees")
    totals = common.stored(counts.filter("mark is null").select("host", F.col("n").alias("pages")), "hosts")
    total = totals.agg(F.sum("pages")).first()[0] or 0
    often = counts.filter((F.col("n") >= least_pages) & F.col("mark").isNotNull())
    recurring = common.join_counted(often, totals, "host", "pages", total).filter(F.col("n") >= share * F.col("pages"))
    return common.stored(recurring.groupBy("host").agg(F.first("pages").alias("pages"), F.collect_set("mark").alias("hashes")), "templates")


def main_text(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars.

    Null and empty html give an empty text. Pages whose url is null or has no host share one host. Repeated rows are
    extracted each, and count as pages of their own. An empty table gives no rows; other columns are ignored. Nothing
    is cut at any length.
    """
    found = templates(pages, share, least_pages)
    total = max(1, pages.count())
    hot = found.filter(F.col("pages") >= common.HOT_SHARE * total).select("host", F.col("hashes").alias("hot"))
    cold = found.filter(F.col("pages") < common.HOT_SHARE * total).select("host", F.col("hashes").alias("cold"))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(hot), "host", "left").join(cold, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty: frozenset[int] = frozenset()
        for batch in batches:
            if batch.num_rows:
                marks = [frozenset(x) if x else empty for x in batch.column(3).to_pylist()]
                texts = [extract(x, m) for x, m in zip(batch.column(2).to_pylist(), marks)]
                columns = [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = rows.select("page_id", "url", "html", F.coalesce("hot", "cold").alias("marks"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
