"""Main text of web pages by tree scoring.

The page is read into a tree.  Every block of text gives points for its length
and its commas to its container and, less, to the containers above; a
container's points are discounted by its link density.  The best container is
the article; siblings that score well, and headings beside it, belong to it.
Menus, headers, footers, sidebars, adverts, notices, forms and comments are
left out by their tags, roles and class names before scoring; a form, or a
block with such a class name, stays if it is a wrapper of the page's article or
of most of the page's text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .words import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attr>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attr2>[^>]*+)(?:>|\Z)",
    re.S,
)
#: The same without quotes: an open quote would be looked for to the page's end at every tag.
_LOOSE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attr>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "xmp", "noembed", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_OUT = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "object", "canvas", "head", "fieldset", "label", "option"}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br img label ruby rt rp nobr".split())
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|widget|comments?|respond|disqus|replies|reply|cookies?|consent|notice|notification|alert|popup|modal|overlay|share|sharing|social|related|recommend\w*|breadcrumbs?|menu|navbar|nav|navigation|toolbar|footer|foot|masthead|header|topbar|subscribe|subscription|newsletter|signup|login|pagination|pager|skip|legal|copyright)(?:[\s_-]|$)",
    re.I,
)
_MODIFIER = re.compile(r"(?:has|no|not|with|without)[_-]", re.I)
_ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "dialog", "alert", "menu", "menubar"}


class Node:
    __slots__ = ("tag", "up", "depth", "block", "out", "link", "points", "chars", "linked", "inside", "soft", "plain", "articles", "stays")

    def __init__(self, tag: str, up: Node | None, out: bool, soft: bool = False):
        self.tag, self.up, self.out = tag, up, out or (up is not None and up.out)
        self.depth = 0 if up is None else up.depth + 1
        self.block = up.block if tag in _INLINE else self  # the nearest node that isn't inline; the root isn't
        self.link = tag == "a" or (up is not None and up.link)
        self.inside = tag in ("article", "main") or (up is not None and up.inside)
        self.soft = self if soft else up.soft if up is not None else None  # the nearest node left out unless it is a wrapper
        self.points = 0.0
        self.chars = self.linked = 0
        self.plain = self.articles = 0
        self.stays = False


def _boiler(value: str, inside: bool) -> bool:
    """A name of boilerplate; 'has-sidebar' and the like only tell of one, and
    a header inside an article is its own."""
    names = [n for n in value.split() if not _MODIFIER.match(n)]
    return any(m.strip(" _-").lower() != "header" or not inside for n in names for m in (x[0] for x in _BOILER.finditer(n)))


def _left_out(tag: str, attrs: str, up: Node) -> tuple[bool, bool]:
    """(left out, left out unless it is a wrapper)"""
    if tag in _OUT or (tag == "header" and not up.inside):
        return True, False
    soft = tag == "form"
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, soft
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if name == "role" and value.lower() in _ROLES:
            return True, False
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return True, False
        soft = soft or (name in ("class", "id") and _boiler(value, up.inside))
    return (soft, False) if tag in _INLINE else (False, soft)


def _wrappers(soft: list[Node], articles: list[Node], blocks: list[tuple[Node, str, int]]) -> None:
    """Marks the nodes that stay: outer before inner ones, the largest first.
    The one with the article stays if no article is outside, others by their share."""
    clean = any(a.soft is None for a in articles)
    direct = {id(a.soft) for a in articles}
    for a in articles:
        if a.soft is not None:
            a.soft.articles += 1
    for node, text, linked in blocks:
        if node.soft is not None:
            node.soft.plain += len(text) - linked
    for s in reversed(soft):
        if s.up.soft is not None:
            s.up.soft.plain += s.plain
            s.up.soft.articles += s.articles
    total = sum(len(text) - linked for _, text, linked in blocks)
    for s in sorted(soft, key=lambda s: -s.plain):  # an outer node comes before those inside, as the sort is stable
        if s.up.soft is None or s.up.soft.stays:
            s.stays = (s.articles > 0 and not clean) or s.plain > 0.8 * total
            clean = clean or (s.stays and id(s) in direct)


def _blocks(page: str) -> list[tuple[Node, str, int]]:
    """(container, text, linked characters) of the blocks that aren't left out."""
    root = Node("", None, False)
    top, blocks, parts, linked = root, [], [], 0
    soft, articles = [], []
    low = None
    token, open_tags = _TOKEN, Counter()  # of the path from the root to ``top``

    def leave(node: Node) -> None:
        """``node``, around ``top``, becomes the top."""
        nonlocal top
        while top is not node:
            open_tags[top.tag] -= 1
            top = top.up

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text and not top.out:
            blocks.append((top.block, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    at = 0
    while at < len(page):
        cut = page.find("<", at)
        m = None
        while cut >= 0 and (m := token.match(page, cut)) is None:
            cut = page.find("<", cut + 1)
        end = len(page) if cut < 0 else cut
        if end > at and not top.out:
            text = html.unescape(page[at:end])
            parts.append(text)
            if top.link:
                linked += len(text.strip())
        if m is None:
            break
        at = m.end()
        loose = token is _TOKEN and m["tag2"]
        name, attrs, closing = (m["tag2"], m["attr2"], bool(m["end2"])) if loose else (m["tag"], m["attr"], bool(m["end"]))
        token = _LOOSE if loose else token
        if not name:
            if m[0].startswith("<![CDATA[") and not top.out:
                parts.append(re.sub(r"\]\]>$", "", m[0][9:]))
            continue
        tag = name.lower()
        if tag in _RAW and not closing:
            if not attrs.endswith("/"):
                low = page.lower() if low is None else low
                found = (low if len(low) == len(page) else page).find(f"</{tag}", at)
                at = len(page) if found < 0 else (page.find(">", found) + 1 or len(page))
            continue
        if tag in _VOID:
            if tag in ("br", "wbr", "img"):
                parts.append(" " if tag != "wbr" else "")
            elif tag == "hr":
                flush()
            continue
        if closing:
            if not open_tags[tag]:
                if tag == "p":
                    flush()
                continue
            node = top
            while node.tag != tag:
                node = node.up
            if tag not in _INLINE or node.up.soft is not top.soft:
                flush()
            leave(node.up)
            continue
        if tag not in _INLINE:
            flush()
            shut, scope = _CLOSES.get(tag, set()), _SCOPE.get(tag, set())
            node, last = top.block, None
            while node is not root and node.tag not in scope and (node.tag in shut or node.tag == "p" or node.tag in _HEADING and tag in _HEADING):
                last = node
                node = node.up.block
            if last is not None:
                leave(last.up)
            else:
                while top.tag == "a" and tag in ("article", "main", "section", "body"):
                    leave(top.up)
        open_tags[tag] += 1
        top = Node(tag, top, *_left_out(tag, attrs, top))
        if not top.out:
            if top.soft is top:
                soft.append(top)
            if tag in ("article", "main") and not any(m[1].lower() in ("class", "id") and _boiler(m[2] or m[3] or m[4] or "", False) for m in _ATTR.finditer(attrs)):
                articles.append(top)
    flush()
    _wrappers(soft, articles, blocks)
    return [b for b in blocks if b[0].soft is None or b[0].soft.stays]


def _scored(blocks: list[tuple[Node, str, int]]) -> list[Node]:
    """The nodes around blocks, with their points and characters, in the order
    the blocks reach them.  Points go four levels up, characters to the root."""
    seen, known = [], set()
    for node, text, linked in blocks:
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        holder = up = node if node.tag in ("", "html", "body", "div", "article", "main", "section", "td") else node.up
        holder.chars += len(text)
        holder.linked += linked
        for part in (1, 2, 6, 9):
            if up is not None:
                up.points += points / part
                up = up.up
        up = holder
        while up is not None and id(up) not in known:
            known.add(id(up))
            seen.append(up)
            up = up.up
    for n in sorted(seen, key=lambda n: -n.depth):
        if n.up is not None:
            n.up.chars += n.chars
            n.up.linked += n.linked
    return seen


def _branch(node: Node, beside: Node, known: dict[int, Node | None]) -> Node | None:
    """The node on the way from ``node`` to the root that is ``beside`` or has
    the same parent; ``known`` keeps the answers, so that no way is gone twice."""
    way, up = [], node
    while up is not None and id(up) not in known and up.up is not beside.up:
        way.append(up)
        up = up.up
    found = None if up is None else known.get(id(up), up)
    known.update((id(n), found) for n in way)
    return found


def main_text(page: str) -> str:
    """Blocks of the article in page order, joined by line feeds."""
    blocks = _blocks(page)
    seen = _scored(blocks)
    if not seen:
        return ""

    def value(n: Node) -> float:
        return n.points * (1 - n.linked / n.chars) * (1.5 if n.tag in ("article", "main") else 1)

    best = max(seen, key=value)
    while best.up is not None and not best.up.out and best.tag in ("ul", "ol", "dl", "table", "tbody", "tr", "blockquote", "p", "li", "dd"):
        best = best.up
    up = best.up
    while up is not None and up.tag not in ("article", "main"):  # an article around the best container holds it all
        up = up.up
    best = best if up is None else up
    enough = max(1.0, 0.2 * value(best))
    out, known = [], {}
    for node, text, linked in blocks:
        branch = _branch(node, best, known)
        if branch is not best:
            if branch is None or not (value_of(branch, value) >= enough or branch.tag in _HEADING or (branch.tag == "p" and linked < 0.25 * len(text) and len(text) > 80)):
                continue
        out.append(text)
    return "\n".join(out)


def value_of(node: Node, value) -> float:
    return value(node) if node.chars else 0.0


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row.

    Null html is empty; a page without text gives an empty text.  Pages are
    independent, so repeated rows and null ids and urls stay as they are; pages
    of any length and depth are read whole, in linear time but for a sort of the
    nodes by depth.  From a tag whose quote is never closed, a page is read as
    if quotes meant nothing.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pages in slices(batches, 2):
            texts = [main_text(p.decode("utf-8", "replace")) for p in pages]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
