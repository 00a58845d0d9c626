"""Main text of HTML pages by scoring the tree of elements.

A small tokenizer builds the element tree of a page.  Each paragraph passes
points for its length and commas to its parent and, halved, to the ancestor
above; a container's points are then discounted by its link density.  If the best container
is or lies in an article, that article is kept whole, else the main element it
lies in; in a page with neither, the best container is kept.  Whatever stands
beside the kept element, text of any tag, stays too unless half of it or more
is links (beside a main element nothing does).  Elements that
never hold main text (menus, headers and footers of the page, sidebars,
notices, adverts, forms, scripts, styles, reader comments) are left out before
scoring, by their tag, role, class or id.  Names are split at humps, hyphens and white space; names such
as no-sidebar or has-ads say nothing.  A form that holds an article, main or h1 element is no form but
the page, and a header within an article or main element stays whatever its class.

Null and empty html give an empty text.  Character references are decoded,
white space inside a block is one space, blocks are joined by two line feeds in
page order, and no block is dropped for its length or its repetition.  Of tied
containers the first in the page wins.  Pages without any paragraph keep the
text of their best container.  Rows are independent: repeated rows give
repeated results, extra columns are dropped.  The work on a page is linear in
its length, deep nesting included.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.llm.tables import table

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")

# Fixed values of HTML: elements without content, with raw text, and that close an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object select option".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Elements that never hold main text, and the roles, classes and ids that say so.
DROPPED = frozenset("nav footer aside form button input head script style noscript template iframe svg canvas object select textarea dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|comments?|commentlist|disqus|respond|repl(?:y|ies)|footer|foot|header|masthead|"
    r"menu|nav|navbar|navigation|breadcrumbs?|sidebar|side|aside|widget\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|search|share|sharing|social|related|recommend\w*|pagination|pager|toolbar|skip|print|hidden)(?:$|[\s_-])",
    re.I,
)
_LIKELY = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text)(?:$|[\s_-])", re.I)
#: Names that a likely one beside them doesn't make up for.
_NEVER = re.compile(r"(?:^|[\s_-])(?:ads?|adbox|adsense|advert\w*|sponsor\w*|comments?|commentlist|cookies?|cookiebar)(?:$|[\s_-])", re.I)
#: Where a name in camel case is split, and names that say what an element has or lacks, not what it is.
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_ABOUT = re.compile(r"(?:^|(?<=\s))(?:no|not|has|have|with|without|show|hide)[_-][^\s]*", re.I)
_FORM_END, _HOLDS = re.compile(r"</form\s*>", re.I), re.compile(r"<(?:article|main|h1)[\s>]", re.I)
#: Elements whose own text counts as a paragraph, and those that can be the container.
PARAGRAPH = frozenset("p pre blockquote td li dd figcaption".split())
CONTAINER = frozenset("article main section div body td html blockquote center details".split())
#: Points of a container by its tag; they only tip the scale.
TAG_POINTS = {"article": 25.0, "main": 25.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0}


class Node:
    __slots__ = ("tag", "parent", "kids", "points", "chars", "linked", "commas", "names", "dropped", "doubtful")

    def __init__(self, tag: str, parent: Node | None, names: str = "", dropped: bool = False, doubtful: bool = False):
        self.tag, self.parent, self.names, self.dropped, self.doubtful = tag, parent, names, dropped, doubtful
        self.kids: list[Node | str] = []
        self.points, self.chars, self.linked, self.commas = 0.0, 0, 0, 0


class _Forms:
    """Whether a form that begins at a place holds an article, main or h1 element; a page is searched once."""

    def __init__(self, page: str):
        self.page = page
        self.ends: list[int] | None = None

    def holds(self, at: int) -> bool:
        if self.ends is None:
            self.ends = [m.start() for m in _FORM_END.finditer(self.page)]
            self.starts = [m.start() for m in _HOLDS.finditer(self.page)]
        first, end = bisect_left(self.starts, at), bisect_left(self.ends, at)
        return first < len(self.starts) and (end == len(self.ends) or self.starts[first] < self.ends[end])


def _dropped(tag: str, attrs: str, inside: bool, holds: bool = False) -> tuple[str, bool, bool]:
    """(class and id, whether the element is left out, whether only a name within an article speaks against it); a form that ``holds`` main text stays."""
    if tag in DROPPED and not holds or tag == "header" and not inside:
        return "", True, False
    if not attrs.strip():
        return "", False, False
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    names = _ABOUT.sub("", _HUMP.sub("-", f"{got.get('class', '')} {got.get('id', '')}")).strip()
    style = got.get("style", "").replace(" ", "").lower()
    off = (
        got.get("role", "").lower() in ROLES
        or "hidden" in got
        or got.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
    )
    if off or holds or tag in ("html", "body", "article", "main", "header"):
        return names, off, False
    if _NEVER.search(names):
        return names, True, False
    unlikely = bool(_UNLIKELY.search(names) and not _LIKELY.search(names))
    doubtful = unlikely and inside and tag in ("section", "div")
    return names, unlikely and not doubtful, doubtful


def build(page: str) -> Node:
    """The element tree; text of left-out elements isn't in it."""
    root = now = Node("html", None)
    at, n, inside = 0, len(page), 0  # inside: open article or main elements
    open_tags: dict[str, int] = {}
    forms = _Forms(page)

    def close(upto: Node) -> Node:
        nonlocal inside
        x = now
        while True:
            open_tags[x.tag] -= 1
            inside -= x.tag in ("article", "main")
            if x is upto:
                return x.parent
            x = x.parent

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            if not now.dropped:
                now.kids.append(page[at:])
            break
        if m.start() > at and not now.dropped:
            now.kids.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_tags.get(tag):
                x = now
                while x.tag != tag:
                    x = x.parent
                now = close(x)
            continue
        if tag in ("html", "body") and open_tags.get("body"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else (n if tag in ("script", "style") else at)
            continue
        if tag in BLOCK and open_tags.get("p") and tag != "html":  # a block ends an open paragraph, as in browsers
            x = now
            while x.tag != "p" and x.tag not in ("td", "th", "li", "div", "article", "section", "blockquote"):
                x = x.parent
            if x.tag == "p":
                now = close(x)
        if tag in CLOSES:
            x = now
            while x.parent is not None and x.tag not in CLOSES[tag] and x.tag not in ("ul", "ol", "dl", "table", "tbody", "thead", "div", "article", "section"):
                x = x.parent
            if x.tag in CLOSES[tag]:
                now = close(x)
        names, off, doubtful = _dropped(tag, m[3], inside > 0, tag == "form" and forms.holds(at))
        if tag in VOID:
            if not now.dropped:
                now.kids.append(Node(tag, now) if tag in ("br", "hr") else " ")
            continue
        if m[3].endswith("/") and tag not in BLOCK and tag not in ("a", "b", "i", "span"):
            continue
        kid = Node(tag, now, names, now.dropped or off, doubtful)
        if not kid.dropped:
            now.kids.append(kid)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        inside += tag in ("article", "main")
        now = kid
    return root


def _walk(root: Node) -> list[Node]:
    """All elements, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        out.append(x)
        stack += [k for k in reversed(x.kids) if isinstance(k, Node)]
    return out


def settle_doubts(root: Node) -> None:
    """Leave out the doubtful sections that hold half of the text of their article (the outermost article or main element) or less."""
    nodes = _walk(root)
    if not any(x.doubtful for x in nodes):
        return
    size = {id(x): sum(len(k.strip()) for k in x.kids if isinstance(k, str)) for x in nodes}
    for x in reversed(nodes):
        if x.parent is not None:
            size[id(x.parent)] += size[id(x)]
    article: dict[int, Node | None] = {}
    for x in nodes:
        above = article.get(id(x.parent)) if x.parent is not None else None
        article[id(x)] = above or (x if x.tag in ("article", "main") else None)
        if x.doubtful and 2 * size[id(x)] <= size[id(above)]:
            x.parent.kids = [k for k in x.parent.kids if k is not x]


def score(root: Node) -> list[Node]:
    """Give points to the containers; return them in page order."""
    nodes = _walk(root)
    for x in reversed(nodes):
        for k in x.kids:
            if isinstance(k, Node):
                x.chars, x.linked, x.commas = x.chars + k.chars, x.linked + (k.chars if k.tag == "a" else k.linked), x.commas + k.commas
            else:
                x.chars += len(k) - k.count(" ") // 8
                x.commas += k.count(",")
    for x in nodes:
        own = x.tag in PARAGRAPH or x.tag in CONTAINER and any(isinstance(k, str) and k.strip() for k in x.kids)
        if not own or x.chars == 0:
            continue
        gives = (1 + x.commas + min(x.chars / 100, 30.0)) * (1 - x.linked / x.chars)
        up = x if x.tag in CONTAINER else x.parent
        while up is not None and up.tag not in CONTAINER:
            up = up.parent
        if up is not None:
            up.points += gives
            above = up.parent
            while above is not None and above.tag not in CONTAINER:
                above = above.parent
            if above is not None:
                above.points += gives / 2
    out = [x for x in nodes if x.tag in CONTAINER]
    for x in out:
        if x.points:
            x.points += TAG_POINTS.get(x.tag, 0.0) + (25.0 if x.names and _LIKELY.search(x.names) else 0.0)
            x.points *= 1 - x.linked / x.chars if x.chars else 0.0
    return out


def _whole(best: Node) -> Node:
    """The outermost article around the best container, else the outermost main element, else the container."""
    around: dict[str, Node] = {}
    x: Node | None = best
    while x is not None:
        if x.tag in ("article", "main"):
            around[x.tag] = x
        x = x.parent
    return around.get("article") or around.get("main") or best


def _kept(best: Node) -> list[Node | str]:
    """What is kept whole and what beside it isn't mostly links, in page order.

    Where the page itself marks an article, what stands beside it is kept only if it
    earns that: by points, as a long paragraph, or as a heading.
    """
    points, best = best.points, _whole(best)
    if best.parent is None or best.tag in ("body", "main"):
        return [best]
    out: list[Node | str] = []
    run: list[Node | str] = []  # text and inline elements between blocks are judged together

    def judge(some: list[Node | str]) -> None:
        chars = sum(len(k.strip()) if isinstance(k, str) else k.chars for k in some)
        linked = sum(0 if isinstance(k, str) else k.chars if k.tag == "a" else k.linked for k in some)
        if linked < 0.5 * chars and (best.tag != "article" or any(not isinstance(k, str) and earns(k) for k in some)):
            out.extend(some)

    def earns(k: Node) -> bool:
        if k.tag in ("article", "h1", "h2"):
            return True
        if k.tag == "p":
            return k.chars > 80 and k.linked < 0.25 * k.chars
        return k.points >= max(10.0, 0.2 * points)

    for k in best.parent.kids:
        if isinstance(k, str) or k.tag not in BLOCK:
            run.append(k)
            continue
        judge(run)
        run = []
        if k is best:
            out.append(k)
        else:
            judge([k])
    judge(run)
    return out


def blocks(roots: list[Node | str]) -> list[str]:
    """Texts of the blocks below, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = _SPACE.sub(" ", entities.unescape("".join(run))).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = list(reversed(roots))
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif x.tag in BLOCK:
            flush()
            stack.append(None)
            stack += reversed(x.kids)
        else:
            stack += reversed(x.kids)
    flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of a page; empty if it has none."""
    if not page:
        return ""
    root = build(page)
    settle_doubts(root)
    containers = score(root)
    best = max(containers, key=lambda x: x.points)  # the first of tied ones
    if best.points <= 0:
        best = root
    return "\n\n".join(blocks(_kept(best)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op10_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))
