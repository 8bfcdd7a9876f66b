"""Main text of raw web pages by scoring the element tree.

Paragraphs give points for length and commas to their parent, half of them to the grandparent and so
on up; a container's points are discounted by the share of its text that stands in links. The best
container and those siblings that score close to it are kept. Parts that never are main text
(menus, headers, footers, forms, adverts, comments and the like) are cut before scoring.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame

from feedlake.llm.common import map_lists

# Fixed values of the HTML language.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math select object canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_ENDS_P = _BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
_CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table".split())

# What is never main text, by tag, by role and by the words of class and id.
_CUT_TAGS = frozenset("nav aside footer form button label menu dialog head".split())
_CUT_ROLES = frozenset("navigation complementary contentinfo banner search dialog alert menu menubar".split())
_CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " gdpr header login masthead menu meta modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted"
    " promotion recommended related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget"
    " reactions discussion disclaimer".split()
)
#: These are cut only at the end of a name or before one of the words below: a ``meta-analysis`` is text.
_CUT_ENDS = frozenset("meta social share".split())
_CUT_NEXT = frozenset("info data box bar button buttons link links icon icons list block wrapper container media item items section area tools".split())
_KEEP_WORDS = frozenset("article body content entry main post story text".split())
_WORDS = re.compile(r"[a-z]+")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

#: A sibling of the best container is kept from this share of its score.
SIBLING_SHARE = 0.2
#: A list or box of which this share of the text stands in links is a menu.
LINK_SHARE = 0.5


#: Marks the end of an article among the parts that are still to be read.
_END = object()


class Node:
    """An element; ``items`` are its texts (str) and elements in order."""

    __slots__ = ("tag", "attrs", "items", "parent", "score", "text_n", "link_n")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.attrs, self.items, self.parent = tag, attrs, [], parent
        self.score, self.text_n, self.link_n = 0.0, 0, 0

    def elements(self):
        return [x for x in self.items if isinstance(x, Node)]


def parse(html: str) -> Node:
    """A tolerant tree: unknown ends are ignored, open elements end with their parent."""
    root = Node("html")
    here, at = root, 0
    open_tags: Counter[str] = Counter()  # so that an end without a beginning is not looked for in a deep tree
    while True:
        m = _TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            here.items.append(unescape(text))
        if not m:
            return root
        at = m.end()
        if m["cdata"] is not None:
            here.items.append(m["cdata"])
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if open_tags[tag]:
                here = _left(here, _closed(here, tag), open_tags)
        elif tag in ("html", "body"):
            root.attrs = root.attrs or ""
        else:
            here = _left(here, _opened(here, tag, open_tags), open_tags)
            node = Node(tag, m["attrs"], here)
            here.items.append(node)
            if tag in _RAW and not m["attrs"].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
            elif tag not in _VOID and tag not in _RAW:
                here = node
                open_tags[tag] += 1


def _left(here: Node, to: Node, open_tags: Counter[str]) -> Node:
    """``to``, an ancestor of ``here``, once all elements below it are closed."""
    while here is not to:
        open_tags[here.tag] -= 1
        here = here.parent
    return to


def _opened(here: Node, tag: str, open_tags: Counter[str]) -> Node:
    """The parent for a new element: an open paragraph or list item ends where the new one cannot stand in it."""
    if tag in _ENDS_P and open_tags["p"]:
        node = here
        while node and node.tag not in _BLOCK:
            node = node.parent
        if node is not None and node.tag == "p":
            here = node.parent
    if not any(open_tags[other] for other in _CLOSES.get(tag, ())):
        return here
    node = here
    while node and node.parent and node.tag not in _SCOPE:
        if node.tag in _CLOSES[tag]:
            here = node.parent
        node = node.parent
    return here


def _closed(here: Node, tag: str) -> Node:
    """The element that is current after ``</tag>``."""
    node = here
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        node = node.parent
    return here


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): unescape(value.strip("\"'")) for name, value in _ATTR.findall(text)}


def _is_cut(node: Node) -> bool:
    if node.tag in _CUT_TAGS or node.tag in _RAW:
        return True
    if node.tag == "header":
        return not _inside(node, "article")
    if not node.attrs.strip(" /"):
        return False
    have = _attributes(node.attrs)
    if "hidden" in have or have.get("aria-hidden") == "true" or have.get("role", "") in _CUT_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", have.get("style", "")):
        return True
    if node.tag in ("article", "main"):
        words = set(_WORDS.findall(f"{have.get('class', '')} {have.get('id', '')}".lower()))
        return bool(words & {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo"})
    for name in re.split(r"\s+", f"{have.get('class', '')} {have.get('id', '')}".lower()):
        words = _WORDS.findall(name)
        words = [w for w, after in zip(words, [*words[1:], ""]) if w not in _CUT_ENDS or not after or after in _CUT_NEXT]
        if words and not _CUT_WORDS.isdisjoint(words) and _KEEP_WORDS.isdisjoint(words[-1:]):
            return True
    return False


def _inside(node: Node, tag: str) -> bool:
    node = node.parent
    while node is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def _prune(root: Node) -> list[Node]:
    """Drop what never is main text; the elements that stay, parents first."""
    kept, work = [], [root]
    while work:
        node = work.pop()
        kept.append(node)
        node.items = [x for x in node.items if not (isinstance(x, Node) and _is_cut(x))]
        work.extend(node.elements())
    return kept


def _measure(nodes: list[Node]) -> None:
    """Characters of text and of link text of every element, children first."""
    for node in reversed(nodes):
        for x in node.items:
            if isinstance(x, Node):
                node.text_n += x.text_n
                node.link_n += x.link_n
            else:
                node.text_n += len(x.strip())
        if node.tag == "a":
            node.link_n = node.text_n


def _link_share(node: Node) -> float:
    return node.link_n / node.text_n if node.text_n else 0.0


def _own_text(node: Node) -> str:
    """The text of a paragraph, without that of blocks inside it."""
    parts, work = [], [node]
    while work:
        x = work.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x is node or x.tag not in _BLOCK:
            work.extend(reversed(x.items))
    return "".join(parts)


def _score(nodes: list[Node]) -> Node | None:
    """Points of paragraphs go up to their ancestors, halved at each step; the best container after the discount."""
    for node in nodes:
        if node.tag in ("p", "pre", "blockquote", "td") or node.tag in ("div", "section", "article", "main") and any(
            isinstance(x, str) and x.strip() for x in node.items
        ):
            text = _own_text(node).strip()
            if not text:
                continue
            points = 1 + min(len(text) / 100, 3) + text.count(",")
            up, share = (node.parent if node.tag in ("p", "pre", "blockquote", "td") else node), 1.0
            while up is not None and share > 0.05:
                up.score += points * share
                up, share = up.parent, share / 2
    best = None
    for node in nodes:
        if node.score and node.tag in _BLOCK:
            node.score *= 1 - _link_share(node)
            if node.tag in ("article", "main"):
                node.score *= 1.5
            if best is None or node.score > best.score:
                best = node
    return best


def _kept_parts(best: Node) -> list[Node]:
    """The best container with the siblings that score close to it or are running text themselves."""
    if best.parent is None:
        return [best]
    alone = best.tag in ("article", "main")  # says itself where the text ends; only what scores like it stands beside it
    kept = []
    for x in best.parent.elements():
        near = x.score >= SIBLING_SHARE * best.score
        running = x.tag == "p" and x.text_n > 80 and _link_share(x) < 0.25
        heading = x.tag in ("h1", "h2", "h3")
        if x is best or near or not alone and (running or heading):
            kept.append(x)
    return kept


def _blocks(parts: list[Node]) -> list[str]:
    """Texts of the blocks below ``parts`` in page order, white space folded; lists made of links are menus and go, but not within an article."""
    blocks, run = [], []
    article = {id(x) for x in parts if x.tag in ("article", "main") or _inside(x, "article")}
    depth = 0  # how many of the parts' articles are open

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    work: list = list(reversed(parts))
    while work:
        x = work.pop()
        if x is None:
            flush()
        elif x is _END:
            depth -= 1
        elif isinstance(x, str):
            run.append(x)
        elif x.tag in ("br", "hr"):
            run.append(" ")
        elif not depth and x.tag in ("ul", "ol", "div", "section", "table") and id(x) not in article and _link_share(x) > LINK_SHARE:
            continue
        elif x.tag in _BLOCK:
            flush()
            if x.tag == "article" or id(x) in article:
                depth += 1
                work.append(_END)
            work.append(None)
            work.extend(reversed(x.items))
        else:
            work.extend(reversed(x.items))
    flush()
    return blocks


def main_text(html: str | None) -> str:
    """The main text of a page, one line per block; empty for null, empty or text-less pages."""
    root = parse(html or "")
    nodes = _prune(root)
    _measure(nodes)
    best = _score(nodes)
    return "\n".join(_blocks(_kept_parts(best) if best is not None else [root]))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    One narrow pass, no shuffle. A null html counts as empty; null and repeated ids or urls keep their rows; other
    columns are not read; an empty table gives an empty result. Pages are handled whole, whatever their length.
    """

    def make():
        def step(rows):
            texts = [main_text(html) for html in rows["html"]]
            return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return step

    return map_lists(pages.selectExpr("cast(page_id as bigint) page_id", "url", "html"), make, "page_id long, url string, text string, n_chars long")
