"""Main text of HTML pages: tree scoring.

A page is read into a tree (tags, implied ends, raw-text elements).  Every
paragraph passes points for its length and its commas to its parent, half of
them to the grandparent, a third to the next ancestor and so on; a container's
score is discounted by its link density.  The best container is kept, together with
its siblings that score enough or are prose by themselves.  An <article> or
<main> around the best container takes its place; beside it the headings
directly before it stay too, with the paragraphs between.  Inside, elements that
are no article text by their kind or by the words of their class, id or role
(menus, headers, footers, sidebars, notices, adverts, forms, comments) are
left out.

Blocks are joined by an empty line in page order; white space in a block is
one space; character references are decoded.

Defined results: null html is empty; a page without text gives an empty
string; unclosed or stray tags never fail; a page is handled on its own, with
an explicit stack, so neither depth nor length is limited.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>\x00]*)", re.S)
TAG_STOP = re.compile(r"[>\"']")
REACH = 64  # ancestors that a block's points go to; beyond, their weight is below 0.2 %
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
SPACE = re.compile(r"[ \t\n\r\f\v\xa0  -     　\x85]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp".split())
#: Never article text.
SKIP = frozenset("script style textarea title noscript template iframe noframes noembed head nav footer aside form button select "
                 "option input svg canvas object embed video audio map menu dialog label fieldset legend math".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end an open <p>.
ENDS_P = BLOCK - frozenset("caption dd dt li tbody td tfoot th thead tr html body".split()) | frozenset(("li", "dd", "dt", "table"))
#: An element of the key ends open elements of the value, up to the nearest stop.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}), "thead": ({"tr", "td", "th"}, {"table"}),
          "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"})}
#: Words of class, id or role that mark what is not the article.
NOT_TEXT = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
                     "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside footer foot masthead topbar header "
                     "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
                     "login share sharing social related recommended recommendations comment comments respond reply replies disqus discussion "
                     "pagination pager toolbar widget widgets skip hidden contentinfo complementary search form tagcloud".split())
#: Beginnings and ends of run-together words of the same kind (commentlist, topnav).
STEMS = tuple("comment sidebar cookie advert adslot adbox adunit banner newsletter breadcrumb subscri recommend sponsor navbar disqus".split())
ENDINGS = tuple("navigation topnav sidenav sidebar comments banner advert".split())
#: Of these, the words that mean nothing beside a word of ARTICLE.
SOFT = frozenset("header side search form skip notices hidden".split())
ARTICLE = frozenset("article main story post entry content".split())
WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "words", "parent", "kids", "score", "chars", "link_chars", "skip", "in_article")

    def __init__(self, tag: str, words: frozenset, parent: Node | None, skip: bool):
        self.tag, self.words, self.parent, self.skip = tag, words, parent, skip
        self.kids: list = []  # nodes and strings, in page order
        self.score = 0.0
        self.chars = self.link_chars = 0
        self.in_article = parent is not None and (parent.in_article or parent.tag in ("article", "main"))


_SEEN: dict[str, tuple[frozenset, bool]] = {}  # pages repeat their attributes


def _words(attrs: str) -> tuple[frozenset, bool]:
    """(words of class, id and role; hidden) of a tag's attributes."""
    if attrs in _SEEN:
        return _SEEN[attrs]
    words, hidden = set(), False
    for name, a, b, c in ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c)
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            words.update(WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    if len(_SEEN) >= 10_000:
        _SEEN.clear()
    _SEEN[attrs] = frozenset(words), hidden
    return _SEEN[attrs]


def _is_boilerplate(tag: str, words: frozenset, hidden: bool, parent: Node) -> bool:
    if tag in SKIP or hidden:
        return True
    if tag == "header":  # a header inside the article holds its title
        return not (parent.in_article or parent.tag in ("article", "main"))
    if tag in ("html", "body", "article", "main"):
        return False
    marks = {w for w in words if w in NOT_TEXT or w.startswith(STEMS) or w.endswith(ENDINGS)}
    if words & {"has", "no", "with", "without"}:  # layout classes such as has-sidebar
        marks = marks - {"sidebar", "nav", "menu", "header", "footer", "side", "aside"}
    return bool(marks - SOFT if words & ARTICLE else marks)


class _Tags:
    """Ends of the tags of a page: the first > outside quotes.  A quote that is
    never closed is an ordinary character, and where no > follows there is no
    tag; both are found out once."""

    def __init__(self, page: str):
        self.page, self.unclosed, self.last = page, set(), page.rfind(">")

    def end(self, pos: int) -> int:
        """The place of the >, or -1."""
        start = pos
        while pos <= self.last:
            m = TAG_STOP.search(self.page, pos)
            if m is None:
                break
            if m[0] == ">":
                return m.start()
            pos = m.end()
            if m[0] not in self.unclosed:
                shut = self.page.find(m[0], pos)
                if shut < 0:
                    self.unclosed.add(m[0])
                else:
                    pos = shut + 1
        return self.page.find(">", start) if start <= self.last else -1


def parse(page: str, by_words: bool = True) -> Node:
    """The tree of a page; text stands as strings among the children.
    ``by_words`` also marks boilerplate by class, id and role."""
    root = Node("html", frozenset(), None, False)
    at, pos, size = root, 0, len(page)
    open_tags: dict[str, int] = {}
    tags = _Tags(page)

    def close(to: Node) -> Node:
        nonlocal at
        while at is not to:
            open_tags[at.tag] -= 1
            at = at.parent
        return to

    while pos < size:
        m = TOKEN.search(page, pos)
        if m is None:
            at.kids.append(page[pos:])
            break
        if m.start() > pos:
            at.kids.append(page[pos:m.start()])
        pos = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                at.kids.append(m[0][9:].removesuffix("]]>"))
            continue
        stop = tags.end(pos)
        if stop < 0:  # no tag from here on
            at.kids.append(page[m.start():])
            break
        attrs, pos = page[pos:stop], stop + 1
        tag = m[2].lower()
        if m[1]:
            if open_tags.get(tag):
                node = at
                while node.tag != tag:
                    # an end tag of an inline element does not reach over a block
                    if tag not in BLOCK and node.tag in BLOCK:
                        break
                    node = node.parent
                if node.tag == tag:
                    at = close(node)
                    open_tags[tag] -= 1
                    at = node.parent
            elif tag == "p":
                at.kids.append(Node("br", frozenset(), at, False))
            continue
        if tag in ("html", "body") and (open_tags.get(tag) or tag == "html"):
            continue
        if tag == "body" and open_tags.get("head"):
            node = at
            while node.tag != "head":
                node = node.parent
            close(node)
            open_tags["head"] -= 1
            at = node.parent
        if tag in ENDS_P and open_tags.get("p"):
            node = at
            while node.tag != "p" and node.tag not in ("td", "th", "table", "button", "object"):
                node = node.parent
            if node.tag == "p":
                close(node)
                open_tags["p"] -= 1
                at = node.parent
        if tag in CLOSES:
            ended, stops = CLOSES[tag]
            node, found = at, None
            while node is not root and node.tag not in stops:
                if node.tag in ended:
                    found = node
                node = node.parent
            if found is not None:
                close(found)
                open_tags[found.tag] -= 1
                at = found.parent
        words, hidden = _words(attrs) if by_words and ("=" in attrs or "hidden" in attrs) else (frozenset(), False)
        node = Node(tag, words, at, at.skip or _is_boilerplate(tag, words, hidden, at))
        at.kids.append(node)
        if tag in VOID or attrs.rstrip().endswith("/") and tag not in BLOCK and tag not in RAW and tag != "a":
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, pos)
            if end is None:
                pos = size
            else:
                node.kids.append(page[pos:end.start()])
                stop = page.find(">", end.start())
                pos = size if stop < 0 else stop + 1
            continue
        open_tags[tag] = open_tags.get(tag, 0) + 1
        at = node
    return root


def _clean(text: str) -> str:
    return SPACE.sub(" ", _html.unescape(text)).strip(" ")


def blocks(top: Node) -> list[tuple[Node, str, int]]:
    """(block element, its text, characters inside links) of the text below
    ``top`` that is no boilerplate, in page order."""
    out: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    links = 0
    owner = top

    def flush() -> None:
        nonlocal links
        text = _clean("".join(parts))
        if text:
            out.append((owner, text, links))
        parts.clear()
        links = 0

    todo: list = [(top, False)]
    in_link = 0
    while todo:
        node, done = todo.pop()
        if isinstance(node, str):
            parts.append(node)
            if in_link:
                links += len(node.strip())
            continue
        if done:
            if node.tag in BLOCK:
                flush()
                owner = node.parent or top
                while owner.tag not in BLOCK and owner.parent is not None:
                    owner = owner.parent
            elif node.tag == "a":
                in_link -= 1
            continue
        if node.skip and node is not top:
            if node.tag in BLOCK or node.tag in SKIP and node.tag in BLOCK:
                flush()
            elif node.tag not in ("script", "style"):
                parts.append(" ")
            continue
        if node.tag in ("br", "hr", "wbr", "img"):
            if node.tag != "wbr":
                parts.append(" ")
            continue
        if node.tag in BLOCK:
            flush()
            owner = node
        elif node.tag == "a":
            in_link += 1
        todo.append((node, True))
        todo.extend((k, False) for k in reversed(node.kids))
    flush()
    return out


def _title(beside: list[Node], best: Node) -> set[int]:
    """The headings directly before ``best`` and the paragraphs after them."""
    out: set[int] = set()
    run: list[Node] = []
    for s in reversed(beside[:next(i for i, s in enumerate(beside) if s is best)]):
        if s.tag in HEADINGS or s.tag in ("header", "hgroup"):
            out.update(id(x) for x in [*run, s])
            run = []
        elif s.tag == "p" and s.link_chars * 4 <= s.chars:
            run.append(s)
        elif s.tag not in VOID:
            break
    return out


def extract(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    for by_words in (True, False):  # nothing left: the class words misled
        root = parse(page, by_words)
        found = blocks(root)
        if found:
            break
    else:
        return ""
    nodes: dict[int, Node] = {}
    prose: dict[int, float] = {}
    for owner, text, link in found:
        points = 0.0
        if owner.tag not in HEADINGS:
            density = min(1.0, link / len(text))
            points = (1.0 + text.count(",") + min(len(text) / 100, 30.0)) * (1 - density) if len(text) >= 25 else 0.0
        prose[id(owner)] = prose.get(id(owner), 0.0) + points
        # a block in p, li, td ... counts for its container
        at = owner.parent if owner.tag in ("p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6") and owner.parent else owner
        at.chars += len(text)
        at.link_chars += link
        depth = 0
        while at is not None and (depth < REACH or id(at) not in nodes):
            nodes[id(at)] = at
            if depth < REACH:
                at.score += points / (1, 2, 6, 12)[min(depth, 3)] / max(1, depth - 2)
            at, depth = at.parent, depth + 1
    # characters go up once every child has its own
    waiting = dict.fromkeys(nodes, 0)
    for n in nodes.values():
        if n.parent is not None:
            waiting[id(n.parent)] += 1
    ready = [n for n in nodes.values() if not waiting[id(n)]]
    while ready:
        n = ready.pop()
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.link_chars += n.link_chars
            waiting[id(n.parent)] -= 1
            if not waiting[id(n.parent)]:
                ready.append(n.parent)
    for n in nodes.values():
        if n.tag == "article" or "article" in n.words or n.words & {"articlebody"}:
            n.score += 2.0
        n.score *= 1 - n.link_chars / max(n.chars, 1)
    best = max(nodes.values(), key=lambda n: n.score)  # the first of equals
    if best.score <= 0:  # headings and links only: the article element, or everything
        best = next((n for n in nodes.values() if n.tag in ("article", "main")), root)
    # parts of one article element belong together
    at: Node | None = best
    while at is not None:
        if at.tag in ("article", "main"):
            best = at
            break
        at = at.parent
    keep = {id(best)}
    if best.parent is not None:
        need = max(3.0, best.score * 0.2)
        beside = [s for s in best.parent.kids if not isinstance(s, str) and (s is best or not s.skip)]
        title = _title(beside, best) if best.tag in ("article", "main") else {id(s) for s in beside if s.tag in HEADINGS}
        for s in beside:
            if s.score * (1 - s.link_chars / max(s.chars, 1)) >= need or prose.get(id(s), 0.0) >= 1.5 or id(s) in title:
                keep.add(id(s))
    out, inside = [], {id(root): id(root) in keep}
    for owner, text, _ in found:
        path, n = [], owner
        while id(n) not in inside and id(n) not in keep:
            path.append(n)
            n = n.parent
        kept = id(n) in keep or inside[id(n)]
        inside.update((id(x), kept) for x in path)
        if kept:
            out.append(text)
    return "\n\n".join(out)


def _extract(batches):
    for batch in batches:
        texts = [extract(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; one map over the rows."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
