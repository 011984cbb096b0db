"""The main text of web pages, by tree scoring: paragraphs pass points for their length
and commas to their ancestors, discounted by link density and by names that tell of things
beside the article; the best container and the siblings that belong to it are kept. An
element beside the article is left out only if it holds no article, main element or first
heading and less than half of the page's paragraph points. Reader comments are left out
whatever their length, and so is what is hidden, and articles beside or within the one kept."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video map".split())
ASIDE = frozenset("nav footer aside form button select textarea fieldset dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
SIDE_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner sidebar side comment comments disqus replies cookie cookies consent notice notices alert popup modal menu nav navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related recommended newsletter subscribe signup widget pagination pager".split())
#: Beginnings of the words that name reader comments, and words of a name that tells of a state
#: of the page instead (no-comments).
TALK, STATES = ("comment", "disqus", "respond", "repl", "discussion", "reaction"), frozenset("no has with without enable enabled disable disabled open closed on off".split())
#: Names of places for advertising that are one word.
SLOT = re.compile(r"ad(slot|unit|box|space|zone|container|wrapper|banner|block)s?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Blocks of running text: within an article a name of several words, such as share-price, does
#: not make them something beside it.
RUNNING_TEXT = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 figcaption td li dd".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
WHOLE = frozenset("html body main article".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template head html".split())

#: Characters of a paragraph that passes points; points for each so many more, at most three times.
LEAST_CHARS, CHARS_A_POINT = 25, 100
#: Extra points of elements that name the article.
NAMED_POINTS = {"article": 25.0, "main": 15.0}
#: A sibling stays from this share of the best score on.
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0
#: Factor of the points of what stands beside the article by its tag, role or name.
SIDE_FACTOR = 0.25


class Node:
    __slots__ = ("tag", "parent", "children", "unseen", "side", "talk", "factor", "points", "chars", "link_chars")

    def __init__(self, tag: str, parent: Node | None, unseen: bool = False, side: bool = False, talk: bool = False):
        self.tag, self.parent, self.unseen, self.side, self.talk, self.factor = tag, parent, unseen, side, talk, 1.0
        self.children: list[Node | str] = []
        self.points, self.chars, self.link_chars = 0.0, 0, 0


def is_side(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in ASIDE:
        return True
    if tag == "header" and not in_article:
        return True
    if tag in WHOLE:
        return False
    for name, value in attrs:
        if name == "role" and (value or "").lower() in SIDE_ROLES:
            return True
        if name in ("class", "id") and value:
            text = in_article and tag in RUNNING_TEXT
            if any(w in SIDE_WORDS or SLOT.fullmatch(w) for w in (value.lower().split() if text else re.split(r"[^a-z]+", value.lower()))):
                return True
    return False


def is_talk(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether the names of an element tell of reader comments."""
    if tag in ("html", "body", "main") or tag in INLINE:
        return False
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.lower().split():
                words = re.split(r"[^a-z]+", token)
                if any(w.startswith(TALK) for w in words) and not STATES & set(words):
                    return True
    return False


def is_hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether no reader sees an element; a whole page is hidden only until it has loaded."""
    return tag not in ("html", "body") and any(n == "hidden" or (n == "style" and HIDDEN.search((v or "").lower())) for n, v in attrs)


class TreeBuilder(HTMLParser):
    """A tree of the page; what no reader sees is not built."""

    def __init__(self, keep_side: bool):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("root", None)
        self.open: Counter[str] = Counter()
        self.keep_side = keep_side
        self.links: list[str] = []
        self.title: list[str] = []

    def _close(self, tag: str) -> None:
        while self.now.tag != tag:
            self.open[self.now.tag] -= 1
            self.now = self.now.parent
        self.open[tag] -= 1
        self.now = self.now.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["head"] and (tag == "body" or (tag not in IN_HEAD and not self.open["noscript"] and not self.open["template"])):
            self._close("head")
        if tag in ENDS_PARAGRAPH and self.open["p"]:
            self._close("p")
        for other in SELF_CLOSING.get(tag, ()):
            if self.now.tag == other or (tag == "p" and self.open["p"]):
                self._close(other)
        if tag == "a":
            self.links.extend(value or "" for name, value in attrs if name == "href")
        side = not self.keep_side and is_side(tag, attrs, self.open["article"] + self.open["main"] > 0)
        unseen = tag in UNSEEN or self.now.unseen or is_hidden(tag, attrs)
        node = Node(tag, self.now, unseen, side, not self.keep_side and is_talk(tag, attrs))
        if not node.unseen or tag == "br":
            self.now.children.append(node)
        if tag not in VOID:
            self.open[tag] += 1
            self.now = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.open[tag] > 0:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.now.tag == "head" and data.strip():
            self._close("head")
        if self.now.tag == "title":
            self.title.append(data)
        if not self.now.unseen:
            self.now.children.append(data)


def without_open_comment(html: str) -> str:
    """A comment that never ends runs to the end of the page; its sign within a script, style or
    the like is none."""
    start = html.rfind("<!--")
    if start < 0 or html.find("-->", start) >= 0:
        return html
    before = html[:start].lower()
    for tag in ("script", "style", "textarea", "title", "xmp"):
        if before.rfind(f"<{tag}") > before.rfind(f"</{tag}"):
            return html
    return html[:start]


def parse(html: str, keep_side: bool = False) -> Node:
    builder = TreeBuilder(keep_side)
    builder.feed(without_open_comment(html))
    builder.close()
    return builder.root


def blocks_of(nodes: list[Node]) -> list[str]:
    """Text of each block under nodes, in page order, white space as one space."""
    blocks: list[str] = []
    text: list[str] = []

    def flush() -> None:
        words = " ".join("".join(text).split())
        if words:
            blocks.append(words)
        text.clear()

    stack: list[Node | str | None] = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            text.append(x)
        elif x.tag == "br":
            text.append(" ")
        elif x.tag in INLINE:
            stack.extend(reversed(x.children))
        else:
            flush()
            stack.append(None)
            stack.extend(reversed(x.children))
    flush()
    return blocks


def in_order(root: Node) -> list[Node]:
    nodes, stack = [], [root]
    while stack:
        x = stack.pop()
        nodes.append(x)
        stack.extend(c for c in reversed(x.children) if isinstance(c, Node))
    return nodes


def paragraph_points(text: str) -> int:
    if len(text) < LEAST_CHARS:
        return 0
    return 1 + text.count(",") + min(len(text) // CHARS_A_POINT, 3)


def drop_side(root: Node) -> None:
    """Take out what stands beside the article, and give the rest of it SIDE_FACTOR. Link
    text has no weight here; in a page without paragraphs characters count."""
    nodes = in_order(root)
    if not any(x.side or x.talk for x in nodes):
        return
    linked: set[Node] = set()
    weight: dict[Node, list[float]] = {}
    for x in nodes:
        if x.tag == "a" or x.parent in linked:
            linked.add(x)
        own, stack = [], list(reversed(x.children))
        if x not in linked and x.tag not in INLINE:
            while stack:
                c = stack.pop()
                if isinstance(c, str):
                    own.append(c)
                elif c.tag in INLINE and c.tag != "a":
                    stack.extend(reversed(c.children))
        text = "".join(own).strip()
        weight[x] = [paragraph_points(text), len(text), x.tag in NAMED_POINTS and not x.talk, x.tag == "h1"]
    for x in reversed(nodes):
        if x.parent is not None:
            weight[x.parent] = [a + b for a, b in zip(weight[x.parent], weight[x], strict=True)]
    unit = 0 if weight[root][0] else 1
    whole = weight[root][unit]
    # an article of half of the points is no comment, nor is what it stands in
    first = max((x for x in nodes if x.tag in NAMED_POINTS and not x.talk), key=lambda x: weight[x][unit], default=None)
    around: set[Node] = set()
    while first is not None and 2 * weight[first][unit] >= whole and first not in around:
        around.add(first)
        first = first.parent or first
    gone: set[Node] = set()
    past_named: set[Node] = set()  # where an article of its own has the factor too
    for x in nodes:
        up = x.parent
        if up in gone:
            gone.add(x)
            continue
        if x.talk and x not in around and not weight[x][3] and weight[x][unit] < whole:
            gone.add(x)
            continue
        if up in past_named:
            past_named.add(x)
        if up is not None and up.factor < 1 and (x.tag not in NAMED_POINTS or up in past_named):
            x.factor = SIDE_FACTOR
        if x.side:
            mine, named, headings = weight[x][unit], weight[x][2], weight[x][3]
            small = not mine or 2 * mine < whole
            if small and not named and not headings:
                gone.add(x)
                continue
            x.factor = SIDE_FACTOR
            if small and not headings:
                past_named.add(x)
    for x in nodes:
        if x not in gone:
            x.children = [c for c in x.children if isinstance(c, str) or c not in gone]


def score_tree(root: Node) -> list[Node]:
    """Nodes in page order, with chars, link_chars and points set."""
    nodes = in_order(root)
    for x in reversed(nodes):
        own = [c for c in x.children if isinstance(c, str)]
        kids = [c for c in x.children if isinstance(c, Node)]
        x.chars = sum(len(c.strip()) for c in own) + sum(c.chars for c in kids)
        x.link_chars = x.chars if x.tag == "a" else sum(c.link_chars for c in kids)
    for x in nodes:
        if x.tag in INLINE or x.tag in ("html", "body", "root"):
            continue
        # a paragraph is a block of text of its own; inline text below it counts
        own, stack = [], list(reversed(x.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                own.append(c)
            elif c.tag in INLINE:
                stack.extend(reversed(c.children))
        points = paragraph_points("".join(own).strip())
        if not points:
            continue
        up, share = (x.parent if x.tag in ("p", "pre", "td", "blockquote", "li") else x), 1.0
        for _ in range(3):
            if up is None:
                break
            up.points += points * share
            up, share = up.parent, share / 2
    for x in nodes:
        x.points = (x.points + (NAMED_POINTS.get(x.tag, 0.0) if x.chars else 0.0)) * (1 - x.link_chars / x.chars if x.chars else 0.0) * x.factor
    return nodes


def main_text(html: str | None) -> str:
    """Blocks of the article, joined by one space; empty if there is none. A page without a
    block long enough to score has its text beside menus and the like, if that is no list
    of links."""
    if not html:
        return ""
    root = parse(html)
    drop_side(root)
    nodes = score_tree(root)
    best = max(nodes, key=lambda x: x.points)
    if best.points <= 0:  # no paragraph: what is left, unless it is links for the most part
        return " ".join(blocks_of([root])) if 2 * root.link_chars < root.chars else ""
    up, path = best, {best}
    while up is not None:  # an article is kept with its heading
        path.add(up)
        if up.tag in NAMED_POINTS:
            best = up
            break
        up = up.parent
    # an article within it or beside it, alone or in a block of such, is another one
    others = {x for x in nodes if x.tag == "article" and x not in path}
    if best.tag in NAMED_POINTS:
        for x in others:
            if x.parent is not None:
                x.parent.children = [c for c in x.parent.children if c is not x]
    if best.parent is None:
        return " ".join(blocks_of([best]))
    kept = []
    for x in best.parent.children:
        if not isinstance(x, Node):
            continue
        if x is best or (not x.side and (x.points >= max(SIBLING_LEAST, SIBLING_SHARE * best.points) or (x.tag == "p" and x.chars > 80 and 4 * x.link_chars < x.chars) or (x.tag in ("h1", "h2", "h3") and x.chars and best.tag not in NAMED_POINTS))):
            kept.append(x)
        elif best.tag not in NAMED_POINTS:  # a heading in a block of its own
            kept.extend(h for h in in_order(x) if h.tag == "h1" and h.chars)
    return " ".join(blocks_of(kept))


def page_parts(html: str) -> tuple[str | None, list[str], str]:
    """Title (null if there is none), targets of the links in page order, and all text that a
    reader of the page could see, a line for each block."""
    builder = TreeBuilder(keep_side=True)
    builder.feed(without_open_comment(html))
    builder.close()
    title = " ".join("".join(builder.title).split())
    return title or None, builder.links, "\n".join(blocks_of([builder.root]))


def visible_text(html: str) -> str:
    return page_parts(html)[2]


def main_text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text)

    return extract(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page.

    pages: page_id long, url string, html string; other columns are left out. One row per
    input row: page_id, url, text, n_chars (code points). A null or empty html, and a
    page of nothing but menus and links, have an empty text; repeated rows stay.
    """
    out = pages.select(F.col("page_id").cast("long"), "url", main_text_column(F.coalesce("html", F.lit(""))).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
