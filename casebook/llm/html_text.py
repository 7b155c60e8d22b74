"""Operator 5: main text of web pages by tree scoring.

The page is read into a tree of elements. Every paragraph gives points to its
parent and half of them to its grandparent: one, one per comma, and one per
hundred characters (three at most), with a bonus or malus for telling tag
names, classes and ids. A container's points are discounted by its link
density. The container with most points is kept, and with it those of its
siblings that have a fifth of its points or read like a paragraph; sibling
articles stay together. Inside what is kept, everything that is not article
text goes: scripts, styles, forms, menus, headers and footers of the page,
sidebars, adverts, notices and reader comments. Outside articles a telling word
in a compound class name is enough for that; inside an article or main element
only elements of these kinds and class names that say so as a whole count.
Links only weigh on containers: no block of a kept container goes for them.

Text: character references are decoded, white space inside a block becomes
one space, blocks are trimmed and joined by one space in page order.

Defined cases: null or empty html has the empty text; a page without any
element is one block; a page without paragraphs is scored by its other text
blocks; unclosed and stray tags are closed or passed over as browsers do;
repeated rows repeat; an empty table gives an empty result. Nothing is cut:
texts and trees have no size limit. No recursion is used, and the time grows in
proportion to the page, however deep, unclosed or broken its markup is.
"""

from __future__ import annotations

import html as _html
import itertools
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
#: Elements whose content is never article text.
DROP = frozenset("""head script style noscript template iframe object embed svg math canvas audio video nav footer
 aside form button input select textarea fieldset label dialog menu title xmp noembed noframes""".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot
 th thead tr ul""".split())
PARAGRAPH = frozenset("p pre td blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key closes an open element of the value.
_BLOCK_CLOSES_P = BLOCK - {"br"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"},
          "tfoot": {"tbody", "thead", "tr", "td", "th"}, "option": {"option"}}
_STOP = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TO_MARK = re.compile(r"""[^>"']*""")
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")
#: Words of classes and ids.
BAD = frozenset("""ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion
 promoted sidebar side rail nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer foot copyright comment
 comments disqus replies reply respond discussion cookie cookies consent gdpr notice notices popup modal overlay subscribe newsletter signup
 login share sharing social related recommended recommendations widget widgets toolbar tags pagination pager skip hidden
 legal disclaimer""".split())
#: Class and id names that, as a whole, mark what is no article text even inside an article.
WHOLE_BAD = frozenset("""ad ads ad-box ad-container ad-slot advert adverts advertisement advertising adsense banner sponsor sponsored promo
 promoted sidebar side-bar nav navbar navigation menu breadcrumb breadcrumbs footer comment comments comment-list comments-area comment-section
 disqus replies respond cookie-banner cookie-notice cookies consent gdpr notice notices popup modal overlay newsletter signup login
 share share-buttons sharing social social-share related-posts pagination pager toolbar hidden""".split())
GOOD = frozenset("article body content entry main post story text page hentry blog column maincontent".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "names", "whole", "hidden")

    def __init__(self, tag: str, parent: "Node | None", names: frozenset[str] = frozenset(), whole: frozenset[str] = frozenset(), hidden: bool = False):
        self.tag, self.parent, self.names, self.whole, self.hidden = tag, parent, names, whole, hidden
        self.parts: list[Node | str] = []


def _attributes(raw: str) -> tuple[frozenset[str], frozenset[str], bool]:
    """The words in classes and ids, the classes and ids as they are, and
    whether the element is hidden."""
    names, whole, hidden = set(), set(), False
    for key, value in _ATTR.findall(raw):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id", "role", "itemprop"):
            for word in value.split():
                names.update(x for x in _WORDS.split(word) if x)
                names.add(_WORDS.sub("", word))
                whole.add(word)
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
    return frozenset(names), frozenset(whole), hidden


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) in page order; kind is text, start or
    end. The content of raw elements is passed over.

    Each search that finds nothing is not repeated, and quotes count for
    nothing once a tag was left open inside one: so no part is read again."""
    at, size, begun = 0, len(page), 0
    gone: set[str] = set()  # marks that don't occur any more
    quotes = True

    def find(mark: str, since: int) -> int:
        if mark in gone:
            return -1
        place = page.find(mark, since)
        if place < 0:
            gone.add(mark)
        return place

    def tag_end(since: int) -> int:
        """The place of the > that ends the tag."""
        nonlocal quotes
        place = since
        while quotes:
            place = _TO_MARK.match(page, place).end()
            if place < size and page[place] == ">":
                return place
            closed = find(page[place], place + 1) if place < size else -1
            if closed < 0:
                quotes = False
            place = closed + 1
        return find(">", since)

    while at < size:
        at = find("<", at)
        if at < 0:
            break
        follows, end = page[at + 1:at + 2], -1
        token = None
        if page.startswith("<!--", at):
            end = find("-->", at + 4)
            end = size if end < 0 else end + 3
        elif page.startswith("<![CDATA[", at) and (closed := find("]]>", at + 9)) >= 0:
            end, token = closed + 3, ("text", page[at + 9:closed].replace("&", "&amp;"), "")
        elif follows and follows in "!?":
            end = find(">", at) + 1
        elif follows == "/" and (m := _NAME.match(page, at + 2)):
            end, token = find(">", m.end()) + 1, ("end", m[0].lower(), "")
        elif m := _NAME.match(page, at + 1):
            closed = tag_end(m.end())
            end, token = closed + 1, ("start", m[0].lower(), page[m.end():closed])
        if end <= 0:  # no markup: the sign is text
            at += 1
            continue
        if at > begun:
            yield "text", page[begun:at], ""
        at = begun = end
        if token:
            yield token
            if token[0] == "start" and token[1] in RAW:
                close = re.compile(rf"</{re.escape(token[1])}\s*>", re.I).search(page, at)
                at = begun = close.end() if close else size
    if begun < size:
        yield "text", page[begun:], ""


def parse(page: str) -> Node:
    """The page's tree. Implied end tags as in browsers, for the usual cases.

    Open elements are a stack, with the places of each tag and of the blocks
    in it, so that what a tag closes is looked up and never walked to."""
    root = Node("#root", None)
    stack: list[Node] = [root]
    places: dict[str, list[int]] = {}
    blocks_at: list[int] = [0]

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            places[node.tag].pop()
            if node.tag in BLOCK:
                blocks_at.pop()

    for kind, name, attrs in tokens(page):
        if kind == "text":
            stack[-1].parts.append(name)
            continue
        open_ = places.get(name)
        if kind == "end":
            # a stray end tag closes nothing, an inline one no block
            if open_ and (name in BLOCK or open_[-1] > blocks_at[-1]):
                close_to(open_[-1])
            continue
        if name in _BLOCK_CLOSES_P:  # closes an open paragraph, with the inline elements in it
            tag = stack[blocks_at[-1]].tag
            if tag == "p" or (tag in HEADING and name in HEADING):
                close_to(blocks_at[-1])
        if name in CLOSES:
            stop = max((places[x][-1] for x in _STOP[name] if places.get(x)), default=0)
            ended = [p[i] for x in CLOSES[name] if (p := places.get(x)) and (i := bisect_right(p, stop)) < len(p)]
            if ended:
                close_to(min(ended))
        names, whole, hidden = _attributes(attrs) if attrs else (frozenset(), frozenset(), False)
        child = Node(name, stack[-1], names, whole, hidden)
        stack[-1].parts.append(child)
        if name not in VOID and name not in RAW and not attrs.endswith("/"):
            places.setdefault(name, []).append(len(stack))
            if name in BLOCK:
                blocks_at.append(len(stack))
            stack.append(child)
    return root


def _unwanted(node: Node, inside_article: bool) -> bool:
    if node.tag in DROP or node.hidden:
        return True
    if node.tag == "header":  # the page's, not the article's own
        return not inside_article
    if inside_article:
        return bool(node.whole & WHOLE_BAD) and node.tag != "main"
    return bool(node.names & BAD) and not node.names & GOOD and node.tag not in ("html", "body", "article", "main")


def _walk(node: Node) -> Iterator[tuple[Node, bool]]:
    """The wanted nodes below ``node`` in page order, and whether each is
    inside an article or main element."""
    stack = [(node, False)]
    while stack:
        x, inside = stack.pop()
        yield x, inside
        inside = inside or x.tag in ("article", "main")
        stack.extend((c, inside) for c in reversed(x.parts) if isinstance(c, Node) and not _unwanted(c, inside))


def _texts(node: Node, inside: bool) -> Iterator[tuple[str, bool]]:
    """The wanted text pieces below ``node`` (``inside``: it is or lies in an
    article), and whether each is in a link; "\0" marks the edge of a block."""
    stack: list = [(node, False, inside)]
    while stack:
        x, link, inside = stack.pop()
        if isinstance(x, str):
            yield x, link
            continue
        link = link or x.tag == "a"
        block = x.tag in BLOCK
        if block:
            yield "\0", link
            stack.append(("\0", link, inside))
        inside = inside or x.tag in ("article", "main")
        stack.extend((c, link, inside) for c in reversed(x.parts) if isinstance(c, str) or not _unwanted(c, inside))


def _clean(raw: str) -> str:
    return " ".join(_html.unescape(raw.replace("\0", "�")).split())


def blocks(node: Node, inside: bool = False) -> list[tuple[str, int]]:
    """(text, characters in links) of the blocks below ``node``."""
    out, piece, linked = [], [], 0
    for raw, link in itertools.chain(_texts(node, inside), [("\0", False)]):
        if raw == "\0":
            text = _clean("".join(piece))
            if text:
                out.append((text, linked))
            piece, linked = [], 0
        else:
            piece.append(raw)
            if link:
                linked += len(_clean(raw))
    return out


def _weight(node: Node) -> float:
    w = {"article": 25, "main": 20, "section": 3, "div": 5, "blockquote": 3, "td": 3, "pre": 3}.get(node.tag, 0)
    w += 25 * bool(node.names & GOOD) - 25 * bool(node.names & BAD)
    return w - (5 if node.tag in ("ul", "ol", "dl") else 0)


def _points(text: str) -> float:
    return 1 + text.count(",") + min(len(text) / 100, 3)


def extract(page: str) -> str:
    """The main text of a page."""
    root = parse(page)
    points: dict[Node, float] = {}
    spread: list[tuple[Node, str, int]] = []  # paragraphs: node, text, characters in links
    order: list[Node] = []
    for node, _ in _walk(root):
        order.append(node)
        own = [c for c in node.parts if isinstance(c, str)]
        loose = node.tag not in PARAGRAPH and any(c.strip() for c in own)
        if (node.tag not in PARAGRAPH and not loose) or (node.tag not in BLOCK and node.tag != "#root"):
            continue
        # text of this paragraph itself, without blocks nested in it
        text = _clean("".join(_inline(node)))
        if node.tag in PARAGRAPH:
            if text:
                spread.append((node, text, _linked(node)))
        elif len(text) >= 25:
            spread.append((Node("p", node), text, _linked(node)))
    text_of: Counter[Node] = Counter()
    link_of: Counter[Node] = Counter()
    for node, text, linked in spread:
        up, share = node.parent, 1.0
        gain = _points(text)
        text_of[up] += len(text)
        link_of[up] += linked
        for _ in range(2):
            if up is None:
                break
            if up not in points:
                points[up] = _weight(up)
            points[up] += gain * share
            share /= 2
            up = up.parent
    for node in reversed(order):  # children come before their parents
        if node.parent is not None:
            text_of[node.parent] += text_of[node]
            link_of[node.parent] += link_of[node]

    def menu(node: Node) -> bool:
        """A container that is mostly links."""
        return link_of[node] > 0.6 * text_of[node]

    if not spread:
        found = blocks(root)
        linked = sum(k for _, k in found) > 0.6 * sum(len(t) for t, _ in found)
        return "" if linked else " ".join(t for t, _ in found)
    final = {n: p * (1 - link_of[n] / max(1, text_of[n])) for n, p in points.items()}
    best = max(final, key=final.get)
    # an article or main element around the winner holds what belongs to it
    up, inside = best, False
    while up is not None:
        if up.tag in ("article", "main") and not _unwanted(up, False):
            best, inside = up, True
            break
        up = up.parent
    least = max(10.0, final.get(best, 0.0) * 0.2)
    siblings = best.parent.parts if best.parent is not None else [best]
    kept: list[Node | str] = []
    if best.tag == "article":
        kept = [s for s in siblings if s is best or (isinstance(s, Node) and s.tag == "article" and not _unwanted(s, True) and not menu(s))]
    elif best.tag == "main":
        kept = [best]
    elif best.tag in ("body", "html", "#root"):
        # what stands directly on the page is judged like a sibling
        kept = [s for s in best.parts if isinstance(s, str) or not (_unwanted(s, False) or (s.tag in BLOCK and s.tag not in PARAGRAPH and menu(s)))]
        return _joined(kept, False)
    elif not menu(best):
        for s in siblings:
            if s is best:
                kept.append(s)
            elif isinstance(s, Node) and not _unwanted(s, False):
                if final.get(s, float("-inf")) >= least:
                    kept.append(s)
                elif s.tag in PARAGRAPH:
                    found = blocks(s)
                    n, linked = sum(len(t) for t, _ in found), sum(k for _, k in found)
                    if n and linked < 0.25 * n and (n > 80 or s.tag in HEADING or any(t.rstrip()[-1:] in ".!?" for t, _ in found)):
                        kept.append(s)
    return _joined(kept, inside)


def _joined(kept: list, inside: bool) -> str:
    """The blocks of the nodes and loose texts ``kept``, in order."""
    around = Node("div", None)
    around.parts = kept
    return " ".join(t for t, _ in blocks(around, inside))


def _inline(node: Node) -> Iterator[str]:
    """Text of ``node`` outside the blocks nested in it; br is a space."""
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            yield x
        elif x is node or x.tag not in BLOCK:
            stack.extend(c for c in reversed(x.parts) if isinstance(c, str) or not _unwanted(c, True))
        else:
            yield " "


def _linked(node: Node) -> int:
    """Characters of ``node`` in links, outside the blocks nested in it."""
    total, stack = 0, [(node, False)]
    while stack:
        x, link = stack.pop()
        if isinstance(x, str):
            total += len(_clean(x)) if link else 0
        elif x is node or x.tag not in BLOCK:
            link = link or x.tag == "a"
            stack.extend((c, link) for c in x.parts if isinstance(c, str) or not _unwanted(c, True))
    return total


def extract_text(df: DataFrame, html_col: str = "html", out_col: str = "text", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns and the main text of each page."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [f"`{out_col}` string"])
    src = df.select(*keep, F.col(html_col).cast("binary").alias("__html"))

    def run(batches):
        for b in batches:
            pages = [(x.as_py() or b"").decode("utf-8", "replace") for x in b.column("__html")]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array([extract(p) for p in pages], pa.string())],
                                             names=[*keep, out_col])

    return src.mapInArrow(run, schema)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
