"""HTML extraction: paragraphs pass points up a tree; the best container and siblings are kept.

A page is parsed into a tree (unclosed and stray tags as browsers take them,
the content of scripts and styles skipped). Elements that never hold the
article (navigation, page headers, footers, asides, forms, ...) are cut. Of
those whose class, id or role names boilerplate (adverts, menus, notices,
comments), one with a token of such words only is cut unless it holds most of
the page's text, one with a token of such and other words only if it is
link-heavy or short; what stays loses points. Every block of text then earns
points for its length and its commas and passes them to all its ancestors,
halved at every step, and every candidate's points are discounted by its link
density. The best one is the container: inside an article or main element all
of that element's uncut blocks are kept, and those of the articles beside it that
are no lists of links; else the container and its siblings: those that
score well or are long and link-poor, paragraphs and headings that are no links, and
loose text. The text is the kept nodes' block texts in page order: character references decoded, white space inside a block one space,
blocks joined by one newline.

The article element of a page, if there is one, is the natural container and
wins by a bonus; pages without any paragraph fall back to the body.

Spark reads and deals out the pages; a page is one call of :func:`main_text`,
its memory a small multiple of the page.

Defined results: a null, empty or text-free page gives an empty text; html
that is no markup is one block; repeated rows are extracted alike; a null
page_id or url is passed through; an empty table gives an empty result. Other
columns are passed through; ``text`` and ``n_chars`` of the input are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MIN_PARAGRAPH = 25
ARTICLE_BONUS = 50.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text for a program, not markup.
RAW = frozenset(["script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea",
                 "title", "canvas", "xmp"])
#: Never part of the article.
CUT = frozenset("nav aside footer button select dialog menu head fieldset figure-caption".split()) | RAW
#: Cut unless they wrap the page: they hold its heading or article, or this share of its text.
WRAPPERS = frozenset(["form"])
WRAPPED_SHARE = 0.8
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt
                   ruby s samp small span strike strong sub sup time tt u var wbr img""".split())
#: Elements a new block start tag closes if they are open.
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form
                     h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li dd dt""".split())
SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "option": {"select"}}
#: Parts of class, id or role tokens that name boilerplate.
BOILERPLATE = re.compile(
    r"(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|"
    r"sidebar|side|aside|footer|foot|header|masthead|cookie\w*|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"comments?|commentlist|disqus|respond|reply|replies|discussion|share|sharing|social|related|recommend\w*|"
    r"newsletter|subscribe|subscription|signup|login|search|widget|pagination|pager|toolbar|tags?|skip|hidden|"
    r"complementary|contentinfo|legal|copyright|disclaimer|paywall|outbrain|taboola)", re.I)
#: Points an element named so loses if it stays, and when it is cut.
NAME_PENALTY = 25.0
SHORT, SHORT_SHARE, MOST_SHARE, HEAVY_LINKS = 200, 0.2, 0.5, 0.5
#: Characters of a block's own text from which it may be a container itself.
LONG_BLOCK = 400
_PARTS = re.compile(r"[_-]+")
PROMISING = re.compile(r"article|body|content|entry|main|page|post|story|text|blog", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
#: One attribute with its value, so that what stands in values is never taken for a name.
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*(?:"|$)|'[^']*(?:'|$)|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "parent", "parts", "points", "hidden", "inside")

    def __init__(self, tag: str, parent: Node | None, names: str = "", hidden: bool = False, inside: bool = False):
        self.tag, self.parent, self.names, self.hidden = tag, parent, names, hidden
        self.inside = inside  # of an article or main element
        self.parts: list[Node | str] = []
        self.points: float | None = None


def _attributes(text: str) -> tuple[str, bool]:
    names, hidden = [], False
    for m in ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name in ("class", "id", "role"):
            names.append(value)
    return " ".join(names), hidden


def parse(html: str) -> Node:
    """The page as a tree of nodes and texts (character references still encoded)."""
    root = Node("html", None)
    at, node = 0, root
    opened: Counter[str] = Counter()  # open elements by tag: a stray end tag looks no further

    def leave(node: Node, to: Node) -> Node:
        while node is not to:
            opened[node.tag] -= 1
            node = node.parent
        return to

    while True:
        m = _TOKEN.search(html, at)
        if m is None:
            if at < len(html):
                node.parts.append(html[at:])
            return root
        if m.start() > at:
            node.parts.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                node = leave(node, _close(node, tag))
            continue
        if tag in ("html", "body"):
            continue
        node = leave(node, _open(node, tag, opened))
        names, hidden = _attributes(m[3]) if m[3] else ("", False)
        child = Node(tag, node, names, hidden, bool(opened["article"] or opened["main"]))
        node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID and not m[3].endswith("/"):
            node = child
            opened[tag] += 1


def _open(node: Node, tag: str, opened: Counter[str]) -> Node:
    """The node a start tag becomes a child of: open elements it implicitly ends are left."""
    if tag in CLOSES_P and opened["p"]:
        here = node
        while here is not None and here.tag != "p" and here.tag in INLINE:
            here = here.parent
        if here is not None and here.tag == "p":
            node = here.parent
    if tag in SAME and any(opened[t] for t in SAME[tag]):
        here = node
        while here is not None and here.tag not in SCOPE[tag]:
            if here.tag in SAME[tag]:
                node = here.parent
            here = here.parent
    return node


def _close(node: Node, tag: str) -> Node:
    """The parent of the innermost open ``tag``."""
    while node.tag != tag:
        node = node.parent
    return node.parent


def _is_cut(node: Node) -> bool:
    if node.tag in CUT or node.hidden:
        return True
    if node.tag == "header":  # a page's header goes, an article's own stays
        return not node.inside
    return False


def _named(node: Node) -> int:
    """2 if a token names only boilerplate ("cookie-notice"), 1 if one also does ("has-sidebar"), else 0."""
    if not node.names or node.tag in ("article", "main"):
        return 0
    most = 0
    for token in node.names.split():
        hits = [BOILERPLATE.fullmatch(x) is not None for x in _PARTS.split(token) if x]
        most = max(most, 2 * (hits != [] and all(hits)), any(hits))
    return most


def _is_cut_by_name(node: Node, size: dict[int, tuple[int, int, int]], page: int) -> bool:
    named = _named(node)
    chars = size[id(node)][0]
    if node.tag in WRAPPERS:
        return chars <= WRAPPED_SHARE * page and not any(n.tag in ("article", "main", "h1") for n in walk(node))
    if named == 2:
        return chars <= MOST_SHARE * page
    return named == 1 and (density(node, size) > HEAVY_LINKS or (chars < SHORT and chars <= SHORT_SHARE * page))


def _ancestors(node: Node):
    while node.parent is not None:
        node = node.parent
        yield node


def prune(root: Node, is_cut=_is_cut) -> None:
    """Remove what can't be article text, and everything below."""
    open_ = [root]
    while open_:
        node = open_.pop()
        node.parts = [p for p in node.parts if isinstance(p, str) or not is_cut(p)]
        open_.extend(p for p in node.parts if not isinstance(p, str))


def clean(text: str) -> str:
    return _SPACE.sub(" ", unescape(text)).strip()


def walk(root: Node):
    """All nodes below ``root`` (and itself), in page order, without recursion."""
    open_ = [root]
    while open_:
        node = open_.pop()
        yield node
        open_.extend(p for p in reversed(node.parts) if not isinstance(p, str))


def lengths(root: Node) -> dict[int, tuple[int, int, int]]:
    """(characters, characters in links, commas) of every node, children first."""
    sums: dict[int, list[int]] = {}
    for node in reversed(list(walk(root))):
        own = sums.setdefault(id(node), [0, 0, 0])
        for p in node.parts:
            if isinstance(p, str):
                text = clean(p) if "&" in p else _SPACE.sub(" ", p).strip()
                own[0] += len(text)
                own[2] += text.count(",") + text.count("، ") + text.count("，")
            else:
                child = sums[id(p)]
                for i in range(3):
                    own[i] += child[i]
        if node.tag == "a":
            own[1] = own[0]
    return {k: tuple(v) for k, v in sums.items()}


def _start(node: Node) -> float:
    """A candidate's own points, from its tag and names."""
    points = {"div": 5.0, "article": 10.0, "main": 10.0, "section": 3.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
              "form": -3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "h1": -5.0, "h2": -5.0, "th": -5.0}.get(node.tag, 0.0)
    if node.names and PROMISING.search(node.names):
        points += 25.0
    if _named(node):
        points -= NAME_PENALTY
    return points


def best_container(root: Node, size: dict[int, tuple[int, int, int]]) -> Node | None:
    """The node with the most points after the discount, the first one on a tie."""
    nodes = list(walk(root))
    own: dict[int, list[int]] = {}  # characters, commas and line breaks of a block's own text
    passed: dict[int, float] = {}
    for node in reversed(nodes):  # children first
        mine = own.setdefault(id(node), [0, 0, 0])
        for part in node.parts:
            if isinstance(part, str):
                mine[0] += len(_SPACE.sub(" ", part).strip())
                mine[1] += part.count(",") + part.count("، ") + part.count("，")
            elif part.tag == "br":
                mine[2] += 1
            elif part.tag in INLINE:
                for i, x in enumerate(own[id(part)]):
                    mine[i] += x
        points = 0.0
        if node.tag not in INLINE and mine[0] >= MIN_PARAGRAPH:
            points = 1.0 + mine[1] + min(mine[0] // 100, 3)
        got = passed.get(id(node), 0.0)
        if points and node.tag != "p" and (mine[2] or mine[0] >= LONG_BLOCK):
            got += points
        if got:
            node.points = _start(node) + got
        up = points + passed.get(id(node), 0.0) / 2
        if up and node.parent is not None:
            passed[id(node.parent)] = passed.get(id(node.parent), 0.0) + up
    best, top = None, 0.0
    for node in nodes:
        if node.points is None:
            continue
        score = node.points * (1 - density(node, size))
        if node.tag in ("article", "main"):
            score += ARTICLE_BONUS
        if best is None or score > top:
            best, top = node, score
    return best


def density(node: Node, size: dict[int, tuple[int, int, int]]) -> float:
    chars, links, _ = size[id(node)]
    return links / chars if chars else 0.0


def kept_parts(best: Node, size: dict[int, tuple[int, int, int]]) -> list[Node | str]:
    """The container and what stands beside it that reads like article text, in page order."""
    scope = next((n for n in (best, *_ancestors(best)) if n.tag in ("article", "main")), None)
    if scope is not None:
        # The innermost one: a main element may hold several articles.
        if scope.tag != "article" or scope.parent is None:
            return [scope]
        return [p for p in scope.parent.parts if p is scope or (
            not isinstance(p, str) and p.tag == "article" and not _named(p) and density(p, size) <= HEAVY_LINKS)]
    if best.parent is None:
        return [best]
    own = (best.points or 0.0) * (1 - density(best, size))
    least = max(10.0, own * 0.2)

    def reads(part: Node) -> bool:
        chars, _, _ = size[id(part)]
        link = density(part, size)
        if part is best:
            return True
        if _named(part) or not chars:
            return False
        if part.tag in INLINE or part.tag == "p" or part.tag in HEADINGS:
            return link <= HEAVY_LINKS
        return (part.points is not None and part.points * (1 - link) >= least) or (chars > 80 and link < 0.25)

    def loose(part: Node | str) -> bool:
        return isinstance(part, str) or part.tag in INLINE

    def chars_of(part: Node | str) -> int:
        return len(clean(part)) if isinstance(part, str) else size[id(part)][0]

    # Loose text counts between blocks that are kept, or if a stretch of it is as long as a paragraph.
    stretches = [(is_loose, list(run)) for is_loose, run in groupby(best.parent.parts, loose)]
    whole = [i for i, (is_loose, run) in enumerate(stretches) if not is_loose and any(map(reads, run))]
    kept: list[Node | str] = []
    for i, (is_loose, run) in enumerate(stretches):
        if not is_loose:
            kept += [p for p in run if reads(p)]
        elif whole[0] < i < whole[-1] or sum(map(chars_of, run)) >= MIN_PARAGRAPH:
            kept += [p for p in run if isinstance(p, str) or p.tag == "br" or reads(p)]
    return kept


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = clean("".join(run))
        run.clear()
        if text:
            out.append(text)

    # (node, index of the next part): an explicit stack, pages nest arbitrarily deep
    stack = [(node, 0)]
    while stack:
        here, i = stack.pop()
        if i == len(here.parts):
            if here.tag not in INLINE:
                flush()
            continue
        stack.append((here, i + 1))
        part = here.parts[i]
        if isinstance(part, str):
            run.append(part)
        elif part.tag == "br":
            run.append(" ")
        else:
            if part.tag not in INLINE:
                flush()
            stack.append((part, 0))
    flush()
    return out


def main_text(html: str | None) -> str:
    """The article of a page."""
    if not html:
        return ""
    root = parse(html)
    prune(root)
    size = lengths(root)
    page = size[id(root)][0]
    prune(root, lambda node: _is_cut_by_name(node, size, page))
    size = lengths(root)
    best = best_container(root, size)
    if best is None:
        best = next((n for n in walk(root) if n.tag in ("article", "main")), root)
        return "\n".join(blocks(best))
    kept = Node("div", None)
    kept.parts = kept_parts(best, size)
    return "\n".join(blocks(kept))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``, and ``n_chars``, its code points, for ``html``."""
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    out = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()),
                        T.StructField("n_chars", T.LongType())])
    names = out.names

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=names)

    return pages.select(*keep, "html").mapInArrow(run, out)


def query(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    return extract(pages.select("page_id", "url", "html"))
