"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text they hold themselves, less their
links; from the best one the page climbs to the container of the whole article,
votes for the generalised tag-class path of that, and Spark adds up the votes
per host. Pages are then read again with their host's
winning paths, so a page whose own best container is a stray one still yields
the article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import rekeyed, row_key, staged
from tablewright.llm.urls import host_of
from tablewright.session import fits_broadcast

# What the markup language says about its elements.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "noembed", "noframes", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# A start tag that ends open elements of these names, up to a border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = BLOCK - {"br", "caption", "html", "body", "head", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}
FORMATTING = {"a", "b", "big", "code", "em", "font", "i", "s", "small", "span", "strike", "strong", "sub", "sup", "tt", "u"}

# Elements and names that are never part of an article.
DROPPED = {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "input", "label", "fieldset", "menu", "dialog",
    "canvas", "object", "audio", "video", "map", "datalist", "output", "search",
}
KEPT_IN_ARTICLE = {"header"}  # a heading block of the article itself holds its title
# Parts of names that stand for what surrounds an article.
SURROUNDINGS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "promo", "promotion", "sponsor",
    "sponsored", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "sidebar", "side", "rail",
    "widget", "footer", "foot", "masthead", "topbar", "toolbar", "comment", "comments", "respond", "reply", "replies",
    "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "share", "sharing", "social", "related", "recommended", "recirculation",
    "pagination", "pager", "copyright", "legal", "skip", "search", "login", "meta", "tags", "hidden",
}
# Parts that say nothing of their own beside those.
LAYOUT = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "col", "column", "container", "content",
    "count", "fixed", "form", "full", "global", "group", "has", "header", "icon", "icons", "inline", "inner", "is", "item",
    "items", "large", "layout", "left", "link", "links", "list", "main", "mobile", "module", "no", "outer", "page", "panel",
    "post", "posts", "primary", "reader", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "thread",
    "top", "unit", "user", "with", "wrap", "wrapper", "zone", "articles", "stories",
}
# End of fixed values.
# Elements of running text: their id is mostly made from what they say.
TEXTUAL = {
    "article", "blockquote", "caption", "dd", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "li",
    "main", "ol", "p", "pre", "section", "table", "tbody", "td", "th", "thead", "tr", "ul",
}
LISTS = {"ul", "ol", "dl", "table"}
CONTROLS = {"input", "button", "select", "textarea"}
# Names of these never surround an article: a page with more of such text than of its own is common.
NEVER = re.compile(
    r"(?:^|[-_ ])(?:comment|comments|respond|reply|replies|disqus|cookie|cookies|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|related|recommended|recirculation|footer|foot|copyright|legal|hidden)(?:$|[-_ ])"
)
SITE_HEADER = re.compile(r"(?:^| )(?:site-|page-|main-|top-)?header(?:$| )")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

# A quote opens a value only behind an equals sign; elsewhere it is a character.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|$)", re.DOTALL
)
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/>][^\s=/>]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")

NESTED = {"svg", "template"}
RAW_TAGS = {tag: re.compile(rf"<(/?){tag}(?![^\s/>])([^>]*)(?:>|$)", re.IGNORECASE) for tag in RAW}


class Node:
    __slots__ = (
        "tag", "name", "named", "doubtful", "dropped", "parent", "path", "own", "linked", "held", "held_links", "score", "at"
    )

    def __init__(self, tag: str, name: str, dropped: bool, parent: Node | None, path: str, at: int):
        self.tag, self.name, self.dropped, self.parent, self.path, self.at = tag, name, dropped, parent, path, at
        self.named = False  # dropped for its name or as a form, which ``spared`` may take back
        self.doubtful = False  # its name may stand for surroundings; ``weighed`` decides by what it holds
        self.own = self.linked = self.held = self.held_links = 0
        self.score = 0.0


def attributes(text: str) -> tuple[str, str, bool]:
    """Classes, the id, and whether the element is hidden or plays a dropped role."""
    if not text or text.isspace():
        return "", "", False
    classes, id_, dropped = [], "", False
    for key, value in ATTRIBUTE.findall(text):
        key = key.lower()
        if key not in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            continue
        value = (value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] else value).lower()
        if key == "class":
            classes.append(value)
        elif key == "id":
            id_ = value
        elif key == "role":
            dropped |= value in ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            dropped = True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            dropped = True
    return " ".join(classes), id_, dropped


def named_for(tag: str, classes: str, id_: str) -> tuple[bool, bool]:
    """Whether a name says that the element surrounds an article, and whether it
    may say so.

    It does if all parts of one of its names stand for surroundings or for
    nothing; one such part beside others, as in ``side-by-side`` or
    ``related-work``, may. The id of an element of running text is no name, and
    a list is never judged by its name alone.
    """
    sure = maybe = False
    for name in (classes if tag in TEXTUAL else f"{classes} {id_}").split():
        parts = [p for p in re.split(r"[-_]+", name) if p and not p.isdigit()]
        some = any(p in SURROUNDINGS for p in parts)
        maybe |= some
        sure |= some and all(p in SURROUNDINGS or p in LAYOUT for p in parts)
    return sure and tag not in LISTS, maybe


def weighed(nodes: list[Node], events: list[tuple[Node, str | None]], controls: set[int]) -> None:
    """Drops elements whose name may stand for surroundings if they hold what
    surroundings hold: links for half of their text, or fields to fill in and
    little text."""
    if not any(x.doubtful for x in nodes):
        return
    sizes: dict[int, int] = {}
    links: dict[int, int] = {}
    in_link = set()
    for node in nodes:
        if node.tag == "a" or (node.parent is not None and id(node.parent) in in_link):
            in_link.add(id(node))
    for node, piece in events:
        if piece is not None and (size := len(piece.strip())):
            sizes[id(node)] = sizes.get(id(node), 0) + size
            if id(node) in in_link:
                links[id(node)] = links.get(id(node), 0) + size
    fields = set(controls)
    for node in reversed(nodes[1:]):  # children come after their parents
        up = id(node.parent)
        sizes[up] = sizes.get(up, 0) + sizes.get(id(node), 0)
        links[up] = links.get(up, 0) + links.get(id(node), 0)
        if id(node) in fields:
            fields.add(up)
    for node in nodes:
        size = sizes.get(id(node), 0)
        if node.doubtful and size and (2 * links.get(id(node), 0) >= size or (id(node) in fields and size < 400)):
            node.named = True


def step(tag: str, name: str) -> str:
    """One element of a path; numbers in classes are generalised away."""
    classes = sorted({re.sub(r"\d+", "0", c) for c in name.split()})
    return tag + "".join(f".{c}" for c in classes)


def raw_end(html: str, tag: str, at: int) -> int:
    """Where the raw element that begins before ``at`` ends. Drawings and
    templates may hold others of their kind; the rest, and those whose tags do
    not pair, end at the first end tag. A drawing without one is only its tag."""
    depth, first = 1, None
    for found in RAW_TAGS[tag].finditer(html, at):
        if found[1]:
            depth, first = depth - 1, first or found.end()
        elif tag in NESTED and not (tag == "svg" and found[2].rstrip().endswith("/")):
            depth += 1
        if not depth:
            return found.end()
    return first or (at if tag == "svg" else len(html))


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """The elements, and the page as events: text of a node, or None for a
    block border. Unclosed and stray tags are mended; a page that breaks off
    keeps what came before."""
    root = Node("", "", False, None, "", 0)
    nodes, events, stack = [root], [], [root]
    controls: set[int] = set()
    at, n = 0, len(html)

    def text(piece: str) -> None:
        if piece:
            events.append((stack[-1], unescape(piece)))

    def pop_to(depth: int) -> None:
        for node in stack[depth:]:
            if node.tag in BLOCK:
                events.append((stack[depth - 1], None))
                break
        del stack[depth:]

    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            text(html[at:])
            break
        found = TOKEN.match(html, mark)
        if found is None or (found[2] and found.end() == n and not html.endswith(">")):
            found = LOOSE_TAG.match(html, mark) or found  # a quote left open does not swallow the page
        if found is None:
            text(html[at : mark + 1])
            at = mark + 1
            continue
        text(html[at:mark])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "br":
                events.append((stack[-1], None))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    break
                if tag in FORMATTING and stack[depth].tag in BLOCK:
                    break  # formatting ends within its block
            continue
        if tag in CLOSES:
            closed, border = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in border:
                    break
                if stack[depth].tag in closed:
                    pop_to(depth)
                    if tag != "tr":
                        break
        elif tag in ENDS_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    pop_to(depth)
                    break
                if stack[depth].tag in BLOCK:
                    break
        if tag in BLOCK:
            events.append((stack[-1], None))
        if tag in CONTROLS:
            controls.add(id(stack[-1]))
        if tag in VOID:
            continue
        if tag in RAW:
            if tag == "svg" and found[3].rstrip().endswith("/"):
                continue  # only markup of other kinds knows empty elements by the slash
            at = raw_end(html, tag, at)
            continue
        classes, id_, hidden = attributes(found[3])
        name = f"{classes} {id_}".strip()
        above = stack[-1]
        in_article = any(x.tag in ("article", "main") for x in stack)
        dropped = hidden or (tag in DROPPED and tag != "form" and not (tag in KEPT_IN_ARTICLE and in_article))
        named = doubtful = False
        if tag not in ("html", "body", "article", "main") and name:
            named, doubtful = named_for(tag, classes, id_)
        named = named or tag == "form" or (not in_article and bool(name) and bool(SITE_HEADER.search(name)))
        if found[3].rstrip().endswith("/") and tag not in BLOCK:
            continue
        where = above.path if tag in FORMATTING else f"{above.path}>{step(tag, name)}"
        node = Node(tag, name, dropped, above, where, len(events))
        node.named = named and not dropped
        node.doubtful = doubtful and not named and not dropped
        nodes.append(node)
        stack.append(node)
    weighed(nodes, events, controls)
    spared(nodes, events)
    for node in nodes[1:]:  # parents come before their children
        node.dropped |= node.named or node.parent.dropped
    return nodes, events


def spared(nodes: list[Node], events: list[tuple[Node, str | None]]) -> None:
    """Takes back drops by name or as a form, from the outside in, where they
    would take the article.

    That is, while no article or main element keeps text, for an element that
    holds a main element with text or more text outside links than is kept, and
    later for one with ten times the text in such elements that they keep; one
    named for what never surrounds an article only if nothing is kept at all.
    """
    if not any(x.named for x in nodes):
        return
    inside: dict[int, Node | None] = {}  # the nearest element dropped by name
    gone, linked, article = set(), set(), set()
    for node in nodes:
        up = node.parent
        inside[id(node)] = node if node.named else inside[id(up)] if up is not None else None
        for found, own in ((gone, node.dropped), (linked, node.tag == "a"), (article, node.tag in ("article", "main"))):
            if own or (up is not None and id(up) in found):
                found.add(id(node))
    sizes: dict[int, int] = {}
    clean: dict[int, int] = {}  # text with that element as the nearest one dropped by name
    holds: dict[int, int] = {}  # the same, for text of an article or main element
    articles: dict[int, int] = {}
    mains: set[int] = set()
    for node, piece in events:
        if piece is None or id(node) in gone or id(node) in linked or not (size := len(piece.strip())):
            continue
        at = id(inside[id(node)])
        clean[at] = clean.get(at, 0) + size
        sizes[id(node)] = sizes.get(id(node), 0) + size
        if id(node) in article:
            holds[at] = holds.get(at, 0) + size
            articles[id(node)] = articles.get(id(node), 0) + size
            up = node
            while up is not None and not up.named:
                if up.tag == "main":
                    mains.add(id(node))
                up = up.parent
    for node in reversed(nodes[1:]):
        for sums in (sizes, articles):
            if id(node) in sums:
                sums[id(node.parent)] = sums.get(id(node.parent), 0) + sums[id(node)]
        if id(node) in mains:
            mains.add(id(node.parent))
    nothing = id(None)
    kept, found, lost = clean.get(nothing, 0), holds.get(nothing, 0), set()
    for node in nodes[1:]:
        if id(node.parent) in lost or node.dropped:
            lost.add(id(node))
        elif node.named:
            size = sizes.get(id(node), 0)
            if NEVER.search(node.name):
                spare = not kept
            elif found:
                spare = articles.get(id(node), 0) > 10 * found
            else:
                spare = size > kept or id(node) in mains
            if size and spare:
                node.named = False
                kept, found = kept + clean.get(id(node), 0), found + holds.get(id(node), 0)
            else:
                lost.add(id(node))


CONTAINERS = {"article", "main", "section", "div", "body", "td", "center", "blockquote", "html", ""}


def above(node: Node) -> Node | None:
    """The nearest container around ``node``."""
    up = node.parent
    while up is not None and up.tag not in CONTAINERS:
        up = up.parent
    return up


def climbed(node: Node, headed: dict[int, int], parts: dict[int, list[Node]]) -> Node:
    """The container of the whole article of which ``node`` holds the most text.

    All that is kept in an article, or else in a main element, belongs to it.
    Elsewhere a quotation gives way to what surrounds it, and a container to the
    next one up if that holds a heading before it, or itself a tenth (the body: a
    quarter) as much text, or further parts with few links and a fifth as much.
    Cells beside a cell are no parts of it, and right below the body only
    sections beside a section are.
    """
    named, up = {}, node
    while up is not None:
        if up.tag in ("article", "main") and not up.dropped:
            named[up.tag] = up
        up = up.parent
    if named:
        return named.get("article") or named["main"]
    while (up := above(node)) is not None and up.parent is not None and not up.dropped:
        page = up.tag in ("body", "html")
        alike = [x for x in parts[id(up)] if x.path == node.path]
        covered = sum(x.held for x in alike)
        others = [x for x in parts[id(up)] if x.path != node.path and not x.tag == node.tag == "td"]
        more = sum(x.held for x in others if x.held >= 2 * x.held_links and (not page or x.tag == node.tag == "section"))
        wide = (4 if page else 10) * up.own >= covered and up.own >= up.linked
        joined = 5 * more >= covered or (len(alike) > 1 and node.tag == "section")
        if not (node.tag == "blockquote" or wide or joined or (not page and headed.get(id(up), node.at) < node.at)):
            break
        node = up
    return node


def scored(html: str) -> list[tuple[str, float]]:
    """Paths and scores of a page's containers, the best first."""
    return ranked(*parse(html))


def ranked(nodes: list[Node], events: list[tuple[Node, str | None]]) -> list[tuple[str, float]]:
    """The same of a parsed page.

    The characters outside links that lie in a container with no container
    between, half of what its direct children hold, and a bonus for elements
    that name an article find where the text is densest; from there ``climbed``
    leads to the container of the whole article. The others follow by score.
    """
    headed: dict[int, int] = {}
    for at, (node, piece) in enumerate(events):
        if piece is None or node.dropped or not piece.strip():
            continue
        size, linked, heading, up = len(piece.strip()), False, False, node
        while up.parent is not None and up.tag not in CONTAINERS:
            linked |= up.tag == "a"
            heading |= up.tag in ("h1", "h2")
            up = up.parent
        if linked:
            up.linked += size
        else:
            up.own += size
        if heading:
            headed.setdefault(id(up), at)
    parts: dict[int, list[Node]] = {}
    for node in reversed(nodes):  # children come after their parents
        if node.tag not in CONTAINERS or node.dropped:
            continue
        node.held += node.own
        node.held_links += node.linked
        up = above(node)
        if up is not None and not up.dropped and (node.held or node.held_links):
            up.held += node.held
            up.held_links += node.held_links
            parts.setdefault(id(up), []).append(node)
        if node.own:
            value = node.own * node.own / (node.own + node.linked)
            node.score += value * (1.5 if node.tag in ("article", "main") else 1.0)
            if up is not None and not up.dropped:
                up.score += value / 2
    found: dict[str, float] = {}
    first: dict[str, Node] = {}
    for node in nodes:
        if node.score > 0:
            found[node.path] = found.get(node.path, 0.0) + node.score
            if node.path not in first or node.score > first[node.path].score:
                first[node.path] = node
    order = sorted(found.items(), key=lambda x: (-x[1], x[0]))
    if order:
        top = climbed(first[order[0][0]], headed, parts).path
        order = [(top, max(found.get(top, 0.0), order[0][1])), *[x for x in order if x[0] != top]]
    return order


def extracted(html: str, paths: list[str], votes: list[int] | None = None) -> str:
    """The text of the elements on one path: of ``paths`` and the path of the
    page's own best container, the one with the largest product of votes and
    characters. The own best has one vote unless ``votes`` gives it another
    number; paths with none come last."""
    nodes, events = parse(html)
    weights = dict(zip(paths, votes if votes is not None else [2] * len(paths)))
    own = [p for p, _ in ranked(nodes, events)[:1]]
    here = {x.path for x in nodes}
    tried = list(dict.fromkeys([p for p in paths if p in here and weights[p] > 0] + own))
    texts = {p: text_on(p, nodes, events) for p in tried}
    chosen = max(tried, key=lambda p: weights.get(p, 1) * len(texts[p]), default=None)
    if chosen is not None and weights.get(chosen, 1) and texts[chosen]:
        return texts[chosen]
    return next((texts[p] for p in tried if texts[p]), "") or text_on("", nodes, events)


def text_on(path: str, nodes: list[Node], events: list[tuple[Node, str | None]]) -> str:
    """The text of the elements on ``path``."""
    roots = {id(x) for x in nodes if x.path == path and x.tag not in FORMATTING and not x.dropped}
    if not roots:
        return ""
    inside = {}
    for node in nodes:  # parents come before their children
        inside[id(node)] = not node.dropped and (id(node) in roots or (node.parent is not None and inside[id(node.parent)]))
    blocks, now = [], []
    for node, piece in events:
        if piece is None:
            blocks.append("".join(now))
            now = []
        elif inside[id(node)]:
            now.append(piece)
    blocks.append("".join(now))
    lines = [" ".join(b.split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def candidates(pages: DataFrame) -> DataFrame:
    """``host``, row key and ``found``, the paths of the page's containers with
    the best first, of all pages with a host."""

    @F.pandas_udf("array<string>")
    def containers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([[p for p, _ in scored(h)] if h else [] for h in htmls], index=htmls.index, dtype=object)

    hosted = pages.select(host_of(F.coalesce("url", F.lit(""))).alias("host"), *row_key("page_id", "html"), "html")
    return hosted.where("host != ''").select("host", "_id", "_th", containers("html").alias("found"))


def elected(found: DataFrame) -> DataFrame:
    """``host``, ``path`` and votes ``n``. A page votes with its best container,
    once. Listed are paths that at least two pages, and half of those that hold
    text on them, voted for, and with no votes the paths that fewer than half
    voted for."""
    seen = found.select("host", F.posexplode("found").alias("at", "path"))
    tally = seen.groupBy("host", "path").agg(F.sum((F.col("at") == 0).cast("long")).alias("n"), F.count(F.lit(1)).alias("held"))
    sure = 2 * F.col("n") >= F.col("held")
    listed = tally.where((F.col("n") > 0) & (~sure | (F.col("n") > 1)))
    return listed.select("host", "path", F.when(sure, F.col("n")).otherwise(0).alias("n"))


def in_order(listed: DataFrame, *keys: str) -> DataFrame:
    """``paths`` and ``votes`` of each key, most votes first."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "path")))
    grouped = listed.groupBy(*keys).agg(ordered.alias("o"))
    return grouped.select(*keys, F.col("o.path").alias("paths"), F.transform("o.less", lambda x: -x).alias("votes"))


def extract_pages(pages: DataFrame, *, max_broadcast: int = 100_000) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and ``n_chars``.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and comments are left out: by their element, by a class or id all of whose
    parts say so, or by one of which some part does if what the element holds
    agrees (links for half of its text, or fields to fill in). Character
    references are decoded, white space in a block becomes one space, blocks are
    joined by a line end in page order. Of a host's winning paths and the page's
    own best container, that with most votes times text is taken; of equals the
    host's first. Pages without URL or host go by their own best alone; NULL and
    empty html give an empty text; texts are never cut; pages that repeat each
    get a row; an empty table gives none; other columns are not read.

    Winning paths are broadcast, by host, if at most ``max_broadcast`` of 64 MB
    in all are measured. Otherwise each page is joined with the votes of its own
    containers, so nothing is gathered that grows with a host.
    """
    found = staged(candidates(pages), "page-containers")
    listed = staged(elected(found), "host-paths")
    hosted = pages.select("page_id", "url", "html", host_of(F.coalesce("url", F.lit(""))).alias("host"))
    if fits_broadcast(listed, max_broadcast):
        paths = F.broadcast(in_order(listed, "host"))
        paths = paths.select(rekeyed(F.col("host"), "string").alias("p_host"), "paths", "votes")
        joined = hosted.join(paths, F.col("host") == F.col("p_host"), "left")
    else:
        own = found.select("host", "_id", "_th", F.explode(F.array_distinct("found")).alias("path")).distinct()
        mine = in_order(own.join(listed, ["host", "path"]), "host", "_id", "_th")
        keyed = hosted.select("page_id", "url", "html", "host", *row_key("page_id", "html"))
        mine = mine.withColumnsRenamed({"host": "_rhost"})
        joined = keyed.join(
            mine.withColumnsRenamed({"_id": "_rid", "_th": "_rth"}),
            F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")) & (F.col("host") == F.col("_rhost")),
            "left",
        )

    @F.pandas_udf("string")
    def main_text(htmls: pd.Series, chosen: pd.Series, votes: pd.Series) -> pd.Series:
        rows = zip(htmls, chosen, votes)
        return pd.Series(
            [extracted(h, *((list(p), list(v)) if p is not None else ([], None))) if h else "" for h, p, v in rows],
            dtype=object,
        )

    text = joined.select("page_id", "url", main_text("html", "paths", "votes").alias("text"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
