"""Main text of web pages by consensus host paths.

Pages of one host mostly share a template, so the place of the article is learned from
all of them: every page's containers are scored by the share of the page's prose they
hold, each container is named by its path of tags and generalised classes, and per host
the paths are voted on in Spark.  A second pass extracts each page at its host's winning
path; a page whose prose is mostly elsewhere is extracted at its own best container.
Time and memory are linear in a page, however deep it nests.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.llm.shared import only, stored

#: Share of a page's prose (in thousandths) from which a container stands for the page.
CANDIDATE_SHARE = 700
#: A path wins its host if it has this share of the votes of the host's best path, and is deepest.
WINNING_SHARE = 0.5
#: The host's path stands for a page where it holds this share (in thousandths) of the page's prose.
HOST_SHARE = 500
#: Labels at the end of a path that are spelt out; a path is known by its depth and a hash of all its labels.
SPELT_LABELS = 6
#: Characters outside links from which an element of an article is prose, though its name may be furniture's.
PROSE_CHARS = 40

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|iframe|textarea|title|xmp|noembed|noframes)(?=[\s/>])[^>]*>"
    r".*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTES = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_MAY_HIDE = re.compile(r"hidden|display\s*:\s*none", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_DIGITS = re.compile(r"\d+")

# Element names of HTML, by what they mean for a page's text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article main section div body td center".split())
_ARTICLE = ("article", "main")
_NOT_TEXT = frozenset(
    "nav aside footer form button input label fieldset head menu dialog audio video map "
    "canvas noscript object select svg template".split()
)
_FORM = frozenset("form button input label fieldset select textarea".split())
_CLOSES_ITSELF = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
                  "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
                  "option": ("option", ("select",))}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ASIDE_PART = re.compile(
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal"
    r"|overlay|newsletter|subscribe|subscription|signup|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side|rail|widget\w*"
    r"|footer|foot|masthead|comments?|commentlist|disqus|respond|reply|replies|related|recommend\w*|share|sharing|social"
    r"|toolbar|pager|pagination|skip|login|search|copyright|disclaimer|contentinfo|complementary"
)
#: Words among them that an article may be about; there more than the name must speak for furniture.
_TOPICS = re.compile(
    r"notices?|alert|menu|side|rail|foot|respond|reply|replies|related|recommend\w*|share|sharing|social|skip|login|search"
    r"|copyright|disclaimer|banner|toolbar"
)
#: What a class of furniture may be called besides; any other word in it makes it a name of its own, as in has-sidebar.
_ASIDE_REST = frozenset(
    "site page post posts entry article articles story stories main primary secondary left right top bottom inner outer global "
    "box bar bars list links link items item area block container wrapper wrap section group row column col button buttons "
    "icons icon form panel slot unit header title text js".split()
)
_PARTS = re.compile(r"[^\W\d_]+")
_HEADER_NAME = re.compile(r"(?:site-?)?header|top-?bar|page-?header", re.I)
_REPLIES = frozenset("comment comments commentlist disqus respond reply replies".split())


def _is_aside(token: str) -> bool:
    """Whether a whole class token, id or role names page furniture.

    >>> [_is_aside(t) for t in ("sidebar", "nav-menu", "share-buttons", "has-sidebar", "related-work", "sidebar2")]
    [True, True, True, False, False, True]
    """
    parts = _PARTS.findall(token)
    aside = [_ASIDE_PART.fullmatch(part) is not None for part in parts]
    return any(aside) and all(a or len(p) == 1 or p in _ASIDE_REST for a, p in zip(aside, parts))


def _is_hidden(attrs: str) -> bool:
    """Whether attributes hide their element: hidden itself, aria-hidden=true, or a style without display."""
    if not _MAY_HIDE.search(attrs):
        return False
    for name, a, b, c in _ATTRIBUTES.findall(attrs):
        name, value = name.lower(), (a or b or c).strip().lower()
        if (
            name == "hidden" and not value.startswith(("false", "until"))
            or name == "aria-hidden" and value == "true"
            or name == "style" and _NO_DISPLAY.search(value)
        ):
            return True
    return False


class _Node:
    """An element: what it is called and holds, and whether its text counts.

    ``why`` says what is against it: 0 nothing, 1 its tag, 2 its name or being hidden, 3 replies, 4 a name that is also a topic.
    ``prose`` and ``linked`` are the characters outside and within links below it; ``up`` is the innermost container that counts
    around its content, itself included.
    """

    __slots__ = ("tag", "label", "parent", "why", "skip", "up", "in_article", "link", "prose", "linked", "form", "depth", "key")

    def __init__(self, tag: str, label: str, parent: _Node | None, why: int):
        self.tag, self.label, self.parent, self.why = tag, label, parent, why
        self.in_article = tag in _ARTICLE or bool(parent and parent.in_article)
        self.link = tag == "a" or bool(parent and parent.link)
        self.prose = self.linked = 0
        self.form, self.skip, self.up = tag in _FORM, False, None
        crc, sum_, self.depth = (*parent.key, parent.depth + 1) if parent else (0, 1, 0)
        name = f">{label}".encode("utf-8", "surrogatepass")
        self.key = (zlib.crc32(name, crc), zlib.adler32(name, sum_))


def _against(tag: str, attrs: str, parent: _Node | None) -> tuple[str, int]:
    """Label of an element, and what is against its text, as in ``_Node.why``."""
    named = {}
    for key, a, b, c in _NAMES.findall(attrs) if "=" in attrs else ():
        named.setdefault(key.lower(), a or b or c)
    classes = named.get("class", "").split()
    label = f"{tag}.{_DIGITS.sub('#', classes[0]).lower()}" if classes else tag
    inside = parent is not None and parent.in_article
    if tag in _NOT_TEXT or tag == "header" and not inside:
        return label, 2 if tag == "form" else 1
    if attrs and _is_hidden(attrs):
        return label, 2
    topic = False
    if named and tag not in ("html", "body", "main", "article"):
        if tag in _HEADINGS:
            named.pop("id", None)  # made of the heading's words
        for token in " ".join(named.values()).lower().split():
            if _is_aside(token):
                parts = [part for part in _PARTS.findall(token) if _ASIDE_PART.fullmatch(part)]
                if inside and all(map(_TOPICS.fullmatch, parts)):
                    topic = True
                else:
                    return label, 2 if _REPLIES.isdisjoint(parts) else 3
            elif not inside and _HEADER_NAME.fullmatch(token):
                return label, 2
    return label, 4 if topic else 0


#: Text with the element it stands in, or None with the element at the end of a block.
_Piece = tuple[str | None, _Node | None]
#: (text, characters within links, the innermost container that counts) of a text block.
_Block = tuple[str, int, _Node | None]


def _parse(page: str) -> tuple[list[_Piece], list[_Node]]:
    """The pieces of a page in its order, and its elements, parents first.

    Unclosed and crossing tags are taken as browsers take them: a block ends a paragraph,
    a list item the item before it, an end tag what was opened since.
    """
    pieces: list[_Piece] = []
    nodes: list[_Node] = []
    stack: list[_Node] = []
    is_open: Counter[str] = Counter()  # so that no tag is looked for in vain

    def flush() -> None:
        if pieces and pieces[-1][0] is not None:
            pieces.append((None, stack[-1] if stack else None))

    def close_to(depth: int) -> None:
        if any(n.tag in _BLOCK for n in stack[depth:]):
            flush()
        is_open.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def close_nearest(tags: tuple[str, ...], stops: Callable[[_Node], bool]) -> None:
        if any(is_open[tag] > 0 for tag in tags):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in tags:
                    return close_to(depth)
                if stops(stack[depth]):
                    return None
        return None

    def add(text: str) -> None:
        if not text:
            return
        node = stack[-1] if stack else None
        pieces.append((text, node))
        if node is not None:
            if node.link:
                node.linked += len(text.strip())
            else:
                node.prose += len(text.strip())

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        tag = token["tag"] or token["tag2"]
        if not tag:
            if (token["raw"] or "").lower() == "textarea" and stack:
                stack[-1].form = True
            continue
        tag = tag.lower()
        if token["end"] or token["end2"]:
            if is_open[tag] > 0:
                close_nearest((tag,), lambda _: False)
            elif tag in _BLOCK:
                flush()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in _BLOCK:
            flush()
            close_nearest(("p",), lambda node: node.tag in _CONTAINER)
        if tag in _CLOSES_ITSELF:
            ends, stops = _CLOSES_ITSELF[tag]
            close_nearest(tuple(ends.split()), lambda node: node.tag in stops)
        attrs = token["attrs"] or token["attrs2"] or ""
        parent = stack[-1] if stack else None
        if tag in _VOID or attrs.endswith("/") and tag not in _BLOCK and tag != "a":
            if tag in _FORM and parent is not None and "hidden" not in attrs:
                parent.form = True
            continue
        node = _Node(tag, *_named(tag, attrs, parent))
        nodes.append(node)
        stack.append(node)
        is_open[tag] += 1
    add(page[at:])
    flush()
    return pieces, nodes


def _named(tag: str, attrs: str, parent: _Node | None) -> tuple[str, _Node | None, int]:
    label, why = _against(tag, attrs, parent)
    return label, parent, why


def _judge(pieces: list[_Piece], nodes: list[_Node]) -> None:
    """Settle which elements count and the container around each.

    An element that is furniture by its name, a form or hidden, and yet holds most of the page's prose, is no furniture, but
    for replies to other prose.  Within an article a heading, or prose with few links and no form, is no
    furniture for a name that is also a topic.
    """
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.prose += node.prose
            node.parent.linked += node.linked
            node.parent.form |= node.form
    total = sum(len(text.strip()) for text, node in pieces if text is not None and not (node and node.link))
    for replies_too in (False, True):
        for node in nodes:
            above, why = node.parent, node.why
            if why == 4:
                prose = node.prose >= max(PROSE_CHARS, node.linked) and not node.form
                against = not (prose or node.tag in _HEADINGS)
            else:
                against = why == 1 or why > 1 and not (
                    (why == 2 or replies_too) and 1000 * node.prose >= CANDIDATE_SHARE * total > 0
                )
            node.skip = against or above is not None and above.skip
            node.up = node if node.tag in _CONTAINER and not node.skip else above.up if above is not None else None
        shown = any(text.strip() for text, node in pieces if text is not None and not (node and (node.skip or node.link)))
        if shown or not any(node.why == 3 for node in nodes):
            return


def _read(page: str) -> tuple[list[_Block], list[_Node]]:
    """The text blocks that count, in page order, and the containers that count, outer ones first."""
    pieces, nodes = _parse(page)
    _judge(pieces, nodes)
    found: list[_Block] = []
    words: list[str] = []
    linked = 0
    for text, node in pieces:
        if text is None:
            block = " ".join("".join(words).split())
            if block:
                found.append((block, linked, node.up if node is not None else None))
            words.clear()
            linked = 0
        elif node is None or not node.skip:
            text = entities.unescape(text) if "&" in text else text
            words.append(text)
            if node is not None and node.link:
                linked += len(text)
    return found, [node for node in nodes if node.up is node]


def _above(node: _Node) -> _Node | None:
    """The container around a container."""
    return node.parent.up if node.parent is not None else None


def _path(node: _Node) -> str:
    """The last labels of a container's path, its depth, and a hash of all of its labels."""
    labels, above = [], node
    while above is not None and len(labels) < SPELT_LABELS:
        labels.append(above.label)
        above = above.parent
    return f"{'>'.join(reversed(labels))}@{_place(node)}"


def _place(node: _Node) -> str:
    return f"{node.depth}:{node.key[0]:08x}{node.key[1]:08x}"


def _weight(block: _Block) -> int:
    return max(0, len(block[0]) - 2 * block[1])


def _containers(parts: list[_Block], containers: list[_Node]) -> tuple[dict[_Node, int], int]:
    """Prose characters within each container, text outside links over its whole subtree, and those of the page."""
    prose = dict.fromkeys(containers, 0)
    for block in parts:
        if block[2] is not None:
            prose[block[2]] += _weight(block)
    for node in reversed(containers):
        if (above := _above(node)) is not None:
            prose[above] += prose[node]
    return prose, sum(map(_weight, parts))


def candidates(page: str) -> list[tuple[str, int, int]]:
    """(path, depth, share of the page's prose in thousandths) of the containers worth a vote."""
    prose, total = _containers(*_read(page))
    best: dict[str, tuple[int, int]] = {}
    for node, weight in prose.items():
        share = 1000 * weight // total if total else 0
        if share >= CANDIDATE_SHARE:
            path = _path(node)
            best[path] = max(best.get(path, (0, 0)), (share, node.depth))
    return [(path, depth, share) for path, (share, depth) in best.items()]


def main_text(page: str | None, path: str | None) -> str:
    """The page's text blocks around ``path``, if most of its prose is there, or around its own best container.

    A deep container may hold the body of an article without its title, lead and captions.  So all of the article, or else
    the main element, around it is taken; prose outside links that stands directly in a container around that; and, where
    there is neither article nor main, prose of containers beside it, but for those directly in the page's body.

    >>> main_text("<body><nav>x</nav><article><p>A &amp; b<p>c</article></body>", None)
    'A & b\\nc'
    """
    parts, containers = _read(page or "")
    if not parts:
        return ""
    prose, total = _containers(parts, containers)
    place = path.rpartition("@")[2] if path else None
    chosen = [n for n in containers if place and _place(n) == place]
    if 1000 * sum(prose[n] for n in chosen) < HOST_SHARE * total or not total:
        chosen = []
    if not chosen:
        most = [n for n, w in prose.items() if total and 1000 * w // total >= CANDIDATE_SHARE]
        if most:
            chosen = [max(most, key=lambda n: n.depth)]
    if not chosen:
        return "\n".join(text for text, _, _ in parts)
    tops = {_top(n) for n in chosen}
    around = {above for top in tops for above in _around(top)}
    beside = {above for top in tops if top.tag not in _ARTICLE for above in _around(top) if above.tag != "body"}
    within: dict[_Node | None, tuple[bool, bool]] = {None: (False, False)}
    for node in containers:
        in_top, in_beside = within[_above(node)]
        within[node] = (in_top or node in tops, in_beside or node in beside)
    kept = []
    for block in parts:
        text, linked, node = block
        in_top, in_beside = within[node]
        near = node is None or node in around or in_beside
        if in_top or near and len(text) > 2 * linked:
            kept.append(text)
    return "\n".join(kept)


def _around(node: _Node) -> Iterator[_Node]:
    """The containers around a node, from the inside."""
    while (node := _above(node)) is not None:
        yield node


def _top(node: _Node) -> _Node:
    """The nearest article around a container or itself, else the nearest main, else the container."""
    for tag in _ARTICLE:
        for above in (node, *_around(node)):
            if above.tag == tag:
                return above
    return node


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows: dict[tuple[str, str], list[int]] = {}
        for host, page in zip(batch["host"], batch["html"]):
            for path, depth, share in candidates(page):
                entry = rows.setdefault((host, path), [depth, 0])
                entry[1] += share
        yield pd.DataFrame(
            [(h, p, d, v) for (h, p), (d, v) in rows.items()], columns=["host", "path", "depth", "votes"]
        )


@F.pandas_udf(T.StringType())
def _extract(pages: pd.Series, paths: pd.Series) -> pd.Series:
    return pd.Series([main_text(page, path) for page, path in zip(pages, paths)], dtype=object)


def host_of(url):
    """Host of a URL column in lower case without ``www.`` or port; '' if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path that the host's pages vote for.

    Votes are summed per host and path, combined before the shuffle, so a host with a third
    of all pages costs one row per path and task.  Of the paths with at least half of
    the best path's votes the deepest wins; ties go to more votes, then the smaller path.
    """
    votes = stored(
        pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
        .mapInPandas(_votes, "host string, path string, depth int, votes long")
        .groupBy("host", "path")
        .agg(F.max("depth").alias("depth"), F.sum("votes").alias("votes")),
        "votes",
    )
    best = votes.groupBy("host").agg(F.max("votes").alias("most"))
    return (
        votes.join(best, "host")
        .filter(F.col("votes") >= WINNING_SHARE * F.col("most"))
        .groupBy("host")
        .agg(F.min_by("path", F.struct(-F.col("depth"), -F.col("votes"), "path")).alias("path"))
    )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, host, path) of every row of ``pages``.

    NULL or empty html gives an empty text; a NULL or unreadable url counts as the host ''.
    Repeated rows stay repeated; an empty table gives an empty result; columns other
    than page_id, url and html are ignored.  Texts are never cut.
    """
    rows = only(pages, page_id="long", url="string", html="string").withColumn("host", host_of(F.col("url")))
    # A table that was stored and plain rows: adaptive execution splits a host that has a third of all pages.
    placed = rows.join(stored(host_paths(pages), "paths"), "host", "left")
    return placed.select(
        "page_id", "url", _extract(F.coalesce("html", F.lit("")), "path").alias("text"), "host", "path"
    ).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host", "path")
