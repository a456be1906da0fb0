"""Main text of web pages by consensus host paths.

Every page scores its containers by the running text below them.  A container's path is the
chain of its ancestors' tags and classes with digits generalised; per host, Spark counts the
pages that vote for each path.  A second pass extracts each page at its host's winning path,
and at the page's own best container where the page doesn't have that path; from there it
climbs to the containers around that add main text only.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import bounded_broadcast, materialize, small_batches

#: Where a comment, declaration or tag begins.
OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_QUOTE_OR_END = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that are never part of the main text.
CHROME = frozenset(
    "head nav header footer aside script style noscript iframe template svg canvas button select textarea "
    "object audio video dialog menu title datalist".split()
)
#: Elements that end a block where they begin and end.
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul nav header footer aside "
    "form menu dialog option".split()
)
CONTAINER = frozenset("article main section div td body blockquote center".split())
#: What an opening tag closes first, of the elements open inside the nearest container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
#: Class, id and role words of what isn't main text.
HINT = re.compile(
    r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menus?|(?:site|page|main|top|global)?-?header|masthead|footers?|side-?bars?|comments?|disqus|replies"
    r"|ads?(?:bygoogle)?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotion|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?"
    r"|shar(?:e|ing)|socials?|related|recommend(?:ed|ations?)?|newsletters?|subscri(?:be|ption)|breadcrumbs?|pagination|pager|widgets?"
    r"|complementary|contentinfo|search(?![-_](?!box|bar|form))|login|signup|toolbar|skip|disclaimer|feedback|respond|trackbacks?|comment-?list|outbrain|taboola)(?:$|[\s_-])",
    re.I,
)
_DIGITS = re.compile(r"\d+")


class Path:
    """A chain of containers; equal chains of a page are one object."""

    __slots__ = ("label", "tag", "parent", "depth", "below")

    def __init__(self, label: str, tag: str, parent: Path | None) -> None:
        self.label, self.tag, self.parent = label, tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.below: dict[str, Path] = {}

    def child(self, label: str, tag: str) -> Path:
        if label not in self.below:
            self.below[label] = Path(label, tag, self)
        return self.below[label]

    def chain(self) -> list[Path]:
        """From this container outwards, without the root."""
        out, at = [], self
        while at.parent is not None:
            out.append(at)
            at = at.parent
        return out

    def __str__(self) -> str:
        return "".join(f"/{p.label}" for p in reversed(self.chain()))


class Node:
    __slots__ = ("tag", "path", "chrome", "parent", "order", "hinted")

    def __init__(self, tag: str, path: Path, chrome: bool, parent: Node | None, order: int, hinted: bool = False) -> None:
        self.tag, self.path, self.chrome, self.parent, self.order, self.hinted = tag, path, chrome, parent, order, hinted


class _Tags:
    """Ends of tags, found in one forward scan however many quotes stay open.

    A tag ends at the first ``>`` outside quotes; where quoting runs to the end of the page, at
    the first ``>`` of any kind, and without one at the end of the page.  What a quote at some
    place leads to is kept, so no stretch is read twice.
    """

    def __init__(self, page: str) -> None:
        self.page, self.known, self.no_end = page, {}, len(page) + 1

    def end(self, at: int) -> int:
        """Index of the tag's ``>``; the page's length if there is none."""
        seen, place = [], at
        while True:
            m = _QUOTE_OR_END.search(self.page, place)
            if not m or m[0] == ">":
                found = m.start() if m else -1
                break
            if m.start() in self.known:
                found = self.known[m.start()]
                break
            seen.append(m.start())
            close = self.page.find(m[0], m.end())
            if close < 0:
                found = -1
                break
            place = close + 1
        for q in seen:
            self.known[q] = found
        if found < 0 and at < self.no_end:
            found = self.page.find(">", at)
            if found < 0:
                self.no_end = at
        return found if found >= 0 else len(self.page)


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """``tag.class`` with sorted classes and generalised digits; whether a hint rules it out.

    A form is ruled out like a hinted element, so one around the page's main text stays.
    """
    if not attributes or "=" not in attributes:
        return tag, tag == "form"
    words, classes = [], []
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        words.append(value)
        if m[1].lower() == "class":
            classes = sorted(set(_DIGITS.sub("#", value).split()))
    return ".".join([tag, *classes]), tag == "form" or any(HINT.search(w) for w in words) and tag not in ("html", "body", "article", "main")


def blocks(page: str) -> list[tuple[Node, str, int]]:
    """(element, text, characters inside links) of the page's text blocks outside chrome, in order."""
    root = Node("", Path("", "", None), False, None, 0)
    stack, out, parts = [root], [], []
    opened: Counter[str] = Counter()
    tags = _Tags(page)
    linked, in_link, orders, at, n = 0, 0, 0, 0, len(page)

    def push(node: Node) -> None:
        stack.append(node)
        opened[node.tag] += 1

    def cut(i: int, j: int | None = None) -> None:
        opened.subtract(x.tag for x in stack[i:j])
        del stack[i:j]

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((stack[-1], text, linked))
        parts, linked = [], 0

    def put(text: str) -> None:
        nonlocal linked
        if not stack[-1].chrome:
            parts.append(text)
            linked += len(text) if in_link else 0

    while at < n:
        m = OPENING.search(page, at)
        if not m:
            put(page[at:])
            break
        if m.start() > at:
            put(page[at : m.start()])
        tag = m[2]
        if tag is None:
            close = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = page.find(close, m.end())
            if m[0] == "<![CDATA[":
                put(html.escape(page[m.end() : end if end >= 0 else n]))
            at = end + len(close) if end >= 0 else n
            continue
        end = tags.end(m.end())
        attributes = page[m.end() : end]
        at = end + 1
        if end == n:  # cut off
            break
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag == "br":
                put(" ")
            if not opened[tag]:
                continue
            if tag in BLOCK or stack[-1].tag == tag and stack[-1].chrome:
                flush()
            # An inline end tag doesn't close the blocks that were opened inside it.
            if tag not in BLOCK and tag not in CHROME:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        cut(i, i + 1)
                        break
                    if stack[i].tag in BLOCK:
                        break
            else:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                cut(i)
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in BLOCK or tag in CHROME:
            flush()
        if tag in VOID:
            continue
        if tag in BLOCK and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    cut(i)
                    break
                if stack[i].tag in CONTAINER or stack[i].tag in CHROME or stack[i].tag == "form":
                    break
        if any(opened[x] for x in CLOSES.get(tag, ())):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    cut(i)
                    break
                if stack[i].tag in CONTAINER - {"td"} or stack[i].tag in ("ul", "ol", "dl", "table"):
                    break
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK or tag in CHROME:
            label, ruled_out = _label(tag, attributes)
            orders += 1
            top = stack[-1]
            # A header inside an article holds its headline.
            chrome = top.chrome or tag in CHROME and not (tag == "header" and (opened["article"] or opened["main"]))
            if not attributes.rstrip().endswith("/") or tag in BLOCK:
                push(Node(tag, top.path.child(label, tag) if tag in CONTAINER else top.path, chrome, top, orders, ruled_out))
        elif tag == "a":
            in_link += 1
        else:
            _, ruled_out = _label(tag, attributes) if tag in ("span", "ins") else ("", False)
            if ruled_out or tag == "label" or stack[-1].chrome and tag == "span":
                push(Node(tag, stack[-1].path, True, stack[-1], stack[-1].order))
            elif tag == "span":
                push(Node(tag, stack[-1].path, False, stack[-1].parent, stack[-1].order))
    flush()
    return _without_hinted(out)


def _without_hinted(found: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The blocks outside elements that a hint rules out.

    A hint doesn't count at an element around the page's largest article or main, if that has
    a quarter of the text; without such, at one that holds most of the text.
    """
    held: dict[Node, int] = {}
    for n, text, linked in found:
        own, at = max(0, len(text) - linked), n
        while at is not None and at not in held:
            held[at] = 0
            at = at.parent
        held[n] += own
    if not any(x.hinted for x in held):
        return found
    total = sum(held.values())
    # Inner elements were opened later, so one pass from the last to the first adds them up.
    inwards = sorted(held, key=lambda x: (x.order, x.tag in ("span", "ins", "label")), reverse=True)
    for x in inwards:
        if x.parent is not None:
            held[x.parent] += held[x]
    told = [x for x in held if x.tag in BONUS and held[x] and 4 * held[x] >= total]
    wraps: set[Node] = set()
    if told:
        at = max(told, key=lambda x: (held[x], -x.order))
        while at is not None:
            wraps.add(at)
            at = at.parent
    else:
        wraps = {x for x in held if 2 * held[x] > total}
    out: dict[Node | None, bool] = {None: False}
    for x in reversed(inwards):
        out[x] = out[x.parent] or x.hinted and x not in wraps
    return [b for b in found if not out[b[0]]]


#: What a container gets of the text one container further down.
DECAY = 0.5
#: Elements that say they are the main text.
BONUS = {"article": 3.0, "main": 2.0}


#: A block's gain ends where it falls below this.
LEAST_GAIN = 1e-6


def _scores(found: list[tuple[Node, str, int]]) -> dict[Path, float]:
    """Score of each container path.

    A block counts its characters outside links, towards its container in full and towards
    containers further out with ``DECAY`` for each step, until less than ``LEAST_GAIN`` is left.
    """
    own: dict[Path, float] = defaultdict(float)
    for node, text, linked in found:
        own[node.path] += max(0, len(text) - 2 * linked)
    scores: dict[Path, float] = defaultdict(float)
    for path, gain in own.items():
        at = path
        while at.parent is not None and gain >= LEAST_GAIN:
            scores[at] += gain * BONUS.get(at.tag, 1.0)
            at, gain = at.parent, gain * DECAY
    return {k: v for k, v in scores.items() if v > 0}


def _best(scores: dict[Path, float]) -> Path | None:
    """The path with the largest score; ties go to the outermost and then to the smallest as text."""
    if not scores:
        return None
    most = max(scores.values())
    tied = [k for k, v in scores.items() if v == most]
    least = min(k.depth for k in tied)
    return min((k for k in tied if k.depth == least), key=str)


def best_path(page: str | None) -> str | None:
    """The page's own choice, as text."""
    best = _best(_scores(blocks(page))) if page else None
    return None if best is None else str(best)


def score_paths(page: str | None) -> dict[str, float]:
    """Score of each container path of the page, by its text."""
    return {str(k): v for k, v in _scores(blocks(page) if page else []).items()}


def _find_path(found: list[tuple[Node, str, int]], path: str) -> Path | None:
    """The page's container path that reads ``path``, if a block lies in it."""
    labels = path.split("/")[1:]
    for start in {n.path: None for n, _, _ in found}:
        chain = start.chain()[::-1]
        if len(chain) >= len(labels) and [p.label for p in chain[: len(labels)]] == labels:
            return chain[len(labels) - 1]
    return None


def climb(found: list[tuple[Node, str, int]], path: Path) -> dict[Path, int]:
    """The blocks' paths inside the outermost container around ``path`` that adds only main text.

    That is the nearest article or main around it, else containers further out as long as
    what they add isn't mostly links; the body only if it adds its own text and sections.
    The answer maps each path of a block inside to the depth at which its chain meets that of
    ``path``.
    """
    chain = path.chain()
    depths = {p: p.depth for p in chain}
    meets: dict[Path, int] = dict(depths)

    def meet(p: Path) -> int:
        way = []
        while p.parent is not None and p not in meets:
            way.append(p)
            p = p.parent
        for w in way:
            meets[w] = meets.get(p, 0)
        return meets.get(p, 0)

    text, links, sections_only = defaultdict(int), defaultdict(int), True
    body = next((p for p in chain if p.tag == "body"), None)
    for n, t, linked in found:
        d = meet(n.path)
        text[d] += len(t)
        links[d] += linked
    outermost = next((p for p in chain if p.tag in BONUS), None)
    if outermost is None:
        outermost, more, more_links = path, 0, 0
        for x in chain[1:]:
            more, more_links = more + text[x.depth], more_links + links[x.depth]
            if x is body and more:
                # Blocks that meet the chain at the body lie in it or in another of its containers.
                tops = {_child_of(n.path, body).tag for n, _, _ in found if meets.get(n.path) == body.depth and n.path is not body}
                sections_only = tops <= {"section"}
                if not sections_only:
                    break
            if 2 * more_links > more:
                break
            outermost = x
            more = more_links = 0
    return {n.path: meets[n.path] for n, _, _ in found if meets.get(n.path, 0) >= outermost.depth}


def _child_of(path: Path, outer: Path) -> Path:
    """The container right below ``outer`` around ``path``."""
    at = path
    while at.parent is not outer:
        at = at.parent
    return at


def extract(page: str | None, path: str | None) -> str:
    """The page's text around ``path``; around its own best container if it has nothing there.

    A block's white space becomes single spaces, blocks are joined by one line break.
    """
    found = blocks(page) if page else []
    where = (_find_path(found, path) if path else None) or _best(_scores(found))
    if where is None:
        return "\n".join(t for _, t, _ in found)
    inside = climb(found, where)
    return "\n".join(t for n, t, _ in found if n.path in inside)


def host_of(url: Column) -> Column:
    """The URL's host in lower case without port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the container path that most pages of the host vote for.

    Ties go to the larger total score and then to the smaller path.  Pages without text and
    null pages don't vote; pages without a host share the empty one.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths, scores = [], [], []
            for h, p in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                s = _scores(blocks(p)) if p else {}
                if s:
                    hosts.append(h), paths.append(str(_best(s))), scores.append(max(s.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
                names=["host", "path", "score"],
            )

    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(
        run, "host string, path string, score double"
    )
    votes = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("score")).alias("score"))
    best = F.min(F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path"))
    return votes.groupBy("host").agg(best.alias("best")).select("host", "best.path")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, path (the host's), text.

    Null or empty html gives an empty text; truncated and unclosed markup is read as far as it
    goes; pages of any size are read whole; repeated rows give repeated results; other columns
    are ignored.
    """
    winners = materialize(host_paths(pages, url_col, html_col), "host-paths")
    winners = bounded_broadcast(winners, F.octet_length("host") + F.octet_length("path") + 64)
    source = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")
    ).join(winners, "host", "left").select("page_id", "url", "path", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(p, w) for p, w in zip(b.column("html").to_pylist(), b.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), b.column("path"), pa.array(texts, pa.string())],
                names=["page_id", "url", "path", "text"],
            )

    id_type = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {id_type}, url string, path string, text string")
