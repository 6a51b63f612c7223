"""Main text of web pages, found by the container paths that the pages of a host agree on."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from batchkit.operators.staging import Stage

# Fixed values of the HTML standard: elements without content, with raw text, and of block kind.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# A start tag of these closes an open paragraph.
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot dd dt li option optgroup body html legend summary".split())
# An element that ends where the next of its kind, or one of these, starts.
ENDS_AT = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What never belongs to the main text, by element, and what may not, by a word of its class, id or role.
APART = frozenset(
    "nav header footer aside form menu search dialog button select svg canvas object template head "
    "fieldset audio video math".split()
)
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment "
    "comments comentarios commentaires kommentare complementary contentinfo cookie cookies consent "
    "disqus feedback footer header hidden masthead menu menubar modal navbar navigation nav newsletter "
    "notice overlay pagination popup promo promoted recommended related replies reply respond sidebar "
    "share sharing skip social sponsor sponsored subscribe tags toolbar widget".split()
)
CONTAINERS = frozenset("article main section div td body blockquote".split())
HOLDS_P = CONTAINERS | {"p"}
ENDERS = frozenset().union(*ENDS_AT.values())
ENDS_WALK = (CONTAINERS - {"td"}) | frozenset("ul ol dl table menu".split())
STORIES = frozenset(("article", "main"))
# A quote opens a string only behind an equals sign; ``<!-->`` is a whole comment.
TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|$))|([!?])[^>]*>?"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)>?)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?")
WORD = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
SPACE = re.compile(r"\s+")


@dataclass(eq=False)
class Node:
    """An element: the step it adds to its parent's path, and what a page's score needs of it."""

    tag: str
    step: str
    parent: Node | None
    apart: bool
    marked: bool = False  # a word of its class, id or role says that it stands apart
    doubtful: bool = False  # such a word is only part of a name, and the element is in an article
    nested: bool = False  # in an element of the same name
    depth: int = 0
    length: int = 0  # of the path as text
    blocks: range = range(0)
    size: int = 0  # characters of text in it and below, links and what stands apart left out
    full: int = 0  # with links

    @property
    def path(self) -> str:
        steps, node = [], self
        while node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return "".join(f"/{step}" for step in reversed(steps))


@dataclass
class Page:
    """``blocks`` of text in page order, the containers with the blocks they hold, and which are titles."""

    blocks: list[str]
    containers: list[Node]
    titles: set[int] = field(default_factory=set)  # blocks in an h1


def _sums(numbers: Iterable[int]) -> list[int]:
    return list(accumulate(numbers, initial=0))


class Reader:
    """One pass over a page. Every tag costs the same, however deep it stands.

    The blocks of an element are those made between its start and its end, so they are a range, and its
    size is a difference of two running totals.
    """

    def __init__(self) -> None:
        self.stack = [Node("", "", None, False)]
        self.opened: Counter[str] = Counter()  # names of open elements
        self.inside: Counter[str] = Counter()  # kinds of open elements: apart, heading, story
        self.blocks: list[str] = []
        self.sizes: list[int] = []
        self.size = self.full = 0
        self.titles: set[int] = set()
        self.headings: set[int] = set()
        self.containers: list[Node] = []
        self.marked: list[Node] = []
        self.story: list[Node] = []
        self.headers: list[Node] = []
        self.text: list[tuple[str, bool]] = []

    def add(self, part: str) -> None:
        if part:
            self.text.append((html.unescape(part) if "&" in part else part, self.opened["a"] > 0))

    def flush(self) -> None:
        """End the current block."""
        if not self.text:
            return
        joined = SPACE.sub(" ", "".join(t for t, _ in self.text)).strip()
        plain = sum(len(t.strip()) for t, link in self.text if not link)
        self.text.clear()
        if not joined or self.inside["apart"]:
            return
        at = len(self.blocks)
        self.blocks.append(joined)
        self.sizes.append(plain)
        self.size += plain
        self.full += len(joined)
        if self.opened["h1"]:
            self.titles.add(at)
        if self.inside["heading"]:
            self.headings.add(at)

    def _kinds(self, node: Node) -> Iterator[str]:
        if node.apart:
            yield "apart"
        if node.tag in HEADINGS:
            yield "heading"
        if node.tag in STORIES:
            yield "story"

    def open(self, node: Node) -> None:
        node.parent, node.depth = self.stack[-1], len(self.stack)
        node.length = node.parent.length + 1 + len(node.step)
        node.blocks = range(len(self.blocks), len(self.blocks))
        node.size, node.full = self.size, self.full
        self.stack.append(node)
        self.opened[node.tag] += 1
        self.inside.update(self._kinds(node))

    def close(self, depth: int) -> None:
        """End all elements from this depth on."""
        if any(n.tag in BLOCKS or n.apart for n in self.stack[depth:]):
            self.flush()
        while len(self.stack) > depth:
            node = self.stack.pop()
            self.opened[node.tag] -= 1
            self.inside.subtract(self._kinds(node))
            node.blocks = range(node.blocks.start, len(self.blocks))
            node.size, node.full = self.size - node.size, self.full - node.full
            if node.apart or not node.blocks:
                continue
            if node.tag in CONTAINERS:
                self.containers.append(node)
            if node.marked or node.doubtful and node.full > 2 * node.size:
                node.marked = True
                self.marked.append(node)
            if node.tag in ("main", "article", "h1") and node.size:
                self.story.append(node)
            if node.tag == "header":
                self.headers.append(node)

    def end(self, name: str) -> None:
        """An end tag; without a start tag it means nothing."""
        if not self.opened[name]:
            if name == "br":
                self.text.append((" ", False))
            return
        depth = len(self.stack) - 1
        crossed = False
        while self.stack[depth].tag != name:
            crossed |= self.stack[depth].tag in CONTAINERS
            if crossed and name not in BLOCKS:
                return
            depth -= 1
        self.close(depth)

    def start(self, name: str, source: str) -> None:
        if name in BLOCKS:
            self.flush()
        if name in CLOSES_P and self.opened["p"]:
            depth = len(self.stack) - 1
            while depth and self.stack[depth].tag not in HOLDS_P:
                depth -= 1
            if depth and self.stack[depth].tag == "p":
                self.close(depth)
        if name in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.close(len(self.stack) - 1)
        if name in ENDERS:
            for k in range(len(self.stack) - 1, 0, -1):
                if name in ENDS_AT.get(self.stack[k].tag, ()):
                    self.close(k)
                    continue
                if self.stack[k].tag in ENDS_WALK:
                    break
        if name in VOID:
            if name in ("br", "hr", "wbr"):
                self.text.append((" " if name != "wbr" else "", False))
            return
        attributes = {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(source)}
        classes = html.unescape(attributes.get("class", "")).lower().split()
        names = [*classes, attributes.get("id", "").lower(), attributes.get("role", "").lower()]
        in_story = self.inside["story"] > 0
        inside = in_story and name != "article"  # one that is called a comment is one
        apart = (
            (name in APART and not (name == "header" and in_story))
            or name in RAW
            or "hidden" in attributes
            or attributes.get("aria-hidden", "").lower() == "true"
        )
        said = [WORD.findall(n) for n in names]
        part = any(not APART_WORDS.isdisjoint(words) for words in said)
        whole = any(words and APART_WORDS.issuperset(words) for words in said)
        step = ".".join([name, *sorted({DIGITS.sub("#", c) for c in classes})])
        nested = name == "article" and self.opened[name] > 0
        self.open(
            Node(name, step, None, apart, whole if inside else part, inside and part and not whole, nested)
        )


def parse(source: str) -> Page:
    """Read a page in one pass, forgiving what is not closed, like a browser.

    The path of a container is the tags from the root to it, each with the sorted words of its class,
    numbers in them generalised to ``#``. What stands apart by its element has no blocks; what does so
    by a word has none either, unless it surrounds the main text (``apart_blocks``). In an ``article`` or
    ``main`` a word counts if it is a whole name, or all words of a name say so, or the element is mostly
    links; of a ``header`` there the headings stay.
    """
    page = Reader()
    raw = ""
    at = 0
    while at < len(source):
        if raw:  # up to its end tag, whatever it looks like
            end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(source, at)
            raw = ""
            at = end.start() if end else len(source)
            continue
        tag = TAG.search(source, at)
        if tag is None:
            rest = source[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag that the page breaks off in
            page.add(rest[: cut.start()] if cut else rest)
            break
        page.add(source[at : tag.start()])
        at = tag.end()
        name = (tag[3] or "").lower()
        if not name:
            continue
        if tag[2]:
            page.end(name)
        else:
            page.start(name, tag[4])
            raw = name if name in RAW else ""
    page.close(1)
    page.flush()
    root = page.stack[0]
    root.blocks, root.size = range(len(page.blocks)), page.size
    if page.blocks:
        page.containers.append(root)
    lost = apart_blocks(page.marked, page.story, page.sizes)
    for node in page.headers:
        lost.update(b for b in node.blocks if b not in page.headings)
    if lost:
        kept = [b not in lost for b in range(len(page.blocks))]
        place, size = _sums(kept), _sums(n * k for n, k in zip(page.sizes, kept, strict=True))
        for node in page.containers:
            first, last = node.blocks.start, node.blocks.stop
            node.blocks, node.size = range(place[first], place[last]), size[last] - size[first]
        page.containers = [n for n in page.containers if n.blocks]
        page.titles = {place[b] for b in page.titles if kept[b]}
        page.blocks = [b for b, k in zip(page.blocks, kept, strict=True) if k]
    return Page(page.blocks, page.containers, page.titles)


def apart_blocks(marked: list[Node], story: list[Node], sizes: list[int]) -> set[int]:
    """Blocks of the ``marked`` nodes, without those nodes that only surround the main text.

    Themes put words like ``sidebar`` into the classes of wrappers around everything. A marked node
    is a wrapper if it is or holds a ``main``, the page's only ``h1`` or its only unmarked outermost
    ``article``, or if it has more text than all that is in no marked node; the fullest is judged
    first, and its own text counts for the next. Text beside the page's only article (comments,
    say) is not made a wrapper by its length.
    """
    heads = [n for n in story if n.tag == "h1"]
    articles = [n for n in story if n.tag == "article" and not n.marked and not n.nested]
    articles = articles if len(articles) == 1 else []
    sure = [n for n in story if n.tag == "main"] + (heads if len(heads) == 1 else []) + articles
    inside = lambda a, b: b.blocks[0] <= a.blocks[0] and a.blocks[-1] <= b.blocks[-1]
    words = [n for n in marked if n.tag not in ("html", "body", "article", "main")]
    doubtful = [n for n in words if not any(inside(s, n) for s in sure)]
    doubtful.sort(key=lambda n: (-n.size, -len(n.blocks)))
    depth = [0] * len(sizes)  # of doubtful nodes around each block
    for node in doubtful:
        for b in node.blocks:
            depth[b] += 1
    free = sum(n for n, d in zip(sizes, depth, strict=True) if not d)
    for node in doubtful:
        if node.size > free and all(inside(node, a) for a in articles):
            for b in node.blocks:
                depth[b] -= 1
                free += 0 if depth[b] else sizes[b]
    return {b for b, d in enumerate(depth) if d}


def best_path(page: Page) -> tuple[str | None, float]:
    """The path of the container of highest rank, the first by name among equals, and its score.

    The score is the text without links. An ``article`` or ``main`` counts a fifth more, and so does
    a container that adds nothing but the title to the fullest one of these. Of containers with the
    same score one that holds an ``h1`` is before others, then the innermost. So no text and no title
    is left out for the sake of depth.
    """
    titles = _sums(b in page.titles for b in range(len(page.blocks)))

    def held(first: int, last: int) -> int:
        return titles[last] - titles[first]

    stories = [n for n in page.containers if n.tag in STORIES]
    story = max(stories, key=lambda n: n.size, default=None)
    if story and held(story.blocks.start, story.blocks.stop):
        story = None

    def weight(node: Node) -> float:
        if node.tag in STORIES:
            return 1.2
        if not story or story.blocks.start < node.blocks.start or node.blocks.stop < story.blocks.stop:
            return 1.0
        more = len(node.blocks) - len(story.blocks)
        return 1.2 if more == held(node.blocks.start, node.blocks.stop) else 1.0

    ranks = [
        (weight(n) * n.size, held(n.blocks.start, n.blocks.stop) > 0, n.depth) for n in page.containers
    ]
    top = max(ranks, default=(0.0, False, 0))
    best = (n.path for n, rank in zip(page.containers, ranks, strict=True) if rank == top)
    return min(best, default=None), top[0]


def main_text(page: Page, path: str | None) -> str:
    """Blocks in the containers with the host's path; without any, in the page's own best one."""
    chosen = _at(page, path)
    if not chosen and page.containers:
        chosen = _at(page, best_path(page)[0])
    at = sorted({b for n in chosen for b in n.blocks})
    return "\n".join(page.blocks[b] for b in at) if chosen else "\n".join(page.blocks)


def _at(page: Page, path: str | None) -> list[Node]:
    return [n for n in page.containers if path is not None and n.length == len(path) and n.path == path]


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    stage: Stage | None = None,
) -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` of every page.

    First each page scores its containers and votes for the best one's path; the host's path is the
    one with most votes, then the highest score, then the first by name. Votes are added up before
    the shuffle, so a host with a third of all pages is no burden. Then every page is read again
    with the path of its host, which Spark broadcasts if the written list is small and joins by host
    otherwise.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and comments
    of readers are left out, by element, class, id or role; a word of a class, id or role does not
    count where it names a wrapper of the main text (see ``apart_blocks``). Character references are decoded, white
    space within a block (and a line break) is one space, blocks are trimmed and joined by a line
    feed in page order. A page whose containers lack the host's path uses its own best one.

    Null or empty html has an empty text; null urls share one host. Repeated rows give repeated
    rows, an empty table gives none. Other columns are not read.
    """
    stage = stage or Stage(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(html_col, F.lit("")).alias("html"),
        host(F.col(url_col)).alias("host"),
    )

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, scores = [], []
            for source in batch["html"]:
                path, score = best_path(parse(source.as_py()))
                paths.append(path)
                scores.append(round(score))
            yield pa.RecordBatch.from_arrays(
                [batch["host"], pa.array(paths, pa.string()), pa.array(scores, pa.int64())],
                ["host", "path", "score"],
            )

    votes = (
        rows.select("host", "html")
        .mapInArrow(vote, "host string, path string, score long")
        .filter("path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    )
    # the smallest path wins a tie: kept apart from the maximum of the other two
    best = votes.groupBy("host").agg(F.max(F.struct("votes", "score")).alias("best"))
    winners = (
        votes.join(best, "host")
        .filter(F.struct("votes", "score") == F.col("best"))
        .groupBy("host")
        .agg(F.min("path").alias("path"))
    )
    winners = stage.put(winners, "paths")
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(parse(source.as_py()), path.as_py())
                for source, path in zip(batch["html"], batch["path"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string())], ["id", "url", "text"]
            )

    found = rows.join(winners, "host", "left").select("id", "url", "html", "path")
    return found.mapInArrow(read, f"id {kind}, url string, text string").select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
