"""Main text of web pages by consensus of the pages of a host.

Every page scores its containers and votes for the path of the best one. A path names the tags and
classes from the top of the page down to the container, with digits made alike, so that pages made
from one template agree on it. Votes are counted per host, and every page is read again with the
paths that won. Scores decide only on pages whose host has no path for them.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.urls import with_parts
from skyledger.llm.workers import released
from skyledger.session import staged

SHARE = 20  # a path wins with one of SHARE votes of its host, so a host has at most SHARE of them
DEPTH = 400  # containers nested deeper count as part of the one above; their text stays

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))
    |<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>
    |<[!?/][^>]*+(?:>|\Z)
    |<(?=[A-Za-z]).*\Z""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var".split()
)
_BLOCK = frozenset(
    "address article aside blockquote button canvas caption center datalist dd details dialog dir "
    "div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main "
    "menu nav noscript object ol optgroup option p pre section select summary svg table tbody td "
    "template tfoot th thead tr ul audio video".split()
)
_CONTAINERS = frozenset("article center div main section td".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TABLE = frozenset("caption table tbody td tfoot th thead tr".split())
#: What a start tag closes, and the tags that it does not look beyond.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_NEVER = frozenset(
    "aside button canvas datalist dialog footer form menu nav noscript object select svg template "
    "audio video".split()
)
#: Words in a class or id that mark something other than the article.
_COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
_MARKS = _COMMENTS | frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar "
    "header masthead footer colophon copyright sidebar aside widget widgets rail "
    "cookie cookies consent gdpr notice notices notification alert banner popup modal overlay toast "
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted "
    "newsletter subscribe subscription signup login search share sharing social related "
    "recommended".split()
)
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
_GOOD = frozenset("article post entry content main story text body".split())
NONE, SOFT, HEADER, HARD = range(4)


@lru_cache(8192)
def _element(tag: str, attributes: str) -> tuple[str, int, float]:
    """Path step, mark and bonus of a start tag."""
    found = {
        name.lower(): markup.unescape(a or b or c)
        for name, a, b, c in reversed(_ATTRIBUTE.findall(attributes))
    }
    classes = sorted({re.sub(r"\d+", "0", c) for c in found.get("class", "").split()})
    step = re.sub(r"/", "_", ".".join([tag, *classes]))
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = [w.lower() for w in _WORD.findall(names)]
    marks = {
        word
        for before, word in zip(["", *words], words)
        if word in _MARKS and before not in ("has", "no", "with", "without")
    }
    bonus = 1.25 if tag in ("article", "main") else 1.1 if _GOOD & set(words) else 1.0
    style = found.get("style", "").lower().replace(" ", "")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
    if tag in _NEVER or hidden or found.get("role", "").lower() in _ROLES:
        return step, HARD, bonus
    if tag == "header":
        return step, HEADER, bonus
    if tag == "article" or tag in _HEADINGS:
        marks &= _COMMENTS | {"ad", "ads", "advert", "sponsored", "promo", "promoted", "related"}
    if tag == "main" or not marks:
        return step, NONE, bonus
    if marks & _COMMENTS:
        return step, HARD, bonus
    return step, SOFT, bonus


class Block(NamedTuple):
    node: int
    text: str
    linked: int
    heading: bool


class Page:
    """Containers of a page, and its blocks of text in order. Node 0 is the page itself."""

    def __init__(self, source: str):
        self.parent, self.mark, self.bonus = [-1], [NONE], [0.8]
        self.main, self.holds_main = [False], [False]
        self.path, self.steps = [0], {}
        self.container = [True]
        self.blocks: list[Block] = []
        self._stack: list[tuple[str, int, bool]] = []  # (tag, node, in a link)
        self._open: Counter[str] = Counter()
        self._deeper: Counter[str] = Counter()
        self._hard = 0  # open elements whose text is dropped
        self._pieces: list[str] = []
        self._linked = 0
        self._read(source)
        self._keep()

    def _read(self, source: str) -> None:
        at = 0
        while found := _TOKEN.search(source, at):
            self._text(source[at : found.start()])
            at = found.end()
            end, tag, attributes = found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
            elif tag in _RAW:
                closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = closing.start() if closing else len(source)
                if tag not in ("script", "style", "title"):
                    self._flush()
            else:
                self._start(tag, attributes)
        self._text(source[at:])
        self._flush()

    def _text(self, text: str) -> None:
        if text and not self._hard:
            if "&" in text:
                text = markup.unescape(text)
            self._pieces.append(text)
            if self._stack and self._stack[-1][2]:
                self._linked += len(text.strip())

    def _flush(self) -> None:
        if self._pieces:
            if text := " ".join("".join(self._pieces).split()):
                node = self._stack[-1][1] if self._stack else 0
                heading = any(self._open[h] for h in _HEADINGS)
                self.blocks.append(Block(node, text, self._linked, heading))
            self._pieces, self._linked = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in _VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self._pieces.append(" ")
            return
        if tag not in _BLOCK:
            if tag == "a":
                self._close({"a"}, _BLOCK)
            step, mark, _ = _element(tag, attributes) if tag in _INLINE else ("", NONE, 0)
            if mark != NONE:
                # Text before and behind belongs to one block, that between to none.
                self._push(tag, self._node(), mark=HARD)
            elif tag == "a":
                self._push(tag, self._node(), linked=True)
            return
        self._flush()
        if self._open["p"]:
            self._close({"p"}, {"table", "td", "th", "caption", "button", "object"})
        if tag in _HEADINGS and self._stack and self._stack[-1][0] in _HEADINGS:
            self._pop()
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        step, mark, bonus = _element(tag, attributes)
        if mark == NONE and len(self._stack) >= DEPTH:
            self._deeper[tag] += 1
            return
        node = self._node()
        if tag in _CONTAINERS or mark != NONE:
            main = tag in ("article", "main") or self.main[node]
            key = (self.path[node], step)
            self.path.append(self.steps.setdefault(key, len(self.steps) + 1))
            self.parent.append(node)
            self.mark.append(mark)
            self.bonus.append(bonus)
            self.main.append(main)
            self.holds_main.append(False)
            self.container.append(tag in _CONTAINERS and mark != HARD)
            node = len(self.parent) - 1
        if tag in ("article", "main", "h1"):
            above = node
            while above >= 0 and not self.holds_main[above]:
                self.holds_main[above] = True
                above = self.parent[above]
        self._push(tag, node, mark=mark)

    def _node(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _push(self, tag: str, node: int, linked: bool = False, mark: int = NONE) -> None:
        linked = linked or bool(self._stack) and self._stack[-1][2]
        self._stack.append((tag if mark != HARD else f"!{tag}", node, linked))
        self._open[tag] += 1
        self._hard += mark == HARD

    def _pop(self) -> str:
        tag, _, _ = self._stack.pop()
        if tag[0] == "!":
            self._hard -= 1
            tag = tag[1:]
        self._open[tag] -= 1
        return tag

    def _close(self, tags: set[str], beyond: set[str] | frozenset[str]) -> None:
        """Pop up to the nearest of some open tags, unless one of `beyond` is nearer."""
        if not any(self._open[tag] for tag in tags):
            return
        for depth in range(len(self._stack) - 1, -1, -1):
            tag = self._stack[depth][0].lstrip("!")
            if tag in tags:
                if tag in _BLOCK:
                    self._flush()
                while len(self._stack) > depth:
                    self._pop()
                return
            if tag in beyond:
                return

    def _end(self, tag: str) -> None:
        if tag in _BLOCK:
            self._flush()
            if self._deeper[tag]:
                self._deeper[tag] -= 1
            elif tag in _TABLE:
                self._close({tag}, {"table"} - {tag})
            elif tag in _HEADINGS:
                self._close(set(_HEADINGS), {"table", "td", "th"})
            else:
                self._close({tag}, {"table", "td", "th", "caption"})
        elif tag in _INLINE:
            self._close({tag}, _BLOCK)

    def _keep(self) -> None:
        """Blocks that may belong to an article, and the containers' sums over them."""
        dropped = [False] * len(self.parent)
        headings_only = [False] * len(self.parent)
        for node in range(1, len(self.parent)):
            above, mark = self.parent[node], self.mark[node]
            headings_only[node] = headings_only[above]
            if mark == HEADER and self.main[above]:
                headings_only[node] = True
            elif mark == HEADER:
                dropped[node] = True
            elif mark == SOFT:
                dropped[node] = not self.holds_main[node]
            dropped[node] |= dropped[above]
        self.blocks = [
            b
            for b in self.blocks
            if not dropped[b.node] and (b.heading or not headings_only[b.node])
        ]
        self.total, self.prose = [0] * len(self.parent), [0] * len(self.parent)
        for block in self.blocks:
            self.total[block.node] += len(block.text)
            self.prose[block.node] += max(0, len(block.text) - 3 * block.linked)
        for node in range(len(self.parent) - 1, 0, -1):
            self.total[self.parent[node]] += self.total[node]
            self.prose[self.parent[node]] += self.prose[node]

    def best(self) -> int:
        """Container with the largest share of the page's prose and the least else; ties: inner."""
        if not self.prose[0]:
            return 0
        scores = [
            (p * p / (t * self.prose[0]) * self.bonus[k], k)
            for k, (p, t) in enumerate(zip(self.prose, self.total))
            if p and self.container[k]
        ]
        return max(scores)[1]

    def name(self, node: int) -> str:
        """Path of a node; the page itself has the empty one."""
        names = {number: (above, step) for (above, step), number in self.steps.items()}
        steps, path = [], self.path[node]
        while path:
            path, step = names[path]
            steps.append(step)
        return "/".join(reversed(steps))

    def nodes(self, path: str) -> list[int]:
        """Containers at a path that are mostly prose."""
        number = 0
        for step in path.split("/") if path else []:
            number = self.steps.get((number, step))
            if number is None:
                return []
        return [
            k
            for k, own in enumerate(self.path)
            if own == number and self.container[k] and 2 * self.prose[k] > self.total[k]
        ]

    def text(self, nodes: list[int]) -> str:
        """All kept blocks inside some nodes, in page order."""
        inside = [False] * len(self.parent)
        for node in nodes:
            inside[node] = True
        for node in range(1, len(self.parent)):
            inside[node] |= inside[self.parent[node]]
        return " ".join(b.text for b in self.blocks if inside[b.node])


def _main(page: Page, winners: list[str]) -> tuple[str, str]:
    """Path and text by the paths of the host, most votes first."""
    own = page.best()
    name = page.name(own)
    # A page that agrees with a path of its host is read by it, though another one has more votes.
    for path in [name, *winners] if name in winners else winners:
        if nodes := page.nodes(path):
            return path, page.text(nodes)
    return name, page.text([own])


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, paths): the paths that one of SHARE pages of a host votes for, most votes first.

    Pages without a host have no vote; an empty page votes for the page as a whole.
    """
    rows = pages.select(F.col(url).alias("url"), F.col(html).alias("html"))
    rows = with_parts(rows).filter("host <> ''").select("host", "html")
    votes = rows.mapInArrow(released(_votes), "host string, path string, votes long")
    votes = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    won = votes.join(totals, "host").filter(F.col("votes") * SHARE >= F.col("total"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("votes"), "path")))
    return won.groupBy("host").agg(order["path"].alias("paths"))


def main_texts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, path) for each row of `pages` (page_id, url, html).

    `text` is the article without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles, hidden parts, markup and reader comments; a header inside an article keeps its headings.
    Character references are decoded, white space (Unicode's) inside a block becomes one space, and
    blocks are joined by a space in page order. `n_chars` counts code points, `path` is the one that
    the page was read by.

    NULL html is an empty page with an empty text. A NULL url has no host, so that its page is read by
    its own best container. Repeated rows give repeated results; other columns are ignored. A page is
    parsed in one piece, in time linear in its length.
    """
    winners = staged(host_paths(pages, url, html))
    rows = pages.select("page_id", F.col(url).alias("url"), F.col(html).alias("html"))
    # The written table has a known size: a small one is broadcast, else hot hosts are split.
    joined = with_parts(rows).join(winners, "host", "left")
    return joined.select("page_id", "url", "html", "paths").mapInArrow(
        released(_texts),
        f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, "
        "n_chars long, path string",
    )


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple[str, str], int] = defaultdict(int)
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = Page(source.as_py() or "")
            votes[host, page.name(page.best())] += 1
        columns = [pa.array([k[i] for k in votes], pa.string()) for i in (0, 1)]
        yield pa.record_batch(
            [*columns, pa.array(votes.values(), pa.int64())], names=["host", "path", "votes"]
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, sources, winners = batch.columns
        found = [
            _main(Page(source.as_py() or ""), paths.as_py() or [])
            for source, paths in zip(sources, winners)
        ]
        yield pa.record_batch(
            [ids, urls, pa.array([t for _, t in found], pa.string()),
             pa.array([len(t) for _, t in found], pa.int64()),
             pa.array([p for p, _ in found], pa.string())],
            names=["page_id", "url", "text", "n_chars", "path"],
        )
