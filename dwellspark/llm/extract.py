"""Main text of web pages by tag-path ratios.

The text of a page lies in blocks, each at the end of a path of tags from the root. For every path
the length of its texts and their punctuation are related to the number of its blocks. A block has
the ratios of its path; both are smoothed along the page and multiplied. Paths whose blocks lie above
a threshold are content, and so are headings and the other paths of the same container (a short last
line), except paths of nothing but links, whose ratio is 0. Paths through elements that by kind or name are no article (menus, adverts, forms) have ratio
0; a name does not count where the element holds most of the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.tables import whole_text

#: Elements by kind.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers that structure an article; inside it they need no ratio of their own.
PARTS = frozenset("article main section header figure details summary".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
NEVER = frozenset(
    "head script style noscript template iframe object svg canvas math audio video fieldset select textarea button input "
    "option optgroup datalist nav menu footer aside dialog title noembed noframes".split()
)
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre td th tr tbody thead tfoot table figcaption hgroup caption br center address".split())
#: Words in a class, id or role that name what is no article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "copyright disclaimer discussion dialog disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification outbrain pager pagination popup promo promoted promotion recommended related replies respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe taboola toc toolbar tooltip topbar widget widgets".split()
)
#: Words that turn such a name into a statement about the layout ("no-comments").
LAYOUT = frozenset("with without no not has hide".split())
#: Names of reader comments: weight never lifts them, since comments may outweigh their article.
COMMENTS = frozenset("comment comments discussion disqus replies respond".split())
#: Share of the weight of a page, and of an article, above which an element is not barred by its name.
MOST, MOST_INSIDE = 0.5, 0.9
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_EDGE = frozenset("ul ol dl table select div article section main body".split())
#: Blocks on each side that smoothing looks at, and the share of the mean that is the threshold.
RADIUS, THRESHOLD = 2, 0.5
#: Share of the best container's weight from which a container is content.
CONTAINER = 0.25

_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>\x00]*))")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


@dataclass
class Path:
    """A tag path by its last element (the others are those of its parents); ``barred`` if an element on it is never an article, ``container`` without its textual end.

    ``named`` if its last element is by name no article, ``suspect`` if any on it is; ``article`` if it leads
    through an article or main element whose name is not that of a comment or the like; ``textual`` if a
    textual element follows its container; ``block`` is the block element that it is in, by tag.
    """

    name: str
    barred: bool
    inside: bool
    container: int
    parent: int = -1
    named: bool = False
    suspect: bool = False
    article: bool = False
    tag: str = ""
    heading: bool = False
    textual: bool = False
    comments: bool = False
    block: str = ""


def named(words: list[str], names: frozenset[str] = NAMES) -> bool:
    """Whether a class, id or role names what is no article."""
    for word in words:
        parts = {w.lower() for w in _SPLIT.split(word) if w}
        if parts & names and not parts & LAYOUT:
            return True
    return False


@dataclass
class Page:
    paths: list[Path] = field(default_factory=list)
    known: dict[tuple[int, str], int] = field(default_factory=dict)
    #: Path, text and characters in links of each block.
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, parent: int, tag: str, attributes: str) -> int:
        names: list[str] = []
        ids: list[str] = []
        for match in _ATTRIBUTE.finditer(attributes) if "=" in attributes else ():
            found = (match.group(2) or match.group(3) or match.group(4) or "").split()
            (ids if match.group(1).lower() == "id" else names).extend(found)
        label = tag if not names else tag + "." + ".".join(names)
        hidden = bool(attributes) and bool(_HIDDEN.search(attributes))
        if hidden:
            label += "!"
        by_name = tag == "form" or tag not in ("html", "body") and named(names + ids)
        if by_name:
            label += "?"  # an id is no part of a path, but what it bars is
        comments = by_name and tag != "form" and named(names + ids, COMMENTS)
        if comments:
            label += "?"
        key = (parent, label)
        if key not in self.known:
            above = self.paths[parent] if parent >= 0 else Path("", False, False, -1)
            inside = above.inside or tag in ("article", "main")
            article = above.article or tag in ("article", "main") and not by_name
            by_name = by_name and tag not in ("article", "main")
            barred = above.barred or hidden or tag in NEVER or (tag == "header" and not above.inside)
            here = len(self.paths)
            self.known[key] = here
            container = here if tag in BLOCKS - TEXTUAL else above.container
            heading = above.heading or tag in HEADINGS
            textual = container != here and (above.textual or tag in TEXTUAL)
            self.paths.append(
                Path(label, barred, inside, container, parent, by_name, above.suspect or by_name, article, tag, heading, textual, comments, tag if tag in BLOCKS else above.block)
            )
        return self.known[key]


class Scanner:
    """Tags of a page from left to right. What is not found once is not looked for again further on, so
    a page takes time in proportion to its length, whatever is left open in it."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.lost: set[str] = set()

    def find(self, what: str, at: int) -> int:
        if what in self.lost:
            return -1
        found = self.source.find(what, at)
        if found < 0:
            self.lost.add(what)
        return found

    def tags(self) -> Iterator[tuple[int, int, str, bool, str, str]]:
        """Start, end, name, whether it closes, attributes, and text that is kept (of CDATA)."""
        at = 0
        while match := _OPEN.search(self.source, at):
            start, mark = match.start(), match.group()
            if mark == "<!--":
                end = self.find("-->", match.end())
                at = end + 3 if end >= 0 else len(self.source)
                yield start, at, "", False, "", ""
            elif mark == "<![CDATA[" and (end := self.find("]]>", match.end())) >= 0:
                at = end + 3
                yield start, at, "", False, "", self.source[match.end() : end]
            elif match.group(2) is None:
                end = self.find(">", match.end())
                if end < 0:
                    return
                at = end + 1
                yield start, at, "", False, "", ""
            else:
                end = self.end_of_tag(match.end())
                if end < 0:
                    return
                at = end + 1
                back = yield start, at, match.group(2).lower(), bool(match.group(1)), self.source[match.end() : end], ""
                at = back or at

    def end_of_tag(self, at: int) -> int:
        """Where the tag ends; a quote that is never closed is a character like any other."""
        while stop := _STOP.search(self.source, at):
            if stop.group() == ">":
                return stop.start()
            closed = self.find(stop.group(), stop.end())
            at = closed + 1 if closed >= 0 else stop.end()
        return -1


def read(source: str) -> Page:
    """Blocks of a page with their paths. Unclosed elements end where HTML lets them end."""
    page, stack, text, at = Page(), [], [], 0
    page.path(-1, "html", "")
    begun, linked, blank = 0, 0, True
    opened: Counter[str] = Counter()

    def top() -> int:
        return stack[-1][1] if stack else 0

    def close(i: int) -> None:
        """Ends the elements from place i of the stack on."""
        opened.subtract(t for t, _ in stack[i:])
        del stack[i:]

    def flush() -> None:
        nonlocal linked, blank
        joined = "" if blank else " ".join("".join(text).split())
        if joined:
            page.blocks.append((begun, joined, min(linked, len(joined))))
        text.clear()
        linked, blank = 0, True

    def add(piece: str) -> None:
        nonlocal begun, linked, blank
        if piece:
            if blank:
                begun = top()
            now, first = page.paths[top()], page.paths[begun]
            if now.barred and not first.barred or now.suspect and not first.suspect:
                return  # an inline element that is no article, inside a block that is
            text.append(html.unescape(piece) if "&" in piece else piece)
            blank = blank and not text[-1].strip()
            if opened["a"]:
                linked += len("".join(text[-1].split()))

    scanner = Scanner(source)
    tags = scanner.tags()
    found = next(tags, None)
    while found is not None:
        start, end, tag, closing, attributes, kept = found
        add(source[at:start])
        at, jump = end, None
        if kept:
            add(kept.replace("&", "&amp;"))
        if tag and tag != "html":
            if tag in BLOCKS:
                flush()
            if closing:
                if opened[tag] > 0:
                    i = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                    if any(t in BLOCKS for t, _ in stack[i:]):
                        flush()
                    close(i)
            else:
                jump = _begin(page, source, stack, opened, close, tag, attributes, at)
                at = jump or at
        found = tags.send(jump) if jump else next(tags, None)
    add(source[at:])
    flush()
    return page


def _begin(page: Page, source: str, stack: list, opened: Counter[str], close, tag: str, attributes: str, at: int) -> int | None:
    """Puts an element on the stack; the place to go on from if its content is skipped."""
    if tag in BLOCKS and tag != "br":
        # A block ends an open paragraph.
        for i in range(len(stack) - 1, -1, -1) if opened["p"] > 0 else ():
            if stack[i][0] == "p":
                close(i)
                break
            if stack[i][0] in BLOCKS:
                break
        for i in range(len(stack) - 1, -1, -1) if tag in CLOSED_BY else ():
            if stack[i][0] in CLOSED_BY[tag]:
                close(i)
                break
            if stack[i][0] in LIST_EDGE:
                break
    if tag == "body":
        close(0)
    if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
        return None
    here = page.path(stack[-1][1] if stack else 0, tag, attributes)
    if tag in RAW:
        end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
        return end.end() if end else len(source)
    stack.append((tag, here))
    opened[tag] += 1
    return None


def smooth(values: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * np.arange(-RADIUS, RADIUS + 1) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, mode="full")[RADIUS : RADIUS + len(values)]
    return np.convolve(values, kernel, mode="full")[RADIUS : RADIUS + len(values)] / weight


def ratios(page: Page, blocks: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Path, length and fused ratio of blocks; a path of nothing but links has ratio 0, unless it is a heading or a
    paragraph of an article."""
    paths = np.array([p for p, _, _ in blocks])
    length = np.array([len(t) for _, t, _ in blocks], float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in blocks], float)
    own = [page.paths[p] for p, _, _ in blocks]
    solid = [q.heading or q.inside and q.block == "p" for q in own]
    plain = np.array([s or len("".join(t.split())) > n for s, (_, t, n) in zip(solid, blocks, strict=True)])
    size = len(page.paths)
    count = np.maximum(np.bincount(paths, minlength=size), 1)
    text_ratio = np.bincount(paths, weights=length, minlength=size) / count
    mark_ratio = np.bincount(paths, weights=marks, minlength=size) / count
    some = np.bincount(paths, weights=plain, minlength=size) > 0
    return paths, length, smooth(text_ratio[paths]) * smooth(1 + mark_ratio[paths]) * some[paths]


def barred_paths(page: Page) -> list[bool]:
    """Which paths are no article, by kind or by name.

    A name bars nothing that holds most of the weight (ratio times length): of the text inside
    article or main where the page has some, else of all text. Inside an article it has to be nearly
    all of it, since a wrapper holds all and a part does not. Comments are barred whatever they weigh,
    unless the article or a first heading of the page is in them.
    """
    barred = [p.barred for p in page.paths]
    blocks = [b for b in page.blocks if not barred[b[0]]]
    if not any(page.paths[p].suspect for p, _, _ in blocks):
        return barred
    paths, length, fused = ratios(page, blocks)
    article = np.array([page.paths[p].article for p in paths.tolist()])
    weight = fused * length * (article if article.any() else 1)
    held = np.bincount(paths, weights=weight, minlength=len(page.paths))
    total = held.sum()
    whole = np.zeros(len(page.paths), bool)
    for i in range(len(held) - 1, 0, -1):
        path = page.paths[i]
        held[path.parent] += held[i]
        whole[i] |= path.tag in ("article", "main") and not path.comments or path.tag == "h1"
        whole[path.parent] |= whole[i]
    for i, path in enumerate(page.paths):
        share = MOST_INSIDE if path.inside else MOST
        by_name = path.named and (held[i] <= share * total or path.comments and not whole[i])
        barred[i] = path.barred or by_name or path.parent >= 0 and barred[path.parent]
    return barred


def content(page: Page) -> list[str]:
    """Texts of the content blocks in page order."""
    barred = barred_paths(page)
    blocks = [b for b in page.blocks if not barred[b[0]]]
    if not blocks:
        return []
    size = len(page.paths)
    paths, length, fused = ratios(page, blocks)
    chosen = (fused >= THRESHOLD * fused.mean()) & (fused > 0)
    own = [page.paths[p] for p in paths.tolist()]
    container = np.array([p.container for p in own])
    weight = np.bincount(container + 1, weights=np.where(chosen, fused * length, 0), minlength=size + 1)
    inside = np.array([p.inside for p in own])
    best = weight[container[inside] + 1].max() if inside.any() else weight.max()
    heavy = weight >= CONTAINER * best if best > 0 else np.zeros(size + 1, bool)
    # What stands beside content under one parent as the same element is content, however short.
    whole = {(page.paths[c].parent, page.paths[c].tag) for c in np.flatnonzero(heavy[1:] & (weight[1:] > 0)).tolist()}
    titled = {p.container for p in own if p.heading}
    beside = np.zeros(size + 1, bool)
    for c in set(container.tolist()) - {-1}:
        path = page.paths[c]
        below = path.parent >= 0 and page.paths[path.parent].tag not in ("html", "body")
        beside[c + 1] = (path.parent, path.tag) in whole and (below or c in titled)
    good = (heavy | beside)[container + 1] & (fused > 0)
    if inside.any():
        # The page says where its article is; beside it only what has a heading and outweighs it counts. In
        # it the ratio of a path decides, save for headings and the short text of a container with content.
        part = np.array([c >= 0 and page.paths[c].tag in PARTS for c in container.tolist()])
        textual = np.array([p.textual for p in own])
        heading = np.array([p.heading for p in own])
        apart = np.array([c in titled for c in container.tolist()])
        with_content = part | beside[container + 1] | (weight[container + 1] > 0) & textual
        good = inside & (fused > 0) & (chosen | heading | with_content) | ~inside & good & apart & (weight[container + 1] > 4 * best)
    return [t for (_, t, _), keep in zip(blocks, good, strict=True) if keep]


def main_text(source: str) -> str:
    return "\n".join(content(read(source)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    A null or empty page, or one without content, has an empty text and 0 characters. Repeated rows
    give repeated rows; an empty table stays empty.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", whole_text(F.col("html")).alias("html"))
    return base.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
