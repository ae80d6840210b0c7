"""Main text of web pages by line-block distribution.

The page is read once by the standard library's HTML parser. Markup is stripped and every block element becomes a line.
A line's *length* counts its characters outside links; lines inside page furniture (menus, page headers, footers,
sidebars, forms, adverts, notices, reader comments, hidden parts) have length 0, so they cut the distribution. A form is furniture unless a marked element
begins in it, or it holds a window of the threshold and more than half of the page's text: then it is a form around the page, and only its controls go.
A class or id name marks furniture if it holds a word of ``NAMES`` and otherwise only words that say nothing of the contents (``GENERIC``, numbers);
a word of ``NAMES`` next to others (``login-guide``) only lowers the length of unmarked lines, ``MARK`` times. The lengths
are summed over sliding windows of ``WINDOW`` lines. A run of lines goes on until a whole window is empty. Its *surge* is the
first line from which a window ahead reaches the threshold, its *dive* the last line at which a window behind does. Text
between surge and dive is kept, in page order. The threshold is ``SURGE`` characters (or the longest line of a shorter page).

Marks (``article``, ``main`` or that role) are a weight: on a page that has them, marked lines count ``MARK`` times, links
included, and the threshold is as many times higher, so unmarked text needs that much more to be kept and a marked teaser
next to a long unmarked text is not the article.

Short lines stay with their text: a marked element that holds a kept line is kept whole, and a kept region goes on to either
side over the lines of its container (the innermost ``div``, ``section``, ... around the region; directly below ``body`` only
lines that stand there too), up to furniture. Lines of links alone do not extend a region, nor do stray short lines elsewhere.

Lines are joined by a blank line; character references are decoded and white space inside a line becomes one space.

Scale: one narrow pass in Arrow batches cut to a few megabytes; no shuffle; time in proportion to the bytes of the page.

Defined results: null and empty html, and pages without a kept line, give the empty text. Unclosed or crossed tags,
stray ``<`` and truncated pages are read as the parser finds them. Repeated rows each give a row. Windows that reach the threshold exactly count. An empty table gives no
rows; pages of any length are read whole. Columns other than the id, the address and the html are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import pieces

WINDOW = 3
SURGE = 80
MARK = 4

BLOCKS = frozenset(
    "address article aside blockquote body caption center datalist dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose lines belong together.
CONTAINERS = frozenset("article body center details div html main section td".split())
FLAT = frozenset(("body", "html"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold article text.
FURNITURE = frozenset(
    "aside button canvas datalist dialog footer head iframe input label legend math menu nav noscript object option script select style svg template textarea title".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words in class or id that mark furniture (fixed list).
NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login"
    " menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply share sharing"
    " sidebar signup skyscraper social sponsor sponsored subscribe teaser toolbar widget".split()
)
#: Words that say where or how large an element is, or what kind, but nothing of what it holds (fixed list).
GENERIC = frozenset(
    "a area article bar block body bottom box btn button center col column container content embed entry facebook fixed form full google group header"
    " heading holder icon icons image inline inner item items label large leaderboard left line link links list main media medium message middle mobile module"
    " mpu news outer overlay page panel placeholder policy post posts primary rectangle right row section secondary side site slot small social space sticky"
    " stories story strip sub tag tags text the title top twitter unit up view window wrap wrapper x zone".split()
)
#: Elements (all furniture) in which markup other than their end is text; the parser knows script and style itself.
RAW_TEXT = frozenset(("iframe", "textarea", "title"))
HEADERS = frozenset(("header", "masthead"))
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _marks(attributes: dict[str, str | None]) -> tuple[set[str], bool, bool]:
    """Words of class and id; whether a name marks furniture, and whether one has a word of furniture next to others. A word after no, has or with says
    what is around, not what this is."""
    out: set[str] = set()
    strong = weak = False
    for key in ("class", "id"):
        for name in (attributes.get(key) or "").split():
            found = _WORD.findall(_CAMEL.sub("-", name).lower())
            own = {w for w, before in zip(found, ["", *found], strict=False) if before not in ("no", "has", "with", "without")}
            if not NAMES.isdisjoint(own):
                others = {w for w in found if w not in NAMES and w not in GENERIC and not w[0].isdigit()}
                strong, weak = strong or not others, weak or bool(others)
            out |= own
    return out, strong, weak


class Container:
    """An element whose lines are lines[first:last] of the page, with the innermost form around it."""

    def __init__(self, outer: Container | None, first: int, flat: bool, marked: bool, form: int | None = None, weak: bool = False) -> None:
        self.outer, self.first, self.last, self.flat = outer, first, None, flat
        self.form = form if form is not None else outer and outer.form
        self.weak = weak or bool(outer and outer.weak)
        self.mark = self if marked else outer and outer.mark  # the innermost marked element


class Lines(HTMLParser):
    """Lines of a page: (text, length outside links, inside a marked article), and the container of each line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool]] = []
        self.containers: list[Container] = []
        self.page = Container(None, 0, True, False)
        self.open: list[tuple[str, bool, bool, Container]] = []  # element, in furniture, in article, innermost container
        self.parts: list[str] = []
        self.length = 0
        self.in_link = False
        self.forms: list[bool] = []  # whether a marked element begins in it

    def _state(self) -> tuple[bool, bool]:
        return self.open[-1][1:3] if self.open else (False, False)

    def _container(self) -> Container:
        return self.open[-1][3] if self.open else self.page

    def _shut(self, at: int) -> None:
        """Close the open elements from ``at`` on; their lines end here."""
        for _, _, _, container in self.open[at:]:
            container.last = len(self.lines)
        del self.open[at:]
        if self.open:
            self.open[-1][3].last = None

    def end_page(self) -> None:
        self.close()
        self.end_line()
        self._shut(0)
        self.page.last = len(self.lines)

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        furniture, article = self._state()
        if furniture:
            if not self.lines or self.lines[-1][0]:
                self.lines += [("", 0, False)] * WINDOW  # cuts the distribution
                self.containers += [self._container()] * WINDOW
        elif text:
            self.lines.append((text, self.length, article))
            self.containers.append(self._container())
        self.parts, self.length = [], 0

    def _close(self, names: tuple[str, ...], within: frozenset[str]) -> None:
        """Close the innermost of ``names`` unless one of ``within`` is open inside it."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in names:
                self._shut(at)
                return
            if self.open[at][0] in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.in_link = True
        if tag in ("br", "img"):
            self.parts.append(" ")
        if tag in BLOCKS:
            self.end_line()
            self._close(("p",), BLOCKS - {"p"})
            if tag == "li":
                self._close(("li",), frozenset(("ul", "ol", "menu", "nav", "div", "section", "article")))
        if tag in VOID:
            return
        furniture, article = self._state()
        weak = False
        given = dict(attrs)
        role = (given.get("role") or "").lower()
        if not furniture and tag not in ("html", "body"):
            named = ("class" in given or "id" in given) and tag not in ("article", "main")
            marks, strong, weak = _marks(given) if named else (frozenset(), False, False)
            page_header = tag == "header" or not HEADERS.isdisjoint(marks)
            furniture = (
                tag in FURNITURE
                or role in ROLES
                or "hidden" in given
                or given.get("aria-hidden") == "true"
                or strong
                or (page_header and not article and tag not in ("h1", "h2", "h3"))
            )
        marked = not furniture and (tag in ("article", "main") or role in ("article", "main"))
        article = not furniture and (article or marked)
        if (marked or (furniture, article) != self._state()) and tag not in BLOCKS:
            self.end_line()
        container = self._container()
        if marked and container.form is not None:
            self.forms[container.form] = True
        if tag == "form" and not furniture:
            self.forms.append(False)
            container = Container(container, len(self.lines), container.flat, False, len(self.forms) - 1, weak)
        elif marked or ((tag in CONTAINERS or weak) and not furniture):
            container = Container(container, len(self.lines), tag in FLAT, marked, weak=weak)
        self.open.append((tag, furniture, article, container))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in ("br", "img"):
            self.end_line() if tag in BLOCKS else self.parts.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in BLOCKS:
            self.end_line()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if tag not in BLOCKS and self.open[at][1:] != (self.open[at - 1][1:] if at else (False, False, self.page)):
                    self.end_line()
                self._shut(at)
                return
            if tag not in BLOCKS and self.open[at][0] in BLOCKS:
                return  # an inline end tag never closes a block

    def parse_comment(self, i: int, report: bool = True) -> int:
        """The end of the comment at ``i``, asked for where the parser reads text or tags (not in scripts, styles or attribute values)."""
        if self.open and self.open[-1][0] in RAW_TEXT:  # no comments in there
            return i + len("<!--")
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)  # a comment that is never closed hides the rest

    def handle_data(self, data: str) -> None:
        furniture, _ = self._state()
        if not furniture:
            self.parts.append(data)
            if not self.in_link:
                self.length += len(data.strip())


def regions(lengths: list[int], threshold: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """[first, last) ranges between surge and dive points of the windowed line lengths."""
    n = len(lengths)
    ahead = [sum(lengths[i : i + window]) for i in range(n)]
    behind = [sum(lengths[max(0, i - window + 1) : i + 1]) for i in range(n)]
    out, at = [], 0
    while at < n:
        if not lengths[at]:
            at += 1
            continue
        end = at + 1  # the run goes on until a whole window is empty
        while end < n and ahead[end]:
            end += 1
        surge = next((i for i in range(at, end) if lengths[i] and ahead[i] >= threshold), None)
        dive = next((i for i in range(end - 1, at - 1, -1) if lengths[i] and behind[i] >= threshold), None)
        if surge is not None and dive is not None and surge <= dive:
            out.append((surge, dive + 1))
        at = end
    return out


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.end_page()
    lines, containers = without_forms(parser), parser.containers
    marked = [MARK * len(text) if article else 0 for text, _, article in lines]
    others = [0 if article else length // MARK if c.weak else length for (_, length, article), c in zip(lines, containers, strict=True)]
    threshold = max(1, min(MARK * SURGE if any(marked) else SURGE, max(map(max, marked, others), default=0)))
    keep = bytearray(len(lines))
    elements = {containers[i].mark for a, b in regions(marked, threshold) for i in range(a, b) if marked[i]}
    found = [(e.first, e.last) for e in elements] + extended(regions(others, threshold), lines, containers)
    for a, b in found:
        keep[a:b] = b"\1" * (b - a)
    return "\n\n".join(text for (text, _, _), kept in zip(lines, keep, strict=True) if kept and text)


def without_forms(parser: Lines) -> list[tuple[str, int, bool]]:
    """The page's lines; those of forms are empty, but for forms around the page's text."""
    lines, of = parser.lines, [c.form for c in parser.containers]
    kept = set()
    for form, marked in enumerate(parser.forms):
        own = [length if f == form else 0 for (_, length, _), f in zip(lines, of, strict=True)]
        around = 2 * sum(own) > sum(length for _, length, _ in lines) and max(sum(own[i : i + WINDOW]) for i in range(len(own))) >= SURGE
        if marked or around:
            kept.add(form)
    return [("", 0, False) if f is not None and f not in kept else line for line, f in zip(lines, of, strict=True)]


def extended(found: list[tuple[int, int]], lines: list[tuple[str, int, bool]], containers: list[Container]) -> list[tuple[int, int]]:
    """The regions with the adjoining unmarked lines of their containers, up to a cut, a window of links or the next region."""
    texts = [0, *accumulate(bool(text) for text, _, _ in lines)]
    out = []
    for n, (first, last) in enumerate(found):
        around = containers[first]
        while around.last < last:
            around = around.outer
        alone = texts[around.last] - texts[around.first] == texts[last] - texts[first]
        if alone and not around.flat and not around.outer.flat:
            around = around.outer  # a region with an element of its own goes with the lines around that
        ends = []
        for at, step, stop in ((first, -1, out[-1][1] - 1 if out else -1), (last - 1, 1, found[n + 1][0] if n + 1 < len(found) else len(lines))):
            end, links, own = at, 0, containers[at]
            for i in range(at + step, stop, step):
                text, length, article = lines[i]
                links = 0 if length else links + 1
                inside = containers[i] is own if around.flat else around.first <= i < around.last
                if not text or article or not inside or links >= WINDOW:
                    break
                end = i if length else end
            ends.append(end)
        out.append((ends[0], ends[1] + 1))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html", 4_000_000):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
