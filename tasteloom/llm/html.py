"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped to lines: a block element begins a new line. What is never article text
(scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms, reader comments)
leaves ``WINDOW`` empty lines, and so does the beginning and the end of ``article`` and ``main``.
Over the lines the weighted text lengths in a sliding window of ``WINDOW`` lines are summed.
Where the sum rises from nothing is a surge, where it falls to nothing a dive; the text between
is kept if the sum reaches ``SURGE`` on the way. If no sum does, the stretch with most text is.

``article`` and ``main`` are weights in these sums, on every page. On a page without them a
character weighs 1. Beside them, a stretch outside weighs half, and nothing if some article has
as much text. A character of an article weighs ``SURGE``, so that its short parts and headings
reach the level too; it weighs 1 if the article has less than ``STORY`` characters and a stretch
outside is kept (then the marks are on cards or comments).

Pages are independent: one Arrow pass, no shuffle.

Defined cases: null or empty html gives an empty text; broken markup is read to its end (an
open comment or script hides the rest; after a tag whose quotes never close, quotes no longer
hide a ``>``); the time is linear in the html's length whatever it holds; repeated rows are each extracted; null ids and urls
are carried through; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tasteloom.llm.base import arrow_map

WINDOW = 3
#: Characters that a window must reach.
SURGE = 40
#: Characters from which a marked article keeps its weight beside a longer story.
STORY = 2 * SURGE

# HTML element names and the usual names of page parts.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "audio button canvas datalist dialog iframe map noembed noframes noscript object script select "
    "style svg template textarea title video".split()
)
BOILERPLATE = frozenset("aside footer form header menu nav".split())
RAW = re.compile(r"<(script|style|textarea|title|iframe|noembed|noframes)\b", re.I)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
PARTS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice pager pagination popup promo related respond search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements that name a whole page or article, whatever class they have.
ROOTS = frozenset("html body main".split())

_OTHER = r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
_NAME = r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
TAG = re.compile(rf"{_OTHER}|{_NAME}(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<over>>?)", re.S)
#: Without regard to quotes.
LOOSE = re.compile(rf"{_OTHER}|{_NAME}(?P<more>[^>]*)(?P<over>>|\Z)", re.S)
ATTRIBUTE = re.compile(
    r"""(?P<key>[^\s=/>"']+)(?:\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s"'>]+)))?"""
)


def _attributes(more: str) -> dict[str, str]:
    return {
        m["key"].lower(): unescape(m["a"] or m["b"] or m["c"] or "") for m in ATTRIBUTE.finditer(more)
    }


def _is_part(name: str, more: str, in_article: bool) -> bool:
    """Whether an element is some page part other than the article."""
    if name in BOILERPLATE and not (name == "header" and in_article):
        return True
    if not more or name in ROOTS or (name == "article" and not in_article):
        return False
    found = _attributes(more)
    if "hidden" in found or found.get("role", "").lower() in ROLES:
        return True
    named = f"{found.get('class', '')} {found.get('id', '')}".lower()
    return not PARTS.isdisjoint(re.split(r"[^a-z0-9]+", named))


class _Open:
    """The open elements, and for each name and for blocks the places where they are open."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool]] = []  # and whether they hide what is in them
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, hides: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, hides))

    def pop(self) -> tuple[str, bool]:
        name, hides = self.stack.pop()
        self.places[name].pop()
        if name in BLOCKS:
            self.blocks.pop()
        return name, hides

    def left_by(self, name: str) -> int:
        """How many elements stay open after an end tag."""
        at = self.places.get(name)
        # The end of an inline element doesn't close blocks.
        if not at or (name not in BLOCKS and self.blocks and self.blocks[-1] > at[-1]):
            return len(self.stack)
        return at[-1]

    def left_before(self, name: str) -> int:
        """How many stay open before an element that ends an open one of its kind."""
        in_kind = self.blocks and self.stack[self.blocks[-1]][0] == name
        return self.blocks[-1] if in_kind else len(self.stack)


def lines_of(html: str, hiding_parts: bool = True) -> list[tuple[str, int]]:
    """Lines of text, each with the number of the outermost marked article it lies in, or 0;
    removed parts and the limits of articles leave gaps.

    Without ``hiding_parts`` the parts that only their names tell leave gaps around them.
    """
    out: list[tuple[str, int]] = []
    line: list[str] = []
    open_ = _Open()
    parts: list[int] = []  # places of parts that are shown
    hiding = articles = marks = at = 0
    tag = TAG

    def close(gap: bool = False) -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append((text, marks if articles else 0))
        if gap:
            out.extend([("", 0)] * WINDOW)

    def pop() -> None:
        nonlocal hiding, articles
        marked = open_.stack[-1][0] in ("article", "main")
        shown = bool(parts) and parts[-1] == len(open_.stack) - 1
        if marked or shown:
            close(gap=not hiding)
        if shown:
            parts.pop()
        _, hides = open_.pop()
        hiding -= hides
        articles -= marked
        if hides and not hiding:
            close(gap=True)

    size = len(html)
    while at < size:
        found = tag.search(html, at)
        if found and found["name"] and not found["over"] and tag is TAG:
            # Quotes that never close hide the rest: from here on they are not looked at.
            tag = LOOSE
            found = tag.match(html, found.start())
        text = html[at : found.start()] if found else html[at:]
        if text and not hiding:
            line.append(unescape(text))
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        more = found["more"]
        if name in BLOCKS:
            close()
        elif name == "br" and not hiding:
            line.append(" ")
        if found["end"]:
            left = open_.left_by(name)
            while len(open_.stack) > left:
                pop()
            continue
        if RAW.match(html, found.start()):
            over = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = over.end() if over else size
            continue
        if name in VOID or more.endswith("/") and name not in BLOCKS:
            continue
        if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
            # These end where the next of their kind begins.
            while (left := open_.left_before(name)) < len(open_.stack):
                while len(open_.stack) > left:
                    pop()
        part = not hiding and _is_part(name, more, articles > 0)
        hides = name in HIDDEN or (part and hiding_parts)
        marked = name in ("article", "main")
        if (hides or part or marked) and not hiding:
            close(gap=not hides)
        if part and not hides:
            parts.append(len(open_.stack))
        open_.push(name, hides)
        hiding += hides
        marks += marked and not articles
        articles += marked
    close()
    return out


def stretches(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(surge, dive, highest window sum): where the window sums rise from and fall to nothing."""
    out, start, top, window = [], None, 0, 0
    for i, length in enumerate(lengths + [0] * WINDOW):
        before = window
        window += length - (lengths[i - WINDOW] if i >= WINDOW else 0)
        if before == 0 and window > 0:
            start, top = i, 0
        top = max(top, window)
        if before > 0 and window == 0:
            out.append((start, i - WINDOW + 1, top))
    return out


def weighted(lines: list[tuple[str, int]]) -> list[int]:
    """The length of every line times twice its weight."""
    lengths = [len(text) for text, _ in lines]
    marked: dict[int, int] = {}
    for length, (_, mark) in zip(lengths, lines, strict=True):
        if mark and length:
            marked[mark] = marked.get(mark, 0) + length
    heaviest = max(marked.values(), default=0)
    apart = [0 if mark else length for length, (_, mark) in zip(lengths, lines, strict=True)]
    out, beside = [0] * len(lines), False
    for a, b, top in stretches(apart):
        if not marked:
            out[a:b] = [2 * length for length in apart[a:b]]
        elif sum(apart[a:b]) > heaviest:
            out[a:b] = apart[a:b]
            beside = beside or top >= 2 * SURGE
    for i, (_, mark) in enumerate(lines):
        if mark:
            out[i] = 2 * lengths[i] * (SURGE if marked.get(mark, 0) >= STORY or not beside else 1)
    return out


def chosen(lines: list[tuple[str, int]]) -> list[tuple[int, int]]:
    """The stretches of lines to keep."""
    kept = [(a, b) for a, b, top in stretches(weighted(lines)) if top >= 2 * SURGE]
    if kept:
        return kept
    lengths = [len(text) for text, _ in lines]
    found = [(a, b) for a, b, _ in stretches(lengths)]
    return [max(found, key=lambda s: sum(lengths[s[0] : s[1]]))] if found else []


def main_text(html: str | None) -> str:
    lines = lines_of(html or "")
    return " ".join(text for a, b in chosen(lines) for text, _ in lines[a:b] if text)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        return pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )

    return arrow_map(
        pages.select("page_id", "url", "html"),
        step,
        "page_id bigint, url string, text string, n_chars bigint",
        "html",
    )
