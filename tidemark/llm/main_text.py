"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block of the page; the text lengths of
a sliding window of lines with text are summed up.  Where the sum surges the
article begins, where it dives the article ends, and all text between is kept.
Short blocks next to a surge belong to it, and surges are joined unless more
link or side text lies between them than the smaller one holds.  Link text
counts nothing, and elements that name themselves menus, headers,
footers, sidebars, notices, adverts, forms or reader comments are taken out
with the scripts and styles before the lines are measured.

An ``article`` or ``main`` element is a prior: on a page that has one, each of
its lines weighs at least a surge and text outside it a quarter.  The
distribution decides on every page whether that is where the article is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Text that a window of lines must hold to be part of a surge; as much link or side text parts blocks.
SURGE = 80
#: What text outside an ``article`` or ``main`` weighs less, on a page that has one.
OUTSIDE = 4
#: Borders without text that two blocks may have between them whatever their length.
NEAR = 2 * WINDOW

MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)"
    r"|<(script|style|template|noscript|svg|iframe|textarea|title|select|object|canvas)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
TOKEN = re.compile(r"\S+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
    "sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BESIDE = frozenset("nav footer aside form menu dialog head button fieldset".split())
BESIDE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar aside rail complementary contentinfo "
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert alertdialog popup modal overlay dialog banner toolbar "
    "comment comments disqus respond replies reactions form search subscribe newsletter signup login "
    "share sharing social related recommended pagination pager widget".split()
)
TOP_NAMES = frozenset("header masthead topbar".split())
COMMENT_NAMES = frozenset("comment comments disqus respond replies reactions".split())
#: Parts of a name that say what an element has or lacks, not what it is.
MODIFIERS = frozenset("with without has have no not hide show content layout".split())
#: Parts after which the one before says what an element is.
FORMS = frozenset(
    "area section list container wrapper wrap box block slot unit inner outer panel bar row col column group item items "
    "link links button buttons icons posts left right top bottom primary secondary main body text".split()
)


@dataclass
class Line:
    text: str
    own: int
    inside: bool
    #: Visible text taken out right before the line.
    side: int = 0


def _beside(tag: str, attributes: str, inside: bool, told: int = 0) -> bool:
    """Whether an element stands beside the article; ``told`` is the length of the ``article``/``main`` text so far.

    The name of an ``article`` or ``main`` does not count, except that of a reader comment below an article's text.
    """
    if tag in BESIDE or (tag == "header" and not inside):
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    if HIDDEN.search(attributes):
        return True
    if tag in ("html", "body", "main"):
        return False
    names = _names(attributes)
    if tag == "article":
        return told >= SURGE and bool(names & COMMENT_NAMES)
    return bool(names & BESIDE_NAMES) or (not inside and bool(names & TOP_NAMES))


def _names(attributes: str) -> set[str]:
    """What an element calls itself: whole class, id and role names, and the last part of each that says what it is.

    Names with a modifier (``with-sidebar``, ``has-comments``, ``menu-open``) describe something else.
    """
    names = set()
    for m in NAMED.finditer(attributes):
        for token in TOKEN.findall("".join(g or "" for g in m.groups())):
            names.add(token.lower())
            parts = [p.lower() for p in PART.findall(token)]
            if MODIFIERS.isdisjoint(parts):
                while len(parts) > 1 and (parts[-1] in FORMS or parts[-1].isdigit()):
                    parts.pop()
                names.update(parts[-1:])
    return names


def page_lines(html: str) -> list[Line]:
    """The page's blocks as lines, without what stands beside the article; empty lines are kept."""
    lines: list[Line] = []
    pieces: list[str] = []
    linked = side = told = 0
    inside: list[str] = []
    anchor = 0
    skip, depth, seen = "", 0, False

    def close() -> None:
        nonlocal linked, side, told
        text = " ".join("".join(pieces).split())
        told += len(text) if inside else 0
        lines.append(Line(text, max(0, len(text) - linked), bool(inside), side))
        pieces.clear()
        linked = side = 0

    def add(raw: str) -> None:
        nonlocal linked, side
        if skip:
            side += len(raw.strip()) if seen else 0
        elif raw:
            text = unescape(raw)
            pieces.append(text)
            if anchor:
                linked += len(text.strip())

    at = 0
    for m in MARKUP.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        if m[3] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag, ends = m[3].lower(), bool(m[2])
        if skip:
            again = tag == skip
            if ends and again:
                depth -= 1
                if not depth:
                    skip = ""
            elif again and skip in ("p", "li", "tr", "td"):
                skip, depth = "", 0
            elif again and not m[4].endswith("/"):
                depth += 1
            elif not ends and tag in ("article", "main") and not _beside(tag, m[4], True, told):
                skip, depth = "", 0  # what was skipped holds the article, or had never been closed
            elif ends and tag in ("body", "html"):
                skip, depth = "", 0
            if skip or (ends and again):
                continue
        if tag == "a":
            anchor = max(0, anchor + (-1 if ends else 1))
        if tag not in INLINE:
            close()
            anchor = 0
        if ends:
            if tag in ("article", "main") and tag in inside:
                inside.remove(tag)
        elif tag not in VOID and not m[4].endswith("/"):
            if _beside(tag, m[4], bool(inside), told):
                if tag in INLINE:
                    close()
                skip, depth, seen = tag, 1, not HIDDEN.search(m[4])
            elif tag in ("article", "main"):
                inside.append(tag)
    add(html[at:])
    close()
    return lines


def surge_and_dive(lines: list[Line]) -> tuple[int, int]:
    """First and one past the last line of the article; ``(0, 0)`` if there is none."""
    lengths = [line.own if 2 * line.own >= len(line.text) else 0 for line in lines]
    if any(line.inside and line.text for line in lines):
        lengths = [
            max(len(line.text), SURGE) * bool(line.text) if line.inside else n // OUTSIDE
            for line, n in zip(lines, lengths, strict=True)
        ]
    # text that parts blocks, up to and including what was taken out before each line
    parted, total = [], 0
    for line, n in zip(lines, lengths, strict=True):
        parted.append(total + line.side)
        total += line.side + (0 if n else len(line.text))
    stretches: list[list[int]] = []
    for k, n in enumerate(lengths):
        if not n:
            continue
        if stretches:
            before = stretches[-1][-1]
            apart = parted[k] - parted[before] >= SURGE or k - before - 1 > max(NEAR, min(n, lengths[before]))
        if not stretches or apart:
            stretches.append([])
        stretches[-1].append(k)
    sums = [max(sum(lengths[k] for k in s[at : at + WINDOW]) for at in range(len(s))) for s in stretches]
    bar = min(SURGE, max(sums, default=0))
    runs: list[tuple[int, int, int]] = []
    for stretch, most in zip(stretches, sums, strict=True):
        if most < bar:
            continue
        runs.append((stretch[0], stretch[-1], sum(lengths[k] for k in stretch)))
        while len(runs) > 1:
            (first, end, held), (begin, last, more) = runs[-2:]
            if parted[begin] - parted[end] >= max(SURGE, min(held, more)):
                break
            runs[-2:] = [(first, last, held + more)]
    if not runs:
        return 0, 0
    best = max(runs, key=lambda r: r[2])
    marked = lambda run: any(line.inside and line.text for line in lines[run[0] : run[1] + 1])
    if marked(best):  # the surges of one article, whatever is set between them
        kept = [run for run in runs if marked(run)]
        return kept[0][0], kept[-1][1] + 1
    return best[0], best[1] + 1


def main_text(html: str | None) -> str:
    lines = page_lines(html or "")
    first, end = surge_and_dive(lines)
    marked = any(line.inside for line in lines[first:end])
    return " ".join(x.text for x in lines[first:end] if x.text and (x.inside or not marked))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per page.

    NULL and empty pages, and pages without a block of text, have the empty
    text.  Markup that is never closed ends with the page.  Repeated rows
    give repeated results, NULL ids and urls are kept, an empty table gives
    an empty result, and other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
