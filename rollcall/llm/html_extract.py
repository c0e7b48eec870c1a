"""Main text of web pages: nearest-URL page differencing, then page structure.

Pages are range-sorted by host and path, so a page's neighbours in its task are the pages of the same host with the
nearest paths. The lines (text blocks) of a page and of the neighbour that shares the longer path prefix are
aligned by a longest common subsequence; lines that both have are what the site repeats, and are deleted. Of the
rest, lines inside menus, headers, footers and the like go.

Articles also share lines: quoted passages, licences, whole copies under two addresses. One neighbour cannot tell
them from boilerplate, so a line inside an ``article`` or ``main`` element is deleted only if it is aligned with
WITNESSES of the page's NEIGHBOURS nearest pages. Pages that share half of their main text are versions of one text:
they are no witnesses of each other, and count once. A page that has lines inside these elements consists of those
that are left. On pages without these elements the nearest page alone decides.

Defined cases: null and empty html give an empty text; a null or odd url is a page of the host "" and pairs with others
there; a page alone in its host, or at the edge of a task, is compared with the neighbours it has, or none;
repeated rows are pages of their own. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package

# Names of elements and of roles, classes and ids by their use.
BOILERPLATE_TAGS = frozenset("nav footer aside form button select menu dialog iframe".split())
RAW_TAGS = frozenset("script style noscript template textarea title svg math object head".split())
MAIN_TAGS = frozenset(("article", "main"))
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr"
    " ul".split()
)
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary"
    " consent contentinfo cookie cookies disclaimer footer header masthead menu nav navbar navigation newsletter notice"
    " popup promo promotion related replies reply search share sharing sidebar social sponsor sponsored subscribe"
    " toolbar widget".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes>(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_OPENED = re.compile(r"<[a-zA-Z/!?]")

MAIN, PLAIN, BOILERPLATE = 0, 1, 2
NEIGHBOURS, WITNESSES = 4, 3


def _is_boilerplate(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in BOILERPLATE_TAGS or tag == "header" and not in_main:
        return True
    if not attributes or tag in ("html", "body") or tag in MAIN_TAGS:
        return False
    return any(
        name in BOILERPLATE_NAMES
        for value in _NAMED.findall(attributes)
        for name in re.split(r"[^a-z0-9]+", value.lower())
    )


def page_lines(html: str) -> list[tuple[str, int]]:
    """The text blocks of a page in order, each with the region it stands in."""
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    region, main_depth, skipped, depth, at = PLAIN, 0, "", 0, 0

    def close_block() -> None:
        text = " ".join(html_entities.unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append((text, region))

    # A tag that the page's end cuts off is no text.
    cut = _OPENED.search(html, html.rfind(">") + 1)
    if cut:
        html = html[: cut.start()]
    while at < len(html):
        token = _TOKEN.search(html, at)
        held.append(html[at : token.start()] if token else html[at:])
        if token is None:
            break
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCK_TAGS or tag in RAW_TAGS:
            close_block()
        elif tag == "br":
            held.append(" ")
        closing = bool(token["close"])
        if tag in RAW_TAGS and not closing:
            if not token["attributes"].endswith("/"):
                # The head ends at the body, also if its own end is missing.
                ends = r"</head\b[^>]*>|(?=<body\b)" if tag == "head" else rf"</{tag}\b[^>]*(?:>|\Z)"
                end = re.compile(ends, re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in MAIN_TAGS:
            # Content never lies in boilerplate that was left open before it.
            main_depth = max(0, main_depth + (-1 if closing else 1))
            skipped, depth = "", 0
        elif skipped:
            if tag == skipped and tag not in VOID_TAGS:
                depth += -1 if closing else 1
                if depth == 0:
                    close_block()
                    skipped = ""
        elif not closing and tag not in VOID_TAGS and _is_boilerplate(tag, token["attributes"], main_depth > 0):
            close_block()
            skipped, depth = tag, 1
        region = BOILERPLATE if skipped else MAIN if main_depth else PLAIN
    close_block()
    return lines


def _lcs_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum(row[1:], np.where(b == x, row[:-1] + 1, 0))
        np.maximum.accumulate(row, out=row)
    return row


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``, in linear memory.

    Lines that the other side lacks are left out first, and equal ends are taken as they are.
    """
    a_at, b_at = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    result: list[int] = []

    def solve(x: np.ndarray, y: np.ndarray) -> None:
        front = 0
        while front < min(len(x), len(y)) and a[x[front]] == b[y[front]]:
            result.append(int(x[front]))
            front += 1
        x, y = x[front:], y[front:]
        back = 0
        while back < min(len(x), len(y)) and a[x[-1 - back]] == b[y[-1 - back]]:
            result.append(int(x[-1 - back]))
            back += 1
        x, y = x[: len(x) - back], y[: len(y) - back]
        if not len(x) or not len(y):
            return
        if len(x) == 1:
            if (b[y] == a[x[0]]).any():
                result.append(int(x[0]))
            return
        half = len(x) // 2
        head = _lcs_lengths(a[x[:half]], b[y])
        tail = _lcs_lengths(a[x[half:]][::-1], b[y][::-1])[::-1]
        cut = int((head + tail).argmax())
        solve(x[:half], y[:cut])
        solve(x[half:], y[cut:])

    solve(a_at, b_at)
    return sorted(result)


def _copies(a: list[tuple[str, int]], b: list[tuple[str, int]]) -> bool:
    """Whether half of the main characters of either page stand in the other, too: then they are versions of one text."""
    x, y = ({t for t, r in page if r == MAIN} for page in (a, b))
    common = sum(map(len, x & y))
    return 2 * common >= min(sum(map(len, x)), sum(map(len, y)))


def main_text(lines: list[tuple[str, int]], others: list[list[tuple[str, int]]] | None) -> tuple[str, int]:
    """Text of a page next to its neighbours' lines (nearest first), and the number of lines that differencing deleted."""
    shared: set[int] = set()
    number: dict[str, int] = {}

    def aligned(other: list[tuple[str, int]]) -> list[int]:
        a, b = (np.array([number.setdefault(t, len(number)) for t, _ in x], np.int64) for x in (lines, other))
        return common_lines(a, b)

    votes: Counter[int] = Counter()
    told: list[list[tuple[str, int]]] = []
    for k, other in enumerate(others or []):
        # Copies of the page, or of a neighbour that has voted, are no further witness of what the site repeats.
        votes_too = not any(_copies(other, seen) for seen in (lines, *told))
        if votes_too:
            told.append(other)
        if k == 0 or votes_too:
            common = aligned(other)
            if k == 0:
                shared.update(at for at in common if lines[at][1] != MAIN)
            if votes_too:
                votes.update(at for at in common if lines[at][1] == MAIN)
    shared.update(at for at, n in votes.items() if n >= WITNESSES)
    left = [line for k, line in enumerate(lines) if k not in shared]
    wanted = MAIN if any(r == MAIN for _, r in lines) else PLAIN
    return "\n\n".join(t for t, r in left if r == wanted), len(shared)


def _prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def _nearest(pages, at: int) -> list:
    """Lines of the nearest pages in the host of page ``at``: those whose paths share more with its path come first,
    then those nearer in order (the earlier one on ties)."""
    page = pages[at]
    near = [k for k in range(len(pages)) if k != at and pages[k][2] == page[2]]
    near.sort(key=lambda k: (-_prefix(pages[k][3], page[3]), abs(k - at), k))
    return [pages[k][4] for k in near[:NEIGHBOURS]]


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "path", "html")), strict=True):
                yield *row[:4], page_lines(row[4] or "")

    def told(done):
        ids, urls, texts, counts = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
            names=["page_id", "url", "text", "n_shared"],
        )

    # The page at ``at`` is told once NEIGHBOURS pages after it are held, or the range has ended.
    held, at = [], 0
    done, size = [], 0
    for row in chain(rows(), repeat(None, NEIGHBOURS)):
        if row is not None:
            held.append(row)
        if at == len(held) or row is not None and len(held) - at <= NEIGHBOURS:
            continue
        page = held[at]
        done.append((page[0], page[1], *main_text(page[4], _nearest(held, at))))
        size += len(done[-1][2])
        if len(done) >= 1000 or size > 4_000_000:
            yield told(done)
            done, size = [], 0
        at += 1
        if at > NEIGHBOURS:
            held.pop(0)
            at -= 1
    if done:
        yield told(done)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_shared) of every page. Hosts of any size spread over the ranges of the sort."""
    ship_package(pages.sparkSession)
    url = F.coalesce(F.col("url"), F.lit(""))
    located = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
    )
    order = ["host", "path", "page_id"]
    return (
        located.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_differ, "page_id long, url string, text string, n_shared long")
    )
