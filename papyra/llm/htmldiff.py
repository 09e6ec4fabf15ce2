"""HTML extraction by nearest-URL page differencing.

A page is cut into text lines, one for each block of markup. Pages of one host with equal lines count as one. Within each
host they are put in order of URL path, and each is differenced against its nearest neighbours, two on either side. The
lines of a pair are aligned by their longest common subsequence. A neighbour whose alignment holds ``COPY_SHARE`` of
the page's own text is a copy of it and has no vote. A line is template, and is deleted, if half of the voting
neighbours share it; inside the article all of three voters or more must share it, as pages of one host quote one
another. Where all neighbours are copies, lines that every one of them shares are deleted, unless nothing is left
or the page has an article.

Markup decides what differencing leaves open: lines of containers that say what they are (nav, header, footer, aside,
form and the like, or a class, id or role such as ad, sidebar, cookie, comments) are no text, also where no
neighbour has them; and where an article or main element holds half of the remaining text or more, that is the text.

Pages are dealt by blocks of ranks with two rows of overlap, so a host with any share of the pages is dealt evenly. Only
hashes of lines travel; the pages themselves stay where they are unless lines have to be deleted from more pages
than ``BROADCAST_PAGES``, beyond which they are joined by a shuffle.

Nulls and empties: a null or empty html gives an empty text; pages with a null url are a host of their own; a null page_id
is carried. Rows that repeat page, url and html get the same text. Extra columns are ignored. An empty
table gives an empty result. Markup that never ends (a quote, comment or tag) is read as browsers do, in one pass; a tag
without its end is text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, deal, slices
from papyra.operators.ranks import global_row_number
from papyra.shared import written

SLICE_BYTES, COPY_SHARE, BROADCAST_PAGES, NEAR, UNANIMOUS, BLOCK_PAGES = 2 << 20, 0.8, 50_000, 2, 3, 64
PLAIN, CHROME, ARTICLE = 0, 1, 2
# Elements and attribute words of HTML pages.
DROPPED = frozenset("nav header footer aside form script style template noscript iframe button select textarea svg object dialog menu head title".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs header footer masthead comment comments disqus reply replies share sharing social related newsletter subscribe subscription signup popup modal widget toolbar contentinfo complementary search".split()
)
COMMENTS = frozenset("comment comments reply replies disqus".split())
#: First parts of a compound that turn it round (no-sidebar) or say that a header is the article's own (post-header).
WITHOUT = frozenset("no non not without has with hide".split())
OWN = frozenset("article post entry story content page".split())
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_KEY = re.compile(r"[\s/]*([^\s=/>]*)\s*")
_SPACE = re.compile(r"\s*")
_BARE = re.compile(r"[^\s>]*")
_PARTS = re.compile(r"[^a-z0-9]+")


def _marks(value: str) -> set[str]:
    """The words that the tokens of a class, id or role stand for: a token itself, or the first or last part of a compound."""
    found = set()
    for token in value.lower().split():
        parts = [p for p in _PARTS.split(token) if p]
        if not parts or (len(parts) > 1 and parts[0] in WITHOUT):
            continue
        found.update(parts[:1] + ([] if parts[0] in OWN and parts[-1] in ("header", "banner", "masthead") else parts[-1:]))
    return found


class _Tag:
    """A tag: its name, whether it closes, the words of its class, id and role, whether it hides, whether it closes itself."""

    __slots__ = ("name", "closing", "marks", "hidden", "slash", "stop")

    def __init__(self, page: str, at: int, name: str, last: dict[str, int], quoted: bool):
        """Read from ``at``, after the name; ``stop`` is the place after the tag, or -1 if it has no end."""
        self.name, self.closing, self.marks, self.hidden, self.slash, self.stop = name.lstrip("/").lower(), name[0] == "/", set(), False, False, -1
        while at < len(page):
            key = _KEY.match(page, at)
            self.slash, word, at = "/" in page[at : key.start(1)], key[1].lower(), key.end()
            if word == "hidden":
                self.hidden = True
            if page[at : at + 1] == ">":
                self.stop = at + 1
                return
            if page[at : at + 1] != "=":
                continue
            at = _SPACE.match(page, at + 1).end()
            quote = page[at : at + 1]
            if quoted and quote in last and last[quote] > at:
                end = page.index(quote, at + 1)
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare[0], bare.end()
            if word in ("class", "id", "role"):
                self.marks |= _marks(value)


def _tags(page: str) -> Iterator[tuple[str, _Tag | None]]:
    """Each stretch of text with the tag after it, if that is one; comments, declarations and raw elements are passed over."""
    last = {c: page.rfind(c) for c in ('"', "'")}
    end, start, quoted = page.rfind(">"), 0, True
    at = page.find("<")
    while at >= 0:
        tag = None
        if page[at + 1 : at + 2] in ("!", "?"):
            comment = page.startswith("<!--", at)
            stop = page.find("-->" if comment else ">", at + 2)
            stop = len(page) if stop < 0 else stop + (3 if comment else 1)
        else:
            name = _NAME.match(page, at + 1)
            tag = _Tag(page, name.end(), name[0], last, quoted) if name and end > at else None
            if tag is None or tag.stop < 0:
                # No tag, or quotes swallow its end: from then on quotes mean nothing, so this happens once.
                if tag is not None and quoted:
                    quoted = False
                    continue
                at = page.find("<", at + 1)
                continue
            stop = tag.stop
            if tag.name in RAW and not tag.closing and not (tag.slash and tag.name in ("svg", "iframe")):
                past = re.compile(rf"</{re.escape(tag.name)}(?=[\s/>])[^>]*>", re.I).search(page, stop)
                stop = past.end() if past else len(page)
        yield page[start:at], tag
        start = stop
        at = page.find("<", start)
    yield page[start:], None


def lines_of(page: str) -> tuple[list[tuple[str, int]], bool]:
    """The text lines, each with its kind (PLAIN, CHROME or ARTICLE), and whether an article or main element has any."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    chrome: list[list] = []  # open containers that are no text: name, depth
    inside: list[tuple[str, int]] = []  # open article and main elements, with how many containers were open

    def close():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, CHROME if len(chrome) > (inside[-1][1] if inside else 0) else ARTICLE if inside else PLAIN))
            parts.clear()

    for text, tag in _tags(page):
        parts.append(text)
        if tag is None or (tag.name in RAW and tag.name not in BLOCKS):
            continue
        name, closing = tag.name, tag.closing
        if chrome and chrome[-1][0] == "p" and not closing and name in BLOCKS:
            close()
            chrome.pop()  # an open paragraph ends at the next block
        if name in BLOCKS:
            close()
        elif name == "br":
            parts.append(" ")
        if chrome and name == chrome[-1][0] and name not in VOID:
            chrome[-1][1] += -1 if closing else 1
            if chrome[-1][1] <= 0:
                close()
                chrome.pop()
            continue
        if closing:
            if name in ("article", "main") and any(n == name for n, _ in inside):
                while inside.pop()[0] != name:
                    pass
            continue
        whole = name in ("article", "main", "body", "html")
        says = tag.marks & (COMMENTS if name == "article" else frozenset() if whole else WORDS)
        if tag.hidden or says or (name in DROPPED and not (name == "header" and inside)):
            if name not in VOID and name not in RAW:
                close()
                chrome.append([name, 1, tag.hidden or name in DROPPED])
        elif name in ("article", "main") and not (chrome and any(c[2] for c in chrome)):
            inside.append((name, len(chrome)))
    close()
    return out, any(kind == ARTICLE for _, kind in out)


def _hashes(lines: list[tuple[str, int]]) -> np.ndarray:
    """A menu's line is never that of a text, whatever it says."""
    return np.array([xxhash.xxh3_64_intdigest(x, int(kind == CHROME)) for x, kind in lines], np.uint64).view(np.int64)


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of a with each prefix of b, by bit-parallel rows."""
    m = len(b)
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << m) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    zeros = np.unpackbits(np.frombuffer((v ^ full).to_bytes(m // 8 + 1, "little"), np.uint8), bitorder="little")[:m]
    return np.concatenate([[0], np.cumsum(zeros)])


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of a and b, in memory that grows with their length."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    head = [(k, k) for k in range(low)]
    a, b = a[low:], b[low:]
    high = 0
    while high < min(len(a), len(b)) and a[-1 - high] == b[-1 - high]:
        high += 1
    tail = [(low + len(a) - high + k, low + len(b) - high + k) for k in range(high)]
    a, b = a[: len(a) - high], b[: len(b) - high]
    middle: list[tuple[int, int]] = []
    work = [(a, b, 0, 0)]
    while work:
        x, y, i, j = work.pop()
        if not x or not y:
            continue
        if len(x) == 1:
            if x[0] in y:
                middle.append((i, j + y.index(x[0])))
            continue
        half = len(x) // 2
        best = _prefix_lengths(x[:half], y) + _prefix_lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int(best.argmax())
        work += [(x[:half], y[:cut], i, j), (x[half:], y[cut:], i + half, j + cut)]
    return head + sorted((low + i, low + j) for i, j in middle) + tail


def _place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; a URL that can't be parsed is a path on the empty host."""
    if url is None:
        return "", ""
    try:
        parts = urlsplit(url.strip())
        return (parts.hostname or "").lower(), f"{parts.path}?{parts.query}"
    except ValueError:
        return "", url


def _body(kinds: list[int], sizes: list[int]) -> int:
    """The kind of line that is the text: ARTICLE where articles hold half of what is not CHROME or more, else PLAIN, which then stands for both."""
    article, plain = (sum(s for s, k in zip(sizes, kinds) if k == kind) for kind in (ARTICLE, PLAIN))
    return ARTICLE if article and article >= plain else PLAIN


def template(lines: list[int], kinds: list[int], sizes: list[int], others: list[list[int]]) -> list[int]:
    """Places of the lines that differencing against the neighbours' lines deletes."""
    body = _body(kinds, sizes)
    own = [k == ARTICLE if body == ARTICLE else k != CHROME for k in kinds]
    whole = sum(s for s, o in zip(sizes, own) if o)
    shared = [{i for i, _ in common(lines, other)} for other in others]
    voters = [s for s in shared if sum(sizes[i] for i in s if own[i]) < COPY_SHARE * whole]
    votes = [sum(i in s for s in voters) for i in range(len(lines))]
    gone = [i for i, v in enumerate(votes) if (v >= UNANIMOUS and v == len(voters) if own[i] and body == ARTICLE else v and 2 * v >= len(voters))]
    if not voters and shared:
        every = set.intersection(*shared)
        left = any(o and i not in every for i, o in enumerate(own))
        gone = [i for i in sorted(every) if not own[i] or (left and body == PLAIN)]
    return gone


def _text(page: str | None, drop: set[int] | frozenset = frozenset()) -> str:
    lines, _ = lines_of(page or "")
    body = _body([k for _, k in lines], [len(t) for t, _ in lines])
    return "\n".join(t for i, (t, k) in enumerate(lines) if i not in drop and (k == ARTICLE if body == ARTICLE else k != CHROME))


def _keyed(pages: DataFrame) -> DataFrame:
    """(page_id, url, key, html): key is a hash of url and html."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.xxhash64("url", "html").alias("key"), F.col("html").cast("binary").alias("html"))


def template_lines(pages: DataFrame) -> DataFrame:
    """(key, shared): for pages with lines that differencing deletes, their places among the page's lines."""

    def cut(batches):
        for part in slices(batches, "html", SLICE_BYTES):
            places = [_place(u) for u in part.column("url").to_pylist()]
            found = [lines_of((page or b"").decode("utf-8", "replace"))[0] for page in part.column("html").to_pylist()]
            lists = [[_hashes(x) for x in found], [[len(t) for t, _ in x] for x in found], [[k for _, k in x] for x in found]]
            whole = [xxhash.xxh3_64_intdigest(x.tobytes() + bytes(k)) - (1 << 63) for x, k in zip(lists[0], lists[2])]
            arrays = [part.column("key"), pa.array([h for h, _ in places], pa.string()), pa.array([p for _, p in places], pa.string()), pa.array(whole, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(x, pa.list_(t)) for x, t in zip(lists, (pa.int64(), pa.int32(), pa.int8()))], ["key", "host", "path", "whole", "lines", "sizes", "kinds"])

    hashed = written(arrow_map(_keyed(pages).select("url", "key", "html"), cut, "key long, host string, path string, whole long, lines array<long>, sizes array<int>, kinds array<byte>"), "html-lines")
    # Pages of a host with equal lines are one page, at the first of their paths.
    same = hashed.groupBy("host", "whole").agg(F.min_by(F.struct("path", "lines", "sizes", "kinds"), F.struct("path", "key")).alias("page"))
    ranked = written(global_row_number(same.select("host", "whole", "page.*"), ["host", "path", "whole"], "rank"), "html-ranks")
    block = F.floor(F.col("rank") / BLOCK_PAGES)
    overlap = F.array_distinct(F.array(F.floor((F.col("rank") - NEAR) / BLOCK_PAGES), block, F.floor((F.col("rank") + NEAR) / BLOCK_PAGES)))
    rows = ranked.select("host", "whole", "lines", "sizes", "kinds", "rank", block.alias("home"), F.explode(overlap).alias("block"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = deal(rows, parts, "block").sortWithinPartitions("block", "rank")

    def differ(batches):
        held: list[tuple] = []  # rows of one block, the last 2 * NEAR + 1 of them
        for batch in batches:
            found = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if held and held[-1][7] != row[7]:
                    found += [judged(held, k) for k in range(max(0, len(held) - NEAR), len(held))]
                    held = []
                held = [*held[-2 * NEAR :], row]
                if len(held) > NEAR:
                    found.append(judged(held, len(held) - NEAR - 1))
            yield out(found)
        yield out([judged(held, k) for k in range(max(0, len(held) - NEAR), len(held))])

    def judged(held, k):
        host, whole, lines, sizes, kinds, _, home, block = held[k]
        near = [held[j] for j in range(max(0, k - NEAR), min(len(held), k + NEAR + 1)) if j != k]
        others = [row[2] for row in near if row[0] == host]
        return (host, whole, template(lines, kinds, sizes, others)) if home == block and others else None

    def out(found):
        found = [f for f in found if f and f[2]]
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.int32()))], ["host", "whole", "shared"])

    found = written(arrow_map(dealt, differ, "host string, whole long, shared array<int>"), "html-shared")
    return hashed.select("key", "host", "whole").distinct().join(found, ["host", "whole"]).groupBy("key").agg(F.min("shared").alias("shared"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_template): one row per page; n_template is how many lines differencing deleted."""
    deleted = written(template_lines(pages), "html-template")
    if deleted.count() <= BROADCAST_PAGES:
        deleted = F.broadcast(deleted)
    joined = _keyed(pages).join(deleted, "key", "left").select("page_id", "url", "html", "shared")

    def run(batches):
        for part in slices(batches, "html", SLICE_BYTES):
            given = zip(part.column("html").to_pylist(), part.column("shared").to_pylist())
            texts = [_text((page or b"").decode("utf-8", "replace"), frozenset(drop or ())) for page, drop in given]
            n = pa.compute.fill_null(pa.compute.list_value_length(part.column("shared")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), n], ["page_id", "url", "text", "n_chars", "n_template"])

    return arrow_map(joined, run, "page_id long, url string, text string, n_chars long, n_template long")
