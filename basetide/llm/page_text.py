"""Main text of web pages: marked-up regions, and a suffix array per host for what is not marked up.

A page is read into blocks of text, each with the container it stands in. Containers that HTML or their names
declare (``article``, ``main``, ``nav``, ``footer``, ``class="advert"``, ...) decide for themselves: where a page declares its
article, its text is the article without such parts, and passages that several articles share stay, as they are content.

All streams of words, those of articles too, are held against the other pages of the host. Equal streams are one; the streams a task has
are concatenated and their suffixes sorted by prefix doubling up to ``WINDOW`` words; equal leading windows of the partial
arrays meet in one aggregate. Windows on pages of different content are repeated, their union is the host's boilerplate:
blocks inside it go where no article is declared, and so do regions that consist of it by half and more on three pages and more. In
declared articles it is counted only.

Articles hold nearly all words, so their windows go to the aggregate only where they can be repeated: equal windows have the same
least short sequence of words (their anchor, one for some three windows), and anchors of one page content are left out.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import stored
from basetide.plans.lineage import written
from basetide.plans.skew import lookup_join

#: Words of a repeated window. A shorter stream is one window.
WINDOW = 8

# Element names and the words of class, id and role that mark what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody tfoot thead tr ul""".split())
CONTAINER = frozenset("""article aside blockquote body center details dialog dir div dl fieldset figure footer form header hgroup li
    main menu nav ol search section table tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("""nav aside footer form button select fieldset dialog menu object svg canvas audio video template datalist
    search head""".split())
CELL = frozenset(("td", "th"))
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKS = frozenset("""ad ads adv adsense advert adverts advertisement advertisements advertising advertorial sponsor sponsored sponsors
    promo promos promoted promotion banner banners cookie cookies consent gdpr notice notices notification notifications
    disclaimer subscribe subscription newsletter paywall popup popover modal overlay comment comments commentlist disqus replies
    respond sidebar sidebars widget widgets related recommended recommendations trending nav navbar navigation navi menu
    menus breadcrumb breadcrumbs pagination pager toolbar topbar skip footer colophon copyright share sharing social login
    signin signup search searchbox form""".split())
OUTSIDE_MARKS = frozenset("header masthead logo branding".split())  # names that parts of an article have as well
NOT_A_MARK = frozenset("has with no without layout".split())  # has-sidebar names the layout

_TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|/[^a-zA-Z][^>]*(?:>|\Z)"
    r"|(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z))", re.S)
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?![a-zA-Z0-9])[^>]*(?:>|\Z)", re.I) for t in RAW}

#: Open elements that the start of another one ends, innermost first.
_P_ENDS = ("p",)
_ENDS = {"li": ("p", "li"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "dd": ("dd", "dt"), "dt": ("dd", "dt")}

KEEP, HEADINGS, DROP = 0, 1, 2


@dataclass
class Block:
    """A block's text, where it stands, and whether it may be the page's text; level 2: inside an article, 1: inside main."""

    text: str
    path: str
    level: int
    mode: int


@dataclass
class _Open:
    tag: str
    path: str
    level: int
    mode: int
    container: bool = field(default=True)


def _attributes(raw: str) -> dict[str, str]:
    out = {}
    for name, a, b, c in _ATTR.findall(raw):
        out.setdefault(name.lower(), references.unescape(a or b or c).lower())
    return out


def _marked(names: str, inside: bool) -> bool:
    """Whether a word of a class or id says that the element is no article text."""
    for name in names.split():
        words = set(_WORD.findall(name))
        if words & NOT_A_MARK:
            continue
        if words & MARKS or (not inside and words & OUTSIDE_MARKS):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks of text of a page in order. Unclosed, stray and crossed tags are read as browsers do: an end tag closes what is
    open inside its element, one without an element closes nothing."""
    out: list[Block] = []
    stack = [_Open("", "", 0, KEEP)]
    buf: list[str] = []
    leaf = ""

    def flush() -> None:
        if not buf:
            return
        text = " ".join("".join(buf).split())
        buf.clear()
        if text:
            top = stack[-1]
            mode = top.mode if top.mode != HEADINGS else KEEP if leaf in HEADING else DROP
            out.append(Block(text, top.path, top.level, mode))

    def add(text: str) -> None:
        if text:
            buf.append(references.unescape(text) if "&" in text else text)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m.group("start")
        if tag is None:
            tag = m.group("end")
            if tag is None:
                continue
            tag = tag.lower()
            if tag in BLOCK:
                flush()
                leaf = ""
            elif tag in CELL:
                buf.append(" ")
            if len(stack) == 1:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag in CONTAINER:
                        flush()
                    elif stack[k].mode != stack[k - 1].mode:
                        flush()
                    del stack[k:]
                    break
                if stack[k].container and tag not in CONTAINER:
                    break
            continue
        tag = tag.lower()
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else end
            continue
        if tag in BLOCK:
            flush()
            leaf = tag
        elif tag in CELL or tag == "br":
            buf.append(" ")
        for ended in _ENDS.get(tag, _P_ENDS if tag in BLOCK else ()):
            if stack[-1].tag == ended:
                if stack[-1].mode != stack[-2].mode:
                    flush()
                stack.pop()
        if tag in VOID:
            continue
        attrs = m.group("attrs")
        named = _attributes(attrs) if attrs and ("=" in attrs) else {}
        container = tag in CONTAINER
        if not container and not named and tag not in DROPPED:
            continue
        top = stack[-1]
        level, mode = top.level, top.mode
        role, names = named.get("role", ""), f"{named.get('class', '')} {named.get('id', '')}"
        if tag == "article" or role == "article" or "articlebody" in named.get("itemprop", ""):
            level = 2
        elif tag == "main" or role == "main":
            level = max(level, 1)
        if tag in DROPPED or role in DROPPED_ROLES:
            mode = DROP
        elif tag == "header":
            mode = max(mode, HEADINGS if top.level else DROP)
        elif tag in ("article", "main", "body", "html"):
            if tag == "article" and re.search(r"\bcomments?\b", names):
                mode = DROP
        elif named and _marked(names, top.level > 0):
            mode = DROP
        if container or mode != top.mode or level != top.level:
            if mode != top.mode or level != top.level:
                flush()
            label = re.sub(r"\d+", "0", (named.get("class") or named.get("id") or "").split(" ")[0])
            stack.append(_Open(tag, f"{top.path}/{tag}.{label}" if label else f"{top.path}/{tag}", level, mode, container))
    flush()
    return out


def word_stream(texts: list[list[bytes]]) -> np.ndarray:
    """XXH64 values of the words of some blocks."""
    return np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(texts)), np.uint64, sum(map(len, texts)))


def suffix_groups(words: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, new, owner): suffixes that begin a window, sorted by it, and where a group of equal windows begins.

    ``words`` are streams one behind the other, ``starts`` where each begins. Ranks of single words are doubled until they
    tell apart ``window`` words. A window never leaves its stream; a stream shorter than it is one window. ``owner`` is the
    stream of every entry of ``order``.
    """
    n = len(words)
    ends = np.append(starts[1:], n)
    stream = np.repeat(np.arange(len(starts)), ends - starts)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    left = (ends[stream] - np.arange(n)).astype(np.int64)  # words up to the stream's end
    have = 1
    while have < window:
        step = min(have, window - have)
        ahead = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > step)
        ahead[inside] = rank[inside + step]  # nothing behind the end: 0
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64) + 1
        have += step
    first = np.zeros(n, bool)
    first[starts[ends > starts]] = True
    begins = np.flatnonzero((left >= window) | first)
    order = begins[np.argsort(rank[begins], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    return order, new, stream[order]


def window_names(words: np.ndarray, at: np.ndarray, left: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """64-bit names of the windows at some places; ``left``: words up to the end of the stream."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    out = (np.minimum(left, window).astype(np.uint64) + np.uint64(0xD1B54A32D192ED03)) * mix
    for k in range(window):
        inside = left > k
        word = np.where(inside, words[np.minimum(at + k, len(words) - 1)], np.uint64(0))
        out = (out ^ word) * mix
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def whole_window_names(words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """``window_names`` of the windows that begin at each place, up to the last that has ``window`` words."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    n = max(len(words) - window + 1, 0)
    out = np.full(n, (window + 0xD1B54A32D192ED03) * int(mix) % 2 ** 64, np.uint64)
    for k in range(window):
        out ^= words[k:k + n]
        out *= mix
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def covered_runs(places: list[int], n: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal runs of words inside repeated windows that begin at ``places`` of a stream of ``n`` words."""
    out: list[list[int]] = []
    for p in sorted(places):
        e = min(p + window, n)
        if out and p <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([p, e])
    return [(s, e) for s, e in out]


def host_of(url: str | None) -> str:
    """Host of an address in lower case; empty without one."""
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#\\]*)", url or "")
    return m.group(1).rpartition("@")[2].lower() if m else ""


def candidates(found: list[Block]) -> tuple[int, list[str], list[bool]]:
    """(level, texts, chosen): the blocks that may be the page's text, of the most specific level that has some."""
    level = max((b.level for b in found if b.mode == KEEP), default=0)
    chosen = [b.mode == KEEP and b.level == level for b in found]
    return level, [b.text for b, c in zip(found, chosen) if c], chosen


def read_page(page: str, articles: bool = True) -> tuple[int, list[str], int, list[tuple]]:
    """(level, texts, content, streams) of a page: the candidate blocks of the most specific level it declares, the name of its
    longest one, and the word streams of the whole page, region by region. Without ``articles`` those of a declared article have
    all but their words."""
    found = blocks(page)
    level, texts, chosen = candidates(found)
    content = xxhash.xxh64_intdigest(max(texts, key=len).encode("utf-8", "replace")) if texts else 0
    streams, n, k = [], 0, 0
    while k < len(found):
        e = k + 1
        while e < len(found) and (found[e].path, chosen[e]) == (found[k].path, chosen[k]):
            e += 1
        words = [b.text.encode("utf-8", "replace").split() for b in found[k:e]]
        name = xxhash.xxh64_intdigest(b" ".join(chain.from_iterable(words)), 3)
        raw = word_stream(words).astype("<u8").tobytes() if articles or not (level and chosen[k]) else None
        streams.append((found[k].path, n if chosen[k] else -1, list(accumulate(map(len, words))), _signed(name), raw))
        n += (e - k) if chosen[k] else 0
        k = e
    return level, texts, _signed(content), streams


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, html, k1, k2): equal rows have equal keys, and get equal results."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.withColumn("k1", F.xxhash64("page_id", "url", "html")).withColumn("k2", F.hash("page_id", "url", "html"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def page_streams(rows: DataFrame) -> DataFrame:
    """One row a word stream of the pages of ``rows``: keys, number of the page's streams, host, level, content, path, first, ends,
    name, words (see ``read_page``; null for streams of a declared article, see ``article_windows``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            at, out = [], []
            for i, (url, page) in enumerate(zip(b.column("url").to_pylist(), b.column("html").to_pylist())):
                level, _, content, streams = read_page(page, articles=False)
                at += [i] * len(streams)
                out += [(len(streams), host_of(url), level, content, *s) for s in streams]
            cols = list(zip(*out)) if out else [[]] * 9
            types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(c).take(pa.array(at, pa.int64())) for c in ("k1", "k2")] + [pa.array(list(c), t) for c, t in zip(cols, types)],
                ["k1", "k2", "n_streams", "host", "level", "content", "path", "first", "ends", "name", "words"])

    return rows.select("url", "html", "k1", "k2").mapInArrow(
        run, "k1 long, k2 int, n_streams int, host string, level int, content long, path string, first int, ends array<int>, "
             "name long, words binary")


def page_blocks(rows: DataFrame) -> DataFrame:
    """(page_id, url, k1, k2, level, texts): the candidate blocks of every page of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            read = [candidates(blocks(p)) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("page_id", "url", "k1", "k2")), pa.array([r[0] for r in read], pa.int32()),
                 pa.array([r[1] for r in read], pa.list_(pa.string()))], ["page_id", "url", "k1", "k2", "level", "texts"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(run, "page_id {}, url {}, k1 long, k2 int, level int, texts array<string>".format(*kinds))


def stream_windows(words: np.ndarray, starts: np.ndarray, seeds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(places, owner, left, anchors) of the windows of streams one behind the other, ``left`` words before the end of their stream;
    ``seeds`` has a number for the host of each.

    The anchor of a window is its least sequence of half as many words, so equal windows of a host have equal ones. A stream shorter
    than a window is one window, and its own anchor."""
    n = len(words)
    ends = np.append(starts[1:], n)
    stream = np.repeat(np.arange(len(starts)), ends - starts)
    left = ends[stream] - np.arange(n)
    first = np.zeros(n, bool)
    first[starts[ends > starts]] = True
    at = np.flatnonzero((left >= window) | first)
    left, owner = left[at], stream[at]
    short = max(1, window // 2)
    grams = whole_window_names(words, short).view(np.uint64)
    whole = left >= window
    anchors = np.empty(len(at), np.uint64)
    m = max(n - window + 1, 0)  # a whole window begins before this place
    least = grams[:m].copy()
    for k in range(1, window - short + 1):
        np.minimum(least, grams[k:k + m], out=least)
    anchors[whole] = least[at[whole]]
    anchors[~whole] = window_names(words, at[~whole], left[~whole], window).view(np.uint64)
    return at, owner, left, ((anchors ^ seeds[owner]) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _page_windows(b: pa.RecordBatch, window: int) -> tuple[list[tuple], np.ndarray, np.ndarray, tuple] | None:
    """(streams, words, starts, windows) of some pages: (host, content, in_article, name, number of words, host as a signed number) of each stream
    that has words, the words of all, where each begins, and ``stream_windows``."""
    found, lists = [], []
    for url, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
        level, _, content, streams = read_page(page)
        for s in streams:
            if s[4]:
                lists.append(np.frombuffer(s[4], "<u8"))
                host = xxhash.xxh64_intdigest(host_of(url).encode("utf-8", "replace"), 42)  # as the function xxhash64
                found.append((host, content, level > 0 and s[1] >= 0, s[3], len(lists[-1]), _signed(host)))
    if not found:
        return None
    sizes = np.array([f[4] for f in found])
    starts = np.cumsum(sizes) - sizes
    seeds = np.array([f[0] for f in found], np.uint64)
    words = np.concatenate(lists)
    return found, words, starts, stream_windows(words, starts, seeds, window)


#: Anchors that are broadcast at most, 128 MB of numbers; more are joined by a shuffle.
ANCHORS = 16_000_000


def _changes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where either differs from the value before it."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


def article_windows(rows: DataFrame, window: int = WINDOW, most: int = ANCHORS) -> DataFrame:
    """(host, window, name, place, n, lo, hi): the windows of declared articles whose anchor stands on pages of different content, or
    is met in several tasks. What is left out here is not repeated. Pages are read twice, and no words are kept."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in _slices([b], 2048):
                got = _page_windows(some, window)
                if got:
                    found, _, _, (_, owner, _, slots) = got
                    content = np.array([f[1] for f in found], np.int64)[owner]
                    begins = np.flatnonzero(_changes(slots, owner))
                    slots, content = slots[begins], content[begins]
                    order = np.lexsort((content, slots))
                    slots, content = slots[order], content[order]
                    slots, n = np.unique(slots[_changes(slots, content)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n.astype(np.int32))], ["anchor", "n"])

    pages = rows.select("url", "html")
    # nearly all differ, so nothing is gained by adding them up in front of the shuffle
    met = stored(pages.mapInArrow(anchors, "anchor long, n int").repartition("anchor").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"),
                 "page-anchors")
    few = np.sort(met.toArrow().column("anchor").to_numpy()) if met.count() <= most else None
    sent = rows.sparkSession.sparkContext.broadcast(few) if few is not None and len(few) else None

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in _slices([b]):
                got = _page_windows(some, window)
                if not got:
                    continue
                found, words, starts, (at, owner, left, slots) = got
                kept = np.array([f[2] for f in found])[owner]
                at, owner, left, slots = at[kept], owner[kept], left[kept], slots[kept]
                if not len(at):
                    continue
                whole = left >= window
                names = np.empty(len(at), np.int64)
                names[whole] = whole_window_names(words, window)[at[whole]]
                names[~whole] = window_names(words, at[~whole], left[~whole], window)
                begins = np.flatnonzero(_changes(slots, owner))
                lengths = np.diff(np.append(begins, len(at)))
                if sent is not None:
                    of_run = slots[begins]
                    met_here = sent.value[np.minimum(np.searchsorted(sent.value, of_run), len(sent.value) - 1)] == of_run
                    begins, lengths, names = begins[met_here], lengths[met_here], names[np.repeat(met_here, lengths)]
                who = owner[begins]
                of = lambda k, t: pa.array([f[k] for f in found], t).take(pa.array(who))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots[begins]), of(5, pa.int64()), of(1, pa.int64()), of(3, pa.int64()), of(4, pa.int32()),
                     pa.array((at[begins] - starts[who]).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(names))],
                    ["anchor", "host", "content", "name", "n", "place", "windows"])

    candidates = pages.mapInArrow(runs, "anchor long, host long, content long, name long, n int, place int, windows array<long>")
    if few is None:
        candidates = candidates.join(met, "anchor", "left_semi")
    elif sent is None:
        candidates = candidates.where(F.lit(False))  # nothing is met twice
    each = candidates.select("host", "name", "n", "place", "content", F.posexplode("windows").alias("i", "window"))
    return each.select("host", "window", "name", (F.col("place") + F.col("i")).cast("int").alias("place"), "n", F.col("content").alias("lo"),
                       F.col("content").alias("hi"))


def repeated_runs(distinct: DataFrame, window: int = WINDOW, more: DataFrame | None = None) -> DataFrame:
    """(host, name, runs, covered): maximal runs of repeated windows in the streams of ``distinct`` (host, name, lo, hi, words),
    one row a stream that has some. ``lo`` and ``hi`` are the least and the greatest content of pages with the stream. Windows of
    streams without ``words`` are those of ``more`` (see ``article_windows``)."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                some = b.slice(lo, 2048)
                lists = [np.frombuffer(w, "<u8") for w in some.column("words").to_pylist()]
                words = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
                if not len(words):
                    continue
                sizes = np.array([len(x) for x in lists])
                ends = np.cumsum(sizes)
                order, _, owner = suffix_groups(words, ends - sizes, window)
                names = window_names(words, order, ends[owner] - order, window)
                yield pa.RecordBatch.from_arrays(
                    [some.column("host").take(pa.array(owner)), pa.array(names), some.column("name").take(pa.array(owner)),
                     pa.array((order - (ends - sizes)[owner]).astype(np.int32)), pa.array(sizes[owner].astype(np.int32)),
                     some.column("lo").take(pa.array(owner)), some.column("hi").take(pa.array(owner))],
                    ["host", "window", "name", "place", "n", "lo", "hi"])

    suffixes = distinct.where(F.col("words").isNotNull()).mapInArrow(
        arrays, "host long, window long, name long, place int, n int, lo long, hi long")
    suffixes = written(suffixes.unionByName(more) if more is not None else suffixes, "page-suffixes")
    repeated = suffixes.groupBy("host", "window").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")).where("_lo <> _hi")
    places = suffixes.select("host", "window", "name", "place", "n").join(repeated.select("host", "window"), ["host", "window"], "left_semi")
    held = places.groupBy("host", "name").agg(F.first("n").alias("n"), F.collect_set("place").alias("places"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for b in batches:
            found = [covered_runs(p, n, window) for p, n in zip(b.column("places").to_pylist(), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), b.column("name"), pa.array([[{"s": s, "e": e} for s, e in r] for r in found], kind),
                 pa.array([sum(e - s for s, e in r) for r in found], pa.int64())], ["host", "name", "runs", "covered"])

    return held.mapInArrow(runs, "host long, name long, runs array<struct<s:int,e:int>>, covered long")


def main_text(pages: DataFrame, window: int = WINDOW, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              hot_rows: int = 1_000_000, anchors: int = ANCHORS) -> DataFrame:
    """(page_id, url, text, n_chars, declared, n_repeated): the main text of every page.

    Blocks are joined by a line feed; ``declared`` tells whether the page marks its article, ``n_repeated`` counts its
    words that stand in runs repeated on the host, those of the article too. Null and empty pages have an empty text; pages of a null or broken
    address count as one host; every row is a page of its own, also where ids or whole rows repeat. Pages of equal
    content are one witness of a repetition, so copies of a page do not remove each other, and repetition alone never
    empties a page. Other columns are not read.
    """
    rows = _rows(pages, id_col, url_col, html_col)
    streams = stored(page_streams(rows).withColumn("host", F.xxhash64("host")), "page-streams")
    distinct = streams.groupBy("host", "name").agg(F.min("content").alias("lo"), F.max("content").alias("hi"),
                                                   F.first("words", True).alias("words"), F.count(F.lit(1)).alias("pages"))
    distinct = stored(distinct, "distinct-streams")
    runs = repeated_runs(distinct, window, article_windows(rows, window, anchors))
    counts = distinct.select("host", "name", "pages")
    met = lookup_join(streams.drop("words"), counts.join(runs, ["host", "name"], "left"), counts, ["host", "name"], "pages", hot_rows)
    none = F.array().cast("array<struct<s:int,e:int>>")
    met = met.withColumn("covered", F.coalesce("covered", F.lit(0).cast("long"))).withColumn("runs", F.coalesce("runs", none))
    met = stored(met.withColumn("n", F.element_at("ends", -1)), "page-runs")

    # regions that are boilerplate by half and more, on three different pages and more
    open_regions = met.where((F.col("level") == 0) & (F.col("first") >= 0))
    sums = [F.sum("n").alias("n"), F.sum("covered").alias("covered")]
    regions = (open_regions.groupBy("host", "path", "content").agg(*sums, F.count(F.lit(1)).alias("rows")).groupBy("host", "path")
               .agg(*sums, F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("rows")))
    whole = regions.where((F.col("pages") >= 3) & (2 * F.col("covered") >= F.col("n"))).select(
        "host", "path", "rows", F.lit(True).alias("boilerplate"))
    judged = lookup_join(open_regions, whole, regions.select("host", "path", "rows"), ["host", "path"], "rows", hot_rows)
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at("ends", F.greatest(i, F.lit(1))))
    inside = F.transform("ends", lambda e, i: F.exists("runs", lambda r: (r["s"] <= start(i)) & (r["e"] >= e)))
    gone = F.filter(F.transform("ends", lambda e, i: F.when(
        F.coalesce("boilerplate", F.lit(False)) | F.element_at(inside, i + 1), F.col("first") + i)), lambda x: x.isNotNull())
    keys = ["k1", "k2"]
    removed = judged.select(*keys, F.explode(gone).alias("block")).groupBy(*keys).agg(F.collect_set("block").alias("gone"))
    # equal rows have each stream several times
    repeated = met.groupBy(*keys).agg(F.expr("sum(covered) div (count(1) div first(n_streams))").alias("n_repeated"))
    results = repeated.join(removed, keys, "left")

    page = page_blocks(rows).join(results, keys, "left")
    left = F.filter("texts", lambda x, i: ~F.array_contains("gone", i))
    kept = F.when(F.col("gone").isNull() | (F.size(left) == 0), F.col("texts")).otherwise(left)
    return page.select("page_id", "url", F.array_join(kept, "\n").alias("text"), (F.col("level") > 0).alias("declared"),
                       F.coalesce("n_repeated", F.lit(0).cast("long")).alias("n_repeated")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "declared", "n_repeated")
