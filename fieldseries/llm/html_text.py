"""Main text of web pages: structure first, then the boilerplate that a host repeats.

A page is cut into blocks.  Elements that never hold main text (menus, headers, footers, sidebars,
forms, scripts, notices, adverts, comments) are left out by their names, roles and class names.
Where a page marks its article and that holds the larger part, the blocks in it are the main text.

All blocks that are left, of every page, are judged by their host: the token streams of its pages
are concatenated, a suffix array finds the long substrings that stand on several distinct pages,
and those that stand on more than half of the host's pages (and on LEAST_PAGES) are its boilerplate.
Tokens that it covers are removed; unique runs stay.  A page that marks its article and would lose
most of it keeps it: what such a page shares is its article, as a copy does, and not its frame.

A host with many pages is dealt to shards of bounded size.  What stands on more than half of all
pages stands on more than half of some shard's, so shards name candidates, and where a host has
several shards these are counted in all of them: the result is the same for any size of a shard.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import BATCH_ROWS, drop_scratch, give_back, map_batches, materialise, small_batches
from .fm_index import suffix_array
from .textcore import NOT_SPACE, mix, word_hashes_exact

#: Tokens that a repeated substring has at least; distinct pages that boilerplate stands on at least.
LEAST_TOKENS, LEAST_PAGES = 6, 3
#: Bytes of html in a host's shard, about.
SHARD_BYTES = 2 << 20
#: Hosts and windows that are sent to all tasks at most; beyond, rows are joined by shuffles.
FEW = 200_000
#: Pages that a task remembers to have sent on.
SEEN = 500_000

# Elements of HTML by the part they play.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
SKIPPED = frozenset("nav header footer aside form script style noscript template iframe svg canvas object select button textarea input label head menu dialog math audio video title option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
MAIN = frozenset(("article", "main"))
#: What can stand in a head; anything else ends it, as its end tag may be left out.
IN_HEAD = frozenset("head title meta link style script base noscript template bgsound basefont".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Headings over what readers have said; it goes on to the next heading of that rank or a higher one.
COMMENTS = re.compile(r"(?:\d+\s+)?(?:(?:reader|user|visitor)s?['’]?\s+)?(?:comments?|responses|replies)(?:\s*\(\d+\)|\s*:)?|(?:leave|post|add|write) a (?:comment|reply)|join the (?:discussion|conversation)", re.I)
CLOSED_BY_BLOCK = frozenset(("p",))
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words in class, id and role that mark other parts than the main text.
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|byline-share|captcha|comments?|commentlist|consent|cookies?|copyright|disqus|footer|gdpr|header|masthead|menu|modal|nav\w*|newsletter|notice|notification|outbrain|overlay|pagination|pager|popup|privacy|promo\w*|related|replies|reply|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|taboola|toolbar|widget|alert|complementary|contentinfo|search|form|cc-(?:window|banner|revoke)|onetrust\w*|usercentrics|truste|didomi\w*)(?:$|[\s_-])",
    re.I,
)

#: Elements that such a word drops inside a marked article, where it must be a whole class name.
CONTAINERS = frozenset("aside div dl figure footer form header nav ol section span ul".split())
#: Class names that say what an element has or lacks beside it.
NOT_HELD = re.compile(r"(?<!\S)(?:no|has|with|without)[_-]\S*", re.I)

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")


def _named(name: str, key: str, value: str, inside: bool) -> bool:
    """Whether a word in an attribute says that an element is no main text; in an article only whole class names do."""
    if key not in ("class", "id", "role", "aria-label") or name in MAIN:
        return False
    if not inside:
        return bool(NOT_MAIN.search(NOT_HELD.sub(" ", value)))
    return key in ("class", "role") and name in CONTAINERS and any(NOT_MAIN.fullmatch(x) for x in value.split())


def _dropped(name: str, attributes: str, inside: bool) -> bool | None:
    """Whether an element goes; None if only by a word in its names, which an article or most of the text outweighs."""
    if name == "form":
        return None  # a page can stand in a form as a whole
    if name in SKIPPED:
        return True
    if not attributes or name in ("html", "body"):
        return False
    named: bool | None = False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if _named(name, key, value, inside):
            named = None
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return True
    return named


def blocks(html: str) -> list[tuple[bool, str]]:
    """(inside a marked article, text) of every block that is not left out by its place, in page order."""
    text: list[tuple[str | None, bool, tuple[int, ...], int]] = []  # text or a block's end, main, elements around it that may go, rank of a heading that ends
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []  # name, dropped, main, the same elements
    dropped = main = head = False
    doubt: tuple[int, ...] = ()

    def flush(rank: int = 0) -> None:
        text.append((None, main, doubt, rank))

    def pop_to(i: int) -> None:
        nonlocal dropped, main, doubt
        if any(s[0] in BLOCKS for s in stack[i:]) and not dropped:
            flush(HEADINGS.index(stack[i][0]) + 1 if stack[i][0] in HEADINGS else 0)
        del stack[i:]
        dropped, main, doubt = stack[-1][1:] if stack else (False, False, ())

    at, n = 0, len(html)
    for m in _TAG.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at and not dropped:
            text.append((html[at : m.start()], main, doubt, 0))
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
                if stack[i][0] in MAIN or stack[i][0] in ("table", "body"):
                    break
            else:
                if name == "p" and not dropped:
                    flush()
            continue
        if head and name not in IN_HEAD:
            head = False
            for i, s in enumerate(stack):
                if s[0] == "head":
                    pop_to(i)
                    break
        if name == "br":
            if not dropped:
                text.append((" ", main, doubt, 0))
            continue
        if name in BLOCKS:
            if not dropped:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                other = stack[i][0]
                if other in CLOSED_BY_BLOCK or other in SIBLINGS.get(name, ()):
                    pop_to(i)
                    break
                if other in BLOCKS and other not in SIBLINGS.get(name, ()):
                    break
        if name in VOID or m[3].rstrip().endswith("/") and name in ("svg", "path", "use"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        own = _dropped(name, m[3], main)
        gone = dropped or bool(own)
        if dropped and name in HEADINGS[:3] and not own:
            # an article's header goes, but for the title in it
            first = next(i for i, s in enumerate(stack) if s[1])
            gone = not (stack[first][0] == "header" and first and stack[first - 1][2])
            if not gone:
                flush()
        if gone and not dropped and name in BLOCKS | SKIPPED:
            flush()
        if own is None and not dropped:
            doubt = (*doubt, m.start() * 2 + main)
        dropped, main = gone, main or name in MAIN
        head |= name == "head"
        stack.append((name, dropped, main, doubt))
    if at < n and not dropped:
        text.append((html[at:], main, doubt, 0))
    flush()
    return _kept_blocks(text)


def _kept_blocks(text: list[tuple[str | None, bool, tuple[int, ...], int]]) -> list[tuple[bool, str]]:
    """The blocks without forms and the elements that their names drop, and without what stands under a heading of comments.

    Where no article stands outside such elements, those that hold one or most of the page's text stay.
    """
    held: dict[int, int] = {}
    with_article: set[int] = set()
    total, clear = 0, False
    for t, main, doubt, _ in text:
        if t and (size := len(_SPACE.sub("", t))):
            total += size
            clear |= main and not doubt
            for d in doubt:
                held[d] = held.get(d, 0) + size
                if main:
                    with_article.add(d)
    stay = set() if clear else {d for d, size in held.items() if d % 2 == 0 and (2 * size > total or d in with_article)}
    out: list[tuple[bool, str]] = []
    parts: list[str] = []
    comments = 0  # the rank of the heading of comments that holds
    for t, main, doubt, rank in text:
        if not stay.issuperset(doubt):
            continue
        if t is not None:
            parts.append(t)
        elif parts:
            joined = _SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if not joined:
                continue
            if rank and (not comments or rank <= comments):
                comments = rank if COMMENTS.fullmatch(joined) else 0
            if not comments:
                out.append((main, joined))
    return out


def page_blocks(html: str | None) -> tuple[bool, list[str]]:
    """(whether the page marks its article, the blocks that may be main text)."""
    found = blocks(html or "")
    # a few teasers in articles do not mark the page
    marked = 2 * sum(len(t) for m, t in found if m) > sum(len(t) for _, t in found)
    return marked, [t for m, t in found if m or not marked]


def token_streams(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, page) of the tokens of all pages' blocks, one after another; a 0 ends each block."""
    raw = [b.encode() for blocks in pages for b in blocks]
    bounds = np.cumsum([0, *map(len, raw)])
    of = np.repeat(np.arange(len(pages)), [len(b) for b in pages])
    _, _, block, h = word_hashes_exact(np.frombuffer(b"".join(raw), np.uint8), bounds, NOT_SPACE)
    count = np.bincount(block, minlength=len(raw))
    out = np.zeros(len(h) + len(raw), np.uint32)
    out[np.arange(len(h)) + block] = np.maximum(h >> np.uint64(32), np.uint64(1)).astype(np.uint32)
    return out, np.repeat(of, count + 1)


def window_hashes(stream: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the windows of `least` tokens that lie in one block."""
    n = max(0, len(stream) - least + 1)
    total, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(least):
        part = stream[k : k + n]
        whole &= part > 0
        total = mix(total + part)
    at = np.flatnonzero(whole)
    return at, total[at].view(np.int64)


def _pages(table: pa.Table) -> list[np.ndarray]:
    """The streams of the distinct pages of a shard."""
    distinct = dict(zip(table["page"].to_pylist(), table["stream"].to_pylist(), strict=True))
    return [np.frombuffer(distinct[k], np.uint32) for k in sorted(distinct)]


def repeated(pages: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(window hash, pages) of every substring of `least` tokens that more than half of the pages hold; by a suffix
    array over all streams."""
    seq = np.concatenate([x for k, p in enumerate(pages) for x in (p.astype(np.int64), np.zeros(1, np.int64))]) if pages else np.zeros(0, np.int64)
    page = np.repeat(np.arange(len(pages)), [len(p) + 1 for p in pages])
    place, value = window_hashes(seq.astype(np.uint32), least)
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = np.zeros(len(seq), np.int64)
    hashed[place] = value
    whole = np.zeros(len(seq), bool)
    whole[place] = True
    order = suffix_array(seq, least)
    order = order[whole[order]]
    # neighbours in suffix order that agree in `least` tokens are occurrences of one substring
    same = np.ones(len(order) - 1, bool)
    for k in range(least):
        same &= seq[order[1:] + k] == seq[order[:-1] + k]
    run = np.cumsum(np.r_[True, ~same]) - 1
    pair = np.unique(run * len(pages) + page[order])
    count = np.bincount(pair // len(pages))
    often = np.flatnonzero(2 * count > len(pages))
    return hashed[order[np.flatnonzero(np.r_[True, ~same])[often]]], count[often]


_COUNTS = "host string, window bigint, pages bigint, least int"
_COUNTS_ARROW = pa.schema([("host", pa.string()), ("window", pa.int64()), ("pages", pa.int64()), ("least", pa.int32())])


def _counts(host: str, found: tuple[np.ndarray, np.ndarray], pages: int, least: int) -> pa.Table:
    """Windows with their pages, and a row without a window that has the shard's pages."""
    n = len(found[0]) + 1
    window = pa.array([*found[0].tolist(), None], pa.int64())
    return pa.table([pa.array([host] * n, pa.string()), window, pa.array([*found[1].tolist(), pages], pa.int64()), pa.array([least] * n, pa.int32())], schema=_COUNTS_ARROW)


def _host() -> Column:
    """The host of a url in lower case; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#\s]*)", 1))


def boilerplate(pages: DataFrame, least: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES, shard_bytes: int = SHARD_BYTES, scratch: list[str] | None = None) -> DataFrame:
    """(host, windows): hashes of the windows of `least` tokens that more than half of a host's distinct pages hold.

    pages: columns url and html.  A host's windows are at most twice as many as a page has on average.
    """
    scratch = [] if scratch is None else scratch
    sizes = pages.groupBy(_host().alias("host")).agg(F.count("*").alias("rows"), F.ceil(F.sum(F.octet_length("html")) / shard_bytes).alias("shards"))
    sizes = sizes.filter(F.col("rows") >= least_pages).select("host", F.greatest(F.col("shards"), F.lit(1)).alias("shards"))
    sizes = materialise(sizes, "hosts", scratch)
    sizes = F.broadcast(sizes) if sizes.count() <= FEW else sizes

    def streams(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not batch.num_rows:
            return None
        found = [page_blocks(x)[1] for x in batch.column(2).to_pylist()]
        stream, of = token_streams(found)
        ends = np.cumsum(np.bincount(of, minlength=len(found)))
        parts = [p.tobytes() for p in np.split(stream, ends[:-1])]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.binary())], ["host", "page", "stream"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A page that stands in a task many times leaves it once, so a page crawled a million times fills no shard."""
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                fresh = []
                for k, key in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    if key not in seen:
                        fresh.append(k)
                        seen.add(key)
                if len(seen) > SEEN:
                    seen.clear()
                if (out := streams(part.take(pa.array(fresh, pa.int64())))) is not None:
                    yield out
        give_back()

    read = pages.select(_host().alias("host"), F.xxhash64("html").alias("page"), F.col("html").cast("string").alias("html")).filter("html is not null")
    small_batches(pages.sparkSession)
    dealt = read.mapInArrow(task, "host string, page bigint, stream binary").join(sizes, "host").withColumn("shard", F.pmod("page", "shards").cast("int"))
    dealt = dealt.select("host", "shard", "page", "stream")

    def in_shard(table: pa.Table) -> pa.Table:
        streams = _pages(table)
        return _counts(table["host"][0].as_py(), repeated(streams, least), len(streams), least)

    first = materialise(dealt.groupBy("host", "shard").applyInArrow(in_shard, _COUNTS), "windows", scratch)
    total = first.filter("window is null").groupBy("host").agg(F.sum("pages").alias("total"))
    counts = first.filter("window is not null").select("host", "window", "pages")
    several = sizes.filter("shards > 1")
    named = counts.join(several, "host").select("host", "window", "shards").distinct()
    if not named.isEmpty():  # count what some shard names in all shards of its host
        asked = named.select("host", F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1)).alias("shard"), "window")

        def in_all(streams: pa.Table, windows: pa.Table) -> pa.Table:
            wanted, held = np.sort(windows["window"].to_numpy()), _pages(streams)
            count = np.zeros(len(wanted), np.int64)
            for p in held if len(wanted) else ():
                count[np.isin(wanted, window_hashes(p, least)[1])] += 1
            host = (streams if streams.num_rows else windows)["host"][0].as_py()
            return _counts(host, (wanted[count > 0], count[count > 0]), len(held), least)

        again = dealt.join(several.select("host"), "host").groupBy("host", "shard").cogroup(asked.groupBy("host", "shard")).applyInArrow(in_all, _COUNTS)
        again = materialise(again, "recounted", scratch).filter("window is not null").select("host", "window", "pages")
        counts = counts.join(several, "host", "left_anti").unionByName(again)
    often = counts.groupBy("host", "window").agg(F.sum("pages").alias("pages")).join(total, "host").filter((F.col("pages") >= least_pages) & (2 * F.col("pages") > F.col("total")))
    return often.groupBy("host").agg(F.collect_list("window").alias("windows"))


def unique_runs(marked: bool, parts: list[str], windows: np.ndarray, least: int) -> list[str]:
    """The blocks without the tokens that windows of boilerplate cover; blocks that these cover as a whole go."""
    stream, _ = token_streams([parts])
    at, h = window_hashes(stream, least)
    at = at[np.isin(h, windows)]
    cover = np.zeros(len(stream) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + least, -1)
    gone = np.cumsum(cover[:-1]) > 0
    if not gone.any() or marked and 2 * gone.sum() > (stream > 0).sum():
        return parts
    out, start = [], 0
    for part in parts:
        tokens = part.split(" ")
        flags = gone[start : start + len(tokens)]
        start += len(tokens) + 1
        if not flags.any():
            out.append(part)
        elif not flags.all():
            out.append(" ".join([t for t, f in zip(tokens, flags.tolist(), strict=True) if not f]))
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", least: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """page_id, url, text, article_marked; a row a row of pages."""
    read = pages.select(F.col(id_col).alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    scratch: list[str] = []
    known = materialise(boilerplate(read, least, least_pages, shard_bytes, scratch), "boilerplate", own := [])
    drop_scratch(pages.sparkSession, scratch)
    if (known.agg(F.sum(F.size("windows"))).first()[0] or 0) <= FEW:  # then the driver holds it, and the table can go
        known = F.broadcast(pages.sparkSession.createDataFrame(known.toArrow(), known.schema))
        drop_scratch(pages.sparkSession, own)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks, texts = [], []
        for html, windows in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
            marked, parts = page_blocks(html)
            if windows.is_valid and parts:
                parts = unique_runs(marked, parts, windows.values.to_numpy(), least)
            marks.append(marked)
            texts.append("\n\n".join(parts))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(marks, pa.bool_())], ["page_id", "url", "text", "article_marked"])

    schema = StructType([StructField("page_id", read.schema["page_id"].dataType), *StructType.fromDDL("url string, text string, article_marked boolean").fields])
    return map_batches(read.withColumn("host", _host()).join(known, "host", "left").select("page_id", "url", "html", "windows"), work, schema)


def op2(pages: DataFrame) -> DataFrame:
    """The contract's columns; a row a row of pages.

    Null and empty html give an empty text.  Rows with the same html are one page where a host's pages are counted,
    so copies do not take each other's text.  Pages without a host share one.  Extra columns are left out.
    """
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "article_marked")
