"""Main text of web pages: a host's suffix array beside page structure.

A page is read once, from its whole markup, into blocks. Blocks under menus, headers, footers, asides, forms, scripts, styles,
hidden elements, and elements whose class, id or role says advert, notice, sidebar or reader comment are boilerplate by structure. If
the page marks its article (``article``, then ``main``, then a content class), the blocks under that mark are the text: the
mark guards passages that several articles quote.

All else on a page, menus and footers too, is its open stream: the blocks' tokens one after another, with a break where the article was. The
open streams of a host's pages are taken as one, with its array of suffixes; a suffix counts by its first ``min_run`` tokens, as two
suffixes share a run of that length just if these are equal. Runs on two pages of different content or more are boilerplate
wherever they begin and end. ``n_removed`` is the number of tokens that they cover; on a page without an article mark these go and
the unique runs that structure leaves are the text. A stream of fewer tokens than ``min_run`` is one run.

The array is never laid out in one task: a suffix head is kept with the least and the greatest content it was found in, which
is summed before the shuffle. The repeated heads are counted: up to ``BROADCAST_HEADS`` are broadcast and no text moves; more are joined to the
pages' heads in ``SALTS`` parts, so that a host with a third of all pages is spread.

Defined cases: null or empty html gives the empty text. Character references are decoded; white space in a block is one
space; blocks are joined by a space. Equal rows are pages of their own, of one content: they don't make each other's text boilerplate. A null
url is the host ''. An empty table gives no rows. Columns that aren't named are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, gram_hashes, mix, small_batches, trimmed, word_hashes, written

#: Repeated heads that are broadcast (16 MB), and the parts in which more of them meet the pages.
BROADCAST_HEADS, SALTS = 2_000_000, 16

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {k: re.compile(rf"</{k}\s*>?", re.I) for k in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp")}
# Elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img label".split())
BOILERPLATE = frozenset("head nav aside footer form button select option fieldset dialog menu menuitem object audio video canvas map applet noframes frameset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
BAD_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer masthead banner cookie cookies consent gdpr notice notices notification alert ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted popup modal overlay newsletter subscribe subscription signup login comment comments commentlist respond disqus reply replies share sharing social related recommended widget widgets toolbar pagination pager copyright disclaimer paywall hidden".split()
)
GOOD_WORDS = frozenset("article content post entry story main body text".split())
# Words of both lists, elements of running text, and words that say nothing of a part's role.
DOUBTFUL = frozenset("social related share sharing recommended notice notices alert promotion copyright menu navigation subscription popup".split())
DOUBTFUL_OF_TEXT = DOUBTFUL | frozenset("comment comments reply replies widget widgets modal overlay login".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td figure figcaption".split())
FILLER = frozenset("bar block bottom box button buttons container content group icon icons inline inner item items left link links list panel posts articles stories right row section slot strip top unit wrap wrapper".split())
_CLOSES_P = frozenset("p div ul ol table h1 h2 h3 h4 h5 h6 section article header footer nav aside form blockquote pre hr dl figure main address fieldset".split())


def _bad_class(tag: str, words: set[str], level: int) -> bool:
    """Whether words of class and id say boilerplate. In a marked article a doubtful word does so only for a part whose words all do, and never for an element of running text."""
    bad = words & BAD_WORDS
    if not bad or level < 3:
        return bool(bad)
    if tag in TEXT:
        return bool(bad - DOUBTFUL_OF_TEXT)
    return bool(bad - DOUBTFUL) or not {w for w in words - BAD_WORDS - FILLER if not w.isdigit() and w}


def _judge(tag: str, attrs: str, level: int) -> tuple[bool, int]:
    """Whether an element is boilerplate, and the level of article mark under it (3 article, 2 main, 1 content class, 0 none)."""
    if tag in BOILERPLATE:
        return True, level
    new = max(level, 3 if tag == "article" else 2 if tag == "main" else 0)
    if tag == "header" and not level:
        return True, level
    if len(attrs) > 1:
        words: set[str] = set()
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                words.update(re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "").lower()))
            elif name == "role":
                if value in BAD_ROLES:
                    return True, level
                if value in ("main", "article"):
                    new = max(new, 2)
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                return True, level
        if words and tag not in ("html", "body", "article", "main"):
            if _bad_class(tag, words, level) or ("header" in words and not level and not words & GOOD_WORDS):
                return True, level
            if words & GOOD_WORDS and tag in ("div", "section", "td"):
                new = max(new, 1)
    return False, new


def blocks(page: str) -> list[tuple[int, str]]:
    """A page's blocks in order as (level, text); level -1 is boilerplate."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, int]] = []
    bad, level, at = 0, 0, 0
    parts: list[str] = []

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((-1 if bad else level, text))
            parts.clear()

    def pop(k: int) -> None:
        nonlocal bad, level
        while len(stack) > k:
            bad -= stack.pop()[1]
        level = stack[-1][2] if stack else 0

    search = _TAG.search
    while m := search(page, at):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        if (tag := m[2]) is None:
            continue
        tag = tag.lower()
        if tag in _RAW_END:
            if not m[1]:
                e = _RAW_END[tag].search(page, at)
                at = e.end() if e else len(page)
            continue
        if tag in INLINE:
            # An inline element counts only if it is itself boilerplate.
            if m[1]:
                if stack and stack[-1][0] == tag:
                    close()
                    pop(len(stack) - 1)
                continue
            if len(m[3]) <= 1 or not _judge(tag, m[3], level)[0]:
                if stack and stack[-1][0] == tag and stack[-1][1]:
                    stack.append((tag, False, level))
                continue
            close()
            stack.append((tag, True, level))
            bad += 1
            continue
        close()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag in VOID or m[3].endswith("/>") and tag not in ("p", "div", "article", "section"):
            continue
        if tag in _CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        elif tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
            pop(len(stack) - 1)
        is_bad, new = _judge(tag, m[3], level)
        stack.append((tag, is_bad, new))
        bad += is_bad
        level = new
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


def _host(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", url or "")
    return m[1].lower().removeprefix("www.") if m else ""


def text_and_stream(page: list[tuple[int, str]]) -> tuple[str | None, list[tuple[int, str]]]:
    """The text under the page's strongest article mark (None: it has no mark but open blocks), and its other blocks, with (0, '') at breaks."""
    top = max((k for k, _ in page), default=-1)
    if top <= 0:
        return (None if top == 0 else ""), page
    rest: list[tuple[int, str]] = []
    for k, t in page:
        if k != top:
            rest.append((k, t))
        elif rest and rest[-1][1]:
            rest.append((0, ""))
    return " ".join(t for k, t in page if k == top), rest


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def stream_heads(stream: list[tuple[int, str]], host: int, n: int) -> list[tuple[np.ndarray, int]]:
    """For each part of a stream between breaks: the hashes of its suffixes' heads with the host, and their length in tokens."""
    parts: list[list[str]] = [[]]
    for _, t in stream:
        if t:
            parts[-1].append(t)
        else:
            parts.append([])
    out = []
    for part in parts:
        w = word_hashes(" ".join(part).encode(errors="replace"))
        size = min(n, max(1, len(w)))
        out.append((mix(gram_hashes(w, size) ^ np.uint64(host & ((1 << 64) - 1))), size))
    return out


def _parsed(n: int):
    """``page_id, url, host, content, text, levels, blocks, heads`` of each page; heads are the distinct ones of its stream."""

    def run(batches):
        import pyarrow as pa

        names = ["page_id", "url", "host", "content", "text", "levels", "blocks", "heads"]
        for b in batches:
            hosts, contents, texts, levels, parts, heads = [], [], [], [], [], []
            for url, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                text, stream = text_and_stream(blocks(page or ""))
                host = _hash(_host(url).encode(errors="replace"))
                hosts.append(host)
                contents.append(_hash((page or "").encode(errors="replace")))
                texts.append(text)
                levels.append([k for k, _ in stream])
                parts.append([t for _, t in stream])
                heads.append(np.unique(np.concatenate([h for h, _ in stream_heads(stream, host, n)])).view(np.int64))
            longs = [pa.array(x, pa.int64()) for x in (hosts, contents)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *longs, pa.array(texts, pa.string()), pa.array(levels, pa.list_(pa.int8())), pa.array(parts, pa.list_(pa.string())), pa.array(heads, pa.list_(pa.int64()))], names=names)

    return run


def unique_runs(stream: list[tuple[int, str]], heads: list[tuple[np.ndarray, int]], repeated: np.ndarray) -> tuple[str, int]:
    """The stream's open blocks without the tokens that repeated runs cover, and the number of tokens covered in all blocks. ``repeated`` is sorted."""
    covered = []
    for h, n in heads:
        at = np.minimum(np.searchsorted(repeated, h), max(0, len(repeated) - 1))
        hit = repeated[at] == h if len(repeated) else np.zeros(len(h), dtype=bool)
        near = np.concatenate((hit, np.zeros(n - 1, dtype=bool))).cumsum()
        near[n:] -= near[:-n].copy()  # runs that begin at one of the last n tokens
        covered.append(near > 0)
    out, gone, part, at = [], 0, 0, 0
    for k, t in stream:
        if not t:
            part, at = part + 1, 0
            continue
        words = t.split()
        cut = covered[part][at : at + len(words)]
        at += len(words)
        gone += int(cut.sum())
        if k == 0 and (kept := [w for w, c in zip(words, cut, strict=True) if not c]):
            out.append(" ".join(kept))
    return " ".join(out), gone


def _judged(host: int, text: str | None, stream: list[tuple[int, str]], repeated: np.ndarray, n: int) -> tuple[str, int]:
    left, gone = unique_runs(stream, stream_heads(stream, host, n), repeated)
    return (left if text is None else text), gone


def _stream_heads(n: int):
    """The distinct heads of each page's stream with the page's content."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            contents, heads = [], []
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _, stream = text_and_stream(blocks(page or ""))
                own = np.unique(np.concatenate([h for h, _ in stream_heads(stream, _hash(_host(url).encode(errors="replace")), n)]))
                heads.append(own.view(np.int64))
                contents.append(np.full(len(own), _hash((page or "").encode(errors="replace")), dtype=np.int64))
            if heads:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(contents)), pa.array(np.concatenate(heads))], names=["content", "head"])

    return run


_OUT = ["page_id", "url", "text", "n_removed"]


def _decided_at_once(held, n: int):
    """Pages whose repeated heads are all at hand."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for url, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                out.append(_judged(_hash(_host(url).encode(errors="replace")), *text_and_stream(blocks(page or "")), held.value, n))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], names=_OUT)

    return run


def _decided(n: int):
    """Parsed pages with the repeated heads of their own."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for host, text, levels, parts, hits in zip(*[b.column(i).to_pylist() for i in range(2, 7)], strict=True):
                out.append(_judged(host, text, list(zip(levels, parts, strict=True)), np.sort(np.array(hits or [], dtype=np.int64).view(np.uint64)), n))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], names=_OUT)

    return run


def extract_pages(pages: DataFrame, min_run: int = 6) -> DataFrame:
    """``page_id, url, text, n_chars, n_removed`` for every row of ``pages`` (page_id, url, html)."""
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_removed long"

    def repeated(heads: DataFrame) -> DataFrame:
        return heads.groupBy("head").agg(F.min("content").alias("lo"), F.max("content").alias("hi")).filter("lo <> hi").select("head")

    found = checkpointed(repeated(rows.select("url", "html").mapInArrow(trimmed(_stream_heads(min_run)), "content long, head long")))
    if found.count() <= BROADCAST_HEADS:
        held = pages.sparkSession.sparkContext.broadcast(np.sort(found.toArrow().column(0).to_numpy().view(np.uint64)))
        out = rows.mapInArrow(trimmed(_decided_at_once(held, min_run)), schema)
    else:
        parsed = written(rows.mapInArrow(trimmed(_parsed(min_run)), f"page_id {kind}, url string, host long, content long, text string, levels array<byte>, blocks array<string>, heads array<long>").withColumn("row", F.monotonically_increasing_id()))
        heads = parsed.select("row", F.explode("heads").alias("head")).withColumn("salt", F.pmod(F.hash("row"), F.lit(SALTS)))
        salted = found.select("head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        hits = heads.join(salted, ["head", "salt"]).groupBy("row").agg(F.collect_list("head").alias("hits"))
        out = parsed.join(hits, "row", "left").select("page_id", "url", "host", "text", "levels", "blocks", "hits").mapInArrow(trimmed(_decided(min_run)), schema)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_removed")
