"""Main text by brute force over a host's streams, and the awkward pages."""

import collections
import re

import pytest

from capturemill.llm import html_text


def _got(spark, rows):
    got = html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return collections.Counter((r.page_id, r.text, r.n_removed) for r in got)


def _brute(rows, n=6):
    """Every pair of pages of a host with different content, all runs of ``n`` tokens compared by themselves."""
    pages = []
    for i, url, page in rows:
        text, stream = html_text.text_and_stream(html_text.blocks(page or ""))
        parts = [[]]
        for k, t in stream:
            if t:
                parts[-1] += [(k, w) for w in t.split()]
            else:
                parts.append([])
        pages.append((i, html_text._host(url), page or "", text, [p for p in parts if p]))
    runs = collections.defaultdict(set)
    for _, host, page, _, parts in pages:
        for p in parts:
            m = min(n, len(p))
            for a in range(len(p) - m + 1):
                runs[host, m, tuple(w.lower() for _, w in p[a : a + m])].add(page)
    out = collections.Counter()
    for i, host, _, text, parts in pages:
        gone, left = 0, []
        for p in parts:
            m, cut = min(n, len(p)), set()
            for a in range(len(p) - m + 1):
                if len(runs[host, m, tuple(w.lower() for _, w in p[a : a + m])]) > 1:
                    cut.update(range(a, a + m))
            gone += len(cut)
            left += [w for x, (k, w) in enumerate(p) if k == 0 and x not in cut]
        out[i, " ".join(left) if text is None else text, gone] += 1
    return out


def test_unmarked_pages_of_a_host(spark):
    menu = "".join(f"<div>{x}</div>" for x in ("Home", "About us", "Contact", "All rights kept"))
    rows = [(i, "http://h.c/x", f"<body>{menu}<div>{' '.join(f'w{i}x{k}' for k in range(9))}</div><p>short {i}</p></body>") for i in range(5)]
    rows += [(20, "http://other.d", f"<body>{menu}<div>stays as no page of its host has it</div></body>"), (21, None, None), (22, "u", ""), (23, "http://h.c/y", f"<body>{menu}</body>")]
    got = _got(spark, rows)
    assert got == _brute(rows)
    assert got[3, " ".join(f"w3x{k}" for k in range(9)) + " short 3", 7] == 1
    assert got[20, "Home About us Contact All rights kept stays as no page of its host has it", 0] == 1


def test_equal_pages_keep_their_text(spark):
    page = "<body><div>" + " ".join(f"word{k}" for k in range(30)) + "</div></body>"
    rows = [(1, "http://h.c/a", page), (2, "http://h.c/a", page), (2, "http://h.c/a", page)]
    want = " ".join(f"word{k}" for k in range(30))
    assert _got(spark, rows) == collections.Counter({(1, want, 0): 1, (2, want, 0): 2})


def test_marked_pages_count_what_the_array_covers_outside_and_keep_quotes(spark):
    quote = "a passage that several articles of one host quote in full"
    foot = "<footer>one foot for all pages of this host</footer>"
    rows = [(i, "http://h.c/x", f"<body><nav>n{i}</nav><article><p>{quote}</p><p>own {i}</p></article>{foot}</body>") for i in range(3)]
    got = _got(spark, rows)
    assert got == collections.Counter({(i, f"{quote} own {i}", 8): 1 for i in range(3)}) == _brute(rows)


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_driver_pages_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(html_text, "BROADCAST_HEADS", most)
    d = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in d.collect()]
    assert _got(spark, rows) == _brute(rows)


def test_odd_tables(spark):
    assert _got(spark, []) == collections.Counter()
    long = "<p>" + "x y z " * 100_000 + "</p>"
    d = spark.createDataFrame([(1, "http://h/1", f"<article>{long}</article>", 5, "k"), (None, "http://h/1", "<article>a &amp; b</article>", 6, "k")], "page_id long, url string, html string, row long, head string")
    got = {r.page_id: r.text for r in html_text.extract_pages(d).collect()}
    assert got[1] == ("x y z " * 100_000).strip() and got[None] == "a & b"


@pytest.mark.parametrize(
    ("part", "kept"),
    [
        ('<p class="social">Social housing was built.</p>', True), ('<div class="related-work">Related work is cited.</div>', True), ('<h2 id="comments-on-method">Comments on method</h2>', True),
        ('<li class="share">A share of the vote.</li>', True), ('<div class="copyright-law">Copyright law changed.</div>', True), ('<div class="social-links">Follow us</div>', False), ('<div class="share">Share this</div>', False),
        ('<section class="related posts">More like this</section>', False), ('<div id="comments-3" class="thread">A reader says</div>', False), ('<p class="ad">Buy now</p>', False), ('<div class="ad-slot">Buy now</div>', False),
        ('<aside class="related-work">By the way</aside>', False), ('<div class="related-work" role="navigation">Next</div>', False),
    ],
)
def test_class_words_in_an_article(part, kept):
    """In a marked article a doubtful class word drops a part only if all of its class does; outside of one it does as before."""
    text = re.sub("<[^>]*>", "", part)
    page = html_text.blocks(f"<body><article><p>First words.</p>{part}<p>Last words.</p></article></body>")
    assert " ".join(t for k, t in page if k == 3) == (f"First words. {text} Last words." if kept else "First words. Last words.")
    if "div" in part or "section" in part:
        assert [k for k, t in html_text.blocks(f"<body>{part}</body>")] == [-1]
