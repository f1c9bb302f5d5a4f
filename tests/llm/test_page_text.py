"""Main text of pages: reading of mark-up, repeated runs of a host against brute force, edge cases."""

import collections
import html
import random
import re

import numpy as np
import pytest

from basetide.llm import page_text
from basetide.llm.common import table

RNG = random.Random(5)


def kept(page):
    level, texts, _, _ = page_text.read_page(page)
    return texts


@pytest.mark.parametrize("page, want", [
    ("", []),
    ("no mark-up at all", ["no mark-up at all"]),
    ("a &lt;b&gt; &amp&copy; &am; &#65;&#x42;", ["a <b> &© &am; AB"]),
    ("<p>one<p>two <b>bold<br>line</p>three", ["one", "two bold line", "three"]),
    ("<article><h1>T</h1><p>x\n\t y&nbsp;z</p></article><footer>f</footer>", ["T", "x y z"]),
    ("<body><nav>n</nav><p>x</p><aside>s</aside><form><p>f</p></form><script>var t='</p>';</script></body>", ["x"]),
    ("<article><p>a</p><div class='ad-slot'>buy</div><p>b</p><section id=comments><p>c</p></section></article>", ["a", "b"]),
    ("<article><p>a<span class=advert>buy</span> b</p></article>", ["a", "b"]),
    ("<article><p class=notice>n<p>text</article>", ["text"]),
    ("<div class=has-sidebar><article>x</article></div>", ["x"]),
    ("<header>site</header><article><header><h1>T</h1><div>by me</div></header>x</article>", ["T", "x"]),
    ("<main><h1>T</h1><p>x</p></main><div>y</div>", ["T", "x"]),
    ("<article>x<!-- <p>hidden</p> -->y<style>p{}</style>z", ["xyz"]),
    ("<article>a < b and 1<2 </ >c", ["a < b and 1<2 c"]),
    ("<article title='a > b'>x</article>", ["x"]),
    ("<article>x <a href=\"unclosed>y</a>", ["x"]),
    ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", ["a", "b", "1 2", "3"]),
    ("<script>only", []),
    ("<nav><ul><li>x</ul>", []),
    ("</div></p>x</span>", ["x"]),
])
def test_reading(page, want):
    assert kept(page) == want


def plain_article(page):
    body = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_given_pages_equal_a_plain_reading(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    got = page_text.main_text(pages).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) and r.declared for r in got)
    assert sum(r.n_repeated for r in got) > 0


def words(n, rng=RNG):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(1000)) for _ in range(n))


def test_suffix_groups_against_brute_force():
    rng = np.random.default_rng(3)
    for window in (1, 2, 3, 8):
        sizes = rng.integers(0, 30, 40)
        lists = [rng.integers(0, 4, n).astype(np.uint64) for n in sizes]
        starts = np.cumsum(sizes) - sizes
        line = np.concatenate(lists)
        order, new, owner = page_text.suffix_groups(line, starts, window)
        got, key = collections.defaultdict(set), -1
        names = page_text.window_names(line, order, (starts + sizes)[owner] - order, window)
        for k, (o, w) in enumerate(zip(order, owner)):
            key += bool(new[k])
            got[key].add((int(w), int(o - starts[w])))
        want = collections.defaultdict(set)
        for w, x in enumerate(lists):
            for p in range(max(1, len(x) - window + 1) if len(x) else 0):
                want[tuple(x[p:p + window].tolist())].add((w, p))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
        assert len(set(names.tolist())) == len(want)


def brute(rows, window):
    """Texts of pages without declared articles, by dictionaries of windows."""
    parsed = [page_text.read_page(h or "") for _, _, h in rows]
    seen = collections.defaultdict(set)
    for (_, url, _), (_, _, content, streams) in zip(rows, parsed):
        for _, _, ends, _, raw in streams:
            x = np.frombuffer(raw, "<u8").tolist()
            for p in range(max(1, len(x) - window + 1)):
                seen[page_text.host_of(url), tuple(x[p:p + window])].add(content)
    cover, regions = [], collections.defaultdict(lambda: [0, 0, set()])
    for (_, url, _), (level, texts, content, streams) in zip(rows, parsed):
        mine = []
        for path, first, ends, _, raw in streams:
            x = np.frombuffer(raw, "<u8").tolist()
            hit = [False] * len(x)
            for p in range(max(1, len(x) - window + 1)):
                if len(seen[page_text.host_of(url), tuple(x[p:p + window])]) > 1:
                    hit[p:p + window] = [True] * len(hit[p:p + window])
            mine.append(hit)
            if level == 0 and first >= 0:
                r = regions[page_text.host_of(url), path]
                r[0], r[1] = r[0] + len(x), r[1] + sum(hit)
                r[2].add(content)
        cover.append(mine)
    out = []
    for (i, url, _), (level, texts, _, streams), mine in zip(rows, parsed, cover):
        gone = set()
        for (path, first, ends, _, _), hit in zip(streams, mine):
            if level or first < 0:
                continue
            n, c, pages = regions[page_text.host_of(url), path]
            for k, (s, e) in enumerate(zip([0, *ends], ends)):
                if all(hit[s:e]) or (len(pages) >= 3 and 2 * c >= n):
                    gone.add(first + k)
        left = [t for k, t in enumerate(texts) if k not in gone] or texts
        out.append((i, "\n".join(left), sum(map(sum, mine))))
    return out


def test_pages_without_marks_against_brute_force(spark):
    menu, legal, story = words(12), [words(20) for _ in range(3)], words(60)
    rows = []
    for k in range(60):
        body = f"<div>{menu}</div><div><p>{words(30)}</p><p>{words(RNG.randrange(1, 9))}</p></div>"
        body += f"<div><p>{legal[k % 3]}</p><p>{words(2)}</p></div>" if k % 2 else f"<p>{legal[k % 3]}"
        rows.append((k, f"https://h{k % 3}.example.org/{k}", body))
    copy = f"<div>{menu}</div><div><p>{story}</p></div>"
    rows += [(70, "https://h0.example.org/a", copy), (71, "https://h0.example.org/b", copy), (72, "https://h0.example.org/b", copy)]
    rows += [(73, None, "<p>lonely page"), (74, None, ""), (75, "https://h0.example.org/", None), (None, "//h1.example.org", f"<p>{menu}"),
             (76, "x", f"<article>{story}</article><nav>{menu}</nav>"), (77, "https://h0.example.org/long", f"<p>{words(20000)}</p><p>{menu}")]
    rows += [rows[3], rows[3], (76, "x", f"<nav>{menu}</nav><article>{story}</article>")]
    data = [(*r, "k", 1, "t") for r in rows]
    df = spark.createDataFrame(data, "page_id long, url string, html string, k1 string, host int, text string").repartition(4)
    for hot in (1_000_000, 3):
        got = [(r.page_id, r.text, r.n_repeated) for r in page_text.main_text(df, hot_rows=hot).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(got, key=key) == sorted(brute(rows, 8), key=key)
    texts = {r[0]: r[1] for r in got}
    assert texts[70] == story and menu not in texts[0] and texts[74] == "" and texts[75] == "" and texts[None] == menu


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert page_text.main_text(none).collect() == []
