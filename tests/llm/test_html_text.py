import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm import html_text as h

SCHEMA = "page_id long, url string, html string"


def text(page):
    return h.main_text(h.lines(page), None)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<article><h1>T &amp; t</h1><p>a  b<i>c</i>\n d.</p></article>", "T & t\na bc d."),
        ("<nav>x</nav><article><p>one<p>two</article><footer>y</footer>", "one\ntwo"),
        ("<article><p><b>Head<br><p>body</article>", "Head\nbody"),
        ("<main><header>h</header><aside>a</aside><form>f<input></form><p>m</p><div class='comments'><p>c</p></div></main>", "m"),
        ("<article><div class=\"ad-slot\">buy</div><div id=sidebar>s</div><div role='navigation'>n</div><p class=\"lead\">ok</p></article>", "ok"),
        ("<article><script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>&lt;yes&gt;&nbsp;&#233;</p></article>", "<yes> é"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\na\nb\nc"),
        ("<body><p>no container</p></body>", "no container"),
        ("<article><p>cut off", "cut off"),
        ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<article><p>x</p><!-- never closed", "x"),
        ("<article><p hidden>x</p><p>y</p></article>", "y"),
        ("<body class='has-sidebar'><div class='page with-comments'><div class='ad'>z</div><article><p>x</p><div class='ad'>y</div></article></div>", "x"),
        ("<div role='main'><p>x</p></div><p>out</p>", "x"),
        ("<article><a title=\"never closed>x</a> y</article>", "x y"),
        ("<article></b></i></div><p>x</span></p></article>", "x"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ],
)
def test_structure(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page", ["<b>" * 20_000 + "x", "</z>" * 50_000 + "x", "<a title='" * 3_000 + "x", "<div>" * 30_000 + "x" + "</p>" * 30_000, "<" * 50_000 + "x", "<!--" * 20_000, "<p><b>" * 20_000 + "x"])
def test_odd_pages_end(page):
    start = time.perf_counter()
    text(page)
    assert time.perf_counter() - start < 5


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_common_is_a_longest_common_subsequence(a, b):
    got = sorted(h.common(a, b))
    assert len(got) == longest(a, b)
    it = iter(b)
    assert all(a[i] in it for i in got)


def test_pages_without_a_container_lose_what_neighbours_share(spark):
    frame = "<p>Site name</p><p>Menu one</p>{}<p>All rights reserved</p>"
    rows = [(i, f"http://h{i % 3}.example/en/{i // 3:03d}", frame.format(f"<p>story {i}</p><p>more of {i}</p>")) for i in range(60)]
    rows += [(100, "http://h0.example/zz", "<article><p>Site name</p><p>kept</p></article>"), (101, "http://lonely.example/", frame.format("<p>x</p>")), (102, None, frame.format("<p>y</p>")), (103, "http://same.example/a", frame.format("<p>z</p>")), (104, "http://same.example/a", frame.format("<p>z</p>"))]
    # copies look past each other, however many there are
    rows += [(200 + k, f"http://trio.example/a/{k:03d}", frame.format("<p>news</p>")) for k in range(40)] + [(300, "http://trio.example/b", frame.format("<p>else</p>"))]
    random.Random(0).shuffle(rows)
    got = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(rows)
    for i in range(60):
        assert got[i] == f"story {i}\nmore of {i}"
    assert {got[200 + k] for k in range(40)} == {"news"} and got[300] == "else"
    whole = "Site name\nMenu one\n{}\nAll rights reserved"
    assert got[100] == "Site name\nkept"
    assert (got[101], got[102], got[103], got[104]) == (whole.format("x"), whole.format("y"), whole.format("z"), whole.format("z"))


def test_boxes_that_neighbours_share_go_from_articles_too(spark):
    page = "<main><div class='wrap'><article><h1>Title {0}</h1><div class='x9'><p>Read our terms</p><p>Ask us</p></div><p>body {0}</p><p>said before</p><div id='part'><p>said before</p><p>own {0}</p></div><p>end {0}</p></article></div></main>"
    rows = [(i, f"http://h.example/{i:02d}", page.format(i)) for i in range(30)]
    # a republished article stays whole, and its neighbours take nothing from each other
    again = "<article><div id='a'><p>one</p><p>two</p></div><p>three</p><p>four</p><p>note {0}</p></article>"
    rows += [(50 + i, f"http://again.example/{i}", again.format(i)) for i in range(4)]
    got = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(rows)
    for i in range(30):
        assert got[i] == f"Title {i}\nbody {i}\nsaid before\nsaid before\nown {i}\nend {i}"
    for i in range(4):
        assert got[50 + i] == f"one\ntwo\nthree\nfour\nnote {i}"


def test_edges(spark, clashing):
    rows = [(1, "http://a/b", None), (2, None, None), (None, "http://a/c", "<article><p>q</p></article>"), (3, "::no url", "<p>r</p>"), (3, "::no url", "<p>r</p>"), (4, "http://a/x", "<article>" + "<p>long text</p>" * 20_000 + "</article>")]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    got = h.extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 20_000 * 10 - 1)]
    assert all(r.n_chars == len(r.text) for r in got)
    assert h.extract(df.limit(0)).collect() == []


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in h.extract(df).collect()}
    for r in df.collect():
        body = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert got[r.page_id].n_chars == len(got[r.page_id].text) > 0
        assert got[r.page_id].text == text(body + "</article>")
        assert "<p>" not in got[r.page_id].text and "&copy;" not in got[r.page_id].text
