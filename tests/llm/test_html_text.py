"""Main text of pages: fixed examples, the style tree, edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from threadsift.llm import html_text

CASES = [
    ("<article><h1>A &amp; B</h1><p>one<br>two <b>three\n  four</b></p></article><footer>x</footer>", "A & B\none two three four"),
    ("<body><nav><a href=/>menu</a></nav><main><p>p&eacute;<p>q<ul><li>i<li>j</ul></main>", "pé\nq\ni\nj"),
    ('<article>text<script>var t="</p>";</script><style>p{}</style><!-- c --><div class="ad x">buy</div></article>', "text"),
    ('<article><p>a</p><section id="comments"><p>nice</p></section><form>f</form><aside>s</aside></article>', "a"),
    ('<head><title>t</title></head><header>h</header><article><header><h1>title</h1></header>b</article>', "title\nb"),
    ("<p>loose &lt;b&gt;</p><div>more</div>", "loose <b>\nmore"),
    ('<div class="cookie-notice">ok?</div><p hidden>no</p><p>yes</p>', "yes"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table><pre>a\n b</pre></article>", "1\n2\n3\na b"),
    ("<article></b>x</i></article></div>y", "x"),
    ("", ""),
    (None, ""),
    ("   ", ""),
    ("plain text only", "plain text only"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_blocks(html, text):
    assert "\n".join(t for _, t, what in html_text.blocks_of(html) if what != 0) == text


def frame(spark, rows, **extra):
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name, value in extra.items():
        made = made.withColumn(name, F.lit(value))
    return made


def test_pages_as_rows(spark):
    rows = [(i, None if i % 3 == 0 else f"http://h{i % 2}.org/{i}", html) for i, (html, _) in enumerate(CASES)]
    rows += [(1, "http://h1.org/1", CASES[1][0]), (None, None, CASES[0][0])]
    got = sorted([tuple(r) for r in html_text.main_text(frame(spark, rows, page="x", text="t", host=1)).collect()], key=repr)
    texts = [t for _, t in CASES] + [CASES[1][1], CASES[0][1]]
    assert got == sorted([(i, u, t, len(t)) for (i, u, _), t in zip(rows, texts)], key=repr)
    assert html_text.main_text(frame(spark, [])).collect() == []


@pytest.mark.parametrize("shipped", [0, 200_000])
def test_branches_alike_on_every_page_of_a_host_go(spark, monkeypatch, shipped):
    monkeypatch.setattr(html_text, "SHIPPED", shipped)
    rows = []
    for i in range(12):
        body = "".join(f"<p>story {i} paragraph {j} of its own</p>" for j in range(1 + i % 4))
        rows.append((i, f"https://site.org/{i}", f'<body><div class="top"><span>Site name</span></div><div class="x">{body}</div><div class="low">all rights</div></body>'))
    rows.append((99, "https://other.org/", '<body><div class="low">all rights</div></body>'))
    got = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == "\n".join(f"story {i} paragraph {j} of its own" for j in range(1 + i % 4))
    assert got[99] == "all rights"


def test_given_pages_keep_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = html_text.main_text(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        import html

        words = html.unescape(re.sub(r"<[^>]*>", " ", article)).split()
        assert r.text.split() == words and r.n_chars == len(r.text)


NAMED = [
    ("<div class='container has-sidebar'><article><p>a</p></article><div class='sidebar'>s</div></div>", "a"),
    ("<div class='site has-fixed-header'><article>a</article></div>", "a"),
    ("<div class='sidebar widget'><main><p>a</p></main></div>", "a"),
    ("<div id='header'><p>menu</p></div><div class='header'><article>a</article></div>", "a"),
    ("<article><div class='entry-header'><h1>title</h1></div><p>a</p></article>", "title\na"),
    ("<article><div class='header'><h1>title</h1></div><p>a</p></article>", "title\na"),
    ("<article><div class='elementor-widget-text-editor elementor-widget-container'><p>a</p></div></article>", "a"),
    ("<article><p>a</p><div id='comments'><article class='comment-body'>nice</article></div></article>", "a"),
    ("<div class='no-comments'>open</div><div class='Comments'>c</div>", "open"),
    # Wrappers of whole pages are no chrome, whatever they are.
    ("<form><main><h1>t</h1><p>a</p></main></form>", "t\na"),
    ("<form id='aspnetForm'><article><p>a</p></article><input name='q'></form>", "a"),
    ("<div role='dialog'><main><p>a</p></main></div>", "a"),
    ("<div style='display: none'><article>a</article></div>", "a"),
    ("<form><p>name</p><button>send</button></form><p>a</p>", "a"),
    ("<nav><article>card</article></nav><p>a</p>", "a"),
    # Entries of comments and related texts may be articles; the text of the page stays.
    ("<div class='comments'><article>a comment</article></div><p>plain body</p>", "plain body"),
    ("<section id='comments'><article>one</article><article>two</article></section><div><h1>t</h1><p>body</p></div>", "t\nbody"),
    ("<div class='related-posts'><article><h3>card</h3></article></div><article><h1>t</h1><p>body</p></article>", "t\nbody"),
    ("<div class='comments'><main><h1>t</h1><p>a</p></main></div>", "t\na"),
    ("<div class='related'><article><h1>t</h1><p>a</p></article></div>", "t\na"),
    # Article elements that hold little of the page do not hide the rest.
    ("<article>short card</article><div><p>" + "long text " * 20 + "</p></div>", "short card\n" + ("long text " * 20).strip()),
    ("<article>" + "long text " * 20 + "</article><div>aside</div>", ("long text " * 20).strip()),
]


@pytest.mark.parametrize("html,text", NAMED)
def test_names_count_whole_and_never_cover_an_article(html, text):
    assert "\n".join(t for _, t, what in html_text.blocks_of(html) if what != 0) == text


@pytest.mark.parametrize("shipped", [0, 200_000])
def test_boilerplate_inside_articles_goes_and_copied_articles_stay(spark, monkeypatch, shipped):
    """With 0 the boilerplate is joined, else it is sent to the tasks."""
    monkeypatch.setattr(html_text, "SHIPPED", shipped)
    def own(i):
        return [f"story {i} has paragraph {j} with many words of its own" for j in range(2 + i % 3)]

    def page(title, paragraphs, more=""):
        return f"<article><h1>{title}</h1>{''.join(f'<p>{x}</p>' for x in paragraphs)}{more}</article>"

    notice = "<div>Read our terms.</div><p>Write to us.</p>"
    copied = [f"copied paragraph {j}" for j in range(6)]
    rows = [(i, f"http://a.org/{i}", page(f"story {i}", own(i), notice)) for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", f"<nav>{i}</nav>" + page("copied", copied)) for i in range(12)]
    rows += [(200 + i, f"http://c.org/{i}", page("near", [*copied, f"number {i}"])) for i in range(12)]
    rows += [(300 + i, f"http://d.org/{i}", page(f"title {i}", copied)) for i in range(12)]
    got = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == "\n".join([f"story {i}", *own(i)])
        assert got[100 + i] == "\n".join(["copied", *copied])
        assert got[200 + i] == "\n".join(["near", *copied, f"number {i}"])
        assert got[300 + i] == "\n".join([f"title {i}", *copied])


def test_both_ways_give_the_same_rows(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", "</?(article|nav|footer)[^>]*>", ""))
    frame_ = pages.unionByName(plain.withColumn("page_id", -F.col("page_id") - 1)).unionByName(pages.limit(3).withColumn("url", F.lit(None).cast("string")))
    found = []
    for shipped in (0, 200_000):
        monkeypatch.setattr(html_text, "SHIPPED", shipped)
        found.append(sorted((tuple(r) for r in html_text.main_text(frame_).collect()), key=repr))
    assert found[0] == found[1] and sum(len(r[2]) for r in found[0]) > 1000
