from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from hackney.llm import html_templates, queries
from tests.llm.conftest import CLASHING, rows

PAGES = "page_id long, url string, html string"


def text_of(page):
    return html_templates.extract_group([page])[0]


def test_given_pages(spark):
    """The given pages keep everything within `article`; paragraphs and headings are blocks."""
    data = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    found = queries.op2_html_templates(spark, data).collect()
    assert sorted(r.page_id for r in found) == sorted(pages)
    for r in found:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.DOTALL)[1]
        blocks = re.split(r"</?p>|</?h1>", re.sub(r"</?b>|<br>", " ", article))
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(line for line in lines if line)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\nb"),
        ("<p>a <b>b</b>c<br>d\n\t e</p>", "a bc d e"),
        ("<article><p>x</p><aside>no</aside><p>y</article><p>z", "x\ny"),
        ("<main><header><h1>T</h1></header><p>x</main><footer>f</footer>", "T\nx"),
        ("<header>menu</header><p>x</p><footer>f</footer>", "x"),
        ("<div class='post sidebar-left'>no</div><div id=content>yes</div>", "yes"),
        ('<div class="ad">no</div><p class="lead">yes', "yes"),
        ('<div id="cookie-notice">no</div><div role="navigation">no</div><p>yes', "yes"),
        ('<article><p>x</p><section class="comments"><p>reader</p></section></article>', "x"),
        ("<form><p>no<input></form><p>yes", "yes"),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no --><p>yes", "yes"),
        ("<p>yes<script>no", "yes"),
        ("<p>yes<!-- no", "yes"),
        ("<p>1 < 2 &lt; 3 &#233;&#xE9;&eacute; &nosuch; a&nbsp;b", "1 < 2 < 3 ééé &nosuch; a b"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ('<p title="a > b">x</p><p title="unclosed>y</p><p>z', "x\ny\nz"),
        ("</div></p>x</article>y", "x\ny"),
        ("<P>A</P><DIV CLASS=AD>no</DIV>", "A"),
        ("<p>tail <", "tail <"),
    ],
)
def test_mark_up(page, text):
    assert text_of(page) == text


def site(k, main):
    return (
        f"<html><body><div class=top>Home of news</div><div class=box><ul><li>Start<li>Page {k % 3}"
        f"</ul></div><div class=text><h2>Story {k}</h2>{main}</div><div class=end>All rights</div>"
    )


def test_template_texts_go_where_no_landmark_helps():
    pages = [site(k, "".join(f"<p>Words {k} {j}</p>" for j in range(k % 4))) for k in range(12)]
    for k, text in enumerate(html_templates.extract_group(pages)):
        assert text == "\n".join(
            [f"Page {k % 3}", f"Story {k}", *(f"Words {k} {j}" for j in range(k % 4))]
        )
    # Copies of one page tell nothing about a template.
    assert html_templates.extract_group([pages[1]] * 5) == [text_of(pages[1])] * 5


def test_classes_and_nesting():
    pages = [
        html_templates.read_page(site(k, f"<p>one {k}").replace("Start", f"Part {k}"))
        for k in range(6)
    ]
    template = html_templates.deduce_template(pages)
    frame = [kind for kind in template.frame if kind[0] == "begin"]
    tags = [tag for _, _, tag in frame]
    assert tags[:3] == ["html", "body", "div"] and "h2" in tags
    items = [t for t in template.nested if t[2] == "li" and t[0] == "begin"]
    assert len(items) == 1  # twice on each page, so a class of its own within one slot
    place = template.frame.index(next(t for t in template.frame if t[2] == "ul"))
    assert template.nested[items[0]] == place + 1


def test_fixed_text_in_an_article_stays():
    pages = [f"<nav>x</nav><article><p>Same in all</p><p>Own {k}</p></article>" for k in range(5)]
    assert html_templates.extract_group(pages) == [f"Same in all\nOwn {k}" for k in range(5)]


def test_template_texts_go_within_landmarks():
    pages = [
        f"<article><div class=a1>Follow us</div><p>Same in all<p>Own {k}<div class=a2>Read on at"
        f"</div></article><div>List {k}</div>"
        for k in range(6)
    ]
    assert html_templates.extract_group(pages) == [f"Same in all\nOwn {k}" for k in range(6)]
    # A landmark without a slot says nothing of where the main text is.
    pages = [f"<main><div>Welcome</div></main><div class=x><p>Story {k}</div>" for k in range(6)]
    assert html_templates.extract_group(pages) == [f"Story {k}" for k in range(6)]


@pytest.mark.parametrize(
    "odd", ["", "<html><body><p>Moved</p>", "<div id=x><table><tr><td>Other layout</table></div>"]
)
def test_odd_pages_leave_the_template(odd):
    pages = [site(k, f"<p>Words {k}</p>") for k in range(12)]
    want = html_templates.extract_group(pages)
    assert want[4] == "Page 1\nStory 4\nWords 4"
    found = html_templates.extract_group([*pages[:5], odd, *pages[5:]])
    assert found == [*want[:5], text_of(odd), *want[5:]]


def test_texts_of_half_of_the_pages():
    notice = "<div class=top2>Prices may vary</div>"
    pages = [site(k, f"<p>Words {k}</p>" + notice * (k % 4 > 0)) for k in range(12)]
    for k, text in enumerate(html_templates.extract_group(pages)):
        assert text == f"Page {k % 3}\nStory {k}\nWords {k}"
    # In varying numbers and within sentences, it may be no template's.
    pages = [f"<div>Top</div><p>{' and '.join(f'<b>w{k} {j}</b>' for j in range(1 + k % 4))}" for k in range(12)]
    for k, text in enumerate(html_templates.extract_group(pages)):
        assert text == " and ".join(f"w{k} {j}" for j in range(1 + k % 4))


def test_groups_do_not_depend_on_partitions(spark):
    pages = [
        (k, f"http://h{k % 3 if k < 100 else 0}/", site(k, f"<p>{k}") + f"<div>Part {k * 7919 % 101 % 2}")
        for k in range(600)
    ]
    frame = spark.createDataFrame(pages, PAGES)
    backwards = frame.orderBy(F.desc("page_id")).repartition(7)
    first, second = (
        rows(html_templates.extract(f, group_pages=8)) for f in (frame.repartition(1), backwards)
    )
    assert first == second


def test_odd_rows(spark):
    big = "<article>" + "<p>para &amp; graph</p>" * 20_000 + "</article>"
    pages = [(1, "http://h/1", None), (2, "http://h/2", ""), (None, None, "<p>a"), (3, "x", "<p>b")]
    pages += [(4, "http://h/4", "<p>c"), (4, "http://h/4", "<p>c"), (5, "http://h/5", big)]
    pages += [(k, "http://hot/", f"<nav>n</nav><p>text {k}") for k in range(100, 400)]
    wide = spark.createDataFrame(pages, PAGES).withColumns({c: F.lit(1) for c in [*CLASHING, "host"]})
    found = rows(html_templates.extract(wide, group_pages=16))
    want = {(None, None, "a"), (1, "http://h/1", ""), (2, "http://h/2", ""), (3, "x", "b")}
    assert want <= set(found) and len(found) == len(pages)
    assert found.count((4, "http://h/4", "c")) == 2
    assert (5, "http://h/5", "\n".join(["para & graph"] * 20_000)) in found
    assert {(k, "http://hot/", f"text {k}") for k in range(100, 400)} <= set(found)
    assert rows(html_templates.extract(wide.limit(0))) == []


def test_attributes_are_read_by_their_whole_names():
    page = '<article><p data-id="share">Body text.</p><p title=\'class="menu"\'>Other</p><p data-role="alert" ID=x>More</p></article>'
    assert html_templates.extract_group([page]) == ["Body text.\nOther\nMore"]


@pytest.mark.parametrize("name", ['class="side-effects"', 'id="related-work"', 'class="share-price history"'])
def test_sections_of_an_article_keep_their_text(name):
    page = f"<article><p>First.</p><section {name}><p>Second.</p></section></article>"
    assert html_templates.extract_group([page]) == ["First.\nSecond."]


@pytest.mark.parametrize("name", ["comments", "related-posts", "share-buttons", "ad ad-slot", "newsletter-box"])
def test_boilerplate_within_an_article_goes(name):
    page = f'<article><p>First.</p><div class="{name}"><p>Second.</p></div></article>'
    assert html_templates.extract_group([page]) == ["First."]


def test_headings_go_with_what_they_head():
    pages = [
        f"<article><h1>Title {k}</h1><h2>Summary</h2><p>About {k}.</p><h3>More</h3><h4>Here</h4><p>Text {k}.</p>"
        f"<h5>Follow us</h5><p class=f>On all days.</p></article>"
        for k in range(6)
    ]
    texts = html_templates.extract_group(pages)
    assert texts == [f"Title {k}\nSummary\nAbout {k}.\nMore\nHere\nText {k}." for k in range(6)]


@pytest.mark.parametrize("n", [65, 129, 200, 321])
def test_no_page_is_left_alone(spark, n):
    """Every page meets others of its host, so the notice that all share goes on each."""
    rows = [(k, f"http://h.org/{k}", f"<div><p>Text {k} here.</p></div><div><i>All rights kept</i></div>") for k in range(n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for share in (1e-5, 2.0):
        found = html_templates.extract(pages, heavy_share=share).collect()
        assert {r.text for r in found} == {f"Text {k} here." for k in range(n)}


def test_groups_do_not_depend_on_other_hosts(spark):
    """A host that is heavy among few pages and light among many has the same groups."""
    rows = [(k, f"http://h.org/{k}", f"<div><p>{k}</p><p>Notice {k % 3}</p></div>") for k in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    heavy, light = (
        {r.page_id: r.text for r in html_templates.extract(pages, heavy_share=s).collect()} for s in (1e-5, 2.0)
    )
    assert heavy == light
