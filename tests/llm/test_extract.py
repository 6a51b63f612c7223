import html
import re
import time

import pytest

from batchkit.llm import extract, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def body(inner, head="<title>t</title><style>p{x:y}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{inner}</body></html>"


def own(source):
    return extract.main_text(extract.parse(source), None)


def plain(page):
    """The article of a page of the test tables, by cutting its markup away."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?p>|</?h1>", article)
    bare = (re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", b)) for b in blocks)
    texts = (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in bare)
    return "\n".join(t for t in texts if t)


def test_the_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = queries.op8_html_extraction(spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        text = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b", "a\nb"),
        ("<p>a &lt;b&gt; &amp;amp; &eacute;&#8211;&#x41;</p>", "a <b> &amp; é–A"),
        ("<div>one\n <b>two</b><br>three</div>", "one two three"),
        ("<ul><li>x<li>y</ul>", "x\ny"),
        ("<p>a</p><script>if (a<b) '</p>'</script><p>b", "a\nb"),
        ("<p>a<!-- <p>no</p> -->b</p>", "ab"),
        ("a < b and c", "a < b and c"),
        ("<p>cut off <a hre", "cut off"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ],
)
def test_text_of_a_page(source, text):
    assert own(source) == text
    assert own(body(f"<article>{source}</article>")) == text


def test_what_stands_apart():
    apart = (
        "<nav><a href=x>menu</a></nav><header>head</header><footer>foot</footer><aside>side</aside>"
        "<div class='cookie-notice'>notice</div><div class=ad>buy</div><form>search<input></form>"
        "<div id=comments><p>reader says</p></div><ul class=breadcrumbs><li>a</ul><p hidden>no</p>"
        "<div class='sidebar left'>x</div><noscript>on</noscript><button>b</button>"
    )
    source = body(f"{apart}<main><h1>Title</h1><p>Text {'word ' * 30}</p>{apart}<p>End.</p></main>{apart}")
    assert own(source) == f"Title\nText {'word ' * 30}".strip() + "\nEnd."
    # a class that only contains such a word in another is not apart
    assert own("<div class=headline><p>a</p></div><div class='uploads'><p>b</p></div>") == "a\nb"


LONG = "word " * 60
SCRAPS = "<div class=top>Our daily paper</div><div class=sidebar>about us</div><div id=comments><p>reader says</p></div>"


@pytest.mark.parametrize("wrapper", ["content-sidebar-wrap", "post has-sidebar", "post category-social", "page comments-open"])
@pytest.mark.parametrize("story", ["<article><h1>T</h1><p>{}</p></article>", "<h1>T</h1><p>{}</p>", "<p>T</p><p>{}</p>"])
def test_a_word_does_not_drop_a_wrapper_of_the_main_text(wrapper, story):
    inner = f"{story.format(LONG)}<div class='sidebar widget'>{'side ' * 20}</div>"
    text = own(body(f"{SCRAPS}<div class='{wrapper}'>{inner}</div>{SCRAPS}"))
    assert "T\n" + LONG.strip() in text
    assert "side" not in text and "reader" not in text and "about" not in text
    # two wrappers, and a text shorter than what stands apart
    text = own(body(f"<div class={wrapper.split()[-1]}><div class='{wrapper}'>{story.format('short text here')}</div>"
                    f"<div class=sidebar>{'side ' * 2}</div></div>"))
    assert text == "T\nshort text here"


def test_comments_longer_than_the_article_stand_apart():
    said = "".join(f"<article class=comment-body><p>reader {LONG}</p></article>" for _ in range(9))
    source = body(f"<main><article><h1>T</h1><p>{LONG}</p></article><div id=comments>{said}</div></main>")
    assert own(source) == "T\n" + LONG.strip()


def test_titles_and_sections_stay_together():
    parts = "".join(f"<section><p>{'word ' * 80}{k}</p></section>" for k in range(5))
    text = own(body(f"<div class=ad>x</div><article><h1>T</h1><div class=text>{parts}</div></article>"))
    assert text.startswith("T\nword") and text.count("\n") == 5


@pytest.mark.parametrize(
    "source",
    [
        "<div class=content><h1>The title</h1><div class=text>{}</div></div>",
        "<div class=content><div class='w-1/2/3/4/5/6/7/8'>{}</div><p>The title</p></div>",
        "<main><h1>The title</h1><article>{}</article></main>",
        "<div class=page><h1>The title</h1><article>{}</article></div><div>scraps</div>",
        "<div class=content><h1><a href=x>The title</a></h1><div class=text>{}</div></div><p><a href=y>more</a></p>",
    ],
)
def test_long_pages_keep_what_stands_beside_the_inner_container(source):
    paragraphs = f"<p>{LONG}</p>" * 40
    lines = own(body(source.format(paragraphs))).split("\n")
    assert sorted(lines) == sorted(["The title", *[LONG.strip()] * 40])


def test_the_innermost_of_equal_containers_has_the_path():
    path, _ = extract.best_path(extract.parse(body("<div class=a><div class=b><div class='c/d'><p>text</p></div></div></div>")))
    assert path.endswith("div.b/div.c/d")


def page(k, text, more=""):
    return body(f"<div class='wrap w{k}'><div class='post post-{k}'><p>{text}</p></div><div class=box>{more}</div></div>")


def test_the_host_decides(spark):
    # on page 9 the box is longer than the post, but the host's pages agree on the post
    data = [(k, f"http://a.example/{k}", page(k, "words " * 40)) for k in range(9)]
    data += [(9, "http://user@A.example:80/9", page(9, "short", "<p>" + "box " * 90 + "</p>"))]
    data += [(10, "http://b.example/", page(10, "short", "<p>" + "box " * 90 + "</p>"))]
    data += [(11, "http://a.example/other", "<main><p>no such path</p></main>")]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got[9] == "short" and got[11] == "no such path"
    assert got[10].startswith(("box", "short\nbox"))


def test_edges(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    data = [(1, None, None), (2, "no host", ""), (3, "http://x/", long), (3, "http://x/", long)]
    data += [(None, "http://x/", "<p>a</p>"), (5, "http://x/", "<div>" * 2000 + "deep")]
    df = spark.createDataFrame([(*r, "c", "p") for r in data], SCHEMA + ", host string, path string")
    rows = extract.extract(df).collect()
    assert len(rows) == 6
    by_id = {r.page_id: r for r in rows}
    assert (by_id[1].text, by_id[1].url, by_id[2].text) == ("", None, "")
    assert by_id[3].n_chars == 20_000 * 16 - 1 and by_id[None].text == "a" and by_id[5].text == "deep"
    assert extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p><a title=it's>link</a> two</p><p>Three isn't four</p>", "link two\nThree isn't four"),
        ("<p>a <img src=\"x\"\" alt=\"it's\"> b</p><p>c's</p>", "a b\nc's"),
        ("<p title = \"a > b\">c</p><p title='>'>d</p>", "c\nd"),
        ("<p>a<!-->b</p><!---><p>c</p><p>d<!-- x --!>e</p>", "ab\nc\nde"),
        ("<p>a <b x=\"never closed>b</b></p><p>c</p>", "a b\nc"),
        ("<div class='related-work'><p>a</p></div><p class='tags-explained'>b</p>", "a\nb"),
        ("<div class=related-posts><a href=x>one</a> <a href=y>two</a></div><p>b</p>", "b"),
        ("<header><h1>Title</h1><p>by somebody</p></header><p>b</p>", "Title\nb"),
        ("<header>no heading</header><p>b</p>", "b"),
    ],
)
def test_no_text_of_an_article_is_lost(source, text):
    assert own(body(f"<header>site</header><article>{source}</article>")) == text
    assert own(body(f"<nav>menu</nav><main>{source}</main>")) == text


@pytest.mark.parametrize("unit", ["<font>x ", "<div>", "<div><p>word ", "<span class=a>", "<li>a<b>", "</i><i>"])
def test_reading_is_linear(unit):
    source = unit * (1_000_000 // len(unit)) + "<p>the end"
    start = time.perf_counter()
    path, _ = extract.best_path(extract.parse(source))
    assert extract.main_text(extract.parse(source), path).endswith("the end")
    assert time.perf_counter() - start < 10


def test_tied_votes_go_to_the_first_path(spark):
    data = [(k, "http://t.example/", f"<body><div class={c}><p>same text</p></div>") for k, c in enumerate("baba")]
    data += [(5, "http://t.example/5", "<body><div class=b><p>in b</p></div><div class=a><p>in a</p></div>")]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got[5] == "in a" and got[0] == got[1] == "same text"
