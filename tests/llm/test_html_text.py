import re
import time

import numpy as np
import pytest

from headway.llm import html_text as h
from headway.llm import language

BODY = "This is a sentence of the article that goes on for a while, as they do. " * 3


def page(inner, head="<title>Site</title><style>p{}</style><script>var a='</p>';</script>"):
    return (f"<!DOCTYPE html><html lang='en'><head>{head}</head><body><nav><ul><li><a href='/'>Home</a>"
            f"</li><li><a href='/a'>About</a></li></ul></nav>{inner}<footer>&copy; us</footer></body></html>")


def test_article_is_taken_whole():
    got = h.extract(page(f"<div class='ad'>Buy now</div><article><h1>Title &amp; more</h1><p>{BODY}"
                         f"<p>Short.</p><p>a<br>b <b>c</b>\n d&nbsp;e</p><ul><li>one<li>two</ul></article>"))
    assert got.split("\n\n") == ["Title & more", " ".join(BODY.split()), "Short.", "a b c d e", "one",
                                 "two"]


@pytest.mark.parametrize("junk", [
    "<aside>Side</aside>", "<div class='sidebar'><p>Side</p></div>", "<div id=cookie-notice>Notice</div>",
    "<form><label>Name</label><input><textarea>x</textarea></form>", "<section class='comments'><article>"
    "<p>Nice post, I liked it a lot and said so at length here.</p></article></section>",
    "<div role='alert'>Notice</div>", "<script>var x = '<p>no</p>'</script>", "<noscript>no</noscript>",
    "<div id='comments'><p>A reader says something</p></div>", "<header><p>Banner</p></header>",
    "<p style='display: none'>no</p>", "<!-- <p>no</p> -->", "<span class='ad'>no", "<div class='ad-slot'>"
    "<div>no</div></div>", "<![if IE]>", "<iframe>no</iframe>"])
@pytest.mark.parametrize("place", ["before", "inside", "after"])
def test_what_is_no_article_text_goes(junk, place):
    parts = {"before": "", "inside": "", "after": ""}
    parts[place] = junk
    if place == "inside" and "<header>" in junk:
        return
    got = h.extract(page(f"{parts['before']}<article><p>{BODY}</p>{parts['inside']}<p>End.</p></article>"
                         f"{parts['after']}"))
    assert got == " ".join(BODY.split()) + "\n\nEnd."


REMARK = "I read this twice and still do not agree with what the author says there. "


@pytest.mark.parametrize("times", [1, 2, 25])
@pytest.mark.parametrize("junk", [
    "<div class='comments'><p>{}</p></div>", "<div id='cookie-notice'><p>{}</p></div>",
    "<div class='advert'>{}</div>", "<div class='sidebar'><p>{}</p><p>{}</p></div>",
    "<ul class='comment-list'><li>{}</li></ul>", "<section id='comments'><p>{}</p></section>",
    "<div class='newsletter'>{}</div>", "<div class='notice'><p>{}</p></div>",
    "<section class='user-comments'><article><p>{}</p></article></section>",
    "<p class='ad-box sponsored'>{}</p>", "<div class='share-buttons'><p>{}</p></div>"])
@pytest.mark.parametrize("around", ["article", "main", None])
def test_long_comments_adverts_and_notices_go(times, junk, around):
    junk = junk.replace("{}", f"{REMARK * times} x")
    text = f"<h1>Head</h1><p>{BODY}</p><p>{BODY}</p>"
    if around:
        got = h.extract(page(f"<{around}>{text}{junk}<p>{BODY}</p></{around}>"))
    else:
        got = h.extract(page(f"<div>{text}</div>{junk}<div><p>{BODY}</p></div>"))
    own = " ".join(BODY.split())
    assert got.split("\n\n") == ["Head", own, own, own]


@pytest.mark.parametrize("inner", ["<section class='social-sciences'>{}</section>",
                                   "<section id='cookies'>{}</section>", "<div class='has-sidebar'>{}</div>",
                                   "<div class='content-sidebar-wrap'><p>{}</p></div>"])
def test_names_with_other_words_drop_no_text(inner):
    own = " ".join(BODY.split())
    got = h.extract(page(f"<main><p>{BODY}</p>{inner.format(BODY)}</main>"))
    assert got.split("\n\n") == [own, own]


@pytest.mark.parametrize("piece", ["<a ", "<!--", "<", "</", "<!", "<?", "<![", "&", "&#", "<a x='",
                                   '<a x="', "<p", "<script>", "<!-- x", "<a b=c ", "<!--a>", "<p>x"])
@pytest.mark.parametrize("end", ["", ">"])
def test_a_megabyte_of_anything_takes_linear_time(piece, end):
    html = piece * (1_000_000 // len(piece)) + end
    began = time.process_time()
    h.extract(html)
    language.without_markup(html)
    assert time.process_time() - began < 20


def test_pages_without_an_article_element():
    menu = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(8))
    got = h.extract(f"<body><div class='top'><ul>{menu}</ul></div><div class='text'><h2>Head</h2><p>{BODY}</p>"
                    f"<p>{BODY}</p><p>Short.</p><p>{BODY}</p></div><div>Links <a href=x>a link</a></div></body>")
    assert got.startswith("Head\n\nThis is") and "Short." in got and "Item" not in got
    assert got.count("This is a sentence") == 9


@pytest.mark.parametrize("inner", [
    '<section id="discussion"><h2>Part</h2><p>{}</p></section>', '<h2 id="navigation">Part</h2><p>{}</p>',
    '<section id="chemical-reactions"><h2>Part</h2><p>{}</p></section>',
    '<div class="related-work"><h2>Part</h2><p>{}</p></div>', '<div id="discussion"><p>Part</p><p>{}</p></div>',
    '<section id="related-work"><h2>Part</h2><p>{}</p></section>', '<math><mi>Part</mi></math><p>{}</p>'])
@pytest.mark.parametrize("around", ["article", "main", 'article class="discussion"'])
def test_names_in_an_article_drop_no_dense_text(inner, around):
    got = h.extract(page(f"<{around}><p>{BODY}</p>{inner.format(BODY)}<p>End.</p></{around.split()[0]}>"))
    text = " ".join(BODY.split())
    assert got.split("\n\n") == [text, "Part", text, "End."]


@pytest.mark.parametrize("first, second", [("<div>{}</div>", "<div>{}</div>"), ("<blockquote>{}</blockquote>", "{}"),
                                           ("<table><tr><td>{}</td></tr></table>", "<div>{}</div>")])
@pytest.mark.parametrize("wrap", ["{}", "<div>{}</div>"])
@pytest.mark.parametrize("turned", [False, True])
def test_no_cluster_outside_the_largest_container_is_lost(first, second, wrap, turned):
    big = first.format("".join(f"<p>A{i}. {BODY}</p>" for i in range(6)))
    small = second.format("".join(f"<p>B{i}. {BODY}</p>" for i in range(2)))
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(8)) + "</ul>"
    got = h.extract(f"<body><div>{menu}</div>{wrap.format(small + big if turned else big + small)}"
                    f"<div>{menu}</div></body>")
    assert all(f"A{i}." in got for i in range(6)) and all(f"B{i}." in got for i in range(2))
    assert "Item" not in got


def test_class_of_a_wrapper_does_not_drop_the_article():
    got = h.extract(page(f"<div class='content-sidebar-wrap'><article><p>{BODY}</p></article></div>"))
    assert got == " ".join(BODY.split())


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), (" ", ""), ("plain text", "plain text"), ("<p>a", "a"), ("</p></div>x", "x"),
    ("<nav>only a menu</nav>", ""), ("a &lt;b&gt; &#233;&amp;amp;", "a <b> é&amp;"), ("<article>", ""),
    ("<article>word</article>", "word"), ("<<>><", "<<>><"), ("<article><p>x<nav>m", "x")])
def test_edges(html, text):
    assert h.extract(html) == text


def test_very_long_and_deep_pages():
    words = "word " * 200_000
    assert h.extract(f"<article><p>{words}</article>") == words.strip()
    assert h.extract("<div>" * 20_000 + "x") == "x"


def test_smoothing_is_a_weighted_mean():
    v = np.array([0.0, 0, 9, 0, 0])
    w = np.exp(-0.5 * (np.arange(-2, 3) / 1.5) ** 2)
    assert h.smoothed(v)[2] == pytest.approx(9 * w[2] / w.sum())
    assert h.smoothed(np.full(7, 3.0)) == pytest.approx(np.full(7, 3.0))


def test_every_test_page_gives_its_article(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in h.page_texts(pages).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_empty_table_and_nulls(spark):
    schema = "page_id long, url string, html string, text string"
    assert h.page_texts(spark.createDataFrame([], schema)).collect() == []
    rows = h.page_texts(spark.createDataFrame([(None, None, None, "old"), (1, "u", "<p>x", None)] * 2,
                                              schema)).collect()
    assert sorted(r.text for r in rows) == ["", "", "x", "x"]
