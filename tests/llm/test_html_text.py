"""HTML main text."""

import pytest

from docweave.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad-slot">buy</div>
<div class="cookie-notice">we use cookies</div>{body}<aside>side</aside><form><input>search</form>
<section id="comments"><p>first! what a long reader comment this is, longer than the article itself maybe</p></section><footer>foot</footer></body></html>"""


@pytest.mark.parametrize("body, expect", [
    ("<article><h1>A &amp; B</h1><p><b>one\n two<br>three<p>four <a href=x>five</a> six</article>", "A & B one two three four five six"),
    ('<div class="post-12"><p>x1 text here</p><ul><li>y<li>z</ul><blockquote>q&eacute;&#8212;</blockquote></div>', "x1 text here y z qé—"),
    ("<main><article>bare text <i>in</i>line<div>block</div></article></main>", "bare text inline block"),
    ("", ""),
])
def test_main_text(body, expect):
    assert H.main_text(PAGE.format(body=body), None) == expect


@pytest.mark.parametrize("body, expect", [
    ('<article><p class="share-price">it fell to 12</p><div class="alert-level">level 3 now</div><p class="related-work">others did so</p></article>',
     "it fell to 12 level 3 now others did so"),
    ('<article><p>the story</p><div class="related-posts"><p>more</p></div><div class="share-buttons">tell</div><div class="adSlot3">buy</div></article>',
     "the story"),
    ('<article><p>the story</p><div class="related-work"><a href=x>one of them</a> <a href=y>two</a></div><p>ends</p></article>', "the story ends"),
    ('<article class="lead"><p>short part</p></article><article class="rest"><p>the second and much longer part of the page</p></article>',
     "short part the second and much longer part of the page"),
    ("<article><p>as <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> here</p><noscript><p>plain</p></noscript></article>",
     "as a=2 here plain"),
    ("<noscript>turn scripts on</noscript><article><p>the story</p></article>", "the story"),
    ('<div class="share-price">up</div><article><p>the story of it</p></article>', "the story of it"),
])
def test_words_of_noise_need_a_second_sign_inside_an_article(body, expect):
    assert H.main_text(PAGE.format(body=body), None) == expect


def test_repeated_rows_and_tied_votes(spark):
    page = '<body><div class="one"><p>{0} of one</p></div><div class="two"><p>{0} of two</p></div></body>'
    rows = [(1, "https://t.example/1", page.format("text"))] * 2 + [(2, "https://t.example/2", page.format("word"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [sorted((r.page_id, r.text, r.path) for r in H.extract(d).collect()) for d in (df, df.repartition(3, "html"))]
    assert got[0] == got[1] and got[0][0] == got[0][1] and len(got[0]) == 3


def test_broken_markup_is_read():
    for bad in ["<", "<a href='x>never closed", "<div <p>>x", "<script>no end", "</p></div>text", "&amp", "<p>a<table><tr><td>b<td>c"]:
        assert isinstance(H.main_text(bad, None), str)
    assert H.main_text("</p></div>text", None) == "text"
    assert len(H.main_text("<article>" + "<p>word " * 20000, None)) == 5 * 20000 - 1


def test_host_vote_wins_over_a_page(spark):
    good = '<body><div class="text-{}"><p>the story of the day is told here at length</p></div><div class="more"><p>{}</p></div></body>'
    rows = [(i, f"https://h.example/{i}", good.format(i, "short")) for i in range(5)]
    rows += [(5, "https://h.example/5", good.format(5, "this box is longer than the story on this one page, " * 3)), (6, None, None), (7, "odd", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", H.F.lit(1))
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert [got[i] for i in range(6)] == ["the story of the day is told here at length"] * 6
    assert got[6] == got[7] == ""
    assert H.extract(df.limit(0)).count() == 0


def test_break_before_the_first_text_of_a_block():
    assert H.main_text("<nav>menu</nav><div class=content><br>First paragraph text</div>", None) == "First paragraph text"
    assert H.main_text("<div class=content>one<nav><br>menu<br></nav><br>two</div>", None) == "one two"
