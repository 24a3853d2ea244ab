"""Selector paths."""

import pytest

from docweave.functions.select import automaton, select_elements, select_paths
from docweave.operators.harvest import selected_markdown

HTML = ('<body><nav id="n"><ul><li><a href="/a" lang="en-GB">A</a></li><li><a>B</a></li></ul></nav>'
        '<div class="post wide"><p>one</p><div><p data-k="x y">two</p></div><section><p>three</p></section></div>'
        '<article><h1>T</h1><div><h1>U</h1></div><img src="pic.png"></article></body>')

CASES = [
    (["nav a"], '<a href="/a" lang="en-GB">A</a>\n<a>B</a>'),
    (["nav a[href]"], '<a href="/a" lang="en-GB">A</a>'),
    (["article > h1"], "<h1>T</h1>"),
    (["article h1"], "<h1>T</h1>\n<h1>U</h1>"),
    (["div.post > p", "div div p"], '<p>one</p>\n<p data-k="x y">two</p>'),
    (["body > div section > p"], "<p>three</p>"),
    (["section > p, nav li > a[href^='/a']"], '<a href="/a" lang="en-GB">A</a>\n<p>three</p>'),
    (["article > *"], '<h1>T</h1>\n<div><h1>U</h1></div>\n<img src="pic.png">'),
    (["[lang|=en]", 'img[src$=".png"]', "p[data-k~=y]"], '<a href="/a" lang="en-GB">A</a>\n<img src="pic.png">\n<p data-k="x y">two</p>'),
    (["nav > a"], ""),
    (["#n > ul > li > a[lang=en-GB]"], '<a href="/a" lang="en-GB">A</a>'),
    (["DIV.wide P"], '<p>one</p>\n<p data-k="x y">two</p>\n<p>three</p>'),
]


@pytest.mark.parametrize("selectors, expected", CASES)
def test_paths(selectors, expected):
    assert select_paths(HTML, selectors) == expected


@pytest.mark.parametrize("selector", ["", "p:hover", "> p", "p >", "p,", "a + b", "[=x]", "p..x"])
def test_unsupported_selectors_give_null(selector):
    assert automaton((selector,)) is None and select_paths(HTML, ["p", selector]) is None


def test_column_form_and_no_python_without_selectors(spark):
    df = spark.createDataFrame([(1, ["article > h1"], HTML), (2, [], HTML), (3, None, HTML)], "page_id long, selectors array<string>, html string")
    assert [r[0] for r in df.select(select_elements("html", ["nav a[href]"])).collect()] == ['<a href="/a" lang="en-GB">A</a>'] * 3
    out = selected_markdown(df)
    got = {r.page_id: r.content for r in out.collect()}
    assert got[1].strip() == "# T" and got[2] == got[3] and "one" in got[2]
    plan = selected_markdown(df)._jdf.queryExecution().optimizedPlan().toString()
    branches = plan.split("Generate")
    assert plan.count("ArrowEvalPython") == 1 and len(branches) > 2
