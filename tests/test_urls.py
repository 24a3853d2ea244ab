from pyspark.sql import functions as F

from conftest import one_col
from docweave.functions import paths as P
from docweave.functions import transcripts as T
from docweave.functions import urls as U
from docweave.functions.content import is_nonblank

P1_CASES = [
    ("http://x/a/?utm_source=z", "http://x/a/"),
    ("http://x//", "http://x/"),
    ("http://x/a?b=/", "http://x/a"),
    ("http://x/a?utm_id=1&utm_source=2", "http://x/a?utm_id=1"),
    ("http://x/a?q=1/#f", "http://x/a?q=1"),
    ("HTTP://X.com/A", "http://X.com/A"),
    ("http://x/a?b=1;c=2", "http://x/a?b=1%3Bc%3D2"),
    ("http://x/a?a=%C3%BC&a=ü", "http://x/a?a=%C3%BC&a=%C3%BC"),
    ("http://x/?x=1&y=2&x=3", "http://x/?x=1&x=3&y=2"),
    ("http://x/?b=&c=1", "http://x/?c=1"),
    ("http://x/?flag", "http://x/"),
    ("http://x/?q=a/b c~*", "http://x/?q=a%2Fb+c~%2A"),
    ("http://x/?q=%zz&r=%20", "http://x/?q=%25zz&r=+"),
    (None, None),
    ("", ""),
    ("http://x/?&&=&a=1&a=1", "http://x/?a=1&a=1"),
]


def test_normalize_url_cases(spark):
    got = one_col(spark, [c for c, _ in P1_CASES], U.normalize_url("x"))
    assert got == [e for _, e in P1_CASES]


def test_normalize_not_idempotent_and_fragment_invariant(spark):
    got = one_col(spark, ["http://x/a/?utm_source=z", "http://x/a/", "http://x/a?b=1#frag", "http://x/a?b=1"], U.normalize_url("x"))
    assert got[0] == "http://x/a/" and got[1] == "http://x/a"
    assert got[2] == got[3]


def test_cleanup_url(spark):
    cases = [None, "", "http://x/a?utm_x=1&b=2&b=3&c#f", "http://x/a/", "http://x/a?k=v"]
    got = one_col(spark, cases, U.cleanup_url("x"))
    assert got == [None, "", "http://x/a?b=3", "http://x/a", "http://x/a?k=v"]


def test_extract_domain(spark):
    got = one_col(spark, ["HTTP://u:p@WWW.Ex.com:80/A", "http://[::1]:8/x", "example.com/x", "https://www.www.a.org"], U.extract_domain("x"))
    assert got == ["ex.com", "::1", "", "www.a.org"]


def test_same_and_subdomain(spark):
    df = spark.createDataFrame(
        [("https://old.wiki.acorn.test/x", "http://wiki.acorn.test/y"), ("https://shop.acorn.test/x", "http://wiki.acorn.test/y"),
         ("http://www.acorn.test", "https://acorn.test:8443/z"), ("x", "y"), (None, "http://a.test/")], "a string, b string")
    r = df.select(U.is_same_domain("a", "b").alias("s"), U.is_subdomain("a", "b").alias("d")).collect()
    assert [(x.s, x.d) for x in r] == [(False, True), (False, False), (True, True), (False, False), (False, False)]


def test_sanitize_and_paths(spark):
    assert one_col(spark, ["a b//c", "___", "x" * 130 + ".html", "y" * 130], P.sanitize_filename("x")) == [
        "a_b_c", "unnamed", "x" * 115 + ".html", "y" * 120]
    paths = one_col(spark, ["http://x/a;p/b;q?z", "http://x/", "http://x//", "example.com/x"], P.build_output_path("out", F.col("x")))
    assert paths == ["out/x/a_p_b.md", "out/x/index.md", "out/x/unnamed.md", "out/unknown/example.com_x.md"]


def test_document_path_boundary(spark):
    n117 = "http://x/" + "a" * 114  # name a*114 + ".md" = 117 characters
    n118 = "http://x/" + "a" * 118  # 118 + ".md" > 120 -> hashed
    got = one_col(spark, [n117, n118], P.document_path("out", F.col("x")))
    assert got[0] == "out/x/" + "a" * 114 + ".md"
    assert got[1].startswith("out/x/" + "a" * 87 + "_") and got[1].endswith(".md") and len(got[1].split("/")[-1]) == 87 + 1 + 8 + 3


def test_format_bytes(spark):
    got = one_col(spark, [256, 1280, 1792, 1024 ** 2, 5 * 1024 ** 5], P.format_bytes(F.col("x")), "x long")
    assert got == ["256.0 B", "1.2 KB", "1.8 KB", "1.0 MB", "5.0 PB"]


def test_nonblank(spark):
    got = one_col(spark, ["\t\n", "\x1c", "\xa0", " a ", ""], is_nonblank(F.col("x")))
    assert got == [False, False, False, True, False]


def test_video_id_cases(spark):
    cases = {"https://www.youtube.com/watch?list=p&v=Zz9_-yX0qA1&t=3": "Zz9_-yX0qA1", "youtu.be/0123456789a?si=b": "0123456789a",
             "http://youtube.com/embed/__________-": "__________-", "https://youtu.be/short": None, "https://acorn.test/watch?v=0123456789a": None}
    assert one_col(spark, list(cases), T.video_id("x")) == list(cases.values())


def test_transcript_clean(spark):
    assert one_col(spark, ["[0:00:1]<spk>hi</spk> [12:3:45]there"], T.clean_transcript("x")) == ["hi</spk> there"]


def test_unknown_hash_rejected():
    import pytest

    with pytest.raises(ValueError):
        U.content_hash("x", "crc32")


def test_select_html_general():
    from docweave.functions.select import select_html

    html = '<div class="x ad" id="t"><p>a<p>b<div class="ad">in</div></div><h1>T</h1><ul><li>1<li>2</ul>'
    assert select_html(html, ["div.ad"]) == '<div class="x ad" id="t"><p>a<p>b<div class="ad">in</div></div>'
    assert select_html(html, ["h1", "#t"]) == '<h1>T</h1>\n<div class="x ad" id="t"><p>a<p>b<div class="ad">in</div></div>'
    assert select_html(html, ["li"]) == "<li>1\n<li>2"
    assert select_html(html, []) == html
