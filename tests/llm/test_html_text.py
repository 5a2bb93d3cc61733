import html
import re

from rowferry.llm.html_text import extract_text, main_text

SF = "/root/testdata/sf0.1"
LONG = "Several words of plain prose that stand in a paragraph of the article, one after the other. " * 3


def test_whole_table_against_markup(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract_text(pages).collect():
        article = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        parts = re.split("</?(?:p|h1)>", article)
        plain = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", " ", p))).strip() for p in parts)
        assert r.text == "\n".join(p for p in plain if p) and r.n_chars == len(r.text)


def test_surroundings_go():
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>
    <nav><a href=a>Home</a></nav><div class="cookie-notice"><p>{LONG}</p></div><div id=sidebar><p>{LONG}</p></div>
    <article><header><h1>Title &amp; more</h1></header><p>First\n  <b>bold</b>&nbsp;text. {LONG}<p>Second<script>x('</p>')</script> {LONG}
    <div class="ad"><p>Buy</p></div><ul><li>one<li>two</ul><form><p>Name</p></form></article>
    <section class="comments"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></section><aside>{LONG}</aside><footer>(c) {LONG}</footer></body></html>"""
    one = " ".join(LONG.split())
    assert main_text(page) == f"Title & more\nFirst bold text. {one}\nSecond {one}\none\ntwo"


def test_density_without_names():
    links = "".join(f"<li><a href=x>Some link {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div></div><div><a href=y>imprint of the site</a></div></body>"
    one = " ".join(LONG.split())
    assert main_text(page) == f"Head\n{one}\n{one}"


def test_broken_and_empty():
    assert [main_text(x) for x in (None, "", "   ", "<p>", "<!-- a", "<!-- <p>x</p>", "<p class='x", "<script>x", "<body></body>")] == [""] * 9
    assert main_text("just text &lt;here") == "just text <here"
    assert main_text("<article><p>cut of") == "cut of"
    assert main_text("<article><p>a<p>b</article></div></p></article><footer>f") == "a\nb"
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    assert main_text(deep) == "deep"
    assert main_text("<article>" + "<p>word &eacute;</p>" * 50_000 + "</article>") == "\n".join(["word é"] * 50_000)


def test_table_edges(spark):
    rows = [(1, None, "a"), (None, "<article><p>x</p></article>", "b"), (1, "<article><p>x</p></article>", "c")]
    out = extract_text(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert out.columns == ["page_id", "text", "n_chars"] and [r.text for r in out.collect()] == ["", "x", "x"]
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0
