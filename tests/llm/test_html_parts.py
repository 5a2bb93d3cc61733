"""Pages whose article is in several parts, whose head is left open, or whose wrappers have noisy names."""

import re

import pytest

from rowferry.llm.html_text import main_text

PLAIN = "Plain words of a paragraph that goes on for a while. "


def section(n, size=300, name="p"):
    texts = [f"{name} {i} {PLAIN * 9}"[: size - 1].strip() for i in range(n)]
    return f"<section>{''.join(f'<p>{t}</p>' for t in texts)}</section>", texts


@pytest.mark.parametrize("one,two", [(20, 3), (10, 2), (12, 6), (3, 20), (1, 30)])
@pytest.mark.parametrize("size", [100, 300])
def test_sections_of_different_length(one, two, size):
    a, first = section(one, 300, "a")
    b, second = section(two, size, "b")
    links = "".join(f"<li><a href=x>Some link {i}</a></li>" for i in range(20))
    assert main_text(f"<body><div>{a}{b}</div></body>").split("\n") == first + second
    page = f"<body><div><ul>{links}</ul></div><div><h1>Title</h1>{a}<h2>Next</h2>{b}</div><div><ul>{links}</ul></div></body>"
    assert main_text(page).split("\n") == ["Title", *first, "Next", *second]
    page = f"<body><div>{a}<div><ul>{links}</ul></div>{b}</div><div>(c) us</div></body>"
    assert main_text(page).split("\n") == first + second


def test_head_without_end_tag():
    head = "<!doctype html><html><head><meta charset=utf-8><title>t</title><style>p{}</style><script>x='<p>'</script>"
    article = f"<article><h1>Title</h1><p>{PLAIN}</p></article>"
    text = f"Title\n{PLAIN.strip()}"
    assert main_text(f"{head}<body>{article}</body></html>") == text
    assert main_text(f"{head}<body class=page><nav><a href=a>Home</a></nav>{article}<footer>f</footer>") == text
    assert main_text(f"{head}{article}") == text
    assert main_text(f"{head}\n<noscript><link rel=stylesheet href=a></noscript>\n<body>{article}") == text
    assert main_text(f"{head}<noscript><img src=a></noscript><body>{article}") == text
    assert main_text(f"{head}<template><p>no</p></template><body>{article}") == text
    assert main_text(f"{head}</head><body>{article}") == text
    assert main_text(f"<head><title>t</title>{PLAIN}") == PLAIN.strip()


ARTICLE, TEXTS = section(6)
TEXT = "\n".join(TEXTS)
WRAPPERS = [
    "<form action=x>", "<div class='site right-sidebar'>", "<div class='sidebar-left'>", "<div class='menu-open'>",
    "<div class='post comments-open'>", "<div class='promo-page'>", "<div id=modal>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrappers_with_noisy_names_keep_the_article(wrapper):
    end = f"</{wrapper[1:5].strip('> ')}>".replace("</div ", "</div")
    around = "<nav><a href=a>Home</a></nav>", f"<div class=comments><p>{PLAIN}</p></div><footer>(c) {PLAIN}</footer>"
    for inner, text in ((f"<article>{ARTICLE}</article>", TEXT), (f"<main>{ARTICLE}</main>", TEXT), (ARTICLE, TEXT), (f"<h1>Title</h1>{ARTICLE}", f"Title\n{TEXT}")):
        assert main_text(f"<body>{wrapper}{around[0]}<div>{inner}</div>{around[1]}{end}</body>") == text
        assert main_text(f"<body><div>{wrapper}{inner}{end}</div>{around[1]}</body>") == text


def test_controls_of_a_form_go():
    page = f"<body><form><label>Search</label><input name=q><select><option>one</select><button>Go</button><article>{ARTICLE}</article></form></body>"
    assert main_text(page) == TEXT


def test_noise_beside_an_article_goes_whatever_its_length():
    many = f"<p>{PLAIN}</p>" * 200
    for noise in (f"<section class=comments>{many}</section>", f"<section id=comments><article>{many}</article></section>", f"<div class=cookie-consent>{many}</div>",
                  f"<form>{many}</form>", f"<footer>{many}</footer>", f"<aside>{many}</aside>", f"<div hidden>{many}</div>"):
        assert main_text(f"<body><article>{ARTICLE}</article>{noise}</body>") == TEXT
    page = f"<body><div><h1>Title</h1>{ARTICLE}</div><section class=comment-list><article>{many}</article></section><footer>{many}</footer></body>"
    assert main_text(page) == f"Title\n{TEXT}"


@pytest.mark.parametrize("one,two", [(3, 3), (6, 3), (3, 6), (1, 8)])
def test_articles_that_make_one_text(one, two):
    (a, first), (b, second) = section(one, name="a"), section(two, name="b")
    teaser = f"<article><h3><a href=x>Another page</a></h3><p>{PLAIN}</p></article>"
    links = "<article>" + "".join(f"<p><a href=x>Some other page number {i}</a></p>" for i in range(9)) + "</article>"
    for page in (f"<main><article>{a}</article><article>{b}</article></main>", f"<main><div><article>{a}</article></div><article>{b}</article>{links}</main>",
                 f"<div><article>{a}</article><article>{b}</article></div>", f"<main><article>{a}</article><p>between</p><article>{b}</article>{teaser}{teaser}</main>"):
        got = main_text(f"<body><nav><a href=a>Home</a></nav>{page}<footer>f</footer></body>").split("\n")
        assert [x for x in got if x != "between"] == first + second
    nested = f"<main><article>{a}<article>{b}</article></article></main>"
    assert main_text(f"<body>{nested}</body>").split("\n") == first + second


def test_comments_longer_than_the_post():
    many = f"<p>{PLAIN}</p>" * 60
    post = f"<div><p>{PLAIN * 4}</p><p>{PLAIN * 3}</p></div>"
    want = f"{(PLAIN * 4).strip()}\n{(PLAIN * 3).strip()}"
    for tail in (f"<div id=comments>{many}</div>", f"<div class='comment-list'>{many}</div>", f"<section class=replies>{many}</section>"):
        assert main_text(f"<body><div>{post}{tail}</div></body>") == want
    assert main_text(f"<body><div id=comments>{many}</div></body>") == "\n".join([PLAIN.strip()] * 60)


@pytest.mark.parametrize("name", ["gdpr", "gdpr-box", "adbox", "ad-slot", "adsbygoogle", "cookie-bar"])
def test_more_names_of_surroundings(name):
    assert main_text(f"<body><article>{ARTICLE}<div class={name}><p>{PLAIN}</p></div></article><div id={name}>{PLAIN}</div></body>") == TEXT


def test_given_pages_without_their_article_tags(spark):
    """The text is found by density alone in all of the given pages."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()
    differ = 0
    for (page,) in pages:
        bare = re.sub(r"</?(?:article|main)(?=[\s>])", lambda m: m[0].replace("article", "div").replace("main", "div"), page)
        differ += main_text(bare) != main_text(page)
    assert differ == 0
