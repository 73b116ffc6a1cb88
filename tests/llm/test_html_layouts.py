"""Pages of one host in several layouts."""

import pytest

from reportloom.llm import html_extract as h

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages: dict[int, str]) -> dict[int, str]:
    rows = [(i, "http://a.example.org/", page) for i, page in pages.items()]
    return {r["page"]: r["text"] for r in h.extract(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()}


def test_a_layout_that_the_reference_lacks_loses_nothing(spark):
    """Whichever page is the reference, articles and extra blocks of the others stay."""
    pages = {i: f"<body><div class=date>Day {i}</div><div class=gallery>Pictures {i}</div></body>" for i in range(12)}
    pages |= {i: f"<body><div class=date>Day {i}</div><article><p>Story {i}</p></article></body>" for i in range(100, 112)}
    pages |= {i: f"<body><div class=date>Day {i}</div><div class=extra>More {i}</div></body>" for i in range(200, 204)}
    found = texts(spark, pages)
    for i, text in found.items():
        assert (f"Story {i}" if 100 <= i < 200 else f"Pictures {i}" if i < 100 else f"More {i}") in text
        assert 100 <= i < 200 or f"Day {i}" in text


def test_template_of_a_smaller_layout(spark):
    """A place that is template in one layout holds content in another, and the other way round."""
    pages = {i: f"<body><div>Welcome to all</div><p class=a>Words {i}</p></body>" for i in range(12)}
    pages |= {i: f"<body><div>Content {i}</div><h2>x {i}</h2><section>Legal</section></body>" for i in range(100, 105)}
    pages |= {i: f"<body><div>Content {i}</div><h2>x {i}</h2><p class=a>Same here</p></body>" for i in range(200, 205)}
    found = texts(spark, pages)
    for i, text in found.items():
        assert text == (f"Words {i}" if i < 100 else f"Content {i}\n\nx {i}")


def test_constant_parts_of_articles_go(spark):
    """Unnamed notices go, wherever they are; an article that most pages have stays."""
    def page(i, body):
        return f"<body><div>Hello</div><main><article><h1>Head {i}</h1>{body}</article></main></body>"

    notice = "<div class=x><p>Please support us</p></div>"
    pages = {i: page(i, f"<p>One {i}</p>{notice}<p>Two {i}</p>" if i % 2 else f"{notice}<p>One {i}</p>") for i in range(12)}
    pages |= {i: page(i, f"<p>One {i}</p><p class=note>Read on</p>{notice}") for i in range(12, 16)}
    found = texts(spark, pages)
    for i, text in found.items():
        assert text == f"Head {i}\n\nOne {i}" + (f"\n\nTwo {i}" if i % 2 and i < 12 else "")
    same = {i: f"<body><p id=n>{i}</p><article><p>The same for all of them</p></article></body>" for i in range(5)}
    assert set(texts(spark, same).values()) == {"The same for all of them"}


def test_long_varying_text_beside_an_article_stays(spark):
    pages = {
        i: f"<body><div class=x>Site</div><article><h1>T{i}</h1></article><div class=y>{f'Long story {i}. ' * 20}</div></body>"
        for i in range(6)
    }
    for i, text in texts(spark, pages).items():
        assert text.startswith(f"T{i}\n\nLong story {i}.") and "Site" not in text


@pytest.mark.parametrize("page, text", [
    ('<div style="overflow:hidden"><article>kept</article></div>', "kept"),
    ('<p title="hidden gems">kept</p><p hidden>gone</p><p data-class="ad">kept</p>', "kept\n\nkept"),
    ("<p title='role=navigation class=ad'>kept</p>", "kept"),
    ('<article><h2 id="social-impact">kept</h2><section id="related-work">kept</section></article>', "kept\n\nkept"),
    ('<article><div id="menu">kept</div><div class="social-impact">kept</div><div class="x share">gone</div></article>', "kept\n\nkept"),
    ('<div><h2 id="related">kept</h2><section id="related-work">kept</section><div id="comments">gone</div></div>', "kept\n\nkept"),
])
def test_attributes_by_name_and_whole_value(page, text):
    assert h.main_text(page, None, frozenset()) == text
