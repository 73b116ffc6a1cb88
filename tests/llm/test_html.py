"""Wrapper induction on pages made here."""

import random
import time
import tracemalloc

import pytest

from reportloom.llm import html_extract as h

SCHEMA = "page_id long, url string, html string, text string, host string, page string"


def _page(i: int, article: bool) -> str:
    body = f"<h1>Title {i}</h1><p>First &amp; foremost {i}<p>Second  \n line<br>goes on.</p>"
    slot = f"<article>{body}</article>" if article else f"<div class=entry>{body}</div>"
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><script>var t='</p><article>';</script></head><body>"
        f"<div id=top><p>Welcome to this site</p></div><nav><ul><li>Item {i}<li>Other</ul></nav><!-- c -->"
        f"{slot}<div class='sidebar'>Side {i}</div><div><p>Same words on every page</p></div>"
        f"<section id=comments><p>Nice {i}</p></section><footer>&copy; {i}</footer></body></html>"
    )


def _extract(spark, rows):
    pages = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(2)
    return {r["page_id"]: r for r in h.extract(pages).withColumnRenamed("page", "page_id").collect()}


@pytest.mark.parametrize("article", [True, False])
def test_varying_slots_are_content(spark, article):
    rows = [(i, f"http://{'a' if i % 2 else 'b'}.example.org/{i}", _page(i, article)) for i in range(12)]
    # Copies of one page do not make its text template.
    rows += [(100 + i, "http://a.example.org/copy", _page(1, article)) for i in range(40)]
    found = _extract(spark, rows)
    assert len(found) == len(rows)
    for i, r in found.items():
        n = i if i < 100 else 1
        assert r["text"] == f"Title {n}\n\nFirst & foremost {n}\n\nSecond line goes on."
        assert r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    found = _extract(spark, [
        (1, None, None), (2, "no host", ""), (3, "http://x.org/", "plain text only"), (4, "http://x.org/", "<p>a < b"),
        (5, "http://x.org/", "<div><div><article><p>open <b>bold<p>next"), (6, None, long), (6, None, long),
        (None, "http://y.org", "<article>no id</article>"), (7, "http://z.org", "<article><p>cut &am"),
    ])
    assert found[1]["text"] == "" and found[1]["n_chars"] == 0 and found[2]["text"] == ""
    assert found[3]["text"] == "plain text only" and found[4]["text"] == "a < b"
    assert found[5]["text"] == "open bold\n\nnext" and found[6]["text"].count("word") == 20_000
    assert found[None]["text"] == "no id" and found[7]["text"] == "cut &am"


def test_no_pages_give_no_rows(spark):
    assert h.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tree_matching_counts_paired_nodes():
    def tree(page):
        return h.skeleton([h.parse(page)])

    assert h.match(tree("<p>a</p><ul></ul>"), tree("<ul></ul>")) == 2
    assert h.match(tree("<div><p>x</p><ul></ul></div><footer>"), tree("<div><ul></ul></div><footer>")) == 4
    assert h.match(tree("<div><p>x</p></div>"), tree("<div><p>y</p></div>")) == 3


def plain_match(a, b):
    if a.sign != b.sign:
        return 0
    best = [[0] * (len(b.below) + 1) for _ in range(len(a.below) + 1)]
    for i, x in enumerate(a.below):
        for j, y in enumerate(b.below):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_match(x, y))
    return best[-1][-1] + 1


def paired_nodes(a, b):
    """Nodes paired on the way that ``pairs`` takes."""
    counts, total, todo = {}, 0, [(a, b)]
    while todo:
        x, y = todo.pop()
        total += 1
        found = h.pairs(x, y, counts)
        assert sorted(found.values()) == [found[j] for j in sorted(found)]
        todo.extend((x.below[i], y.below[j]) for j, i in found.items())
    return total


@pytest.mark.parametrize("cells", [2, 1 << 18])
def test_tree_matching_equals_the_plain_recursion(monkeypatch, cells):
    monkeypatch.setattr(h, "_CELLS", cells)
    rnd = random.Random(cells)

    def tree(depth):
        below = [tree(depth - 1) for _ in range(rnd.randint(0, 4))] if depth else []
        return h.Slot(rnd.choice("abc"), below=below).shaped()

    for _ in range(400):
        a, b = tree(3), tree(3)
        a.sign = b.sign = "root"
        a.shaped(), b.shaped()
        assert h.match(a, b) == plain_match(a, b) == paired_nodes(a, b)
        again = h.unpacked(h.packed(a))
        assert (again.shape, again.size) == (a.shape, a.size)


def test_deep_and_wide_pages(spark):
    """Ten thousand elements inside each other, and twenty thousand blocks without an article."""
    deep = "<div>" * 10_000 + "<p>deep {}</p>"
    rnd = random.Random(1)
    wide = "".join(f"<{t}>w{{0}}</{t}>" for t in (rnd.choice(["p", "h2", "div"]) for _ in range(20_000)))
    other = "".join(f"<{t}>w{{0}}</{t}>" for t in (rnd.choice(["p", "h2", "div"]) for _ in range(20_000)))
    rows = [(i, "http://deep.org/", deep.format(i)) for i in range(4)]
    rows += [(10 + i, "http://lists.org/", f"<ul>{'<ul><li>' * 5_000}x {i}") for i in range(3)]
    found = _extract(spark, rows)
    assert [found[i]["text"] for i in range(4)] == [f"deep {i}" for i in range(4)]
    assert found[12]["text"] == "x 2"
    tracemalloc.start()
    start = time.perf_counter()
    a, b = (h.skeleton([h.parse(x)]) for x in (wide.format(1), other.format(2)))
    matched = h.pairs(a, b, {})
    assert time.perf_counter() - start < 120
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    assert all(a.below[i].sign == b.below[j].sign for j, i in matched.items())
    # Some 16,000 slots a page, of which a good half pair up in order.
    assert len(matched) > 0.6 * len(b.below)


def test_headline_and_lead_beside_an_article_stay(spark):
    pages = [
        (i, "http://lead.org/", f"<body><div>Our site</div><h1>Head {i}</h1><p>Lead of {i}</p><p>{i}</p>"
         f"<article><h2>Summary</h2><p>Story {i}</p><p class=n>Support us</p></article></body>")
        for i in range(6)
    ]
    for i, r in _extract(spark, pages).items():
        assert r["text"] == f"Head {i}\n\nLead of {i}\n\nSummary\n\nStory {i}"


@pytest.mark.parametrize("page, text", [
    ('<div class="with-sidebar"><article>kept</article></div>', "kept"),
    ('<article>kept<aside>gone</aside><div class="ad">gone</div><header><h1>Head</h1></header></article>', "kept\n\nHead"),
    ('<article class="comment">gone</article><main>kept</main>', "kept"),
    ("<article>a<script>if (a < b) '</article>'</script>b</article>", "ab"),
    ('<article title="a > b">x&nbsp;&lt;y&gt;</article>', "x <y>"),
    ("<article><form>gone</form><ul><li>one<li>two</ul></article>", "one\n\ntwo"),
])
def test_single_pages(page, text):
    assert h.main_text(page, None, frozenset()) == text
