import itertools
import random

import pytest

from medloom.llm import html

PAGE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Title</title><style>p{margin:0}</style>
<script>var t="</p>";track(0);</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<!-- ad 0 --><div class="ad">Buy now, it is a great offer. Really.</div><article><h1>A &amp; B</h1><p><b>First  text<br>goes on.<br>
<p>Ti.</p><p>Third &lt;p&gt; &copy; one &notreal; R&D &am</p><ul><li>an item</li><li>two<ul><li>deep</li></ul></li></ul>
<div class="comments"><p>A reader's comment that is long enough to look like text.</p></div><form>Name <input> <button>Send</button></form>
</article><aside>See also</aside><div id="cookie-notice">We use cookies.</div><footer>&copy; site &middot; Text of the footer.</footer></body></html>"""


def test_article():
    assert html.main_text(PAGE) == "\n".join([
        "A & B", "First text goes on.", "Ti.", "Third <p> © one ¬real; R&D &am", "an item", "two", "deep"])


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<article>a <", "a <"), ("<p", ""), ("<article><p>one<p>two</article>", "one\ntwo"), ("<nav>only a menu</nav>", ""),
    ("<article>a<!-- b --> c<!-- d", "a c"), ('<article><p title="a > b">x</p>', "x"), ("<article><pre> a\n b </pre></article>", "a b"),
    ("<article><script>if (a < b) {}</script>x</article>", "x"), ("<article><p>x &amp y</article>", "x & y"), ("<ARTICLE><P>x</P></ARTICLE>", "x"),
    ("<article><p>a</p></div></section><p>b</p>", "a\nb"), ("<article><p> x </p></article>", "x"), ("<article><h2>H</h2>tail</article>", "H\ntail"),
    ("<article><table><tr><td>1<td>2</table></article>", "1\n2"), ("<article><header><h1>T</h1></header><p>b</p></article>", "T\nb"),
])
def test_pages(page, text):
    assert html.main_text(page) == text


def test_without_an_article():
    """Plain divisions: long blocks of text stay, linked and short ones around them go."""
    page = "<body><div><a href=x>Home</a></div><div><a href=x>News</a> <a href=y>Sport</a></div><div>" + "".join(
        f"<p>{'This is sentence number one of the text. ' * 3}</p>" for _ in range(4)) + "<p>Short.</p></div><div><a href=z>Imprint</a></div></body>"
    lines = html.main_text(page).split("\n")
    assert len(lines) == 5 and lines[-1] == "Short."


def test_truncated_anywhere():
    for end in range(len(PAGE)):
        html.main_text(PAGE[:end])


def test_cut_is_minimal():
    """The flow's cut costs as little as the best of all labellings."""
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randrange(1, 8)
        gain = [rng.randrange(-9, 10) for _ in range(n)]
        ties = [(a, b, rng.randrange(6)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        flow = html.Flow(n + 2)
        for i, g in enumerate(gain):
            flow.edge(n, i, max(g, 0), 0)
            flow.edge(i, n + 1, max(-g, 0), 0)
        for a, b, w in ties:
            flow.edge(a, b, w, w)
        def cost(side):
            return sum(max(g, 0) if not s else max(-g, 0) for g, s in zip(gain, side)) + sum(w for a, b, w in ties if side[a] != side[b])
        found = flow.source_side(n, n + 1)[:n]
        assert cost(found) == min(cost(s) for s in itertools.product([True, False], repeat=n))


def test_table(spark):
    from pyspark.sql import functions as F

    rows = [(1, "u", PAGE), (None, None, None), (2, "v", ""), (1, "u", PAGE), (3, "w", "<article>" + "<p>many words stand here.</p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("other"))
    found = html.extract(df)
    assert sorted(((r.page_id, r.url, r.text) for r in found.collect()), key=str) == sorted(((k, u, html.main_text(h)) for k, u, h in rows), key=str)
    assert html.extract(df.limit(0)).collect() == []


def test_large_page_with_mixed_labels():
    page = "<body>" + "".join(f"<div><p>{'Text that is long. ' * (i % 4)}</p><div><a href=x>link {i}</a></div></div>" for i in range(2000))
    lines = html.main_text(page + "<article><p>Ends here.</p></article>").split("\n")
    assert lines[-1] == "Ends here." and not any(line.startswith("link") for line in lines)


ARTICLE = ("<article><h1>Title here</h1><p>" + "word " * 40 + ".</p><ul><li><a href=x>One link</a></li></ul><p>" + "more " * 30 + ".</p></article>")
WRAPPERS = ["<form id=aspnetForm>%s</form>", "<div class='content-with-sidebar'>%s</div>", "<div class='no-comments'>%s</div>",
            "<main class='has-social'>%s</main>", "<div class='has-social'><main>%s</main></div>", "<div class='search-open'>%s</div>", "%s"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrappers(wrapper):
    """What stands around a whole article does not take it away; comments, also such as are articles, and menus go."""
    comments = "<section id=comments><article class=c1><p>" + "nice " * 30 + ".</p></article></section>"
    page = "<html><nav><a>Home</a><a>About</a></nav>" + wrapper % (ARTICLE + comments) + "<footer>Copyright text here.</footer></html>"
    lines = html.main_text(page).split("\n")
    assert lines[0] == "Title here" and lines[2] == "One link" and len(lines) == 4
    plain = html.main_text(page.replace(ARTICLE, ARTICLE.replace("article>", "section>")))
    assert "word word" in plain and "more more" in plain and "Home" not in plain and "nice" not in plain


def cheapest(page):
    """Blocks that every cheapest labelling of a small page calls content, from all labellings."""
    found, _ = html.blocks(page)
    if not found:
        return ""
    nodes, gains, ties = html.graph(found)
    assert nodes <= 15
    best = None
    for side in itertools.product([False, True], repeat=nodes):
        cost = sum(w for v, w in gains if w > 0 and not side[v]) - sum(w for v, w in gains if w < 0 and side[v])
        cost += sum(w for a, b, w in ties if side[a] != side[b])
        if best is None or (cost, sum(side)) < best[0]:
            best = (cost, sum(side)), side
    return "\n".join(text for (text, _, _), kept in zip(found, best[1]) if kept)


def test_query_against_all_labellings(spark):
    rng = random.Random(9)
    texts = ["Short", "A sentence that says something, with enough words to count as text.", "<a href=x>Link text</a>", "Two words.",
             "Some text with <a href=y>a link that is long</a> in it, and more."]
    tags = ["p", "div", "li", "h2", "section", "article", "aside", "form", "main", "div class=ad", "div class=content", "div id=has-menu"]
    pages = []
    for i in range(150):
        def made(depth):
            tag = rng.choice(tags)
            inner = "".join(made(depth - 1) for _ in range(rng.randrange(1, 3))) if depth and rng.random() < 0.6 else rng.choice(texts)
            return f"<{tag}>{inner}</{tag.split()[0]}>"
        pages.append((i, f"u{i}", "".join(made(2) for _ in range(rng.randrange(1, 3)))))
    pages = [p for p in pages if len(html.blocks(p[2])[0]) and html.graph(html.blocks(p[2])[0])[0] <= 15]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html.extract(df).collect()}
    assert len(pages) > 60 and found == {k: cheapest(h) for k, _, h in pages}


def test_the_cut_decides(spark):
    """On the given pages the cut calls some blocks otherwise than their own text would."""
    import os

    from tests.conftest import SMALL

    if not os.path.isdir(SMALL):
        pytest.skip("needs the given tables")
    pages = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    differ = 0
    for page in pages:
        found, _ = html.blocks(page)
        differ += [a > b for a, b in (html.costs(*x) for x in found)] != html.content(found)
    assert differ > 0.5 * len(pages)
