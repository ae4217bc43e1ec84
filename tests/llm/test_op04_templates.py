import html
import random
import re
import time

import pytest

from mercato.llm import site_templates as S


def read(page):
    root, marked = S.parse(page)
    return S.text_of(root, marked)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("plain &lt; text  here", "plain < text here"),
    ("<article><h1>A &amp; B</h1><p>one\n two<p>three <b>bold</b>face</article>", "A & B\none two\nthree boldface"),
    ("<nav>menu</nav><div>text</div><footer>f</footer>", "text"),
    ("<body><header>h</header><main><header><h1>T</h1></header><p>x</main>", "T\nx"),
    ("<div class='page-sidebar'>s</div><div class=content>c</div>", "c"),
    ("<article>x<div id=comments><p>c</p></div><form>f</form></article>out", "x"),
    ("<script>if (a < b) '<p>'</script><style>p{}</style><p>a<!-- c > d -->b", "ab"),
    ("<ul><li>a<li>b</ul>c", "a\nb\nc"),
    ("a < b <br/> c", "a < b\nc"),
    ("<p title='a>b'>x</p></div></p>y", "x\ny"),
    ("<article><p><b>one.<br><p>two</p></article>", "one.\ntwo"),
    ("<p>a&nbsp;&#233;&#x4e2d;</p>", "a é中"),
    ("<!doctype html><title>t</title><textarea>z</textarea>w<script>open", "w"),
])
def test_pages(page, text):
    assert read(page) == text


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, subtree string").repartition(3)


def test_recurring_subtrees_go(spark):
    bar = "<div><div>Latest <i>news</i></div><div>Weather</div></div>"
    rows = [(i, f"http://a.example/{i}", f"<body>{bar}<div>page {i} says {'word ' * i}</div></body>") for i in range(12)]
    rows += [(100, "http://b.example/1", f"<body>{bar}<div>other site</div></body>")]
    # Copies of one page do not make its text a template, nor shared paragraphs of an article.
    rows += [(200 + i, "http://c.example/x", "<body><div>copied text</div></body>") for i in range(20)]
    rows += [(300 + i, f"http://d.example/{i}", f"<article><p>shared words</p><p>own {i}</p><div>box</div></article>") for i in range(8)]
    rows += [(400, None, None), (None, "", ""), (None, "", "")]
    got = {}
    for r in S.article_texts(pages_of(spark, rows)).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert all(got[i] == [" ".join(f"page {i} says {'word ' * i}".split())] for i in range(12))
    assert got[100] == ["Latest news\nWeather\nother site"]
    assert all(got[200 + i] == ["copied text"] for i in range(20))
    assert all(got[300 + i] == [f"shared words\nown {i}"] for i in range(8))
    assert got[400] == [""] and got[None] == ["", ""]


def test_long_and_empty(spark):
    long = "<article>" + "".join(f"<p>word {i}</p>" for i in range(60_000)) + "</article>"
    deep = "<div>" * 5000 + "deep"
    got = {r["page_id"]: r["text"] for r in S.article_texts(pages_of(spark, [(1, "http://x/", long), (2, "http://x/", deep)])).collect()}
    assert got[1].count("\n") == 59_999 and got[2] == "deep"
    assert S.article_texts(pages_of(spark, [])).collect() == []


def test_recurring_text_blocks_of_an_article_go(spark):
    note = "<p>Get our <b>letter</b></p>"
    rows = [(i, f"http://a.example/{i}", f"<main><h1>T {i}</h1>{'<p>shared words</p>' if i % 5 == 0 else ''}<p>own {i}</p>"
                f"{''.join(f'<p>more {i} {k}</p>' for k in range(i % 4))}{note}</main>") for i in range(40)]
    # A notice of one section, on a tenth of the host's pages.
    rows += [(1000 + i, f"http://b.example/{'news' if i < 30 else 's%d' % (i % 50)}/{i}", f"<main><p>own {i}</p>{note if i < 30 else ''}</main>")
             for i in range(300)]
    got = {r["page_id"]: r["text"] for r in S.article_texts(pages_of(spark, rows)).collect()}
    for i in range(40):
        assert got[i] == "\n".join([f"T {i}", *["shared words"] * (i % 5 == 0), f"own {i}", *[f"more {i} {k}" for k in range(i % 4)]])
    assert all(got[1000 + i] == f"own {i}" for i in range(300))


def test_many_pages_suffice_on_a_large_host(spark):
    trees = [("h", "", i, 10 if i < 1000 else 12 if i < 1999 else None) for i in range(12_000)] + [("h", "", i, 11) for i in range(1000)]
    df = spark.createDataFrame(trees, "host string, section string, page long, subtree long")
    assert [r["subtree"] for r in S.recurring_subtrees(df).collect()] == [10]


@pytest.mark.parametrize("page", ["<a" * 50_000, "<a " * 50_000, "<" + "a" * 100_000, '<b ">" ' * 20_000, '<a "' * 30_000, "</x" * 40_000,
                                  "<div>" * 20_000 + "</x>" * 20_000, "<li><ul>" + "<b>" * 20_000 + "<li></li>" * 10_000,
                                  "<!--" * 30_000, '<p class="' * 10_000, "<a '>\">" * 15_000])
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    root, marked = S.parse(page)
    S.subtree_hashes(root, marked, "h")
    S.text_of(root, marked)
    assert time.process_time() - start < 2


def test_unclosed_quotes_end_at_the_first_bracket():
    assert read('a < b <a href="x>link</a> end') == "a < b link end"
    assert read("<p class='a>one</p><p>two") == "one\ntwo"


def test_articles_equal_the_blocks_they_were_made_of(spark):
    """Pages written from known blocks and known surroundings give the blocks back."""
    rng = random.Random(6)
    word = lambda: rng.choice(["one", "zwei", "tr\u00e8s", "x &amp; y", "&lt;b&gt;", "caf&#233;", "<b>bold</b>", "<i>two\n words</i>"])
    pages, want = [], {}
    for i in range(120):
        blocks, texts = [], []
        for _ in range(rng.randrange(1, 9)):
            tag = rng.choice(["p", "h2", "li", "blockquote", "pre", "div"])
            inside = f"{i} " + rng.choice([" ", "\n  "]).join(word() for _ in range(rng.randrange(1, 12)))
            blocks.append(f"<{tag}>{inside}</{tag}>")
            texts.append(" ".join(html.unescape(re.sub(r"</?[bi]>", "", inside)).split()))
        body = "".join(blocks)
        marked = rng.random() < 0.7
        outer = rng.choice(["<article>%s</article>", "<main>%s</main>"]) % body if marked else f"<div class='content'>{body}</div>"
        around = ("<header>site</header>", "<nav>a b</nav>", "<aside>ads</aside>", "<footer>f</footer>", "<div class='cookie-notice'>c</div>",
                  "<form>f <input></form>", "<script>var x = '<p>';</script>", "<style>p{}</style>", "<div id='comments'><p>c</p></div>", "<!-- <p>n</p> -->")
        page = "".join(rng.sample(around, 4)) + outer + "".join(rng.sample(around, 3))
        pages.append((i, f"http://h{i % 40}/s/{i}", f"<html><head><title>t</title></head><body>{page}</body></html>"))
        want[i] = "\n".join(texts)
    got = {r["page_id"]: r["text"] for r in S.article_texts(pages_of(spark, pages)).collect()}
    assert got == want
