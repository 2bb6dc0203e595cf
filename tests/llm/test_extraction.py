"""Main text of pages: markup rules, marked boilerplate, and templates learnt from a host's pages."""

import random

import pytest

from unitledger.llm.dom import Shapes, parse
from unitledger.llm.extraction import Page, main_texts

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b <b>c</b>\n d<br>e", "a\nb c d e"),
        ("<body><nav>n</nav><article><h1>T</h1><p>x&nbsp;&lt;y&gt;</p></article><footer>f</footer>", "T\nx <y>"),
        ("<article><header><h1>T</h1><p>by me</p></header><p>x</p><aside>s</aside><form>f</form></article>", "T\nx"),
        ("<div id=content><p>x</p><div class='site-comments'><p>c</p></div></div><div class=sidebar>s</div>", "x"),
        ("<main><p>x<script>var a='</p><p>no'</script>y</p><style>p{}</style><!-- c --></main>", "xy"),
        ("<body class='has-sidebar'><div class='cookie-notice'>c</div><p>x</p>", "x"),
        ("<article><p>x</p></article><section class=comments><article><p>c</p></article></section>", "x"),
        ("<article><p>x</p><article class='comment'>c</article></article>", "x"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\n1\n2\n3"),
        ("<p>cut off <b", "cut off"),
        ("<p title='a>b'>x</p><p hidden>h</p><p style='display: none'>d</p>", "x"),
        ("</p></div>x<textarea><p>t</p></textarea> &am", "x &am"),
    ],
)
def test_one_page(html, want):
    page = Page(html)
    Shapes().sign(page.root)
    assert page.text(set()) == want


def test_matching_pairs_the_same_slots():
    shapes = Shapes()
    a = parse("<body><div class=m>menu</div><p>one</p><p>two</p><div>end</div></body>")
    b = parse("<body><div class=m>menu</div><h1>t</h1><p>other</p><div>end</div></body>")
    shapes.sign(a)
    shapes.sign(b)
    assert shapes.match(a.sign, b.sign) == 5
    texts = {(x.own_text(), y.own_text()) for x, y in shapes.align(a, b)}
    assert {("menu", "menu"), ("one", "other"), ("end", "end")} <= texts


def test_template_of_a_host(spark):
    page = "<body><div>Shop of all things</div><div><p>Story {0} begins here.</p><p>And {0} goes on.</p></div><div>All rights kept</div></body>"
    rows = [(i, f"https://u@Shop.example:80/{i}", page.format(i), "k") for i in range(12)]
    rows += [(100, "https://small.example/", page.format("s"), "k"), (101, None, None, "k"), (102, "", "<p>no host", "k"), (0, rows[0][1], rows[0][2], "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = main_texts(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id < 100:
            assert r.text == f"Story {r.page_id} begins here.\nAnd {r.page_id} goes on."
        elif r.page_id == 100:  # one page has no template
            assert r.text.startswith("Shop of all things\nStory s")
        else:
            assert r.text == ("no host" if r.page_id == 102 else "")
        assert r.n_chars == len(r.text)


def test_copies_of_one_page_are_no_template(spark):
    rows = [(i, "http://h.example/x", "<article><p>same text</p></article>") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in main_texts(df).collect()} == {"same text"}
    assert main_texts(df.limit(0)).collect() == []


def test_joined_references_give_the_same(spark, monkeypatch):
    import unitledger.llm.extraction as E

    df = spark.read.parquet(SF_DIR + "/pages.parquet")
    want = sorted(map(tuple, main_texts(df).collect()))
    monkeypatch.setattr(E, "BROADCAST_CHARS", 0)
    assert sorted(map(tuple, main_texts(df).collect())) == want


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    page = Page(deep)
    assert page.text(set()) == "x"
    many = Page("".join(f"<p>{i}</p><div>{i}</div>" for i in range(3000)))
    assert len(many.text(set()).split("\n")) == 6000


@pytest.mark.parametrize(
    "html, want",
    [
        ("<div>menu</div><div class=post-title>T</div><div class=post-body>x</div><div>end</div>", "T\nx"),
        ("<h1 class=entry-title>T</h1><div class=entry-content>x</div><div>end</div>", "T\nx"),
        ("<div class=content>a</div><div class=ad>ad</div><div class=content>longer <div class=content>b</div></div>", "a\nlonger\nb"),
        ("<main>a<main>b</main></main><div>m</div><div role=main>c</div>", "a\nb\nc"),
    ],
)
def test_all_blocks_of_the_main_text(html, want):
    page = Page(html)
    Shapes().sign(page.root)
    assert page.text(set()) == want


def _texts(spark, pages):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", html) for i, html in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in main_texts(df.repartition(3)).collect()}


def test_copies_of_a_long_page_keep_its_tail(spark):
    page = "<body><div>Menu of the site</div><div>{}</div></body>"
    long = page.format("".join(f"<p>Long {k}</p>" for k in range(40)))
    others = [page.format("".join(f"<p>Story {i} {k}</p>" for k in range(10))) for i in range(6)]
    got = _texts(spark, [long] * 8 + others)
    for i in range(8):
        assert got[i] == "\n".join(f"Long {k}" for k in range(40))
    for i in range(6):
        assert got[8 + i] == "\n".join(f"Story {i} {k}" for k in range(10))


@pytest.mark.parametrize("tag", ["article", "main", "div role=main"])
def test_captures_with_a_rotating_notice_keep_the_article(spark, tag):
    page = f"<body><div>Notice {{0}}</div><{tag}><p>Same body.</p><p>More of it.</p></{tag.split()[0]}></body>"
    assert set(_texts(spark, [page.format(i) for i in range(20)]).values()) == {"Same body.\nMore of it."}


def test_each_layout_of_a_host_has_a_template(spark):
    one = "<body><div>Menu of the shop</div><div><p>Story {0}</p></div></body>"
    two = "<body><section><p>Menu of the forum</p></section><section><p>Thread {0}</p></section></body>"
    odd = "<body class=error><p>Broken</p></body>"
    got = _texts(spark, [one.format(i) for i in range(8)] + [two.format(i) for i in range(12)] + [odd])
    assert [got[i] for i in range(21)] == [f"Story {i}" for i in range(8)] + [f"Thread {i}" for i in range(12)] + ["Broken"]


def test_template_inside_articles(spark):
    page = "<body><nav>n</nav><article><h1>Title {0}</h1><p>Tell your friends</p>" + "<p>Story {0} goes on and on, word by word.</p>" * 4 + "</article></body>"
    got = _texts(spark, [page.format(i) for i in range(9)])
    assert {"Tell your friends" in t for t in got.values()} == {False}
    assert got[3].split("\n") == ["Title 3"] + ["Story 3 goes on and on, word by word."] * 4


def test_captures_that_differ_inside_the_article_stay_whole(spark):
    page = "<article><p>Seen {0} times</p><p>Same body, of some length.</p><p>More of it, and more.</p></article>"
    got = _texts(spark, [page.format(i) for i in range(20)])
    assert [got[i] for i in range(20)] == [f"Seen {i} times\nSame body, of some length.\nMore of it, and more." for i in range(20)]


def test_slots_with_most_of_the_main_text_stay_whatever_their_names(spark):
    page = "<article><h1>T{0}</h1><div class='widget-review'><p>The review {0} of all this.</p></div><div class=ad>Buy {0}</div><div class=comments>" + "<p>reply {0}</p>" * 9 + "</div></article>"
    got = _texts(spark, [page.format(i) for i in range(7)])
    assert [got[i] for i in range(7)] == [f"T{i}\nThe review {i} of all this." for i in range(7)]


def test_every_host_with_enough_pages_is_aligned(spark, monkeypatch):
    """The given pages all have articles; no text of theirs repeats, so class words change nothing."""
    import unitledger.llm.extraction as E

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: r.text for r in main_texts(df).collect()}
    rows = [(r.page_id, r.html) for r in df.collect()]
    monkeypatch.setattr(E, "WORDS", set())
    assert {i: Page(html).text(set()) for i, html in rows} == want


def _most_pairs(a, b):
    """Most nodes of a top-down mapping that keeps the order of children, by trying all of them."""
    if a.label != b.label:
        return 0

    def best(left, right):
        if not left or not right:
            return 0
        return max(best(left[1:], right), best(left, right[1:]), _most_pairs(left[0], right[0]) + best(left[1:], right[1:]))

    return 1 + best(a.elements(), b.elements())


def test_matching_equals_brute_force_on_random_trees():
    rng = random.Random(5)

    def grow(depth):
        tag = rng.choice("abc")
        children, last = [], None
        for _ in range(rng.randint(0, 4) if depth else 0):
            child = grow(depth - 1)
            if child != last:  # neighbours of one shape count as one
                children.append(child)
            last = child
        return f"<x{tag}>{''.join(children)}</x{tag}>"

    for _ in range(300):
        shapes = Shapes()
        a, b = parse(f"<r>{grow(3)}</r>"), parse(f"<r>{grow(3)}</r>")
        shapes.sign(a)
        shapes.sign(b)
        want = _most_pairs(a, b)
        assert shapes.match(a.sign, b.sign) == want
        assert len(list(shapes.align(a, b))) == want


def test_joined_references_and_copies_count_the_same(spark, monkeypatch):
    import unitledger.llm.extraction as E

    page = "<body><div>Menu of the site</div><div><p>Story {0}</p></div></body>"
    pages = [page.format(i % 12) for i in range(40)] + ["<body><section>Error</section></body>"] * 2
    pages += [f"<body><section>Menu of the forum<section>Thread {i}</section></section></body>" for i in range(8)]
    want = _texts(spark, pages)
    assert want[0] == "Story 0" and want[49] == "Thread 7"
    monkeypatch.setattr(E, "BROADCAST_CHARS", 0)
    monkeypatch.setattr(E, "BROADCAST_COPIES", 0)
    assert _texts(spark, pages) == want
