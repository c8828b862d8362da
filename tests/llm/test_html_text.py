"""Main text of pages: structure, hard markup, learned weights, and the linear scan."""

import random
import time

import pytest

from sieveline.llm import html_text as ht

TEMPLATE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body>
<header>Site name here</header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use them</div><div class="ad">Buy this thing today and not tomorrow</div><!-- <article>no</article> -->
<article>{0}</article><section id="comments"><p>I read this and have a lot to say about it, so here it is in full</p></section>
<aside>More like this</aside><form>Mail <input name="x"><button>Go</button></form><footer>&copy; us &middot; {1}</footer></body></html>"""


def page(body, foot="words in the footer of the page"):
    return TEMPLATE.format(body, foot)


PAGES = [page(f"<h1>Title {i}</h1><p>" + "some words of the text " * (3 + i) + "</p><p>and an end.</p>") for i in range(20)]


@pytest.fixture(scope="module")
def weights():
    counts = sum((ht.count(p) for p in PAGES), ht.Counter())
    return ht.weigh(counts)


CASES = [
    ("<h1>A &amp; B</h1><p>one  two\n three</p>", "A & B\none two three"),
    ("<p>open <b>bold<br><p>next &lt;tag&gt; &#233;&eacute &am", "open bold\nnext <tag> éé &am"),
    ("<p>a<br>b</p>text<ul><li>x</li><li>y</li></ul>", "a b\ntext\nx\ny"),
    ("<p>in</p><nav>menu</nav><div class='x share'>share</div><p>s<i>pl</i>it</p><aside>side</aside>", "in\nsplit"),
    ("<header><h1>Head</h1></header><p>t</p><footer>by me</footer>", "Head\nt"),
    ("<div><div><p>deep</p></div></div></div></div><p>after</p>", "deep\nafter"),
    ("<p title='a>b'>quoted</p><script>if (a < b) { '</p>' }</script><p>&nbsp; end &nbsp;</p>", "quoted\nend"),
    ("<p>one</p><table><tr><td>1</td><td>2</td></tr></table>", "one\n1\n2"),
    ("<h1>Word</h1><p>Word</p>", "Word\nWord"),
    ("", ""),
]


@pytest.mark.parametrize("body, text", CASES)
def test_articles(weights, body, text):
    assert ht.main_text(page(body), weights) == text


def test_pages_without_an_article(weights):
    plain = "<body><nav>a b</nav><div id=x><p>This is the text of the page.</p><p>All of it.</p></div><footer>the end</footer>"
    assert ht.main_text(plain, weights) == "This is the text of the page.\nAll of it."
    for nothing in (None, "", "   ", "<", "<<<>", "<script>never closed", "<!-- open", "<nav>only a menu</nav>"):
        assert ht.main_text(nothing, weights) in ("", "<", "<<<>")
    assert ht.main_text("a" * 100_000, weights) == "a" * 100_000


def test_best_region_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(300):
        scores = [(rng.choice([-3, -1, 0]), rng.choice([-4, 0, 1, 5])) for _ in range(rng.randint(0, 12))]
        value = lambda a, b: sum(x + y for x, y in scores[a : b + 1]) - scores[a][0]
        every = [value(a, b) for a in range(len(scores)) for b in range(a, len(scores))]
        found = ht.best_region(scores)
        if found is None:
            assert max(every, default=0) <= 0
        else:
            assert value(*found) == max(every)


def test_weights_are_learned(weights):
    assert weights.containers["article"] > 0 > weights.containers["nav"] and weights.containers[".ad"] < 0
    assert all(w < 0 for w in weights.tags.values())


def test_frame(spark):
    rows = [(i, f"u{i}", p, "t", 9) for i, p in enumerate(PAGES)] + [(100, None, None, "t", 9), (100, None, None, "t", 9), (None, "u", "", "t", 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = ht.extract(df).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i in range(20):
        assert by_id[i].text == f"Title {i}\n" + ("some words of the text " * (3 + i)).strip() + "\nand an end."
        assert by_id[i].n_chars == len(by_id[i].text) and by_id[i].url == f"u{i}"
    assert by_id[100].text == "" and by_id[None].n_chars == 0
    assert ht.extract(df.where("false")).count() == 0


def test_names_that_only_hold_a_listed_word(weights):
    text = "<p>This is the text of the page.</p><p>All of it.</p>"
    want = "This is the text of the page.\nAll of it."
    for tag, name in (("body", "single no-sidebar"), ("body", "sidebar"), ("main", "comment"), ("div", "content with-sidebar"), ("div", "social-science"), ("div", "sidebar")):
        assert ht.main_text(f"<{tag} class='{name}'>{text}</{tag}><footer>the end</footer>", weights) == want, (tag, name)
    for name in ("article-header", "entry-header", "header"):
        assert ht.main_text(page(f"<div class='{name}'><h1>Head</h1></div>{text}"), weights) == f"Head\n{want}"
    assert ht.main_text(page(f"<div class='social-science'><p>more</p></div>{text}"), weights) == f"more\n{want}"
    for name in ("share-buttons", "related_posts", "x sidebar", "cookie-notice"):
        assert ht.main_text(page(f"{text}<div class='{name}'><p>gone</p></div>"), weights) == want


ARTICLE = "<p>" + "first words of the text " * 8 + "</p>"
FIRST = ("first words of the text " * 8).strip()


@pytest.mark.parametrize(
    "body, text",
    [
        ("<p>one <math><mi>x</mi><mo>+</mo><mn>1</mn></math> two</p>", "one x+1 two"),
        ("<noscript>shown without scripts</noscript><object><p>instead of the film</p></object>", "shown without scripts\ninstead of the film"),
        ("<section id='related'><p>Related work</p></section><div id='search'><p>We search</p></div>", "Related work\nWe search"),
        ("<p>press <button>Go<p>after an open button</p>", "press\nafter an open button"),
        ("<p>x <svg>not <text>closed<p>after</p>", "x not closed\nafter"),
        ("<p>x <svg><text>drawn</text></svg>y</p><select><option>a</select>", "x y"),
        ("<SCRIPT>a</ScRiPt ><p>after</p><style>b</STYLE>", "after"),
        ("<p class='a>b' title=\"c>d\">e</p><p title=\"open>f</p>", "e\nf"),
    ],
)
def test_nothing_else_is_lost(weights, body, text):
    assert ht.main_text(page(ARTICLE + body), weights) == f"{FIRST}\n{text}"


def test_sibling_articles_are_one_region(weights):
    two = page(ARTICLE).replace("</article>", "</article><article>" + ARTICLE.replace("first", "second") + "</article>")
    assert ht.main_text(two, weights) == f"{FIRST}\n{FIRST.replace('first', 'second')}"
    inside = page(ARTICLE + "<nav><a>menu</a></nav>" + ARTICLE.replace("first", "second"))
    assert ht.main_text(inside, weights) == f"{FIRST}\n{FIRST.replace('first', 'second')}"


def test_letters_that_grow_in_lower_case(weights):
    """Places are those of the page itself."""
    for n in (15, 40, 400):
        body = f"<p>{chr(0x130) * n}</p><script>var x = 1;</script><p>Second paragraph of the text.</p>"
        assert ht.main_text(page(ARTICLE + body), weights) == f"{FIRST}\n{chr(0x130) * n}\nSecond paragraph of the text."


@pytest.mark.parametrize("unit", ["<div>", "<div>x", "<div>x</section>", "<a \"", "<a '>", "<a \">", "<p", "<", "<!--", "<svg>", "<button>", "<b>y</div>", "<script>"])
def test_broken_pages_take_linear_time(weights, unit):
    def seconds(n):
        start = time.process_time()
        ht.main_text("<body><p>text " + unit * n, weights)
        return time.process_time() - start

    assert min(seconds(8000) for _ in range(3)) < 0.4


def brute_region(page_text, weights):
    """The text of the best of all regions, block by block."""
    pieces, nodes = ht.parse(page_text)
    for node in nodes:
        node.known = weights.known(node)
    scores = [(sum(map(weights.tag, p.tags)), p.words * weights.word(p.node)) for p in pieces]
    value = lambda a, b: sum(x + y for x, y in scores[a : b + 1]) - scores[a][0]
    a, b = max(((a, b) for a in range(len(pieces)) for b in range(a, len(pieces))), key=lambda r: value(*r))
    wanted = {p.block for p in pieces[a : b + 1]}
    blocks = {}
    for p in pieces:
        if p.block in wanted and not p.node.never and min(p.node.known, default=1.0) > ht.LEAST_WORD:
            blocks.setdefault(p.block, []).append(p.text)
    return "\n".join(t for parts in blocks.values() if (t := " ".join(ht.html.unescape("".join(parts)).split())))


def test_the_query_is_the_best_region_of_every_page(spark):
    """The whole operator against all regions of each page, with its own weights."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        parts = [f"<p>{'words of it ' * rng.randint(1, 9)}</p>" for _ in range(rng.randint(1, 5))]
        boxes = ["<nav><a>menu here</a></nav>", "<div class='ad'>buy it now</div>", "<ul><li>a point</li></ul>", "<aside>more</aside>"]
        body = "".join(x for p in parts for x in (p, rng.choice(["", *boxes])))
        rows.append((i, "u", page(body) if i % 3 else f"<body>{boxes[0]}<div id=x>{body}</div><footer>end of it</footer>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = ht.fit(df)
    got = {r.page_id: r.text for r in ht.extract(df).collect()}
    assert got == {i: brute_region(h, weights) for i, _, h in rows} and all(got.values())
