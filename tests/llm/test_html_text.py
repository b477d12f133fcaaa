"""Page texts: fixtures with every kind of clutter, host votes, broken and very long pages."""

import random

import pytest

from leafmill.llm import html_text

ARTICLE = "<h1>Title &amp; more</h1><p>First  line\n of text, long enough.<p><b>Second</b> one with <a href='/x'>a link</a>.<ul><li>i<li>j</ul>"
WANT = "Title & more\nFirst line of text, long enough.\nSecond one with a link.\ni\nj"
PAGES = [
    f"<html><head><title>no</title><style>p{{}}</style><script>var a='</p>';</script></head><body><header>Site</header><nav><a>Home</a></nav>"
    f"<!-- <p>no --><article>{ARTICLE}</article><footer>&copy;</footer>",
    f"<body><div class='menu-top'>menu</div><main>{ARTICLE}<form>Mail <input></form><aside>side</aside></main><div id=sidebar>side bar</div></body>",
    f"<div class='page'><div class='post-content'>{ARTICLE}</div><div class='comments'><p>A long comment by a reader, with many words, as they are.</div></div>",
    f"<DIV class=cookie-notice>We use cookies</DIV><div>{ARTICLE}<noscript>no</noscript><button>Go</button></div>",
    f"<article class='post with-sidebar' data-id='ad'><div class='ad'>Buy</div>{ARTICLE}<div class=\"social share\">Share it</div></article>",
]


@pytest.mark.parametrize("page", PAGES)
def test_clutter_goes_and_the_article_stays(page):
    assert html_text.main_text(page) == WANT


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), ("plain & text &amp; &#233; &lt;b&gt;", "plain & text & é <b>"), ("a < b and c > d <!-- x", "a < b and c > d"), ("<p>a<br>b", "a b"),
    ("<nav>only a menu</nav>", ""), ("<p>&amp;amp;", "&amp;"), ("x</div></p>y", "x\ny"), ("<p title='a>b'>q</p>", "q"), ("<script>if (a<b)", ""),
])
def test_small_and_broken_pages(page, want):
    assert html_text.main_text(page) == want


def test_very_long_pages_are_read_whole():
    page = "<article>" + "".join(f"<p>word{i} &lt;" for i in range(50_000))
    assert html_text.main_text(page).count("\n") == 49_999
    assert html_text.main_text("<div>" * 5000 + "<p>a" * 5000).count("a") == 5000
    assert html_text.main_text("<" * 50_000 + "'" * 1000).startswith("<<")
    assert html_text.main_text("<a '" * 20_000)


def test_hosts_agree_on_a_path(spark):
    good = "<body><div class='story-1'><p>{}</p></div><div class='tail'><p>{}</p></div>"
    rows = [(i, "https://User@A.example:80/x?y", good.format("The story of the day. " * 40, "Short tail."), "x") for i in range(5)]
    rows += [(9, "http://a.example/odd", good.format("Brief story.", "A tail that is longer than the story on this page. " * 3), "x")]
    rows += [(10, None, "<p>alone</p>", "x"), (None, "http://b.example", None, "x"), (11, "nonsense", "", "x"), (10, None, "<p>alone</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(3)
    assert {r["host"]: r["path"] for r in html_text.host_paths(pages).collect() if r["host"] == "a.example"} == {"a.example": "body>div.story"}
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_pages(pages).collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    texts = {i: t for i, t, _ in got}
    assert texts[9] == "Brief story." and texts[10] == "alone" and texts[None] == texts[11] == ""
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_paths_of_any_depth_and_equal_scores():
    """Two columns far inside a page are told apart; a very deep page costs what its tags do."""
    deep = "<div>" * 200 + "<div class=story>" + "<p>main words here</p>" * 9 + "</div><div class=other><p><a href=x>a link</a></p></div>" + "</div>" * 200
    assert html_text.page_vote(deep)[0].endswith("div>div.story") and html_text.page_vote(deep)[0].count(">") == 200
    assert html_text.main_text(deep) == "\n".join(["main words here"] * 9)
    very_deep = "<div>" * 100_000 + "<p>the end</p>"
    assert html_text.main_text(very_deep) == "the end" and html_text.page_vote(very_deep)[0].count(">") == 99_999
    equal = "<div class=a><p>same</p></div><div class=b><p>same</p></div>"
    assert html_text.page_vote(equal)[0] == "div.b"


def test_scores_of_all_containers_equal_brute_force():
    """Every container's text summed again from each block's whole list of containers."""
    rng = random.Random(3)
    for _ in range(60):
        page, still = "", []
        for _ in range(rng.randint(1, 40)):
            if still and rng.random() < 0.4:
                page += f"</{still.pop()}>"
            elif rng.random() < 0.6:
                still.append(rng.choice(["div", "section", "article", "main"]))
                page += f"<{still[-1]} class={rng.choice('abc')}>"
            else:
                page += f"<p>{'x' * rng.randint(1, 9)}</p>"
        paths = html_text.Paths()
        blocks, worth = list(html_text.blocks_of(page, paths)), {}
        for b in blocks:
            names = paths.text(b.path).split(">") if b.path else []
            for n in range(1, len(names) + 1):
                worth[">".join(names[:n])] = worth.get(">".join(names[:n]), 0) + max(0, sum(map(len, b.pieces)) - 2 * b.linked)
        scored = [
            (own * (1 + 0.02 * min(p.count(">"), 5)) * (1.2 if p.rpartition(">")[2].split(".")[0] in ("article", "main") else 1.0), p)
            for p, own in worth.items()
        ]
        assert html_text.best_path(blocks, paths) == max(scored, default=(0.0, ""))[::-1]
