import html
import random
import re

import numpy as np
import pytest

from skyloom.llm import pages
from skyloom.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, text string, host string, array string"
SITE = "Welcome to this site please read these terms before you go on"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash", "clash") for i, u, h in rows], SCHEMA)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h1>T</h1><p>a &amp; b<p>c<br>d<b>e</b>f</article><p>z", "T a & b c def"),
        ("<main><div class='cookie-notice'>c<div>x</div></div><p>kept</main>", "kept"),
        ("<article><header><h1>Head</h1></header>x<div class=ad>AD</div><p class='ad'>m<p>y", "Head x y"),
        ('<article>a<script>var t="</p>";</script>b<!-- c --><style>p{}</style>', "a b"),
        ("<article>a<section id=comments><article>r</article>more</section>end</article>", "a end"),
        ("<article>a<aside>s</aside><form>f<input></form><nav><ul><li>m</ul></nav>b</article>", "a b"),
        ("<article>x<div hidden>h</div><div style='display: none'>h</div>y</article>", "x y"),
        ("<article>1 < 2 &lt;b&gt; &#233;&nbsp;&copy; &am", "1 < 2 <b> é © &am"),
        ("<article><div class=ad>unclosed</article><footer>f</footer>", ""),
        ("<article>one</article><article>two</article>", "one two"),
        ("<ARTICLE><P CLASS='Big'>Text</P></ARTICLE>", "Text"),
        ("<div role=main><p>in</p></div><p>out", "in"),
        ('<article title="a > b">x</article>', "x"),
    ],
)
def test_declared_articles(page, text):
    assert (pages.read_page(page)[0] or "") == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article class="post category-social">x</article>', "x"),
        ('<article class="post has-comments sidebar">x<div class=ad>AD</div></article>', "x"),
        ('<article id="header" class="comment">x</article>', "x"),
        ('<div class="article-body with-sidebar">x</div><p>out', "x"),
        ('<div itemprop="articleBody" class="related">x</div><p>out', "x"),
        ('<main><div id="content" class="no-sidebar">x</div></main>', "x"),
        ('<main><section class="form-and-function">x</section></main>', "x"),
        ("<main><div class='site_footer'>f</div><div class=search-form>f</div>x</main>", "x"),
        ("<article class=post role=banner>h</article><article hidden>h</article><main>x</main>", "x"),
        ("<article style='display:none'>h</article><main>x</main>", "x"),
    ],
)
def test_layout_names_are_no_chrome(page, text):
    assert (pages.read_page(page)[0] or "") == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<main><h1>T</h1><p>long body</p><article class='card'>teaser</article></main>", "T long body teaser"),
        ("<main><h1>T</h1><p>a body that is far longer than it</p><article>next</article></main>",
         "T a body that is far longer than it next"),
        ("<main><p>next</p><article>a story that is longer</article></main>", "a story that is longer"),
        ("<div id='content'><p>story</p></div><article class='teaser'>Read next</article>", "story"),
        ("<article>x<article class='comment'>c</article>y</article>", "x y"),
        ("<main>story</main><article class='comment'>a comment longer than it</article>", "story"),
        ("<article>x</article><article class='user-comment'>c</article>", "x"),
        ("<article class='comment'>only</article>", "only"),
        *((f"<article>x<div class='{name}'>c</div>y</article>", "x y") for name in (
            "comments-wrapper", "user-comment", "comment-thread", "commentlist", "advertisement-slot", "ad-1",
            "ad_300x250", "post-comments", "mobile-ad")),
        *((f"<article>x<div class='{name}'>c</div>y</article>", "x c y") for name in (
            "no-comments", "has-ad", "with-ads", "ad-free", "download", "header-ad-free", "commentary")),
        ("<body class='ad-page'><main class='with-comments'>x</main></body>", "x"),
    ],
)
def test_comments_adverts_and_teasers(page, text):
    assert (pages.read_page(page)[0] or "") == text


def test_the_share_that_suffix_arrays_decide(spark):
    """Half of these pages declare nothing; the arrays alone tell their text from the site's."""
    rows = []
    for i in range(40):
        own = " ".join(f"w{i}x{j}" for j in range(20))
        around = f"<div>{SITE}</div><div class=x>{SITE} again</div>"
        body = f"<article>{own}</article>" if i % 2 else f"<p>{own}</p>"
        rows.append((i, f"http://site.example/{i}", around + body))
    found = {r["page_id"]: r["text"] for r in pages.main_text(table(spark, rows)).collect()}
    assert found == {i: " ".join(f"w{i}x{j}" for j in range(20)) for i in range(40)}
    undeclared = [i for i, _, h in rows if pages.read_page(h)[0] is None]
    assert len(undeclared) == 20


def article(n, box, size=40):
    return f"<article><h1>T{n}</h1><p>{' '.join(f'w{n}x{j}' for j in range(size))}</p>{box}<p>end {n}</article>"


def plain(n, size=40):
    return f"T{n} {' '.join(f'w{n}x{j}' for j in range(size))} end {n}"


def test_hosts_judge_boxes_of_declared_articles(spark):
    """Boxes that nothing names go if the host shows them around articles, and in different ones."""
    foot = f"<footer>{SITE}</footer>"
    box = f"<div class='b7'><p>{SITE}</div>"
    part, bare, head = f"<div class=b7>{SITE} now</div>", f"<div>{SITE}</div>", f"<h2 class=b7>{SITE}</h2>"
    rows = [(i, "http://a.example/", article(i, box) + foot) for i in range(4)]
    rows += [(4 + i, "http://a.example/", article(4 + i, kept) + foot) for i, kept in enumerate((part, bare, head))]
    rows += [(7, "http://a.example/", f"<article class=post>{box}</article>{foot}")]
    rows += [(8, "http://a.example/", f"<main>{box * 20}{article(8, '')}</main>")]
    # Nothing around articles says so; few pages around; few articles.
    rows += [(10 + i, "http://b.example/", article(10 + i, box)) for i in range(4)]
    rows += [(20 + i, "http://c.example/", article(20 + i, box) + foot * (i < 2)) for i in range(4)]
    rows += [(30 + i, "http://d.example/", article(30 + i, box * (i < 2)) + foot) for i in range(4)]
    found = {r["page_id"]: r["text"] for r in pages.main_text(table(spark, rows)).collect()}
    wanted = {i: plain(i) for i in (*range(4), 8, 32, 33)}
    wanted |= {i: plain(i).replace(" end", f" {SITE} end") for i in (5, 6, *range(10, 14), *range(20, 24), 30, 31)}
    wanted |= {4: plain(4).replace(" end", f" {SITE} now end"), 7: SITE}
    assert found == wanted


def test_near_copies_of_an_article_keep_their_lead(spark):
    """Many pages lead to one article; its copies and editions are no evidence of a notice."""
    lead = f"<p class='lead'>{SITE}</p>"
    rows = [(i, f"http://a.example/{i}", article(1, lead, 400) + f"<aside>{SITE}</aside>") for i in range(6)]
    rows += [(6, "http://a.example/6", article(1, lead, 399) + f"<aside>{SITE}</aside>")]
    found = {r["page_id"]: r["text"] for r in pages.main_text(table(spark, rows)).collect()}
    assert found == {
        i: plain(1, 399 if i == 6 else 400).replace(" end", f" {SITE} end") for i in range(7)
    }


def test_boxes_are_counted_over_all_arrays(spark):
    """Three of a host's 400 pages have a notice in a box, three others in their footers."""
    rows = []
    for i in range(400):
        box = f"<div class=b7>{SITE}</div>" if i in (5, 105, 305) else "<p class=own>own text</p>"
        foot = f"<footer>{SITE}</footer>" if i in (50, 150, 350) else ""
        rows.append((i, f"http://a.example/{i}", article(i, box) + foot))
    found = pages.main_text(table(spark, rows), pages_per_array=10).collect()
    own = {i: plain(i).replace(" end", " own text end") for i in range(400)}
    assert {r["page_id"]: r["text"] for r in found} == own | {i: plain(i) for i in (5, 105, 305)}


@pytest.mark.parametrize(
    "page, boxes",
    [
        ("<article><div class=x>a<p>b</div>c<section id=y>d</section></article>", {1: "a b", 2: "d"}),
        ("<article><p class=x>a<p>b<p class=y>c<div>d</div>e</article>", {1: "a", 2: "c"}),
        ("<article><div class=x>a<div>b</div><div class=y>c</div>d</div>e</article>", {1: "a b d", 2: "c"}),
        ("<article><ul><li class=x>a<li>b</ul><div class=y>c</article><div class=z>d", {1: "a", 2: "c"}),
        ("<article><span class=x>a</span><h2 class=x>b</h2><div class=''>c</div></article>", {}),
        ("<article class=post><div class=entry-content>a</div><div class=ad>b</div></article>", {}),
        ("<main id=content><div class=x>a</div><article class=x>b</article></main>", {1: "a"}),
        ("<div class=x>a</div><article>b</article>", {}),
    ],
)
def test_boxes(page, boxes):
    parts = [(zone, text, box) for zone, chrome, text, box in pages.blocks(page) if not chrome]
    assert pages.boxed_texts(parts, 1) == boxes


def test_unclosed_boxes_take_no_square_time():
    page = "<article>" + "<div class=x>word " * 100_000
    assert len(pages.blocks(page)) == 100_000


def test_loose_pages_lose_what_the_host_repeats(spark):
    own = [" ".join(f"w{i}x{j}" for j in range(15)) for i in range(6)]
    rows = [
        (i, f"http://site.example/{i}", f"<div>{SITE}</div><p>{text}</p><footer>{SITE}</footer>")
        for i, text in enumerate(own)
    ]
    rows += [(10, "http://other.example/", f"<p>{SITE}</p>"), (11, None, f"<p>{SITE}</p>")]
    rows += [(12 + i, "http://copies.example/", f"<p>{own[0]}</p>") for i in range(4)]
    found = {r["page_id"]: r["text"] for r in pages.main_text(table(spark, rows)).collect()}
    assert found == {**dict(enumerate(own)), 10: SITE, 11: SITE, **{12 + i: own[0] for i in range(4)}}


def test_repeated_passages_stay_in_articles(spark):
    rows = [(i, "http://a.example/", f"<article>{SITE} {i}</article><footer>{SITE}") for i in range(5)]
    found = {r["page_id"]: r["text"] for r in pages.main_text(table(spark, rows)).collect()}
    assert found == {i: f"{SITE} {i}" for i in range(5)}


def test_many_arrays_for_one_host(spark):
    rows = [(i, "http://a.example/", f"<p>{SITE}<p>own text of page {i} " + f"u{i} " * 9) for i in range(200)]
    found = pages.main_text(table(spark, rows), pages_per_array=50).collect()
    assert len(found) == 200
    assert all("Welcome" not in r["text"] and f"u{r['page_id']}" in r["text"] for r in found)


def test_a_passage_on_few_pages_of_a_large_host(spark):
    rng = random.Random(1)
    words = {i: [f"u{i}x{j}" for j in range(10)] for i in range(10_000)}
    passages = {n: [f"p{n}x{j}" for j in range(11)] for n in (2, 3, 40)}
    for n, passage in passages.items():
        for i in rng.sample(range(10_000), n):
            words[i] += passage
    for i in rng.sample(range(10_000), 9):  # copies of one page
        words[i] = words[0]
    rows = [(i, f"http://a.example/{i}", f"<p>{' '.join(own)}") for i, own in words.items()]
    holders = {}
    for own in words.values():
        for i in range(len(own) - 7):
            holders.setdefault(tuple(own[i : i + 8]), set()).add(tuple(own))
    wanted = {}
    for page, own in words.items():
        gone = set()
        for i in range(len(own) - 7):
            if len(holders[tuple(own[i : i + 8])]) >= 3:
                gone.update(range(i, i + 8))
        wanted[page] = " ".join(w for i, w in enumerate(own) if i not in gone)
    assert sum("p40x" in text for text in wanted.values()) == 0
    assert {r["page_id"]: r["text"] for r in pages.main_text(table(spark, rows)).collect()} == wanted


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "http://x/", "<p"), (3, "http://x/", "<p"), (None, "u", "<article>t")]
    rows.append((4, "u", "<article>" + "word " * 200_000))
    found = pages.main_text(table(spark, rows))
    assert found.columns == ["page_id", "url", "text"]
    texts = sorted((r["page_id"] or 0, len(r["text"])) for r in found.collect())
    assert texts == [(0, 1), (1, 0), (2, 0), (3, 0), (3, 0), (4, 999_999)]
    assert pages.main_text(table(spark, [])).count() == 0


def test_repeats_against_brute_force():
    rng = random.Random(0)
    for _ in range(30):
        streams = [np.array([rng.randrange(3) for _ in range(rng.randrange(30))]) for _ in range(6)]
        owners = np.array([0, 1, 2, 3, 3, 4])
        size, least = rng.choice([2, 3, 5]), rng.choice([2, 3])
        holders = {}
        for stream, owner in zip(streams, owners):
            for i in range(len(stream) - size + 1):
                holders.setdefault(tuple(stream[i : i + size]), set()).add(int(owner))
        for stream, got in zip(streams, pages.repeated_tokens(streams, owners, size, least)):
            wanted = np.zeros(len(stream), bool)
            for i in range(len(stream) - size + 1):
                if len(holders[tuple(stream[i : i + size])]) >= least:
                    wanted[i : i + size] = True
            assert (wanted == got).all()


def test_query_against_a_plain_reading(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r["page_id"]: r for r in QUERIES["op10_page_text"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert (found[r["page_id"]]["text"], found[r["page_id"]]["n_chars"]) == (text, len(text))
        assert found[r["page_id"]]["url"] == r["url"]
