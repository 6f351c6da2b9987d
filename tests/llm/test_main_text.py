"""Main text against articles that are marked, and hand-made pages."""

import html
import re

import pytest
from compare import connect, mismatch

from formlake.llm.main_text import extract_main_text, main_text
from formlake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"
LONG = "This paragraph goes on for long enough to be a surge in the distribution of text over lines, "


def test_all_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op10_main_text"](spark, FOLDER).collect()}
    assert len(got) == len(pages)
    for page in pages:
        article = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        wanted = "\n".join(b for b in blocks if b)
        row = got[page["page_id"]]
        assert (row["text"], row["n_chars"], row["url"]) == (wanted, len(wanted), page["url"])


def test_all_pages_equal_sql(spark):
    assert mismatch(QUERIES["op10_main_text"](spark, FOLDER), connect(FOLDER), ORACLES["op10_main_text"]) is None


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("", ""),
        ("plain", "plain"),
        ("<", "<"),
        ("a < b", "a < b"),
        ("<p>one<p>two &amp; &lt;three&gt;&nbsp;\n four", "one\ntwo & <three> four"),
        ("<article><h1>T</h1><p>x <a href=1>y</a>z<br>w</p></article><footer>f</footer>", "T\nx yz w"),
        ("<article><p>x</p><div class='ad'>buy</div><p>y</p></article>", "x\ny"),
        ("<article><header><h1>T</h1></header>x</article><div class=comments><article>c</article></div>", "T\nx"),
        ("<main>x<form>name</form><aside>more</aside></main><header>h</header>", "x"),
        ("<article>x<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> -->y</article>", "xy"),
        ("<nav>only a menu</nav>", ""),
        ("<article>" + "<p>a</p>" * 500 + "</article>", "\n".join(["a"] * 500)),
        ("<p title='a>b'>x", "x"),
        ("<script>never closed <p>x", ""),
    ],
)
def test_pages(page, wanted):
    assert main_text(page) == wanted


@pytest.mark.parametrize(
    "page, wanted",
    [
        ('<article><a class="skip-link" href="#c">Skip</a><h1>T</h1><p>one</p></article>', "T\none"),
        ('<body><a class="skip-link" href="#c">Skip</a><div><article>one</article></div></body>', "one"),
        ('<body><span class="share"><a href=1>f</a><span>t</span></span><p>one</p></body>', "one"),
        ('<p>a <span class="promo">x <span>y</span> z</span> b</p>', "a b"),
        ('<article><p>a<span class="ad"><div>x</div></span>b</p><p>c</p></article>', "a\nb\nc"),
        ('<article><p><a class="share">x<p>one</p><a href=1>two</a> three</article>', "one\ntwo three"),
        ('<article><p><b>one<br><p>two</b> three</p></article>', "one\ntwo three"),
    ],
)
def test_inline_furniture(page, wanted):
    assert main_text(page) == wanted


def test_unmarked_page():
    page = f"""<body class="with-sidebar"><div id="top-nav"><a href=1>Home</a> <a href=2>About</a></div>
    <ul><li><a href=3>one</a></li><li><a href=4>two</a></li></ul><div>by me</div><div></div>
    <div><h2>Title</h2><div>{LONG}first.</div><div>Short.</div><div>{LONG}second.</div></div>
    <div class="cookie-notice">{LONG}</div><div id=comments><p>{LONG}</p></div><p>&copy; 2020 us</p>"""
    assert main_text(page).splitlines()[-4:] == ["Title", f"{LONG}first.", "Short.", f"{LONG}second."]


def test_given_pages_without_landmarks(spark):
    for page in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        assert main_text(re.sub("</?article>", "", page["html"])) == main_text(page["html"])


ARTICLE = f"<h1>Title</h1><p>{LONG}first.</p><p>Short.</p><p>{LONG}second.</p>"
TEXT = f"Title\n{LONG}first.\nShort.\n{LONG}second."
CARDS = "".join(f"<article class='card'><h3>Story {i}</h3><p>And what it says.</p></article>" for i in range(4))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div>{ARTICLE}</div><div>{CARDS}</div></body>",
        f"<body><main><div>{ARTICLE}</div><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>"
        "<div><p>All about us.</p></div></main></body>",
        f"<body><div>Site of sites</div><article>{ARTICLE}</article><div>Some closing words</div></body>",
    ],
)
def test_landmarks_do_not_decide(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    "opening, closing",
    [
        ('<div class="layout has-sidebar">', "</div>"),
        ('<div class="no-sidebar"><article>', "</article></div>"),
        ('<div id="search-results"><div class="content-with-ads">', "</div></div>"),
        ('<form id="aspnetForm">', "</form>"),
        ('<form id="aspnetForm"><div class="ad">Buy this now.</div>', "</form>"),
    ],
)
def test_named_wrappers(opening, closing):
    assert main_text(f"<body><nav>menu</nav>{opening}{ARTICLE}{closing}<footer>end</footer></body>") == TEXT


def test_long_comments_stay_out():
    page = f"<body><div>{ARTICLE}</div><div id=comments>{f'<p>{LONG}</p>' * 20}</div></body>"
    assert main_text(page) == TEXT


LINKS = "<ul>" + "<li><a href=1>a link to another page</a></li>" * 4 + "</ul>"


@pytest.mark.parametrize("around", ["<body>{}</body>", "<body><div>{}</div></body>", "<body><div><p>{}</div></body>"])
def test_interrupted_articles(around):
    body = f"<p>Opening.</p>{LINKS}<p>{LONG}</p><p>{LONG}</p>{LINKS}<p>Closing words.</p>"
    assert main_text(around.format(body)) == f"Opening.\n{LONG.strip()}\n{LONG.strip()}\nClosing words."


def test_interrupted_sections():
    body = f"<section><p>{LONG}</p><p>{LONG}</p></section>{LINKS}<section><p>Closing.</p></section>"
    assert main_text(f"<body><div>{body}</div></body>") == f"{LONG.strip()}\n{LONG.strip()}\nClosing."


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "u", "<p>x"), (2, "u", "<p>x"), (2, "u", "<p>x"), (3, "", "<p>" + "long text " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' as text")
    got = sorted((r["page_id"] or 0, r["url"], r["n_chars"]) for r in extract_main_text(pages).collect())
    assert got == [(0, "u", 1), (1, None, 0), (2, "u", 1), (2, "u", 1), (3, "", 1_999_999)]
    assert extract_main_text(pages.limit(0)).count() == 0
