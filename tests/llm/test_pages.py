"""Main text of small pages, and the shape of the densities."""

import math

import pytest

from postpulse.llm import pages

LONG = "Plain words that tell a story of some length, enough to be the article of a page. " * 4
MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">entry {i}</a></li>' for i in range(9)) + "</ul></nav>"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("no markup &amp; no body", "no markup & no body"),
        (f"<body>{MENU}<article><h1>T</h1><p>{LONG}<b>x</b><br></article><footer>f</footer>",
         f"T\n{LONG}x"),
        (f"<html><body>{MENU}<div class='ad'>{LONG}{LONG}</div><div id=main><p>{LONG}<p>a  b\n c"
         f"</div><section class='comments'><p>{LONG}</section>", f"{LONG.strip()}\na b c"),
        (f"<body><script>if (a < b) '</p>'</script><style>p{{}}</style><p>{LONG}&lt;i&gt; &eacute;"
         "<!-- <p>gone</p> --></p>", f"{LONG}<i> é"),
        (f"<body><form><p>{LONG}</p></form><main><ul><li>{LONG}<li>two</ul></main>",
         f"{LONG.strip()}\ntwo"),
        (f"<body><header><h2>Site</h2></header><article><header><h1>T</h1></header><p>{LONG}"
         "</p></article><aside><p>side</p></aside>", f"T\n{LONG.strip()}"),
        (f"<body><p>{LONG}</p><p hidden>{LONG}</p><p>cut <a href='x", f"{LONG.strip()}\ncut"),
    ],
)
def test_main_text(page, text):
    assert pages.main_text(page) == "\n".join(" ".join(b.split()) for b in text.split("\n"))


ARTICLE = f"<article><h1>T</h1><p>{LONG}</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{MENU}<div class='layout has-sidebar'>{ARTICLE}</div>",
        f'<body><div id="content-sidebar-wrap">{MENU}{ARTICLE}</div>',
        f"<body><div class='no-comments'><div class='post related'>{ARTICLE}</div></div>",
        f"<body><div class=widget><main><h1>T</h1><p>{LONG}</p></main></div>",
        f"<body><div class='noCommentsHere post'><h1>T</h1><p>{LONG}</div>{MENU}",
        f"<body><section class='Related'><div><p>T<p>{LONG}</div></section><p><a href=x>{LONG}</a>",
        f"<body><div class=layout>{ARTICLE}<div class='box Sidebar'><p>{LONG}</div></div>",
        f"<body>{ARTICLE}<section id=comments><p>{LONG}<p>{LONG}<p>{LONG}</section>",
        f"<body><div class=ad>{LONG}{LONG}{LONG}</div>{ARTICLE}",
        f"<body><article><h1>T</h1><p>{LONG}</p><div class=comments><article>{LONG}</article></div>",
    ],
)
def test_names_of_wrappers_drop_no_content(page):
    assert pages.main_text(page) == f"T\n{LONG.strip()}"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id=aspnetForm>{MENU}{ARTICLE}</form>",
        f"<body><form id=aspnetForm>{MENU}<h1>T</h1><p>{LONG}</p></form>",
        f"<body><aside>{ARTICLE}</aside><footer>f</footer>",
        f"<body><fieldset><h2>T</h2><p>{LONG}</p></fieldset>{MENU}",
        f"<body><dialog open>{ARTICLE}</dialog>",
        f"<body><div role=dialog><div role=complementary>{ARTICLE}</div></div>",
        f"<body><div role=banner><main><h1>T</h1><p>{LONG}</p></main></div>",
        f"<body><form><input name=q> search</form>{ARTICLE}<form><p>{LONG}{LONG}{LONG}</form>",
    ],
)
def test_boxes_around_the_content_drop_none(page):
    assert pages.main_text(page) == f"T\n{LONG.strip()}"


@pytest.mark.parametrize(
    "name",
    ["cookie-banner", "site-footer", "comment-list", "ad-slot", "adSlot", "SiteFooter",
     "comments__thread", "share-buttons", "privacy-notice", "newsletter_box", "page-header"],
)
def test_compound_names(name):
    part = f"<div class='x {name}'><p>{LONG[:90]}</p></div>"
    assert pages.main_text(f"<body>{part}{ARTICLE}{part}") == f"T\n{LONG.strip()}"
    unframed = f"<body>{part}<div><h1>T</h1><p>{LONG}</p></div>{part}"
    assert pages.main_text(unframed) == f"T\n{LONG.strip()}"
    assert pages.main_text(f"<body>{MENU}<div class={name}>{ARTICLE}</div>") == f"T\n{LONG.strip()}"


@pytest.mark.parametrize(
    "name", ["no-comments", "hasSidebar", "content-sidebar-wrap", "share-price", "social-policy", "headline"]
)
def test_names_that_say_nothing(name):
    page = f"<body><article><h1>T</h1><p class={name}>{LONG}</p><p>{LONG}</p></article>"
    assert pages.main_text(page) == f"T\n{LONG.strip()}\n{LONG.strip()}"


def test_character_data_sections_are_markup():
    assert pages.main_text(f"<body><p>{LONG}<![CDATA[ a > b ]]></p>") == LONG.strip()


def test_links_lower_the_density():
    dom = pages.Dom(f"<body><div>{LONG}</div><div><a>{LONG}</a></div></body>")
    by_tag = dict(zip(range(len(dom.tags)), pages.densities(dom, 1)))
    plain, linked = (by_tag[i] for i, t in enumerate(dom.tags) if t == "div")
    assert plain > linked == 0


def test_density_formula():
    dom = pages.Dom("<body><div>abcd<a>ef</a></div></body>")
    c, t, lc, lt, share = 6, 1, 2, 1, 2 / 6
    base = math.log(c / (c - lc) * lc + share * c + math.e)
    expected = c / t * math.log(c / lc * t / lt) / math.log(base)
    assert pages.densities(dom, 1)[2] == pytest.approx(expected)


def test_very_deep_and_long_pages():
    deep = "<div>" * 20_000 + LONG
    assert pages.main_text(f"<body>{deep}") == LONG.strip()
    assert len(pages.main_text("<body>" + f"<p>{LONG}</p>" * 2000)) == 2000 * len(LONG) - 1


def test_table(spark):
    rows = [(1, "u", f"<body><p>{LONG}</p>", "x"), (2, None, None, None), (2, "", "", "y")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, N_chars string")
    found = pages.extract(frame).orderBy("page_id", "url").collect()
    assert [(r.page_id, r.text, r.n_chars) for r in found] == [
        (1, LONG.strip(), len(LONG.strip())), (2, "", 0), (2, "", 0)]
    assert pages.extract(frame.limit(0)).count() == 0
