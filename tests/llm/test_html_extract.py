import pytest

from hazeline.llm import html_extract
from hazeline.llm.html_extract import main_text

LONG = "This is a paragraph of the article that goes on for a while, as they do, with several words. " * 3
PAGES = {
    "article": (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p><p>no</p>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href=/>Menu</a></ul></nav><div class='ad'>Buy " + LONG + "</div>"
        "<article><h1>Head</h1><p>First &amp; <b>bold</b>\n  &eacute; &#8364;</p><p>Short.<br>Line"
        "<div class='comments'><p>" + LONG + "</p></div><form><p>mail</p><input></form><footer>by</footer></article>"
        "<aside>" + LONG + "</aside><footer>end</footer></body></html>",
        "Head\nFirst & bold é €\nShort. Line",
    ),
    "no article": (
        "<body><div id=menu><a href=a>one</a> <a href=b>two</a></div><div><h2>Head</h2><p>" + LONG + "</p><p>Short.</p><p>"
        + LONG + "</p></div><div><a href=c>More</a> <a href=d>Even more</a></div><div class='cookie-notice'>" + LONG + "</div>",
        "Head\n" + LONG.strip() + "\nShort.\n" + LONG.strip(),
    ),
    "cut off": ("<body><nav><a href=x>y</a></nav><article><p>Text that ends <b>in the mid", "Text that ends in the mid"),
    "unclosed menu": ("<nav><ul><li><a href=x>y</a><article><p>" + LONG, LONG.strip()),
    "cut off in a tag": ("<article><p>Text</p><p class='x", "Text"),
    "comments after it": (
        "<main><p>" + LONG + "</p></main><section id='reader-comments'><article class='comment'><p>" + LONG + "</p></article></section>",
        LONG.strip(),
    ),
    "nothing": ("<html><body><nav>a</nav></body></html>", ""),
    "empty": ("", ""),
    "null": (None, ""),
    "plain text": ("just   text\nhere", "just text here"),
    "names of layouts and topics": (
        "<div class='page has-sidebar'><article class='post category-social tag-ad-blockers'><div class='post-header'>"
        "<h2>Head</h2></div><p>" + LONG + "</p><div class='share-buttons'>share</div></article>"
        "<article class='teaser'><p>" + LONG + "</p></article></div>",
        "Head\n" + LONG.strip(),
    ),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    "broken": ("<article><p>a < b && c > d</b></i></p><!-- no --><![CDATA[x]]><p>e", None),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_page(name):
    html, expected = PAGES[name]
    text = main_text(html or "")
    if expected is None:
        assert text.startswith("a < b && c > d") and text.endswith("e")
    else:
        assert text == expected


CARDS = "".join(f"<article class='card'><h3><b>Card</b> {n}</h3><p><i>By</i> <b>us</b></p></article>" for n in range(4))


def test_main_text_outside_of_articles():
    """Articles that are only cards don't displace the text beside them; one next to it may be smoothed in."""
    text = f"<div class='story'><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p><p>{LONG}</p></div>"
    for page in (f"<body>{text}<div>{CARDS}</div></body>", f"<body><div>{CARDS}</div>{text}</body>"):
        found = main_text(page)
        assert "\n".join(["Head", LONG.strip(), "Short.", LONG.strip(), LONG.strip()]) in found
        assert "Card 1" not in found and "Card 2" not in found


def test_main_text_in_an_article_and_beside_it():
    page = f"<body><article><p>{LONG}</p><p>{LONG}</p></article><div>{CARDS}</div><section><p>{LONG}</p><p>{LONG}</p></section></body>"
    found = main_text(page)
    assert found.split("\n").count(LONG.strip()) == 4
    assert "Card 1" not in found and "Card 2" not in found


def test_articles_of_links_only():
    """Where no block speaks for a region, articles are all there is."""
    assert main_text("<body><div><a href=x>Menu</a></div><article><a href=y>Text</a></article></body>") == "Text"


def test_a_very_long_page():
    html = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    assert main_text(html) == "\n".join([LONG.strip()] * 3000)
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_two_clusters():
    values = html_extract.smoothed(html_extract.np.array([1.0, 1, 1, 90, 100, 95, 1, 1]), 0.5)
    border = html_extract.threshold(html_extract.np.log1p(values))
    assert [value > border for value in html_extract.np.log1p(values)] == [False] * 3 + [True] * 3 + [False] * 2


def test_table(spark):
    rows = [(number, name, html, "kept", 1) for number, (name, (html, _)) in enumerate(sorted(PAGES.items()))]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = html_extract.extract(df)
    assert sorted(found.columns) == sorted(df.columns)
    got = found.collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.n_chars == len(row.text)
        if PAGES[row.url][1] is not None:
            assert row.text == PAGES[row.url][1]
    assert html_extract.extract(df.limit(0)).count() == 0


PARAGRAPH = "<p>{} is a long paragraph of the article that tells the reader a good deal about its subject, in whole sentences, without links.</p>"


@pytest.mark.parametrize("name", ["class='related-work'", "class='legal-history'", "id=search", "class='banner-making guide'"])
def test_names_that_may_be_topics_do_not_cost_a_section(name):
    page = f"<body><article><h1>Title</h1>{PARAGRAPH.format('One') * 3}<section {name}><h2>More on it</h2>{PARAGRAPH.format('Two') * 2}</section></article></body>"
    lines = html_extract.main_text(page).split("\n")
    assert len(lines) == 7 and lines[4] == "More on it" and lines[5].startswith("Two is")


def test_a_container_named_like_its_topic():
    page = f"<body><main><div class='search-story'>{PARAGRAPH.format('One') * 3}</div></main></body>"
    assert html_extract.main_text(page).count("One is") == 3


@pytest.mark.parametrize("part", [
    f"<div class='comments'>{PARAGRAPH.format('Reply') * 4}</div>",
    f"<div class='comment-list user-posts'>{PARAGRAPH.format('Reply') * 4}</div>",
    f"<section class='discussion' id=talk>{PARAGRAPH.format('Reply') * 4}</section>",
    "<div class='newsletter-weekly'>Reply: get it every week</div>",
    "<div class='related-reading'>" + "<p><a href=x>Reply to a long story that somebody else wrote about quite another subject</a></p>" * 5 + "</div>",
])
def test_what_the_name_and_the_text_speak_against_goes(part):
    page = f"<body><article>{PARAGRAPH.format('One') * 3}{part}</article></body>"
    assert "Reply" not in html_extract.main_text(page)
