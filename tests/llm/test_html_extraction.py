import html as html_module
import re

import pytest

from careflow.llm.html_extraction import extract, main_text

PAGE = """<html><head><title>Site</title><script>var a = "<p>no</p>";</script><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=x>one</a><li><a href=y>two</a></ul></nav>
<div class="cookie-notice">We use cookies on all of our pages, see the notice.</div>
<{tag}><h1>Title</h1><p>First   para of
text that is long &amp; good enough.<p>Second<br>one.</p><ul><li>a<li>b</ul>
<div class="ad">Buy now</div><form><label>Name</label><input></form><aside>Beside</aside></{tag}>
<div class="sidebar"><p>Some long text at the side that nobody wants in the article text at all.</p></div>
<section id="comments"><article class="comment"><p>I like this very much, says a long reader comment, longer than the article.</p></article></section>
<footer>&copy; all</footer></body></html>"""
TEXT = "Title\nFirst para of text that is long & good enough.\nSecond one.\na\nb"


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_article_only(tag):
    assert main_text(PAGE.replace("{tag}", tag)) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav>a</nav><footer>b</footer>", ""),
        ("plain &lt; text", "plain < text"),
        ("<article><p>open", "open"),
        ("<article></p></b>x<b>y</article>z", "xy"),
        ("<article>" + "<b>" * 2000 + "deep", "deep"),
        ("<p>a&nbsp; b</p>", "a b"),
        ("<article><p>" + "word " * 50_000 + "</p></article>", ("word " * 50_000).strip()),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


PARAGRAPH = "A paragraph of the article that is long enough to count as its text, with some words more."


@pytest.mark.parametrize(
    "inline",
    [
        "<button>Share</button>", "<noscript>Turn it on</noscript>", "<svg><text>Icon</text></svg>", "<textarea>Type here</textarea>",
        "<iframe>Frame</iframe>", "<span hidden>Never</span>", '<span style="display: none">Never</span>', '<span class="advertisement">Buy</span>',
        '<a class="ad" href=x>Buy</a>', "<select><option>One</select>", "<label>Your mail</label>", '<span class="share-links">Share <b>this</b></span>',
        '<a class="adbox" href=x>Buy</a>', "<button>a <i>b</i></button>",
    ],
)
def test_side_matter_within_a_line(inline):
    assert main_text(f"<article><p>{PARAGRAPH} {inline} and on.</p><p>{PARAGRAPH}</p></article>") == f"{PARAGRAPH} and on.\n{PARAGRAPH}"


def test_buttons_and_labels_outside_forms():
    assert main_text(f"<article><p>{PARAGRAPH}</p></article><button>B</button><label>Your mail</label>") == PARAGRAPH


@pytest.mark.parametrize("kept", ['<span class="notice">n</span>', "<b>n</b>", '<span class="text-header">n</span>', '<em class="has-ads">n</em>'])
def test_inline_elements_that_stay(kept):
    assert main_text(f"<article><p>{PARAGRAPH} {kept} end</p></article>") == f"{PARAGRAPH} n end"


def test_linked_lines_of_an_article():
    items = "<ul><li>first kept item</li><li><a href=x>linked item text</a></li><li>third kept item</li></ul>"
    page = f"<article><p>{PARAGRAPH}</p>{items}<div><a href=y>A block that is a link</a></div><p>{PARAGRAPH}</p></article>"
    assert main_text(page) == f"{PARAGRAPH}\nfirst kept item\nlinked item text\nthird kept item\nA block that is a link\n{PARAGRAPH}"
    menu = "<ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul>"
    assert main_text(f"<div>{menu}</div><article><p>{PARAGRAPH}</p></article>{menu}") == PARAGRAPH


@pytest.mark.parametrize("name", ['class="user-responses"', 'class="reader-feedback"', 'class="promobox"', 'id="adbox"', 'id="secondary"', 'class="adslot-1"'])
def test_names_of_comments_and_advertisements(name):
    side = f"<div {name}><p>{PARAGRAPH}</p></div>"
    assert main_text(f"<div class='wrap'><div class='story'><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>{side}</div>") == f"{PARAGRAPH}\n{PARAGRAPH}"


@pytest.mark.parametrize("name", ["adventure", "address", "admin", "promote-less advice", "adaptation"])
def test_names_that_begin_alike(name):
    assert main_text(f"<article><div class='{name.split()[-1]}'><p>{PARAGRAPH}</p></div></article>") == PARAGRAPH


def test_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x")], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract(pages).collect()), key=repr)
    article = (1, "u", main_text(PAGE), len(main_text(PAGE)))
    assert got == sorted([article, article, (None, None, "", 0)], key=repr)
    assert extract(pages.limit(0)).count() == 0


def test_all_pages_of_the_tables(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    want = {}
    for row in pages.collect():
        inside = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        lines = [" ".join(html_module.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        want[row.page_id] = "\n".join(x for x in lines if x)
    assert {r.page_id: r.text for r in extract(pages).collect()} == want


LONG = "A paragraph of the page that is long enough to be seen as its text, with words and more words. " * 4
LONG = LONG.strip()


def test_regions_beside_each_other():
    """Heading and lead outside the body's container, a linked paragraph, and two articles."""
    page = f"<body><div id=top><h1>Title</h1><p>The lead.</p></div><div id=rest><p>{LONG}</p><p><a href=x>One linked paragraph</a></p><p>{LONG}</p></div><nav>n</nav></body>"
    assert main_text(page) == f"Title\nThe lead.\n{LONG}\nOne linked paragraph\n{LONG}"
    page = f"<body><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG}</p></article><footer>f</footer></body>"
    assert main_text(page) == f"One\n{LONG}\nTwo\n{LONG}"


@pytest.mark.parametrize(
    "wrapper",
    ['class="content has-sidebar"', 'id="page" class="no-sidebar"', 'class="main header-fixed"', 'class="sidebar-left"', 'class="layout with-footer"'],
)
def test_wrappers_with_side_words(wrapper):
    assert main_text(f"<body><div {wrapper}><article><h1>T</h1><p>{LONG}</p></article></div></body>") == f"T\n{LONG}"


@pytest.mark.parametrize("part", ['section id="discussion"', 'div class="popular-science"'])
def test_doubtful_parts_of_an_article(part):
    tag = part.split()[0]
    page = f'<body><article><h1>T</h1><p>{LONG}</p><{part}><h2>D</h2><p>{LONG}</p></{tag}><div class="ad">Buy</div></article></body>'
    assert main_text(page) == f"T\n{LONG}\nD\n{LONG}"
