"""Main text of pages with known parts."""

from broadsheet.llm import html_text

ARTICLE = "<h1>Title here</h1><p>First <b>bold</b>\n paragraph &amp; more.<p>Second<br>line.</p><p>End.</p>"
TEXT = "Title here\nFirst bold paragraph & more.\nSecond\nline.\nEnd."
AROUND = [
    "<nav><ul><li><a href='/x'>Menu entry</a></ul></nav>",
    "<header><h2>Site name</h2></header>",
    "<div class='cookie-notice'>We use cookies. <div>Really.</div></div>",
    "<aside>Other things to read</aside>",
    "<div id=sidebar><p>Side</p></div>",
    "<form><label>Name</label><input name=q><button>Go</button></form>",
    "<script>var t='</p><p>no text';</script><style>p{color:red}</style>",
    "<!-- <p>not shown</p> -->",
    "<section class='comments'><article><p>A reader says something long enough to look like an article, really.</p></article></section>",
    "<footer>&copy; somebody</footer>",
    "<p class='ad'>Buy now",
]


def test_article_among_everything_else():
    page = "<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(AROUND) + f"<article>{ARTICLE}</article>" + "".join(AROUND)
    assert html_text.main_text(page) == TEXT
    assert html_text.main_text(page.replace("article>", "main>").replace("<main><p>A", "<article><p>A")) == TEXT


def test_parts_inside_the_article_are_left_out():
    for part in AROUND[2:]:
        if "class='ad'" not in part:
            assert html_text.main_text(f"<body><article>{ARTICLE}{part}<p>After.</p></article>") == TEXT + "\nAfter."


def test_class_names_that_say_what_an_element_has():
    page = f"<body class='no-ads'><div class='content has-sidebar'><article class='post has-comments ad-free'>{ARTICLE}"
    comment = "<article class='comment depth-1'><p>A reader agrees.</p></article>"
    assert html_text.main_text(f"{page}{comment}</article><aside>x</aside></div></body>") == TEXT


def test_page_without_article_element():
    long = "A sentence that is long enough to count as running text of a page. "
    menu = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{menu}</ul></div><div><p>{long * 3}</p><p>{long}</p><p>Short.</p></div><footer>x</footer></body>"
    assert html_text.main_text(page) == f"{(long * 3).strip()}\n{long.strip()}\nShort."


def test_broken_and_empty_pages():
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<article><p>Cut &am") == "Cut &am"
    assert html_text.main_text("<article><p>Cut &amp") == "Cut &"
    assert html_text.main_text("<article><p>Cut <a hre") == "Cut"
    assert html_text.main_text("<article><p>1 < 2 &lt;b&gt; &#233;&nbsp;&nbsp;x</p>") == "1 < 2 <b> é x"
    assert html_text.main_text("<article><a href='x?id=ad&class=menu'>Linked</a> text</article>") == "Linked text"


def test_long_page_is_linear():
    assert len(html_text.main_text("<article>" + "<p>word</p>" * 50_000)) == 5 * 50_000 - 1
    assert html_text.main_text("<" * 50_000) is not None


def test_table(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "old"), (2, None, None, "old"), (1, "u", "", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).select("page_id", "text", "n_chars").collect()
    assert sorted(map(tuple, got)) == [(1, "", 0), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_div_only_page_keeps_short_first_blocks():
    long = "Running text of the story that goes on for a while and says a lot of things. "
    page = (
        "<body><nav><a href='/'>Home</a></nav><div class='wrap'><div><h2>Title</h2><p>By Ann, May 2</p>"
        f"<p>{long * 4}</p><p>{long * 2}</p><p>Ends.</p></div></div>"
        "<div class='footer'>Contact</div></body>"
    )
    body = f"Title\nBy Ann, May 2\n{(long * 4).strip()}\n{(long * 2).strip()}\nEnds."
    assert html_text.main_text(page) == body


def test_short_article_is_kept_whole_and_weak_runs_go():
    assert html_text.main_text("<body><div><p>Only a line.</p><p>And one.</p></div></body>") == "Only a line.\nAnd one."
    long = "Words of the article proper that carry the page from start to end. " * 5
    links = "".join(f"<p><a href='/{i}'>Link {i}</a></p>" for i in range(5))
    page = f"<body><div><p>{long}</p></div>{links}<div><p>Share</p><p>Print</p></div></body>"
    assert html_text.main_text(page) == long.strip()
    assert html_text.main_text("<body><p><a href='/a'>Only links</a></p></body>") == ""
