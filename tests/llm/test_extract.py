import time

from dwellspark.llm import extract


def page(body, head="<title>t</title><script>var t='</p>';</script><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


LONG = "This is a sentence, with a comma. And another one, which ends here. "


def test_article_without_the_rest():
    source = page(
        '<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>no</p> -->'
        '<div class="cookie-notice">We use cookies, all of them.</div><div class="ad">Buy this, now.</div>'
        f"<article><h1>Title</h1><p><b>Bold start.<br><p>{LONG}</p><p>Tom&nbsp;&amp; \n Jerry &lt;3</p><p>End.</p>"
        '<section class="comments"><p>First comment, a long one. Really, it is long.</p></section></article>'
        '<aside><p>Related story, with text.</p></aside><form><label>Mail</label><input></form><footer>&copy; us</footer>'
    )
    assert extract.main_text(source).split("\n") == ["Title", "Bold start.", LONG.strip(), "Tom & Jerry <3", "End."]


def test_page_without_an_article_element():
    source = page(f'<div id="menu"><a>One</a> <a>Two</a></div><div class="content"><h2>Head</h2><p>{LONG * 3}</p><p>{LONG}</p></div><div class="sidebar">Side, bar.</div>')
    assert extract.main_text(source).split("\n") == ["Head", (LONG * 3).strip(), LONG.strip()]


def test_broken_and_empty_pages():
    assert extract.main_text("") == "" and extract.main_text("<p") in ("", "<p")
    assert extract.main_text(page("<nav>a, b.</nav>")) == ""
    assert extract.main_text("<article><p>Unclosed, to the end. <i>Yes") == "Unclosed, to the end. Yes"
    assert extract.main_text("plain, text only.") == "plain, text only."
    deep = "<div>" * 3000 + "deep, text." + "</div>" * 3000
    assert extract.main_text(page(deep)) == "deep, text."


def test_table_with_nulls_and_repeats(spark):
    rows = [(1, "u", None, 5), (2, None, "", 5), (None, "u", page(f"<article><p>{LONG}"), 5), (3, "u", "<article>é</article>", 5)]
    rows += rows[-1:]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = extract.extract_pages(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [
        (0, LONG.strip(), len(LONG.strip())), (1, "", 0), (2, "", 0), (3, "é", 1), (3, "é", 1),
    ]
    assert extract.extract_pages(pages.limit(0)).count() == 0


def test_names_of_wrappers_do_not_bar_the_article():
    rest = '<div class="Sidebar">Side, bar.</div><div id="userComments">First, comment.</div><div class="MENU">One, two.</div>'
    text = f"<p>{LONG * 3}</p><p>{LONG}</p>"
    want = [(LONG * 3).strip(), LONG.strip()]
    for wrapper in ('div class="layout with-sidebar"', 'div class="post no-comments"', 'div id="search-results-page"', 'form action="/page.aspx"'):
        end = wrapper.split()[0]
        for inner in (f"<article>{text}</article>", f'<div class="content">{text}</div>'):
            assert extract.main_text(page(f"<{wrapper}>{inner}{rest}</{end}>")).split("\n") == want, wrapper
    long = f'<article>{text}</article><div class="comments"><p>{LONG * 20}</p></div>'
    assert extract.main_text(page(long)).split("\n") == want
    comments = f'<div class="content">{text}</div><ol class="comments"><li><article class="comment"><p>{LONG}</p></article></li></ol>'
    assert extract.main_text(page(comments)).split("\n") == want


def test_ratios_decide_inside_an_article():
    links = "".join(f'<li><a href="/{i}">Another story {i}</a></li>' for i in range(6))
    junk = f'<ul>{links}</ul><div class="s2"><a href="/t">Tweet</a> <a href="/m">Mail</a></div>'
    bottom = "".join(f'<div class="x9"><span>Buy {i}</span></div>' for i in range(8))
    body = "".join(f"<p>{LONG * 3}</p>" for _ in range(6))
    source = page(f'<article><header><h1><a href="/">Title</a></h1></header>{body}<p>End.</p>{junk}{bottom}</article>')
    assert extract.main_text(source).split("\n") == ["Title", *[(LONG * 3).strip()] * 6, "End."]


def test_short_parts_of_an_article_without_its_element():
    parts = f'<section id="s1"><p>{LONG * 9}</p></section><section id="s2"><p>Short, but whole.</p></section>'
    source = page(f'<div class="all"><div class="title"><h1>Title</h1></div><div class="intro"><p>A lead.</p></div><div class="text">{parts}</div></div>')
    assert extract.main_text(source).split("\n")[-2:] == [(LONG * 9).strip(), "Short, but whole."]
    source = page(f'<div class="all"><div class="title"><h1>Title</h1></div><div class="intro"><p>A lead.</p></div><div class="text"><p>{LONG * 9}</p></div></div>')
    assert extract.main_text(source).split("\n") == ["Title", "A lead.", (LONG * 9).strip()]


def test_comments_stay_out_whatever_they_weigh():
    comments = "".join(f"<p>{LONG * 2}</p>" for _ in range(6))
    inside = page(f'<article><p>{LONG}</p><div class="comments">{comments}</div></article>')
    assert extract.main_text(inside) == LONG.strip()
    after = page(f"<article><p>{LONG}</p></article><div>{comments * 3}</div>")
    assert extract.main_text(after) == LONG.strip()
    around = page(f'<div class="comments"><h1>Title</h1><p>{LONG * 3}</p><p>{LONG * 3}</p></div>')
    assert extract.main_text(around).split("\n") == ["Title", *[(LONG * 3).strip()] * 2]


def test_parts_of_an_article_that_are_links_or_details():
    source = page(f'<article><p>{LONG * 3}</p><p><a href="/x">A whole paragraph, as a link.</a></p><details><summary>More</summary>{LONG}</details><p>{LONG}</p></article>')
    want = [(LONG * 3).strip(), "A whole paragraph, as a link.", "More", LONG.strip(), LONG.strip()]
    assert extract.main_text(source).split("\n") == want


def test_hostile_pages_take_time_in_proportion():
    for piece in ("<a b='", '<a b="', "<b>x</b> ", "<![CDATA[", "<!x", "<!--", "<", "</b>", "<b>", "<div>", "<p><i>", "<a href=x>y", "<td>", "&lt;", "<hr>"):
        source = piece * (300_000 // len(piece))
        began = time.process_time()
        extract.main_text(f"<p>{LONG}</p>" + source)
        assert time.process_time() - began < 5, piece
