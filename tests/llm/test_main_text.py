from __future__ import annotations

from tidemark.llm.main_text import Line, extract_main_text, main_text, surge_and_dive

BODY = "A first paragraph with enough words in it to make the sum over a window of lines surge well above the bar."
PAGE = f"""<html><head><title>T</title><script>var t="</p><article>";</script></head><body>
<header><h1>Site</h1><nav><a href=x>home</a></nav></header><div id="cookie-notice">We use cookies</div>
<div class="post"><h1>The title</h1><p>{BODY} <b>bo</b>ld &lt;yes&gt; &amp;amp;</p><p>Short.</p>
<div class="ad">Buy now!</div><p>{BODY}</p><p>End.</p></div><aside class=sidebar><ul><li><a href=1>link</a></li></ul></aside>
<section id="comments"><div class="comment"><p>{BODY}</p></div></section><form><label>Name</label></form><footer>(c)</footer>"""


def test_page_without_article_element():
    assert main_text(PAGE) == f"The title {BODY} bold <yes> &amp; Short. {BODY} End."


def test_article_element_keeps_short_blocks():
    html = f"<nav>{'menu ' * 50}</nav><article><h1>Hi</h1><p>a<br>b\n c</p></article><p>{BODY * 3}</p>"
    assert main_text(html) == "Hi a b c"


def test_surge_and_dive_keep_what_is_between():
    line = lambda n: Line("x" * n, n, False)
    lengths = [3, 0, 0, 0, 0, 0, 0, 0, 0, 0, 60, 0, 70, 2, 0, 90, 0, 0, 0, 0, 0, 0, 0, 0, 0, 5]
    assert surge_and_dive([line(n) for n in lengths]) == (10, 16)
    assert surge_and_dive([]) == (0, 0)


def test_awkward_pages(spark):
    pages = [
        (1, "u", None), (2, None, ""), (None, "u", "<p>only this"), (4, "u", "<div class='ad'>x<article>real</article>"),
        (5, "u", "<p><![CDATA[raw]]> &nbsp; end"), (6, "u", "<" * 50), (7, "u", "<p>" + "w " * 200_000), (7, "u", "<p>w"),
    ]
    got = extract_main_text(spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string"))
    texts = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()))
    assert [t[:2] for t in texts[:5]] == [(0, "only this"), (1, ""), (2, ""), (4, "real"), (5, "raw end")]
    assert all(len(t) == n for _, t, n in texts) and max(n for _, _, n in texts) == 399_999
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_short_blocks_do_not_split_an_article():
    long = BODY * 3
    blocks = lambda *texts: "".join(f"<p>{t}</p>" for t in texts)
    items = ["one", "two", "three"]
    page = f"<p>{BODY * 2}</p><ul>{''.join(f'<li>{i}</li>' for i in items)}</ul><p>{long}</p>"
    assert main_text(page) == " ".join([BODY * 2, *items, long])
    talk = ["Yes.", "No?", "Yes!", "Oh.", "Well.", "So.", "Hm."]
    assert main_text(blocks(BODY, *talk, long)) == " ".join([BODY, *talk, long])
    cells = "".join(f"<tr><td>{k}</td><td>v{k}</td></tr>" for k in range(9))
    got = main_text(f"<p>{long}</p><div><table><tbody>{cells}</tbody></table></div><p>{BODY}</p>")
    assert got == " ".join([long, *(f"{k} v{k}" for k in range(9)), BODY])
    code = "".join(f"<div><div><div>x = {k}</div></div></div>" for k in range(5))
    assert main_text(f"<p>{BODY}</p>{code}<p>{long}</p>") == " ".join([BODY, *(f"x = {k}" for k in range(5)), long])


def test_title_byline_and_short_closing_blocks_stay():
    html = f"<div><h1>The title</h1></div><div><p>By Ann</p></div><div><div><p>{BODY}</p><p>{BODY}</p></div><p>Short.</p><p>End.</p></div>"
    assert main_text(html) == f"The title By Ann {BODY} {BODY} Short. End."


def test_link_and_side_text_part_blocks():
    links = "".join(f"<li><a href=x>another page {k}</a></li>" for k in range(30))
    side = f"<div class=sidebar>{BODY * 4}</div>"
    for beside in (f"<ul>{links}</ul>", side):
        assert main_text(f"<p>Site</p>{beside}<p>{BODY * 3}</p>{beside}<p>{BODY}</p>") == BODY * 3
    advert = f"<div class=ad>{BODY}</div>"
    assert main_text(f"<p>{BODY * 2}</p>{advert}<p>{BODY * 3}</p>") == f"{BODY * 2} {BODY * 3}"


def test_names_with_modifiers_do_not_drop_the_article():
    for attributes in ("class='post comments-open'", "class='hentry has-comments'", "class=with-sidebar", "class='notice'"):
        for tag in ("article", "main"):
            assert main_text(f"<nav>menu</nav><{tag} {attributes}><h1>T</h1><p>{BODY}</p></{tag}>") == f"T {BODY}"
    for name in ("content with-sidebar", "main-menu-open", "page no-sidebar", "hasSidebar", "content-sidebar-wrap"):
        assert main_text(f"<div class='{name}'><h1>T</h1><p>{BODY}</p></div><p>End.</p>") == f"T {BODY} End."
    assert main_text(f"<div class='widget'><article class='post form'><p>{BODY}</p></article></div>") == BODY


def test_names_of_side_elements_still_count():
    for name in ("sidebar", "left-sidebar", "sidebar-left", "adBox", "ad-container-2", "cookie_notice", "comments-area", "site-header"):
        assert main_text(f"<div class='{name}'>{BODY}</div><p>{BODY} End.</p>") == f"{BODY} End.", name
    comment = f"<ol class=comment-list><li class=comment><article class=comment-body><p>{BODY * 2}</p></article></li></ol>"
    assert main_text(f"<article><p>{BODY}</p></article><div id=comments>{comment}</div>") == BODY
    assert main_text(f"<article class=comment><p>{BODY}</p></article>") == BODY


def test_all_article_elements_stay():
    between = "".join(f"<div><p>beside {k}</p></div>" for k in range(9))
    html = f"<article><h1>One</h1><p>{BODY}</p></article>{between}<article><h2>Two</h2><p>Short.</p></article>"
    assert main_text(html) == f"One {BODY} Two Short."
