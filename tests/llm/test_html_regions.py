import frames

from tierstone.llm import html_regions as H

LONG = "Content words that go on for quite a while so that the line is long. " * 4
PAGE = f"""<!DOCTYPE html><html><head><meta charset="utf-8"><title>No title</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body class="home"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="cookie-notice"><p>{LONG}</p></div><!-- a comment -->
<article><h1>The &amp; title</h1><p><b>First&nbsp;part  of
 it.<br>{LONG}<p>Short.</p><div class="ad"><p>{LONG}</p></div><form><p>{LONG}</p></form><p>caf&#233; &lt;b&gt; 文</p>
<aside><p>{LONG}</p></aside><section id="comments"><p>{LONG}</p></section></article>
<div class="sidebar"><p>{LONG}</p></div><footer><p>{LONG}</p></footer></body></html>"""


def test_the_article_is_kept_and_nothing_else():
    assert H.main_text(PAGE) == "\n\n".join(["The & title", "First part of it. " + LONG.strip(), "Short.", "café <b> 文"])


def test_without_an_article_dense_lines_choose_their_parent():
    page = f"<body><div>{''.join('<a href=x>go</a> ' for _ in range(20))}</div><div><p>{LONG}</p><p>Tiny.</p><p>{LONG}</p></div></body>"
    assert H.main_text(page) == "\n\n".join([LONG.strip(), "Tiny.", LONG.strip()])


def test_without_an_article_short_lines_between_paragraphs_stay():
    text = LONG.strip()
    inner = f"<h2>Methods</h2><p>{LONG}</p><ul><li>item one</li><li>item two</li></ul><p>{LONG}</p>"
    inner += f"<table><tr><td>cell</td></tr></table><blockquote>Said.</blockquote><dl><dd>It is</dd></dl><p>{LONG}</p>"
    menu = "".join(f"<div><a href=x>go {k}</a></div>" for k in range(20))
    want = ["Methods", text, "item one", "item two", text, "cell", "Said.", "It is", text]
    for page in (f"<div>{inner}</div>", f"<section>{inner}</section>"):
        assert H.main_text(f"<body>{menu}{page}{menu}</body>") == "\n\n".join(want)
    outer = f"<body>{menu}<div><h1>Title</h1><div>{inner}</div></div>{menu}</body>"
    assert H.main_text(outer) == "\n\n".join(["Title", *want])


def test_text_outside_teaser_articles_is_kept():
    teasers = "".join(f"<article><h3><a href=x>Teaser {k}</a></h3></article>" for k in range(5))
    page = f"<body><div><h2>Own</h2><p>{LONG}</p><p>{LONG}</p></div>{teasers}</body>"
    assert H.main_text(page) == "\n\n".join(["Own", LONG.strip(), LONG.strip()])


def test_names_that_only_mention_furniture_keep_their_text():
    text = LONG.strip()
    body = f"<h2 id='search'>Head</h2><p>{LONG}</p><section id='discussion'><h3>Talk</h3><p>{LONG}</p></section>"
    want = "\n\n".join(["Head", text, "Talk", text])
    for names in ("layout has-sidebar", "no-sidebar", "post comments-open", "sidebar", "widget-area", "entry-header", "withSidebar"):
        assert H.main_text(f"<body><div class='{names}'>{body}</div></body>") == want, names
    assert H.main_text(f"<article class='post comment'>{body}</article>") == want
    comments = f"<div id='comments'>{f'<p>{LONG}</p>' * 9}</div><div class='sidebar-right'><p>{LONG}</p></div>"
    assert H.main_text(f"<body><div>{body}</div>{comments}</body>") == want
    assert H.main_text(f"<body><div>{body}</div><x-ad class='ad'>{LONG}</x-ad></body>") == want


def test_a_form_around_the_page_keeps_its_text():
    controls = "<label>Name</label><input name=x><button>Send</button><select><option>one</option></select>"
    page = f"<body><form action=/x><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div>{controls}</form><form><p>Sign up</p></form></body>"
    assert H.main_text(page) == "\n\n".join(["Head", LONG.strip(), LONG.strip()])
    assert H.main_text(f"<article><p>{LONG}</p><form><p>Sign up today</p>{controls}</form><p>{LONG}</p></article>") == "\n\n".join([LONG.strip()] * 2)


def test_short_blocks_in_their_own_elements_stay():
    text, menu = LONG.strip(), "<ul>" + "".join(f"<li><a href=x>go {k}</a></li>" for k in range(9)) + "</ul>"
    for inner, want in (("<ul><li>one</li><li>two</li></ul>", ["one", "two"]), ("<pre>x = 1</pre>", ["x = 1"]), ("<h3>Next</h3><p>Tiny.</p>", ["Next", "Tiny."])):
        for page in (f"<p>{LONG}</p><div>{inner}</div><p>{LONG}</p>", f"<div><p>{LONG}</p></div><div>{inner}</div><div><p>{LONG}</p></div>"):
            assert H.main_text(f"<body>{menu}<div>{page}</div>{menu}</body>") == "\n\n".join([text, *want, text])
    between = f"<div><p>{LONG}</p></div><div>{menu}</div><div><p>{LONG}</p></div>"
    assert H.main_text(f"<body><div>{between}</div></body>") == "\n\n".join([text, text])


def test_layout_tables_lose_their_menu_cell():
    menu = "<br>".join(f"<a href=x>go {k}</a>" for k in range(15))
    page = f"<body><table><tr><td>{menu}</td><td><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></td></tr></table></body>"
    assert H.main_text(page) == "\n\n".join(["Head", LONG.strip(), LONG.strip()])
    data = f"<body><div><p>{LONG}</p><p>{LONG}</p><table><tr><td>a</td><td>b</td></tr></table></div></body>"
    assert H.main_text(data) == "\n\n".join([LONG.strip(), LONG.strip(), "a", "b"])


def test_reader_responses_go():
    replies = "".join(f"<p>I liked this one, reader {k}.</p>" for k in range(3))
    assert H.main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div class='responses'>{replies}</div></body>") == "\n\n".join([LONG.strip()] * 2)


def test_broken_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p></p>") == ""
    assert H.main_text("<head><title>t<body><p>only text") in ("", "only text")
    assert H.main_text("plain text") == "plain text"
    assert H.main_text("</div></p><article><p>a</article>") == "a"
    assert H.main_text("<head><meta><body><p>open head") == "open head"
    assert len(H.main_text("<article>" + "<p>word word" * 20000)) > 200000


def test_every_row_has_a_result(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "u", ""), (3, "u", "<p>x")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    found = [tuple(r) for r in H.extract(pages).collect()]
    assert sorted(found, key=repr) == sorted(((i, u, H.main_text(h), len(H.main_text(h))) for i, u, h in rows), key=repr)
    assert H.extract(pages.limit(0)).collect() == []
    assert frames.rows_of(H.extract(pages))[0][3] >= 0
