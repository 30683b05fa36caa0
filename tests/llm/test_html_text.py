from wardline.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="page-12"><header><h1>Site</h1><nav><ul><li><a href=/a>menu</a></ul></nav></header><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p><b>Bold  text<br><p>Second\n para&nbsp;&eacute; <a href=x>link</a>.</p><aside>see also</aside>
<!-- <p>comment</p> --><div class="ad">buy</div><form><p>mail</p></form><blockquote>quoted</blockquote><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>
<div id="comments"><p>first!</p></div><footer>&copy; host</footer>"""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1) for r in rows], "page_id long, url string, html string, host string, path string, votes long")


def test_article_without_boilerplate(spark):
    got = H.extract(pages(spark, [(1, "https://h.example/1", PAGE)])).first()
    assert got.text == "Title & more\nBold text\nSecond para é link.\nquoted\none\ntwo\nc1\nc2"
    assert got.n_chars == len(got.text) and got.path == "html/body.page/article"


def test_host_consensus_beats_a_page_that_misleads(spark):
    def page(main, other):
        return f"<body><div class='story-{len(main)}'><p>{main}</p></div><div class=box><p>{other}</p></div></body>"

    rows = [(i, "http://a.example/x", page("long words of the story " * 20, "short")) for i in range(5)]
    rows += [(9, "http://a.example/y", page("brief story", "a very long box of other things " * 9)), (10, "http://b.example/", page("brief", "a very long box of other things " * 9))]
    got = {r.page_id: r for r in H.extract(pages(spark, rows)).collect()}
    assert got[9].text == "brief story" and got[0].path == "body/div.story"
    assert got[10].text.startswith("a very long box")


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "not a url", ""), (3, "http://x.example/", "bare text &lt;b&gt;"), (None, "http://[bad", "<p>no id</p>"), (4, "http://x.example/", "</div></p><p>a<"),
            (5, "http://x.example/", "<script>never closed"), (6, "http://x.example/", "<p>" + "long words " * 200_000), (7, "http://y.example/", "<nav><a>menu</a></nav>"),
            (8, "http://z.example/", "<p>twice</p>"), (8, "http://z.example/", "<p>twice</p>")]
    got = [(r.page_id, r.text) for r in H.extract(pages(spark, rows)).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert (by[1], by[2], by[3], by[None], by[5], by[7], by[8]) == ("", "", "bare text <b>", "no id", "", "", "twice")
    assert len(by[6]) == 200_000 * 11 - 1
    assert H.extract(pages(spark, rows).limit(0)).count() == 0


def test_given_pages(spark):
    """On the given pages the text is that of the article's title and paragraphs."""
    import re
    from html import unescape

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(rows).collect()}
    for r in rows.collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        want = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert got[r.page_id] == "\n".join(b for b in want if b)


def test_layout_without_an_article_element(spark):
    page = """<html><body><div id="header" class="site-header"><h1>Site</h1><p>tagline</p></div><div class="alert alert-info"><p>We moved.</p></div>
<main><section class="entry"><div class="post-header"><h1>T</h1></div><p>First words.</p><div class="newsletter-signup"><p>join</p></div>
<p>Second <i>words</i> &#8212; more.</p></section></main><section id="comments-area"><p>a comment that is longer than the whole article of this page</p></section></body></html>"""
    assert H.extract(pages(spark, [(1, "http://h.example/", page)])).first().text == "T\nFirst words.\nSecond words — more."


def test_values_are_no_attributes_and_telling_classes_no_boilerplate(spark):
    words = "words of the article that stay " * 5
    marks = ['style="overflow:hidden"', 'title="The hidden valley"', 'data-id="comment-5"', 'class="content has-sidebar"', 'class="no-sidebar"',
             "class='page with-sidebar'", "data-x='id=sidebar' class=text", "href=/a?class=ad&id=menu", 'id="text" id="sidebar"']
    gone = ['class="sidebar"', "id=comments-area", "hidden", 'aria-hidden="true"', "class='x cookie-notice'", 'ROLE="navigation"']
    rows = [(i, None, f"<body><div {m}><p>{words}</p></div></body>") for i, m in enumerate(marks)]
    rows += [(100 + i, None, f"<body><div {m}><p>{words}</p></div><div><p>else</p></div></body>") for i, m in enumerate(gone)]
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert [got[i] for i in range(len(marks))] == [words.strip()] * len(marks)
    assert [got[100 + i] for i in range(len(gone))] == ["else"] * len(gone)


def test_winner_is_widened_to_what_lies_around_it(spark):
    body = "words of the entry " * 55
    page = f"""<html><body><div class=wrap><div class=links><p><a href=/1>other things</a> <a href=/2>more other things</a></p></div>
<div class=post><h1>A title of 20 letters</h1><div class=entry><p>{body}</p></div></div></div></body></html>"""
    want = f"A title of 20 letters\n{body.strip()}"
    got = H.extract(pages(spark, [(1, "http://h.example/1", page), (2, "http://h.example/2", page), (3, None, page)])).collect()
    assert [r.text for r in got] == [want] * 3
    assert {r.path for r in got} == {"html/body/div.wrap/div.post"}


def text_of(page):
    found = H.blocks(page)
    path = H._best(H.containers(found))
    return H.main_text(found, path and H.widened(path, H.amounts(found)))


def test_formulas_and_forms_that_are_layout():
    assert text_of("<body><article><p>a <math><mi>x</mi><mo>=</mo></math> b <svg viewBox='0'><text>c</text></svg></p></article></body>") == "a x= b c"
    assert text_of("<body><form id=page><nav><a>menu</a></nav><div><p>the words of the page</p></div></form></body>") == "the words of the page"
    assert text_of("<body><form><p>name</p><input></form></body>") == ""
    assert text_of("<body><article><p>text</p><form><p>mail</p></form></article></body>") == "text"
    related = "<body><article><p>some longer text here</p><div class=related><p>{}</p></div></article></body>"
    assert text_of(related.format("a true paragraph")) == "some longer text here\na true paragraph"
    assert text_of(related.format("<a href=x>other things</a>")) == "some longer text here"


def test_deep_and_broken_pages_take_time_in_proportion():
    import time

    begin = time.monotonic()
    deep = "".join(f"<div class='a b'><p>w{i}" for i in range(20_000))
    assert text_of(f"<body>{deep}").split("\n") == [f"w{i}" for i in range(20_000)]
    assert text_of("<body>" + "<div>" * 60_000 + "x" + "</div>" * 60_000) == "x"
    for piece in ('<a "', '<a b="', "<!", "<a b='>", "<!--", "</", "<a ="):
        text_of("<p>text</p>" + piece * 100_000)
    assert time.monotonic() - begin < 30
