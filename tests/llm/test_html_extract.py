import html
import re

from signalmine.llm.html_extract import Page, extracted

SCHEMA = "page_id long, url string, html string, host string, path string"


def text(source):
    page = Page(source)
    return page.text(page.best())


def test_boilerplate_goes():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/x">menu</a></ul></nav>
    <div class="cookie-notice">we use cookies</div><div id="sidebar"><p>side</p></div>
    <div class="wrap with-sidebar"><article class="post"><header><h1>Title &amp; more</h1><p>by me</p></header>
    <p>One  <b>bold</b>ly&nbsp;two<br>three<p>Four<ul><li>a<li>b</ul><!-- no --><aside>box</aside>
    <div class="ad">buy</div><form><input value=1>send</form><table><tr><td>c<td>d</table><footer>tags</footer></article></div>
    <section class="comments"><article class="comment"><p>I disagree with a comment that is very long indeed, longer than
    the article, and so on and so on and so on and so on.</p></article></section><footer>&copy; 2020</footer></body></html>"""
    assert text(page) == "Title & more One boldly two three Four a b c d"


def test_other_templates():
    assert text("<body><div id=top>x</div><div class=main-text><p>aaaa aaaa aaaa aaaa</p><p>bbbb bbbb</p></div></body>") \
        == "aaaa aaaa aaaa aaaa bbbb bbbb"
    assert text("<main><h2>H</h2><p>x &lt;b&gt; 1 < 2 &#233;</p></main><div>tail</div>") == "H x <b> 1 < 2 é"
    assert text("just text") == "just text"
    assert text("") == ""
    assert text("<p>unclosed <b>bold <i>both</p><p>next") == "unclosed bold both next"
    assert text('<p title="a>b" class=\'x\'>q</p><p title="open>r</p>') in ("q", "q r", 'q r</p>')
    assert text("<script>never closed <p>x</p>") == ""
    assert text("<article><p>" + "word " * 300_000 + "</p></article>") == ("word " * 300_000).strip()


def plain(source):
    """Of the tables' own template: what the article element holds."""
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", inner).replace("<b>", "")).split())


def test_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    got = extracted(pages).collect()
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_consensus_and_edges(spark):
    def page(body):
        return f"<body><div class=head3>{'link ' * 30}</div><div class='col-{len(body)} x'>{body}</div></body>"

    good = [(i, "https://h.example/a", page("<p>" + "body " * 40 + "</p>"), "", "") for i in range(9)]
    odd = [(20, "https://u@h.example:80/b", page("<p>" + "body " * 25 + "</p>"), "", ""),
           (21, None, None, "", ""), (22, "nonsense", "", "", ""), (23, "https://h.example/c", "<p>no such path</p>", "", ""),
           (24, "https://h.example/c", "<p>no such path</p>", "", ""), (24, "https://h.example/c", "<p>no such path</p>", "", "")]
    got = [(r.page_id, r.text) for r in extracted(spark.createDataFrame(good + odd, SCHEMA)).collect()]
    want = [(i, ("body " * 40).strip()) for i in range(9)] + [(20, ("body " * 25).strip()), (21, ""), (22, ""),
            (23, "no such path"), (24, "no such path"), (24, "no such path")]
    if ("link" in dict(got)[0]):  # nothing says that the links aren't text: the whole body is the container
        want = [(i, t if i > 20 else ("link " * 30 + t)) for i, t in want]
    assert sorted(got) == sorted(want)
    assert extracted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_container():
    lead, body = "<h1>Heading</h1><p class=lead>The lead.</p>", "<p>" + "body " * 60 + "</p>"
    said = "Heading The lead. " + ("body " * 60).strip()
    side = "<nav><a href=/>home</a></nav><footer>© site</footer>"
    for page in (f"<div class=post>{lead}<div class=body>{body}</div></div>", f"{lead}<div class=body>{body}</div>",
                 f"<div class=page><main>{lead}<article>{body}</article></main></div>",
                 f"<div class=post>{lead}<article>{body}</article></div>",
                 f"<div class=post><span>Heading</span><p>The lead.</p><div class=body>{body}</div></div>",
                 f"<div class=post><span>Heading</span> <div>The lead.</div><div class=body>{body}</div></div>"):
        assert text(f"<body>{page}{side}</body>") == said, page
    halves = "{0}one one one{1}{0}two two{1}<div class=ad>buy</div>{0}three{1}"
    for begin, end in (("<article><p>", "</p></article>"), ("<div class=body><p>", "</p></div>"), ("<div class=body><h2>", "</h2></div>")):
        assert text("<body>" + halves.format(begin, end) + side + "</body>") == "one one one two two three"


def test_odd_pages_of_a_host(spark):
    usual = "<body><div class=post><div class=body><p>" + "usual " * 20 + "</p></div></div></body>"
    odd = "<body><div class=post><h1>Head</h1><div class=body><p>" + "part " * 20 + "</p></div><p>" + "rest " * 30 + "</p></div></body>"
    split = "<body><div class=post><div class=body><p>first</p></div><div class=body><p>second half</p></div></div></body>"
    rows = [(i, "http://h.example/", usual, "", "") for i in range(5)] + [
        (5, "http://h.example/", odd, "", ""), (6, "http://h.example/", split, "", "")]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**{i: ("usual " * 20).strip() for i in range(5)}, 6: "first second half",
                   5: "Head " + "part " * 20 + ("rest " * 30).strip()}
    page = Page(split)
    assert len(page.at(page.nodes[-2].path)) == 2 and page.text(*page.chosen(page.nodes[-2].path)) == "first second half"


def test_votes_drop_the_frame_of_a_host(spark):
    notice = "Our office is open on Monday to Friday from nine to five, and closed on all public holidays of the year."
    words = ["ant", "bee", "cat", "dog", "elk"]

    def page(i, head="", tail=f"<div class=box><p>{notice}</p></div>"):
        body = "".join(f"<p>{(w + ' ') * 30}{i}</p>" for w in words[:1 + i % 3])
        return f"<body><div class=wrap>{head}<div class=content>{body}</div>{tail}</div></body>"

    def body(i):
        return " ".join(f"{(w + ' ') * 30}{i}" for w in words[:1 + i % 3])

    rows = [(i, "http://h.example/", page(i), "", "") for i in range(6)] + [
        (6, "http://h.example/", page(6, f"<h1>Head six</h1><p>{'lead ' * 20}</p>"), "", ""),
        (7, "http://h.example/", f"<body><div class=wrap><p>other page</p><p>{notice}</p></div></body>", "", ""),
        # a host of one article in many copies: what repeats is the article's
        *((10 + i, "http://copies.example/", page(1, "<h1>Head</h1>"), "", "") for i in range(5)),
        # two pages are no host's habit
        *((20 + i, "http://two.example/", page(i), "", "") for i in range(2))]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = {r.page_id: r.text for r in extracted(pages).collect()}
    assert got == {**{i: body(i) for i in range(6)}, 6: f"Head six {('lead ' * 20).strip()} {body(6)}", 7: f"other page {notice}",
                   **{10 + i: f"Head {body(1)} {notice}" for i in range(5)},
                   **{20 + i: f"{body(i)} {notice}" for i in range(2)}}
    # without the votes the notice stays
    assert all(text(h).endswith(notice) for _, _, h, _, _ in rows)


def test_core_is_the_container_of_most_text():
    long = "<p>" + "word " * 60 + "</p>"
    for inner, path in ((f"<div class=a><h1>T</h1><div class=b>{long}{long}</div></div>", "div.b"),
                        (f"<div class=a>{long}{long}<div class=b>{long}</div></div>", "div.a"),
                        (f"<div class=a><section>{long}</section><section>{long}</section></div>", "section"),
                        (f"<div class=a><div class=links><a href=x>{'link ' * 200}</a></div>{long}</div>", "div.a")):
        assert Page(f"<body>{inner}</body>").core().path.split("/")[-1] == path, inner
    assert Page("").core() is not None and Page("<p>").core() is not None


def test_a_lead_in_the_header_of_an_article():
    lead = "What the article is about is said at some length, " * 4
    page = f"<body><article><header><h1>Title</h1><p class=by>by me</p><p class=lead>{lead}<b>boldly</b></p></header><p>body</p></article></body>"
    assert text(page) == f"Title {lead}boldly body"
    assert text(page.replace("<article>", "<div>").replace("</article>", "</div>")) == "body"  # the page's header


def test_marks_by_what_they_hold():
    paragraphs = "<p>" + "one " * 40 + "</p><p>" + "two " * 40 + "</p>"
    said = " ".join((("one " * 40) + ("two " * 40)).split())
    side = "<nav><a href=/>home</a></nav><div class=sidebar><p>side text</p></div><footer>© site</footer>"
    for name in ("content with-sidebar", "has-comments", "layout--no-sidebar", "post category-notice tag-social", "comments-open",
                 "elementor-widget elementor-widget-text-editor", "sidebar-left content", "content-widget", "socialPage"):
        for page in (f"<div class='{name}'><h1>Title</h1>{paragraphs}</div>", f"<div id='{name.split()[0]}'><h1>Title</h1>{paragraphs}</div>"):
            assert text(f"<body>{page}{side}</body>") == "Title " + said, page
    for name in ("post tag-social", "post promo", "has-sidebar related"):
        assert text(f"<body><article class='{name}'><h1>Title</h1>{paragraphs}</article>{side}</body>") == "Title " + said
    parts = "".join(f"<div class='{{0}} n-{i}'><p>{w * 20}</p></div>" for i, w in enumerate(("one ", "one ", "two ", "two ")))
    for name in ("elementor-widget", "block-widget", "promo"):
        for page in ("<article>{}</article>", "<div class=post>{}</div>"):
            assert text("<body>" + page.format(parts.format(name)) + side.replace("sidebar", "banner") + "</body>") == said, (name, page)
    assert text("<body><div class=widget>" + parts.format("widget-row") + f"</div>{side}</body>") == said
    assert text(f"<body><noscript><div>{paragraphs}</div></noscript>{side}</body>") == said
    assert text(f"<body><form action=x><div class=post>{paragraphs}</div></form>{side}</body>") == said


def test_still_left_out():
    article = "<p>" + "one " * 40 + "</p>"
    said = ("one " * 40).strip()
    for out in ("<div class=comments><p>{}</p></div>", "<div id=cookie-notice><p>{}</p></div>", "<aside><p>{}</p></aside>",
                "<div class=sidebar style='display:none'><p>{}</p></div>", "<div class='comment tag-x'><p>{}</p></div>"):
        assert text(f"<body><div class=post>{article}</div>{out.format('other ' * 60)}</body>") == said, out
    for out in ("<div class=sidebar><p>{}</p></div>", "<form><p>{}</p></form>"):
        assert text(f"<body><div class=post>{article}</div>{out.format('other ' * 20)}</body>") == said, out
        assert text(f"<body><article>{article}</article>{out.format('other ' * 90)}</body>") == said, out


def test_math_object_noscript():
    page = "<body><noscript>switch on scripts</noscript>{}<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math></p>" \
        "<object data=a><param name=b><p>what the film shows</p></object><noscript><p>the plain form</p></noscript>{}</body>"
    for begin, end in (("<article>", "</article>"), ("<div class=post>", "</div>")):
        assert text(page.format(begin, end)) == "so x=1 what the film shows the plain form"
