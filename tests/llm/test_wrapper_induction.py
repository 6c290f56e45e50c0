import html
import random
import re

import pytest

from edgewatch.llm import wrapper_induction as wrap
from edgewatch.llm.html_tree import parse, tidy


def _reference(page):
    """The one article of a test page by hand: tags out, references decoded, spaces single."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    text = re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inner)
    return " ".join(html.unescape(text).split())


@pytest.mark.parametrize("bound", [wrap.BROADCAST_BYTES, 0])
def test_corpus_pages_equal_their_articles(spark, bound):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: _reference(r.html) for r in pages.collect()}
    rows = wrap.extract_text(pages.repartition(5), broadcast_bytes=bound).collect()
    assert {r.page_id: r.text for r in rows} == want


def _div_site(i, rng):
    words = lambda n: " ".join(rng.choices("alpha beta gamma delta epsilon zeta".split(), k=n))
    paragraphs = [f"Page {i} says {words(20)} &amp; more&nbsp;{j}" for j in range(rng.randrange(2, 6))]
    body = "".join(f"<p>{p} <b>bold</b>tail" + "</p>" * rng.randrange(2) for p in paragraphs)
    advert = f'<div class="ad-slot">buy {words(4)}</div>' * rng.randrange(2)
    page = (
        f'<html><head><title>t{i}</title><script>if (a<b) "<p>x</p>"</script></head><body class="has-sidebar">'
        f'<div id="top-header">Site {words(3)}</div><ul class="menu"><li><a href="/">Home</a><li>{words(2)}</ul>'
        f'<div class="wrap"><div class="story"><h1>Title {i}</h1>{body}{advert}'
        f'<p class="tool">Print this page</p><!-- note <p>hidden</p> --><ul><li>one {i}<li>two</ul></div>'
        f'<div class="sidebar">{words(60)}</div><div id="comments"><p>reader {words(30)}</p></div></div>'
        f'<form><input name=q>Search {words(2)}</form><div class="cookie-notice">We use cookies</div>'
        f"<footer>(c) {words(5)}</footer>"
    )
    text = f"Title {i} " + " ".join(html.unescape(p) + " boldtail" for p in paragraphs) + f" one {i} two"
    return page, " ".join(text.split())


def test_template_and_names_leave_the_story(spark):
    rng = random.Random(8)
    site = [_div_site(i, rng) for i in range(40)]
    rows = [(i, f"https://Div.example.com:80/{i}", page, "c") for i, (page, _) in enumerate(site)]
    got = wrap.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    found = {r.page_id: r.text for r in got.collect()}
    for i, (_, want) in enumerate(site):
        assert found[i] == want


def _texts(spark, pages):
    rows = [(i, f"http://one.example/{i}", page) for i, page in enumerate(pages)]
    got = wrap.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got)]


def test_page_in_one_form_keeps_its_text(spark):
    search = "<form role=search>Search this site</form>"
    story = [f"<h1>Title {i}</h1><p>story {i} of some words and more of them</p>" for i in range(12)]
    want = [f"Title {i} story {i} of some words and more of them" for i in range(12)]
    for start, end in (("<article>", "</article>"), ("<div class=text>", "</div>")):
        pages = [f"<body><form id=aspnet><nav>Home</nav>{start}{s}{end}{search}</form></body>" for s in story]
        assert _texts(spark, pages) == want
        pages = [f"<body>{start}<form role=form>{s}</form>{end}{search}</body>" for s in story]
        assert _texts(spark, pages) == want


def test_names_inside_the_content_need_the_template(spark):
    rng = random.Random(9)
    pages, want = [], []
    for i in range(12):
        a, b, c, d = (" ".join(rng.choices("alpha beta gamma delta epsilon zeta".split(), k=15)) for _ in range(4))
        pages.append(
            f'<body><nav>n</nav><article><h1>T{i}</h1><p>{a}</p><h2 id="social-history">Social {i}</h2><p>{b}</p>'
            f'<section id="related-work"><p>{c}</p></section><p id="advertising">{d}</p>'
            f'<pre>x = {i} <span class="comment"># note {i}</span></pre><div class="share">Share this {i % 2}</div>'
            f'<div id="newsletter">Get our letter</div></article><div class="comments">{a} {i}</div></body>'
        )
        want.append(f"T{i} {a} Social {i} {b} {c} {d} x = {i} # note {i}")
    assert _texts(spark, pages) == want
    assert _texts(spark, ['<div id="comments">all there is</div>']) == ["all there is"]


def test_copies_of_one_page_keep_their_text(spark):
    page = "<body><nav>n</nav><article><h1>Same</h1><p>all the same text</article></body>"
    rows = [(i, f"http://copies.net/{i}", page) for i in range(30)]
    got = wrap.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Same all the same text"} and len(got) == 30


def test_edges(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "no host", "plain &lt;text&gt; only"), (4, "http://x/", "<div>" * 20_000 + "deep"),
        (5, "http://x/", "<p>a" * 5_000), (6, "http://y/", "a < b <3 <unclosed"), (None, "http://y/", "</b></p><!-- open"),
        (8, "http://z/", "<noscript>kept text"), (8, "http://z/", "<noscript>kept text"), (9, "http://z/", "<script>x"),
        (10, "http://l/", "word " * 200_000), (11, "http://q/", "<a title='x>y'>in link</a>" + "<li>" * 300),
    ]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.url, r.text) for r in wrap.extract_text(docs.repartition(2)).collect()}
    assert got[1] == (None, "") and got[2] == ("", "") and got[3][1] == "plain <text> only"
    assert got[4][1] == "deep" and got[5][1] == "a " * 4_999 + "a" and got[8][1] == "kept text" and got[9][1] == ""
    assert got[6][1] == "a < b <3 <unclosed" and got[None][1] == "" and len(got[10][1]) == 999_999
    assert got[11][1] == "in link"
    assert wrap.extract_text(docs.limit(0)).count() == 0


def test_frequent_slots_outlive_any_number_of_rare_ones(monkeypatch):
    monkeypatch.setattr(wrap, "MAX_NODES", 100)
    rng = random.Random(10)

    def page(i):
        words = " ".join(rng.choices("alpha beta gamma delta".split(), k=20))
        rare = "".join(f'<p id="{"".join(rng.choices("abcdefgh", k=9))}">{i} {words}</p>' for _ in range(4))
        if i < 60:  # an older layout first
            return f'<body><div class="old">{rare}</div></body>', None
        notice = "<div class=hint>Always the same hint</div>"
        deep = "<div>" * 60
        return f'<body><div class="new">{rare}{deep}<h1>T{i}</h1>{notice}<p>{words}</p></div></body>', notice

    pages = [page(i)[0] for i in range(600)]
    halves = []
    for part in (pages[::2], pages[1::2]):
        room = [wrap.MAX_NODES]
        halves.append(wrap.Slot("root"))
        for p in part:
            wrap.add_page(halves[-1], parse(p), room)
    for order in (halves, halves[::-1]):
        total, room = wrap.Slot("root"), [wrap.MAX_NODES]
        for half in order:
            wrap.merge(total, wrap.Slot.load(half.dump()), room)
        wrap.settle(total)
        texts = [wrap.extract(parse(p), total, wrap.content_slot(total)) for p in pages]
        assert all(f"T{i}" in t and "hint" not in t for i, t in enumerate(texts) if i >= 60)
        assert all(len(t.split()) == 84 for t in texts[:60])
        size, stack = 0, [total]
        while stack:
            below = stack.pop().children
            size, stack = size + len(below), stack + below
        assert size < 1200  # of more than 2,400 labels


def test_alignment_matches_most_nodes():
    template = wrap.Slot("root")
    room = [wrap.MAX_NODES]
    for page in ("<h1>a</h1><div><p>x</div><ul><li>1</ul>", "<div><p>y<p>z</div><table></table><ul><li>2</ul>"):
        wrap.add_page(template, parse(page), room)
    assert [c.label for c in template.children] == ["h1", "div", "table", "ul"]
    assert [c.pages for c in template.children] == [1, 2, 1, 2]
    again = wrap.Slot.load(template.dump())
    wrap.merge(again, template, room)
    assert [c.pages for c in again.children] == [2, 4, 2, 4] and again.dump()[5][1][5][0][0] == "p"


def test_parser_closes_what_is_left_open():
    root = parse("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<b>y</p>z<table><tr><td>1<td>2<tr><td>3</table>t<br>u")
    assert tidy(root.raw()) == "a b c xy z 1 2 3 t u"
    rows = [n for n in root.nodes() if n.tag == "table"][0].nodes()
    assert [len(r.nodes()) for r in rows] == [2, 1]
