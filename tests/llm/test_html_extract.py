import random

from lodestack.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li>B</li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><article class="post"><h1>Title &amp; more</h1><p>First<b>bold</b> &eacute;<br>line.<p>Second
  p&#97;ra <form><input>Search</form><span class="ad">Buy</span> end<div id="comments"><p>Reader says</p></div></article>
<aside>Side</aside><div class="sidebar">Bar</div><footer>&copy; foot</footer></body></html>"""


def test_article_alone():
    assert H.main_text(PAGE) == "Title & more Firstbold é line. Second para end"


def test_odd_input():
    assert [H.main_text(x) for x in (None, "", "   ", "<", "<p", "<script>x", "<!--", "</p></div>")] == ["", "", "", "<", "", "", "", ""]
    assert H.main_text("plain text &lt; <b>x</b>") == "plain text < x"
    assert H.main_text("<article><p>cut off &am") == "cut off &am"
    assert H.main_text("<p title='a>b'>x</p><p title=\"unclosed>y") == "x y"
    assert H.main_text("<article>" + "<div>" * 300 + "deep") == "deep"


def page(n, body):
    return f'<html><body><div class="top"><a href="/">Start</a><span>Our paper</span></div><div class="c{n}"><div class="story">{body}</div></div><div class="low">All rights reserved</div></body></html>'


def bodies(k):
    return "".join(f"<p>Paragraph {k} {j} of the story with its own words {k * j}.</p>" for j in range(1, 3 + k))


def test_wrapper_finds_the_story_and_the_template():
    pages = [page(k, bodies(k)) for k in range(1, 5)]
    wrapper = H.infer(pages)
    assert "(<p>#</p>)+" in H.expression(wrapper) and "All rights reserved" in H.expression(wrapper)
    own = H.summary(wrapper, len(pages))
    assert H.main_text(pages[0], own) == " ".join(f"Paragraph 1 {j} of the story with its own words {j}." for j in range(1, 4))
    assert H.main_text("<p>Another form</p><p>All rights reserved</p>", own) == "Another form"


def test_optional_groups():
    wrapper = H.infer(["<div><h2>a</h2><p>x</p></div>", "<div><p>y</p></div>"])
    assert H.expression(wrapper) == "<div>(<h2>a</h2>)?<p>#</p></div>"


def marked_page(k):
    """A teaser in an article of its own, the story without one, or in one with a box whose class says nothing."""
    return f'<body><div class="x1"><article><h3>Teaser</h3></article></div><div class="story">{bodies(k)}</div></body>'


def boxed_page(k):
    box = '<div class="q7">Get the weekly letter</div>' if k != 2 else ""
    return f"<body><article><h1>Story {k}</h1>{bodies(k)}{box}</article></body>"


def test_wrapper_decides_on_marked_pages():
    story = " ".join(f"Paragraph 4 {j} of the story with its own words {4 * j}." for j in range(1, 7))
    own = H.summary(H.infer([marked_page(k) for k in range(1, 5)]), 4)
    assert H.main_text(marked_page(4), own) == story and H.main_text(marked_page(4)) == "Teaser"
    own = H.summary(H.infer([boxed_page(k) for k in range(1, 5)]), 4)
    assert H.main_text(boxed_page(4), own) == f"Story 4 {story}"


def test_all_pages_are_learned_from(spark):
    """A layout on 4 of 44 pages, a notice on 3 of them, and hosts that hold only copies, or two pages and copies."""
    tale = lambda k: f'<body><div class="bar">Bar {k} of the day</div><div class="tale">{bodies(k)}{"<h4>Closed today</h4>" if k > 1 else ""}</div></body>'
    rows = [(k, f"http://h.org/{k}", page(1, bodies(k))) for k in range(10, 50)] + [(k, f"http://h.org/{k}", tale(k)) for k in range(1, 5)]
    alone = "<body><h1>Only title</h1><div><p>Only words.</p></div></body>"
    rows += [(100 + k, f"http://copies.org/{k}", alone) for k in range(9)]
    rows += [(200 + k, f"http://two.org/{k}", alone if k % 2 else alone.replace("words", "letters")) for k in range(8)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    story = lambda k: " ".join(f"Paragraph {k} {j} of the story with its own words {k * j}." for j in range(1, 3 + k))
    assert all(got[k] == story(k) for k in (*range(1, 5), *range(10, 50)))
    assert all(got[k] == "Only title Only words." for k in (*range(100, 109), *range(201, 208, 2))) and got[200] == "Only title Only letters."


def test_table(spark):
    rows = [(k, f"http://h{k % 2}.org/{k}", page(k, bodies(k))) for k in range(8)] + [(100, None, PAGE), (101, "x", None), (102, "http://h0.org/", ""), (None, "http://z.org", PAGE), (100, None, PAGE)]
    df = spark.createDataFrame([(*r, "e", "e") for r in rows], "page_id long, url string, html string, host string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(df).collect()), key=repr)
    assert [(a, b) for a, b, _, _ in got] == sorted(((r[0], r[1]) for r in rows), key=repr)
    texts = {(a, b): t for a, b, t, _ in got}
    assert texts[None, "http://z.org"] == texts[100, None] == H.main_text(PAGE) and texts[101, "x"] == texts[102, "http://h0.org/"] == ""
    assert all("rights" not in t and t.startswith("Paragraph") for (a, _), t in texts.items() if a is not None and a < 8)
    assert all(n == len(t) for _, _, t, n in got)
    assert H.extract(df.limit(0)).count() == 0


def test_article_sections_and_long_attributes_stay():
    page = '<article><section id="discussion"><p>Alpha.</p></section><section id="related-work"><p>Beta.</p></section><div class="cookie-notice" data-x="%s">Cookies.</div><p data-y="%s>">Gamma.</p></article>'
    assert H.main_text(page % ("x" * 5000, "y" * 5000)) == "Alpha. Beta. Gamma."


def test_deep_and_long_pages():
    deep = "<article>" + "<div>" * 20_000 + "<nav>menu</nav>deep" + "</div>" * 20_000 + "<p>after</p></article><footer>end</footer>"
    assert H.main_text(deep) == "deep after"
    long = "<article>" + "".join(f"<p>t{k}</p><h2>h{k}</h2>" for k in range(50_000)) + "</article>"
    assert len(H.main_text(long).split()) == 100_000
    other = "<article>" + "".join(f"<h2>x{k}</h2><p>y{k}</p><p>z</p>" for k in range(20_000)) + "</article>"
    H.summary(H.infer([deep, long, other, long.replace("t1", "u1")]), 4)


def test_alignment_finds_common_subsequences():
    rng = random.Random(1)
    for exact in (1 << 14, 0):
        H.EXACT, kept = exact, H.EXACT
        for _ in range(200):
            a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
            pairs = H._pairs(a, b)
            assert all(a[i] == b[j] for i, j in pairs) and all(x < z and y < w for (x, y), (z, w) in zip(pairs, pairs[1:]))
        H.EXACT = kept
