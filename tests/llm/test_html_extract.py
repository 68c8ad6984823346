from taxaspark.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="top"><a href="/">Home</a></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this now, please, today.</div>
<div class="cookie-notice">We use cookies.</div><aside>side</aside><article><h1>Title &amp; more</h1><p><b>First   line.<br><p>Second
line, with&nbsp;spaces &#233;.</p><ul><li>one</li><li>two</li></ul><div class="comments"><p>Nice post!</p></div></article>
<form><input><label>Mail</label></form><footer>&copy; foot</footer></body></html>"""


def test_article_without_boilerplate():
    assert H.main_text(PAGE) == "Title & more\nFirst line.\nSecond line, with spaces é.\none\ntwo"


def test_wrappers_and_nested_articles():
    p = """<body class="has-sidebar"><div class="page header-fixed has-sidebar"><main><article class="post"><header class="entry-header"><h1 class="header">Title</h1>
    <p class="byline">by X</p></header><p>Body text.</p><div class="notice">Note!</div><section id="comments"><article><p>I disagree.</p></article></section></article></main>
    <div class="sidebar"><p>More to read, friends.</p></div></div><div id="footer">foot</div></body>"""
    assert H.main_text(p) == "Title\nBody text."
    q = """<body><div id="header">Site</div><div class="menu"><a>One</a> <a>Two</a></div><div class="content"><h1>Head</h1><p>Some text, with marks.</p><p>Be.</p></div>
    <div class="widget">w</div><div class="footer">f</div></body>"""
    assert H.main_text(q) == "Head\nSome text, with marks.\nBe."


def test_page_without_article_takes_the_dense_container():
    p = "<html><body><div id=x><a href=1>a</a></div><div id=main2><p>" + "A long sentence, with commas, and dots. " * 5 + "</p><p>Another one, also long, with marks, yes. " * 3 + "</p></div><div id=y><a>b</a></div></body></html>"
    text = H.main_text(p)
    assert text.startswith("A long sentence") and "Another one" in text and "\nb" not in text


def test_broken_and_empty_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<html></html>") == ""
    assert H.main_text("<article><p>cut of") == "cut of"
    assert H.main_text("<article><p>a &am</p><p>b < c</p></ar") == "a &am\nb < c"
    assert H.main_text("<article><p>x</p><!-- open <p>y</p>") == "x"
    assert H.main_text("plain text only") == "plain text only"
    long = "<article>" + "<p>word, word.</p>" * 20_000 + "</article>"
    assert H.main_text(long).count("\n") == 19_999


def test_path_scores_favour_punctuated_text():
    found = [(("body", "p"), False, "Some text, with marks. And more."), (("body", "ul", "li"), False, "link"), (("body", "ul", "li"), False, "link")]
    s = H.path_scores(found, 0.3)
    assert s["body", "p"] > s["body", "ul", "li"]


def test_query_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 9), (1, "u", PAGE, 9), (None, None, None, 9)], "page_id long, url string, html string, text int")
    out = H.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"] > 0) for r in out) == [(0, False), (1, True), (1, True)]
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert H.extract(df.limit(0)).count() == 0


STORY = "".join(f"<p>The {w} sentence of the story is long, has commas, and ends here. It goes on, as stories do, for a while.</p>" for w in ("first", "second", "third"))


def test_story_in_a_plain_element_outvotes_teaser_articles():
    cards = "".join(f'<article class="card"><h2>Card {i}</h2><p>Read more about it.</p></article>' for i in range(4))
    for page in (f'<body><div class="story"><h1>Head</h1>{STORY}</div>{cards}</body>', f'<body>{cards}<div><div class="story"><h1>Head</h1>{STORY}</div></div></body>', f'<body><div class="wrap"><div class="story"><h1>Head</h1>{STORY}</div>{cards}</div></body>'):
        text = H.main_text(page)
        assert text.count("sentence of the story") == 3 and "Card" not in text and "Read more" not in text


def test_slugs_of_headings_are_content_and_furniture_is_not():
    for slug in ("related-work", "social-impact", "share-capital"):
        page = f'<article><h1>Head</h1>{STORY}<section id="{slug}"><h2>Slug</h2>{STORY}<ul><li>short</li></ul></section><div class="related-posts"><a href="/x">Other story</a></div></article>'
        text = H.main_text(page)
        assert text.count("sentence of the story") == 6 and "Slug\n" in text and text.endswith("\nshort")
    page = f'<article>{STORY}<div id="comments">{STORY}</div><div class="share-buttons"><a>Post</a></div></article>'
    assert H.main_text(page).count("sentence of the story") == 3


def test_without_article_wrapper_names_do_not_empty_the_page():
    page = f'<body><div class="page has-sidebar"><div class="content"><h1>Head</h1>{STORY}</div><div class="sidebar"><p>Side text.</p></div></div><div>Imprint</div></body>'
    text = H.main_text(page)
    assert text.count("sentence of the story") == 3 and "Side text" not in text and "Imprint" not in text
    form = f'<body><form id="aspnetForm"><div>{STORY}</div></form></body>'
    assert H.main_text(form).count("sentence of the story") == 3
    assert H.main_text('<div class="notice"><p>All there is.</p></div>') == "All there is."


def test_what_readers_and_sites_add_never_outvotes_a_short_article():
    head = "<h1>Head</h1><p>The story is short.</p><p>It ends, here.</p>"
    long = "<p>" + "This text is long, has commas, and goes on. " * 20 + "</p>"
    for page in (
        f"<article>{head}</article><section id='comments'>{long}</section>",
        f"<article>{head}<div class='comments'>{long}</div></article>",
        f"<div class='story'>{head}</div><div class='comments'>{long}</div>",
        f"<article>{head}<aside>{long}</aside><form>{long}</form></article>",
        f"<div class='cookie-consent'>{long}</div><article>{head}</article>",
        f"<article>{head}<div class='user-reviews'><h3>Reader comments</h3>{long}</div></article>",
        f"<article>{head}<section class='x'><h2>Reader comments</h2>{long}</section></article>",
        f"<body><div class='cookie-consent'>{long}</div><div>{head}</div></body>",
    ):
        assert H.main_text(page) == "Head\nThe story is short.\nIt ends, here."


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(n):
        began = time.process_time()
        assert len(H.main_text("<div>x" * n)) == 2 * n - 1
        return time.process_time() - began

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.01)


def test_path_scores_equal_a_plain_sum():
    import math

    found = [("a", None, "One, two."), ("b", None, "x"), ("a", None, "Three; four!"), ("c", None, "long text without marks", 4), ("d", None, "y.")]
    paths = ["a", "b", "c", "d"]
    length = {p: sum(len(t) - sum(rest) for q, _, t, *rest in found if q == p) / sum(q == p for q, *_ in found) for p in paths}
    marks = {p: sum(sum(c in ".,;!" for c in t) for q, _, t, *_ in found if q == p) / sum(q == p for q, *_ in found) for p in paths}
    for sigma in (0.1, 1.0):
        weight = lambda d: math.exp(-d * d / (2 * sigma**2)) if abs(d) <= max(1, math.ceil(3 * sigma)) else 0.0  # noqa: E731, B023
        smooth = lambda x, i: sum(weight(i - j) * x[q] for j, q in enumerate(paths)) / sum(weight(i - j) for j in range(4))  # noqa: E731, B023
        for i, p in enumerate(paths):
            assert abs(H.path_scores(found, sigma)[p] - smooth(length, i) * (1 + smooth(marks, i))) < 1e-9
