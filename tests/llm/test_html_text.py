import html
import re

import numpy as np

from medallion.llm import html_text as H
from medallion.llm.queries import op5_html_text

from .conftest import SF

TREE = H.default_tree()


def text(body):
    return H.main_text(body, TREE)


def test_tree_fits_its_table():
    table = np.array(H.LABELLED, float)
    assert np.mean([H.keeps(TREE, tuple(r[:-1])) == bool(r[-1]) for r in table]) >= 0.97


def test_best_split_by_hand():
    x, y = np.array([[1.0, 5], [2, 5], [3, 1], [4, 1]]), np.array([0.0, 0, 0, 1])
    tree = H.grow(x, y, least=1)
    assert (tree.at, tree.limit) == (0, 3.5) and [H.keeps(tree, tuple(r)) for r in x] == [False, False, False, True]


def test_page_furniture_goes():
    page = """<!DOCTYPE html><html class="has-sidebar"><head><title>T</title><style>p{a:b}</style></head><body>
      <header><a href="/">Home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
      <div class="cookie-notice">We use cookies on this page and you have to agree to all of them.</div>
      <article><h1>Head &amp; line</h1><p>First   paragraph,
      with <b>bold</b>ed words and <a href=x>a link</a>.<p>Yes.<!-- no --><script>var a = "</p><p>x";</script>
      <div class=ad>Buy this thing today and save a lot of money.</div><p>Last &lt;one&gt;&nbsp;here.</article>
      <aside><p>Something else that is also written in long sentences but beside the text.</aside>
      <section id="comments"><p>I liked this very much and will read it once more tomorrow evening.</section>
      <form><label>Mail</label><textarea>write here</textarea><button>Send</button></form><footer>&copy; us</footer></body></html>"""
    assert text(page) == "Head & line First paragraph, with bolded words and a link. Yes. Last <one> here."


def test_page_without_article():
    page = """<body><div id=menu><a href=1>A</a> <a href=2>B</a></div><div><h1>A title</h1><p>""" + "Plain words that go on for a while. " * 4 + \
        """</p><p>Short.</p><p>""" + "And more of them in a second one here. " * 4 + """</p></div><div class=footer>Copyright</div>"""
    assert text(page).startswith("A title Plain words") and text(page).endswith("second one here.") and " Short. " in text(page)


SENTENCES = "<p>" + "</p><p>".join("Plain words that go on for a while in the %s of these paragraphs." % w for w in ("first", "second", "third")) + "</p>"
PLAIN_SENTENCES = " ".join(re.sub("<[^>]*>", " ", SENTENCES).split())


def test_wrappers_named_after_a_part_keep_the_text():
    around = "<nav><a href=1>One</a> <a href=2>Two</a></nav>%s<div class=footer>Copyright of us</div>"
    for wrapper in ("<div class='layout has-sidebar'>", "<div id='page' class='right-sidebar'>", "<div class='page-with-header'>", "<form id=aspnetForm>"):
        end = "</form>" if "form" in wrapper else "</div>"
        for inside in ("<article>%s</article>", "<main>%s</main>", "<div>%s</div>"):
            inside %= SENTENCES
            assert text(f"<body>{wrapper}{around % inside}{end}</body>") == PLAIN_SENTENCES, (wrapper, inside[:9])
        part = "<div class=sidebar><p>Something else that is written beside the text.</div>"
        assert text(f"<body>{wrapper}{around % (SENTENCES + part)}{end}</body>") == PLAIN_SENTENCES
        assert text(f"<body><main>{wrapper}{SENTENCES}{part}{end}</main></body>") == PLAIN_SENTENCES


def test_names_with_an_everyday_word_are_no_furniture():
    page = f"<body><div>{SENTENCES}</div><section id='market-share'><p>Their share of the market grew by a tenth in the last year.</section>%s</body>"
    kept = PLAIN_SENTENCES + " Their share of the market grew by a tenth in the last year."
    assert text(page % "") == kept
    assert text(page % "<div class='share-buttons'><p>Tell all of your friends about this page now.</div><div id=comments><p>I liked this.</div>") == kept


def test_unclosed_elements_that_are_no_raw_text():
    for name in ("video", "audio", "object", "svg", "canvas", "math", "select", "datalist", "template"):
        assert text(f"<article><p>before<{name} id=x><p>after</article>") == "before after", name
    assert text("<article><p>before<video>not shown</video> after<video><p>end</article>") == "before after end"
    assert text("<article><p>before<textarea><p>after</article>") == "before"


def test_broken_markup():
    assert text("<article><p>a < b and c > d <b>x<p>y</article>") == "a < b and c > d x y"
    assert text("<article><p>open <a href='x'>link<p>next one that is not closed") == "open link next one that is not closed"
    assert text("<article>text <!-- never closed <p>x") == "text"
    assert text("<script>never closed <p>x</p>") == ""
    assert text("just words and no markup at all") == "just words and no markup at all"
    assert text("") == text(None) == text("<p> \n </p>") == ""
    assert text('<article><p title="a > b">c &amp d &#233; &unknown;</article>') == "c & d é &unknown;"


def test_odd_rows(spark):
    long = "<article>" + "<p>some words in a paragraph</p>" * 5000 + "</article>"
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<article>null id</article>", "x"), (4, "u", long, None), (4, "u", long, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = H.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted((r["page_id"] or -1, r["n_chars"]) for r in got.collect())
    assert found == [(-1, 7), (1, 0), (2, 0), (4, 5000 * 26 - 1), (4, 5000 * 26 - 1)]
    assert H.extract(pages.limit(0)).count() == 0


def test_query_against_the_article_elements(spark):
    got = {r["page_id"]: r["text"] for r in op5_html_text(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        plain = html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside)))
        assert got[r["page_id"]] == " ".join(plain.split())


COMMENT = "A reader wrote this long comment because the matter seemed to need one more word. "


def test_articles_of_comments_and_teasers_go():
    main = f"<article>{SENTENCES}</article>"
    comment = f"<article class='comment'><p>{COMMENT}</article>"
    for beside in (f"<section class='comments'>{comment * 3}</section>", f"<div id=comments>{comment}<article><p>{COMMENT}</article></div>", comment * 2,
                   f"<aside class='related'><article><h2>Another story</h2><p>{COMMENT}</article></aside>", f"<aside><article><p>{COMMENT}</article></aside>",
                   f"<ol class='comment-list'><li><article>{COMMENT}</article></ol>", f"<article class='related-post'><p>{COMMENT}</article>"):
        assert text(f"<body>{main}{beside}</body>") == PLAIN_SENTENCES, beside
        assert text(f"<body>{beside}{main}</body>") == PLAIN_SENTENCES, beside
        assert text(f"<body><main>{SENTENCES}{beside}</main></body>") == PLAIN_SENTENCES, beside
        assert text(f"<body><div><h1>Title</h1>{SENTENCES}</div>{beside}</body>") == "Title " + PLAIN_SENTENCES, beside


def test_comments_and_asides_longer_than_the_text_go():
    for beside in (f"<div class='comments'>{('<p>' + COMMENT) * 40}</div>", f"<aside>{('<p>' + COMMENT) * 40}</aside>", f"<section id=disqus_thread><p>{COMMENT * 40}</section>"):
        for whole in (f"<article>{SENTENCES}</article>{beside}", f"<article>{SENTENCES}{beside}</article>", f"<div>{SENTENCES}</div>{beside}", f"{beside}<main>{SENTENCES}</main>"):
            assert text(f"<body>{whole}</body>") == PLAIN_SENTENCES, whole[:60]


def test_an_article_in_an_aside_alone_stays():
    assert text(f"<body><aside><article>{SENTENCES}</article></aside></body>") == PLAIN_SENTENCES
    assert text(f"<body><div class='right-sidebar'><aside><main>{SENTENCES}</main></aside></div></body>") == PLAIN_SENTENCES


def test_several_articles_without_a_name_stay():
    page = "".join(f"<article><h2>Part {w}</h2><p>{COMMENT}</article>" for w in ("one", "two", "three"))
    assert text(f"<body>{page}</body>") == " ".join(f"Part {w} {COMMENT.strip()}" for w in ("one", "two", "three"))


def test_lists_of_links_in_an_article_stay():
    for items in (["One", "Two", "Three"], ["First link", "Second one here", "Third"], ["A"], ["Some words of a link"] * 6):
        links = "".join(f"<li><a href=x>{i}</a></li>" for i in items)
        assert text(f"<body><article>{SENTENCES}<ul>{links}</ul><p>The end of it.</p></article></body>") == f"{PLAIN_SENTENCES} {' '.join(items)} The end of it."
        assert text(f"<body><nav><ul>{links}</ul></nav><article>{SENTENCES}</article><ul>{links}</ul></body>") == PLAIN_SENTENCES


def test_nested_wrappers():
    page = f"<body><div id=page class='right-sidebar'><form><div class='layout sidebar-left'><main><div class=content>{SENTENCES}</div>" \
           f"<div class=sidebar><p>Beside the text.</div></main></div></form></div></body>"
    assert text(page) == PLAIN_SENTENCES


def plain_tags(page):
    """The tags by one pattern (quadratic on bad markup)."""
    pattern = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>\"']*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
    return [(m.start(), m.end(), m[1] == "/", (m[2] or "").lower(), m[3] or "") for m in pattern.finditer(page)]


def test_tags_are_those_of_the_pattern():
    import random

    rng = random.Random(4)
    for _ in range(6000):
        page = "".join(rng.choices(["<", ">", "'", '"', "a", "/", " ", "<a ", "</p>", "<!--", "-->", "<!x", "<b x='", "=", "<p>", "é"], k=rng.randrange(0, 25)))
        got, at, tags = [], 0, H.Tags(page)
        while (tag := tags.after(at)) is not None:
            got.append(tag)
            at = tag[1]
        assert got == plain_tags(page), page


def test_bad_markup_takes_linear_time():
    import time

    kinds = ["<a x='", "<a x=\"'", "<div>", "<a", "<a ", "<!x", "<!--", "<", "</x>", "<p class='ad'>", "<span class=ad>x<br>", "<video>", "<li><a>", "'<b ", "<a x='>' y="]
    for kind in kinds:
        for tail in ("", ">", "'>", "</x>" * 16_000):
            began = time.perf_counter()
            H.main_text(kind * 16_000 + tail, TREE)
            assert time.perf_counter() - began < 1.5, (kind, tail[:4])
    began = time.perf_counter()
    assert len(H.main_text("<article>" + "<p>some words in a paragraph</p>" * 60_000 + "</article>", TREE)) == 60_000 * 26 - 1
    assert time.perf_counter() - began < 10
