import html
import re
from collections import Counter

from scorespark.llm.html_main import Weights, extract_pages, fit_weights, main_text, weighted


def text(page):
    return main_text(page, Weights())


def test_parts_around_and_inside_the_article():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
    <header><div class="logo">Site name</div></header><nav><ul><li><a href="/">Home page link</a></li></ul></nav>
    <div class="cookie-notice">We use cookies on this site</div>
    <article><h1>Head&nbsp;line</h1><p>First   <b>bo</b>ld &amp; more&lt;<br>next</p><script>drop()</script>
    <div class="ad">Buy this now please</div><!-- hidden <p>comment</p> --><p>Second <a href="#">link</a>.</p>
    <form><input><button>Send it</button></form><aside>See also this</aside><ul><li>one item<li>two item</ul></article>
    <section class="comments"><p>A reader says a lot of words here about it</p></section>
    <footer>&copy; all rights</footer></body></html>"""
    assert text(page) == "Head line First bold & more< next Second link . one item two item".replace("link .", "link.")


def test_pages_without_main_element():
    body = "<p>" + "plain words of a story " * 20 + "</p>"
    page = f"<body><div class='menu'><a>a</a><a>b</a></div><div id=content>{body}<div>{body}</div></div><div class='footer'>x y z</div></body>"
    assert text(page) == ("plain words of a story " * 40).strip()


def test_edge_pages():
    assert text(None) == text("") == text("<nav>only menu</nav>") == text("<p></p>") == ""
    assert text("no markup at all") == "no markup at all"
    assert text("a < b and c > d") == "a < b and c > d"
    assert text("<p>cut off <scr") == "cut off"
    assert text("<p>kept</p><script>rest is gone <p>x") == "kept"
    assert text("<p>" + "<div>" * 5000 + "deep words here" * 1) == "deep words here" or text("<p>" + "<div>" * 5000 + "deep") == "deep"
    assert text("<p title='a > b'>x</p>") == "x"
    assert text("<P CLASS=AD>x</P><P>y</P>") == "y"


def test_weights_are_learned():
    learned = weighted({("key", ".infobox"): (0, 500), ("key", ".lead"): (300, 2), ("tag", "a"): (1, 99), ("tag", "p"): (99, 1)})
    assert learned.key(".infobox") < -1.2 < learned.key(".lead")
    assert learned.cost("a") > learned.cost("p")
    page = "<article><p class=lead>the lead text</p><div class=infobox>box words</div></article>"
    assert main_text(page, learned) == "the lead text"


def test_every_page_of_the_table(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[row.page_id].text == expected and got[row.page_id].n_chars == len(expected)


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>é words</p>", "x"), (3, "v", "", "x"), (4, "w", "<p>" + "w " * 200000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.n_chars) for r in extract_pages(pages).collect())
    assert got == [("1", 0), ("1", 0), ("3", 0), ("4", 399999), ("None", 7)]
    assert extract_pages(pages.limit(0)).count() == 0


def test_depth_is_not_limited():
    deep = "<font>" * 600
    first = ("first words " * 10).strip()
    fourth = ("fourth words " * 10).strip()
    page = f"<div><article><p>{first}</p>{deep}<div>second words</div><div>third words</div><p>{fourth}</p></article></div>"
    assert text(page) == f"{first} second words third words {fourth}"
    assert text(f"<article>{deep}<nav>menu words</nav>kept words</article>") == "kept words"
    assert text("<div>" * 60000 + "deep words" + "</p>" * 60000) == "deep words"


def test_unclosed_elements_that_are_not_raw_text_keep_the_rest():
    for tag in ("svg", "video", "audio", "object", "select", "canvas", "math"):
        assert text(f"<article><p>before</p><{tag} class=x><p>after it</p></article>") == "before after it"
        assert text(f"<article><p>before</p><{tag}>inner</{tag}><p>after it</p></article>") == "before after it"


def test_main_elements_need_most_words_to_shut_out_the_others():
    body = "<div>" + "<p>words of the body text here</p>" * 10 + "</div>"
    teaser = "<article>" + "a teaser card " * 9 + "</article>"
    assert "words of the body text here" in text(body + teaser)
    assert "words of the body" not in text(body + "<article>" + "main story " * 40 + "</article>")


def test_all_names_are_learned(spark):
    many = "".join(f"<p class=n{k}>five words stand right here</p>" for k in range(6000))
    pages = spark.createDataFrame([(f"<article>main text</article>{many}<p class=rare>one two three four</p>",)], "html string")
    assert all(fit_weights(pages).key(k) < -1.2 for k in (".rare", ".n0", ".n5999"))


def words(name, n):
    return " ".join(f"{name}{k}" for k in range(n))


def test_misleading_names_do_not_lose_the_article():
    story, menu = words("a", 200), "<nav><a>home</a> <a>news</a></nav>"
    for page in (
        f"<body><form method=post>{menu}<article><p>{story}</p></article><input></form></body>",
        f"<body class='page search'>{menu}<p>{story}</p></body>",
        f"{menu}<article class='post popular'><p>{story}</p></article>",
        f"<body class=search><form>{menu}<main class=popular><p>{story}</p></main></form><footer>the end</footer></body>",
    ):
        assert text(page) == story
    thirds = "".join(f"<article class=popular><p>{words(x, 70)}</p></article>" for x in "abc")
    assert text(thirds) == " ".join(words(x, 70) for x in "abc")


def test_left_out_stretches_do_not_cut_the_article():
    first, second, aside = words("a", 200), words("b", 200), words("x", 300)
    assert text(f"<div><p>{first}</p><aside><p>{aside}</p></aside><p>{second}</p></div>") == f"{first} {second}"
    first, second = words("a", 100), words("b", 60)
    assert text(f"<article>{first}</article><div>{words('x', 150)}</div><article>{second}</article>") == f"{first} {second}"
    menu = "<nav>" + "<a>menu entry</a>" * 30 + "</nav>"
    assert text(f"<div>some stray words</div>{menu}<p>{first}</p>") == first


def test_reader_comments_are_left_out_however_long():
    story, talk = words("a", 30), words("x", 2000)
    for page in (f"<div><p>{story}</p><section class=comments><p>{talk}</p></section></div>", f"<section class=comments><article>{talk}</article></section><article>{story}</article>"):
        assert text(page) == story
    assert text(f"<form>{talk}</form>") == text(f"<body><div class=menu>{talk}</div></body>") == ""
    assert text(f"<body><p>{story}</p><div class=widget>{words('x', 200)}</div></body>") == story


def test_table_with_main_elements_renamed(spark, folder):
    """Without main elements no page is labelled: at least 95 % of the words, and as few others."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    renamed = pages.selectExpr("page_id", "url", "regexp_replace(html, '<(/?)(article|main)', '<$1div') AS html")
    expected = {r.page_id: r.text.split() for r in extract_pages(pages).collect()}
    got = {r.page_id: r.text.split() for r in extract_pages(renamed).collect()}
    for page, wanted in expected.items():
        both = sum((Counter(wanted) & Counter(got[page])).values())
        assert both >= 0.95 * len(wanted) and both >= 0.95 * len(got[page]), page
