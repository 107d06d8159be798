import itertools
import random

from matchpeaks.llm import main_text as m

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies</div>
<article><h2>Title &amp; more</h2><p>First   <b>bold</b>&nbsp;text<br>next<p>Second &lt;p&gt; <a href='x>y'>link</a>.
<div class="ad">Buy now</div><p>Third</p><section id="comments"><p>Reader says</p></section></article>
<aside>Side</aside><form><p>Your mail</p></form><footer>&copy; us</footer></body></html>"""


def test_article_only():
    assert m.main_text(PAGE) == "Title & more\n\nFirst bold text next\n\nSecond <p> link.\n\nThird"


def test_broken_pages():
    assert m.main_text("") == "" and m.main_text("<p>") == "" and m.main_text("<script>never closed") == ""
    assert m.main_text("<article><p>open <b>end") == "open end"
    assert m.main_text("<article>" + "<div>" * 3000 + "deep") == "deep"
    assert m.main_text("<nav>only a menu</nav>") == ""
    assert m.main_text("<article>1 < 2 & 3 > 2</article>") == "1 < 2 & 3 > 2"


def test_pages_without_names_go_by_length_and_links():
    long = "<p>" + "word " * 80 + "</p>"
    page = f"<body><div><a href=1>one</a></div>{long}<p>short but inside</p>{long}<div><a href=1>two</a></div></body>"
    assert m.main_text(page).count("\n\n") == 2 and "short but inside" in m.main_text(page)


def test_labels_are_the_least_cut():
    """Against all labellings of small graphs."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 8)
        odds = [rng.choice([-2, -1, -0.5, 0.25, 0.5, 1, 2]) for _ in range(n)]
        cost = {(a, b): rng.choice([0.3, 0.7, 1.1]) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5}

        def total(x):
            return sum(o * (o > 0) if not keep else -o * (o < 0) for o, keep in zip(odds, x)) + sum(c for (a, b), c in cost.items() if x[a] != x[b])

        least = min(map(total, itertools.product([False, True], repeat=n)))
        assert abs(total(m.labels(odds, cost)) - least) < 1e-9
        assert abs(total(m.minimum_cut(odds, cost)) - least) < 1e-9


def test_query_columns(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 3), (None, None, None, 4), (1, "u", PAGE, 3)], "page_id bigint, url string, html string, text int")
    rows = sorted(map(tuple, m.extract(df).collect()), key=str)
    assert rows[-1] == (None, None, "", 0) and rows[0] == rows[1] and rows[0][3] == len(rows[0][2])
    assert m.extract(df.limit(0)).collect() == []


def test_raw_elements_hide_only_what_is_theirs():
    assert m.main_text('<article><p>One <svg class="i"/> two</p><p>Three</p></article>') == "One two\n\nThree"
    assert m.main_text("<article><p>One <svg><title/><path d=x /><text>icon</text></svg> two</p><p>Three</p></article>") == "One two\n\nThree"
    for name in ("svg", "select", "template", "iframe", "noscript", "object"):
        assert m.main_text(f"<article><p>One <{name} class=x> </p><p>Three</p></article><p>{'and more text ' * 9}</p>").startswith("One\n\nThree\n\nand more")
    assert m.main_text("<article><p>One <svg> <p>Three</article>") == "One\n\nThree"
    assert m.main_text("<article><p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> or <math/> holds</p></article>") == "If x=1 or holds"
    assert m.main_text("<article><p>See <object data=f><param name=a>the film</object> here</p></article>") == "See the film here"
    assert m.main_text("<article>Code<xmp><p>&amp; raw</XMP >end</article>") == "Code\n\n<p>&amp; raw\n\nend"
    assert m.main_text("<article><p>One <select><option>a<option>b</select> <template><div>no</div></template>two</p></article>") == "One two"
    assert m.main_text("<article><p>One</p><textarea>rest <p>of the page") == "One"


def test_names_of_wrappers_leave_the_article():
    text = "A sentence of the article that goes on for quite some while, as such sentences do. " * 10
    story = f"<h1>Title of it</h1><p>{text}</p><p>Short one.</p><p>{text}</p>"
    side = "<div class=sidebar><p>Other things to read, a list of them, and some more words on top of that.</p></div>"
    notes = f"<div id=comments>{'<p>A reader says a lot about it, sentence by sentence, for no good reason at all.</p>' * 4}</div>"
    for name in ("content-sidebar-wrap", "main has-sidebar", "no-sidebar", "post category-social", "sidebar-layout", "page header-fixed"):
        for inner in (story, f"<article>{story}</article>", f"<main><div>{story}</div></main>"):
            for page in (f"<div class='{name}'>{inner}{side}</div>{notes}", f"<div class='{name}'><div class='{name}'>{inner}</div>{side}{notes}</div>"):
                found = m.main_text(page)
                assert found.count(text.strip()) == 2 and "Short one." in found, (name, page)
                assert "Other things" not in found and "A reader" not in found, (name, page)
    assert "A reader" not in m.main_text(f"<article class=post><div class=entry-content>{story}</div>{notes}</article>")
    assert m.main_text("<div class=related><article><p>Read this</p></article></div><article><p>" + text + "</p></article>") == text.strip()
