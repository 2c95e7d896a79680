import html
import itertools
import math
import re

from adlake.llm import html_extract as H

LONG = "The first of them came early, as they always did. Then there was a second one, and nobody minded much."


def test_messages_equal_enumeration():
    model = H.train([])
    nodes = H.parse("<body><nav><a>x</a></nav><p>Some <b>bold</b> text, here.</p></body>")
    H.describe(nodes)
    weight = [0.0] * len(nodes)
    total = 0.0
    for s in itertools.product((0, 1), repeat=len(nodes)):
        w = -20.0 * s[0] + sum(s[i] * sum(model.emission.get(f, 0.0) for f in n.features) for i, n in enumerate(nodes))
        w = math.exp(w + sum(model.potential[H.kind(n)][s[n.parent]][s[i]] for i, n in enumerate(nodes) if i))
        total += w
        for i, x in enumerate(s):
            weight[i] += w * x
    for got, w in list(zip(model.marginals(nodes), weight))[1:]:
        assert abs(got - w / total) < 1e-9


def text(page):
    return H.main_text(page, H.train([]))


def test_layouts_that_were_not_trained_on():
    page = f"""<!doctype html><html><head><title>t</title><script>var x="<p>no</p>"</script></head><body>
    <div class="cookie-notice">We use cookies, please accept them all. {LONG}</div>
    <header><nav><a href=1>Home</a> <a>News</a></nav></header>
    <article><h1>Head &amp; line</h1><p><b>Short.<br><p>{LONG} &lt;ok&gt;&nbsp;  x<p>foo<i>bar</i>
      baz</p><div class="ad"><p>Buy now, {LONG}</p></div><ul><li>one thing, then<li>another</ul>
    <section class="comments"><h3>Comments</h3><p>{LONG}</p></section></article>
    <aside class="sidebar"><p>{LONG}</p></aside><form><p>Sign up, {LONG}</p></form><footer><p>{LONG}</p></footer>"""
    assert text(page).split("\n") == ["Head & line", "Short.", f"{LONG} <ok> x", "foobar baz", "one thing, then", "another"]


def test_odd_pages():
    assert text(None) == text("") == text("  ") == text("<!-- <p>x</p>") == text("<script>x") == ""
    assert text("<article><p>a < b and " + LONG) == "a < b and " + LONG
    deep = "<div>" * 5000 + "<article><p>" + LONG + "</p></article>"
    assert text(deep) in ("", LONG)
    assert text("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>") == "\n".join([LONG] * 3000)


def test_drawings_formulas_controls():
    art = lambda inner: text(f"<body><nav><a>x</a></nav><article><h1>Head</h1><p>{LONG}</p>{inner}<p>{LONG}</p></article></body>").split("\n")
    two = ["Head", LONG, LONG]
    assert art('<svg class="icon" viewBox="0 0 1 1"/>') == two
    assert art("<svg><title>t</title><text>label</text></svg>") == two
    assert art("<svg>") == two  # never closed: only the tag goes
    assert art("<select><option>one<option>two") == two
    assert art("<select><option>one</option></select>") == two
    assert art("<iframe src=x>") == two
    assert art(f"<p>Then <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds. {LONG}</p>") == ["Head", LONG, f"Then x=2 holds. {LONG}", LONG]
    assert art(f"<p>An <svg/> icon. {LONG}</p>") == ["Head", LONG, f"An icon. {LONG}", LONG]
    assert art(f"<object data=x><p>{LONG}</p></object>") == ["Head", LONG, LONG, LONG]
    assert art(f"<noscript><p>{LONG}</p></noscript>") == ["Head", LONG, LONG, LONG]


def truth(page):
    """The given pages' articles, read off by their known markup."""
    body = page[page.index("<article>") : page.index("</article>")]
    parts = re.split(r"</?(?:article|h1|p|div)>", body)
    return "\n".join(t for x in parts if (t := " ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split())))


def test_query_against_known_markup(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
        got = H.op8_html_extract(spark, sf).collect()
        assert len(got) == len(pages)
        bad = [r.page_id for r in got if r.text != truth(pages[r.page_id].html) or r.n_chars != len(r.text) or r.url != pages[r.page_id].url]
        assert not bad, (len(bad), len(got), bad[:5])


def test_columns_and_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, f"<article><p>{LONG}</p></article>", "y"), (None, "", None)], "page_id long, html string, text string")
    got = H.extract(df, H.fit(df)).collect()
    assert sorted((r.n_chars, r.text) for r in got) == [(0, ""), (0, ""), (len(LONG), LONG)]
    assert H.extract(df.limit(0), H.fit(df.limit(0))).collect() == []
