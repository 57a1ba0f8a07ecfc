import re
from html.parser import HTMLParser

from cohortlens.llm.layout import extract, render

CASES = {
    "<p>One<p>Two <b>bold</b>\n text": "One\n\nTwo bold text",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>after": "- a\n- b\n  - c\n- d\n\nafter",
    "<ol><li>x<li>y</ol>": "1. x\n2. y",
    "<table><tr><th>Name<th>N<tr><td>longer name<td>1</table>": "Name         N\nlonger name  1",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<pre>  x\n   y</pre>z": "  x\n   y\n\nz",
    "<div hidden>no</div><div>yes</div>": "yes",
    "<div style='display: none'>no<p>no</div>yes": "yes",
    '<div style="visibility:hidden">no<span style="visibility:visible">yes</span></div>': "yes",
    "<script>var a='</p>';if(a<b){}</script>ok<style>p{}</style>": "ok",
    "<title>t</title><body>x &amp; y &lt;b&gt; 1 < 2": "x & y <b> 1 < 2",
    "<a title='a>b'>link</a><!-- c --><!doctype x>": "link",
    "unfinished <a href='x": "unfinished",
    "<table><tr><td><table><tr><td>in</table><td>out</table>": "in  out",
    "</p></div>stray</td>": "stray",
    "": "",
}


def test_cases():
    for source, text in CASES.items():
        assert render(source)[0] == text, source


def test_depth_and_odd_input_do_not_break_it():
    assert render("<div>" * 20_000 + "deep")[0] == "deep"
    assert render("<ul><li>" * 500 + "x")[0].endswith("x")
    assert render("<" * 50_000)[0] == "<" * 50_000
    assert render("<a '" * 3_000)[0] == ""


class Plain(HTMLParser):
    """Words outside hidden elements, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.skip, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title", "noscript", "template")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title", "noscript", "template")

    def handle_data(self, data):
        if not self.skip:
            self.words += re.findall(r"[^\W_]+", data)


def test_all_pages_keep_every_visible_word(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        plain = Plain()
        plain.feed(r.html)
        if "hidden" in r.html or "display:none" in r.html:
            continue
        words = re.findall(r"[^\W_]+", re.sub(r"(?m)^\s*(-|\d+\.) ", " ", got[r.page_id]))
        assert sorted("".join(words)) == sorted("".join(plain.words)) or words == plain.words, r.page_id


def test_defined_rows(frame):
    rows = extract(frame([(1, None, "x"), (1, "", "x"), (None, "<p>a", "x")], "page_id long, html string, text string"))
    assert sorted((r.page_id or 0, r.text) for r in rows.collect()) == [(0, "a"), (1, ""), (1, "")]
    assert extract(frame([], "page_id long, html string")).count() == 0


def test_head_ends_with_what_cannot_stand_in_it():
    assert render("<html><head><title>T</title><h1>Hi</h1><p>text")[0] == "Hi\n\ntext"
    assert render("<head> <meta charset=x><link href=y><style>p{}</style>\n words<p>more</head>")[0] == "words\n\nmore"
    assert render("<head><title>T</title><script>1<2</script><template><p>no</template> </head><body>yes")[0] == "yes"
    assert render("<head><img src=x>seen")[0] == "seen"


def test_a_closing_slash_ends_drawings_and_formulas():
    assert render("<p>a <svg width='1'/>b <math/>c</p>d")[0] == "a b c\n\nd"
    assert render('<div><svg><title/><style/><path d="M0=1"/>no<svg/>no</svg>yes</div>')[0] == "yes"
    assert render("<div><svg width=1/>no</svg>yes<div/>in</div>")[0] == "yes\nin"
    assert render("<svg><foreignObject><div/><p>no</p></div>no</foreignObject></svg>yes")[0] == "yes"
