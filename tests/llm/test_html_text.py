import re
import time
from html.parser import HTMLParser

import duckdb
import pytest

from veritrail.llm.html_text import extract, extract_text

CASES = [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br/>c", "a\nb\nc"), ("<p>a<br><p>b<br><br></p>c", "a\n\nb\n\n\nc"),
    ("<head><title>T</title><style>p{}</style></head><body>x<script>var a='<p>no</p>'</script>y", "xy"),
    ("<!-- no --><div>a</div><div>b <b>c</b>d</div>", "a\nb cd"), ("<p hidden>n</p><p style='display: none'>n</p><p aria-hidden=true>y", "y"),
    ("<div style='visibility:hidden'>n<span style=\"visibility:visible\">y</span></div>", "y"),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", "- one\n- two\n  - in\n- three"), ("<ol start=3><li>c</li><li value=9>i</li><li>j</li></ol>", "3. c\n9. i\n10. j"),
    ("<table><tr><th>Name<th>N<tr><td>Ann<td>1<tr><td>B<td>200</table>", "Name  N\nAnn   1\nB     200"),
    ("<table><caption>Cap</caption><tr><td colspan=2>wide one</td><td>z<tr><td>a<td>b<td>c</table>", "Cap\nwide one  z\na  b  c"),
    ("<table><tr><td>x<br>y<td>1</table>", "x  1\ny"), ("<table><tr><td><table><tr><td>i<td>j</table><td>o</table>", "i  j  o"),
    ("<pre>\n a\n   b\n</pre>c", " a\n   b\n\nc"), ("<blockquote><p>q</p></blockquote>", "> q"), ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("&lt;b&gt; &amp; &eacute; &#233;", "<b> & é é"), ("a < b and <3", "a < b and <3"), ("<h1>H</h1>text<hr>more", "H\n\ntext\n\nmore"),
    ("<details><summary>s</summary>n</details><details open><summary>s</summary>y</details>", "s\ns\ny"), ("<a href=x>l</a><a href=y>m</a>", "lm"),
    ("<input type=hidden value=n><input type=submit value=Go>", "Go"), ("<p>unclosed <b>bold <i>it</p>after", "unclosed bold it\n\nafter"),
    ('<p title="a > b">x</p>', "x"), ("<p title=\"never closed>x</p>", "x"), ("</p>a", "a"), ("<textarea> t&amp;<b> </textarea>", " t&<b>"), ("<td>lone</td>", "lone"),
    ("<ul><li><p>a</p><p>b</p></ul>", "- a\n\n  b"), ("İ<script>x</script>y", "İy"),
    ("<html><head><title>T</title><h1>A</h1><p>text", "A\n\ntext"), ("<head>\n<meta charset=x><script>n</script>\nwords<title>n</title> go on", "words go on"), ("<head><template><p>n</template>&#32;<link><div>y", "y"), ("<head><title>T</title></br>y", "\ny"),
    ("<table><colgroup><col><col><tr><td>x<td>y</table>z", "x  y\n\nz"), ("<table><colgroup span=2><thead><tr><th>a<tbody><tr><td>b</table>", "a\nb"), ("<table><colgroup><col></colgroup><tr><td>x</table>", "x"),
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"), ("<math><semantics><mi>x</mi><annotation>n</annotation></semantics></math>", "x"), ("<map name=m><area href=x>l <a href=y>k</a></map>", "l k"),
    ("a<svg><title>n</title><defs><text>n</text></defs><style>n</style><g>n<text x=1>one</text><path/><text>t<tspan>wo</tspan></text></g></svg>b", "a one two b"), ("<svg><defs/><title/><text>y</text></svg>z", "y z"),
    ("<svg><foreignObject><p>f</p></foreignObject></svg>", "f"), ("<svg><path d=x><p>out", "out"), ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>dd<td>e</table>", "a   b\n    c\ndd  e"), ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e</table>", "a  b  c\nd     e"),
    ("<table><tr><td colspan=2 rowspan=2>ab<td>c<tr><td>d<tr><td>1<td>2<td>3</table>", "ab    c\n      d\n1  2  3"), ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td>a<table><tr><td>b<td rowspan=2>c<tr><td>d</table><td>e</table>", "a     e\n\nb  c\nd"), ("<pre>a   b<div>c   d</div>e  f<p>g  h</pre>", "a   b\nc   d\ne  f\ng  h"),
    ("<ol start=" + "9" * 5000 + "><li>x</ol>", "1000000000. x"), ("<ol start=+00012x><li value=' 7'>x</ol>", "7. x"), ("&#" + "9" * 5000 + ";y&#x" + "f" * 5000 + "z&#x110000;", "\ufffdy\ufffdz\ufffd"),
    ("&#" + "0" * 5000 + "65;&#x0000000041;&#65;", "AAA"), ("<td colspan=" + "1" * 5000 + " rowspan=" + "1" * 5000 + ">x", "x"),
    ("<p>a<svg style='display:none'><text>n</text></svg>b", "ab"), ("<a href=x><svg><a><text>in</text></a></svg>out</a>", "in out"),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_cases(page, want):
    assert extract(page) == want


@pytest.mark.parametrize("piece", ["<div>", "<table><tr><td>", "<ul><li>", "<b><p>", "<", "<a href=\"", "<!--", "<p x='", "&", "<select><option>", "</x>", "<table><tr><td>a<td>", "<pre><div>a", "<tr><td rowspan=9>"])
def test_long_and_deep_pages_take_bounded_time(piece):
    began = time.time()
    extract(piece * 20_000)
    assert time.time() - began < 30


class Lines(HTMLParser):
    """Another way to the lines of a page without tables, preformatted text and hidden elements: the standard library's parser, blocks on lines of their own."""

    BLOCKS = frozenset("html body p li ul ol div nav article section header footer main h1 h2 h3 h4 blockquote".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.now, self.silent = [], [], 0

    def end_line(self):
        text = " ".join("".join(self.now).split(" ")).split()
        self.lines += [" ".join(text)] if text else []
        self.now = []

    def handle_starttag(self, tag, attributes):
        if tag in ("script", "style", "title", "noscript"):
            self.silent += 1
        if tag in self.BLOCKS or tag == "br":
            self.end_line()

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title", "noscript"):
            self.silent -= 1
        if tag in self.BLOCKS:
            self.end_line()

    def handle_data(self, data):
        if not self.silent:
            self.now.append(re.sub(r"[ \t\n\r\f]+", " ", data))


def test_lines_of_all_real_pages_by_another_parser():
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        other = Lines()
        other.feed(page)
        other.close()
        other.end_line()
        items = page.count("<li")
        got = [x for x in extract(page).split("\n") if x]
        assert [" ".join(x.removeprefix("- ").split()) for x in got] == other.lines and sum(x.startswith("- ") for x in got) >= items


def test_frame(spark):
    rows = [(1, "<p>a", "x"), (None, None, "y"), (1, "<p>a", "x"), (2, "", None)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "")]
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0
