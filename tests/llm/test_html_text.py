import re
from html.parser import HTMLParser

import pytest

from orchardflow.llm.html_text import extract, page_text

CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>One<p>Two", "One\n\nTwo"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<b>x</b> <i>y</i>z", "x yz"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>after", "- a\n- b\n  - c\n- d\n\nafter"),
    ("<ol start=9><li>x<li>y<p>z</ol>", "9. x\n10. y\n\n    z"),
    ("<head><title>t</title><meta charset=x>visible", "visible"),
    ("<script>var t=\"</p>\";</script><style>p{}</style>k", "k"),
    ("<p hidden>no</p><p style='display: none'>no</p><div style=visibility:hidden>no</div>yes", "yes"),
    ("<table><tr><th>Name<th>Price<tr><td>Long name<td>5<tr><td>x<td>1234</table>", "Name       Price\nLong name  5\nx          1234"),
    ("<table><caption>C</caption><tr><td>a<br>b<td>c</table>", "C\na  c\nb"),
    ("<table><tr><td colspan=2>wide one<tr><td>a<td>b</table>", "wide one\na  b"),
    ("<pre>\n a  b\n  c</pre>d", " a  b\n  c\n\nd"),
    ("1 < 2 &amp; 3 &gt; 2 &copy;&eacute;", "1 < 2 & 3 > 2 ©é"),
    ("<!-- no --><!doctype html>x<? y ?>z", "xz"),
    ("<details><summary>s</summary>gone</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
    ("<blockquote>q<p>r</blockquote>", "> q\n\n> r"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    ("kept<a href=\"broken>lost", "kept"),
    ("<p>a</div></span>b</p></p>c", "ab\n\nc"),
    ("<a href=x>l1<a href=y>l2</a>", "l1l2"),
    ("<td>loose</td>", "loose"),
    ("<textarea>a <b>\n c</textarea>", "a <b>\n c"),
    ("x <svg><title>t</title><desc>d</desc><text>one</text><text>two <tspan>three</tspan></text></svg> y", "x one two three y"),
    ("<p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>tex</annotation></math>.", "E = mc2."),
    ("<select><option>a<option selected>b<option>c</select>d", "b d"),
    ("<select><optgroup label=g><option>a<option>b</optgroup></select>", "a"),
    ("<select multiple><option>a<option>b</select>", "a b"),
    ("<table><tr><td rowspan=2>Long head<td>1<td>2<tr><td>3<td>4<tr><td>x<td>5<td>6</table>", "Long head  1  2\n           3  4\nx          5  6"),
    ("<table><tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b   c\nd      e\nf      g"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert page_text(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ('<a href="x"">one</a> two three', "one two three"),
        ("<p title=it's>Hello</p><p>more</p>", "Hello\n\nmore"),
        ("<p title=it's>Hello</p><p>that's <b class=o'k>all</b>", "Hello\n\nthat's all"),
        ('<a "b">x</a>y', "xy"),
        ('<p ="a>b">c', 'b">c'),
        ("<p title=a\"hidden \">shown", "shown"),
        ("<p title=a=\"b>c", "c"),
        ("<p title = \"a>b\" class=>c", "c"),
        ("<p>x</p \">y", "x\n\ny"),
        ("kept<a href= 'broken>lost", "kept"),
    ],
)
def test_stray_quotes(page, text):
    """A quote opens a string only directly after ``=``; elsewhere the tag ends at the next ``>``."""
    assert page_text(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000
    assert page_text(deep) == "x"
    assert page_text("<table><tr><td>" * 400 + "y") == "y"
    assert page_text("<p>" + "word " * 200_000).count("word") == 200_000
    assert page_text("<a \"" * 20_000) == ""


class Words(HTMLParser):
    """Visible words another way: no layout, no tree."""

    def __init__(self):
        super().__init__()
        self.hidden, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        self.found.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        self.found.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.found.append(data)


def test_same_words_as_flat_reading(spark):
    from pathlib import Path

    path = "/root/testdata/sf0.01/pages.parquet"
    if not Path(path).exists():
        pytest.skip("no test tables")
    pages = spark.read.parquet(path)
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        flat = Words()
        flat.feed(re.sub(r"<[^>]*\Z", "", r.html))  # what ends inside a tag shows nothing of it
        flat.close()
        want = "".join(flat.found).split()
        words = [w for line in got[r.page_id].split("\n") for w in re.sub(r"^\s*- ", "", line).split()]
        assert words == want, r.page_id


def test_rows(spark):
    df = spark.createDataFrame([(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, "y"), (2, "", "z")], "page_id long, html string, text string")
    assert sorted((str(r.page_id), r.text, r.n_lines) for r in extract(df).collect()) == [("1", "a", 1), ("1", "a", 1), ("2", "", 0), ("None", "", 0)]
    assert extract(df.limit(0)).count() == 0


def test_visibility_is_inherited_and_taken_back():
    for page, text in (
        ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span>x</div>c", "b\nc"),
        ("<p style='visibility:hidden'>a<p>b", "b"),
        ("<p>a</p><p style='color:red; VISIBILITY : collapse'>b<b>c</b></p><p>d</p>", "a\n\nd"),
        ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
        ("<div style='visibility:visible;visibility:hidden'>a</div>b", "b"),
        ("<div style='visibility:hidden'><div style='display:none;visibility:visible'>a</div></div>b", "b"),
        ("<table style='visibility:hidden'><tr><td>a<td style='visibility:visible'>b</table>", "b"),
        ("visibility: hidden <i>words</i>", "visibility: hidden words"),
    ):
        assert page_text(page).strip() == text, page
    deep = "<div style='visibility:hidden'>" * 3000 + "x<b style='visibility:visible'>y</b>"
    assert page_text(deep) == "y"
