import re
from html import unescape

import pytest

from shiftwise.llm.html_text import extract, html_text

CASES = [
    ("<p>a<p>b", "a\n\nb"),
    ("a <b>bold</b>\n\n text", "a bold text"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>x", "- one\n- two\n  - deep\n- three\n\nx"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
    ("<table><tr><th>name<th>n<tr><td>apple<td>10<tr><td>fig<td>7</table>", "name   n\napple  10\nfig    7"),
    ("<table><tr><td colspan=2>wide<td>c<tr><td>a<td>b<td>c</table>", "wide     c\na     b  c"),
    ("<script>var t='</p>';x()</script><style>p{}</style>a<!-- no -->b", "ab"),
    ('<p style="display: none">no</p><p hidden>no</p><span style="color:red">yes</span>', "yes"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("&lt;x&gt; &amp;&eacute; &#65;", "<x> &é A"),
    ("<head><title> T  t </title></head><body><h1>H</h1>p", "H\n\np"),
    ("<td>stray</td></div></p>x", "stray x"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("", ""), (None, ""), ("<", "<"), ("no tags", "no tags"),
    ("<table><form><tr><td>a<td>b</form></table>c", "a  b\n\nc"),
    ("<table><td>x<td>y</table>", "x  y"),
    ("<table><tbody><td>x<tr><td>y</table>", "x\ny"),
    ("<table><colgroup><col><col><tr><td>a<td>b</table>", "a  b"),
    ("<table><col><tr><td>a</table>", "a"),
    ("<table>text<tr><td>a</table>", "text\n\na"),
    ("<table><tr>in row<td>a</tr><div>block</div>tail</table>", "in row\nblock\ntail\n\na"),
    ("<table><tbody><p>para<tr><td>a</table>z", "para\n\na\n\nz"),
    ("<table><tr><td>a<div><tr><td>b</table>", "a\nb"),
    ("<table><tr><table><tr><td>inner</table>x", "inner\n\nx"),
    ("<table><tr><td><table><tr><td>in</table>out<td>b</table>", "in out  b"),
    ("<table><caption>cap<td>a</table>", "cap\na"),
    ("<table><tr><b>bold</b><select><option>o</select><td>a</table>", "bold\no\n\na"),
    ("<table><template><tr><td>no</template><tr><td>a</table>", "a"),
    ("<head><title>T</title><p>whole<p>article", "whole\n\narticle"),
    ("<html><head><meta charset=utf-8><title>T</title>\n text <b>only</b>", "text only"),
    ("<head><script>x()</script><style>p{}</style><noscript>no</noscript><h1>H</h1>", "H"),
    ("<head><noscript><link></head><body>a", "a"),
    ("<p>a</p><head><p>b</head>c", "a\n\nbc"),
    ("<title>T</title><head><link>text", "text"),
    ("a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b", "a x=1 b"),
    ("<math><semantics><mi>y</mi><annotation>\\y</annotation></semantics></math>", "y"),
    ("a <svg><title>no</title><g>no<text x=1>one <tspan>two</tspan></text><text>three</text></g></svg> b", "a one two three b"),
    ("<svg><defs><text>no</text></defs><path/><desc/><text>yes</text></svg>", "yes"),
    ("<svg><foreignObject><p>in</p></foreignObject></svg>out", "in\n\nout"),
    ("a<svg/>b<svg><circle><p>c", "ab\n\nc"),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_rendering(html, text):
    assert html_text(html)[1] == text


def test_title():
    assert html_text("<title> A  b</title><p>x")[0] == "A b"


def test_every_visible_word_once_and_in_order(spark):
    """Brute force: what stays after cutting hidden elements and tags, compared word by word."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        t = re.sub(r"(?is)<!--.*?-->|<(script|style|title|noscript|template)\b.*?</\1>", " ", r["html"] or "")
        want = re.sub(r"\s+", "", unescape(re.sub(r"(?s)<[a-zA-Z/!][^>]*>", "", t)))
        have = re.sub(r"\s+", "", re.sub(r"(?m)^ *(?:- |\d+\. )", "", got[r["page_id"]]["text"]))
        if "<ol" not in (r["html"] or ""):
            assert have == re.sub(r"\s+", "", want), r["page_id"]


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "u", 5), (None, "<p>x", "u", 5), (2, "", "u", 6), (2, "", "u", 6)],
                               "page_id long, html string, text string, n_lines int")
    assert sorted((r["page_id"] or -1, r["text"], r["n_lines"]) for r in extract(df).collect()) == [
        (-1, "x", 1), (1, "", 0), (2, "", 0), (2, "", 0)]
