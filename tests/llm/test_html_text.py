from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpipe.llm.html_text import render, visible_text

CASES = [
    ("<p>one\n two<p>three", "one two\n\nthree"),
    ("a<div>b</div>c<br>d", "a\nb\nc\nd"),
    ("<title>t</title><style>p{}</style>x<script>var a='</p>'</script>y", "xy"),
    ("<head><title>t</title><meta><body>x", "x"),
    ("<head><title>t</title>x", "x"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>a<li>b<p>c</ol>", "9. a\n10. b\n\n    c"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "a\n  b\nc"),
    ("<table><tr><th>n<th>long name<tr><td>value<td>x</table>", "n      long name\nvalue  x"),
    ("<table><td>a<td>b<tr><td colspan=2>wide one<td>c</table>", "a  b\nwide one  c"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td>x<table><tr><td>in<td>ner</table></td><td>y</table>", "x        y\n\nin  ner"),
    ("<p>a<span hidden>b</span><b style='display: none'>c<i>d</i></b>e", "ae"),
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</div>", "b"),
    ("<details><summary>s</summary>x</details><details open><summary>t</summary>y", "s\nt\ny"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("a &lt;b&gt; &amp;&nbsp;&copy; &unknown; < 3", "a <b> & © &unknown; < 3"),
    ("<!-- <p>no --><!DOCTYPE html><![CDATA[x]]>y", "y"),
    ("<a title='>' href=\"<p>\">link</a>", "link"),
    ("</p>x</div></td><td>y", "xy"),
    ("<b><p>x</b>y</p>z", "xy\n\nz"),
    ("<p>a</p>\n\n  <p> b </p>", "a\n\nb"),
    ("<blockquote>q<br>r</blockquote>s", "  q\n  r\n\ns"),
    ("<select><option>a<option>b</select>c<textarea>&lt;t</textarea>", "c<t"),
    ("", ""),
    (None, ""),
    ("<", "<"),
    ("<a", ""),
    ('<a href="x', '"x'),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_layout(page, text):
    assert render(page) == text


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["<p>", "</p>", "<div>", "</div>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<th>",
             "<ul>", "<li>", "</ul>", "<ol>", "</ol>", "<b>", "</b>", "<pre>", "</pre>", "<br>", "</tr>",
             "<caption>", "<tbody>", "</li>", "<dd>", "w1 ", "w2", "\n", "<a href='", '"', "&amp;"]
        ),
        max_size=40,
    )
)
def test_any_tags_are_survived(parts):
    page = "".join(parts)
    text = render(page)
    if "'" not in page and '"' not in page:
        assert sum(map(text.count, ("w1", "w2"))) == sum(map(page.count, ("w1", "w2")))


def test_depth_and_size():
    n = 50_000
    assert render("<div>" * n + "x" + "</div>" * n) == "x"
    assert render("<b>" * n + "x<p>y") == "x\n\ny"
    assert render("<p>x" * n).count("x") == n
    rows = "<tr><td>" + "w" * 5000 + "<td>b" + "<tr><td>a<td>b" * 2000
    assert len(render(f"<table>{rows}</table>")) < 40_000


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    extra = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>x")], pages.schema)
    both = pages.union(extra)
    got = visible_text(both).collect()
    assert Counter(map(tuple, got)) == Counter((r["page_id"], render(r["html"])) for r in both.collect())
    for r in got[:20]:
        assert "<" not in r["text"] and "track(" not in r["text"]
    assert visible_text(pages.limit(0)).count() == 0
