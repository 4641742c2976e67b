from hypothesis import given, settings
from hypothesis import strategies as st
from textloom.llm.html_text import extract, visible_text

CASES = {
    "": "",
    "plain  text\n here": "plain text here",
    "<p>one<p>two <b>bold</b>, x": "one\n\ntwo bold, x",
    "<div>a</div><div>b<div>c</div></div>": "a\nb\nc",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>after": "- a\n- b\n  3. x\n  4. y\n- c\n\nafter",
    "<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>": "Name       Qty\napple pie  3",
    "<table><tr><td rowspan=2>r<td>1<tr><td>2</table>": "r  1\n   2",
    "<table><tr><td colspan=2>wide words here<td>z<tr><td>a<td>b<td>c</table>": "wide words here  z\na  b  c",
    "<table><tr><td>a<br>bb<td>c</table>": "a   c\nbb",
    "<table><tr><td>中文<td>x<tr><td>abcd<td>y</table>": "中文  x\nabcd  y",
    "a<script>if (a<b) '</p>'</script>b<style>p{}</style>c<!-- <p>no -->d": "abcd",
    "<head><title>no</title></head><body>yes": "yes",
    "<div hidden>no</div><p style='display : NONE'>no</p><input type=hidden value=no>yes": "yes",
    "<p hidden>no<p>yes": "yes",
    "<pre>\n  keep   it\n   so</pre>": "  keep   it\n   so",
    "&lt;b&gt; &amp; &eacute;&#33;": "<b> & é!",
    "x<br>y<br><br>z": "x\ny\n\nz",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n    d\nu",
    "<blockquote>q<br>r</blockquote>": "> q\n> r",
    "</div></table></p>a</li>": "a",
    "<td>cell<tr>": "cell",
    "<table><tr><td>in<table><tr><td>x<td>y</table></table>": "in\n\nx  y",
    "<a title='a>b'>t</a><a title='broken>u": "tu",
    "<table>stray<tr><td>cell</table>": "stray\n\ncell",
}


def test_cases():
    for page, text in CASES.items():
        assert visible_text(page) == text, page


def test_deep_and_long():
    assert visible_text("<div>" * 20_000 + "deep") == "deep"
    assert visible_text("<table><tr><td>" * 2_000 + "deep") == "deep"
    assert visible_text("<p>word " * 20_000).count("word") == 20_000
    rows = "<tr><td>a<td>b" * 5_000
    assert len(visible_text(f"<table><tr><td>{'x' * 10_000}<td>y{rows}</table>")) < 1_000_000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "</table>", "<tr>", "<td colspan=3>", "<td rowspan=2>", "</td>", "<pre>", "</pre>", "<dd>", "<br>", "<caption>", "</caption>", "</tr>", "<ol>", "<select>", "<option>", "w1 ", "w2", " w3"]), max_size=40))
def test_no_word_is_lost(parts):
    page = "".join(parts)
    got = visible_text(page)
    for w in ("w1", "w2", "w3"):
        assert got.count(w) == page.count(w)


def test_spark(spark):
    rows = [(1, "u", "<p>a", "t", 5), (1, "u", "<p>a", "t", 5), (2, "u", None, "t", 5), (None, "u", "", "t", 5), (3, "u", "<p>é", "t", 5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in extract(df).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (1, "a", 1), (2, "", 0), (None, "", 0), (3, "é", 1)], key=repr)
    assert extract(df.limit(0)).count() == 0
