"""HTML extraction: layouts, implied tags, visibility, a plain word reader over all pages, and edge cases."""

from html.parser import HTMLParser

import pytest

import __spark_entry__ as entry
from conftest import SF_MID
from ridgeway.llm import html_text as ht

BLOCKS = {"p", "div", "h1", "h2", "li", "ul", "ol", "nav", "article", "footer", "body", "br", "td", "th", "tr", "table", "section", "header"}


class Words(HTMLParser):
    """Visible words in order, for pages without hidden attributes."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("head", "script", "style", "title") and tag != "head"
        if tag in BLOCKS:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")
        if tag in BLOCKS:
            self.out.append(" ")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_every_page_keeps_its_visible_words(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in entry.queries()["op6_html_extraction"](spark, SF_MID).collect()}
    assert set(got) == set(pages)
    for k, html in pages.items():
        reader = Words()
        reader.feed(html)
        reader.close()
        words = [w for w in "".join(reader.out).split()]
        assert [w for w in got[k].split() if w != "-"] == [w for w in words if w != "-"], k
        lines = got[k].split("\n")
        assert all(x or y for x, y in zip(lines, lines[1:])) and lines[0] and lines[-1]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a<p>b <div>c</div>d", "a\n\nb\n\nc\nd"),
        ("x <b>bold</b>\n  y<br>z<br><br>w", "x bold y\nz\n\nw"),
        ("<ul><li>one<li>two<ul><li>in<li>ner</ul><li>three</ul>after", "- one\n- two\n  - in\n  - ner\n- three\n\nafter"),
        ("<ol start=9><li>nine<li>ten<p>more</ol><ol><li value=4>four<li>five</ol>", "9. nine\n10. ten\n\n    more\n\n4. four\n5. five"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td>x<td>1000</table>", "Name       Qty\napple pie  3\nx          1000"),
        ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td colspan=2>wide one<td>f</table>", "a  b  c\n   d  e\nwide one  f"),
        ("<table><caption>cap</caption><tr><td>p<br>q<td>r</table>t", "cap\np  r\nq\n\nt"),
        ("<table><tr><td>o<td><table><tr><td>i<td>j<tr><td>kk<td>l</table><td>z</table>", "o  i   j  z\n   kk  l"),
        ("<pre>\n a\n\n  b &lt;</pre>c", " a\n\n  b <\n\nc"),
        ("<head><title>no</title></head><body>yes<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no --> ok", "yes ok"),
        ("<title>t</title>text", "text"),
        ("a<div hidden>no<p>no</div>b<p style='color:red; DISPLAY : none'>no</p><span style=visibility:hidden>no</span>c", "abc"),
        ("<details>no<summary>sum</summary>no</details><details open><summary>s</summary>in</details><dialog>no</dialog>", "sum\ns\nin"),
        ("a &amp; b&nbsp;c &eacute;&#x41;", "a & b c éA"),
        ("1 < 2 </> </3> <a title=it's href='x>y'>link</a>", "1 < 2 link"),
        ("<dl><dt>T<dd>D one<dt>U<dd>E</dl><blockquote>q</blockquote>", "T\n    D one\nU\n    E\n\n    q"),
        ("<td>loose</td> <tr>row", "loose row"),
        ("<select><option>A<option>B</select><textarea> keep\n  it</textarea>", "A\nB\n keep\n  it"),
        ("</p>x</div></b><h1>h</h2>y", "x\n\nh\n\ny"),
        ("<p>unclosed <b>tag", "unclosed tag"),
        ("text <!-- open comment <p>x", "text"),
        ("a<p style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</p>b", "a\n\nyes\n\nb"),
        ("<div style='visibility:collapse'><div style='display:none'><i style='visibility:visible'>no</i></div>no</div>x", "x"),
        ("<ol><li style='visibility:hidden'>no<li>two</ol>", "2. two"),
        ("<p style='backface-visibility:hidden; --display:none'>seen", "seen"),
        ("", ""), (None, ""), ("   ", ""), ("<p></p><ul><li></ul>", ""),
    ],
)
def test_layout(html, text):
    assert ht.visible_text(html) == text.strip("\n")


def columns_of(text, starts):
    return [tuple(line[a:b].strip() for a, b in zip(starts, [*starts[1:], None])) for line in text.split("\n")]


def test_long_cells_wrap_within_their_column():
    prose = " ".join(f"word{i}" for i in range(60))
    got = ht.visible_text(f"<table><tr><td>k<td>{prose}<td>end<tr><td>kk<td>short<td>fin</table>")
    lines = got.split("\n")
    where = lines[0].index("end")
    assert where <= 4 + 80 + 2 and lines[-1].index("fin") == where and lines[-1].startswith("kk  short")
    assert " ".join(x[1] for x in columns_of(got, (0, 4, where))[:-1]) == prose
    url = "http://" + "x" * 200
    got = ht.visible_text(f"<table><tr><td>see {url} here<td>one<br>two<br>three<tr><td>a<td>b</table>").split("\n")
    assert [x.strip() for x in got if url in x] == [url] and got[0].startswith("see")
    at = got[0].index("one")
    assert [x[at:] for x in got if len(x) < 200 and x[at:]] == ["one", "two", "three", "b"]
    inner = "<table>" + "".join(f"<tr><td>{'r' * k}<td>{'s' * 50}<td>{'t' * 50}" for k in (1, 20)) + "</table>"
    got = ht.visible_text(f"<table><tr><td>nav<td>{inner}<td>side</table>").split("\n")
    assert got[0].startswith("nav  r ") and got[0].index("t" * 50) == got[1].index("t" * 50) and [x.strip() for x in got[2:]] == ["side"]
    pre = "a   b" + " " * 90 + "c"
    assert ht.visible_text(f"<table><tr><td>x<td><pre>{pre}\n</pre><td>y</table>") == f"x  {pre}\n     y"
    wide = ht.visible_text("<table><tr>" + f"<td>{prose}" * 60 + "<tr>" + "<td>c" * 60 + "</table>").split("\n")
    starts = [i for i, ch in enumerate(wide[-1]) if ch == "c"]
    assert len(starts) == 60 and max(map(len, wide)) <= 2000 and all(x[i - 1] == " " for x in wide for i in starts[1:] if i < len(x))
    assert sorted(w for x in wide[:-1] for w in x.split()) == sorted(prose.split() * 60)


def test_deep_and_long_pages_take_linear_time():
    n = 20_000
    assert ht.visible_text("<div>" * n + "x") == "x"
    assert ht.visible_text("<p><b>" * n + "x").strip() == "x"
    assert len(ht.visible_text("<ul><li>a" * 2000).split("\n")) == 2000
    assert ht.visible_text("<table><tr><td>" * 300 + "deep") == "deep"
    assert ht.visible_text("<a title=\"" + "x" * 10**6) == ""
    assert len(ht.visible_text("<p>" + "word " * 200_000)) == 10**6 - 1
    assert len(ht.visible_text("<table>" + "<tr>" + "<td>c" * 900 + ("<tr><td colspan=900>" + "w" * 5) * 300)) < 10**6


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "<p>a"), (3, "<p>a"), (None, "b"), (4, "<td>" * 1000)]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'x' AS text", "1 AS html2")
    got = sorted(((r.page_id or 0, r.text) for r in ht.extract(df).collect()))
    assert got == [(0, "b"), (1, ""), (2, ""), (3, "a"), (3, "a"), (4, "")]
    assert ht.extract(df.limit(0)).collect() == []
