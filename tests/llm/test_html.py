"""Rendering of HTML."""

import random
import re
from html.parser import HTMLParser

import pytest

from kpitide.llm import html_text
from tests.compare import DATA

CASES = {
    "<p>a  b<p>c": "a b\n\nc",
    "<div>a</div><div>b<span> c</span></div>": "a\nb c",
    "<head><title>t</title><style>p{}</style></head><body>x<script>y</script>": "x",
    "<ul><li>a<li>b<ol><li>c</li><li>d</ol></ul>e": "- a\n- b\n  1. c\n  2. d\n\ne",
    "<table><tr><td>a<td>long cell<tr><th>bbbb<td>c</table>": "a     long cell\nbbbb  c",
    "<p>a<br>b</p><pre>\n x\n  y</pre>": "a\nb\n\n x\n  y",
    "<p hidden>a</p><p style='display: none'>b</p><p>c <i style=\"visibility:hidden\">d</i>e": "c e",
    "a &lt; b &amp; c&nbsp;d < e <!-- f --> <g>h": "a < b & c\xa0d < e h",
    "<dl><dt>a<dd>b<dt>c<dd>d</dl>": "a\n    b\nc\n    d",
    "<b>x</b>y <table><tr><td>1<table><tr><td>2</table></table>z": "xy\n\n1\n\n2\n\nz",
    "": "",
    "<p": "",
}


@pytest.mark.parametrize("html", CASES)
def test_cases(html):
    assert html_text.render(html) == CASES[html]


FOUND_CASES = {
    "<html><head><title>t</title><p>Hello": "Hello",
    "<html><head><meta charset=x><link rel=y>\n <style>p{}</style><h1>a</h1>b": "a\n\nb",
    "<head><title>t</title>\n text <b>c</b>": "text c",
    "<head>&nbsp;a": "\xa0a",
    "<head><script>x</script><table><tr><td>a</table>": "a",
    "<head><noscript><img src=x>no</noscript><template><p>t</p></template><div>a</div>": "a",
    "<head><title>t</title><head><html><meta x><body>a<head>b": "ab",
    "<p title=Bob's>a</p><p title=it's>b</p>": "a\n\nb",
    "<p title=5\"6>a</p> b > c": "a\n\nb > c",
    "<a href=x/ title = 'a > b' data-'>c</a>d": "cd",
    "<p title='x' style='display:none'>a</p><p title=x'y style=display:none>b</p>c": "c",
    "<div style='visibility:hidden'>a<p style='visibility: visible'>b</p>c</div>d": "b\n\nd",
    "<table style='visibility:hidden'><tr><td>a<td><i style='visibility:visible'>b</i></table>": "  b",
    "<div hidden>a<p style='visibility:visible'>b</p></div>c": "c",
    "<p style='backface-visibility:hidden'>a</p>": "a",
    "<p style='color:red' style='display:none'>a</p>": "a",
}


@pytest.mark.parametrize("html", FOUND_CASES)
def test_head_attribute_and_visibility_cases(html):
    assert html_text.render(html) == FOUND_CASES[html]


def test_open_quotes_take_no_long_time():
    assert html_text.render("<p " + "a='b' c=d'e " * 50_000 + ">x") == "x"
    assert html_text.render("<p>x" + "<a b=c " * 50_000) == "x"


def test_depth_and_length():
    assert html_text.render("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert html_text.render("<table><tr><td>" * 300 + "x").strip() == "x"
    assert len(html_text.render("<p>word " * 50_000).split()) == 50_000


class Plain(HTMLParser):
    """All text outside what is never shown, by the library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style") and not (tag != "head" and self.skip)

    def handle_endtag(self, tag):
        if tag == "head" or (tag in ("script", "style") and self.skip and not self.in_head):
            self.skip = max(0, self.skip - 1)

    in_head = False

    def handle_data(self, data):
        if not self.skip:
            self.words += data.split()


def test_pages_keep_their_words(spark):
    pages = spark.read.parquet(str(DATA / "sf0.001" / "pages.parquet"))
    texts = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        plain = Plain()
        plain.feed(r.html[r.html.index("</head>") :] if "</head>" in r.html else r.html)
        plain.close()
        shown = [w for w in texts[r.page_id].split() if w != "-"]
        assert "".join(shown) == "".join(w for w in plain.words if w != "-")


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (2, "<p>x", "u")], "page_id bigint, html string, text string")
    assert sorted((r.page_id, r.text) for r in html_text.extract(df).collect() if r.text is not None) == [(2, ""), (2, "x")]
    assert html_text.extract(df.limit(0)).count() == 0


def plain_grid(rows):
    """Column of each cell, by marking every place a cell takes."""
    taken, columns = set(), {}
    for r, row in enumerate(rows):
        for name, across, down in row:
            c = 0
            while (r, c) in taken:
                c += 1
            columns[name] = c
            taken |= {(y, x) for x in range(c, c + across) for y in range(r, r + down)}
    return columns


@pytest.mark.parametrize("seed", range(8))
def test_cells_with_spans_stand_in_their_columns(seed):
    rng = random.Random(seed)
    rows = [[(f"r{r}c{c}" + "x" * rng.randrange(9), rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 1, 2, 3])) for c in range(rng.randrange(1, 6))] for r in range(7)]
    html = "<table>" + "".join("<tr>" + "".join(f'<td colspan={a} rowspan="{d}">{n}</td>' for n, a, d in row) for row in rows) + "</table>"
    lines = html_text.render(html).split("\n")
    assert len(lines) == len(rows)
    columns, begins = plain_grid(rows), {}
    for r, row in enumerate(rows):
        for name, _, _ in row:
            begins.setdefault(columns[name], set()).add((" " + lines[r] + " ").index(f" {name} "))
    assert all(len(at) == 1 for at in begins.values())
    order = [min(begins[c]) for c in sorted(begins)]
    assert order == sorted(order) and len(set(order)) == len(order)


def test_odd_spans():
    assert html_text.render("<table><tr><td colspan=0>a<td colspan=x>b<td rowspan=0>c<tr><td>1<td>2<tr><td>3<td>4<td>5</table>") == "a  b  c\n1  2\n3  4     5"
    assert html_text.render("<table><tr><td colspan=999999>a<td>b<tr><td>c</table>").split() == ["a", "b", "c"]


@pytest.mark.parametrize(
    "page",
    [
        "<blockquote>a" * 77_000,
        "<ul><li>a" * 100_000,
        "<table><tr><td>" + "x " * 20_000 + "<td>b" + "<tr><td>a<td>b" * 70_000,
        "<table><tr>" + ("<td>" + "w" * 119) * 200 + ("<tr>" + "<td>" * 199 + "a") * 1_200,
        "<table><tr>" + "<td rowspan=60000>" * 190 + "<tr><td>a" * 100_000,
    ],
)
def test_text_grows_in_proportion_to_the_page(page):
    out = html_text.render(page)
    assert len(out) < 50 * len(page)
    assert sorted(out.replace(" ", "").replace("\n", "").replace("-", "")) == sorted(re.sub(r"<[^>]*>|\s", "", page))


def test_what_is_shown_and_what_is_not():
    html = '<p style="display:none;display:block">s</p><p style="display:block; display: none">t</p><dialog>no</dialog><dialog open>yes</dialog><ruby>x<rp>(</rp><rt>y</rt><rp>)</rp></ruby>'
    assert html_text.render(html) == "s\n\nyes\nxy"
