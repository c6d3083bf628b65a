"""Main text of pages: given pages against a plain cut, and hand-made ones against their texts."""

import html
import re

import pytest
from planpulse.llm import queries
from planpulse.llm.htmltext import extract, main_text

SF = "/root/testdata/sf0.01"
A = "The committee met on Monday, and it heard three reports, of which two were accepted."
B = "Nobody asked for a vote, so the chair closed the meeting early, to general relief."
C = "A short end."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


CASES = {
    "menus and the rest go": (
        f"<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div id='cookie-notice'><p>We use cookies, {A}</p></div>"
        f"<div class=sidebar><p>{B}</p></div><main><h1>Title</h1><p>{A}</p><p>{C}</p></main>"
        f"<section id=comments><p>First! {A} {B}</p></section><footer>&copy; us</footer>", f"Title {A} {C}"),
    "plain containers": (f"<div class=top><a href=/1>One</a> <a href=/2>Two</a></div><div><p>{A}</p><p>{B}</p><p>{C}</p></div>"
                         f"<div><a href=/3>Next page</a></div>", f"{A} {B} {C}"),
    "siblings": (f"<h2>Head</h2><div><p>{A}</p><p>{B}</p></div><div><p>{B} {B}</p></div><p>{C}</p><p>link</p>",
                 f"Head {A} {B} {B} {B} {C}"),
    "references and white space": ("<article><p>a&nbsp;&amp;\n\t b&#8364;&lt;i&gt; <b>x</b>y<br>z</p></article>", "a & b€<i> xy z"),
    "open elements": (f"<article><p><b>{A}<br><p>{B}<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table></article>",
                      f"{A} {B} one two 1 2 3"),
    "own header": (f"<article><header><h1>Title</h1><p class=byline>by me</p></header><p>{A}</p></article>", f"Title {A}"),
    "menu in the article": (f"<article><p>{A}</p><ul><li><a href=1>x</a><li><a href=2>y</a><li><a href=3>z</a></ul></article>", A),
    "inline adverts": (f"<article><p>be<span class='ad'>BUY <b>now</b></span>fore {C}</p></article>", f"before {C}"),
    "not markup": ("<article><p>1 < 2, 3 <4 and a<3 </p></article>", "1 < 2, 3 <4 and a<3"),
    "quotes in attributes": (f"<article><p title='a>b' data-x=it's>{A}</p><p>it's</p></article>", f"{A} it's"),
    "a form around all": (f"<form><div><h1>T</h1><p>{A}</p></div><input><button>Go</button></form>", f"T {A}"),
    "forms": (f"<article><p>{A}</p><form><p>{B}</p></form></article>", A),
    "article comments": (f"<article><p>{A}</p></article><div class='post-comments'><article><p>{B} {B}</p></article></div>", A),
    "wrapper named by what it has": (f"<div class='wrap with-sidebar'><p>{A}</p></div>", A),
    "two column table": (f"<table><tr><td><a href=1>x</a><td><p>{A}</p><p>{B}</p></table>", f"{A} {B}"),
    "comment and cdata": (f"<article><!-- <p>no</p> --><p>{A}</p><![CDATA[x]]></article>", A),
    "no article": ("<nav><a href=1>x</a></nav>", ""),
    "text alone": ("just text", "just text"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    body, want = CASES[name]
    assert main_text(page(body)) == want


def test_cut_pages_and_odd_input():
    assert main_text(None) == main_text("") == main_text(" \n ") == main_text("<!-- open") == main_text("<script>x") == ""
    assert main_text(f"<article><p>{A}</p><p>cut &am") == f"{A} cut &am"
    assert main_text("<article><p>x</p><p class='") == "x"
    deep = "<div>" * 20_000 + f"<p>{A}" + "</div>" * 20_000
    assert main_text(deep) == A
    wide = "<article>" + "<p>word, " * 50_000 + "</article>"
    assert main_text(wide) == " ".join(["word,"] * 50_000)
    assert main_text("<b>" * 50_000 + "<i></b>" * 1000 + "x") == "x"


def plain(source):
    """The given pages hold one article element of headings and paragraphs: a cut by patterns."""
    part = source[source.index("<article>") + 9:source.index("</article>")]
    part = re.sub(r"</?b>", "", re.sub(r"</?(p|h1)>|<br>", " ", part))
    return " ".join(html.unescape(part).split())


def test_query_against_a_plain_cut(spark):
    out = {r.page_id: r for r in queries.QUERIES["op11_html_extraction"](spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(out) == len(given)
    for r in given:
        assert (out[r.page_id].url, out[r.page_id].text) == (r.url, plain(r.html))
        assert out[r.page_id].n_chars == len(plain(r.html))


def test_awkward_tables(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars date, `odd.name` int"
    rows = [(None, None, None, "x", None, 1), (1, "u", "", "x", None, 1), (2, "u", page(f"<p>{A}"), None, None, None)]
    out = extract(spark.createDataFrame(rows + rows[2:], schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in out.collect()) == [
        (0, None, "", 0), (1, "u", "", 0), (2, "u", A, len(A)), (2, "u", A, len(A))]
    assert extract(spark.createDataFrame([], schema)).collect() == []
