import html as escapes

import pytest
from cases import prose
from pyspark.sql import functions as F

from roadwatch.llm.host_paths import host_of, main_text, winning_paths
from roadwatch.llm.page_blocks import parse

ARTICLE = ["A title &amp; more", "First   paragraph\n with <b>bold</b> and <a href='x'>a link</a>.", "Second &lt;one&gt;&nbsp;here."]
WANTED = "A title & more\n\nFirst paragraph with bold and a link.\n\nSecond <one> here."
NOISE = (
    "<nav><a href='/'>Home</a></nav><header><h2>Site</h2></header><aside>side</aside>"
    "<div class='sidebar-left'><p>more of the side</p></div><div id='cookie-notice'>We use cookies</div>"
    "<div class='ad'>Buy now</div><form><p>Mail <input></p><button>Go</button></form><script>var p = '<p>no</p>';</script>"
    "<style>p { margin: 0 }</style><!-- <p>hidden</p> --><noscript><p>no script</p></noscript>"
)
AFTER = "<section class='comments'><p>A reader's long comment, longer than the article itself. " + "x " * 300 + "</p></section><footer>&copy; us</footer>"


def page(body, tag="article"):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{NOISE}<{tag}>{body}</{tag.split()[0]}>{AFTER}</body></html>"


@pytest.mark.parametrize("tag", ["article", "main", "div class='content'", "section id='story'"])
def test_article_without_the_rest(tag):
    body = "".join(f"<{t}>{p}</{t}>" for t, p in zip(["h1", "p", "p"], ARTICLE, strict=True))
    assert parse(page(body, tag)).extract() == WANTED


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>open <b>bold<br>line<p>next<li>one<li>two", "open bold line\n\nnext\n\none\n\ntwo"),
        ("<p>cut off <a hre", "cut off"),
        ("<p>a < b &am", "a < b &am"),
        ("<p>x</p><script>never closed <p>y", "x"),
        ("<p>&#x41;&#66;&hellip;&unknown;</p>", "AB…&unknown;"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<nav><p>only links</p></nav>", ""),
        ("<body class='has-sidebar'><div class='no-ads'><p>kept</p></div>", "kept"),
        ("<div class='site-header'>x</div><div class='story-header'><h1>T</h1></div><p>text</p>", "T\n\ntext"),
        ("<div style='display: none'><p>gone</p></div><p>here</p>", "here"),
        ("<p>attribute <img alt='a > b'>with sign</p>", "attribute with sign"),
        ("</p>stray</div> ends", "stray ends"),
        ("<div>" * 100_000 + "deep" + "</b>" * 100_000 + "<p>er", "deep\n\ner"),
        ("<p title=it's>text</p><p>don't</p>", "text\n\ndon't"),
        ("<p title = 'a > b' class=\"x > y\">text</p>", "text"),
    ],
)
def test_odd_pages(source, text):
    assert parse(source).extract() == text


def frame_of(spark, rows):
    full = [(*r, "extra", "extra") for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, text string, host string")


def test_host(spark):
    urls = ["https://A.example.com:8080/x", "http://a.example.com?q", "nothing", None, "//x/y"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(host_of(F.col("url"))).collect()
    assert [r[0] for r in rows] == ["a.example.com:8080", "a.example.com", "", "", ""]


def test_consensus_corrects_a_page(spark):
    """A page whose unmarked box outweighs its article follows the other pages of its host."""
    normal = [
        (i, f"http://h.example/{i}", f"<body><div class='story'><p>{prose(i, 60, 1)}</p></div><div class='box'><p>short</p></div></body>")
        for i in range(20)
    ]
    odd = (99, "http://h.example/odd", f"<body><div class='story'><p>The story.</p></div><div class='box'><p>{prose(7, 300, 1)}</p></div></body>")
    alone = (100, "http://other.example/", odd[2])
    frame = frame_of(spark, [*normal, odd, alone])
    result = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    assert result[99] == "The story."
    assert result[100] == prose(7, 300, 1)
    rows = frame.select(host_of(F.col("url")).alias("host"), "html")
    winners = {r["host"]: r["paths"] for r in winning_paths(rows).collect()}
    assert winners["h.example"][0] == "html>body>div.story"


def test_pages_of_two_templates(spark):
    """A teaser on the most voted path does not stand for the article; pages without a host have no siblings."""

    def content(i):
        return f"<body><div class='content'><p>{prose(i, 60, 1)}</p></div></body>"

    def article(i):
        return f"<body><div class='content'><p>Teaser.</p></div><article><p>{prose(i, 60, 1)}</p></article></body>"

    rows = [(i, "http://h.example/", content(i) if i % 5 < 3 else article(i)) for i in range(20)]
    rows += [(100 + i, None, content(i)) for i in range(20)]
    rows += [(120, None, f"<body><div class='content'><p>Teaser.</p></div><div class='text'><p>{prose(120, 60, 1)}</p></div></body>")]
    result = {r["page_id"]: r["text"] for r in main_text(frame_of(spark, rows)).collect()}
    assert [result[i] for i in range(20)] == [prose(i, 60, 1) for i in range(20)]
    assert result[120] == prose(120, 60, 1)


LONG = prose(77, 200, 1)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (f"<body><h1>Title</h1><p>Lead</p><div><p>{LONG}</p></div></body>", f"Title\n\nLead\n\n{LONG}"),
        (f"<div><h1>Title</h1><p>Lead.</p><article><p>{LONG}</p></article></div>", f"Title\n\nLead.\n\n{LONG}"),
        (f"<div class='top'><h1>Title</h1></div><div class='text'><p>{LONG}</p></div>", f"Title\n\n{LONG}"),
        (f"<body><div><p>{LONG}</p></div><p>Last words.</p><p>&copy; 2020 us</p></body>", f"{LONG}\n\nLast words."),
        (f"<body><p><a href='/'>Home</a> <a href='/n'>News</a></p><article><p>{LONG}</p></article></body>", LONG),
        (f"<body><p>Far.</p><div class='box'><p>Box.</p></div><article><p>{LONG}</p></article></body>", LONG),
    ],
)
def test_heads_and_ends_come_with_the_article(spark, source, text):
    assert parse(source).extract() == text
    rows = [(i, "http://h.example/", source) for i in range(3)]
    assert [r["text"] for r in main_text(frame_of(spark, rows)).collect()] == [text] * 3


def test_strange_template_falls_back(spark):
    """A page of a template that its host has nowhere else keeps its article; a known loser stays out."""

    def normal(i):
        return f"<body><div class='story'><p>{prose(i, 60, 1)}</p></div><div class='box'><p>short</p></div></body>"

    rows = [(i, "http://h.example/", normal(i)) for i in range(30)]
    strange = f"<body><div class='story'><p>Teaser.</p></div><section class='long-read'><p>{LONG}</p></section></body>"
    loser = f"<body><div class='story'><p>The story.</p></div><div class='box'><p>{LONG}</p></div></body>"
    rows += [(100, "http://h.example/", strange), (101, "http://h.example/", loser)]
    frame = frame_of(spark, rows)
    result = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    assert [result[i] for i in range(30)] == [prose(i, 60, 1) for i in range(30)]
    assert result[100] == LONG and result[101] == "The story."
    host = winning_paths(frame.select(host_of(F.col("url")).alias("host"), "html")).first()
    assert host["paths"] == ["html>body>div.story"] and host["losers"] == ["html>body>div.box"]


def test_edge_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://x/", page("<p>a</p>")), (2, "http://x/", ""), (3, None, "<p>x")]
    result = main_text(frame_of(spark, rows))
    assert result.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in result.collect()), key=repr)
    assert got == sorted([(1, "", 0), (1, "", 0), (None, "a", 1), (2, "", 0), (3, "x", 1)], key=repr)
    assert main_text(frame_of(spark, rows).limit(0)).count() == 0


def test_given_pages(spark):
    """Every word of the given articles and nothing else."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)
        plain = escapes.unescape(re.sub(r"<[^>]*>|<[a-z/][^>]*$", " ", inside[1])) if inside else ""
        assert found[r["page_id"]].split() == plain.split()
