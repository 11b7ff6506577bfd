"""HTML extraction and derived WARC records."""

import base64
import glob
import gzip
import hashlib
import time
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import extract as X
from tidemark.llm import markup, warc

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if(a<b)write("</p><p>no")</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies on this page, do you agree to that?</div>
<div class="wrap"><article class="post-%d"><header><h1>Title &amp; more</h1><p class="byline">by someone</p></header>
<p>First   paragraph, caf&eacute; &#233;&#xe9;,
 with <b>bold</b> and <a href="x>y">a link</a>.<p>Second<br>paragraph without an end
<div class="ad-slot"><p>Buy this now, it is cheap and good and cheap</p></div><ul><li>one<li>two</ul>
<form><label>Mail</label><input><button>Go</button></form>
<section id="comments"><p>I like this text very much, thank you for it.</p></section></article>
<aside class="rail"><p>Other texts that you may like to read some day</p></aside></div>
<!-- <p>not shown</p> --><footer>&copy; all of us</footer></body></html>"""
TEXT = "Title & more\n\nFirst paragraph, café éé, with bold and a link.\n\nSecond paragraph without an end\n\none\n\ntwo"


def test_main_text_of_a_page():
    assert X.Scored(PAGE % 7).text(None) == TEXT


LONG = "The words of the article go on and on for a good while. " * 3


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # negated or longer names are none
        (f"<header><h1>Title</h1></header><div class='entry-content no-sidebar'><p>{LONG}</div>", LONG.strip()),
        (f"<article><p>{LONG}<section id='related-work'><p>Others did this.</section></article>", LONG + "\n\nOthers did this."),
        (f"<article><p>{LONG}<div class='overflow-hidden lg:hidden'>A table.</div></article>", LONG + "\n\nA table."),
        # headings and paragraphs
        (f"<article><p>{LONG}<h2 id='search-results'>Results</h2><p class='notice'>Mind this.</article>",
         LONG + "\n\nResults\n\nMind this."),
        (f"<article><p>{LONG}<h2 id='search' class='header'>Search</h2><p id='share'>Ask.</article>", LONG + "\n\nSearch\n\nAsk."),
        # ids made of headings
        (f"<main><p>{LONG}<section id='discussion'><h2>4.2. Discussion</h2><p>It holds.</section></main>",
         LONG + "\n\n4.2. Discussion\n\nIt holds."),
        (f"<main><p>{LONG}<div id='comments'><h2>Comments</h2><div class='comment'>Nice.</div></div></main>", LONG.strip()),
        (f"<main><p>{LONG}<div id='comments'><h2>Comments</h2><form>Name</form></div></main>", LONG.strip()),
        # most of a page's text
        (f"<body><h1>Title</h1><div class='search'><p>{LONG}</div><p>Short.</p></body>", LONG.strip()),
        (f"<div class='hidden'><p>{LONG}</div><p>Short.", LONG.strip()),
        (f"<main><div class='notice'><p>{LONG}</div><p>Short.</p></main>", LONG + "\n\nShort."),
        # unless the main text is marked elsewhere
        (f"<div class='cookie-consent'><p>{LONG}</div><article><p>The short article.</article>", "The short article."),
        (f"<article><p>The short article.<section id='comments'><p>{LONG}</section></article>", "The short article."),
        # names are still names
        *((f"<article><p>{LONG}<div class='{c}'>Left out.</div></article>", LONG.strip()) for c in (
            "ad", "ad-slot", "ad_300x250", "sidebar-left", "site-header", "related-posts", "relatedPosts", "sidebar2",
            "share-buttons x", "newsletter-signup", "search-form")),
    ],
)
def test_names_drop_nothing_else(source, text):
    squeezed = "\n\n".join(x.strip() for x in text.split("\n\n"))
    assert X.Scored(source).text(None) == squeezed


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def run(df):
    return X.extract(df, X.winners(X.votes(df)))


def test_hosts_agree_on_a_container(spark):
    body = "<html><body><div class='top-9'>{top}</div><div class='story-{i}'><p>{text}</p></div></body></html>"
    rows = [
        (i, f"https://www.a.example/{i}", body.format(i=i, top="Short line.", text=f"The story number {i} goes on for a good while. " * 4))
        for i in range(9)
    ]
    # one page of the host where the other container holds more text
    rows.append((9, "http://a.example:80/x", body.format(i=9, top="A long line that is no story. " * 6, text="The short story of this page. " * 4)))
    got = {r.page_id: r.text for r in run(frame(spark, rows)).collect()}
    assert got[9] == ("The short story of this page. " * 4).strip()
    assert all(got[i] == (f"The story number {i} goes on for a good while. " * 4).strip() for i in range(9))


def test_texts_in_several_elements_stay_whole(spark):
    part = "Part {} of text {} goes on for a good while. "
    a, b = ((part.format(k, "{i}") * 4).strip() for k in "AB")
    halves = f"<html><body><div class='page'><div class='text'>{a}</div><p>Between.</p><div class='text'>{b}</div></div></body></html>"
    rows = [(i, f"http://halves.example/{i}", halves.format(i=i)) for i in range(5)]
    # a host of single texts, one page of which has two
    one = f"<html><body><div class='list'><div class='text'>{a}</div></div></body></html>"
    two = f"<html><body><div class='list'><div class='text'>{a}</div><div class='text'>{b}</div></div></body></html>"
    rows += [(10 + i, f"http://single.example/{i}", (two if i == 4 else one).format(i=10 + i)) for i in range(5)]
    got = {r.page_id: r.text for r in run(frame(spark, rows)).collect()}
    for i in range(5):
        assert got[i] == f"{a}\n\nBetween.\n\n{b}".format(i=i)
        assert got[10 + i] == (f"{a}\n\n{b}" if i == 4 else a).format(i=10 + i)


def test_a_page_that_differs_from_its_template_loses_nothing(spark):
    """Text beside the winning container stays, however the parts compare."""
    usual = "<html><body><div class='wrap'><div class='text'><p>{a}</p></div></div><div class='foot'>{c}</div></body></html>"
    differs = "<html><body><div class='wrap'><div class='text'><p>{a}</p></div><div class='more'><p>{b}</p></div></div><div class='foot'>{c}</div></body></html>"
    line, rows, want = "Words of part {} of page {} go on for a while. ", [], {}
    for i in range(12):
        a, b = ((line.format(k, i) * n).strip() for k, n in (("A", 1 + i), ("B", 12 - i)))
        rows.append((i, f"http://w.example/{i}", (differs if i % 3 == 0 else usual).format(a=a, b=b, c="Short foot.")))
        want[i] = f"{a}\n\n{b}" if i % 3 == 0 else a
    # the foot outweighs the text of a page: still no part of it
    rows.append((20, "http://w.example/20", usual.format(a="A short text of the page.", b="", c="A long foot of the page. " * 9)))
    want[20] = "A short text of the page."
    assert {r.page_id: r.text for r in run(frame(spark, rows)).collect()} == want


def plain_version(source, known):
    """Own version: blocks whose path has more pages inside than outside the
    best container, without votes on containers."""
    own = X.Scored(source)
    best = own.best()
    if best is None:
        return ""
    inside = {i for i, _ in own._inside([best])}
    return "\n\n".join(t for i, t, _ in own.blocks if i in inside and known.get(own.path(i), 1) >= 0)


def test_given_pages_as_without_votes_on_containers(spark):
    """On the given pages each page's own container, without what its host has
    outside more often, is the whole text."""
    from collections import Counter

    from conftest import SF_MID

    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    rows = pages.select("page_id", "html", X.host_of(pages.url).alias("host")).collect()
    known: dict = {}
    for r in rows:
        own = X.Scored(r.html or "")
        if own.best() is not None:
            inside = {own.path(i) for i, _ in own._inside([own.best()])}
            all_ = {own.path(i) for i, _ in own._inside([0])}
            known.setdefault(r.host, Counter()).update({p: 1 if p in inside else -1 for p in all_})
    got = {r.page_id: r.text for r in run(pages).collect()}
    assert got == {r.page_id: plain_version(r.html or "", known.get(r.host, {})) for r in rows}


ODD = [
    (1, "http://h.example/1", PAGE % 1),
    (1, "http://h.example/1", PAGE % 1),
    (2, None, PAGE % 2),
    (None, "no url", PAGE % 3),
    (4, "http://h.example/4", None),
    (5, "http://h.example/5", ""),
    (6, "http://h.example/6", "just text, no markup & more"),
    (7, "http://h.example/7", "<nav>only a menu</nav>"),
    (8, "http://h.example/8", "<p>" + "long text " * 50_000),
]


def test_odd_pages(spark):
    from pyspark.sql import functions as F

    df = frame(spark, ODD)
    got = sorted(map(tuple, run(df).collect()), key=repr)
    more = df.withColumns({c: F.lit("x") for c in ("host", "text", "winner", "path", "score", "n_chars", "_html")})
    assert got == sorted(map(tuple, run(more).collect()), key=repr)
    text = {1: TEXT, 2: TEXT, None: TEXT, 4: "", 5: "", 6: "just text, no markup & more", 7: "", 8: ("long text " * 50_000).strip()}
    assert [(r[0], r[1], r[2], r[3]) for r in got] == sorted([(i, u, text[i], len(text[i])) for i, u, _ in ODD], key=repr)
    assert run(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p>a<p>b", "a\n\nb"),
        ("<p>x</p><!-->y<!--z-->w", "x\n\nyw"),
        ("a < b and c > d", "a < b and c > d"),
        ("<table><tr><td>c1<td>c2<tr><td>c3</table>", "c1\n\nc2\n\nc3"),
        ("<p>it's <b>don't</b> 'quoted > text'</p>", "it's don't 'quoted > text'"),
        ("<div><p title='a>b'>hey</p></div></p></b></div>tail", "hey\n\ntail"),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("x<br>y<br/>z &nbsp; &lt;b&gt; &amp &am", "x y z <b> & &am"),
        ("<p>İ<script>a</SCRIPT>b", "İb"),
        ("<!-- never closed <p>x", ""),
        ("<p>cut <a href='", "cut"),
    ],
)
def test_markup(source, text):
    assert X.Scored(source).text(None) == text


def test_hostile_markup_takes_linear_time():
    for source in ("<b" * 20_000, "<a href='" * 20_000, "<div>" * 2_000 + "deep", "<!--" * 20_000, "&" * 100_000, "<p x=\"" * 9_999 + ">"):
        began = time.time()
        X.Scored(source).text(None)
        assert time.time() - began < 20


def test_visible_text_keeps_everything_shown():
    assert markup.visible_text(PAGE % 1).startswith("Site name\nHome\nWe use cookies") and "not shown" not in markup.visible_text(PAGE % 1)


def response(body=b"<p>Hi there</p>", status="200 OK", kind="text/html; charset=utf-8", more=""):
    return f"HTTP/1.1 {status}\r\nContent-Type: {kind}\r\nX-Note: a\r\n  folded\r\n{more}\r\n".encode() + body


def test_derived_records_refer_to_their_source(spark):
    content = response("<p>é &amp; <script>x</script>b".encode())
    df = spark.createDataFrame([(1, "<urn:uuid:1>", "http://a/", "2020-01-01T00:00:00Z", content)],
                               "k int, record_id string, target_uri string, date string, content binary")
    meta, conv = sorted(warc.derive(df, "k").collect(), key=lambda r: r.record_type, reverse=True)
    digest = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert (meta.record_type, conv.record_type) == ("metadata", "conversion")
    assert meta.refers_to == conv.refers_to == "<urn:uuid:1>" and meta.record_id != conv.record_id
    assert conv.block == "é & b" and conv.block_digest == digest("é & b".encode()) and conv.content_length == len("é & b".encode())
    fields = dict(line.split(": ", 1) for line in meta.block.split("\r\n") if line)
    assert fields["source-header-x-note"] == "a folded" and fields["source-status"] == "HTTP/1.1 200 OK"
    assert fields["source-block-digest"] == digest(content) and fields["conversion-record-id"] == conv.record_id
    assert fields["source-payload-digest"] == digest(content.partition(b"\r\n\r\n")[2])


@pytest.mark.parametrize(
    ("content", "text"),
    [
        (response("Grüße".encode("latin-1"), kind="text/plain; charset=ISO-8859-1"), "Grüße"),
        (response("<meta charset=windows-1251><p>Привет".encode("cp1251"), kind="text/html"), "Привет"),
        (response(b"<p>a\xff", kind="text/html; charset=no-such"), "a�"),
        (response(b"\x89PNG", kind="image/png"), None),
        (response(status="404 Not Found"), None),
        (b"HTTP/1.1 200 OK\nA: b\n\n<p>bare line ends", "bare line ends"),
        (b"HTTP/1.1 200 OK\r\nA: b", None),
        (b"", None),
        (None, None),
    ],
)
def test_odd_responses(content, text):
    records = warc.derivatives("<urn:uuid:1>", "http://a/", None, content)
    assert records[0][0] == "metadata"
    assert [r[-1] for r in records[1:]] == ([] if text is None else [text])


def chunked(body, sizes=(3, 5, 100)):
    out = b""
    for n in (*sizes, len(body)):
        part, body = body[:n], body[n:]
        out += f"{len(part):x};x=y\r\n".encode() + part + b"\r\n" if part else b""
    return out + b"0\r\nTrailer: x\r\n\r\n"


HI = b"<p>Hi there, " + b"all of you " * 9
SAID = HI[3:].decode().strip()


@pytest.mark.parametrize(
    ("body", "more", "text"),
    [
        (gzip.compress(HI), "Content-Encoding: gzip", SAID),
        (gzip.compress(HI[:20]) + gzip.compress(HI[20:]), "Content-Encoding: x-gzip", SAID),
        (zlib.compress(HI), "Content-Encoding: deflate", SAID),
        (zlib.compress(HI)[2:-4], "Content-Encoding: deflate", SAID),
        (zstandard.compress(HI), "Content-Encoding: zstd", SAID),
        (chunked(HI), "Transfer-Encoding: chunked", SAID),
        (chunked(gzip.compress(HI)), "Content-Encoding: gzip\r\nTransfer-Encoding: chunked", SAID),
        (gzip.compress(zlib.compress(HI)), "Content-Encoding: deflate, gzip", SAID),
        (HI, "Content-Encoding: gzip", SAID),  # stored plain
        (HI, "Transfer-Encoding: chunked", SAID),
        (HI, "Content-Encoding: identity", SAID),
        (gzip.compress(HI)[:-9], "Content-Encoding: gzip", None),  # cut off: what it holds
        (HI, "Content-Encoding: br", ""),
        (b"\x1f\x8bno gzip", "Content-Encoding: gzip", ""),
    ],
)
def test_encoded_bodies(body, more, text):
    records = warc.derivatives("<urn:uuid:1>", "http://a/", None, response(body, more=more + "\r\nX-Empty:\r\n"))
    fields = dict(line.split(": ", 1) for line in records[0][-1].split("\r\n") if line)
    assert fields["source-header-x-empty"] == "" and fields["source-payload-digest"] == warc.digest(body)
    if text is None:
        assert SAID.startswith(records[1][-1]) and records[1][-1].startswith("Hi there")
    else:
        assert [r[-1] for r in records[1:]] == [text][: bool(text)]


def test_clashing_names_of_responses(spark):
    df = warc.responses(frame(spark, ODD))
    clash = df.withColumnsRenamed({"date": "captured"}).withColumns(
        {c: F.lit("extra") for c in ("record_type", "header", "block", "refers_to", "content_type")}).withColumnRenamed("captured", "date")
    plain = lambda x: sorted(map(repr, x.collect()))
    assert plain(warc.derive(clash, "page_id")) == plain(warc.derive(df, "page_id"))


def test_records_of_odd_pages_and_files(spark, tmp_dir):
    df = frame(spark, ODD)
    records = warc.derive(warc.responses(df), "page_id")
    rows = records.collect()
    assert sum(r.record_type == "metadata" for r in rows) == len(ODD)
    assert sum(r.record_type == "conversion" for r in rows) == sum(bool(r[2]) for r in ODD)
    assert warc.derive(warc.responses(df.limit(0)), "page_id").count() == 0
    warc.write(records, f"{tmp_dir}/out")
    seen = []
    for path in glob.glob(f"{tmp_dir}/out/part-*.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            size = int(fields["Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n" and warc.digest(rest[:size]) == fields["WARC-Block-Digest"]
            seen.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
            data = rest[size + 4 :]
    info = [x for x in seen if x[0] == "warcinfo"]
    assert len(info) == len({x[1] for x in info}) == len(glob.glob(f"{tmp_dir}/out/part-*.gz"))
    assert sorted(x for x in seen if x[0] != "warcinfo") == sorted((r.record_type, r.record_id, r.refers_to) for r in rows)
