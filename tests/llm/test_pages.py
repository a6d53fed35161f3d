from __future__ import annotations

import gzip
import html
import random
import re
import sys
from collections import Counter
from hashlib import sha256
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import sf_dir  # noqa: E402, F401

from eigenlake.llm import warc
from eigenlake.llm.html_text import extract_text, main_text
from eigenlake.llm.warc import page_digests, parse_records, read_records, read_transactions, write_archives

SCHEMA = "page_id long, url string, html string, text string, digest int"

MESSY = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h1>Site name</h1><p>Slogan, of the site.</p></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, as you know. Accept all of them, please.</p></div>
<div id=main><h1>Real&nbsp;title</h1><div class=content><p>First <b>paragraph</b>, with &lt;signs&gt; &amp;
more &eacute; text here.<p title="a > b">Second one; it is longer, and has <a href=x>a link</a> inside.
<ul><li>item one, which is long<li>item two</ul><!-- <p>hidden</p> --><blockquote>Quote.</blockquote></div>
<div class="sidebar"><p>Popular posts, here, are these.</p></div><form><p>Name, please.</p><input></form>
<section class="comments"><p>I like it, thanks a lot, really.</p></section></div>
<footer>c 2020, all rights reserved.</footer></body></html>"""


def test_messy_page():
    assert main_text(MESSY) == (
        "Real title First paragraph, with <signs> & more é text here. Second one; it is longer, and has a link inside. "
        "item one, which is long item two Quote."
    )


@pytest.mark.parametrize("root", ["article", "main"])
def test_short_blocks_inside_content_stay(root):
    prose = [f"Paragraph {i}, " + "with words, and more of them; " * 12 + "end." for i in range(7)]
    items, cells = [f"item{i:02d}" for i in range(12)], [f"{i} g" for i in range(12)]
    links = "".join(f"<li><a href=/{i}>Other {i}</a>" for i in range(12))
    table = "".join(f"<tr><td>{c}<td>{c}" for c in cells)
    body = "".join(f"<p>{p}</p>" for p in prose[:4]) + "<section><h2>Parts</h2><ul>" + "".join(f"<li>{i}" for i in items) + "</ul></section>"
    body += f"<p>{prose[4]}</p><table>{table}</table><p>{prose[5]}</p><ul class=more>{links}</ul><p>{prose[6]}</p>"
    want = [*prose[:4], "Parts", *items, prose[4], *[c for c in cells for _ in range(2)], prose[5], prose[6]]
    found = main_text(f"<html><body><ul><li>Home<li>News<li>Shop<li>Help<li>More</ul><{root}>{body}</{root}></body></html>")
    assert found.endswith(" ".join(want[1:])) and "Other 5" not in found and "Home" not in found


PROSE = [f"Paragraph {i}, " + "with words, and more of them; " * 12 + "end." for i in range(6)]
SITE = "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>{}<footer>All rights reserved, 2020.</footer>"


def paragraphs(texts):
    return "".join(f"<p>{text}</p>" for text in texts)


@pytest.mark.parametrize(
    "opening, closing",
    [
        ('<article class="search widget">', "</article>"),
        ('<main class="ad-free">', "</main>"),
        ('<main><div class="post comment-enabled">', "</div></main>"),
        ('<div class="page no-sidebar" id="SearchContent">', "</div>"),
        ('<form id="aspnetForm"><main>', "</main></form>"),
        ("<nav><ul><li><a href=/>Unclosed</a></li></ul><article>", "</article>"),
        ('<div class="widget"><article>', "</article></div>"),
        ('<div class="ad-layout-page">', "</div>"),
        ("<table><tr><td>", "</table>"),
    ],
)
def test_names_do_not_cost_an_article(opening, closing):
    found = main_text(f"<html><body class=search>{SITE.format(opening + paragraphs(PROSE) + closing)}</body></html>")
    assert found == " ".join(PROSE)


@pytest.mark.parametrize(
    "part",
    [
        '<div class="cookie-notice">{}</div>', '<div class="ad-slot">{}</div>', '<section id="reader-comments">{}</section>', "<aside>{}</aside>",
        '<div class="comments"><article class="comment">{}</article></div>', '<article class="comment">{}</article>', '<div id=shareButtons>{}</div>',
        '<div role="complementary">{}</div>', '<section class="related posts"><article>{}</article></section>', '<form class="x">{}</form>',
    ],
)
def test_side_parts_go(part):
    side = part.format("<p>We use this, as you know, for some things; please accept all.</p>" * 2)
    for opening, closing in (("<article>", "</article>"), ("<div id=main>", "</div>")):
        inside = opening + paragraphs(PROSE[:3]) + side + paragraphs(PROSE[3:]) + closing
        after = opening + paragraphs(PROSE) + closing + side
        for body in (inside, after):
            assert main_text(f"<html><body>{SITE.format(body)}</body></html>") == " ".join(PROSE), (body, opening)


def test_links_and_formulas_inside_an_article_stay():
    links = "".join(f"<li><a href=/{i}>Source {i}</a>" for i in range(4))
    body = f"<h2><a href=#a>A linked heading</a></h2><p>{PROSE[0]}</p><math><mi>x</mi><mo>+</mo><mn>1</mn></math><p>{PROSE[1]}</p><ul>{links}</ul><p>{PROSE[2]}</p>"
    found = main_text(f"<html><body>{SITE.format('<article>' + body + '</article>')}</body></html>")
    assert found == " ".join(["A linked heading", PROSE[0], "x + 1", PROSE[1], *[f"Source {i}" for i in range(4)], PROSE[2]])


def test_lists_and_tables_without_an_article_stay():
    table = "<table>" + "".join(f"<tr><th>row {i}<td>{i} g" for i in range(10)) + "</table>"
    items = "<ul>" + "".join(f"<li>thing {i}" for i in range(5)) + "</ul>"
    menu = "<ul class=more>" + "".join(f"<li><a href=/{i}>Other page {i}</a>" for i in range(9)) + "</ul>"
    body = f"<div id=story><p>{PROSE[0]}</p>{table}<p>{PROSE[1]}</p>{items}<p>{PROSE[2]}</p>{menu}</div>"
    want = [PROSE[0], *[t for i in range(10) for t in (f"row {i}", f"{i} g")], PROSE[1], *[f"thing {i}" for i in range(5)], PROSE[2]]
    assert main_text(f"<html><body>{SITE.format(body)}</body></html>") == " ".join(want)


def test_very_long_page():
    text = [f"Block {i}, of many; it goes on, as others do." for i in range(60_000)]
    assert main_text(f"<body><article>{paragraphs(text)}</article></body>") == " ".join(text)
    assert main_text(f"<body><article><p>{'word, ' * 500_000}</article></body>") == " ".join(["word,"] * 500_000)
    assert main_text("<div>" * 50_000 + "deep" + "</div>" * 50_000) in ("", "deep")


@pytest.mark.parametrize("source", [None, "", "<p>", "<script>x", "<!-- x", "<div", "<a b='", "&", "<nav>x</nav>"])
def test_broken_pages(source):
    assert isinstance(main_text(source), str)


def test_articles_of_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:h1|p)>", re.sub("<br>", " ", re.sub("</?b>", "", inner)))
        want = " ".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (want, len(want), r.url)


def test_rows_of_text(spark):
    rows = [(1, None, None, "x", 1), (None, "u", MESSY, "x", 1), (None, "u", MESSY, "x", 1), (2, "v", "", "x", 1)]
    found = extract_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 4 and sum(r.n_chars > 50 for r in found) == 2
    assert extract_text(spark.createDataFrame([], SCHEMA)).collect() == []


def pages(rng):
    shared = ["s" * 150, "ü" * 50, "t" * 99, "a\r\n\r\nWARC/1.1\r\nb" * 20]
    rows = [(i, f"http://h/{i} x", rng.choice([*shared, f"own {i} " + "é\n" * rng.randrange(200)]), "x", 1) for i in range(60)]
    return [*rows, (100, None, None, "x", 1), (101, "", "", "x", 1), (7, rows[7][1], rows[7][2], "x", 1), (None, "n", "s" * 150, "x", 1)]


def test_round_trip(spark, tmp_path):
    rows = pages(random.Random(3))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = page_digests(frame, str(tmp_path / "warc")).collect()
    first = {}
    for i, _, text, *_ in rows:
        data = (text or "").encode()
        first[data] = min(first.get(data, (True, 0)), (i is None, i or 0))
    want = Counter()
    for i, _, text, *_ in rows:
        data = (text or "").encode()
        again = len(data) >= 100 and first[data] != (i is None, i or 0)
        want[i, len(data), sha256(data).hexdigest(), "revisit" if again else "response", first[data][1] if again else None] += 1
    assert Counter(tuple(r) for r in found) == want


def test_files_and_nested_rows(spark, tmp_path):
    rows = pages(random.Random(4))[:20]
    path = str(tmp_path / "warc")
    write_archives(spark.createDataFrame(rows, SCHEMA), path)
    kinds = Counter()
    for file in (tmp_path / "warc").glob("part-*"):
        for headers, block in parse_records(memoryview(file.read_bytes())):
            kinds[headers["warc-type"]] += 1
            assert len(block) == int(headers["content-length"])
    assert kinds["request"] == kinds["metadata"] == kinds["response"] + kinds["revisit"] == 20
    nested = read_transactions(spark, path, payload=True).collect()
    assert len(nested) == 20
    texts = {(t or "").encode() for _, _, t, *_ in rows}
    for r in nested:
        assert r.request.record_id != r.metadata.record_id and r.main.record_id == r.capture
        if r.main.kind == "response":
            assert bytes(r.main.payload) in texts and sha256(bytes(r.main.payload)).hexdigest() == r.main.payload_digest
    lost = read_records(spark, path).where("kind <> 'request'")
    assert lost.count() == 40


def test_files_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    monkeypatch.setattr(warc, "LEAST_RECORDS", 64)
    rng = random.Random(5)
    rows = [(i, f"http://h/{i}", f"{i} " + "x" * rng.choice([0, 100, 5000, 60_000, 400_000, 3_000_000 if i % 40 == 0 else 9]), "x", 1) for i in range(160)]
    path = tmp_path / "warc"
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(2), str(path))
    sizes = [file.stat().st_size for file in path.glob("part-*")]
    large = sum(len(text) > 1 << 20 for _, _, text, *_ in rows)
    assert sum(size > 1 << 20 for size in sizes) == large and len(sizes) < 400
    found = read_transactions(spark, str(path)).collect()
    assert sorted((int(r.metadata.fields["pageId"]), r.main.payload_bytes) for r in found) == [(i, len(t)) for i, _, t, *_ in rows]


@pytest.mark.parametrize("members", ["record", "whole", "uneven"])
def test_gzip_members(spark, tmp_path, members, monkeypatch):
    monkeypatch.setattr(warc, "PIECE_BYTES", 100)
    rows = pages(random.Random(6))[:30]
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "plain"))
    data = b"".join(file.read_bytes() for file in sorted((tmp_path / "plain").glob("part-*")))
    cuts = {"whole": [], "uneven": list(range(700, len(data), 700))}.get(members)
    if cuts is None:
        cuts, at = [], 0
        for _, block in parse_records(memoryview(data)):
            at = data.index(bytes(block), at) + len(block) + 4
            cuts.append(at)
    edges = sorted({0, *cuts, len(data)})
    (tmp_path / "packed").mkdir()
    (tmp_path / "packed" / "a.warc.gz").write_bytes(b"".join(gzip.compress(data[a:b]) for a, b in zip(edges, edges[1:])))

    def content(name):
        return sorted((r.kind, r.record_id, r.capture, r.payload_digest, r.payload_bytes) for r in read_records(spark, str(tmp_path / name)).collect())

    assert content("packed") == content("plain") and len(content("plain")) == 90
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc.gz").write_bytes(gzip.compress(data)[:-20])
    with pytest.raises(Exception, match="gzip member"):
        content("cut")


def test_no_pages(spark, tmp_path):
    assert page_digests(spark.createDataFrame([], SCHEMA), str(tmp_path / "none")).collect() == []


def test_long_http_heads(spark, tmp_path):
    body = b"the body\r\n\r\nof it"

    def archive(name, block):
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Length: {len(block)}\r\n\r\n"
        path = tmp_path / name
        path.mkdir()
        (path / "part-0").write_bytes(head.encode() + block + b"\r\n\r\n")
        return read_records(spark, str(path))

    found = archive("long", b"HTTP/1.1 200 OK\r\nX-Long: " + b"x" * 70_000 + b"\r\n\r\n" + body).collect()
    assert [(r.payload_bytes, r.payload_digest) for r in found] == [(len(body), sha256(body).hexdigest())]
    with pytest.raises(Exception, match="no end of the HTTP headers"):
        archive("none", b"HTTP/1.1 200 OK\r\n").collect()
