"""The page operators: archives by exact round trip, extraction on pages written by hand."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from slotledger.llm import html_text, warc

SCHEMA = "page_id long, url string, html string, size long, text string"
TRAP = "<p>x</p>\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 7\r\n\r\n" * 40


def pages() -> list[tuple]:
    long = "<p>" + "é word " * 400 + "</p>"
    out = [(1, "http://a.example/1", None), (2, None, ""), (3, "http://a.example/3 x\r\ny", "<p>short</p>"), (4, "u", "<p>short</p>"), (5, "u", TRAP)]
    out += [(k, "http://b.example/", long) for k in (10, 30, 20, 30)] + [(None, "u", long), (None, None, None), (7, "v", TRAP), (8, "w", "x" * 300_000)]
    return [(*r, 1, "other") for r in out]


@pytest.mark.parametrize("range_bytes", [97, 5000, 1 << 22])
def test_archives(spark, tmp_path, range_bytes):
    rows = pages()
    folder = f"file://{tmp_path}/warc"
    listed = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), folder)
    if range_bytes < 1000:  # tiny ranges over the small pages only
        listed = warc.write_archives(spark.createDataFrame(rows[:5], SCHEMA).coalesce(1), folder + "-small")
        rows, folder = rows[:5], folder + "-small"
    got = sorted((tuple(r) for r in warc.read_archives(folder, listed, range_bytes).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html").collect()), key=repr)
    largest: dict[str, int] = {}
    for r in rows:
        if r[0] is not None:
            largest[r[2] or ""] = max(largest.get(r[2] or "", r[0]), r[0])
    want = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        keeper = largest.get(html or "")
        again = len(data) >= warc.MIN_REVISIT_BYTES and keeper is not None and keeper != page_id
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None, None if again else html or ""))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("range_bytes", [70_000, 1 << 22])
def test_headers_of_any_length(spark, tmp_path, range_bytes):
    urls = ["http://a.example/" + "x" * n for n in (3, 100_000, 65_000, 400_000, 5)]
    rows = [(k, url, f"<p>page {k}</p>" + TRAP, 1, "t") for k, url in enumerate(urls)]
    folder = f"file://{tmp_path}/warc"
    listed = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    got = warc.read_archives(folder, listed, range_bytes).select("page_id", "url", "html").collect()
    assert sorted(map(tuple, got)) == [r[:3] for r in rows]


def test_damage_is_found(spark, tmp_path):
    listed = warc.write_archives(spark.createDataFrame(pages()[2:5], SCHEMA).coalesce(1), f"file://{tmp_path}/warc")
    file = next((tmp_path / "warc").glob("*.warc"))
    data = file.read_bytes()
    file.write_bytes(data.replace(b"Content-Length: 1", b"Content-Length: 2", 1))
    with pytest.raises(Exception):
        warc.read_archives(f"file://{tmp_path}/warc", listed).collect()


def test_candidates_in_payloads_are_not_reachable():
    data = warc.record(1, "u", TRAP.encode(), None, False) + warc.record(2, "u", b"x", None, False)
    found = {a: b for a, b, _ in warc.candidates(data, 0, 0, len(data))}
    assert len(found) > 10
    chain, at = [], 0
    while at < len(data):
        chain.append(at)
        at = found[at]
    assert at == len(data) and len(chain) == 2


CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a&amp;b &lt;i&gt; &eacute;&#233;&nbsp;c</p>", "a&b <i> éé c"),
    ("<body><nav>menu</nav><article><h1>T</h1><p>one <b>two</b>\n three<p>four</article><footer>f</footer>", "T\none two three\nfour"),
    ("<article><p>a<script>if (x<y) p('</p>')</script>b</p><!-- <p>no</p> --><style>p{}</style></article>x", "ab"),
    ("<main><p>m</p><aside>s</aside><div class='cookie-notice'>c</div><form><p>f</p></form></main><p>out", "m"),
    ("<div id=comments><p>c</p></div><p>body</p><div class=\"ad\">buy</div><header>h</header>", "body"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article><div class='a>b'>x</div><p>un<b>closed <i>tags</p><p>next", "x\nunclosed tags\nnext"),
    ("<p>a<br>b</p><p hidden>no</p>", "a b"),
]


CASES += [
    ("<article><p>teaser</p></article><div><p>the body of this page</p><p>goes on</p></div>", "teaser\nthe body of this page\ngoes on"),
    ("<main><p>the body of this page</p><article>card</article></main><article>teaser</article>", "the body of this page\ncard"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_site_templates_go(spark):
    def page(k: int) -> str:
        return f"<body><div class='x'>Site line <b>of all pages</b></div><p>Text number {k}.</p><p>End.</p></body>" if k != 3 else "<p>other</p>"

    rows = [(k, "https://Host.example:80/a", page(k), 1, "t") for k in range(8)] + [(100 + k, "https://few.example/", page(k), 1, "t") for k in range(3)]
    rows += [(200 + k, "https://copies.example/", page(0), 1, "t") for k in range(9)] + [(300, None, page(0), 1, "t"), (301, "no url", None, 1, "t")]
    out = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == len(rows)
    assert out[1].text == "Text number 1."  # the site's line and its ending stand on seven of eight pages
    assert out[3].text == "other"
    assert out[101].text == "Site line of all pages\nText number 1.\nEnd."  # too few pages to tell
    assert out[200].text == "Site line of all pages\nText number 0.\nEnd."  # copies of one page count once
    assert out[300].text and out[301].text == ""
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = warc.archive_and_read_back(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0


@pytest.mark.parametrize("broadcast", [html_text.BROADCAST_SUBTREES, 0])
def test_block_on_a_fifth_of_a_large_host(spark, monkeypatch, broadcast):
    monkeypatch.setattr(html_text, "BROADCAST_SUBTREES", broadcast)

    def page(k: int) -> str:
        # a copied story of which each copy changes another paragraph
        story = "".join(f"<p>story {j if j != k % 20 else f'changed {k}'}</p>" for j in range(20)) if k >= 170 else f"<p>Text number {k}.</p>"
        return f"<body><div><p>Site line</p></div>{'<div class=x><p>Closed on Monday</p></div>' if k % 5 == 0 else ''}<div>{story}</div><div><p>Page {k} ends</p></div></body>"

    rows = [(k, "https://large.example/", page(k), 1, "t") for k in range(200)] + [(1000, "https://other.example/", page(5), 1, "t")]
    out = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(out[k] == f"Text number {k}.\nPage {k} ends" for k in range(170))
    assert all(out[k].count("\n") == 20 for k in range(170, 200))
    assert out[1000] == "Site line\nClosed on Monday\nText number 5.\nPage 5 ends"


FILLER = "some more words of the article"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><p class='share-price'>A</p><p>{FILLER}</p></article>", f"A\n{FILLER}"),
        ("<body><div id='social-history'>B</div></body>", "B"),
        (f"<body><div class='article-header'><h1>T</h1></div><p>{FILLER}</p>", f"T\n{FILLER}"),
        (f"<article><div class='post-header'><h1>T</h1></div><p>{FILLER}</p></article>", f"T\n{FILLER}"),
        ("<p class='notice-board'>C</p>", "C"),
        (f"<div class='page-header'>menu</div><p>{FILLER}</p>", FILLER),
        (f"<p>{FILLER}</p><div class='cmt'>no</div><ol class='replies'><li>no</li></ol><div class='comment-list'>no</div>", FILLER),
        (f"<p>{FILLER}</p><div class='ad'>no</div><div class='cookie-banner'>no</div><div id='related-links'>no</div>", FILLER),
    ],
)
def test_names_of_parts(page, text):
    assert html_text.main_text(page) == text


# what a token is, as one pattern; it takes the square of the length on markup that is left open
PATTERN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{html_text.RAW})\b[^>]*>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|</(?P<end>[a-z][\w:-]*)[^>]*>|<(?P<tag>[a-z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<tag2>[a-z][\w:-]*)(?P<attrs2>[^>]*)>",
    re.S | re.I,
)


def plain_tokens(page):
    for t in PATTERN.finditer(page):
        if name := t["tag"] or t["tag2"]:
            yield t.start(), t.end(), "tag", name.lower(), t["attrs"] if t["tag"] else t["attrs2"]
        elif t["end"]:
            yield t.start(), t.end(), "end", t["end"].lower(), ""
        elif t["raw"]:
            yield t.start(), t.end(), "raw", t["raw"].lower(), t["inside"]
        else:
            yield t.start(), t.end(), "skip", "", ""


def test_tokens_of_odd_markup():
    rng = random.Random(1)
    bits = ["<", ">", "/", '"', "'", "!", "--", "<!--", "-->", "a", "script", "<script", "</script>", "<a ", "=", "x", " ", "<p>", "</p>", "<title>", "?", "</", '<b "', "\n"]
    for _ in range(20_000):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert list(html_text.tokens(page)) == list(plain_tokens(page)), page


@pytest.mark.parametrize(
    "bit",
    ["<script ", "<a ", '<a ">" ', '<a ">', "<!-- ", "<script>", "</script ", "<a '\"> ", "<p>word ", "<div>word ", "<b>word ", "<td>x</p>", "<li><b>x", "&amp;", "<"],
)
def test_a_megabyte_of_open_markup(bit):
    page = bit * ((1 << 20) // len(bit)) + "the end"
    begun = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begun < 12  # a second or two as a rule


@pytest.mark.parametrize(("first", "then"), [("<b>", "</i>"), ("<i><main><b>", "</i>"), ("<span>", "<p></p>"), ("<tbody>", "<li></li>"), ("<b>", "<p></b>")])
def test_deep_markup(first, then):
    begun = time.process_time()
    html_text.main_text(first * 40_000 + then * 40_000)
    assert time.process_time() - begun < 12
