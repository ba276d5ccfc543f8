from __future__ import annotations

import time
import base64
import hashlib
from collections import defaultdict

import pytest

from llm.conftest import sorted_rows
from tableferry.llm import archives, host_reputation, site_templates

SHA1 = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()

PAGES = [
    (1, "http://a.example.com/x y?q=1#f", "<p>Hello</p>"),
    (2, "http://a.example.com/2", "<p>Hello</p>"),
    (3, None, None),
    (4, "no scheme", ""),
    (4, "no scheme", ""),
    (5, "https://b.example.org/é", "<p>é\r\n\r\nWARC/1.0\r\n\n2 0 x\n</p>" * 50),
    (6, "https://b.example.org/", "x" * 300_000),
    (None, "https://b.example.org/n", "<p>Hello</p>"),
]


# --- archives --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("records", [1_000, 3])
def test_round_trip(pages, monkeypatch, records):
    monkeypatch.setattr(archives, "RECORDS", records)
    found = sorted_rows(archives.round_trip(pages(PAGES)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    groups = defaultdict(list)
    for page, _, html in PAGES:
        groups[(html or "").encode()].append(page)
    expected = []
    for payload, members in groups.items():
        last = max(m for m in members if m is not None)
        first = True
        for m in members:
            response = m == last and first
            first &= m != last
            expected.append((m, len(payload), SHA1(payload), "response" if response else "revisit", None if response else last))
    assert found == sorted(expected, key=repr)


def test_least_bytes(pages):
    found = sorted_rows(archives.round_trip(pages([(1, "u://a/", ""), (2, "u://a/", None), (3, "u://a/", "xyz"), (4, "u://a/", "xyz")]), 1), "page_id", "record_type", "refers_to")
    assert found == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_archives_of_an_empty_table(pages):
    assert archives.round_trip(pages([])).count() == 0


def test_arc_versions():
    one = b"filedesc://x 0.0.0.0 19970101000000 text/plain 76\n1 0 Alexa\nURL IP-address Archive-date Content-type Archive-length\n          \n"
    body = one.split(b"\n", 1)[1]
    one = b"filedesc://x 0.0.0.0 19970101000000 text/plain %d\n" % len(body) + body
    two = b"2 0 Alexa\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    two = b"filedesc://y 0.0.0.0 19970101000000 text/plain 200 - - 0 y.arc %d\n" % len(two) + two
    data = one + b"\nhttp://a/b c 1.2.3.4 19970102 text/html 5\nab\ncd\n\n" + two + b"\nhttp://d/ 1.2.3.4 19970103000000 text/html 404 xx - 7 y.arc 0\n\n"
    got = [(h["URL"], h["Archive-date"], h.get("Result-code"), b) for _, h, b in archives.parse_arc(data)]
    assert got == [("http://a/b c", "19970102", None, b"ab\ncd"), ("http://d/", "19970103000000", "404", b"")]
    with pytest.raises(ValueError):
        list(archives.parse_arc(data[:-60] + b"http://d/ 1.2.3.4 19970103000000 text/html 404 xx - 7 y.arc 99\nshort"))


def test_warc_dates_and_damage():
    assert archives._warc_date("19970102") == "1997-01-02T00:00:00Z"
    record = archives._warc([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], b"block")
    assert [b for _, b in archives.parse_warc(record + b"\r\n\r\n" + record + b"\r\n\r\n")] == [b"block"] * 2
    with pytest.raises(ValueError):
        list(archives.parse_warc(record.replace(b"block", b"blick")))


# --- url filter ------------------------------------------------------------------------------------------------------

URLS = [
    ("https://WWW.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
    ("http://m.example.com/en/a/b", "m.example.com", "/en/a/b", "example.com/en/", "block"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://example.com?x=/en/", "example.com", "", None, "allow"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("ftp://a.net/fr/#", "a.net", "/fr/", "net/fr/", "block"),
    ("x://a.net/de/?y://b.com/", "a.net", "/de/", None, "allow"),
    ("http://", "", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_hosts_paths_and_rules(pages):
    rows = [(i, u[0], "<p>" + "word " * 60 + "</p>") for i, u in enumerate(URLS)] + [(0, URLS[0][0], None)]
    found = host_reputation.judge(pages(rows)).orderBy("page_id", "host").collect()
    expected = [(i, *u[1:]) for i, u in enumerate(URLS)]
    expected.insert(0, expected[0])
    assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found] == expected
    assert host_reputation.judge(pages([])).count() == 0


def test_reputation_shrinks_small_hosts(spark, pages):
    bad = [("bad.x.org", i, 1) for i in range(60)] + [("one.x.org", 0, 1)] + [("fine.y.org", i, int(i < 2)) for i in range(200)] + [("z.com", i, 0) for i in range(50)]
    labelled = spark.createDataFrame([(h, b) for h, _, b in bad] + [(None, 1), ("q.com", None)], "host string, bad long")
    rates = {r.host: r for r in host_reputation.reputations(labelled).collect()}
    assert set(rates) == {"bad.x.org", "one.x.org", "fine.y.org", "z.com"}
    assert rates["bad.x.org"].low > 0.5 > rates["fine.y.org"].rate and rates["one.x.org"].rate < rates["bad.x.org"].rate
    rows = [(1, "http://bad.x.org/", ""), (2, "http://fine.y.org/", ""), (3, "http://unseen.org/", "")]
    assert dict(sorted_rows(host_reputation.judge(pages(rows), labelled), "page_id", "verdict")) == {1: "block", 2: "allow", 3: "allow"}
    assert host_reputation.reputations(labelled.limit(0)).count() == 0


# --- main text -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b<br>c", "a\nb c"),
        ("<nav>m</nav><article><h1>T</h1><p>x &amp; <b>y</b>z</p></article><footer>f</footer>", "T\nx & yz"),
        ("<header>s</header><main><article><header><h1>T</h1></header><p>x</p></article></main>", "T\nx"),
        ("<article><p>x</p><div class='ad-box'>buy</div><section id=comments><p>c</p></section><form>f</form></article>", "x"),
        ("<div class=cookie-notice>c</div><p>x</p><aside>a</aside><p>y</p><div hidden>h</div>", "x\ny"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><p title='a>b'>q</p><!-- <p>no</p> -->", "q"),
        ("<p>a  \n\t b&nbsp;c</p><p> </p><ul><li>1<li>2</ul>tail", "a b c\n1\n2\ntail"),
        ("<article><p>open <b>x<br><p>next</article>", "open x\nnext"),
        ("<div>" * 5_000 + "deep", "deep"),
        ("<p>" + "long " * 50_000 + "</p>", ("long " * 50_000).strip()),
        ("a < b and c > d <", "a < b and c > d <"),
    ],
)
def test_extract(html, text):
    assert site_templates.extract(html) == text


def test_templates_are_found_by_counting(pages):
    menu = lambda i: f"<div class=x1><ul><li><a href=/{i}>Link {i}</a></li><li><a href=/q>Other</a></li></ul></div>"
    page = lambda i: f"<body><div class=x0>Welcome to the site</div>{menu(i)}<div class=x2><p>Story {i}</p><p>Shared by all</p></div></body>"
    marked = lambda i: f"<article><p>Story {i}</p><p>Shared by all</p></article><div>Welcome</div>"
    rows = [(i, "http://a.com/1", page(i)) for i in range(20)] + [(100 + i, "http://b.com/1", marked(i)) for i in range(20)]
    rows += [(200 + i, "http://few.com/1", page(i)) for i in range(3)] + [(300, None, None)]
    got = {r.page_id: (r.text, r.n_chars) for r in site_templates.main_text(pages(rows)).collect()}
    assert got[3] == ("Story 3", 7)
    assert got[103][0] == "Story 3\nShared by all"
    assert got[201][0] == "Welcome to the site\nLink 1\nOther\nStory 1\nShared by all"
    assert got[300] == ("", 0)
    assert site_templates.main_text(pages([])).count() == 0


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "</b>" * 100_000, "<b>" * 100_000, "<li><p>" * 50_000, '<a b="' * 100_000, "a>" + "<b" * 100_000, "<article>" * 50_000 + "x"],
    ids=["unmatched", "nested", "list", "quotes", "unended", "articles"],
)
def test_long_misshapen_pages_are_parsed_in_one_pass(page):
    started = time.monotonic()
    site_templates.extract(page, frozenset([1]))
    assert time.monotonic() - started < 20  # some minutes if each tag looked at all that are open


def test_visible_words(spark):
    cases = {
        "one <b>two</b> three": 3,
        "<head><title>no</title></head><body>a b<nav>c d</nav> e</body>": 3,
        "a <script>if (a < b) x</script > b": 2,
        "a <nav> b c": 3,  # left open: its text is seen
        "a <!-- b <i>c</i> --> d": 2,
        "a <!-- b": 3,
        "a<header>b</header>": 2,
        "<FOOTER class=x>a</footer>b": 1,
        "": 0,
        " a > b ": 3,
    }
    frame = spark.createDataFrame([(html, n) for html, n in cases.items()], "html string, n int")
    found = host_reputation.visible_words(frame, frame["html"]).collect()
    assert {r.html: r.words for r in found} == cases


def test_visible_words_of_long_open_markup(spark):
    frame = spark.createDataFrame([("<nav> a " * 100_000,), ("<!-- a " * 50_000,), ("<script" * 100_000,)], "html string")
    assert [r.words for r in host_reputation.visible_words(frame, frame["html"]).collect()][0] == 100_000


def test_outcomes_of_long_pages_in_files(spark, tmp_path):
    """Read from files, where Spark may merge the steps of a projection."""
    rows = [(1, "http://a.b/", "<nav> a " * 40_000), (2, "http://a.b/", "<p>x</p> " * 40_000), (3, "http://a.b/", "few")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages")
    started = time.monotonic()
    found = host_reputation.outcomes(spark.read.parquet(f"{tmp_path}/pages")).collect()
    assert sorted(r.bad for r in found) == [0, 0, 1] and time.monotonic() - started < 60
