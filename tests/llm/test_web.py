import base64
import hashlib
import random
import time
from collections import Counter

import pytest

from earshot.llm.page_text import closeness, extract_text, main_text, page_lines, shared_lines
from earshot.llm.warc import captured_pages, captures, parse_archive, read_warc, write_warc

PAGES = "page_id bigint, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(pages, min_bytes=0):
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        payload = (h or "").encode()
        to = first.get(h or "") if len(payload) >= min_bytes else None
        again = to is not None and to != i
        out.append((i, len(payload), digest(payload), "revisit" if again else "response", to if again else None))
    return Counter(out)


ODD = [
    (4, "http://a.b/c\r\nX: y", None),
    (2, None, ""),
    (3, "u", "é\r\n\r\nWARC/1.1\r\n"),
    (9, "u2", "é\r\n\r\nWARC/1.1\r\n"),
    (9, "u2", "é\r\n\r\nWARC/1.1\r\n"),
    (None, "u2", "q"),
    (None, "u3", "q"),
    (1, "http://h/" + "p" * 3000, "x" * 200_000),
    (7, "http://h:80/ä ö?q=1", "\0\x01\n"),
]


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_round_trip(spark, tmp_path, min_bytes):
    pages = spark.createDataFrame(ODD, PAGES).selectExpr("*", "'x' AS digest")
    write_warc(pages, str(tmp_path / "w"), min_bytes)
    found = captured_pages(captures(read_warc(spark, str(tmp_path / "w"))))
    assert Counter(map(tuple, found.collect())) == expected(ODD, min_bytes)


def test_captures_are_whole(spark, tmp_path):
    write_warc(spark.createDataFrame(ODD[:4], PAGES), str(tmp_path / "w"), records_per_file=3)
    found = captures(read_warc(spark, str(tmp_path / "w"))).collect()
    payloads = {int(r.metadata.fields["page-id"]): r.response.payload for r in found}
    assert payloads[3] == ODD[2][2].encode() and payloads[4] is None and payloads[2] == b""
    assert all(r.request.request_block.startswith("GET ") for r in found)
    main = {int(r.metadata.fields["page-id"]): r for r in found}
    assert main[9].response.refers_to == main[3].record_id and main[4].response.refers_to == main[2].record_id
    assert len(list((tmp_path / "w").glob("*.gz"))) >= 2


def test_no_pages(spark, tmp_path):
    write_warc(spark.createDataFrame([], PAGES), str(tmp_path / "w"))
    assert captures(read_warc(spark, str(tmp_path / "w"))).count() == 0


def test_broken_archives_fail(spark, tmp_path):
    with pytest.raises(ValueError, match="cut off"):
        list(parse_archive(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    with pytest.raises(ValueError, match="no WARC record"):
        list(parse_archive(b"HTTP/1.1 200 OK\r\n\r\n"))


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<nav>a<div>b</div></nav><article>Hi <b>x</b><br>y<p>z\n  w</article><footer>f", ["Hi x y", "z w"]),
        ("<article><h1>T</h1><p>one<p>two<div class='comments'><div>c</div>d</div><p>three", ["T", "one", "two", "three"]),
        ("<nav>never closed<article><p>text</article>", ["text"]),
        ('<script>var t="</p>"</script><style>p{}</style><!-- <p>no --><p>yes<!-- open', ["yes"]),
        ("<p>a &lt; b &nbsp; c</p><p cut", ["a < b c"]),
        ("<article>a<form>f</form>b<article>c</article>d</article>", ["a", "b", "c", "d"]),
        ('<div class="content has-sidebar"><p>body</p></div>', ["body"]),
        ('<div class="site-header">menu</div><div class="sidebar">body of the page, most of its text</div>', ["body of the page, most of its text"]),
        ('<article>one<div class="search-results">two</div><p id="comments-on-law">three</p></article>', ["one", "two", "three"]),
        ('<article><p>a long enough body<p class="notice">n<p>b</article>', ["a long enough body", "b"]),
        ('<article>a long enough body<ul><li class="nav">n<ul><li>x</ul>y<li>b</ul>c</article>', ["a long enough body", "b", "c"]),
        ('<article>a long enough body<table><tr><td class="ad">n<td>b<tr><td>c</table>d</article>', ["a long enough body", "b", "c", "d"]),
        ('<article>a<b data-id="nav">b</b><i title="x>y">c</i></article>', ["abc"]),
        ('<p>a</p><p title="never closed>b</p><p>c</p>', ["a", "b", "c"]),
    ],
)
def test_blocks(page, lines):
    assert main_text(*page_lines(page), None) == "\n\n".join(lines)


@pytest.mark.parametrize("part", ["<x\"", "<x'", "<x ", "<", "</", "<!--", "<script ", '<p class="ad">', "<div class='nav'>x", "class=", '<b class="', "</script "])
def test_broken_pages_take_time_in_proportion(part):
    start = time.perf_counter()
    page_lines(part * (1_000_000 // len(part)) + '"')
    assert time.perf_counter() - start < 5


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = random.Random(1)
    for _ in range(200):
        a, b = (["l" + draw.choice("abcd") for _ in range(draw.randint(0, 12))] for _ in range(2))
        shared = sorted(shared_lines(a, b))
        rest = iter(b)
        assert len(shared) == lcs(a, b) and all(any(a[i] == y for y in rest) for i in shared)


def test_nearest_page_tells_the_template(spark):
    def page(text):
        return f"<div>Site name</div><div>Welcome back</div><p>{text}</p><div>Imprint</div>"

    pages = [(1, "http://h/a/1", page("first")), (2, "http://h/a/2", page("second")), (3, "http://other/", page("alone"))]
    pages += [(4, None, None), (5, "http://h/b", "<article>kept</article><div>Site name</div>"), (5, "http://h/b", "<article>kept</article><div>Site name</div>")]
    found = extract_text(spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS lines").coalesce(1))
    texts = sorted((r.page_id, r.text, r.n_chars) for r in found.collect())
    alone = "Site name\n\nWelcome back\n\nalone\n\nImprint"
    assert texts == [(1, "first", 5), (2, "second", 6), (3, alone, len(alone)), (4, "", 0), (5, "kept", 4), (5, "kept", 4)]
    assert extract_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("parts", [2, 7, 40])
def test_neighbours_in_other_tasks_and_by_segments(spark, parts):
    """The nearest page of the host, the former on a tie, wherever the tasks begin and end."""
    draw = random.Random(parts)
    places = [(f"h{draw.randrange(3)}", draw.choice(["/a/b", "/a/b-x", "/a/b/c", "/a/b/d", "/a.c/d", "/", "/e"])) for _ in range(40)]
    pages = {}
    for i, (host, path) in enumerate(places):
        words = [f"<p>{draw.choice('uvwxyz')}</p>" for _ in range(6)] + [f"<p>own {i}</p>"]
        draw.shuffle(words)
        pages[i] = (host, path.split("/"), f"http://{host}{path}", "".join(words) if i % 9 else f"<main>{words[0]}</main><p>x</p>")
    expected = {}
    order = sorted(pages, key=lambda i: (*pages[i][:2], i))
    for at, i in enumerate(order):
        host, path, _, html = pages[i]
        beside = [k for k in order[max(0, at - 1) : at] + order[at + 1 : at + 2] if pages[k][0] == host]
        best = max(beside, key=lambda k: closeness(pages[k][1], path), default=None)
        assert best is None or closeness(pages[best][1], path) == max(closeness(p[1], path) for k, p in pages.items() if k != i and p[0] == host)
        expected[i] = main_text(*page_lines(html), page_lines(pages[best][3])[0] if best is not None else None)
    rows = spark.createDataFrame([(i, url, html) for i, (_, _, url, html) in pages.items()], PAGES)
    settings = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = extract_text(rows).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.page_id: r.text for r in found} == expected and len(found) == len(pages)
