"""URL verdicts and archives: against plain Python, and exact round trips."""

from __future__ import annotations

import gzip
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from paystream.llm import urlfilter, warc
from paystream.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def judged(url, rules):
    host, path = parts(url)
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    return (host, path, *max(fits, key=lambda x: len(x[0]))) if fits else (host, path, None, "allow")


def test_urls(spark):
    random.seed(3)
    hosts = ["example.com", "WWW.Example.com", "a.b.example.net", "example.org", "com", "xcom", "a..com", "", "u:p@www.example.com:80"]
    tails = ["", "/", "/en/", "/en/x?y://z", "/es/1#a", "/fr", "/fr/2", "?q=/en/", "#/en/", "/de/\n/en/"]
    urls = [random.choice(["http://", "https://", "ftp://x@", "//", "://", ""]) + h + t for h in hosts for t in tails]
    urls += [None, "", "no scheme", urls[0], "http://example.com/en/" + "x" * 50000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'z' AS host", "1 AS rule", "2 AS keys")
    rules = spark.createDataFrame([(*r, True) for r in URL_RULES], urlfilter.RULE_SCHEMA)
    for block in (4_000_000, 2):
        index = urlfilter.build_index(rules, block_keys=block)
        assert len(index.files) == (1 if block > 2 else 3)
        found = urlfilter.judge(pages, index).collect()
        assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in sorted(found)] == [
            (k, *judged(u, URL_RULES)) for k, u in enumerate(urls)
        ]
    nothing = urlfilter.build_index(rules.where("false"))
    assert {r.verdict for r in urlfilter.judge(pages, nothing, default="block").collect()} == {"block"}
    assert urlfilter.judge(pages.where("false"), index).count() == 0


def test_listed_domains_yield_to_rules(spark):
    rows = [("example.com", "", "block", False), ("com", "/", "allow", True), ("net", "", "block", False), ("net", "", "allow", False), (None, "", "block", True)]
    index = urlfilter.build_index(spark.createDataFrame(rows, urlfilter.RULE_SCHEMA))
    pages = spark.createDataFrame([(1, "http://example.com/"), (2, "http://example.com"), (3, "http://a.net/x")], "page_id long, url string")
    assert [(r.rule, r.verdict, r.listed) for r in sorted(urlfilter.judge(pages, index).collect())] == [
        ("com/", "allow", "example.com"), (None, "block", "example.com"), (None, "block", "net")
    ]


def test_hosts_of_many_labels(spark):
    """A host of very many labels, and rules with more labels than most hosts."""
    deep = "a." * 40_000 + "www.example.com"
    rules = [*URL_RULES, ("x.y.z.www.example.com", "/en/", "block")]
    index = urlfilter.build_index(spark.createDataFrame([(*r, True) for r in rules], urlfilter.RULE_SCHEMA))
    assert index.labels == (1, 2, 3, 6)
    urls = [f"http://{h}/en/1" for h in (deep, "x.y.z.www.example.com", "y.z.www.example.com", "." * 50_000 + "net", "w.x.y.z.www.example.com")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = sorted(urlfilter.judge(pages, index).collect())
    assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found] == [(k, *judged(u, rules)) for k, u in enumerate(urls)]


def test_equal_digests_are_told_apart(tmp_path):
    rows = [(-5, b"x", 1), (7, b"one", 0), (7, b"two", 3), (7, b"three", 2)]
    block = urlfilter._Block(urlfilter._write(rows, str(tmp_path)))
    found, flags = block.probe(np.array([7, 7, 7, -5, 8, -9], "i8"), pa.array(["two", "four", "three", "y", "x", "x"]))
    assert found.tolist() == [0, 2] and flags.tolist() == [3, 2]


def test_archive_of_pages(spark):
    same, small = "<p>" + "é" * 60, "<p>tiny"
    rows = [
        (5, "http://a.com/x y", same), (3, "http://b.com", same), (9, None, same), (7, "u", small), (8, "u", small),
        (10, "u", None), (11, "u", ""), (None, "n", same), (12, "u", "a\r\n\r\nWARC/1.1\r\n\n\r" * 300), (13, "u", "x" * 400_000),
        (14, "u", "lone\n"), (3, "http://b.com", same),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first", "3 AS content")

    def want(page, html):
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        again = len(data) >= 100 and ids and page != min(ids)
        return page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(ids) if again else None

    found = warc.archive(pages).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=key) == sorted(
        (want(p, h) for p, _, h in rows), key=key)
    by_page = {r.page_id: r for r in found}
    assert by_page[5].refers_to_id == by_page[3].record_id and by_page[5].target_uri == "http://a.com/x%20y"
    assert warc.archive(pages.where("false")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    records = [("http://a.com/ b", b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\n\xff\x00body\n\n"), ("dns:a.com", b"20080101 a.com 1.2.3.4\n"), ("http://c", b"")]
    data = warc.arc_file(version, records)
    found = list(warc.parse_arc(data))
    assert [f.version for f in found] == [version] * 4
    assert [(f.url, f.body) for f in found[1:]] == [("http://a.com/%20b", records[0][1]), records[1], records[2]]
    # Blanks in a url that an old crawler left stand as they are.
    spaced = data.replace(b"http://a.com/%20b ", b"http://a.com/ b ")
    assert [f.url for f in warc.parse_arc(spaced)][1] == "http://a.com/ b"
    cut = list(warc.parse_arc(data[:data.index(b"body")]))
    assert cut[-1].truncated and b"WARC-Truncated: length" in warc.to_warc(cut[-1])
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://a.com 1.1.1.1 2008 text/html 3\nabc\n"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(b"http://c 0.0.0.0 ", b"http://c ")))


def test_dates_and_types():
    assert warc.iso_date("20080102030405") == "2008-01-02T03:04:05Z"
    assert warc.iso_date("1999") == "1999-01-01T00:00:00Z"
    kinds = [next(warc.parse_warc(iter([warc.to_warc(a)]))).headers["warc-type"] for a in warc.parse_arc(
        warc.arc_file(2, [("http://a", b"HTTP/1.0 200 OK\r\n\r\nx"), ("http://b", b"plain"), ("http://c", b"HTTP/1.0 200 OK\r\nX-Page-Id: 4\r\nX-First-Page: 2\r\n\r\nx")]))]
    assert kinds == ["warcinfo", "response", "resource", "revisit"]


def test_arc_files_of_any_bytes_through_spark(spark, tmp_path):
    random.seed(2)
    bodies = [bytes(random.getrandbits(8) for _ in range(random.randint(0, 3000))) for _ in range(40)]
    folder = tmp_path / "arc"
    folder.mkdir()
    for k in range(4):
        data = warc.arc_file(1 + k % 2, [(f"http://a/{n}", bodies[n]) for n in range(k, 40, 4)])
        (folder / f"{k}.arc.gz").write_bytes(gzip.compress(data[:500]) + gzip.compress(data[500:]) if k % 2 else data)
    files = spark.read.format("binaryFile").load(str(folder))
    warc.write_archive(warc.convert(files), str(tmp_path / "out"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "out").glob("*.gz")))
    pieces = iter([data[k:k + 777] for k in range(0, len(data), 777)])
    found = {r.headers["warc-target-uri"]: r for r in warc.parse_warc(pieces) if r.headers["warc-type"] == "resource"}
    assert {u: r.block for u, r in found.items()} == {f"http://a/{n}": b for n, b in enumerate(bodies)}
    rows = {r.target_uri: r for r in warc.read_archive(spark, str(tmp_path / "out")).collect()}
    assert {u: r.payload_digest for u, r in rows.items()} == {f"http://a/{n}": hashlib.sha256(b).hexdigest() for n, b in enumerate(bodies)}
