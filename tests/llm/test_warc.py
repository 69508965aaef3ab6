from __future__ import annotations

import gzip
import hashlib
import os
import time

import pytest
from support import SF_DIRS, compare, duck_connection, fresh_dir

from pulsegrid.llm import warc as W

PAGES = "page_id long, url string, html string, block string, record_id string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/", "<html lang='en'><head><title>A &amp; B</title><script>var t='</p><a href=\"no\">';</script></head><body><p>One<br>two &#8364; &eacute;</p><!-- <p>gone</p> --><a href=\"x?a=1\">l</a>", "x", "y"),
        (2, None, None, None, None), (3, "http://b/", "", None, None), (None, "http://c/", "<p>5 < 6 and <b>bold</b></p><script>never closed", None, None),
        (4, "http://d/", "x" * 200_000 + "<p>" * 5000, None, None), (1, "http://a/", "again", None, None), (1, "http://a/", "again", None, None),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_records(pages):
    rows = W.derivatives(W.responses_of_pages(pages), keep=("page_id",)).collect()
    assert len(rows) == 14
    for r in rows:
        block = r["block"].encode()
        assert r["content_length"] == len(block) and r["block_digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    first = {r["warc_type"]: r for r in rows if r["target_uri"] == "http://a/" and "again" not in r["block"] and r["source_length"] > 5}
    assert first["conversion"]["block"] == "A & B\nOne\ntwo € é\nl"
    assert "title: A & B\r\n" in first["metadata"]["block"] and "language: en\r\n" in first["metadata"]["block"]
    assert first["metadata"]["block"].count("outlink: ") == 1 and "outlink: x?a=1\r\n" in first["metadata"]["block"]
    assert "source-headers: HTTP/1.1 200 OK | Content-Type: text/html; charset=utf-8 | Content-Length:" in first["metadata"]["block"]
    assert first["metadata"]["refers_to"] == first["conversion"]["refers_to"] != first["metadata"]["record_id"]
    assert [r["block"] for r in rows if r["page_id"] is None and r["warc_type"] == "conversion"] == ["5 < 6 and bold"]


def test_ids_are_stable_and_linked(pages):
    responses = W.responses_of_pages(pages)
    ids = {r["record_id"] for r in responses.collect()}
    a, b = (sorted(tuple(r) for r in W.derivatives(responses).select("record_id", "refers_to").collect()) for _ in range(2))
    assert a == b and {r for _, r in a} == ids


def test_files_read_back(pages):
    path = fresh_dir("pg-warc-") + "/out"
    records = W.derivatives(W.responses_of_pages(pages))
    W.write_warc(records, path)
    want = {(r["record_id"], r["refers_to"], r["block"].encode()) for r in records.collect()}
    got = set()
    for name in os.listdir(path):
        if name.endswith(".gz"):
            data = gzip.open(f"{path}/{name}").read()
            at = 0
            while at < len(data):
                head, _, _ = data[at:].partition(b"\r\n\r\n")
                fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
                start = at + len(head) + 4
                size = int(fields[b"Content-Length"])
                got.add((fields[b"WARC-Record-ID"].decode(), fields[b"WARC-Refers-To"].decode(), data[start : start + size]))
                assert data[start + size : start + size + 4] == b"\r\n\r\n"
                at = start + size + 4
    assert got == want


def test_empty(pages):
    assert W.derivatives(W.responses_of_pages(pages.limit(0))).count() == 0


def test_sql(spark):
    d = SF_DIRS["0.001"]
    assert compare(W.query(spark, d).toPandas(), duck_connection(d).sql(W.SQL).df()) == []


def test_links_in_every_attribute_form(spark):
    page = (
        "<a href=\"/double\">1</a><a href='/single'>2</a><a href=/bare>3</a><A class=x HREF = /spaced id=y>4</a><a href=\"/it's\">5</a><a href='/say\"so\"'>6</a>"
        "<a title=\"href=/no\" href=\"/after\">7</a><a title='href=/no'>8</a><a data-href=\"/no\" href=\"/real\">9</a><a title=\"a>b\"href=\"/tight\">10</a>"
        "<a href=\"\">11</a><a href=/q?a=b&c=d>12</a><a name=top>13</a><abbr href=/no>14</abbr><a href=\"/two\n lines\">15</a>"
    )
    frame = spark.createDataFrame([(1, "http://a/", page, "x", "y"), (2, "http://b/", "<a " + "x" * 100_000 + " y=1" * 300 + " href=/far>", "x", "y")], PAGES)
    found = {r["page_id"]: r["block"] for r in W.derivatives(W.responses_of_pages(frame), keep=("page_id",)).filter("warc_type = 'metadata'").collect()}
    links = {i: [x[len("outlink: "):] for x in b.split("\r\n") if x.startswith("outlink: ")] for i, b in found.items()}
    assert links == {
        1: ["/double", "/single", "/bare", "/spaced", "/it's", '/say"so"', "/after", "/real", "/tight", "", "/q?a=b&c=d", "/two lines"], 2: ["/far"],
    }


LONG_TAGS = {
    "attributes": ("<a " + "b=1 " * 100_000 + "href='/far'>", ["/far"]), "quoted attributes": ("<a " + "b=\"x>y\" " * 100_000 + "href='/far'>", ["/far"]),
    "unclosed quotes": ("<a x=\"" * 100_000, []), "unclosed tags": ("<a " * 100_000, []), "unclosed tags with links": ("<a href=/x " * 50_000, ["/x"]),
    "single quotes": ("<a x='" * 100_001 + "><a href=/after>", ["/after"]), "blanks": ("<a" + " " * 300_000 + "href=/x>", ["/x"]), "equals": ("<a x" + "=" * 300_000 + "><a href=/y>", ["/y"]),
    "no value": ("<a href=><a href><a href = \"/z\">", ["/z"]), "value of another": ("<a x= href=/no><a href=/yes>", ["/yes"]),
}


@pytest.mark.parametrize("name", LONG_TAGS)
def test_tags_of_any_length(spark, name):
    page, want = LONG_TAGS[name]
    frame = spark.createDataFrame([(1, "http://a/", page, "x", "y")], PAGES)
    began = time.monotonic()
    block = W.derivatives(W.responses_of_pages(frame)).filter("warc_type = 'metadata'").first()["block"]
    assert [x[len("outlink: "):] for x in block.split("\r\n") if x.startswith("outlink: ")] == want
    assert time.monotonic() - began < 20
