from __future__ import annotations

import hashlib
import io

import pytest

from tessera.llm.archives import (
    arc_header,
    arc_record,
    arc_records,
    archived_pages,
    iso_date,
    member,
    warc_record,
    warc_records,
)

LONG = "<p>WARC/1.0\r\n\r\nhttp://x 0.0.0.0 20000101000000 text/html 5\né</p>" * 5
PAGES = [
    (3, "http://a.test/", LONG, 1),
    (1, None, LONG, 1),
    (4, "http://a b.test/é", LONG, 1),
    (4, "http://a b.test/é", LONG, 1),
    (5, "no scheme", None, 1),
    (6, "x", "", 1),
    (7, "x", "short", 1),
    (8, "x", "short", 1),
    (None, "x", LONG + "!", 1),
    (9, "x", "big " * 300_000, 1),
]


def test_pages_survive(small):
    docs = small(PAGES, "page_id bigint, url string, html string, record int")
    rows = archived_pages(docs).collect()
    got = sorted(
        ((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows),
        key=repr,
    )
    want = []
    for page_id, _, html, _ in PAGES:
        data = (html or "").encode()
        revisit = html == LONG and page_id != 1
        want.append(
            (
                page_id or 0,
                len(data),
                hashlib.sha256(data).hexdigest(),
                "revisit" if revisit else "response",
                1 if revisit else None,
            )
        )
    assert got == sorted(want, key=repr)


def test_empty_table(small):
    assert archived_pages(small([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [True, False])
def test_headers_of_both_versions(version, packed):
    pack = member if packed else bytes
    data = pack(arc_header(version, "f", "20000101000000")) + b"".join(
        pack(arc_record(version, url, "19991231235959", block, 9, "f"))
        for url, block in (("http://a b/", b"HTTP/1.1 200 OK\r\n\r\nx\n\ny"), ("dns:x", b""))
    )
    found = list(arc_records(io.BytesIO(data)))
    assert [(n, f["URL"], b) for n, f, b in found] == [
        (0, "http://a%20b/", b"HTTP/1.1 200 OK\r\n\r\nx\n\ny"),
        (1, "dns:x", b""),
    ]
    warc = b"".join(pack(warc_record("f", n, f, b, None)) for n, f, b in found)
    read = list(warc_records(io.BytesIO(warc)))
    assert [h["warc-type"] for _, h, _ in read] == ["response", "resource"]
    assert [b for _, _, b in read] == [b for _, _, b in found]
    assert read[0][1]["warc-date"] == "1999-12-31T23:59:59Z"
    assert len({h["warc-record-id"] for _, h, _ in read}) == 2


def test_broken_archives_are_refused():
    head = arc_header(1, "f", "20000101000000")
    for tail in (b"not a header\n", b"http://x 0.0.0.0 2000 text/html 50\nshort"):
        with pytest.raises(ValueError):
            list(arc_records(io.BytesIO(head + tail)))
    assert list(arc_records(io.BytesIO(b""))) == []


def test_short_dates():
    assert iso_date("1997") == "1997-01-01T00:00:00Z"
