from __future__ import annotations

import gzip
import hashlib
import os

import pytest

from ledgerloom.llm import warc

PAGES = "page_id long, url string, html string, value string, count long"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], PAGES)


def plain(rows, least=100):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(html) if first.get(html) != page else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=repr)


def test_round_trip_and_seek(spark, tmp_path):
    same = "é<p>" * 40
    rows = [(7, "http://a/x y\r\n", same), (3, None, same), (3, "http://b", same), (4, "u", None), (5, "u", ""), (6, "u", "short")]
    rows += [(8, "u", "short"), (9, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9), (10, "u", "z" * 300_000), (None, "u", same)]
    folder = str(tmp_path / "out")
    index = warc.archive(pages_of(spark, rows), folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index), key=repr) == plain(rows)
    assert all(r.intact for r in index)
    html = {(p, len((h or "").encode())): h or "" for p, _, h in rows}
    for r in index:
        with open(os.path.join(folder, "records", r.file), "rb") as file:
            file.seek(r.offset)
            record = gzip.decompress(file.read(r.length))
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert record.endswith(b"\r\n\r\n")
        if r.record_type == "response":
            assert record[:-4].decode().endswith(html[r.page_id, r.payload_bytes])
    for name in {r.file for r in index}:  # members, and nothing between them
        spans = sorted((r.offset, r.length) for r in index if r.file == name)
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        data = open(os.path.join(folder, "records", name), "rb").read()
        assert len(data) == sum(n for _, n in spans) and gzip.decompress(data).count(b"WARC-Type") >= len(spans)
    for name in os.listdir(os.path.join(folder, "monolithic")):  # one stream a file before
        if name.endswith(".gz"):
            assert len(list(warc.members(open(os.path.join(folder, "monolithic", name), "rb").read()))) <= 1


def test_no_pages(spark, tmp_path):
    assert warc.archive(pages_of(spark, []), str(tmp_path / "out")).count() == 0


def test_large_record_ends_in_zero():
    record = os.urandom(1 << 12) * (1 << 12) + b"end"
    out = warc.member(record)
    assert out[-1] == 0 and gzip.decompress(out) == record
    assert [(o, n) for o, n, _ in warc.members(out + out)] == [(0, len(out)), (len(out), len(out))]


def test_broken_archives_are_refused():
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert list(warc.split_records(iter([whole[:9], whole[9:], whole]))) == [whole, whole]
    for part in (whole[:12], whole[:-6]):
        with pytest.raises(ValueError):
            list(warc.split_records(iter([part])))
    with pytest.raises(ValueError):
        list(warc.members(gzip.compress(whole)[:-3]))
