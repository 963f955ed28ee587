"""Archives written, read back and damaged."""

import hashlib
import random

import pytest

from feedmetrics.llm import warc
from feedmetrics.session import scratch_dir

LONG = "".join(random.Random(1).choice("abc é\n") for _ in range(50_000))
PAGES = [
    (1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200), (3, None, "x" * 200), (4, "http://a/ 4\r\nX: y", "short"),
    (5, "u", "short"), (6, "u", ""), (7, "u", None), (8, "u", LONG), (9, "u", LONG), (None, "u", "x" * 200),
    (None, "u", "y" * 200), (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 900), (11, "u", "z" * 150),
    (11, "u", "z" * 150), (12, "u", "a\r\n\r\nb" * 40), (13, "u", "WARC/1.1"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string")


@pytest.mark.parametrize("chunk, segment", [(4096, 8192), (7, 100), (1, 1_000_000), (4096, 64)])
def test_round_trip(spark, chunk, segment):
    rows = [r for r in PAGES if len(r[2] or "") < 1000 or segment > 1000]
    path = scratch_dir(spark, "warc-test")
    warc.write_archive(pages(spark, rows).repartition(3), path, 100, chunk, segment)
    records = warc.read_archive(spark, path)
    assert records.filter("NOT complete").count() == 0
    payloads = {r.record_id: bytes(r.payload) for r in records.filter("type = 'response'").collect()}
    expected = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        first = min(same) if len(data) >= 100 and same else None
        revisit = first is not None and page_id != first
        expected.append((str(page_id), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                         str(first) if revisit else "None"))
        if not revisit:
            assert data in payloads.values()
    found = warc.pages_of(records).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to))
                  for r in found) == sorted(expected)


def test_no_pages(spark):
    path = scratch_dir(spark, "warc-empty")
    warc.write_archive(pages(spark, []), path)
    assert warc.pages_of(warc.read_archive(spark, path)).count() == 0


def test_damage_is_seen(spark, tmp_path):
    block = warc.HTTP_HEAD + warc.chunked(b"hello world" * 30, 50)
    parts = [block[:100], block[100:250], block[250:]]

    def archive(name, chosen, total=None, numbers=None):
        records = [next(warc.records_of(name, 0, None, "", "d", None, 9, 9))] if not chosen else []
        for n, part in zip(numbers or range(1, len(chosen) + 1), chosen):
            own = f"<urn:page:{name}:0>"
            fields = [("WARC-Type", "response" if n == 1 else "continuation"),
                      ("WARC-Record-ID", own if n == 1 else f"<urn:page:{name}:0:{n}>"),
                      ("WARC-Segment-Number", str(n))]
            fields += [] if n == 1 else [("WARC-Segment-Origin-ID", own)]
            fields += [("WARC-Segment-Total-Length", str(total or len(block)))] if n == 3 else []
            records.append(warc._record(fields, part))
        return records

    every = [*archive("1", parts), *archive("2", parts[:2]), *archive("3", parts, total=7),
             *archive("4", [parts[0], parts[2]], numbers=[1, 3]), *archive("5", parts[1:], numbers=[2, 3]),
             *archive("6", [parts[0], b"?" * 150, parts[2]])]
    random.Random(2).shuffle(every)
    (tmp_path / "a.warc").write_bytes(warc.BETWEEN.encode().join(every)
                                      + b"\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\ncut")
    found = {r.record_id: r for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert bytes(found["<urn:page:1:0>"].payload) == b"hello world" * 30
    assert [k for k, r in found.items() if r.complete] == ["<urn:page:1:0>"]
    assert len(found) == 7


def test_other_versions_and_bad_numbers(spark, tmp_path):
    def record(version, n, body, *more):
        fields = [f"WARC-Type: response", f"WARC-Record-ID: <urn:page:{n}:0>", f"Content-Length: {len(body)}", *more]
        return f"WARC/{version}\r\n".encode() + "\r\n".join(fields).encode() + b"\r\n\r\n" + body

    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    (tmp_path / "old.warc").write_bytes(b"\r\n\r\n".join([record("1.0", n, body) for n in range(3)] + [
        record("1.1", 3, body, "WARC-Segment-Number: one"), record("1.0", 4, b"HTTP/1.1 200 OK\r\n\r\nsee WARC/1.0 there"),
        record("1.1", 5, body).replace(b"Content-Length: 24", b"Content-Length: many")]) + b"\r\n\r\n")
    found = warc.read_archive(spark, str(tmp_path))
    rows = {r.record_id: r for r in found.collect()}
    assert [bytes(rows[f"<urn:page:{n}:0>"].payload) for n in range(3)] == [b"hello"] * 3
    assert not any(rows[f"<urn:page:{n}:0>"].complete for n in (3, 4, 5))
    assert [r.type for r in rows.values() if r.record_id is None] == ["unread"]
    pages_found = {r.page_id: r.payload_bytes for r in warc.pages_of(found).collect()}
    assert pages_found == {0: 5, 1: 5, 2: 5, 3: None, 4: None, 5: None, None: None}


def test_marks_in_urls_and_lost_responses(spark, tmp_path):
    path = scratch_dir(spark, "warc-urls")
    warc.write_archive(pages(spark, [(1, "http://a/WARC/1.0", "WARC/1.0 " * 30), (2, "u", "WARC/1.0 " * 30)]), path)
    records = warc.read_archive(spark, path)
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in warc.pages_of(records).collect()) == [
        (1, 270, "response"), (2, 270, "revisit")]
    lost = warc.pages_of(records.filter("type = 'revisit'")).collect()
    assert [(r.page_id, r.payload_bytes, r.refers_to) for r in lost] == [(2, None, 1)]
