import base64
import gzip
import hashlib

import pytest

from reelgauge.llm import warc as W
from reelgauge.session import fresh_path

ROWS = [
    (1, "http://a/1", "<p>same é</p>", 1), (2, "http://a/2", "<p>same é</p>", 1), (3, None, None, 1), (4, "http://a/4", "", 1),
    (5, "http://a/5\r\nX: y", "one\r\n\r\nWARC/1.1\r\n\r\ntwo", 1), (5, "http://a/5", "unlike", 1),
    (6, "u", "twice", 1), (6, "u", "twice", 1), (None, "u", "<p>same é</p>", 1), (None, "u", "only null", 1),
    (None, "u", "only null", 1), (7, "u", "long " * 100_000, 1), (8, "u", "long " * 100_000, 1),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, digest int").coalesce(3)


def run(spark, pages, **options):
    files = W.write_archives(pages, fresh_path(spark, "warc"), **options)
    return files, W.normalise(files)


@pytest.mark.parametrize("size", [W.FILE_BYTES, 50])
def test_round_trip(spark, pages, size):
    files, index = run(spark, pages, file_bytes=size)
    got = W.read_archives(index).collect()
    assert len(got) == len(ROWS) and (files.count() > 3) == (size == 50)
    by_payload = {}
    for page, _, html, _ in ROWS:
        by_payload.setdefault((html or "").encode(), []).append(page)
    for payload, ids in by_payload.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        same = [x for x in got if x.payload_digest == digest]
        first = min((x for x in ids if x is not None), default=None)
        assert sorted(map(str, ids)) == sorted(str(x.page_id) for x in same)
        assert [(x.page_id, x.refers_to, bytes(x.payload)) for x in same if x.record_type == "response"] == [(first, None, payload)]
        assert all(x.refers_to == first and x.payload is None for x in same if x.record_type == "revisit")
        assert {x.payload_bytes for x in same} == {len(payload)}


def test_small_payloads_are_responses(spark, pages):
    _, index = run(spark, pages, least=100)
    kinds = {(x.page_id, x.record_type) for x in W.read_archives(index).collect()}
    assert (2, "response") in kinds and (8, "revisit") in kinds


def test_members_and_index_files(spark, pages):
    files, index = run(spark, pages)
    for path in {x.path for x in files.collect()}:
        raw = W.open_shared(path).read()
        assert raw[:2] == b"\x1f\x8b" and gzip.decompress(raw).startswith(b"WARC/1.1\r\n")
    for path in {x.path for x in index.collect()}:
        raw = W.open_shared(path).read()
        lines = W.open_shared(path.removesuffix(".warc.gz") + ".idx").read().decode().splitlines()
        place = 0
        for offset, size, kind, _ in (x.split("\t") for x in lines):
            assert int(offset) == place
            member = gzip.decompress(raw[place : place + int(size)])
            assert member.startswith(b"WARC/1.1\r\n") and f"WARC-Type: {kind}".encode() in member
            place += int(size)
        assert place == len(raw)


def test_damage_is_noticed(spark, pages):
    with pytest.raises(ValueError):
        list(W.records_of(iter([W.record(1, "u", b"x", "D", None, False)[:-3]])))
    with pytest.raises(ValueError):
        list(W.records_of(iter([b"nothing here\r\n\r\n"])))


def test_empty_table(spark, pages):
    _, index = run(spark, pages.filter("page_id < 0"))
    assert W.read_archives(index).count() == 0
