"""Archives: round trip, validity of the files, indexed reads."""

import base64
import gzip
import hashlib
import os

import pytest
from leadlink.llm import warc
from leadlink.session import fresh_path

LONG = "é" * 300_000
ROWS = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "http://d", LONG), (6, "http://e", LONG),
        (6, "http://e", LONG), (None, "http://f", "<p>x</p>"), (None, "http://g", "only"), (7, "http://h", "a\r\n\r\nb")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "page_id long, url string, html string, sha string, first string, bytes string")


def want(rows, least=0):
    out = []
    for i, url, html in rows:
        raw = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == raw and j is not None] if len(raw) >= least else []
        first = min(ids, default=None)
        kind = "response" if first is None or first == i else "revisit"
        url = url.replace("\r", "%0D").replace("\n", "%0A") if url else url
        out.append((i, url, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, first if kind == "revisit" else None))
    return out


@pytest.mark.parametrize("least, roll", [(0, 1 << 30), (5, 200)])
def test_round_trip(spark, least, roll):
    path = fresh_path(spark, "warc")
    found = warc.read(warc.write(pages(spark), path, min_bytes=least, roll_bytes=roll), path, payloads=True).collect()
    assert sorted([tuple(r)[:6] for r in found], key=repr) == sorted(want(ROWS, least), key=repr)
    texts = {(i, (h or "").encode()) for i, _, h in ROWS}
    assert all((r.page_id, bytes(r.payload)) in texts for r in found if r.record_type == "response")


def test_files_are_concatenated_gzip_members_of_records(spark):
    path = fresh_path(spark, "warc")
    index = warc.write(pages(spark).coalesce(1), path).collect()
    root = path.removeprefix("file:")
    total = 0
    for name in {r.file for r in index}:
        raw = open(os.path.join(root, name), "rb").read()
        total += gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type: ")
        places = sorted((r.offset, r.length) for r in index if r.file == name)
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) == len(raw)
    assert total == len(ROWS)


def test_selected_records_only(spark):
    path = fresh_path(spark, "warc")
    index = warc.write(pages(spark), path)
    got = warc.read(index.where("url IN ('http://d', 'http://h')"), path).collect()
    assert sorted(r.page_id for r in got) == [5, 7]


def test_neighbours_are_coalesced():
    places = [("a", 0, 10), ("a", 10, 10), ("a", 25, 10), ("a", 200, 10), ("b", 0, 10), ("b", 10, 500), ("b", 510, 10)]
    assert [len(r) for r in warc._ranges(places, gap=5, span=100)] == [3, 1, 1, 1, 1]


def test_damage_is_noticed():
    record = warc._record(1, "u", base64.b32encode(hashlib.sha1(b"other").digest()).decode(), b"payload", None, "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc._parse(gzip.compress(record), True)


def test_nothing(spark):
    path = fresh_path(spark, "warc")
    assert warc.read(warc.write(pages(spark, []), path), path).collect() == []
