from collections import Counter

import pytest
import zstandard

from gridpulse.llm import warc
from gridpulse.llm.common import ship


def expected(rows):
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    out = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        top = largest.get(html or "")
        revisit = top is not None and page != top
        out[page, len(data), warc.payload_digest(data), "revisit" if revisit else "response", top if revisit else None] += 1
    return out


ROWS = [
    (1, "http://a/ b\nc", "<p>x</p>"),
    (2, None, "<p>x</p>"),
    (3, "http://c", None),
    (4, "http://d", ""),
    (5, "http://é", "é中" * 50_000),
    (5, "http://é", "é中" * 50_000),
    (None, "http://none", "<p>x</p>"),
    (None, "http://none", "alone"),
    *[(100 + i, f"http://n/{i}", f"<html><body>page {i % 7}</body></html>" * 20) for i in range(60)],
]


def test_round_trip(spark, frames):
    ship(spark)
    got = warc.round_trip(frames.pages(ROWS, extra=True)).collect()
    assert all(r["problem"] is None for r in got)
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[f] for f in fields) for r in got) == expected(ROWS)


def test_empty_table(spark, frames):
    assert warc.round_trip(frames.pages([])).count() == 0


def archive(dictionary=b"", pages=((7, "http://x", b"hello", None),)):
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor()
    first = warc.dictionary_frame(dictionary) if dictionary else b""
    return first + b"".join(coder.compress(warc.record(*p)) for p in pages)


def test_files_are_read_through_spark(spark, tmp_path):
    ship(spark)
    samples = [f"<html><title>{i}</title><body>{'text ' * (i % 9)}{i * i}</body></html>".encode() for i in range(400)]
    dictionary = zstandard.train_dictionary(4096, samples).as_bytes()
    (tmp_path / "a.warc.zst").write_bytes(archive(dictionary, [(i, None, s, None) for i, s in enumerate(samples)]))
    rows = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert sorted((r["page_id"], bytes(r["payload"])) for r in rows) == list(enumerate(samples))


@pytest.mark.parametrize(
    "raw",
    [
        b"HTTP/1.1 200\r\n\r\n",
        warc.record(1, None, b"hello", None)[:-1],
        warc.record(1, None, b"hello", None).replace(b"hello", b"hullo"),
        warc.record(1, None, b"hello", None).replace(b"WARC-Date", b"WARC-Dote"),
        warc.record(1, None, b"hello", 2).replace(b"WARC-Refers-To", b"WARC-Other"),
        b"\xff\xfe\r\n\r\n",
    ],
)
def test_broken_records_are_told(raw):
    data = zstandard.ZstdCompressor().compress(raw) + archive()
    found = list(warc.read_archive(data))
    assert found[0]["problem"].startswith("record") and found[1]["page_id"] == 7


def test_cut_archive_is_told():
    data = archive(pages=((1, None, b"a" * 100, None), (2, None, b"b" * 100, None)))
    found = list(warc.read_archive(data[:-5]))
    assert found[0]["page_id"] == 1 and found[1]["problem"].startswith("frame")
    assert list(warc.read_archive(b"")) == []
