from __future__ import annotations

import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from larkspur.llm import warc
from larkspur.llm.storage import scratch


def frames(data):
    return list(warc.FrameReader(io.BytesIO(data), chunk=7).frames())


@pytest.mark.parametrize("dictionary", [b"", b"WARC/1.1 HTTP/1.1 200 OK html body head title " * 9])
def test_frames_round_trip(dictionary):
    made = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    zipper = zstandard.ZstdCompressor(dict_data=made)
    records = [warc.make_record(str(k), f"http://x/{k}\r\n", b"p" * k, None if k % 2 else "0") for k in range(20)]
    data = (warc.dictionary_frame(dictionary) if dictionary else b"") + b"".join(map(zipper.compress, records))
    assert frames(data) == records
    for k, record in enumerate(map(warc.parse_record, records)):
        assert record["payload_bytes"] == k and record["payload"] == (b"p" * k if k % 2 else b"")
        assert record["headers"]["warc-target-uri"] == f"http://x/{k}%0D%0A"
    with pytest.raises(ValueError, match="cut off"):
        frames(data[:-3])


def test_compressed_dictionary():
    raw = b"some shared text of the pages " * 20
    data = warc.dictionary_frame(zstandard.compress(raw)) + zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(b"x" * 50)
    assert frames(data) == [b"x" * 50]
    assert struct.unpack("<I", data[:4])[0] == 0x184D2A5D and frames(b"") == []


@pytest.mark.parametrize(
    "old,new",
    [(b"WARC/1.1\r", b"WARC/0.9\r"), (b"WARC-Type", b"WARC-Tipe"), (b"payload", b"pailoat"), (b"\r\n\r\n", b"\r\n"),
     (b"WARC-Date", b"WARC-Type"), (b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A")],
)
def test_bad_records(old, new):
    record = warc.make_record("1", None, b"the payload", None)
    warc.parse_record(record)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(old, new))


def test_pages(spark, monkeypatch):
    rows = [(5, "u5", "same é"), (2, None, "same é"), (9, "u9", None), (7, "u7", ""), (3, "u3", "other"), (2, "u2", "same é"), (None, "u", "other"), (None, None, "lone"), (4, "u4", "x" * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("id", F.lit(1)).repartition(3)
    manifest = warc.write_archives(pages, scratch(spark, "warc-test"))
    found = warc.read_archives(manifest, with_payload=True).collect()
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) == len(found)
    got = sorted(str((r.page_id, r.record_type, r.refers_to, r.payload_bytes, len(r.payload))) for r in found)
    want = [
        ("5", "revisit", "2", 7, 0), ("2", "response", None, 7, 7), ("2", "response", None, 7, 7), ("9", "revisit", "7", 0, 0),
        ("7", "response", None, 0, 0), ("3", "response", None, 5, 5), (None, "revisit", "3", 5, 0), (None, "response", None, 4, 4),
        ("4", "response", None, 500_000, 500_000),
    ]
    assert got == sorted(map(str, want))
    assert {r.page_id: r.refers_to for r in found if r.record_type == "revisit"} == {"5": "2", "9": "7", None: "3"}
    assert warc.read_archives(warc.write_archives(pages.limit(0), scratch(spark, "warc-none"))).count() == 0


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(k, None, "ab" if k < 2 else "abcdef") for k in range(4)], "page_id long, url string, html string")
    found = warc.read_archives(warc.write_archives(pages, scratch(spark, "warc-min"), min_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in found) == [("0", "response"), ("1", "response"), ("2", "response"), ("3", "revisit")]


def test_archives_roll(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    pages = spark.createDataFrame([(k, None, str(k)) for k in range(6)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(pages, scratch(spark, "warc-roll"))
    assert warc.read_archives(manifest).count() == 6
