"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: payload digests are grouped first (an aggregation with map-side combine over digests, not
payloads).  Of records with equal payloads the one with the smallest id is a ``response``; the
others are ``revisit`` records, which keep the HTTP head (so the full length) but no payload.
Archives roll at ``ARCHIVE_BYTES``.  Each is written under a name of its own attempt in the shared
folder and counts only once it is in the manifest, so retried or lost tasks do no harm.

Reading: archives are streamed frame by frame; the dictionary comes from the skippable frame.
Every record is checked: version line, mandatory headers, block length, closing blank lines,
block digest and, for responses, payload digest and length.

Null or empty payloads are payloads of no bytes and are grouped like any other (``min_bytes`` = 0).
Rows that share the smallest id of their group are responses alike; a null id ranks last and is
itself a response only if its group has no other id.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.sampling import sample_of
from larkspur.llm.storage import materialize, scratch

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on about so many payloads, drawn by hash of the id, so many characters of each.
DICTIONARY_ROWS, DICTIONARY_CHARS = 256, 8192
LEVEL = 3
# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:larkspur:record:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, digest: str | None = None) -> bytes:
    """One response record, or a revisit record if refers_to is given."""
    digest = digest or base32_sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID_PREFIX}{record_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; ValueError if anything about it is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("not a WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or name.lower() in headers:
            raise ValueError(f"bad header line {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"{name} is missing")
    length = int(headers["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ValueError("block length differs from Content-Length")
    if headers.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
        raise ValueError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    told = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    if not gap or told is None:
        raise ValueError("no HTTP head")
    if headers["warc-type"] == "response":
        if len(payload) != told or headers["warc-payload-digest"] != "sha1:" + base32_sha1(payload):
            raise ValueError("payload differs from its length or digest")
    elif headers["warc-type"] != "revisit" or payload or "warc-refers-to" not in headers:
        raise ValueError("bad revisit record")
    return {"headers": headers, "payload": payload, "payload_bytes": told}


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


class FrameReader:
    """Records of one archive stream, one decompressed frame at a time."""

    def __init__(self, stream, chunk: int = 1 << 16):
        self._stream, self._chunk, self._left = stream, chunk, b""

    def _read(self, size: int) -> bytes:
        while len(self._left) < size and (more := self._stream.read(max(self._chunk, size - len(self._left)))):
            self._left += more
        out, self._left = self._left[:size], self._left[size:]
        return out

    def frames(self) -> Iterator[bytes]:
        head = self._read(8)
        dictionary = None
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
            size = struct.unpack("<I", head[4:])[0]
            raw = self._read(size)
            if len(raw) != size:
                raise ValueError("the dictionary frame is cut off")
            if raw[:4] == zstandard.FRAME_HEADER:
                raw = zstandard.ZstdDecompressor().decompress(raw)
            dictionary = zstandard.ZstdCompressionDict(raw)
        else:
            self._left = head + self._left
        unzip = zstandard.ZstdDecompressor(dict_data=dictionary)
        while True:
            data = self._left or self._stream.read(self._chunk)
            if not data:
                return
            self._left, frame, parts = b"", unzip.decompressobj(), []
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    self._left = frame.unused_data
                    break
                data = self._stream.read(self._chunk)
                if not data:
                    raise ValueError("the last frame is cut off")
            yield b"".join(parts)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or none if there is too little to learn from."""
    samples = [s for s in samples if len(s) >= 8]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 4 + 256), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write all rows of pages below folder; return the manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    ).withColumn("digest", F.sha1(F.encode("payload", "utf-8")))
    long_enough = F.octet_length("payload") >= min_bytes
    first = (
        rows.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("first_digest"), "first")
    )
    joined = rows.join(first, (F.col("digest") == F.col("first_digest")) & long_enough, "left").select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"),
    )
    texts = pages.select(F.col(id_col).alias("id"), F.substring(F.col(payload_col), 1, DICTIONARY_CHARS).alias("p"))
    picked = sample_of(texts, DICTIONARY_ROWS).collect()
    dictionary = train_dictionary(sorted((r.p or "").encode() for r in picked))

    def write(batches):
        made = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        zipper = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True)
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        attempt, number = uuid.uuid4().hex, 0
        store.create_dir(base, recursive=True)
        start = dictionary_frame(dictionary) if dictionary else b""
        held, size, count = [start], len(start), 0

        def flush():
            name = f"{attempt}-{number:05d}.warc.zst"
            with store.open_output_stream(f"{base}/{name}.part", compression=None) as out:
                for part in held:
                    out.write(part)
            store.move(f"{base}/{name}.part", f"{base}/{name}")
            return pd.DataFrame({"archive": [f"{folder}/{name}"], "records": [count], "bytes": [size]})

        for batch in batches:
            for row in batch.itertuples(index=False):
                refers = row.refers_to if isinstance(row.refers_to, str) else None
                url = row.url if isinstance(row.url, str) else None
                page = row.id if isinstance(row.id, str) else "null"
                frame = zipper.compress(make_record(page, url, row.payload.encode("utf-8", "surrogatepass"), refers))
                held.append(frame)
                size, count = size + len(frame), count + 1
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size, count, number = [start], len(start), 0, number + 1
        if count:
            yield flush()

    manifest = joined.mapInPandas(write, "archive string, records long, bytes long")
    return materialize(manifest, scratch(spark, "warc-manifest"))


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id string, url, payload_bytes, payload_digest, record_type, refers_to string[, payload])."""

    def read(batches):
        for batch in batches:
            for archive, records in zip(batch["archive"], batch["records"], strict=True):
                store, path = pyarrow.fs.FileSystem.from_uri(archive)
                out, size, seen = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for frame in FrameReader(stream).frames():
                        record = parse_record(frame)
                        seen += 1
                        h = record["headers"]
                        page = h["warc-record-id"][1 + len(ID_PREFIX) : -1]
                        refers = h.get("warc-refers-to")
                        row = [
                            None if page == "null" else page, h.get("warc-target-uri"), record["payload_bytes"],
                            h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"],
                            refers and refers[1 + len(ID_PREFIX) : -1],
                        ]
                        if with_payload:
                            row.append(record["payload"])
                            size += len(record["payload"])
                        out.append(row)
                        if len(out) >= 2000 or size > 1 << 24:
                            yield pd.DataFrame(out, columns=columns)
                            out, size = [], 0
                if seen != records:
                    raise ValueError(f"{archive} has {seen} records, the manifest says {records}")
                if out:
                    yield pd.DataFrame(out, columns=columns)

    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    spread = manifest.select("archive", "records").repartition(manifest.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInPandas(read, schema + ", payload binary" * with_payload)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = read_archives(write_archives(pages, scratch(spark, "warc")))
    return found.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p
), b AS (
  SELECT *, CAST(CAST(unhex(h) AS BIT) AS VARCHAR) AS bits FROM g
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
                  + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
                  + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""
