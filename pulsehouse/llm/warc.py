"""Operator 12: WARC archives, written by Spark and read back by a salvage
reader.

Writing: a record per page; of pages with equal payloads the one with the
largest id is a ``response``, the others are ``revisit`` records that name it.
Each record is a gzip member of its own (or plain), handed to Spark's text
writer as raw bytes, so files are committed like any other output and lie
wherever Spark can write. The writer's line separator is used too: an empty
gzip member between compressed records, the last line break of a plain one.

Reading: every file is walked from its start. A record counts only if all its
checks hold (member checksum, version line, header, length, closing line
breaks, block and payload digests). Where one fails, the next gzip member or
version line that starts a valid record is searched from the following byte
on, later records are recovered, and the bytes between are a quarantined gap
with the reason. Lengths of records and gaps add up to the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.llm.common import bounded, keep, map_arrow

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
# Records of a file: a file is read as one row by one task.
RECORDS_PER_FILE = 20_000
LEVEL = 6
# A gzip member without content: stands between records, readers skip it.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
_STEP = 1 << 16
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_PAGE = re.compile(r"<?urn:page:(-?\d*):")
# What may stand unescaped in a header's address.
_URI_SAFE = "".join(map(chr, range(33, 127)))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- writing

def record(page_id: int | None, url: str | None, payload: bytes, record_type: str,
           refers_to: int | None) -> bytes:
    """One WARC record. A revisit has the HTTP header, with the length of the
    payload, but not the payload."""
    sha = digest(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if record_type == "response":
        block += payload
    name = lambda i: f"<urn:page:{'' if i is None else i}:{sha}>"
    head = [f"WARC-Type: {record_type}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URI_SAFE)}")
    if record_type == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response",
             f"WARC-Block-Digest: sha1:{digest(block)}", f"WARC-Payload-Digest: sha1:{sha}",
             f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _writer(compress: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                out = []
                for r in b.slice(lo, 256).to_pylist():
                    data = record(r["page_id"], r["url"], r["payload"], r["record_type"],
                                  r["refers_to"])
                    out.append(gzip_member(data) if compress else data[:-2])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def deduplicated(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, record_type and refers_to per row of ``pages``.

    Payloads of ``min_bytes`` and more are compared by SHA-1 and length; of
    equal ones the row with the largest page_id is the response (all rows of
    that id, should it be repeated), the others revisit it. A null id is less
    than any other; rows of a payload that has null ids only are responses.
    The groups of more than one row are broadcast if they are few (checked).
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("__sha"), F.octet_length("payload").alias("__n"))
    groups = (rows.filter(F.col("__n") >= min_bytes).groupBy("__sha", "__n")
              .agg(F.max("page_id").alias("__keeper"), F.count("*").alias("__c"))
              .filter("__c > 1").drop("__c"))
    rows = rows.join(bounded(keep(groups)), ["__sha", "__n"], "left")
    revisits = F.col("__keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__keeper"))
    return rows.select("page_id", "url", "payload",
                       F.when(revisits, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisits, F.col("__keeper")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, compress: bool = True,
                   per_file: int = RECORDS_PER_FILE) -> None:
    """``records`` (see ``deduplicated``) as WARC files of at most ``per_file``
    records in the new folder ``path``."""
    rows = map_arrow(records, _writer(compress), "value binary")
    sep = EMPTY_MEMBER.decode("latin-1") if compress else "\r\n"
    (rows.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", sep).option("maxRecordsPerFile", per_file).text(path))


# -- reading

class Invalid(Exception):
    """A check that failed, as the reason of a gap."""


def _header(raw: bytes) -> dict[str, str]:
    lines = raw.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", lines[0]):
        raise Invalid("no version line")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Invalid("broken header line")
        out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not out.get("content-length", "").isdecimal():
        raise Invalid("no length in the header")
    if not {"warc-type", "warc-record-id", "warc-date"} <= out.keys():
        raise Invalid("a required header field is missing")
    return out


def _checked(head: dict[str, str], block: bytes, strict: bool) -> tuple[dict[str, str], bytes]:
    want = head.get("warc-block-digest", "")
    if strict and not want:
        raise Invalid("no block digest")
    if want.startswith("sha1:") and want[5:] != digest(block):
        raise Invalid("block digest differs")
    want = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "response" and want.startswith("sha1:"):
        if want[5:] != digest(_payload(head, block)[1]):
            raise Invalid("payload digest differs")
    return head, block


def _payload(head: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP header fields and the bytes after them."""
    if not head.get("content-type", "").startswith("application/http"):
        return {}, block
    raw, _, payload = block.partition(b"\r\n\r\n")
    pairs = (line.partition(b":") for line in raw.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("latin-1")
            for k, _, v in pairs}, payload


def _plain_at(data: bytes, at: int, strict: bool) -> tuple[int, dict[str, str], bytes]:
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Invalid("header does not end")
    head = _header(data[at:end])
    a, b = end + 4, end + 4 + int(head["content-length"])
    if data[b:b + 4] != b"\r\n\r\n":
        raise Invalid("record does not end where its length says")
    return (b + 4, *_checked(head, data[a:b], strict))


def _member_at(data: bytes, at: int, strict: bool) -> tuple[int, dict[str, str] | None, bytes]:
    """Inflates step by step: bytes that do not start a record, or go beyond
    the declared length, end it at once, so a broken member costs no more
    than it claims to hold. An empty member has no header."""
    view, d, out = memoryview(data), zlib.decompressobj(31), bytearray()
    head, start, feed, pos, full = None, 0, b"", at, False
    while not d.eof:
        if not feed and not full:  # nothing is held back inside either
            feed = view[pos:pos + _STEP]
            pos += len(feed)
            if not feed:
                raise Invalid("member is cut off")
        try:
            piece = d.decompress(feed, _STEP)
        except zlib.error as e:
            raise Invalid("broken gzip member") from e
        out += piece
        feed, full = d.unconsumed_tail, len(piece) == _STEP
        if out and not out.startswith(VERSION[:len(out)][:6]):
            raise Invalid("member holds no record")
        if head is None:
            end = out.find(b"\r\n\r\n")
            if end >= 0:
                head, start = _header(bytes(out[:end])), end + 4
        if head is not None and len(out) > start + int(head["content-length"]) + 4:
            raise Invalid("member is longer than its record")
    after = pos - len(d.unused_data)
    if not out:
        return after, None, b""
    if head is None:
        raise Invalid("header does not end")
    stop = start + int(head["content-length"])
    if bytes(out[stop:]) != b"\r\n\r\n":
        raise Invalid("record does not end where its length says")
    return (after, *_checked(head, bytes(out[start:stop]), strict))


def _at(data: bytes, at: int, strict: bool) -> tuple[int, dict[str, str] | None, bytes]:
    if data.startswith(b"\x1f\x8b\x08", at):
        return _member_at(data, at, strict)
    if data.startswith(b"WARC/1.", at):
        return _plain_at(data, at, strict)
    raise Invalid("neither a member nor a version line")


def walk(data: bytes, strict: bool = True
         ) -> Iterator[tuple[int, int, str | None, dict[str, str] | None, bytes]]:
    """(offset, length, None, header, block) of the valid records of a file
    (no header: an empty member)
    and (offset, length, reason, None, b"") of the gaps, in order."""
    at = 0
    while at < len(data):
        try:
            after, head, block = _at(data, at, strict)
        except Invalid as e:
            why, begin = str(e), at
            while True:
                m = _START.search(data, at + 1)
                at = m.start() if m else len(data)
                if not m:
                    break
                try:
                    _at(data, at, strict)
                except Invalid:
                    continue
                break
            yield begin, at - begin, why, None, b""
            continue
        yield at, after - at, None, head, block
        at = after


SCHEMA = ("file string, offset long, length long, problem string, record_id string, page_id long, "
          "url string, record_type string, refers_to_id string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_FIELDS = [f.split() for f in SCHEMA.split(", ")]
_ARROW = pa.schema([(n, _TYPES[t]) for n, t in _FIELDS])


def _page_of(record_id: str | None) -> int | None:
    m = _PAGE.match(record_id or "")
    return int(m[1]) if m and m[1] not in ("", "-") else None


def _row(file: str, at: int, size: int, head: dict[str, str], block: bytes, payloads: bool) -> dict:
    http, payload = _payload(head, block)
    kind = head.get("warc-type")
    sha = head.get("warc-payload-digest", "")
    row = {"file": file, "offset": at, "length": size, "record_id": head.get("warc-record-id"),
           "page_id": _page_of(head.get("warc-record-id")), "url": head.get("warc-target-uri"),
           "record_type": kind, "refers_to_id": head.get("warc-refers-to"),
           "refers_to": _page_of(head.get("warc-refers-to"))}
    if kind == "revisit":  # of the full payload, which stands elsewhere
        n = http.get("content-length", "")
        return row | {"payload_bytes": int(n) if n.isdecimal() else None,
                      "payload_digest": sha.removeprefix("sha1:") or None}
    return row | {"payload_bytes": len(payload), "payload_digest": digest(payload),
                  "payload": payload if payloads else None}


def _reader(payloads: bool, strict: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                file, data = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                out, held = [], 0
                for at, size, problem, head, block in walk(data, strict):
                    if problem is not None:
                        out.append({"file": file, "offset": at, "length": size, "problem": problem})
                    elif head is not None:
                        out.append(_row(file, at, size, head, block, payloads))
                        held += len(block) if payloads else 0
                    if len(out) >= 4096 or held >= 1 << 24:
                        yield pa.RecordBatch.from_pylist(out, _ARROW)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, _ARROW)

    return run


def salvage(spark: SparkSession, path: str, payloads: bool = True, strict: bool = True) -> DataFrame:
    """All records and gaps of the WARC files in ``path``, plain or of gzip
    members, also mixed: file, offset, length (of empty members between
    records nothing is reported), problem (null for a record, else why the
    gap was quarantined), record_id, page_id, url, record_type, refers_to_id,
    refers_to, payload_bytes, payload_digest (of the full payload, for a
    revisit as its record says), payload (null for a revisit, and without
    ``payloads``). A file is one row of one task; an empty file gives nothing.
    With ``strict`` a record without a block digest is no valid one: nothing
    tells whether its bytes are as written. The header of a plain record has no
    checksum of its own, so damage that leaves it well-formed goes unseen.
    A broken record whose payload itself holds a whole valid record lets that
    one through, as nothing tells them apart."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_arrow(files, _reader(payloads, strict), SCHEMA)


def records(salvaged: DataFrame) -> DataFrame:
    return salvaged.filter("problem IS NULL")


def gaps(salvaged: DataFrame) -> DataFrame:
    """The quarantine log: file, offset, length, problem."""
    return salvaged.filter("problem IS NOT NULL").select("file", "offset", "length", "problem")


def lost_targets(salvaged: DataFrame) -> DataFrame:
    """refers_to_id of revisits whose response was not recovered, with how
    many revisit it (counted before anything is joined)."""
    wanted = (records(salvaged).filter("record_type = 'revisit'")
              .groupBy("refers_to_id").agg(F.count("*").alias("revisits")))
    have = records(salvaged).filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"))
    return wanted.join(have, "refers_to_id", "left_anti")


def archive(pages: DataFrame, path: str, compress: bool = True) -> DataFrame:
    """``pages`` (page_id, url, html) written to ``path`` and read back: one row per
    page as ``records`` gives it, without the payloads.

    A null html is the empty payload; a null url has no address; white space
    and other characters outside ASCII in an address are percent-encoded.
    Repeated rows give equal rows; no rows give no rows; other columns are
    ignored.
    """
    write_archives(deduplicated(pages), path, compress)
    return records(salvage(pages.sparkSession, path, payloads=False))
