"""Operator 12: exact round trips, the SQL, and archives damaged on purpose."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from pulsehouse.llm import warc
from pulsehouse.llm.oracle import ORACLE_SQL
from pulsehouse.llm.queries import op12_warc
from pulsehouse.session import new_run_dir

SF = "/root/testdata/sf0.001"


def b32(x: bytes) -> str:
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


def parts(path):
    return sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"))


def pages(n, seed=1):
    r = random.Random(seed)
    return [(i, f"http://h/{i}", "".join(r.choice("abc <>\r\né") for _ in range(r.randint(0, 900))))
            for i in range(n)]


def blob(rows, compress):
    """A file as the writer makes it, and where its records start."""
    out, starts = b"", []
    for i, url, html in rows:
        starts.append(len(out))
        data = warc.record(i, url, html.encode(), "response", None)
        out += warc.gzip_member(data) + warc.EMPTY_MEMBER if compress else data
    return out, starts


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF}/pages.parquet')")
    want = sorted(con.execute(ORACLE_SQL["op12_warc"]).fetchall())
    got = op12_warc(spark, SF)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert got.columns == cols
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("compress", [True, False])
def test_odd_pages(spark, compress):
    body = "same " * 50
    rows = [(1, "u1", body), (2, "u 2\r\nX: y", body), (3, None, body), (4, "u4", None), (5, "u5", ""),
            (6, "é", "é\x00\r\n\r\nWARC/1.1\r\n\r\n"), (None, "n", body), (None, "n", "only null"),
            (7, "u7", "x" * 3_000_000), (8, "u8", "twice"), (8, "u8", "twice"), (9, "u9", "\x1f\x8b\x08")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS payload", "2 AS record_type", "3 AS keeper")
    path = new_run_dir(spark, "test_warc")
    got = warc.archive(df, path, compress)
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        data, k = (h or "").encode(), best[h or ""]
        new = k in (-1, i)
        want.append((i, len(data), b32(data), "response" if new else "revisit", None if new else k))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(want, key=repr)
    whole = warc.salvage(spark, path)
    assert warc.gaps(whole).count() == 0 and warc.lost_targets(whole).count() == 0
    back = {(r.page_id, bytes(r.payload).decode()) for r in
            warc.records(whole).filter("record_type = 'response'").collect()}
    assert back == {(w[0], h or "") for w, (_, _, h) in zip(want, rows, strict=True)
                    if w[3] == "response"}
    assert warc.archive(df.limit(0), new_run_dir(spark, "test_warc")).count() == 0


def test_files_are_standard_gzip_and_bounded(spark):
    df = spark.createDataFrame(pages(50), "page_id long, url string, html string").coalesce(1)
    path = new_run_dir(spark, "test_warc")
    warc.write_archives(warc.deduplicated(df), path, per_file=20)
    files = parts(path)
    assert len(files) == 3
    text = b"".join(gzip.open(f).read() for f in files)
    plain = new_run_dir(spark, "test_warc")
    warc.write_archives(warc.deduplicated(df), plain, compress=False)
    assert text == b"".join(open(f, "rb").read() for f in parts(plain))


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_damage_costs_only_the_records_it_touches(compress, seed):
    r = random.Random(seed)
    rows = pages(60, seed)
    data, starts = blob(rows, compress)
    ends = [*starts[1:], len(data)]
    hurt, cuts = bytearray(data), []
    for _ in range(5):  # overwritten, removed and inserted stretches, from the back
        cuts.append((r.randrange(len(data) - 200), r.randint(1, 150), r.choice(("write", "cut", "put"))))
    broken = set()
    for at, n, how in sorted(cuts, reverse=True):
        if how == "write":
            hurt[at:at + n] = bytes(b ^ 0x55 for b in hurt[at:at + n])
        elif how == "cut":
            del hurt[at:at + n]
        else:
            hurt[at:at] = bytes(r.randrange(256) for _ in range(n))
        broken |= {k for k, (a, b) in enumerate(zip(starts, ends, strict=True))
                   if a < at + (0 if how == "put" else n) and at < b}
    got, total = {}, 0
    for at, n, problem, head, block in warc.walk(bytes(hurt)):
        assert at == total
        total += n
        if problem is None and head is not None:
            got[warc._page_of(head["warc-record-id"])] = warc._payload(head, block)[1]
    assert total == len(hurt)
    for k, (i, _, html) in enumerate(rows):
        if k not in broken:
            assert got[i] == html.encode()
    if compress:  # the member's checksum covers the header too
        assert all(got[i] == rows[i][2].encode() for i in got)
    assert set(got.values()) <= {x[2].encode() for x in rows}


def test_false_starts_and_mixed_formats():
    a, b, c = (warc.record(i, "u", f"page {i}".encode() * 40, "response", None) for i in range(3))
    torn = warc.gzip_member(a)[:-1]  # its checksum is short by a byte
    fakes = b"\x1f\x8b\x08 WARC/1.1\r\nno header WARC/1.x " + b"\x1f\x8b\x08" * 5
    bomb = warc.gzip_member(b"\x00" * 10_000_000) + warc.gzip_member(
        b"WARC/1.1\r\nWARC-Type: x\r\nWARC-Record-ID: y\r\nWARC-Date: z\r\nContent-Length: 3\r\n\r\n"
        + b"0" * 10_000_000)
    data = torn + fakes + b + bomb + warc.gzip_member(c) + c[:-1]
    seen = [(p, h and warc._page_of(h["warc-record-id"])) for _, _, p, h, _ in warc.walk(data)]
    assert [i for p, i in seen if p is None] == [1, 2]
    assert [p for p, _ in seen if p] == ["broken gzip member", "member holds no record",
                                         "record does not end where its length says"]
    changed = a.replace(b"page 0", b"page 9", 1)
    assert [x[2] for x in warc.walk(changed + b)] == ["block digest differs", None]
    bare = re.sub(rb"WARC-Block-Digest.*?\r\n", b"", a)
    assert [x[2] for x in warc.walk(bare)] == ["no block digest"]
    assert [x[2] for x in warc.walk(bare, strict=False)] == [None]
    assert list(warc.walk(b"")) == [] and [x[1] for x in warc.walk(b"junk")] == [4]


def test_gaps_and_lost_targets_of_a_damaged_archive(spark):
    body = "shared " * 30
    df = spark.createDataFrame([(i, "u", body if i < 5 else f"page {i}") for i in range(20)],
                               "page_id long, url string, html string").coalesce(1).sortWithinPartitions("page_id")
    path = new_run_dir(spark, "test_warc")
    warc.write_archives(warc.deduplicated(df), path, compress=False)
    (file,) = parts(path)
    data = open(file, "rb").read()
    at = data.index(body.encode())  # only the response, page 4, holds it
    os.makedirs(hurt := new_run_dir(spark, "test_warc").removeprefix("file:"))
    with open(f"{hurt}/one.warc", "wb") as f:
        f.write(data[:at] + b"?" + data[at + 1:])
    seen = warc.salvage(spark, hurt)
    (gap,) = warc.gaps(seen).collect()
    assert gap.problem == "block digest differs" and gap.offset < at < gap.offset + gap.length
    assert sorted(r.page_id for r in warc.records(seen).collect()) == [i for i in range(20) if i != 4]
    (lost,) = warc.lost_targets(seen).collect()
    assert lost.revisits == 4 and warc._page_of(lost.refers_to_id) == 4
    assert seen.agg(F.sum("length")).first()[0] == len(data)
