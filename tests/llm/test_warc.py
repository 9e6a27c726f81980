import base64
import hashlib
import random

import pytest

from weirgate.llm import warc
from weirgate.session import scratch_path

PAGES = "page_id bigint, url string, html binary"


def expected(rows):
    best = {}
    for page_id, _, html in rows:
        if page_id is not None:
            best[html or b""] = max(best.get(html or b"", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        html = html or b""
        target = best.get(html)
        revisit = page_id is not None and page_id < target
        digest = base64.b32encode(hashlib.sha1(html).digest()).decode()
        out.append((page_id, len(html), digest, "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.fixture
def odd_pages():
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(300_000))
    rows = [
        (1, "http://a/", b"x"), (2, "http://b/", b"x"), (3, None, None), (4, "http://c/", b""), (5, "u\r\nX: y", "é ".encode()),
        (6, "u", noise), (7, "u", b"WARC/1.1\r\n" * 3), (8, "u", b"a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5000),
        (9, "u", b"\r\n\r\n"), (10, "u", b"line\n" * 40_000), (11, "u", b"z" * 65_536), (12, "u", b"z" * 65_537), (13, "u", noise),
        (14, "u", b"WAWAWARC/1.1\r\n" + b"W" * 70_000), (2, "http://b/", b"x"), (None, "n", b"x"), (None, None, b"n"), (None, None, b"n"),
        (15, "u", noise[:1000] + b"WARC/1.1\r\n" + noise[:70_000]),
    ]
    return rows + [(100 + i, "u", bytes([i % 7]) * 10) for i in range(50)]


def test_round_trip(spark, odd_pages):
    pages = spark.createDataFrame(odd_pages, PAGES).repartition(3)
    assert found(warc.round_trip(pages)) == expected(odd_pages)


def test_archives_split_anywhere(spark, odd_pages, with_conf):
    with_conf({"spark.sql.files.maxPartitionBytes": "7001", "spark.sql.files.openCostInBytes": "0"})
    pages = spark.createDataFrame(odd_pages, PAGES).coalesce(1)
    assert found(warc.round_trip(pages)) == expected(odd_pages)


def test_chunks_carry_running_digests(spark, odd_pages):
    path = scratch_path(spark, "warc")
    pages = spark.createDataFrame([r for r in odd_pages if r[0] == 8], PAGES)
    warc.write(pages, path, "page_id", "url", "html", chunk_bytes=1000)
    payload, length, digest = odd_pages[7][2], 0, hashlib.sha1()
    chunks = {r.chunk: r.payload for r in warc.read_chunks(spark, path).collect()}
    rows = sorted(warc.chunk_table(warc.read_chunks(spark, path)).collect(), key=lambda r: r.chunk)
    assert [r.chunk for r in rows] == list(range(1, len(rows) + 1)) and len(rows) > 5000
    for r in rows:
        assert len(chunks[r.chunk]) <= 1000
        digest.update(chunks[r.chunk])
        length += len(chunks[r.chunk])
        assert (r.length, r.digest) == (length, base64.b32encode(digest.digest()).decode())
    assert b"".join(chunks[k] for k in sorted(chunks)) == payload


def test_archive_is_well_formed(spark, odd_pages):
    """Read the files byte by byte, by Content-Length only."""
    from pathlib import Path

    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame(odd_pages, PAGES).coalesce(1), path, "page_id", "url", "html")
    data = b"".join(f.read_bytes() for f in sorted(Path(path).glob("part-*")))
    at, kinds, ids = 0, [], set()
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        ids.add(fields["WARC-Record-ID"])
        kinds.append(fields["WARC-Type"])
        at = end + 4 + int(fields["Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert len(ids) == len(kinds) and kinds.count("continuation") > 5 and kinds.count("revisit") > 40


def test_missing_segment_is_noticed(spark, odd_pages):
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame([r for r in odd_pages if r[0] == 6], PAGES), path, "page_id", "url", "html")
    with pytest.raises(Exception, match="is missing"):
        warc.chunk_table(warc.read_chunks(spark, path).where("chunk <> 2")).collect()


def test_no_rows_and_extra_columns(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
    pages = spark.createDataFrame([(1, "u", b"a", "d", 2, "o")], PAGES + ", digest string, row bigint, origin string")
    assert found(warc.round_trip(pages)) == expected([(1, "u", b"a")])
