import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from vigil.llm import warc


def pages_of(spark, rows):
    df = spark.createDataFrame(rows or [(1, "u", "h")], "page_id long, url string, html string")
    return df if rows else df.limit(0)


def brute(rows, least=1000):
    out = []
    for page_id, url, html in rows:
        body = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        again = len(body) >= least and same and (page_id is None or page_id < max(same))
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(),
                    "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", "x" * 999), (2, "http://a/2", "x" * 999), (3, "http://a/3", "y" * 1000),
        (4, "http://a/4", "y" * 1000), (5, None, "y" * 1000), (6, "http://a/6", None),
        (7, "http://a/7\r\nX: y", ""), (8, "u", "é" * 600 + "\r\n\r\nWARC/1.1\r\n\r\n"),
        (9, "v", "long " * 50_000), (9, "v", "long " * 50_000), (10, "w", "z" * 1200),
        (None, "n", "z" * 1200), (None, "n", "q" * 1200), (None, "n", "q" * 1200), (11, "", "\x00\n")]


@pytest.mark.parametrize("chunk", [7000, 1 << 16])
def test_round_trip(spark, chunk):
    pages = pages_of(spark, ROWS).repartition(4)
    chunks = warc.round_trip(spark, pages, chunk_bytes=chunk).cache()
    got = warc.records_of(chunks).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got], key=str) == brute(ROWS)
    stored = {}
    for r in sorted(chunks.filter("record_type = 'response' AND page_id IN (8, 10, 4)").collect(),
                    key=lambda r: r.chunk_no):
        assert len(r.data) <= chunk
        stored[r.page_id] = stored.get(r.page_id, b"") + bytes(r.data)
        assert hashlib.sha1(stored[r.page_id]).hexdigest() == r.sha1
    assert stored == {i: h.encode() for i, _, h in ROWS if i in stored}
    assert chunks.filter(f"octet_length(data) > {chunk}").count() == 0


def test_archives_are_gzip_members_of_warc_records(spark, tmp_path):
    manifest = warc.write_archives(warc.chunk_rows(pages_of(spark, ROWS)), f"file://{tmp_path}/w")
    files = [r.path for r in manifest.collect()]
    raw = b"".join(gzip.open(f).read() for f in files)
    assert raw.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)
    assert sum(r.records for r in manifest.collect()) == len(ROWS)
    assert raw.endswith(b"\r\n\r\n")


def archive(body, digest=None, length=None):
    digest = digest or hashlib.sha1(body).hexdigest()
    head = warc._headers(1, "u", digest, length or len(body), None)
    return pa.py_buffer(gzip.compress(head + body + b"\r\n\r\n"))


def test_damage_is_reported():
    good = list(warc.archive_chunks(io.BytesIO(archive(b"abc" * 10)), 8))
    assert [r[6] for r in good] == [0, 1, 2, 3] and good[-1][9] and b"".join(
        r[7] for r in good) == b"abc" * 10
    with pytest.raises(ValueError, match="digest"):
        list(warc.archive_chunks(io.BytesIO(archive(b"abc", "00" * 20)), 8))
    with pytest.raises(EOFError):
        list(warc.archive_chunks(io.BytesIO(archive(b"abc", length=500)), 8))


def test_empty(spark):
    assert warc.round_trip(spark, pages_of(spark, [])).count() == 0
