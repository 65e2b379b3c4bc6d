import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stormgrid.llm import warc
from stormgrid.session import work_path

SMALL = "/root/testdata/sf0.001"


def expected(rows, least=0):
    """Contract rows of (page_id, url, html), without telling rows alike in all three apart."""
    groups = {}
    for page_id, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((page_id, url))
    out = []
    for payload, members in groups.items():
        order = sorted(members, key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or ""))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for i, (page_id, _) in enumerate(order):
            last = i == len(order) - 1 or len(payload) < least
            out.append((page_id, len(payload), digest, "response" if last else "revisit", None if last else order[-1][0]))
    return sorted(out, key=repr)


def written(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string").repartition(3)
    path = work_path(spark, "warc-test")
    warc.write(frame, path, **options)
    return path


def found(spark, path, **options):
    got = warc.read(spark, path, **options)
    return sorted((tuple(r) for r in got.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, "<p>one</p>"), (4, "http://b\r\nX: y z", "Ünï\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", None), (6, "u", ""),
    (None, "n", "<p>one</p>"), (None, None, None), (None, "q", "only null ids"), (None, "r", "only null ids"), (7, "a", "tie"), (7, "b", "tie"), (8, "same", "rep"), (8, "same", "rep"), (8, "same", "rep"), (9, "x", "y" * 300_000),
]


@pytest.mark.parametrize("options", [{}, {"archive_bytes": 400}, {"least": 5}])
def test_written_and_read_back(spark, options):
    path = written(spark, ROWS, **options)
    want = expected(ROWS, options.get("least", 0))
    assert found(spark, path) == want


def test_archives_are_plain_warc(spark):
    path = written(spark, ROWS)
    index = spark.read.parquet(f"{path}/index").collect()
    seen = []
    for file in glob.glob(f"{path}/archives/*.warc.gz"):
        data = open(file, "rb").read()
        mine = sorted((r.offset, r.length) for r in index if r.archive == file.rsplit("/", 1)[1])
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))] and sum(n for _, n in mine) == len(data)
        rest = gzip.decompress(data)  # all members, one after the other
        while rest:
            head, body = rest.split(b"\r\n\r\n", 1)
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            headers = dict(line.split(b": ", 1) for line in lines[1:])
            n = int(headers[b"Content-Length"])
            assert body[n : n + 4] == b"\r\n\r\n"
            seen.append((headers[b"WARC-Type"], body[:n].split(b"\r\n\r\n", 1)[1]))
            rest = body[n + 4 :]
    assert sorted(p for t, p in seen if t == b"response") == sorted({(h or "").encode() for _, _, h in ROWS})
    assert len(seen) == len(ROWS) and all(p == b"" for t, p in seen if t == b"revisit")


def test_selected_records_and_payloads(spark):
    path = written(spark, ROWS)
    got = warc.read(spark, path, where=F.col("url") == "http://b\r\nX: y z", with_payload=True).collect()
    assert [(r.key, r.url, bytes(r.payload).decode()) for r in got] == [(4, "http://b%0D%0AX:%20y%20z", ROWS[3][2])]


def test_ranges_join_near_records_and_keep_to_stretches(spark):
    index = spark.createDataFrame([("a", o, n) for o, n in [(0, 10), (10, 10), (25, 5), (90, 20), (110, 300), (411, 5)]] + [("b", 0, 7)], "archive string, offset long, length long")
    got = sorted((r.archive, r.start, r.stop, list(r.offsets)) for r in warc.ranges(index, gap=10, read_bytes=100).collect())
    assert got == [("a", 0, 30, [0, 10, 25]), ("a", 90, 110, [90]), ("a", 110, 410, [110]), ("a", 411, 416, [411]), ("b", 0, 7, [0])]


def test_damaged_payload_is_noticed(spark):
    path = written(spark, [(1, "u", "abc" * 50)])
    file = glob.glob(f"{path}/archives/*.warc.gz")[0]
    raw = gzip.decompress(open(file, "rb").read()).replace(b"abcabc", b"abcabd", 1)
    squeezed = gzip.compress(raw, mtime=0)
    open(file, "wb").write(squeezed)
    spark.read.parquet(f"{path}/index").withColumn("length", F.lit(len(squeezed)).cast("bigint")).write.parquet(f"{path}-new/index")
    import os

    os.symlink(f"{path}/archives", f"{path}-new/archives")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read(spark, f"{path}-new").collect()


def test_other_key_types_and_empty_table(spark):
    frame = spark.createDataFrame([("a b/ü", "u", "x"), ("", "u", "x"), (None, "u", "z")], "page_id string, url string, html string")
    path = work_path(spark, "warc-test")
    warc.write(frame, path)
    assert sorted(map(str, (r.key for r in warc.read(spark, path, "string").collect()))) == ["", "None", "a b/ü"]
    path = work_path(spark, "warc-test")
    warc.write(frame.limit(0), path)
    assert warc.read(spark, path, "string").collect() == []


def test_given_table(spark):
    from stormgrid.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op11_warc"](spark, SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
