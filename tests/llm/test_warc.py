import hashlib
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from llm_cases import SF
from vigil.llm import warc
from vigil.llm.common import shared_path

SCHEMA = "page_id long, url string, html string"


def archive(spark, pages):
    path = shared_path(spark, "test-warc")
    warc.write(pages, path)
    return path


def brute(rows):
    top = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000 and i is not None:
            top[html] = max(i, top.get(html, i))
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        refers = top.get(html) if len(payload) >= 1000 and html in top and top[html] != i else None
        out.append((str(i), len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def rows(df):
    return sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


LONG = "é" * 400 + "\r\n\r\n" + "x" * 300
ODD = [(1, "http://a.b/c", LONG), (2, None, LONG), (9, "http://a.b/\r\nWARC-Type: revisit", LONG), (9, "u", LONG),
       (None, "u", LONG), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", "y" * 999),
       (8, "u", "y" * 999), (-3, "u", "z" * 1000), (-4, "u", "z" * 1000), (None, None, None), (10, "u", "q" * 300_000)]


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = archive(spark, pages)
    assert rows(warc.digests(warc.parse(warc.records(spark, path)))) == brute([tuple(r) for r in pages.collect()])


def test_odd_pages(spark):
    path = archive(spark, spark.createDataFrame(ODD, SCHEMA).withColumn("sha256", F.lit("clash")).withColumn("header", F.lit(1)))
    assert rows(warc.digests(warc.parse(warc.records(spark, path)))) == brute(ODD)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ODD})


def test_records_are_whole_and_exact(spark):
    path = archive(spark, spark.createDataFrame(ODD, SCHEMA))
    for r in warc.records(spark, path).collect():
        record = bytes(r.record)
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and all(re.match(r"[A-Za-z-]+: .", x) for x in lines[1:])
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert len(fields) == len(lines) - 1
        block, end = rest[:int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
        assert end == b"\r\n\r\n"
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        assert body == (bytes(r.payload) if fields["WARC-Type"] == "response" else b"")
        assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(bytes(r.payload)).hexdigest()
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_a_changed_payload_ends_the_job(spark):
    path = archive(spark, spark.createDataFrame(ODD[:2], SCHEMA))
    changed = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other"))
    other = shared_path(spark, "test-warc")
    changed.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    with pytest.raises(PySparkException, match="differs from its digest"):
        warc.digests(warc.parse(warc.records(spark, other))).collect()


def test_empty_table(spark):
    path = archive(spark, spark.createDataFrame([], SCHEMA))
    assert warc.digests(warc.parse(warc.records(spark, path))).count() == 0
