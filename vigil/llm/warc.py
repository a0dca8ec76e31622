"""Content-addressed web archive: payload bytes once per strong digest, exact record headers apart, joins to rebuild.

An archive is a folder with two Parquet tables. ``payloads``: sha256, payload; one row per distinct payload.
``records``: page_id, header and http (the exact bytes of the WARC header and of the HTTP header), sha256 (the
payload's address). A record's bytes are header, HTTP header and, for a response, its payload, rebuilt by a join.
Records differ only in headers, so a page that many records share costs its bytes once. All steps are DataFrame
expressions on binary columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Equal payloads of at least so many bytes are archived as revisits of one record.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
# FIXED VALUES of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD_ID = "urn:page:"


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null value. Control characters, which would end the line, are written as %XX."""
    safe = value.cast("string")
    for code in (0, 9, 10, 13):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def write(pages: DataFrame, path: str, min_bytes: int = REVISIT_BYTES, date: str = DATE, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html") -> None:
    """One record per row of ``pages``, in ``path``/records, and each distinct payload once, in ``path``/payloads.

    The payload is the html in UTF-8; a null is empty. Of records with equal payloads of at least ``min_bytes``, that
    with the largest id is the response, the others revisit it; smaller payloads are all responses. Repeated rows
    with that largest id are all responses; a row without an id revisits, or is a response if no equal row has an
    id. A null url writes no target line. Other columns are ignored. An empty table writes no row.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    # Equal payloads meet once per input task before the shuffle.
    rows.groupBy("sha256").agg(F.any_value("payload").alias("payload")).write.option("compression", "zstd").parquet(
        f"{path}/payloads")
    heads = rows.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"),
                        F.octet_length("payload").cast("long").alias("size"))
    largest = heads.where(F.col("size") >= min_bytes).groupBy("sha256").agg(F.max("page_id").alias("largest"))
    found = heads.join(largest, "sha256", "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size"), F.lit(CRLF + CRLF))
    name = F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    refers = F.when(revisit, F.concat(F.lit(f"<{RECORD_ID}"), F.col("largest"), F.lit(">")))
    header = F.concat(
        F.lit(VERSION + CRLF), _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", name), _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Profile", F.when(revisit, PROFILE)), _field("WARC-Refers-To", refers),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(F.col("http")) + F.when(revisit, 0).otherwise(F.col("size"))),
        F.lit(CRLF))
    records = found.withColumn("http", http.cast("binary")).select(
        "page_id", header.cast("binary").alias("header"), "http", "sha256")
    records.write.option("compression", "zstd").parquet(f"{path}/records")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record, payload): each record's exact bytes, and the full payload its digest names.

    A payload that does not have the digest it is stored under ends the job.
    """
    payloads = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("sha256"))).cast("binary"))
    heads = spark.read.parquet(f"{path}/records")
    stored = payloads.select("sha256", checked.alias("payload"))
    revisit = F.contains(F.col("header"), F.lit(f"{CRLF}WARC-Type: revisit{CRLF}").cast("binary"))
    return heads.join(stored, "sha256", "left").select(
        "page_id", F.concat("header", "http", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")),
                            F.lit(CRLF + CRLF).cast("binary")).alias("record"), "payload")


def _value(head: Column, name: str) -> Column:
    """The value of a header line; null without it."""
    line = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(line != "", line)


def parse(found: DataFrame) -> DataFrame:
    """What the bytes of rebuilt records say: page_id, record_type, refers_to, target, payload, payload_digest.

    ``found``: rows of :func:`records`. A response's payload is cut from its own record by its lengths; a revisit's is
    that of the record it refers to. payload_digest is the digest line without its prefix.
    """
    end = CRLF + CRLF
    text = F.col("record").cast("string")
    rows = found.withColumn("head", F.substring_index(text, end, 1))
    body = F.octet_length("head") + len(end)
    rows = rows.withColumn("block", F.substring("record", body + 1, _value(F.col("head"), "Content-Length").cast("int")))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), end, 1)) + len(end)
    kind = _value(F.col("head"), "WARC-Type")
    own = F.substring("block", http + 1, F.octet_length("block") - http)
    number = rf"<{RECORD_ID}(-?\d+)>"
    return rows.select(
        F.regexp_extract(_value(F.col("head"), "WARC-Record-ID"), number, 1).try_cast("long").alias("page_id"),
        kind.alias("record_type"),
        F.regexp_extract(_value(F.col("head"), "WARC-Refers-To"), number, 1).try_cast("long").alias("refers_to"),
        _value(F.col("head"), "WARC-Target-URI").alias("target"),
        F.when(kind == "response", own).otherwise(F.col("payload")).alias("payload"),
        F.substring(_value(F.col("head"), "WARC-Payload-Digest"), 6, 40).alias("payload_digest"))


def digests(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of parsed records.

    The digest is that of the payload read back; one that differs from the record's own line ends the job.
    """
    sha1 = F.sha1("payload")
    checked = F.when(sha1 == F.col("payload_digest"), sha1).otherwise(
        F.raise_error(F.concat(F.lit("record differs from its digest "), F.col("payload_digest"))))
    return found.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
                        checked.alias("payload_digest"), "record_type", "refers_to")
