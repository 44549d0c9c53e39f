"""WARC records in a content-addressed archive, with DataFrame functions.

An archive is a folder with two tables. ``payloads`` holds the bytes of each distinct payload
once, under their SHA-256 digest. ``headers`` holds the exact header block of each record, as
it stands in a WARC/1.1 file, under the digest of its payload. Records whose payload of at
least ``REVISIT`` bytes is that of a record with a smaller id are revisits of it.

Only the first row of each digest in a task is shuffled for ``payloads`` (the planner limits a
ranking before it shuffles); ``headers`` are made from ids, addresses and digests alone. Read
back, every payload's bytes are hashed again, and a digest that differs, or a header without
its payload, ends the job with an error.

Defined results: a null html is an empty payload; a row without page_id is a revisit if any
row with an id has its payload of that size, and a response otherwise; rows that repeat a
page_id each give a record; a null url is written as an empty one; characters of a url that
would end or break a header line are written as percent codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.llm.common import table
from caseweave.workspace import new_folder

REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _hashed(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    return pages.select(
        "page_id",
        "url",
        F.sha2("payload", 256).alias("digest"),
        F.octet_length("payload").cast("long").alias("size"),
        "payload",
    )


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def header_block() -> Column:
    """The header of a record with page_id, url, digest, size, first_id (of its payload)."""
    own = F.col("page_id").eqNullSafe(F.col("first_id"))
    revisit = ~own & F.col("first_id").isNotNull() & (F.col("size") >= REVISIT)
    url = F.coalesce("url", F.lit(""))
    for code in ("\r", "\n"):
        url = F.replace(url, F.lit(code), F.lit(f"%{ord(code):02X}"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, line("WARC-Refers-To", record_id(F.col("first_id")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("size").cast("string"))),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, folder: str) -> str:
    hashed = _hashed(pages)
    first = Window.partitionBy("digest").orderBy(F.col("page_id").asc_nulls_last())
    payloads = hashed.withColumn("place", F.row_number().over(first)).where("place = 1")
    payloads = payloads.select("digest", F.col("page_id").alias("first_id"), "payload")
    payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    firsts = pages.sparkSession.read.parquet(f"{folder}/payloads").select("digest", "first_id")
    headers = hashed.drop("payload").join(firsts, "digest")
    headers = headers.select("digest", header_block().cast("binary").alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{folder}/headers")
    return folder


def verified_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, payload) of the archive; the job fails where the bytes have another digest."""
    stored = spark.read.parquet(f"{folder}/payloads").select("digest", "payload")
    hashed = F.sha2("payload", 256)
    checked = F.when(hashed == F.col("digest"), hashed).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest"))
    )
    return stored.select(checked.cast("string").alias("digest"), "payload")


def _fields(headers: DataFrame) -> DataFrame:
    text = F.col("header").cast("string")
    field = lambda name, what: F.regexp_extract(text, f"\\r\\n{name}: {what}\\r\\n", 1)
    number = lambda value: F.when(value != "", value.cast("long"))
    return headers.select(
        number(field("WARC-Record-ID", "<urn:page:(-?[0-9]*)>")).alias("page_id"),
        field("WARC-Target-URI", "([^\\r]*)").alias("url"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        number(field("WARC-Refers-To", "<urn:page:(-?[0-9]*)>")).alias("refers_to"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("payload_digest"),
        "digest",
        "header",
    )


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record, from its header and from the payload that its digest leads to."""
    sizes = verified_payloads(spark, folder)
    sizes = sizes.select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    found = _fields(spark.read.parquet(f"{folder}/headers")).join(sizes, "digest", "left")
    size = F.when(F.col("payload_bytes").isNull(), F.raise_error(F.lit("a payload is missing")))
    return found.select(
        "page_id",
        "url",
        size.otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, record_type, payload, record): the bytes of each record as in a WARC file, and
    its payload, which a revisit has from the record that it refers to."""
    found = _fields(spark.read.parquet(f"{folder}/headers"))
    found = found.join(verified_payloads(spark, folder), "digest")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat("header", body, F.lit(b"\r\n\r\n"))
    return found.select("page_id", "record_type", "payload", record.alias("record"))


def op10_warc(spark, folder: str) -> DataFrame:
    archive = write_archive(table(spark, folder, "pages"), new_folder(spark, "archive"))
    return read_index(spark, archive).drop("url")


OP10_SQL = """
WITH hashed AS (
  SELECT page_id, sha256(coalesce(html, '')) AS digest,
    CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS size FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM hashed
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""
