"""Content-addressed WARC archive.

The archive is two tables in the shared folder: ``headers`` keeps the exact
header text of every record, ``payloads`` keeps each distinct payload once
under its SHA-256. A record is rebuilt by joining the two; rebuilding hashes
the stored bytes again and fails on any difference in digest or length.

Records with equal payloads of at least ``min_revisit_bytes`` bytes: the one
with the largest id is the response, the others revisit it. Smaller payloads
are always responses (their bytes are stored once all the same).

Defined results: null html is an empty payload; a null url has no
WARC-Target-URI line; CR and LF inside a url are percent-encoded; a record
without an id is named ``none`` and revisits any record that has one; rows
that repeat an id are records of their own; an empty table gives an empty
archive; columns other than the three named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh_path, stash

CRLF = "\r\n"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{CRLF}{name}: "), value)


def write_archive(pages: DataFrame, root: str | None = None, id_col: str = "page_id",
                  url_col: str = "url", payload_col: str = "html",
                  min_revisit_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write the archive of ``pages`` under ``root`` (a new shared folder by
    default) and return that folder."""
    spark = pages.sparkSession
    root = root or fresh_path(spark, "warc")
    body = F.encode(F.coalesce(pages[payload_col], F.lit("")), "UTF-8")
    full = pages.select(pages[id_col].cast("bigint").alias("id"), pages[url_col].alias("url"),
                        body.alias("payload"))
    full = full.withColumn("key", F.sha2("payload", 256))
    # Every distinct payload once; equal ones meet in the tasks that read them
    # before any travels.
    full.groupBy("key").agg(F.first("payload").alias("payload")).write.parquet(f"{root}/payloads")

    thin = stash(full.select("id", "url", "key", F.sha1("payload").alias("digest"),
                             F.octet_length("payload").cast("bigint").alias("n")), "warc-index")
    lead = (thin.filter(F.col("n") >= min_revisit_bytes).groupBy(F.col("key").alias("k"))
            .agg(F.max("id").alias("leader")))
    rows = thin.join(lead, thin["key"] == lead["k"], "left")
    revisit = F.col("leader").isNotNull() & ~F.col("id").eqNullSafe(F.col("leader"))
    name = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        F.when(F.col("url").isNull(), "").otherwise(_line("WARC-Target-URI", url)),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Refers-To", F.concat(
            F.lit("<urn:page:"), F.col("leader").cast("string"), F.lit(">")))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")),
        F.lit(CRLF + CRLF))
    rows.select(head.alias("header"), "key").write.parquet(f"{root}/headers")
    return root


def _field(name: str, pattern: str) -> Column:
    return F.regexp_extract("header", f"\\r\\n{name}: {pattern}", 1)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """Records rebuilt from the archive: page_id, url, record_type,
    payload_digest, refers_to, payload (of the page, also for revisits),
    payload_bytes, and ``record``, the record's own bytes (a revisit has none
    of the payload). Broken content raises an error."""
    heads = spark.read.schema("header string, key string").parquet(f"{root}/headers")
    bodies = (spark.read.schema("key string, payload binary").parquet(f"{root}/payloads")
              .withColumnRenamed("key", "k"))
    kind = _field("WARC-Type", "([a-z]+)\\r\\n")
    stated = _field("Content-Length", "([0-9]+)\\r\\n").cast("bigint")
    size = F.octet_length("payload").cast("bigint")
    whole = heads.join(bodies, F.col("key") == F.col("k"), "left")
    digest = _field("WARC-Payload-Digest", "sha1:([0-9a-f]+)\\r\\n")
    right = (F.col("payload").isNotNull()
             & (F.sha2("payload", 256) == F.col("key"))
             & (F.sha1("payload") == digest)
             & (stated == F.when(kind == "revisit", F.lit(0)).otherwise(size)))
    checked = F.when(right, size).otherwise(
        F.raise_error(F.concat(F.lit("archive record does not match its digest: "),
                               F.col("key"))).cast("bigint"))
    block = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return whole.select(
        _field("WARC-Record-ID", "<urn:page:([-0-9]+)>").try_cast("bigint").alias("page_id"),
        F.regexp_extract("header", "\\r\\nWARC-Target-URI: ([^\\r]*)\\r\\n", 1).alias("url"),
        kind.alias("record_type"),
        digest.alias("payload_digest"),
        F.regexp_extract("header", "\\r\\nWARC-Refers-To: <urn:page:([-0-9]+)>", 1)
        .try_cast("bigint").alias("refers_to"),
        F.col("payload"), checked.alias("payload_bytes"),
        F.concat(F.encode(F.col("header"), "UTF-8"), block,
                 F.lit(b"\r\n\r\n")).alias("record"))
