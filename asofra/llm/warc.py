"""Content-addressed web archive.

An archive is a folder of two tables. ``payloads`` holds the bytes of each
distinct payload once, under its SHA-256. ``headers`` holds the exact header
text of every record, its WARC fields and its HTTP header. A record is its
header joined with its payload.

The digest is verified: writing fails if two payloads share a SHA-256 but
differ in length or SHA-1, reading fails if stored bytes no longer have the
digest under which they are stored, or if a rebuilt record does not have the
length and digest that its own header states.

Payloads are written in buckets of their key, so that rebuilding records moves
headers to them and no payload bytes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups, new_path, table, written

#: RFC 4648 base32, and the digits that conv() writes in base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hex digits in eight groups of
    20 bits, each four base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def _field(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(CRLF))


def _record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), digest, F.lit(">"))


def _header(is_response: Column) -> Column:
    page, first, sha1 = F.col("page_id"), F.col("_first"), F.col("payload_digest")
    revisit = F.concat(
        _field("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        _field("WARC-Refers-To", _record_id(first, sha1)),
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"), _field("Content-Type", "text/html; charset=utf-8"),
        _field("Content-Length", F.col("_bytes").cast("string")), F.lit(CRLF),
    )
    size = F.when(is_response, F.octet_length(http) + F.col("_bytes")).otherwise(F.lit(0))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        _field("WARC-Record-ID", _record_id(page, sha1)),
        _field("WARC-Date", DATE),
        # a line break in an address would end the field
        _field("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(is_response, F.lit("")).otherwise(revisit),
        _field("Content-Type", F.when(is_response, "application/http; msgtype=response").otherwise("text/html; charset=utf-8")),
        _field("Content-Length", size.cast("string")),
        F.lit(CRLF),
        F.when(is_response, http).otherwise(F.lit("")),
    )


def write_archive(pages: DataFrame, path: str, smallest: int = 0) -> str:
    """Archive ``pages`` (page_id, url, html) under ``path``.

    Of records with equal payloads of at least ``smallest`` bytes, the one
    with the smallest page_id is the response and the others revisit it;
    smaller payloads are responses all. A null html is an empty payload, a
    null url an empty address, a null page_id the last choice for a response.
    Rows repeated under one page_id with one payload are the same record
    written again, each of the group's type. Other columns are ignored.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digested = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest"),
        base32_sha1(F.col("payload")).alias("payload_digest"), F.octet_length("payload").cast("long").alias("_bytes"),
    )
    signed = written(digested.drop("payload"), "warc-signed")
    groups = written(
        signed.groupBy("digest").agg(
            F.min("page_id").alias("_first"), F.count("*").alias("_n"),
            (F.max("payload_digest") != F.min("payload_digest")).alias("_clash"),
            (F.max("_bytes") != F.min("_bytes")).alias("_clash2"),
        ),
        "warc-groups",
    )
    if not groups.where("_clash OR _clash2").isEmpty():
        raise ValueError("two different payloads have one SHA-256")
    # one exchange moves the payloads: the semi join and the rows repeated
    # under one page_id share its keys
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none")).alias("_page")
    first = groups.select("digest", F.col("_first").alias("page_id")).select("digest", page)
    keys = ["digest", "_page"]
    kept = digested.select("digest", page, "payload").join(first, keys, "left_semi").dropDuplicates(keys)
    spark = pages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"payloads_{uuid.uuid4().hex}"
    kept.withColumnRenamed("_page", "holder").write.option("compression", "zstd").option("path", f"{path}/payloads").bucketBy(
        buckets, "digest", "holder"
    ).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name goes, the files stay
    is_first = F.col("page_id").eqNullSafe(F.col("_first"))
    is_response = is_first | (F.col("_bytes") < smallest)
    holder = F.coalesce(F.col("_first").cast("string"), F.lit("none")).alias("holder")
    join_groups(signed, groups, ["digest"], "_n").select(
        "page_id", "digest", holder, F.when(is_first, "holder").when(is_response, "copy").otherwise("revisit").alias("role"),
        F.lit(buckets).alias("buckets"), _header(is_response).alias("header"),
    ).write.option("compression", "zstd").parquet(f"{path}/headers")
    return path


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, holder, payload), one row a distinct payload and none of an
    empty archive; an altered payload raises an error."""
    of = spark.read.parquet(f"{path}/headers").select("buckets").first()
    if of is None:
        return spark.createDataFrame([], "digest string, holder string, payload binary")
    name = f"payloads_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (digest STRING, holder STRING, payload BINARY) USING parquet "
        f"CLUSTERED BY (digest, holder) INTO {of[0]} BUCKETS LOCATION '{path}/payloads'"
    )
    wrong = F.raise_error(F.concat(F.lit("payload does not have its digest "), F.col("digest"))).cast("binary")
    return spark.table(name).select(
        "digest", "holder", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong).alias("payload")
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record): the bytes of each original record, header and block.

    A revisit has no block; its payload is in the record it refers to. Only
    responses are joined with bytes, each at the payload's own bucket. Page
    ids may be null, a record written twice comes twice, an empty archive has
    no records.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), read_payloads(spark, path)
    whole = F.concat(F.encode("header", "UTF-8"), F.col("payload")).alias("record")
    # headers are hashed bucket by bucket, payloads neither move nor sort
    own = headers.where("role = 'holder'").hint("shuffle_hash")
    out = payloads.join(own, ["digest", "holder"]).select("page_id", whole)
    copies = headers.where("role = 'copy'")
    if not copies.isEmpty():  # payloads below the size that is stored as a revisit
        counts = copies.groupBy("digest").agg(F.count("*").alias("_n"))
        small = payloads.drop("holder").join(counts, "digest")
        out = out.unionByName(join_groups(copies, small, ["digest"], "_n").select("page_id", whole))
    return out.unionByName(headers.where("role = 'revisit'").select("page_id", F.encode("header", "UTF-8").alias("record")))


def parsed(records: DataFrame) -> DataFrame:
    """Records (page_id, record) read as WARC: page_id, url, record_type,
    payload_digest and payload_bytes (null for a revisit, which has no block)
    and refers_to. A record whose block does not have the length and the
    digest that its header states raises an error."""
    text = F.decode("record", "ISO-8859-1")
    head = F.substring_index(text, CRLF * 2, 1)
    rows = records.select("page_id", "record", F.concat(head, F.lit(CRLF)).alias("head")).withColumn(
        "block", F.expr("substring(record, octet_length(encode(head, 'ISO-8859-1')) + 3)")
    )
    field = lambda name, form: F.regexp_extract("head", rf"(?m)^{name}: {form}\r\n", 1)
    response = field("WARC-Type", r"(\w+)") == "response"
    http = F.substring_index(F.decode("block", "ISO-8859-1"), CRLF * 2, 1)
    payload = F.expr("substring(block, http_length + 5)")
    rows = rows.withColumn("http_length", F.char_length(http)).withColumn("payload", F.when(response, payload))
    refers = F.regexp_extract("head", r"(?m)^WARC-Refers-To: <urn:page:([^:]*):", 1)
    found = rows.select(
        "page_id", field("WARC-Type", r"(\w+)").alias("record_type"),
        F.decode(F.encode(field("WARC-Target-URI", r"(.*)"), "ISO-8859-1"), "UTF-8").alias("url"),
        field("WARC-Payload-Digest", r"sha1:(\w+)").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(refers.rlike("^-?[0-9]+$"), refers.cast("long")).alias("refers_to"),
        (field("Content-Length", r"(\d+)").cast("long") == F.octet_length("block")).alias("_long"),
        F.when(response, base32_sha1(F.col("payload"))).alias("_sha1"),
    )
    good = F.col("_long") & (F.col("_sha1").isNull() | (F.col("_sha1") == F.col("payload_digest")))
    wrong = F.raise_error(F.concat(F.lit("record differs from its header: "), F.col("payload_digest"))).cast("string")
    return found.withColumn("payload_digest", F.when(good, F.col("payload_digest")).otherwise(wrong)).drop("_long", "_sha1")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record as of ``parsed``, read from the rebuilt bytes of
    each; a revisit has the payload_bytes of what it refers to, by digest."""
    found = written(parsed(reconstruct(spark, path)), "warc-records")
    revisits = found.where("record_type = 'revisit'")
    sizes = found.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    counted = written(sizes.join(revisits.groupBy("payload_digest").agg(F.count("*").alias("_n")), "payload_digest"), "warc-measured")
    return found.where("record_type = 'response'").unionByName(join_groups(revisits.drop("payload_bytes"), counted, ["payload_digest"], "_n").drop("_n"))


def export_files(spark: SparkSession, path: str, out: str) -> None:
    """Write the records as WARC files, each ended by two line breaks."""
    reconstruct(spark, path).select(F.decode("record", "UTF-8").alias("record")).write.option("lineSep", CRLF * 2).text(out)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record) of the records in WARC files below ``path``, cut by
    their stated lengths; page_id from the record's id, null if it has none.
    A file is read whole, so it must be below 2 GB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                raw, at, ids, records = content.as_py(), 0, [], []
                while at < len(raw):
                    head = raw.index(b"\r\n\r\n", at) + 4
                    end = head + int(re.search(rb"^Content-Length: (\d+)\r$", raw[at:head], re.M)[1])
                    page = re.search(rb"^WARC-Record-ID: <urn:page:(-?\d+):", raw[at:head], re.M)
                    ids.append(int(page[1]) if page else None)
                    records.append(raw[at:end])
                    if raw[end : end + 4] != b"\r\n\r\n":
                        raise ValueError("a record does not end where its header says")
                    at = end + 4
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(records, pa.binary())], ["page_id", "record"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id long, record binary")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archive(table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS keep
  FROM p
)
SELECT page_id, payload_bytes,
       translate(
         (SELECT string_agg(to_base(CAST('0x' || substr(h, 1 + 5 * k, 5) AS BIGINT), 32, 4), '' ORDER BY k)
          FROM range(8) r(k)),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM g
"""
