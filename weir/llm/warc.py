"""Content-addressed WARC archive.

A record's payload is stored once under its SHA-256, whatever the number of
records that carry it; the record's header block is stored exactly, apart from
it, with the digest. Reading joins the two, checks every payload against its
length and digest, rebuilds the original record (header block, content block,
closing lines) and checks its content block against the block digest its own header
names. All steps are SQL expressions; only ids and digests are shuffled to find who
holds a payload, and payloads once to rebuild the records.

Of records with equal payloads of at least `revisit_from` bytes, that with the
largest page id is a response and the others are revisits that refer to it;
smaller payloads are all responses.

Defined cases: a null html is an empty payload; a null url gives an empty target
URI; line breaks in a url are percent-encoded, since they would end a header
line; a null page_id takes part with the smallest rank (a response only if no
other page has its payload); repeated rows are records of their own (equal ids
and payloads: all are responses, of one record id); a payload may have any length
that a cell holds; further columns of any name stay out of the plan; an empty table
gives an empty archive. Pages carry no time of capture, so WARC-Date is `captured`,
the time of writing unless the caller has another.
"""

from __future__ import annotations

from hashlib import sha1

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from weir.session import scratch_path

REVISIT_FROM = 1000  # bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
CRLF = "\r\n"
EMPTY_SHA1 = sha1(b"").hexdigest()


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("unknown")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM, captured: Column | None = None) -> None:
    """Two tables under `path`: headers (one row per record) and payloads (one
    row per distinct payload)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    sized = rows.select(
        "page_id", F.coalesce("page_id", F.lit(-(2**63))).alias("rank"), "url",
        F.octet_length("payload").cast("long").alias("length"),
        F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("digest"), "payload")
    # a payload's holder; counts and ids combine before the shuffle, payloads stay
    holders = sized.groupBy("digest").agg(F.max("rank").alias("holder_rank")).select(
        F.col("digest").alias("held_digest"), "holder_rank",
        F.when(F.col("holder_rank") > -(2**63), F.col("holder_rank")).alias("holder"))
    narrow = sized.drop("payload").join(holders, F.col("digest") == F.col("held_digest")).drop("held_digest")
    revisit = (F.col("length") >= revisit_from) & F.col("holder").isNotNull() & (F.col("rank") != F.col("holder_rank"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    url = F.coalesce(F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(""))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.date_format(F.current_timestamp() if captured is None else captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(revisit, F.lit(EMPTY_SHA1)).otherwise(F.col("sha1")))),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_id(F.col("holder"))), line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("length").cast("string"))),
        F.lit(CRLF))
    narrow.select("page_id", F.encode(header, "utf-8").alias("header"), "digest").write.mode("overwrite").parquet(f"{path}/headers")
    # every payload once: the holder's. Rows meet by id, so copies of one payload
    # are spread over all tasks; the id and digest that join also drop repeated rows.
    own = (F.col("rank") == F.col("holder_rank")) & (F.col("digest") == F.col("held_digest"))
    stored = sized.select("rank", "digest", "length", "payload").join(holders, own, "left_semi")
    stored.dropDuplicates(["rank", "digest"]).select("digest", "length", "payload").write.mode("overwrite").parquet(
        f"{path}/payloads")


def _field(name: str) -> Column:
    """A header line's value, from the stored header block."""
    return F.regexp_extract(F.decode("header", "utf-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; one that does not match its length and digest is an error."""
    rows = spark.read.parquet(f"{path}/payloads")
    good = (F.octet_length("payload") == F.col("length")) & (F.sha2("payload", 256) == F.col("digest"))
    checked = F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))).cast("binary"))
    rows = rows.select(F.col("digest").alias("stored"), checked.alias("payload"))
    # taken where the bytes are: a reader of these alone does not move payloads
    return rows.select("stored", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha1("payload").alias("sha1"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header fields, payload (of a revisit: the one it refers to) and
    `record`, the original record's bytes."""
    headers = spark.read.parquet(f"{path}/headers")
    joined = headers.join(read_payloads(spark, path), F.col("digest") == F.col("stored"))
    refers = F.regexp_extract(_field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1)
    kind = _field("WARC-Type")
    block = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    rebuilt = joined.withColumn("record", F.concat(F.col("header"), block, F.lit(CRLF * 2).cast("binary")))
    # what the record itself says of its content block, against the bytes that stand there
    length = _field("Content-Length").cast("int")
    content = F.substring("record", F.octet_length("header") + 1, length)
    whole = (F.octet_length("record") == F.octet_length("header") + length + 4) & (
        F.concat(F.lit("sha1:"), F.sha1(content)) == _field("WARC-Block-Digest"))
    named = F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "")
    digest = F.when(whole & (named == F.col("sha1")), named).otherwise(
        F.raise_error(F.lit("record and digests differ")).cast("string"))
    return rebuilt.select(
        "page_id", "payload_bytes", digest.alias("payload_digest"), kind.alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"), _field("WARC-Target-URI").alias("url"),
        "payload", "record")


def archive(pages: DataFrame) -> DataFrame:
    """Write `pages` as an archive and read it back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_records(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
