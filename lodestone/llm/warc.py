"""WARC archives with revisit records: writing, resolving, reading back.

*Writing.*  Headers (digest, length, record id; no payload) are grouped by
payload digest with map-side aggregation, which leaves one row for each payload
that occurs more than once: its response.  The pages join these rows by digest
and become response or revisit records with fresh headers; only responses carry
their payload.  A payload that a large share of the pages has makes a skewed
join key, which adaptive execution splits, as the other side has one row a key.
Archives are written by Spark's text writer (a record ends in CR LF CR LF, so
its last byte is the line end) and gzip, into the shared folder; each begins
with a warcinfo record, and all records are dated when the job writes them.

*Reading.*  Spark's text reader gives an archive's lines in order (gzip files
are never split; a file that could be is refused); each task
cuts them into records by Content-Length, checks each digest, and the revisit
records are joined to the responses that they refer to by record id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

from . import common

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def headers(pages: DataFrame) -> DataFrame:
    """Pages with payload, its length and digests, and a record id; NULL html is an empty payload."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = common.narrow(pages, page_id="long", url="string", html="string").select("page_id", "url", payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"), F.octet_length("payload").cast("long").alias("bytes"))
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")), "sha256").cast("binary"))
    dashed = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return rows.withColumn("record_id", F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")))


def resolved(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``headers`` with the response of each row's payload (``first_*``), NULL for rows that are responses themselves."""
    rows = headers(pages)
    own = F.struct(F.col("page_id").alias("id"), F.col("record_id").alias("record"), F.col("url").alias("url"))
    repeated = (rows.where(F.col("bytes") >= least_bytes).groupBy("sha256", "sha1")
                .agg(F.max(own).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n", "sha1"))
    joined = rows.join(repeated, "sha256", "left")
    revisits = F.col("first.id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.id"))
    return joined.withColumn("first", F.when(revisits, F.col("first")))


def records(pages: DataFrame, date: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(value): WARC records as strings of bytes, without their last line end; dated now if no date is given."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") if date is None else date
    rows = resolved(pages, least_bytes)
    revisit = F.col("first").isNotNull()

    def clean(column):  # a header's value stays on its line
        return F.regexp_replace(column, "[\r\n]+", "%20")

    def field(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")

    http = F.concat(F.lit(HTTP), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        field("WARC-Record-ID", F.col("record_id")), F.lit(f"WARC-Date: {date}\r\n"),
        field("WARC-Target-URI", clean(F.col("url"))), field("WARC-Page-ID", F.col("page_id")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        field("WARC-Payload-Length", F.col("bytes")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\n"), field("WARC-Refers-To", F.col("first.record")), F.lit(f"WARC-Refers-To-Date: {date}\r\n"),
                                 field("WARC-Refers-To-Target-URI", clean(F.col("first.url"))))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"), F.lit("\r\n\r\n"))
    payload = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(head.cast("binary"), http.cast("binary"), payload, F.lit(b"\r\n\r"))
    # the first record of each task, and so of each file, has the file's own before it
    place = F.monotonically_increasing_id()
    about = "software: lodestone\r\nformat: WARC File Format 1.1\r\n"
    info = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(
        f">\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"))
    led = rows.select(record.alias("record"), place.alias("place"))
    first = F.col("place").bitwiseAND((1 << 33) - 1) == 0
    return led.select(F.when(first, F.concat(info.cast("binary"), F.col("record"))).otherwise(F.col("record")).cast("string").alias("value"))


def write(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, date: str | None = None) -> None:
    """Write deduplicated archives into a new folder, one gzip file a task."""
    records(pages, date, least_bytes).write.option("lineSep", "\n").option("compression", "gzip").text(folder)


def _record(head: dict[str, str], block: bytes) -> tuple:
    payload = block.partition(b"\r\n\r\n")[2]
    digest, length = head["warc-payload-digest"].removeprefix("sha1:"), int(head["warc-payload-length"])
    if head["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
        raise ValueError(f"damaged record {head['warc-record-id']}")
    page = head.get("warc-page-id")
    return (head["warc-record-id"], head["warc-type"], None if page is None else int(page), head.get("warc-target-uri"),
            digest, length, head.get("warc-refers-to"), payload if head["warc-type"] == "response" else None)


_FIELDS = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
                     ("payload_bytes", pa.int64()), ("refers_to_record", pa.string()), ("payload", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    head, block, missing, rows, held = None, [], 0, [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_FIELDS)], schema=_FIELDS)

    for lines in batches:
        for line in lines.column(0).to_pylist():
            if missing > 0:  # inside a block of known length
                block.append(line)
                missing -= len(line) + 1
                if missing > 0:
                    continue
                data = b"\n".join(block)
                if head["warc-type"] == "warcinfo":
                    head = None
                    continue
                rows.append(_record(head, data[:len(data) + missing + 1] if missing < 0 else data + b"\n"))
                held += len(data)
                if not with_payload:
                    rows[-1] = (*rows[-1][:-1], None)
                head = None
            elif head is None:
                if line.startswith(b"WARC/"):
                    head = {}
            elif line != b"\r":
                name, _, value = line.rstrip(b"\r").decode().partition(":")
                head[name.lower()] = value.strip()
            else:
                block, missing = [], int(head["content-length"])
        if rows and (held > 4 << 20 or len(rows) > 10000):
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the gzip archives in a folder, as written, every response checked against its digest."""
    split = F.raise_error(F.concat(F.lit("records of a file that may be split can't be read: "), F.input_file_name())).cast("string")
    whole = F.when(F.input_file_name().endswith(".gz"), F.col("value")).otherwise(split)
    lines = spark.read.option("lineSep", "\n").text(folder).select(whole.cast("binary").alias("value"))
    return lines.mapInArrow(lambda batches: _cut(batches, with_payload),
                            "record_id string, record_type string, page_id long, url string, payload_digest string, "
                            "payload_bytes long, refers_to_record string, payload binary")


def resolve(found: DataFrame) -> DataFrame:
    """Revisit records joined to the responses that they refer to (``refers_to``: the response's page_id)."""
    responses = (found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_record"))
                 .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("_bytes"), F.max("payload_digest").alias("_digest")))
    joined = found.join(responses, "refers_to_record", "left")
    return joined.select("page_id", F.coalesce("_bytes", "payload_bytes").alias("payload_bytes"), F.coalesce("_digest", "payload_digest").alias("payload_digest"),
                         "record_type", "refers_to", "url", "record_id")


def archived(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write archives, read them back and resolve them: one row per page.

    Returns page_id, payload_bytes, payload_digest (SHA-1 in hex, of the full
    payload), record_type, refers_to, url and record_id.  Of the records with
    equal payloads of at least ``least_bytes``, those with the largest page_id
    are responses (all of them, if that page_id is repeated) and the others
    revisit it.  A NULL page_id is below all others; if a payload's page_ids
    are all NULL, each is a response.  NULL html is an empty payload; NULL urls
    have no header and come back NULL; line ends in urls become %20.  An empty
    table gives an empty result; other columns are ignored.
    """
    folder = scratch_dir(pages.sparkSession, "warc")
    write(pages, folder, least_bytes)
    return resolve(read(pages.sparkSession, folder, with_payload=False))

