"""Web archives: writing captures as records, reading archives, and joining the records of a capture again."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm.textual import whole
from tablecraft.plans.lineage import materialize

#: Fixed values of the format: what ends a header and a record, and the version line.
BREAK = "\r\n\r\n"
VERSION = "WARC/1.1"
#: Bytes of a shared payload's entry, and of all of them up to which they are broadcast; beyond, the join is shuffled.
SHARED_BYTES, BROADCAST_BYTES = 100, 8_000_000
#: Digits of base 32 as Spark's conversion writes them, and as archives do.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1 of bytes: five hexadecimal digits give four of base 32 at a time."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _record_id(kind: str, *parts: Column) -> Column:
    code = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("none")) for p in parts]))
    cut = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str, name: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record as text; the break that ends it is left to the writer."""
    lines = [F.lit(VERSION), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), name),
             *[F.concat(F.lit(f"{k}: "), v) for k, v in headers],
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(BREAK), block)


def _one_line(text: Column) -> Column:
    """A header's value: what would end the line, and blanks, are percent-encoded as in addresses."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "\r", "%0D"), "\n", "%0A"), " ", "%20")


def write_pages(pages: DataFrame, path: str, least: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write three records per page: a request, a response or revisit, and metadata that name each other.

    Of pages with equal payloads of at least ``least`` bytes, the one with the smallest key is a response
    and holds the payload; the others revisit it. A missing key comes after all others. Rows that agree in
    key and payload are copies of one capture, written each time with the same ids. A missing payload is
    empty, a missing address likewise. The files are gzip archives in one folder, written by Spark.
    """
    rows = pages.select(F.col(key).alias("key"), _one_line(whole(url)).alias("url"), whole(html).alias("html"))
    rows = rows.withColumn("digest", payload_digest(F.col("html").cast("binary")))
    first = materialize(
        pages.select(F.col(key).alias("key"), payload_digest(whole(html).cast("binary")).alias("d"))
        .groupBy("d").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key"))["key"].alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("d").alias("digest"), "first", F.lit(True).alias("shared")))
    small = first.count() * SHARED_BYTES <= BROADCAST_BYTES
    rows = rows.join(F.broadcast(first) if small else first, "digest", "left")
    size = F.octet_length("html")
    revisits = F.coalesce("shared", F.lit(False)) & (size >= least) & ~F.col("key").eqNullSafe(F.col("first"))
    rows = rows.withColumn("revisits", revisits).withColumn("target", F.when(F.col("revisits"), _record_id("capture", F.col("first"), F.col("digest"))))
    name, where = _record_id("capture", F.col("key"), F.col("digest")), ("WARC-Target-URI", F.col("url"))
    date = ("WARC-Date", F.lit("2020-01-01T00:00:00Z"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(BREAK))
    reply = ("Content-Type", F.lit("application/http; msgtype=response"))
    capture = F.when(F.col("revisits"), _record("revisit", name, [
        date, where, digest, ("WARC-Refers-To", F.col("target")),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), reply], http)
    ).otherwise(_record("response", name, [date, where, digest, reply], F.concat(http, F.col("html"))))
    request = _record("request", _record_id("request", F.col("key"), F.col("digest")), [
        date, where, ("WARC-Concurrent-To", name), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1" + BREAK)))
    fields = F.concat_ws("\r\n", F.concat(F.lit("page: "), F.col("key").cast("string")), F.concat(F.lit("refers-to-page: "), F.when(F.col("revisits"), F.col("first").cast("string"))))
    about = _record("metadata", _record_id("metadata", F.col("key"), F.col("digest")), [
        date, where, ("WARC-Concurrent-To", name), ("Content-Type", F.lit("application/warc-fields"))], fields)
    records = rows.select(F.explode(F.array(request, capture, about)).alias("value"))
    records.write.option("lineSep", BREAK).option("compression", "gzip").mode("overwrite").text(path)


RECORD = ("file string, type string, record_id string, concurrent_to string, refers_to string, uri string, date string, "
          "declared_digest string, content_type string, headers map<string,string>, fields map<string,string>, "
          "payload_bytes bigint, payload_digest string, payload binary")


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of gzip archives: its headers, and the payload's size and SHA-1.

    Spark streams every file to one task in order, cut at the format's breaks; the task joins the cuts again as
    Content-Length says, so a payload may hold breaks itself, and no more than one record is held. ``fields`` are the
    HTTP headers of requests and responses, which are split off the payload, or the fields of a metadata record. A record cut short
    at the end of a file is dropped, and so is what stands between records. Without ``payloads`` the bytes themselves are left out.
    """
    cuts = spark.read.option("lineSep", BREAK).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("cut"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for record in _records((f, c) for b in batches for f, c in zip(b.column(0).to_pylist(), _bytes(b.column(1)))):
            row = _row(*record, payloads)
            rows.append(row)
            held += 2048 + (len(row["payload"]) if payloads else 0)
            if held > 16_000_000:
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    found = cuts.mapInArrow(parse, RECORD)
    return found if payloads else found.drop("payload")


SCHEMA = pa.schema([(n, pa.string()) for n in ("file", "type", "record_id", "concurrent_to", "refers_to", "uri", "date", "declared_digest", "content_type")]
                   + [(n, pa.map_(pa.string(), pa.string())) for n in ("headers", "fields")]
                   + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (v.as_py() for v in column)


def _records(cuts: Iterator[tuple[str, bytes]]) -> Iterator[tuple[str, dict, bytes]]:
    """(file, headers, block) of the records in a stream of cuts, of which only the unread rest is held."""
    end, now, parts, size, headers, want = BREAK.encode(), None, [], 0, None, 0
    for file, cut in cuts:
        if file != now:
            now, parts, size, headers = file, [], 0, None
        parts += [cut, end]
        size += len(cut) + len(end)
        while headers is not None or size:
            if headers is None:
                head, found, rest = b"".join(parts).lstrip(b"\r\n").partition(end)
                parts, size = [rest] if found else [head], len(rest) if found else len(head)
                if not found:
                    break
                if not head.startswith(b"WARC/"):
                    continue
                headers = _fields(head.partition(b"\r\n")[2])
                length = headers.get("content-length", "")
                want = int(length) if length.isdigit() else 0
            if size < want:
                break
            data = b"".join(parts)
            yield file, headers, data[:want]
            parts, size, headers = [data[want:]], len(data) - want, None


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on the one before."""
    found, last = {}, None
    for line in head.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:
            found[last] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            name, _, value = line.partition(b":")
            last = name.strip().lower().decode("utf-8", "replace")
            found[last] = value.strip().decode("utf-8", "replace")
    return found


def _row(file: str, headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    fields = {}
    if headers.get("content-type", "").startswith("application/http"):
        head, _, block = block.partition(BREAK.encode())
        fields = _fields(head.partition(b"\r\n")[2])
    elif headers.get("content-type", "").startswith("application/warc-fields"):
        fields = _fields(block)
    return {"file": file, "type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"), "uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
            "declared_digest": headers.get("warc-payload-digest"), "content_type": headers.get("content-type"), "headers": list(headers.items()),
            "fields": list(fields.items()), "payload_bytes": len(block),
            "payload_digest": base64.b32encode(hashlib.sha1(block).digest()).decode(), "payload": block if payloads else None}


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: record_id, copies, and the structs response (or revisit), request and metadata.

    A request or metadata record belongs to the capture that its WARC-Concurrent-To names. A record that is
    stored several times is one, with the number of its copies; a capture without request or metadata has a
    null struct there; a record that belongs to no capture is left out, and so are captures without id.
    """
    columns = [c for c in records.columns if c != "file"]
    captures = records.where(F.col("type").isin("response", "revisit") & F.col("record_id").isNotNull()).groupBy("record_id").agg(
        F.count("*").alias("copies"), F.first(F.struct(*columns)).alias("response"))
    for kind in ("request", "metadata"):
        own = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull()).groupBy(
            F.col("concurrent_to").alias("record_id")).agg(F.min_by(F.struct(*columns), "record_id").alias(kind))
        captures = captures.join(own, "record_id", "left")
    return captures


def page_captures(captures: DataFrame) -> DataFrame:
    """Per page as written: page_id, payload_bytes, payload_digest, record_type, refers_to; copies count one by one.

    A revisit's size and digest are those that it declares for the payload it stands for.
    """
    number = lambda name: F.col("metadata.fields")[name].cast("long")
    revisit = F.col("response.type") == "revisit"
    return captures.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        number("page").alias("page_id"),
        F.when(revisit, F.col("response.fields")["content-length"].cast("long")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("response.declared_digest", "^sha1:", "")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"), number("refers-to-page").alias("refers_to"))


SQL = r"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
h as (select page_id, octet_length(b)::bigint as payload_bytes, sha1(b) as d from p),
f as (select *, min(page_id) over (partition by d) as first from h),
c as (select *, list_transform(range(0, 8), lambda i: ('0x' || substr(d, (i * 5 + 1)::int, 5))::int) as v from f)
select page_id, payload_bytes, case when page_id is distinct from first then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from first then first end as refers_to,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((v[(i // 4 + 1)::int] >> (15 - 5 * (i % 4))::int) & 31) + 1, 1)), '') as payload_digest
from c
"""
