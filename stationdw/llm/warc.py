"""WARC archives: writing with segmented and chunked records, and segment reassembly.

Writing: one record per page, its block an HTTP response in chunked transfer framing. Of pages
with equal payloads the one with the largest id is the response, the others are revisits of it.
A block longer than a segment is split: the record's first segment and ``continuation`` records
that name it as their origin, the last with the total length. Spark's text writer puts the
records into gzip files (a record's end mark, CRLF CRLF, is the line separator), so files are
committed as a whole and a lost executor's unfinished file never counts. A file has at most
``file_records`` records of at most a segment each, so a reader can hold one.

Reading: records of all files; segments are grouped by origin id, ordered by number and joined
if numbers are complete and the total length is right; then the chunked framing is decoded and
the payload's digest compared. A record that fails is kept with the reason as its ``status``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationdw.session import scratch_dir

from .common import arrow_map, columns_of, stage

CRLF = b"\r\n"
END = "\r\n\r\n"
RECORD = ("origin string, number int, total long, kind string, page_id long, uri string, "
          "payload_digest string, refers_to long, block binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """HTTP/1.1 chunked transfer coding."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out += [b"%x\r\n" % len(part), part, CRLF]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Decoded chunked transfer coding (chunk extensions and trailers are passed over)."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk size line is cut off")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size < 0 or len(body) < at + size + (2 if size else 0):
            raise ValueError("chunk is cut off")
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != CRLF:
            raise ValueError("chunk does not end where its size says")
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields if v is not None],
            f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block


def _uri(url: str | None) -> str | None:
    """A header-safe URI: white space and controls are percent-encoded."""
    if not url:
        return None
    return re.sub(r"[\x00-\x20\x7f-\xa0\s]",
                  lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url)


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool, unique: str, date: str, segment: int, chunk: int) -> list[bytes]:
    """The WARC records of one page: a revisit, or a response in one or more segments."""
    own = f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(unique.encode()).digest())}>"
    known = [("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", _uri(url)),
             ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
             ("X-Page-ID", None if page_id is None else str(page_id)),
             ("Content-Type", "application/http; msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        same = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record([("WARC-Type", "revisit"), *known, ("WARC-Profile", same),
                         ("X-Refers-To-Page-ID", str(refers_to))], head + CRLF)]
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    parts = [block[at:at + segment] for at in range(0, len(block), segment)]
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), *known], block)]
    out = [_record([("WARC-Type", "response"), *known, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        out.append(_record(
            [("WARC-Type", "continuation"),
             ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.UUID(own[10:-1]), str(number))}>"),
             ("WARC-Date", date), ("WARC-Segment-Origin-ID", own),
             ("WARC-Segment-Number", str(number)),
             ("WARC-Segment-Total-Length", str(len(block)) if number == len(parts) else None)],
            part))
    return out


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, segment: int = 8192,
                   chunk: int = 4096, file_records: int = 2048,
                   date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> None:
    """Archives of all pages under ``path``.

    Payloads of fewer than ``least_bytes`` bytes are always responses. Equal payloads are found
    on narrow rows (digest, length, id); only payloads that occur more than once are joined back,
    as a written table whose size Spark knows. A null html is an empty payload; a page with a
    null id revisits a page with an id, if there is one; repeated rows of the largest id are all
    responses.
    """
    read = columns_of(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    read = read.withColumn("sha", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    repeated = stage(read.where(F.col("n") >= least_bytes).groupBy("sha", "n")
                     .agg(F.count("*").alias("copies"), F.max("page_id").alias("keeper"))
                     .where("copies > 1").select("sha", "n", "keeper"), "repeated-payloads")
    flagged = (read.withColumn("row", F.monotonically_increasing_id())
               .join(repeated, ["sha", "n"], "left")
               .withColumn("revisit", F.col("keeper").isNotNull()
                           & ~F.col("page_id").eqNullSafe(F.col("keeper"))))

    def rows(batch):
        out: list[bytes] = []
        for page_id, url, payload, keeper, revisit, row in zip(
                *[batch[c] for c in ("page_id", "url", "payload", "keeper", "revisit", "row")]):
            out += page_records(page_id, url, payload, keeper, revisit, f"{page_id} {row}", date,
                                segment, chunk)
        return {"record": out}

    records = arrow_map(flagged.select("page_id", "url", "payload", "keeper", "revisit", "row"),
                        rows, "record binary")
    (records.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", file_records).text(path))


def parse_records(data: bytes):
    """(header fields in lower case, block) of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + 4
        stop = start + int(fields["content-length"])
        if stop > len(data):
            raise ValueError(f"record at byte {at} is cut off")
        yield fields, data[start:stop]
        at = stop + 4


def _inflate(data: bytes) -> bytes:
    """All gzip members of a file, or the bytes themselves if they are not compressed."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of every archive file under ``path`` (columns ``RECORD``)."""
    def number(fields, name):
        return int(fields[name]) if name in fields else None

    def rows(batch):
        out: dict[str, list] = {c.split()[0]: [] for c in RECORD.split(", ")}
        for data in batch["content"]:
            for f, block in parse_records(_inflate(data)):
                for name, value in (
                        ("origin", f.get("warc-segment-origin-id", f.get("warc-record-id"))),
                        ("number", number(f, "warc-segment-number")),
                        ("total", number(f, "warc-segment-total-length")),
                        ("kind", f.get("warc-type")), ("page_id", number(f, "x-page-id")),
                        ("uri", f.get("warc-target-uri")),
                        ("payload_digest", f.get("warc-payload-digest", "")
                         .removeprefix("sha1:") or None),
                        ("refers_to", number(f, "x-refers-to-page-id")), ("block", block)):
                    out[name].append(value)
        return out

    files = spark.read.format("binaryFile").load(path).select("content")
    return arrow_map(files, rows, RECORD)


def reassemble(segments: DataFrame) -> DataFrame:
    """Whole records: ``kind, page_id, uri, payload_digest, refers_to, payload, status``.

    Records without a segment number are whole already and are not shuffled. The others meet by
    origin id, one page's segments a group. ``status`` is ``ok``, or why a payload is null:
    ``segment missing``, ``total length``, ``framing`` or ``digest``.
    """
    plain = segments.where(F.col("number").isNull()).select(
        "kind", "page_id", "uri", "payload_digest", "refers_to",
        F.array("block").alias("blocks"), F.lit("ok").alias("status"))
    part = F.struct("number", "block", "total", "kind", "page_id", "uri", "payload_digest",
                    "refers_to")
    joined = (segments.where(F.col("number").isNotNull()).groupBy("origin")
              .agg(F.array_sort(F.collect_list(part)).alias("parts")))
    first, last = F.col("parts")[0], F.element_at("parts", -1)
    numbers = F.transform("parts", lambda p: p["number"])
    length = F.aggregate("parts", F.lit(0).cast("long"),
                         lambda n, p: n + F.octet_length(p["block"]))
    whole = (numbers == F.sequence(F.lit(1), F.size("parts"))) & last["total"].isNotNull()
    joined = joined.select(
        *[first[c].alias(c) for c in ("kind", "page_id", "uri", "payload_digest", "refers_to")],
        F.transform("parts", lambda p: p["block"]).alias("blocks"),
        F.when(~whole, "segment missing").when(length != last["total"], "total length")
        .otherwise("ok").alias("status"))
    keep = ("kind", "page_id", "uri", "payload_digest", "refers_to")

    def rows(batch):
        payloads, statuses = [], []
        for kind, blocks, digest, status in zip(batch["kind"], batch["blocks"],
                                                batch["payload_digest"], batch["status"]):
            payload = None
            if status == "ok" and kind != "revisit":
                head, _, body = b"".join(blocks).partition(b"\r\n\r\n")
                try:
                    payload = unchunked(body) if b"chunked" in head.lower() else body
                except ValueError:
                    status = "framing"
                if payload is not None and digest and payload_digest(payload) != digest:
                    payload, status = None, "digest"
            payloads.append(payload)
            statuses.append(status)
        return {**{c: batch[c] for c in keep}, "payload": payloads, "status": statuses}

    return arrow_map(plain.unionByName(joined), rows,
                     "kind string, page_id long, uri string, payload_digest string, "
                     "refers_to long, payload binary, status string")


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write all pages as archives in the shared folder, read them back, and describe every
    record: ``page_id, payload_bytes, payload_digest, record_type, refers_to, status``. A
    revisit's length is that of the response with its digest."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archives(pages, path, **options)
    whole = reassemble(read_segments(spark, path))
    facts = stage(whole.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest", F.col("kind").alias("record_type"), "refers_to", "status"), "records")
    revisits = facts.where("record_type = 'revisit'").drop("payload_bytes")
    known = (facts.where("record_type <> 'revisit'").join(
        revisits.select("payload_digest").distinct(), "payload_digest", "left_semi")
        .groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes")))
    return facts.where("record_type <> 'revisit'").unionByName(
        revisits.join(known, "payload_digest", "left"))
