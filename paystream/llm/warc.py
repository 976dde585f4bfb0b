"""Legacy archives: read ARC records, write equivalent WARC records, read WARC files back.

An ARC file starts with a version block, whose second line names the version; the version sets
the fields of the header line of each record (5 in version 1, 10 in version 2). The last field
is the declared length of the record's body. Archives are written and read by Spark's own text
and binary file sources, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.session import work_dir

# Fixed values of the two formats: how many fields a header line has, by version.
ARC_FIELDS = {1: 5, 2: 10}
VERSION_BLOCKS = {
    1: b"1 0 paystream\nURL IP-address Archive-date Content-type Archive-length\n",
    2: b"2 0 paystream\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


@dataclass
class ArcRecord:
    version: int
    url: str
    ip: str
    date: str
    content_type: str
    body: bytes
    truncated: bool = False


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes = b""
    http: dict[str, str] = field(default_factory=dict)

    @property
    def payload(self) -> bytes:
        """The block without its HTTP head, where it has one."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


def arc_line(version: int, url: str, ip: str, date: str, content_type: str, length: int) -> bytes:
    """Header line of a record; blanks in the url are escaped, as they part the fields."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-"
    middle = [] if version == 1 else ["200", "-", "-", "0", "pages.arc"]
    return " ".join([url, ip, date, content_type, *middle, str(length)]).encode() + b"\n"


def arc_file(version: int, records: list[tuple[str, bytes]], date: str = "20080101000000") -> bytes:
    """The bytes of an ARC file with ``records`` (url, body)."""
    block = VERSION_BLOCKS[version]
    parts = [arc_line(1, "filedesc://pages.arc", "0.0.0.0", date, "text/plain", len(block)), block, b"\n"]
    for url, body in records:
        parts += [arc_line(version, url, "0.0.0.0", date, "text/html", len(body)), body, b"\n"]
    return b"".join(parts)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, the version block first.

    Header lines are split from the right, since old crawlers left blanks in urls. A body that
    ends before its declared length is kept and marked.
    """
    at, version = 0, 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            end = len(data)
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        at = end + 1
        if not line:
            continue
        fields = line.rsplit(" ", ARC_FIELDS[version or 1] - 1)
        if line.startswith("filedesc://"):
            # The block names the version of the lines after it; its own has either form.
            size = int(line.rsplit(" ", 1)[1])
            version = 2 if data[at:at + 1] == b"2" else 1
            fields = line.split(" ")
        elif not version:
            raise ValueError("not an ARC file: no version block")
        elif len(fields) != ARC_FIELDS[version] or not fields[-1].isdigit():
            raise ValueError(f"not a version {version} header line at byte {at}: {line[:80]!r}")
        else:
            size = int(fields[-1])
        body = bytes(data[at:at + size])
        yield ArcRecord(version, fields[0], fields[1], fields[2], fields[3], body, len(body) < size)
        at += size


def record_id(*parts: object) -> str:
    """An identifier that the same parts always get."""
    return f"<urn:uuid:{uuid.uuid5(_IDS, '|'.join(map(str, parts)))}>"


def iso_date(date: str) -> str:
    """``YYYYMMDDhhmmss``, or a shorter start of it, as a WARC date."""
    date = (date + "00000101000000"[len(date):])[:14]
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z"


def _http_head(body: bytes) -> dict[str, str]:
    head = body.partition(b"\r\n\r\n")[0].decode("utf-8", "replace")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.split("\r\n")[1:])}


def to_warc(arc: ArcRecord) -> bytes:
    """The WARC record of an ARC record, bytes and all.

    The version block becomes ``warcinfo``, a body that is an HTTP answer ``response``, any
    other ``resource``. An answer whose head has ``X-First-Page`` repeats the payload of that
    page and becomes a ``revisit``, which carries the head only.
    """
    block, extra = arc.body, {}
    if arc.url.startswith("filedesc:"):
        kind, content_type = "warcinfo", "application/warc-fields"
        block = f"software: paystream\r\nformat: WARC File Format 1.1\r\nconverted-from: {arc.url}\r\n".encode()
        identifier = record_id("warcinfo", arc.url, arc.date, hashlib.sha256(arc.body).hexdigest())
    else:
        extra["WARC-Target-URI"] = arc.url
        extra["WARC-IP-Address"] = arc.ip
        kind, content_type, payload = "resource", arc.content_type, arc.body
        page = ""
        if arc.body.startswith(b"HTTP/"):
            kind, content_type = "response", "application/http; msgtype=response"
            payload = arc.body.partition(b"\r\n\r\n")[2]
            head = _http_head(arc.body)
            page = head.get("x-page-id", "")
        digest = hashlib.sha256(payload).hexdigest()
        extra["WARC-Payload-Digest"] = f"sha256:{digest}"
        identifier = record_id(page or arc.url, page or arc.date, digest)
        if kind == "response" and "x-first-page" in head:
            first = head["x-first-page"]
            kind, block = "revisit", arc.body[:len(arc.body) - len(payload)]
            extra |= {
                "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(first, first, digest),
                "X-Payload-Length": str(len(payload)),
            }
        if arc.truncated:
            extra["WARC-Truncated"] = "length"
    headers = {
        "WARC-Type": kind, "WARC-Record-ID": identifier, "WARC-Date": iso_date(arc.date), **extra,
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": content_type, "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def convert(files: DataFrame) -> DataFrame:
    """WARC records (``record``, binary) of the ARC files in ``content``; null content has none.

    Each row is a whole file, as the binary file source gives it; a gzipped one is unpacked.
    Files are converted record by record, so one task holds one file and one record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if not content.is_valid:
                    continue
                data = content.as_buffer().to_pybytes()
                if data[:2] == b"\x1f\x8b":
                    data = b"".join(_unzipped(data))
                held, size = [], 0
                for arc in parse_arc(data):
                    held.append(to_warc(arc))
                    size += len(held[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])

    return files.select("content").mapInArrow(run, "record binary")


def write_archive(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write ``record`` as gzipped WARC files, in the order of each partition.

    The text writer ends each row with a line feed, which is the last byte of a WARC record.
    """
    lines = records.select(F.expr("substring(record, 1, length(record) - 1)").cast("string").alias("record"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", records_per_file).mode("errorifexists").text(path)


def _unzipped(data) -> Iterator[bytes]:
    """Pieces of the unpacked bytes of one or more gzip members."""
    view, at = memoryview(data), 0
    while at < len(view):
        unzip, member = zlib.decompressobj(31), at
        while not unzip.eof and member < len(view):
            piece = view[member:member + (1 << 18)]
            yield unzip.decompress(piece)
            member += len(piece)
        at = member - len(unzip.unused_data)
        if not unzip.eof:
            raise ValueError("the archive ends within a gzip member")


def parse_warc(pieces: Iterator[bytes]) -> Iterator[WarcRecord]:
    """The records of a WARC stream that comes in pieces; blocks are as long as declared."""
    held = bytearray()

    def fill(want: int) -> bool:
        while len(held) < want:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        scanned = 0
        while (end := held.find(b"\r\n\r\n", max(0, scanned - 3))) < 0:
            scanned = len(held)
            if not fill(len(held) + 1):
                raise ValueError("the archive ends within a header")
        lines = held[:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("the archive ends within a record")
        block = bytes(held[end + 4:end + 4 + size])
        del held[:end + 8 + size]
        http = _http_head(block) if headers.get("content-type", "").startswith("application/http") else {}
        yield WarcRecord(headers, block, http)


RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string, refers_to_id string, target_uri string, warc_date string"
)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the WARC files below ``path``; payloads are digested anew.

    Raises if the payload of a record doesn't have the digest its header states.
    """

    def row(record: WarcRecord) -> tuple:
        head, http = record.headers, record.http
        stated = head["warc-payload-digest"].removeprefix("sha256:")
        if head["warc-type"] == "revisit":
            size, refers = int(head["x-payload-length"]), int(http["x-first-page"])
        else:
            payload, refers = record.payload, None
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != stated:
                raise ValueError(f"{head['warc-record-id']}: the payload isn't the one that was written")
        page = http.get("x-page-id", "")
        return (
            int(page) if page else None, size, stated, head["warc-type"], refers, head["warc-record-id"],
            head.get("warc-refers-to"), head.get("warc-target-uri"), head["warc-date"],
        )

    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64() if x.split()[1] == "long" else pa.string() for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [
                    row(r) for r in parse_warc(_unzipped(content.as_buffer()))
                    if r.headers["warc-type"] in ("response", "resource", "revisit")
                ]
                columns = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def pages_to_arc(pages: DataFrame, least_bytes: int = 100, rows_per_file: int = 256) -> DataFrame:
    """Pages (page_id, url, html) as small ARC files (``content``), of either version in turn.

    The body of a record is an HTTP answer with the page's id and, if a page with a smaller id
    has the same payload of at least ``least_bytes`` bytes, the smallest such id.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"),
    )
    sized = base.where(F.octet_length("html") >= least_bytes)
    first = sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # Ids only, so that a payload that many pages share moves none of them; then one row per page.
    again = (
        sized.select("page_id", "digest").join(first, "digest").where("NOT page_id <=> first")
        .select(F.coalesce("page_id", F.lit(-1)).alias("page"), F.col("digest").alias("d"), "first").distinct()
    )
    told = base.join(
        again, (F.coalesce(base["page_id"], F.lit(-1)) == again["page"]) & (base["digest"] == again["d"]), "left"
    ).select("page_id", "url", "html", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 1
        for batch in batches:
            for at in range(0, len(batch), rows_per_file):
                part = batch.slice(at, rows_per_file)
                records = []
                for page, url, text, same in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "first"))):
                    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    head += f"X-Page-Id: {'' if page is None else page}\r\n"
                    head += f"X-First-Page: {same}\r\n" if same is not None else ""
                    records.append((url, head.encode() + b"\r\n" + text.encode()))
                yield pa.RecordBatch.from_arrays([pa.array([arc_file(version, records)], pa.binary())], ["content"])
                version = 3 - version

    return told.mapInArrow(run, "content binary")


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Put every page into WARC files by way of ARC, and read the files back.

    The archive lies in ``path``, else in a new folder of the shared work folder. Null html is
    an empty payload, a null url becomes ``-``, a null id stays null and is never referred to.
    Rows that repeat a page wholly are records of the same type; other columns are ignored; an
    empty table gives no rows.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "warc")
    write_archive(convert(pages_to_arc(pages)), path)
    return read_archive(spark, path)
