"""Legacy ARC archives, their conversion to WARC, and readers of both.

ARC files begin with a version block; the version decides the fields of each
record's header line, whose last field declares the length of what follows.
Conversion synthesises what a WARC record needs and ARC lacks: an identifier, an
ISO timestamp, a type, and digests of block and payload. Records are members of
a gzip file each, and are read one at a time, so that a task never holds more
than one record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import blocks
from tessera.llm.files import new_file, open_input, open_output
from tessera.workspace import materialize, scratch_path

# Fixed values of the ARC format: the fields of a header line by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum",
        "Location", "Offset", "Filename", "Archive-length"],
}
GZIP_LEVEL = 1
CHUNK = 1 << 20
LEAST_REVISIT = 100
PAGE_ID = "X-Page-Id"
PRINTED = "".join(map(chr, range(0x21, 0x7F)))

RECORD = (
    "file string, record bigint, page_id bigint, record_type string, record_id string, "
    "refers_to_id string, target string, date string, payload_bytes bigint, payload_digest string"
)


def member(data: bytes) -> bytes:
    """``data`` as a gzip member of its own."""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Unpacked:
    """Lines and exact lengths from a file of gzip members, or from a plain file."""

    def __init__(self, file: Any):
        self.file, self.held, self.over = file, bytearray(), False
        self.packed = bytes(file.read(2))
        self.gzip = self.packed == b"\x1f\x8b"
        self.unpacker = zlib.decompressobj(31)

    def _more(self) -> bool:
        data = self.packed or self.file.read(CHUNK)
        self.packed = b""
        if not data:
            self.over = True
            return False
        if not self.gzip:
            self.held += data
            return True
        while data:
            self.held += self.unpacker.decompress(data)
            data = self.unpacker.unused_data
            if self.unpacker.eof:
                self.unpacker = zlib.decompressobj(31)
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        start = 0
        while (end := self.held.find(b"\n", start)) < 0:
            start = len(self.held)
            if not self._more():
                if not self.held:
                    return None
                end = len(self.held)
                break
        found = bytes(self.held[:end]).rstrip(b"\r")
        del self.held[: end + 1]
        return found

    def exactly(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more():
                raise ValueError(f"the file ends {size - len(self.held)} bytes early")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found


def arc_header(version: int, name: str, date: str) -> bytes:
    fields = " ".join(ARC_FIELDS[version])
    body = f"{version} 0 tessera\n{fields}\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n"
    if version == 2:
        line = f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n"
    return line.encode() + body + b"\n"


def arc_record(version: int, url: str, date: str, block: bytes, offset: int, name: str) -> bytes:
    url = quote(url, safe=PRINTED) or "-"
    middle = "text/html" if version == 1 else f"text/html 200 - - {offset} {name}"
    return f"{url} 0.0.0.0 {date} {middle} {len(block)}\n".encode() + block + b"\n"


def http_response(payload: bytes, page_id: int | None) -> bytes:
    name = "" if page_id is None else f"{PAGE_ID}: {page_id}\r\n"
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n{name}\r\n"
    )
    return head.encode() + payload


def write_arc(
    pages: DataFrame,
    version: int,
    date: str = "20000101000000",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Pages as ARC files of one version, a file per task; returns the files (``file``).

    A null url is written as ``-``, a null page as an empty payload, and a null
    id as a response without the header that carries it.
    """
    folder = scratch_path(pages.sparkSession, f"arc{version}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = None
        out, at = None, 0
        for block in blocks(batches, "html"):
            if out is None:
                name = new_file(folder, ".arc.gz")
                out = open_output(name)
                at += out.write(member(arc_header(version, name.rpartition("/")[2], date)))
            for page in block.to_pylist():
                body = http_response((page["html"] or "").encode(), page["page_id"])
                record = arc_record(
                    version, page["url"] or "", date, body, at, name.rpartition("/")[2]
                )
                at += out.write(member(record))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
    )
    return materialize(rows.mapInArrow(write, "file string"), f"arc{version}-files")


def arc_records(file: Any) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Number, header fields and block of every record after the version block.

    A header line of the wrong number of fields, an unknown version or a length
    that runs past the end of the file is an error, not a record.
    """
    source = Unpacked(file)
    first = source.line()
    if first is None:
        return
    if not first.startswith(b"filedesc://"):
        raise ValueError("no ARC version block")
    about = source.exactly(int(first.rsplit(b" ", 1)[1])).decode("latin-1").split("\n")
    fields = ARC_FIELDS.get(int(about[0].split()[0]))
    if fields is None:
        raise ValueError(f"unknown ARC version: {about[0]}")
    number = 0
    while (line := source.line()) is not None:
        if not line:
            continue
        values = line.decode("latin-1").rsplit(" ", len(fields) - 1)
        if len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header line: {line[:200]!r}")
        yield number, dict(zip(fields, values)), source.exactly(int(values[-1]))
        number += 1


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head, its headers by lower-case name, and payload; a block of no HTTP is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    head, found, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    named = (line.partition(":") for line in lines)
    return head + found, {n.strip().lower(): v.strip() for n, _, v in named}, payload


def iso_date(date: str) -> str:
    """14 digits (or fewer, from the year on) as an ISO timestamp."""
    d = (date + "00000101000000"[len(date) :])[:14] if date.isdigit() else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_urn(file: str, number: int) -> str:
    """The same for every attempt to convert the same record."""
    name = f"{file.rpartition('/')[2]}#{number}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=4)}>"


def warc_record(file: str, number: int, fields: dict[str, str], block: bytes, first: str | None) -> bytes:
    """The WARC record of an ARC record; a revisit of ``first`` keeps no payload."""
    head, headers, payload = split_http(block)
    url = fields["URL"]
    if head:
        kind, content = "response", "application/http; msgtype=response"
    elif url.startswith("dns:"):
        kind, content = "resource", "text/dns"
    else:
        kind, content = "resource", fields["Content-type"]
    lines = [f"WARC-Target-URI: {url}", f"WARC-Date: {iso_date(fields['Archive-date'])}"]
    lines.append(f"WARC-Record-ID: {record_urn(file, number)}")
    lines.append(f"WARC-IP-Address: {fields['IP-address']}")
    lines.append(f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}")
    if first is not None:
        kind, block = "revisit", head
        lines.append(f"WARC-Refers-To: {first}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        lines.append(f"X-Payload-Length: {len(payload)}")
    lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    lines += [f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    start = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", *lines])
    return start.encode("latin-1") + b"\r\n\r\n" + block + b"\r\n\r\n"


def arc_index(files: DataFrame) -> DataFrame:
    """Place, page, payload length and digest of every ARC record."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with open_input(name) as file:
                    for number, _, block in arc_records(file):
                        _, headers, payload = split_http(block)
                        page = headers.get(PAGE_ID.lower())
                        rows.append(
                            {
                                "file": name,
                                "record": number,
                                "page_id": None if page is None else int(page),
                                "payload_bytes": len(payload),
                                "payload_digest": hashlib.sha256(payload).hexdigest(),
                            }
                        )
                yield pa.RecordBatch.from_pylist(rows, schema=INDEXED)

    return files.select("file").mapInArrow(
        index,
        "file string, record bigint, page_id bigint, payload_bytes bigint, payload_digest string",
    )


INDEXED = pa.schema(
    [("file", pa.string()), ("record", pa.int64()), ("page_id", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def one_file_each(files: DataFrame) -> DataFrame:
    """File names dealt out to as many tasks as there are files.

    The number is stated: rows this small would else be merged into one task.
    """
    return files.repartition(max(1, files.count()), "file")


def convert_arc(files: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """ARC files as WARC files, one for each; returns the files (``file``).

    Of records with equal payloads of ``least_revisit`` bytes or more, that of
    the smallest page id (null last; then the first by file and place) is a
    response and the others revisit it.
    """
    spark = files.sparkSession
    folder = scratch_path(spark, "warc")
    index = materialize(arc_index(one_file_each(files)), "arc-index")
    place = F.struct(F.isnull("page_id").alias("last"), "page_id", "file", "record")
    first = (
        index.where(F.col("payload_bytes") >= least_revisit)
        .groupBy("payload_digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    revisits = (
        index.join(first, "payload_digest")
        .where("file <> first.file OR record <> first.record")
        .groupBy("file")
        .agg(
            F.collect_list(
                F.struct("record", F.col("first.file").alias("file"), F.col("first.record").alias("of"))
            ).alias("revisits")
        )
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                firsts = {
                    r["record"]: record_urn(r["file"], r["of"]) for r in row["revisits"] or []
                }
                name = new_file(folder, ".warc.gz")
                with open_input(row["file"]) as file, open_output(name) as out:
                    for number, fields, block in arc_records(file):
                        found = warc_record(
                            row["file"], number, fields, block, firsts.get(number)
                        )
                        out.write(member(found))
                yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    work = files.join(revisits, "file", "left")
    return materialize(one_file_each(work).mapInArrow(convert, "file string"), "warc-files")


def warc_records(file: Any) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Number, headers by lower-case name, and block of every WARC record."""
    source, number = Unpacked(file), 0
    while (line := source.line()) is not None:
        if not line:
            continue
        if not re.fullmatch(rb"WARC/\d\.\d", line):
            raise ValueError(f"not a WARC version line: {line[:200]!r}")
        headers: dict[str, str] = {}
        while header := source.line():
            name, _, value = header.decode("latin-1").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield number, headers, source.exactly(int(headers["content-length"]))
        number += 1


def read_warc(files: DataFrame) -> DataFrame:
    """Records of WARC files; digests and lengths of responses are those of what was read."""
    schema = pa.schema(
        [("file", pa.string()), ("record", pa.int64()), ("page_id", pa.int64()),
         ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
         ("target", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with open_input(name) as file:
                    for number, warc, block in warc_records(file):
                        _, headers, payload = split_http(block)
                        page = headers.get(PAGE_ID.lower())
                        size = len(payload)
                        digest = hashlib.sha256(payload).hexdigest()
                        if warc["warc-type"] == "revisit":
                            size = int(warc["x-payload-length"])
                            digest = warc["warc-payload-digest"].removeprefix("sha256:")
                        rows.append(
                            {
                                "file": name,
                                "record": number,
                                "page_id": None if page is None else int(page),
                                "record_type": warc["warc-type"],
                                "record_id": warc["warc-record-id"],
                                "refers_to_id": warc.get("warc-refers-to"),
                                "target": warc["warc-target-uri"],
                                "date": warc["warc-date"],
                                "payload_bytes": size,
                                "payload_digest": digest,
                            }
                        )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return one_file_each(files).mapInArrow(read, RECORD)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Pages through ARC files of both versions, converted to WARC and read back.

    Even page ids (and null) go through version 1, odd ones through version 2.
    One row per input row. A revisit of a response without page id refers to null.
    """
    odd = F.coalesce(F.abs(F.col("page_id") % 2) == 1, F.lit(False))
    files = write_arc(pages.where(~odd), 1).union(write_arc(pages.where(odd), 2))
    records = materialize(read_warc(convert_arc(files)), "warc-records")
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return records.join(responses, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target", "date"
    )
