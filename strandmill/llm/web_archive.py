"""Legacy archive converter: ARC records to WARC records, and both formats' readers and writers.

ARC: a file begins with a version block ("filedesc://", its own declared length, then a line with
the version number and the field names); each record is one header line, its fields by version (1:
URL IP date type length; 2: URL IP date type result checksum location offset filename length), then
exactly as many bytes as declared, then a newline. Each ARC record becomes one WARC/1.1 record: the
URL and IP carry over, the 14-digit date becomes an ISO date, the id is a name-based UUID of the
record's own fields, the payload digest is the SHA-1 of what follows the HTTP header, and a payload
that a given other page holds becomes a revisit with HTTP header only that refers to that page's
record, by its id, url and date. Each WARC file begins with a warcinfo record.

Defined results: null html is an empty payload; a null or spaced url is written percent-encoded (null: "-");
of repeated rows with the largest page_id each is a response; a null page_id counts as the smallest.
Payloads are whole, of any length; a record is held in memory one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.components import split_join
from strandmill.llm.shared import fresh_path

#: Field names of a record's header line, by ARC version; fixed values of the format.
ARC_FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
ID_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:strandmill:arc-record")
ROLL_BYTES = 64 << 20


class ArcRecord(NamedTuple):
    version: str
    fields: dict[str, str]
    block: bytes


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_version_block(version: str, name: str, date: str = "20240101000000") -> bytes:
    """The first record of an ARC file."""
    names = " ".join(ARC_FIELDS[version])
    body = f"{version} 0 strandmill\n{names}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain", "Archive-length": str(len(body)), "Filename": name, "Offset": "0"}
    return " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_record(version: str, url: str, date: str, block: bytes, ip: str = "0.0.0.0", kind: str = "text/html", **more: str) -> bytes:
    values = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Archive-length": str(len(block))} | more
    return " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode() + b"\n" + block + b"\n"


def read_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """Records of an ARC file, without its version blocks; lengths are as declared, never guessed."""
    names: list[str] = []
    version = ""
    while line := stream.readline():
        if line == b"\n":
            continue
        values = line.decode("utf-8").rstrip("\n").split(" ")
        size = int(values[-1])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"ARC record of {size} bytes ends after {len(block)}")
        if values[0].startswith("filedesc://"):
            first, fields = block.decode().split("\n")[:2]
            version, names = first.split(" ")[0], fields.split(" ")
            if names != ARC_FIELDS.get(version):
                raise ValueError(f"ARC version {version} with fields {names}")
            continue
        if len(values) != len(names):
            raise ValueError(f"ARC header line with {len(values)} fields, version {version} has {len(names)}")
        yield ArcRecord(version, dict(zip(names, values)), block)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its empty line, and payload; a block without such a header is all payload."""
    if block.startswith(b"HTTP/") and (end := block.find(b"\r\n\r\n")) >= 0:
        return block[: end + 4], block[end + 4 :]
    return b"", block


def arc_date(date: str) -> str:
    """14 digits (shorter ones are filled with the first month, day or zeros) to ISO."""
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, page_id: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(ID_SPACE, f'{url} {date} {page_id}')}>"


def warc_info(name: str) -> WarcRecord:
    """The record that a WARC file begins with."""
    block = b"software: strandmill\r\nformat: WARC File Format 1.1\r\n"
    return WarcRecord({
        "WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(ID_SPACE, name)}>", "WARC-Date": arc_date("2024"), "WARC-Filename": name,
        "WARC-Block-Digest": "sha1:" + sha1_base32(block), "Content-Type": "application/warc-fields", "Content-Length": str(len(block)),
    }, block)


def to_warc(record: ArcRecord, page_id: str = "-", refers_to: tuple[str, str] | None = None) -> WarcRecord:
    """The equivalent WARC record; refers_to: id and url of the page whose response this record revisits, taken on the same date."""
    head, payload = split_http(record.block)
    headers = {
        "WARC-Type": "revisit" if refers_to is not None else "response" if head else "resource",
        "WARC-Record-ID": record_id(record.fields["URL"], record.fields["Archive-date"], page_id),
        "WARC-Date": arc_date(record.fields["Archive-date"]),
        "WARC-Target-URI": record.fields["URL"],
        "WARC-IP-Address": record.fields["IP-address"],
        "WARC-Payload-Digest": "sha1:" + sha1_base32(payload),
        "WARC-Page-Id": page_id,
        "WARC-Payload-Length": str(len(payload)),
    }
    block = record.block
    if refers_to is not None:
        block = head
        headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To-Page-Id": refers_to[0]}
        headers |= {"WARC-Refers-To": record_id(refers_to[1], record.fields["Archive-date"], refers_to[0]), "WARC-Refers-To-Target-URI": refers_to[1], "WARC-Refers-To-Date": headers["WARC-Date"]}
    headers |= {"WARC-Block-Digest": "sha1:" + sha1_base32(block), "Content-Type": "application/http; msgtype=response" if head else record.fields["Content-type"], "Content-Length": str(len(block))}
    return WarcRecord(headers, block)


def warc_bytes(record: WarcRecord, level: int = 1) -> bytes:
    """One record as a gzip member of its own."""
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in record.headers.items()).encode() + b"\r\n" + record.block + b"\r\n\r\n"
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(raw) + packer.flush()


def _members(stream: BinaryIO, chunk: int = 1 << 20) -> Iterator[bytes]:
    data = b""
    while data or (data := stream.read(chunk)):
        opened, out = zlib.decompressobj(wbits=31), []
        while True:
            out.append(opened.decompress(data))
            if opened.eof:
                data = opened.unused_data
                break
            if not (data := stream.read(chunk)):
                raise ValueError("WARC file ends inside a record")
        yield b"".join(out)


def read_warc(stream: BinaryIO) -> Iterator[WarcRecord]:
    """Records of a gzipped WARC file; block and payload digests are verified."""
    for raw in _members(stream):
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = rest[: int(headers["Content-Length"])]
        if "sha1:" + sha1_base32(block) != headers["WARC-Block-Digest"]:
            raise ValueError(f"block digest of {headers['WARC-Record-ID']} differs")
        if headers["WARC-Type"] not in ("revisit", "warcinfo") and "sha1:" + sha1_base32(split_http(block)[1]) != headers["WARC-Payload-Digest"]:
            raise ValueError(f"payload digest of {headers['WARC-Record-ID']} differs")
        yield WarcRecord(headers, block)


def page_block(page_id: str, html: bytes) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {page_id}\r\nContent-Length: {len(html)}\r\n\r\n".encode() + html


def written_url(url: str | None) -> str:
    """As archives hold it: percent-encoded, or "-"."""
    return quote(url, safe="/:?#[]@!$&'()*+,;=%~-._") if url else "-"


def page_arc(rows: Iterable[tuple[str, str | None, bytes]], version: str, name: str) -> Iterator[bytes]:
    """An ARC file of pages (page id, url, html), piece by piece."""
    yield arc_version_block(version, name)
    for page_id, url, html in rows:
        yield arc_record(version, written_url(url), "20240101000000", page_block(page_id, html))


def archive_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the pages as WARC files in folder, each by way of an ARC record, and returns the manifest
    (path, records) as a table in that folder. Files of lost or repeated attempts are not in it.

    Of equal payloads the one with the largest id is the response and the others revisit it. Their
    leaders come from one aggregate over digests, pre-aggregated by task; the join back splits digests that
    many pages share."""
    html = F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b""))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html).alias("sha"))
    leaders = base.groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("leader"), F.count(F.lit(1)).alias("rows_of_key"))
    other = F.col("leader.page_id").isNotNull() & ~F.col("leader.page_id").eqNullSafe(F.col("page_id"))
    joined = split_join(base, leaders, "sha", pages.count()).select("page_id", "url", "html", F.when(other, F.col("leader.page_id")).alias("refers_to"), F.when(other, F.col("leader.url")).alias("refers_url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        stem = f"{root}/pages-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, count, part, done = None, 0, 0, []

        def close() -> None:
            if out is not None:
                out.close()
                done.append((f"{stem}-{part}.warc.gz", count))

        for batch in batches:
            for page, url, body, refers, refers_url in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to", "refers_url"))):
                name = "-" if page is None else str(page)
                version = "2" if (page or 0) % 2 else "1"
                arc = io.BytesIO(b"".join(page_arc([(name, url, body)], version, "pages.arc")))
                for record in read_arc(arc):
                    if out is None or out.tell() > ROLL_BYTES:
                        close()
                        part, count = part + 1, 0
                        out = store.open_output_stream(f"{stem}-{part}.warc.gz", compression=None)
                        out.write(warc_bytes(warc_info(f"{stem.rsplit('/', 1)[1]}-{part}.warc.gz")))
                    out.write(warc_bytes(to_warc(record, name, None if refers is None else (str(refers), written_url(refers_url)))))
                    count += 1
        close()
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "records": [n for _, n in done]}, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    joined.mapInArrow(write, "path string, records long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's WARC files, from their headers and blocks."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string"
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, records in zip(batch["path"].to_pylist(), batch["records"].to_pylist()):
                rows, seen = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for record in read_warc(stream):
                        h = record.headers
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        revisit = h["WARC-Type"] == "revisit"
                        size = int(h["WARC-Payload-Length"]) if revisit else len(split_http(record.block)[1])
                        rows.append((None if h["WARC-Page-Id"] == "-" else int(h["WARC-Page-Id"]), h["WARC-Target-URI"], size, h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], int(h["WARC-Refers-To-Page-Id"]) if revisit else None, h["WARC-Record-ID"]))
                        seen += 1
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                            rows = []
                if seen != records:
                    raise ValueError(f"{path} has {seen} records, {records} were written")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    files = manifest.repartition(max(1, min(4096, manifest.count())), "path")
    return files.mapInArrow(read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives the pages in a fresh shared folder and reads the archives back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, folder, archive_pages(pages, folder))
