"""Legacy archive converter: ARC files in, equivalent WARC files out, and readers of both.

An ARC file begins with a version block; its second line names the version (1 or 2), which fixes the
fields of every record's header line. A record is that line and as many bytes as the line declares.
The converter keeps these bytes, the HTTP header among them, and gives each record a WARC identifier,
an ISO date, a type and digests. Of records with equal payloads of at least ``least`` bytes the first
stays a response, the others become revisits that refer to it and keep their header only.

Files are read and written as streams within tasks, through Arrow's file systems, whatever bytes they
hold: one gzip member per record. A file is written under a name of its task attempt and then renamed,
so a task that is run again does no harm. What is no record is skipped up to the next header line and
reported, with its file, place and reason.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, new_path, stage

ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: A record's line: URL and type may hold blanks, the fields between and after them don't.
_LINE = r"(?P<url>\S.*?) (?P<ip>[0-9A-Fa-f.:]+|-) (?P<date>\d{8,17}) (?P<type>.*?)"
_LINES = {1: re.compile(_LINE + r" (?P<length>\d+)"), 2: re.compile(_LINE + r" (?P<code>\d{3}|-) \S+ \S+ \d+ \S+ (?P<length>\d+)")}
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that a reader asks for at once, and payload bytes of a batch of parsed records.
_CHUNK, _BATCH = 1 << 20, 8 << 20
_LEVEL = 6


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


class _Stream:
    """Reads lines and byte counts from gzip data of one or more members, or from plain data."""

    def __init__(self, source):
        self.source, self.rest, self.have, self.at, self.offset = source, source.read(_CHUNK), b"", 0, 0
        self.inflate = zlib.decompressobj(31) if self.rest[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        """Add to what is there; False at the end."""
        piece = b""
        while not piece:
            if not self.rest:
                self.rest = self.source.read(_CHUNK)
            if not self.rest:
                return False
            if self.inflate is None:
                piece, self.rest = self.rest, b""
            else:
                piece = self.inflate.decompress(self.rest, _CHUNK)
                self.rest = self.inflate.unconsumed_tail
                if self.inflate.eof:
                    self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        self.have, self.at = self.have[self.at :] + piece, 0
        return True

    def line(self) -> bytes | None:
        """The next line with its line feed; None at the end."""
        while (end := self.have.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.have) - 1
                break
        return self.take(end + 1 - self.at) if end >= self.at else None

    def take(self, n: int) -> bytes:
        if len(self.have) - self.at < n:
            parts, left = [self.have[self.at :]], n - (len(self.have) - self.at)
            self.have, self.at = b"", 0
            while left > 0 and self._more():
                parts.append(self.have[:left])
                self.at, left = min(left, len(self.have)), left - len(self.have)
            if left > 0:
                raise ValueError(f"the archive ends {left} bytes before a declared length")
            out = b"".join(parts)
        else:
            out = self.have[self.at : self.at + n]
            self.at += n
        self.offset += n
        return out


def uri(url: str | None) -> str:
    """The URL with blanks, controls and non-ASCII characters percent-encoded; ``urn:none`` for null or empty."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in url.encode()) if url else "urn:none"


def _url(raw: bytes) -> str:
    """The URL of a header line: UTF-8, or with its bytes beyond ASCII percent-encoded."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join(chr(b) if b < 0x80 else f"%{b:02X}" for b in raw)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP header with its blank line, and the payload; a block that is no HTTP response has no header."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [at + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (at := block.find(mark)) >= 0]
    end = min(ends, default=len(block))
    return block[:end], block[end:]


def http_field(header: bytes, name: str) -> str | None:
    """The value of the first header field of this name."""
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb"[ \t]*:[ \t]*([^\r\n]*)", header)
    return found[1].decode("latin-1").rstrip() if found else None


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _write_file(folder: str, name: str, records: Iterator[bytes]) -> int:
    """Write a file of one gzip member per record, all of it or nothing; how many there are."""
    from pyspark import TaskContext

    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)
    part, n = f"{path}/_{TaskContext.get().taskAttemptId()}-{name}", 0
    with fs.open_output_stream(part, compression=None) as out:
        for record in records:
            out.write(_member(record))
            n += 1
    fs.move(part, f"{path}/{name}")
    return n


def arc_version_block(version: int, date: str, name: str) -> bytes:
    body = f"{version} {0} voxloom\n{ARC_FIELDS[version]}\n".encode()
    extra = "" if version == 1 else "200 - - 0 " + name + " "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {extra}{len(body)}\n".encode() + body


def arc_record(version: int, url: str | None, page_id: str, payload: bytes, date: str, offset: int, name: str) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {page_id}\r\n\r\n".encode() + payload
    extra = "" if version == 1 else f"200 {hashlib.md5(payload).hexdigest()} - {offset} {name} "
    return f"{uri(url)} 127.0.0.1 {date} text/html {extra}{len(block)}\n".encode() + block


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20240101000000") -> None:
    """ARC files of all rows: tasks with an even number write version 1, the others version 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part:06d}.arc.gz"

        def records() -> Iterator[bytes]:
            yield arc_version_block(version, date, name) + b"\n"
            offset = 0
            for batch in batches:
                for page, url, html in zip(*(batch.column(c) for c in ("id", "url", "html")), strict=True):
                    payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                    record = arc_record(version, url.as_py(), page.as_py() or "", payload, date, offset, name) + b"\n"
                    offset += len(record)
                    yield record

        yield pa.RecordBatch.from_arrays([pa.array([_write_file(path, name, records())], pa.int64())], names=["n"])

    rows = pages.select(pages[f"`{id_col}`"].cast("string").alias("id"), pages[f"`{url_col}`"].cast("string").alias("url"), pages[f"`{html_col}`"].cast("string").alias("html"))
    rows.mapInArrow(run, "n long").agg(F.sum("n")).first()


def parse_arc(source) -> Iterator[dict]:
    """Records of one ARC file, plain or gzip, with their ``block``; or, with ``error``, why bytes at ``offset`` are none.

    ``source`` is a binary file object. After a line that is no header the search goes on with the next
    line; a file that ends early or is damaged as gzip ends there, with what was wrong.
    """
    line_of, lost = _LINES[1], None  # which fits a version block of either version
    try:
        s = _Stream(source)
        while (line := s.line()) is not None:
            at = s.offset - len(line)
            if not line.strip():  # records are set apart by line feeds
                continue
            found = line_of.fullmatch(line.decode("latin-1").rstrip("\r\n"))
            if found is None:
                lost = at if lost is None else lost
                continue
            if lost is not None:
                yield {"offset": lost, "error": f"{at - lost} bytes that are no ARC record"}
                lost = None
            block = s.take(int(found["length"]))
            if found["url"].startswith("filedesc://"):
                version = block.split(b" ", 1)[0]
                if version not in (b"1", b"2"):
                    yield {"offset": at, "error": f"ARC version {version[:20]!r}"}
                    return
                line_of = _LINES[int(version)]
                continue
            yield {"url": _url(found["url"].encode("latin-1")), "ip": found["ip"], "date": found["date"], "type": found["type"], "offset": at, "block": block, "error": None}
        if lost is not None:
            yield {"offset": lost, "error": f"{s.offset - lost} bytes that are no ARC record"}
    except (ValueError, zlib.error) as e:
        yield {"offset": s.offset, "error": str(e)}


def parse_warc(source) -> Iterator[dict]:
    """Records of one WARC file, plain or gzip: ``head`` (fields, lower-case names) and ``block``; or ``error`` as above."""
    lost = None
    try:
        s = _Stream(source)
        while (line := s.line()) is not None:
            at = s.offset - len(line)
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                lost = at if lost is None else lost
                continue
            if lost is not None:
                yield {"offset": lost, "error": f"{at - lost} bytes that are no WARC record"}
                lost = None
            head: dict[str, str] = {}
            while (line := s.line()) is not None and line.strip():
                key, _, value = line.decode("utf-8", "replace").partition(":")
                head[key.strip().lower()] = value.strip()
            if not head.get("content-length", "").isdigit() or "warc-type" not in head:
                lost = at
                continue
            yield {"head": head, "block": s.take(int(head["content-length"])), "offset": at, "error": None}
        if lost is not None:
            yield {"offset": lost, "error": f"{s.offset - lost} bytes that are no WARC record"}
    except (ValueError, zlib.error) as e:
        yield {"offset": s.offset, "error": str(e)}


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path")


def _read(spark: SparkSession, path: str, parse: Callable, row: Callable[..., dict | None], kinds: dict[str, pa.DataType], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("path").to_pylist():
                fs, own = _open(file)
                rows, size = [], 0
                with fs.open_input_stream(own, compression=None) as source:
                    for record in parse(source):
                        if (r := row(record)) is not None:
                            rows.append(r | {"file": file, "offset": record["offset"], "error": record["error"]})
                            size += len(r.get("payload") or b"") + 200
                        if size >= _BATCH:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return _files(spark, path).mapInArrow(run, schema)


_PLACE, _PLACE_SCHEMA = {"file": pa.string(), "offset": pa.int64(), "error": pa.string()}, "file string, offset long, error string"


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``(id, url, ip, date, type, header, payload, size, digest)`` and file, offset and error of every record of the ARC files in a folder.

    ``id`` is the HTTP field X-Page-Id, if there is one; size and digest are of the payload, which is
    left out without ``payloads``. Broken records have nothing but file, offset and error.
    """

    def row(r: dict) -> dict:
        if r["error"]:
            return {}
        header, payload = split_http(r["block"])
        digest = hashlib.sha256(payload).hexdigest()
        out = {"id": http_field(header, "X-Page-Id") or None, "size": len(payload), "digest": digest} | {k: r[k] for k in ("url", "ip", "date", "type")}
        return out | {"header": header, "payload": payload} if payloads else out

    kinds = {"id": pa.string(), "url": pa.string(), "ip": pa.string(), "date": pa.string(), "type": pa.string(), "header": pa.binary(), "payload": pa.binary(), "size": pa.int64(), "digest": pa.string()}
    return _read(spark, path, parse_arc, row, kinds | _PLACE, "id string, url string, ip string, date string, type string, header binary, payload binary, size long, digest string, " + _PLACE_SCHEMA)


def iso_date(arc_date: str) -> str:
    d = (arc_date + "00000101000000"[len(arc_date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def record_id(url: str, date: str, file: str, offset: int) -> str:
    """The same identifier whenever the same record of a file is converted."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{url} {date} {file} {offset}'.encode()).digest()[:16], version=4)}>"


def _warc(fields: dict[str, str | int | None], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{head}WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _warc_record(r: dict, file: str, first: dict | None) -> bytes:
    """The WARC record of an ARC record; ``first`` is the record that it revisits."""
    header, payload = split_http(r["block"])
    http = bool(header)
    fields = {
        "WARC-Type": "revisit" if first else "response" if http else "resource", "WARC-Record-ID": record_id(r["url"], r["date"], file, r["offset"]), "WARC-Date": iso_date(r["date"]), "WARC-Target-URI": uri(r["url"]),
        "WARC-IP-Address": None if r["ip"] in ("-", "0.0.0.0") else r["ip"], "WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(), "X-Payload-Length": len(payload),
        "X-Page-Id": http_field(header, "X-Page-Id"), "Content-Type": "application/http; msgtype=response" if http else r["type"] or "application/octet-stream",
    }
    if first:
        fields |= {"WARC-Profile": _REVISIT, "WARC-Refers-To": record_id(first["url"], first["date"], first["file"], first["offset"]), "WARC-Refers-To-Target-URI": uri(first["url"]), "WARC-Refers-To-Date": iso_date(first["date"]), "X-Refers-To-Page-Id": first["id"]}
    return _warc(fields, header if first else r["block"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, id_type: str = "long", least: int = 100) -> DataFrame:
    """Write the WARC files equivalent to a folder of ARC files, one each; the broken records, as a table.

    Of records with equal payloads the first is the one with the smallest id; records without one come
    last, in the order of date, file and place. Records that repeat the first one's id are responses too.
    The archives are read twice, payloads are never moved: what is joined are their digests.
    """
    heads = stage(read_arc(spark, arc_path, payloads=False).drop("header", "payload"), "arc-records")
    page = F.col("id").try_cast(id_type)
    order = F.struct(page.isNull().alias("none"), page.alias("page"), F.rpad("date", 17, "0").alias("at"), "file", "offset", "id", "url", "date")
    large = heads.where(F.col("size") >= least)
    first = large.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d"), "first")
    again = large.join(stage(first, "first-payloads"), F.col("digest") == F.col("d"))  # a table: a payload of very many records can be split
    again = again.where(~((F.col("file") == F.col("first.file")) & (F.col("offset") == F.col("first.offset"))) & ~F.coalesce(page == F.col("first.page"), F.lit(False)))
    again = again.groupBy("file").agg(F.collect_list(F.struct("offset", "first.id", "first.url", F.col("first.date").alias("date"), F.col("first.file").alias("first_file"), F.col("first.offset").alias("first_offset"))).alias("again"))
    files = _files(spark, arc_path).join(again.withColumnRenamed("file", "f"), F.col("path") == F.col("f"), "left").select("path", "again")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, own in zip(batch.column("path").to_pylist(), batch.column("again"), strict=True):
                known = {r["offset"]: {"id": r["id"], "url": r["url"], "date": r["date"], "file": r["first_file"], "offset": r["first_offset"]} for r in own.as_py() or ()}
                yield pa.RecordBatch.from_arrays([pa.array([_convert_file(file, known, warc_path)], pa.int64())], names=["n"])

    files.repartition(max(1, files.count())).mapInArrow(run, "n long").agg(F.sum("n")).first()
    broken = stage(heads.where("error is not null").select("file", "offset", "error"), "broken-records")
    discard(heads)
    return broken


def _convert_file(file: str, again: dict[int, dict], folder: str) -> int:
    fs, own = _open(file)
    name = f"{hashlib.sha256(file.encode()).hexdigest()[:16]}-{re.sub(r'(?:[.]arc)?(?:[.]gz)?$', '', file.rsplit('/', 1)[-1])}.warc.gz"

    def records(source) -> Iterator[bytes]:
        info = f"software: voxloom\r\nformat: WARC File Format 1.1\r\nconverted-from: {uri(file)}\r\n".encode()
        yield _warc({"WARC-Type": "warcinfo", "WARC-Record-ID": record_id("warcinfo", "", file, 0), "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Filename": name, "Content-Type": "application/warc-fields"}, info)
        for r in parse_arc(source):
            if not r["error"]:
                yield _warc_record(r, file, again.get(r["offset"]))

    with fs.open_input_stream(own, compression=None) as source:
        return _write_file(folder, name, records(source))


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``(id, url, date, size, digest, type, refers_to, header, payload)`` and file, offset and error of the responses, resources and revisits in a folder.

    Size and digest are of the full payload: of a revisit's as declared, of others as read. Header and
    payload are left out without ``payloads``.
    """

    def row(r: dict) -> dict | None:
        if r["error"]:
            return {}
        head, kind = r["head"], r["head"]["warc-type"]
        if kind not in ("response", "resource", "revisit"):
            return None
        header, payload = split_http(r["block"])
        whole = kind != "revisit"
        size = head.get("x-payload-length") or http_field(header, "Content-Length") or ""
        out = {
            "id": head.get("x-page-id") or http_field(header, "X-Page-Id") or None, "url": head.get("warc-target-uri"), "date": head.get("warc-date"), "type": kind, "refers_to": head.get("x-refers-to-page-id"),
            "size": len(payload) if whole else int(size) if size.isdigit() else None, "digest": hashlib.sha256(payload).hexdigest() if whole else head.get("warc-payload-digest", "").partition(":")[2] or None,
        }
        return out | {"header": header, "payload": payload if whole else None} if payloads else out

    kinds = {"id": pa.string(), "url": pa.string(), "date": pa.string(), "size": pa.int64(), "digest": pa.string(), "type": pa.string(), "refers_to": pa.string(), "header": pa.binary(), "payload": pa.binary()}
    return _read(spark, path, parse_warc, row, kinds | _PLACE, "id string, url string, date string, size long, digest string, type string, refers_to string, header binary, payload binary, " + _PLACE_SCHEMA)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> DataFrame:
    """Write all rows as ARC files, convert these to WARC, and read the WARC files back.

    Per row: id, payload_bytes, payload_digest, record_type and refers_to. Null html is an empty
    payload, null URLs and ids are kept as such; of equal payloads that all lack an id one is the
    response, and the others revisit it without naming an id. Other columns are not archived. An empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    id_type = pages.schema[id_col].dataType.simpleString()
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    broken = convert(spark, arc, warc, id_type, least)
    if not broken.isEmpty():
        raise RuntimeError(f"broken records: {broken.limit(5).collect()}")
    back = read_warc(spark, warc, payloads=False)
    return back.select(F.col("id").cast(id_type).alias(id_col), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to").cast(id_type).alias("refers_to"))


#: The same rows in DuckDB.
ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN p.payload_bytes >= 100 AND f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.payload_bytes >= 100 AND p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
