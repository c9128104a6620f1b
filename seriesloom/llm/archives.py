"""Legacy web archives (ARC) converted to WARC.

An ARC file is a sequence of records, each a header line and as many bytes as the line declares. The first record,
`filedesc:`, names the version and with it the fields of the lines that follow: version 1 has URL, address, date, type
and length, version 2 also result code, checksum, location, offset and file name. Lines are taken apart from the right,
since old URLs may hold spaces. Files are one gzip member per record, or plain.

For every ARC record the converter makes the WARC record that says the same: an identifier derived from the ARC file's
name and the record's place in it (the same in every run), the 14-digit date as a timestamp, a type (response; resource
for other than http; warcinfo for the file's head), block and payload digests (SHA-256, bare hex). Of records with
equal payloads of at least LEAST_BYTES bytes one is the response and the others become revisits of it: their block is
the HTTP header alone, they name the response and keep the payload's length and digest.

Work runs in three jobs: a pass over the archives for lengths and digests; joins of these small rows that find each
record's response; a second pass that writes a WARC file per ARC file. Archives are closed at FILE_BYTES or
FILE_RECORDS, so a task holds one record of the data at a time and the decisions of one file.

Rows of the page queries: null html is an empty payload; null page_ids are kept, come after all others when a response
is chosen, and a revisit of such a page has a null refers_to; among records of one page_id the first by file and place
is the response; repeated rows are records each; a null URL is written as `-`, blanks and control characters in URLs are
percent-encoded; an empty table gives no file and no row; extra columns are not read. A broken ARC record raises an
error that names file and place.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NAMED, chunks, drop, scratch, table, written

LEAST_BYTES = 100
#: An archive is closed when its records reach so many bytes before compression, or so many records.
FILE_BYTES, FILE_RECORDS = 64_000_000, 20_000
READ = 1 << 20
FETCHED = "20240101000000"

# Names and fields of the two archive formats.
ARC_FIELDS = {
    1: ("url", "address", "date", "type", "length"),
    2: ("url", "address", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_HEADINGS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-to-warc")

FILES = "file string, version int, n_records long"
INDEX = "file string, offset long, page_id long, url string, date string, payload_bytes long, payload_digest string"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, refers_to_id string, url string, date string"


# ---- byte streams ------------------------------------------------------------
class Members:
    """Bytes of a file by place. A gzip file is read member by member; place is the first byte of the member.

    Nothing but the current member's unread bytes is held.
    """

    def __init__(self, source):
        self.source, self.buffer, self.place = source, b"", 0
        self.raw, self.raw_at = source.read(READ), 0
        self.zipped = self.raw[:2] == b"\x1f\x8b"
        self.inflate = None
        if not self.zipped:
            self.buffer = self.raw

    def _more(self) -> bool:
        if not self.zipped:
            data = self.source.read(READ)
            self.buffer += data
            return bool(data)
        while self.inflate is not None and not self.inflate.eof:
            if not self.raw:
                self.raw = self.source.read(READ)
                if not self.raw:
                    raise ValueError(f"gzip member at byte {self.place} is cut off")
            before = len(self.raw)
            data = self.inflate.decompress(self.raw, READ)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.raw_at += before - len(self.raw)
            if data:
                self.buffer += data
                return True
        return False

    def next_record(self) -> bool:
        """Go to the next record; False at the end of the file."""
        if self.zipped:
            while self._more():  # what is left of a member is no part of the next record
                self.buffer = b""
            self.raw = self.raw or self.source.read(READ)
            if not self.raw:
                return False
            self.place, self.buffer, self.inflate = self.raw_at, b"", zlib.decompressobj(31)
            return True
        while True:
            kept = self.buffer.lstrip(b"\r\n")
            self.place += len(self.buffer) - len(kept)
            self.buffer = kept
            if kept:
                return True
            if not self._more():
                return False

    def _taken(self, n: int) -> bytes:
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        if not self.zipped:
            self.place += n
        return out

    def line(self) -> bytes:
        start = 0
        while (end := self.buffer.find(b"\n", start)) < 0:
            start = len(self.buffer)
            if not self._more():
                raise ValueError(f"no end of line after byte {self.place}")
        return self._taken(end + 1).rstrip(b"\r\n")

    def block(self, n: int) -> bytes:
        parts, missing = [], n
        while missing:
            if not self.buffer and not self._more():
                raise ValueError(f"record at byte {self.place} is {missing} bytes shorter than declared")
            parts.append(self._taken(missing))
            missing -= len(parts[-1])
        return b"".join(parts)


class RecordFile:
    """A file written one gzip member per record."""

    def __init__(self, uri: str):
        store, place = pafs.FileSystem.from_uri(uri)
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.uri, self.sink = uri, store.open_output_stream(place, compression=None)
        self.n_bytes = self.n_records = 0

    def add(self, *parts: bytes) -> None:
        zipper = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.sink.write(b"".join([*(zipper.compress(p) for p in parts), zipper.flush()]))
        self.n_bytes += sum(map(len, parts))
        self.n_records += 1

    @property
    def full(self) -> bool:
        return self.n_bytes >= FILE_BYTES or self.n_records >= FILE_RECORDS

    def close(self) -> None:
        self.sink.close()


def _opened(uri: str):
    store, place = pafs.FileSystem.from_uri(uri)
    return store.open_input_stream(place, compression=None)


# ---- ARC -----------------------------------------------------------------------
@dataclass
class ArcRecord:
    place: int
    url: str
    address: str
    date: str
    type: str
    block: bytes

    def http(self) -> tuple[bytes, bytes]:
        """(HTTP header with its blank line, payload); no header where the block does not begin with a status line."""
        if not self.block.startswith(b"HTTP/"):
            return b"", self.block
        end = self.block.find(b"\r\n\r\n")
        return (self.block, b"") if end < 0 else (self.block[: end + 4], self.block[end + 4 :])


def arc_header(line: bytes, version: int) -> dict[str, str]:
    """Fields of a record's header line; the URL is whatever stands left of the others."""
    names = ARC_FIELDS[version]
    fields = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
    if len(fields) != len(names) or not fields[-1].isdigit():
        raise ValueError(f"not a header line of version {version}: {line[:200]!r}")
    found = dict(zip(names, fields, strict=True))
    if not re.fullmatch(r"\d{12}|\d{14}", found["date"]):
        raise ValueError(f"not a date: {found['date']!r}")
    return found


def read_arc(file: str) -> Iterator[ArcRecord]:
    """Records of an ARC file in a store that pyarrow reads."""
    try:
        yield from arc_records(_opened(file))
    except ValueError as broken:
        raise ValueError(f"{file}: {broken}") from broken


def arc_records(source) -> Iterator[ArcRecord]:
    """Records of an open ARC file, the file's head first (its URL begins with `filedesc:`)."""
    members, version = Members(source), None
    while members.next_record():
        place, line = members.place, members.line()
        if version is None:
            # The head's own line is one of either version; the line after it says which.
            fields = arc_header(line, 1 if len(line.split(b" ")) == len(ARC_FIELDS[1]) else 2)
            if not fields["url"].startswith("filedesc:"):
                raise ValueError("an ARC file begins with a filedesc: record")
            block = members.block(int(fields["length"]))
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            fields = arc_header(line, version)
            block = members.block(int(fields["length"]))
        yield ArcRecord(place, fields["url"], fields["address"], fields["date"], fields["type"], block)


def _plain_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


class ArcFile(RecordFile):
    def __init__(self, uri: str, version: int, date: str):
        super().__init__(uri)
        self.name, self.version, self.date = uri.rsplit("/", 1)[1], version, date
        about = f"{version} 0 own\n{ARC_HEADINGS[version]}\n\n".encode()
        self.add(self._line(f"filedesc://{self.name}", "0.0.0.0", "text/plain", 200, len(about)), about)
        self.n_records = 0

    def _line(self, url: str, address: str, kind: str, status: int, length: int) -> bytes:
        middle = f" {status} - - {self.n_bytes} {self.name}" if self.version == 2 else ""
        return f"{url} {address} {self.date} {kind}{middle} {length}\n".encode()

    def page(self, page_id: int | None, url: str | None, payload: bytes) -> None:
        own = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode()
        self.add(self._line(_plain_url(url), "0.0.0.0", "text/html", 200, len(head) + len(payload)), head, payload, b"\n")


def write_arc(pages: DataFrame, path: str, date: str = FETCHED) -> DataFrame:
    """Pages as ARC files below `path`, files of version 1 and 2 in turn; returns the table of the files.

    Files are named by task and attempt; the table names those of attempts that succeeded.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, out, done = TaskContext.get(), 0, None, []
        for batch in chunks(batches, "html"):
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                if out is None:
                    out = ArcFile(f"{path}/files/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{made:05d}.arc.gz", 1 + (task.partitionId() + made) % 2, date)
                    made += 1
                out.page(page_id, url, (html or "").encode("utf-8"))
                if out.full:
                    out.close()
                    done.append(out)
                    out = None
        if out is not None:
            out.close()
            done.append(out)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x.uri for x in done]), pa.array([x.version for x in done], pa.int32()), pa.array([x.n_records for x in done], pa.int64())],
                                             names=["file", "version", "n_records"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows.mapInArrow(write, FILES).write.parquet(f"{path}/manifest")
    return pages.sparkSession.read.schema(FILES).parquet(f"{path}/manifest")


# ---- WARC ------------------------------------------------------------------------
def record_id(file: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, file.rsplit('/', 1)[1] + '#' + str(place))}>"


def warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def header_value(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb"[ \t]*:[ \t]*(.*?)[ \t]*\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def _warc_head(fields: dict) -> bytes:
    return "".join([f"{WARC_VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None), "\r\n"]).encode("utf-8", "surrogatepass")


def warc_record(file: str, r: ArcRecord, first: dict | None) -> tuple[bytes, bytes]:
    """(header, block) of the WARC record that says what the ARC record says; `first` is the response it repeats, if any."""
    fields = {"WARC-Type": "response", "WARC-Record-ID": record_id(file, r.place), "WARC-Date": warc_date(r.date)}
    if r.url.startswith("filedesc:"):
        fields |= {"WARC-Type": "warcinfo", "WARC-Filename": file.rsplit("/", 1)[1]}
        block, kind = b"software: ARC converter\r\nformat: WARC File Format 1.1\r\n", "application/warc-fields"
    else:
        head, payload = r.http()
        fields |= {"WARC-Target-URI": r.url, "WARC-IP-Address": None if r.address in ("0.0.0.0", "-") else r.address,
                   "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}"}
        block, kind = r.block, "application/http; msgtype=response" if head else r.type
        if not head:
            fields["WARC-Type"] = "resource"
        if first is not None:
            block = head
            fields |= {"WARC-Type": "revisit", "WARC-Profile": IDENTICAL, "WARC-Refers-To": first["id"], "WARC-Refers-To-Target-URI": first["url"],
                       "WARC-Refers-To-Date": warc_date(first["date"]), f"{PAGE_HEADER}-Referred": first["page_id"], "X-Payload-Length": len(payload)}
    fields |= {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type": kind, "Content-Length": len(block)}
    return _warc_head(fields), block


def warc_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an open WARC file; block digests are verified."""
    members = Members(source)
    while members.next_record():
        if not (version := members.line()).startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {members.place}: {version[:100]!r}")
        fields = {}
        while line := members.line():
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = members.block(int(fields["content-length"]))
        if "sha256:" + hashlib.sha256(block).hexdigest() != fields.get("warc-block-digest"):
            raise ValueError(f"block digest of {fields.get('warc-record-id')} is wrong")
        yield fields, block


# ---- conversion ------------------------------------------------------------------
def _of_file(files: DataFrame) -> DataFrame:
    """One row per task, so that archives are read side by side whatever file the table is in."""
    return files.repartition(max(1, files.count()))


def index_arc(files: DataFrame) -> DataFrame:
    """Place, length and payload digest of every ARC record but the heads."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for r in read_arc(file):
                    if r.url.startswith("filedesc:"):
                        continue
                    head, payload = r.http()
                    page = header_value(head, PAGE_HEADER)
                    rows.append((file, r.place, None if page is None else int(page), r.url, r.date, len(payload), hashlib.sha256(payload).hexdigest()))
                if rows:
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])

    return _of_file(files.select("file")).mapInArrow(read, INDEX)


def first_records(index: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """For every payload found more than once the record that stays a response: that of the least page_id."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset", "url", "date")
    groups = index.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    return groups.where("n > 1").select(F.col("payload_digest").alias("digest"), *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("page_id", "file", "offset", "url", "date")])


def convert_arc(files: DataFrame, path: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes a WARC file below `path` for every ARC file; returns the table of the WARC files (file, n_records)."""
    spark = files.sparkSession
    index = written(index_arc(files), "arc-index")
    # A table, so that adaptive execution can split the join at a payload that a large share of the records has.
    firsts = written(first_records(index, least), "arc-firsts")
    repeats = index.join(firsts, index["payload_digest"] == firsts["digest"]).where((F.col("file") != F.col("first_file")) | (F.col("offset") != F.col("first_offset")))
    repeats = repeats.where(F.col("payload_bytes") >= least)
    per_file = repeats.groupBy("file").agg(F.collect_list(F.struct("offset", "first_page_id", "first_file", "first_offset", "first_url", "first_date")).alias("repeats"))
    work = files.select("file", "n_records").join(per_file, "file", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for batch in batches:
            for i in range(batch.num_rows):
                file, repeats = batch.column("file")[i].as_py(), batch.column("repeats")[i].as_py() or []
                first = {r["offset"]: {"id": record_id(r["first_file"], r["first_offset"]), "url": r["first_url"], "date": r["first_date"], "page_id": r["first_page_id"]} for r in repeats}
                name = re.sub(r"\.arc(\.gz)?$", "", file.rsplit("/", 1)[1])
                out = RecordFile(f"{path}/files/{name}-{task.taskAttemptId()}.warc.gz")
                for r in read_arc(file):
                    out.add(*warc_record(file, r, first.get(r.place)), b"\r\n\r\n")
                out.close()
                yield pa.RecordBatch.from_arrays([pa.array([out.uri]), pa.array([out.n_records - 1], pa.int64())], names=["file", "n_records"])

    _of_file(work).mapInArrow(write, "file string, n_records long").write.parquet(f"{path}/manifest")
    return spark.read.schema("file string, n_records long").parquet(f"{path}/manifest")


def read_warc(files: DataFrame) -> DataFrame:
    """One row per response, resource or revisit of the WARC files; payload digests of responses are verified."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for fields, block in warc_records(_opened(file)):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    head, payload = ArcRecord(0, "", "", "", "", block).http()
                    size = len(payload)
                    if kind == "revisit":
                        size = int(fields["x-payload-length"])
                    elif hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload digest of {fields['warc-record-id']} is wrong")
                    page, referred = header_value(head, PAGE_HEADER), fields.get(f"{PAGE_HEADER}-Referred".lower())
                    rows.append((None if page is None else int(page), size, digest, kind, None if referred is None else int(referred), fields["warc-record-id"],
                                 fields.get("warc-refers-to"), fields["warc-target-uri"], fields["warc-date"]))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in PAGES.split(", ")])

    return _of_file(files.select("file")).mapInArrow(read, PAGES)


def op11_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as ARC files, converted to WARC and read back."""
    arcs = write_arc(table(spark, sf_dir, "pages"), scratch(spark, "arc"))
    folder = NAMED[-1]
    warcs = convert_arc(arcs, scratch(spark, "warc"))
    drop(spark, [folder])
    return read_warc(warcs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_SQL = """
SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN octet_length(encode(h)) < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN octet_length(encode(h)) < 100 OR page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
"""

QUERIES = {"op11_legacy_archives": op11_legacy_archives}
ORACLES = {"op11_legacy_archives": _SQL}
