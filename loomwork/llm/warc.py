"""WARC archives: written from tables with revisit records for copies, read as a Spark data source."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith,
)

from ..storage import new_path
from .texts import pieces

# The WARC 1.1 format, and gzip's header.
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
SKIP = b"SL"  # gzip extra field with the member's whole length, so that readers can skip it
PAGE, REFERS_PAGE = "X-Page-ID", "X-Refers-To-Page-ID"  # extension fields of ours
HEADERS_AT_MOST = 1 << 22  # a header block beyond this is taken for a broken file


# --- records -----------------------------------------------------------------------------------


def digest32(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member of its own that says how long it is."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = SKIP + (8).to_bytes(2, "little") + (24 + len(body) + 8).to_bytes(8, "little")
    head = GZIP + b"\x04" + bytes(5) + b"\xff" + len(extra).to_bytes(2, "little") + extra
    return head + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


def record(page_id, url, payload: bytes, refers_to=None, is_revisit: bool = False, date: str = "") -> bytes:
    """A response record, or a revisit without the payload that it repeats."""
    digest = digest32(payload)
    name = lambda page: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}|{digest}')}>"
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", name(page_id) if not is_revisit else name(f"{page_id}|{refers_to}")),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append((PAGE, str(page_id)))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", name(refers_to))]
        if refers_to is not None:
            fields.append((REFERS_PAGE, str(refers_to)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    block = http if is_revisit else http + payload
    fields.append(("Content-Length", str(len(block))))
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields)]).encode()
    return head + END + block + END


def parse_fields(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space goes on with the one before."""
    out: dict[str, str] = {}
    last = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        else:
            key, colon, value = line.partition(":")
            if colon:
                last = key.strip().lower()
                out[last] = value.strip()
    return out


# --- reading -----------------------------------------------------------------------------------


class Member:
    """A record's bytes, decoded no further than asked for."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size, self.next_at = file, at, size, at
        self.data, self.done, self.end = bytearray(), False, None
        head = file.read_at(min(64, size - at), at)
        self.packed = head[:3] == GZIP
        self.unpacker = zlib.decompressobj(31) if self.packed else None
        if self.packed and head[3] & 4 and head[12:14] == SKIP:
            self.end = at + int.from_bytes(head[16:24], "little")

    def more(self, n: int = 1 << 16) -> None:
        chunk = self.file.read_at(min(n, self.size - self.next_at), self.next_at)
        self.next_at += len(chunk)
        if self.packed:
            self.data += self.unpacker.decompress(chunk)
            if self.unpacker.eof:
                self.end = self.next_at - len(self.unpacker.unused_data)
                self.done = True
        else:
            self.data += chunk
        if not self.done and self.next_at >= self.size:
            if self.packed and not self.unpacker.eof:
                raise ValueError(f"the gzip member at {self.at} is cut off")
            self.done = True

    def until(self, mark: bytes, start: int = 0) -> int:
        """Where ``mark`` begins, decoding as far as needed."""
        seen = start
        while (found := self.data.find(mark, max(start, seen - len(mark)))) < 0:
            if self.done or len(self.data) - start > HEADERS_AT_MOST:
                raise ValueError(f"no end of header in the record at {self.at}")
            seen = len(self.data)
            self.more(1 << 12)
        return found

    def upto(self, n: int) -> None:
        while len(self.data) < n and not self.done:
            self.more()
        if len(self.data) < n:
            raise ValueError(f"the record at {self.at} is cut off")

    def finish(self, record_bytes: int) -> int:
        """Where the next record begins."""
        if not self.packed:
            return self.at + record_bytes
        while self.end is None:
            self.data.clear()
            self.more()
        return self.end


@dataclass(frozen=True)
class Wanted:
    """Predicates on header fields; all must hold.  ``values`` None asks that the field is there."""

    field: str
    values: tuple[str, ...] | None = None
    prefix: str | None = None
    absent: bool = False

    def holds(self, fields: dict[str, str]) -> bool:
        value = fields.get(self.field)
        if value is None or self.absent:
            return self.absent and value is None
        return (self.values is None or value in self.values) and (self.prefix is None or value.startswith(self.prefix))


# Columns of text that are one header field each.
COLUMNS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "date": "warc-date", "target_uri": "warc-target-uri",
    "content_type": "content-type", "refers_to": "warc-refers-to",
}
_HEADERS = ("headers", pa.map_(pa.string(), pa.string()))
_FACTS = [("payload_digest", pa.string()), ("payload_bytes", pa.int64())]


def read_records(file, size: int, wanted: tuple[Wanted, ...], payload: bool, verify: bool) -> Iterator[tuple]:
    """(fields, digest, length of the whole payload, payload or None) of the records that are wanted.

    Headers are parsed first; the payload of other records, or of all if none
    is asked for, is skipped without being decoded where the file allows it.
    A revisit has no payload; its length is what its HTTP header says.
    """
    at = 0
    while at < size:
        member = Member(file, at, size)
        head_end = member.until(END)
        if not bytes(member.data[:5]) == b"WARC/":
            raise ValueError(f"no WARC record at {at}")
        fields = parse_fields(bytes(member.data[:head_end]))
        body, n = head_end + len(END), int(fields.get("content-length", "0"))
        if all(w.holds(fields) for w in wanted):
            start, length = body, n
            if "application/http" in fields.get("content-type", "").lower() and n:
                http_end = member.until(END, body)
                http = parse_fields(bytes(member.data[body:http_end]))
                start = http_end + len(END)
                length = n - (start - body)
                if fields.get("warc-type") == "revisit" and "content-length" in http:
                    length = int(http["content-length"])
            digest = fields.get("warc-payload-digest", "").rpartition(":")[2].upper() or None
            data = None
            if payload and fields.get("warc-type") != "revisit":
                member.upto(body + n)
                data = bytes(member.data[start : body + n])
                if digest is None:
                    digest = digest32(data)
                elif verify and digest != digest32(data):
                    raise ValueError(f"the payload of the record at {at} isn't what its digest says")
            yield fields, digest, length, data
        at = member.finish(body + n + len(END))


class FilePart(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


class WarcReader(DataSourceReader):
    """Some files a partition; predicates on header columns are looked at before payloads are decoded."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.manifest = options.get("path"), options.get("manifest")
        self.payload = options.get("payload", "true") == "true"
        self.verify = options.get("verify", "true") == "true"
        self.part_bytes = int(options.get("partitionbytes", 128 << 20))
        self.wanted: list[Wanted] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            field = COLUMNS.get(column)
            if field is None:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.wanted.append(Wanted(field, (f.value,)))
            elif isinstance(f, In):
                self.wanted.append(Wanted(field, tuple(f.value)))
            elif isinstance(f, IsNotNull):
                self.wanted.append(Wanted(field))
            elif isinstance(f, IsNull):
                self.wanted.append(Wanted(field, absent=True))
            elif isinstance(f, StringStartsWith):
                self.wanted.append(Wanted(field, prefix=f.value))
            else:
                yield f

    def partitions(self) -> list[FilePart]:
        if self.manifest:
            fs, base = pafs.FileSystem.from_uri(self.manifest)
            files = [f.path for f in fs.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".parquet")]
            found = []
            for path in sorted(files):
                with fs.open_input_file(path) as file:
                    table = pq.read_table(file, columns=["path", "bytes"])
                found += zip(table.column("path").to_pylist(), table.column("bytes").to_pylist())
        else:
            fs, base = pafs.FileSystem.from_uri(self.folder)
            infos = fs.get_file_info(pafs.FileSelector(base, recursive=True))
            found = [(f.path, f.size) for f in infos if f.path.endswith((".warc", ".warc.gz"))]
        parts, held = [], 0
        for path, size in sorted(found):
            if not parts or held + size > self.part_bytes:
                parts.append([])
                held = 0
            parts[-1].append(path)
            held += size
        return [FilePart(p) for p in parts] or [FilePart([])]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.manifest or self.folder)
        schema = arrow_schema(self.payload)
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for fields, digest, length, data in read_records(file, file.size(), tuple(self.wanted), self.payload, self.verify):
                    row = [fields.get(f) for f in COLUMNS.values()] + [digest, length, list(fields.items())]
                    rows.append(row + [data] * self.payload)
                    held += 500 + len(data or b"")
                    if held > 1 << 23:
                        yield _batch(rows, schema)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def arrow_schema(payload: bool) -> pa.Schema:
    fields = [(c, pa.string()) for c in COLUMNS] + _FACTS + [_HEADERS] + [("payload", pa.binary())] * payload
    return pa.schema(fields)


class WarcSource(DataSource):
    """``spark.read.format("warc")``: a row per record.

    Options: ``path`` (a folder of .warc and .warc.gz files) or ``manifest`` (a
    Parquet table with ``path`` and ``bytes``), ``payload`` (false: not read),
    ``verify`` (false: payloads aren't held against their digests) and
    ``partitionBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        text = ", ".join(f"{c} string" for c in COLUMNS)
        payload = ", payload binary" if self.options.get("payload", "true") == "true" else ""
        return f"{text}, payload_digest string, payload_bytes long, headers map<string,string>{payload}"

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, **options) -> DataFrame:
    """Records of archives.  Turns on Spark's filter push-down for Python data sources in the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(**options).load()


# --- writing -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Payloads of ``min_bytes`` or more are stored once; a file is closed beyond ``file_bytes``."""

    min_bytes: int = 0
    file_bytes: int = 256 << 20
    level: int = 6


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """``page_id, url, payload, first, revisit`` of every row: ``first`` is the smallest id with its payload.

    Smallest ids are found before rows are sent, and only payloads that several
    rows have are joined with, so a hot payload is one row of the other side;
    adaptive joins split its rows.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= min_bytes)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = firsts.where("n > 1").select(F.col("digest").alias("d"), "first")
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(shared, (F.col("digest") == F.col("d")) & (F.octet_length("payload") >= min_bytes), "left")
    return joined.select("page_id", "url", "payload", "first", revisit.alias("revisit"))


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", layout: Layout = Layout()
) -> str:
    """Write a record for each row into files under ``folder``; returns the path of their manifest.

    Of rows with equal payloads of ``min_bytes`` or more that with the smallest
    id is a response (all of them, if several have that id; null counts as
    largest), and the others are revisits of it.  Null html is an empty
    payload, and a null url or id leaves its field out.  A task that is run
    again writes files of other names, and only accepted ones are in the
    manifest.  No rows give an empty manifest.
    """
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = with_revisits(pages, id_col, url_col, html_col, layout.min_bytes)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, path, n, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            cells = [pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())]
            return pa.RecordBatch.from_arrays(cells, ["path", "n_records", "bytes"])

        for batch in batches:
            for some in pieces(batch, 256):
                for page_id, url, html, first, revisit in zip(*(c.to_pylist() for c in some.columns)):
                    if out is None:
                        path, n, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(path, compression=None)
                    data = gzip_member(record(page_id, url, html.encode(), first, revisit, date), layout.level)
                    out.write(data)
                    n, size = n + 1, size + len(data)
                    if size > layout.file_bytes:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    manifest = new_path(pages.sparkSession, "warc-manifests")
    rows.mapInArrow(save, "path string, n_records long, bytes long").write.parquet(manifest)
    return manifest


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", layout: Layout = Layout()) -> DataFrame:
    """Write all pages and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Payloads of responses are decoded and held against their digests.
    """
    spark = pages.sparkSession
    manifest = write_warc(pages, new_path(spark, "warc"), id_col, url_col, html_col, layout)
    records = read_warc(spark, manifest=manifest)
    length = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes"))
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        F.element_at("headers", PAGE.lower()).cast("long").alias("page_id"), length.alias("payload_bytes"),
        "payload_digest", "record_type", F.element_at("headers", REFERS_PAGE.lower()).cast("long").alias("refers_to"),
    )
