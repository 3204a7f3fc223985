"""WARC: a Python data source that reads and writes web archives.

Reading plans a partition for each group of files, takes predicates on record type and other
headers, parses the header of a record first, and neither decompresses nor reads the rest of
a record that the predicates or the option ``payload = false`` make unneeded.  That works for
plain files (by Content-Length) and for files compressed record by record whose gzip members
carry the skip lengths of the WARC standard's annex (extra field ``sl``); other gzip members
are read through.  Writing compresses record by record, with skip lengths, starts a new file
after ``roll_bytes``, names files by task attempt, and lists the files of a finished job in
one commit file; a reader that finds commit files reads just what they list, so a lost or
repeated task leaves no double record.

Paths may be of any file system that pyarrow opens.

Edge cases: a null payload is empty; a null page id or URL leaves its header out and reads
back as null; repeated rows give a record each; an empty table gives an archive without
records; a truncated file gives its whole records; columns that the writer does not know are
an error, and ``deduplicated`` uses just its three.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

from ebbtide.llm.common import if_small, shared_folder, table, text_of, written

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, content_type string, payload_digest string, "
    "payload_length long, page_id long, refers_to string, refers_to_page long, payload binary, file string, offset long"
)
# Header names of the format, by column; the last three are extension headers.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "payload_length": "X-Payload-Length", "page_id": "X-Page-Id", "refers_to_page": "X-Refers-To-Page-Id",
}
LONGS = {"payload_length", "page_id", "refers_to_page"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
BATCH_BYTES = 8 << 20


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


class _Window:
    """Random access to a file through one buffer, so that short skips cost no read."""

    def __init__(self, handle: pa.NativeFile) -> None:
        self.handle, self.size, self.at, self.data = handle, handle.size(), 0, b""

    def fetch(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.data)):
            self.handle.seek(at)
            self.at, self.data = at, self.handle.read(max(n, CHUNK))
        return self.data[at - self.at : at - self.at + n]


def _skip_lengths(head: bytes) -> tuple[int, int] | None:
    """(compressed, uncompressed) length of a gzip member from its extra field."""
    if len(head) < 12 or not head[3] & 4:
        return None
    end = 12 + struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(end, len(head)):
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"sl" and n == 8:
            return struct.unpack_from("<II", head, at + 4)
        at += 4 + n
    return None


def gzip_member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member with its skip lengths."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    extra = lambda n: b"sl" + struct.pack("<HII", 8, n, len(raw))
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", 12)
    total = len(head) + 12 + len(body) + 8
    return head + extra(total) + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    found: dict[str, str] = {"": lines[0]}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


@dataclass
class _Record:
    headers: dict[str, str]
    offset: int
    body: bytes | None


def records(window: _Window, wanted, with_body) -> Iterator[_Record]:  # noqa: ANN001
    """The records of a file for which wanted(headers) holds; the body only if with_body(headers)."""
    at = 0
    while at < window.size:
        first = window.fetch(at, 2)
        if first == b"\x1f\x8b":
            lengths = _skip_lengths(window.fetch(at, min(4096, window.size - at)))
            known = lengths[0] if lengths else None
            unpack, got, read_to = zlib.decompressobj(31), b"", at
            while b"\r\n\r\n" not in got and not unpack.eof and read_to < window.size:
                if unpack.unconsumed_tail:
                    got += unpack.decompress(unpack.unconsumed_tail, 4096)
                    continue
                piece = window.fetch(read_to, min(2048, window.size - read_to))
                read_to += len(piece)
                got += unpack.decompress(piece, 4096)
            head, found, rest = got.partition(b"\r\n\r\n")
            if not found:
                return
            headers = _parsed(head)
            length = int(headers.get("content-length", 0))
            want = wanted(headers)
            body = want and with_body(headers)
            if known and not body:
                after = at + known
            else:
                parts, have = [rest], len(rest)
                while not unpack.eof and (unpack.unconsumed_tail or read_to < window.size):
                    if unpack.unconsumed_tail:
                        piece = unpack.unconsumed_tail
                    else:
                        n = known - (read_to - at) if known else CHUNK // 16
                        piece = window.fetch(read_to, max(1, min(n, window.size - read_to)))
                        read_to += len(piece)
                    out = unpack.decompress(piece, CHUNK)
                    if have < length and body:
                        parts.append(out)
                    have += len(out)
                if not unpack.eof:
                    return
                after = read_to - len(unpack.unused_data)
                rest = b"".join(parts)
            if want:
                yield _Record(headers, at, rest[:length] if body else None)
            at = after
        else:
            n = 2048
            got = window.fetch(at, min(n, window.size - at))
            while b"\r\n\r\n" not in got and n < window.size - at:
                n *= 2
                got = window.fetch(at, min(n, window.size - at))
            head, found, _ = got.partition(b"\r\n\r\n")
            if not found or not head.startswith(b"WARC/"):
                return
            headers = _parsed(head)
            length = int(headers.get("content-length", 0))
            begin = at + len(head) + 4
            if begin + length > window.size:
                return
            if wanted(headers):
                yield _Record(headers, at, window.fetch(begin, length) if with_body(headers) else None)
            at = begin + length + 4


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.group = int(options.get("partition_bytes", 32 << 20))
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo) and f.value is not None:
                self.tests.append((name, "in", (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append((name, "in", tuple(v for v in f.value if v is not None)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((name, "prefix", (f.value,)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        fs, root = _file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        done = [f for f in found if f.base_name.startswith("_committed-")]
        if done:
            listed: set[str] = set()
            for f in done:
                with fs.open_input_stream(f.path) as handle:
                    listed |= set(json.loads(handle.read()))
            found = [f for f in found if f.base_name in listed]
        groups: list[Files] = []
        size = self.group
        for f in sorted((f for f in found if f.base_name.endswith((".warc", ".warc.gz"))), key=lambda f: f.path):
            if size + f.size > self.group:
                groups.append(Files([]))
                size = 0
            groups[-1].paths.append(f.path)
            size += f.size
        return groups or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _file_system(self.path)
        fields = [x.split() for x in SCHEMA.split(", ")]
        types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, types[t]) for n, t in fields])

        def value(headers: dict[str, str], name: str):  # noqa: ANN202
            raw = headers.get(HEADERS[name].lower())
            if name == "payload_digest" and raw is not None:
                raw = raw.removeprefix("sha1:")
            return int(raw) if raw is not None and name in LONGS else raw

        def wanted(headers: dict[str, str]) -> bool:
            for name, kind, values in self.tests:
                v = value(headers, name)
                if v is None or (v not in values if kind == "in" else not str(v).startswith(values[0])):
                    return False
            return True

        rows: list[tuple] = []
        held = 0
        for path in partition.paths:
            with fs.open_input_file(path) as handle:
                for r in records(_Window(handle), wanted, lambda h: self.payload and h.get("warc-type") != "revisit"):
                    own = [value(r.headers, n) if n in HEADERS else None for n, _ in fields[:-3]]
                    rows.append((*own, r.body, path, r.offset))
                    held += len(r.body or b"") + 512
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


@dataclass
class Wrote(WriterCommitMessage):
    names: list[str]


def record_bytes(row: dict) -> bytes:
    """One record, uncompressed, from the columns that the writer knows."""
    payload = row.get("payload") or b""
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        v = row.get(column)
        if v is not None:
            v = f"sha1:{v}" if column == "payload_digest" else str(v)
            lines.append(f"{name}: " + v.replace("\r", "%0D").replace("\n", "%0A"))
    if row.get("record_type") == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, names: list[str]) -> None:
        unknown = set(names) - set(HEADERS) - {"payload"}
        if unknown:
            raise ValueError(f"columns that a record has no place for: {sorted(unknown)}")
        self.path = options["path"]
        self.roll = int(options.get("roll_bytes", 64 << 20))
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        names: list[str] = []
        handle, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if handle is None or size >= self.roll:
                        if handle is not None:
                            handle.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        handle, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    size += handle.write(gzip_member(record_bytes(row), self.level)) or 0
        finally:
            if handle is not None:
                handle.close()
        return Wrote(names)

    def commit(self, messages: list[Wrote | None]) -> None:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/_committed-{uuid.uuid4().hex}") as out:
            out.write(json.dumps([n for m in messages if m is not None for n in m.names]).encode())

    def abort(self, messages: list[Wrote | None]) -> None:
        fs, root = _file_system(self.path)
        for m in messages:
            for n in m.names if m is not None else ():
                fs.delete_file(f"{root}/{n}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:  # noqa: ANN001
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:  # noqa: ANN001
        return WarcWriter(dict(self.options), schema.fieldNames())


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits, 5 of them making 4 letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def letters(d: Column) -> Column:
        out = []
        for i in range(8):
            v = F.conv(F.substring(d, 5 * i + 1, 5), 16, 10).cast("int")
            out += [F.substring(alphabet, F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
        return F.concat(*out)

    # an array of one element binds the digest, so that it is computed once
    return F.element_at(F.transform(F.array(digest), letters), 1)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text or binary column."""
    return base32_of_hex(F.sha1(data))


def deduplicated(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records for the writer from (page_id, url, html): of pages with equal payloads of at
    least ``min_bytes`` that with the largest page_id is a response, the others revisit it.

    Digests decide alone; payloads stay where they are unless there are more revisits than
    fit a checked broadcast."""
    html = text_of("html")
    slim = pages.select("page_id", "url", F.sha1(html).alias("sha1"), base32_sha1(html).alias("payload_digest"), F.octet_length(html).cast("long").alias("payload_length"))
    kept = slim.where(F.col("payload_length") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("refers_to_page"), F.count(F.lit(1)).alias("_n"))
    kept = kept.where("_n > 1").drop("_n")
    revisits = written(slim.join(kept, "sha1").where(F.col("page_id") < F.col("refers_to_page")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    gone = revisits.select("page_id", "sha1").distinct()
    responses = pages.withColumn("sha1", F.sha1(html)).join(if_small(gone), ["page_id", "sha1"], "left_anti")
    responses = responses.select(
        F.lit("response").alias("record_type"), urn("page_id").alias("record_id"), F.col("url").alias("target_uri"), base32_sha1(html).alias("payload_digest"),
        F.octet_length(html).cast("long").alias("payload_length"), "page_id", F.lit(None).cast("string").alias("refers_to"),
        F.lit(None).cast("long").alias("refers_to_page"), F.encode(html, "UTF-8").alias("payload"),
    )
    again = revisits.select(
        F.lit("revisit").alias("record_type"), urn("page_id").alias("record_id"), F.col("url").alias("target_uri"), "payload_digest",
        "payload_length", "page_id", urn("refers_to_page").alias("refers_to"), "refers_to_page", F.lit(None).cast("binary").alias("payload"),
    )
    both = responses.unionByName(again)
    return both.withColumns({"date": F.lit("1970-01-01T00:00:00Z"), "content_type": F.lit("text/html; charset=utf-8")})


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    path = shared_folder(spark) + "-warc"
    deduplicated(table(spark, sf_dir, "pages").select("page_id", "url", "html")).write.format("warc").mode("append").save(path)
    read = spark.read.format("warc")
    responses = read.load(path).where(F.col("record_type") == "response").select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = read.option("payload", "false").load(path).where(F.col("record_type") == "revisit").select(
        "page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to")
    )
    return responses.unionByName(revisits)


QUERIES = {"op8_warc": op8_warc}
ORACLE_SQL: dict[str, str] = {}
