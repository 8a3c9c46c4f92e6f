"""WARC archives as a Spark source and sink, and payload dedup by revisit records.

Reading (``spark.read.format("warc")``): files are listed once and planned into
partitions of about ``partition_bytes``. A record's headers are parsed first. Filters on
header columns that Spark pushes down (``record_type``, ``record_id``, ``target_uri``,
``refers_to``, ``payload_digest``, ``content_length``) are decided on the headers alone,
and a block that is not wanted, because a filter fails or no block column was asked for,
is skipped without inflating it wherever the archive allows: plain files by their
content length, gzipped ones by the member length that this writer notes in the gzip
header (subfield ``sl``). Other gzipped files are inflated past, not kept.

Writing (``frame.write.format("warc")``): each task rolls files of about
``file_bytes`` with one gzip member a record. Files count once they stand in the manifest
that the driver writes at the commit, one a commit in ``_warc_manifests``, so a repeated
task leaves nothing behind that is read, and a second append adds to the first. A commit
that is repeated writes the same manifest again. Overwriting puts its manifest in place
first, and then removes the others and their files. An aborted write removes what it
wrote. Folders without a manifest, from other writers, are read whole.

Paths are opened by pyarrow, so local folders, hdfs and s3 work; a store that only
Spark's own readers reach does not.

Defined cases. Null payload: written empty. Null uri: no target header. Line ends in a
header value are percent-encoded. A record cut off at the end of a file raises an error.
Repeated rows are records of their own. Payloads are written and read whole, of any length
that fits a row. Ids are written as text; ``archive_roundtrip`` gives them back as whole
numbers, and ids that are none (text, fractions, null) as null. Only the named columns of
the input are used, so others cannot clash. An empty table leaves a manifest without files,
which reads as no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from lakebook.llm.shared import lookup, stored
from lakebook.session import activate, shared_folder

RESPONSE, REVISIT = "response", "revisit"
MIN_SHARED_BYTES = 100
#: A manifest a commit, and the longest member that the gzip header can tell.
MANIFESTS = "_warc_manifests"
LONGEST_NOTED = 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_HEADER = "WARC-X-Payload-Length"
HEADER_COLUMNS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in HEADER_COLUMNS]
    + [
        T.StructField("content_length", T.LongType()),
        T.StructField("payload_length", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)
READ_BYTES = 1 << 16


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        uri = path.replace("s3a://", "s3://", 1)
        return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


# Records ---------------------------------------------------------------------


def _header_value(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if ("\r" in value or "\n" in value) else value


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {_header_value(v)}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int) -> bytes:
    """One gzip member whose extra field tells its own length and the record's.

    Lengths that do not fit are 0, which stands for unknown: readers then inflate past it.
    """
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, *(n if n <= LONGEST_NOTED else 0 for n in (total, len(record))))
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    found: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            found[last] = value.strip()
    return found


class _Plain:
    """Bytes of an uncompressed archive; skipping seeks."""

    def __init__(self, file) -> None:
        self.file, self.held = file, b""

    def offset(self) -> int:
        return self.file.tell() - len(self.held)

    def start(self) -> bool:
        while True:
            if not self.held:
                self.held = self.file.read(READ_BYTES)
                if not self.held:
                    return False
            self.held = self.held.lstrip(b"\r\n")
            if self.held:
                return True

    def more(self) -> bool:
        data = self.file.read(READ_BYTES)
        self.held += data
        return bool(data)

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out, self.held = self.held[:n], self.held[n:]
        return out

    def skip(self, n: int) -> None:
        if n > len(self.held):
            self.file.seek(n - len(self.held), 1)
            self.held = b""
        else:
            self.held = self.held[n:]

    def finish(self) -> None:
        pass


class _Gzipped:
    """Bytes of one gzip member after the other; an unread rest is skipped."""

    def __init__(self, file) -> None:
        self.file, self.raw, self.held, self.packed = file, b"", b"", None
        self.begin, self.length = 0, None

    def offset(self) -> int:
        return self.begin

    def start(self) -> bool:
        self.begin = self.file.tell() - len(self.raw)
        while len(self.raw) < 24:
            data = self.file.read(READ_BYTES)
            if not data:
                break
            self.raw += data
        if not self.raw:
            return False
        if self.raw[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at {self.begin}")
        self.length = None
        if self.raw[3] & 4 and self.raw[12:14] == b"sl":
            self.length = struct.unpack("<I", self.raw[16:20])[0]
        self.packed, self.held = zlib.decompressobj(16 + zlib.MAX_WBITS), b""
        return True

    def more(self) -> bool:
        while not self.packed.eof:
            if not self.raw:
                self.raw = self.file.read(READ_BYTES)
                if not self.raw:
                    return False
            out = self.packed.decompress(self.raw, READ_BYTES)
            self.raw = self.packed.unused_data if self.packed.eof else self.packed.unconsumed_tail
            if out:
                self.held += out
                return True
        return False

    def take(self, n: int) -> bytes:
        parts, size = [self.held], len(self.held)
        while size < n:
            self.held = b""
            if not self.more():
                break
            parts.append(self.held)
            size += len(self.held)
        whole = b"".join(parts)
        self.held = whole[n:]
        return whole[:n]

    def skip(self, n: int) -> None:
        """Left to ``finish``, which knows where the next member starts."""

    def finish(self) -> None:
        if not self.packed.eof and self.length:
            ahead = self.begin + self.length - (self.file.tell() - len(self.raw))
            if ahead > len(self.raw):
                self.file.seek(ahead - len(self.raw), 1)
                self.raw = b""
            else:
                self.raw = self.raw[ahead:]
            return
        while self.more():
            self.held = b""


def records(file, wants: Callable[[dict], bool], with_block: bool) -> Iterator[tuple[int, dict, bytes | None]]:
    """(offset, headers, block) of the wanted records; the block only if asked for."""
    magic = file.read(2)
    file.seek(0)
    source = _Gzipped(file) if magic == b"\x1f\x8b" else _Plain(file)
    while source.start():
        offset = source.offset()
        end = source.held.find(b"\r\n\r\n")
        while end < 0:
            if not source.more():
                raise ValueError(f"record at {offset} is cut off in its headers")
            end = source.held.find(b"\r\n\r\n")
        headers = _parse_headers(source.take(end + 4)[:-4])
        length = int(headers.get("content-length", 0))
        wanted = wants(headers)
        block = None
        if wanted and with_block:
            block = source.take(length)
            if len(block) < length:
                raise ValueError(f"record at {offset} is cut off: {len(block)} of {length} bytes")
        else:
            source.skip(length)
        source.finish()
        if wanted:
            yield offset, headers, block


# Source ----------------------------------------------------------------------


def _column(headers: dict, name: str):
    if name == "content_length":
        return int(headers.get("content-length", 0))
    if name == "payload_length":
        value = headers.get(LENGTH_HEADER.lower())
        return int(value) if value is not None else None
    return headers.get(HEADER_COLUMNS[name].lower())


def _passes(held: Filter, headers: dict) -> bool:
    value = _column(headers, held.attribute[0])
    if isinstance(held, IsNull):
        return value is None
    if isinstance(held, IsNotNull):
        return value is not None
    if isinstance(held, EqualNullSafe):
        return value == held.value
    if value is None:
        return False
    if isinstance(held, EqualTo):
        return value == held.value
    if isinstance(held, In):
        return value in held.value
    if isinstance(held, StringStartsWith):
        return value.startswith(held.value)
    if isinstance(held, GreaterThan):
        return value > held.value
    if isinstance(held, GreaterThanOrEqual):
        return value >= held.value
    if isinstance(held, LessThan):
        return value < held.value
    return value <= held.value


_PUSHED = (
    EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith,
    GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual,
)


def _manifests(system: pafs.FileSystem, root: str) -> dict[str, list]:
    """By path, the files of each commit."""
    folder = pafs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True)
    found = {}
    for info in system.get_file_info(folder):
        if info.base_name.endswith(".json"):
            with system.open_input_stream(info.path) as stream:
                found[info.path] = json.loads(stream.read())
    return found


@dataclass
class WarcFiles(InputPartition):
    files: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.path = options["path"]
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.schema = schema
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        known = {*HEADER_COLUMNS, "content_length"}
        for held in filters:
            if isinstance(held, _PUSHED) and len(held.attribute) == 1 and held.attribute[0] in known:
                self.filters.append(held)
            else:
                yield held

    def _files(self) -> list[tuple[str, int]]:
        system, root = filesystem(self.path)
        committed = _manifests(system, root)
        if committed:
            return sorted((f"{root}/{name}", size) for files in committed.values() for name, size in files)
        info = system.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [(root, info.size)]
        return sorted(
            (f.path, f.size)
            for f in system.get_file_info(pafs.FileSelector(root, recursive=True))
            if f.type == pafs.FileType.File and f.base_name.endswith((".warc", ".warc.gz"))
        )

    def partitions(self) -> Sequence[InputPartition]:
        parts, names, size = [], [], 0
        for name, n in self._files():
            if names and size + n > self.partition_bytes:
                parts.append(WarcFiles(tuple(names)))
                names, size = [], 0
            names.append(name)
            size += n
        return [*parts, WarcFiles(tuple(names))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(self.path)
        names = self.schema.fieldNames()
        with_block = "payload" in names
        kinds = pa.schema(
            [
                (f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.string())
                for f in self.schema.fields
            ]
        )
        wants = lambda headers: all(_passes(held, headers) for held in self.filters)
        rows: list[tuple] = []
        held = 0
        for name in partition.files:
            with system.open_input_file(name) as file:
                for offset, headers, block in records(file, wants, with_block):
                    values = {"file": name, "offset": offset}
                    if block is not None:
                        payload = _payload(headers, block)
                        values["payload"] = payload
                        values["payload_length"] = len(payload)
                    stated = _column(headers, "payload_length")
                    if stated is not None:
                        values["payload_length"] = stated
                    rows.append(tuple(values[n] if n in values else (None if n == "payload" else _column(headers, n)) for n in names))
                    held += len(block or b"")
                    if held > (8 << 20) or len(rows) >= 10_000:
                        yield _batch(rows, kinds)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, kinds)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=kind.type) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
        schema=kinds,
    )


def _payload(headers: dict, block: bytes) -> bytes:
    """The block without the HTTP head that it starts with, if it has one."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# Sink ------------------------------------------------------------------------


@dataclass
class WarcWritten(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


class WarcWriter(DataSourceArrowWriter):
    """Columns: record_id, record_type, target_uri, payload_digest, refers_to,
    payload_length, payload. A revisit carries its headers only."""

    def __init__(self, options: dict, overwrite: bool = False) -> None:
        self.path, self.overwrite = options["path"], overwrite
        #: Names this write in its manifest and in the names of its files.
        self.name = uuid.uuid4().hex
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.level = int(options.get("level", 1))
        self.file_bytes = int(options.get("file_bytes", 128 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WarcWritten:
        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        stream, name, size = None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if stream is None:
                    name, size = f"part-{self.name}-{uuid.uuid4().hex}.warc.gz", 0
                    stream = system.open_output_stream(f"{root}/{name}", compression=None)
                size += stream.write(gzip_member(self._record(row), self.level)) or 0
                size = stream.tell()
                if size >= self.file_bytes:
                    stream.close()
                    done.append((name, size))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((name, size))
        return WarcWritten(tuple(done))

    def _record(self, row: dict) -> bytes:
        revisit = row["record_type"] == REVISIT
        payload = row["payload"] or b""
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        headers = {
            "WARC-Type": row["record_type"],
            "WARC-Record-ID": row["record_id"],
            "WARC-Date": self.date,
            "WARC-Target-URI": row["target_uri"],
            "WARC-Payload-Digest": row["payload_digest"],
            LENGTH_HEADER: str(row["payload_length"]),
            "WARC-Refers-To": row["refers_to"],
            "WARC-Profile": PROFILE if revisit else None,
            "Content-Type": f"application/http; msgtype={RESPONSE}",
        }
        return record_bytes(headers, http if revisit else http + payload)

    def commit(self, messages: list[WarcWritten | None]) -> None:
        system, root = filesystem(self.path)
        files = sorted(f for m in messages if m for f in m.files)
        older = _manifests(system, root) if self.overwrite else {}
        system.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        own = f"{root}/{MANIFESTS}/{self.name}.json"
        with system.open_output_stream(f"{own}.new", compression=None) as stream:
            stream.write(json.dumps(files).encode())
        system.move(f"{own}.new", own)
        older.pop(own, None)
        for manifest in older:
            system.delete_file(manifest)
        for names in older.values():
            for name, _ in names:
                system.delete_file(f"{root}/{name}")
        self._remove_but({name for name, _ in files})

    def abort(self, messages: list[WarcWritten | None]) -> None:
        """Without a manifest, what was written is never read; it is removed."""
        self._remove_but(set())

    def _remove_but(self, kept: set[str]) -> None:
        """Remove files of this write that no task has reported."""
        system, root = filesystem(self.path)
        for info in system.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith(f"part-{self.name}-") and info.base_name not in kept:
                system.delete_file(info.path)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark push filters down to Python sources."""
    activate(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# Operator --------------------------------------------------------------------


def with_revisits(
    pages: DataFrame, id_col: str = "page_id", payload: str = "html", url: str = "url",
    min_bytes: int = MIN_SHARED_BYTES,
) -> DataFrame:
    """Records to write, one a page: of equal payloads of ``min_bytes`` or more, the
    smallest id is the response and the others revisit it.

    Only digests are grouped, summed per task first. The groups of two and more are
    broadcast if they are few; otherwise payloads shuffle by digest in a join whose hot
    keys Spark splits. Null ids are larger than others; a group of null ids, and rows
    that share the smallest id, are responses.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    digests = pages.select(
        F.sha2(body, 256).alias("digest"), F.length(body).alias("n"), F.col(id_col).alias("id")
    ).where(F.col("n") >= min_bytes)
    groups = digests.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    shared = lookup(stored(groups.where("n > 1").select("digest", "first_id"), "revisits"))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url).alias("target_uri"), body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    ).join(shared, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return rows.select(
        _urn(F.col("id")).alias("record_id"),
        F.when(revisit, REVISIT).otherwise(RESPONSE).alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.when(revisit, _urn(F.col("first_id"))).alias("refers_to"),
        F.length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _urn(column):
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("null")), F.lit(">"))


def _unurn(name: str):
    return F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")


def archive_roundtrip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as an archive and report each record as read back from it.

    Responses are read with their payload, which is measured and hashed anew. Revisits
    are a second read that the pushed filter answers from headers alone.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or shared_folder(spark, "warc")
    with_revisits(pages).write.format("warc").mode("append").save(path)
    source = spark.read.format("warc")
    heads = T.StructType([f for f in SCHEMA.fields if f.name in ("record_id", "record_type", "refers_to", "payload_digest", "payload_length")])
    whole = T.StructType([f for f in SCHEMA.fields if f.name in ("record_id", "record_type", "payload")])
    responses = source.schema(whole).load(path).where(F.col("record_type") == RESPONSE).select(
        _unurn("record_id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = source.schema(heads).load(path).where(F.col("record_type") == REVISIT).select(
        _unurn("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type",
        _unurn("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)
