"""WARC archives as a Spark data source: write with deduplicated payloads, read with pushdown.

Every record is its own gzip member whose header says how long the member is, so a reader decodes
the first bytes of a record, looks at its headers, and jumps over it when a pushed-down predicate
on record type or headers says no or when payloads are not asked for. Files reach a bounded size,
and each is one partition. Paths go through Arrow's file systems (local, HDFS, object stores).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from unitledger.llm.common import prepare, written
from unitledger.operators.skew import keyed_join
from unitledger.session import shared_dir

#: A file is closed once it has so many bytes.
FILE_BYTES = 64 << 20
#: Payload bytes handed to Spark at a time.
BATCH_BYTES = 8 << 20
#: Payloads from this length on are stored once.
REVISIT_FROM = 100
MANIFEST = "_manifest.json"
_HEAD = 2048
_END = b"\r\n\r\n"

# Columns and the record headers they stand for.
HEADERS = {
    "type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
SCHEMA = "type string, record_id string, uri string, refers_to string, digest string, payload_length long, headers map<string,string>, payload binary"
_ARROW = pa.schema(
    [(c, pa.string()) for c in ("type", "record_id", "uri", "refers_to", "digest")]
    + [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(values: dict, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record; `values` has the columns of the source, without `headers`."""
    lines = ["WARC/1.1"]
    lines += [f"{HEADERS[c]}: {_clean(str(values[c]))}" for c in HEADERS if values[c] is not None]
    lines.append(f"WARC-Date: {date}")
    if values["type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        body = b"HTTP/1.1 200 OK" + _END
    else:
        payload = values["payload"] or b""
        body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + _END + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + _END + body + _END


def member(data: bytes) -> bytes:
    """A gzip member with the lengths of itself and of its content in an `sl` field."""
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    size = 24 + len(packed) + 8
    if max(size, len(data)) >= 1 << 32:
        size = 0
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<HccHII", 12, b"s", b"l", 8, size, len(data) if size else 0)
    return head + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_headers(raw: bytes) -> dict[str, str]:
    """Header lines below the version line, by name; the first of equal names counts."""
    out: dict[str, str] = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out.setdefault(name.strip(), value.strip())
    return out


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers; the whole of a block that has none."""
    if block.startswith(b"HTTP/"):
        return block.partition(_END)[2]
    return block


def _fs(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


def read_records(file, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and payload of the records of a file for which `wanted(headers)` holds.

    Members with a length are skipped unread; others, and plain records, are read through.
    """
    at, size = 0, file.size()
    while at < size:
        file.seek(at)
        start = file.read(_HEAD)
        if start[:2] == b"\x1f\x8b":
            if len(start) >= 24 and start[3] & 4 and start[12:14] == b"sl":
                length = struct.unpack_from("<I", start, 16)[0]
            else:
                length = 0
            unpack = zlib.decompressobj(31)
            text = unpack.decompress(start if not length else start[:length])
            read = min(len(start), length or len(start))

            def more() -> bytes:
                nonlocal read
                if unpack.eof:
                    return b""
                file.seek(at + read)
                chunk = file.read(min(1 << 20, length - read) if length else 1 << 20)
                read += len(chunk)
                return unpack.decompress(chunk) if chunk else b""

            while _END not in text and (chunk := more()):
                text += chunk
            raw, _, rest = text.partition(_END)
            headers = parse_headers(raw)
            keep = wanted(headers)
            if keep and payloads or not length:
                parts = [rest]
                while not unpack.eof and (chunk := more()):
                    parts.append(chunk)
                rest = b"".join(parts)
            at += length or read - len(unpack.unused_data)
            if keep:
                block = rest[: int(headers.get("Content-Length", 0))]
                yield headers, payload_of(block) if payloads else None
        else:
            while _END not in start and len(start) < size - at:
                start += file.read(_HEAD) or b""
            raw, found, _ = start.partition(_END)
            if not found:
                return
            headers = parse_headers(raw)
            length = int(headers.get("Content-Length", 0))
            keep = wanted(headers)
            if keep:
                file.seek(at + len(raw) + 4)
                yield headers, payload_of(file.read(length)) if payloads else None
            at += len(raw) + 4 + length + 4


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payloads", "true").lower() != "false"
        self.tests: list[tuple[str, tuple]] = []

    def pushFilters(self, filters):
        """Takes over equality, membership and presence of record headers; leaves the rest to Spark."""
        for f in filters:
            name = None
            if f.attribute[0] in HEADERS and f.attribute[0] != "payload_length" and len(f.attribute) == 1:
                name = HEADERS[f.attribute[0]]
            elif len(f.attribute) == 2 and f.attribute[0] == "headers":
                name = f.attribute[1]
            if name and isinstance(f, EqualTo | EqualNullSafe) and f.value is not None:
                self.tests.append((name, (f.value,)))
            elif name and isinstance(f, In):
                self.tests.append((name, tuple(f.value)))
            elif name and isinstance(f, IsNotNull):
                self.tests.append((name, ()))
            else:
                yield f

    def partitions(self):
        fs, path = _fs(self.path)
        info = fs.get_file_info(path)
        if info.type == pa.fs.FileType.File:
            return [WarcFile(self.path)]
        listed = fs.get_file_info(f"{path}/{MANIFEST}")
        if listed.type == pa.fs.FileType.File:
            with fs.open_input_stream(listed.path) as file:
                names = json.loads(file.read())
        else:
            found = fs.get_file_info(pa.fs.FileSelector(path))
            names = sorted(f.base_name for f in found if ".warc" in f.base_name)
        return [WarcFile(f"{self.path}/{n}") for n in names]

    def _wanted(self, headers: dict[str, str]) -> bool:
        return all(name in headers and (not values or headers[name] in values) for name, values in self.tests)

    def read(self, partition):
        if partition is None:  # what Spark passes where there is no file
            return
        fs, path = _fs(partition.path)
        rows: list[tuple] = []
        held = 0
        with fs.open_input_file(path) as file:
            for headers, payload in read_records(file, self._wanted, self.payloads):
                length = headers.get(HEADERS["payload_length"])
                own = [headers.get(HEADERS[c]) for c in ("type", "record_id", "uri", "refers_to", "digest")]
                rows.append((*own, int(length) if length else None, list(headers.items()), payload))
                held += 500 + len(payload or b"")
                if held >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator):
        fs, path = _fs(self.path)
        fs.create_dir(path)
        names: list[str] = []
        file, size = None, 0
        for batch in iterator:
            for values in batch.to_pylist():
                if file is None or size >= self.file_bytes:
                    if file is not None:
                        file.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    file, size = fs.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                data = member(record(values))
                file.write(data)
                size += len(data)
        if file is not None:
            file.close()
        return Written(names)

    def commit(self, messages):
        """Readers see the files of finished tasks only, whatever failed attempts have left."""
        fs, path = _fs(self.path)
        fs.create_dir(path)
        names = sorted(n for m in messages if m is not None for n in m.names)
        listed = fs.get_file_info(f"{path}/{MANIFEST}")
        if not self.overwrite and listed.type == pa.fs.FileType.File:
            with fs.open_input_stream(listed.path) as file:
                names = json.loads(file.read()) + names
        with fs.open_output_stream(f"{path}/{MANIFEST}") as file:
            file.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, path = _fs(self.path)
        for name in (n for m in messages if m is not None for n in m.names):
            fs.delete_file(f"{path}/{name}")


class WarcSource(DataSource):
    """`spark.read.format("warc")`, with the option `payloads` (false: headers only)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict:
        return {name.lower(): value for name, value in self.options.items()}

    def reader(self, schema) -> WarcReader:
        return WarcReader(self._options())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self._options(), overwrite)


def register(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A record per page. Of equal payloads of `REVISIT_FROM` bytes or more, the one with the smallest
    id is a response and the others revisit it; rows that repeat that id are responses too. Null
    html is an empty payload; a null id is never the smallest; a null url gives no URI."""
    rows = pages.select(
        F.col(id_col).cast("string").alias("record_id"),
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("uri"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    firsts = written(
        rows.filter(F.col("payload_length") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("n"))
        .filter("n > 1 and _first is not null")
        .select("digest", "_first")
    )
    again = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    return keyed_join(rows, firsts, ["digest"], "left").select(
        F.when(again, "revisit").otherwise("response").alias("type"),
        "record_id",
        "uri",
        F.when(again, F.col("_first").cast("string")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("digest"),
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the pages as archives into the shared folder and reads them back.

    Lengths and digests of responses are made anew from the payloads read; those of revisits stand
    in their headers, and their (empty) blocks are not decoded.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/archives/{uuid.uuid4().hex}"
    write_archives(page_records(pages, id_col, url_col, html_col), path)
    kind = pages.schema[id_col].dataType
    columns = lambda length, digest: [
        F.col("record_id").cast(kind).alias(id_col),
        length.cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    ]
    responses = read_archives(spark, path).filter("type = 'response'")
    revisits = read_archives(spark, path, payloads=False).filter("type = 'revisit'")
    return responses.select(*columns(F.octet_length("payload"), F.sha2("payload", 256))).unionByName(
        revisits.select(*columns(F.col("payload_length"), F.substring_index("digest", ":", -1)))
    )
