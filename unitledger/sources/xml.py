"""XML exports: numbered files per table, loose or inside one zip archive.

Both ways give records as `(stem, file_no, row_no, record)`, which `parse_records` turns into
text columns. Nothing is inferred: digits with leading zeros stay text. A loose file is cut into
byte ranges by Spark's text source, on any file system; a file inside a zip is one task.
"""

from __future__ import annotations

import glob
import os
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from unitledger.operators.skew import written
from unitledger.session import shared_dir
from unitledger.specs import stem_of_file

CHUNK = 1 << 20
ORDER = ["file_no", "row_no"]

#: A record is handed on whole up to what a row can hold (2 GB); only a longer one comes in pieces.
LONGEST_RECORD = 1 << 29

# A text value that XML forbids: control characters, `&` that starts no entity, or `<` that
# starts no tag.
BAD_TEXT = (
    r"(?<=>)[^<>]*(?:[\x00-\x08\x0B\x0C\x0E-\x1F]|&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"
    r"|<(?![A-Za-z_/!?]))(?:[^<]|<(?![A-Za-z_/!?]))*+(?=</)"
)
# What such a text holds; a record without it needs no repair.
BAD_CHARACTER = r"[\x00-\x08\x0B\x0C\x0E-\x1F]|&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)|<(?![A-Za-z_/!?])"
# An element whose text holds a `<` that ends nothing, also before a letter (`a <b`), and no end tag
# but its own. Only records that do not parse are searched for it.
STRAY_TEXT = r"<([A-Za-z_][\w.-]*)(?:\s[^<>]*+)?>[^<]*+(?:<(?!/)[^<]*+)++</\1\s*>"
_EMPTY_FILE = re.compile(r"(?:<\?[^>]*>\s*)?(?:<([\w.:-]+)[^<>]*/>|<([\w.:-]+)[^<>]*>\s*</\2\s*>)?", re.S)
_ROOT_END = re.compile(r"</[\w.:-]+\s*>")
_HEAD = re.compile(r"\ufeff?\s*(?:<\?[^>]*>\s*|<!--.*?-->\s*)*<[A-Za-z_][^<>]*(?<!/)>", re.S)
_MARKS = {"utf-16-le": b"\xff\xfe", "utf-16-be": b"\xfe\xff", "utf-8": b"\xef\xbb\xbf"}


def split_records(chunks: Iterator[str]) -> Iterator[str]:
    """Child elements of the root, one by one, from a text that arrives in chunks.

    Nothing is left out: what follows the last whole record, unless it is the end of the root, and
    a text without any record come as pieces of their own, which then fail to parse.
    """
    buffer, end, looked = "", None, 0
    for chunk in chunks:
        buffer += chunk
        if end is None:
            opening = re.search(r"<[A-Za-z_][^<>]*(?<!/)>\s*<([A-Za-z_][\w.-]*)(?=[\s/>])", buffer)
            if not opening:
                continue
            tag = re.escape(opening.group(1))
            end = re.compile(rf"<{tag}(?:\s[^<>]*)?/>|</{tag}\s*>")
            buffer = buffer[opening.start(1) - 1 :]
        start = 0
        while found := end.search(buffer, max(start, looked)):
            yield buffer[start : found.end()].strip()
            start, looked = found.end(), 0
        buffer = buffer[start:]
        if len(buffer) > LONGEST_RECORD:
            yield buffer
            buffer = ""
        # An end tag may be cut; its first character is the last `<`.
        looked = max(0, buffer.rfind("<"))
    rest = buffer.strip()
    if rest and not (_ROOT_END if end else _EMPTY_FILE).fullmatch(rest):
        yield rest


class FilesOfArchive(DataSource):
    """One partition per XML file, so a table's numbered files are read side by side.

    Options: `path` (a zip, or a folder of XML files, on storage all executors mount), `stems`
    (comma separated table stems; only their files are opened) and `encoding`.
    """

    @classmethod
    def name(cls) -> str:
        return "registry_xml"

    def schema(self) -> T.StructType:
        return RECORDS

    def reader(self, schema: T.StructType) -> "FilesOfArchiveReader":
        return FilesOfArchiveReader(dict(self.options))


class FilePartition(InputPartition):
    def __init__(self, member: str, stem: str, number: int):
        self.member, self.stem, self.number = member, stem, number


class FilesOfArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.encoding = options.get("encoding", "utf-16")
        self.stems = [s for s in options.get("stems", "").split(",") if s]

    def partitions(self) -> Sequence[InputPartition]:
        if zipfile.is_zipfile(self.path):
            with zipfile.ZipFile(self.path) as archive:
                names = archive.namelist()
        else:
            names = sorted(glob.glob(os.path.join(self.path, "*.xml")))
        parts = []
        for name in names:
            stem, number = stem_of_file(name)
            if name.lower().endswith(".xml") and (not self.stems or stem in self.stems):
                parts.append(FilePartition(name, stem, number))
        return parts

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        import codecs

        def chunks(handle):
            decoder = codecs.getincrementaldecoder(self.encoding)()
            while block := handle.read(CHUNK):
                yield decoder.decode(block)
            yield decoder.decode(b"", final=True)

        def rows(handle):
            for row_no, record in enumerate(split_records(chunks(handle))):
                yield partition.stem, partition.number, row_no, record

        if zipfile.is_zipfile(self.path):
            with zipfile.ZipFile(self.path) as archive, archive.open(partition.member) as handle:
                yield from rows(handle)
        else:
            with open(partition.member, "rb") as handle:
                yield from rows(handle)


RECORDS = T.StructType(
    [
        T.StructField("stem", T.StringType()),
        T.StructField("file_no", T.IntegerType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("record", T.StringType()),
    ]
)


def _files_by_stem(spark: SparkSession, path: str, stems: Sequence[str]) -> dict[str, list[str]]:
    """The XML files of a folder on any file system, by table stem."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files: dict[str, list[str]] = {}
    for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
        stem, _ = stem_of_file(status.getPath().getName())
        if status.isFile() and status.getPath().getName().lower().endswith(".xml") and (not stems or stem in stems):
            files.setdefault(stem, []).append(status.getPath().toString())
    return files


def record_start(spark: SparkSession, files: Sequence[str], encoding: str = "utf-16") -> tuple[str | None, str]:
    """(start tag of the records, encoding with its byte order), from the head of the largest file.

    The tag is None where the first record's start tag has attributes or there is no record.
    """
    pieces = [bytes(r[0]) for r in spark.read.text(list(files), lineSep="<").select(F.col("value").cast("binary")).take(64)]
    if encoding.lower().replace("_", "-") in ("utf-16", "utf16"):
        encoding = "utf-16-be" if pieces and pieces[0].startswith(_MARKS["utf-16-be"]) else "utf-16-le"
    # Markup is ASCII, so a piece without zero bytes reads the same in any of the encodings.
    plain = [p.replace(b"\0", b"").decode("latin-1") for p in pieces]
    tags = [p for p in plain if re.match("[A-Za-z_]", p)]
    found = re.match(r"([A-Za-z_][\w.-]*)\s*/?>", tags[1]) if len(tags) > 1 else None
    return (f"<{found.group(1)}>" if found else None), encoding


def _pieces(text: str, start: str, ends: re.Pattern, first: bool) -> Iterator[str]:
    """Records of what stands between two start tags, and what is left over if it is no end of the root."""
    if first:
        head = _HEAD.match(text)
        if not head:
            if not _EMPTY_FILE.fullmatch(text.strip("\ufeff \t\r\n")):
                yield text.strip()
            return
        text = text[head.end() :]
    else:
        text = start + text
    at = 0
    for end in ends.finditer(text):
        yield text[at : end.end()].strip()
        at = end.end()
    rest = text[at:].strip()
    if rest and not _ROOT_END.fullmatch(rest):
        yield rest


def _records_of_ranges(stem: str, start: str, encoding: str):
    def run(batches):
        import pyarrow as pa

        tag, block, index, number = re.escape(start[1:-1]), None, 0, 0
        ends = re.compile(rf"<{tag}(?:\s[^<>]*)?/>|</{tag}\s*>")
        for batch in batches:
            rows = []
            for path, begin, raw in zip(*(c.to_pylist() for c in batch.columns)):
                first = (path, begin) != block and begin == 0
                if (path, begin) != block:
                    block, index, number = (path, begin), 0, stem_of_file(path)[1]
                if first and any(raw.startswith(m) for e, m in _MARKS.items() if e != encoding):
                    raise ValueError(f"{path} has another encoding than {encoding}")
                for record in _pieces(raw.decode(encoding), start, ends, first):
                    rows.append((stem, number, begin + index, record))
                    index += 1
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=RECORDS.names)

    return run


def split_records_of(spark: SparkSession, stem: str, files: Sequence[str], start: str, encoding: str) -> DataFrame:
    """Records of loose files of one table, each file read in ranges of `spark.sql.files.maxPartitionBytes`.

    The start tag of the records is the text source's line separator, in the bytes of the encoding,
    so a range begins at the first record that starts in it and any file system will do. Only the
    first piece of a file is its head. A record with attributes or an empty one comes with the one
    before it and is cut off there. `row_no` is the place of the range plus a running number, which
    keeps the order of the file. A record that is cut off is a row of its own; the next one is whole.
    """
    java = {"utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE"}.get(encoding, encoding)
    ranges = spark.read.options(lineSep=start, encoding=java).text(list(files)).select(
        "_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value")
    )
    return ranges.mapInArrow(_records_of_ranges(stem, start, encoding), RECORDS)


def archive_records(spark: SparkSession, path: str, stems: Sequence[str] = (), encoding: str = "utf-16") -> DataFrame:
    """Records of the chosen tables, unpacked once into the shared folder, one sub-folder per
    table stem, so that loading a table reads that table only.

    A folder may lie on any file system, and its files are read in byte ranges; only tables whose
    records have attributes are read file by file, and so is a zip, both from a mounted path.
    """
    spark.dataSource.register(FilesOfArchive)
    parts, whole = {}, list(stems)
    local = path.removeprefix("file://").removeprefix("file:")
    if not zipfile.is_zipfile(local):
        files = _files_by_stem(spark, path, stems)
        starts = {stem: record_start(spark, names, encoding) for stem, names in files.items()}
        parts = {s: split_records_of(spark, s, files[s], start, e) for s, (start, e) in starts.items() if start}
        whole = [s for s, (start, _) in starts.items() if not start]
    staged = f"{shared_dir(spark)}/records/{uuid.uuid4().hex}"
    # A table known beforehand goes to its sub-folder as it comes; only several tables at once need the sort by table.
    for stem, part in parts.items():
        part.drop("stem").write.parquet(f"{staged}/stem={_folder_name(stem)}")
    if whole or not parts:
        reader = spark.read.format("registry_xml").option("path", local).option("encoding", encoding)
        reader.option("stems", ",".join(whole)).load().write.mode("append").partitionBy("stem").parquet(staged)
    return spark.read.schema(RECORDS).parquet(staged)


def _folder_name(stem: str) -> str:
    """A partition value as Spark spells it in a path."""
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", stem) or "__HIVE_DEFAULT_PARTITION__"


def folder_records(spark: SparkSession, path: str, stem: str, row_tag: str, columns: Sequence[str], encoding: str = "UTF-16") -> DataFrame:
    """Files of one table read by Spark's own XML source from any file system; parsed columns
    come with the file number and the row's place in its file for key enforcement."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    rows = (
        spark.read.format("xml")
        .options(rowTag=row_tag, encoding=encoding, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
        .schema(schema)
        .load(path)
    )
    number = F.regexp_extract(F.input_file_name(), r"_(\d+)\.[^/]*$", 1)
    file_no = F.coalesce(F.nullif(number, F.lit("")).cast("int"), F.lit(1))
    return rows.withColumns({"stem": F.lit(stem), "file_no": file_no, "row_no": F.monotonically_increasing_id()})


def record_columns(records: DataFrame) -> list[str]:
    """Names of elements that end inside the records; one distributed distinct over the lists of
    names, which most records share, and only the distinct lists are taken apart."""
    name = r"([A-Za-z_][A-Za-z0-9_.-]*+)"
    closed = F.regexp_extract_all("record", F.lit(rf"</{name}\s*>"), F.lit(1))
    empty = F.when(F.contains("record", F.lit("/>")), F.regexp_extract_all("record", F.lit(rf"<{name}(?:\s[^<>]*)?/>"), F.lit(1)))
    row_tag = F.regexp_extract("record", rf"^\s*<{name}", 1)
    lists = records.select(closed.alias("closed"), empty.alias("empty"), row_tag.alias("tag")).distinct()
    names = lists.select(F.explode(F.concat("closed", F.coalesce("empty", F.array().cast("array<string>")))).alias("name"), "tag").filter("name <> tag")
    return sorted(r["name"] for r in names.select("name").distinct().collect())


def parse_records(
    records: DataFrame, columns: Sequence[str] | None = None, seen: Observation | None = None, keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine). A text XML forbids is blanked, as is, in a record that does not parse, a
    text with a stray `<`; a record that is still broken goes to the quarantine whole, and so does
    one without a value in any of its key columns `keys`, each with the reason. With `seen` the parsed
    rows are written once, broken ones counted on the way, and both results are read from there."""
    columns = list(columns or record_columns(records))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    repaired = F.when(F.rlike("record", F.lit(BAD_CHARACTER)), F.regexp_replace("record", BAD_TEXT, "")).otherwise(F.col("record"))
    parsed = lambda text: F.from_xml(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    fails = lambda c: F.col(c).isNull() | F.col(f"{c}._corrupt").isNotNull()
    # Each parse is a generator's only row: the optimizer copies no expression out of one, so a record
    # is parsed once however many columns and filters use it.
    once = lambda df, name, value: df.select("*", F.explode(F.array(value)).alias(name))
    rows = once(records, "_first", parsed(repaired))
    again = parsed(F.regexp_replace(repaired, STRAY_TEXT, "<$1></$1>"))
    rows = once(rows, "_parsed", F.when(fails("_first"), again).otherwise(F.col("_first"))).drop("_first")
    broken = fails("_parsed")
    value = lambda c: F.nullif(F.col(f"_parsed.`{c}`"), F.lit(""))
    known = [value(c) for c in keys if c in columns]
    keyless = F.coalesce(*known).isNull() if known else F.lit(bool(keys))
    rows = rows.withColumn("reason", F.when(broken, "broken record").when(keyless, "no key"))
    if seen is not None:
        aside = F.when(F.col("reason").isNotNull(), F.col("record")).alias("record")
        rows = written(rows.select("stem", *ORDER, "_parsed", aside, "reason").observe(seen, F.count("reason").alias("broken")))
    good = rows.filter("reason is null").select("stem", *ORDER, *[value(c).alias(c) for c in columns])
    return good, rows.filter("reason is not null").select("stem", *ORDER, "record", "reason")
