"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing. A WARC record is a header, an empty line, a block and two line ends, so a text file
whose line separator is CRLF CRLF holds one record per row, in any file system Spark writes to,
with its commit protocol. Pages with equal payloads of at least ``min_bytes`` are stored once:
the row with the largest page_id is a ``response``, the others ``revisit`` it.

Reading. ``spark.read.format("warc").load(dir)`` plans one partition per stretch of the files.
Filters on the record type and other header fields are pushed down. A record's header is parsed
first; if a filter refuses it, or the schema does not ask for the payload, its block is skipped
by its length and never decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith,
)
from pyspark.sql.types import StructType

from hebdo.llm.common import forget_on_exit, ship_package, text_of, written
from hebdo.session import scratch_path, unique_suffix

MIN_REVISIT_BYTES = 1000
CRLF = "\r\n"
VERSION = "WARC/1.1"
#: Column -> header field (fixed names of the WARC format; X- is an extension field).
FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
    "payload_bytes": "X-Payload-Length", "content_type": "Content-Type",
}
SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, "
          "refers_to string, payload_bytes long, content_type string, payload binary")


def record_id(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))


def page_of(c: Column) -> Column:
    """The page_id inside a record id."""
    return F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")


def with_record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (text), payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload; null url leaves the field out. Where several rows hold the
    largest page_id of a payload, each is a response; a null page_id is below any other, and a
    payload that only null page_ids hold is never revisited.
    """
    held = pages.select("page_id", "url", text_of("html").alias("payload"),
                        F.octet_length(text_of("html")).cast("long").alias("payload_bytes"),
                        F.sha1(text_of("html").cast("binary")).alias("payload_digest"))
    # narrow rows, combined before the shuffle: one per payload that occurs again
    again = (held.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select(F.col("payload_digest").alias("digest"), "response_id"))
    again = written(again, "warc-again")
    revisits = (F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id")))
    return (held.join(again, held["payload_digest"] == again["digest"], "left")  # AQE splits a hot digest
            .select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                    F.when(revisits, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisits, F.col("response_id")).alias("refers_to")))


def record_text(content_type: str = "application/http; msgtype=response") -> Column:
    """The record of a row of ``with_record_types``, without the two line ends that close it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    # header values are single lines; control characters of a URL are percent-encoded
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), "\t", "%09")
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
             F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
             F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
             F.concat(F.lit("WARC-Target-URI: "), uri),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
             F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
             F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one archive file per task into the new folder ``path``."""
    (with_record_types(pages, min_bytes).select(record_text().alias("value"))
     .write.option("lineSep", CRLF + CRLF).text(path))


class _Stretch(InputPartition):
    """Records that begin in [start, end) of a file."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class WarcSource(DataSource):
    """Options: path (folder or file), stretch (bytes per partition, default 128 MB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options, schema)


_COMPARE = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b,
            GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b,
            LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b,
            StringStartsWith: lambda a, b: a.startswith(b)}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path = options["path"]
        self.stretch = int(options.get("stretch", 128 << 20))
        self.columns = [f.name for f in schema.fields]
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take those on header columns; return the rest to Spark."""
        for f in filters:
            known = getattr(f, "attribute", ("",))[0] in FIELDS and len(f.attribute) == 1
            if known and isinstance(f, (*_COMPARE, EqualNullSafe, IsNotNull)):
                self.filters.append(f)
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for f in self.filters:
            value = row[f.attribute[0]]
            if isinstance(f, EqualNullSafe):
                if value != f.value:
                    return False
            elif value is None or not isinstance(f, IsNotNull) and not _COMPARE[type(f)](value, f.value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        fs, root = _file_system(self.path)
        from pyarrow.fs import FileSelector, FileType
        info = fs.get_file_info(root)
        files = [info] if info.type == FileType.File else [
            f for f in fs.get_file_info(FileSelector(root)) if f.type == FileType.File
            and not f.base_name.startswith(("_", "."))]
        return [_Stretch(f.path, at, min(at + self.stretch, f.size)) for f in sorted(files, key=lambda f: f.path)
                for at in range(0, f.size, self.stretch)]

    def read(self, partition: _Stretch | None) -> Iterator[tuple]:
        if partition is None:  # no bytes to read
            return
        fs, _ = _file_system(self.path)
        with fs.open_input_file(partition.path) as f:
            at = _first_record(f, partition.start, partition.end)
            while at is not None and at < partition.end:
                header, block_at = _header(f, at)
                row = _row(header)
                length = int(header["content-length"])
                at = block_at + length + 4
                if not self.wanted(row):
                    continue
                if "payload" in self.columns:
                    row["payload"] = None
                    if row["record_type"] != "revisit":
                        block = f.read_at(length, block_at)
                        if header.get("content-type", "").startswith("application/http"):
                            block = block[block.index(b"\r\n\r\n") + 4:]
                        row["payload"] = block
                yield tuple(row[c] for c in self.columns)


def _file_system(uri: str):
    from pyarrow.fs import FileSystem, LocalFileSystem
    if uri.startswith("file:"):
        return LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return FileSystem.from_uri(uri) if "://" in uri else (LocalFileSystem(), uri)


def _row(header: dict[str, str]) -> dict:
    row = {c: header.get(name.lower()) for c, name in FIELDS.items()}
    if row["payload_digest"] is not None:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    if row["payload_bytes"] is not None:
        row["payload_bytes"] = int(row["payload_bytes"])
    return row


def _header(f, at: int) -> tuple[dict[str, str], int]:
    """The fields (names in lower case) of the record at ``at``, and where its block begins."""
    data = b""
    while (end := data.find(b"\r\n\r\n")) < 0:
        more = f.read_at(2048, at + len(data))
        if not more:
            raise ValueError(f"unfinished WARC header at byte {at}")
        data += more
    first, *lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, at + end + 4


def _first_record(f, start: int, end: int) -> int | None:
    """Where the first record at or after ``start`` begins. A payload may hold text that looks
    like a record, so records are followed from the file's beginning by their lengths: headers
    alone are read."""
    at = 0
    size = f.size()
    while at < start and at < size:
        header, block_at = _header(f, at)
        at = block_at + int(header["content-length"]) + 4
    return at if at < end else None


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """Records below ``path``; ``columns`` names the wanted ones, so that payloads can be left."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").schema(columns).load(path)


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the pages as archives below the shared folder and read them back, one row per
    record: page_id, payload_bytes, payload_digest, record_type, refers_to. A response's length
    and digest are those of the payload read; a revisit's are in its header, which the filter on
    the record type reaches without its block."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm", f"warc-{unique_suffix()}")
    write_archives(pages, path, min_bytes)
    forget_on_exit(spark, path)
    responses = (read_archives(spark, path).filter("record_type = 'response'")
                 .select(page_of(F.col("record_id")).alias("page_id"),
                         F.octet_length("payload").cast("long").alias("payload_bytes"),
                         F.sha1("payload").alias("payload_digest"), "record_type",
                         F.lit(None).cast("long").alias("refers_to")))
    revisits = (read_archives(spark, path, "record_type string, record_id string, payload_digest string, "
                                           "payload_bytes long, refers_to string")
                .filter("record_type = 'revisit'")
                .select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", page_of(F.col("refers_to")).alias("refers_to")))
    return responses.unionByName(revisits)
