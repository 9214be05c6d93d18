"""WARC archives as a PySpark data source.

`spark.read.format("warc").load(folder)` plans one partition per archive file (the writer starts a new file at
`file_bytes`).  A task parses the headers of a record first.  Filters on the record type and on header columns are pushed down to this point,
so the block of an unwanted record is skipped by its length; with the option `payload` set to false, all payloads are.
Archives ending in .gz are read as a stream.

`df.write.format("warc").save(folder)` writes record_id, warc_type, target_uri, refers_to, payload.  Files
of failed attempts are left out: a successful job lists its files, and readers follow the list.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage)

from feedloom.llm.common import meet, stored
from feedloom.llm.files import opened
from feedloom.session import shared_folder

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_COLUMNS = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
                  "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
SCHEMA = "warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, declared_bytes long, payload_bytes long, payload binary"
ARROW = pa.schema([(c, pa.string()) for c in HEADER_COLUMNS] + [("declared_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
ARROW = pa.schema([ARROW.field(c) for c in ("warc_type", "record_id", "target_uri", "refers_to", "payload_digest", "declared_bytes", "payload_bytes", "payload")])
LIST = "_files.json"
FILE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(text: str) -> str:
    return f"<{quote(text, safe=':/?#[]@!$&()*+,;=%-._~')}>"


def record(record_id: str, warc_type: str, target_uri: str | None, refers_to: str | None, payload: bytes, date: str) -> bytes:
    """One record.  A revisit keeps the headers of its response, with the payload's length and digest, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if warc_type == "revisit" else http + payload
    lines = [f"WARC-Type: {warc_type}", f"WARC-Record-ID: {_uri(record_id)}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if target_uri is not None:
        lines.append(f"WARC-Target-URI: {quote(target_uri, safe=':/?#[]@!$&()*+,;=%-._~')}")
    if warc_type == "revisit":
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("archives are only added to a folder: use mode('append')")
        self.folder, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.limit = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = opened(self.folder)
        system.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.limit:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc")
                    out, size = system.open_output_stream(f"{folder}/{files[-1]}"), 0
                data = record(row["record_id"], row["warc_type"], row["target_uri"], row["refers_to"], row["payload"] or b"", self.date)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        system, folder = opened(self.folder)
        system.create_dir(folder, recursive=True)
        names = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{folder}/{uuid.uuid4().hex}{LIST}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        system, folder = opened(self.folder)
        for name in (f for m in messages if m is not None for f in m.files):
            system.delete_file(f"{folder}/{name}")


class _Stream:
    """Forward reading with skips, by seeking where the file allows it."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.plain = not path.endswith(".gz")
        self.file = system.open_input_file(path) if self.plain else system.open_input_stream(path, compression="gzip")
        self.held, self.at = b"", 0

    def until(self, mark: bytes) -> bytes | None:
        """Up to and including a mark; None at the end of the file."""
        seen = 0
        while (end := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            more = self.file.read(16_384)
            if not more:
                return None
            self.held += more
        out, self.held = self.held[:end + len(mark)], self.held[end + len(mark):]
        return out

    def take(self, count: int) -> bytes:
        while len(self.held) < count:
            more = self.file.read(max(16_384, count - len(self.held)))
            if not more:
                raise EOFError("an archive ends inside a record")
            self.held += more
        out, self.held = self.held[:count], self.held[count:]
        return out

    def skip(self, count: int) -> None:
        if self.plain and count > len(self.held):
            self.file.seek(self.file.tell() + count - len(self.held))
            self.held = b""
        else:
            while count > 0:
                count -= len(self.take(min(count, 1 << 20)))


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if ":" in line)}


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.payload = options["path"], options.get("payload", "true").lower() != "false"
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]):
        """Keep equality, membership and prefix tests on header columns; hand back the others."""
        for test in filters:
            column = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else None
            if column in HEADER_COLUMNS and isinstance(test, EqualTo):
                self.tests.append((column, "in", (test.value,)))
            elif column in HEADER_COLUMNS and isinstance(test, In):
                self.tests.append((column, "in", tuple(test.value)))
            elif column in HEADER_COLUMNS and isinstance(test, StringStartsWith):
                self.tests.append((column, "starts", (test.value,)))
            else:
                yield test

    def partitions(self) -> list[InputPartition]:
        system, folder = opened(self.folder)
        found = [i.path for i in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if i.type == fs.FileType.File]
        lists = [p for p in found if p.endswith(LIST)]
        names = {n for p in lists for n in json.loads(system.open_input_stream(p).read())}
        archives = [p for p in found if p.endswith((".warc", ".warc.gz")) and (not lists or p.rsplit("/", 1)[-1] in names)]
        return [_File(p) for p in sorted(archives)] or [_File("")]

    def _wanted(self, row: dict) -> bool:
        for column, kind, values in self.tests:
            value = row[column]
            if value is None or not (value in values if kind == "in" else value.startswith(values)):
                return False
        return True

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = opened(self.folder)
        stream, rows, held = _Stream(system, partition.path), [], 0
        while (raw := stream.until(b"\r\n\r\n")) is not None:
            head = _headers(raw.lstrip(b"\r\n"))
            size = int(head["content-length"])
            row = {c: head.get(h) for c, h in HEADER_COLUMNS.items()}
            for c in ("record_id", "refers_to", "target_uri"):
                row[c] = row[c] and unquote(row[c].strip("<>"))
            row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
            row |= {"declared_bytes": None, "payload_bytes": None, "payload": None}
            if self._wanted(row):
                if "msgtype=response" in head.get("content-type", ""):
                    http = stream.until(b"\r\n\r\n")
                    length = _headers(http).get("content-length", "")
                    row["declared_bytes"] = int(length) if length.isdigit() else None
                    size -= len(http)
                row["payload_bytes"] = size
                if self.payload and row["warc_type"] != "revisit":
                    row["payload"] = stream.take(size)
                    size = 0
                rows.append(row)
                held += 512 + len(row["payload"] or b"")
            stream.skip(size + 4)
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, ARROW)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let Spark push filters down to it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records for `pages` (page_id, url, html): of equal payloads of at least `least_bytes`, that of the greatest page_id is the response.

    A null html is an empty payload.  Rows of the greatest id itself are all responses, so a repeated row is no revisit.
    Null ids are least; a null url leaves its header out.  Other columns are ignored.
    """
    text = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(text).alias("sha"))
    narrow = stored(rows.select("page_id", "sha").distinct())
    heads = narrow.groupBy("sha").agg(F.max("page_id").alias("head"))
    ruled = stored(narrow.join(heads, "sha"))
    met = meet(rows, ruled, "page_id", "sha")
    revisits = F.col("head").isNotNull() & ~F.col("head").eqNullSafe(F.col("page_id")) & (F.octet_length(text) >= least_bytes)
    name = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return met.select(name(F.col("page_id")).alias("record_id"), F.when(revisits, "revisit").otherwise("response").alias("warc_type"),
                      F.col("url").alias("target_uri"), F.when(revisits, name(F.col("head"))).alias("refers_to"),
                      text.cast("binary").alias("payload"))


def write_archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> str:
    """Write a record per page and return the folder, by default a new one in the cluster's shared folder."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    records(pages, least_bytes).write.format("warc").option("file_bytes", file_bytes).mode("append").save(folder)
    return folder


def read_archive(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of a folder.  Spark keeps the filters first pushed down with the loaded table: call this again for other filters."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives say about each page: responses by their payloads, revisits by headers alone."""
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS BIGINT)")
    responses = read_archive(spark, folder).filter("warc_type = 'response'").select(
        number("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        F.col("warc_type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    revisits = read_archive(spark, folder, payload=False).filter("warc_type = 'revisit'").select(
        number("record_id").alias("page_id"), F.col("declared_bytes").alias("payload_bytes"), "payload_digest",
        F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)
