"""WARC archives: writing, reading, and resolving equal payloads to revisit records.

Archives hold one gzip member per record, so that a record can be read from its place alone. Records with
equal payloads are found by their headers: those are read from the archives, shuffled by payload digest, and
joined to the record that stays a response. Then every archive is read again by place and written anew
with fresh headers, in which the other records only point at that response. Payloads never leave the
task that reads them.

Digests that very many records share are joined by broadcast: of digests that hold more than one in a
thousand of all records there are fewer than a thousand.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of
from tabprep.scratch import materialize, scratch_dir
from tabprep.sinks.workbook import file_system

#: Payloads of fewer bytes stay responses; bytes of an archive file, about; effort of the compression.
LEAST, ARCHIVE_BYTES, LEVEL = 1000, 64 << 20, 1
#: One in so many records makes a digest, or an original, a frequent one.
FREQUENT = 1000
_READ = 1 << 20

FILES = "path string, records bigint, bytes bigint"
HEADERS = (
    "path string, offset bigint, length bigint, record_id string, record_type string, url string, date string, "
    "page_id bigint, payload_bytes bigint, payload_digest string, refers_to_id string"
)
_HEADER_SCHEMA = pa.schema(
    [(n, pa.int64() if k == "bigint" else pa.string()) for n, k in (c.split() for c in HEADERS.split(", "))]
)
_FILE_SCHEMA = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
# The format's version line, and the profile of records that repeat a payload.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _hex_digest(value: str) -> str:
    return base64.b32decode(value.removeprefix("sha1:")).hex()


def _target(url: str) -> str:
    """A URL as a header value: blanks, control characters and others beyond ASCII are escaped, as is the escape."""
    return quote(url, safe="!#$&'()*+,/:;=?@[]~-._")


class Record(dict):
    """Named header fields of a record, with its block."""

    def __init__(self, fields: dict[str, str], block: bytes):
        super().__init__(fields)
        self.block = block

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header in the block."""
        return self.block.partition(b"\r\n\r\n")[2]

    def member(self, level: int) -> bytes:
        """The record as a gzip member."""
        lines = [_VERSION, *(f"{name}: {value}".encode() for name, value in self.items()), b"Content-Length: %d" % len(self.block)]
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + self.block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> Record:
    """A record from its bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    size = int(fields.pop("Content-Length"))
    if len(rest) < size:
        raise ValueError("a record is cut off")
    return Record(fields, rest[:size])


def response(record_id: str, page_id: int | None, url: str | None, date: str, payload: bytes) -> Record:
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date}
    if url is not None:
        fields["WARC-Target-URI"] = _target(url)
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    fields |= {"WARC-Payload-Digest": _digest(payload), "Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    return Record(fields, _HTTP % len(payload) + payload)


class _Archives:
    """Writes members into files of a folder, each under a name of the attempt, and lists the finished ones."""

    def __init__(self, folder: str, limit: int):
        self.store, self.folder = file_system(folder)
        self.limit, self.number = limit, 0
        task = TaskContext.get()
        self.name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        self.shown = folder.rstrip("/")
        self.out = None
        self.done: list[tuple[str, int, int]] = []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.file = f"{self.name}-{self.number:03d}.warc.gz"
            self.out = self.store.open_output_stream(f"{self.folder}/{self.file}", compression=None)
            self.records = self.bytes = 0
            self.number += 1
        self.out.write(member)
        self.records += 1
        self.bytes += len(member)
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((f"{self.shown}/{self.file}", self.records, self.bytes))

    def listed(self) -> Iterator[pa.RecordBatch]:
        self.close()
        if self.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.done), _FILE_SCHEMA)], schema=_FILE_SCHEMA)


def _folder(spark: SparkSession, folder: str | None) -> str:
    folder = folder or f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    return folder


def _now(date: dt.datetime | None) -> str:
    return (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_responses(
    pages: DataFrame,
    folder: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: dt.datetime | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """Write a response record per row into archives of a folder, and return the finished files.

    The payload is the column's UTF-8 (null: empty). A null id or URL is left out of the header. Equal rows are
    records of their own. Columns: ``path``, ``records``, ``bytes``. Files of attempts that failed are not listed.
    Without a folder they lie with the intermediate tables. An empty table gives no files.
    """
    folder, date = _folder(pages.sparkSession, folder), _now(date)
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(payload_column).alias("payload")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, run = _Archives(folder, archive_bytes), f"{folder}/{TaskContext.get().partitionId()}"
        for number, (page_id, url, payload) in enumerate(rows_of(batches, "page_id", "url", "payload")):
            record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{run}/{number}").urn
            out.add(response(record_id, page_id, url and url.decode(), date, payload or b"").member(level))
        yield from out.listed()

    return materialize(rows.mapInArrow(write, FILES))


def _members(stream) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and content of the gzip members of a file, one at a time."""
    at, data = 0, b""
    while data or (data := stream.read(_READ)):
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            data = data or stream.read(_READ)
            if not data:
                raise ValueError("an archive is cut off")
            parts.append(unpack.decompress(data))
            used += len(data) - len(unpack.unused_data)
            data = unpack.unused_data
        yield at, used, b"".join(parts)
        at += used


def _header_row(path: str, at: int, length: int, record: Record) -> tuple:
    refers = record.get("WARC-Refers-To")
    kind, number = record["WARC-Type"], record.get("Page-ID")
    digest = record.get("WARC-Payload-Digest")
    if kind == "response":
        payload = record.payload
        own = hashlib.sha1(payload).hexdigest()
        if digest is not None and _hex_digest(digest) != own:
            raise ValueError(f"{path}: the payload at {at} does not have its digest")
        size, digest = len(payload), own
    else:
        size, digest = record.get("Payload-Length"), digest and _hex_digest(digest)
    url = record.get("WARC-Target-URI")
    return (
        path, at, length, record["WARC-Record-ID"].strip("<>"), kind, url if url is None else unquote(url), record.get("WARC-Date"),
        None if number is None else int(number), None if size is None else int(size), digest, refers and refers.strip("<>"),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_headers(files: DataFrame) -> DataFrame:
    """The records of listed archives (a column ``path``): a row of ``HEADERS`` each, payloads left where they are.

    ``offset`` and ``length`` are the record's place in its file. Size and digest (bare, in lower-case hex) are
    those of the payload that is there; a digest in the header that differs is an error. A revisit record has the
    ones that its header names. Files are dealt to tasks one by one.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for (path,) in rows_of(batches, "path"):
            path = path.decode()
            store, name = file_system(path)
            with store.open_input_file(name) as stream:
                for at, length, data in _members(stream):
                    rows.append(_header_row(path, at, length, parse_record(data)))
                    if len(rows) >= 10_000:
                        yield _batch(rows, _HEADER_SCHEMA)
                        rows = []
        if rows:
            yield _batch(rows, _HEADER_SCHEMA)

    n = max(1, min(files.count(), 100_000))
    return files.select("path").repartition(n).mapInArrow(read, HEADERS)


def frequent_join(rows: DataFrame, facts: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Left join of rows with one row of facts per key, which has the number of the key's rows as ``_rows``.

    Keys with more than one in ``FREQUENT`` of all rows are fewer than ``FREQUENT`` and are broadcast; the rows of
    the others are exchanged, at most so many per key.
    """
    often = facts.filter(F.col("_rows") > F.lit(total) / FREQUENT)
    rare = facts.filter(F.col("_rows") <= F.lit(total) / FREQUENT)
    marked = rows.join(F.broadcast(often.withColumn("_often", F.lit(True))), keys, "left")
    met = marked.filter("_often").drop("_often")
    return met.unionByName(marked.filter("_often is null").select(rows.columns).join(rare, keys, "left"))


def resolve(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """What each record becomes: the headers with ``target_*``, the response whose payload it repeats, or nulls.

    Of responses with equal payloads of at least ``least`` bytes that with the largest page id stays one, of equal
    ids that with the largest record id; null ids come last. Payloads are equal if digest and size are.
    """
    named = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("order"), "record_id", "page_id", "url", "date")
    groups = headers.filter(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
    originals = groups.agg(F.max(named).alias("original"), F.count("*").alias("_rows")).filter("_rows > 1")
    originals = materialize(originals)
    joined = frequent_join(headers, originals, ["payload_digest", "payload_bytes"], headers.count())
    other = F.col("original.record_id") != F.col("record_id")
    return joined.select(
        *headers.columns, *(F.when(other, F.col(f"original.{c}")).alias(f"target_{c}") for c in ("record_id", "url", "date"))
    )


def _revisit(record: Record, date: str, target_id: str, target_url: str | None, target_date: str | None) -> Record:
    fields = {"WARC-Type": "revisit", "WARC-Record-ID": record["WARC-Record-ID"], "WARC-Date": date}
    fields |= {n: record[n] for n in ("WARC-Target-URI", "Page-ID", "WARC-Payload-Digest", "Payload-Length") if n in record}
    fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<{target_id}>"}
    if target_url is not None:
        fields["WARC-Refers-To-Target-URI"] = _target(target_url)
    if target_date is not None:
        fields["WARC-Refers-To-Date"] = target_date
    return Record(fields | {"Content-Type": "application/http; msgtype=response"}, record.block[: len(record.block) - len(record.payload)])


def write_deduplicated(
    resolved: DataFrame, folder: str | None = None, date: dt.datetime | None = None, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Write the records of ``resolve`` anew, repeats as revisit records, and return the finished files.

    Rows are dealt by file and place, in ranges of about ``archive_bytes``, so that a task reads a stretch of one
    file after the other. Records get fresh headers: type, date, digest, size and what they refer to.
    """
    spark = resolved.sparkSession
    folder, date = _folder(spark, folder), _now(date)
    columns = ("path", "offset", "length", "target_record_id", "target_url", "target_date")
    rows = materialize(resolved.select(*columns))
    size = rows.agg(F.sum("length")).first()[0] or 0
    n = max(-(-size // archive_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")) if size > archive_bytes else 1)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, opened, stream = _Archives(folder, archive_bytes), None, None
        for path, offset, length, target_id, url, first in rows_of(batches, *columns):
            if path != opened:
                if stream is not None:
                    stream.close()
                store, name = file_system(path.decode())
                stream, opened = store.open_input_file(name), path
            stream.seek(offset)
            record = parse_record(zlib.decompress(stream.read(length), 31))
            if target_id is not None:
                record = _revisit(record, date, target_id.decode(), url and url.decode(), first and first.decode())
            else:
                record["WARC-Date"] = date
            out.add(record.member(level))
        if stream is not None:
            stream.close()
        yield from out.listed()

    ranged = rows.repartitionByRange(int(n), "path", "offset").sortWithinPartitions("path", "offset")
    return materialize(ranged.mapInArrow(write, FILES))


def referred(headers: DataFrame) -> DataFrame:
    """The headers of deduplicated archives with ``refers_to``, the page id of the response of each revisit record.

    Revisit records are joined to responses by the record id that they name; one that names no response of the
    archives is an error.
    """
    headers = materialize(headers)
    counted = headers.filter("record_type = 'revisit'").groupBy(F.col("refers_to_id").alias("id")).agg(F.count("*").alias("_rows"))
    originals = headers.filter("record_type = 'response'").select(F.col("record_id").alias("id"), F.col("page_id").alias("refers_to"))
    facts = counted.join(originals.withColumn("_there", F.lit(True)), "id", "left")
    facts = facts.withColumn("refers_to", F.when(F.col("_there"), F.col("refers_to")).otherwise(F.raise_error(F.lit("a revisit record refers to no response"))))
    facts = materialize(facts.select(F.col("id").alias("refers_to_id"), "refers_to", "_rows"))
    revisits = headers.filter("record_type = 'revisit'")
    joined = frequent_join(revisits, facts, ["refers_to_id"], headers.count()).select(*headers.columns, "refers_to")
    return joined.union(headers.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("bigint")))


def deduplicate(files: DataFrame, folder: str | None = None, least: int = LEAST, **options) -> DataFrame:
    """Resolve the records of listed archives and write deduplicated ones; returns the finished files.

    ``options`` are those of ``write_deduplicated``.
    """
    return write_deduplicated(resolve(materialize(read_headers(files)), least), folder, **options)
