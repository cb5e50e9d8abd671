"""WARC archives: a writer on Spark's text sink and a reader as a PySpark Python data source.

Writing. Every row becomes one record whose block is an HTTP response with the page as payload. Of
rows with equal payloads (by SHA-1 digest) the one with the largest key is a ``response``, the others
are ``revisit`` records without a block that refer to it; with a least size, smaller payloads are
always responses. Digests are counted with map-side aggregation, and only digests that occur twice
are joined back, so a payload that a third of all rows share is one row on the small side.

Reading. The driver lists the files and plans one partition per file, or per few small files.
Record-type and header predicates are pushed down to the tasks, which parse the header of each record
first and skip the block of a record that the predicates do not want, or whose payload was not asked
for. The predicates are arguments of the read and travel as options of the source: filters that Spark
pushes into a Python source stay with it for the next query on the same DataFrame, which then misses rows.

A null page has an empty payload. Rows equal in both key and payload are of the same type. A null key
is written as an empty id and read as null; against any other key it is the smaller one. Empty tables
give empty archives. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from marketlens.llm.common import column
from marketlens.session import fresh_path, staged

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
BATCH_BYTES = 8 << 20


def digest(payload: Column) -> Column:
    """SHA-1 in base32, from five hexadecimal digits to four letters at a time."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def marked_repeats(pages: DataFrame, key: str, page: str, least: int = 0) -> DataFrame:
    """``key``, ``url``, payload, digest, type and referred key of every row."""
    rows = pages.withColumn("payload", F.coalesce(F.col(page), F.lit("")).cast("binary"))
    rows = rows.withColumn("digest", digest(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    many = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.max(key).alias("first"), F.count("*").alias("n"))
    many = staged(many.filter("n > 1").select(F.col("digest").alias("d"), "first"), "digests")
    held = rows.join(many, (rows.digest == many.d) & (rows.bytes >= least), "left")
    return held.withColumn("again", F.col("d").isNotNull() & ~F.col(key).eqNullSafe(F.col("first")))


def _record(key: str, url: str) -> Column:
    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))

    def urn(column: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))

    again, block = F.col("again"), F.col("bytes") + len(HTTP)
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col(key))),
        line("WARC-Target-URI", F.translate(F.coalesce(F.col(url), F.lit("")), "\r\n", "")),
        line("WARC-Date", "1970-01-01T00:00:00Z"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(again, F.concat(line("WARC-Profile", PROFILE), line("WARC-Refers-To", urn(F.col("first"))))).otherwise(""),
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", F.when(again, 0).otherwise(block).cast("string")),
        F.lit("\r\n"),
    )
    # A binary cast to string keeps its bytes, and the text sink writes them as they are.
    return F.concat(head, F.when(again, "").otherwise(F.concat(F.lit(HTTP), F.col("payload").cast("string"))))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", page: str = "html", least: int = 0) -> None:
    """Writes archives below ``path``, on any file system Spark can write to.

    The text sink ends every row with its line separator, which is here the two line ends that close
    a record.
    """
    rows = marked_repeats(pages.select(key, url, page), key, page, least)
    rows.select(_record(key, url).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True, where: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """The records below ``path`` whose header columns have one of the values ``where`` gives for them.

    Without payloads, all blocks are skipped.
    """
    unknown = set(where or {}) - set(HEADERS)
    if unknown:
        raise ValueError(f"no header columns: {sorted(unknown)}; use some of {sorted(HEADERS)}")
    spark.dataSource.register(WarcSource)
    wanted = json.dumps({name: list(values) for name, values in (where or {}).items()})
    return spark.read.format("warc").option("payload", str(payload).lower()).option("where", wanted).load(path)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` (false skips blocks); ``where``, a JSON object of header columns and their wanted
    values; ``groupBytes``, the size up to which files share a partition."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true") != "false"
        self.group = int(options.get("groupBytes", options.get("groupbytes", 4 << 20)))
        self.wanted = {name: set(values) for name, values in json.loads(options.get("where", "{}")).items()}

    def partitions(self) -> list[Files]:
        system, path = _file_system(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        files = sorted((f for f in found if f.is_file and not posixpath.basename(f.path).startswith(("_", "."))), key=lambda f: f.path)
        groups: list[Files] = []
        size = self.group
        for f in files:
            if size + f.size > self.group:
                groups.append(Files([]))
                size = 0
            groups[-1].paths.append(f.path)
            size += f.size
        return groups or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        system, _ = _file_system(self.path)
        for path in partition.paths:
            with system.open_input_stream(path) as stream:  # gzip by the file's extension
                for row in records(stream, self.wanted, self.payload):
                    rows.append(row)
                    held += 200 + len(row[-1] or b"")
                    if held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        yield _batch(rows)


TYPES = [pa.string()] * 5 + [pa.int64(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(TYPES)], names=names)


class _Buffered:
    """Lines and exact numbers of bytes from a stream that only reads chunks."""

    def __init__(self, stream: BinaryIO, chunk: int = 1 << 20):
        self.stream, self.chunk, self.data, self.at = stream, chunk, b"", 0

    def _fill(self) -> bool:
        more = self.stream.read(self.chunk)
        self.data, self.at = self.data[self.at :] + more, 0
        return bool(more)

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next ``mark``, or None at the end of the stream."""
        while (k := self.data.find(mark, self.at)) < 0:
            if not self._fill():
                return None
        out = self.data[self.at : k]
        self.at = k + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts = [self.data[self.at : self.at + n]]
        self.at += len(parts[0])
        left = n - len(parts[0])
        while left and (more := self.stream.read(min(left, self.chunk))):
            parts.append(more)
            left -= len(more)
        if left:
            raise ValueError("archive ends inside a record")
        return b"".join(parts)

    def skip(self, n: int) -> None:
        here = min(n, len(self.data) - self.at)
        self.at += here
        left = n - here
        while left:
            got = len(self.stream.read(min(left, self.chunk)))
            if not got:
                raise ValueError("archive ends inside a record")
            left -= got


def records(stream: BinaryIO, wanted: dict[str, set], payload: bool) -> Iterator[tuple]:
    source = _Buffered(stream)
    end = END.encode()
    while (head := source.until(end)) is not None:
        first, *lines = head.decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record where one should begin: {first[:40]!r}")
        fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        row = {name: fields.get(header.lower()) for name, header in HEADERS.items()}
        row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
        if any(row[name] not in values for name, values in wanted.items()) or not (payload and size):
            source.skip(size)
            body = None
        else:
            body = source.take(size)
            if "application/http" in fields.get("content-type", ""):
                body = body.partition(end)[2]
        if source.take(len(end)) != end:
            raise ValueError("record without its closing line ends")
        if all(row[name] in values for name, values in wanted.items()):
            length = int(fields.get("x-payload-length", size)) if body is None else len(body)
            yield *(row[name] for name in HEADERS), length, body


def payload_digests(found: DataFrame) -> DataFrame:
    """``found`` with the digests of the payloads that were read; records without one keep the header's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, told = column(batch, "payload").to_pylist(), column(batch, "payload_digest").to_pylist()
            sums = [t if b is None else base64.b32encode(hashlib.sha1(b).digest()).decode() for b, t in zip(bodies, told, strict=True)]
            kept = [column(batch, n) for n in ("record_id", "payload_bytes", "record_type", "refers_to")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.string())], names=["record_id", "payload_bytes", "record_type", "refers_to", "payload_digest"])

    return found.mapInArrow(run, "record_id string, payload_bytes long, record_type string, refers_to string, payload_digest string")


def round_trip(pages: DataFrame, key: str = "page_id", least: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and returns what reading them gives.

    Payloads are read of responses only; of the other records the headers tell all.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_warc(pages, path, key=key, least=least)
    responses = read_warc(spark, path, where={"record_type": ["response"]})
    revisits = read_warc(spark, path, payload=False, where={"record_type": ["revisit"]})
    found = payload_digests(responses.unionByName(revisits))

    def number(name: str) -> Column:
        return F.nullif(F.regexp_extract(name, "<urn:page:(.*)>", 1), F.lit("")).cast(pages.schema[key].dataType)

    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
