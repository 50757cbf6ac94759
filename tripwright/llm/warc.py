"""WARC archives of pages, and a two-level index of their captures.

``write`` makes WARC/1.1 files with one record per page. A record is text (headers, HTTP head, HTML in
UTF-8) and ends in CR LF CR LF, so Spark's text writer with that separator writes archives without
any file leaving Spark. Of pages with one payload of ``REVISIT_BYTES`` or more the one with the largest
id is a response, the others are revisits that refer to it.

``index`` sorts the captures by key (host name reversed, then path and query) into compressed blocks of
``BLOCK_LINES`` lines and keeps a sparse directory: the first and last key of each block. ``captured`` takes a
table of urls: it finds the blocks of their keys by the directory, opens only these, searches them by bisection
and reads only the byte range of each record found, all of it in tasks. Only the directory, a row per
block, is broadcast. Ranges are read by pyarrow, which knows local, HDFS, S3 and GCS paths; of archives in another store
Spark reads the files that hold a record whole, and the ranges are cut out of them.

Defined cases: null html is an empty payload; a null url has no target header and the key "-"; rows of
one id and payload that are the largest are all responses; a null id never is referred to; without
pages there are no archives, and an index without blocks.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm.tables import written
from tripwright.session import new_workspace

REVISIT_BYTES = 1000
BLOCK_LINES = 3000
FILE_RECORDS = 4000

# Marks of the public archive format.
_END = "\r\n\r\n"
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", page_id.cast("string"), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; line breaks cannot end it."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _target(url: Column) -> Column:
    """A url as a record's header has it."""
    for char, code in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return url


def typed(pages: DataFrame) -> DataFrame:
    """Pages with ``payload``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("payload_digest", F.sha1(F.encode("payload", "UTF-8")))
    # One row per payload that occurs again: combined before the shuffle, so a hot payload is one row a task.
    again = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and newest is not null")
        .drop("n")
    )
    # Stored, so that its size is known: Spark broadcasts it below its threshold, and then no payload is shuffled.
    again = written(again, "warc-repeated")
    joined = rows.join(again, "payload_digest", "left")
    is_revisit = F.coalesce((F.col("payload_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("newest")) & F.col("newest").isNotNull(), F.lit(False))
    return joined.withColumns({
        "record_type": F.when(is_revisit, "revisit").otherwise("response"),
        "refers_to": F.when(is_revisit, F.col("newest")),
    }).drop("newest")


def write(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> str:
    """Writes the archives; returns their folder. ``date`` goes into every record: pages carry none."""
    revisit = F.col("record_type") == "revisit"
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(_END)
    )
    length = F.octet_length(head) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    record = F.concat(
        F.lit(f"{_VERSION}\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _target(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(revisit, _header("WARC-Profile", F.lit(_PROFILE))).otherwise(""),
        F.when(revisit, _header("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("payload_digest")))).otherwise(""),
        _header("X-Refers-To-Page", F.col("refers_to")),
        _header("X-Page-Id", F.col("page_id")),
        _header("X-Payload-Length", F.col("payload_bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", length),
        F.lit("\r\n"),
        head,
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    folder = new_workspace(pages.sparkSession, "warc")
    writer = typed(pages).select(record.alias("value")).write
    writer.option("lineSep", _END).option("maxRecordsPerFile", FILE_RECORDS).text(folder)
    return folder


def surt(url: str | None) -> str:
    """``http://m.example.com:80/a?b#c`` as ``com,example,m)/a?b``."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return url
    key = ",".join(reversed(host.lower().split("."))) + ")" + (parts.path or "/")
    return key + (f"?{parts.query}" if parts.query else "")


def _head_length(record: memoryview) -> int:
    """Bytes up to the end of the headers."""
    end = bytes(record[:65536]).find(b"\r\n\r\n")
    return (end if end >= 0 else bytes(record).find(b"\r\n\r\n")) + 4


def parse(record: bytes | memoryview) -> tuple[dict[str, str], memoryview]:
    """Headers (lower-case names) and block of the record at the front of some bytes."""
    view = memoryview(record)
    end = _head_length(view)
    lines = bytes(view[: end - 4]).decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return headers, view[end : end + int(headers["content-length"])]


_RECORD = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("key", pa.string()), ("url", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORDS = "file string, offset long, length long, key string, url string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(file: str, offset: int, rest: bytes | memoryview) -> tuple:
    """The row of the record at the front of ``rest``. A response's payload must have the digest it names."""
    rest = memoryview(rest)
    headers, block = parse(rest)
    length = _head_length(rest) + block.nbytes + len(_END)
    digest = headers["warc-payload-digest"].partition(":")[2]
    size = int(headers["x-payload-length"])
    if headers["warc-type"] == "response":
        payload = block[bytes(block[:65536]).index(b"\r\n\r\n") + 4 :]
        found = hashlib.sha1(payload).hexdigest()
        if found != digest or payload.nbytes != size:
            raise ValueError(f"{file}: the payload at {offset} is not the one its header names")
    number = lambda name: int(headers[name]) if name in headers else None
    url = headers.get("warc-target-uri")
    return file, offset, length, surt(url), url, number("x-page-id"), size, digest, headers["warc-type"], number("x-refers-to-page")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Reads all archives: place, key, page and payload digest of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                file, data = path.as_py().rsplit("/", 1)[1], memoryview(content.as_buffer())
                at, rows = 0, []
                while at < len(data):
                    rows.append(_read(file, at, data[at:]))
                    at += rows[-1][2]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, RECORDS)


_BLOCKS = "part int, block int, first_key string, last_key string, n_lines int, payload binary"


def index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> str:
    """Writes ``blocks`` and ``directory`` of the captures (rows of ``records``); returns the folder."""
    spark = captures.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block(rows: list[dict]) -> pa.RecordBatch:
            lines = "\n".join(json.dumps([r[n] for n in ("key", "file", "offset", "length", "page_id", "record_type", "payload_digest")]) for r in rows)
            row = (part, number, rows[0]["key"], rows[-1]["key"], len(rows), zlib.compress(lines.encode(), 6))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.binary()))], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= block_lines:
                yield block(held[:block_lines])
                held, number = held[block_lines:], number + 1
        if held:
            yield block(held)

    folder = new_workspace(spark, "capture-index")
    # The place is part of the order, so captures of one key can lie in several parts.
    order = ["key", "file", "offset"]
    lines = captures.select(*order, "length", "page_id", "record_type", "payload_digest")
    lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _BLOCKS).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    blocks.drop("payload").write.parquet(f"{folder}/directory")
    return folder


_LINES = "key string, file string, offset long, length long, page_id long, record_type string, payload_digest string"


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of an index, from its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                rows = [json.loads(line) for line in zlib.decompress(payload).decode().split("\n")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in _LINES.split(", ")])

    return spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("payload").mapInArrow(run, _LINES)


def keys(urls: DataFrame) -> DataFrame:
    """Each ``key`` of some urls (column ``url``) once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(url) for url in batch.column(0).to_pylist()], pa.string())], ["key"])

    return urls.select(_target(F.col("url")).alias("url")).mapInArrow(run, "key string").distinct()


def places(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """``file``, ``offset`` and ``length`` of all captures of the wanted keys (column ``key``, each once)."""
    names = _BLOCKS.replace(", payload binary", "")
    directory = spark.read.schema(names).parquet(f"{folder}/directory").orderBy("part", "block").collect()  # a row per block
    number = spark.sparkContext.broadcast([(r["part"], r["block"]) for r in directory])
    edges = spark.sparkContext.broadcast(([r["first_key"] for r in directory], [r["last_key"] for r in directory]))

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = edges.value
        for batch in batches:
            found: dict[int, list[str]] = {}
            for key in batch.column(0).to_pylist():
                for k in range(bisect_left(last, key), bisect_right(first, key)):
                    found.setdefault(k, []).append(key)
            if found:
                part, block = zip(*(number.value[k] for k in found))
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.int32()), pa.array(list(found.values()), pa.list_(pa.string()))], ["part", "block", "keys"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, own in zip(batch.column(0), batch.column(1)):
                text = zlib.decompress(payload.as_buffer()).decode().split("\n")
                lines: list[list | None] = [None] * len(text)

                def line(k: int) -> list:
                    if lines[k] is None:
                        lines[k] = json.loads(text[k])
                    return lines[k]

                found = []
                for key in own.as_py():
                    at = bisect_left(range(len(text)), key, key=lambda k: line(k)[0])
                    while at < len(text) and line(at)[0] == key:
                        found.append(line(at)[1:4])
                        at += 1
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.int64()))], ["file", "offset", "length"])

    # In the order of keys, those of one block come together.
    near = written(wanted.select("key"), "capture-keys").repartitionByRange("key").sortWithinPartitions("key")
    hits = near.mapInArrow(hit, "part int, block int, keys array<string>")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("part", "block", "payload")
    return hits.join(blocks, ["part", "block"]).select("payload", "keys").mapInArrow(search, "file string, offset long, length long")


def _store(uri: str) -> tuple[FileSystem, str] | None:
    """The store and path of a folder, if pyarrow can read it."""
    try:
        return FileSystem.from_uri(uri)
    except (pa.ArrowException, OSError, ValueError):
        return None


def _pieces(spark: SparkSession, archives: str, found: DataFrame, make: Callable[[Iterator[tuple]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``make`` of the (file, offset, bytes) of records at some places."""
    target = spark._jvm.org.apache.hadoop.fs.Path(archives)
    uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        store, path = FileSystem.from_uri(uri)
        name, source = None, None
        try:
            for batch in batches:
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    if file != name:
                        if source is not None:
                            source.close()
                        name, source = file, store.open_input_file(f"{path}/{file}")
                    piece = source.read_at(length, offset)
                    if len(piece) != length:
                        raise ValueError(f"{file}: no {length} bytes at {offset}")
                    yield file, offset, piece
        finally:
            if source is not None:
                source.close()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, content, own in zip(*batch.columns):
                data = memoryview(content.as_buffer())
                for place in own.as_py():
                    yield path.as_py(), place["offset"], data[place["offset"] : place["offset"] + place["length"]]

    if _store(uri):
        # Stored, as dealing out by range looks at its input twice.
        near = written(found.select("file", "offset", "length"), "capture-places").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
        return near.mapInArrow(lambda batches: make(ranges(batches)), schema)
    own = found.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(archives)
    whole = files.select(F.substring_index("path", "/", -1).alias("file"), "content").join(own, "file")
    return whole.select("file", "content", "places").mapInArrow(lambda batches: make(cut(batches)), schema)


def captured(spark: SparkSession, archives: str, folder: str, urls: DataFrame) -> DataFrame:
    """The rows (as of ``records``) of every capture of some urls: directory, blocks, bisection, range reads."""

    def make(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        while rows := [_read(*piece) for piece in islice(pieces, 1000)]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    return _pieces(spark, archives, places(spark, folder, keys(urls)), make, RECORDS)


def lookup(spark: SparkSession, archives: str, folder: str, url: str) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of every capture of one url, found in the same way and brought to the driver."""

    def make(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for file, offset, piece in pieces:
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([offset]), pa.array([bytes(piece)], pa.binary())], ["file", "offset", "record"])

    urls = spark.createDataFrame([(url,)], "url string")
    read = _pieces(spark, archives, places(spark, folder, keys(urls)), make, "file string, offset long, record binary")
    parsed = (parse(bytes(r["record"])) for r in read.orderBy("file", "offset").toLocalIterator())
    return [(headers, bytes(block)) for headers, block in parsed]
