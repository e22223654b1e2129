"""WARC archives: write them, give every record a gzip member of its own, and index where each one lies.

Spark's own readers and writers move all files, so any store that Spark reaches will do, and a task that is lost is
simply run again.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ready, scratch

CRLF, GAP = "\r\n", "\r\n\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{GAP}"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
CHUNK = 1 << 16
INDEX = (
    "file string, offset long, length long, page_id long, target_uri string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, intact boolean"
)


def records(pages: DataFrame, least: int = 100) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, refers_to) of every page; null html is the empty payload.

    Of equal payloads of at least ``least`` bytes, the smallest page_id is kept in full and the others refer to it;
    rows that repeat that page_id are all kept in full, and so are rows with equal payloads that all lack an id.
    The smallest id by digest is pre-aggregated; the join back has one row a digest on one side, so that adaptive
    execution can split a digest with very many pages.
    """
    known = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    known = known.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    firsts = (
        known.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    joined = known.join(firsts, F.col("payload_digest") == F.col("digest"), "left").drop("digest")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    return joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def _record(date: str) -> Column:
    """The text of a record, without the blank lines that end it."""

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{CRLF}{name}: "), F.lit(value) if isinstance(value, str) else value)

    def name(c: str) -> Column:
        return F.concat(F.lit(f"<{ID}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, "").otherwise(F.col("html"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", date),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", REVISIT_PROFILE), line("WARC-Refers-To", name("refers_to"))))
        .otherwise(""),
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", (F.octet_length(body) + len(HTTP_HEAD)).cast("string")),
        F.lit(GAP),
        F.lit(HTTP_HEAD),
        body,
    )


def write_monolithic(pages: DataFrame, folder: str, least: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives that are one gzip stream each: the text writer's line end is the blank lines that end a record."""
    lines = records(pages, least).select(_record(date).alias("value"))
    lines.write.option("lineSep", GAP).option("compression", "gzip").text(folder)


# ---- inside a task ------------------------------------------------------------------------------------


def inflate(content: bytes) -> Iterator[bytes]:
    """The bytes of a gzip file, a stretch at a time; it may have several members."""
    at, stream = 0, zlib.decompressobj(31)
    while at < len(content):
        part = content[at : at + CHUNK]
        at += len(part)
        while part:
            yield stream.decompress(part)
            part = stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)


def split_records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, with the blank lines that end them, from a stream that is read once."""
    held = bytearray()

    def fill(n: int) -> bool:
        for part in stream:
            held.extend(part)
            if len(held) >= n:
                return True
        return len(held) >= n

    while True:
        head = held.find(b"\r\n\r\n")
        while head < 0:
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError(f"archive ends inside the head of a record: {bytes(held[:80])!r}")
                return
            head = held.find(b"\r\n\r\n")
        size = head + 4 + int(headers(bytes(held[:head]))["content-length"]) + 4
        if len(held) < size and not fill(size):
            raise ValueError(f"archive ends inside a record: {bytes(held[:80])!r}")
        yield bytes(held[:size])
        del held[:size]


def headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8", "replace").split(CRLF)[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member of one record, ending in a zero byte.

    The last byte of a member is the top byte of its content's length. For records of 16 MiB and more it need not be
    zero, so an empty member follows, which every reader of gzip skips.
    """

    def gzip(data: bytes) -> bytes:
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        return squeeze.compress(data) + squeeze.flush()

    out = gzip(record)
    return out if out[-1] == 0 else out + gzip(b"")


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each member with content; empty ones count to the one before."""
    at, found = 0, None
    while at < len(content):
        begin, raw, stream = at, [], zlib.decompressobj(31)
        while not stream.eof and at < len(content):
            part = content[at : at + CHUNK]
            raw.append(stream.decompress(part))
            at += len(part) - len(stream.unused_data)
        if not stream.eof:
            raise ValueError(f"archive ends inside the member at {begin}")
        data = b"".join(raw)
        if data or not found:
            if found:
                yield found
            found = (begin, at - begin, data)
        else:
            found = (found[0], at - found[0], found[2])
    if found:
        yield found


def entry(file: str, offset: int, length: int, record: bytes) -> dict:
    """What the index says about a record; its payload's length and digest are taken from the bytes read."""
    head, _, rest = record.partition(b"\r\n\r\n")
    field, block = headers(head), rest[:-4]
    said, size = field["warc-payload-digest"].removeprefix("sha256:"), int(field["x-payload-length"])

    def page(name: str) -> int | None:
        number = field.get(name, "").removeprefix(f"<{ID}").removesuffix(">")
        return int(number) if number else None

    if field["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        digest = hashlib.sha256(payload).hexdigest()
        intact, size, said = (digest, len(payload)) == (said, size), len(payload), digest
    else:
        intact = block == HTTP_HEAD.encode()
    return {
        "file": file, "offset": offset, "length": length, "page_id": page("warc-record-id"),
        "target_uri": field.get("warc-target-uri"), "record_type": field["warc-type"],
        "refers_to": page("warc-refers-to"), "payload_bytes": size, "payload_digest": said, "intact": intact,
    }


# ---- jobs ---------------------------------------------------------------------------------------------


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole files, one a row: an archive must fit a task, and the writers keep it to about an advised partition."""
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def rewrite_members(spark: SparkSession, source: str, target: str, level: int = 6) -> None:
    """Read each file's stream once and write its records as members of their own.

    The text writer puts the last byte of each member, a zero, as its line end. So the members lie in a file without
    anything between them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                held, size = [], 0
                for record in split_records(inflate(content.as_py())):
                    held.append(member(record, level)[:-1])
                    size += len(held[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
                        held, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])

    out = _files(ready(spark), source).mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    out.write.option("lineSep", "\u0000").text(target)


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """One row a member of the archives in a folder, found by reading them back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[t]) for n, t in map(str.split, INDEX.split(", "))]
        )
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = path.rpartition("/")[2]
                rows = []
                for offset, length, record in members(content.as_py()):
                    rows.append(entry(name, offset, length, record))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _files(ready(spark), folder).mapInArrow(run, INDEX)


def normalise(spark: SparkSession, source: str, target: str, index: str, level: int = 6) -> DataFrame:
    """Archives of one stream each, rewritten by record, with a sidecar index (Parquet) of where each record lies."""
    rewrite_members(spark, source, target, level)
    index_of(spark, target).write.parquet(index)
    return spark.read.parquet(index)


def archive(pages: DataFrame, folder: str | None = None, least: int = 100) -> DataFrame:
    """Write ``pages`` as archives below a folder and return their index: one row a page.

    Below the folder, ``monolithic`` has the archives as written first, ``records`` those with a member a record and
    ``index`` the sidecar. Without a folder they go to a new one in the shared scratch folder.
    """
    spark = pages.sparkSession
    folder = folder or f"{scratch(spark)}/warc-{uuid.uuid4().hex}"
    write_monolithic(pages, f"{folder}/monolithic", least)
    return normalise(spark, f"{folder}/monolithic", f"{folder}/records", f"{folder}/index")
