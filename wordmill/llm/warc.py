"""WARC archives: whole-file gzip streams, and what normalises them.

Writing: every page becomes a record; the rows of a task go into one file that is one gzip
stream, which Spark's own text writer produces, as a record ends in the same bytes every time.
Such a file can only be read from its start.

Normalising: a file is inflated once, as a stream, and every record is written again as a gzip
member of its own. A sidecar names the offset and length of each member, so that any record can
be read by itself. Only one record is in memory at a time.

Reading: the sidecars are the index; tasks read the members they name.

Files are opened through the file system that their path names, so the folder has to be one that
all executors reach, as ``spark.checkpoint.dir`` is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordmill.sources.checkpoints import kept_path, materialise

# The version line, line ends, what ends a record, the least payload that can be
# revisited, and the date that archives carry, since pages have none.
VERSION = "WARC/1.1"
LINE = "\r\n"
RECORD_END = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SIDECAR = ".idx"

_CHUNK = 1 << 20


def _urn(key: Column) -> Column:
    """A record id that is always the same for the same key."""
    h = F.md5(key)
    parts = [F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to, revisit`` of all pages.

    Of equal payloads the row with the least page_id, then the least url, is the response; of
    rows that agree in all three one is. Rows without a page_id come last.
    """
    plain = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    measured = plain.select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha2("html", 256).alias("payload_digest")
    )
    who = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    counted = measured.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy("payload_digest", "page_id", "url").agg(F.count("*").alias("n"))
    firsts = counted.groupBy("payload_digest").agg(F.min(who).alias("first"), F.min_by("n", who).alias("tied"), F.sum("n").alias("n"))
    groups = firsts.where("n > 1").select(
        "payload_digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"), "tied"
    )
    groups = materialise(groups.withColumn("grouped", F.lit(True)), "payloads")
    first = F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("url") == F.col("refers_url"))
    joined = measured.join(groups, "payload_digest", "left").withColumn("revisit", F.col("grouped").isNotNull() & ~first)
    if groups.where("tied > 1").isEmpty():
        return joined
    equal = (F.col("tied") > 1) & ~F.col("revisit")
    no = F.row_number().over(Window.partitionBy("payload_digest").orderBy("url"))
    one = joined.where(equal).withColumn("revisit", no > 1)
    return joined.where(~F.coalesce(equal, F.lit(False))).unionByName(one)


def _record(pages: DataFrame) -> Column:
    """A record without its end, as text."""
    revisit = F.col("revisit")
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_bytes"),
        F.lit(LINE + LINE),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    refers = F.when(
        revisit,
        F.concat(
            F.lit(f"WARC-Profile: {PROFILE}{LINE}WARC-Refers-To: "),
            _urn(F.concat_ws(":", F.lit("page"), F.coalesce(F.col("refers_to").cast("string"), F.lit("none")))),
            F.lit(f"{LINE}X-Refers-To-Page: "),
            F.coalesce(F.col("refers_to").cast("string"), F.lit("none")),
            F.lit(LINE),
        ),
    ).otherwise("")
    # A header is one line, whatever the url holds.
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    return F.concat(
        F.lit(f"{VERSION}{LINE}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{LINE}WARC-Record-ID: "),
        _urn(F.concat_ws(":", F.lit("page"), number)),
        F.lit(f"{LINE}WARC-Date: {DATE}{LINE}WARC-Target-URI: "),
        uri,
        F.lit(f"{LINE}X-Page: "),
        number,
        F.lit(f"{LINE}WARC-Payload-Digest: sha256:"),
        F.col("payload_digest"),
        F.lit(LINE),
        refers,
        F.lit(f"Content-Type: application/http; msgtype=response{LINE}Content-Length: "),
        F.octet_length(block),
        F.lit(LINE + LINE),
        block,
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write all pages to archives at ``path``, each file one gzip stream."""
    records = with_revisits(pages).select(_record(pages).alias("value"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").mode("overwrite").text(path)


def _open(path: str):
    """The file system of a path or URI, and the path within it."""
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


class _Inflated:
    """Bytes of a gzip file with one or more members, read as a stream."""

    def __init__(self, stream):
        self.stream, self.inflate, self.buffer, self.raw = stream, zlib.decompressobj(31), bytearray(), b""

    def _more(self) -> bool:
        while True:
            if self.inflate.eof:
                self.raw = self.inflate.unused_data + self.raw
                self.inflate = zlib.decompressobj(31)
            self.raw = self.raw or self.stream.read(_CHUNK)
            if not self.raw:
                return False
            found = self.inflate.decompress(self.raw, 4 * _CHUNK)
            self.raw = self.inflate.unconsumed_tail
            if found:
                self.buffer += found
                return True

    def take(self, n: int) -> bytes:
        """The next n bytes, or as many as there are."""
        while len(self.buffer) < n and self._more():
            pass
        found = bytes(self.buffer[:n])
        del self.buffer[:n]
        return found

    def until(self, end: bytes) -> bytes:
        """All up to and with ``end``; nothing at the end of the file."""
        seen = 0
        while (at := self.buffer.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                return self.take(len(self.buffer))
        return self.take(at + len(end))


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split(LINE)[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def _records(stream) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """Head, headers and block of each record of a gzip stream."""
    inflated, end = _Inflated(stream), RECORD_END.encode()
    while head := inflated.until(end):
        headers = _headers(head)
        size = int(headers["Content-Length"])
        block = inflated.take(size)
        if len(block) < size or inflated.take(len(end)) != end:
            raise ValueError(f"a record breaks off after {headers.get('WARC-Record-ID')}")
        yield head, headers, block


def _normalise(target: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path in rows["path"]:
                yield pd.DataFrame(_rewrite(path, f"{target}/{path.rsplit('/', 1)[1]}"), columns=["file", "at", "size", "record_id"])

    return run


def _rewrite(path: str, to: str) -> list[tuple]:
    """Rewrite one archive with a member per record and a sidecar; its index.

    Both are written beside their place and moved there, so that a task that runs twice leaves
    whole files.
    """
    source, name = _open(path)
    fs, out = _open(to)
    part, index, at = f"{out}.{uuid.uuid4().hex}.tmp", [], 0
    with source.open_input_stream(name, compression=None) as stream, fs.open_output_stream(part, compression=None) as sink:
        for head, headers, block in _records(stream):
            deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = deflate.compress(head + block + RECORD_END.encode()) + deflate.flush()
            sink.write(member)
            index.append((to, at, len(member), headers["WARC-Record-ID"]))
            at += len(member)
    with fs.open_output_stream(part + SIDECAR, compression=None) as sink:
        for _, start, size, record_id in index:
            sink.write((json.dumps({"record_id": record_id, "at": start, "size": size}) + "\n").encode())
    fs.move(part, out)
    fs.move(part + SIDECAR, out + SIDECAR)
    return index


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The archives at a path, a row each; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "length")


def normalise(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Rewrite the archives at ``path`` into the folder ``target``: ``file, at, size, record_id``.

    Each archive gets a member per record and a sidecar ``<archive>.idx`` of JSON lines with the
    offset, size and id of each member. An archive is one task's work, as a gzip stream can only
    be inflated from its start.
    """
    fs, folder = _open(target)
    fs.create_dir(folder, recursive=True)
    files = materialise(_files(spark, path), "archives")
    count = max(1, files.count())
    each = files.select("path").repartition(count)
    return materialise(each.mapInPandas(_normalise(target), "file string, at long, size long, record_id string"), "index")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = []
        for file, members in rows.groupby("file", sort=False):
            fs, name = _open(file)
            with fs.open_input_file(name) as archive:
                for at, size in zip(members["at"].tolist(), members["size"].tolist()):
                    archive.seek(at)
                    found.append(_page(archive.read(size)))
        yield pd.DataFrame(found, columns=["page", "type", "bytes", "digest", "refers"])


def _page(member: bytes) -> tuple:
    """What a record says of its page; a response's payload is measured, a revisit's is cited."""
    (_, headers, block), = _records(pa.BufferReader(member))
    http, payload = block.split((LINE + LINE).encode(), 1)
    cited = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "revisit":
        return headers["X-Page"], "revisit", int(_headers(http)["Content-Length"]), cited, headers["X-Refers-To-Page"]
    digest = hashlib.sha256(payload).hexdigest()
    if digest != cited:
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not what was written")
    return headers["X-Page"], "response", len(payload), digest, None


def read_archives(spark: SparkSession, index: DataFrame) -> DataFrame:
    """One row per record of an index: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    read = index.select("file", "at", "size").mapInPandas(_read, "page string, type string, bytes long, digest string, refers string")
    number = lambda name: F.when(F.col(name) != "none", F.col(name).cast("long"))
    return read.select(
        number("page").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers").alias("refers_to"),
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder, normalise them and read all records back.

    One row per page. Null html is an empty payload, null urls are empty, rows without a page_id
    keep none. Repeated rows are records of their own; of equal payloads one is the response.
    An empty table gives an empty result. Other columns are not read.
    """
    spark = pages.sparkSession
    raw, normal = kept_path(spark, "warc-streams"), kept_path(spark, "warc")
    write_archives(pages, raw)
    return read_archives(spark, normalise(spark, raw, normal))


SQL = f"""
  WITH measured AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
  ), firsts AS (
    SELECT payload_digest, min(page_id) AS first FROM measured WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY payload_digest
  )
  SELECT page_id, payload_bytes, payload_digest,
         CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN first <> page_id THEN first END AS refers_to
  FROM measured LEFT JOIN firsts USING (payload_digest)"""
