"""WARC archives: one gzip member per record, read back by byte ranges.

Writing: each task writes one archive to the shared folder, under a name of
its own first and then moved into place, so a task that runs twice leaves one
whole file. Reading: archives are cut into byte ranges, whatever is in them. A
task looks for the gzip magic in its range, inflates a candidate far enough to
see a WARC header, and owns every record that starts inside its range, reading
past its end to finish the last one.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm.common import stored

MAGIC = b"\x1f\x8b\x08"
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


# -- records ------------------------------------------------------------------


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    value = record_id.strip("<>").rpartition(":")[2]
    return int(value) if value.lstrip("-").isdigit() else None


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One response, or a revisit of ``refers_to`` without the payload, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n") + pack.compress(block + b"\r\n\r\n") + pack.flush()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def decode_record(data: bytes) -> dict:
    """The parts of one inflated record; ``payload`` is None for a revisit."""
    head, end, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    if not end or "content-length" not in warc:
        raise ValueError("WARC record without a whole header")
    block = rest[: int(warc["content-length"])]
    if len(block) != int(warc["content-length"]):
        raise ValueError("WARC record ends early")
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    return {
        "page_id": _page(warc["warc-record-id"]),
        "url": warc.get("warc-target-uri"),
        "record_type": warc["warc-type"],
        "payload": None if revisit else payload,
        "http_length": int(_fields(http).get("content-length", len(payload))),
        "header_digest": warc.get("warc-payload-digest", "").partition(":")[2],
        "refers_to": _page(warc["warc-refers-to"]) if revisit else None,
    }


# -- reading ------------------------------------------------------------------


def _member(read, at: int) -> tuple[bytes, int] | None:
    """The inflated record of the gzip member at ``at`` and where it ends; None if none starts there."""
    inflate, out, pos, sure = zlib.decompressobj(31), [], at, False
    while not inflate.eof:
        data = read(pos, 16 << 10 if not sure else READ_BYTES)
        if not data:
            if sure:
                raise ValueError(f"WARC member at byte {at} ends early")
            return None
        try:
            out.append(inflate.decompress(data))
        except zlib.error:
            if sure:
                raise
            return None
        pos += len(data)
        if not sure:
            # What begins like a record is one, however long its header is: it ends properly or is an error.
            start = b"".join(out)
            sure = start.startswith(b"WARC/1.")
            if not sure and (inflate.eof or not b"WARC/1.".startswith(start)):
                return None
    return b"".join(out), pos - len(inflate.unused_data)


def records_in(read, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of every member that starts in [start, end). ``read(at, n)`` gives up to n bytes."""
    pos = start
    while pos < end:
        window = read(pos, min(READ_BYTES, end - pos) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0 or pos + hit >= end:
            if len(window) < len(MAGIC):
                return
            pos += len(window) - len(MAGIC) + 1
            continue
        pos += hit
        found = _member(read, pos)
        if found is None:
            pos += 1
        else:
            yield pos, found[0]
            pos = found[1]


_READ = "page_id long, url string, record_type string, payload binary, http_length long, header_digest string, refers_to long, path string, start long"


def read_archives(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per record of the ``*.warc.gz`` files in ``folder``; an empty folder gives no rows.

    Spark lists the files and cuts them into ranges of ``split_bytes``; each
    range is read by a task of its own. ``payload`` is null for revisits.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(folder).select("path", "length").filter("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start"))
    tasks = max(1, files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("http_length", pa.int64()), ("header_digest", pa.string()), ("refers_to", pa.int64()), ("path", pa.string()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = file_system(path)
                with fs.open_input_file(name) as f:
                    rows, held = [], 0
                    for at, data in records_in(lambda at, n: f.read_at(n, at) if at < length else b"", start, min(start + split_bytes, length)):
                        rows.append(decode_record(data) | {"path": path, "start": at})
                        held += len(data)
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.select("path", "length", "start").repartition(tasks, "path", "start").mapInArrow(run, _READ)


# -- writing ------------------------------------------------------------------


def _payload(col: str) -> Column:
    return F.encode(F.coalesce(F.col(col).cast("string"), F.lit("")), "UTF-8")


def revisits(df: DataFrame, id_col: str, html_col: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, first): pages whose payload of ``least_bytes`` or more a page of smaller id has too."""
    slim = df.select(F.col(id_col).cast("long").alias("page_id"), _payload(html_col).alias("p")).filter(F.octet_length("p") >= least_bytes).select("page_id", F.sha2("p", 256).alias("digest"))
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last").select("digest", "first")
    return slim.join(firsts, "digest").filter("page_id > first").groupBy("page_id", "digest").agg(F.min("first").alias("first"))


def write_archives(df: DataFrame, folder: str, id_col: str, url_col: str, html_col: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``df`` as one WARC file per task under ``folder``; returns (path, records, bytes) per file.

    Null html is an empty payload; a null URL leaves out its field. Pages
    without an id, and all pages that share the smallest id of a payload, are
    responses. URLs and payloads of any length are kept whole; a record is one
    member, and a task holds one at a time. An empty table writes no file.
    """
    fs, name = file_system(folder)
    fs.create_dir(name, recursive=True)
    known = stored(revisits(df, id_col, html_col, least_bytes), "warc-revisits")
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), _payload(html_col).alias("payload"))
    pages = pages.withColumn("digest", F.sha2("payload", 256)).join(known, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, name = file_system(folder)
        final = f"{name}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        own, out, rows, size = f"{name}/.{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:2]] + [batch.column(2)] + [c.to_pylist() for c in batch.columns[3:]]
            for page_id, url, payload, digest, first in zip(*columns):
                out = out or fs.open_output_stream(own)
                member = encode_record(page_id, url, payload.as_py(), digest, first)
                out.write(member)
                rows, size = rows + 1, size + len(member)
        if out is not None:
            out.close()
            fs.move(own, final)
            yield pa.RecordBatch.from_pydict({"path": [final], "records": [rows], "bytes": [size]})

    return stored(pages.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")
