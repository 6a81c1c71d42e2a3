"""WARC archives with a two-level capture index.

Writing: every page becomes one gzip member of a WARC 1.1 file, a response with
its payload or, when a page of a larger id has the same payload, a revisit that
refers to that page. Files are written by the tasks straight to the shared
folder; a task that runs again writes new files, and only the files named in the
committed index rows are ever read.

Index, level one: capture lines sorted by (reversed-host URL key, page id),
range-partitioned into shards and compressed in blocks of ``block_lines`` lines.
Level two: each shard's sparse directory, one (first key, offset, length) a
block, beside the shard; the shards' own first keys (as many as the session's
shuffle partitions) are the only part that every task gets.

Reading: a key is binary-searched in the shards' first keys and the shard's
directory, the matching blocks are range-read and decompressed, and each found
capture is range-read from its archive in file order. Several blocks of one key
are separate rows, so a key with most captures is no single task.

Folders are reached through ``pyarrow.fs``, which covers local, HDFS and object
stores by URI. A folder without a scheme is qualified by the session's default file
system first, as Spark's own writes are. Payloads of any length are one record; a task
holds one at a time.

Defined results: a null html is an empty payload; a null URL has the empty key;
rows that share both payload and the largest id are all responses, as a payload
whose rows have no id; repeated rows are captures of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm.common import shared_folder, values, written

#: Fixed date of the records: an archive of the same pages is the same bytes.
CAPTURED = "2024-01-01T00:00:00Z"
CONFORMS = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK_LINES = 512
FILE_BYTES = 256 << 20
READ_AHEAD = 4 << 20


def url_key(url: str | None) -> str:
    """Sort key: host labels reversed, then port, path and query: ``org,example)/a?b``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return re.sub(r"\s", "%20", url.strip())
    key = ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return re.sub(r"\s", "%20", key)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the file system that Spark's own writes would take for it (``fs.defaultFS`` if it names none)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """A qualified folder's file system and path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:(//)?", "", uri)
    return fs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """A URL as a header can carry it."""
    return quote(text, safe="!#$%&'()*+,/:;=?@[]~-._")


def record(page_id, url: str | None, payload: bytes, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, whose Content-Length is the full payload's, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        CONFORMS,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {_header_value(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Headers of a record, its payload's size and digest, checked against the payload where there is one."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: (m := re.search(r"urn:page:(-?\d+)>", fields.get(name, ""))) and int(m[1])
    return {
        "page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number("WARC-Refers-To"), "payload": payload,
    }


class _Archive:
    """A task's current output file; a new one is begun at ``FILE_BYTES``."""

    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix, self.out = folder, suffix, None

    def append(self, data: bytes) -> tuple[str, int]:
        if self.out is None or self.at + len(data) > FILE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}{self.suffix}", 0
            system, path = opened(self.folder)
            system.create_dir(path, recursive=True)
            self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.out.write(data)
        place = (self.name, self.at)
        self.at += len(data)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _write_batches(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, refers_to, revisit) -> capture lines (key, page_id, file, offset, length)."""
    archive = _Archive(folder, ".warc.gz")
    for batch in batches:
        lines = []
        for page, url, html, refers, revisit in zip(*(values(c) for c in batch.columns), strict=True):
            payload = (html or "").encode()
            data = gzip.compress(record(page, url, payload, len(payload), base32_sha1(payload), refers, revisit), 6, mtime=0)
            lines.append((url_key(url), page, *archive.append(data), len(data)))
        columns = list(zip(*lines, strict=True)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "page_id", "file", "offset", "length"]
        )
    archive.close()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every page below ``folder``; the capture lines, written too.

    Payload classes are found on digests alone. The one shuffle of payloads
    joins each page with its class by (digest, id), which spreads a payload
    that most pages share.
    """
    folder = qualified(pages.sparkSession, folder)
    narrow = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).select(
        "page_id", F.sha1(F.encode("html", "UTF-8")).alias("digest")
    )
    classes = narrow.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    # only pages whose payload occurs again under a larger id
    revisits = written(
        narrow.join(classes, "digest").where("page_id IS NULL OR page_id < first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct(),
        "revisits",
    )
    rows = (
        pages.select("page_id", "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest"))
        .alias("p")
        .join(revisits.alias("r"), F.expr("p.page_id <=> r.page_id AND p.digest = r.digest"), "left")
        .select(F.col("p.page_id").cast("long").alias("page_id"), "url", "html", F.col("refers_to").cast("long").alias("refers_to"), F.col("refers_to").isNotNull().alias("revisit"))
    )
    lines = rows.mapInArrow(partial(_write_batches, f"{folder}/archive"), "key string, page_id long, file string, offset long, length long")
    return written(lines, "captures")


def _index_batches(folder: str, block_lines: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted capture lines -> one compressed shard with its directory; a row names the shard and its first key."""
    name, first, directory, block, at = uuid.uuid4().hex, None, [], [], 0
    out = system = path = None

    def flush():
        nonlocal block, at
        data = zlib.compress("\n".join(block).encode())
        directory.append(f"{block[0].split(' ', 1)[0]} {at} {len(data)}")
        out.write(data)
        at += len(data)
        block = []

    for batch in batches:
        for key, page, file, offset, length in zip(*(values(c) for c in batch.columns), strict=True):
            if out is None:
                system, path = opened(folder)
                system.create_dir(path, recursive=True)
                out, first = system.open_output_stream(f"{path}/{name}.blocks"), key
            block.append(f"{key} {page} {file} {offset} {length}")
            if len(block) == block_lines:
                flush()
    if out is None:
        return
    if block:
        flush()
    out.close()
    with system.open_output_stream(f"{path}/{name}.directory") as f:
        f.write(zlib.compress("\n".join(directory).encode()))
    yield pa.RecordBatch.from_arrays([pa.array([first], pa.string()), pa.array([name]), pa.array([len(directory)], pa.int64())], ["first", "shard", "blocks"])


def write_index(lines: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """The sorted, compressed index of capture lines below ``folder``; (first, shard, blocks) of each shard, written."""
    folder = qualified(lines.sparkSession, folder)
    shards = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(shards, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    return written(
        ordered.select("key", "page_id", "file", "offset", "length").mapInArrow(
            partial(_index_batches, f"{folder}/index", block_lines), "first string, shard string, blocks long"
        ),
        "shards",
    )


@lru_cache(maxsize=64)
def _directory(folder: str, shard: str) -> tuple[list[str], list[tuple[int, int]]]:
    system, path = opened(folder)
    with system.open_input_stream(f"{path}/{shard}.directory") as f:
        rows = [x.rsplit(" ", 2) for x in zlib.decompress(f.read()).decode().split("\n")]
    return [k for k, _, _ in rows], [(int(a), int(n)) for _, a, n in rows]


def run_of(firsts: list[str], key: str) -> range:
    """The runs (sorted, each known by its first key) that may hold ``key``."""
    return range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key))


def _locate_batches(folder: str, shards, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys -> (shard, offset, length, key) of the blocks that may hold them."""
    firsts, names = shards.value
    for batch in batches:
        found = []
        for key in values(batch.column(0)):
            for i in run_of(firsts, key):
                keys, places = _directory(folder, names[i])
                found += [(names[i], *places[j], key) for j in run_of(keys, key)]
        columns = list(zip(*found, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "at", "size", "key"])


def _block_batches(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, at, size, key) in order -> capture places (file, offset, length) of the keys."""
    system, path = opened(folder)
    current, by_key, handle, open_shard = None, {}, None, None
    for batch in batches:
        found = []
        for shard, at, size, key in zip(*(values(c) for c in batch.columns), strict=True):
            if (shard, at) != current:
                if shard != open_shard:
                    handle, open_shard = system.open_input_file(f"{path}/{shard}.blocks"), shard
                by_key, current = {}, (shard, at)
                for line in zlib.decompress(handle.read_at(size, at)).decode().split("\n"):
                    k, _, file, offset, length = line.split(" ")
                    by_key.setdefault(k, []).append((file, int(offset), int(length)))
            found += by_key.get(key, ())
        columns = list(zip(*found, strict=True)) or [()] * 3
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "offset", "length"])


def _record_batches(folder: str, payloads: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Capture places in file order -> parsed records; neighbours are read in one range."""
    system, path = opened(folder)
    open_file, handle, held, held_at = None, None, b"", 0
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads
    for batch in batches:
        found = []
        for file, offset, length in zip(*(values(c) for c in batch.columns), strict=True):
            if file != open_file:
                handle, open_file, held = system.open_input_file(f"{path}/{file}"), file, b""
            if not (held_at <= offset and offset + length <= held_at + len(held)):
                held, held_at = handle.read_at(max(length, READ_AHEAD), offset), offset
            fields = parsed(gzip.GzipFile(fileobj=io.BytesIO(held[offset - held_at : offset - held_at + length])).read())
            found.append([fields[n] for n in names])
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def look_up(keys: DataFrame, shards: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of every capture of ``keys`` (one column, distinct URL keys), read back from the archives.

    ``shards``: one row an index shard, at most as many as shuffle partitions; their first keys are broadcast.
    """
    spark = keys.sparkSession
    folder = qualified(spark, folder)
    known = sorted((r.first, r.shard) for r in shards.select(F.col("first"), "shard").collect())
    # equal first keys: any order will do, all of them are searched
    shared = spark.sparkContext.broadcast(([k for k, _ in known], [s for _, s in known]))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # in key order a task needs few directories
    ordered = keys.repartitionByRange(n, keys.columns[0]).sortWithinPartitions(keys.columns[0])
    located = ordered.mapInArrow(partial(_locate_batches, f"{folder}/index", shared), "shard string, at long, size long, key string")
    blocks = located.repartition(n, "shard", "at").sortWithinPartitions("shard", "at")
    places = blocks.mapInArrow(partial(_block_batches, f"{folder}/index"), "file string, offset long, length long")
    runs = places.repartition(n, "file", F.floor(F.col("offset") / READ_AHEAD)).sortWithinPartitions("file", "offset")
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    return runs.mapInArrow(partial(_record_batches, f"{folder}/archive", payloads), kind)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives and index, look every URL key up and return all records found, one a page."""
    folder = shared_folder(pages.sparkSession, "warc")
    lines = write_archives(pages, folder)
    shards = write_index(lines, folder)
    return look_up(lines.select("key").distinct(), shards, folder)
