"""WARC archives of pages, a two-level capture index over them, and reads by range.

Archives are real `.warc.gz` files, one gzip member per record, written by the executors through `pyarrow.fs` into a folder that
all of them share. The index holds captures sorted by reversed-host key in compressed blocks; a sparse directory
has the first key of every k-th block, with k chosen so that it never has more than `MOST_DIRECTORY` rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain, groupby
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.sources.paths import file_system, scratch, stored

ARCHIVE_BYTES = 64 << 20
BLOCK_ENTRIES = 1024
MOST_DIRECTORY = 65_536
READ_BYTES = 8 << 20
#: What one task reads back.
TASK_BYTES = 16 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

ENTRIES = "key string, file string, offset long, length long"
BLOCKS = "first_key string, last_key string, entries int, part int, place int, block binary"


class CaptureIndex(NamedTuple):
    """The stored blocks, each with the number of its directory group, and the first keys of the groups."""

    blocks: DataFrame
    directory: list[str]


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest: five hexadecimal digits make four signs."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def surt(url: str | None) -> str:
    """Reversed-host key of a URL: no scheme, user, default port or fragment; path and query as they are, runs of white space as a blank."""
    text = " ".join((url or "").split())
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return text
    if not host:
        return text
    named = ",".join(reversed(host.rstrip(".").split(".")))
    shown = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    return f"{named}{shown}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to.

    Of equal payloads the largest page_id is the response (each of its rows, if the row is repeated); a null page_id never
    answers for others. Equal payloads are found by digest and length, reduced before the shuffle; a digest with a third of all pages is
    split by the adaptive join.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn(
        "payload_digest", base32_sha1(F.col("payload"))).withColumn("_bytes", F.octet_length("payload"))
    keepers = base.groupBy("payload_digest", "_bytes").agg(F.max("page_id").alias("_keeper"))
    typed = base.join(keepers, ["payload_digest", "_bytes"])
    own = F.col("_keeper").isNull() | F.col("page_id").eqNullSafe(F.col("_keeper"))
    return typed.select("page_id", "url", "payload", "payload_digest", F.when(own, "response").otherwise("revisit").alias("record_type"),
                        F.when(~own, F.col("_keeper")).alias("refers_to"))


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(str(page_id).encode()).hexdigest())}>"


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record. A revisit has the HTTP header of its page, with the full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names, with the HTTP length as http-length) and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    for line in http.decode().split("\r\n"):
        name, _, value = line.partition(":")
        if name.lower() == "content-length":
            fields["http-length"] = value.strip()
    return fields, payload


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page and returns where each one is (ENTRIES), as a stored table.

    A task attempt writes files of its own names, and only files of attempts that Spark committed are named in the table, so
    lost executors leave no wrong rows, at most files that nothing refers to.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, name, size = None, "", 0
        for batch in batches:
            keys, files, offsets, lengths = [], [], [], []
            # A few rows at a time become Python values, so that payloads are not held several times over.
            for row in chain.from_iterable(batch.slice(i, 32).to_pylist() for i in range(0, batch.num_rows, 32)):
                if out is None or size > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                data = gzip.compress(record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["record_type"],
                                            row["refers_to"]), LEVEL, mtime=0)
                out.write(data)
                keys.append(surt(row["url"]))
                files.append(name)
                offsets.append(size)
                lengths.append(len(data))
                size += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    return stored(with_record_types(pages).mapInArrow(write, ENTRIES), "captures")


def _block(rows: list[tuple]) -> bytes:
    return zlib.compress("\n".join(f"{k}\t{f}\t{o}\t{n}" for k, f, o, n in rows).encode(), 6)


def _lines(block: bytes) -> list[tuple[str, str, int, int]]:
    rows = (x.rsplit("\t", 3) for x in zlib.decompress(block).decode().split("\n"))
    return [(k, f, int(o), int(n)) for k, f, o, n in rows]


def build_index(captures: DataFrame) -> CaptureIndex:
    """Sorts the captures into blocks and takes the sparse directory from the blocks' first keys.

    Rows are ranged by key, file and offset, so a URL with many captures is spread over many blocks and tasks.
    """
    order = ["key", "file", "offset"]
    parts = max(1, -(-captures.count() // (64 * BLOCK_ENTRIES)))
    ranged = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        place = 0

        def made(rows: list[tuple], part: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[0][0]]), pa.array([rows[-1][0]]), pa.array([len(rows)], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([place], pa.int32()), pa.array([_block(rows)], pa.binary())],
                ["first_key", "last_key", "entries", "part", "place", "block"])

        part = 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            waiting += zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            while len(waiting) >= BLOCK_ENTRIES:
                yield made(waiting[:BLOCK_ENTRIES], part)
                place += 1
                del waiting[:BLOCK_ENTRIES]
        if waiting:
            yield made(waiting, part)

    table = stored(ranged.mapInArrow(blocks, BLOCKS), "blocks")
    counts = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.count("*").alias("n")).toLocalIterator()}
    total = sum(counts.values())
    stride = max(1, -(-total // MOST_DIRECTORY))
    first, before = [], 0
    for part in sorted(counts):
        first.append((part, before))
        before += counts[part]
    starts = table.sparkSession.createDataFrame(first or [(0, 0)], "part int, before long")
    # One row per range of the index.
    numbered = table.join(F.broadcast(starts), "part").withColumn("number", F.col("before") + F.col("place")).withColumn(
        "bucket", F.floor(F.col("number") / stride)).drop("before", "part", "place")
    directory = [r["k"] for r in numbered.where(F.col("number") % stride == 0).orderBy("number").select(
        F.col("first_key").alias("k")).collect()]
    return CaptureIndex(numbered, directory)


def lookup(index: CaptureIndex, urls: DataFrame, url: str = "url") -> DataFrame:
    """Captures (ENTRIES) of the given URLs, each once.

    A key is looked for in the directory by bisection, which names the groups of blocks to read; in a block it is found
    by bisection again.
    """
    sent = urls.sparkSession.sparkContext.broadcast(index.directory)

    def to_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = sent.value
        for batch in batches:
            keys, buckets = [], []
            for key in {surt(u) for u in batch.column(0).to_pylist()}:
                # Captures of one key may begin in the group before the first one that starts with it.
                for b in range(max(0, bisect_left(directory, key) - 1), bisect_right(directory, key)):
                    keys.append(key)
                    buckets.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(buckets, pa.int64())], ["wanted", "bucket"])

    wanted = urls.select(F.col(url).cast("string")).mapInArrow(to_buckets, "wanted string, bucket long").distinct()
    near = wanted.join(index.blocks.drop("block", "entries"), "bucket").where(
        (F.col("first_key") <= F.col("wanted")) & (F.col("wanted") <= F.col("last_key")))
    asked = near.groupBy("number").agg(F.collect_list("wanted").alias("wanted")).join(index.blocks.select("number", "block"), "number")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wanted_keys, block in zip(batch.column("wanted").to_pylist(), batch.column("block").to_pylist(), strict=True):
                rows = _lines(block)
                keys = [r[0] for r in rows]
                hits = [r for k in wanted_keys for r in rows[bisect_left(keys, k):bisect_right(keys, k)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h[0] for h in hits], pa.string()), pa.array([h[1] for h in hits], pa.string()),
                     *(pa.array([h[i] for h in hits], pa.int64()) for i in (2, 3))], ["key", "file", "offset", "length"])

    return asked.select("wanted", "block").mapInArrow(search, ENTRIES)


def read_captures(captures: DataFrame, folder: str, id_type: str) -> DataFrame:
    """Reads records by range: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Ranges of a file are read in order, and neighbours together up to `READ_BYTES`. The number of tasks follows from the bytes to be
    read, as the table of captures is small beside them. The payload of a response must have the digest
    that its header names.
    """
    captures = stored(captures, "wanted")
    parts = max(1, -(-(captures.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    spread = captures.repartition(int(parts), "file", F.floor(F.col("offset") / (4 * READ_BYTES))).sortWithinPartitions("file", "offset")
    schema = (f"page_id {id_type}, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}, "
              "payload binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from base64 import b32encode

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            for name, own in groupby(rows, key=lambda r: r[0]):
                with system.open_input_file(f"{root}/{name}") as file:
                    for start, data, ranges in _joined_reads(file, [r[1:] for r in own]):
                        out: list[tuple] = []
                        for offset, length in ranges:
                            fields, payload = parse_record(gzip.decompress(data[offset - start:offset - start + length]))
                            digest = fields["warc-payload-digest"].removeprefix("sha1:")
                            response = fields["warc-type"] == "response"
                            if response and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"{name} at {offset}: payload and digest differ")
                            out.append((fields.get("x-page"), int(fields["http-length"]), digest, fields["warc-type"],
                                        fields.get("x-refers-to-page"), payload if response else None))
                        columns = list(zip(*out, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), *(pa.array(columns[i], pa.string()) for i in (2, 3, 4)),
                             pa.array(columns[5], pa.binary())],
                            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    text = schema.replace(f"page_id {id_type}", "page_id string").replace(f"refers_to {id_type}", "refers_to string")
    got = spread.mapInArrow(read, text)
    return got.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _joined_reads(file, ranges: list[tuple[int, int]]) -> Iterator[tuple[int, bytes, list[tuple[int, int]]]]:
    """Reads that cover neighbouring ranges, with the ranges that lie in each."""
    own: list[tuple[int, int]] = []
    for offset, length in ranges:
        if own and (offset != sum(own[-1]) or offset + length - own[0][0] > READ_BYTES):
            yield own[0][0], file.read_at(sum(own[-1]) - own[0][0], own[0][0]), own
            own = []
        own.append((offset, length))
    if own:
        yield own[0][0], file.read_at(sum(own[-1]) - own[0][0], own[0][0]), own


def archive_pages(spark: SparkSession, pages: DataFrame) -> tuple[CaptureIndex, str]:
    """Writes the pages to archives in a new shared folder and indexes them."""
    folder = shared_address(spark, scratch(spark, "warc"))
    return build_index(write_archives(pages, folder)), folder


#: Schemes of Hadoop and what pyarrow calls the same store; all others of pyarrow's have one name in both. Fixed values.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
KNOWN_SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs")


def shared_address(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark itself would use for it, so that archives go where stored tables go."""
    fs, path = file_system(spark, folder)
    scheme, rest = fs.makeQualified(path).toString().split(":", 1)
    scheme = SCHEMES.get(scheme, scheme)
    if scheme not in KNOWN_SCHEMES:
        raise ValueError(f"archives cannot be written to {scheme}: spark.checkpoint.dir must lie in one of {', '.join(KNOWN_SCHEMES)}")
    return f"{scheme}:{rest}" if rest.startswith("//") else f"{scheme}://{rest}"


def round_trip(pages: DataFrame) -> DataFrame:
    """Every page's record, written, found by its URL in the index, and read back.

    An empty table gives no rows; null URLs share the empty key, null html is an empty payload, and repeated rows give a record each.
    """
    index, folder = archive_pages(pages.sparkSession, pages)
    captures = lookup(index, pages.select("url"))
    return read_captures(captures, folder, pages.schema["page_id"].dataType.simpleString()).drop("payload")


#: DuckDB SQL for the query, but for the digest's base32, which it takes from the SHA-1 in hexadecimal.
WARC_SQL = """
with p as (select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages),
k as (select h, strlen(t) as n, max(page_id) as keeper from p group by all),
d as (select p.*, keeper, strlen(t) as payload_bytes, list_transform(range(32), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || p.h[1 + 5 * (i // 4) : 5 + 5 * (i // 4)])::bigint >> (15 - 5 * (i % 4))) & 31)::int]) as s
      from p join k on p.h = k.h and strlen(p.t) = k.n)
select page_id, payload_bytes, array_to_string(s, '') as payload_digest,
       case when keeper is null or page_id is not distinct from keeper then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from keeper then keeper end as refers_to
from d"""
