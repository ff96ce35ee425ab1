"""Deterministic sharded WARC writer and reader.

Records are sorted by page_id into shards whose boundaries are exact positions of the
payload bytes' running sum, so the same table gives the same files. Tasks roll files by
compressed size, one gzip member per record, with regenerated headers and digests. Equal
payloads of at least `min_revisit_bytes` are revisits of the one with the smallest page_id; what a revisit
refers to is found on digests alone, and reaches its record in the shard's sort.

Defined cases: null html is an empty payload; a null url is an empty target; rows with a null
page_id come first and are responses; rows that repeat page_id and payload are all responses if
the id is the smallest; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickerloom.llm.common import new_folder, ship, stored
from tickerloom.llm.shards import MANIFEST, Roll, commit, file_system, manifest_batch

ROLL_BYTES = 256 << 20
SHARD_BYTES = 64 << 20
RECORD_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest}'.encode()).digest()[:16])}>"


def one_line(text: str) -> str:
    return "".join(c if c not in "\r\n" else " " for c in text)


def record_bytes(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    digest = payload_digest(payload)
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Target-URI: {one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        headers.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        headers += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def parsed_record(raw: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of one record, digests checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    if headers["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("payload digest differs")
    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page")
    return int(page) if page else None, length, digest, headers["WARC-Type"], int(refers) if refers else None


def shard_starts(pages: DataFrame, shard_bytes: int) -> list[int]:
    """The page_ids at which the running sum of payload bytes passes a multiple of `shard_bytes`.

    One narrow range sort: sums per sorted slice, then the running sum inside each slice.
    The driver gets a row per slice and a row per shard.
    """
    sizes = pages.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(
        F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 512).alias("n"))
    ordered = stored(sizes.repartitionByRange("page_id").withColumn("slice", F.spark_partition_id()), "sizes")
    totals = sorted(ordered.groupBy("slice").agg(F.sum("n").alias("n")).collect())
    before, sum_ = {}, 0
    for row in totals:
        before[row["slice"]], sum_ = sum_, sum_ + row["n"]
    if not before:
        return []
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("slice"))
    running = F.sum("n").over(Window.partitionBy("slice").orderBy("page_id")) + offset
    passed = F.floor(running / shard_bytes) > F.floor((running - F.col("n")) / shard_bytes)
    rows = ordered.withColumn("passed", passed).where("passed").select("page_id").collect()
    return sorted(row["page_id"] for row in rows)


def _sharded(starts: list[int], width: int):
    """Adds the shard of a page_id (null: the first) as an Arrow column."""
    bounds = np.array(starts, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            shard = pa.array(np.searchsorted(bounds, known, side="left").astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    return run


def write_warc(
    pages: DataFrame, folder: str, min_revisit_bytes: int = 0, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Write the archives below `folder` and return their stored manifest."""
    spark = pages.sparkSession
    ship(spark)
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keys = stored(source.select("page_id", F.unhex(F.sha1("html")).alias("digest"), F.octet_length("html").alias("n")), "digests")
    firsts = stored(
        keys.where(F.col("n") >= min_revisit_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("refers_to").isNotNull()).select("digest", "refers_to"),
        "firsts",
    )
    revisits = keys.join(firsts, "digest").where(F.col("page_id") > F.col("refers_to")).select("page_id", "digest", "refers_to").distinct()
    nothing = F.lit(None)
    rows = source.select(
        "page_id", F.unhex(F.sha1("html")).alias("digest"), F.lit(1).alias("kind"), nothing.cast("long").alias("refers_to"), "url", "html"
    ).unionByName(
        revisits.select("page_id", "digest", F.lit(0).alias("kind"), "refers_to", F.lit("").alias("url"), F.lit("").alias("html"))
    )
    starts = shard_starts(source, shard_bytes)
    schema = rows.withColumn("shard", F.lit(0)).schema
    sharded = rows.mapInArrow(_sharded(starts, len(starts)), schema)
    # A whole number of shards per partition; the partitioner deals out shard numbers, one a task at most times.
    dealt = sharded.repartition(len(starts) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", "kind")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        revisit = None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["page_id"], row["digest"])
                if row["kind"] == 0:
                    revisit = (key, row["refers_to"])
                else:
                    yield row["shard"], row["page_id"], row["url"], row["html"], revisit[1] if revisit and revisit[0] == key else None

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for shard, group in groupby(records(batches), key=lambda r: r[0]):
            out = None
            for _, page_id, url, html, refers_to in group:
                if out is None or out.n_bytes >= roll_bytes:
                    part = 0 if out is None else out.part + 1
                    if out is not None:
                        done.append(out.close())
                    out = Roll(folder, shard, part, ".warc.gz")
                out.write(member(record_bytes(page_id, url, html.encode(), refers_to)))
            done.append(out.close())
        yield manifest_batch(done)

    manifest = stored(dealt.mapInArrow(write, MANIFEST), "manifest")
    commit(manifest, folder)
    return manifest


def read_members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpacker, parts, data = zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
            data = data or stream.read(1 << 20)
        else:
            data = stream.read(1 << 20)
    if parts and any(parts):
        raise ValueError("archive ends inside a record")


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the manifest's archives, digests checked."""
    ship(manifest.sparkSession)
    names = [field.split()[0] for field in RECORD.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        for batch in batches:
            for final in batch.column(0).to_pylist():
                rows = []
                with system.open_input_stream(f"{path}/{final}", compression=None) as stream:
                    for raw in read_members(stream):
                        rows.append(parsed_record(raw))
                        if len(rows) == 1000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    files = manifest.select("final").repartition(max(1, manifest.count()), "final")
    return files.mapInArrow(run, RECORD)
