"""Binary shard files that tasks write to a shared folder: temporary names, a manifest, then a commit.

A task writes each file under a name of its own (with a random part) and reports it as a
manifest row. Only rows of successful tasks reach the stored manifest; `commit` renames
those files to their final names and can be repeated. Leftovers of failed attempts keep their
temporary names and are read by nobody.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from tickerloom.llm.common import ship

MANIFEST = "temporary string, final string, shard int, part int, n_records long, n_bytes long"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder's uri (local, hdfs, s3, ...)."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class Roll:
    """One output file under its temporary name."""

    def __init__(self, folder: str, shard: int, part: int, suffix: str):
        system, path = file_system(folder)
        name = f"part-{shard:06d}-{part:04d}{suffix}"
        self.temporary, self.final = f"tmp-{uuid.uuid4().hex}-{name}", name
        self.shard, self.part, self.n_records, self.n_bytes = shard, part, 0, 0
        system.create_dir(path, recursive=True)
        self.out = system.open_output_stream(f"{path}/{self.temporary}", compression=None)

    def write(self, data: bytes, records: int = 1) -> None:
        self.out.write(data)
        self.n_records += records
        self.n_bytes += len(data)

    def close(self) -> tuple:
        self.out.close()
        return self.temporary, self.final, self.shard, self.part, self.n_records, self.n_bytes


def manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    names = [field.split()[0] for field in MANIFEST.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def commit(manifest: DataFrame, folder: str) -> None:
    """Give every file of the (stored) manifest its final name."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{path}/{row['temporary']}", f"{path}/{row['final']}"
                if system.get_file_info(source).type == fs.FileType.File:
                    system.move(source, target)
                elif system.get_file_info(target).type != fs.FileType.File:
                    raise FileNotFoundError(target)
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], names=["done"])

    manifest.mapInArrow(run, "done int").count()
