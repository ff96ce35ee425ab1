"""Token-id files: documents in doc_id order, their ids coded by the context-mixing range coder.

Texts are range-partitioned and sorted by doc_id before they are tokenised, so ids are never
shuffled. Each task writes one file of groups; a group has an index of its documents and
independently decodable blocks. The manifest's counts give every file's first position.

Defined cases: null text is empty text and has the end id alone; null doc_ids come first;
rows that share a doc_id follow one another by the text's hash; an empty table gives no file and no
row; tokenizers of more than 65,536 ids are refused; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tickerloom.llm.common import ship, stored
from tickerloom.llm.mixing_coder import BLOCK_IDS, HEADER, MAGIC, decode_block, encode_block
from tickerloom.llm.pieces import Segments
from tickerloom.llm.shards import MANIFEST, Roll, commit, file_system, manifest_batch

GROUP = struct.Struct("<4sIIIII")
GROUP_MAGIC = b"TLG2"
GROUP_IDS = 2 * BLOCK_IDS
NO_BLANK_TO_RUST = re.compile("[\x1c-\x1f]")
# Printable ASCII, composed Latin letters and common marks: the same in all normal forms, and lower-cased one by one.
LATIN = "a-z\u00df-\u00f6\u00f8-\u00ff"
PLAIN = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u00a1\u00ab\u00bb\u00bf\u2013\u2014\u2018-\u201e\u2022\u2026\u20ac"
PLAIN_TEXT = re.compile(f"[ \t-\r{PLAIN}]*")
LETTERS_ONLY = re.compile(f"[{LATIN}]+")
# The tokenizer's own split, for plain texts in lower case.
PLAIN_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^ \t-\r{LATIN}0-9]+")


class ChunkEncoder:
    """A tokenizers file whose ids are remembered per chunk between blanks.

    Normalisation, splitting and merging of this kind of tokenizer never reach across a
    blank; plain texts and chunks without special tokens are split here, and a part goes to the
    merges at once, its bytes written as the tokenizer writes them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.chunks = Segments(self.encode_chunk)
        # How the tokenizer's byte level writes the bytes that are no printable characters in Latin-1.
        odd = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
        self.shown = {b: chr(256 + n) for n, b in enumerate(odd)}

    def merged(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.shown)
        ids = [token.id for token in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}H", *ids)

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        if LETTERS_ONLY.fullmatch(chunk) or self.plain(chunk) and self.parts(chunk) == [chunk]:
            return self.merged(chunk)
        return self.encode_plain(chunk) if self.plain(chunk) else self.direct(chunk)

    def plain(self, text: str) -> bool:
        return bool(PLAIN_TEXT.fullmatch(text)) and "<|" not in text

    def parts(self, text: str) -> list[str]:
        return PLAIN_PARTS.findall(text.lower())

    def encode_plain(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, self.parts(text)))

    def encode(self, text: str) -> bytes:
        if self.plain(text):
            return self.encode_plain(text)
        if NO_BLANK_TO_RUST.search(text):
            return self.direct(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder_at(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def group_bytes(doc_ids: list[int | None], parts: list[bytes]) -> bytes:
    """A coded group: its index of documents and its blocks."""
    ids = np.frombuffer(b"".join(parts), dtype="<u2")
    blocks = [encode_block(ids[at : at + BLOCK_IDS]) for at in range(0, len(ids), BLOCK_IDS)]
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    lengths = np.array([len(p) // 2 for p in parts], dtype="<u4")
    index = zlib.compress(numbers.tobytes() + nulls.tobytes() + lengths.tobytes())
    coded = b"".join(blocks)
    return GROUP.pack(GROUP_MAGIC, len(doc_ids), len(blocks), len(index), len(coded), zlib.crc32(index)) + index + coded


def read_groups(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of every document of a file, in order."""
    while head := stream.read(GROUP.size):
        magic, n_docs, n_blocks, index_size, coded_size, crc = GROUP.unpack(head)
        index, coded = stream.read(index_size), stream.read(coded_size)
        if magic != GROUP_MAGIC or zlib.crc32(index) != crc:
            raise ValueError("damaged group")
        plain = zlib.decompress(index)
        numbers = np.frombuffer(plain, dtype="<i8", count=n_docs).tolist()
        nulls = np.frombuffer(plain, dtype=np.uint8, count=n_docs, offset=8 * n_docs)
        lengths = np.frombuffer(plain, dtype="<u4", count=n_docs, offset=9 * n_docs)
        blocks, at = [], 0
        for _ in range(n_blocks):
            kind, length, lanes, top, payload, check = HEADER.unpack_from(coded, at)
            if kind != MAGIC:
                raise ValueError("damaged block")
            at += HEADER.size
            blocks.append(decode_block(length, lanes, top, coded[at : at + payload], check))
            at += payload
        ids = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.uint16)
        ends = np.cumsum(lengths.astype(np.int64))
        for number, null, end, length in zip(numbers, nulls, ends, lengths):
            yield (None if null else number), ids[end - length : end]


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int) -> DataFrame:
    """Write the files below `folder` and return their stored manifest (n_records: ids)."""
    ship(docs.sparkSession)
    end = np.array([end_id], dtype="<u2").tobytes()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = encoder_at(tokenizer_path), None
        doc_ids, parts, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    doc_ids.append(doc_id)
                    parts.append(encoder.encode(text or "") + end)
                    size += len(parts[-1]) // 2
                    if size >= GROUP_IDS:
                        out = out or Roll(folder, TaskContext.get().partitionId(), 0, ".ids")
                        out.write(group_bytes(doc_ids, parts), size)
                        doc_ids, parts, size = [], [], 0
        if doc_ids:
            out = out or Roll(folder, TaskContext.get().partitionId(), 0, ".ids")
            out.write(group_bytes(doc_ids, parts), size)
        yield manifest_batch([out.close()] if out else [])

    manifest = stored(ordered.mapInArrow(run, MANIFEST), "manifest")
    commit(manifest, folder)
    return manifest


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids (binary, unsigned 32-bit) per document."""
    ship(manifest.sparkSession)
    files = manifest.select(
        "final",
        (F.sum("n_records").over(Window.orderBy("shard", "part")) - F.col("n_records")).alias("first"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        names = ["doc_id", "start", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                start, rows = row["first"], []
                with system.open_input_stream(f"{path}/{row['final']}", compression=None) as stream:
                    for doc_id, ids in read_groups(stream):
                        rows.append((doc_id, start, ids.astype("<u4").tobytes()))
                        start += len(ids)
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    dealt = files.repartition(max(1, manifest.count()), "final")
    return dealt.mapInArrow(run, "doc_id long, start long, ids binary")
