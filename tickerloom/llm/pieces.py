"""SentencePiece encoding (merge type) by backtracking, and decoding.

The encoding of a text is the one sequence of pieces in which every piece re-merges to
itself and every adjacent pair re-merges to that pair. It is found from left to right:
an Aho-Corasick automaton gives the pieces that start at a position, longest first; a piece
is taken if it is compatible with the one before; where none is, the position is marked in
a bitfield of failed positions and the last piece is taken back.

No piece crosses from another character to a blank, so a text is encoded in segments (blanks
and what follows them), cut again between two characters that are adjacent in no piece.
Frequent short segments and pairs are remembered per worker in tables of bounded size.
Characters without a piece are segments of their own and become bytes.

Defined cases: null text is empty text; an empty text has only the begin and end ids; ids
outside the model raise an error; other columns pass through, result columns replace
those of their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from tickerloom.llm.common import ship

BLANK = "▁"
BATCH_ROWS = 256
MAX_KEPT_SEGMENTS = 700_000
MAX_KEPT_PAIRS = 1_000_000
MAX_SEGMENT_CHARS = 40


class Segments(dict):
    """Segment -> ids as bytes, filled on demand. When full, all become the older generation;
    of that, only those asked for again are kept when it is full the next time."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            ids = self.encode(segment)
        if len(segment) <= MAX_SEGMENT_CHARS:
            if len(self) >= MAX_KEPT_SEGMENTS // 2:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids


class PieceModel:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.pieces = [model.id_to_piece(i) for i in range(count)]
        plain = [
            i for i in range(count)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(count) if model.is_byte(i)}
        self.characters = set("".join(self.ids))
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        inner_blank = any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        self.segment = re.compile("(?s).+" if inner_blank else f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        # Adjacent characters inside pieces: between two others a text can be cut.
        self.inside = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.segments = Segments(self.encode_segment)
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.shown = [b"" if model.is_control(i) else self._shown(model, i) for i in range(count)]

    def _shown(self, model, i: int) -> bytes:
        if model.is_byte(i):
            return bytes([int(self.pieces[i][3:5], 16)])
        return " ⁇ ".encode() if model.is_unknown(i) else self.pieces[i].replace(BLANK, " ").encode()

    def remerge(self, text: str) -> list[str]:
        """Merge adjacent symbols, best score first, leftmost of equals, until none is a piece."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, left: int | None, right: int) -> bool:
        if left is None:
            if right not in self.whole:
                self.whole[right] = self.remerge(self.pieces[right]) == [self.pieces[right]]
            return self.whole[right]
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_KEPT_PAIRS:
                self.pairs.clear()
            a, b = self.pieces[left], self.pieces[right]
            known = self.pairs[key] = self.remerge(a + b) == [a, b]
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces."""
        starting: list[list[tuple[int, int]]] = [[] for _ in text]
        for end, (length, i) in self.automaton.iter(text):
            starting[end - length + 1].append((end + 1, i))
        failed = bytearray(len(text) // 8 + 1)
        found: list[tuple[int, int, int]] = []
        size, at, left, fits = len(text), 0, None, self.fits
        choice = len(starting[0]) if text else 0  # the pieces from a position end ever later: go back from the last
        while at < size:
            options = starting[at]
            while choice:
                choice -= 1
                end, i = options[choice]
                if not failed[end >> 3] >> (end & 7) & 1 and fits(left, i):
                    found.append((at, choice, left))
                    at, left = end, i
                    choice = len(starting[at]) if at < size else 0
                    break
            else:
                if not found:
                    raise ValueError("the model gives this text no encoding")
                failed[at >> 3] |= 1 << (at & 7)
                at, choice, left = found.pop()
        ids = [left] if found else []
        for _, _, before in reversed(found[1:]):
            ids.append(before)
        return ids[::-1]

    def encode_segment(self, segment: str) -> bytes:
        inside, cuts = self.inside, [0]
        for at in range(1, len(segment)):
            if segment[at - 1 : at + 1] not in inside:
                cuts.append(at)
        if len(cuts) > 1:
            cuts.append(len(segment))
            return b"".join([self.segments[segment[a:b]] for a, b in zip(cuts, cuts[1:])])
        if segment not in self.characters and len(segment) == 1:
            return np.array([self.bytes[b] for b in segment.encode()], dtype="<u4").tobytes()
        return np.array(self.backtrack(segment), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Begin id, ids of the text, end id as little-endian unsigned 32-bit integers."""
        begin, end = (np.array([i], dtype="<u4").tobytes() for i in (self.begin, self.end))
        if not text:
            return begin + end
        parts = self.segment.findall(BLANK + text.replace(" ", BLANK))
        return b"".join([begin, *map(self.segments.__getitem__, parts), end])

    def decode(self, ids: bytes) -> str:
        shown = b"".join(map(self.shown.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        # The blank put before a text is taken off again; a byte that is no character shows as U+FFFD.
        return shown.removeprefix(b" ").decode(errors="replace")


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    return PieceModel(path)


def _mapped(df: DataFrame, source: str, target: str, kind, convert) -> DataFrame:
    """`df` with `target` made from `source` by a per-value function, in Arrow batches."""
    ship(df.sparkSession)
    rest = [name for name in df.columns if name != target]
    place = rest.index(source)
    # All columns travel as one struct, the source among them, so that no name can clash and no text goes twice.
    narrow = df.select(F.struct(*rest).alias("row"))
    schema = narrow.select("row", F.lit(None).cast(kind).alias("target")).schema
    arrow = pa.binary() if isinstance(kind, BinaryType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                values = pa.array(convert(part.column(0).field(place).to_pylist()), type=arrow)
                yield pa.RecordBatch.from_arrays([part.column(0), values], names=["row", "target"])

    mapped = narrow.mapInArrow(run, schema)
    return mapped.select(*[F.col("row").getField(name).alias(name) for name in rest], F.col("target").alias(target))


def encode_documents(docs: DataFrame, model_path: str, column: str = "text") -> DataFrame:
    """`docs` with `token_ids` (binary, little-endian unsigned 32-bit)."""

    def convert(texts: list) -> list[bytes]:
        model = model_at(model_path)
        return [model.encode(text or "") for text in texts]

    return _mapped(docs, column, "token_ids", BinaryType(), convert)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """`encoded` with `decoded_text` made from `token_ids`."""

    def convert(values: list) -> list[str]:
        model = model_at(model_path)
        return [model.decode(ids or b"") for ids in values]

    return _mapped(encoded, "token_ids", "decoded_text", StringType(), convert)
