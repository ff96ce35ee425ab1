"""Bit tables for membership tests inside column expressions.

A table is a binary literal of one byte per bit, so a test is a single substring. It is
sized by the keys it lists, never by the rows it is tested on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SET = b"\x01"


class BitTable:
    """A Bloom filter: `width` positions, `probes` of them per key."""

    def __init__(self, bits: bytes, probes: int, seed: int):
        self.bits, self.probes, self.seed = bits, probes, seed

    def _positions(self, key: Column) -> list[Column]:
        return positions(key, len(self.bits), self.probes, self.seed)

    def may_hold(self, key: Column) -> Column:
        found = F.lit(True)
        for at in self._positions(key):
            found = found & (F.substring(F.lit(self.bits), at.cast("int") + 1, F.lit(1)) == F.lit(SET))
        return found


def positions(key: Column, width: int, probes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed * 1000 + i), key), F.lit(width)) for i in range(probes)]


def build(keys: DataFrame, column: str, count: int, bits_per_key: int, probes: int, seed: int) -> BitTable:
    """A filter of `count` listed keys. The driver gets at most `probes` positions per listed key."""
    width = max(64, count * bits_per_key)
    found = keys.select(F.explode(F.array(*positions(F.col(column), width, probes, seed))).alias("at")).distinct()
    bits = bytearray(width)
    for row in found.toLocalIterator():
        bits[row["at"]] = 1
    return BitTable(bytes(bits), probes, seed)
