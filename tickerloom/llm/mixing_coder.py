"""Adaptive context-mixing range coder for token ids, many lanes in step.

A block codes its ids on its own: tables and coders start anew, and a CRC-32 of its ids ends
its header. Its ids are cut into lanes of equal length (the last is filled up with zeros), which
share the block's tables and have a range coder each; numpy runs a step of all lanes at once.

Per id, the order-2 table (hash of the two ids before) proposes an id, and so does the order-1
table (the id before). How likely each is right mixes two adaptive predictions in the logistic
domain with learned weights; one three-way decision is coded: the first, the second, neither. If
neither, the whole id is coded by the order-0 frequencies of the ids that both missed. Every
step codes with what the steps before taught. All arithmetic is on integers, so every machine
decodes the same; where lanes of a step share a cell of a table, the last lane's entry stays.

The range coder has 48 bits of state and moves 16 at a time, as soon as the range falls below
`LEAST`. A range that then crosses a carry is cut at the carry, so no carry ever travels.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

STEPS = 256
LANES = 8192
BLOCK_IDS = STEPS * LANES
IDS = 1 << 16
PAIRS_BITS = 20
HEADER = struct.Struct("<4sIIIII")
MAGIC = b"TLB3"
ONE = 1 << 16
WORD = 16
TAIL = (1 << 32) - 1
LEAST = 1 << 24
# Order-0 frequencies of all ids up to the block's largest: at least one each, TOTAL in all.
TOTAL_BITS = 19
TOTAL = 1 << TOTAL_BITS
COUNTED_EVERY = 16
GROWTH_STEPS = 64
GROWTH_WORDS = 4 * GROWTH_STEPS


def _squash_table() -> np.ndarray:
    x = np.arange(-2047, 2048) / 256.0
    return np.clip(np.floor(ONE / (1 + np.exp(-x)) + 0.5), 64, ONE - 64).astype(np.int32)


SQUASH = _squash_table()
# The inverse by counting, on twelve-bit probabilities.
# As numbers of 32 bits: what is multiplied with a truth value keeps that width.
GOAL, LAST = np.int32(ONE - 128), np.int32(ONE - 1)
STRETCH = np.clip(np.searchsorted(SQUASH, (np.arange(4096) * 16 + 8)), 0, 4094).astype(np.int32) - 2047


class _Coder:
    """Range coders of all lanes; encodes given choices or decodes them."""

    def __init__(self, lanes: int, data: np.ndarray | None = None):
        self.low = np.zeros(lanes, dtype=np.int64)
        self.range = np.full(lanes, (1 << 48) - 1, dtype=np.int64)
        self.at = np.zeros(lanes, dtype=np.int64)
        self.decoding = data is not None
        self.data = data if self.decoding else np.zeros((lanes, GROWTH_WORDS), dtype=np.uint16)
        if self.decoding:
            # The coded value, less `low`.
            self.ahead = np.zeros(lanes, dtype=np.int64)
            for word in range(3):
                self.ahead = self.ahead << WORD | self.data[:, word]
            self.at += 3

    def _refill(self, rows: np.ndarray) -> None:
        """Move words out of the given lanes, whose range became narrow."""
        while len(rows):
            low, size, at = self.low.take(rows), self.range.take(rows), self.at.take(rows)
            crosses = (low ^ (low + size - 1)) > TAIL
            size = np.where(crosses, -low & (LEAST - 1), size) << WORD
            if self.decoding:
                self.ahead[rows] = self.ahead.take(rows) << WORD | self.data.take(rows * self.data.shape[1] + at)
            else:
                self.data.reshape(-1)[rows * self.data.shape[1] + at] = low >> 32
            self.at[rows] = at + 1
            self.low[rows] = (low & TAIL) << WORD
            self.range[rows] = size
            rows = rows[size < LEAST]

    def choose(self, first: np.ndarray, either: np.ndarray, choice: np.ndarray | None) -> np.ndarray:
        """Code one of three choices in every lane, by the chances of the first and of the first two in 1/65536."""
        unit = self.range >> 16
        cut1, cut2 = unit * first, unit * either
        if self.decoding:
            choice = (self.ahead >= cut1).astype(np.int8) + (self.ahead >= cut2)
        skipped = np.where(choice == 0, 0, np.where(choice == 1, cut1, cut2))
        self.range = np.where(choice == 0, cut1, np.where(choice == 1, cut2, self.range)) - skipped
        self.low += skipped
        if self.decoding:
            self.ahead -= skipped
        self._refill(np.flatnonzero(self.range < LEAST))
        return choice

    def symbol(self, rows: np.ndarray, model: _Order0, symbols: np.ndarray | None) -> np.ndarray:
        """Code one id in each of the given lanes."""
        unit = self.range.take(rows) >> TOTAL_BITS
        if self.decoding:
            ahead = self.ahead.take(rows)
            symbols = model.at_share(np.minimum(ahead // unit, TOTAL - 1))
        start = model.bounds.take(symbols)
        skipped, size = unit * start, unit * (model.bounds.take(symbols + 1) - start)
        self.low[rows] += skipped
        self.range[rows] = size
        if self.decoding:
            self.ahead[rows] = ahead - skipped
        self._refill(rows[size < LEAST])
        return symbols

    def make_room(self) -> None:
        """Room for `GROWTH_STEPS` more ids in every lane."""
        missing = int(self.at.max(initial=0)) + GROWTH_WORDS - self.data.shape[1]
        if missing > 0:
            self.data = np.concatenate([self.data, np.zeros((len(self.at), missing), dtype=np.uint16)], axis=1)

    def finish(self) -> None:
        rows = np.arange(len(self.low))
        for shift in (32, 16, 0):
            self.data[rows, self.at] = self.low >> shift & 0xFFFF
            self.at += 1


class _Decision:
    """How likely a proposal is right: chances by a few states and by the id before, mixed with learned weights."""

    def __init__(self, states: int):
        self.by_state = np.full(states, ONE // 2, dtype=np.int32)
        self.by_id = np.full(IDS, ONE // 2, dtype=np.int32)
        self.weights = [22000, 22000]

    def chance(self, state: np.ndarray, before: np.ndarray) -> np.ndarray:
        self.known = self.by_id.take(before)
        self.stretched = STRETCH.take(self.by_state >> 4).take(state), STRETCH.take(self.known >> 4)
        total = (self.weights[0] * self.stretched[0] + self.weights[1] * self.stretched[1]) >> 15
        self.given = SQUASH.take(np.clip(total, -2047, 2047) + 2047)
        return self.given

    def learn(self, state: np.ndarray, before: np.ndarray, right: np.ndarray, rows: np.ndarray | slice) -> None:
        """What came out in the lanes `rows`, for which the other arguments are given."""
        if not len(right):
            return
        known = self.known[rows]
        self.by_id[before] = known + ((right * GOAL + (64 - known)) >> 4)
        missed, hits = np.bincount(state * 2 + right, minlength=2 * len(self.by_state)).reshape(-1, 2).T
        seen = missed + hits
        share = 64 + (ONE - 128) * hits // np.maximum(seen, 1)
        self.by_state += (((share - self.by_state) * np.minimum(seen, 16)) >> 6).astype(np.int32)
        miss = right * LAST - self.given[rows]
        for k in range(2):
            slope = int((self.stretched[k][rows] * miss).sum(dtype=np.int64)) // len(right)
            self.weights[k] = min(max(self.weights[k] + (slope >> 10), -ONE), 2 * ONE)


class _Proposals:
    """From a context to the id last seen there and a trust from 0 to 3."""

    def __init__(self, contexts: int):
        self.cells = np.zeros(contexts, dtype=np.int32)

    def look(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = self.cells.take(at)
        return cell, cell & 0xFFFF, cell >> 16

    def learn(self, at: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray], symbol: np.ndarray) -> None:
        cell, guess, trust = found
        self.cells[at] = np.where(guess == symbol, np.minimum(cell + ONE, guess | 3 * ONE), np.where(trust > 0, cell - ONE, symbol))


class _Order0:
    """Cumulative frequencies of ids, counted anew after the first steps and then every few."""

    def __init__(self, size: int):
        self.counts = np.zeros(size, dtype=np.int64)
        self.fresh: list[np.ndarray] = []
        self.refresh()

    def learn(self, symbols: np.ndarray, step: int) -> None:
        self.fresh.append(symbols)
        if step % COUNTED_EVERY == 0 or step in (1, 2, 4, 8):
            self.counts += np.bincount(np.concatenate(self.fresh), minlength=len(self.counts))
            self.fresh = []
            self.refresh()

    def refresh(self) -> None:
        size = len(self.counts)
        shares = 1 + self.counts * (TOTAL - size) // max(int(self.counts.sum()), 1)
        self.bounds = np.concatenate(([0], np.cumsum(shares)))
        self.bounds[-1] = TOTAL
        self.ids = None

    def at_share(self, shares: np.ndarray) -> np.ndarray:
        if self.ids is None:
            self.ids = np.repeat(np.arange(len(self.counts), dtype=np.int32), np.diff(self.bounds))
        return self.ids.take(shares)


def _run(coder: _Coder, ids: np.ndarray, size: int) -> None:
    """Code (or decode into) `ids` [steps, lanes], all below `size`."""
    decoding, lanes = coder.decoding, ids.shape[1]
    first, second, rest = _Decision(32), _Decision(16), _Order0(size)
    order2, order1 = _Proposals(1 << PAIRS_BITS), _Proposals(IDS)
    before, before2 = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    for step in range(len(ids)):
        if not decoding and step % GROWTH_STEPS == 0:
            coder.make_room()
        at2 = (before * 0x9E3779B1 + before2 * 0x85EBCA6B) >> 12 & ((1 << PAIRS_BITS) - 1)
        found2, found1 = order2.look(at2), order1.look(before)
        (_, guess2, trust2), (_, guess1, trust1) = found2, found1
        same = guess1 == guess2
        state1 = trust2 * 4 + trust1
        state2 = state1 + 16 * same
        chance2 = first.chance(state2, before)
        chance1 = np.where(same, 0, ((ONE - chance2) >> 1) * (second.chance(state1, before) >> 1) >> 14)
        choice = None
        if not decoding:
            symbol = ids[step]
            choice = (symbol != guess2).astype(np.int8) * (1 + (symbol != guess1))
        choice = coder.choose(chance2, chance2 + chance1, choice)
        if decoding:
            symbol = np.where(choice == 0, guess2, guess1)
        missed = np.flatnonzero(choice == 2)
        if len(missed):
            found = coder.symbol(missed, rest, None if decoding else symbol[missed])
            if decoding:
                symbol[missed] = found
            rest.learn(found, step + 1)
        if decoding:
            ids[step] = symbol
        first.learn(state2, before, choice == 0, slice(None))
        asked = np.flatnonzero((choice > 0) & ~same)
        second.learn(state1[asked], before[asked], choice[asked] == 1, asked)
        order2.learn(at2, found2, symbol)
        order1.learn(before, found1, symbol)
        before2, before = before, symbol.astype(np.int64)


def _shape(length: int) -> tuple[int, int]:
    """Steps and lanes of a block."""
    return min(length, STEPS), -(-length // STEPS)


def encode_block(ids: np.ndarray) -> bytes:
    """The coded block of a uint16 id array of at most BLOCK_IDS, with its header."""
    steps, lanes = _shape(len(ids))
    crc = zlib.crc32(ids.astype("<u2").tobytes())
    size = int(ids.max(initial=0)) + 1
    filled = np.concatenate([ids, np.zeros(steps * lanes - len(ids), dtype=ids.dtype)])
    coder = _Coder(lanes)
    _run(coder, np.ascontiguousarray(filled.reshape(lanes, steps).T).astype(np.int32), size)
    coder.make_room()
    coder.finish()
    words = coder.data[np.arange(coder.data.shape[1]) < coder.at[:, None]]
    payload = coder.at.astype("<u2").tobytes() + words.astype("<u2").tobytes()
    return HEADER.pack(MAGIC, len(ids), lanes, size, len(payload), crc) + payload


def decode_block(length: int, lanes: int, size: int, payload: bytes, crc: int) -> np.ndarray:
    """The uint16 ids of a block given by its header's fields and its payload; the checksum is tested."""
    steps, expected = _shape(length)
    if lanes != expected:
        raise ValueError("damaged block")
    used = np.frombuffer(payload, dtype="<u2", count=lanes).astype(np.int64)
    data = np.zeros((lanes, int(used.max(initial=0)) + 8), dtype=np.uint16)
    data[np.arange(data.shape[1]) < used[:, None]] = np.frombuffer(payload, dtype="<u2", offset=2 * lanes)
    ids = np.zeros((steps, lanes), dtype=np.int32)
    try:
        _run(_Coder(lanes, data), ids, size)
    except IndexError as error:
        raise ValueError("damaged block") from error
    found = ids.T.reshape(-1)[:length].astype(np.uint16)
    if zlib.crc32(found.astype("<u2").tobytes()) != crc:
        raise ValueError("block checksum differs")
    return found
