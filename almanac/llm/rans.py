"""A static range asymmetric numeral system for blocks of token ids.

One table of frequencies, which sum to ``2 ** bits``, serves all blocks. A block is coded by
interleaved lanes, id ``t`` in lane ``t % lanes``, each with a 64-bit state that gives off or
takes in 32-bit words; the words of all lanes are one stream in the decoder's order. Every
``stride`` steps a checkpoint has the states and the place in the stream, so the segments between
checkpoints are decoded side by side, or one of them alone. The last states must be the first
ones of the encoder, and the block ends in a checksum of its bytes.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

MAGIC = b"RANS"
HEADER = struct.Struct("<4sIIIIII")  # magic, table's crc32, ids, lanes, stride, checkpoints, words
LOWEST = np.uint64(1 << 31)
WORD = np.uint64(32)


class BadBlock(ValueError):
    """The bytes aren't a whole block of this table."""


def scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies in proportion to ``counts`` that sum to ``2 ** bits``; what occurs has one or more.

    What rounding down leaves goes to the largest remainders, what the least ones take too much
    comes from the largest frequencies, ties by the lower id.
    """
    total, size = int(counts.sum()), 1 << bits
    if total == 0:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > size:
        raise ValueError("more ids than the table has places")
    parts = counts / total * size
    out = np.where(counts > 0, np.maximum(1, np.floor(parts)), 0).astype(np.int64)
    spare = size - int(out.sum())
    if spare > 0:
        by_rest = np.lexsort((np.arange(len(counts)), -(parts - out)))
        by_rest = by_rest[counts[by_rest] > 0]
        out[by_rest] += spare // len(by_rest)
        out[by_rest[:spare % len(by_rest)]] += 1
    while spare < 0:
        large = np.flatnonzero(out > 1)
        large = large[np.lexsort((large, -out[large]))][:-spare]
        take = np.minimum(out[large] - 1, max(1, -spare // len(large)))
        out[large] -= take
        spare += int(take.sum())
    return out


@dataclass(frozen=True)
class Layout:
    """Ids in a block at most, lanes that share its stream, steps between checkpoints."""

    block: int = 262_144
    lanes: int = 1024
    stride: int = 128

    def lanes_for(self, n: int) -> int:
        """Short blocks have fewer lanes, so that their states don't outweigh the ids."""
        return min(self.lanes, max(1, 1 << max(0, (n // self.stride).bit_length())))


@dataclass(frozen=True)
class Table:
    """Frequencies of the ids from 0."""

    frequencies: np.ndarray
    bits: int

    @cached_property
    def crc(self) -> int:
        return zlib.crc32(self.frequencies.astype("<u4").tobytes(), self.bits)

    @cached_property
    def widths(self) -> np.ndarray:
        return self.frequencies.astype(np.uint64)

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.widths) - self.widths

    @cached_property
    def id_at(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies)

    @cached_property
    def filler(self) -> int:
        """Stands in the places behind the last id; the likeliest id costs least."""
        return int(self.frequencies.argmax())

    def encode(self, ids: np.ndarray, layout: Layout = Layout()) -> bytes:
        if len(ids) and not (ids.max() < len(self.widths) and self.widths[ids].all()):
            raise ValueError("an id that the table doesn't have")
        lanes, stride = layout.lanes_for(len(ids)), layout.stride
        steps = -(-len(ids) // lanes)
        grid = np.full(steps * lanes, self.filler, np.int64)
        grid[:len(ids)] = ids
        grid = grid.reshape(steps, lanes)
        bits, room = np.uint64(self.bits), np.uint64(63 - self.bits)
        states = np.full(lanes, LOWEST)
        words: list[np.ndarray] = []
        written = 0
        checkpoints: list[tuple[int, np.ndarray]] = []
        for step in range(steps - 1, -1, -1):
            width = self.widths[grid[step]]
            full = states >= width << room
            out = states[full]
            words.append(out.astype(np.uint32))
            written += len(out)
            states[full] = out >> WORD
            whole, rest = np.divmod(states, width)
            states = (whole << bits) + rest + self.starts[grid[step]]
            if step % stride == 0:
                checkpoints.append((written, states.copy()))
        checkpoints.reverse()
        stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
        body = b"".join([
            HEADER.pack(MAGIC, self.crc, len(ids), lanes, stride, len(checkpoints), written),
            np.array([written - at for at, _ in checkpoints], "<u4").tobytes(),
            *[s.astype("<u8").tobytes() for _, s in checkpoints],
            stream.astype("<u4").tobytes()])
        return body + struct.pack("<I", zlib.crc32(body))

    def decode(self, data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of the segments from checkpoint ``first`` to before ``last``, of all by default."""
        if len(data) < HEADER.size + 4 or struct.unpack("<I", data[-4:])[0] != zlib.crc32(data[:-4]):
            raise BadBlock("checksum")
        magic, crc, n, lanes, stride, checkpoints, total = HEADER.unpack_from(data)
        if magic != MAGIC or crc != self.crc:
            raise BadBlock("other format or table")
        at = HEADER.size
        places = np.frombuffer(data, "<u4", checkpoints, at).astype(np.int64)
        at += 4 * checkpoints
        states = np.frombuffer(data, "<u8", checkpoints * lanes, at).reshape(checkpoints, lanes)
        at += 8 * checkpoints * lanes
        words = np.frombuffer(data, "<u4", total, at).astype(np.uint64)
        last = checkpoints if last is None else min(last, checkpoints)
        if first >= last:
            return np.empty(0, np.uint32)
        steps = -(-n // lanes)
        ends = [(places[k + 1], states[k + 1]) if k + 1 < checkpoints
                else (total, np.full(lanes, LOWEST)) for k in range(first, last)]
        short = (steps - 1) % stride + 1 if last == checkpoints else stride
        states, places = states[first:last].astype(np.uint64), places[first:last].copy()
        out = np.zeros((last - first, stride, lanes), np.uint32)
        bits, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        for step in range(stride):
            live = last - first - (step >= short)
            if not live:
                break
            now = states[:live]
            slot = now & mask
            ids = self.id_at[slot]
            out[:live, step] = ids
            now = self.widths[ids] * (now >> bits) + slot - self.starts[ids]
            low = np.flatnonzero(now < LOWEST)
            counts = np.diff(np.searchsorted(low, np.arange(live + 1) * lanes))
            if (places[:live] + counts).max() > total:
                raise BadBlock("stream ends early")
            taken = np.concatenate([words[p:p + c] for p, c in zip(places, counts.tolist())])
            flat = now.reshape(-1)
            flat[low] = flat[low] << WORD | taken
            states[:live] = now
            places[:live] += counts
        for k, (place, state) in enumerate(ends):
            if places[k] != place or (states[k] != state).any():
                raise BadBlock("states at the end")
        ids = out.reshape(-1)[:min(n, last * stride * lanes) - first * stride * lanes]
        return ids
