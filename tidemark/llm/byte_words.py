"""Words of a column of texts as numpy arrays, found in its UTF-8 bytes, and the CRC-32 of words and of runs of words.

Only A-Z are lower-cased, so texts can be cut and compared byte by byte: every byte of a character outside ASCII is
0x80 or more.  The CRC-32 of joined strings follows from those of its parts, crc(a + b) = shift(crc(a), len(b)) xor
crc(b), where shift, the register after so many zero bytes, is linear over the bits and is looked up byte by byte.
"""
from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 4_000_000        # texts of about so many bytes are cut together
SHORT = 64                     # longest shift with a table of its own

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def _crc_step() -> np.ndarray:
    """What a byte does to the register: the reflected polynomial of CRC-32 divided bit by bit."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


STEP = _crc_step()


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Shifts by 0 to SHORT zero bytes, and by 1, 2, 4, ... zero bytes: 4 x 256 entries each, by register byte."""
    level = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    short = [level]
    for _ in range(SHORT):
        level = STEP[level & np.uint32(255)] ^ (level >> np.uint32(8))
        short.append(level)
    powers = [short[1]]
    for _ in range(40):
        powers.append(_apply(powers[-1], 0, powers[-1]))
    return np.concatenate(short), powers


def _apply(table: np.ndarray, at, x: np.ndarray) -> np.ndarray:
    out = table[at + (x & np.uint32(255)).astype(np.int64)]
    for k in range(1, 4):
        out ^= table[at + 256 * k + ((x >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int64)]
    return out


SHIFTS, POWERS = _tables()


def shift(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The CRCs moved past ``by`` further bytes."""
    out = _apply(SHIFTS, np.minimum(by, SHORT).astype(np.int64) * 1024, crc)
    rest = np.flatnonzero(by > SHORT)
    if len(rest):
        x, left = out[rest], by[rest] - SHORT
        for k in range(int(left.max()).bit_length()):
            on = (left >> k) & 1 == 1
            x[on] = _apply(POWERS[k], 0, x[on])
        out[rest] = x
    return out


@dataclass
class Words:
    """The words of some texts in order: lower-cased bytes, place and byte length, and the number of the text."""
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    row: np.ndarray

    def pick(self, at) -> Words:
        return Words(self.data, self.start[at], self.size[at], self.row[at])

    def crc(self) -> np.ndarray:
        """CRC-32 of each word, byte by byte for all words that are long enough."""
        out = np.empty(len(self.start), dtype=np.uint32)
        long = np.flatnonzero(self.size > SHORT)
        for i in long.tolist():
            out[i] = zlib.crc32(self.data[self.start[i]:self.start[i] + self.size[i]])
        order = np.argsort(np.where(self.size > SHORT, 0, self.size).astype(np.uint8), kind="stable")[::-1][:len(self.start) - len(long)]
        start, size = self.start[order], self.size[order]
        many = len(order) - np.searchsorted(size[::-1], np.arange(1, SHORT + 1), side="left")      # words of at least so many bytes
        reg = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        for j, n in enumerate(many.tolist()):
            if not n:
                break
            reg[:n] = STEP[(reg[:n] ^ self.data[start[:n] + j]) & np.uint32(255)] ^ (reg[:n] >> np.uint32(8))
        out[order] = reg ^ np.uint32(0xFFFFFFFF)
        return out

    def strings(self) -> pa.Array:
        """The words as an Arrow column."""
        ends = np.cumsum(self.size)
        at = np.repeat(self.start - ends + self.size, self.size) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(self.size), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[at])])


def cut(texts: pa.Array, inside_of) -> Words:
    """Maximal runs of the bytes that ``inside_of`` (bytes to truth values) marks; none goes over the end of a text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = LOWER[np.frombuffer(held, dtype=np.uint8)[edges[0]:edges[-1]]] if held is not None else np.zeros(0, dtype=np.uint8)
    edges = edges - edges[0]
    inside = inside_of(data)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    begin[inner], end[inner - 1] = inside[inner], inside[inner - 1]
    start = np.flatnonzero(begin)
    return Words(data, start, np.flatnonzero(end) + 1 - start, np.searchsorted(edges, start, side="right") - 1)


def groups_of(texts: pa.Array, limit: int = GROUP_BYTES):
    """(first, end) rows of consecutive texts of about ``limit`` bytes together; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)
