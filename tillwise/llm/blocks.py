"""Vectorised words, lines and hashes over Arrow batches of texts, for use inside tasks.

A block is a run of whole texts; a text is never cut. Hashes are polynomial over the bytes
modulo 2**64 with random byte values, then mixed, so equal runs of bytes hash alike anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SEEDS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def byte_set(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


def _powers(base: int) -> np.ndarray:
    first = np.full(_CHUNK + 1, base, np.uint64)
    first[0] = 1
    return np.multiply.accumulate(first)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for spans in ascending order that don't overlap."""
    up, down = _powers(_BASE), _powers(_BASE_INVERSE)
    at_start, at_end = np.zeros(len(starts), np.uint64), np.zeros(len(ends), np.uint64)
    back = np.zeros(len(starts), np.uint64)
    carry = np.uint64(0)
    for low in range(0, max(len(data), 1), _CHUNK):
        part = data[low : low + _CHUNK]
        scale = np.array([pow(_BASE, low, 1 << 64)], np.uint64)
        unscale = np.array([pow(_BASE_INVERSE, low, 1 << 64)], np.uint64)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_SEEDS[part] * up[: len(part)], out=sums[1:])
        sums = sums * scale + carry
        a, b = np.searchsorted(starts, [low, low + _CHUNK])
        at_start[a:b] = sums[starts[a:b] - low]
        back[a:b] = down[starts[a:b] - low] * unscale
        a, b = np.searchsorted(ends, [low, low + _CHUNK + (low + _CHUNK >= len(data))])
        at_end[a:b] = sums[ends[a:b] - low]
        carry = sums[-1]
    length = (ends - starts).astype(np.uint64)
    return mix((at_end - at_start) * back + length * np.uint64(0xD6E8FEB86659FD93))


class Block:
    """Texts ``offsets[i]:offsets[i+1]`` of ``data`` (UTF-8 bytes)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        inside = ~IS_SPACE[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        filled = np.flatnonzero(np.diff(offsets))
        begins[offsets[filled]] = inside[offsets[filled]]
        stops[offsets[filled + 1] - 1] = inside[offsets[filled + 1] - 1]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.n_words = np.bincount(self.doc, minlength=self.n)

    def word_hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes are flagged in each text."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return np.diff(sums[self.offsets])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of every line; an empty text is one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        at = np.searchsorted(self.offsets, breaks, "right") - 1
        starts = np.concatenate((self.offsets[:-1], breaks + 1))
        ends = np.concatenate((breaks, self.offsets[1:]))
        doc_s = np.concatenate((np.arange(self.n), at))
        doc_e = np.concatenate((at, np.arange(self.n)))
        order_s, order_e = np.lexsort((starts, doc_s)), np.lexsort((ends, doc_e))
        return starts[order_s], ends[order_e], doc_s[order_s]

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words inside one text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for i in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
            out ^= out >> np.uint64(29)
        first = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return first, mix(out[first])


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, Block]]:
    """(index of the first text, block) over a column; NULL counts as empty.

    A block has at most ``limit`` bytes, unless a single text is longer.
    """
    texts = pc.fill_null(texts, "")
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(ends, ends[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(texts), low + 4096)
        yield low, Block(data[ends[low] : ends[high]], ends[low : high + 1] - ends[low])
        low = high
