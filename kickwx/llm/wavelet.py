"""A wavelet matrix of token ids and its file format."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"KWXWAVE1"
BLOCK = 512  # bits per entry of the rank directory


class BitPlane:
    """Bits with a rank directory: the number of ones before each block of 512 bits."""

    def __init__(self, words: np.ndarray, size: int, directory: np.ndarray | None = None):
        self.words, self.size = words.reshape(-1, 8), size
        ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.directory = (
            np.concatenate(([0], np.cumsum(ones))).astype(np.uint32) if directory is None else directory
        )

    @classmethod
    def of(cls, bits: np.ndarray) -> "BitPlane":
        padded = np.zeros(-(-max(len(bits), 1) // BLOCK) * BLOCK, bool)
        padded[: len(bits)] = bits
        return cls(np.packbits(padded, bitorder="little").view("<u8"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.reshape(-1).view(np.uint8), count=self.size, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        word = self.words.reshape(-1)[at >> 6]
        return ((word >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position (0 to size)."""
        at = np.asarray(at, np.int64)
        block = np.minimum(at >> 9, len(self.words) - 1)
        into = at - (block << 9)
        left = np.clip(into[:, None] - 64 * np.arange(8), 0, 64)
        mask = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << (left & 63).astype(np.uint64)) - np.uint64(1))
        return self.directory[block].astype(np.int64) + np.bitwise_count(self.words[block] & mask).sum(axis=1, dtype=np.int64)

    def select(self, bit: int, nth: np.ndarray) -> np.ndarray:
        """Position of the nth (from 0) bit of that value."""
        nth = np.asarray(nth, np.int64)
        before = self.directory.astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, nth, side="right") - 1
        bits = np.unpackbits(self.words[block].view(np.uint8).reshape(len(nth), -1), axis=1, bitorder="little")
        seen = np.cumsum(bits if bit else 1 - bits, axis=1, dtype=np.int64)
        return block * BLOCK + (seen <= (nth - before[block])[:, None]).sum(axis=1)


class WaveletMatrix:
    """Token ids as bit planes, highest bit first; each plane orders the ids by the bits above it, zeros before ones."""

    def __init__(self, planes: list[BitPlane], zeros: list[int], size: int):
        self.planes, self.zeros, self.size = planes, zeros, size

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(levels - 1, -1, -1):
            ones = (now >> level & 1).astype(bool)
            low = np.flatnonzero(~ones)  # positions, then take: twice as fast as boolean selection
            planes.append(BitPlane.of(ones))
            zeros.append(len(low))
            now = np.concatenate((now.take(low), now.take(np.flatnonzero(ones))))
        return cls(planes, zeros, len(ids))

    def all(self) -> np.ndarray:
        """Every id in order, rebuilt from the lowest plane upwards."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.size, kind)
        for level, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            ones = plane.bits()
            above = np.empty_like(now)
            above[np.flatnonzero(~ones)] = now[:zeros]
            above[np.flatnonzero(ones)] = now[zeros:] | kind(1 << level)
            now = above
        return now.astype(np.uint32)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some positions, without reading others."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.uint32)
        for plane, zeros in zip(self.planes, self.zeros):
            ones = plane.get(at)
            before = plane.rank1(at)
            out = out << np.uint32(1) | ones
            at = np.where(ones, zeros + before, at - before)
        return out

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        ends = np.array([start, stop], np.int64)
        for depth, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            before = plane.rank1(ends)
            ends = zeros + before if token >> (len(self.planes) - 1 - depth) & 1 else ends - before
        return int(ends[0]), int(ends[1])

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token in positions [start, stop)."""
        first, last = self._range(token, start, self.size if stop is None else stop)
        return last - first

    def locate(self, token: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Positions of a token in [start, stop), ascending."""
        first, last = self._range(token, start, self.size if stop is None else stop)
        at = np.arange(first, last)
        for depth in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bit = token >> (len(self.planes) - 1 - depth) & 1
            at = self.planes[depth].select(bit, at - self.zeros[depth] if bit else at)
        return at


def dump(ids: np.ndarray, doc_ends: np.ndarray) -> bytes:
    """One compressed file: magic, number of planes, ids and documents, then zstandard frames, each after its length:
    document ends (u64), zeros per plane (u64), and per plane its bits (u64 words, little-endian) and rank directory (u32)."""
    matrix = WaveletMatrix.build(ids)
    sections = [np.asarray(doc_ends, "<u8").tobytes(), np.array(matrix.zeros, "<u8").tobytes()]
    for plane in matrix.planes:
        sections += [plane.words.tobytes(), plane.directory.astype("<u4").tobytes()]
    pack = zstandard.ZstdCompressor(level=1).compress
    frames = [pack(s) for s in sections]
    head = MAGIC + struct.pack("<IQQ", len(matrix.planes), matrix.size, len(doc_ends))
    return head + b"".join(struct.pack("<Q", len(f)) + f for f in frames)


def load(file: bytes) -> tuple[WaveletMatrix, np.ndarray]:
    """The matrix and the document ends of a file."""
    if file[: len(MAGIC)] != MAGIC:
        raise ValueError("not a wavelet file")
    levels, size, n_docs = struct.unpack_from("<IQQ", file, len(MAGIC))
    at, sections, unpack = len(MAGIC) + 20, [], zstandard.ZstdDecompressor().decompress
    for _ in range(2 + 2 * levels):
        (n,) = struct.unpack_from("<Q", file, at)
        sections.append(unpack(file[at + 8: at + 8 + n]))
        at += 8 + n
    planes = [
        BitPlane(np.frombuffer(w, "<u8"), size, np.frombuffer(d, "<u4")) for w, d in zip(sections[2::2], sections[3::2])
    ]
    return WaveletMatrix(planes, np.frombuffer(sections[1], "<u8").astype(np.int64).tolist(), size), np.frombuffer(sections[0], "<u8")[:n_docs]
