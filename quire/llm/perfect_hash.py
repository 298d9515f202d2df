"""Minimal perfect hashing of 64-bit key hashes: levels of bit arrays, each holding the keys alone in their place."""

from __future__ import annotations

import struct

import numpy as np

from quire.llm.kernels import mixed

_STEP = 0x9E3779B97F4A7C15


class PerfectHash:
    """Maps n distinct 64-bit numbers one to one onto 0..n-1 in about 4 bits a key; others to any slot or -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.cumsum(bits, dtype=np.int64) - 1 for bits in levels]
        self.n = sum(int(r[-1]) + 1 for r in self.ranks)

    @staticmethod
    def _places(h: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(h + np.uint64((level + 1) * _STEP % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray, room: float = 1.6) -> PerfectHash:
        """h: distinct numbers."""
        levels, left = [], h.astype(np.uint64)
        while len(left):
            if len(levels) > 200:
                raise ValueError("keys share a 64-bit hash")
            size = max(8, int(room * len(left)))
            at = cls._places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, h: np.ndarray) -> np.ndarray:
        out, left, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for k, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._places(h[left], k, len(bits))
            hit = bits[at]
            out[left[hit]] = base + rank[at[hit]]
            left, base = left[~hit], base + int(rank[-1]) + 1
        return out

    def tobytes(self) -> bytes:
        head = struct.pack(f"<I{len(self.levels)}Q", len(self.levels), *map(len, self.levels))
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def frombytes(cls, raw: bytes) -> PerfectHash:
        (k,) = struct.unpack_from("<I", raw)
        sizes, at, levels = struct.unpack_from(f"<{k}Q", raw, 4), 4 + 8 * k, []
        for n in sizes:
            m = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, m, at), count=n).astype(bool))
            at += m
        return cls(levels)
