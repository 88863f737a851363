"""Shingle sets and their sketches over batches of texts, vectorized in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")
#: Hashes are kept in this many bytes when a set is shipped; two of 10,000 shingles collide with a chance of 5e-5.
SET_BYTES = 5


class _Hashes(dict):
    """Word to 64-bit hash; emptied when it grows past its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64) after adding a salt."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``width`` consecutive words of each text, sorted within a text: the flat array, and where each text's part begins (one more than texts)."""
    flat: list[int] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        if t:
            flat += map(_HASHES.__getitem__, _WORD.findall(t.lower()))
        ends[i + 1] = len(flat)
    w = np.array(flat, np.uint64)
    if len(w) < width:
        return w[:0], np.zeros(len(texts) + 1, np.int64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends))
    n = len(w) - width + 1
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = mix(h ^ w[j : j + n], j + 1)
    same = doc[:n] == doc[width - 1 :]
    h, doc = h[same], doc[:n][same]
    order = np.argsort(h)
    order = order[np.argsort(doc[order], kind="stable")]
    h, doc = h[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[fresh], doc[fresh]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def minima(h: np.ndarray, starts: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Minimum of ``count`` random 32-bit permutations over each non-empty part: texts x count, uint32."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 2**32, count, dtype=np.uint32)
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), count), np.uint32)
    for j in range(count):
        out[:, j] = np.minimum.reduceat(x * a[j] + b[j], starts)
    return out


def hyper_registers(minimum: np.ndarray, mantissa_bits: int = 10) -> np.ndarray:
    """HyperMinHash registers: leading-zero count of the minimum (5 bits) and the mantissa bits that follow the leading one."""
    bits = (minimum.astype(np.float64) + 1).view(np.uint64)
    lead = np.uint64(31) - np.minimum((bits >> np.uint64(52)) - np.uint64(1023), np.uint64(31))
    mantissa = (bits >> np.uint64(52 - mantissa_bits)) & np.uint64((1 << mantissa_bits) - 1)
    return ((lead << np.uint64(mantissa_bits)) | mantissa).astype(np.uint16)


def low_registers(minimum: np.ndarray) -> np.ndarray:
    """b-bit minwise registers: the 16 low bits of the minimum after a finalizer."""
    return (mix(minimum.astype(np.uint64), 7) & np.uint64(0xFFFF)).astype(np.uint16)


def chance_collision(kind: str, mantissa_bits: int = 10) -> float:
    """Chance that the registers of two different minima are equal: for HyperMinHash a third of the leading-zero counts agree, then the mantissas must."""
    return 2.0**-mantissa_bits / 3 if kind == "hyper" else 2.0**-16


def pack(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).tobytes()


def unpack(b: bytes) -> np.ndarray:
    part = np.frombuffer(b, np.uint8).reshape(-1, SET_BYTES)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :SET_BYTES] = part
    return out.reshape(-1).view(np.uint64)
