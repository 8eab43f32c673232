"""Word and shingle hashes of many texts at a time, in array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

CHUNK = 1 << 20  # bytes that are hashed at once
LONG_WORD = 256  # longer words are hashed one by one, for the sums below have patterns that collide in long strings

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
_BYTE = np.random.Generator(np.random.PCG64(3)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_A = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(n, b, dtype=np.uint64)
            x[0] = 1
            _powers[i] = np.cumprod(x)
    return _powers[0], _powers[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start of each word; ``data`` is lower-cased and its separators are spaces."""
    a = np.frombuffer(data, dtype=np.uint8)
    inside = np.empty(len(a) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = a != 32
    edge = np.diff(inside)
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(s):
        return np.empty(0, np.uint64), s
    up, down = _power(max(CHUNK, len(a)) + 1)
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=total[1:])
    h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    for i in np.flatnonzero(e - s > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(data[s[i] : e[i]])
    return h, s


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Joined texts of about CHUNK bytes with the texts' numbers and starts; long texts are cut between words."""
    held, who, at, size = [], [], [], 0
    for i, t in enumerate(texts):
        t = t.translate(_LOWER)
        while t:
            cut = len(t) if len(t) <= CHUNK else t.rfind(b" ", 0, CHUNK) + 1
            cut = cut or t.find(b" ", CHUNK) + 1 or len(t)
            if size + cut > CHUNK and held:
                yield b" ".join(held), who, at
                held, who, at, size = [], [], [], 0
            held.append(t[:cut])
            who.append(i)
            at.append(size)
            size += cut + 1
            t = t[cut:]
    if held:
        yield b" ".join(held), who, at


def words_of(texts: list[bytes]) -> list[np.ndarray]:
    """The word hashes of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for data, who, at in _pieces(texts):
        h, s = word_hashes(data)
        edges = np.searchsorted(s, np.array([*at, len(data) + 1]))
        for i, lo, hi in zip(who, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out[i].append(h[lo:hi])
    none = np.empty(0, np.uint64)
    return [x[0] if len(x) == 1 else np.concatenate(x) if x else none for x in out]


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``size``-word shingles; the whole sequence is one if it is shorter."""
    words = words_of(texts)
    if not words:
        return []
    flat = np.concatenate(words)
    ends = np.cumsum([len(w) for w in words])
    # shingles of all texts at once; those that reach into the next text are left out below
    full = np.full(max(0, len(flat) - size + 1), mix(np.array([size], np.uint64))[0])
    for j in range(size):
        full = mix(full * _A + flat[j : j + len(full)])
    out, lo = [], 0
    for w, hi in zip(words, ends.tolist(), strict=True):
        if len(w) >= size:
            out.append(np.unique(full[lo : hi - size + 1]))
        elif len(w):
            x = mix(np.array([len(w)], np.uint64))
            for j in range(len(w)):
                x = mix(x * _A + w[j : j + 1])
            out.append(x)
        else:
            out.append(w)
        lo = hi
    return out
