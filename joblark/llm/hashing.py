"""Vectorised hashes of bytes, words and runs of them, as numpy arrays of uint64.

Texts of a chunk lie in one buffer, one after the other; ``bounds`` says where
each one's elements (bytes or words) begin and end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
CHUNK_BYTES = 1 << 19

_ODD = (
    U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0xD6E8FEB86659FD93),
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over the word."""
    x = x ^ (x >> U(30))
    x *= _ODD[1]
    x ^= x >> U(27)
    x *= _ODD[2]
    x ^= x >> U(31)
    return x


BYTE_HASH = mix((np.arange(256, dtype=U) + U(1)) * _ODD[0])

# The six ASCII characters that separate words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def join_runs(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of runs of length a + step from hashes of runs of length a >= step."""
    if len(h) <= step:
        return h[:0]
    out = h[:-step] * _ODD[step % 3]
    out += h[step:]
    out ^= out >> U(29)
    out *= _ODD[3]
    return out


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` elements, by doubling."""
    size = 1
    while size * 2 <= length:
        h = join_runs(h, size)
        size *= 2
    return join_runs(h, length - size) if size < length else h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width and len(v) > size:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    if rest:
        v = np.minimum(v[:-rest], v[rest:]) if len(v) > rest else v[:0]
    return v


def chunks(rows: Iterator[tuple], size: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Rows whose last field is bytes, in lists of about ``size`` bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[-1])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def byte_elements(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Element hashes of the texts' bytes, and each text's first and past-last element."""
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lens)
    return BYTE_HASH[np.frombuffer(b"".join(texts), dtype=np.uint8)], ends - lens, ends


def word_elements(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for words, which ASCII white space separates."""
    buf = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = IS_SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edge[::2], edge[1::2]
    # text t begins after the separator that follows the text before it
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begin = np.cumsum(lens + 1) - lens
    first = np.searchsorted(starts, begin)
    last = np.searchsorted(starts, begin + lens)
    if not len(starts):
        return np.zeros(0, U), first, last
    size = stops - starts
    at = np.cumsum(size) - size
    letters = BYTE_HASH[buf[~space]]
    power = np.ones(int(size.max()), U)
    power[1:] = _ODD[0]
    np.multiply.accumulate(power, out=power)
    letters *= power[np.arange(len(letters)) - np.repeat(at, size)]
    words = np.add.reduceat(letters, at)
    return mix(words + size.astype(U) * _ODD[2]), first, last
