"""Vectorised scanning of many texts at once as one UTF-8 byte array.

Every operator of this subpackage that must look at each byte of a corpus does so here:
texts of a batch are joined into one byte array, and words, hashes and windows are found by
array operations over it. Batches are cut to a bounded number of bytes, so memory does not
follow the length of a partition; a single text longer than the bound is a batch by itself.
"""

from __future__ import annotations

import numpy as np

#: Bytes of text handled at once in a Python worker.
BLOCK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
#: Random odd multipliers by place in a word; places beyond the table reuse it with a power of `_FAR`.
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_TABLE = (_PLACE[:, None] * _BYTE[None, :]) ^ ((_PLACE[:, None] + _BYTE[None, :]) >> np.uint64(17))
_FAR = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cuts(sizes: list[int], limit: int):
    """Runs of texts of about `limit` bytes, one text at least: (first index, texts)."""
    first = size = 0
    for i, n in enumerate(sizes):
        if i > first and size + n > limit:
            yield first, i - first
            first, size = i, 0
        size += n
    if len(sizes) > first:
        yield first, len(sizes) - first


def blocks(texts: list[bytes | str | None], limit: int = BLOCK_BYTES):
    """Cut a list of texts into runs of about `limit` bytes; yields (first index, UTF-8 texts). A null text is empty."""
    held = [b"" if t is None else t if isinstance(t, bytes) else t.encode() for t in texts]
    for first, n in cuts([len(b) for b in held], limit):
        yield first, held[first : first + n]


def joined(parts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte array of all texts, each followed by `gap`; starts and ends of the texts in it."""
    lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    starts = np.zeros(len(parts), np.int64)
    np.cumsum(lengths[:-1] + len(gap), out=starts[1:])
    return np.frombuffer(gap.join(parts) + gap, np.uint8), starts, starts + lengths


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask.size and mask[0]:
        edge = np.concatenate(([0], edge))
    if mask.size and mask[-1]:
        edge = np.concatenate((edge, [mask.size]))
    return edge[0::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that do not overlap and are in order (none is empty).

    A span's hash is the mixed sum of random numbers by (place, byte), so spans differ in their
    hash unless two random sums meet, about one pair in 2**64.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(total, dtype=np.int64) - np.repeat(offsets, lengths)
    if total == data.size and int(starts[0]) == 0:
        bytes_ = data
    else:
        bytes_ = data[place + np.repeat(starts, lengths)]
    if int(lengths.max()) <= 64:
        values = _TABLE.ravel()[(place << 8) | bytes_]
    else:
        far = place >> 6
        values = _TABLE.ravel()[((place & 63) << 8) | bytes_]
        late = np.flatnonzero(far)
        values[late] = mix64(values[late] + far[late].astype(np.uint64) * _FAR)
    sums = np.add.reduceat(values, offsets)
    return mix64(sums + lengths.astype(np.uint64) * _FAR)


#: Bytes of the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after A-Z became a-z).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Bytes of the words `[^\x20\x09-\x0D]+`.
SOLID = np.ones(256, bool)
SOLID[0x20] = False
SOLID[0x09:0x0E] = False


def words(parts: list[bytes], kind: np.ndarray):
    """Words of lower-cased texts: (lower-cased bytes, starts, ends, hashes, first word of each text and one past the last's)."""
    data, begin, _ = joined(parts)
    data = lower_ascii(data)
    starts, ends = runs(kind[data])
    first = np.concatenate((np.searchsorted(starts, begin), [len(starts)]))
    return data, starts, ends, span_hashes(data, starts, ends), first


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of `width` consecutive words from each word on (fewer rows than words by width - 1)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += mix64(hashes[k : k + n] + _PLACE[k % 64])
    return mix64(out)
