"""Bit-packed Elias-delta streams of ascending ids, for whole Arrow batches.

The stream of a list is the concatenation of the codes of its ids, most significant bit first
(:func:`quarry.functions.text.elias_delta` gives the same codes as strings).  The code of 0 is a
prefix of others; as ids ascend, zeros come first, and their number is kept beside the stream.
"""

from __future__ import annotations

import numpy as np


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each positive number, exact to 2^63."""
    if len(values) and values.max() < 1 << 53:      # a double holds it
        return np.frexp(values.astype(np.float64))[1].astype(np.int64)
    out = np.zeros(len(values), np.int64)
    left = values.astype(np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        high = left >= np.uint64(1) << np.uint64(step)
        out[high] += step
        left = np.where(high, left >> np.uint64(step), left)
    return out + (left > 0)


#: Bits of a code that fit in eight bytes wherever in its first byte it begins.
_WINDOW = 57


def _pack_words(ids: np.ndarray, length: np.ndarray, width: np.ndarray, at: np.ndarray, n_bytes: int) -> np.ndarray:
    """Bytes with each code, a number of ``width`` bits, at bit ``at``: eight bytes of each are added to
    the stream, where codes that share a byte have no bit in common."""
    word = np.where(ids == 0, 0, (length << (length - 1)) + ids - (np.int64(1) << (length - 1)))
    placed = word.astype(np.uint64) << (64 - (at & 7) - width).astype(np.uint64)
    parts, first = placed.astype(">u8").view(np.uint8).reshape(-1, 8), at >> 3
    out = np.zeros(n_bytes + 8)
    for k in range(8):
        out += np.bincount(first + k, weights=parts[:, k], minlength=n_bytes + 8)
    return out[:n_bytes].astype(np.uint8)


def pack(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Streams of consecutive lists: bytes of all (each list begins a byte), first byte of each and
    of the end, and bits of each.  ``starts`` are the places where lists begin, from 0."""
    length = np.maximum(_bit_lengths(ids), 1)
    head = 2 * _bit_lengths(length) - 1          # the code of the length ...
    width = np.where(ids == 0, 1, head + length - 1)     # ... and the number without its first bit
    list_bits = np.add.reduceat(width, starts)
    first_byte = np.concatenate([[0], np.cumsum((list_bits + 7) // 8)])
    before = np.cumsum(width) - width
    sizes = np.diff(np.append(starts, len(ids)))
    at = before - np.repeat(before[starts], sizes) + np.repeat(first_byte[:-1] * 8, sizes)
    if len(ids) and width.max() <= _WINDOW:
        return _pack_words(ids, length, width, at, int(first_byte[-1])), first_byte, list_bits
    bits = np.zeros(int(first_byte[-1]) * 8, np.uint8)
    some = np.flatnonzero(ids)
    for value, n, begin in ((length[some], head[some], at[some]),
                            (ids[some], length[some] - 1, at[some] + head[some])):
        total = np.cumsum(n)
        place = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - n, n)
        shift = np.repeat(n - 1, n) - place
        bits[np.repeat(begin, n) + place] = (np.repeat(value, n) >> shift) & 1
    return np.packbits(bits), first_byte, list_bits


def unpack(stream: bytes, n: int, zeros: int) -> tuple[list[int], list[str]]:
    """The ``n`` ids of a stream, the first ``zeros`` of them 0, and the code of each as it is stored."""
    bits = bin(int.from_bytes(b"\x01" + stream, "big"))[3:]
    ids, codes, at = [0] * zeros, ["0"] * zeros, zeros
    for _ in range(n - zeros):
        one = bits.index("1", at)
        tail = 2 * one - at + 1
        end = tail + int(bits[one:tail], 2) - 1
        ids.append(int("1" + bits[tail:end], 2))
        codes.append(bits[at:end])
        at = end
    return ids, codes
