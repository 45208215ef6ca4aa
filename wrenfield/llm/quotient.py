"""Counting quotient filters over packed word-id n-grams, without loss.

Word ids of ``bits`` bits are packed into lanes of at most 64 bits. The first lane, mixed with the others, is permuted by an invertible
function, so that keys spread evenly and still can be read back. Its highest bits are the *bucket*, under which filters of
several shards are brought together, the next ones the *quotient*, the others the *remainder*, kept in full. A filter holds the keys of a bucket
in order: each quotient's number of keys in unary, the remainders and further lanes in as many bytes as they need, and a counter of one byte for each key, with
larger counts in a list. The order of keys does not depend on the number of quotient bits, which follows the number of keys; so filters of any
shards and sizes are merged by merging their sorted keys.
"""

from __future__ import annotations

import struct

import numpy as np

from .words import mix

#: Odd multipliers of the permutation.
_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_HEAD = "<IBBI"


def lanes(n: int, bits: int) -> list[int]:
    """How many ids each lane holds."""
    each = max(1, 64 // bits)
    return [min(each, n - i) for i in range(0, n, each)]


def _mask(w: int) -> np.uint64:
    return np.uint64((1 << w) - 1)


def _other(keys: np.ndarray, w: int) -> np.ndarray:
    out = np.zeros(keys.shape[1], np.uint64)
    for k in keys[1:]:
        out = mix(out + k)
    return out & _mask(w)


def packed(ids: np.ndarray, bits: int) -> np.ndarray:
    """Permuted keys (lane, key) of n-grams (word, n-gram)."""
    out, at = [], 0
    for k in lanes(len(ids), bits):
        x = np.zeros(ids.shape[1], np.uint64)
        for row in ids[at : at + k]:
            x = (x << np.uint64(bits % 64)) | row.astype(np.uint64) if k > 1 else row.astype(np.uint64)
        out.append(x)
        at += k
    keys = np.stack(out)
    w = lanes(len(ids), bits)[0] * bits
    x, half = keys[0] ^ _other(keys, w), np.uint64((w + 1) // 2)
    for odd in _ODD:
        x = (x ^ (x >> half)) * np.uint64(odd) & _mask(w)
    keys[0] = x ^ (x >> half)
    return keys


def unpacked(keys: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The n-grams of permuted keys."""
    w = lanes(n, bits)[0] * bits
    half = np.uint64((w + 1) // 2)
    x = keys[0] ^ (keys[0] >> half)
    for odd in reversed(_ODD):
        x = x * np.uint64(pow(odd, -1, 1 << 64)) & _mask(w)
        x = x ^ (x >> half)
    first = x ^ _other(keys, w)
    out = []
    for lane, k in zip((first, *keys[1:]), lanes(n, bits)):
        out += [(lane >> np.uint64(bits * j if k > 1 else 0)) & _mask(bits) for j in range(k - 1, -1, -1)]
    return np.stack(out).astype(np.int64)


def ordered(keys: np.ndarray) -> np.ndarray:
    return np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their counts, and the number of each given key among them."""
    order = ordered(keys)
    keys = keys[:, order]
    new = np.ones(keys.shape[1], bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    if not len(begins):
        return keys, np.zeros(0, np.int64), number
    total = np.diff(np.append(begins, len(order))) if counts is None else np.add.reduceat(counts[order], begins)
    return keys[:, new], total.astype(np.int64), number


def bucket_bits(n: int, bits: int, wanted: int) -> int:
    """Bits of the bucket of n-grams of n words, ``wanted`` if the keys have as many."""
    return min(wanted, lanes(n, bits)[0] * bits, 31)


def buckets(keys: np.ndarray, n: int, bits: int, p: int) -> np.ndarray:
    w = lanes(n, bits)[0] * bits
    return (keys[0] >> np.uint64(w - p)).astype(np.int64) if p else np.zeros(keys.shape[1], np.int64)


def encode(keys: np.ndarray, counts: np.ndarray, n: int, bits: int, p: int) -> bytes:
    """A filter of distinct ordered keys of one bucket."""
    own = lanes(n, bits)
    m, below = keys.shape[1], own[0] * bits - p
    rest = min(7, below // 8)  # bytes of the remainder, so that there are about as many quotients as keys
    while rest and below - 8 * rest < max(1, m.bit_length() - 4):
        rest -= 1
    while below - 8 * rest > 24:  # few keys of many bits: the metadata stays small
        rest += 1
    q = below - 8 * rest
    value = keys[0] & _mask(below)
    slots = np.zeros(m + (1 << q), bool)
    slots[((value >> np.uint64(8 * rest)) if rest < 8 else np.zeros(m, np.uint64)).astype(np.int64) + np.arange(m)] = True
    parts = [np.packbits(slots).tobytes(), value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :rest].tobytes()]
    for lane, k in zip(keys[1:], own[1:]):
        parts.append(lane.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (k * bits + 7) // 8].tobytes())
    many = counts >= 255
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[many].astype("<i8").tobytes()]
    return struct.pack(_HEAD, m, q, rest, int(many.sum())) + b"".join(parts)


def decode(data: bytes, n: int, bits: int, p: int, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a filter."""
    own = lanes(n, bits)
    m, q, rest, many = struct.unpack_from(_HEAD, data)
    at = struct.calcsize(_HEAD)

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    def numbers(width: int) -> np.ndarray:
        out = np.zeros((m, 8), np.uint8)
        out[:, :width] = take(m * width).reshape(m, width)
        return out.view("<u8").ravel()

    slots = np.flatnonzero(np.unpackbits(take((m + (1 << q) + 7) // 8), count=m + (1 << q)))
    keys = [np.uint64(bucket << (own[0] * bits - p)) | ((slots - np.arange(m)).astype(np.uint64) << np.uint64(8 * rest if rest < 8 else 0)) | numbers(rest)]
    keys += [numbers((k * bits + 7) // 8) for k in own[1:]]
    counts = take(m).astype(np.int64)
    counts[counts == 255] = take(8 * many).view("<i8")
    return np.stack(keys), counts
