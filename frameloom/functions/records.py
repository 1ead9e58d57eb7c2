"""Bytes of episode records: the checksum and framing of record files, and examples in protocol buffers' wire format. For use inside tasks; NumPy only."""

from __future__ import annotations

import struct
from collections.abc import Mapping, Sequence
from functools import cache

import numpy as np

#: The reversed polynomial of CRC-32C, and what masks a checksum that stands beside its data.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
#: Data is cut into so many lanes, whose checksums NumPy makes side by side.
LANES = 512


@cache
def byte_table() -> np.ndarray:
    """What each byte does to the checksum, from the polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return t


def _times(columns: np.ndarray, v: int) -> int:
    """A linear map of 32 bits, by its columns, applied to v."""
    out, i = 0, 0
    while v:
        if v & 1:
            out ^= int(columns[i])
        v, i = v >> 1, i + 1
    return out


@cache
def zeros(n: int) -> np.ndarray:
    """The linear map that n zero bytes are to a checksum, by repeated squaring."""
    if n == 1:
        t = byte_table()
        return np.array([(1 << i >> 8) ^ int(t[(1 << i) & 255]) for i in range(32)], dtype=np.uint32)
    half = zeros(n // 2)
    both = [_times(half, int(c)) for c in half]
    return np.array([_times(zeros(1), c) for c in both] if n % 2 else both, dtype=np.uint32)


def crc32c(data: bytes) -> int:
    """CRC-32C. It is linear: lanes are summed side by side from zero and joined by the maps of the lanes that follow; the start value passes through the whole length."""
    if not data:
        return 0
    t, size = byte_table(), -(-len(data) // LANES) if len(data) >= 4 * LANES else len(data)
    padded = np.zeros(-(-len(data) // size) * size, dtype=np.uint8)
    # zeros in front change nothing where a sum starts from zero
    padded[len(padded) - len(data) :] = np.frombuffer(data, dtype=np.uint8)
    lanes = padded.reshape(-1, size)
    sums = np.zeros(len(lanes), dtype=np.uint32)
    for column in lanes.T:
        sums = (sums >> np.uint32(8)) ^ t[(sums ^ column) & np.uint32(255)]
    whole = 0
    for s in sums.tolist():
        whole = _times(zeros(size), whole) ^ s
    return whole ^ _times(zeros(len(data)), 0xFFFFFFFF) ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    c = crc32c(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def framed(data: bytes) -> bytes:
    """A record: its length, the length's checksum, the data, the data's checksum."""
    size = struct.pack("<Q", len(data))
    return size + struct.pack("<I", masked(size)) + data + struct.pack("<I", masked(data))


def varint(v: int) -> bytes:
    """Seven bits a byte, the lowest first; negative numbers as 64 bits."""
    v, out = v & 0xFFFFFFFFFFFFFFFF, bytearray()
    while v > 127:
        out.append(v & 127 | 128)
        v >>= 7
    out.append(v)
    return bytes(out)


def field(number: int, data: bytes) -> bytes:
    """A field of bytes, with its length."""
    return varint(number << 3 | 2) + varint(len(data)) + data


def feature(value) -> bytes:
    """A feature of bytes and strings (1), floats (2) or integers and booleans (3), one or a sequence of them; None is a feature without a kind."""
    values = list(value) if isinstance(value, Sequence) and not isinstance(value, (bytes, bytearray, str)) else [value]
    values = [v for v in values if v is not None]
    if not values:
        return b""
    if isinstance(values[0], (bytes, bytearray, str)):
        return field(1, b"".join(field(1, v.encode() if isinstance(v, str) else bytes(v)) for v in values))
    if isinstance(values[0], float):
        return field(2, field(1, struct.pack(f"<{len(values)}f", *values)))
    return field(3, field(1, b"".join(varint(int(v)) for v in values)))


def example(features: Mapping[str, object]) -> bytes:
    """An example: a map from names to features, in order of name, so equal rows have equal bytes."""
    entries = (field(1, field(1, name.encode()) + field(2, feature(value))) for name, value in sorted(features.items()))
    return field(1, b"".join(entries))
