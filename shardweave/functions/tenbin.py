"""Tenbin: lists of arrays as chunks of magic, length and data padded to 64 bytes.

Every array is two chunks: a header of 64-bit integers (type, info, rank, sides) and its raw data.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterable, Iterator

import numpy as np

MAGIC = b"~TenBin~"
ALIGN = 64
# Short names of the element types.
TYPES = {"float16": "f2", "float32": "f4", "float64": "f8", "int8": "i1", "int16": "i2", "int32": "i4", "int64": "i8", "uint8": "u1", "uint16": "u2", "uint32": "u4", "uint64": "u8"}


def _word(text: str) -> bytes:
    raw = text.encode("ascii")
    if len(raw) > 8:
        raise ValueError(f"{text!r} has more than 8 characters")
    return raw.ljust(8, b"\0")


def padded(n: int, k: int = ALIGN) -> int:
    return -(-n // k) * k


def write_chunk(stream: io.IOBase, data: bytes) -> None:
    stream.write(MAGIC + struct.pack("<q", len(data)) + data + bytes(padded(len(data)) - len(data)))


def read_chunks(stream: io.IOBase) -> Iterator[bytes]:
    while head := stream.read(16):
        if len(head) < 16 or head[:8] != MAGIC:
            raise ValueError("this is no tenbin chunk")
        n = struct.unpack("<q", head[8:])[0]
        data = stream.read(padded(n))
        if n < 0 or len(data) < n:
            raise ValueError("a tenbin chunk is cut short")
        yield data[:n]


def encode(arrays: Iterable[np.ndarray], infos: Iterable[str] | None = None) -> bytes:
    """Arrays of rank below 10, with an info of up to 8 ASCII characters each."""
    out, arrays = io.BytesIO(), list(arrays)
    names = [""] * len(arrays) if infos is None else list(infos)
    if len(names) != len(arrays):
        raise ValueError("there must be as many infos as arrays")
    for a, info in zip(arrays, names, strict=True):
        a = np.asarray(a)
        if a.ndim >= 10 or a.dtype.name not in TYPES:
            raise ValueError(f"an array of type {a.dtype} and rank {a.ndim} can't be stored")
        write_chunk(out, _word(TYPES[a.dtype.name]) + _word(info) + struct.pack(f"<{1 + a.ndim}q", a.ndim, *a.shape))
        write_chunk(out, np.ascontiguousarray(a).tobytes())
    return out.getvalue()


def decode(data: bytes, with_infos: bool = False) -> list:
    """The arrays, or (array, info) pairs."""
    out, chunks = [], read_chunks(io.BytesIO(data))
    for head in chunks:
        body = next(chunks, None)
        if body is None or len(head) < 24:
            raise ValueError("a tenbin array has no data")
        rank = struct.unpack("<q", head[16:24])[0]
        shape = struct.unpack(f"<{rank}q", head[24 : 24 + 8 * rank])
        kind = head[:8].rstrip(b"\0").decode("ascii")
        if kind not in TYPES.values():
            raise ValueError(f"unknown tenbin type {kind!r}")
        a = np.frombuffer(body, dtype=f"<{kind}").reshape(shape)
        out.append((a, head[8:16].rstrip(b"\0").decode("ascii")) if with_infos else a)
    return out
