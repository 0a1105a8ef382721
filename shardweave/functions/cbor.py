"""A small CBOR codec (RFC 8949): numbers, strings, arrays, maps, tags passed through, definite and open lengths."""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

_BREAK = object()


def _head(out: bytearray, major: int, n: int) -> None:
    for width, info, form in ((24, None, None), (1 << 8, 24, ">B"), (1 << 16, 25, ">H"), (1 << 32, 26, ">I"), (1 << 64, 27, ">Q")):
        if n < width:
            out += bytes([major << 5 | (n if info is None else info)]) + (b"" if form is None else struct.pack(form, n))
            return
    raise ValueError("the number is too large")


def dumps(value: object) -> bytes:
    out = bytearray()

    def put(x: object) -> None:
        if x is None or x is True or x is False:
            out.append({None: 0xF6, True: 0xF5, False: 0xF4}[x])
        elif isinstance(x, int):
            _head(out, 0 if x >= 0 else 1, x if x >= 0 else -1 - x)
        elif isinstance(x, float):
            out.extend(b"\xfb" + struct.pack(">d", x))
        elif isinstance(x, bytes | bytearray):
            _head(out, 2, len(x))
            out.extend(x)
        elif isinstance(x, str):
            raw = x.encode()
            _head(out, 3, len(raw))
            out.extend(raw)
        elif isinstance(x, list | tuple):
            _head(out, 4, len(x))
            for y in x:
                put(y)
        elif isinstance(x, dict):
            _head(out, 5, len(x))
            for k, v in x.items():
                put(k)
                put(v)
        else:
            raise TypeError(f"{type(x).__name__} has no CBOR form")

    put(value)
    return bytes(out)


def _take(stream: io.IOBase, n: int) -> bytes:
    got = stream.read(n)
    if len(got) < n:
        raise ValueError("the CBOR data is cut short")
    return got


def _read(stream: io.IOBase, first: int) -> object:
    major, info = first >> 5, first & 31
    if first == 0xFF:
        return _BREAK
    if major == 7:
        if info in (20, 21, 22, 23):
            return {20: False, 21: True}.get(info)
        if info in (25, 26, 27):
            return struct.unpack({25: ">e", 26: ">f", 27: ">d"}[info], _take(stream, 1 << (info - 24)))[0]
        raise ValueError(f"unknown simple value {info}")
    n = info if info < 24 else None if info == 31 else int.from_bytes(_take(stream, 1 << (info - 24)))
    if major == 0:
        return n
    if major == 1:
        return -1 - n
    if major == 6:
        return _read(stream, _take(stream, 1)[0])
    parts = []
    if major in (2, 3):
        if n is None:
            while (x := _read(stream, _take(stream, 1)[0])) is not _BREAK:
                parts.append(x)
            return (b"" if major == 2 else "").join(parts)
        raw = _take(stream, n)
        return raw if major == 2 else raw.decode()
    wanted = None if n is None else n * (1 if major == 4 else 2)
    while wanted is None or len(parts) < wanted:
        if (x := _read(stream, _take(stream, 1)[0])) is _BREAK:
            break
        parts.append(x)
    return parts if major == 4 else dict(zip(parts[::2], parts[1::2], strict=True))


def load_all(stream: io.IOBase) -> Iterator[object]:
    """Objects one after the other until the stream ends."""
    while first := stream.read(1):
        yield _read(stream, first[0])


def loads(data: bytes) -> object:
    return next(load_all(io.BytesIO(data)))
