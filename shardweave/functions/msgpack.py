"""MessagePack, as far as JSON-like values and bytes need it (the format is public; timestamps come as extension pairs)."""

from __future__ import annotations

import struct
from io import BytesIO

# Leading byte -> (struct format of the length or value); after the public format table.
_FIXED = {0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}
_SIZED = {0xC4: ">B", 0xC5: ">H", 0xC6: ">I", 0xD9: ">B", 0xDA: ">H", 0xDB: ">I", 0xDC: ">H", 0xDD: ">I", 0xDE: ">H", 0xDF: ">I", 0xC7: ">B", 0xC8: ">H", 0xC9: ">I"}
_EXT = {0xD4: 1, 0xD5: 2, 0xD6: 4, 0xD7: 8, 0xD8: 16}


def _take(src: BytesIO, form: str) -> int | float:
    n = struct.calcsize(form)
    data = src.read(n)
    if len(data) < n:
        raise ValueError("the data ends too early")
    return struct.unpack(form, data)[0]


def _bytes(src: BytesIO, n: int) -> bytes:
    data = src.read(n)
    if len(data) < n:
        raise ValueError("the data ends too early")
    return data


def _load(src: BytesIO) -> object:
    b = int(_take(src, ">B"))
    if b < 0x80 or b >= 0xE0:
        return b if b < 0x80 else b - 256
    if b < 0x90:
        return {_load(src): _load(src) for _ in range(b & 15)}
    if b < 0xA0:
        return [_load(src) for _ in range(b & 15)]
    if b < 0xC0:
        return _bytes(src, b & 31).decode("utf-8")
    if b in (0xC0, 0xC2, 0xC3):
        return {0xC0: None, 0xC2: False, 0xC3: True}[b]
    if b in _FIXED:
        return _take(src, _FIXED[b])
    if b in _EXT:
        return int(_take(src, ">b")), _bytes(src, _EXT[b])
    if b not in _SIZED:
        raise ValueError(f"no value begins with {b:#x}")
    n = int(_take(src, _SIZED[b]))
    if b <= 0xC6:
        return _bytes(src, n)
    if b <= 0xC9:
        return int(_take(src, ">b")), _bytes(src, n)
    if b <= 0xDB:
        return _bytes(src, n).decode("utf-8")
    return [_load(src) for _ in range(n)] if b <= 0xDD else {_load(src): _load(src) for _ in range(n)}


def loads(data: bytes) -> object:
    src = BytesIO(data)
    out = _load(src)
    if src.read(1):
        raise ValueError("there is more than one value")
    return out


def _head(n: int, short: tuple[int, int] | None, *wide: int) -> bytes:
    """Head of ``n`` elements: ``short`` is (first byte, most elements in it), ``wide`` the bytes for 1, 2, 4 bytes of length (0: none)."""
    if short and n <= short[1]:
        return bytes([short[0] | n])
    for byte, form, most in zip(wide, ("B", "H", "I"), (0xFF, 0xFFFF, 0xFFFFFFFF), strict=True):
        if byte and n <= most:
            return struct.pack(f">B{form}", byte, n)
    raise ValueError("too long")


def dumps(x: object) -> bytes:
    if x is None or isinstance(x, bool):
        return {None: b"\xc0", False: b"\xc2", True: b"\xc3"}[x]
    if isinstance(x, int):
        if -32 <= x < 128:
            return struct.pack(">b", x)
        for byte in (0xCC, 0xCD, 0xCE, 0xCF) if x > 0 else (0xD0, 0xD1, 0xD2, 0xD3):
            try:
                return bytes([byte]) + struct.pack(_FIXED[byte], x)
            except struct.error:
                continue
        raise ValueError("the number has more than 64 bits")
    if isinstance(x, float):
        return struct.pack(">Bd", 0xCB, x)
    if isinstance(x, str):
        data = x.encode("utf-8")
        return _head(len(data), (0xA0, 31), 0xD9, 0xDA, 0xDB) + data
    if isinstance(x, bytes | bytearray):
        return _head(len(x), None, 0xC4, 0xC5, 0xC6) + bytes(x)
    if isinstance(x, list | tuple):
        return _head(len(x), (0x90, 15), 0, 0xDC, 0xDD) + b"".join(map(dumps, x))
    if isinstance(x, dict):
        return _head(len(x), (0x80, 15), 0, 0xDE, 0xDF) + b"".join(dumps(k) + dumps(v) for k, v in x.items())
    raise TypeError(f"{type(x).__name__} cannot be written")
