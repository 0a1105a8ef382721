"""Decoding and encoding of sample fields by their extension.

A field's name is the whole extension of its file (``txt.gz``).  What Spark can decode it decodes itself
(text, whole numbers, JSON); the rest goes through Arrow functions.  Codecs whose libraries are absent are
plug-ins: register them, or get an error that names the library.
"""

from __future__ import annotations

import ast
import gzip
import io
import json
import pickle
import struct
import zlib
from collections.abc import Callable
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import cbor, msgpack, tenbin

# Extensions by kind of content.
TEXT = ("txt", "text", "transcript", "html", "htm")
NUMBER = ("cls", "cls2", "class", "count", "index", "inx", "id")
JSON = ("json", "jsn")
PICKLE = ("pyd", "pickle")
TENBIN = ("ten", "tb", "tenbin")
MSGPACK = ("mp", "msg", "msgpack")
VIDEO = ("mp4", "ogv", "mjpeg", "avi", "mov", "h264", "mpg", "webm", "wmv")
AUDIO = ("flac", "mp3", "sox", "wav", "m4a", "ogg", "wma")
IMAGE = ("jpg", "jpeg", "png", "ppm", "pgm", "pbm", "pnm", "gif", "bmp", "tif", "tiff", "webp")
#: Image specs: library x element type x colour.
IMAGE_SPECS = ("l8", "rgb8", "rgba8", "l", "rgb", "rgba", *(f"{a}{b}{c}" for a in ("torch", "pil") for b in ("l", "rgb", "rgba") for c in ("8", "") if not (a == "pil" and c)))


def kind(name: str) -> str:
    """Last part of a field name."""
    return name.rsplit(".", 1)[-1]


def missing(library: str) -> Callable[[bytes], object]:
    def fail(_: bytes) -> object:
        raise ImportError(f"decoding this needs {library}; register a decoder for the extension")

    return fail


def decode_int(data: bytes) -> int:
    return int(data)


def decode_npz(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def decode_pnm(data: bytes) -> np.ndarray:
    """Binary PGM and PPM (8 bits)."""
    fields, at = [], 0
    while len(fields) < 4:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1
            continue
        end = at
        while not data[end : end + 1].isspace():
            end += 1
        fields.append(data[at:end])
        at = end
    if fields[0] not in (b"P5", b"P6") or int(fields[3]) > 255:
        raise ValueError("only binary 8-bit PGM and PPM are decoded here")
    w, h, c = int(fields[1]), int(fields[2]), 1 if fields[0] == b"P5" else 3
    a = np.frombuffer(data, np.uint8, w * h * c, at + 1)
    return a.reshape((h, w) if c == 1 else (h, w, c))


def _bytes_image(a: np.ndarray) -> np.ndarray:
    a = np.asarray(a)
    if a.dtype.kind == "f":
        if a.size and not (a.min() >= -0.001 and a.max() <= 1.001):
            raise ValueError("float images must lie between 0 and 1")
        a = (np.clip(a, 0, 1) * 255).astype(np.uint8)
    if a.ndim == 3 and a.shape[2] == 1:
        a = a[..., 0]
    if a.dtype != np.uint8 or a.ndim not in (2, 3) or (a.ndim == 3 and a.shape[2] not in (3, 4)):
        raise ValueError("the array is no grey or colour image")
    return a


def encode_pnm(a: np.ndarray) -> bytes:
    """An image as PGM or PPM; floats must lie in [-0.001, 1.001] and are scaled by 255."""
    a = _bytes_image(a)
    if a.ndim == 3 and a.shape[2] != 3:
        raise ValueError("the array is no grey or colour image")
    magic = b"P5" if a.ndim == 2 else b"P6"
    return magic + f"\n{a.shape[1]} {a.shape[0]}\n255\n".encode() + np.ascontiguousarray(a).tobytes()


_PNG = b"\x89PNG\r\n\x1a\n"
# Samples per pixel of PNG colour types.
_PNG_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def encode_png(a: np.ndarray) -> bytes:
    """A grey, colour or colour-and-alpha image (uint8, or floats in [0, 1]) as PNG."""
    a = _bytes_image(a)
    h, w, c = (*a.shape, 1) if a.ndim == 2 else a.shape
    colour = {1: 0, 3: 2, 4: 6}[c]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), a.reshape(h, w * c)], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """8-bit PNG that is not interlaced: grey, colour, palette, each with alpha or without (alpha is kept)."""
    if data[:8] != _PNG:
        raise ValueError("this is no PNG")
    at, body, palette, head = 8, b"", None, None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += part
        at += 12 + n
    if head is None or head[2] != 8 or head[6] or head[3] not in _PNG_SAMPLES:
        raise ValueError("only 8-bit PNG without interlacing is decoded here")
    w, h, c = head[0], head[1], _PNG_SAMPLES[head[3]]
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * c)
    out, above = np.empty((h, w * c), np.uint8), np.zeros(w * c, np.int64)
    for y in range(h):
        above = out[y] = _unfilter(int(rows[y, 0]), rows[y, 1:].astype(np.int64), above, c)
        above = above.astype(np.int64)
    a = out.reshape(h, w, c)
    if palette is not None and head[3] == 3:
        return palette[a[..., 0]]
    return a[..., 0] if c == 1 else np.concatenate([np.repeat(a[..., :1], 3, axis=2), a[..., 1:]], axis=2) if c == 2 else a


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, c: int) -> np.ndarray:
    if kind == 0:
        return line.astype(np.uint8)
    if kind == 1:
        return (np.cumsum(line.reshape(-1, c), axis=0) & 255).astype(np.uint8).ravel()
    if kind == 2:
        return ((line + above) & 255).astype(np.uint8)
    out = line.tolist()
    up = above.tolist()
    for i, x in enumerate(out):
        left, corner = (out[i - c], up[i - c]) if i >= c else (0, 0)
        if kind == 3:
            guess = (left + up[i]) // 2
        else:
            p = left + up[i] - corner
            far = abs(p - left), abs(p - up[i]), abs(p - corner)
            guess = left if far[0] <= far[1] and far[0] <= far[2] else up[i] if far[1] <= far[2] else corner
        out[i] = (x + guess) & 255
    return np.array(out, np.uint8)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 24 or 32 bits, as colour."""
    start, w, h, bits, packed = struct.unpack("<I", data[10:14])[0], *struct.unpack("<ii", data[18:26]), *struct.unpack("<HI", data[28:34])
    if data[:2] != b"BM" or bits not in (24, 32) or packed not in (0, 3):
        raise ValueError("only uncompressed BMP of 24 or 32 bits is decoded here")
    stride = (w * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)[:, : w * bits // 8].reshape(abs(h), w, bits // 8)
    return np.ascontiguousarray((rows[::-1] if h > 0 else rows)[..., 2::-1])


def image_array(a: np.ndarray, spec: str) -> np.ndarray:
    """A decoded image by spec: colour l, rgb or rgba; with 8 bytes, without floats in [0, 1]; torch: channels first."""
    lib = "torch" if spec.startswith("torch") else "pil" if spec.startswith("pil") else ""
    rest = spec[len(lib) :]
    colour, bytes_ = rest.rstrip("8"), rest.endswith("8") or lib == "pil"
    if colour not in ("l", "rgb", "rgba"):
        raise ValueError(f"unknown image spec {spec!r}")
    rgb = np.repeat(a[..., None], 3, axis=2) if a.ndim == 2 else a[..., :3]
    if colour == "l":
        out = a if a.ndim == 2 else np.rint(rgb @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    else:
        out = rgb if colour == "rgb" else np.concatenate([rgb, np.full((*rgb.shape[:2], 1), 255, np.uint8)], axis=2)
    out = out if bytes_ else (out / np.float32(255)).astype(np.float32)
    return np.moveaxis(out, 2, 0) if lib == "torch" and out.ndim == 3 else out


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the header of a PNG, GIF, JPEG or PNM, else None."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return struct.unpack("<HH", data[6:10])
    if data[:2] in (b"P5", b"P6"):
        h, w = decode_pnm(data).shape[:2]
        return w, h
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4])
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            at += 2 + n
    return None


Handler = Callable[[str, bytes], object]


class Codecs:
    """Decoders by extension or pattern; the one registered last wins.  ``unsafe`` allows pickles.

    ``pre`` and ``post`` are handlers (name, data) that come before and after the registry, the first that gives
    something but None wins; with ``only`` other fields stay as they are.
    """

    def __init__(self, unsafe: bool = False, pre: list[Handler] | None = None, post: list[Handler] | None = None, only: list[str] | None = None):
        self.pre, self.post, self.only = list(pre or ()), list(post or ()), None if only is None else set(only)
        self.decoders: list[tuple[str, Callable[[bytes], object]]] = []
        for exts, f in (
            (TEXT, lambda b: b.decode("utf-8")),
            (NUMBER, decode_int),
            (JSON, json.loads),
            (PICKLE, pickle.loads if unsafe else missing("Codecs(unsafe=True)")),
            (TENBIN, tenbin.decode),
            (("npy",), lambda b: np.load(io.BytesIO(b), allow_pickle=False)),
            (("npz",), decode_npz),
            (("cbor",), cbor.loads),
            (("ppm", "pgm", "pnm"), decode_pnm),
            (("png",), decode_png),
            (("bmp",), decode_bmp),
            (("pth",), missing("torch")),
            (MSGPACK, msgpack.loads),
            (VIDEO, missing("a video decoder")),
            (AUDIO, missing("an audio decoder")),
        ):
            for e in exts:
                self.register(f"*.{e}", f)

    def register(self, pattern: str, f: Callable[[bytes], object]) -> Codecs:
        """``pattern``: a glob over the dotted field name, in any case; a bare extension means its dotted suffix."""
        self.decoders.append((pattern.lower() if any(c in pattern for c in "*?[") else f"*.{pattern.lower().lstrip('.')}", f))
        return self

    def find(self, name: str) -> Callable[[bytes], object] | None:
        dotted = "." + name.rsplit("/", 1)[-1].lower()
        return next((f for p, f in reversed(self.decoders) if fnmatch(dotted, p) or fnmatch(dotted[1:], p)), None)

    def decode(self, name: str, data: object, must_decode: bool = False) -> object:
        """Unpack ``.gz``, then decode by the inner extension; the field keeps its name.  ``__``-fields are text.

        Unknown extensions stay bytes, or are an error with ``must_decode``; data that is no bytes stays as it is.
        """
        if not isinstance(data, bytes | bytearray) or data is None or (self.only is not None and name not in self.only):
            return data
        data = bytes(data)
        if name.startswith("__"):
            return data.decode("utf-8")
        for h in self.pre:
            if (got := h(name, data)) is not None:
                return got
        while name.lower().endswith(".gz"):
            data, name = gzip.decompress(data), name[:-3]
        f = self.find(name)
        if f is None:
            for h in self.post:
                if (got := h(name, data)) is not None:
                    return got
            if must_decode:
                raise ValueError(f"no decoder for {name}")
            return data
        return f(data)

    def encode(self, name: str, value: object) -> bytes:
        """The inverse; bytes pass, text is UTF-8 for any extension, ``_``-fields must be text."""
        if name.startswith("_") and not isinstance(value, str):
            raise ValueError(f"{name} must be text")
        if isinstance(value, bytes | bytearray):
            return bytes(value)
        if isinstance(value, str) and kind(name) not in JSON:
            return value.encode("utf-8")
        if name.lower().endswith(".gz"):
            return gzip.compress(self.encode(name[:-3], value), mtime=0)
        k = kind(name).lower()
        out = io.BytesIO()
        if k in NUMBER:
            return str(value).encode("ascii")
        if k in JSON:
            return json.dumps(value).encode("utf-8")
        if k in PICKLE:
            return pickle.dumps(value)
        if k in TENBIN:
            return tenbin.encode(value if isinstance(value, list) else [value])
        if k == "npy":
            np.save(out, np.asarray(value), allow_pickle=False)
            return out.getvalue()
        if k == "npz":
            np.savez(out, **value)
            return out.getvalue()
        if k == "cbor":
            return cbor.dumps(value)
        if k in ("ppm", "pgm", "pnm"):
            return encode_pnm(value)
        if k == "png":
            return encode_png(value)
        if k in MSGPACK:
            return msgpack.dumps(value)
        raise ValueError(f"no handler found for {name}")


TENSOR = T.ArrayType(T.StructType([T.StructField("dtype", T.StringType()), T.StructField("info", T.StringType()), T.StructField("shape", T.ArrayType(T.IntegerType())), T.StructField("data", T.BinaryType())]))


def text_field(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def int_field(data: Column) -> Column:
    """Whole number, blanks around it allowed; null where it is none."""
    return F.trim(F.decode(data, "UTF-8")).try_cast("bigint")


def json_field(data: Column, schema: str) -> Column:
    return F.from_json(F.decode(data, "UTF-8"), schema)


def variant_field(data: Column) -> Column:
    """JSON of unknown shape; null where it is broken."""
    return F.try_parse_json(F.decode(data, "UTF-8"))


def gunzip(data: Column) -> Column:
    @F.arrow_udf(T.BinaryType())
    def unpack(blobs: pa.Array) -> pa.Array:
        return pa.array([None if b is None else gzip.decompress(b) for b in blobs.to_pylist()], pa.binary())

    return unpack(data)


def tenbin_field(data: Column) -> Column:
    """ARRAY<STRUCT<dtype, info, shape, data>>."""

    @F.arrow_udf(TENSOR)
    def unpack(blobs: pa.Array) -> pa.Array:
        rows = [None if b is None else [{"dtype": a.dtype.name, "info": i, "shape": list(a.shape), "data": a.tobytes()} for a, i in tenbin.decode(b, True)] for b in blobs.to_pylist()]
        kinds = pa.list_(pa.struct([("dtype", pa.string()), ("info", pa.string()), ("shape", pa.list_(pa.int32())), ("data", pa.binary())]))
        return pa.array(rows, kinds)

    return unpack(data)


def floats_to_tenbin(values: Column) -> Column:
    """ARRAY<FLOAT> as a tenbin of one vector."""

    @F.arrow_udf(T.BinaryType())
    def pack(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else tenbin.encode([np.asarray(x, np.float32)]) for x in lists.to_pylist()], pa.binary())

    return pack(values)


def tenbin_to_floats(data: Column) -> Column:
    """First array of a tenbin, flattened."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def unpack(blobs: pa.Array) -> pa.Array:
        return pa.array([None if b is None else tenbin.decode(b)[0].astype(np.float32).ravel().tolist() for b in blobs.to_pylist()], pa.list_(pa.float32()))

    return unpack(data)


def literal_or_text(text: str) -> object:
    """A Python literal, or the text itself."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def encoded(value: Column, kind: str) -> Column:
    """A column of Spark type ``kind`` as the bytes of a field: text as UTF-8, numbers in digits, structures as JSON, bytes as they are."""
    if kind == "binary":
        return value
    nested = kind.startswith(("array", "map", "struct"))
    return F.encode(F.to_json(value) if nested else value.cast("string"), "UTF-8")
