"""YUV4MPEG2, the plain-text-headed format of uncompressed video: the one video format that needs no library."""

from __future__ import annotations

from io import BytesIO
from typing import BinaryIO

import numpy as np

# Horizontal and vertical cut of the colour planes, by the header's C parameter.
CHROMA = {"420": (2, 2), "420jpeg": (2, 2), "420mpeg2": (2, 2), "420paldv": (2, 2), "422": (2, 1), "444": (1, 1), "mono": (0, 0)}


class Y4M:
    """A video as frames: ``width``, ``height``, ``fps``, ``frames``; frames are read by number."""

    def __init__(self, data: bytes | BinaryIO):
        self.src = BytesIO(data) if isinstance(data, bytes | bytearray) else data
        head = self.src.readline(4096).decode("ascii", "replace").split()
        if not head or head[0] != "YUV4MPEG2":
            raise ValueError("this is no YUV4MPEG2 video")
        fields = {p[0]: p[1:] for p in head[1:]}
        self.width, self.height = int(fields["W"]), int(fields["H"])
        num, _, den = fields.get("F", "25:1").partition(":")
        self.fps = int(num) / int(den or 1)
        kind = fields.get("C", "420")
        if kind not in CHROMA:
            raise ValueError(f"colour space {kind} is not read here")
        self.cut = CHROMA[kind]
        planes = 0 if self.cut == (0, 0) else 2 * (-(-self.width // self.cut[0])) * (-(-self.height // self.cut[1]))
        self.size = self.width * self.height + planes
        self.start: list[int] = []
        while line := self.src.readline(4096):
            if not line.startswith(b"FRAME"):
                raise ValueError("a frame does not begin where it should")
            at = self.src.tell()
            end = self.src.seek(self.size, 1)
            if self.src.seek(0, 2) < end:
                break  # the last frame is cut off
            self.start.append(at)
            self.src.seek(end)

    @property
    def frames(self) -> int:
        return len(self.start)

    def read(self, i: int) -> np.ndarray:
        """Frame ``i`` as colour (height x width x 3)."""
        self.src.seek(self.start[i])
        data = np.frombuffer(self.src.read(self.size), np.uint8)
        n = self.width * self.height
        y = data[:n].reshape(self.height, self.width).astype(np.float32)
        if self.cut == (0, 0):
            return np.repeat(y.astype(np.uint8)[..., None], 3, axis=2)
        dx, dy = self.cut
        h, w = -(-self.height // dy), -(-self.width // dx)
        u, v = (p.reshape(h, w).repeat(dy, 0).repeat(dx, 1)[: self.height, : self.width].astype(np.float32) - 128 for p in (data[n : n + h * w], data[n + h * w :]))
        rgb = np.stack([y + 1.402 * v, y - 0.344136 * u - 0.714136 * v, y + 1.772 * u], axis=2)
        return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)


def encode(frames: list[np.ndarray], fps: int = 25) -> bytes:
    """Grey frames (height x width, uint8) as a video."""
    h, w = frames[0].shape
    return f"YUV4MPEG2 W{w} H{h} F{fps}:1 Cmono\n".encode() + b"".join(b"FRAME\n" + np.ascontiguousarray(f, np.uint8).tobytes() for f in frames)
