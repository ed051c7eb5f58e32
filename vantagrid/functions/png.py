"""A small PNG writer and header reader, for debug frames and fixtures."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGN = b"\x89PNG\r\n\x1a\n"
_KINDS = {1: 0, 3: 2, 4: 6}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(image: np.ndarray) -> bytes:
    """PNG of bytes (height, width[, 1 | 3 | 4]); colours in the order blue, green, red[, alpha]."""
    image = np.atleast_3d(np.ascontiguousarray(image, np.uint8))
    height, width, channels = image.shape
    if channels >= 3:
        image = image[:, :, [2, 1, 0, *range(3, channels)]]
    lines = np.zeros((height, width * channels + 1), np.uint8)
    lines[:, 1:] = image.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, _KINDS[channels], 0, 0, 0)
    return _SIGN + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def size(data: bytes) -> tuple[int, int]:
    """(width, height) from the header alone."""
    if data[:8] != _SIGN or data[12:16] != b"IHDR":
        raise ValueError("not a PNG")
    return struct.unpack(">II", data[16:24])


# A 3 by 5 font of the characters that debug captions use, rows from the top.
_FONT = {
    "0": "111 101 101 101 111",
    "1": "010 110 010 010 111",
    "2": "111 001 111 100 111",
    "3": "111 001 111 001 111",
    "4": "101 101 111 001 001",
    "5": "111 100 111 001 111",
    "6": "111 100 111 101 111",
    "7": "111 001 010 010 010",
    "8": "111 101 111 101 111",
    "9": "111 101 111 001 111",
    ".": "000 000 000 000 010",
    "f": "011 100 110 100 100",
    "i": "010 000 010 010 010",
    "l": "100 100 100 100 111",
    " ": "000 000 000 000 000",
}


def caption(image: np.ndarray, text: str, x: int, y: int, colour: tuple[int, int, int], scale: int = 2) -> None:
    """Write text with its base line at y; what falls outside is cut off."""
    for c in text:
        glyph = np.array([[int(p) for p in line] for line in _FONT.get(c, _FONT[" "]).split()], bool)
        glyph = glyph.repeat(scale, axis=0).repeat(scale, axis=1)
        for dy, dx in np.argwhere(glyph):
            py, px = y - glyph.shape[0] + dy, x + dx
            if 0 <= py < image.shape[0] and 0 <= px < image.shape[1]:
                image[py, px, :3] = colour
        x += glyph.shape[1] + scale


def outline(image: np.ndarray, x: int, y: int, w: int, h: int, colour: tuple[int, int, int]) -> None:
    """A rectangle two pixels wide with its far corner at (x + w, y + h)."""
    for left, top, right, low in ((x, y, x + w, y), (x, y + h, x + w, y + h), (x, y, x, y + h), (x + w, y, x + w, y + h)):
        image[max(top - 1, 0) : low + 1, max(left - 1, 0) : right + 1, :3] = colour
