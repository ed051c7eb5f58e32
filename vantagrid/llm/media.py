"""Media columns: Netpbm and BMP pictures as arrays, NPY tiles and difference hashes.

A picture's bytes are decoded to a numpy array (height, width, channels), resized
by exact area averaging over an integral image, and stored as an NPY tile beside a
64-bit difference hash. Bytes that are no such picture give nulls and the reason in
``error``; null bytes give nulls throughout, with a null ``error``.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vantagrid.llm.common import map_arrow, utf8

#: Rows of the stored pictures are this wide; payloads are padded to a multiple of it.
WIDTH = 64
#: Side of the square tiles.
TILE = 8


class MediaError(ValueError):
    """Bytes that are no picture this module reads."""


def _netpbm_header(data: bytes) -> tuple[bytes, list[int], int]:
    kind, at, numbers = data[:2], 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])+(\d{1,9})").match(data, at)
        if not m:
            raise MediaError("netpbm header")
        numbers.append(int(m[1]))
        at = m.end()
    if kind in (b"P4", b"P5", b"P6"):
        if not data[at : at + 1].isspace():
            raise MediaError("netpbm header")
        at += 1
    if numbers[0] < 1 or numbers[1] < 1 or len(numbers) > 2 and not 0 < numbers[2] < 65536:
        raise MediaError("netpbm size")
    return kind, numbers, at


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6; 16-bit samples where the largest value asks for them. Bitmaps give 0 (black) and 255."""
    kind, numbers, at = _netpbm_header(data)
    width, height = numbers[:2]
    channels = 3 if kind in (b"P3", b"P6") else 1
    count = width * height * channels
    if kind == b"P4":
        stride = (width + 7) // 8
        raw = np.frombuffer(data, np.uint8, offset=at)
        if raw.size < stride * height:
            raise MediaError("netpbm data end early")
        bits = np.unpackbits(raw[: stride * height].reshape(height, stride), axis=1)[:, :width]
        return ((1 - bits) * 255).astype(np.uint8)[:, :, None]
    if kind in (b"P5", b"P6"):
        unit = np.dtype(">u2") if numbers[2] > 255 else np.dtype(np.uint8)
        if len(data) - at < count * unit.itemsize:
            raise MediaError("netpbm data end early")
        raw = np.frombuffer(data, unit, count, at)
        return raw.astype(unit.newbyteorder("="), copy=False).reshape(height, width, channels)
    body = re.sub(rb"#[^\n\r]*", b"", data[at:])
    if kind == b"P1":
        bits = np.frombuffer(re.sub(rb"[^01]", b"", body), np.uint8)[:count]
        if bits.size < count:
            raise MediaError("netpbm data end early")
        return ((49 - bits) * 255).astype(np.uint8).reshape(height, width, 1)
    values = body.split()[:count]
    if len(values) < count:
        raise MediaError("netpbm data end early")
    samples = np.array([int(v) for v in values])
    if samples.max() > numbers[2]:
        raise MediaError("netpbm sample above the largest value")
    return samples.astype(np.uint16 if numbers[2] > 255 else np.uint8).reshape(height, width, channels)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits; colours come out as red, green, blue."""
    try:
        offset, head = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
        if head == 12:
            width, height, _, depth = struct.unpack_from("<HHHH", data, 18)
            packed, used, entry = 0, 0, 3
        else:
            width, height, _, depth, packed = struct.unpack_from("<iiHHI", data, 18)
            used, entry = struct.unpack_from("<I", data, 46)[0], 4
    except struct.error:
        raise MediaError("bmp header") from None
    if packed not in (0, 3) or packed == 3 and depth != 32 or depth not in (1, 4, 8, 24, 32):
        raise MediaError("bmp kind")
    if width < 1 or height == 0:
        raise MediaError("bmp size")
    rows, stride = abs(height), (width * depth + 31) // 32 * 4
    if len(data) - offset < rows * stride:
        raise MediaError("bmp data end early")
    raw = np.frombuffer(data, np.uint8, rows * stride, offset).reshape(rows, stride)
    if depth >= 24:
        out = raw[:, : width * depth // 8].reshape(rows, width, depth // 8)[:, :, 2::-1]
    else:
        bits = np.unpackbits(raw, axis=1)[:, : width * depth].reshape(rows, width, depth)
        index = bits @ (1 << np.arange(depth)[::-1])
        colours = used or 1 << depth
        start = 14 + head
        if start + colours * entry > len(data) or index.max() >= colours:
            raise MediaError("bmp palette")
        palette = np.frombuffer(data, np.uint8, colours * entry, start).reshape(colours, entry)
        out = palette[index][:, :, 2::-1]
    return np.ascontiguousarray(out if height < 0 else out[::-1])


def decode(data: bytes) -> np.ndarray:
    if data[:1] == b"P" and data[1:2] in b"123456" and data[1:2]:
        return decode_netpbm(data)
    if data[:2] == b"BM":
        return decode_bmp(data)
    raise MediaError("unknown kind")


def _summed(image: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The integral along the first axis at fractional points; whole rows are added up between the points only."""
    low = np.minimum(points.astype(np.int64), len(image) - 1)
    starts, at = np.unique(np.append(0, low), return_inverse=True)
    sums = np.stack([image[a:z].sum(axis=0, dtype=np.float64) for a, z in zip(starts, np.append(starts[1:], len(image)), strict=True)])
    before = np.cumsum(sums, axis=0) - sums
    return before[at[1:]] + (points - low)[:, None, None] * image[low]


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each target cell's exact area, read off an integral image at the cells' fractional corners.

    The integral is kept at the corners' rows and columns alone, so a long picture takes no more room.
    """
    h, w = image.shape[:2]
    down = _summed(image, np.linspace(0, h, height + 1))
    both = _summed(down.transpose(1, 0, 2), np.linspace(0, w, width + 1)).transpose(1, 0, 2)
    sums = np.diff(np.diff(both, axis=0), axis=1)
    return sums * (height * width / (h * w))


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each cell of an 8 by 9 reduction is darker than its right neighbour."""
    grey = np.round(area_resize(image, 8, 9).mean(axis=2), 6)
    return np.packbits(grey[:, 1:] > grey[:, :-1]).tobytes().hex()


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def tile(image: np.ndarray, side: int = TILE) -> bytes:
    """An NPY file of the picture reduced to ``side`` by ``side`` cells, in its own sample type."""
    return npy(np.rint(area_resize(image, side, side)).astype(image.dtype))


def encode_pgm(payload: bytes, width: int = WIDTH) -> bytes:
    """Bytes, a positive multiple of ``width``, as the samples of a grey picture."""
    return b"P5\n%d %d\n255\n" % (width, len(payload) // width) + payload


def encode_bmp(image: np.ndarray) -> bytes:
    """A picture of red, green and blue bytes as a BMP of 24 bits, its last row first."""
    height, width = image.shape[:2]
    rows = np.pad(image[::-1, :, ::-1].reshape(height, width * 3), ((0, 0), (0, -3 * width % 4)))
    head = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, rows.size, 0, 0, 0, 0)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + head + rows.astype(np.uint8).tobytes()


def encode_ppm(image: np.ndarray) -> bytes:
    """A picture of red, green and blue bytes as a binary pixmap."""
    return b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + image.astype(np.uint8).tobytes()


MEDIA_SCHEMA = "height int, width int, channels int, dhash string, tile binary, error string"


def describe(content: bytes | None) -> tuple:
    """One row of MEDIA_SCHEMA."""
    if content is None:
        return (None,) * 6
    try:
        image = decode(content)
    except MediaError as e:
        return (None,) * 5 + (str(e),)
    return (*image.shape, difference_hash(image), tile(image), None)


def media_columns(df: DataFrame, id_col: str, content_col: str) -> DataFrame:
    """(id, MEDIA_SCHEMA) of a column of pictures; one row for each input row."""
    src = df.select(df[id_col].alias("id"), df[content_col].cast("binary").alias("content"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [describe(x) for x in batch.column(1).to_pylist()]
        types = [pa.int32()] * 3 + [pa.string(), pa.binary(), pa.string()]
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], ["id", "height", "width", "channels", "dhash", "tile", "error"])

    return map_arrow(src, run, f"id {kind}, {MEDIA_SCHEMA}").withColumnRenamed("id", id_col)


def text_pictures(df: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, content) of each text as a grey picture: UTF-8, zero bytes up to a positive multiple of 64.

    A null or empty text gives one row of zeros.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, out = [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            n.append(len(text))
            out.append(encode_pgm(text + bytes(-len(text) % WIDTH if text else WIDTH)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n_bytes", "content"])

    return map_arrow(df.select(df["doc_id"].cast("long").alias("doc_id"), utf8().alias("text")), run, "doc_id long, n_bytes long, content binary")


def vector_pictures(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, bmp, ppm): each vector as a colour picture of rows of 16 pixels, every three numbers of -1 to 1 a pixel; null and empty vectors give nulls."""
    src = df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("vector"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bmp, ppm = [], []
        for vector in batch.column(1).to_pylist():
            values = np.clip(np.rint((np.nan_to_num(np.array(vector or [], float)) + 1) * 127.5), 0, 255).astype(np.uint8)
            image = np.pad(values, (0, -len(values) % 48)).reshape(-1, 16, 3)
            bmp.append(encode_bmp(image) if len(values) else None)
            ppm.append(encode_ppm(image) if len(values) else None)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(bmp, pa.binary()), pa.array(ppm, pa.binary())], ["id", "bmp", "ppm"])

    return map_arrow(src, run, f"id {kind}, bmp binary, ppm binary").withColumnRenamed("id", id_col)


def stored_texts(df: DataFrame) -> DataFrame:
    """Each text stored as a picture, read back, and described; see op8's contract in ``queries``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for content in batch.column(2).to_pylist():
            image = decode(content)
            back = image.tobytes()
            small = tile(image)
            rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(content), hashlib.sha256(content).hexdigest(), f"{difference_hash(image)}-{small[-TILE * TILE:].hex()}", small))
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile"])

    return map_arrow(text_pictures(df), run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary")
