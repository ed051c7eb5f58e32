"""Raster operators over tables: the kernels of ``functions.raster`` in Arrow batches, one frame at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantagrid.functions import raster
from vantagrid.schemas import ANNOTATION

#: Decoded frames in one Arrow batch: two frames of 1080 lines are 12 MB.
FRAMES_PER_BATCH = 16


def with_lit(frames: DataFrame, threshold: int, key: str) -> DataFrame:
    """(key, n_lit, lit_sum): lit pixels of frames (key, pixels array<int>, width), and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(int(lit.sum()), int(pixels[lit].sum())) for pixels in _rows(b.column(1)) for lit in [raster.binarise(pixels[None], threshold)[0]]]
            cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["k", "n_lit", "lit_sum"])

    src = frames.select(F.col(key).cast("long").alias("k"), "pixels")
    return src.mapInArrow(run, "k long, n_lit long, lit_sum long").withColumnRenamed("k", key)


def with_components(frames: DataFrame, threshold: int, key: str) -> DataFrame:
    """(key, first_pixel, x, y, w, h, area): every eight-connected component of frames (key, pixels array<int>, width)."""

    def one(pixels: np.ndarray) -> list[raster.Box]:
        return raster.components(raster.binarise(pixels, threshold))

    return _boxes(frames, key, one)


def with_instances(frames: DataFrame, threshold: int, min_box_area: int, key: str) -> DataFrame:
    """(key, x, y, w, h, area, components): the object of each frame that has one."""

    def one(pixels: np.ndarray) -> list[raster.Box]:
        return raster.instances(raster.binarise(pixels, threshold), min_box_area)

    return _boxes(frames, key, one)


def _rows(lists: pa.ListArray) -> Iterator[np.ndarray]:
    """The lists of a column as arrays on its values; null lists are empty."""
    lists = lists.fill_null([])
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return (values[a:z] for a, z in zip(offsets, offsets[1:], strict=False))


def _boxes(frames: DataFrame, key: str, one: Callable[[np.ndarray], list[raster.Box]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, pixels, width in zip(b.column(0).to_pylist(), _rows(b.column(1)), b.column(2).to_pylist(), strict=True):
                image = pixels.reshape(-1, width)
                rows += [(k, x.x, x.y, x.w, x.h, x.mask_area, x.components) for x in one(image)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.int32()) for i, c in enumerate(cols)], ["k", "x", "y", "w", "h", "mask_area", "components"])

    src = frames.select(F.col(key).cast("long").alias("k"), "pixels", "width")
    return src.mapInArrow(run, "k long, x int, y int, w int, h int, mask_area int, components int").withColumnRenamed("k", key)


def contrast_sums(frames: DataFrame, threshold: int, key: str, core_alpha: int, ring_px: int, min_core_px: int) -> DataFrame:
    """(key, core_sum, core_n, ring_sum, ring_n): exact sums behind the contrast of frames (key, plane, pixels, width)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, plane, pixels, width in zip(b.column(0).to_pylist(), _rows(b.column(1)), _rows(b.column(2)), b.column(3).to_pylist(), strict=True):
                alpha, grey = pixels.reshape(-1, width), plane.reshape(-1, width)
                lit = raster.binarise(alpha, threshold)
                for box in raster.instances(lit, 1):
                    maps = raster.sampled(alpha, lit, box, core_alpha, ring_px, min_core_px)
                    if maps is not None:
                        rows.append((k, int(grey[maps[0]].sum()), int(maps[0].sum()), int(grey[maps[1]].sum()), int(maps[1].sum())))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["k", "core_sum", "core_n", "ring_sum", "ring_n"])

    src = frames.select(F.col(key).cast("long").alias("k"), "plane", "pixels", "width")
    return src.mapInArrow(run, "k long, core_sum long, core_n long, ring_sum long, ring_n long").withColumnRenamed("k", key)


def image_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """A decoded image struct as (height, width, 3) in blue, green, red; grey is repeated and alpha dropped."""
    image = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(image, 3, axis=2) if channels == 1 else image[:, :, :3]


def annotate(pairs: DataFrame, threshold: int, min_box_area: int, class_id: int, draw: Callable[[np.ndarray, list[dict]], bytes] | None = None) -> DataFrame:
    """(run_id, problem, annotation columns, drawn) of image pairs (run_id, frame_index, normal_name, normal, mask).

    ``normal`` and ``mask`` are image structs. ``problem`` says why a pair has no
    annotation; the caller refuses the run. ``drawn`` is what ``draw`` makes of the
    normal image and its boxes, while both are at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # frame by frame, so that one pair of images is in Python's hands at a time
            out = [_annotated(b.slice(k, 1).to_pylist()[0], threshold, min_box_area, class_id, draw) for k in range(b.num_rows)]
            yield pa.RecordBatch.from_pylist(out, schema=_ANNOTATED)

    spark = pairs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(FRAMES_PER_BATCH))
    parts = [F.struct(*[F.col(f"{side}.{c}").alias(c) for c in ("height", "width", "nChannels", "data")]).alias(side) for side in ("normal", "mask")]
    src = pairs.select("run_id", F.col("frame_index").cast("int").alias("frame_index"), "normal_name", *parts)
    return src.mapInArrow(run, f"run_id string, problem string, {ANNOTATION}, drawn binary")


_BOX_TYPE = pa.struct([(c, pa.int32()) for c in ("class_id", "x", "y", "w", "h", "mask_area")] + [("fill_ratio", pa.float64()), ("components", pa.int32()), ("contrast", pa.float64())])
_ANNOTATED = pa.schema([("run_id", pa.string()), ("problem", pa.string()), ("frame_index", pa.int32()), ("normal", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("boxes", pa.list_(_BOX_TYPE)), ("drawn", pa.binary())])


def _annotated(row: dict, threshold: int, min_box_area: int, class_id: int, draw: Callable | None) -> dict:
    out = {"run_id": row["run_id"], "problem": None, "frame_index": row["frame_index"], "normal": row["normal_name"], "width": None, "height": None, "boxes": [], "drawn": None}
    sizes = {s: (row[s]["width"], row[s]["height"]) for s in ("normal", "mask")}
    for side, (width, height) in sizes.items():
        if width < 0 or height < 0:
            return out | {"problem": f"frame {row['frame_index']}: the {side} image cannot be read"}
    if sizes["normal"] != sizes["mask"]:
        return out | {"problem": f"frame {row['frame_index']}: normal is {sizes['normal']}, mask is {sizes['mask']}"}
    normal, mask = (image_array(row[s]["height"], row[s]["width"], row[s]["nChannels"], row[s]["data"]) for s in ("normal", "mask"))
    lit = raster.binarise(mask, threshold)
    boxes = []
    for box in raster.instances(lit, min_box_area):
        seen = raster.contrast(normal, mask, lit, box)
        boxes.append(
            {
                "class_id": class_id,
                "x": box.x,
                "y": box.y,
                "w": box.w,
                "h": box.h,
                "mask_area": box.mask_area,
                "fill_ratio": round(box.fill_ratio, 4),
                "components": box.components,
                "contrast": None if seen is None else round(seen, 2),
            }
        )
    return out | {"width": sizes["normal"][0], "height": sizes["normal"][1], "boxes": boxes, "drawn": draw(normal, boxes) if draw else None}


def sky_tints(images: DataFrame, rows: int = 300) -> DataFrame:
    """(run_id, tint): mean blue less red over the top rows of images (run_id, image struct)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(r["run_id"], raster.sky_tint(image_array(r["height"], r["width"], r["channels"], r["data"]), rows)) for r in b.to_pylist() if r["height"] > 0]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["run_id", "tint"])

    images.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(FRAMES_PER_BATCH))
    src = images.select("run_id", F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))
    return src.mapInArrow(run, "run_id string, tint double")
