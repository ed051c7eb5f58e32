"""Convert: runs become annotations, provenance, a quality report and debug frames.

Many runs are converted by one job, frame by frame in parallel. Everything is checked
before anything is written; a conversion overwrites an earlier one of the same name.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.config import ConvertConfig
from vantagrid.errors import ConfigRefused, ConvertRefused, FrameRefused, ManifestRefused
from vantagrid.functions import png
from vantagrid.functions.text import frame_index
from vantagrid.operators import qc
from vantagrid.operators.pairing import duplicates, paired, pairing_report
from vantagrid.operators.raster import annotate
from vantagrid.provenance import run_provenance
from vantagrid.schemas import BOX_FIELDS, FRAME_FIELDS, MANIFEST, PROVENANCE_SUFFIX
from vantagrid.sources.documents import checked_manifest
from vantagrid.sources.store import Store, read_bytes, write_bytes
from vantagrid.workspace import shared_path

_GREEN = (0, 255, 0)
#: Tasks that read or write small documents at a time, at most.
READERS = 256


def _manifests(spark: SparkSession, raw: Store, run_ids: list[str]) -> dict[str, int]:
    """Frames that each run's manifest claims; the runs are read side by side by the tasks."""

    def read(part) -> Iterator[tuple]:
        for r in part:
            try:
                manifest = checked_manifest(json.loads(read_bytes(r.path)))
                yield r.place, r.run_id, manifest["frame_count"], None
            except FileNotFoundError:
                yield r.place, r.run_id, None, f"run {r.run_id} has no {MANIFEST} at {r.path.removeprefix('file://')}: it is not complete"
            except (ManifestRefused, ValueError) as e:
                yield r.place, r.run_id, None, f"run {r.run_id}: {e}"

    rows = spark.createDataFrame([(k, r, raw.path(f"{r}/{MANIFEST}")) for k, r in enumerate(run_ids)], "place int, run_id string, path string")
    found = sorted(rows.repartition(min(len(run_ids), READERS), "place").rdd.mapPartitions(read).collect())
    for *_, problem in found:
        if problem:
            raise ConvertRefused(problem)
    return {run: n for _, run, n, _ in found}


def _side(spark: SparkSession, raw: Store, run_ids: list[str], side: str) -> DataFrame:
    """(run_id, frame_index, path) of one pass of the runs."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load([raw.path(f"{r}/{side}") for r in run_ids])
    return files.select(_run_of(raw, F.col("path")).alias("run_id"), frame_index(F.col("path")).alias("frame_index"), "path")


def _run_of(raw: Store, path):
    base = raw.root.split("://", 1)[-1].rstrip("/") + "/"
    return F.element_at(F.split(F.substring_index(path, base, -1), "/"), 1)


def decoded(spark: SparkSession, raw: Store, run_ids: list[str], side: str) -> DataFrame:
    """(run_id, frame_index, name, image) of one pass of the runs, by Spark's image source."""
    got = spark.read.format("image").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load([raw.path(f"{r}/{side}") for r in run_ids])
    path = F.col("image.origin")
    return got.select(_run_of(raw, path).alias("run_id"), frame_index(path).alias("frame_index"), F.element_at(F.split(path, "/"), -1).alias(f"{side}_name"), F.col("image").alias(side))


def _require_frames(spark: SparkSession, raw: Store, claims: dict[str, int]) -> None:
    """Refuse runs whose passes do not pair or whose pairs are not as many as claimed."""
    run_ids = list(claims)
    folders = [(run, side) for run in run_ids for side in ("normal", "mask")]
    with ThreadPoolExecutor(16) as pool:
        there = pool.map(lambda f: raw.exists("/".join(f)), folders)
        for (run, side), found in zip(folders, there, strict=True):
            if not found:
                raise ConvertRefused(f"run {run} has no {side} frames")
    sides = {s: _side(spark, raw, run_ids, s) for s in ("normal", "mask")}
    for side, frames in sides.items():
        if odd := frames.where("frame_index IS NULL").first():
            raise ConvertRefused(f"{odd.path} does not end in a frame index")
        if twice := duplicates(frames, ["run_id", "frame_index"]).first():
            raise ConvertRefused(f"run {twice.run_id}: frame index {twice.frame_index} occurs {twice.n} times among the {side} frames")
    report = pairing_report(paired(sides["normal"], sides["mask"], ["run_id"], "frame_index"), ["run_id"], "frame_index")
    claimed = spark.createDataFrame(list(claims.items()), "run_id string, claimed int")
    for r in claimed.join(report, "run_id", "left").orderBy("run_id").collect():
        if r.n_missing_right or r.n_missing_left:
            raise ConvertRefused(f"run {r.run_id}: {r.n_missing_right} frames lack a mask ({r.first_missing_right}), {r.n_missing_left} a normal render ({r.first_missing_left})")
        if (r.n_pairs or 0) != r.claimed:
            raise ConvertRefused(f"run {r.run_id} has {r.n_pairs or 0} frame pairs, its manifest says {r.claimed}")


def convert_runs(spark: SparkSession, run_ids: list[str], config: ConvertConfig, version_of: Callable[[str], str]) -> DataFrame:
    """Convert runs; the quality reports, one row a run."""
    if len(config.class_map) != 1:
        raise ConfigRefused("class_map must have exactly one class: a mask shows one")
    (class_id,) = config.class_map
    raw, datasets, reports = (Store.at(spark, r) for r in (config.raw_root, config.dataset_root, config.qc_root))
    _require_frames(spark, raw, _manifests(spark, raw, run_ids))
    normal, mask = (decoded(spark, raw, run_ids, s) for s in ("normal", "mask"))
    pairs = normal.join(mask.drop("mask_name"), ["run_id", "frame_index"])
    path = shared_path(spark, "annotations")
    # each image is decoded once; the debug frame is drawn while it is at hand
    annotate(pairs, config.threshold, config.min_box_area, class_id, drawn).write.parquet(path)
    kept = spark.read.parquet(path)
    if bad := kept.where("problem IS NOT NULL").orderBy("run_id", "frame_index").first():
        raise FrameRefused(f"run {bad.run_id}, {bad.problem}")
    annotations = kept.drop("problem", "drawn")

    _write_annotations(annotations, {r: datasets.path(f"{version_of(r)}/annotations/{r}.json") for r in run_ids})
    sidecar = {r: run_provenance(r, config.threshold, config.min_box_area, config.class_map) for r in run_ids}
    texts = [(datasets.path(f"{version_of(r)}/annotations/{r}{PROVENANCE_SUFFIX}"), json.dumps(x, indent=2)) for r, x in sidecar.items()]
    _write_texts(spark.createDataFrame(texts, "target string, text string").repartition(min(len(texts), READERS)))
    report = qc.qc_report(annotations)
    _write_reports(report, reports.root)
    _write_debug(kept, reports.root)
    return report


def _write_texts(rows: DataFrame) -> None:
    """(target, text), written by the tasks."""

    def write(part) -> None:
        for r in part:
            write_bytes(r.target, r.text.encode())

    rows.foreachPartition(write)


def _write_reports(report: DataFrame, root: str) -> None:
    def write(part) -> None:
        for r in part:
            write_bytes(f"{root}/{r.run_id}/report.json", json.dumps(r.asDict(recursive=True), indent=2).encode())

    report.foreachPartition(write)


def _write_annotations(annotations: DataFrame, targets: dict[str, str]) -> None:
    """One JSON list a run, in frame order, written by the tasks."""

    def write(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for f in frames.sort_values("frame_index").to_dict("records"):
            boxes = [{k: _plain(b[k]) for k in BOX_FIELDS} for b in f["boxes"]]
            rows.append({k: _plain(f[k]) for k in FRAME_FIELDS if k != "boxes"} | {"boxes": boxes})
        write_bytes(targets[key[0]], json.dumps(rows, indent=2).encode())
        return pd.DataFrame({"run_id": [key[0]], "n": [len(rows)]})

    annotations.groupBy("run_id").applyInPandas(write, "run_id string, n long").count()


def _plain(value):
    """A numpy number as Python's; what is not a number as null."""
    value = value.item() if hasattr(value, "item") else value
    return None if value is None or value != value else value


def drawn(image: np.ndarray, boxes: list[dict]) -> bytes:
    """A normal image with its boxes and their fill ratios drawn on, as a PNG."""
    image = image.copy()
    for b in boxes:
        png.outline(image, b["x"], b["y"], b["w"], b["h"], _GREEN)
        png.caption(image, f"fill {b['fill_ratio']:.2f}", b["x"], max(b["y"] - 6, 12), _GREEN)
    return png.encode(image)


def _write_debug(frames: DataFrame, root: str) -> None:
    def write(rows) -> None:
        for r in rows:
            write_bytes(f"{root}/{r.run_id}/debug/{r.run_id}_{r.frame_index:06d}.png", bytes(r.drawn))

    frames.select("run_id", "frame_index", "drawn").foreachPartition(write)


def convert_run(spark: SparkSession, run_id: str, config: ConvertConfig, version: str):
    """Convert one run; its quality report as a row."""
    return convert_runs(spark, [run_id], config, lambda _: version).first()
