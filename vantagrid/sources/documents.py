"""Readers of run documents: manifests, annotations, provenance, reports, key lists.

Many documents are read in one distributed scan, one row each; what must keep its
exact text (open dictionaries) stays text. Documents are judged by the same Python
rules whether one is read or a million, and a document that fails carries its
problem beside it rather than failing the scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.errors import ManifestRefused
from vantagrid.functions.text import canonical, scene_of
from vantagrid.schemas import BOX, BOX_FIELDS, FRAME_FIELDS, RUN_FIELDS, SCHEMA_VERSION

_RUN_ID = re.compile(r"[a-z0-9][a-z0-9_-]*\Z")


def checked_manifest(data: object) -> dict:
    """A run manifest with defaults filled in and unknown fields dropped, or a refusal."""
    if not isinstance(data, dict):
        raise ManifestRefused("a manifest is a JSON object")
    if data.get("schema_version") != SCHEMA_VERSION:
        raise ManifestRefused(f"schema_version {data.get('schema_version')!r} is not {SCHEMA_VERSION}")
    m = {"randomization": {}, "generator": {}, "seed": None} | {k: data[k] for k in RUN_FIELDS if k in data}
    lacking = [k for k in RUN_FIELDS if k not in m]
    if lacking:
        raise ManifestRefused(f"lacks {', '.join(lacking)}")
    if not isinstance(m["run_id"], str) or not _RUN_ID.match(m["run_id"]):
        raise ManifestRefused(f"run_id {m['run_id']!r}: lower-case letters, digits, _ and - only")
    try:
        date.fromisoformat(m["captured_at"])
    except (TypeError, ValueError):
        raise ManifestRefused(f"captured_at {m['captured_at']!r} is no ISO date") from None
    if isinstance(m["frame_count"], bool) or not isinstance(m["frame_count"], int) or m["frame_count"] <= 0:
        raise ManifestRefused(f"frame_count {m['frame_count']!r} is not positive")
    for k in ("ue_map", "drone_model", "camera_sequence"):
        if not isinstance(m[k], str) or not m[k].strip():
            raise ManifestRefused(f"{k} is blank")
    return {k: m[k] for k in RUN_FIELDS}


def checked_annotations(data: object) -> list[dict]:
    """Annotations with defaults filled in; an unknown or missing field is refused."""
    if not isinstance(data, list):
        raise ManifestRefused("annotations are a JSON list")
    out = []
    for frame in data:
        if not isinstance(frame, dict) or set(frame) != set(FRAME_FIELDS) or not isinstance(frame["boxes"], list):
            raise ManifestRefused("a frame has unknown or missing fields")
        boxes = []
        for box in frame["boxes"]:
            if not isinstance(box, dict):
                raise ManifestRefused("a box is a JSON object")
            box = {"components": 1, "contrast": None} | box
            if set(box) != set(BOX_FIELDS):
                raise ManifestRefused("a box has unknown or missing fields")
            boxes.append(box)
        out.append({k: frame[k] for k in FRAME_FIELDS} | {"boxes": boxes})
    return out


def checked_provenance(data: object) -> dict:
    if not isinstance(data, dict) or not all(k in data for k in ("run_id", "converted_at")):
        raise ManifestRefused("provenance lacks run_id or converted_at")
    return {"run_id": data["run_id"], "converted_at": data["converted_at"], "converter": data.get("converter") or {}, "conversion": data.get("conversion") or {}}


def whole_texts(spark: SparkSession, paths: list[str] | str, pattern: str | None = None) -> DataFrame:
    """(path, text), a row for each file; paths that are not there give no row."""
    reader = spark.read.option("ignoreMissingFiles", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


_MANIFEST = "path string, problem string, run_id string, captured_at string, frame_count int, ue_map string, drone_model string, camera_sequence string, randomization string, generator string, seed long, scene string, text string"


def read_manifests(texts: DataFrame) -> DataFrame:
    """Judged manifests of (path, text): fields, scene identity, or the problem."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in _MANIFEST.split(", ")]
        for b in batches:
            rows = []
            for path, t in zip(b["path"], b["text"], strict=True):
                row = dict.fromkeys(names) | {"path": path, "text": t}
                try:
                    m = checked_manifest(json.loads(t))
                    row |= {k: m[k] for k in names if k in m} | {"randomization": json.dumps(m["randomization"]), "generator": json.dumps(m["generator"]), "scene": scene_of(m)}
                except ValueError as e:
                    row["problem"] = str(e)
                rows.append(row)
            yield pd.DataFrame(rows, columns=names).astype({"frame_count": "Int32", "seed": "Int64"})

    return texts.mapInPandas(run, _MANIFEST)


_ANNOTATED = f"path string, problem string, n_frames long, frames array<struct<frame_index:int,normal:string,width:int,height:int,boxes:array<{BOX}>>>"


def read_annotations(texts: DataFrame) -> DataFrame:
    """(path, problem, n_frames, frames) of annotation files; one row a run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, t in zip(b["path"], b["text"], strict=True):
                try:
                    frames = checked_annotations(json.loads(t))
                    rows.append((path, None, len(frames), frames))
                except ValueError as e:
                    rows.append((path, str(e), None, None))
            yield pd.DataFrame(rows, columns=["path", "problem", "n_frames", "frames"]).astype({"n_frames": "Int64"})

    return texts.mapInPandas(run, _ANNOTATED)


def read_provenance(texts: DataFrame) -> DataFrame:
    """(path, problem, converted_at, converter, conversion): the blocks as canonical JSON."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, t in zip(b["path"], b["text"], strict=True):
                try:
                    p = checked_provenance(json.loads(t))
                    rows.append((path, None, p["converted_at"], canonical(p["converter"]), canonical(p["conversion"])))
                except ValueError as e:
                    rows.append((path, str(e), None, None, None))
            yield pd.DataFrame(rows, columns=["path", "problem", "converted_at", "converter", "conversion"])

    return texts.mapInPandas(run, "path string, problem string, converted_at string, converter string, conversion string")


def read_reports(spark: SparkSession, qc_root: str) -> DataFrame:
    """QC reports below a root, in one scan."""
    from vantagrid.schemas import QC_REPORT

    return spark.read.schema(QC_REPORT).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "report.json").json(qc_root)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(run_id) of a file of run ids, one a line; blank lines are skipped."""
    return spark.read.text(path).select(F.trim("value").alias("run_id")).where("run_id <> ''")


def list_keys(spark: SparkSession, root: str) -> DataFrame:
    """(key, length) of all objects below a root: one distributed listing, contents unread."""
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    tail = F.expr(f"substring(path, instr(path, '{base.split('://')[-1].rstrip('/')}/') + {len(base.split('://')[-1])})")
    return files.select(tail.alias("key"), "length")


def discovered_runs(spark: SparkSession, raw_root: str) -> DataFrame:
    """(run_id) of the runs that are complete, by their manifests' keys."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "manifest.json").option("recursiveFileLookup", True).load(raw_root)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("run_id")).distinct()
