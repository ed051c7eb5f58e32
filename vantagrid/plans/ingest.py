"""Ingest: a finished capture becomes a run. Checked first, copied second, committed by its manifest last."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vantagrid.errors import IngestRefused, KeyExists, NotPermitted
from vantagrid.functions.text import frame_name
from vantagrid.plans.place import place
from vantagrid.schemas import MANIFEST, SCHEMA_VERSION
from vantagrid.sources.documents import checked_manifest
from vantagrid.sources.frames import checked_frames, paired_run, sequence_of
from vantagrid.sources.store import Store


def ingest_capture(spark: SparkSession, normal_root: str, mask_root: str, run_id: str, raw_root: str, captured_at: str, ue_map: str, drone_model: str) -> dict:
    """Register a capture under ``raw_root``; the manifest written, as a dictionary."""
    sides = [Store.at(spark, root) for root in (normal_root, mask_root)]
    frames = [checked_frames(spark, s.root, s.exists("")) for s in sides]
    pairs = paired_run(*frames, f"capture {run_id}").cache()
    raw = Store.at(spark, raw_root)
    taken = IngestRefused(f"run {run_id} is already there: {raw.describe(run_id)}")
    try:
        if raw.exists(f"{run_id}/{MANIFEST}"):
            raise taken
        raw.delete_prefix(run_id)
    except NotPermitted:
        pass
    manifest = checked_manifest(
        {
            "run_id": run_id,
            "captured_at": captured_at,
            "frame_count": pairs.count(),
            "ue_map": ue_map,
            "drone_model": drone_model,
            "camera_sequence": sequence_of(pairs),
            "schema_version": SCHEMA_VERSION,
        }
    )
    name = frame_name(F.col("frame_index"))
    for side in ("normal", "mask"):
        place(pairs.select(F.col(f"{side}_path").alias("source"), F.concat(F.lit(f"{raw.root}/{run_id}/{side}/"), name).alias("target")))
    try:
        raw.write_text_if_absent(f"{run_id}/{MANIFEST}", json.dumps(manifest, indent=2))
    except KeyExists:
        raise taken from None
    finally:
        pairs.unpersist()
    return manifest
