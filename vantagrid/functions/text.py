"""Scalar functions: names, keys, label lines, canonical JSON, Python's rounding.

What Java renders or rounds otherwise than the label format asks for goes through
vectorised Python; everything else is a column expression.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# A clip recedes if its distance grows by this ratio.
RECESSION_RATIO = 5.0


# Fixed values in the functions below: the patterns of file names, keys and run names.


def stem(name: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(?<=.)\.[^.]*$", "")


def frame_index(name: Column) -> Column:
    """The digits that end a file's stem; null without any."""
    digits = F.regexp_extract(stem(name), r"([0-9]+)$", 1)
    return F.when(digits != "", digits.try_cast("long"))


def sequence_name(name: Column) -> Column:
    """A frame's stem without its index and the sign before it."""
    return F.regexp_replace(stem(name), r"[._-]?[0-9]+$", "")


def frame_name(index: Column) -> Column:
    return F.format_string("frame_%06d.png", index)


def placed_stem(run_id: Column, index: Column) -> Column:
    return F.concat(run_id, F.format_string("_%06d", index))


def suffix(name: Column) -> Column:
    return F.regexp_extract(name, r"[^/](\.[^./]+)$", 1)


def run_of_key(key: Column) -> Column:
    """The run of a manifest's key; null for any other key."""
    run = F.regexp_extract(key, r"^raw/([^/]*)/manifest\.json\z", 1)
    return F.when(key.rlike(r"^raw/[^/]*/manifest\.json\z"), run)


def run_of_owned_key(key: Column) -> Column:
    """The run that owns a key under any of the three prefixes; null if none does."""
    run = F.regexp_extract(key, r"^(?:raw/|qc/|datasets/auto-)([^/]+)/", 1)
    return F.when(run != "", run)


def owned_prefix(key: Column) -> Column:
    return F.regexp_extract(key, r"^((?:raw|qc)/[^/]+|datasets/auto-[^/]+)/", 1)


def auto_version(run_id: Column) -> Column:
    return F.concat(F.lit("auto-"), run_id)


def flag_shape(reason: Column) -> Column:
    return F.regexp_replace(reason, "[0-9]", "N")


def clip_kind(start: Column, end: Column) -> Column:
    known = F.coalesce(start != 0, F.lit(False)) & end.isNotNull()
    return F.when(~known, "unknown").when(end.cast("double") / start.cast("double") >= RECESSION_RATIO, "recession").otherwise("crossing")


def seed_suffix(run_id: Column) -> Column:
    return F.substring_index(run_id, "_", -1)


def crop_window(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, crop_width: int) -> Column:
    """A 16 to 9 window of the given width around a box's middle, moved inside the frame."""
    crop_height = crop_width * 9 // 16
    left = F.greatest(F.lit(0), F.least(x + F.floor(w / 2) - crop_width // 2, width - crop_width))
    top = F.greatest(F.lit(0), F.least(y + F.floor(h / 2) - crop_height // 2, height - crop_height))
    return F.struct(left.cast("int").alias("left"), top.cast("int").alias("top"), F.lit(crop_width).alias("width"), F.lit(crop_height).alias("height"))


def python_round(digits: int):
    """Python's rounding of a column of doubles: to nearest, exact ties to even."""

    @F.pandas_udf(DoubleType())
    def rounded(x: pd.Series) -> pd.Series:
        return x.map(lambda v: round(v, digits), na_action="ignore")

    return rounded


def label_line(class_id: int, x: int, y: int, w: int, h: int, width: int, height: int) -> str:
    """One box as class, middle and size in shares of the frame."""
    return f"{class_id} {(x + w / 2) / width:.6f} {(y + h / 2) / height:.6f} {w / width:.6f} {h / height:.6f}"


@F.pandas_udf(StringType())
def label_text(boxes: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """The label file of each frame: a line for each box, nothing without boxes."""
    out = []
    for frame, fw, fh in zip(boxes, width, height, strict=True):
        out.append("".join(label_line(b["class_id"], b["x"], b["y"], b["w"], b["h"], fw, fh) + "\n" for b in frame))
    return pd.Series(out)


def canonical(value) -> str:
    """JSON with sorted keys, the form that texts are compared in."""
    return json.dumps(value, sort_keys=True)


def scene_of(manifest: dict) -> str:
    """What makes a run's scene distinct: its seed and all that decides what the seed means."""
    # The members, from the manifest's own names.
    parts = {
        "seed": manifest.get("seed"),
        "randomization": manifest.get("randomization") or {},
        "ue_map": manifest["ue_map"],
        "drone_model": manifest["drone_model"],
        "generator": (manifest.get("generator") or {}).get("commit"),
    }
    return hashlib.sha256(canonical(parts).encode()).hexdigest()[:16]


@F.pandas_udf(StringType())
def scene_identity(manifest_json: pd.Series) -> pd.Series:
    return manifest_json.map(lambda text: scene_of(json.loads(text)), na_action="ignore")


@F.pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    return text.map(lambda t: canonical(json.loads(t)), na_action="ignore")


