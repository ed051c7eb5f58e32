"""Quality control: per-run reports, flags, and rollups of reports over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantagrid.functions.text import flag_shape

# What a frame is flagged for, and the texts of the flags.
LOW_FILL, TINY_AREA, LOW_CONTRAST = 0.15, 64, 8.0
SEVERAL, PIECES, LOW, TINY, FAINT, EDGE = "{} boxes in frame", "mask in {} pieces", "low fill ratio {}", "tiny box {}x{}", "low contrast {}", "box touches frame edge"


def shown(number: Column, digits: int) -> Column:
    """A number rounded to so many digits already, written without exponent and without trailing zeros."""
    return F.regexp_replace(number.cast(f"decimal(18,{digits})").cast("string"), r"(\.[0-9]+?)0+$", "$1")


def _text(form: str, *values: Column) -> Column:
    pieces = form.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value.cast("string"), F.lit(piece)]
    return F.concat(*parts)


def box_flags(box: Column, width: Column, height: Column) -> Column:
    """Reasons to look at a box, in order, nulls between."""
    touches = (box["x"] == 0) | (box["y"] == 0) | (box["x"] + box["w"] == width) | (box["y"] + box["h"] == height)
    return F.array(
        F.when(box["components"] > 1, _text(PIECES, box["components"])),
        F.when(box["fill_ratio"] < LOW_FILL, _text(LOW, shown(box["fill_ratio"], 4))),
        F.when(box["w"] * box["h"] < TINY_AREA, _text(TINY, box["w"], box["h"])),
        F.when(F.abs(box["contrast"]) < LOW_CONTRAST, _text(FAINT, shown(box["contrast"], 2))),
        F.when(touches, F.lit(EDGE)),
    )


def qc_flags(annotations: DataFrame) -> DataFrame:
    """(run_id, frame_index, place, reason): every flag, numbered in order within its frame."""
    several = F.array(F.when(F.size("boxes") > 1, _text(SEVERAL, F.size("boxes"))))
    each = F.flatten(F.transform("boxes", lambda box: box_flags(box, F.col("width"), F.col("height"))))
    reasons = F.filter(F.concat(several, each), lambda r: r.isNotNull())
    return annotations.select("run_id", "frame_index", F.posexplode(reasons).alias("place", "reason"))


def qc_rollup(annotations: DataFrame) -> DataFrame:
    """One row a run: frames, empty frames, boxes, and the ranges of area, fill and contrast.

    Each frame is reduced to its own ranges first, so boxes are never exploded.
    """

    def low(value):
        return F.array_min(F.transform("boxes", value))

    def high(value):
        return F.array_max(F.transform("boxes", value))

    values = {"box_area": lambda b: b["w"] * b["h"], "fill_ratio": lambda b: b["fill_ratio"], "contrast": lambda b: b["contrast"]}
    frames = annotations.select(
        "run_id",
        F.size("boxes").alias("n"),
        F.size(F.filter("boxes", lambda b: b["contrast"].isNull())).alias("unmeasured"),
        *[low(v).alias(f"{k}_min") for k, v in values.items()],
        *[high(v).alias(f"{k}_max") for k, v in values.items()],
    )
    ranges = [f(f"{k}_{s}").alias(f"{k}_{s}") for k in values for s, f in (("min", F.min), ("max", F.max))]
    return frames.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.col("n") == 0).alias("empty_frames"),
        F.sum("n").cast("long").alias("total_boxes"),
        *ranges,
        F.sum("unmeasured").cast("long").alias("contrast_unmeasured"),
    )


def qc_report(annotations: DataFrame) -> DataFrame:
    """The rollup with each run's flags in frame order."""
    flags = qc_flags(annotations).groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", "place", "reason"))).alias("f"))
    flags = flags.select("run_id", F.transform("f", lambda x: F.struct(x["frame_index"], x["reason"])).alias("flags"))
    out = qc_rollup(annotations).join(flags, "run_id", "left")
    return out.withColumn("flags", F.coalesce("flags", F.array().cast("array<struct<frame_index:int,reason:string>>")))


def flag_histogram(flags: DataFrame) -> DataFrame:
    """(shape, n): reasons with their digits masked, the commonest first, ties by shape."""
    return flags.groupBy(flag_shape(F.col("reason")).alias("shape")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "shape")


def corpus_rollup(reports: DataFrame) -> DataFrame:
    """One row over reports: sums of counts, ranges of ranges."""
    return reports.agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("frames").alias("frames"),
        F.sum("total_boxes").alias("total_boxes"),
        F.sum("empty_frames").alias("empty_frames"),
        F.min("box_area_min").alias("box_area_min"),
        F.max("box_area_max").alias("box_area_max"),
        F.min("fill_ratio_min").alias("fill_ratio_min"),
        F.max("fill_ratio_max").alias("fill_ratio_max"),
    )


def contrast_summary(annotations: DataFrame, by: list[str]) -> DataFrame:
    """Boxes, the share of faint ones, and the median over runs of each run's median contrast."""
    boxes = annotations.select(*by, "run_id", F.explode("boxes.contrast").alias("contrast"))
    runs = boxes.groupBy(*by, "run_id").agg(F.count("contrast").alias("n"), F.count_if(F.abs("contrast") < LOW_CONTRAST).alias("faint"), F.median("contrast").alias("median"))
    share = F.try_divide(F.sum("faint"), F.sum("n"))
    return runs.groupBy(*by).agg(F.sum("n").alias("boxes"), share.alias("faint_share"), F.median("median").alias("median_of_medians"))
