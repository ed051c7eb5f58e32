"""The engine's operators as queries over the driver's tables, each with its SQL.

The tables hold no pictures, so every operator runs on the nearest table: embeddings
serve as 8 by 8 rasters, labels as runs, documents and orders as frames and runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.config import BuildConfig
from vantagrid.functions import png, text
from vantagrid.functions.tables import register
from vantagrid.operators import pairing, qc, raster, runs
from vantagrid.plans import build, convert, corpus
from vantagrid.schemas import MANIFEST, PROVENANCE_SUFFIX
from vantagrid.sources.store import Store, write_bytes
from vantagrid.workspace import shared_path

THRESHOLD, SIDE, MIN_AREA = 140, 8, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, pixels, width): embeddings as bytes of 8 by 8 pixels."""
    pixels = F.transform("embedding", lambda v: F.floor((v.cast("double") + 1) * 127.5).cast("int"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", pixels.alias("pixels"), F.lit(SIDE).alias("width"))


def raster_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances of the rasters as annotations: label is the run, vec_id the frame; fill is not rounded, contrast not measured."""
    frames = rasters(spark, sf_dir)
    found = raster.with_instances(frames, THRESHOLD, MIN_AREA, "vec_id")
    fill = F.col("mask_area") / (F.col("w") * F.col("h"))
    box = F.struct(F.lit(0).alias("class_id"), "x", "y", "w", "h", "mask_area", fill.alias("fill_ratio"), "components", F.lit(None).cast("double").alias("contrast"))
    boxes = found.groupBy("vec_id").agg(F.collect_list(box).alias("boxes"))
    out = frames.select("vec_id", "label").join(boxes, "vec_id", "left")
    empty = F.array().cast(boxes.schema["boxes"].dataType)
    return out.select(F.col("label").alias("run_id"), F.col("vec_id").alias("frame_index"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), F.coalesce("boxes", empty).alias("boxes"))


_PIXELS = f"""
px AS (
  SELECT vec_id, label, i - 1 AS p, (i - 1) % {SIDE} AS x, (i - 1) // {SIDE} AS y, CAST(floor((CAST(v AS DOUBLE) + 1) * 127.5) AS INT) AS val
  FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
), lit AS (SELECT * FROM px WHERE val > {THRESHOLD})"""

_COMPONENTS = f"""{_PIXELS}, reach AS (
  SELECT vec_id, p AS root, p, x, y FROM lit
  UNION
  SELECT r.vec_id, r.root, l.p, l.x, l.y FROM reach r JOIN lit l ON r.vec_id = l.vec_id AND abs(r.x - l.x) <= 1 AND abs(r.y - l.y) <= 1
), named AS (SELECT vec_id, p, any_value(x) AS x, any_value(y) AS y, min(root) AS c FROM reach GROUP BY vec_id, p)"""

_INSTANCES = f"""{_COMPONENTS}, inst AS (
  SELECT vec_id, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h, count(*) AS a, count(DISTINCT c) AS n
  FROM named GROUP BY vec_id
), boxes AS (SELECT * FROM inst WHERE w * h >= {MIN_AREA})"""


def q_binarize(spark, d):
    return raster.with_lit(rasters(spark, d), THRESHOLD, "vec_id")


def q_components(spark, d):
    got = raster.with_components(rasters(spark, d), THRESHOLD, "vec_id")
    return got.select("vec_id", *[F.col(c).cast("long").alias(c) for c in ("x", "y", "w", "h", "mask_area")])


def q_instances(spark, d):
    got = raster.with_instances(rasters(spark, d), THRESHOLD, MIN_AREA, "vec_id")
    return got.select("vec_id", *[F.col(c).cast("long").alias(c) for c in ("x", "y", "w", "h", "mask_area", "components")])


def q_contrast(spark, d):
    frames = rasters(spark, d).withColumn("plane", F.reverse("pixels"))
    got = raster.contrast_sums(frames, THRESHOLD, "vec_id", core_alpha=160, ring_px=3, min_core_px=3)
    return got.withColumn("contrast", F.col("core_sum") / F.col("core_n") - F.col("ring_sum") / F.col("ring_n"))


def q_qc_rollup(spark, d):
    return qc.qc_rollup(raster_boxes(spark, d)).drop("contrast_min", "contrast_max")


def q_qc_flags(spark, d):
    return qc.qc_flags(raster_boxes(spark, d))


def q_flag_histogram(spark, d):
    return qc.flag_histogram(q_qc_flags(spark, d))


def q_corpus_qc(spark, d):
    return qc.corpus_rollup(qc.qc_rollup(raster_boxes(spark, d)))


def q_yolo_labels(spark, d):
    return raster_boxes(spark, d).select(F.col("frame_index").alias("vec_id"), text.label_text("boxes", "width", "height").alias("label_text"))


def _pictures(spark, d):
    """(vec_id, label, image): the first 63 pixels of each raster as a colour picture of three rows by seven, decoded."""
    data = F.unhex(F.array_join(F.transform(F.slice("pixels", 1, 63), lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    image = F.struct(F.lit(3).alias("height"), F.lit(7).alias("width"), F.lit(3).alias("nChannels"), data.alias("data"))
    return rasters(spark, d).select("vec_id", "label", image.alias("image"))


def q_sky_tint(spark, d):
    """Blue less red over the two top rows."""
    got = raster.sky_tints(_pictures(spark, d).withColumn("run_id", F.col("vec_id").cast("string")), 2)
    return got.select(F.col("run_id").cast("long").alias("vec_id"), F.round("tint", 9).alias("tint"))


def q_annotate(spark, d):
    """The rasters written as colour masks beside a normal picture, decoded from the files again, and annotated."""
    base = shared_path(spark, "pictures")

    def write(part) -> None:
        for r in part:
            values = np.zeros(SIDE * SIDE, np.uint8)  # what a raster lacks is unlit
            values[: len(r.pixels or [])] = [min(max(v or 0, 0), 255) for v in r.pixels or []]
            values = values.reshape(SIDE, SIDE, 1)
            write_bytes(f"{base}/run/mask/frame_{r.vec_id:06d}.png", png.encode(np.concatenate([values // 2, values, values // 3], axis=2)))
            write_bytes(f"{base}/run/normal/frame_{r.vec_id:06d}.png", png.encode(np.full((SIDE, SIDE, 3), 90, np.uint8)))

    rasters(spark, d).foreachPartition(write)
    sides = [convert.decoded(spark, Store.at(spark, base), ["run"], s) for s in ("normal", "mask")]
    pairs = sides[0].join(sides[1].drop("mask_name"), ["run_id", "frame_index"])
    got = raster.annotate(pairs, THRESHOLD, MIN_AREA, 0)
    box = F.explode_outer("boxes")
    rows = got.select(F.col("frame_index").cast("long").alias("vec_id"), "problem", "normal", "width", "height", box.alias("b"))
    return rows.select("vec_id", "problem", "normal", "width", "height", *[F.col(f"b.{c}").cast("long").alias(c) for c in ("x", "y", "w", "h", "mask_area", "components")], "b.fill_ratio")


def q_gather_documents(spark, d):
    """Runs made of nations, some of them incomplete or wrong: what a build would refuse each for."""
    base = shared_path(spark, "runs")
    nations = table(spark, d, "nation").select("n_nationkey", "n_name").collect()  # 25 by definition
    raw, data = Store.at(spark, f"{base}/raw"), Store.at(spark, f"{base}/data")
    for r in nations:
        run, case = f"run_{r.n_nationkey}", r.n_nationkey % 7
        manifest = {"run_id": run, "captured_at": "2026-01-02", "frame_count": 0 if case == 2 else 1, "ue_map": r.n_name, "drone_model": "quad", "camera_sequence": "seq", "schema_version": 1}
        frame = {"frame_index": 0, "normal": "frame_000000.png", "width": 8, "height": 8, "boxes": []}
        if case != 1:
            raw.write_text(f"{run}/{MANIFEST}", json.dumps(manifest))
        if case != 3:
            data.write_text(f"auto-{run}/annotations/{run}.json", json.dumps([frame] * (2 if case == 4 else 1)))
        if case != 5:
            side = {"run_id": run} if case == 6 else {"run_id": run, "converted_at": "2026-01-03"}
            data.write_text(f"auto-{run}/annotations/{run}{PROVENANCE_SUFFIX}", json.dumps(side))
    config = BuildConfig(tuple(f"run_{r.n_nationkey}" for r in nations), (), "by_run", raw.root, data.root)
    return build.gather(spark, config).select("run_id", "problem")


def q_pairs(spark, d):
    turns = table(spark, d, "conversations").withColumn("slot", F.floor(F.col("turn") / 2)).withColumn("path", F.concat_ws("/", "conv_id", "turn"))
    sides = [turns.where(F.col("role") == r) for r in ("user", "assistant")]
    return pairing.pairing_report(pairing.paired(*sides, ["conv_id"], "slot"), ["conv_id"], "slot")


def q_duplicate_frames(spark, d):
    return pairing.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


_VAL_SOURCES = ("src1", "src7", "src13")


def _split_documents(spark, d):
    val = spark.createDataFrame([(s,) for s in _VAL_SOURCES], "source string")
    return runs.split_subsets(table(spark, d, "documents"), val, "source")


def q_split(spark, d):
    return runs.subset_totals(_split_documents(spark, d), "source", F.lit(1).cast("long"))


def q_unknown(spark, d):
    return runs.unknown_members(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")), table(spark, d, "events"), "user_id")


def q_comparability(spark, d):
    return runs.comparability(table(spark, d, "part"), F.concat_ws("|", "p_brand", "p_type"), "p_partkey")


def q_scene_leaks(spark, d):
    rows = _split_documents(spark, d).select("doc_id", "subset", F.substring(F.sha2("text", 256), 1, 16).alias("scene"))
    return runs.scene_leaks(rows, "scene", "doc_id")


def q_gather(spark, d):
    """Orders with their lines and customers: the first thing that is wrong with each."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_linenumber").alias("claimed"))
    customers = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("o_custkey"))
    out = runs.gathered(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", {"lines": (lines, "l_orderkey")})
    out = runs.gathered(out.withColumnRenamed("o_custkey", "customer_key"), "customer_key", {"customer": (customers, "c_custkey")})
    status = runs.first_problem((F.col("customer").isNull(), "no customer"), (F.col("lines").isNull(), "no lines"), (F.col("lines.n_lines") != F.col("lines.claimed"), "count differs"))
    return out.select("o_orderkey", F.coalesce(status, F.lit("ok")).alias("status"), F.coalesce("lines.n_lines", F.lit(0)).alias("n_lines"))


def q_holdout(spark, d):
    members = table(spark, d, "events").select("event_type", "user_id").distinct()
    return runs.hashed_holdout(members, ["event_type"], "user_id", F.when(F.col("event_type") == "click", 5).otherwise(3))


def q_clip_kind(spark, d):
    place = F.struct("ts", "event_id")
    ends = table(spark, d, "events").groupBy("user_id").agg(F.min_by("value", place).alias("first_value"), F.max_by("value", place).alias("last_value"))
    return ends.select("user_id", text.clip_kind(F.col("first_value"), F.col("last_value")).alias("kind"))


def _runs_of_users(spark, d):
    """One row a user: a time of day and a value, from the user's fourth event."""
    one = runs.kth_of_each(table(spark, d, "events"), "user_id", ["ts", "event_id"], 3)
    tod = F.hour("ts") + F.minute("ts") / 60.0
    return one.select(F.col("user_id").alias("run_id"), F.col("user_id").alias("place"), tod.alias("tod"), F.col("value").alias("tint"))


_USERS = """
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS slot, count(*) OVER (PARTITION BY user_id) AS n FROM events),
r AS (SELECT user_id AS run_id, hour(ts) + minute(ts) / CAST(60 AS DOUBLE) AS tod, value AS tint FROM placed WHERE slot = least(4, n))"""


def q_neighbours(spark, d):
    return runs.neighbour_medians(_runs_of_users(spark, d), ["tod", "place"], "tint").select("run_id", "expected", "off", "testable")


def q_twins(spark, d):
    return runs.twins(_runs_of_users(spark, d), "run_id", "tod", "tint")


def q_nearest(spark, d):
    return runs.nearest(_runs_of_users(spark, d), "run_id", "tint")


def q_sky_verdicts(spark, d):
    return runs.sky_verdicts(_runs_of_users(spark, d)).select("run_id", "verdict")


def q_kth(spark, d):
    got = runs.kth_of_each(table(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 2)
    return got.select("l_orderkey", "l_linenumber", "l_extendedprice")


def q_top_ties(spark, d):
    return runs.top_with_ties(table(spark, d, "lineitem").select("l_suppkey", "l_quantity"), "l_suppkey", "l_quantity", 8)


def _keys(spark, d):
    """Object keys made of events: each belongs to the run of its user, under one of the three areas or none."""
    run = F.concat(F.lit("run_"), F.col("user_id").cast("string"))
    kind = F.col("event_id") % 4
    key = (
        F.when(kind == 0, F.concat(F.lit("raw/"), run, F.lit("/manifest.json")))
        .when(kind == 1, F.concat(F.lit("datasets/auto-"), run, F.lit("/annotations/"), run, F.lit(".json")))
        .when(kind == 2, F.concat(F.lit("qc/"), run, F.lit("/report.json")))
        .otherwise(F.concat(F.lit("tmp/"), run))
    )
    return table(spark, d, "events").select("event_id", key.alias("key"))


_KEYS = """
keys AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'raw/run_' || user_id || '/manifest.json'
  WHEN 1 THEN 'datasets/auto-run_' || user_id || '/annotations/run_' || user_id || '.json'
  WHEN 2 THEN 'qc/run_' || user_id || '/report.json' ELSE 'tmp/run_' || user_id END AS key FROM events)"""


def q_prefixes(spark, d):
    return runs.prefix_counts(_keys(spark, d), text.owned_prefix(F.col("key")))


def q_hosts(spark, d):
    return runs.prefix_counts(table(spark, d, "pages"), F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1))


def q_key_parse(spark, d):
    got = _keys(spark, d).withColumn("run_id", text.run_of_key(F.col("key"))).where("run_id IS NOT NULL")
    return got.select("event_id", "run_id", text.auto_version(F.col("run_id")).alias("version"))


def q_prune(spark, d):
    doomed = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("run_"), F.col("c_custkey").cast("string")).alias("run_id"))
    return runs.owned_keys(_keys(spark, d), doomed)


def q_object_counts(spark, d):
    every = table(spark, d, "events").select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"))
    return runs.object_counts(_keys(spark, d), every, 10)


def q_orders_rollup(spark, d):
    """A rollup of rollups: lines by order as reports, then all orders."""
    low, high = F.min("l_quantity"), F.max("l_quantity")
    reports = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("frames"),
        F.count("l_quantity").alias("total_boxes"),
        F.count_if(F.col("l_quantity") < 5).alias("empty_frames"),
        low.alias("box_area_min"),
        high.alias("box_area_max"),
        (low / 50).alias("fill_ratio_min"),
        (high / 50).alias("fill_ratio_max"),
    )
    return qc.corpus_rollup(reports)


def q_order_contrast(spark, d):
    """Lines as boxes of an order, quantities about 25 as their contrast."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), (F.col("l_orderkey") % 3).alias("third"), F.array(F.struct((F.col("l_quantity").cast("double") - 25).alias("contrast"))).alias("boxes"))
    got = qc.contrast_summary(lines, ["third"])
    return got.select("third", "boxes", F.round("faint_share", 6).alias("faint_share"), F.round("median_of_medians", 6).alias("median_of_medians"))


def _manifests_of_events(spark, d):
    """Manifests made of events: the type is the preset, the number in the properties the distance at the end."""
    k = F.get_json_object("props", "$.k")
    text_ = F.concat(F.lit('{"preset": "'), F.when(F.col("event_type") != "click", F.col("event_type")).otherwise(""), F.lit('", "distance_start_cm": 4, "distance_end_cm": '), F.coalesce(k, F.lit("null")), F.lit("}"))
    return table(spark, d, "events").select(F.lit(None).cast("string").alias("problem"), F.col("event_type").alias("run_id"), text_.alias("randomization"))


def q_json_props(spark, d):
    """Presets and kinds of clips out of JSON, with how many of each are held out."""
    val = spark.createDataFrame([("view",), ("purchase",)], "run_id string")
    return corpus.strata_counts(corpus.strata(_manifests_of_events(spark, d)), val)


def q_affected(spark, d):
    """Verdicts on runs, and how many of each are held out."""
    val = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("run_id"))
    return corpus.affected(runs.sky_verdicts(_runs_of_users(spark, d)), val)


def q_placements(spark, d):
    """Keys that documents would be placed under, source by source."""
    stem = text.placed_stem(F.col("source"), F.col("doc_id"))
    return _split_documents(spark, d).select("doc_id", F.concat(F.lit("images/"), "subset", F.lit("/"), stem, F.lit(".png")).alias("image_key"))


def q_label_pairs(spark, d):
    """Documents against their labels: both sides, and each alone."""
    images, labels = (table(spark, d, t).select("doc_id", F.col("doc_id").cast("string").alias("path")) for t in ("documents", "labels"))
    both = pairing.paired(images, labels, [], "doc_id")
    side = runs.first_problem((F.col("right_path").isNull(), "image only"), (F.col("left_path").isNull(), "label only"))
    return both.groupBy(F.coalesce(side, F.lit("both")).alias("side")).agg(F.count(F.lit(1)).alias("n"))


def q_preset_default(spark, d):
    return table(spark, d, "orders").groupBy(corpus.preset_of("o_orderpriority").alias("preset")).agg(F.count(F.lit(1)).alias("n"))


def q_crop(spark, d):
    got = raster.with_instances(rasters(spark, d), THRESHOLD, MIN_AREA, "vec_id")
    window = text.crop_window(*(F.col(c) for c in ("x", "y", "w", "h")), F.lit(SIDE * 4), F.lit(SIDE * 4), 16)
    return got.withColumn("c", window).select("vec_id", "c.left", "c.top")


def q_components_udtf(spark, d):
    """The components once more, by the table function in SQL."""
    register(spark)
    rasters(spark, d).createOrReplaceTempView("vantagrid_rasters")
    got = spark.sql(f"SELECT r.vec_id, c.x, c.y, c.w, c.h, c.mask_area FROM vantagrid_rasters r, LATERAL raster_components(r.pixels, r.width, {THRESHOLD}) c")
    return got.select("vec_id", *[F.col(c).cast("long").alias(c) for c in ("x", "y", "w", "h", "mask_area")])


def q_contrast_summary(spark, d):
    """Contrast of the rasters' objects by label: boxes, share of faint ones, median over runs of the runs' medians."""
    boxes = F.array(F.struct("contrast"))
    seen = q_contrast(spark, d).select("vec_id", boxes.alias("boxes"))
    rows = rasters(spark, d).select("vec_id", (F.col("label") % 3).alias("preset"), F.col("label").alias("run_id")).join(seen, "vec_id")
    got = qc.contrast_summary(rows, ["preset"])
    return got.select("preset", "boxes", F.round("faint_share", 6).alias("faint_share"), F.round("median_of_medians", 6).alias("median_of_medians"))


def q_stream(spark, d):
    from vantagrid.streaming.trigger import counted_stream

    return counted_stream(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raster_binarize": q_binarize,
    "raster_components": q_components,
    "raster_components_udtf": q_components_udtf,
    "raster_instances": q_instances,
    "raster_contrast": q_contrast,
    "contrast_summary": q_contrast_summary,
    "qc_rollup": q_qc_rollup,
    "qc_flags": q_qc_flags,
    "flag_histogram": q_flag_histogram,
    "corpus_qc_rollup": q_corpus_qc,
    "yolo_labels": q_yolo_labels,
    "sky_tint": q_sky_tint,
    "pair_full_outer": q_pairs,
    "duplicate_frames": q_duplicate_frames,
    "split_by_group": q_split,
    "unknown_val_anti": q_unknown,
    "comparability_groups": q_comparability,
    "scene_leak": q_scene_leaks,
    "gather_join": q_gather,
    "stratified_holdout": q_holdout,
    "clip_kind": q_clip_kind,
    "neighbour_median": q_neighbours,
    "twin_band_join": q_twins,
    "nearest_row": q_nearest,
    "sky_verdicts": q_sky_verdicts,
    "kth_per_group": q_kth,
    "topk_with_ties": q_top_ties,
    "prefix_counts": q_prefixes,
    "host_counts": q_hosts,
    "key_parse": q_key_parse,
    "prune_semi_join": q_prune,
    "object_counts": q_object_counts,
    "corpus_rollup": q_orders_rollup,
    "order_contrast": q_order_contrast,
    "affected_val": q_affected,
    "raster_annotate": q_annotate,
    "gather_documents": q_gather_documents,
    "json_props": q_json_props,
    "placements": q_placements,
    "label_image_pairs": q_label_pairs,
    "preset_default": q_preset_default,
    "crop_window": q_crop,
    "stream_trigger": q_stream,
}

_REASONS = f"""{_INSTANCES}, b AS (SELECT *, a / CAST(w * h AS DOUBLE) AS fill FROM boxes JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id)), listed AS (
  SELECT label AS run_id, vec_id AS frame_index, list_filter([
    CASE WHEN n > 1 THEN 'mask in ' || n || ' pieces' END,
    CASE WHEN fill < 0.15 THEN 'low fill ratio ' || regexp_replace(CAST(CAST(fill AS DECIMAL(18, 4)) AS VARCHAR), '(\\.[0-9]+?)0+$', '\\1') END,
    CASE WHEN w * h < 64 THEN 'tiny box ' || w || 'x' || h END,
    CASE WHEN x = 0 OR y = 0 OR x + w = {SIDE} OR y + h = {SIDE} THEN 'box touches frame edge' END], lambda r: r IS NOT NULL) AS reasons FROM b
), flags AS (SELECT run_id, frame_index, CAST(generate_subscripts(reasons, 1) - 1 AS INT) AS place, unnest(reasons) AS reason FROM listed)"""

_ROLLUP = f"""{_INSTANCES}, b AS (SELECT label, boxes.*, a / CAST(w * h AS DOUBLE) AS fill FROM (SELECT vec_id, label FROM embeddings) LEFT JOIN boxes USING (vec_id)), rep AS (
  SELECT label AS run_id, count(*) AS frames, count(*) - count(a) AS empty_frames, count(a) AS total_boxes,
         CAST(min(w * h) AS INT) AS box_area_min, CAST(max(w * h) AS INT) AS box_area_max, min(fill) AS fill_ratio_min, max(fill) AS fill_ratio_max, count(a) AS contrast_unmeasured
  FROM b GROUP BY label)"""

_CONTRAST = f"""{_PIXELS}, plane AS (SELECT vec_id, {SIDE * SIDE - 1} - p AS p, val AS g FROM px),
ranked AS (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY val DESC) AS k, count(*) FILTER (WHERE val >= 160) OVER (PARTITION BY vec_id) AS strong FROM lit),
core AS (SELECT vec_id, sum(g) AS s, count(*) AS n FROM ranked JOIN plane USING (vec_id, p) WHERE CASE WHEN strong >= 3 THEN val >= 160 ELSE k <= 3 END GROUP BY vec_id),
ring AS (SELECT q.vec_id, sum(g) AS s, count(*) AS n FROM (SELECT DISTINCT a.vec_id, a.p FROM px a JOIN lit b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 WHERE a.val <= {THRESHOLD}) q JOIN plane USING (vec_id, p) GROUP BY q.vec_id),
seen AS (SELECT vec_id, CAST(core.s AS BIGINT) AS core_sum, core.n AS core_n, CAST(ring.s AS BIGINT) AS ring_sum, ring.n AS ring_n,
       CAST(core.s AS DOUBLE) / core.n - CAST(ring.s AS DOUBLE) / ring.n AS contrast FROM core JOIN ring USING (vec_id))"""

_VAL = ", ".join(f"'{s}'" for s in _VAL_SOURCES)
_SPLIT = f"sp AS (SELECT *, CASE WHEN source IN ({_VAL}) THEN 'val' ELSE 'train' END AS subset FROM documents)"

_NEIGHBOURS = f"""{_USERS}, s AS (SELECT *, row_number() OVER (ORDER BY tod, run_id) AS i FROM r), o AS (
  SELECT s.run_id, s.i, any_value(s.tod) AS tod, any_value(s.tint) AS tint, list(t.tint) AS others, median(t.tint) AS expected
  FROM s JOIN s t ON t.i <> s.i AND abs(t.i - s.i) <= 5 GROUP BY s.run_id, s.i
), e AS (SELECT run_id, tod, tint, expected, tint - expected AS off, (SELECT median(abs(v - expected)) FROM (SELECT unnest(others) AS v)) < 5.0 AS testable FROM o),
tw AS (SELECT a.run_id, arg_min(b.run_id, (b.tod, b.run_id)) AS twin FROM r a JOIN r b ON a.run_id <> b.run_id AND abs(a.tod - b.tod) < 0.15 AND abs(a.tint - b.tint) < 5.0 GROUP BY a.run_id)"""

ORACLE_SQL: dict[str, str] = {
    "raster_binarize": f"WITH {_PIXELS} SELECT e.vec_id, count(l.p) AS n_lit, CAST(coalesce(sum(l.val), 0) AS BIGINT) AS lit_sum FROM embeddings e LEFT JOIN lit l USING (vec_id) GROUP BY e.vec_id",
    "raster_components": f"WITH RECURSIVE {_COMPONENTS} SELECT vec_id, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h, count(*) AS mask_area FROM named GROUP BY vec_id, c",
    "raster_components_udtf": f"WITH RECURSIVE {_COMPONENTS} SELECT vec_id, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h, count(*) AS mask_area FROM named GROUP BY vec_id, c",
    "raster_instances": f"WITH RECURSIVE {_INSTANCES} SELECT vec_id, x, y, w, h, a AS mask_area, n AS components FROM boxes",
    "raster_contrast": f"""WITH {_CONTRAST} SELECT * FROM seen""",
    "contrast_summary": f"""WITH {_CONTRAST}, runs AS (
  SELECT label % 3 AS preset, label, count(*) AS n, count(*) FILTER (WHERE abs(contrast) < 8.0) AS faint, median(contrast) AS m
  FROM seen JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id) GROUP BY 1, 2)
SELECT preset, CAST(sum(n) AS BIGINT) AS boxes, round(CAST(sum(faint) AS DOUBLE) / sum(n), 6) AS faint_share, round(median(m), 6) AS median_of_medians FROM runs GROUP BY 1""",
    "qc_rollup": f"WITH RECURSIVE {_ROLLUP} SELECT * FROM rep",
    "qc_flags": f"WITH RECURSIVE {_REASONS} SELECT * FROM flags",
    "flag_histogram": f"WITH RECURSIVE {_REASONS} SELECT regexp_replace(reason, '[0-9]', 'N', 'g') AS shape, count(*) AS n FROM flags GROUP BY 1",
    "corpus_qc_rollup": f"""WITH RECURSIVE {_ROLLUP} SELECT count(*) AS runs, CAST(sum(frames) AS BIGINT) AS frames, CAST(sum(total_boxes) AS BIGINT) AS total_boxes, CAST(sum(empty_frames) AS BIGINT) AS empty_frames,
min(box_area_min) AS box_area_min, max(box_area_max) AS box_area_max, min(fill_ratio_min) AS fill_ratio_min, max(fill_ratio_max) AS fill_ratio_max FROM rep""",
    "yolo_labels": f"""WITH RECURSIVE {_INSTANCES} SELECT e.vec_id, CASE WHEN b.vec_id IS NULL THEN '' ELSE
printf('0 %.6f %.6f %.6f %.6f', (x + w / CAST(2 AS DOUBLE)) / {SIDE}, (y + h / CAST(2 AS DOUBLE)) / {SIDE}, w / CAST({SIDE} AS DOUBLE), h / CAST({SIDE} AS DOUBLE)) || chr(10) END AS label_text
FROM embeddings e LEFT JOIN boxes b USING (vec_id)""",
    "sky_tint": f"WITH {_PIXELS} SELECT vec_id, round(CAST(sum(CASE p % 3 WHEN 0 THEN val WHEN 2 THEN -val ELSE 0 END) AS DOUBLE) / 14, 9) AS tint FROM px WHERE p < 42 GROUP BY vec_id",
    "raster_annotate": f"""WITH RECURSIVE {_INSTANCES} SELECT e.vec_id, CAST(NULL AS VARCHAR) AS problem, printf('frame_%06d.png', e.vec_id) AS normal, {SIDE} AS width, {SIDE} AS height,
  x, y, w, h, a AS mask_area, n AS components, round_even(a / CAST(w * h AS DOUBLE), 4) AS fill_ratio FROM embeddings e LEFT JOIN boxes USING (vec_id)""",
    "gather_documents": """SELECT 'run_' || n_nationkey AS run_id, CASE n_nationkey % 7 WHEN 1 THEN 'has no manifest.json: it was never ingested, or was pruned'
  WHEN 2 THEN 'has an invalid manifest: frame_count 0 is not positive' WHEN 3 THEN 'has no annotations: convert it first' WHEN 4 THEN 'has 2 annotated frames, its manifest says 1'
  WHEN 5 THEN 'has no converter provenance: convert it again' WHEN 6 THEN 'has invalid provenance: provenance lacks run_id or converted_at' END AS problem FROM nation""",
    "affected_val": f"""WITH {_NEIGHBOURS}, v AS (SELECT run_id, CASE WHEN abs(off) <= 15.0 THEN 'ok' WHEN twin IS NOT NULL THEN 'corroborated' WHEN testable THEN 'wrong' ELSE 'unclear' END AS verdict FROM e LEFT JOIN tw USING (run_id))
SELECT verdict, count(*) AS n, count(*) FILTER (WHERE run_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) AS n_val FROM v GROUP BY 1""",
    "pair_full_outer": """WITH t AS (SELECT conv_id, turn // 2 AS slot, role, conv_id || '/' || turn AS path FROM conversations),
j AS (SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.slot, b.slot) AS slot, a.path AS l, b.path AS r
      FROM (SELECT * FROM t WHERE role = 'user') a FULL JOIN (SELECT * FROM t WHERE role = 'assistant') b ON a.conv_id = b.conv_id AND a.slot = b.slot)
SELECT conv_id, count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL) AS n_pairs, count(*) FILTER (WHERE r IS NULL) AS n_missing_right, count(*) FILTER (WHERE l IS NULL) AS n_missing_left,
  coalesce(array_to_string(list_slice(list(slot ORDER BY slot) FILTER (WHERE r IS NULL), 1, 5), ','), '') AS first_missing_right,
  coalesce(array_to_string(list_slice(list(slot ORDER BY slot) FILTER (WHERE l IS NULL), 1, 5), ','), '') AS first_missing_left
FROM j GROUP BY conv_id""",
    "duplicate_frames": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "split_by_group": f"WITH {_SPLIT} SELECT subset, count(DISTINCT source) AS runs, count(*) AS frames FROM sp GROUP BY subset",
    "unknown_val_anti": "SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)",
    "comparability_groups": "SELECT p_brand || '|' || p_type AS setting, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1",
    "scene_leak": f"""WITH {_SPLIT}, h AS (SELECT doc_id, subset, substr(sha256(text), 1, 16) AS scene FROM sp)
SELECT scene, count(*) FILTER (WHERE subset = 'train') AS n_train, count(*) FILTER (WHERE subset = 'val') AS n_val,
  min(doc_id) FILTER (WHERE subset = 'train') AS first_train, min(doc_id) FILTER (WHERE subset = 'val') AS first_val FROM h GROUP BY scene HAVING count(DISTINCT subset) > 1""",
    "gather_join": """WITH l AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS claimed FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'no customer' WHEN n IS NULL THEN 'no lines' WHEN n <> claimed THEN 'count differs' ELSE 'ok' END AS status, coalesce(n, 0) AS n_lines
FROM orders LEFT JOIN l ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "stratified_holdout": """SELECT event_type, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_type || '|' || user_id), user_id) AS k FROM (SELECT DISTINCT event_type, user_id FROM events))
WHERE k <= CASE event_type WHEN 'click' THEN 5 ELSE 3 END""",
    "clip_kind": """SELECT user_id, CASE WHEN f IS NULL OR f = 0 OR l IS NULL THEN 'unknown' WHEN l / f >= 5.0 THEN 'recession' ELSE 'crossing' END AS kind
FROM (SELECT user_id, arg_min(value, (ts, event_id)) AS f, arg_max(value, (ts, event_id)) AS l FROM events GROUP BY user_id)""",
    "neighbour_median": f"WITH {_NEIGHBOURS} SELECT run_id, expected, off, testable FROM e",
    "twin_band_join": f"WITH {_NEIGHBOURS} SELECT * FROM tw",
    "nearest_row": f"WITH {_USERS} SELECT a.run_id, arg_min(b.run_id, (abs(a.tint - b.tint), b.run_id)) AS nearest FROM r a JOIN r b ON a.run_id <> b.run_id GROUP BY a.run_id",
    "sky_verdicts": f"""WITH {_NEIGHBOURS} SELECT run_id, CASE WHEN abs(off) <= 15.0 THEN 'ok' WHEN twin IS NOT NULL THEN 'corroborated' WHEN testable THEN 'wrong' ELSE 'unclear' END AS verdict FROM e LEFT JOIN tw USING (run_id)""",
    "kth_per_group": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE k = least(3, n)""",
    "topk_with_ties": "SELECT l_suppkey, l_quantity, CAST(k AS INT) AS rank FROM (SELECT l_suppkey, l_quantity, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS k FROM lineitem) WHERE k <= 8",
    "prefix_counts": rf"WITH {_KEYS} SELECT regexp_extract(key, '^((?:raw|qc)/[^/]+|datasets/auto-[^/]+)/', 1) AS prefix, count(*) AS n FROM keys GROUP BY 1 HAVING prefix <> ''",
    "host_counts": "SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS prefix, count(*) AS n FROM pages GROUP BY 1 HAVING prefix <> ''",
    "key_parse": rf"WITH {_KEYS} SELECT event_id, regexp_extract(key, '^raw/([^/]*)/manifest\.json$', 1) AS run_id, 'auto-' || regexp_extract(key, '^raw/([^/]*)/manifest\.json$', 1) AS version FROM keys WHERE regexp_matches(key, '^raw/[^/]*/manifest\.json$')",
    "prune_semi_join": rf"""WITH {_KEYS}, o AS (SELECT DISTINCT regexp_extract(key, '^(?:raw/|qc/|datasets/auto-)([^/]+)/', 1) AS run_id, key FROM keys)
SELECT run_id, key FROM o WHERE run_id IN (SELECT 'run_' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "object_counts": rf"""WITH {_KEYS}, o AS (SELECT regexp_extract(key, '^(?:raw/|qc/|datasets/auto-)([^/]+)/', 1) AS run_id, string_split(key, '/')[1] AS area FROM keys)
SELECT r.run_id, count(*) FILTER (WHERE area = 'raw') AS raw, count(*) FILTER (WHERE area = 'datasets') AS dataset, count(*) FILTER (WHERE area = 'qc') AS qc,
  count(*) FILTER (WHERE area = 'raw') = 22 AND count(*) FILTER (WHERE area = 'datasets') = 2 AND count(*) FILTER (WHERE area = 'qc') = 11 AS complete
FROM (SELECT DISTINCT 'run_' || user_id AS run_id FROM events) r LEFT JOIN o USING (run_id) GROUP BY r.run_id""",
    "corpus_rollup": """SELECT count(*) AS runs, CAST(sum(n) AS BIGINT) AS frames, CAST(sum(b) AS BIGINT) AS total_boxes, CAST(sum(e) AS BIGINT) AS empty_frames, min(low) AS box_area_min, max(high) AS box_area_max,
  min(low / 50) AS fill_ratio_min, max(high / 50) AS fill_ratio_max
FROM (SELECT l_orderkey, count(*) AS n, count(l_quantity) AS b, count(*) FILTER (WHERE l_quantity < 5) AS e, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1)""",
    "order_contrast": """WITH o AS (SELECT l_orderkey % 3 AS third, l_orderkey, count(*) AS n, count(*) FILTER (WHERE abs(CAST(l_quantity AS DOUBLE) - 25) < 8.0) AS faint, median(CAST(l_quantity AS DOUBLE) - 25) AS m FROM lineitem GROUP BY 1, 2)
SELECT third, CAST(sum(n) AS BIGINT) AS boxes, round(CAST(sum(faint) AS DOUBLE) / sum(n), 6) AS faint_share, round(median(m), 6) AS median_of_medians FROM o GROUP BY 1""",
    "json_props": """SELECT CASE event_type WHEN 'click' THEN 'unknown' ELSE event_type END AS preset,
  CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'unknown' WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 4 >= 5.0 THEN 'recession' ELSE 'crossing' END AS kind,
  count(*) AS n, count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS n_val FROM events GROUP BY 1, 2""",
    "placements": f"WITH {_SPLIT} SELECT doc_id, 'images/' || subset || '/' || source || printf('_%06d', doc_id) || '.png' AS image_key FROM sp",
    "label_image_pairs": "SELECT CASE WHEN l.doc_id IS NULL THEN 'image only' WHEN d.doc_id IS NULL THEN 'label only' ELSE 'both' END AS side, count(*) AS n FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1",
    "preset_default": "SELECT coalesce(nullif(o_orderpriority, ''), 'unknown') AS preset, count(*) AS n FROM orders GROUP BY 1",
    "crop_window": f"WITH RECURSIVE {_INSTANCES} SELECT vec_id, CAST(greatest(0, least(x + w // 2 - 8, 16)) AS INT) AS left, CAST(greatest(0, least(y + h // 2 - 4, 23)) AS INT) AS top FROM boxes",
    "stream_trigger": "SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1",
}
