"""Build: converted runs become one dataset version, or a refusal says why not.

Order of checks: the version is new; each run's manifest, annotations and provenance
are there, valid and agree in frames; all runs were converted alike; the hold-out
names runs of the build; no scene is on both sides; classes are recorded. Then all
placements are decided, placed, described, and committed by the manifest.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.config import BuildConfig
from vantagrid.errors import BuildRefused, KeyExists, NotPermitted, SplitRefused
from vantagrid.functions import text
from vantagrid.operators import runs as ops
from vantagrid.plans.place import place
from vantagrid.provenance import converter_stamp, now
from vantagrid.schemas import MANIFEST, PROVENANCE_SUFFIX, SCHEMA_VERSION
from vantagrid.sources.documents import read_annotations, read_manifests, read_provenance, whole_texts
from vantagrid.sources.store import Store


def descriptor(class_map: dict[int, str]) -> str:
    """The dataset descriptor: fixed keys in fixed order, classes by id."""
    import yaml

    # Keys and folders that trainers look for.
    head = {"path": ".", "train": "images/train", "val": "images/val", "names": {k: class_map[k] for k in sorted(class_map)}}
    return yaml.safe_dump(head, sort_keys=False)


def gather(spark: SparkSession, config: BuildConfig) -> DataFrame:
    """One row a run of the config, in its order (place): documents joined, ``problem`` where something is missing or wrong."""
    raw, datasets = Store.at(spark, config.raw_root), Store.at(spark, config.dataset_root)
    wanted = spark.createDataFrame([(r, k) for k, r in enumerate(config.runs)], "run_id string, place int")
    last = F.element_at(F.split("path", "/"), -1)

    def there(store: Store, keys: list[str]) -> list[str]:
        with ThreadPoolExecutor(16) as pool:
            return [store.path(k) for k, found in zip(keys, pool.map(store.exists, keys), strict=True) if found]

    def texts(paths: list[str]) -> DataFrame:
        return whole_texts(spark, paths) if paths else spark.createDataFrame([], "path string, text string")

    m = read_manifests(texts(there(raw, [f"{r}/{MANIFEST}" for r in config.runs]))).withColumn("of_run", F.element_at(F.split("path", "/"), -2))
    a = read_annotations(texts(there(datasets, [f"auto-{r}/annotations/{r}.json" for r in config.runs]))).withColumn("of_run", F.regexp_replace(last, r"\.json$", ""))
    p = read_provenance(texts(there(datasets, [f"auto-{r}/annotations/{r}{PROVENANCE_SUFFIX}" for r in config.runs]))).withColumn("of_run", F.regexp_replace(last, r"\.provenance\.json$", ""))
    out = ops.gathered(wanted, "run_id", {"manifest": (m, "of_run"), "annotated": (a, "of_run"), "provenance": (p, "of_run")})
    counted = F.concat(F.lit("has "), F.col("annotated.n_frames").cast("string"), F.lit(" annotated frames, its manifest says "), F.col("manifest.frame_count").cast("string"))
    problem = ops.first_problem(
        (F.col("manifest").isNull(), f"has no {MANIFEST}: it was never ingested, or was pruned"),
        (F.col("manifest.problem").isNotNull(), F.concat(F.lit("has an invalid manifest: "), "manifest.problem")),
        (F.col("annotated").isNull(), "has no annotations: convert it first"),
        (F.col("annotated.problem").isNotNull(), F.concat(F.lit("has invalid annotations: "), "annotated.problem")),
        (F.col("provenance").isNull(), "has no converter provenance: convert it again"),
        (F.col("provenance.problem").isNotNull(), F.concat(F.lit("has invalid provenance: "), "provenance.problem")),
        (F.col("annotated.n_frames") != F.col("manifest.frame_count"), counted),
    )
    return out.withColumn("problem", problem)


def _require_alike(inputs: DataFrame) -> None:
    for column, what in (("provenance.conversion", "conversion settings"), ("provenance.converter", "converters")):
        groups = ops.comparability(inputs, F.col(column), "run_id").orderBy("setting").collect()
        if len(groups) > 1:
            detail = "; ".join(f"{g.setting}: {g.n} runs, such as {g.first}" for g in groups)
            raise BuildRefused(f"labels are not comparable, they were made under {len(groups)} {what}: {detail}")


def plan_placements(inputs: DataFrame, raw_root: str, target: str) -> DataFrame:
    """(run_id, subset, source, target, label_target, label_text), one row a frame of inputs that carry a subset."""
    frames = inputs.select("run_id", "subset", F.explode("annotated.frames").alias("f"))
    stem = text.placed_stem(F.col("run_id"), F.col("f.frame_index"))
    return frames.select(
        "run_id",
        "subset",
        F.concat(F.lit(f"{raw_root}/"), "run_id", F.lit("/normal/"), "f.normal").alias("source"),
        F.concat(F.lit(f"{target}/images/"), "subset", F.lit("/"), stem, text.suffix(F.col("f.normal"))).alias("target"),
        F.concat(F.lit(f"{target}/labels/"), "subset", F.lit("/"), stem, F.lit(".txt")).alias("label_target"),
        text.label_text("f.boxes", "f.width", "f.height").alias("label_text"),
    )


def _record(r) -> dict:
    m = json.loads(r.manifest.text)
    # The members of a run's record.
    return {
        "run_id": r.run_id,
        "source_version": f"auto-{r.run_id}",
        "subset": r.subset,
        "seed": r.manifest.seed,
        "captured_at": r.manifest.captured_at,
        "ue_map": r.manifest.ue_map,
        "drone_model": r.manifest.drone_model,
        "camera_sequence": r.manifest.camera_sequence,
        "randomization": m.get("randomization") or {},
        "generator": m.get("generator") or {},
        "converter": json.loads(r.provenance.converter),
        "converted_at": r.provenance.converted_at,
        "scene_identity": r.manifest.scene,
        "frames": r.n_frames,
        "boxes": r.n_boxes,
    }


def build_dataset(spark: SparkSession, version: str, config: BuildConfig) -> dict:
    """Assemble a version; its manifest, as a dictionary."""
    raw, datasets = Store.at(spark, config.raw_root), Store.at(spark, config.dataset_root)
    key = f"{version}/{MANIFEST}"
    try:
        if datasets.exists(key):
            raise BuildRefused(f"version {version} is already there: {datasets.describe(version)}")
    except NotPermitted:
        pass  # the commit below decides

    inputs = gather(spark, config).cache()
    if bad := inputs.where("problem IS NOT NULL").orderBy("place").first():
        raise BuildRefused(f"run {bad.run_id} {bad.problem}")
    _require_alike(inputs)

    val = spark.createDataFrame([(r,) for r in config.val_runs], "run_id string")
    unknown = [r.run_id for r in ops.unknown_members(val, inputs, "run_id").orderBy("run_id").collect()]
    if unknown:
        raise SplitRefused(f"the hold-out names runs that are not in the build: {unknown}")
    inputs = ops.split_subsets(inputs, val, "run_id")
    scenes = inputs.select("run_id", "subset", F.col("manifest.scene").alias("scene"))
    leaks = ops.scene_leaks(scenes, "scene", "run_id").orderBy("scene").collect()
    if leaks:
        detail = "; ".join(f"{x.first_train} in train, {x.first_val} in val" for x in leaks)
        raise BuildRefused(f"{len(leaks)} scenes are on both sides of the split: {detail}")

    conversion = json.loads(inputs.orderBy("place").select("provenance.conversion").first()[0])
    class_map = {int(k): v for k, v in (conversion.get("class_map") or {}).items()}
    if not class_map:
        raise BuildRefused("the runs' provenance records no classes")

    boxes = F.aggregate("annotated.frames", F.lit(0), lambda n, f: n + F.size(f["boxes"]))
    told = inputs.select("run_id", "subset", "manifest", "provenance", F.col("annotated.n_frames").alias("n_frames"), boxes.alias("n_boxes")).orderBy("run_id").collect()
    place(plan_placements(inputs, raw.root, f"{datasets.root}/{version}/yolo"))
    datasets.write_text(f"{version}/yolo/dataset.yaml", descriptor(class_map))

    records = [_record(r) for r in told]
    side = {s: [r for r in records if r["subset"] == s] for s in ("train", "val")}
    # The members of a dataset manifest.
    manifest = {
        "version": version,
        "built_at": now(),
        "schema_version": SCHEMA_VERSION,
        "builder": dict(converter_stamp()),
        "conversion": conversion,
        "split": {"mode": config.mode, "train": [r["run_id"] for r in side["train"]], "val": [r["run_id"] for r in side["val"]]},
        "totals": {
            "runs": len(records),
            "frames": sum(r["frames"] for r in records),
            "boxes": sum(r["boxes"] for r in records),
            "train_runs": len(side["train"]),
            "val_runs": len(side["val"]),
            "train_frames": sum(r["frames"] for r in side["train"]),
            "val_frames": sum(r["frames"] for r in side["val"]),
        },
        "runs": records,
    }
    inputs.unpersist()
    try:
        datasets.write_text_if_absent(key, json.dumps(manifest, indent=2))
    except KeyExists:
        raise BuildRefused(f"version {version} was committed by another build meanwhile; what this one placed is debris") from None
    return manifest


def checked_dataset_manifest(data: dict) -> dict:
    if not isinstance(data, dict) or data.get("schema_version") != SCHEMA_VERSION:
        raise BuildRefused(f"dataset manifest schema_version {data.get('schema_version') if isinstance(data, dict) else None!r} is not {SCHEMA_VERSION}")
    return {"builder": {}, "conversion": {}, "split": {}, "totals": {}, "runs": []} | data
