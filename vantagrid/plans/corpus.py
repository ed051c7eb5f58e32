"""Corpus analytics: verification, pruning, hold-out configs, sky audit."""

from __future__ import annotations

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.functions import text
from vantagrid.operators import qc, raster
from vantagrid.operators import runs as ops
from vantagrid.sources.documents import list_keys, read_manifests, read_reports, whole_texts
from vantagrid.sources.frames import kth_image
from vantagrid.sources.store import Store, arrow_path


def verify(spark: SparkSession, root: str, qc_root: str, runs: DataFrame, frames: int = 60, extra: int = 0) -> dict:
    """Object counts, missing reports, the rollup and the flag histogram of the named runs."""
    counts = ops.object_counts(list_keys(spark, root), runs, frames, extra).where(~F.col("complete"))
    wanted = runs.select("run_id").distinct()
    reports = read_reports(spark, qc_root).join(wanted, "run_id", "left_semi").cache()
    flags = reports.select("run_id", F.explode("flags").alias("f")).select("run_id", "f.frame_index", "f.reason")
    out = {
        "mismatches": [r.asDict() for r in counts.orderBy("run_id").collect()],
        "missing": [r.run_id for r in ops.unknown_members(wanted, reports, "run_id").orderBy("run_id").collect()],
        "rollup": qc.corpus_rollup(reports).first().asDict(),
        "shapes": [(r["shape"], r["n"]) for r in qc.flag_histogram(flags).collect()],
        "fragmented": [tuple(r) for r in flags.where(F.col("reason").contains("pieces")).orderBy("run_id", "frame_index").collect()],
    }
    reports.unpersist()
    return out


def snapshot_keys(spark: SparkSession, root: str, to: str) -> DataFrame:
    """One listing of a store, (key, length), written as a table that later counts and prunings read instead of listing again."""
    list_keys(spark, root).write.mode("overwrite").parquet(to)
    return spark.read.parquet(to)


def prune(spark: SparkSession, root: str, runs: DataFrame, apply: bool = False, keys: DataFrame | None = None) -> dict[str, int]:
    """Objects that the named runs own, counted by prefix; deleted only with ``apply``. ``keys`` is a snapshot, else the store is listed."""
    doomed = ops.owned_keys(list_keys(spark, root) if keys is None else keys, runs).cache()
    counts = {r.prefix: r.n for r in ops.prefix_counts(doomed, text.owned_prefix(F.col("key"))).orderBy("prefix").collect()}
    store = Store.at(spark, root)
    if apply and store.deletes_at_once > 1:
        store.delete_keys(r.key for r in doomed.toLocalIterator())
    elif apply:
        base = store.root

        def delete(rows) -> None:
            for r in rows:
                fs, path = arrow_path(f"{base}/{r.key}")
                fs.delete_file(path)

        doomed.foreachPartition(delete)
    doomed.unpersist()
    return counts


def strata(manifests: DataFrame) -> DataFrame:
    """(run_id, preset, kind) of manifests that are valid."""
    value = {k: F.get_json_object("randomization", f"$.{k}") for k in ("preset", "distance_start_cm", "distance_end_cm")}
    preset = preset_of(value["preset"])
    kind = text.clip_kind(value["distance_start_cm"].try_cast("double"), value["distance_end_cm"].try_cast("double"))
    return manifests.where("problem IS NULL").select("run_id", preset.alias("preset"), kind.alias("kind"))


def strata_counts(found: DataFrame, val: DataFrame) -> DataFrame:
    """(preset, kind, n, n_val): runs of each preset and kind, and how many of them ``val`` (run_id) holds out."""
    held = ops.split_subsets(found, val, "run_id")
    return held.groupBy("preset", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("subset") == "val").alias("n_val"))


def preset_of(value) -> Column:
    """The preset a run was made with; none or an empty one is unknown."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("unknown"))


def affected(verdicts: DataFrame, val: DataFrame) -> DataFrame:
    """(verdict, n, n_val): runs of each verdict, and how many of them are held out."""
    return ops.split_subsets(verdicts, val, "run_id").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("subset") == "val").alias("n_val"))


def holdout_config(spark: SparkSession, raw_root: str, dataset_root: str, seed_prefix: str = "3", recession: int = 2, crossing: int = 1) -> str:
    """A build config of the runs that match, with the published draw as its hold-out; YAML text."""
    store = Store.at(spark, raw_root)
    found = strata(read_manifests(whole_texts(spark, store.root, "manifest.json")))
    rows = ops.matching_seed(found, seed_prefix).orderBy("run_id").collect()
    groups: dict[tuple[str, str], list[str]] = {}
    for r in rows:
        groups.setdefault((r.preset, r.kind), []).append(r.run_id)
    val = ops.drawn_holdout(groups, recession, crossing)
    lines = [f"# {len(rows)} runs, {len(val)} held out: drawn blind from every preset and kind."]
    held = {(p, k): sum((p, k) == v[1:] for v in val) for p, k in groups}
    lines += [f"#   {p}, {k}: {len(groups[p, k])} runs, {held[p, k]} held out" for p, k in sorted(groups)] + ["runs:"]
    for preset in sorted({r.preset for r in rows}):
        lines += [f"  # {preset}", *(f"  - {r.run_id}" for r in rows if r.preset == preset)]
    lines += ["split:", "  mode: by_run", "  val_runs:" if val else "  val_runs: []"]
    lines += [f"    - {run}  # {preset}, {kind}" for run, preset, kind in val]
    tail = yaml.safe_dump({"storage": {"raw_root": raw_root, "dataset_root": dataset_root}}, sort_keys=False)
    return "\n".join(lines) + "\n" + tail


def audit_sky(spark: SparkSession, raw_root: str, run_ids: list[str], rows: int = 300) -> DataFrame:
    """(run_id, place, seed, tod, tint, expected, off, testable, twin, verdict) of runs that record a time of day."""
    store = Store.at(spark, raw_root)
    named = spark.createDataFrame([(r, k) for k, r in enumerate(run_ids)], "run_id string, place int")
    manifests = read_manifests(whole_texts(spark, [store.path(f"{r}/manifest.json") for r in run_ids]))
    tod = F.get_json_object("randomization", "$.time_of_day").try_cast("double")
    known = manifests.where("problem IS NULL").select("run_id", "seed", tod.alias("tod")).where("tod IS NOT NULL")
    tints = raster.sky_tints(kth_image(spark, store.root, named), rows)
    return ops.sky_verdicts(named.join(known, "run_id").join(tints, "run_id"))
