"""Command line: ingest, convert, build, submit, verify, prune, holdout, audit, watch. A refusal exits with 2."""

from __future__ import annotations

import argparse
import subprocess
import sys
from datetime import date

from pyspark.sql import SparkSession

from vantagrid.config import load_build_config, load_convert_config
from vantagrid.errors import Refusal


def session() -> SparkSession:
    return SparkSession.builder.appName("vantagrid").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _ingest(a: argparse.Namespace) -> None:
    from vantagrid.plans.ingest import ingest_capture

    root = a.raw_root or load_convert_config(a.config).raw_root
    m = ingest_capture(session(), a.normal, a.mask, a.run_id, root, a.captured_at, a.ue_map, a.drone_model)
    print(f"run {m['run_id']}: {m['frame_count']} frame pairs of {m['camera_sequence']}")


def _convert(a: argparse.Namespace) -> None:
    from vantagrid.plans.convert import convert_run

    r = convert_run(session(), a.run_id, load_convert_config(a.config), a.version)
    print(f"run {r.run_id}: {r.frames} frames, {r.total_boxes} boxes, {r.empty_frames} empty, {len(r.flags)} flags")
    for f in r.flags:
        print(f"  frame {f.frame_index}: {f.reason}")


def _build(a: argparse.Namespace) -> None:
    from vantagrid.plans.build import build_dataset

    t = build_dataset(session(), a.version, load_build_config(a.config))["totals"]
    print(f"version {a.version}: " + ", ".join(f"{v} {k.replace('_', ' ')}" for k, v in t.items()))


def job_name(run_id: str, version: str) -> str:
    return f"convert-{run_id}-{version}"


def submit_command(run_id: str, version: str, config: str, master: str) -> list[str]:
    """The spark-submit call of a conversion; settings travel as arguments, never as a replaced command."""
    return ["spark-submit", "--master", master, "--name", job_name(run_id, version), __file__, "convert", "--config", config, "--run-id", run_id, "--version", version]


def _submit(a: argparse.Namespace) -> None:
    subprocess.run(submit_command(a.run_id, a.version, a.config, a.master), check=True)


def _verify(a: argparse.Namespace) -> int:
    from vantagrid.plans.corpus import verify
    from vantagrid.sources.documents import read_names

    spark = session()
    out = verify(spark, a.root, a.qc_root, read_names(spark, a.runs), a.frames, a.extra)
    for k, v in out.items():
        print(f"{k}: {v}")
    return 1 if out["missing"] else 0


def _prune(a: argparse.Namespace) -> None:
    from vantagrid.plans.corpus import prune
    from vantagrid.sources.documents import read_names

    spark = session()
    counts = prune(spark, a.root, read_names(spark, a.runs), a.apply)
    for prefix, n in counts.items():
        print(f"{n:8d}  {prefix}")
    print(f"{sum(counts.values())} objects " + ("deleted" if a.apply else "would go; --apply deletes them"))


def _holdout(a: argparse.Namespace) -> None:
    from vantagrid.plans.corpus import holdout_config

    print(holdout_config(session(), a.raw_root, a.dataset_root, a.seed_prefix, a.val_recession, a.val_crossing), end="")


def _audit(a: argparse.Namespace) -> None:
    from vantagrid.plans.corpus import audit_sky

    config = load_build_config(a.config)
    rows = audit_sky(session(), config.raw_root, list(config.runs)).orderBy("tod", "place").collect()
    for r in rows:
        side = "val" if r.run_id in config.val_runs else "train"
        print(f"{r.run_id}  {r.tod:6.2f}  {r.tint:9.2f}  {r.verdict}  {side}")
    wrong = [r.run_id for r in rows if r.verdict == "wrong"]
    print(f"{len(wrong)} runs are wrong, {len(set(wrong) & set(config.val_runs))} of them held out")


def _watch(a: argparse.Namespace) -> None:
    from vantagrid.plans.convert import convert_runs
    from vantagrid.streaming.trigger import convert_on_arrival

    spark, config = session(), load_convert_config(a.config)
    convert_on_arrival(spark, config.raw_root, a.checkpoint, lambda found: convert_runs(spark, found, config, lambda r: f"auto-{r}"), a.once).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vantagrid", description="paired renders to dataset versions, on Spark")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(name: str, handler, *required: str, **optional) -> argparse.ArgumentParser:
        p = verbs.add_parser(name)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        for k, v in optional.items():
            p.add_argument(f"--{k.replace('_', '-')}", default=v, **({"action": "store_true"} if v is False else {"type": type(v)} if isinstance(v, int) else {}))
        p.set_defaults(handler=handler)
        return p

    verb("ingest", _ingest, "config", "normal", "mask", "run-id", "ue-map", "drone-model", captured_at=date.today().isoformat(), raw_root=None)
    verb("convert", _convert, "config", "run-id", "version")
    verb("build", _build, "config", "version")
    verb("submit", _submit, "config", "run-id", "version", master="yarn")
    verb("verify", _verify, "root", "qc-root", "runs", frames=60, extra=0)
    verb("prune", _prune, "root", "runs", apply=False)
    verb("holdout", _holdout, "raw-root", "dataset-root", seed_prefix="3", val_recession=2, val_crossing=1)
    verb("audit", _audit, "config")
    verb("watch", _watch, "config", "checkpoint", once=False)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.handler(a) or 0
    except Refusal as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
