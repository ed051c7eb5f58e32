"""Ingest, convert, build and the corpus tools, end to end on small captures."""

import json
import subprocess
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import yaml

from vantagrid import cli
from vantagrid.config import BuildConfig, ConvertConfig, load_build_config, load_convert_config
from vantagrid.errors import BuildRefused, ConfigRefused, ConvertRefused, IngestRefused, KeyExists, KeyMissing, ManifestRefused, NotPermitted, PairingRefused, SplitRefused, StoreRefused
from vantagrid.functions import png
from vantagrid.functions.text import label_line, scene_of
from vantagrid.plans import convert, corpus
from vantagrid.plans.build import build_dataset, checked_dataset_manifest
from vantagrid.plans.convert import convert_run, convert_runs
from vantagrid.plans.corpus import prune, snapshot_keys
from vantagrid.plans.ingest import ingest_capture
from vantagrid.provenance import stamp_from
from vantagrid.sources.documents import checked_annotations, checked_manifest, checked_provenance, list_keys
from vantagrid.sources.frames import checked_frames
from vantagrid.sources.store import Store, copy_file
from vantagrid.streaming.trigger import convert_on_arrival

MANIFEST = {"captured_at": "2026-07-19", "ue_map": "valley", "drone_model": "quad", "camera_sequence": "seq", "schema_version": 1}


def capture(root: Path, blobs, name="seq", nested=""):
    for side in ("normal", "mask"):
        (root / side / nested).mkdir(parents=True)
    for i, blob in enumerate(blobs):
        normal, mask = np.full((48, 64, 3), 90, np.uint8), np.zeros((48, 64, 4), np.uint8)
        mask[:, :, 3] = 255
        if blob:
            y0, y1, x0, x1 = blob
            mask[y0:y1, x0:x1, :3] = 255
            normal[y0:y1, x0:x1] = 40
        (root / "normal" / nested / f"{name}.{i:04d}.png").write_bytes(png.encode(normal))
        (root / "mask" / nested / f"{name}.{i:04d}.png").write_bytes(png.encode(mask))
    return root


THREE = [(10, 30, 5, 15), None, (20, 40, 30, 50)]


def converting(tmp_path) -> ConvertConfig:
    return ConvertConfig({0: "drone"}, 32, 16, str(tmp_path / "raw"), str(tmp_path / "data"), str(tmp_path / "qc"))


def building(tmp_path, runs, val=()) -> BuildConfig:
    return BuildConfig(tuple(runs), tuple(val), "by_run", str(tmp_path / "raw"), str(tmp_path / "data"))


def ingest(spark, tmp_path, run, blobs=THREE):
    root = capture(tmp_path / "cap" / run, blobs, nested="Camera/Color")
    return ingest_capture(spark, str(root / "normal"), str(root / "mask"), run, str(tmp_path / "raw"), "2026-07-19", "valley", "quad")


def set_manifest(tmp_path, run, **values):
    path = tmp_path / "raw" / run / "manifest.json"
    path.write_text(json.dumps(json.loads(path.read_text()) | values))


@pytest.fixture
def corpus_of_four(spark, tmp_path):
    runs = [f"run_{k}" for k in range(4)]
    for k, r in enumerate(runs):
        ingest(spark, tmp_path, r, [(10, 30, 5, 15)] * 3)
        set_manifest(tmp_path, r, seed=k, randomization={"preset": "fog", "list": [1, 2]}, generator={"commit": "abc"})
    convert_runs(spark, runs, converting(tmp_path), lambda r: f"auto-{r}")
    return tmp_path, runs


def test_three_frames_end_to_end(spark, tmp_path):
    m = ingest(spark, tmp_path, "run_a")
    assert (m["frame_count"], m["camera_sequence"]) == (3, "seq")
    assert sorted(p.name for p in (tmp_path / "raw/run_a/mask").glob("*.png")) == [f"frame_{i:06d}.png" for i in range(3)]
    r = convert_run(spark, "run_a", converting(tmp_path), "v1")
    assert (r.frames, r.empty_frames, r.total_boxes) == (3, 1, 2)
    assert (r.contrast_min, r.contrast_max, r.fill_ratio_min) == (-50.0, -50.0, 1.0)
    frames = json.loads((tmp_path / "data/v1/annotations/run_a.json").read_text())
    assert [f["frame_index"] for f in frames] == [0, 1, 2] and frames[1]["boxes"] == []
    assert frames[0]["boxes"] == [{"class_id": 0, "x": 5, "y": 10, "w": 10, "h": 20, "mask_area": 200, "fill_ratio": 1.0, "components": 1, "contrast": -50.0}]
    side = json.loads((tmp_path / "data/v1/annotations/run_a.provenance.json").read_text())
    assert side["conversion"] == {"threshold": 32, "min_box_area": 16, "class_map": {"0": "drone"}, "contrast": {"core_alpha": 200, "ring_px": 15, "min_core_px": 8}}
    report = json.loads((tmp_path / "qc/run_a/report.json").read_text())
    assert report["flags"] == [] and report["contrast_unmeasured"] == 0
    debug = sorted((tmp_path / "qc/run_a/debug").glob("*.png"))
    assert [p.name for p in debug] == [f"run_a_{i:06d}.png" for i in range(3)]
    shown = spark.read.format("image").load(str(debug[0])).select("image.*").first()
    image = np.frombuffer(bytes(shown.data), np.uint8).reshape(48, 64, 3)
    assert (image[10, 5:15] == (0, 255, 0)).all() and (image[30, 5:15] == (0, 255, 0)).all()


def test_flags(spark, tmp_path):
    ingest(spark, tmp_path, "run_f", [(0, 4, 0, 4)])
    r = convert_run(spark, "run_f", converting(tmp_path), "v1")
    assert [f.reason for f in r.flags] == ["tiny box 4x4", "box touches frame edge"]


def test_runs_are_immutable_and_debris_is_cleared(spark, tmp_path):
    (tmp_path / "raw/run_a/normal").mkdir(parents=True)
    (tmp_path / "raw/run_a/normal/frame_000099.png").write_bytes(b"x")
    ingest(spark, tmp_path, "run_a")
    assert not (tmp_path / "raw/run_a/normal/frame_000099.png").exists()
    with pytest.raises(IngestRefused):
        ingest_capture(spark, str(tmp_path / "cap/run_a/normal"), str(tmp_path / "cap/run_a/mask"), "run_a", str(tmp_path / "raw"), "2026-07-19", "valley", "quad")


def test_broken_captures(spark, tmp_path):
    root = capture(tmp_path / "a", THREE)
    with pytest.raises(PairingRefused):
        checked_frames(spark, str(tmp_path / "none"), False)
    (root / "mask/seq.0001.png").unlink()
    (root / "mask/seq.0007.png").write_bytes(b"x")
    with pytest.raises(PairingRefused, match="1.*mask.*1.*normal"):
        ingest_capture(spark, str(root / "normal"), str(root / "mask"), "r", str(tmp_path / "raw"), "2026-07-19", "v", "q")
    (root / "normal/other.0001.png").write_bytes(b"x")
    with pytest.raises(PairingRefused, match="index 1 occurs 2"):
        checked_frames(spark, str(root / "normal"), True)
    (root / "normal/thumbnail.png").write_bytes(b"x")
    with pytest.raises(PairingRefused, match="thumbnail"):
        checked_frames(spark, str(root / "normal"), True)
    assert not (tmp_path / "raw").exists()


def test_corrupt_runs_are_not_converted(spark, tmp_path):
    with pytest.raises(ConvertRefused, match="manifest"):
        convert_run(spark, "nobody", converting(tmp_path), "v1")
    ingest(spark, tmp_path, "run_a")
    for side in ("normal", "mask"):
        (tmp_path / f"raw/run_a/{side}/frame_000002.png").unlink()
    with pytest.raises(ConvertRefused, match="2 frame pairs"):
        convert_run(spark, "run_a", converting(tmp_path), "v1")
    set_manifest(tmp_path, "run_a", frame_count=2)
    (tmp_path / "raw/run_a/mask/frame_000001.png").write_bytes(png.encode(np.zeros((8, 8, 3), np.uint8)))
    with pytest.raises(ValueError, match="frame 1"):
        convert_run(spark, "run_a", converting(tmp_path), "v1")
    assert not (tmp_path / "data").exists()


def test_build(spark, corpus_of_four):
    tmp_path, runs = corpus_of_four
    m = build_dataset(spark, "v001", building(tmp_path, runs, ["run_2"]))
    assert m["totals"] == {"runs": 4, "frames": 12, "boxes": 12, "train_runs": 3, "val_runs": 1, "train_frames": 9, "val_frames": 3}
    assert json.loads((tmp_path / "data/v001/manifest.json").read_text()) == m
    yolo = tmp_path / "data/v001/yolo"
    assert len(list((yolo / "images/train").glob("*.png"))) == 9
    assert {p.stem for p in (yolo / "images/val").iterdir() if p.suffix == ".png"} == {p.stem for p in (yolo / "labels/val").iterdir() if p.suffix == ".txt"}
    assert (yolo / "labels/val/run_2_000000.txt").read_text() == "0 0.156250 0.416667 0.156250 0.416667\n"
    assert (yolo / "images/val/run_2_000000.png").read_bytes() == (tmp_path / "raw/run_2/normal/frame_000000.png").read_bytes()
    assert (yolo / "dataset.yaml").read_text().splitlines() == ["path: .", "train: images/train", "val: images/val", "names:", "  0: drone"]
    assert m["runs"][0]["randomization"] == {"preset": "fog", "list": [1, 2]} and len(m["runs"][0]["scene_identity"]) == 16
    with pytest.raises(BuildRefused, match="already"):
        build_dataset(spark, "v001", building(tmp_path, runs))


def test_build_refusals(spark, corpus_of_four):
    tmp_path, runs = corpus_of_four
    with pytest.raises(BuildRefused, match="never ingested"):
        build_dataset(spark, "v", building(tmp_path, [*runs, "run_9"]))
    with pytest.raises(SplitRefused, match="run_8"):
        build_dataset(spark, "v", building(tmp_path, runs, ["run_8"]))
    set_manifest(tmp_path, "run_1", seed=0)
    with pytest.raises(BuildRefused, match="both sides"):
        build_dataset(spark, "v", building(tmp_path, runs, ["run_1"]))
    build_dataset(spark, "same-side", building(tmp_path, runs, ["run_2"]))
    set_manifest(tmp_path, "run_1", generator={"commit": "other"})
    build_dataset(spark, "other-generator", building(tmp_path, runs, ["run_1"]))
    side = tmp_path / "data/auto-run_3/annotations/run_3.provenance.json"
    p = json.loads(side.read_text())
    side.write_text(json.dumps(p | {"conversion": p["conversion"] | {"threshold": 12}}))
    with pytest.raises(BuildRefused, match="conversion settings"):
        build_dataset(spark, "v", building(tmp_path, runs))
    side.write_text(json.dumps(p | {"converter": {"commit": "zzz"}}))
    with pytest.raises(BuildRefused, match="converters"):
        build_dataset(spark, "v", building(tmp_path, runs))
    side.unlink()
    with pytest.raises(BuildRefused, match="provenance"):
        build_dataset(spark, "v", building(tmp_path, runs))
    set_manifest(tmp_path, "run_0", frame_count=5)
    with pytest.raises(BuildRefused, match="3 annotated frames"):
        build_dataset(spark, "v", building(tmp_path, runs))
    assert not (tmp_path / "data/v").exists()


def test_failure_while_placing_leaves_no_manifest(spark, corpus_of_four):
    tmp_path, runs = corpus_of_four
    (tmp_path / "raw/run_3/normal/frame_000001.png").unlink()
    with pytest.raises(Exception, match="frame_000001"):
        build_dataset(spark, "v", building(tmp_path, runs))
    assert not (tmp_path / "data/v/manifest.json").exists() and not (tmp_path / "data/v/yolo/dataset.yaml").exists()


def test_verify_prune_and_holdout(spark, corpus_of_four):
    tmp_path, runs = corpus_of_four
    (tmp_path / "datasets").symlink_to(tmp_path / "data")
    names = spark.createDataFrame([(r,) for r in runs], "run_id string")
    for r in runs:
        (tmp_path / f"raw/{r}/job.json").write_text("{}")
    keys = list_keys(spark, f"file://{tmp_path}/raw").select("key").collect()
    assert "run_0/manifest.json" in {k.key for k in keys}
    out = corpus.verify(spark, f"file://{tmp_path}", str(tmp_path / "qc"), spark.createDataFrame([("run_0",), ("run_x",)], "run_id string"), frames=3)
    assert out["missing"] == ["run_x"] and out["rollup"]["frames"] == 3 and out["shapes"] == []
    counts = corpus.prune(spark, f"file://{tmp_path}", names.where("run_id = 'run_1'"))
    assert counts["raw/run_1"] == 8 and counts["qc/run_1"] == 4 and (tmp_path / "raw/run_1").exists()
    corpus.prune(spark, f"file://{tmp_path}", names.where("run_id = 'run_1'"), apply=True)
    assert not list((tmp_path / "raw/run_1").rglob("*.png")) and list((tmp_path / "raw/run_0").rglob("*.png"))


def test_holdout_config_is_the_seeded_draw(spark, tmp_path):
    for k in range(12):
        run = f"r_{30000 + k}"
        (tmp_path / "raw" / run).mkdir(parents=True)
        rand = {"preset": "fog" if k % 2 else "", "distance_start_cm": 100, "distance_end_cm": 2000 if k < 8 else 150}
        (tmp_path / "raw" / run / "manifest.json").write_text(json.dumps(MANIFEST | {"run_id": run, "frame_count": 3, "randomization": rand}))
    (tmp_path / "build.yaml").write_text(corpus.holdout_config(spark, str(tmp_path / "raw"), "data"))
    c = load_build_config(tmp_path / "build.yaml")
    assert len(c.runs) == 12 and len(c.val_runs) == 6 and set(c.val_runs) <= set(c.runs)
    import random

    draw = random.Random(20260728)
    want = []
    for odd in (1, 0):
        want += draw.sample([f"r_{30000 + k}" for k in range(8, 12) if k % 2 == odd], 1)
        want += draw.sample([f"r_{30000 + k}" for k in range(8) if k % 2 == odd], 2)
    assert sorted(want) == list(c.val_runs)


def test_sky_audit(spark, tmp_path):
    for k in range(12):
        run = f"run_{k:02d}"
        (tmp_path / "raw" / run / "normal").mkdir(parents=True)
        blue = 200 if k == 5 else 100
        image = np.zeros((4, 4, 3), np.uint8)
        image[:, :, 0] = blue
        (tmp_path / "raw" / run / "normal/frame_000000.png").write_bytes(png.encode(image))
        m = MANIFEST | {"run_id": run, "frame_count": 1, "seed": k, "randomization": {"time_of_day": 8 + k * 0.5}}
        (tmp_path / "raw" / run / "manifest.json").write_text(json.dumps(m))
    rows = corpus.audit_sky(spark, str(tmp_path / "raw"), [f"run_{k:02d}" for k in range(12)]).collect()
    assert Counter(r.verdict for r in rows) == {"ok": 11, "wrong": 1}
    assert next(r for r in rows if r.verdict == "wrong").run_id == "run_05"


def test_stream_converts_complete_runs_once(spark, tmp_path):
    ingest(spark, tmp_path, "run_a")
    (tmp_path / "raw/run_b/normal").mkdir(parents=True)
    seen = []
    for _ in range(2):
        convert_on_arrival(spark, str(tmp_path / "raw"), str(tmp_path / "ck"), seen.extend, once=True).awaitTermination()
    assert seen == ["run_a"]


def test_manifest_rules():
    good = MANIFEST | {"run_id": "r-1", "frame_count": 2}
    assert checked_manifest(good | {"new": 1}) == {"run_id": "r-1"} | {k: good[k] for k in ("captured_at", "frame_count", "ue_map", "drone_model", "camera_sequence")} | {"randomization": {}, "generator": {}, "seed": None, "schema_version": 1}
    for bad in ({"schema_version": 2}, {"run_id": "R"}, {"run_id": "r\n"}, {"captured_at": "July"}, {"frame_count": 0}, {"ue_map": " "}):
        with pytest.raises(ManifestRefused):
            checked_manifest(good | bad)
    with pytest.raises(ManifestRefused, match="frame_count"):
        checked_manifest({k: v for k, v in good.items() if k != "frame_count"})


def test_annotation_rules():
    box = {"class_id": 0, "x": 1, "y": 2, "w": 3, "h": 4, "mask_area": 5, "fill_ratio": 0.5}
    frame = {"frame_index": 0, "normal": "a.png", "width": 9, "height": 9, "boxes": [box]}
    assert checked_annotations([frame])[0]["boxes"][0] == box | {"components": 1, "contrast": None}
    for bad in ({"extra": 1}, {"boxes": [box | {"more": 1}]}, {"boxes": [{"x": 1}]}, {"boxes": None}):
        with pytest.raises(ManifestRefused):
            checked_annotations([frame | bad])
    assert checked_provenance({"run_id": "r", "converted_at": "t"})["converter"] == {}
    with pytest.raises(BuildRefused):
        checked_dataset_manifest({"schema_version": 3})


def test_scene_identity_keeps_exact_numbers():
    base = {"seed": 1, "randomization": {"a": 30.0}, "ue_map": "m", "drone_model": "d", "generator": {}}
    assert scene_of(base) != scene_of(base | {"randomization": {"a": 30}})
    assert scene_of(base) == scene_of(base | {"run_id": "x"}) != scene_of(base | {"seed": 2})


def test_labels():
    assert label_line(0, 5, 10, 10, 20, 64, 48) == "0 0.156250 0.416667 0.156250 0.416667"
    assert label_line(0, 10, 12, 8, 6, 64, 48) == "0 0.218750 0.312500 0.125000 0.125000"


CONVERT = {"class_map": {0: "drone"}, "mask": {"threshold": 32, "min_box_area": 16}, "storage": {"raw_root": "a", "dataset_root": "b", "qc_root": "c"}}
BUILD = {"runs": ["a ", "b"], "split": {"mode": "by_run", "val_runs": ["b"]}, "storage": {"raw_root": "a", "dataset_root": "b"}}


def test_configs(tmp_path):
    path = tmp_path / "c.yaml"

    def written(values):
        path.write_text(yaml.safe_dump(values))
        return path

    assert load_convert_config(written(CONVERT | {"other": 1})).threshold == 32
    for bad in ({"class_map": {}}, {"class_map": {-1: "x"}}, {"mask": {"threshold": 255, "min_box_area": 1}}, {"mask": {"threshold": 1, "min_box_area": -1}}, {"mask": {"threshold": 1}}, {"storage": {}}):
        with pytest.raises(ConfigRefused):
            load_convert_config(written(CONVERT | bad))
    assert load_build_config(written(BUILD)).runs == ("a", "b")
    for bad in ({"runs": []}, {"runs": ["a", "a"]}, {"runs": [" "]}, {"split": {"mode": "by_frame"}}, {"split": {"mode": "by_run", "val_runs": "a"}}):
        with pytest.raises(ConfigRefused):
            load_build_config(written(BUILD | bad))
    path.write_text("a: [")
    with pytest.raises(ConfigRefused):
        load_build_config(path)
    with pytest.raises(ConfigRefused):
        load_build_config(tmp_path / "none.yaml")


def test_store(spark, tmp_path):
    s = Store.at(spark, str(tmp_path / "root"))
    assert s.list_keys("none") == [] and not s.exists("a/b")
    s.write_text("a/b", "x")
    s.write_text("a/b", "y")
    assert s.read_text("a/b") == "y" and s.list_keys() == ["a/b"] and s.list_keys("a") == ["a/b"]
    s.write_text_if_absent("a/c", "1")
    with pytest.raises(KeyExists):
        s.write_text_if_absent("a/c", "2")
    with pytest.raises(KeyMissing):
        s.read_text("nothing")
    with pytest.raises(KeyMissing):
        s.get_file("nothing", tmp_path / "z")
    s.put_file(tmp_path / "root/a/b", "d/e")
    s.get_file("d/e", tmp_path / "out/f")
    assert (tmp_path / "out/f").read_text() == "y"
    s.delete_prefix("a")
    assert s.list_keys() == ["d/e"]
    with pytest.raises(StoreRefused):
        Store.at(spark, "s3://")


def test_stamp(tmp_path):
    assert stamp_from({"VANTAGRID_COMMIT": "abc", "VANTAGRID_DIRTY": "No"}, tmp_path)["dirty"] is False
    assert stamp_from({"VANTAGRID_COMMIT": "abc", "VANTAGRID_DIRTY": "maybe"}, tmp_path)["dirty"] is None
    assert stamp_from({"VANTAGRID_COMMIT": "unknown"}, tmp_path) == {"repo": "vantagrid", "commit": None, "dirty": None}


def test_command_line(tmp_path, capsys):
    assert cli.main(["build", "--config", str(tmp_path / "none.yaml"), "--version", "v"]) == 2
    assert "error: no config" in capsys.readouterr().err
    command = cli.submit_command("run_1", "v002", "c.yaml", "yarn")
    assert "convert-run_1-v002" in command and command[-6:] == ["--config", "c.yaml", "--run-id", "run_1", "--version", "v002"]
    with pytest.raises(SystemExit):
        cli.main(["nonsense"])


def test_runs_as_a_data_source(spark, tmp_path):
    from vantagrid.sources.runs import register

    register(spark)
    for run, manifest in (("a", MANIFEST | {"run_id": "a", "frame_count": 2, "seed": 5}), ("b", {"schema_version": 9}), ("c", None)):
        (tmp_path / run).mkdir()
        if manifest:
            (tmp_path / run / "manifest.json").write_text(json.dumps(manifest, indent=2))
    rows = {r.folder: r for r in spark.read.format("runs").load(str(tmp_path)).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].seed == 5 and rows["a"].problem is None and "schema_version" in rows["b"].problem


def test_stamp_of_a_checkout(tmp_path):
    git = lambda *a: subprocess.run(["git", "-c", "user.name=x", "-c", "user.email=x@y", *a], cwd=tmp_path, check=True, capture_output=True, text=True).stdout.strip()
    (tmp_path / "vantagrid").mkdir()
    code = tmp_path / "vantagrid/a.py"
    code.write_bytes(b"one\ntwo\n")
    assert stamp_from({}, tmp_path)["commit"] is None
    git("init", "-q")
    assert stamp_from({}, tmp_path) == {"repo": "vantagrid", "commit": None, "dirty": None}
    git("add", ".")
    git("commit", "-qm", "x")
    head = git("rev-parse", "HEAD")[:12]
    said = lambda: stamp_from({}, tmp_path)
    assert said() == {"repo": "vantagrid", "commit": head, "dirty": False}
    (tmp_path / "notes.txt").write_text("beside the code")
    code.write_bytes(b"one\r\ntwo\r\n")
    assert said()["dirty"] is False
    code.write_bytes(b"one\nthree\n")
    assert said()["dirty"] is True
    code.write_bytes(b"one\ntwo\n")
    (tmp_path / "vantagrid/new file.py").write_text("")
    assert said()["dirty"] is True
    (tmp_path / "vantagrid/new file.py").unlink()
    code.unlink()
    assert said()["dirty"] is True
    assert stamp_from({"VANTAGRID_COMMIT": "abc", "VANTAGRID_DIRTY": "1"}, tmp_path) == {"repo": "vantagrid", "commit": "abc", "dirty": True}


def test_store_puts_copies_and_deletes(spark, tmp_path):
    store = Store.at(spark, str(tmp_path / "s"))
    store._write_new("a/b.json", "one")
    with pytest.raises(KeyExists):
        store._write_new("a/b.json", "two")
    assert store.read_text("a/b.json") == "one"
    copy_file(store.path("a/b.json"), store.path("c/d.json"))
    assert store.read_text("c/d.json") == "one"
    with pytest.raises(FileNotFoundError):
        copy_file(store.path("nothing"), store.path("c/e.json"))
    for k in range(7):
        store.write_text(f"k/{k}", "x")
    assert store.deletes_at_once >= 1 and store.delete_keys(f"k/{k}" for k in range(5)) == 5
    assert store.list_keys("k") == ["k/5", "k/6"]
    objects = Store(spark, "s3a://bucket/raw")
    assert objects.of_objects and not store.of_objects
    with pytest.raises(NotPermitted):
        objects.delete_prefix("run_1")


def test_prune_by_a_snapshot(spark, tmp_path):
    store = Store.at(spark, str(tmp_path / "s"))
    for run in ("run_a", "run_b"):
        for key in (f"raw/{run}/manifest.json", f"qc/{run}/report.json", f"datasets/auto-{run}/a b.json"):
            store.write_text(key, "x")
    keys = snapshot_keys(spark, store.root, str(tmp_path / "keys"))
    store.write_text("raw/run_a/late.png", "x")
    runs = spark.createDataFrame([("run_a",)], "run_id string")
    want = {"raw/run_a": 1, "qc/run_a": 1, "datasets/auto-run_a": 1}
    assert prune(spark, store.root, runs, keys=keys) == want and len(store.list_keys()) == 7
    assert prune(spark, store.root, runs, apply=True, keys=keys) == want
    assert [k for k in store.list_keys() if "run_a" in k] == ["raw/run_a/late.png"]


def test_no_image_is_decoded_twice(spark, tmp_path, monkeypatch):
    ingest(spark, tmp_path, "run_d", [(10, 20, 5, 15), None])
    seen = []
    monkeypatch.setattr(convert, "decoded", lambda *a, own=convert.decoded: seen.append(a[3]) or own(*a))
    report = convert_run(spark, "run_d", converting(tmp_path), "v1")
    assert sorted(seen) == ["mask", "normal"] and report.total_boxes == 1
