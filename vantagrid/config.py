"""Typed configs: everything that decides a dataset's content comes through here."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import yaml

from vantagrid.errors import ConfigRefused


@dataclass(frozen=True)
class ConvertConfig:
    """How a run becomes annotations: class, mask settings, and where things lie."""

    class_map: dict[int, str]
    threshold: int
    min_box_area: int
    raw_root: str
    dataset_root: str
    qc_root: str


@dataclass(frozen=True)
class BuildConfig:
    """Which runs a dataset version has, and which of them are held out."""

    runs: tuple[str, ...]
    val_runs: tuple[str, ...]
    mode: str
    raw_root: str
    dataset_root: str


class _Section:
    """A mapping that refuses to lack a key."""

    def __init__(self, values: object, where: str):
        if not isinstance(values, dict):
            raise ConfigRefused(f"{where} must be a mapping")
        self.values, self.where = values, where

    def __getitem__(self, key: str):
        if key not in self.values:
            raise ConfigRefused(f"{self.where} lacks '{key}'")
        return self.values[key]

    def section(self, key: str) -> _Section:
        return _Section(self[key], key)

    def whole(self, key: str, low: int, high: int | None = None) -> int:
        value = self[key]
        if isinstance(value, bool) or not isinstance(value, int) or value < low or high is not None and value > high:
            limits = f"from {low}" + (f" to {high}" if high is not None else "")
            raise ConfigRefused(f"{self.where}.{key} must be a whole number {limits}, not {value!r}")
        return value


def _read(path: str | Path) -> _Section:
    try:
        return _Section(yaml.safe_load(Path(path).read_text(encoding="utf-8")), f"config {path}")
    except FileNotFoundError:
        raise ConfigRefused(f"no config at {path}") from None
    except yaml.YAMLError as e:
        raise ConfigRefused(f"config {path} is not YAML: {e}") from None


def load_convert_config(path: str | Path) -> ConvertConfig:
    top = _read(path)
    classes = top.section("class_map").values
    if not classes:
        raise ConfigRefused("class_map is empty")
    for k in classes:
        if isinstance(k, bool) or not isinstance(k, int) or k < 0:
            raise ConfigRefused(f"class_map: {k!r} is not a class id")
    mask, roots = top.section("mask"), top.section("storage")
    return ConvertConfig(
        class_map={k: str(v) for k, v in classes.items()},
        # At 255 no pixel could exceed the threshold.
        threshold=mask.whole("threshold", 0, 254),
        min_box_area=mask.whole("min_box_area", 0),
        raw_root=str(roots["raw_root"]),
        dataset_root=str(roots["dataset_root"]),
        qc_root=str(roots["qc_root"]),
    )


def _names(value: object, what: str) -> list[str]:
    if not isinstance(value, list) or not all(isinstance(v, str) and v.strip() for v in value):
        raise ConfigRefused(f"{what} must be a list of run ids")
    return [v.strip() for v in value]


def load_build_config(path: str | Path) -> BuildConfig:
    top = _read(path)
    runs = _names(top["runs"], "runs")
    if not runs:
        raise ConfigRefused("runs is empty")
    twice = sorted({r for r in runs if runs.count(r) > 1})
    if twice:
        raise ConfigRefused(f"runs lists these more than once: {twice}")
    split, roots = top.section("split"), top.section("storage")
    if split["mode"] != "by_run":
        raise ConfigRefused(f"split.mode {split['mode']!r}: only by_run keeps neighbouring frames on one side")
    val = _names(split.values.get("val_runs") or [], "split.val_runs")
    return BuildConfig(tuple(runs), tuple(val), "by_run", str(roots["raw_root"]), str(roots["dataset_root"]))
