"""A data source of runs: ``spark.read.format("runs").load(raw_root)``.

One row a complete run, by its manifest; each run is a partition of its own, so
manifests are read in parallel. A manifest that is refused has its problem in the row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vantagrid.schemas import MANIFEST
from vantagrid.sources.documents import checked_manifest
from vantagrid.sources.store import arrow_path

_COLUMNS = ("run_id", "captured_at", "frame_count", "ue_map", "drone_model", "camera_sequence", "seed")


class RunSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "runs"

    def schema(self) -> str:
        return "folder string, problem string, run_id string, captured_at string, frame_count int, ue_map string, drone_model string, camera_sequence string, seed long, randomization string, generator string"

    def reader(self, schema) -> DataSourceReader:
        root = self.options["path"]
        return RunReader(root if "://" in root else f"file://{root}")


class RunReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = arrow_path(self.root)
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return [InputPartition(i.base_name) for i in sorted(found, key=lambda i: i.path) if i.type == fs.FileType.Directory]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, path = arrow_path(f"{self.root}/{partition.value}/{MANIFEST}")
        try:
            with store.open_input_stream(path) as f:
                text = f.read().decode()
        except FileNotFoundError:
            return  # not complete
        try:
            m = checked_manifest(json.loads(text))
        except ValueError as e:
            yield (partition.value, str(e), *[None] * 9)
            return
        yield (partition.value, None, *[m[c] for c in _COLUMNS], json.dumps(m["randomization"]), json.dumps(m["generator"]))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RunSource)
