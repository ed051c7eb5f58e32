"""Placement: files copied and written from a table of sources and targets, by many tasks."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row

from vantagrid.sources.store import copy_file, write_bytes

#: Requests that one task has under way at a time.
IN_FLIGHT = 16
#: Rows of a task where there are more than the session's tasks can share.
PER_TASK = 10_000


def place(rows: DataFrame) -> None:
    """Copy ``source`` to ``target`` in each row; with ``label_target``, also write ``label_text`` there.

    Targets follow from the rows alone and are overwritten, so a task that is retried
    on another executor does the same again. The first failure ends the job.
    """
    labelled = "label_target" in rows.columns

    def one(r: Row) -> None:
        copy_file(r.source, r.target)
        if labelled:
            write_bytes(r.label_target, r.label_text.encode())

    def run(part: Iterable[Row]) -> None:
        with ThreadPoolExecutor(IN_FLIGHT) as pool:
            for _ in pool.map(one, part):
                pass

    kept = rows.cache()
    n = kept.count()
    parts = min(-(-n // IN_FLIGHT), max(rows.sparkSession.sparkContext.defaultParallelism, n // PER_TASK))
    kept.repartition(max(parts, 1)).foreachPartition(run)
    kept.unpersist()
