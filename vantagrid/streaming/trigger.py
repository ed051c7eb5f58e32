"""Streams: convert runs as their manifests arrive, and a stream over the events table.

A manifest is written last, so its arrival means that its run is complete; partial
runs never show. Each micro-batch is handled idempotently, so a replay after a
failure gives the same state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vantagrid.functions.text import run_of_key
from vantagrid.workspace import shared_path


def arriving_manifests(spark: SparkSession, raw_root: str) -> DataFrame:
    """(run_id, path) of run manifests as they appear under ``raw_root``/<run>/."""
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", "manifest.json").schema("path string, modificationTime timestamp, length long, content binary").load(f"{raw_root.rstrip('/')}/*/")
    tail = F.concat_ws("/", F.lit("raw"), F.element_at(F.split("path", "/"), -2), F.element_at(F.split("path", "/"), -1))
    return files.select(run_of_key(tail).alias("run_id"), "path").where("run_id IS NOT NULL")


def convert_on_arrival(spark: SparkSession, raw_root: str, checkpoint: str, convert: Callable[[list[str]], None], once: bool = False) -> StreamingQuery:
    """Call ``convert`` with the run ids of each micro-batch; with ``once`` stop when all that is there is done."""

    def handle(batch: DataFrame, _: int) -> None:
        found = sorted(r.run_id for r in batch.select("run_id").distinct().collect())
        if found:
            convert(found)

    writer = arriving_manifests(spark, raw_root).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def counted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a file stream: count and range of ids of each type.

    Each micro-batch is reduced and written under its own number, overwriting what a
    failed attempt may have left; the parts are added up at the end.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*.parquet")
    out = shared_path(spark, "stream")
    ids = [F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")]

    def handle(batch: DataFrame, number: int) -> None:
        batch.groupBy("event_type").agg(*ids).write.mode("overwrite").parquet(f"{out}/parts/batch={number}")

    query = events.writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    parts = spark.read.schema("event_type string, n long, first_id long, last_id long, batch long").parquet(f"{out}/parts")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
