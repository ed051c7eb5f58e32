"""Shared plumbing of the corpus operators: table access and shared scratch tables."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches handed to Python hold at most so many rows and bytes.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

#: A word is a maximal run of characters other than these (ASCII white space).
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a batch of very long texts fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is named, a local one if they are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="vantagrid-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


class Scratch:
    """Written tables that cut lineage: they survive lost executors.

    ``keep`` writes a frame as Parquet into the shared folder and reads it back;
    ``drop`` removes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.mode("overwrite").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.vantagrid_path = path  # type: ignore[attr-defined]
        return kept

    def drop(self, *kept: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in kept:
            path = jvm.org.apache.hadoop.fs.Path(df.vantagrid_path)
            path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, rows: int) -> bool:
    """Whether a frame has at most so many rows; what a broadcast is checked by."""
    return df.limit(rows + 1).count() <= rows


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``, in bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    return next(n for k in itertools.count() if (n := f"{name}_{k}").lower() not in taken)


def utf8(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
